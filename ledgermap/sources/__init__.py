"""Tables in and out: landed sources, translation tables, mapping sheets, import files."""
