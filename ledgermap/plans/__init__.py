"""Dataset builders: seeds, mapping sheets, import datasets, reports and archived variants."""
