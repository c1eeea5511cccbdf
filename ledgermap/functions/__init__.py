"""Column expressions: value semantics, text parsing and memo composition."""
