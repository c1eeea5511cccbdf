"""Reusable DataFrame operators: lookups, document numbering, netting, packing, keyed updates."""
