"""Column builders: text to stamps, numbers, units and identifiers."""
