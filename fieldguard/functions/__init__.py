"""Column builders: scanning and masking one text."""
