"""Column expressions: sensor names, units, dates and report text."""
