"""Every operator and job bound to the given tables, each next to its SQL twin."""
