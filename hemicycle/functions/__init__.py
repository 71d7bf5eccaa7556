"""Column functions: VARIANT access, dates, numbers and text."""
