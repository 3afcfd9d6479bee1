"""Column functions: parsing of messy text, text rules, geography."""
