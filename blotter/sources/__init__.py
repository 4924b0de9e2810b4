"""Reading landed files, extracts, catalog tables and the supplied test tables."""
