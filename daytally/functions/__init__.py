"""Column functions and message codecs."""
