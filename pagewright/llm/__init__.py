"""Training-data operators for page text.  Nothing outside this subpackage imports it."""
