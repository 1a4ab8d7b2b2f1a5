"""The whole pipeline and its command line."""
