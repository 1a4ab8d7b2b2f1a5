"""Column functions: no data access, no Python in the data path unless said so."""
