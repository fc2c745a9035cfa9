"""Reading, landing and writing datasets."""
