"""Reading and writing: listings, files as lines, datasets, scratch space."""
