"""Training-data operators: dedup, decontamination, quality, secrets,
tokens, packing and page extraction.  Nothing else in the library imports
this subpackage."""
