"""Reading, checking, staging and writing tables."""
