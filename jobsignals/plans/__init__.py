"""Domain transforms from raw postings to marts."""
