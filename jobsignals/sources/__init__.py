"""Reading, landing, replacing, upserting and exporting tables."""
