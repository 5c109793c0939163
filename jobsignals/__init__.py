"""Job-market analytics on Spark: land postings, attach signals, build occupation marts."""
