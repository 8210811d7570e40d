"""Reading raw files, publishing tables, and the sample-data views."""
