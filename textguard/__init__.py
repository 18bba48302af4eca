"""textguard: scan text tables and tidy JSON field names with Spark DataFrames."""
