"""Tag-driven data quality, table health and chargeback on Spark DataFrames."""
