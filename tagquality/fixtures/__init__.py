"""Sample inputs derived from the test parquet, the registered queries and their SQL oracles."""
