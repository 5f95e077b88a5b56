"""Message-delivery analytics expressed as Spark DataFrames."""
