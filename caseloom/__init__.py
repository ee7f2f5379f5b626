"""caseloom: deterministic evidence pipelines expressed as Spark DataFrames."""
