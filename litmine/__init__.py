"""Literature mining on Spark: article records in, term edges and triples out."""
