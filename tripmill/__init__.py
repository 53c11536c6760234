"""Analytics over trip-like records on Spark, in batch and as a stream."""
