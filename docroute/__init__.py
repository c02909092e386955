"""Document intake on Spark: identifier resolution, duplicate routing, packing and lifecycle queries."""
