"""Road-traffic analytics as Spark DataFrame transforms, shared by batch and Structured Streaming."""
