"""Column expressions: JVM-side, no UDF."""
