"""Column functions: each takes and returns Spark columns, so that plans stay inside code generation."""
