"""Column expressions. Each function returns a ``Column`` built from Spark
built-ins only, so it stays inside whole-stage codegen."""
