"""Column-expression helpers: everything here returns a ``Column`` and stays
inside whole-stage codegen (no Python UDF)."""
