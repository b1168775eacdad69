"""Column expressions: text normalisation, dense and sparse vector arithmetic.

Everything here returns a ``Column`` built from Spark's built-in functions, so
it stays inside whole-stage code generation."""
