"""Column expressions shared by the operators (no Spark actions here)."""
