"""DuckDB restatement of every registered query (correctness oracle)."""
