"""Independent DuckDB SQL for every catalog key (the correctness oracle)."""
