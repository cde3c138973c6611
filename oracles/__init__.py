"""Reference answers in DuckDB SQL, written independently of the Spark plans."""
