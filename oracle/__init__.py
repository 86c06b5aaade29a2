"""DuckDB SQL formulations used to check the Spark queries."""
