"""Attribution-shaped tables derived from the test tables, in Spark and in DuckDB SQL."""
