"""SQL statements that state each query's result independently of Spark."""
