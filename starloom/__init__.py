"""Star schemas from raw tables, written as Spark DataFrame jobs."""
