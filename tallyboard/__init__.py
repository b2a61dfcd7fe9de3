"""Season statistics, award votes and rankings as Spark DataFrame operators and jobs."""
