"""Reports, rule checks and booking workflow for shared rooms, as Spark DataFrame jobs."""
