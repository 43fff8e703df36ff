"""Manufacturing-yield root-cause analysis as Spark DataFrame jobs."""
