"""Settlement queries for advertising-media spend, as Spark DataFrame jobs."""
