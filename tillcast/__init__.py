"""A sales warehouse and revenue forecast engine made of Spark DataFrame jobs."""
