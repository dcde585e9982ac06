"""stocktake: audits of large data archives, written as Spark DataFrame jobs."""
