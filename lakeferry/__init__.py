"""Replicate relational tables into a partitioned lake, refine them and report on them with Spark."""
