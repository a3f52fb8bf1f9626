"""Boosted-tree training, scoring and storage on Spark ML."""
