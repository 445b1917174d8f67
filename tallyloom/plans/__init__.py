"""The reference jobs as Spark plans over the given tables."""
