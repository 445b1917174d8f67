"""Classical machine-learning data work expressed as Spark jobs."""

__version__ = "0.1.0"
