"""Flight-delay features, samples, quality checks and evaluation tables as Spark DataFrame jobs."""

__version__ = "0.1.0"
