"""Field-survey analytics as composable Spark DataFrame operations."""

__version__ = "0.1.0"
