"""Business analytics jobs on Apache Spark: file loads, change capture, curated tables and reports."""

__version__ = "0.1.0"
