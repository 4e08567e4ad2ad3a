"""tidemark: a Spark-first engine for layered, configuration-driven data processing."""

__version__ = "0.1.0"
