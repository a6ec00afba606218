"""riskloom: scoring, profiling and drift analytics as Spark jobs."""

__version__ = "0.1.0"
