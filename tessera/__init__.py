"""tessera: a Spark-first engine for assembling, partitioning and auditing row datasets."""

__version__ = "0.1.0"
