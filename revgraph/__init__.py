"""revgraph: wiki revision histories as Spark DataFrames and yearly graphs."""

__version__ = "0.1.0"
