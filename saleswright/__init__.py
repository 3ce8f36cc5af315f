"""Sales-order analytics on Spark: sources, cleaning, features, reports, profiling."""

__version__ = "0.1.0"
