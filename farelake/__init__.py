"""farelake: trip analytics on Spark, from a raw landing table to reports and data checks."""

__version__ = "0.1.0"
