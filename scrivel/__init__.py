"""Record scrubbing, statement parsing and layout extraction as Spark DataFrame jobs."""

__version__ = "0.1.0"
