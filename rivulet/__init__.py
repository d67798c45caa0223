"""rivulet: event and table analytics as plain Spark DataFrame and streaming jobs."""

__version__ = "0.1.0"
