"""Consumer-insight tables from video-platform exports, as Spark DataFrame operators."""

__version__ = "0.1.0"
