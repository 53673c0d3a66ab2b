"""martforge: sales-drop ingest and reporting marts as Spark jobs."""

__version__ = "0.1.0"
