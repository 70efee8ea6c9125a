"""Build and audit directories of local businesses from raw sightings, on Spark."""

__version__ = "0.1.0"
