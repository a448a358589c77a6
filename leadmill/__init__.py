"""leadmill: marketing-data ingestion, conformance, upserts and star-schema models on Spark."""

__version__ = "0.1.0"
