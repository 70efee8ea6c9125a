"""Ingestion as streams."""
