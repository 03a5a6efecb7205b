"""Spark jobs for environmental reporting portals: page corpora and air-quality tables."""
