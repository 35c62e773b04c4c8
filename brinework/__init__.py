"""Spark jobs for gridded ocean-model data, station series and training-data pipelines."""
