"""Composite jobs: operators chained into the pipelines a user runs."""
