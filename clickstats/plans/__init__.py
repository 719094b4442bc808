"""Composed jobs: the batch plans of each analytics job."""
