"""Composed jobs: the full transform and the batch runner."""
