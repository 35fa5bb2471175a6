"""Pipelines built from several operators."""
