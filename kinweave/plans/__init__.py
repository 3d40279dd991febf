"""Stages, pipelines and queries."""
