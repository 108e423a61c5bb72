"""Pipelines and shared plan helpers."""
