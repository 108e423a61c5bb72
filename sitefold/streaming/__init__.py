"""Streaming landing of harvested rows."""
