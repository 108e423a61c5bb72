"""Readers of registers and listings."""
