"""Operators on records, reports and dimensions."""
