"""Operators for preparing training data at scale, each usable on any table."""
