"""Streaming jobs and the versioned changelog they write."""
