"""Daily sales reporting on Spark: one set of report definitions for batch and stream."""

__version__ = "0.1.0"
