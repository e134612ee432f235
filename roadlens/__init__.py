"""Batch analytics over large tables of timestamped, geolocated road incidents.

Everything is a function from DataFrame to DataFrame (or from Column to
Column) built on Spark's own expressions; composing them is the pipeline.
"""

from roadlens.session import get_session

__all__ = ["get_session"]
