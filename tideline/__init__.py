"""Tideline: layered tables from files and change feeds, on plain PySpark."""

__version__ = "0.1.0"
