"""Behaviour analytics over event tables and streams, written for Spark."""

__version__ = "0.1.0"
