"""Windowed analytics over shop orders, for Spark tables and streams."""
