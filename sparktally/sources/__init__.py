"""Typed readers of the input files, and the result writers."""
