"""Whole reports: the operators bound to tables or to raw input files."""
