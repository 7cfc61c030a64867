"""Operators: functions from DataFrame to DataFrame, with columns and limits as parameters."""
