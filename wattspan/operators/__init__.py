"""Operators: functions from DataFrames and config to a DataFrame."""
