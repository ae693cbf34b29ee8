"""Operators: functions from DataFrames and parameters to DataFrames."""
