"""Operators: functions from DataFrames to DataFrames or fitted models."""
