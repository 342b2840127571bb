"""Operators: functions from DataFrame to DataFrame, or fit functions that return small parameter objects."""
