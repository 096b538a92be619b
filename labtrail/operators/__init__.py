"""Operators: functions from DataFrame to DataFrame. All are lazy unless their docstring says otherwise."""
