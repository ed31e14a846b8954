"""Models and serving queries: functions from DataFrames to DataFrames."""
