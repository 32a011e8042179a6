"""Interval and coverage analytics on Spark DataFrames.

Coordinates are 0-based and closed (start0, stop0) inside; sources and sinks convert.
"""
