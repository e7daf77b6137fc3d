"""Operators on whole DataFrames: joins, rankings, aggregates."""
