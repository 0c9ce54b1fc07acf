"""Operators over DataFrames; none of them collects or writes."""
