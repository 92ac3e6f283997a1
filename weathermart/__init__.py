"""Retail sales x daily weather analytics as plain Spark DataFrame functions.

Layers: raw -> bronze -> silver -> gold, a small star schema on top, ten
reports and a set of data-quality checks. Library code never creates or stops a
session; every step takes DataFrames and returns DataFrames, and only the sinks
and ``plans.pipeline`` run jobs.
"""
