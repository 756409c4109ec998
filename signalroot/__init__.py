"""Provenance-first analytics over collections of recorded signals, on Spark DataFrames."""
