"""Typed documents as a graph, queried through one algebra on Spark DataFrames."""
