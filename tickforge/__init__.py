"""Tickforge: replay analytics and operational queries expressed as Spark DataFrames."""
