"""Cleaning and analysis of public-health record tables on Spark DataFrames."""
