"""Behaviour analytics and recommendation tables on Spark DataFrames."""
