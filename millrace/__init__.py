"""Tabular feature preparation and modelling on Spark DataFrames."""
