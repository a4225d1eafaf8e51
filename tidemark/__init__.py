"""Warehouse modelling and analytics operators for Spark DataFrames."""
