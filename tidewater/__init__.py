"""Fact streams and dimension tables of an e-commerce warehouse, on Spark."""
