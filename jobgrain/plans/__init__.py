"""Cleaning, layers, serving queries and the batch job."""
