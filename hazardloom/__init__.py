"""Survival and competing-risk analytics as Spark DataFrame transformations."""
