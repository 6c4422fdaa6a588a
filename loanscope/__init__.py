"""Loan portfolio cleaning and reporting as Spark DataFrame transformations."""
