"""Retail, rental and vehicle-sharing analytics written as Spark DataFrame jobs."""
