"""Loads and totals over streams of files."""
