"""Relational, table-change, audit and row-policy operators over DataFrames."""
