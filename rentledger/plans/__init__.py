"""Whole tasks composed of the operators: reports, table-change recipes, the fleet schema."""
