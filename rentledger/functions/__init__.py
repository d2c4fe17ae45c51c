"""Scalar helpers: Columns in, Columns out, all inside whole-stage codegen."""

from rentledger.functions.domains import RATINGS, member_of, within
from rentledger.functions.ordering import asc, desc
from rentledger.functions.text import (
    eq_ci,
    eq_ci_null_as_empty,
    join_text,
    label,
    number_after,
    principal_name,
    size_pretty,
    starred,
)
from rentledger.functions.temporal import (
    add_days,
    difference,
    in_range,
    instant,
    on_or_after,
    wall_time,
    whole_minutes,
    years_since,
)

__all__ = [
    "RATINGS",
    "add_days",
    "asc",
    "desc",
    "difference",
    "eq_ci",
    "eq_ci_null_as_empty",
    "in_range",
    "instant",
    "join_text",
    "label",
    "member_of",
    "number_after",
    "on_or_after",
    "principal_name",
    "size_pretty",
    "starred",
    "wall_time",
    "whole_minutes",
    "within",
    "years_since",
]
