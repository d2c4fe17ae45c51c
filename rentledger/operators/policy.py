"""Rows a principal may see."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentledger.functions.text import principal_name
from rentledger.operators.joins import eq_scalar, exists_in_all, ne_scalar
from rentledger.operators.ordering import first_by


def principal_names(
    entity: DataFrame, key: str = "customer_id", first: str = "first_name", last: str = "last_name", raw: bool = False
) -> DataFrame:
    """Each entity's key and the name of its principal."""
    return entity.select(key, principal_name(F.col(first), F.col(last), raw).alias("principal"))


def _owner(entity: DataFrame, principal: str, key: str, first: str, last: str, raw: bool) -> DataFrame:
    named = principal_names(entity, key, first, last, raw)
    return named.where(F.col("principal") == F.lit(principal)).select(key)


def visible_rows(
    fact: DataFrame,
    entity: DataFrame,
    principal: str,
    key: str = "customer_id",
    first: str = "first_name",
    last: str = "last_name",
    raw: bool = False,
) -> DataFrame:
    """Fact rows of the one entity the principal stands for.

    An unknown principal sees nothing; a name shared by two entities is an
    error at run time. The entity is looked up once and its key becomes a
    filter on the scan: the fact is neither joined nor shuffled.
    """
    return eq_scalar(fact, key, _owner(entity, principal, key, first, last, raw))


def policy_leaks(
    visible: DataFrame,
    entity: DataFrame,
    principal: str,
    key: str = "customer_id",
    first: str = "first_name",
    last: str = "last_name",
    raw: bool = False,
) -> DataFrame:
    """Rows that belong to somebody else; there must be none among visible rows."""
    return ne_scalar(visible, key, _owner(entity, principal, key, first, last, raw))


def first_active(entity: DataFrame, key: str, facts: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """The entity with the smallest key among those that occur in every fact."""
    return first_by(exists_in_all(entity, key, facts), key)
