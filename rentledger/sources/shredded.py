"""Semi-structured columns: paths that occur often are stored as typed columns, the rest as VARIANT.

Which paths there are, of which type and how often, is one aggregate over the rows; only paths that a stated share of
the rows has come to the driver, so there are at most as many as a row has on average, divided by that share. Nothing else has
to be known in advance and nothing is lost: a value of another type, a rare path, or a text that is no JSON
stays in the rest. Conditions on a stored path are conditions on a column and reach the Parquet reader.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHARE = 0.2  # of the rows that have to hold a path with one type
TYPES = {"BIGINT": "bigint", "STRING": "string", "BOOLEAN": "boolean", "DOUBLE": "double"}
_MAP = "map<string,variant>"


@dataclass(frozen=True)
class Layout:
    """The stored paths of a JSON column: column name to path and type. A path is a list of keys."""

    column: str
    paths: Mapping[str, tuple[tuple[str, ...], str]]

    @property
    def rest(self) -> str:
        return f"{self.column}_rest"

    @property
    def text(self) -> str:
        return f"{self.column}_text"

    def name(self, *path: str) -> str | None:
        return next((n for n, (p, _) in self.paths.items() if p == path), None)


def _entries(value: Column) -> Column:
    """Keys and values of an object, NULL for anything else."""
    return F.try_variant_get(value, "$", _MAP)


def _kind(value: Column) -> Column:
    """The type of a value: integers and decimals of JSON have a type for each size, which are one here where they are whole."""
    schema = F.schema_of_variant(value)
    return F.when(schema.startswith("OBJECT"), "OBJECT").otherwise(schema)


def discover(rows: DataFrame, column: str, share: float = SHARE, depth: int = 2) -> Layout:
    """The layout for a text column of JSON: paths that at least `share` of all rows hold with one of `TYPES`.

    Objects are looked into for `depth` levels. Each level is one aggregate: keys and types are counted in the tasks and
    combined, rare ones are dropped before anything is collected.
    """
    parsed = rows.select(F.try_parse_json(column).alias("v"))
    n = parsed.count()
    paths: dict[str, tuple[tuple[str, ...], str]] = {}
    level: list[tuple[str, ...]] = [()]
    for _ in range(depth):
        found = []
        for path in level:
            inside = parsed.select(F.explode(_entries(_at(F.col("v"), path))).alias("key", "value"))
            counts = inside.groupBy("key", _kind(F.col("value")).alias("kind")).agg(F.count(F.lit(1)).alias("n"))
            often = counts.where(F.col("n") >= max(1.0, share * n)).orderBy("key", F.desc("n"), "kind").collect()
            for r in often:
                own = (*path, r.key)
                if r.kind == "OBJECT":
                    found.append(own)
                elif r.kind in TYPES and own not in [p for p, _ in paths.values()]:
                    paths[f"{column}_p{len(paths)}"] = (own, TYPES[r.kind])
        level = found
    return Layout(column, paths)


def _at(value: Column, path: tuple[str, ...]) -> Column:
    """The value under a path of keys, whatever characters they have."""
    for key in path:
        value = F.element_at(_entries(value), F.lit(key))
    return value


def _typed(value: Column, kind: str) -> Column:
    """The value as its column holds it, NULL where it has another type."""
    name = next(n for n, t in TYPES.items() if t == kind)
    return F.when(F.schema_of_variant(value) == name, F.try_variant_get(value, "$", kind))


def shred(rows: DataFrame, layout: Layout) -> DataFrame:
    """The rows with the JSON column replaced by a column for each path, a VARIANT for the rest, and the text where it is no JSON.

    Objects lose the keys that a column holds; what is no object stays whole in the rest.
    """
    value = F.try_parse_json(layout.column)
    parsed = rows.withColumn(layout.rest, value)
    whole = F.col(layout.rest)
    typed = {n: _typed(_at(whole, path), kind) for n, (path, kind) in layout.paths.items()}
    held = parsed.withColumns({**typed, layout.text: F.when(whole.isNull(), F.col(layout.column))})
    return held.withColumn(layout.rest, _without(whole, layout, ())).drop(layout.column)


def _unless(key: str, name: str) -> Callable[[Column, Column], Column]:
    return lambda k, v: (k != key) | F.col(name).isNull()


def _replaced(key: str, inner: Column) -> Callable[[Column, Column], Column]:
    return lambda k, v: F.when(k == key, inner).otherwise(v)


def _without(value: Column, layout: Layout, prefix: tuple[str, ...]) -> Column:
    """An object without what columns hold of it."""
    below = {p[len(prefix)] for p, _ in layout.paths.values() if p[: len(prefix)] == prefix and len(p) > len(prefix)}
    if not below:
        return value
    own = {p[-1]: n for n, (p, _) in layout.paths.items() if p[:-1] == prefix}
    entries = _entries(value)
    for key, name in own.items():
        entries = F.map_filter(entries, _unless(key, name))
    for key in sorted(below - set(own)):
        inner = _without(F.element_at(_entries(value), F.lit(key)), layout, (*prefix, key))
        entries = F.transform_values(entries, _replaced(key, inner))
    return F.coalesce(F.to_variant_object(entries), value)


def unshred(stored: DataFrame, layout: Layout) -> DataFrame:
    """The rows with the JSON column put together again: the same values, with keys in alphabetical order and no white space."""
    value = _whole(F.col(layout.rest), layout, ())
    return stored.withColumn(layout.column, F.coalesce(layout.text, F.to_json(value))).drop(layout.rest, layout.text, *layout.paths)


def _whole(value: Column, layout: Layout, prefix: tuple[str, ...]) -> Column:
    below = {p[len(prefix)] for p, _ in layout.paths.values() if p[: len(prefix)] == prefix and len(p) > len(prefix)}
    if not below:
        return value
    own = {p[-1]: n for n, (p, _) in layout.paths.items() if p[:-1] == prefix}
    entries = _entries(value)
    for key in sorted(below - set(own)):
        inner = _whole(F.element_at(_entries(value), F.lit(key)), layout, (*prefix, key))
        entries = F.transform_values(entries, _replaced(key, inner))
    for key, name in own.items():
        one = F.try_variant_get(F.try_parse_json(F.to_json(F.array(name))), "$[0]", "variant")
        entries = F.when(F.col(name).isNull(), entries).otherwise(F.map_concat(entries, F.create_map(F.lit(key), one)))
    return F.coalesce(F.to_variant_object(entries), value)


def path_column(layout: Layout, *path: str) -> Column:
    """A stored path as a column to be compared; a path that is not stored is looked up in the rest."""
    name = layout.name(*path)
    return F.col(name) if name else _at(F.col(layout.rest), path)
