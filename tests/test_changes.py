from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from rentledger.operators import changes as ch
from rentledger.operators.audits import ConstraintViolation
from rentledger.operators.ids import assign_ids
from tests.fixtures import bag, values

T = "id BIGINT, k STRING, v INT"


@pytest.fixture
def table(spark):
    return spark.createDataFrame([(1, "a", 10), (2, "b", None), (5, None, 30)], T)


def test_insert_if_absent(spark, table):
    source = spark.createDataFrame([("A", 1), ("c", 2), ("c", 3), (None, 4)], "k STRING, v INT")
    result = ch.insert_if_absent(table, source, [F.upper("k")], id_column="id", id_order=["v"])
    assert bag(result.affected) == [(6, "c", 2), (7, "c", 3), (8, None, 4)]
    assert result.table.count() == 6


def test_insert_if_absent_again_adds_only_null_keys(spark, table):
    source = spark.createDataFrame([("c", 2), (None, 4)], "k STRING, v INT")
    once = ch.insert_if_absent(table, source, ["k"]).table
    twice = ch.insert_if_absent(once, source, ["k"])
    assert bag(twice.affected) == [(None, None, 4)]


def test_distinct_insert_drops_exact_copies_only(spark, table):
    source = spark.createDataFrame([("z",), ("z",), ("Z",)], "k STRING")
    result = ch.insert_if_absent(table, source, [F.upper("k")], distinct=True)
    assert sorted(r.k for r in result.affected.collect()) == ["Z", "z"]


def test_defaults_fill_absent_columns_only(spark, table):
    given = spark.createDataFrame([("x", None)], "k STRING, v INT")
    absent = spark.createDataFrame([("y",)], "k STRING")
    assert bag(ch.insert_rows(table, given, defaults={"v": 9}).affected) == [(None, "x", None)]
    assert bag(ch.insert_rows(table, absent, defaults={"v": 9}).affected) == [(None, "y", 9)]
    with pytest.raises(ValueError, match="columns not in the table"):
        ch.insert_rows(table, absent.withColumn("w", F.lit(1)))


def test_skip_conflicts(spark, table):
    source = spark.createDataFrame(
        [("a", 1), ("c", 7), ("c", 3), (None, 1), (None, 1)],
        "k STRING, v INT",
    )
    result = ch.insert_skip_conflicts(table, source, ["k"], ["v"])
    assert bag(result.affected.drop("id")) == [("c", 3), (None, 1), (None, 1)]
    again = ch.insert_skip_conflicts(result.table, source.where("k IS NOT NULL"), ["k"], ["v"])
    assert again.affected.count() == 0


@pytest.mark.parametrize("values_given", [[("c", 10)], [("c", 7), ("d", 7)]])
def test_skip_conflicts_forgives_one_key_only(spark, table, values_given):
    source = spark.createDataFrame(values_given, "k STRING, v INT")
    with pytest.raises(ConstraintViolation) as caught:
        ch.insert_skip_conflicts(table, source, ["k"], ["v"], other_keys=[["v"]])
    assert caught.value.broken == {"v_unique": 1}


def test_statement_that_reads_the_old_table_misses_new_rows(spark, table):
    """Linking against the old state finds nothing for rows just inserted; the new state does."""
    source = spark.createDataFrame([("c", 2)], "k STRING, v INT")
    films = ch.insert_if_absent(table, source, ["k"], id_column="id")
    links = spark.createDataFrame([], "id BIGINT")
    old = ch.insert_if_absent(links, table.join(source, "k").select("id"), ["id"])
    new = ch.insert_if_absent(links, films.table.join(source.select("k"), "k").select("id"), ["id"])
    assert (bag(old.affected), bag(new.affected)) == ([], [(6,)])


def test_insert_chain(spark, table):
    child = spark.createDataFrame([(1, 6, "old")], "child_id BIGINT, id BIGINT, note STRING")
    parent = ch.insert_if_absent(
        table, spark.createDataFrame([("c", 2), ("d", 3)], "k STRING, v INT"), ["k"], id_column="id", id_order=["k"]
    )
    result = ch.insert_chain(
        parent, child, lambda new: new.select("id", F.col("k").alias("note")), ["id"], "child_id", ["id"]
    )
    assert bag(result.affected) == [(2, 7, "d")]


@pytest.mark.parametrize("unique", [None, "left"])
def test_update_from(spark, table, unique):
    source = spark.createDataFrame([("A", 2, None), ("a", 1, "n"), ("zz", 9, "q")], "key STRING, o INT, new STRING")
    result = ch.update_from(
        table, source, [F.upper("k")], {"k": "new", "v": F.col("o") * 100}, [F.upper("key")], ["o"], unique
    )
    assert bag(result.table) == [(1, "n", 100), (2, "b", None), (5, None, 30)]
    assert bag(result.affected) == [(1, "n", 100)]


def test_update_from_sets_null(spark, table):
    source = spark.createDataFrame([("a", None)], "k STRING, new INT")
    assert bag(ch.update_from(table, source, ["k"], {"v": "new"}).affected) == [(1, "a", None)]


def test_update_where_scalar(table):
    newest = table.agg(F.max("id")).scalar()
    result = ch.update_where(table, F.col("id") == newest, {"v": F.lit(0)})
    assert bag(result.affected) == [(5, None, 0)]
    assert result.table.count() == 3


def test_backfill_and_evolve_are_idempotent(table):
    day = F.lit(dt.date(2020, 1, 1))
    once = ch.evolve(table, "record_ts", "date", day)
    twice = ch.evolve(once.table, "record_ts", "date", F.lit(dt.date(2021, 1, 1)))
    assert once.affected.count() == 3
    assert twice.affected.count() == 0
    assert bag(once.table) == bag(twice.table)
    assert bag(ch.backfill(table, "v", -1).affected) == [(2, "b", -1)]


def test_delete_where_keeps_unknown(table):
    result = ch.delete_where(table, F.col("v") > 20)
    assert bag(result.table) == [(1, "a", 10), (2, "b", None)]
    assert bag(result.affected) == [(5, None, 30)]


def test_delete_using(spark, table):
    gone = spark.createDataFrame([("A",), ("A",), (None,)], "k STRING")
    result = ch.delete_using(table, gone, [F.upper("k")], ["k"])
    assert bag(result.affected) == [(1, "a", 10)]
    assert bag(result.table) == [(2, "b", None), (5, None, 30)]


def test_pick_target(spark, table):
    fallback = spark.createDataFrame([(9,), (4,)], "id BIGINT")
    match, miss = F.col("k") == "b", F.col("k") == "nobody"
    assert values(ch.pick_target(table, "id", match, fallback)) == [(2,)]
    assert values(ch.pick_target(table, "id", miss, fallback)) == [(4,)]
    assert values(ch.pick_target(table, "id", miss, fallback.limit(0))) == [(None,)]


@pytest.mark.parametrize("unique_order", [False, True])
def test_ids_follow_the_order_over_many_partitions(spark, unique_order):
    table = spark.createDataFrame([(100,)], "id BIGINT")
    source = spark.range(0, 5000, 1, 7).select(((F.col("id") * 7919) % 5000).alias("n"))
    got = assign_ids(source.repartition(7), table, "id", ["n"], unique_order)
    assert values(got.orderBy("id")) == [(101 + i, i) for i in range(5000)]


def test_ids_without_order_are_dense_and_stable(spark):
    table = spark.createDataFrame([], "id BIGINT")
    got = assign_ids(spark.range(0, 1000, 1, 5).select(F.rand().alias("r")), table, "id")
    first, second = bag(got), bag(got)
    assert first == second
    assert sorted(r[0] for r in first) == list(range(1, 1001))


def test_ids_of_exact_copies_spread_over_partitions(spark, conf):
    conf(adaptive__coalescePartitions__enabled="false")
    table = spark.createDataFrame([], "id BIGINT")
    copies = spark.range(0, 40000, 1, 4).select(F.lit("same").alias("t"))
    got = assign_ids(copies, table, "id", ["t"])
    sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 40000 and max(sizes) < 20000
    assert got.agg(F.count_distinct("id")).first()[0] == 40000


def test_repeats_of_a_hot_key_are_combined_before_the_shuffle(spark, table):
    hot = spark.range(0, 30000, 1, 4).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        (F.col("id") + 1).cast("int").alias("v"),
    )
    result = ch.insert_skip_conflicts(table, hot, ["k"], ["v"])
    assert values(result.affected.where("k = 'hot'").select("v")) == [(1,)]
    assert result.affected.count() == 20001
    assert "partial_min_by" in result.affected._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("made", [
    lambda s: s.range(400).select((F.rand() * 40).cast("int").cast("string").alias("k"), F.col("id").cast("int").alias("v")),
    lambda s: s.range(400).select(F.uuid().alias("k"), F.lit(1).alias("v")),
    lambda s: s.range(4000, numPartitions=8).selectExpr("CAST(id % 40 AS STRING) AS k", "CAST(id AS INT) AS v").limit(50),
    lambda s: s.range(4000).selectExpr("CAST(id % 40 AS STRING) AS k", "CAST(id AS INT) AS v").sample(0.02),
])
def test_a_source_that_differs_each_time_is_read_once(spark, made):
    table = spark.createDataFrame([(i, str(i), 0) for i in range(20)], T)
    for insert in (
        lambda source: ch.insert_if_absent(table, source, ["k"], id_column="id"),
        lambda source: ch.insert_if_absent(table, source, ["k"], distinct=True, id_column="id"),
        lambda source: ch.insert_skip_conflicts(table, source, ["k"], ["v"], id_column="id"),
    ):
        change = insert(made(spark))
        first, second = ([tuple(r) for r in change.affected.orderBy("id").collect()] for _ in range(2))
        assert first == second and not {k for _, k, _ in first} & {str(i) for i in range(20)}
        assert sorted(i for i, _, _ in first) == list(range(20, 20 + len(first)))
        assert change.table.count() == 20 + len(first)


def test_null_keys_into_an_empty_table_are_read_once_and_all_kept(spark, table, tmp_path, monkeypatch):
    monkeypatch.setattr("rentledger.sources.shared.shared_dir", lambda spark: str(tmp_path))
    rows = [("a", 3), ("a", 1), ("a", None), (None, 4), (None, 4), ("b", 2)]
    source = spark.createDataFrame(rows, "k STRING, v INT").distinct().union(spark.createDataFrame([(None, 4)], "k STRING, v INT"))
    empty = spark.createDataFrame([], T)
    result = ch.insert_skip_conflicts(empty, source, ["k"], ["v"], id_column="id")
    assert bag(result.affected.select("k", "v")) == bag(spark.createDataFrame([("a", None), ("b", 2), (None, 4), (None, 4)], "k STRING, v INT"))
    assert sorted(r.id for r in result.affected.collect()) == [1, 2, 3, 4]
    assert len(list(tmp_path.glob("rows-*"))) == 1


@pytest.mark.parametrize("held", [[], [(7, "a", 0), (8, None, 0)]])
@pytest.mark.parametrize("rows", [[("a", 3), ("b", 2), (None, 4), (None, 4)], [("a", 3), ("b", 5), ("b", 2), ("a", 1), (None, 4), (None, 4)]])
@pytest.mark.parametrize("id_column", ["id", None])
def test_whole_sources_give_the_same_rows(spark, held, rows, id_column):
    """As large as the table or not, with keys that repeat or not."""
    table, source = spark.createDataFrame(held, T), spark.createDataFrame(rows, "k STRING, v INT").repartition(3)
    one, other = (ch.insert_skip_conflicts(table, source, ["k"], ["v"], id_column=id_column, whole=whole) for whole in (True, False))
    assert bag(one.affected.select("k", "v")) == bag(other.affected.select("k", "v"))
    assert bag(one.table.select("k", "v")) == bag(other.table.select("k", "v"))
    if id_column:
        first = 9 if held else 1
        assert sorted(r.id for r in one.affected.collect()) == list(range(first, first + one.affected.count()))
    absent = [ch.insert_if_absent(table, source, ["k"], id_column=id_column, whole=whole).affected.select("k", "v") for whole in (True, False)]
    assert bag(absent[0]) == bag(absent[1])


def test_whole_sources_without_repeats_are_stored_once_and_not_grouped_as_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("rentledger.sources.shared.shared_dir", lambda spark: str(tmp_path))
    source = spark.range(1000).selectExpr("uuid() AS k", "CAST(id AS INT) AS v")
    result = ch.insert_skip_conflicts(spark.createDataFrame([], T), source, ["k"], ["v"], id_column="id", whole=True)
    assert result.affected.count() == 1000 and len(list(tmp_path.glob("rows-*"))) == 1
    assert "min_by" not in result.affected._jdf.queryExecution().executedPlan().toString()
