"""Prefix scans, as-of joins, interval joins, overlaps: against plain versions, on hot keys, and by their plans."""

from __future__ import annotations

import datetime as dt
import os
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from rentledger.operators.intervals import _binned, audit_no_overlap, conflicts, interval_join, overlaps
from rentledger.operators.running import Running, asof_join, moving_sum, ntile, percent_rank, with_running
from rentledger.plans import timeline
from rentledger.sources.shared import stored_once
from tests.oracle_check import differences, oracle_connection

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "SinglePartition")


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")
@pytest.mark.parametrize("name", sorted(timeline.QUERIES))
def test_query(spark, name):
    frame = timeline.QUERIES[name](spark, FOLDER)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    one_row = ("SinglePartition",) if name.startswith("audit") else ()
    keyless = ("SinglePartition",) if name in ("running_revenue", "payment_ranks", "recent_rate", "moving_revenue") else ()  # one row for each range
    assert not [operator for operator in FORBIDDEN if operator in plan and operator not in (*one_row, *keyless)]
    assert differences(frame, oracle_connection(FOLDER), timeline.ORACLES[name]) == []


# --- running values


def plain_running(rows, descending):
    """(key, order, tie, value) rows to all running values."""
    found = {}
    groups = defaultdict(list)
    for row in rows:
        groups[row[0]].append(row)
    size = lambda o: (o is None, o or 0)
    for own in groups.values():
        own.sort(key=lambda r: r[2])
        own.sort(key=lambda r: size(r[1]), reverse=descending)
        for i, (_, order, tie, value) in enumerate(own):
            upto = [r[3] for r in own[: i + 1] if r[3] is not None]
            peers = [r[3] for k, r in enumerate(own) if k <= i or r[1] == order]
            smaller = [r[1] for r in own[:i] if r[1] != order]
            total = [v for v in peers if v is not None]
            before = [r[3] for r in own[:i] if r[3] is not None]
            found[tie] = (
                sum(upto) if upto else None, len(upto), min(upto, default=None), max(upto, default=None), upto[-1] if upto else None,
                sum(before) if before else None, max(before, default=None), sum(total) if total else None,
                i + 1, len(smaller) + 1, len(set(map(size, smaller))) + 1,
                own[i - 1][3] if i else None, own[i + 1][2] if i + 1 < len(own) else None, len(own),
            )
    return found


VALUES = {
    "s": Running("sum", "v"), "c": Running("count", "v"), "lo": Running("min", "v"), "hi": Running("max", "v"), "l": Running("last", "v"),
    "sb": Running("sum", "v", before=True), "hb": Running("max", "v", before=True), "t": Running("total", "v"),
    "n": Running("row_number"), "r": Running("rank"), "d": Running("dense_rank"),
    "lg": Running("lag", "v"), "ld": Running("lead", "tie"), "z": Running("size"),
}


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("spread", [2, 40, 10_000])
def test_running_values_over_hot_keys_and_long_runs_of_peers(spark, conf, spread, descending):
    conf(shuffle__partitions=13, adaptive__coalescePartitions__enabled=False)
    rng = random.Random(spread)
    rows = []
    for tie in range(3000):
        key = None if tie % 97 == 0 else 0 if tie % 3 else rng.randrange(1, 40)  # two thirds on one key
        order = None if rng.random() < 0.05 else rng.randrange(spread)
        rows.append((key, order, tie, None if rng.random() < 0.1 else rng.randrange(-50, 50)))
    table = spark.createDataFrame(rows, "k long, o long, tie long, v long").repartition(5)
    found = with_running(table, VALUES, ["o"], ["k"], ties=["tie"], descending=descending)
    assert found.columns == [*table.columns, *VALUES]
    assert {r.tie: tuple(r)[4:] for r in found.collect()} == plain_running(rows, descending)
    whole = with_running(table.drop("k"), VALUES, ["o"], ties=["tie"], descending=descending)
    assert {r.tie: tuple(r)[3:] for r in whole.collect()} == plain_running([(0, *r[1:]) for r in rows], descending)


def test_running_values_of_no_rows_and_of_copies(spark, conf):
    conf(shuffle__partitions=7, adaptive__coalescePartitions__enabled=False)
    table = spark.createDataFrame([(1, 2, 3)] * 500, "k long, o long, v long")
    found = with_running(table, {"n": Running("row_number"), "t": Running("total", "v"), "r": Running("rank")}, ["o"], ["k"])
    assert sorted(r.n for r in found.collect()) == list(range(1, 501)) and {(r.t, r.r) for r in found.collect()} == {(1500, 1)}
    assert with_running(table.limit(0).withColumn("tie", F.col("v")), VALUES, ["o"], ["k"], ties=["v"]).count() == 0


def test_peers_in_many_ranges_with_nulls_and_zeros(spark, conf):
    conf(shuffle__partitions=9, adaptive__coalescePartitions__enabled=False)
    for values in ([None] * 300, [None] * 200 + [0] * 100, [0] * 100 + [None] * 200, [None] * 100 + [5, -5] * 100):
        rows = [(1, 1, i, v) for i, v in enumerate(values)] + [(1, 2, 1000, 7), (1, 0, -1, None)]
        table = spark.createDataFrame(rows, "k long, o long, tie long, v long")
        found = with_running(table, {"t": Running("total", "v")}, ["o"], ["k"], ties=["tie"])
        assert {r.tie: r.t for r in found.collect()} == {t: v[7] for t, v in plain_running(rows, False).items()}


def test_decimals_and_other_columns_keep_their_types(spark):
    table = spark.createDataFrame([(1, "a")], "o int, x string").withColumn("m", F.lit("1.50").cast("decimal(18,2)"))
    found = with_running(table, {"s": Running("sum", "m"), "o2": Running("max", "x")}, ["o"])
    assert dict(found.dtypes) == {"o": "int", "x": "string", "m": "decimal(18,2)", "s": "decimal(28,2)", "o2": "string"}


def test_a_hot_key_is_cut_into_ranges_and_nothing_large_is_broadcast(spark, conf, tmp_path):
    conf(shuffle__partitions=16, adaptive__coalescePartitions__enabled=False)
    path = str(tmp_path / "t")
    spark.range(30_000).select(F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(-1).alias("k"), F.col("id").alias("o"), F.lit(1).alias("v")).write.parquet(path)
    found = with_running(spark.read.parquet(path), {"s": Running("sum", "v")}, ["o"], ["k"])
    assert found.where("k = -1").agg(F.max("s")).first()[0] == 20_000
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SinglePartition" not in plan
    stored = spark.read.parquet(next(p for p in found.inputFiles()).rsplit("/", 1)[0])
    sizes = [r["count"] for r in stored.groupBy("_range").count().collect()]
    assert len(sizes) > 10 and max(sizes) < 3 * 30_000 / 16
    assert stored.where("k = -1").select("_range").distinct().count() > 8


@pytest.mark.parametrize("n", [1, 3, 4, 9])
def test_tiles_and_shares(spark, n):
    rows = spark.createDataFrame([(i, s) for s in range(1, 12) for i in range(1, s + 1)], "row long, size long")
    found = rows.select("row", "size", ntile(F.col("row"), F.col("size"), n).alias("t"), percent_rank(F.col("row"), F.col("size")).alias("p")).collect()
    for size in range(1, 12):
        own = [r.t for r in sorted((r for r in found if r["size"] == size), key=lambda r: r.row)]
        wide = [size // n + (k < size % n) for k in range(n)]
        assert own == [k + 1 for k, w in enumerate(wide) for _ in range(w)]
    assert all(r.p == ((r.row - 1) / (r["size"] - 1) if r["size"] > 1 else 0) for r in found)


def test_moving_sums(spark, conf):
    conf(shuffle__partitions=9, adaptive__coalescePartitions__enabled=False)
    rng = random.Random(8)
    rows = [(i, rng.choice([0, 0, 0, 1, None]), None if i % 40 == 0 else rng.randrange(120), None if rng.random() < 0.3 else rng.randrange(-9, 9)) for i in range(500)]
    table = spark.createDataFrame([(i, k, day(t), v) for i, k, t, v in rows], "i long, k long, t timestamp_ntz, v long")
    for keys in ([], ["k"]):
        found = {r.i: r.m for r in moving_sum(table, "m", "v", "t", F.expr("INTERVAL 5 DAYS"), keys).collect()}
        for i, k, t, _ in rows:
            inside = [v for _, k2, t2, v in rows if t is not None and t2 is not None and t - 5 <= t2 <= t and (not keys or k2 == k) and v is not None]
            assert found[i] == (sum(inside) if inside else None)


# --- as-of


def day(n):
    return None if n is None else dt.datetime(2020, 1, 1) + dt.timedelta(days=n)


@pytest.mark.parametrize("exact", [True, False])
def test_asof_join(spark, conf, exact):
    conf(shuffle__partitions=9, adaptive__coalescePartitions__enabled=False)
    rng = random.Random(11)
    draw = lambda n: None if rng.random() < 0.05 else rng.randrange(n)
    left = [(i, 0 if i % 2 else draw(5), draw(60)) for i in range(800)]
    right = [(0 if i % 3 == 0 else draw(5), draw(60), rng.randrange(4), draw(9)) for i in range(150)]
    expected = {}
    for i, k, t in left:
        ok = [r for r in right if k is not None and t is not None and r[0] == k and r[1] is not None and (r[1] < t or exact and r[1] == t)]
        best = max(ok, key=lambda r: (r[1], r[2], r[3] is None, r[3] or 0), default=None)
        recent = best is not None and t - best[1] <= 3
        expected[i] = ((best[2], best[3], day(best[1])) if best else (None,) * 3, best[2] if recent else None)
    a = spark.createDataFrame([(i, k, day(t)) for i, k, t in left], "i long, k long, t timestamp_ntz")
    b = spark.createDataFrame([(k, day(t), x, y) for k, t, x, y in right], "k long, t timestamp_ntz, x long, y long")
    found = asof_join(a, b, ("t", "t"), {"rate": "x", "more": "y"}, [("k", "k")], exact=exact, matched="since").collect()
    near = asof_join(a, b, ("t", "t"), {"rate": "x", "more": "y"}, [("k", "k")], exact=exact, within=F.expr("INTERVAL 3 DAYS")).collect()
    assert {r.i: (r.rate, r.more, r.since) for r in found} == {i: e[0] for i, e in expected.items()} and len(found) == len(left)
    assert {r.i: r.rate for r in near} == {i: e[1] for i, e in expected.items()}


def test_asof_with_an_empty_side(spark):
    a = spark.createDataFrame([(1, 5)], "k long, t long")
    assert [tuple(r) for r in asof_join(a, a.limit(0), ("t", "t"), {"found": "t"}, [("k", "k")]).collect()] == [(1, 5, None)]
    assert asof_join(a.limit(0), a, ("t", "t"), {"found": "t"}, [("k", "k")]).count() == 0


# --- intervals


def spans(rng, n, scale):
    made = []
    for i in range(n):
        start = rng.randrange(-1000, 1000)
        length = rng.choice([0, 1, 3, 4, 5, rng.randrange(20), rng.randrange(scale), -1])
        made.append((i, rng.choice([0, 0, 1, 2, None]), None if i % 41 == 0 else start, None if i % 43 == 0 else start + length))
    return made


@pytest.mark.parametrize("part", [5, 10_000])
@pytest.mark.parametrize("closed", [True, False])
def test_interval_join(spark, closed, part):
    rng = random.Random(part)
    own = spans(rng, 300, 900)
    points = [(i, rng.choice([0, 0, 1, 2, None]), None if i % 50 == 0 else rng.randrange(-1100, 1100)) for i in range(400)]
    expected = Counter(
        (p, s) for p, pk, at in points for s, sk, a, b in own
        if None not in (pk, at, sk, a, b) and pk == sk and a <= b and a <= at and (at <= b if closed else at < b)
    )
    left = spark.createDataFrame(points, "p long, pk long, at long")
    right = spark.createDataFrame(own, "s long, sk long, a long, b long")
    found = interval_join(left, right, "at", ("a", "b"), [("pk", "sk")], closed=closed, part=part)
    assert Counter((r.p, r.s) for r in found.collect()) == expected and len(expected) > 500
    keyless = interval_join(left, right, "at", ("a", "b"), closed=closed, condition=F.col("p") < F.col("s"), part=part).count()
    assert keyless == sum(None not in (at, a, b) and a <= b and a <= at and (at <= b if closed else at < b) and p < s for p, _, at in points for s, _, a, b in own)


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date", "double", "decimal(10,3)", "int"])
def test_intervals_of_every_kind_of_value(spark, kind):
    rng = random.Random(1)
    base = spark.createDataFrame([(i, rng.randrange(5000), rng.randrange(400)) for i in range(200)], "i long, x long, n long")
    number = {"double": "x / 7D", "decimal(10,3)": "CAST(x / 7 AS DECIMAL(10,3))", "int": "CAST(x AS INT)"}
    moment = lambda x: F.expr(number[kind].replace("x", x)) if kind in number else F.expr(f"CAST(CAST('2020-01-01' AS TIMESTAMP_NTZ) + make_dt_interval({x} - 2000) AS {kind})")
    left = base.select(F.col("i").alias("p"), moment("x").alias("at"))
    right = base.select(F.col("i").alias("s"), moment("(x - n)").alias("a"), moment("(x + n)").alias("b"))
    found = {(r.p, r.s) for r in interval_join(left, right, "at", ("a", "b")).select("p", "s").collect()}
    expected = {(r.p, r.s) for r in left.join(right, F.expr("a <= at AND at < b")).select("p", "s").collect()}
    assert found == expected and len(found) > 500


def test_very_long_and_very_short_intervals(spark):
    big = 1 << 62
    right = spark.createDataFrame([(0, -big, big), (1, 0, 1), (2, 7, 7), (3, -big, -big + 1), (4, big - 1, big)], "s long, a long, b long")
    left = spark.createDataFrame([(x,) for x in (-big, 0, 1, 7, 8, big - 1, big)], "at long")
    found = Counter((r.at, r.s) for r in interval_join(left, right, "at", ("a", "b"), closed=True).collect())
    expected = Counter((x, s) for x in (-big, 0, 1, 7, 8, big - 1, big) for s, a, b in ((0, -big, big), (1, 0, 1), (2, 7, 7), (3, -big, -big + 1), (4, big - 1, big)) if a <= x <= b)
    assert found == expected
    assert interval_join(left, right.limit(0), "at", ("a", "b")).count() == 0 == interval_join(left.limit(0), right, "at", ("a", "b")).count()


def test_few_candidates_are_compared_whatever_the_lengths(spark):
    """Many short and some very long intervals: intervals in the bins that are looked into stay near the pairs found."""
    rng = random.Random(2)
    own = [(i, a := rng.randrange(10**6), a + (rng.randrange(5, 10) if i % 100 else 300_000)) for i in range(5000)]
    right = spark.createDataFrame(own, "s long, a long, b long")
    left = spark.range(0, 10**6, 200).withColumnRenamed("id", "at")
    found = sum(-(-min(b, 10**6) // 200) - -(-a // 200) for _, a, b in own)
    assert interval_join(left, right, "at", ("a", "b")).count() == found
    bins = _binned(right.selectExpr("a AS _from", "b AS _to")).groupBy("_level", "_bin").count()
    compared = bins.withColumn("points", F.expr("greatest(least((_bin + 1) * shiftleft(1L, 2 * _level), 1000000) - _bin * shiftleft(1L, 2 * _level), 0) / 200"))
    assert bins.agg(F.sum("count")).first()[0] <= 2 * len(own)
    assert compared.agg(F.sum(F.expr("count * points"))).first()[0] < 8 * found


def test_a_bin_with_a_third_of_the_points_is_split(spark, conf):
    conf(
        autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1", adaptive__advisoryPartitionSizeInBytes="64KB",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="64KB", adaptive__skewJoin__skewedPartitionFactor="2", shuffle__partitions="16",
    )
    points = spark.range(0, 300_000, 1, 8).select(F.when(F.col("id") % 3 == 0, 77_777).otherwise(F.col("id") * 7).alias("at"), F.hash("id").alias("p"))
    spans = spark.range(0, 4000, 1, 4).select((F.col("id") * 500).alias("a"), (F.col("id") * 500 + 300).alias("b"))
    found = interval_join(points, spans, "at", ("a", "b"))
    assert len(found.collect()) == 100_000 + sum((7 * i) % 500 < 300 and 7 * i < 2_000_000 for i in range(300_000) if i % 3)
    assert "skew=true" in found._jdf.queryExecution().executedPlan().toString()


def test_overlaps_and_conflicts(spark, conf):
    conf(shuffle__partitions=9, adaptive__coalescePartitions__enabled=False)
    rng = random.Random(4)
    own = [(i, k, a, b) for i, k, a, b in spans(rng, 250, 60)]
    table = spark.createDataFrame(own, "id long, k long, a long, b long")
    usable = [(i, k, a, b) for i, k, a, b in own if a is not None and b is not None and a < b]
    pairs = {(x[0], y[0]) for x in usable for y in usable if None not in (x[1], y[1]) and x[1] == y[1] and (x[2], x[0]) < (y[2], y[0]) and x[2] < y[3] and y[2] < x[3]}
    found = overlaps(table, "a", "b", ["k"], ["id"], part=7)
    assert found.columns == [f"{s}_{c}" for s in ("second", "first") for c in table.columns]
    assert Counter((r.first_id, r.second_id) for r in found.collect()) == Counter(pairs)
    late = {y[0] for x in usable for y in usable if x[1] == y[1] and (x[2], x[0]) < (y[2], y[0]) and y[2] < x[3]}
    assert {r.id for r in conflicts(table, "a", "b", ["k"], ["id"]).collect()} == late
    assert [tuple(r) for r in audit_no_overlap(table, "once", "a", "b", ["k"], ["id"]).collect()] == [("once", len(late))]
    assert overlaps(table.limit(0), "a", "b", ["k"], ["id"]).count() == 0


# --- what may be read again


@pytest.mark.parametrize("made", [
    lambda t: t.limit(3), lambda t: t.withColumn("x", F.rand()), lambda t: t.withColumn("x", F.uuid()), lambda t: t.sample(0.5),
    lambda t: t.withColumn("x", F.current_timestamp()), lambda t: t.distinct(), lambda t: t.orderBy("a"), lambda t: t.join(t.select("a").limit(2), "a"),
    lambda t: t.withColumn("x", F.monotonically_increasing_id()), lambda t: t.where("a IN (SELECT 1)"), lambda t: t.union(t),
])
def test_only_plain_sources_are_read_again(spark, tmp_path, made):
    spark.range(9).selectExpr("id AS a", "id % 2 AS b").write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    for plain in (table, table.select("a").where("a > 1"), table.withColumn("c", F.col("a") + 1).alias("z")):
        assert stored_once(plain) is plain
    source = made(table)
    kept = stored_once(source)
    assert kept is not source and kept.exceptAll(kept).count() == 0 and kept.inputFiles()[0] != table.inputFiles()[0]


def test_few_counts_and_plain_columns_go_through_an_interval_join(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("rentledger.sources.shared.shared_dir", lambda spark: str(tmp_path / "shared"))
    monkeypatch.setattr("rentledger.operators.intervals.BUCKETS", 16)
    spark.range(4000).selectExpr("id AS s", "id % 50 AS k", "id * 10 AS a", "id * 10 + 1 + id % 200 AS b", "id AS unused").write.parquet(str(tmp_path / "spans"))
    spark.range(3000).selectExpr("id AS p", "id % 700 AS `_bin`", "id * 13 AS at", "id AS `_s0`").write.parquet(str(tmp_path / "points"))
    own, points = spark.read.parquet(str(tmp_path / "spans")), spark.read.parquet(str(tmp_path / "points"))
    found = interval_join(points, own, "at", ("a", "b"), [("_bin", "k")])
    assert found.columns == [*points.columns, *own.columns]
    expected = {(p, s) for p in range(3000) if p % 700 < 50 for s in range(p % 700, 4000, 50) if s * 10 <= p * 13 < s * 10 + 1 + s % 200}
    assert {(r.p, r.s) for r in found.collect()} == expected and expected
    counted = spark.read.parquet(str(next((tmp_path / "shared").glob("rows-*"))))
    assert counted.count() <= 16 * counted.select("_level").distinct().count() and counted.agg(F.sum("n")).first()[0] >= 4000
    plan = found.select("p", "s")._jdf.queryExecution().optimizedPlan().toString()
    moved = [line for line in plan.splitlines() if "Relation" not in line]
    assert any("LeftSemi" in line for line in moved) and not any("unused" in line or "_span" in line for line in moved)


def test_overlaps_compare_plain_columns_and_do_not_look_for_their_own_keys(spark):
    table = spark.createDataFrame([(1, 0, 0, 9), (2, 0, 5, 7), (3, 1, 5, 7)], "id long, k long, a long, b long")
    found = overlaps(table, "a", "b", ["k"], ["id"])
    assert [(r.first_id, r.second_id) for r in found.collect()] == [(1, 2)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert not [word for word in ("_span", "_point", "LeftSemi") if word in plan]


def test_overlaps_read_bookings_once(spark):
    """Random beginnings differ each time they are read; every booking has one, and pairs are those of a plain comparison."""
    begin = F.floor(F.rand() * 200)
    drawn = spark.range(0, 300, 1, 4).select(F.lit(1).alias("k"), F.col("id").alias("n"), begin.alias("s")).withColumn("e", F.col("s") + 1 + F.col("n") % 7)
    pairs = overlaps(drawn, "s", "e", ["k"], ["n"]).collect()
    rows = {(p[f"{side}_n"], p[f"{side}_s"]) for p in pairs for side in ("first", "second")}
    spans = {n: (s, n, s + 1 + n % 7) for n, s in rows}
    assert pairs and len(spans) == len(rows)
    wanted = {(a[1], b[1]) for a in spans.values() for b in spans.values() if a < b and b[0] < a[2]}
    assert sorted((p.first_n, p.second_n) for p in pairs) == sorted(wanted)
