"""Merge and logs, multiset differences, levels, sketches, closure, streams: against plain versions, with edge rows."""

from __future__ import annotations

import datetime as dt
import itertools
import json
import os
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from rentledger.operators.closure import reachable
from rentledger.operators.levels import Measure, cube_sets, grouping_sets, rollup_sets
from rentledger.operators.merge import MergeConflict, apply_log, compose_logs, merge, undo_log
from rentledger.operators.multiset import except_all, intersect_all, same_rows, table_difference
from rentledger.operators.sketches import DISTINCT_BOUND, RANK_BOUND, daily_sketches, exact_range, sketched_range
from rentledger.plans import revisions
from rentledger.sources.shredded import discover, path_column, shred, unshred
from rentledger.streaming import loads
from tests.fixtures import bag
from tests.oracle_check import differences, oracle_connection

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "Expand")


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")
@pytest.mark.parametrize("name", sorted(revisions.QUERIES))
def test_query(spark, name):
    frame = revisions.QUERIES[name](spark, FOLDER)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    several = ("Expand",) if name == "revenue_rollup" else ()  # two counted values; over the stored level, not the fact
    assert not [operator for operator in FORBIDDEN if operator in plan and operator not in several]
    assert differences(frame, oracle_connection(FOLDER), revisions.ORACLES[name]) == []


# --- merge

T = "k long, a string, v int"


def test_merge_routes_every_row(spark):
    table = spark.createDataFrame([(1, "x", 1), (2, "y", None), (3, "z", 3), (3, "zz", 4), (None, "n", 5), (9, "q", 6)], T)
    source = spark.createDataFrame([(1, 10, "U"), (2, None, "U"), (3, 30, "D"), (4, 40, "U"), (5, 50, "skip"), (None, 60, "U"), (9, 6, "U")], "k long, w int, op string")
    found = merge(
        table, source.withColumnRenamed("w", "v"), ["k"], update={"v": "s.v"}, delete_if=F.col("s.op") == "D", insert=False,
    )
    assert bag(found.table) == bag(spark.createDataFrame([(1, "x", 10), (2, "y", None), (None, "n", 5), (9, "q", 6)], T))
    assert Counter((r.op, r.k) for r in found.log.collect()) == {("U", 1): 1, ("D", 3): 2}
    inserted = merge(table, source.select("k", F.col("w").alias("v")), ["k"], insert_if=F.col("s.v") > 45, defaults={"a": "new"}, delete_unmatched=True)
    assert bag(inserted.table.where("a = 'new'")) == bag(spark.createDataFrame([(5, "new", 50), (None, "new", 60)], T))
    assert sorted(r.op for r in inserted.log.collect()) == ["D", "I", "I"]  # the row without a key matches nothing


def test_merge_conditions_that_are_null_do_not_hold(spark):
    table = spark.createDataFrame([(1, "x", 1), (2, "y", 2)], T)
    source = spark.createDataFrame([(1, None, 5), (2, "b", 6), (3, None, 7)], T)
    found = merge(table, source, ["k"], update={"v": "s.v"}, update_if=F.col("s.a") == "b", delete_if=F.col("s.a") == "c", insert_if=F.col("s.a").isNotNull())
    assert bag(found.table) == bag(spark.createDataFrame([(1, "x", 1), (2, "y", 6)], T))


def test_several_matches_are_refused(spark):
    table = spark.createDataFrame([(1, "x", 1)], T)
    twice = spark.createDataFrame([(1, "a", 2), (1, "b", 3), (7, "c", 4), (7, "c", 4)], T)
    with pytest.raises(MergeConflict):
        merge(table, twice, ["k"], update={"v": "s.v"})
    kept = merge(table, twice, ["k"], delete_unmatched=True)
    assert bag(kept.table) == bag(spark.createDataFrame([(1, "x", 1), (7, "c", 4), (7, "c", 4)], T))
    assert merge(table, twice.where("k = 7"), ["k"], update={"v": "s.v"}).table.count() == 3


def test_logs_apply_compose_and_are_taken_back(spark):
    rng = random.Random(5)
    tables = [spark.createDataFrame([(k, rng.choice("ab"), 0) for k in range(40)], T)]
    logs = []
    for _ in range(2):
        rows = [(k, rng.choice("ab"), rng.randrange(2)) for k in rng.sample(range(60), 30)]
        found = merge(tables[-1], spark.createDataFrame(rows, T), ["k"], update={"a": "s.a", "v": "s.v"}, delete_if=F.col("s.k") % 7 == 0, delete_unmatched=rng.random() < 0.5)
        assert same_rows(apply_log(tables[-1], found.log, ["k"]), found.table)
        assert same_rows(apply_log(found.table, undo_log(found.log), ["k"]), tables[-1])
        tables.append(found.table)
        logs.append(found.log)
    both = compose_logs(*logs, ["k"])
    assert same_rows(apply_log(tables[0], both, ["k"]), tables[2])
    assert compose_logs(logs[0], undo_log(logs[0]), ["k"]).isEmpty()
    assert both.select("k").distinct().count() == both.count()


def test_a_small_source_leaves_the_table_where_it_is(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(0, 50_000, 1, 5).selectExpr("id AS k", "'a' AS a", "1 AS v").write.parquet(path)
    found = merge(spark.read.parquet(path), spark.createDataFrame([(1, "b", 2), (-1, "c", 3)], T), ["k"], update={"v": "s.v"})
    assert found.table.count() == 50_001 and found.log.count() == 2
    stored = found.table.groupBy(F.col("_metadata.file_path")).agg(F.min("k").alias("lo"), F.max("k").alias("hi")).collect()
    assert sorted(r.hi - r.lo for r in stored if r.lo >= 0)[-1] < 20_000  # files follow those of the table: it was not exchanged
    assert merge(spark.read.parquet(path).limit(0), found.table.limit(0), ["k"], update={"v": "s.v"}).table.count() == 0


def test_a_hot_key_of_the_table_is_split(spark, conf):
    conf(
        autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1", adaptive__advisoryPartitionSizeInBytes="64KB",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="64KB", adaptive__skewJoin__skewedPartitionFactor="2", shuffle__partitions="16",
    )
    table = spark.range(0, 300_000, 1, 8).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), F.hash("id").cast("string").alias("a"), F.lit(1).alias("v"))
    source = spark.range(0, 3000, 1, 4).select(F.col("id").alias("k"), F.lit("s").alias("a"), F.lit(2).alias("v"))
    found = merge(table, source, ["k"], update={"v": "s.v"}, insert=False)
    stored = [r["count"] for r in found.table.groupBy(F.col("_metadata.file_path")).count().collect()]
    assert sum(stored) == 300_000 and max(stored) < 90_000  # the hot key alone has 100,000 rows
    assert found.table.where("k = 7 AND v = 2").count() == 100_001


# --- differences


def test_multiset_operators_count_repeats_and_nulls(spark):
    a = [(1, "x")] * 5 + [(None, "x")] * 2 + [(2, None)] + [(7, "only")] * 3
    b = [(1, "x")] * 2 + [(None, "x")] * 3 + [(2, None)] + [(8, "other")]
    one, two = (spark.createDataFrame(r, "n long, s string") for r in (a, b))
    assert Counter(map(tuple, except_all(one, two).collect())) == Counter(a) - Counter(b)
    assert Counter(map(tuple, except_all(two, one.select("s", "n")).collect())) == Counter(b) - Counter(a)
    assert Counter(map(tuple, intersect_all(one, two).collect())) == Counter(a) & Counter(b)
    found = {(r.n, r.s): r.surplus for r in table_difference(one, two).collect()}
    assert found == {(1, "x"): 3, (None, "x"): -1, (7, "only"): 3, (8, "other"): -1}
    assert same_rows(one, one.repartition(3)) and not same_rows(one, two) and same_rows(one.limit(0), two.limit(0))
    plan = table_difference(one, two)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan
    with pytest.raises(ValueError):
        table_difference(one, two.withColumnRenamed("s", "t"))


# --- levels


def plain_sets(rows, sets, dims):
    found = Counter()
    for own in sets:
        groups = defaultdict(list)
        for r in rows:
            groups[tuple(r[i] if d in own else None for i, d in enumerate(dims))].append(r)
        if not own and not rows:
            groups[(None,) * len(dims)] = []
        level = sum(1 << (len(dims) - 1 - i) for i, d in enumerate(dims) if d not in own)
        for key, members in groups.items():
            v = [r[3] for r in members if r[3] is not None]
            found[(*key, level, sum(v) if v else None, len(members), len(v), len({r[4] for r in members} - {None}), sum(v) / len(v) if v else None, max(v, default=None))] += 1
    return found


MEASURES = {
    "s": Measure("sum", "v"), "n": Measure("count"), "nv": Measure("count", "v"), "d": Measure("distinct", "w"),
    "m": Measure("avg", "v"), "hi": Measure("max", "v"),
}


@pytest.mark.parametrize("n", [0, 1, 300])
@pytest.mark.parametrize("sets", [cube_sets("abc"), rollup_sets("abc"), [("a",), ("b", "c")], [()]])
def test_grouping_sets(spark, n, sets):
    rng = random.Random(n)
    rows = [(rng.choice([None, 1, 2]), rng.choice("xy"), rng.choice([None, 5, 6, 7]), rng.choice([None, 1, 2, 9]), rng.choice([None, 1, 2, 3])) for _ in range(n)]
    fact = spark.createDataFrame(rows, "a long, b string, c long, v long, w long")
    found = grouping_sets(fact, {"a": "a", "b": "b", "c": "c"}, MEASURES, sets)
    assert Counter(map(tuple, found.collect())) == plain_sets(rows, sets, "abc")
    few = grouping_sets(fact, {"a": "a", "b": "b", "c": "c"}, MEASURES, sets, having=F.col("s") > 50)
    assert Counter(map(tuple, few.collect())) == Counter({k: c for k, c in plain_sets(rows, sets, "abc").items() if (k[4] or 0) > 50})


def test_the_fact_is_read_once(spark, tmp_path):
    path = str(tmp_path / "fact")
    spark.range(1000).selectExpr("id % 3 AS a", "id % 5 AS b", "id AS v", "id % 11 AS w").write.parquet(path)
    found = grouping_sets(spark.read.parquet(path), {"a": "a", "b": "b"}, {"s": Measure("sum", "v"), "d": Measure("distinct", "w")}, cube_sets("ab"))
    assert not [f for f in found.inputFiles() if path in f] and found.count() == 24
    assert "Expand" not in found._jdf.queryExecution().executedPlan().toString()


# --- sketches


def test_merged_sketches_stay_within_their_bounds(spark):
    day = F.date_add(F.lit(dt.date(2020, 1, 1)), (F.col("id") % 30).cast("int"))
    fact = spark.range(60_000).select(day.alias("day"), (F.xxhash64("id") % 7000).alias("who"), F.pow(F.rand(3), F.lit(6)).alias("v"))
    fact.write.mode("overwrite").parquet(f"/tmp/rl-sketch-{os.getpid()}")
    fact = spark.read.parquet(f"/tmp/rl-sketch-{os.getpid()}")
    daily = daily_sketches(fact, "day", "who", "v")
    ranges = [(f"r{a}_{b}", dt.date(2020, 1, a), dt.date(2020, 1, b)) for a, b in itertools.combinations(range(1, 31, 7), 2)] + [("none", dt.date(1999, 1, 1), dt.date(1999, 1, 2))]
    asked = spark.createDataFrame(ranges, "range_name string, since date, until date")
    for quantile in (0.05, 0.5, 0.95):
        near = sketched_range(daily, asked, quantile)
        both = near.join(exact_range(fact, asked, "day", "who", "v", near), "range_name", "left").collect()
        assert len(both) == len(ranges)
        for r in both:
            if r.range_name == "none":
                assert (r.n_rows, r.n_distinct, r.quantile, r.exact_rows) == (0, 0, None, None)
                continue
            assert r.n_rows == r.exact_rows and abs(r.n_distinct - r.exact_distinct) <= DISTINCT_BOUND * r.exact_distinct
            assert r.share_up_to >= quantile - RANK_BOUND and r.share_below <= quantile + RANK_BOUND


# --- closure


def plain_reach(links, seeds):
    after = defaultdict(set)
    for a, b in links:
        if a is not None and b is not None:
            after[a].add(b)
    found = {}
    for s in {s for s in seeds if s is not None}:
        now, steps = {s}, 0
        while now:
            steps += 1
            now = {b for a in now for b in after[a]} - {n for (t, n) in found if t == s}
            found |= {(s, n): steps for n in now}
    return found


@pytest.mark.parametrize("links", [
    [], [(1, 1)], [(1, 2), (2, 3), (3, 1), (3, 4)], [(i, i + 1) for i in range(12)], [(1, None), (None, 2), (1, 2), (1, 2)],
    [(0, i) for i in range(1, 300)] + [(i, 1000) for i in range(1, 300)] + [(1000, 0)],
    [(random.Random(i).randrange(30), random.Random(-i - 1).randrange(30)) for i in range(40)],
])
def test_reachable(spark, links):
    given, seeds = spark.createDataFrame(links, "source long, target long"), [1, 1, 3, 0, None, 77]
    found = reachable(given, spark.createDataFrame([(s,) for s in seeds], "seed long"))
    assert Counter({(r.seed, r.node): r.steps for r in found.collect()}) == Counter(plain_reach(links, seeds)) and found.count() == len(plain_reach(links, seeds))
    near = reachable(given, spark.createDataFrame([(s,) for s in seeds], "seed long"), most=2).collect()
    assert {(r.seed, r.node) for r in near} == {k for k, n in plain_reach(links, seeds).items() if n <= 2}


# --- streams

S = "k long, at timestamp, v long"


def arrive(spark, folder, rows):
    spark.createDataFrame(rows, S).coalesce(1).write.mode("append").parquet(folder)


def first_rows(rows):
    best = {}
    for r in rows:
        if r[0] is not None:
            best[r[0]] = min(best.get(r[0], r), r, key=lambda x: (x[1], x[2]))
    return Counter([*best.values(), *(r for r in rows if r[0] is None)])


def moment(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(hours=n)


def test_a_streamed_insert_equals_the_batch_after_restarts_and_with_late_rows(spark, tmp_path, monkeypatch):
    rng = random.Random(6)
    files, table, progress = (str(tmp_path / n) for n in ("files", "table", "progress"))
    schema = spark.createDataFrame([], S).schema
    everything = []
    for run in range(4):
        for _ in range(2):
            rows = [(rng.choice([None, *range(12)]), moment(rng.randrange(200)), rng.randrange(1000)) for _ in range(15)]
            rows += [rows[0]] * 2  # delivered again
            arrive(spark, files, rows)
            everything += rows
        stream = loads.file_stream(spark, files, schema, files_per_batch=1)
        if run == 2:  # fails after a batch is half written
            whole = loads.semi_join
            monkeypatch.setattr(loads, "semi_join", lambda *a, **b: 1 / 0)
            with pytest.raises(Exception):  # noqa: B017, PT011
                loads.insert_stream(stream, table, progress, ["k"], ["at", "v"]).awaitTermination()
            os.makedirs(f"{table}/{loads.BATCH}=4/_temporary", exist_ok=True)
            monkeypatch.setattr(loads, "semi_join", whole)
        loads.insert_stream(stream, table, progress, ["k"], ["at", "v"]).awaitTermination()
        assert Counter(map(tuple, loads.loaded(spark, table, schema, ["k"]).collect())) == first_rows(everything)
    loads.insert_stream(loads.file_stream(spark, files, schema), table, progress, ["k"], ["at", "v"]).awaitTermination()  # nothing new
    small = loads.compacted(spark, table, schema, ["k"], str(tmp_path / "small"))
    assert Counter(map(tuple, small.collect())) == first_rows(everything)


def test_a_batch_that_is_run_again_adds_the_same(spark, tmp_path):
    files, table, progress = (str(tmp_path / n) for n in ("files", "table", "progress"))
    schema = spark.createDataFrame([], S).schema
    arrive(spark, files, [(1, moment(1), 1), (2, moment(2), 2), (None, moment(3), 3)])
    loads.insert_stream(loads.file_stream(spark, files, schema), table, progress, ["k"], ["at"]).awaitTermination()
    before = bag(loads.loaded(spark, table, schema, ["k"]))
    loads.insert_stream(loads.file_stream(spark, files, schema), table, str(tmp_path / "lost"), ["k"], ["at"]).awaitTermination()  # batch 0 anew
    assert bag(loads.loaded(spark, table, schema, ["k"])) == before
    assert loads.loaded(spark, str(tmp_path / "no"), schema, ["k"]).count() == 0


def test_streamed_totals_count_a_row_once_and_say_which_days_are_complete(spark, tmp_path):
    files, table, progress = (str(tmp_path / n) for n in ("files", "table", "progress"))
    schema = spark.createDataFrame([], S).schema
    shape = spark.createDataFrame([], "day date, total long, n_rows long, latest timestamp").schema
    for rows in ([(1, moment(1), 5), (2, moment(30), 7)], [(1, moment(1), 5), (3, moment(2), 1)], [(4, moment(90), 9)]):
        arrive(spark, files, rows)
        stream = loads.file_stream(spark, files, schema)
        loads.totals_stream(stream, table, progress, "at", [], "v", ["k"], "2 days").awaitTermination()
    found = {r.day.day: (r.total, r.n_rows, r.complete) for r in loads.totals(spark, table, shape, [], "2 days").collect()}
    assert found == {1: (6, 2, True), 2: (7, 1, False), 4: (9, 1, False)}


# --- semi-structured columns

DOCUMENTS = [
    '{"k": 1, "o": {"x": "a", "y": 2.5, "z": [1, 2]}, "s": "t"}', '{"k": "odd", "o": {"x": "b"}, "b": true}', "[1, 2]", "not json", None,
    '{"k": 5, "o": 7, "e": {}, "n": null}', '{"k": 10000000000, "o": {"x": "c", "q": {"deep": 1}}, "s": "u", "b": false}', "{}", "3", "",
    '{"a.b": 1, "sp ace": "é", "o": {"x": null}}', '{"k": null, "s": ""}', '{"k": 1, "k": 2}',
]


@pytest.mark.parametrize("share", [0.0, 0.15, 0.9])
@pytest.mark.parametrize("depth", [1, 2, 3])
def test_shredded_documents_lose_nothing(spark, tmp_path, share, depth):
    rows = spark.createDataFrame(list(enumerate(DOCUMENTS)), "i long, j string")
    layout = discover(rows, "j", share, depth)
    shred(rows, layout).write.parquet(str(tmp_path / "t"))
    back = {r.i: r.j for r in unshred(spark.read.parquet(str(tmp_path / "t")), layout).collect()}
    for i, text in enumerate(DOCUMENTS):
        if text in ("not json", None, "", '{"k": 1, "k": 2}'):
            assert back[i] == text
        else:
            assert json.loads(back[i]) == json.loads(text)
    assert discover(rows.limit(0), "j").paths == {}


def test_conditions_on_paths_reach_the_reader(spark, tmp_path):
    rows = spark.createDataFrame(list(enumerate(DOCUMENTS)), "i long, j string")
    layout = discover(rows, "j", 0.15)
    assert {(p, t) for p, t in layout.paths.values()} == {(("k",), "bigint"), (("s",), "string"), (("b",), "boolean"), (("o", "x"), "string")}
    shred(rows, layout).write.parquet(str(tmp_path / "t"))
    found = spark.read.parquet(str(tmp_path / "t")).where(path_column(layout, "k") > 1).where(path_column(layout, "o", "x") == "c")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert [r.i for r in found.collect()] == [6] and "GreaterThan(j_p" in plan and "EqualTo(j_p" in plan
