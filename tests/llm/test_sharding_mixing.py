"""Histogram-sort shards and the weighted mixture: laws, hot keys, edge rows."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from rentledger.llm import histogram
from rentledger.llm.histogram import Goal, boundaries
from rentledger.llm.mixing import mix, mixed_documents, period, phases
from rentledger.llm.sharding import histogram_sort, shard_documents

DOCS = "doc_id long, text string, lang string, source string, n_chars long, slot string, shard string"


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(4)
    rows = [(i, "w" * rng.randrange(1, 400), "en", f"s{rng.randrange(4)}", 0, "x", "y") for i in range(3000)]
    rows += [(7, "same", "en", "s0", 0, None, None)] * 1500  # a third repeats in every column
    rows += [(None, None, None, None, None, None, None)] * 40 + [(9001, "", "en", "s1", 0, "x", "y")]
    rows += [(9002, "long " * 20_000, "en", "s2", 0, "x", "y")]
    return spark.createDataFrame(rows, DOCS).repartition(5).cache()


def test_shards_have_near_equal_bytes_and_gapless_slots(docs):
    found = shard_documents(docs).collect()
    assert len(found) == docs.count()
    slots, sizes = defaultdict(list), Counter()
    for r in found:
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r.size
    assert set(slots) <= set(range(16))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    largest = max(r.size for r in found)
    mean = sum(sizes.values()) / 16
    assert all(abs(sizes[i] - mean) <= largest for i in range(16))
    others = [sizes[i] for i in sizes if sizes[i] < largest]
    assert len(others) >= 11 and max(others) - min(others) <= largest


def test_sizes_and_checksums(docs):
    texts = Counter((r.doc_id, r.text) for r in docs.collect())
    expected = Counter({(i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())): n for (i, t), n in texts.items()})
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in shard_documents(docs).collect()) == expected


def test_one_hot_row_is_cut_between_shards(spark):
    rows = spark.createDataFrame([(1, "same")] * 4000, "doc_id long, text string")
    assert Counter(r.shard for r in shard_documents(rows, 8).collect()) == {i: 500 for i in range(8)}


def test_order_is_kept_and_clashing_columns_are_replaced(spark):
    rows = spark.range(5000).select("id", F.lit("old").alias("shard"), (F.col("id") % 3).alias("slot"))
    found = histogram_sort(rows, (F.col("id") - 2500, F.lit(0)), F.lit(1), 4)
    assert found.columns == ["id", "shard", "slot"]
    assert [(r.id, r.shard * 1250 + r.slot) for r in found.orderBy("id").collect()] == [(i, i) for i in range(5000)]


def test_null_order_values_come_first(spark):
    rows = spark.createDataFrame([(5,), (None,), (-3,)], "k long")
    found = histogram_sort(rows, (F.col("k"), F.lit(0)), F.lit(1), 1).orderBy("slot").collect()
    assert found[2].k == 5 and {found[0].k, found[1].k} == {None, -3}


def test_an_empty_table_has_no_shards(docs):
    assert shard_documents(docs.limit(0)).count() == 0


def test_boundaries_are_exact_for_skewed_keys(spark):
    rows = spark.createDataFrame([(1, i, 10) for i in range(900)] + [(1 << 40, i, 10) for i in range(100)], "key long, tie long, size long")
    found = boundaries(rows, [Goal("rows", n, 0) for n in (1, 450, 900, 950)] + [Goal("bytes", 5000, 0)])
    assert [b.rows for b in found] == [1, 450, 900, 950, 500]


@pytest.mark.parametrize("weights", [{0: 1}, {0: 3, 1: 1, 2: 7, 3: 2}, {0: 1, 1: 99}, {i: i % 4 + 1 for i in range(21)}])
def test_a_period_deviates_by_less_than_a_block(weights):
    slots, total, done = period(weights), sum(weights.values()), Counter()
    assert Counter(slots) == weights
    for t, stream in enumerate(slots, 1):
        done[stream] += 1
        assert all(abs(done[s] * total - t * w) < total for s, w in weights.items())


def test_phases_use_up_every_block():
    weights, blocks = {0: 3, 1: 1, 2: 2}, {0: 10, 1: 17, 2: 1}
    plan = phases(weights, blocks)
    assert {s: sum(p["used"].get(s, 0) for p in plan) for s in blocks} == blocks
    assert [set(p["at"]) for p in plan] == [{0, 1, 2}, {0, 1}, {1}]


def test_the_mixture_keeps_all_rows_and_its_weights(docs):
    weights = {"s0": 3, "s1": 1, "s2": 2}
    found = mix(docs, weights, other=2, block_bytes=2000).collect()
    assert len(found) == docs.count() and all(r.slot is not None for r in found)
    assert {r.stream for r in found if r.source is None or r.source == "s3"} == {3}
    by_stream = defaultdict(list)
    for r in found:
        by_stream[r.stream].append(r)
    used, sizes = defaultdict(set), {}
    for stream, own in by_stream.items():
        own.sort(key=lambda r: r.place)
        assert [r.place for r in own] == list(range(len(own)))
        before = 0
        for r in own:
            assert r.block == before // 2000
            before += len((r.text or "").encode()) + 1
            used[stream].add((r.block, r.slot))
        assert [r.slot for r in own] == sorted(r.slot for r in own)
        sizes[stream] = -(-before // 2000)
    expected = plain_schedule({0: 3, 1: 1, 2: 2, 3: 2}, sizes)
    assert all(expected[s, b] == slot for s, own in used.items() for b, slot in own)


def plain_schedule(weights, blocks):
    """Slot of every block, by trying every stream in every slot: released blocks only, the earliest deadline first."""
    left, done, found = dict(blocks), Counter(), {}
    while own := {s: w for s, w in weights.items() if left.get(s, 0) > 0}:
        total, had, now = sum(own.values()), Counter(), 0
        while all(left[s] for s in own):
            ready = [s for s in own if had[s] * total // own[s] <= now]
            stream = min(ready, key=lambda s: (-(-(had[s] + 1) * total // own[s]), s))
            assert -(-(had[stream] + 1) * total // own[stream]) > now
            found[stream, done[stream]] = len(found)
            left[stream] -= 1
            done[stream] += 1
            had[stream] += 1
            now += 1
    return found


CLASHING = ("key", "tie", "size", "range", "rows", "bytes", "copy", "hash", "row", "c0", "c1", "id", "__key", "__tie", "__range", "__size", "__rows", "__file", "__row", "place2")


def test_columns_of_any_name_pass_through(spark, docs, tmp_path):
    odd = docs.withColumns({n: F.lit(i) for i, n in enumerate(CLASHING)})
    for made in (
        mix(odd, {"s0": 2}, block_bytes=500), histogram_sort(odd, (F.xxhash64("doc_id"), F.lit(0)), F.lit(1), 3), mixed_documents(odd, {"s0": 2}),
    ):
        assert set(odd.columns) <= set(made.columns) and made.count() == odd.count()
        assert [tuple(r) for r in made.select(*CLASHING).distinct().collect()] == [tuple(range(len(CLASHING)))]


def test_copies_of_one_row_are_cut_between_ranges(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(histogram, "ROWS_PER_RANGE", 50)
    spark.createDataFrame([(1, "same", "s0")] * 900 + [(i, f"t{i}", "s1") for i in range(600)], "doc_id long, text string, source string").repartition(4).write.parquet(str(tmp_path / "d"))
    found = mix(spark.read.parquet(str(tmp_path / "d")), {"s0": 1, "s1": 1}, block_bytes=100)
    rows = found.collect()
    assert sorted(r.place for r in rows if r.stream == 0) == list(range(900)) and sorted(r.place for r in rows if r.stream == 1) == list(range(600))
    plan = found.select("place")._jdf.queryExecution().executedPlan().toString()
    assert "range" in plan
    assert max(Counter(r.block for r in rows if r.stream == 0).values()) == 20


def test_the_stored_mixture_has_the_old_columns_in_the_new_order(spark, docs, tmp_path):
    mixed_documents(docs, {"s0": 1, "s1": 1, "s2": 1}, block_bytes=1000).write.parquet(str(tmp_path / "m"))
    found = spark.read.parquet(str(tmp_path / "m"))
    assert found.columns == docs.columns and found.exceptAll(docs).count() == 0 == docs.exceptAll(found).count()
    first = found.orderBy("_metadata.file_name", "_metadata.row_index").limit(100).collect()
    assert {r.source for r in first} >= {"s0", "s1", "s2"}


def test_mixing_edges(docs):
    assert mix(docs.limit(0), {"a": 1}).count() == 0
    assert {r.stream for r in mix(docs, {}).collect()} == {0}
    for bad in ({"a": 0}, {str(i): 1 for i in range(300)}):
        with pytest.raises(ValueError):
            mix(docs, bad)
