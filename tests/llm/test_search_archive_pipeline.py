"""Vector search, archives and the whole pipeline, each against a plain version."""

from __future__ import annotations

import hashlib
import io
import os
import random
import struct
from collections import Counter

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

import __spark_entry__ as registered
import corpus_pipeline
from rentledger.llm import decontamination, simhash, toxicity, vptree, warc

SMALL = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


# --- vectors


def vectors(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 1, "old") for i, v in rows], "vec_id long, embedding array<float>, label int, score string")


def brute(rows, k):
    sound = {i: np.array(v, dtype=np.float32).astype(np.float64) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all() and np.any(v)}
    found = {}
    for q in sorted(i for i in sound if i % 20 == 0):
        order = sorted((-float(np.einsum("i,i->", sound[q], v)), i) for i, v in sound.items() if i != q)
        found[q] = [(i, -s) for s, i in order[:k]]
    return found


@pytest.mark.parametrize("sizes", [{}, {"shards": 40, "least_rows": 20, "most_rows": 100}, {"shards": 3, "least_rows": 1, "most_rows": 10_000}])
def test_factor_one_is_exact(spark, sizes):
    rng = np.random.default_rng(1)
    rows = [(i, (rng.normal(size=6) * rng.uniform(0.1, 3)).tolist()) for i in range(800)]
    rows += [(i, [1, 2, 3, 0, 0, 1]) for i in range(800, 1200)]  # a third are equal
    rows += [(2000, None), (2001, [0] * 6), (2002, [1, None, 1, 1, 1, 1]), (2003, [float("nan")] * 6), (2004, [float("inf")] + [1] * 5), (2020, None)]
    rows += [(None, [1] * 6), (2040, [])]
    found = {}
    for r in vptree.nearest(vectors(spark, rows), F.col("vec_id") % 20 == 0, 20, 1.0, **sizes).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(found[r.query_id])
    expected = brute(rows, 20)
    assert found.keys() == expected.keys()
    for q, own in expected.items():
        assert [i for i, _ in found[q]] == [i for i, _ in own]
        assert np.allclose([s for _, s in found[q]], [s for _, s in own], rtol=1e-12)


def test_a_relaxed_factor_skips_leaves_and_keeps_recall():
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(40, 16)) * 4
    points = centres[rng.integers(0, 40, 6000)] + rng.normal(size=(6000, 16)) * 0.3
    ids, longest = np.arange(6000), np.linalg.norm(points, axis=1).max()
    looked = {}
    results = {}
    for factor in (1.0, 0.5):
        seen = [0]

        class Counting(vptree.Tree):
            def search(self, queries, offer, reach, factor):
                super().search(queries, lambda a, r: (seen.__setitem__(0, seen[0] + len(a) * len(r)), offer(a, r)), reach, factor)

        own, vptree.Tree = vptree.Tree, Counting
        try:
            results[factor] = vptree.best_in_shard(ids, points, ids[:200], points[:200], longest, 10, factor)
        finally:
            vptree.Tree = own
        looked[factor] = seen[0]
    assert looked[0.5] < looked[1.0] <= 200 * 6000
    both = results[1.0].merge(results[0.5], on=["query_id", "vec_id"])
    assert len(both) >= 0.9 * len(results[1.0])


@pytest.mark.parametrize("scale", [1e-3, 1.0, 1e6])
def test_clustered_vectors_of_several_lengths_find_all_of_their_own(spark, scale, monkeypatch):
    monkeypatch.setattr(vptree, "PER_LEAF", 12)
    monkeypatch.setattr(vptree, "SAMPLE", 200)  # so leaves are dealt to parts as well
    rng, rows = np.random.default_rng(int(scale)), []
    for dims, n in ((2, 25), (3, 700), (8, 500)):
        centres = rng.normal(size=(6, dims)) * scale * 5
        rows += [(len(rows) + i, (centres[rng.integers(6)] + rng.normal(size=dims) * scale * 0.2).tolist()) for i in range(n)]
    found = vptree.nearest(vectors(spark, rows), F.col("vec_id") % 20 == 0, 7, 1.0, shards=30, least_rows=10, most_rows=30).collect()
    for n in (2, 3, 8):
        own = [(i, v) for i, v in rows if len(v) == n]
        expected = brute(own, 7)
        assert {q: [r.vec_id for r in sorted(found, key=lambda r: r["rank"]) if r.query_id == q] for q in expected} == {q: [i for i, _ in x] for q, x in expected.items()}
    assert len(found) == 7 * len({i for i, _ in rows if i % 20 == 0})


def test_shards_that_cannot_hold_anything_nearer_are_not_asked():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(30, 8)) * 5
    points = centres[rng.integers(0, 30, 6000)] + rng.normal(size=(6000, 8)) * 0.1
    longest = float(np.linalg.norm(points, axis=1).max())
    space = vptree.Space.build(longest, vptree.lifted(points, longest), 60)
    shard = space.route(vptree.lifted(points, longest), np.arange(6000, dtype=np.uint64))
    assert space.leaves >= 40 and np.bincount(shard).max() < 400
    asked = pairs = 0
    for q in range(0, 6000, 200):
        scores = points @ points[q]
        bar = np.sort(np.delete(scores, q))[-10]
        open_ = {leaf for _, leaf in space.visits(vptree.flat(points[q : q + 1]), vptree.reach_of(points[q : q + 1], longest, np.array([bar])), 1.0)}
        assert set(shard[scores >= bar].tolist()) <= open_
        asked, pairs = asked + len(open_), pairs + space.leaves
    assert asked < 0.8 * pairs


def test_few_or_no_vectors(spark):
    few = vptree.nearest(vectors(spark, [(0, [1, 0]), (1, [0, 1]), (1, [0, 1]), (2, [1, 1, 1])]), F.col("vec_id") % 20 == 0)
    assert [tuple(r) for r in few.collect()] == [(0, 1, 1, 0.0)]
    assert vptree.nearest(vectors(spark, []), F.col("vec_id") % 20 == 0).count() == 0
    assert vptree.nearest(vectors(spark, [(1, [1.0])]), F.col("vec_id") % 20 == 0).count() == 0


# --- archives

PAGES = [
    (5, "http://a/ b\r\nx", "é" * 60),
    (3, "u", "é" * 60),
    (9, None, "é" * 60),
    (7, "u", "short"),
    (8, "u", "short"),
    (10, "u", None),
    (11, "u", ""),
    (12, "u", "x" * 99),
    (13, "u", "x" * 99),
    (14, "u", "y" * 100),
    (15, "u", "y" * 100),
    (16, "u", "big " * 100_000),
    (17, "u", "line\r\n\r\nWARC/1.1\r\n\r\n" * 20),
    (17, "u", "line\r\n\r\nWARC/1.1\r\n\r\n" * 20),
    (None, "u", "z" * 200),
    (None, "u", "y" * 100),
]


def pages(spark, rows=PAGES):
    return spark.createDataFrame([(*r, "old") for r in rows], "page_id long, url string, html string, payload string").repartition(3)


def expected_records(rows):
    first = {}
    for page_id, _, html in rows:
        body = (html or "").encode()
        if len(body) >= 100 and page_id is not None:
            first[body] = min(first.get(body, page_id), page_id)
    found = Counter()
    for page_id, _, html in rows:
        body = (html or "").encode()
        origin = first.get(body, page_id)
        kind = ("response", None) if origin == page_id else ("revisit", origin)
        found[page_id, len(body), hashlib.sha256(body).hexdigest(), *kind] += 1
    return found


def test_round_trip(spark, tmp_path):
    index = warc.write_archive(pages(spark), str(tmp_path / "a"), frame_bytes=1000, bundle_bytes=3000)
    found = warc.read_archive(spark, str(tmp_path / "a"), index).collect()
    assert Counter(tuple(r)[:5] for r in found) == expected_records(PAGES)
    for r in found:
        assert (r.payload is None) == (r.record_type == "revisit")
        assert r.payload is None or len(r.payload) == r.payload_bytes
    assert index.select("bundle").distinct().count() > 3


def test_bundles_are_seekable_and_plain_zstandard(spark, tmp_path):
    index = warc.write_archive(pages(spark), str(tmp_path / "a"), frame_bytes=500).collect()
    for name in {r.bundle for r in index}:
        content = (tmp_path / "a" / name).read_bytes()
        frames = warc.seek_table(content)
        plain = [zstandard.ZstdDecompressor().decompress(content[a : a + n]) for a, n in frames]
        whole = zstandard.ZstdDecompressor().stream_reader(content, read_across_frames=True).read()
        assert whole == b"".join(plain)
        assert struct.unpack("<I", content[frames[-1][0] + frames[-1][1] :][:4])[0] == warc.SKIPPABLE
        for r in (r for r in index if r.bundle == name):
            assert (r.frame_start, r.frame_length) == frames[r.frame]
            assert warc.decode(plain[r.frame][r.start : r.start + r.length])[0] == r.page_id


def test_single_records_are_found_and_orphans_ignored(spark, tmp_path):
    folder = str(tmp_path / "a")
    index = warc.write_archive(pages(spark), folder)
    warc.write_archive(pages(spark), folder)  # as a task that ran twice would leave it
    assert [r.page_id for r in warc.read_archive(spark, folder, index.where("page_id = 16")).collect()] == [16]
    assert warc.read_archive(spark, folder, index).count() == len(PAGES)


class Counting(io.BytesIO):
    count = 0

    def read(self, n=-1):
        found = super().read(n)
        self.count += len(found)
        return found


def test_one_record_takes_its_frame_and_the_table_only(spark, tmp_path):
    rng = random.Random(4)
    rows = [(i, f"u{i}", "".join(rng.choice("abcdefgh ") for _ in range(900))) for i in range(300)] + [(300, "long", "<p>" + "é x" * 700_000)]
    given = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    index = warc.write_archive(given, str(tmp_path / "a"), frame_bytes=4000)
    for r in index.where("page_id IN (0, 7, 150, 299)").collect():
        file = Counting((tmp_path / "a" / r.bundle).read_bytes())
        ((number, plain),) = warc.read_frames(file, [r.frame])
        frames = len(warc.seek_table(file.getvalue()))
        assert number == r.frame and warc.decode(plain[r.start : r.start + r.length])[0] == r.page_id
        assert file.count == r.frame_length + 13 + 8 * frames < len(file.getvalue()) / 10
    found = warc.read_archive(spark, str(tmp_path / "a"), index)
    assert {(r.page_id, r.payload.decode()) for r in found.collect()} == {(i, h) for i, _, h in rows}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "binaryFile" not in plan and "Join" not in plan and "content" not in plan


def test_damage_is_noticed():
    record = warc.encode(1, "u", b"payload", hashlib.sha256(b"payload").hexdigest(), None)
    assert warc.decode(record)[-1] == b"payload"
    for bad in (record[:-1], record.replace(b"payload", b"qayload")):
        with pytest.raises(ValueError):
            warc.decode(bad)
    with pytest.raises(ValueError):
        warc.seek_table(b"x" * 20)


def test_no_pages(spark, tmp_path):
    index = warc.write_archive(pages(spark).limit(0), str(tmp_path / "a"))
    assert index.count() == 0 == warc.read_archive(spark, str(tmp_path / "a"), index).count()


# --- pipeline and registration


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What every stage is given and what it keeps."""
    folder, docs, found = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{SMALL}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SMALL).write.parquet(str(folder / name))
        kept = spark.read.parquet(str(folder / name))
        found.append((name, docs, kept))
        docs = kept
    return found


def test_stages_keep_the_columns_of_documents(stages):
    assert [n for n, _, _ in stages] == ["toxicity", "near_dedup", "decontamination", "mixing", "sharding"]
    for _, before, after in stages[:-1]:
        assert after.columns == before.columns
    assert stages[-1][2].columns == [*stages[-1][1].columns, "shard", "slot"]


def ids(frame):
    return Counter(r.doc_id for r in frame.select("doc_id").collect())


def test_stages_drop_what_a_plain_run_drops(spark, stages):
    _, before, after = stages[0]
    model = toxicity.train(before, spark.read.parquet(f"{SMALL}/labels.parquet"))
    assert ids(after) == Counter(r.doc_id for r in before.collect() if model.score(r.text) < 0.5)
    _, before, after = stages[1]
    rows = before.collect()
    prints = [simhash.fingerprint(None if r.text is None else r.text.encode()) for r in rows]
    root = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if ((prints[a] ^ prints[b]) % (1 << 64)).bit_count() <= 2 and root[a] != root[b]:
                root = [root[b] if x == root[a] else x for x in root]
    least = {}
    for r, x in zip(rows, root):
        least[x] = min(least.get(x, r.doc_id), r.doc_id)
    assert ids(after) == Counter(least.values())
    _, before, after = stages[2]
    index = decontamination.Index.build([tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()])
    assert ids(after) == Counter(r.doc_id for r in before.collect() if not index.hits(r.text))
    for _, before, after in stages[3:]:
        assert ids(before) == ids(after)


ODD = (
    "id", "hash", "key", "tie", "size", "range", "rows", "bytes", "place", "block", "stream", "copy", "row", "c0", "c1", "fp", "score", "toxic", "mark",
    "__id", "__hash", "__key", "__tie", "__size", "__range", "__rows", "__bytes", "__file", "__row", "__0", "component_id", "text_hash", "a.b", "file_name",
)


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_leave_columns_of_any_name_alone(spark, stages, tmp_path, name):
    _, before, after = next(s for s in stages if s[0] == name)
    spark.read.parquet(*before.inputFiles()).withColumns({n: F.lit(i) for i, n in enumerate(ODD)}).write.parquet(str(tmp_path / "d"))
    odd = spark.read.parquet(str(tmp_path / "d"))
    found = dict(corpus_pipeline.STAGES)[name](spark, odd, SMALL)
    assert found.columns == odd.columns + (["shard", "slot"] if name == "sharding" else [])
    rows = found.collect()
    assert ids(found.select("doc_id")) == ids(after) and {tuple(r[n] for n in ODD) for r in rows} == {tuple(range(len(ODD)))}


def test_shards_follow_the_stored_mixture(stages):
    _, mixed, placed = stages[-1]
    stored = [r.doc_id for r in mixed.orderBy("_metadata.file_name", "_metadata.row_index").select("doc_id").collect()]
    cut = [r.doc_id for r in placed.orderBy("shard", "slot").select("doc_id").collect()]
    assert stored == cut


def test_run_is_the_stages_in_a_row(spark, stages):
    found = corpus_pipeline.run(spark, SMALL)
    assert Counter(map(tuple, found.select("doc_id", "shard").collect())) == Counter(map(tuple, stages[-1][2].select("doc_id", "shard").collect()))
    assert corpus_pipeline.ORACLE_SQL is None


def test_all_operators_are_registered():
    names = registered.queries()
    assert "pipeline" in names and all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 11))


@pytest.mark.parametrize("name, columns", [
    ("op1_sharding", "doc_id size text_crc32 law shard slot grown_shard"),
    ("op3_mixing", "doc_id source stream block place slot"),
    ("op4_toxicity", "doc_id held_out score predicted"),
    ("op5_simhash", "doc_id fingerprint component_id"),
    ("op8_langid", "doc_id held_out lang_pred score rejected"),
    ("op9_vptree", "query_id rank vec_id score"),
    ("op10_warc", "page_id payload_bytes payload_digest record_type refers_to"),
])
def test_results_have_the_agreed_columns(spark, name, columns):
    found = registered.queries()[name](spark, SMALL)
    assert found.columns == columns.split() and found.count() > 0


@pytest.mark.parametrize("name", ["op1_sharding", "op3_mixing"])
def test_native_operators_plan_no_python(spark, name):
    plan = registered.queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not [word for word in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop") if word in plan]
