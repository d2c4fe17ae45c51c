from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from rentledger.plans.recipes import bulk_lifecycle
from rentledger.sources import shared
from rentledger.sources import tables as tb
from tests.fixtures import bag, values


def test_rows_and_bind(spark):
    t = tb.rows(spark, [(1, ["a", "b"]), (2, None)], "id INT, tags ARRAY<STRING>")
    assert bag(tb.bind(t, n=F.col("id") + 1, words="tags")) == [(2, ["a", "b"]), (3, None)]


def test_sequence_table(spark):
    assert values(tb.sequence_table(spark, 3, "p")) == [("p1",), ("p2",), ("p3",)]
    assert values(tb.row_count(tb.sequence_table(spark, 0, "p"))) == [(0,)]


def test_create_as(spark, tmp_path):
    path = str(tmp_path / "t")
    made = tb.create_as(spark.range(5), path)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        tb.create_as(spark.range(3), path)
    assert made.count() == 5
    assert tb.create_as(spark.range(3), path, replace=True).count() == 3


def test_truncate_keeps_columns_and_scans_nothing(spark, tmp_path):
    made = tb.create_as(spark.range(5), str(tmp_path / "t"))
    empty = tb.truncate(made)
    assert (empty.columns, empty.count()) == (["id"], 0)
    assert "FileScan" not in empty._jdf.queryExecution().optimizedPlan().toString()
    assert tb.create_as(empty, str(tmp_path / "e")).count() == 0


def test_append(spark):
    t = spark.createDataFrame([(1, "a", 1.5)], "id BIGINT, k STRING, x DOUBLE")
    added = spark.createDataFrame([("b", 2)], "k STRING, id INT")
    assert bag(tb.append(t, added, {"x": 0.5})) == [(1, "a", 1.5), (2, "b", 0.5)]


def test_append_to(spark, tmp_path):
    path = str(tmp_path / "t")
    tb.create_as(spark.range(2), path)
    tb.append_to(path, spark.range(5))
    assert spark.read.parquet(path).count() == 7


def test_table_size(spark, tmp_path):
    path = tmp_path / "t"
    tb.create_as(spark.range(0, 100, 1, 3), str(path))
    files = [f for f in path.iterdir() if f.suffix == ".parquet"]
    size = sum(f.stat().st_size for f in files)
    got = tb.table_size(spark, str(path), "t")
    assert values(got) == [("t", len(files), size, f"{size} bytes")]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan


def test_save_all(spark, tmp_path):
    folder = str(tmp_path / "v2")
    tb.save_all({"a": spark.range(2), "b": spark.range(3)}, folder)
    assert tb.load(spark, folder, "b").count() == 3
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        tb.save_all({"a": spark.range(2)}, folder)


@pytest.mark.parametrize("n", [0, 1, 3, 1000])
def test_bulk_lifecycle(spark, tmp_path, n):
    report = bulk_lifecycle(spark, n, str(tmp_path / "bulk"))
    counts = {r.table_name: r.row_count for r in report.collect()}
    assert counts == {"made": n, "kept": n - n // 3, "emptied": 0}
    assert all(r.total_bytes >= 0 and r.total.endswith("bytes") for r in report.collect())


class Conf:
    def __init__(self, value=None):
        self.value = value

    def get(self, name, default):
        return self.value if name == "spark.checkpoint.dir" and self.value else default


class Cluster:
    master = "yarn"

    def getCheckpointDir(self):
        return None


class Session:
    def __init__(self, value=None):
        self.conf, self.sparkContext = Conf(value), Cluster()


def test_shared_dir_prefers_the_setting():
    assert shared.shared_dir(Session("hdfs://shared/place")) == "hdfs://shared/place"


def test_shared_dir_refuses_a_machine_local_folder_on_a_cluster():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared.shared_dir(Session())


def test_files_of_any_suffix_count(spark, tmp_path):
    from rentledger.sources.tables import table_size

    folder = tmp_path / "mixed"
    folder.mkdir()
    (folder / "part-0.parquet").write_bytes(b"x" * 10)
    (folder / "part-1.orc").write_bytes(b"y" * 7)
    (folder / "_SUCCESS").write_bytes(b"")
    found = table_size(spark, str(folder), "mixed").first()
    assert (found.file_count, found.total_bytes) == (2, 17)


def test_literal_rows_have_a_known_size_and_keep_their_types(spark, tmp_path):
    import decimal

    from rentledger.operators.joins import semi_join
    from rentledger.sources.tables import rows

    ddl = "k BIGINT, d DECIMAL(10,2), a ARRAY<STRING>, n INT"
    seed = rows(spark, [(1, decimal.Decimal("2.50"), ["x", None], None), (2, None, None, 3)], ddl)
    assert [tuple(r) for r in seed.collect()] == [(1, decimal.Decimal("2.50"), ["x", None], None), (2, None, None, 3)]
    assert rows(spark, [], ddl).count() == 0 and rows(spark, [], ddl).schema == seed.schema
    spark.range(10_000).withColumnRenamed("id", "k").write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    plan = semi_join(stored, seed, ["k"], unique="right")._jdf.queryExecution().executedPlan().toString()
    assert "LocalTableScan" in plan and "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_scratch_frees_what_was_stored_in_it(spark, tmp_path):
    from contextvars import copy_context
    from threading import Thread

    from rentledger.sources import durable, scratch

    where = lambda df: df.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    outer = durable(spark.range(3))
    with pytest.raises(ZeroDivisionError), scratch(spark):
        one = durable(spark.range(4))
        with scratch(spark):
            two = durable(one.where("id > 1"))
            two.write.parquet(str(tmp_path / "kept"))
            assert os.path.isdir(where(two))
        assert not os.path.isdir(where(two)) and one.count() == 4
        named = durable(spark.range(2), str(tmp_path))
        threads = []
        worker = Thread(target=copy_context().run, args=(lambda: threads.append(durable(spark.range(5))),))
        worker.start()
        worker.join()
        1 / 0
    assert not os.path.isdir(where(one)) and not os.path.isdir(where(threads[0]))
    assert outer.count() == 3 and named.count() == 2 and spark.read.parquet(str(tmp_path / "kept")).count() == 2
