from __future__ import annotations

from pyspark.sql import functions as F

from rentledger.functions import asc, desc
from rentledger.operators import aggregates as ag
from rentledger.operators.ordering import first_by, order, top_k
from tests.fixtures import bag, values


def test_latest_per_key_breaks_ties_and_skips_null_order(spark):
    t = spark.createDataFrame(
        [("a", 1, 1, "x"), ("a", 2, 5, "y"), ("a", 2, 6, "z"), ("a", None, 9, "n"), ("b", None, 1, "n"), ("c", 3, 1, None)],
        "k STRING, d INT, id INT, v STRING",
    )
    assert bag(ag.latest_per_key(t, ["k"], ["d", "id"], ["id", "v"])) == [("a", 6, "z"), ("c", 1, None)]


def test_count_by_value_keeps_zero_groups_and_null(spark):
    t = spark.createDataFrame([(1, "p"), (1, "q"), (2, "q"), (3, None), (None, "p")], "y INT, c STRING")
    got = ag.count_by_value(t, ["y"], "c", {"n_p": "p", "n_z": "z"})
    assert bag(got) == [(1, 1, 0), (2, 0, 0), (3, 0, 0), (None, 1, 0)]


def test_sums_and_counts(spark):
    t = spark.createDataFrame([("a", 1), ("a", 1), ("a", None), ("b", None)], "k STRING, n INT")
    got = t.groupBy("k").agg(
        F.sum("n").alias("s"), ag.zero_sum(F.col("n")).alias("z"), F.count("n").alias("c"), F.count(F.lit(1)).alias("r")
    )
    assert bag(got) == [("a", 2, 2, 2, 3), ("b", None, 0, 0, 1)]
    assert bag(ag.distinct_count(t, ["k"], "n", "d")) == [("a", 1), ("b", 0)]


def test_eligible_counts_each_fact_on_its_own(shop):
    facts = [(shop["rental"], "customer_id", 43), (shop["payment"], "customer_id", 43)]
    assert values(ag.eligible(shop["customer"].select("customer_id"), "customer_id", facts)) == [(2,)]


def test_count_report(spark, shop):
    report = ag.count_report({"store": shop["store"], "none": shop["store"].limit(0)})
    assert bag(report) == [("none", 0), ("store", 3)]


def test_order_and_top_k(spark):
    t = spark.createDataFrame([(1, "b", 5), (2, "a", 5), (3, "a", None), (4, "a", 5)], "id INT, n STRING, x INT")
    assert [r[0] for r in values(order(t, [desc("x"), asc("n")], ["id"]))] == [3, 2, 4, 1]
    assert [r[0] for r in values(top_k(t, [desc("x"), asc("n")], 2, ["id"]))] == [3, 2]
    assert [r[0] for r in values(first_by(t, "id"))] == [1]


def test_top_k_keeps_k_rows_per_task(spark):
    plan = top_k(spark.range(1000), [desc("id")], 5, [])._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_full_ties_give_one_answer_whatever_the_order_of_rows(spark):
    from rentledger.operators.aggregates import latest_per_key

    rows = [("a", 5, f"v{i}") for i in range(50)]
    found = {
        tuple(latest_per_key(spark.createDataFrame(rows[i:] + rows[:i], "k string, o int, v string").repartition(i + 1), ["k"], ["o"], ["v"]).first())
        for i in range(5)
    }
    assert found == {("a", "v9")}
