"""Queries about versions, levels, sketches, links and streams of tables. Each with its SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rentledger.operators.closure import reachable
from rentledger.operators.levels import Measure, cube, rollup
from rentledger.operators.merge import MergeResult, apply_log, compose_logs, merge
from rentledger.operators.multiset import except_all, intersect_all, table_difference
from rentledger.operators.sketches import DISTINCT_BOUND, RANK_BOUND, daily_sketches, exact_range, sketched_range
from rentledger.plans.workload import money, shown
from rentledger.sources.shared import durable, shared_dir
from rentledger.sources.shredded import discover, path_column, shred, unshred
from rentledger.sources.tables import bind, load
from rentledger.streaming.loads import file_stream, insert_stream, loaded, totals, totals_stream

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        ORACLES[function.__name__] = sql
        return function

    return register


# --- merge ---------------------------------------------------------------------------


def accounts(spark: SparkSession, folder: str) -> DataFrame:
    return bind(load(spark, folder, "customer"), account_id="c_custkey", holder="c_name", segment="c_mktsegment", balance=money("c_acctbal"))


def statements(spark: SparkSession, folder: str) -> DataFrame:
    """Every third account with a new balance, every 21st closed, and new accounts for those of nation 0."""
    old = load(spark, folder, "customer")
    segment = F.when(F.col("c_custkey") % 21 == 0, "CLOSED").otherwise(F.col("c_mktsegment"))
    balance = F.when(F.col("c_custkey") % 2 == 0, money("c_acctbal")).otherwise(money("c_acctbal") + 10)
    known = bind(old.where("c_custkey % 3 = 0"), account_id="c_custkey", holder="c_name", segment=segment, balance=balance.cast("decimal(18,2)"))
    opened = bind(old.where("c_nationkey = 0"), account_id=-F.col("c_custkey") - 1, holder="c_name", segment=F.lit("NEW"), balance=F.lit(0).cast("decimal(18,2)"))
    return known.unionByName(opened)


def merged_accounts(spark: SparkSession, folder: str) -> MergeResult:
    closed = F.col("s.segment") == "CLOSED"
    return merge(accounts(spark, folder), statements(spark, folder), ["account_id"], update={"balance": "s.balance"}, delete_if=closed)


BALANCE = "CAST(c_acctbal AS DECIMAL(18,2))"
MERGED = f"""
    SELECT c_custkey AS account_id, c_name AS holder, c_mktsegment AS segment,
           CASE WHEN c_custkey % 3 = 0 AND c_custkey % 2 <> 0 THEN {BALANCE} + 10 ELSE {BALANCE} END AS balance
    FROM customer WHERE c_custkey % 21 <> 0
    UNION ALL SELECT -c_custkey - 1, c_name, 'NEW', 0 FROM customer WHERE c_nationkey = 0
"""


@query(f"SELECT account_id, holder, segment, CAST(balance AS DOUBLE) AS balance FROM ({MERGED})")
def merge_accounts(spark: SparkSession, folder: str) -> DataFrame:
    """Accounts after their statements were merged in: updated, closed and new ones."""
    return shown(merged_accounts(spark, folder).table, "balance")


@query(f"""
    SELECT 'D' AS op, c_custkey AS account_id, CAST({BALANCE} AS DOUBLE) AS balance_before, CAST(NULL AS DOUBLE) AS balance_after
    FROM customer WHERE c_custkey % 21 = 0
    UNION ALL SELECT 'U', c_custkey, CAST({BALANCE} AS DOUBLE), CAST({BALANCE} + 10 AS DOUBLE)
    FROM customer WHERE c_custkey % 3 = 0 AND c_custkey % 21 <> 0 AND c_custkey % 2 <> 0
    UNION ALL SELECT 'I', -c_custkey - 1, NULL, 0 FROM customer WHERE c_nationkey = 0
""")
def merge_log(spark: SparkSession, folder: str) -> DataFrame:
    """What the merge changed; statements that say nothing new are not in it."""
    log = merged_accounts(spark, folder).log
    return log.select("op", "account_id", F.col("before.balance").cast("double").alias("balance_before"), F.col("after.balance").cast("double").alias("balance_after"))


@query(f"""
    SELECT account_id, holder, segment, CAST(balance + 1 AS DOUBLE) AS balance FROM ({MERGED}) WHERE account_id >= 0 AND account_id % 2 = 0
    UNION ALL SELECT account_id, holder, segment, CAST(balance AS DOUBLE) FROM ({MERGED}) WHERE account_id >= 0 AND account_id % 2 <> 0
""")
def replayed_log(spark: SparkSession, folder: str) -> DataFrame:
    """The log of two merges, composed to one, applied to the accounts as they were: new ones are gone again, every other got interest."""
    first = merged_accounts(spark, folder)
    kept = durable(first.table)
    interest = kept.where("account_id >= 0").select("account_id", F.when(F.col("account_id") % 2 == 0, F.col("balance") + 1).otherwise(F.col("balance")).alias("balance"))
    second = merge(kept, interest, ["account_id"], update={"balance": "s.balance"}, insert=False, delete_unmatched=True)
    log = compose_logs(first.log, second.log, ["account_id"])
    return shown(apply_log(accounts(spark, folder), log, ["account_id"]), "balance")


# --- differences ----------------------------------------------------------------------

_HALVES = """
    WITH a AS (SELECT l_suppkey, l_returnflag, l_linestatus FROM lineitem WHERE l_orderkey % 2 = 0),
         b AS (SELECT l_suppkey, l_returnflag, l_linestatus FROM lineitem WHERE l_orderkey % 2 = 1)
"""


def halves(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    line = load(spark, folder, "lineitem")
    return tuple(line.where(f"l_orderkey % 2 = {i}").select("l_suppkey", "l_returnflag", "l_linestatus") for i in (0, 1))


@query(f"""{_HALVES}
    SELECT l_suppkey, l_returnflag, l_linestatus, CAST(sum(n) AS BIGINT) AS surplus
    FROM (SELECT *, 1 AS n FROM a UNION ALL SELECT *, -1 FROM b) GROUP BY ALL HAVING sum(n) <> 0
""")
def line_difference(spark: SparkSession, folder: str) -> DataFrame:
    """Kinds of lines that even or odd orders have more often, and how much more."""
    return table_difference(*halves(spark, folder))


@query(f"{_HALVES} SELECT * FROM a EXCEPT ALL SELECT * FROM b")
def lines_except(spark: SparkSession, folder: str) -> DataFrame:
    return except_all(*halves(spark, folder))


@query(f"{_HALVES} SELECT * FROM a INTERSECT ALL SELECT * FROM b")
def lines_in_both(spark: SparkSession, folder: str) -> DataFrame:
    return intersect_all(*halves(spark, folder))


# --- levels -----------------------------------------------------------------------------

_PRICE = "CAST(l_extendedprice AS DECIMAL(18,2))"


@query(f"""
    SELECT l_returnflag, l_linestatus, CAST(year(l_shipdate) AS INTEGER) AS year,
           CAST(GROUPING_ID(l_returnflag, l_linestatus, year(l_shipdate)) AS BIGINT) AS level, CAST(sum({_PRICE}) AS DOUBLE) AS revenue,
           count(*) AS n_lines, count(DISTINCT l_suppkey) AS n_suppliers, avg(l_quantity) AS mean_quantity, max(l_discount) AS largest_discount
    FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus, year(l_shipdate)) HAVING count(*) > 50 AND sum({_PRICE}) > 1000
""")
def revenue_cube(spark: SparkSession, folder: str) -> DataFrame:
    """Revenue by flag, status and year in all combinations, groups of more than 50 lines."""
    dims = {"l_returnflag": "l_returnflag", "l_linestatus": "l_linestatus", "year": F.year("l_shipdate")}
    measures = {
        "revenue": Measure("sum", money("l_extendedprice")),
        "n_lines": Measure("count"),
        "n_suppliers": Measure("distinct", "l_suppkey"),
        "mean_quantity": Measure("avg", "l_quantity"),
        "largest_discount": Measure("max", "l_discount"),
    }
    found = cube(load(spark, folder, "lineitem"), dims, measures, (F.col("n_lines") > 50) & (F.col("revenue") > 1000))
    return shown(found, "revenue")


@query(f"""
    SELECT o_orderstatus AS status, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
           CAST(GROUPING_ID(o_orderstatus, year(o_orderdate), month(o_orderdate)) AS BIGINT) AS level,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue, count(DISTINCT o_custkey) AS n_customers,
           count(DISTINCT o_orderpriority) AS n_priorities
    FROM orders GROUP BY ROLLUP (o_orderstatus, year(o_orderdate), month(o_orderdate))
""")
def revenue_rollup(spark: SparkSession, folder: str) -> DataFrame:
    """Revenue by status, year and month, with subtotals and the total."""
    dims = {"status": "o_orderstatus", "year": F.year("o_orderdate"), "month": F.month("o_orderdate")}
    measures = {
        "revenue": Measure("sum", money("o_totalprice")),
        "n_customers": Measure("distinct", "o_custkey"),
        "n_priorities": Measure("distinct", "o_orderpriority"),
    }
    return shown(rollup(load(spark, folder, "orders"), dims, measures), "revenue")


# --- sketches ---------------------------------------------------------------------------

RANGES = [("week", "1996-03-01", "1996-03-07"), ("quarter", "1997-01-01", "1997-03-31"), ("years", "1996-01-01", "1999-12-31"), ("none", "1970-01-01", "1970-01-02")]


@query(
    "WITH r(range_name, since, until) AS (VALUES "
    + ", ".join(f"('{n}', DATE '{a}', DATE '{b}')" for n, a, b in RANGES)
    + """)
    SELECT range_name, count(o_orderkey) AS n_rows, coalesce(CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE), 0) AS total,
           count(DISTINCT o_custkey) AS exact_customers, true AS customers_within, true AS p95_within
    FROM r LEFT JOIN orders ON CAST(o_orderdate AS DATE) BETWEEN since AND until GROUP BY range_name
"""
)
def sketched_ranges(spark: SparkSession, folder: str) -> DataFrame:
    """Customers and the 95th percentile of order values in ranges of days, from stored daily sketches, and whether they keep their bounds."""
    order = load(spark, folder, "orders").withColumn("amount", money("o_totalprice"))
    daily = durable(daily_sketches(order, "o_orderdate", "o_custkey", "amount"))
    ranges = spark.createDataFrame(RANGES, "range_name string, since string, until string").select("range_name", *(F.col(c).cast("date").alias(c) for c in ("since", "until")))
    near = sketched_range(daily, ranges)
    exact = exact_range(order, ranges, "o_orderdate", "o_custkey", "amount", near)
    both = near.join(exact, "range_name", "left")
    exact_customers = F.coalesce("exact_distinct", F.lit(0))
    return both.select(
        "range_name",
        "n_rows",
        F.coalesce(F.col("total").cast("double"), F.lit(0.0)).alias("total"),
        exact_customers.alias("exact_customers"),
        (F.abs(F.col("n_distinct") - exact_customers) <= DISTINCT_BOUND * exact_customers).alias("customers_within"),
        F.coalesce((F.col("share_up_to") >= 0.95 - RANK_BOUND) & (F.col("share_below") <= 0.95 + RANK_BOUND), F.col("n_rows") == 0).alias("p95_within"),
    )


# --- links ------------------------------------------------------------------------------

_LINKS = """
    SELECT DISTINCT a.l_partkey AS source, b.l_partkey AS target
    FROM lineitem AS a JOIN lineitem AS b ON a.l_orderkey = b.l_orderkey AND b.l_linenumber = a.l_linenumber + 1
    WHERE a.l_returnflag = 'R' AND a.l_linestatus = 'F' AND b.l_returnflag = 'A' AND a.l_partkey % 2 = 0
"""


@query(f"""
    WITH RECURSIVE links AS ({_LINKS}),
    reach(seed, node) AS (
        SELECT p_partkey, target FROM part JOIN links ON source = p_partkey WHERE p_size <= 2
        UNION SELECT seed, target FROM reach JOIN links ON node = source
    )
    SELECT seed, node FROM reach
""")
def parts_reached(spark: SparkSession, folder: str) -> DataFrame:
    """Parts that small parts lead to, over parts that were ordered right after one another."""
    line = load(spark, folder, "lineitem")
    first = line.where("l_returnflag = 'R' AND l_linestatus = 'F' AND l_partkey % 2 = 0").select("l_orderkey", (F.col("l_linenumber") + 1).alias("l_linenumber"), F.col("l_partkey").alias("source"))
    second = line.where("l_returnflag = 'A'").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("target"))
    links = first.join(second, ["l_orderkey", "l_linenumber"]).select("source", "target")
    seeds = load(spark, folder, "part").where("p_size <= 2").select(F.col("p_partkey").alias("seed"))
    return reachable(links, seeds).select("seed", "node")


# --- streams ----------------------------------------------------------------------------


def order_files(spark: SparkSession, folder: str) -> tuple[str, DataFrame]:
    """A folder of files of orders in no order of time, each read as a micro-batch, and the stream of it."""
    place = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    order = load(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_totalprice")
    order.repartition(3, F.col("o_orderkey") % 7).write.parquet(f"{place}/files")
    return place, file_stream(spark, f"{place}/files", order.schema, 1)


@query("""
    SELECT o_custkey, o_orderstatus, min(o_orderkey) AS o_orderkey FROM orders GROUP BY o_custkey, o_orderstatus
""")
def streamed_first_orders(spark: SparkSession, folder: str) -> DataFrame:
    """The first order of each customer and status, loaded from a stream of files in which later ones may come first."""
    place, stream = order_files(spark, folder)
    on = ["o_custkey", "o_orderstatus"]
    insert_stream(stream, f"{place}/table", f"{place}/progress", on, ["o_orderkey"]).awaitTermination()
    return loaded(spark, f"{place}/table", stream.schema, on).select(*on, "o_orderkey")


@query("""
    SELECT CAST(o_orderdate AS DATE) AS day, o_orderstatus, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total, count(*) AS n_rows,
           CAST(o_orderdate AS DATE) + 1 <= (SELECT max(o_orderdate) - INTERVAL 4000 DAY FROM orders) AS complete
    FROM orders GROUP BY CAST(o_orderdate AS DATE), o_orderstatus
""")
def streamed_daily_revenue(spark: SparkSession, folder: str) -> DataFrame:
    """Daily revenue from a stream, each order counted once."""
    place, stream = order_files(spark, folder)
    priced = stream.withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp")).withColumn("amount", money("o_totalprice"))
    delay = "4000 days"  # orders of all years come in any order
    totals_stream(priced, f"{place}/table", f"{place}/progress", "o_orderdate", ["o_orderstatus"], "amount", ["o_orderkey"], delay).awaitTermination()
    shape = "day date, o_orderstatus string, total decimal(28,2), n_rows long, latest timestamp"
    schema = spark.createDataFrame([], shape).schema
    return shown(totals(spark, f"{place}/table", schema, ["o_orderstatus"], delay), "total")


# --- semi-structured columns --------------------------------------------------------------


@query("""
    SELECT event_type, count(*) AS n_events, min(CAST(json_extract(props, '$.k') AS BIGINT)) AS least, sum(value) AS total
    FROM events WHERE CAST(json_extract(props, '$.k') AS BIGINT) >= 50 GROUP BY event_type
""")
def event_properties(spark: SparkSession, folder: str) -> DataFrame:
    """Events by a property that is found in their JSON and stored as a column of its own."""
    events = load(spark, folder, "events").select("event_type", "value", "props")
    layout = discover(events, "props")
    stored = durable(shred(events, layout))
    k = path_column(layout, "k")
    return stored.where(k >= 50).groupBy("event_type").agg(F.count(F.lit(1)).alias("n_events"), F.min(k).alias("least"), F.round(F.sum("value"), 6).alias("total"))


@query("""
    SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'none' ELSE CAST(o_custkey AS VARCHAR) END AS customer, o_orderpriority AS priority,
           o_orderkey % 3 = 0 AS rare
    FROM orders
""")
def order_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as JSON with a key of two types and a rare key, taken apart to columns, stored, put together and read again."""
    c = F.col
    customer = F.when(c("o_orderkey") % 5 == 0, F.lit("\"none\"")).otherwise(c("o_custkey").cast("string"))
    extra = F.when(c("o_orderkey") % 3 == 0, F.concat(F.lit(", \"rare"), c("o_orderkey").cast("string"), F.lit("\": [1, {\"x\": null}]"))).otherwise("")
    text = F.concat(F.lit("{\"who\": {\"customer\": "), customer, F.lit("}, \"priority\": \""), c("o_orderpriority"), F.lit("\""), extra, F.lit("}"))
    made = load(spark, folder, "orders").select("o_orderkey", text.alias("document"))
    layout = discover(made, "document")
    back = unshred(durable(shred(made, layout)), layout).withColumn("v", F.parse_json("document"))
    rare = F.contains("document", F.lit("[1,{\"x\":null}]"))
    return back.select("o_orderkey", F.variant_get("v", "$.who.customer", "string").alias("customer"), F.variant_get("v", "$.priority", "string").alias("priority"), rare.alias("rare"))
