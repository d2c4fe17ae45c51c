"""Queries along an order: running values, the rate in force, trips in windows, bookings that overlap. Each with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rentledger.operators.intervals import audit_no_overlap, interval_join, overlaps
from rentledger.operators.running import Running, asof_join, moving_sum, ntile, percent_rank, with_running
from rentledger.plans.workload import money, shown
from rentledger.sources.tables import bind, load

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        ORACLES[function.__name__] = sql
        return function

    return register


AMOUNT = "CAST(o_totalprice AS DECIMAL(18,2))"


def payments(spark: SparkSession, folder: str) -> DataFrame:
    return bind(
        load(spark, folder, "orders"),
        payment_id="o_orderkey", customer_id="o_custkey", paid_on="o_orderdate", status="o_orderstatus", amount=money("o_totalprice"),
    )


@query(f"""
    SELECT o_orderkey AS payment_id, CAST(sum({AMOUNT}) OVER upto AS DOUBLE) AS paid_so_far,
           CAST(sum({AMOUNT}) OVER (mine ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS DOUBLE) AS paid_before,
           CAST(max({AMOUNT}) OVER upto AS DOUBLE) AS largest, row_number() OVER mine AS payment_no
    FROM orders
    WINDOW mine AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey),
           upto AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
""")
def running_customer_revenue(spark: SparkSession, folder: str) -> DataFrame:
    """What every customer had paid with and before each payment, and the largest payment until then."""
    values = {
        "paid_so_far": Running("sum", "amount"),
        "paid_before": Running("sum", "amount", before=True),
        "largest": Running("max", "amount"),
        "payment_no": Running("row_number"),
    }
    found = with_running(payments(spark, folder), values, ["paid_on"], ["customer_id"], ties=["payment_id"])
    return shown(found.select("payment_id", *values), "paid_so_far", "paid_before", "largest")


@query(f"""
    SELECT o_orderkey AS payment_id, CAST(sum({AMOUNT}) OVER days AS DOUBLE) AS revenue_to_date,
           rank() OVER days AS day_rank, dense_rank() OVER days AS day_no
    FROM orders WINDOW days AS (ORDER BY o_orderdate)
""")
def running_revenue(spark: SparkSession, folder: str) -> DataFrame:
    """Revenue of the whole table up to and with each payment's day, and the number of that day."""
    values = {"revenue_to_date": Running("total", "amount"), "day_rank": Running("rank"), "day_no": Running("dense_rank")}
    found = with_running(payments(spark, folder), values, ["paid_on"])
    return shown(found.select("payment_id", *values), "revenue_to_date")


@query(f"""
    SELECT o_orderkey AS payment_id, CAST(sum({AMOUNT}) OVER days AS DOUBLE) AS revenue_to_date, rank() OVER days AS place,
           dense_rank() OVER days AS day_no,
           count(*) OVER (PARTITION BY o_orderstatus ORDER BY o_orderdate DESC, o_orderkey ROWS UNBOUNDED PRECEDING) AS n_so_far
    FROM orders WINDOW days AS (PARTITION BY o_orderstatus ORDER BY o_orderdate DESC)
""")
def running_status_revenue(spark: SparkSession, folder: str) -> DataFrame:
    """As `running_revenue`, backwards and per status: each of few keys holds a large part of the rows."""
    values = {
        "revenue_to_date": Running("total", "amount"),
        "place": Running("rank"),
        "day_no": Running("dense_rank"),
        "n_so_far": Running("count"),
    }
    found = with_running(payments(spark, folder), values, ["paid_on"], ["status"], ties=["payment_id"], descending=True)
    return shown(found.select("payment_id", *values), "revenue_to_date")


@query(f"""
    SELECT o_orderkey AS payment_id, rank() OVER amounts AS place, dense_rank() OVER amounts AS amount_no
    FROM orders WINDOW amounts AS (ORDER BY floor({AMOUNT} / 1000) DESC)
""")
def payment_ranks(spark: SparkSession, folder: str) -> DataFrame:
    """Ranks of all payments by whole thousands, the largest first; many are equal."""
    thousands = payments(spark, folder).withColumn("thousands", F.floor(F.col("amount") / 1000))
    found = with_running(thousands, {"place": Running("rank"), "amount_no": Running("dense_rank")}, ["thousands"], descending=True)
    return found.select("payment_id", "place", "amount_no")


@query(f"""
    SELECT o_orderkey AS payment_id, CAST(lag({AMOUNT}) OVER mine AS DOUBLE) AS amount_before, lead(o_orderkey) OVER mine AS next_payment,
           count(*) OVER (PARTITION BY o_custkey) AS n_payments, percent_rank() OVER mine AS share_before, ntile(4) OVER mine AS quarter
    FROM orders WINDOW mine AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)
""")
def payment_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """Each payment's neighbours among those of its customer, and where it stands among them."""
    values = {
        "amount_before": Running("lag", "amount"),
        "next_payment": Running("lead", "payment_id"),
        "n_payments": Running("size"),
        "row": Running("row_number"),
    }
    found = with_running(payments(spark, folder), values, ["paid_on", "payment_id"], ["customer_id"])
    return found.select(
        "payment_id", F.col("amount_before").cast("double").alias("amount_before"), "next_payment", "n_payments",
        percent_rank(F.col("row"), F.col("n_payments")).alias("share_before"), ntile(F.col("row"), F.col("n_payments"), 4).alias("quarter"),
    )


@query(f"""
    SELECT o_orderkey AS payment_id, CAST(sum({AMOUNT}) OVER (ORDER BY o_orderdate RANGE BETWEEN INTERVAL 30 DAY PRECEDING AND CURRENT ROW) AS DOUBLE) AS month_revenue
    FROM orders
""")
def moving_revenue(spark: SparkSession, folder: str) -> DataFrame:
    """Revenue of the 30 days up to each payment, over the whole table."""
    return shown(moving_sum(payments(spark, folder), "month_revenue", "amount", "paid_on", F.expr("INTERVAL 30 DAYS")).select("payment_id", "month_revenue"), "month_revenue")


@query(f"""
    SELECT o_orderkey AS payment_id, CAST(sum({AMOUNT}) OVER (PARTITION BY o_orderstatus ORDER BY o_orderdate RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND CURRENT ROW) AS DOUBLE) AS week_revenue
    FROM orders
""")
def moving_status_revenue(spark: SparkSession, folder: str) -> DataFrame:
    """Revenue of the seven days up to each payment among those of its status."""
    found = moving_sum(payments(spark, folder), "week_revenue", "amount", "paid_on", F.expr("INTERVAL 7 DAYS"), ["status"])
    return shown(found.select("payment_id", "week_revenue"), "week_revenue")


def rates(spark: SparkSession, folder: str) -> DataFrame:
    """Discounts that suppliers set: the first lines of orders."""
    line = load(spark, folder, "lineitem").where("l_linenumber = 1")
    return bind(line, supplier_id="l_suppkey", valid_from="l_shipdate", rate="l_discount", tax="l_tax")


@query("""
    WITH rates AS (
        SELECT l_suppkey, l_shipdate, max(row(l_discount, l_tax)) AS newest FROM lineitem WHERE l_linenumber = 1 GROUP BY ALL
    )
    SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, struct_extract(newest, 1) AS rate, struct_extract(newest, 2) AS tax, r.l_shipdate AS valid_from
    FROM (SELECT * FROM lineitem WHERE l_linenumber > 1) AS l ASOF LEFT JOIN rates AS r
      ON l.l_suppkey = r.l_suppkey AND l.l_shipdate >= r.l_shipdate
""")
def rate_in_force(spark: SparkSession, folder: str) -> DataFrame:
    """For each further line the supplier's latest rate until that day; of several of one day the largest."""
    line = load(spark, folder, "lineitem").where("l_linenumber > 1").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    found = asof_join(line, rates(spark, folder), ("l_shipdate", "valid_from"), {"rate": "rate", "tax": "tax"}, [("l_suppkey", "supplier_id")], matched="valid_from")
    return found.select("l_orderkey", "l_linenumber", "l_partkey", "rate", "tax", F.col("valid_from").cast("timestamp_ntz").alias("valid_from"))


@query("""
    WITH rates AS (SELECT l_shipdate, max(row(l_discount, l_tax)) AS newest FROM lineitem WHERE l_linenumber = 1 GROUP BY ALL)
    SELECT o_orderkey, CASE WHEN o_orderdate - INTERVAL 2 DAY <= l_shipdate THEN struct_extract(newest, 1) END AS rate
    FROM orders ASOF LEFT JOIN rates ON o_orderdate > l_shipdate
""")
def recent_rate(spark: SparkSession, folder: str) -> DataFrame:
    """The last rate that anybody set before each order's day, unless it is older than two days: no key at all."""
    order = load(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    found = asof_join(order, rates(spark, folder), ("o_orderdate", "valid_from"), {"rate": "rate", "tax": "tax"}, exact=False, within=F.expr("INTERVAL 2 DAYS"))
    return found.select("o_orderkey", "rate")


def windows(spark: SparkSession, folder: str) -> DataFrame:
    """Reservation windows of vehicles, from hours to two days."""
    line = load(spark, folder, "lineitem")
    return bind(
        line, reserved_vehicle="l_suppkey", order_no="l_orderkey", line_no="l_linenumber", part_no="l_partkey", reserved_from="l_shipdate",
        reserved_until=F.col("l_shipdate") + F.make_dt_interval(hours=F.col("l_quantity").cast("int")),
    )


def trips(spark: SparkSession, folder: str) -> DataFrame:
    started = F.col("o_orderdate") + F.make_dt_interval(mins=(F.col("o_orderkey") % 1440).cast("int"))
    return bind(
        load(spark, folder, "orders"), trip_id="o_orderkey", vehicle_id="o_custkey", started_at=started,
        ended_at=started + F.make_dt_interval(mins=(F.col("o_orderkey") % 600).cast("int")),
    )


TRIPS = """(SELECT o_orderkey AS trip_id, o_custkey AS vehicle_id, o_orderdate + to_minutes(o_orderkey % 1440) AS started_at,
                   o_orderdate + to_minutes(o_orderkey % 1440 + o_orderkey % 600) AS ended_at FROM orders)"""


@query(f"""
    SELECT trip_id, l_orderkey AS order_no, l_linenumber AS line_no, l_partkey AS part_no
    FROM {TRIPS} JOIN lineitem ON vehicle_id = l_suppkey
     AND started_at >= l_shipdate AND ended_at <= l_shipdate + to_hours(CAST(l_quantity AS INTEGER))
""")
def trips_in_windows(spark: SparkSession, folder: str) -> DataFrame:
    """Trips that lie wholly inside a reservation window of their vehicle."""
    found = interval_join(
        trips(spark, folder), windows(spark, folder), "started_at", ("reserved_from", "reserved_until"), [("vehicle_id", "reserved_vehicle")],
        closed=True, condition=F.col("ended_at") <= F.col("reserved_until"),
    )
    return found.select("trip_id", "order_no", "line_no", "part_no")


@query(f"""
    SELECT l_returnflag, count(*) AS n_pairs, count(DISTINCT trip_id) AS n_trips
    FROM {TRIPS} JOIN lineitem ON started_at >= l_shipdate AND started_at < l_shipdate + to_minutes(CAST(l_quantity AS INTEGER))
    GROUP BY l_returnflag
""")
def trips_while_loading(spark: SparkSession, folder: str) -> DataFrame:
    """Per kind of line, the trips that began within minutes of any line's loading: no key at all, one band of time."""
    loading = load(spark, folder, "lineitem").select(
        "l_returnflag", F.col("l_shipdate").alias("opened"), (F.col("l_shipdate") + F.make_dt_interval(mins=F.col("l_quantity").cast("int"))).alias("closed")
    )
    found = interval_join(trips(spark, folder).select("trip_id", "started_at"), loading, "started_at", ("opened", "closed"))
    return found.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n_pairs"), F.count_distinct("trip_id").alias("n_trips"))


BOOKING = ["order_no", "line_no", "part_no", "price"]


def bookings(spark: SparkSession, folder: str) -> DataFrame:
    """Bookings of minutes; vehicle 0 has a third of them."""
    begin = F.col("l_shipdate") + F.make_dt_interval(mins=(F.col("l_orderkey") * 7 % 1440).cast("int"))
    return bind(
        load(spark, folder, "lineitem"), vehicle_id=F.when(F.col("l_orderkey") % 3 == 0, 0).otherwise(F.col("l_suppkey")), order_no="l_orderkey",
        line_no="l_linenumber", part_no="l_partkey", price="l_extendedprice", booked_from=begin,
        booked_until=begin + F.make_dt_interval(mins=F.col("l_quantity").cast("int")),
    )


BOOKINGS = """(SELECT CASE WHEN l_orderkey % 3 = 0 THEN 0 ELSE l_suppkey END AS vehicle_id, l_orderkey AS order_no, l_linenumber AS line_no,
                      l_partkey AS part_no, l_extendedprice AS price, l_shipdate + to_minutes(l_orderkey * 7 % 1440) AS booked_from,
                      l_shipdate + to_minutes(l_orderkey * 7 % 1440 + CAST(l_quantity AS INTEGER)) AS booked_until FROM lineitem)"""


@query(f"""
    SELECT a.vehicle_id AS vehicle_id, a.order_no AS first_order, a.line_no AS first_line, b.order_no AS second_order, b.line_no AS second_line
    FROM {BOOKINGS} AS a JOIN {BOOKINGS} AS b ON a.vehicle_id = b.vehicle_id AND a.booked_from < b.booked_until AND b.booked_from < a.booked_until
     AND row(a.booked_from, a.order_no, a.line_no, a.part_no, a.price) < row(b.booked_from, b.order_no, b.line_no, b.part_no, b.price)
""")
def double_bookings(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of bookings of one vehicle that overlap."""
    found = overlaps(bookings(spark, folder), "booked_from", "booked_until", ["vehicle_id"], BOOKING)
    return bind(
        found, vehicle_id="first_vehicle_id", first_order="first_order_no", first_line="first_line_no", second_order="second_order_no", second_line="second_line_no"
    )


@query(f"""
    SELECT 'vehicle_booked_once' AS "constraint", count(*) AS n_violations
    FROM (SELECT booked_from, max(booked_until) OVER (PARTITION BY vehicle_id ORDER BY booked_from, order_no, line_no, part_no, price
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS busy_until FROM {BOOKINGS} WHERE booked_from < booked_until)
    WHERE booked_from < busy_until
""")
def audit_double_bookings(spark: SparkSession, folder: str) -> DataFrame:
    """How many bookings begin while an earlier one of their vehicle lasts."""
    return audit_no_overlap(bookings(spark, folder), "vehicle_booked_once", "booked_from", "booked_until", ["vehicle_id"], BOOKING)
