"""The operators, reports and recipes run over the star-schema test tables.

Every entry takes `(spark, folder)` and works on whole tables. The film-rental
and vehicle-sharing names are given to the star tables by `bind`; money is cast
to decimals before it is summed and shown as double.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rentledger.functions import (
    add_days,
    asc,
    desc,
    difference,
    eq_ci,
    eq_ci_null_as_empty,
    in_range,
    instant,
    join_text,
    label,
    member_of,
    number_after,
    on_or_after,
    principal_name,
    size_pretty,
    starred,
    wall_time,
    whole_minutes,
    within,
    years_since,
)
from rentledger.operators.aggregates import count_by_value, count_report, eligible, latest_per_key, zero_sum
from rentledger.operators.audits import (
    audit,
    audit_foreign_key,
    audit_primary_key,
    audit_rows,
    audit_unique,
    check,
    domain,
    fits_decimal,
    max_length,
    not_null,
    orphans,
    repeated_keys,
)
from rentledger.operators.changes import (
    backfill,
    delete_using,
    delete_where,
    evolve,
    insert_chain,
    insert_if_absent,
    insert_rows,
    insert_skip_conflicts,
    pick_target,
    update_from,
    update_where,
)
from rentledger.operators.ids import assign_ids
from rentledger.operators.joins import (
    anti_join,
    eq_scalar,
    exists_in_all,
    left_join_filtered,
    resolve_keys,
    semi_join,
    through,
    with_agg,
    with_one_row,
)
from rentledger.operators.ordering import first_by, order, top_k
from rentledger.operators.policy import first_active, policy_leaks, principal_names, visible_rows
from rentledger.plans import recipes
from rentledger.plans.fleet import SPECS, audit_fleet_table, empty_fleet, load_fleet, named_rows
from rentledger.plans.reports import (
    films_in_category,
    genre_counts_per_year,
    inactivity_gap,
    most_rented,
    revenue_per_store,
    revenue_with_latest,
    top_actors,
    top_staff,
)
from rentledger.sources.shared import shared_dir
from rentledger.sources.tables import append, bind, create_as, load, rows, sequence_table, table_size, truncate

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = dt.date(2002, 1, 1)
SIZE_LABELS = {"SMALL": "Compact", "MEDIUM": "Regular", "LARGE": "Bulky"}
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
PART_TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
PRINCIPAL = "client_MACHINERY_CUSTOMER_000000001"

_QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def money(column: str) -> Column:
    return F.col(column).cast("decimal(18,2)")


def shown(df: DataFrame, *columns: str) -> DataFrame:
    """Exact decimals as double, for output."""
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


# --- star tables under film-rental names ------------------------------------


def films(spark: SparkSession, folder: str) -> DataFrame:
    return bind(
        load(spark, folder, "part"),
        film_id="p_partkey",
        title=join_text(" ", F.col("p_name"), F.col("p_partkey").cast("string")),
        release_year=F.col("p_size") + 1970,
        language_id=F.lit(0),
        rental_duration="p_size",
        rental_rate=money("p_retailprice"),
        rating="p_type",
        last_update=F.lit(dt.date(2001, 1, 1)),
    )


def categories(spark: SparkSession, folder: str) -> DataFrame:
    brands = load(spark, folder, "part").select("p_brand").distinct()
    return bind(brands, category_id=number_after(F.col("p_brand"), "Brand#").cast("int"), name="p_brand")


def film_categories(spark: SparkSession, folder: str) -> DataFrame:
    return bind(
        load(spark, folder, "part"),
        film_id="p_partkey",
        category_id=number_after(F.col("p_brand"), "Brand#").cast("int"),
        last_update=F.lit(dt.date(2001, 1, 1)),
    )


def actors(spark: SparkSession, folder: str) -> DataFrame:
    return bind(
        load(spark, folder, "supplier"),
        actor_id="s_suppkey",
        first_name=F.lit("Supplier"),
        last_name="s_name",
        last_update=F.lit(dt.date(2001, 1, 1)),
    )


def appearances(spark: SparkSession, folder: str) -> DataFrame:
    pairs = load(spark, folder, "lineitem").select("l_suppkey", "l_partkey").distinct()
    return bind(pairs, actor_id="l_suppkey", film_id="l_partkey", last_update=F.lit(dt.date(2001, 1, 1)))


def stores(spark: SparkSession, folder: str) -> DataFrame:
    return bind(load(spark, folder, "nation"), store_id="n_nationkey", address_id="n_nationkey")


def addresses(spark: SparkSession, folder: str) -> DataFrame:
    nation = load(spark, folder, "nation")
    region = load(spark, folder, "region")
    placed = nation.join(region, nation.n_regionkey == region.r_regionkey)
    return bind(placed, address_id="n_nationkey", address="n_name", address2="r_name")


def customers(spark: SparkSession, folder: str) -> DataFrame:
    return bind(
        load(spark, folder, "customer"),
        customer_id="c_custkey",
        store_id="c_nationkey",
        first_name="c_mktsegment",
        last_name="c_name",
        email=F.when(F.col("c_acctbal") >= 0, F.concat(F.lower("c_name"), F.lit("@example.com"))),
        address_id="c_nationkey",
        last_update=F.lit(dt.date(2001, 1, 1)),
    )


def clerks(spark: SparkSession, folder: str) -> DataFrame:
    return bind(
        load(spark, folder, "supplier"),
        staff_id="s_suppkey",
        first_name=F.lit("Supplier"),
        last_name="s_name",
        store_id="s_nationkey",
    )


def copies(spark: SparkSession, folder: str) -> DataFrame:
    """One copy of each part in the nation of each of its suppliers."""
    line = load(spark, folder, "lineitem").select("l_partkey", "l_suppkey")
    seat = load(spark, folder, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    held = line.join(seat, "l_suppkey").select("l_partkey", "s_nationkey").distinct()
    return bind(
        held,
        inventory_id=F.col("l_partkey") * 100 + F.col("s_nationkey"),
        film_id="l_partkey",
        store_id="s_nationkey",
        last_update=F.lit(dt.date(2001, 1, 1)),
    )


def rentals(spark: SparkSession, folder: str) -> DataFrame:
    return bind(
        load(spark, folder, "orders"),
        rental_id="o_orderkey",
        rental_date="o_orderdate",
        inventory_id="o_custkey",
        customer_id="o_custkey",
        return_date=F.col("o_orderdate") + F.expr("INTERVAL 2 DAYS"),
        staff_id=F.lit(0).cast("long"),
        last_update="o_orderdate",
    )


def payments(spark: SparkSession, folder: str) -> DataFrame:
    """One payment per order."""
    return bind(
        load(spark, folder, "orders"),
        payment_id="o_orderkey",
        customer_id="o_custkey",
        staff_id=F.lit(0).cast("long"),
        rental_id="o_orderkey",
        amount=money("o_totalprice"),
        payment_date="o_orderdate",
    )


def lines_with_customer(spark: SparkSession, folder: str) -> DataFrame:
    line = load(spark, folder, "lineitem").select("l_orderkey")
    placed = load(spark, folder, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    return line.join(placed, "l_orderkey")


# --- reports ------------------------------------------------------------------


@query
def category_range_report(spark: SparkSession, folder: str) -> DataFrame:
    film = bind(
        load(spark, folder, "customer"),
        film_id="c_nationkey",
        title="c_name",
        release_year="c_nationkey",
        rating="c_mktsegment",
        rental_rate="c_acctbal",
    )
    links = bind(load(spark, folder, "nation"), film_id="n_nationkey", category_id="n_regionkey")
    category = bind(load(spark, folder, "region"), category_id="r_regionkey", name="r_name")
    return films_in_category(film, links, category, "asia", (5, 19), 1.0)


@query
def category_repeated_links(spark: SparkSession, folder: str) -> DataFrame:
    """Films that are linked to the category many times appear once."""
    links = bind(load(spark, folder, "lineitem"), film_id="l_partkey", category_id=F.col("l_suppkey") % 5)
    category = bind(load(spark, folder, "region"), category_id="r_regionkey", name="r_name")
    return shown(films_in_category(films(spark, folder), links, category, "Asia", (1980, 2010), 1.0), "rental_rate")


@query
def zero_kept_revenue(spark: SparkSession, folder: str) -> DataFrame:
    staff = bind(load(spark, folder, "customer"), staff_id="c_custkey", store_id="c_nationkey")
    payment = bind(
        load(spark, folder, "orders"), staff_id="o_custkey", amount=money("o_totalprice"), payment_date="o_orderdate"
    )
    report = revenue_per_store(
        stores(spark, folder), addresses(spark, folder), staff, payment, since=dt.date(2001, 7, 31)
    )
    return shown(report, "revenue")


@query
def top_by_distinct(spark: SparkSession, folder: str) -> DataFrame:
    link = bind(load(spark, folder, "lineitem"), actor_id="l_suppkey", film_id="l_partkey")
    return top_actors(actors(spark, folder), link, films(spark, folder), since_year=2000)


@query
def counts_by_year_and_value(spark: SparkSession, folder: str) -> DataFrame:
    orders = load(spark, folder, "orders")
    film = bind(orders, film_id="o_orderkey", release_year=F.year("o_orderdate"))
    link = bind(orders, film_id="o_orderkey", category_id="o_custkey")
    category = bind(load(spark, folder, "customer"), category_id="c_custkey", name="c_mktsegment")
    names = {"n_building": "BUILDING", "n_machinery": "MACHINERY", "n_household": "HOUSEHOLD"}
    return genre_counts_per_year(film, link, category, names)


@query
def top_revenue_with_latest(spark: SparkSession, folder: str) -> DataFrame:
    orders = load(spark, folder, "orders").withColumn("amount", money("o_totalprice"))
    period = orders.where(in_range(F.col("o_orderdate"), dt.date(1997, 1, 1), dt.date(1998, 1, 1)))
    totals = revenue_with_latest(
        period, "o_custkey", "amount", ["o_orderdate", "o_orderkey"], {"last_priority": "o_orderpriority"}
    )
    named = totals.join(bind(load(spark, folder, "customer"), o_custkey="c_custkey", c_name="c_name"), "o_custkey")
    best = top_k(named, [desc("total_revenue"), asc("c_name")], 3, ["o_custkey"])
    return shown(best.select("c_name", "last_priority", "total_revenue"), "total_revenue")


@query
def top_staff_report(spark: SparkSession, folder: str) -> DataFrame:
    payment = bind(
        load(spark, folder, "lineitem"),
        payment_id="l_orderkey",
        staff_id="l_suppkey",
        amount=money("l_extendedprice"),
        payment_date="l_shipdate",
    )
    report = top_staff(
        clerks(spark, folder),
        stores(spark, folder),
        addresses(spark, folder),
        payment,
        dt.date(1997, 1, 1),
        dt.date(1998, 1, 1),
    )
    return shown(report, "total_revenue")


@query
def top_counts_labelled(spark: SparkSession, folder: str) -> DataFrame:
    part = load(spark, folder, "part")
    film = bind(part, film_id="p_partkey", title="p_name", rating="p_type")
    inventory = bind(part, inventory_id="p_partkey", film_id="p_partkey")
    rental = bind(load(spark, folder, "lineitem"), inventory_id="l_partkey", rental_id="l_orderkey")
    return most_rented(film, inventory, rental, SIZE_LABELS)


@query
def inactivity_gap_report(spark: SparkSession, folder: str) -> DataFrame:
    orders = load(spark, folder, "orders")
    actor = bind(
        load(spark, folder, "customer"), actor_id="c_custkey", first_name="c_mktsegment", last_name="c_name"
    )
    link = bind(orders, actor_id="o_custkey", film_id="o_orderkey")
    film = bind(orders, film_id="o_orderkey", release_year=F.year("o_orderdate"))
    return inactivity_gap(actor, link, film, AS_OF)


# --- aggregates, existence, top-k ---------------------------------------------


@query
def multi_fact_threshold(spark: SparkSession, folder: str) -> DataFrame:
    facts = [
        (load(spark, folder, "orders"), "o_custkey", 10),
        (lines_with_customer(spark, folder), "o_custkey", 43),
    ]
    return eligible(load(spark, folder, "customer").select("c_custkey", "c_name"), "c_custkey", facts)


@query
def pick_target_fallback(spark: SparkSession, folder: str) -> DataFrame:
    customer = load(spark, folder, "customer")
    regulars = eligible(customer, "c_custkey", [(load(spark, folder, "orders"), "o_custkey", 10)])
    missing = pick_target(customer, "c_custkey", F.col("c_name") == "nobody", regulars)
    known = pick_target(customer, "c_custkey", eq_ci(F.col("c_name"), F.lit("customer#000000003")), regulars)
    return missing.select(F.lit("fallback").alias("way"), "c_custkey").unionByName(
        known.select(F.lit("match").alias("way"), "c_custkey")
    )


@query
def table_count_report(spark: SparkSession, folder: str) -> DataFrame:
    names = ["customer", "orders", "lineitem", "part", "supplier"]
    return count_report({name: load(spark, folder, name) for name in names})


@query
def exists_both_first(spark: SparkSession, folder: str) -> DataFrame:
    orders = load(spark, folder, "orders")
    facts = [
        (orders.where(in_range(F.col("o_orderdate"), dt.date(y, 1, 1), dt.date(y + 1, 1, 1))), "o_custkey")
        for y in (1995, 2001)
    ]
    return first_active(load(spark, folder, "customer").select("c_custkey", "c_name"), "c_custkey", facts)


@query
def exists_both(spark: SparkSession, folder: str) -> DataFrame:
    orders = load(spark, folder, "orders")
    facts = [
        (orders.where(in_range(F.col("o_orderdate"), dt.date(y, 1, 1), dt.date(y + 1, 1, 1))), "o_custkey")
        for y in (1995, 2001)
    ]
    return exists_in_all(load(spark, folder, "customer").select("c_custkey", "c_name"), "c_custkey", facts)


@query
def not_exists_unlabelled(spark: SparkSession, folder: str) -> DataFrame:
    documents = load(spark, folder, "documents").select("doc_id", "lang")
    return anti_join(documents, load(spark, folder, "labels"), ["doc_id"], unique="right")


@query
def semi_join_repeated_keys(spark: SparkSession, folder: str) -> DataFrame:
    orders = load(spark, folder, "orders").select("o_orderkey", "o_custkey")
    returned = load(spark, folder, "lineitem").where(F.col("l_returnflag") == "R")
    return semi_join(orders, returned, ["o_orderkey"], ["l_orderkey"])


@query
def latest_order_per_customer(spark: SparkSession, folder: str) -> DataFrame:
    orders = load(spark, folder, "orders")
    return latest_per_key(
        orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], ["o_orderkey", "o_orderdate", "o_orderpriority"]
    )


@query
def grouped_aggregates(spark: SparkSession, folder: str) -> DataFrame:
    orders = load(spark, folder, "orders").withColumn("amount", money("o_totalprice"))
    summed = orders.groupBy("o_orderstatus").agg(
        F.sum("amount").alias("total"),
        F.count(F.lit(1)).alias("n_rows"),
        F.count("o_orderpriority").alias("n_priorities"),
        F.count_distinct("o_custkey").alias("n_customers"),
        F.min("o_orderdate").alias("first_date"),
        F.max("o_orderdate").alias("last_date"),
        zero_sum(F.when(F.col("o_orderpriority") == "none", F.col("amount"))).alias("nothing"),
    )
    return shown(summed, "total", "nothing")


@query
def counts_by_value(spark: SparkSession, folder: str) -> DataFrame:
    statuses = {f"n_{v.lower()}": v for v in ("O", "F", "X")}
    counts = count_by_value(load(spark, folder, "lineitem"), ["l_returnflag"], "l_linestatus", statuses)
    return order(counts, [asc("l_returnflag")])


@query
def distinct_rows(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "lineitem").select("l_suppkey", "l_partkey").distinct()


@query
def group_by_id_show_name(spark: SparkSession, folder: str) -> DataFrame:
    part = bind(load(spark, folder, "part"), l_partkey="p_partkey", p_name="p_name")
    per_part = load(spark, folder, "lineitem").groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n_lines"))
    named = part.join(per_part, "l_partkey")
    return order(named, [asc("p_name"), desc("n_lines")], ["l_partkey"]).drop("l_partkey")


@query
def top_orders(spark: SparkSession, folder: str) -> DataFrame:
    orders = load(spark, folder, "orders")
    return top_k(orders, [desc("o_totalprice"), asc("o_orderdate")], 10, ["o_orderkey"])


@query
def first_customers(spark: SparkSession, folder: str) -> DataFrame:
    return first_by(load(spark, folder, "customer"), "c_custkey", 10)


@query
def inline_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Line items per meaning of their flag; flags without a literal row drop out."""
    meaning = rows(spark, [("A", "accepted"), ("R", "returned"), ("Z", None)], "l_returnflag STRING, meaning STRING")
    counts = load(spark, folder, "lineitem").groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n_lines"))
    return counts.join(meaning, "l_returnflag").select("meaning", "n_lines")


# --- joins --------------------------------------------------------------------


@query
def bridge_join(spark: SparkSession, folder: str) -> DataFrame:
    supplier = bind(load(spark, folder, "supplier"), l_suppkey="s_suppkey", s_name="s_name")
    part = bind(load(spark, folder, "part"), l_partkey="p_partkey", p_type="p_type")
    bridge = load(spark, folder, "lineitem").select("l_suppkey", "l_partkey").distinct()
    joined = through(supplier, bridge, part, "l_suppkey", "l_partkey")
    return joined.groupBy("s_name", "p_type").agg(F.count(F.lit(1)).alias("n_parts"))


@query
def lookup_chain(spark: SparkSession, folder: str) -> DataFrame:
    line = load(spark, folder, "lineitem")
    orders = load(spark, folder, "orders")
    customer = load(spark, folder, "customer")
    nation = load(spark, folder, "nation")
    region = load(spark, folder, "region")
    per_order = line.groupBy("l_orderkey").agg(F.sum(money("l_extendedprice")).alias("amount"))
    per_customer = (
        orders.join(per_order, orders.o_orderkey == per_order.l_orderkey, "left")
        .groupBy("o_custkey")
        .agg(F.sum("amount").alias("amount"), F.count(F.lit(1)).alias("n_orders"))
    )
    chained = (
        per_customer.join(customer, per_customer.o_custkey == customer.c_custkey, "left")
        .join(nation, F.col("c_nationkey") == nation.n_nationkey, "left")
        .join(region, F.col("n_regionkey") == region.r_regionkey, "left")
    )
    summed = chained.groupBy("r_name").agg(F.sum("amount").alias("revenue"), F.sum("n_orders").alias("n_orders"))
    return shown(summed, "revenue")


@query
def left_join_filter_in_on(spark: SparkSession, folder: str) -> DataFrame:
    customer = load(spark, folder, "customer").select("c_custkey", "c_name")
    orders = bind(
        load(spark, folder, "orders"), c_custkey="o_custkey", o_orderkey="o_orderkey", o_orderdate="o_orderdate"
    )
    return left_join_filtered(customer, orders, ["c_custkey"], on_or_after(F.col("o_orderdate"), dt.date(2001, 6, 1)))


@query
def composite_key_join(spark: SparkSession, folder: str) -> DataFrame:
    orders = load(spark, folder, "orders")
    newest = orders.groupBy("o_custkey").agg(F.max("o_orderdate").alias("o_orderdate"))
    return orders.join(newest, ["o_custkey", "o_orderdate"]).select("o_custkey", "o_orderdate", "o_orderkey")


@query
def correlated_aggregates(spark: SparkSession, folder: str) -> DataFrame:
    orders = load(spark, folder, "orders").where(F.col("o_orderpriority") == "1-URGENT")
    aggregates = {
        "urgent_total": F.sum(money("o_totalprice")),
        "urgent_last": F.max("o_orderdate"),
        "n_urgent": F.count(F.lit(1)),
    }
    customer = load(spark, folder, "customer").select("c_custkey")
    joined = with_agg(customer, orders, ["c_custkey"], aggregates, ["o_custkey"], zero=["n_urgent"], unique="left")
    return shown(joined, "urgent_total")


@query
def one_row_join(spark: SparkSession, folder: str) -> DataFrame:
    orders = load(spark, folder, "orders")
    bounds = orders.agg(F.min("o_orderdate").alias("first_date"), F.max("o_orderdate").alias("last_date"))
    return with_one_row(load(spark, folder, "customer").select("c_custkey"), bounds)


@query
def compare_with_scalar(spark: SparkSession, folder: str) -> DataFrame:
    orders = load(spark, folder, "orders")
    return eq_scalar(orders, "o_orderdate", orders.agg(F.max("o_orderdate")))


@query
def case_insensitive_join(spark: SparkSession, folder: str) -> DataFrame:
    supplier = bind(load(spark, folder, "supplier"), s_suppkey="s_suppkey", nation=starred("nation_", F.col("s_nationkey")))
    return resolve_keys(
        supplier, load(spark, folder, "nation"), {"nation": "n_name"}, {"n_nationkey": "n_nationkey"}, ci=True
    )


def customer_name(key: Column) -> Column:
    """Name that goes with a customer key: at least nine digits, more where the key has more."""
    padded = F.concat(F.lit("Customer#"), F.lpad(key.cast("string"), 9, "0"))  # formatting is several times as slow
    return F.when(key.between(0, 999_999_999), padded).otherwise(F.format_string("Customer#%09d", key))


@query
def natural_key_lookup(spark: SparkSession, folder: str) -> DataFrame:
    seed = bind(
        load(spark, folder, "orders"),
        o_orderkey="o_orderkey",
        customer_name=customer_name(F.col("o_orderkey")),
    )
    return resolve_keys(seed, load(spark, folder, "customer"), {"customer_name": "c_name"}, {"c_custkey": "c_custkey"})


@query
def optional_key_lookup(spark: SparkSession, folder: str) -> DataFrame:
    documents = load(spark, folder, "documents").select("doc_id", "source")
    labels = load(spark, folder, "labels")
    found = resolve_keys(documents, labels, {"doc_id": "doc_id"}, {"label_id": "doc_id"}, how="left")
    return found.groupBy("source").agg(F.count(F.lit(1)).alias("n_documents"), F.count("label_id").alias("n_labels"))


# --- predicates and scalar functions --------------------------------------------


@query
def predicate_counts(spark: SparkSession, folder: str) -> DataFrame:
    c = F.col
    tests = {
        "equal_literal": c("p_brand") == "Brand#2",
        "equal_ci": eq_ci(c("p_type"), F.lit("economy")),
        "null_safe_ci": eq_ci_null_as_empty(F.nullif(c("p_type"), F.lit("ECONOMY")), F.lit("")),
        "closed_range": c("p_size").between(10, 20),
        "compared": (c("p_size") > 10) & (c("p_retailprice") <= 950) & (c("p_size") != 12),
        "in_list": F.upper("p_type").isin("SMALL", "LARGE"),
        "is_null": F.nullif(c("p_size"), F.lit(7)).isNull(),
        "or_guard": F.nullif(c("p_size"), F.lit(7)).isNull() | (c("p_size") < 5),
        "parsed_number": number_after(c("p_brand"), "Brand#") % 3 == 0,
    }
    part = load(spark, folder, "part")
    return part.agg(*(F.count_if(test).alias(name) for name, test in tests.items()))


@query
def scalar_functions(spark: SparkSession, folder: str) -> DataFrame:
    c = F.col
    customer = load(spark, folder, "customer")
    maybe = F.when(c("c_acctbal") > 0, c("c_mktsegment"))
    return customer.select(
        "c_custkey",
        F.lower("c_name").alias("lowered"),
        join_text(", ", c("c_name"), maybe).alias("joined"),
        F.concat(c("c_name"), F.lit("/"), maybe).alias("glued"),
        F.replace(c("c_name"), F.lit("Customer#"), F.lit("C")).alias("replaced"),
        F.regexp_replace("c_name", "[^A-Z0-9]+", "_").alias("cleaned"),
        F.coalesce(maybe, F.lit("none")).alias("filled"),
        label(c("c_mktsegment"), {"BUILDING": "B", "MACHINERY": "M"}, "Unknown").alias("labelled"),
        F.greatest(F.floor("c_acctbal"), F.lit(0)).cast("long").alias("clamped"),
        F.pow(c("c_nationkey"), F.lit(2)).cast("double").alias("squared"),
        ((c("c_custkey") + 7) % 5).alias("remainder"),
        c("c_acctbal").cast("decimal(12,2)").cast("string").alias("as_text"),
        F.array_join(F.array(c("c_name"), c("c_mktsegment")), "|").alias("array_text"),
        F.lit(None).cast("string").isNull().alias("typed_null"),
        member_of(c("c_mktsegment"), SEGMENTS).alias("checked_text"),
        within(c("c_nationkey"), 0, 24).alias("checked_number"),
    )


@query
def date_functions(spark: SparkSession, folder: str) -> DataFrame:
    moment = F.col("o_orderdate")
    return load(spark, folder, "orders").select(
        "o_orderkey",
        F.year(moment).alias("order_year"),
        years_since(AS_OF, F.year(moment)).alias("years_ago"),
        (moment + F.expr("INTERVAL 2 DAYS")).alias("due"),
        add_days(moment, (F.col("o_orderkey") % 10).cast("int")).alias("returned"),
        on_or_after(moment, dt.date(2000, 1, 1)).alias("recent"),
        moment.cast("date").cast("string").alias("day"),
    )


@query
def zoned_moments(spark: SparkSession, folder: str) -> DataFrame:
    """Order days as texts with offsets of one to eleven and a half hours, read as instants and shown in UTC and by a clock two hours ahead."""
    hours, half = (F.col("o_orderkey") % 11 + 1).cast("string"), F.when(F.col("o_orderkey") % 2 == 0, ":30").otherwise("")
    sign = F.when(F.col("o_orderkey") % 3 == 0, "-").otherwise("+")
    text = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"), F.when(F.col("o_orderkey") % 5 == 0, "").otherwise(F.concat(sign, F.lpad(hours, 2, "0"), half)))
    moment = instant(text)
    return load(spark, folder, "orders").select("o_orderkey", wall_time(moment, "UTC").alias("in_utc"), wall_time(moment, "+02:00").alias("two_ahead"))


@query
def size_pretty_values(spark: SparkSession, folder: str) -> DataFrame:
    size = F.col("l_orderkey") * F.col("l_partkey") * F.col("l_suppkey") * F.col("l_linenumber")
    sized = load(spark, folder, "lineitem").select(size.alias("bytes")).distinct()
    return sized.select("bytes", size_pretty(F.col("bytes")).alias("pretty"))


@query
def principal_name_list(spark: SparkSession, folder: str) -> DataFrame:
    return principal_names(customers(spark, folder))


# --- table changes -----------------------------------------------------------------


@query
def insert_absent_labels(spark: SparkSession, folder: str) -> DataFrame:
    labels = load(spark, folder, "labels")
    source = bind(load(spark, folder, "documents"), doc_id="doc_id", quality=F.lit(-1), toxic=F.lit(-1))
    return insert_if_absent(labels, source, ["doc_id"]).table


@query
def insert_absent_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Order keys the line items ask for, against the orders moved up by the number of customers."""
    orders = load(spark, folder, "orders")
    moved = load(spark, folder, "customer").agg(F.count(F.lit(1))).scalar()
    target = bind(orders, o_orderkey=F.col("o_orderkey") + moved, o_custkey="o_custkey")
    source = bind(load(spark, folder, "lineitem"), o_orderkey="l_orderkey", o_custkey="l_suppkey")
    return insert_if_absent(target, source, ["o_orderkey"]).affected


@query
def insert_absent_ci(spark: SparkSession, folder: str) -> DataFrame:
    target = load(spark, folder, "customer").select("c_custkey", "c_name")
    recased = bind(load(spark, folder, "customer"), c_name=F.upper("c_name"))
    added = bind(load(spark, folder, "supplier"), c_name="s_name")
    source = recased.unionByName(added).unionByName(added)
    result = insert_if_absent(
        target,
        source,
        [F.upper("c_name")],
        distinct=True,
        id_column="c_custkey",
        id_order=["c_name"],
        unique_order=True,
    )
    return result.affected


@query
def insert_skip_conflicts_lines(spark: SparkSession, folder: str) -> DataFrame:
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    source = load(spark, folder, "lineitem").select(*columns)
    target = bind(
        load(spark, folder, "orders"),
        l_orderkey="o_orderkey",
        l_linenumber=F.lit(1),
        l_partkey=F.lit(-1).cast("long"),
        l_suppkey=F.lit(-1).cast("long"),
        l_quantity=F.lit(0.0),
        l_extendedprice="o_totalprice",
    )
    return insert_skip_conflicts(target, source, ["l_orderkey", "l_linenumber"], columns[2:]).table


@query
def insert_skip_null_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Labels whose quality is 0 have no key here, so each of them is added."""
    labels = load(spark, folder, "labels")
    target = bind(load(spark, folder, "documents"), doc_id="doc_id", toxic=F.lit(-1))
    source = labels.select(F.when(F.col("quality") == 1, F.col("doc_id")).alias("doc_id"), "toxic")
    return insert_skip_conflicts(target, source, ["doc_id"], ["toxic"]).affected


@query
def assigned_ids(spark: SparkSession, folder: str) -> DataFrame:
    source = load(spark, folder, "supplier").select(F.col("s_name").alias("c_name"))
    return assign_ids(source, load(spark, folder, "customer"), "c_custkey", ["c_name"])


@query
def appended_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers appended to customers: the nation is given, the segment is a default, the balance stays NULL."""
    target = load(spark, folder, "customer")
    source = bind(load(spark, folder, "supplier"), c_custkey="s_suppkey", c_name="s_name", c_nationkey="s_nationkey")
    return append(target, source, {"c_mktsegment": "SUPPLIER"})


@query
def inserted_with_ids(spark: SparkSession, folder: str) -> DataFrame:
    target = bind(load(spark, folder, "customer"), id="c_custkey", name="c_name", kind="c_mktsegment")
    source = bind(load(spark, folder, "supplier"), name="s_name")
    return insert_rows(target, source, "id", ["name"], {"kind": "SUPPLIER"}).affected


@query
def insert_chain_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """One new order per customer, then one payment per new order."""
    orders = load(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customer = load(spark, folder, "customer")
    new_orders = bind(
        customer,
        o_custkey="c_custkey",
        o_orderdate=add_days(F.lit(dt.datetime(2002, 1, 1)).cast("timestamp_ntz"), F.col("c_nationkey")),
    )
    parent = insert_if_absent(
        orders, new_orders, ["o_custkey", "o_orderdate"], id_column="o_orderkey", id_order=["o_custkey"]
    )
    paid = bind(
        load(spark, folder, "orders"),
        payment_id="o_orderkey",
        order_id="o_orderkey",
        customer_id="o_custkey",
        paid_at="o_orderdate",
    )

    def bills(inserted: DataFrame) -> DataFrame:
        return bind(inserted, order_id="o_orderkey", customer_id="o_custkey", paid_at="o_orderdate")

    return insert_chain(parent, paid, bills, ["order_id", "customer_id"], "payment_id", ["order_id"], True).affected


@query
def update_from_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Each customer's segment becomes the priority of the first urgent or high order."""
    orders = load(spark, folder, "orders").where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
    result = update_from(
        load(spark, folder, "customer"),
        orders,
        ["c_custkey"],
        {"c_mktsegment": "o_orderpriority"},
        ["o_custkey"],
        ["o_orderdate", "o_orderkey"],
        unique="left",
    )
    return result.table


@query
def update_latest_order(spark: SparkSession, folder: str) -> DataFrame:
    orders = load(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    newest = orders.agg(F.max("o_orderkey")).scalar()
    return update_where(orders, F.col("o_orderkey") == newest, {"o_orderstatus": F.lit("X")}).table


@query
def backfill_column(spark: SparkSession, folder: str) -> DataFrame:
    documents = load(spark, folder, "documents").select("doc_id", "lang")
    joined = documents.join(load(spark, folder, "labels").select("doc_id", "quality"), "doc_id", "left")
    filled = backfill(joined, "quality", -1).table
    return evolve(filled, "record_ts", "timestamp_ntz", F.lit(dt.datetime(2002, 1, 1)).cast("timestamp_ntz")).table


@query
def delete_mod(spark: SparkSession, folder: str) -> DataFrame:
    customer = load(spark, folder, "customer")
    return delete_where(customer, number_after(F.col("c_name"), "Customer#") % 3 == 0).table


@query
def delete_null_predicate(spark: SparkSession, folder: str) -> DataFrame:
    """Rows without a label have an unknown condition and stay."""
    documents = load(spark, folder, "documents").select("doc_id")
    joined = documents.join(load(spark, folder, "labels"), "doc_id", "left")
    return delete_where(joined, F.col("toxic") == 0).table.select("doc_id")


@query
def delete_using_customers(spark: SparkSession, folder: str) -> DataFrame:
    orders = load(spark, folder, "orders").select("o_orderkey", "o_custkey")
    indebted = load(spark, folder, "customer").where(F.col("c_acctbal") < 0)
    return delete_using(orders, indebted, ["o_custkey"], ["c_custkey"], unique="right").table


@query
def deleted_parent_and_child(spark: SparkSession, folder: str) -> DataFrame:
    """Orders holding a returned line lose those lines first, then go themselves."""
    line = load(spark, folder, "lineitem").select("l_orderkey", "l_returnflag")
    orders = load(spark, folder, "orders").select("o_orderkey")
    returned = line.where(F.col("l_returnflag") == "R").select("l_orderkey")
    lines = delete_using(line, returned, ["l_orderkey"])
    parents = delete_using(orders, returned, ["o_orderkey"], ["l_orderkey"], unique="left")
    return count_report({"lineitem": lines.affected, "orders": parents.affected})


@query
def generated_columns(spark: SparkSession, folder: str) -> DataFrame:
    orders = load(spark, folder, "orders")
    line = load(spark, folder, "lineitem")
    joined = line.join(orders, line.l_orderkey == orders.o_orderkey)
    start = F.col("o_orderdate")
    end = F.when(F.col("l_linestatus") == "F", F.col("l_shipdate"))
    price = F.when(F.col("l_linestatus") == "F", money("o_totalprice"))
    return shown(
        joined.select(
            "l_orderkey",
            "l_linenumber",
            whole_minutes(start, end).alias("minutes"),
            difference(money("l_extendedprice"), price).alias("price_difference"),
        ),
        "price_difference",
    )


@query
def truncate_table(spark: SparkSession, folder: str) -> DataFrame:
    """Rows and columns of a table, and of its emptied snapshot as stored."""
    before = load(spark, folder, "lineitem")
    after = create_as(truncate(before), f"{shared_dir(spark)}/emptied-{uuid.uuid4().hex}")
    widths = F.when(F.col("table_name") == "before", len(before.columns)).otherwise(len(after.columns))
    return count_report({"before": before, "after": after}).withColumn("n_columns", widths)


@query
def replaced_table(spark: SparkSession, folder: str) -> DataFrame:
    """A stored table of finished orders, replaced by one of the open orders."""
    orders, target = load(spark, folder, "orders"), f"{shared_dir(spark)}/replaced-{uuid.uuid4().hex}"
    create_as(orders.where(F.col("o_orderstatus") == "F").select("o_custkey"), target)
    return create_as(orders.where(F.col("o_orderstatus") == "O").select("o_orderkey", "o_orderdate"), target, replace=True)


# --- audits and policy ------------------------------------------------------------


@query
def audit_row_rules(spark: SparkSession, folder: str) -> DataFrame:
    c = F.col
    rules = [
        *not_null("l_orderkey", "l_shipdate"),
        check("quantity_at_least_2", c("l_quantity") >= 2),
        check("discount_range", c("l_discount").between(0.0, 0.05)),
        check("shipped_after_1996", c("l_shipdate") > dt.date(1996, 1, 1)),
        domain("l_returnflag", ["A", "N"]),
        check("tax_not_above_discount", c("l_tax") <= c("l_discount")),
        check("status_upper_case", c("l_linestatus") == F.upper("l_linestatus")),
        check("unknown_passes", F.nullif(c("l_quantity"), F.lit(1.0)) > 1),
        *max_length({"l_returnflag": 0}),
        *fits_decimal({"l_extendedprice": (6, 2)}),
    ]
    return audit_rows(load(spark, folder, "lineitem"), rules)


@query
def audit_unique_lines(spark: SparkSession, folder: str) -> DataFrame:
    return audit_unique(load(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def repeated_line_keys(spark: SparkSession, folder: str) -> DataFrame:
    found = repeated_keys(load(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])
    return found.toDF("l_orderkey", "l_linenumber", "n_rows")


@query
def audit_primary_keys(spark: SparkSession, folder: str) -> DataFrame:
    lines = audit_primary_key(load(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])
    return lines.unionByName(audit_primary_key(load(spark, folder, "orders"), ["o_orderkey"]))


@query
def audit_foreign_keys(spark: SparkSession, folder: str) -> DataFrame:
    documents, labels = load(spark, folder, "documents"), load(spark, folder, "labels")
    line, orders = load(spark, folder, "lineitem"), load(spark, folder, "orders")
    return audit_foreign_key(documents, labels, ["doc_id"]).unionByName(
        audit_foreign_key(line, orders, ["l_orderkey"], ["o_orderkey"])
    )


@query
def orphan_documents(spark: SparkSession, folder: str) -> DataFrame:
    documents = load(spark, folder, "documents").select("doc_id", "source")
    return orphans(documents, load(spark, folder, "labels"), ["doc_id"])


@query
def audit_full_report(spark: SparkSession, folder: str) -> DataFrame:
    rules = [
        *not_null("o_orderkey", "o_custkey"),
        check("total_not_negative", F.col("o_totalprice") >= 0),
        domain("o_orderstatus", ["F", "O"]),
    ]
    customer = load(spark, folder, "customer")
    return audit(
        load(spark, folder, "orders"), rules, [["o_orderkey"], ["o_custkey"]], [(["o_custkey"], customer, ["c_custkey"])]
    )


@query
def row_policy(spark: SparkSession, folder: str) -> DataFrame:
    fact = rentals(spark, folder).select("customer_id", "rental_id", "rental_date")
    return visible_rows(fact, customers(spark, folder), PRINCIPAL)


@query
def row_policy_leaks(spark: SparkSession, folder: str) -> DataFrame:
    """Leaks among the visible rows (none) and among the unfiltered rows."""
    fact = rentals(spark, folder).select("customer_id", "rental_id")
    entity = customers(spark, folder)
    seen = visible_rows(fact, entity, PRINCIPAL)
    return count_report({"visible": policy_leaks(seen, entity, PRINCIPAL), "all": policy_leaks(fact, entity, PRINCIPAL)})


@query
def principal_access(spark: SparkSession, folder: str) -> DataFrame:
    facts = {"rental": rentals(spark, folder), "payment": payments(spark, folder)}
    return recipes.principal_access(customers(spark, folder), facts, PRINCIPAL)


# --- bulk tables --------------------------------------------------------------------


@query
def generated_sequence(spark: SparkSession, folder: str) -> DataFrame:
    """As many generated rows as there are line items."""
    return sequence_table(spark, load(spark, folder, "lineitem").count(), recipes.BULK_PREFIX)


@query
def stored_table_size(spark: SparkSession, folder: str) -> DataFrame:
    return table_size(spark, f"{folder}/lineitem.parquet", "lineitem")


@query
def bulk_lifecycle(spark: SparkSession, folder: str) -> DataFrame:
    """Made, thinned and emptied snapshots of as many rows as there are line items."""
    n = load(spark, folder, "lineitem").count()
    target = f"{shared_dir(spark)}/bulk-{uuid.uuid4().hex}"
    return recipes.bulk_lifecycle(spark, n, target).select("step", "table_name", "row_count")


# --- recipes ------------------------------------------------------------------------


@query
def bulk_sizes(spark: SparkSession, folder: str) -> DataFrame:
    """Sizes of the three steps of the bulk exercise: each is smaller than the one before, rows of text take room, and no rows leave footers only."""
    n = load(spark, folder, "lineitem").count()
    steps = recipes.bulk_lifecycle(spark, n, f"{shared_dir(spark)}/bulk-{uuid.uuid4().hex}")
    before = steps.select((F.col("step") + 1).alias("step"), F.col("total_bytes").alias("bytes_before"))
    return steps.join(before, "step", "left").select(
        "step",
        "table_name",
        (F.col("total_bytes") < F.col("bytes_before")).alias("smaller"),
        F.when(F.col("row_count") > 0, F.col("total_bytes") > 2 * F.col("row_count")).otherwise(F.col("total_bytes") < 4096 * F.col("file_count")).alias("sized"),
        (F.col("total") == size_pretty(F.col("total_bytes"))).alias("shown"),
    )


@query
def add_films_recipe(spark: SparkSession, folder: str) -> DataFrame:
    """Every part is offered again in capitals, and every supplier as a film of 2001."""
    film, category = films(spark, folder), categories(spark, folder)
    language = bind(load(spark, folder, "region"), language_id="r_regionkey", name="r_name")
    old = film.select(
        F.upper("title").alias("title"), "release_year", "rental_duration", "rental_rate", "rating"
    ).withColumn("category_name", F.lit("Brand#1"))
    new = bind(
        load(spark, folder, "supplier"),
        title="s_name",
        release_year=F.lit(2001),
        rental_duration=F.lit(7),
        rental_rate=F.lit("4.99").cast("decimal(18,2)"),
        rating=F.lit("PG"),
        category_name=F.lit("Brand#2"),
    )
    result = recipes.add_films(
        film,
        film_categories(spark, folder),
        category,
        language,
        old.unionByName(new),
        "ASIA",
        AS_OF,
        ratings=[*PART_TYPES, "PG"],
    )
    added = result.changes["film"].affected.select("film_id", "title", "release_year", "language_id")
    links = result.changes["film_category"].affected
    per_category = with_agg(added, links, ["film_id"], {"n_links": F.count(F.lit(1))}, zero=["n_links"])
    return per_category.unionByName(
        links.agg(F.count(F.lit(1)).alias("n_links")).select(
            F.lit(-1).cast("long").alias("film_id"),
            F.lit("all links").alias("title"),
            F.lit(0).alias("release_year"),
            F.lit(0).alias("language_id"),
            "n_links",
        )
    )


def added_actors(spark: SparkSession, folder: str) -> recipes.RecipeResult:
    """Customers become the cast of the part with their number, beside all suppliers again in capitals."""
    film = films(spark, folder)
    part = bind(film, number="film_id", movie_title="title")
    fans = bind(load(spark, folder, "customer"), number="c_custkey", first_name="c_mktsegment", last_name="c_name")
    known = bind(
        load(spark, folder, "supplier"),
        number="s_suppkey",
        first_name=F.lit("SUPPLIER"),
        last_name=F.upper("s_name"),
    )
    seed = part.join(fans.unionByName(known), "number").drop("number")
    return recipes.add_actors(actors(spark, folder), appearances(spark, folder), film, seed, AS_OF)


@query
def add_actors_recipe(spark: SparkSession, folder: str) -> DataFrame:
    return added_actors(spark, folder).report


@query
def add_actors_links(spark: SparkSession, folder: str) -> DataFrame:
    """The links that were inserted; those that were there already are not."""
    return added_actors(spark, folder).changes["film_actor"].affected.select("actor_id", "film_id")


@query
def stock_first_store_recipe(spark: SparkSession, folder: str) -> DataFrame:
    film = films(spark, folder)
    seed = film.select(F.lower("title").alias("title"))
    result = recipes.stock_first_store(copies(spark, folder), stores(spark, folder), film, seed, AS_OF)
    return result.changes["inventory"].affected.select("inventory_id", "film_id", "store_id")


@query
def preview_customer_recipe(spark: SparkSession, folder: str) -> DataFrame:
    return recipes.preview_customer(
        customers(spark, folder), rentals(spark, folder), payments(spark, folder), "nobody@example.com", 10
    )


@query
def retarget_customer_recipe(spark: SparkSession, folder: str) -> DataFrame:
    result = recipes.retarget_customer(
        customers(spark, folder),
        rentals(spark, folder),
        payments(spark, folder),
        stores(spark, folder),
        addresses(spark, folder),
        "Ada",
        "Example",
        "target@example.com",
        10,
        AS_OF,
    )
    changed = result.table("customer")
    return changed.select("customer_id", "first_name", "last_name", "email", "address_id", "store_id")


@query
def preview_purge_recipe(spark: SparkSession, folder: str) -> DataFrame:
    return recipes.preview_purge(
        customers(spark, folder), rentals(spark, folder), payments(spark, folder), "CUSTOMER#000000001@example.com"
    )


@query
def purge_customer_recipe(spark: SparkSession, folder: str) -> DataFrame:
    result = recipes.purge_customer(
        customers(spark, folder), rentals(spark, folder), payments(spark, folder), "CUSTOMER#000000001@example.com"
    )
    return count_report({"payment": result.table("payment"), "rental": result.table("rental")})


@query
def purge_customer_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The rows that a purge deletes."""
    result = recipes.purge_customer(
        customers(spark, folder), rentals(spark, folder), payments(spark, folder), "CUSTOMER#000000001@example.com"
    )
    deleted = {name: result.changes[name].affected for name in ("payment", "rental")}
    payment = bind(deleted["payment"], table_name=F.lit("payment"), row_id="payment_id", customer_id="customer_id")
    return payment.unionByName(bind(deleted["rental"], table_name=F.lit("rental"), row_id="rental_id", customer_id="customer_id"))


@query
def rent_and_pay_recipe(spark: SparkSession, folder: str) -> DataFrame:
    """One customer rents every film that the customer's store has a copy of."""
    film = films(spark, folder)
    seed = bind(
        film,
        title=F.upper("title"),
        rental_date=add_days(F.lit(dt.datetime(2002, 1, 1)).cast("timestamp_ntz"), F.col("rental_duration")),
    )
    result = recipes.rent_and_pay(
        customers(spark, folder),
        clerks(spark, folder),
        film,
        copies(spark, folder),
        rentals(spark, folder),
        payments(spark, folder),
        seed,
        "customer#000000001@example.com",
        AS_OF,
    )
    return shown(result.report, "amount")


@query
def touched_rental(spark: SparkSession, folder: str) -> DataFrame:
    """A rental made now and the stamp on the newest rental."""
    moment = F.lit(dt.datetime(2002, 1, 1, 12)).cast("timestamp_ntz")
    made = recipes.add_rental_now(rentals(spark, folder), moment, 2, 2, 1)
    stamped = recipes.touch_latest_rental(made.table, F.lit(dt.datetime(2002, 1, 2)).cast("timestamp_ntz"))
    return stamped.affected


@query
def load_dates(spark: SparkSession, folder: str) -> DataFrame:
    names = ["customer", "orders", "part", "supplier", "nation", "region"]
    stamped = recipes.add_load_date({name: load(spark, folder, name) for name in names}, AS_OF)
    counts = [
        change.table.agg(
            F.count("record_ts").alias("n_dated"), F.max("record_ts").cast("string").alias("record_ts")
        ).select(F.lit(name).alias("table_name"), "n_dated", "record_ts")
        for name, change in stamped.items()
    ]
    report = counts[0]
    for part in counts[1:]:
        report = report.unionByName(part)
    return report


@query
def load_dates_today(spark: SparkSession, folder: str) -> DataFrame:
    """Without a given day the load date is today."""
    stamped = recipes.add_load_date({"lineitem": load(spark, folder, "lineitem")})["lineitem"].table
    return stamped.agg(F.count_if(F.col("record_ts") == F.current_date()).alias("n_today"), F.count(F.lit(1)).alias("n_rows"))


def fleet_seeds(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Seeds for all twelve fleet tables, with natural keys, made from the star tables."""
    part, customer = load(spark, folder, "part"), load(spark, folder, "customer")
    supplier, orders = load(spark, folder, "supplier"), load(spark, folder, "orders")
    text = lambda c: F.col(c).cast("string")
    mail = lambda name: F.concat(F.lower(name), F.lit("@example.com"))
    hour = F.expr("INTERVAL 1 HOUR")
    start_2001 = F.lit(dt.datetime(2001, 1, 1))
    serviced = start_2001 + F.make_dt_interval(F.col("p_size"))
    inspected = start_2001 + F.make_dt_interval(F.lit(5))
    owner = customer_name(F.col("o_custkey"))
    booked = F.col("o_orderdate").cast("timestamp") + F.expr("INTERVAL 10 YEARS") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), F.col("o_orderkey")
    )
    set_off = booked + F.expr("INTERVAL 15 MINUTES")
    booking = {"user_email": mail(owner), "vin": starred("V", F.col("o_custkey"))}
    riding = {**booking, "trip_started_at": set_off}
    return {
        "vehicle_type": bind(part, type_name="p_type", description="p_type").distinct(),
        "app_user": bind(
            customer,
            first_name="c_mktsegment",
            last_name="c_name",
            email=mail("c_name"),
            phone_number=text("c_custkey"),
            driver_license_no=starred("L", F.col("c_custkey")),
            registered_at=start_2001,
        ),
        "employee": bind(
            supplier,
            first_name=F.lit("Agent"),
            last_name="s_name",
            email=mail("s_name"),
            phone_number=F.lit(None).cast("string"),
            job_title=F.lit("Examiner"),
            hired_at=F.lit(dt.date(2001, 1, 1)),
        ),
        "vehicle": bind(
            part,
            type_name="p_type",
            vin=starred("V", F.col("p_partkey")),
            registration_plate=starred("P", F.col("p_partkey")),
            brand="p_brand",
            model="p_name",
            production_year=F.lit(2000) + F.col("p_size") % 20,
            current_odometer_km=F.col("p_retailprice").cast("decimal(12,2)"),
        ),
        "maintenance_event": bind(
            part,
            vin=starred("V", F.col("p_partkey")),
            maintenance_type=F.lit("Tyre swap"),
            opened_at=serviced,
            completed_at=serviced + hour,
            odometer_km=F.col("p_retailprice").cast("decimal(12,2)"),
            maintenance_status=F.lit("completed"),
        ),
        "inspection_event": bind(
            supplier,
            vin=starred("V", F.col("s_suppkey")),
            employee_email=mail("s_name"),
            inspection_type=F.lit("Yearly review"),
            inspection_result=F.lit("passed"),
            inspected_at=inspected,
            odometer_km=F.lit(1).cast("decimal(12,2)"),
        ),
        "reservation": bind(
            orders,
            **booking,
            reserved_from=booked,
            reserved_until=booked + hour,
            created_at=booked,
            reservation_status=F.lit("fulfilled"),
        ),
        "trip": bind(
            orders,
            **booking,
            reservation_from=booked,
            started_at=set_off,
            ended_at=set_off + F.make_dt_interval(F.lit(0), F.lit(0), (F.col("o_orderkey") % 600).cast("int")),
            start_odometer_km=F.lit(0).cast("decimal(12,2)"),
            end_odometer_km=F.col("o_totalprice").cast("decimal(12,2)"),
            total_cost=F.col("o_totalprice").cast("decimal(10,2)"),
            trip_status=F.lit("completed"),
        ),
        "payment": bind(
            orders,
            **riding,
            amount=F.col("o_totalprice").cast("decimal(10,2)"),
            payment_method=F.lit("card"),
            created_at=set_off,
        ),
        "rating": bind(
            orders, **riding, score=(F.col("o_orderkey") % 5 + 1).cast("int"), created_at=set_off
        ),
        "maintenance_event_employee": bind(
            part.join(supplier, F.col("p_partkey") == F.col("s_suppkey")),
            vin=starred("V", F.col("p_partkey")),
            opened_at=serviced,
            employee_email=mail("s_name"),
            assigned_role=F.lit("Lead"),
            assigned_at=serviced,
        ),
        "vehicle_status_history": bind(
            orders,
            vin=starred("V", F.col("o_custkey")),
            status_code=F.lit("in_use"),
            reservation_from=booked,
            trip_started_at=set_off,
            maintenance_opened_at=F.lit(None).cast("timestamp"),
            inspection_at=F.lit(None).cast("timestamp"),
            valid_from=set_off,
            valid_to=set_off + hour,
            recorded_at=set_off,
        ),
    }


@query
def fleet_load(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per table after loading all twelve fleet tables."""
    changes = load_fleet(empty_fleet(spark), fleet_seeds(spark, folder), dt.datetime(2020, 1, 1))
    return count_report({name: change.table for name, change in changes.items()})


@query
def fleet_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Every row of all twelve tables under natural keys, loaded with all constraints enforced."""
    changes = load_fleet(empty_fleet(spark), fleet_seeds(spark, folder), dt.datetime(2020, 1, 1), enforced=True)
    return named_rows({name: change.table for name, change in changes.items()})


TRIP_TABLES = ("vehicle_type", "app_user", "vehicle", "reservation", "trip")


def loaded_trips(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    seeds = fleet_seeds(spark, folder)
    changes = load_fleet(empty_fleet(spark), {name: seeds[name] for name in TRIP_TABLES}, dt.datetime(2020, 1, 1))
    return {name: change.table for name, change in changes.items()}


@query
def fleet_trip_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Every loaded trip under its natural keys, with defaults and generated columns."""
    tables = loaded_trips(spark, folder)
    user = tables["app_user"].select("user_id", "email", "is_active")
    vehicle = tables["vehicle"].select("vehicle_id", "vin", "vehicle_type_id")
    kind = tables["vehicle_type"].select("vehicle_type_id", "type_name")
    booking = tables["reservation"].select("reservation_id", "reserved_from", "user_id", "vehicle_id")
    named = (
        tables["trip"]
        .join(booking, ["reservation_id", "user_id", "vehicle_id"])
        .join(user, "user_id")
        .join(vehicle, "vehicle_id")
        .join(kind, "vehicle_type_id")
    )
    moment = lambda c: F.col(c).cast("timestamp_ntz").alias(c)
    return shown(
        named.select(
            "email", "is_active", "vin", "type_name", "duration_minutes", "distance_km", "total_cost",
            moment("reserved_from"), moment("started_at"),
        ),
        "distance_km", "total_cost",
    )


@query
def fleet_load_again(spark: SparkSession, folder: str) -> DataFrame:
    """All twelve tables loaded, given a load date, and loaded again with some new vehicle types and users."""
    seeds = fleet_seeds(spark, folder)
    first = load_fleet(empty_fleet(spark), seeds, dt.datetime(2020, 1, 1))
    dated = recipes.add_load_date({name: change.table for name, change in first.items()}, AS_OF)
    brands = bind(load(spark, folder, "part"), type_name="p_brand", description="p_name")
    guests = seeds["app_user"].withColumns(
        {
            "email": F.concat(F.lit("guest."), "email"),
            "driver_license_no": F.concat(F.lit("G"), "driver_license_no"),
            "phone_number": F.concat(F.lit("+"), "phone_number"),
        }
    )
    later = seeds | {
        "vehicle_type": seeds["vehicle_type"].unionByName(brands),
        "app_user": seeds["app_user"].unionByName(guests),
    }
    second = load_fleet({name: change.table for name, change in dated.items()}, later, dt.datetime(2020, 1, 2))
    report = None
    for name, change in second.items():
        day = F.col(recipes.LOAD_DATE)
        counts = change.table.agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(day == AS_OF).alias("n_dated_first"),
            F.count_if(day == dt.date(2020, 1, 2)).alias("n_dated_later"),
        ).select(F.lit(name).alias("table_name"), "*")
        report = counts if report is None else report.unionByName(counts)
    return report


@query
def fleet_trip_measures(spark: SparkSession, folder: str) -> DataFrame:
    """Generated columns of the loaded trips, per number of minutes."""
    trip = loaded_trips(spark, folder)["trip"]
    return shown(
        trip.groupBy("duration_minutes").agg(
            F.count("reservation_id").alias("n_trips"), F.sum("distance_km").alias("distance_km")
        ),
        "distance_km",
    )


@query
def fleet_trip_audit(spark: SparkSession, folder: str) -> DataFrame:
    """All rules of the trip table, over the loaded trips with their costs and ends cut down to break some."""
    tables = loaded_trips(spark, folder)
    tables["trip"] = tables["trip"].withColumns(
        {
            "total_cost": F.col("total_cost") - 100000,
            "end_odometer_km": F.nullif(F.col("end_odometer_km"), F.col("start_odometer_km")),
            "vehicle_id": -F.col("vehicle_id"),
        }
    )
    return audit_fleet_table(SPECS["trip"], tables)


@query
def principal_name_forms(spark: SparkSession, folder: str) -> DataFrame:
    """The principal's normal form beside the form that takes the names as stored."""
    person = load(spark, folder, "supplier")
    return person.select(
        "s_suppkey",
        principal_name(F.lit("o'neil"), F.col("s_name")).alias("normal"),
        principal_name(F.lit("o'neil"), F.col("s_name"), raw=True).alias("raw"),
    )
