"""The seven reports.

Tables come in as DataFrames with the film-rental column names; other tables
are given those names with `sources.bind`. The large tables (payments, rentals,
links) are reduced by their own key before they meet anything else.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentledger.functions import asc, desc, eq_ci, in_range, join_text, label, on_or_after, years_since
from rentledger.operators.aggregates import count_by_value, distinct_count, latest
from rentledger.operators.joins import semi_join, with_agg
from rentledger.operators.ordering import order, top_k

# Audience named for each rating.
AUDIENCES = {
    "G": "All ages",
    "PG": "Parental guidance suggested",
    "PG-13": "13+",
    "R": "17+ (under 17 with accompanying parent or adult guardian)",
    "NC-17": "17+ only",
}


def films_in_category(
    film: DataFrame,
    film_category: DataFrame,
    category: DataFrame,
    name: str,
    years: tuple[int, int],
    min_rate: float,
) -> DataFrame:
    """Films of a category within a closed year range and above a rate, by title.

    The category name is matched without regard to case, and a film that is
    linked to the category twice appears once.
    """
    wanted = category.where(eq_ci(F.col("name"), F.lit(name)))
    links = film_category.join(wanted.select("category_id"), "category_id")
    chosen = film.where(F.col("release_year").between(*years) & (F.col("rental_rate") > min_rate))
    found = semi_join(chosen, links, ["film_id"])
    by_title = order(found.select("film_id", "title", "release_year", "rating", "rental_rate"), [asc("title")], ["film_id"])
    return by_title.drop("film_id")


def revenue_per_store(
    store: DataFrame, address: DataFrame, staff: DataFrame, payment: DataFrame, since: dt.date
) -> DataFrame:
    """Revenue of every store since a day, 0 for a store that took nothing, with its address."""
    recent = payment.where(on_or_after(F.col("payment_date"), since))
    per_staff = recent.groupBy("staff_id").agg(F.sum("amount").alias("taken"))
    per_store = staff.select("staff_id", "store_id").join(per_staff, "staff_id")
    stores = store.join(address, "address_id").select(
        "store_id", join_text(", ", "address", "address2").alias("address")
    )
    with_revenue = with_agg(stores, per_store, ["store_id"], {"revenue": F.sum("taken")}, zero=["revenue"], unique="left")
    return order(with_revenue, [asc("address")], ["store_id"]).drop("store_id")


def top_actors(actor: DataFrame, film_actor: DataFrame, film: DataFrame, since_year: int, k: int = 5) -> DataFrame:
    """Actors with the most different films since a year."""
    recent = film.where(F.col("release_year") >= since_year).select("film_id")
    appearances = film_actor.select("actor_id", "film_id").join(recent, "film_id")
    counts = distinct_count(appearances, ["actor_id"], "film_id", "number_of_movies")
    named = actor.select("actor_id", "first_name", "last_name").join(counts, "actor_id")
    keys = [desc("number_of_movies"), asc("last_name"), asc("first_name")]
    return top_k(named, keys, k, ["actor_id"]).select("first_name", "last_name", "number_of_movies")


def genre_counts_per_year(
    film: DataFrame, film_category: DataFrame, category: DataFrame, names: Mapping[str, str]
) -> DataFrame:
    """Films per year for the named categories, newest year first.

    `names` maps output columns to category names. Years without any of them
    stay, with zeros, and films without a year form a year of their own.
    """
    listed = category.where(F.col("name").isin(list(names.values()))).select("category_id", "name")
    links = film_category.select("film_id", "category_id").join(listed, "category_id")
    filed = film.select("film_id", "release_year").join(links, "film_id", "left")
    return order(count_by_value(filed, ["release_year"], "name", names), [desc("release_year")])


def revenue_with_latest(
    fact: DataFrame, key: str, amount: str, latest_order: Sequence[str], carry: Mapping[str, str]
) -> DataFrame:
    """Revenue per key together with columns of the key's latest row, in one shuffle.

    `carry` maps output columns to columns of the latest row.
    """
    summed = fact.groupBy(key).agg(
        F.sum(amount).alias("total_revenue"), latest(list(carry.values()), latest_order).alias("_latest")
    )
    return summed.select(key, "total_revenue", *(F.col("_latest")[c].alias(name) for name, c in carry.items()))


def top_staff(
    staff: DataFrame,
    store: DataFrame,
    address: DataFrame,
    payment: DataFrame,
    start: dt.date,
    end: dt.date,
    k: int = 3,
) -> DataFrame:
    """Staff with the most revenue in `[start, end)` and the address of the store of their last payment.

    Staff without a store get an empty address. Addresses are looked up for the
    k winners only.
    """
    period = payment.where(in_range(F.col("payment_date"), start, end))
    totals = revenue_with_latest(
        period, "staff_id", "amount", ["payment_date", "payment_id"], {"last_staff_id": "staff_id"}
    )
    people = staff.select("staff_id", "first_name", "last_name")
    keys = [desc("total_revenue"), asc("last_name"), asc("first_name")]
    best = top_k(people.join(totals, "staff_id"), keys, k, ["staff_id"])
    places = store.join(address, "address_id", "left").select("store_id", "address", "address2")
    seat = staff.select(F.col("staff_id").alias("last_staff_id"), "store_id")
    placed = best.join(seat, "last_staff_id", "left").join(places, "store_id", "left")
    shown = placed.withColumn("last_store_address", join_text(", ", "address", "address2"))
    return order(shown, keys, ["staff_id"]).select("first_name", "last_name", "last_store_address", "total_revenue")


def most_rented(
    film: DataFrame,
    inventory: DataFrame,
    rental: DataFrame,
    labels: Mapping[str, str] | None = None,
    k: int = 5,
    other: str = "Unknown",
) -> DataFrame:
    """The films rented most often, with the audience their rating stands for."""
    per_copy = rental.groupBy("inventory_id").agg(F.count("rental_id").alias("taken"))
    per_film = (
        inventory.select("inventory_id", "film_id")
        .join(per_copy, "inventory_id")
        .groupBy("film_id")
        .agg(F.sum("taken").alias("number_of_rentals"))
    )
    counted = film.select("film_id", "title", "rating").join(per_film, "film_id")
    best = top_k(counted, [desc("number_of_rentals"), asc("title")], k, ["film_id"])
    audience = label(F.col("rating"), AUDIENCES if labels is None else labels, other)
    return best.select("title", "number_of_rentals", "rating", audience.alias("expected_audience_age"))


def inactivity_gap(
    actor: DataFrame, film_actor: DataFrame, film: DataFrame, as_of: dt.date | None = None
) -> DataFrame:
    """Years since each actor's latest film, longest gap first.

    Actors without any link are left out; actors whose films all are missing
    have an unknown gap and come first.
    """
    years = film_actor.select("actor_id", "film_id").join(film.select("film_id", "release_year"), "film_id", "left")
    latest_year = years.groupBy("actor_id").agg(F.max("release_year").alias("latest_release_year"))
    dated = actor.select("actor_id", "first_name", "last_name").join(latest_year, "actor_id")
    gaps = dated.withColumn("inactivity_gap_years", years_since(as_of, F.col("latest_release_year")))
    keys = [desc("inactivity_gap_years"), asc("last_name"), asc("first_name")]
    return order(gaps, keys, ["actor_id"]).drop("actor_id")
