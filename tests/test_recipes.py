from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

import pytest

from rentledger.plans import recipes
from pyspark.sql import functions as F
from tests.fixtures import bag, ts, values

DAY = dt.date(2024, 5, 1)
MAIL = "target@example.com"


@pytest.fixture(scope="module")
def film_seed(spark):
    return spark.createDataFrame(
        [
            ("Amber Skies", "a", 2001, 7, D("4.99"), 100, D("19.99"), "PG", ["Trailers"], "Animation"),
            ("PAPER MOONS", "b", 2017, 7, D("4.99"), 100, D("19.99"), "G", None, "Drama"),
            ("Paper Moons", "c", 1999, 14, D("9.99"), 100, D("29.99"), "R", None, "No such category"),
        ],
        "title STRING, description STRING, release_year INT, rental_duration INT, rental_rate DECIMAL(4,2), length INT, "
        "replacement_cost DECIMAL(5,2), rating STRING, special_features ARRAY<STRING>, category_name STRING",
    )


def test_add_films(shop, film_seed):
    tables = [shop[n] for n in ("film", "film_category", "category", "language")]
    result = recipes.add_films(*tables, film_seed, as_of=DAY)
    added = result.changes["film"].affected
    assert bag(added.select("film_id", "title", "release_year", "language_id", "last_update")) == [
        (8, "Amber Skies", 2001, 1, DAY),
        (9, "Paper Moons", 1999, 1, DAY),
    ]
    assert bag(result.changes["film_category"].affected) == [(1, 2, DAY), (8, 1, DAY)]
    assert [(r.film_id, r.title) for r in result.report.collect()] == [
        (8, "Amber Skies"),
        (1, "Paper Moons"),
        (9, "Paper Moons"),
    ]
    again = recipes.add_films(result.table("film"), result.table("film_category"), *tables[2:], film_seed, as_of=DAY)
    assert [again.changes[n].affected.count() for n in ("film", "film_category")] == [0, 0]


def test_add_films_needs_the_language(shop, film_seed):
    tables = [shop[n] for n in ("film", "film_category", "category", "language")]
    result = recipes.add_films(*tables, film_seed, language_name="Latin", as_of=DAY)
    assert result.changes["film"].affected.count() == 0


def test_add_actors(spark, shop):
    seed = spark.createDataFrame(
        [("red lanterns", "New", "Face"), ("Tin Roofs", "New", "Face"), ("Tin Roofs", "bo", "STONE"), ("None", "A", "B")],
        "movie_title STRING, first_name STRING, last_name STRING",
    )
    result = recipes.add_actors(shop["actor"], shop["film_actor"], shop["film"], seed, DAY)
    assert bag(result.changes["actor"].affected) == [(6, "A", "B", DAY), (7, "New", "Face", DAY)]
    assert bag(result.changes["film_actor"].affected) == [(7, 3, DAY), (7, 5, DAY)]
    assert values(result.report) == [
        ("Tin Roofs", "New", "Face", 7, 5),
        ("Tin Roofs", "Bo", "Stone", 3, 5),
        ("red lanterns", "New", "Face", 7, 3),
    ]
    again = recipes.add_actors(result.table("actor"), result.table("film_actor"), shop["film"], seed, DAY)
    assert [again.changes[n].affected.count() for n in ("actor", "film_actor")] == [0, 0]


def test_stock_first_store(spark, shop):
    seed = spark.createDataFrame([("paper moons",), ("Red Lanterns",)], "title STRING")
    result = recipes.stock_first_store(shop["inventory"], shop["store"], shop["film"], seed, DAY)
    assert bag(result.changes["inventory"].affected) == [(7, 3, 1, DAY)]
    assert values(result.report) == [
        (1, 1, "Paper Moons"),
        (2, 2, "Paper Moons"),
        (7, 1, "Red Lanterns"),
        (4, 2, "Red Lanterns"),
    ]
    nowhere = recipes.stock_first_store(
        shop["inventory"], shop["store"].limit(0), shop["film"].where("film_id = 4"), seed, DAY
    )
    assert nowhere.changes["inventory"].affected.count() == 0


def people(shop):
    return [shop[n] for n in ("customer", "rental", "payment")]


def test_retarget_customer(shop):
    preview = recipes.preview_customer(*people(shop), MAIL)
    assert [r.customer_id for r in preview.collect()] == [2]
    result = recipes.retarget_customer(*people(shop), shop["store"], shop["address"], "Pat", "Lee", MAIL, as_of=DAY)
    assert values(result.report) == [(2, "Pat", "Lee", MAIL, 1, 1, DAY)]
    assert preview.count() == result.changes["customer"].affected.count()
    changed = result.table("customer")
    assert changed.count() == 5
    # The second run finds the same customer by e-mail, whatever the counts are now.
    rerun = recipes.preview_customer(changed, shop["rental"].limit(0), shop["payment"], MAIL.upper())
    assert [r.customer_id for r in rerun.collect()] == [2]


def test_retarget_without_anyone_eligible(shop):
    result = recipes.retarget_customer(
        *people(shop), shop["store"], shop["address"], "Pat", "Lee", MAIL, least=1000, as_of=DAY
    )
    assert result.report.count() == 0
    assert bag(result.table("customer")) == bag(shop["customer"])


def test_purge_customer(shop):
    preview = recipes.preview_purge(*people(shop), "JAN@example.com")
    assert bag(preview) == [("payment", 43), ("rental", 43)]
    result = recipes.purge_customer(*people(shop), "JAN@example.com")
    assert bag(result.report) == bag(preview)
    assert result.table("rental").count() == shop["rental"].count() - 43
    assert bag(recipes.preview_purge(shop["customer"], result.table("rental"), result.table("payment"), "JAN@example.com")) == [
        ("payment", 0),
        ("rental", 0),
    ]


def test_rent_and_pay(spark, shop):
    seed = spark.createDataFrame(
        [("PAPER MOONS", ts("2017-06-10 10:00:00")), ("Under Glass", ts("2017-06-11 11:00:00")), ("Tin Roofs", ts("2017-06-12"))],
        "title STRING, rental_date TIMESTAMP_NTZ",
    )
    tables = [shop[n] for n in ("customer", "staff", "film", "inventory", "rental", "payment")]
    result = recipes.rent_and_pay(*tables, seed, "jan@example.com", DAY)
    rented = result.changes["rental"].affected
    assert bag(rented.select("rental_id", "inventory_id", "customer_id", "return_date", "staff_id")) == [
        (129, 1, 2, ts("2017-06-13 10:00:00"), 1),
        (130, 5, 2, ts("2017-06-14 11:00:00"), 1),
    ]
    assert values(result.report) == [
        ("Paper Moons", 129, ts("2017-06-10 10:00:00"), 135, D("2.99"), ts("2017-06-10 10:00:00")),
        ("Under Glass", 130, ts("2017-06-11 11:00:00"), 136, D("3.99"), ts("2017-06-11 11:00:00")),
    ]
    again = recipes.rent_and_pay(*tables[:4], result.table("rental"), result.table("payment"), seed, "jan@example.com", DAY)
    assert again.report.count() == 0


def test_new_and_touched_rental(shop):
    noon = F.lit(ts("2024-05-01 12:00:00")).cast("timestamp_ntz")
    made = recipes.add_rental_now(shop["rental"], noon, 2, 2, 1)
    assert bag(made.affected) == [
        (129, ts("2024-05-01 12:00:00"), 2, 2, ts("2024-05-03 12:00:00"), 1, ts("2024-05-01 12:00:00"))
    ]
    later = F.lit(ts("2024-05-02 00:00:00")).cast("timestamp_ntz")
    touched = recipes.touch_latest_rental(made.table, later)
    assert [(r.rental_id, r.last_update) for r in touched.affected.collect()] == [(129, ts("2024-05-02 00:00:00"))]


def test_add_load_date(shop):
    tables = {n: shop[n] for n in ("store", "staff")}
    once = recipes.add_load_date(tables, DAY)
    twice = recipes.add_load_date({n: c.table for n, c in once.items()}, dt.date(2030, 1, 1))
    assert {r.record_ts for r in once["staff"].table.collect()} == {DAY}
    assert all(change.affected.count() == 0 for change in twice.values())
