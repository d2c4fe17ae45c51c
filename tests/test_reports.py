"""Each report against plain SQL in two other forms, and against rows worked out by hand."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

import pytest

from rentledger.plans import reports as rp
from tests.fixtures import bag, values


@pytest.fixture
def sql(spark, shop):
    for name, table in shop.items():
        table.createOrReplaceTempView(name)
    yield spark.sql
    for name in shop:
        spark.catalog.dropTempView(name)


def test_films_in_category(shop, sql):
    got = rp.films_in_category(shop["film"], shop["film_category"], shop["category"], "animation", (2017, 2019), 1)
    assert [r.title for r in got.collect()] == ["Paper Moons", "Red Lanterns"]
    columns = "title, release_year, rating, rental_rate"
    semi = f"""SELECT {columns} FROM film f WHERE release_year IN (2017, 2018, 2019) AND rental_rate > 1 AND EXISTS
        (SELECT 1 FROM film_category c JOIN category USING (category_id)
         WHERE c.film_id = f.film_id AND upper(name) = 'ANIMATION')"""
    joined = f"""SELECT DISTINCT film_id, {columns} FROM film JOIN film_category USING (film_id)
        JOIN category USING (category_id)
        WHERE lower(name) = 'animation' AND release_year BETWEEN 2017 AND 2019 AND rental_rate > 1"""
    assert bag(got) == bag(sql(semi)) == bag(sql(joined).drop("film_id"))


def test_revenue_per_store(shop, sql):
    day = dt.date(2017, 4, 1)
    got = rp.revenue_per_store(shop["store"], shop["address"], shop["staff"], shop["payment"], day)
    assert values(got) == [("1 Elm", D("114.00")), ("2 Oak, ", D("0.00")), ("3 Fir, Flat 3", D("0.00"))]
    scalar = """SELECT concat_ws(', ', address, address2) address, coalesce((
        SELECT sum(amount) FROM payment JOIN staff USING (staff_id)
        WHERE staff.store_id = store.store_id AND payment_date >= DATE '2017-04-01'), 0) revenue
        FROM store JOIN address USING (address_id)"""
    joined = """WITH sold AS (SELECT store_id, sum(amount) FILTER (WHERE payment_date >= '2017-04-01') revenue
            FROM staff JOIN payment USING (staff_id) GROUP BY store_id)
        SELECT array_join(array(address, address2), ', '), nvl(revenue, 0)
        FROM store LEFT JOIN sold USING (store_id) JOIN address USING (address_id)"""
    assert bag(got) == bag(sql(scalar)) == bag(sql(joined))


def test_top_actors(shop, sql):
    got = rp.top_actors(shop["actor"], shop["film_actor"], shop["film"], 2015)
    assert values(got) == [("Ann", "Reed", 2), ("Ann", "Reed", 2), ("Bo", "Stone", 1)]
    joined = """SELECT first_name, last_name, n FROM actor JOIN (
            SELECT actor_id, size(collect_set(film_id)) n FROM film_actor
            WHERE film_id IN (SELECT film_id FROM film WHERE release_year >= 2015) GROUP BY actor_id) USING (actor_id)"""
    scalar = """SELECT * FROM (SELECT first_name, last_name, (SELECT count(DISTINCT f.film_id) FROM film_actor f
        JOIN film USING (film_id) WHERE f.actor_id = actor.actor_id AND release_year >= 2015) n FROM actor) WHERE n > 0"""
    assert bag(got) == bag(sql(joined)) == bag(sql(scalar))
    assert rp.top_actors(shop["actor"], shop["film_actor"], shop["film"], 2015, k=1).count() == 1


def test_genre_counts_per_year(shop, sql):
    names = {"drama": "Drama", "travel": "Travel", "documentary": "Documentary"}
    got = rp.genre_counts_per_year(shop["film"], shop["film_category"], shop["category"], names)
    assert values(got) == [
        (None, 1, 0, 0),
        (2019, 0, 0, 0),
        (2018, 1, 1, 0),
        (2017, 0, 0, 0),
        (2015, 0, 0, 0),
        (2010, 0, 0, 0),
    ]
    summed = """SELECT release_year, count_if(name = 'Drama'), count_if(name = 'Travel'), count_if(name = 'Documentary')
        FROM film LEFT JOIN film_category USING (film_id) LEFT JOIN category USING (category_id)
        GROUP BY release_year"""
    assert bag(got) == bag(sql(summed))


def test_top_staff(shop, sql):
    start, end = dt.date(2017, 1, 1), dt.date(2018, 1, 1)
    tables = [shop[name] for name in ("staff", "store", "address", "payment")]
    got = rp.top_staff(*tables, start, end)
    assert values(got) == [
        ("Eve", "Ames", "1 Elm", D("143.00")),
        ("Hal", "Dunn", "", D("8.00")),
        ("Gus", "Cobb", "2 Oak, ", D("3.00")),
    ]
    ranked = """WITH p AS (SELECT *, row_number() OVER (PARTITION BY staff_id
            ORDER BY payment_date DESC, payment_id DESC) place, sum(amount) OVER (PARTITION BY staff_id) total
            FROM payment WHERE year(payment_date) = 2017)
        SELECT first_name, last_name, concat_ws(', ', address, address2), total
        FROM p JOIN staff USING (staff_id) LEFT JOIN store USING (store_id) LEFT JOIN address USING (address_id)
        WHERE place = 1"""
    assert bag(got) == bag(sql(ranked))
    assert [r[1] for r in values(rp.top_staff(*tables, start, end, k=2))] == ["Ames", "Dunn"]


def test_revenue_with_latest_takes_one_shuffle_of_the_fact(shop):
    got = rp.revenue_with_latest(
        shop["payment"], "staff_id", "amount", ["payment_date", "payment_id"], {"last_payment": "payment_id"}
    )
    assert {r.staff_id: r.last_payment for r in got.collect()}[4] == 133
    plan = got._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("Join") == 0


def test_most_rented(shop, sql):
    got = rp.most_rented(shop["film"], shop["inventory"], shop["rental"])
    first = values(got)[0]
    assert first[:3] == ("Paper Moons", 44, "G") and first[3] == "All ages"
    assert {r.rating: r.expected_audience_age for r in got.collect()} == {
        "G": "All ages",
        "PG": "Parental guidance suggested",
        "PG-13": "13+",
        None: "Unknown",
        "XX": "Unknown",
    }
    counted = """SELECT title, n, rating FROM film JOIN (
            SELECT film_id, sum(1) n FROM inventory JOIN rental USING (inventory_id) GROUP BY film_id) USING (film_id)"""
    scalar = """SELECT title, (SELECT count(rental_id) FROM inventory i JOIN rental USING (inventory_id)
        WHERE i.film_id = film.film_id) n, rating FROM film
        WHERE film_id IN (SELECT film_id FROM inventory JOIN rental USING (inventory_id))"""
    assert bag(got.drop("expected_audience_age")) == bag(sql(counted)) == bag(sql(scalar))


def test_inactivity_gap(shop, sql):
    got = rp.inactivity_gap(shop["actor"], shop["film_actor"], shop["film"], dt.date(2024, 7, 1))
    assert values(got) == [
        ("Cy", "Tall", None, None),
        ("Bo", "Stone", 2015, 9),
        ("Ann", "Reed", 2018, 6),
        ("Ann", "Reed", 2019, 5),
    ]
    scalar = """SELECT first_name, last_name, y, 2024 - y FROM (SELECT first_name, last_name, (
        SELECT max(release_year) FROM film_actor fa JOIN film USING (film_id) WHERE fa.actor_id = actor.actor_id) y
        FROM actor WHERE actor_id IN (SELECT actor_id FROM film_actor))"""
    assert bag(got) == bag(sql(scalar))
