"""Table-change tasks over the film-rental tables.

Each recipe takes the current tables as DataFrames and returns the changed
tables with the rows it affected. Steps that build on earlier inserts read the
table with those inserts in it, so that one run links everything it added; pass
older DataFrames to the operators themselves for any other reading.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rentledger.functions import RATINGS, add_days, asc, eq_ci_null_as_empty, member_of, number_after, within
from rentledger.operators.aggregates import count_report, eligible
from rentledger.operators.changes import (
    ChangeResult,
    delete_using,
    delete_where,
    evolve,
    insert_chain,
    insert_if_absent,
    insert_rows,
    pick_target,
    update_where,
)
from rentledger.operators.joins import eq_scalar, resolve_keys, semi_join, with_one_row
from rentledger.operators.ordering import order
from rentledger.operators.policy import policy_leaks, visible_rows
from rentledger.plans.fleet import LOAD_DATE
from rentledger.sources.shared import durable
from rentledger.sources.tables import create_as, row_count, sequence_table, table_size, truncate


# Years a film can be from, unless the caller says otherwise. The bounds are a choice of this library.
FILM_YEARS = (1880, 2200)


@dataclass(frozen=True)
class RecipeResult:
    """Changes by table name, and the rows the task reports."""

    changes: Mapping[str, ChangeResult]
    report: DataFrame

    def table(self, name: str) -> DataFrame:
        return self.changes[name].table


def _today(as_of: dt.date | None) -> Column:
    return F.current_date() if as_of is None else F.lit(as_of)


def _titles_of(film: DataFrame, seed: DataFrame, title: str = "title") -> DataFrame:
    """Films whose title is in the seed, without regard to case."""
    return semi_join(film, seed, [F.upper("title")], [F.upper(title)])


def add_films(
    film: DataFrame,
    film_category: DataFrame,
    category: DataFrame,
    language: DataFrame,
    seed: DataFrame,
    language_name: str = "English",
    as_of: dt.date | None = None,
    ratings: Sequence[str] = RATINGS,
    years: tuple[int, int] = FILM_YEARS,
) -> RecipeResult:
    """Insert seed films that are new by title and year, then link every seed film to its category.

    The seed has the film's columns and `category_name`. A rating that is not
    listed, or a year outside `years`, is an error.
    """
    seed = seed.withColumns(
        {"release_year": within(F.col("release_year"), *years), "rating": member_of(F.col("rating"), ratings)}
    )
    spoken = language.where(F.col("name") == language_name).select("language_id")
    described = with_one_row(seed.drop("category_name"), spoken).withColumn("last_update", _today(as_of))
    films = insert_if_absent(
        film,
        described,
        on=[F.upper("title"), "release_year"],
        id_column="film_id",
        id_order=["title", "release_year"],
    )
    wanted = seed.select("title", "release_year", "category_name")
    targets = films.table.select("film_id", F.upper("title").alias("_title"), "release_year").join(
        wanted.select(F.upper("title").alias("_title"), "release_year", "category_name"), ["_title", "release_year"]
    )
    links = resolve_keys(targets, category, {"category_name": "name"}, {"category_id": "category_id"})
    linked = insert_if_absent(
        film_category,
        links.select("film_id", "category_id", _today(as_of).alias("last_update")),
        on=["film_id", "category_id"],
    )
    shown = _titles_of(films.table, seed).select(
        "film_id", "title", "release_year", "rental_duration", "rental_rate"
    )
    return RecipeResult({"film": films, "film_category": linked}, order(shown, [asc("title")], ["film_id"]))


def add_actors(
    actor: DataFrame, film_actor: DataFrame, film: DataFrame, seed: DataFrame, as_of: dt.date | None = None
) -> RecipeResult:
    """Insert seed actors that are new by name, then link every seed actor to the seed film.

    The seed has `movie_title`, `first_name` and `last_name`.
    """
    names = seed.select("first_name", "last_name", _today(as_of).alias("last_update"))
    actors = insert_if_absent(
        actor,
        names,
        on=[F.upper("first_name"), F.upper("last_name")],
        distinct=True,
        id_column="actor_id",
        id_order=["last_name", "first_name"],
        unique_order=True,
    )
    cast = seed.select(
        "movie_title", F.upper("first_name").alias("_first"), F.upper("last_name").alias("_last")
    )
    people = actors.table.select(
        "actor_id",
        "first_name",
        "last_name",
        F.upper("first_name").alias("_first"),
        F.upper("last_name").alias("_last"),
    )
    titled = film.select("film_id", F.upper("title").alias("_title"))
    pairs = (
        cast.join(people, ["_first", "_last"])
        .withColumn("_title", F.upper("movie_title"))
        .join(titled, "_title")
        .select("movie_title", "first_name", "last_name", "actor_id", "film_id")
    )
    linked = insert_if_absent(
        film_actor,
        pairs.select("actor_id", "film_id", _today(as_of).alias("last_update")),
        on=["actor_id", "film_id"],
    )
    report = order(pairs, [asc("movie_title"), asc("last_name"), asc("first_name")], ["actor_id", "film_id"])
    return RecipeResult({"actor": actors, "film_actor": linked}, report)


def stock_first_store(
    inventory: DataFrame, store: DataFrame, film: DataFrame, seed: DataFrame, as_of: dt.date | None = None
) -> RecipeResult:
    """Add one copy of every seed film to the store with the smallest id, unless it has one."""
    first = store.agg(F.min("store_id").alias("store_id"))
    wanted = with_one_row(_titles_of(film, seed).select("film_id"), first)
    copies = insert_if_absent(
        inventory,
        wanted.withColumn("last_update", _today(as_of)),
        on=["film_id", "store_id"],
        id_column="inventory_id",
        id_order=["film_id"],
        unique_order=True,
    )
    held = copies.table.join(_titles_of(film, seed).select("film_id", "title"), "film_id")
    report = order(
        held.select("inventory_id", "store_id", "title"), [asc("title"), asc("store_id")], ["inventory_id"]
    )
    return RecipeResult({"inventory": copies}, report)


def choose_customer(
    customer: DataFrame, rental: DataFrame, payment: DataFrame, email: str, least: int = 43
) -> DataFrame:
    """One-row relation: the customer with this e-mail, else the first one with enough rentals and payments."""
    regulars = eligible(
        customer.select("customer_id"),
        "customer_id",
        [(rental, "customer_id", least), (payment, "customer_id", least)],
    )
    return pick_target(customer, "customer_id", eq_ci_null_as_empty(F.col("email"), F.lit(email)), regulars)


def preview_customer(
    customer: DataFrame, rental: DataFrame, payment: DataFrame, email: str, least: int = 43
) -> DataFrame:
    """The row that `retarget_customer` would change."""
    target = choose_customer(customer, rental, payment, email, least)
    return eq_scalar(customer, "customer_id", target).select(
        "customer_id", "first_name", "last_name", "email", "address_id", "store_id"
    )


def retarget_customer(
    customer: DataFrame,
    rental: DataFrame,
    payment: DataFrame,
    store: DataFrame,
    address: DataFrame,
    first_name: str,
    last_name: str,
    email: str,
    least: int = 43,
    as_of: dt.date | None = None,
) -> RecipeResult:
    """Give the chosen customer a new name and e-mail, the first address and the first store."""
    target = choose_customer(customer, rental, payment, email, least)
    values = {
        "first_name": F.lit(first_name),
        "last_name": F.lit(last_name),
        "email": F.lit(email),
        "address_id": address.agg(F.min("address_id")).scalar(),
        "store_id": store.agg(F.min("store_id")).scalar(),
        "last_update": _today(as_of),
    }
    changed = update_where(customer, F.col("customer_id") == target.scalar(), values)
    return RecipeResult({"customer": changed}, changed.affected.select("customer_id", *values))


def _with_email(customer: DataFrame, email: str) -> DataFrame:
    return customer.where(eq_ci_null_as_empty(F.col("email"), F.lit(email)))


def preview_purge(customer: DataFrame, rental: DataFrame, payment: DataFrame, email: str) -> DataFrame:
    """How many payments and rentals `purge_customer` would delete."""
    owner = durable(_with_email(customer, email).select("customer_id"))
    facts = {"payment": payment, "rental": rental}
    return count_report({name: semi_join(fact, owner, ["customer_id"], unique="right") for name, fact in facts.items()})


def purge_customer(customer: DataFrame, rental: DataFrame, payment: DataFrame, email: str) -> RecipeResult:
    """Delete the payments, then the rentals, of the customers with this e-mail."""
    owner = durable(_with_email(customer, email).select("customer_id"))  # few rows, and known to be few
    payments = delete_using(payment, owner, ["customer_id"], unique="right")
    rentals = delete_using(rental, owner, ["customer_id"], unique="right")
    report = count_report({"payment": payments.affected, "rental": rentals.affected})
    return RecipeResult({"payment": payments, "rental": rentals}, report)


def rent_and_pay(
    customer: DataFrame,
    staff: DataFrame,
    film: DataFrame,
    inventory: DataFrame,
    rental: DataFrame,
    payment: DataFrame,
    seed: DataFrame,
    email: str,
    as_of: dt.date | None = None,
) -> RecipeResult:
    """Rent the seed films (`title`, `rental_date`) to one customer and pay for the rentals just made.

    The films come from the copies in the customer's store and the rentals are
    booked by that store's first staff member.
    """
    renter = _with_email(customer, email).select("customer_id", "store_id")
    clerks = (
        semi_join(staff, renter, ["store_id"]).groupBy("store_id").agg(F.min("staff_id").alias("staff_id"))
    )
    booked_by = durable(renter.join(clerks, "store_id"))  # known to be few, so copies are cut to their store without a shuffle
    stocked = inventory.select("inventory_id", "film_id", "store_id").join(booked_by, "store_id")
    copies = _titles_of(film, seed).select("film_id", "title", "rental_duration", "rental_rate").join(stocked, "film_id")
    wanted = (
        seed.select(F.upper("title").alias("_title"), "rental_date")
        .join(copies.withColumn("_title", F.upper("title")), "_title")
        .select(
            "rental_date",
            "inventory_id",
            "customer_id",
            add_days(F.col("rental_date"), F.col("rental_duration")).alias("return_date"),
            "staff_id",
            _today(as_of).cast(rental.schema["last_update"].dataType).alias("last_update"),
        )
    )
    rentals = insert_if_absent(
        rental,
        wanted,
        on=["customer_id", "inventory_id", "rental_date"],
        id_column="rental_id",
        id_order=["rental_date", "inventory_id", "customer_id"],
    )
    priced = inventory.select("inventory_id", "film_id").join(film.select("film_id", "title", "rental_rate"), "film_id")

    def bills(inserted: DataFrame) -> DataFrame:
        return inserted.join(priced, "inventory_id").select(
            "customer_id",
            "staff_id",
            "rental_id",
            F.col("rental_rate").alias("amount"),
            F.col("rental_date").alias("payment_date"),
        )

    payments = insert_chain(
        rentals,
        payment,
        bills,
        on=["rental_id", "customer_id"],
        id_column="payment_id",
        id_order=["rental_id"],
        unique_order=True,
    )
    pairs = (
        rentals.affected.select("rental_id", "rental_date", "inventory_id")
        .join(payments.affected.select("rental_id", "payment_id", "amount", "payment_date"), "rental_id")
        .join(priced.select("inventory_id", "title"), "inventory_id")
        .select("title", "rental_id", "rental_date", "payment_id", "amount", "payment_date")
    )
    report = order(pairs, [asc("rental_date"), asc("title")], ["rental_id"])
    return RecipeResult({"rental": rentals, "payment": payments}, report)


def add_rental_now(rental: DataFrame, moment: Column, copy: int, customer: int, clerk: int) -> ChangeResult:
    """One new rental that starts at `moment` and is due two days later."""
    new = rental.sparkSession.range(1).select(
        moment.alias("rental_date"),
        F.lit(copy).alias("inventory_id"),
        F.lit(customer).alias("customer_id"),
        (moment + F.expr("INTERVAL 2 DAYS")).alias("return_date"),
        F.lit(clerk).alias("staff_id"),
        moment.alias("last_update"),
    )
    return insert_rows(rental, new, id_column="rental_id")


def touch_latest_rental(rental: DataFrame, moment: Column) -> ChangeResult:
    """Stamp the rental with the largest id."""
    newest = rental.agg(F.max("rental_id")).scalar()
    return update_where(rental, F.col("rental_id") == newest, {"last_update": moment})


def add_load_date(
    tables: Mapping[str, DataFrame], as_of: dt.date | None = None, column: str = LOAD_DATE
) -> dict[str, ChangeResult]:
    """Give every table a load date and fill it where it is missing."""
    return {name: evolve(table, column, "date", _today(as_of)) for name, table in tables.items()}


# Fixed value: text in front of the number in the bulk table.
BULK_PREFIX = "veeeeeeery_long_string"


def bulk_lifecycle(spark: SparkSession, n: int, folder: str, prefix: str = BULK_PREFIX) -> DataFrame:
    """Generate n rows, delete every third, empty the table; rows, bytes and size after each step.

    Each step stores a new snapshot below `folder`.
    """
    made = create_as(sequence_table(spark, n, prefix), f"{folder}/made")
    kept = create_as(delete_where(made, number_after(F.col("col"), prefix) % 3 == 0).table, f"{folder}/kept")
    emptied = create_as(truncate(kept), f"{folder}/emptied")
    steps = [("made", made), ("kept", kept), ("emptied", emptied)]
    report = None
    for position, (name, table) in enumerate(steps):
        size = table_size(spark, f"{folder}/{name}", name)
        step = with_one_row(size, row_count(table)).withColumn("step", F.lit(position))
        report = step if report is None else report.unionByName(step)
    return report


def principal_access(
    entity: DataFrame, facts: Mapping[str, DataFrame], principal: str, key: str = "customer_id"
) -> DataFrame:
    """Per fact: rows the principal sees, and how many of those belong to somebody else."""
    seen = {name: visible_rows(fact, entity, principal, key) for name, fact in facts.items()}
    visible = count_report(seen).withColumnRenamed("row_count", "visible")
    leaks = count_report({name: policy_leaks(table, entity, principal, key) for name, table in seen.items()})
    return visible.join(leaks.withColumnRenamed("row_count", "leaked"), "table_name")
