"""Hand-made tables. All names are invented."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

D = Decimal


def ts(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def values(df: DataFrame) -> list[tuple]:
    """Rows as plain tuples, in the order they come."""
    return [tuple(row) for row in df.collect()]


def bag(df: DataFrame) -> list[tuple]:
    """Rows as plain tuples, order ignored."""
    return sorted(values(df), key=repr)


def film_rental(spark: SparkSession) -> dict[str, DataFrame]:
    def table(ddl: str, data: list[tuple]) -> DataFrame:
        return spark.createDataFrame(data, ddl)

    tables = {}
    day = dt.date(2020, 1, 1)
    tables["film"] = table(
        "film_id BIGINT, title STRING, description STRING, release_year INT, language_id BIGINT, "
        "rental_duration INT, rental_rate DECIMAL(4,2), length INT, replacement_cost DECIMAL(5,2), rating STRING, "
        "last_update DATE, special_features ARRAY<STRING>",
        [
            (1, "Paper Moons", None, 2017, 1, 3, D("2.99"), 90, D("9.99"), "G", day, ["Trailers"]),
            (2, "Quiet Rivers", None, 2018, 1, 4, D("0.99"), 91, D("9.99"), "PG", day, None),
            (3, "Red Lanterns", None, 2019, 1, 5, D("4.99"), 92, D("9.99"), "PG-13", day, None),
            (4, "Silver Birds", None, None, 1, 6, D("3.99"), 93, D("9.99"), "R", day, None),
            (5, "Tin Roofs", None, 2010, 1, 7, D("3.99"), 94, D("9.99"), "NC-17", day, None),
            (6, "Under Glass", None, 2018, 2, 3, D("3.99"), 95, D("9.99"), None, day, None),
            (7, "Velvet Fields", None, 2015, 2, 3, D("1.99"), 96, D("9.99"), "XX", day, None),
        ],
    )
    tables["category"] = table(
        "category_id BIGINT, name STRING",
        [(1, "Animation"), (2, "Drama"), (3, "Travel"), (4, "Documentary"), (5, "ANIMATION"), (6, "Music")],
    )
    tables["film_category"] = table(
        "film_id BIGINT, category_id BIGINT, last_update DATE",
        [(1, 1, day), (1, 5, day), (2, 1, day), (3, 5, day), (4, 2, day), (6, 2, day), (6, 3, day), (7, 6, day)],
    )
    tables["language"] = table("language_id BIGINT, name STRING", [(1, "English"), (2, "French")])
    tables["actor"] = table(
        "actor_id BIGINT, first_name STRING, last_name STRING, last_update DATE",
        [
            (1, "Ann", "Reed", day),
            (2, "Ann", "Reed", day),
            (3, "Bo", "Stone", day),
            (4, "Cy", "Tall", day),
            (5, "Di", "Unlinked", day),
        ],
    )
    tables["film_actor"] = table(
        "actor_id BIGINT, film_id BIGINT, last_update DATE",
        [(1, 1, day), (1, 2, day), (2, 3, day), (2, 6, day), (3, 5, day), (3, 7, day), (4, 99, day)],
    )
    tables["address"] = table(
        "address_id BIGINT, address STRING, address2 STRING",
        [(1, "1 Elm", None), (2, "2 Oak", ""), (3, "3 Fir", "Flat 3")],
    )
    tables["store"] = table("store_id BIGINT, address_id BIGINT", [(1, 1), (2, 2), (3, 3)])
    tables["staff"] = table(
        "staff_id BIGINT, first_name STRING, last_name STRING, store_id BIGINT",
        [(1, "Eve", "Ames", 1), (2, "Flo", "Bell", 1), (3, "Gus", "Cobb", 2), (4, "Hal", "Dunn", None)],
    )
    tables["customer"] = table(
        "customer_id BIGINT, store_id BIGINT, first_name STRING, last_name STRING, email STRING, address_id BIGINT, "
        "last_update DATE",
        [
            (1, 2, "Ivy", "Eads", None, 3, day),
            (2, 1, "JAN", "FOY", "jan@example.com", 2, day),
            (3, 1, "Kay", "O'Hara", "kay@example.com", 1, day),
            (4, 2, "Twin", "Name", "twin1@example.com", 1, day),
            (5, 2, "Twin", "Name", "twin2@example.com", 1, day),
        ],
    )
    tables["inventory"] = table(
        "inventory_id BIGINT, film_id BIGINT, store_id BIGINT, last_update DATE",
        [(1, 1, 1, day), (2, 1, 2, day), (3, 2, 1, day), (4, 3, 2, day), (5, 6, 1, day), (6, 7, 1, day)],
    )
    moment = ts("2017-03-01 00:00:00")
    rentals, payments = [], []
    for customer, n_rentals, n_payments in ((1, 42, 43), (2, 43, 43), (3, 43, 42)):
        for i in range(n_rentals):
            rentals.append((len(rentals) + 1, moment, 1 + i % 6, customer, None, 1, moment))
        for i in range(n_payments):
            payments.append((len(payments) + 1, customer, 1, None, D("1.00"), moment))
    late = [
        (1, D("10.00"), "2017-04-01 00:00:00"),
        (1, D("5.00"), "2017-12-31 23:59:59"),
        (2, D("99.00"), "2018-01-01 00:00:00"),
        (4, D("7.50"), "2017-06-01 00:00:00"),
        (4, D("0.50"), "2017-06-01 00:00:00"),
        (3, D("3.00"), "2017-03-31 23:59:59"),
    ]
    for staff, amount, at in late:
        payments.append((len(payments) + 1, 4, staff, None, amount, ts(at)))
    tables["rental"] = table(
        "rental_id BIGINT, rental_date TIMESTAMP_NTZ, inventory_id BIGINT, customer_id BIGINT, "
        "return_date TIMESTAMP_NTZ, staff_id BIGINT, last_update TIMESTAMP_NTZ",
        rentals,
    )
    tables["payment"] = table(
        "payment_id BIGINT, customer_id BIGINT, staff_id BIGINT, rental_id BIGINT, amount DECIMAL(5,2), "
        "payment_date TIMESTAMP_NTZ",
        payments,
    )
    return tables


def fleet_seeds(spark: SparkSession) -> dict[str, DataFrame]:
    """A few rows for each fleet table, with natural keys.

    One vehicle has two trips, one of them still open and without a reservation; one
    trip ends within its first minute; one vehicle names a type that is not there.
    """

    def table(ddl: str, data: list[tuple]) -> DataFrame:
        return spark.createDataFrame(data, ddl)

    kim, lou = "kim@mail.test", "lou@mail.test"
    fix, see = "fix@depot.test", "see@depot.test"
    red, blue = "CH-RED-1", "CH-BLUE-2"
    booked, quick, still = ts("2031-08-09 18:00:00"), ts("2031-08-10 00:30:00"), ts("2031-09-01 21:40:00")
    opened, checked = ts("2031-07-07 14:20:00"), ts("2031-07-30 10:10:00")
    return {
        "vehicle_type": table("type_name STRING, description STRING", [("Tandem", "two seats"), ("Cargo", None)]),
        "app_user": table(
            "first_name STRING, last_name STRING, email STRING, phone_number STRING, driver_license_no STRING, "
            "registered_at TIMESTAMP",
            [
                ("Kim", "Umber", kim, "+0 11", "K-11", ts("2030-11-11 11:11:11")),
                ("Lou", "Vale", lou, "+0 22", "L-22", ts("2031-02-02 22:22:22")),
            ],
        ),
        "employee": table(
            "first_name STRING, last_name STRING, email STRING, phone_number STRING, job_title STRING, hired_at DATE",
            [
                ("Ira", "Wick", fix, None, "Mender", dt.date(2027, 10, 3)),
                ("Max", "Yew", see, None, "Examiner", dt.date(2028, 12, 30)),
            ],
        ),
        "vehicle": table(
            "type_name STRING, vin STRING, registration_plate STRING, brand STRING, model STRING, production_year INT, "
            "commissioned_at DATE, current_odometer_km DECIMAL(12,2)",
            [
                ("Tandem", red, "RD 1", "Velox", "T", 2022, dt.date(2022, 9, 9), D("7.25")),
                ("Cargo", blue, "BL 2", "Velox", "C", 2024, None, D("0.00")),
                ("Rickshaw", "CH-GREY-3", "GY 3", "Velox", "R", 2024, None, D("1.00")),
            ],
        ),
        "maintenance_event": table(
            "vin STRING, maintenance_type STRING, opened_at TIMESTAMP, completed_at TIMESTAMP, "
            "odometer_km DECIMAL(12,2), maintenance_status STRING, cost_amount DECIMAL(10,2)",
            [
                (red, "Chain", opened, ts("2031-07-09 02:00:00"), D("3.00"), "completed", D("12.34")),
                (blue, "Lamp", ts("2031-10-31 23:59:00"), None, D("0.00"), "planned", None),
            ],
        ),
        "inspection_event": table(
            "vin STRING, employee_email STRING, inspection_type STRING, inspection_result STRING, notes STRING, "
            "inspected_at TIMESTAMP, odometer_km DECIMAL(12,2)",
            [
                (red, see, "Frame", "passed", None, ts("2031-01-15 19:05:00"), D("1.75")),
                (blue, see, "Frame", "failed", "bent fork", checked, D("0.00")),
            ],
        ),
        "reservation": table(
            "user_email STRING, vin STRING, reserved_from TIMESTAMP, reserved_until TIMESTAMP, created_at TIMESTAMP, "
            "cancelled_at TIMESTAMP",
            [
                (kim, red, booked, ts("2031-08-09 23:00:00"), ts("2031-06-01 04:00:00"), None),
                (lou, red, quick, ts("2031-08-10 01:00:00"), ts("2031-08-09 20:00:00"), None),
            ],
        ),
        "trip": table(
            "user_email STRING, vin STRING, reservation_from TIMESTAMP, started_at TIMESTAMP, ended_at TIMESTAMP, "
            "start_odometer_km DECIMAL(12,2), end_odometer_km DECIMAL(12,2), total_cost DECIMAL(10,2)",
            [
                (kim, red, booked, ts("2031-08-09 18:03:00"), ts("2031-08-09 20:20:59"), D("7.25"), D("19.00"), D("8.80")),
                (lou, red, quick, ts("2031-08-10 00:31:00"), ts("2031-08-10 00:31:42"), D("19.00"), D("19.00"), D("0.00")),
                (kim, blue, None, still, None, D("0.00"), None, None),
            ],
        ),
        "payment": table(
            "user_email STRING, vin STRING, trip_started_at TIMESTAMP, amount DECIMAL(10,2), payment_method STRING, "
            "payment_status STRING, paid_at TIMESTAMP",
            [
                (kim, red, ts("2031-08-09 18:03:00"), D("8.80"), "card", "paid", ts("2031-08-11 06:30:00")),
                (lou, red, ts("2031-08-10 00:31:00"), D("0.00"), "wallet", "pending", None),
            ],
        ),
        "rating": table(
            "user_email STRING, vin STRING, trip_started_at TIMESTAMP, score INT, comment_text STRING",
            [
                (kim, red, ts("2031-08-09 18:03:00"), 2, "squeaks"),
                (lou, red, ts("2031-08-10 00:31:00"), 3, None),
            ],
        ),
        "maintenance_event_employee": table(
            "vin STRING, opened_at TIMESTAMP, employee_email STRING, assigned_role STRING",
            [(red, opened, fix, "Lead"), (red, opened, see, "Witness")],
        ),
        "vehicle_status_history": table(
            "vin STRING, status_code STRING, reservation_from TIMESTAMP, trip_started_at TIMESTAMP, "
            "maintenance_opened_at TIMESTAMP, inspection_at TIMESTAMP, valid_from TIMESTAMP, valid_to TIMESTAMP",
            [
                (red, "maintenance", None, None, opened, None, opened, ts("2031-07-09 02:00:00")),
                (blue, "in_use", None, still, None, None, still, None),
                (blue, "inspection", None, None, None, checked, checked, ts("2031-07-30 12:00:00")),
            ],
        ),
    }
