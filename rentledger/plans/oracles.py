"""SQL that says the same as each workload query, for an independent engine.

`stored_table_size` lists the files of the test tables at `SIZED_FOLDER`, as SQL has no other way to name a table's files.
"""

from __future__ import annotations

SIZED_FOLDER = "/root/testdata/sf0.01"

MONEY = "CAST({} AS DECIMAL(18,2))"

FILMS = f"""
    SELECT p_partkey AS film_id, p_name || ' ' || p_partkey AS title, p_size + 1970 AS release_year,
           p_size AS rental_duration, {MONEY.format('p_retailprice')} AS rental_rate, p_type AS rating,
           CAST(replace(p_brand, 'Brand#', '') AS INTEGER) AS category_id
    FROM part
"""

CUSTOMERS = """
    SELECT c_custkey AS customer_id, c_nationkey AS store_id, c_mktsegment AS first_name, c_name AS last_name,
           CASE WHEN c_acctbal >= 0 THEN lower(c_name) || '@example.com' END AS email, c_nationkey AS address_id
    FROM customer
"""

PRINCIPAL = r"""'client_' || regexp_replace(upper(first_name), '[^A-Z0-9]+', '_', 'g')
    || '_' || regexp_replace(upper(last_name), '[^A-Z0-9]+', '_', 'g')"""

OWNER = f"""(SELECT customer_id FROM ({CUSTOMERS})
             WHERE {PRINCIPAL} = 'client_MACHINERY_CUSTOMER_000000001')"""

ORACLES: dict[str, str] = {}

ORACLES["category_range_report"] = """
    SELECT c_name AS title, c_nationkey AS release_year, c_mktsegment AS rating, c_acctbal AS rental_rate
    FROM customer
    WHERE c_nationkey BETWEEN 5 AND 19 AND c_acctbal > 1
      AND c_nationkey IN (SELECT n_nationkey FROM nation JOIN region ON r_regionkey = n_regionkey
                          WHERE lower(r_name) = 'asia')
    ORDER BY c_name
"""

ORACLES["category_repeated_links"] = f"""
    SELECT title, release_year, rating, CAST(rental_rate AS DOUBLE) AS rental_rate
    FROM ({FILMS})
    WHERE release_year BETWEEN 1980 AND 2010 AND rental_rate > 1
      AND film_id IN (SELECT l_partkey FROM lineitem JOIN region ON r_regionkey = l_suppkey % 5 WHERE lower(r_name) = 'asia')
"""

ORACLES["zero_kept_revenue"] = f"""
    SELECT concat_ws(', ', n_name, r_name) AS address,
           CAST(coalesce(sum({MONEY.format('o_totalprice')}), 0) AS DOUBLE) AS revenue
    FROM nation
    JOIN region ON r_regionkey = n_regionkey
    LEFT JOIN customer ON c_nationkey = n_nationkey
    LEFT JOIN orders ON o_custkey = c_custkey AND o_orderdate >= DATE '2001-07-31'
    GROUP BY n_nationkey, n_name, r_name
    ORDER BY address
"""

ORACLES["top_by_distinct"] = """
    SELECT 'Supplier' AS first_name, s_name AS last_name, count(DISTINCT p_partkey) AS number_of_movies
    FROM supplier JOIN lineitem ON l_suppkey = s_suppkey JOIN part ON p_partkey = l_partkey
    WHERE p_size + 1970 >= 2000
    GROUP BY s_suppkey, s_name
    ORDER BY number_of_movies DESC, s_name, s_suppkey
    LIMIT 5
"""

ORACLES["counts_by_year_and_value"] = """
    SELECT CAST(extract(year FROM o_orderdate) AS INTEGER) AS release_year,
           CAST(sum(CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END) AS BIGINT) AS n_building,
           CAST(sum(CASE WHEN c_mktsegment = 'MACHINERY' THEN 1 ELSE 0 END) AS BIGINT) AS n_machinery,
           CAST(sum(CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 1 ELSE 0 END) AS BIGINT) AS n_household
    FROM orders LEFT JOIN customer ON c_custkey = o_custkey
    GROUP BY 1
    ORDER BY 1 DESC
"""

ORACLES["top_revenue_with_latest"] = f"""
    WITH period AS (
        SELECT * FROM orders WHERE o_orderdate >= DATE '1997-01-01' AND o_orderdate < DATE '1998-01-01'
    ), ranked AS (
        SELECT o_custkey, o_orderpriority,
               row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS place
        FROM period
    ), summed AS (
        SELECT o_custkey, sum({MONEY.format('o_totalprice')}) AS total FROM period GROUP BY o_custkey
    )
    SELECT c_name, o_orderpriority AS last_priority, CAST(total AS DOUBLE) AS total_revenue
    FROM summed JOIN ranked USING (o_custkey) JOIN customer ON c_custkey = o_custkey
    WHERE place = 1
    ORDER BY total DESC, c_name, c_custkey
    LIMIT 3
"""

ORACLES["top_staff_report"] = f"""
    WITH summed AS (
        SELECT l_suppkey, sum({MONEY.format('l_extendedprice')}) AS total
        FROM lineitem WHERE l_shipdate >= DATE '1997-01-01' AND l_shipdate < DATE '1998-01-01'
        GROUP BY l_suppkey
    )
    SELECT 'Supplier' AS first_name, s_name AS last_name, concat_ws(', ', n_name, r_name) AS last_store_address,
           CAST(total AS DOUBLE) AS total_revenue
    FROM summed JOIN supplier ON s_suppkey = l_suppkey
    LEFT JOIN nation ON n_nationkey = s_nationkey
    LEFT JOIN region ON r_regionkey = n_regionkey
    ORDER BY total DESC, s_name, s_suppkey
    LIMIT 3
"""

ORACLES["top_counts_labelled"] = """
    SELECT p_name AS title, count(l_orderkey) AS number_of_rentals, p_type AS rating,
           CASE p_type WHEN 'SMALL' THEN 'Compact' WHEN 'MEDIUM' THEN 'Regular' WHEN 'LARGE' THEN 'Bulky'
                       ELSE 'Unknown' END AS expected_audience_age
    FROM part JOIN lineitem ON l_partkey = p_partkey
    GROUP BY p_partkey, p_name, p_type
    ORDER BY number_of_rentals DESC, p_name, p_partkey
    LIMIT 5
"""

ORACLES["inactivity_gap_report"] = """
    SELECT c_mktsegment AS first_name, c_name AS last_name,
           CAST(max(extract(year FROM o_orderdate)) AS INTEGER) AS latest_release_year,
           CAST(2002 - max(extract(year FROM o_orderdate)) AS INTEGER) AS inactivity_gap_years
    FROM customer JOIN orders ON o_custkey = c_custkey
    GROUP BY c_custkey, c_mktsegment, c_name
"""

ORACLES["multi_fact_threshold"] = """
    SELECT c_custkey, c_name FROM customer
    JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) a ON a.o_custkey = c_custkey
    JOIN (SELECT o_custkey, count(*) AS n FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1) b
      ON b.o_custkey = c_custkey
    WHERE a.n >= 10 AND b.n >= 43
"""

ORACLES["pick_target_fallback"] = """
    SELECT 'fallback' AS way, min(o_custkey) AS c_custkey
    FROM (SELECT o_custkey FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1 HAVING count(*) >= 10)
    UNION ALL
    SELECT 'match', c_custkey FROM customer WHERE upper(c_name) = 'CUSTOMER#000000003'
"""

ORACLES["table_count_report"] = """
    SELECT 'customer' AS table_name, count(*) AS row_count FROM customer
    UNION ALL SELECT 'orders', count(*) FROM orders
    UNION ALL SELECT 'lineitem', count(*) FROM lineitem
    UNION ALL SELECT 'part', count(*) FROM part
    UNION ALL SELECT 'supplier', count(*) FROM supplier
"""

_BOTH = """
    SELECT c_custkey, c_name FROM customer
    WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND extract(year FROM o_orderdate) = 1995)
      AND EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND extract(year FROM o_orderdate) = 2001)
"""
ORACLES["exists_both"] = _BOTH
ORACLES["exists_both_first"] = _BOTH + " ORDER BY c_custkey LIMIT 1"

ORACLES["not_exists_unlabelled"] = """
    SELECT doc_id, lang FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)
"""

ORACLES["semi_join_repeated_keys"] = """
    SELECT o_orderkey, o_custkey FROM orders
    WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')
"""

ORACLES["latest_order_per_customer"] = """
    SELECT o_custkey, o_orderkey, o_orderdate, o_orderpriority FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
"""

ORACLES["grouped_aggregates"] = f"""
    SELECT o_orderstatus, CAST(sum({MONEY.format('o_totalprice')}) AS DOUBLE) AS total, count(*) AS n_rows,
           count(o_orderpriority) AS n_priorities, count(DISTINCT o_custkey) AS n_customers,
           min(o_orderdate) AS first_date, max(o_orderdate) AS last_date, CAST(0 AS DOUBLE) AS nothing
    FROM orders GROUP BY o_orderstatus
"""

ORACLES["counts_by_value"] = """
    SELECT l_returnflag, CAST(sum((l_linestatus = 'O')::INT) AS BIGINT) AS n_o,
           CAST(sum((l_linestatus = 'F')::INT) AS BIGINT) AS n_f, CAST(sum((l_linestatus = 'X')::INT) AS BIGINT) AS n_x
    FROM lineitem GROUP BY l_returnflag
"""

ORACLES["distinct_rows"] = "SELECT DISTINCT l_suppkey, l_partkey FROM lineitem"

ORACLES["group_by_id_show_name"] = """
    SELECT p_name, count(*) AS n_lines FROM part JOIN lineitem ON l_partkey = p_partkey GROUP BY p_partkey, p_name
"""

ORACLES["top_orders"] = "SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderdate, o_orderkey LIMIT 10"

ORACLES["first_customers"] = "SELECT * FROM customer ORDER BY c_custkey LIMIT 10"

ORACLES["inline_rows"] = """
    SELECT meaning, count(*) AS n_lines
    FROM lineitem JOIN (VALUES ('A', 'accepted'), ('R', 'returned'), ('Z', NULL)) v(flag, meaning) ON flag = l_returnflag
    GROUP BY meaning
"""

ORACLES["bridge_join"] = """
    SELECT s_name, p_type, count(DISTINCT (s_suppkey, p_partkey)) AS n_parts
    FROM supplier JOIN lineitem ON l_suppkey = s_suppkey JOIN part ON p_partkey = l_partkey
    GROUP BY s_name, p_type
"""

ORACLES["lookup_chain"] = f"""
    SELECT r_name, CAST(sum({MONEY.format('l_extendedprice')}) AS DOUBLE) AS revenue,
           CAST(count(DISTINCT o_orderkey) AS BIGINT) AS n_orders
    FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey
    LEFT JOIN customer ON c_custkey = o_custkey
    LEFT JOIN nation ON n_nationkey = c_nationkey
    LEFT JOIN region ON r_regionkey = n_regionkey
    GROUP BY r_name
"""

ORACLES["left_join_filter_in_on"] = """
    SELECT c_custkey, c_name, o_orderkey, o_orderdate
    FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderdate >= DATE '2001-06-01'
"""

ORACLES["composite_key_join"] = """
    SELECT o_custkey, o_orderdate, o_orderkey FROM orders
    QUALIFY o_orderdate = max(o_orderdate) OVER (PARTITION BY o_custkey)
"""

ORACLES["correlated_aggregates"] = f"""
    SELECT c_custkey,
           (SELECT CAST(sum({MONEY.format('o_totalprice')}) AS DOUBLE) FROM orders
            WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT') AS urgent_total,
           (SELECT max(o_orderdate) FROM orders
            WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT') AS urgent_last,
           (SELECT count(*) FROM orders
            WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT') AS n_urgent
    FROM customer
"""

ORACLES["one_row_join"] = """
    SELECT c_custkey, first_date, last_date
    FROM customer, (SELECT min(o_orderdate) AS first_date, max(o_orderdate) AS last_date FROM orders)
"""

ORACLES["compare_with_scalar"] = "SELECT * FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)"

ORACLES["case_insensitive_join"] = """
    SELECT s_suppkey, 'nation_' || s_nationkey AS nation, n_nationkey
    FROM supplier JOIN nation ON upper(n_name) = upper('nation_' || s_nationkey)
"""

ORACLES["natural_key_lookup"] = """
    SELECT o_orderkey, c_name AS customer_name, c_custkey
    FROM orders JOIN customer ON c_name = printf('Customer#%09d', o_orderkey)
"""

ORACLES["optional_key_lookup"] = """
    SELECT source, count(*) AS n_documents, count(l.doc_id) AS n_labels
    FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id GROUP BY source
"""

ORACLES["predicate_counts"] = """
    SELECT count(*) FILTER (p_brand = 'Brand#2') AS equal_literal,
           count(*) FILTER (upper(p_type) = upper('economy')) AS equal_ci,
           count(*) FILTER (upper(coalesce(nullif(p_type, 'ECONOMY'), '')) = '') AS null_safe_ci,
           count(*) FILTER (p_size BETWEEN 10 AND 20) AS closed_range,
           count(*) FILTER (p_size > 10 AND p_retailprice <= 950 AND p_size <> 12) AS compared,
           count(*) FILTER (upper(p_type) IN ('SMALL', 'LARGE')) AS in_list,
           count(*) FILTER (nullif(p_size, 7) IS NULL) AS is_null,
           count(*) FILTER (nullif(p_size, 7) IS NULL OR p_size < 5) AS or_guard,
           count(*) FILTER (CAST(replace(p_brand, 'Brand#', '') AS BIGINT) % 3 = 0) AS parsed_number
    FROM part
"""

ORACLES["scalar_functions"] = """
    WITH t AS (SELECT *, CASE WHEN c_acctbal > 0 THEN c_mktsegment END AS maybe FROM customer)
    SELECT c_custkey, lower(c_name) AS lowered, concat_ws(', ', c_name, maybe) AS joined,
           c_name || '/' || maybe AS glued, replace(c_name, 'Customer#', 'C') AS replaced,
           regexp_replace(c_name, '[^A-Z0-9]+', '_', 'g') AS cleaned, coalesce(maybe, 'none') AS filled,
           CASE c_mktsegment WHEN 'BUILDING' THEN 'B' WHEN 'MACHINERY' THEN 'M' ELSE 'Unknown' END AS labelled,
           CAST(greatest(floor(c_acctbal), 0) AS BIGINT) AS clamped, CAST(power(c_nationkey, 2) AS DOUBLE) AS squared,
           (c_custkey + 7) % 5 AS remainder, CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR) AS as_text,
           array_to_string([c_name, c_mktsegment], '|') AS array_text, TRUE AS typed_null,
           c_mktsegment AS checked_text, c_nationkey AS checked_number
    FROM t
"""

ORACLES["date_functions"] = """
    SELECT o_orderkey, CAST(extract(year FROM o_orderdate) AS INTEGER) AS order_year,
           CAST(2002 - extract(year FROM o_orderdate) AS INTEGER) AS years_ago,
           o_orderdate + INTERVAL 2 DAY AS due,
           o_orderdate + CAST(o_orderkey % 10 AS INTEGER) * INTERVAL 1 DAY AS returned,
           o_orderdate >= DATE '2000-01-01' AS recent,
           CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day
    FROM orders
"""

ORACLES["zoned_moments"] = """
    WITH t AS (
        SELECT o_orderkey, o_orderdate, CASE WHEN o_orderkey % 5 = 0 THEN 0 ELSE
               (CASE WHEN o_orderkey % 3 = 0 THEN -1 ELSE 1 END) * ((o_orderkey % 11 + 1) * 60 + CASE WHEN o_orderkey % 2 = 0 THEN 30 ELSE 0 END) END AS ahead
        FROM orders
    )
    SELECT o_orderkey, o_orderdate - to_minutes(ahead) AS in_utc, o_orderdate - to_minutes(ahead - 120) AS two_ahead FROM t
"""

ORACLES["size_pretty_values"] = """
    WITH t AS (SELECT DISTINCT l_orderkey * l_partkey * l_suppkey * l_linenumber AS bytes FROM lineitem),
    u AS (SELECT bytes, (bytes + 512) // 1024 AS kb, (bytes + 524288) // 1048576 AS mb,
                 (bytes + 536870912) // 1073741824 AS gb FROM t)
    SELECT bytes, CASE WHEN bytes < 10240 THEN bytes || ' bytes' WHEN kb < 10240 THEN kb || ' kB'
                       WHEN mb < 10240 THEN mb || ' MB' WHEN gb < 10240 THEN gb || ' GB'
                       ELSE (bytes + 549755813888) // 1099511627776 || ' TB' END AS pretty
    FROM u
"""

ORACLES["stored_table_size"] = f"""
    WITH t AS (SELECT count(*) AS file_count, CAST(sum(size) AS BIGINT) AS total_bytes FROM read_blob('{SIZED_FOLDER}/lineitem.parquet')),
    u AS (SELECT *, (total_bytes + 512) // 1024 AS kb, (total_bytes + 524288) // 1048576 AS mb FROM t)
    SELECT 'lineitem' AS table_name, file_count, total_bytes,
           CASE WHEN total_bytes < 10240 THEN total_bytes || ' bytes' WHEN kb < 10240 THEN kb || ' kB' ELSE mb || ' MB' END AS total
    FROM u
"""

ORACLES["bulk_sizes"] = """
    WITH n AS (SELECT count(*) AS made, count(*) - count(*) // 3 AS kept FROM lineitem)
    SELECT 0 AS step, 'made' AS table_name, CAST(NULL AS BOOLEAN) AS smaller, true AS sized, true AS shown FROM n
    UNION ALL SELECT 1, 'kept', kept < made, true, true FROM n
    UNION ALL SELECT 2, 'emptied', kept > 0, true, true FROM n
"""

ORACLES["principal_name_list"] = f"SELECT customer_id, {PRINCIPAL} AS principal FROM ({CUSTOMERS})"

ORACLES["insert_absent_labels"] = """
    SELECT doc_id, quality, toxic FROM labels
    UNION ALL
    SELECT doc_id, -1, -1 FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
"""

ORACLES["insert_absent_orders"] = """
    SELECT l_orderkey AS o_orderkey, l_suppkey AS o_custkey FROM lineitem
    WHERE l_orderkey NOT IN (SELECT o_orderkey + (SELECT count(*) FROM customer) FROM orders)
"""

ORACLES["insert_absent_ci"] = """
    SELECT (SELECT max(c_custkey) FROM customer) + row_number() OVER (ORDER BY s_name) AS c_custkey, s_name AS c_name
    FROM (SELECT DISTINCT s_name FROM supplier)
"""

ORACLES["insert_skip_conflicts_lines"] = """
    SELECT o_orderkey AS l_orderkey, 1 AS l_linenumber, CAST(-1 AS BIGINT) AS l_partkey, CAST(-1 AS BIGINT) AS l_suppkey,
           CAST(0 AS DOUBLE) AS l_quantity, o_totalprice AS l_extendedprice
    FROM orders
    UNION ALL
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice
    FROM lineitem
    WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND l_linenumber = 1)
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice) = 1
"""

ORACLES["insert_skip_null_keys"] = """
    SELECT CAST(NULL AS BIGINT) AS doc_id, toxic FROM labels WHERE quality <> 1
    UNION ALL
    SELECT doc_id, toxic FROM labels WHERE quality = 1 AND doc_id NOT IN (SELECT doc_id FROM documents)
"""

_NEXT_CUSTOMER = """
    SELECT (SELECT max(c_custkey) FROM customer) + row_number() OVER (ORDER BY s_name) AS {id}, s_name AS {name}{more}
    FROM supplier
"""
ORACLES["assigned_ids"] = _NEXT_CUSTOMER.format(id="c_custkey", name="c_name", more="")
ORACLES["inserted_with_ids"] = _NEXT_CUSTOMER.format(id="id", name="name", more=", 'SUPPLIER' AS kind")

ORACLES["appended_rows"] = """
    SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
    UNION ALL
    SELECT s_suppkey, s_name, s_nationkey, NULL, 'SUPPLIER' FROM supplier
"""

ORACLES["insert_chain_pairs"] = """
    WITH placed AS (
        SELECT (SELECT max(o_orderkey) FROM orders) + row_number() OVER (ORDER BY c_custkey) AS order_id,
               c_custkey AS customer_id, TIMESTAMP '2002-01-01' + c_nationkey * INTERVAL 1 DAY AS paid_at
        FROM customer
    )
    SELECT (SELECT max(o_orderkey) FROM orders) + row_number() OVER (ORDER BY order_id) AS payment_id,
           order_id, customer_id, paid_at
    FROM placed
"""

ORACLES["update_from_orders"] = """
    WITH firsts AS (
        SELECT o_custkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1
    )
    SELECT c_custkey, c_name, c_nationkey, c_acctbal, coalesce(o_orderpriority, c_mktsegment) AS c_mktsegment
    FROM customer LEFT JOIN firsts ON o_custkey = c_custkey
"""

ORACLES["update_latest_order"] = """
    SELECT o_orderkey, CASE WHEN o_orderkey = (SELECT max(o_orderkey) FROM orders) THEN 'X' ELSE o_orderstatus END
           AS o_orderstatus
    FROM orders
"""

ORACLES["backfill_column"] = """
    SELECT d.doc_id, lang, coalesce(quality, -1) AS quality, TIMESTAMP '2002-01-01' AS record_ts
    FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
"""

ORACLES["delete_mod"] = """
    SELECT * FROM customer WHERE CAST(replace(c_name, 'Customer#', '') AS BIGINT) % 3 <> 0
"""

ORACLES["delete_null_predicate"] = """
    SELECT d.doc_id FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id WHERE (toxic = 0) IS NOT TRUE
"""

ORACLES["delete_using_customers"] = """
    SELECT o_orderkey, o_custkey FROM orders
    WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)
"""

ORACLES["deleted_parent_and_child"] = """
    WITH returned AS (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag = 'R')
    SELECT 'lineitem' AS table_name, count(*) AS row_count FROM lineitem
    WHERE l_orderkey IN (SELECT l_orderkey FROM returned)
    UNION ALL
    SELECT 'orders', count(*) FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM returned)
"""

ORACLES["generated_columns"] = f"""
    SELECT l_orderkey, l_linenumber,
           CASE WHEN l_linestatus = 'F'
                THEN CAST(greatest(floor(epoch(l_shipdate - o_orderdate) / 60), 0) AS INTEGER) END AS minutes,
           CASE WHEN l_linestatus = 'F'
                THEN CAST({MONEY.format('o_totalprice')} - {MONEY.format('l_extendedprice')} AS DOUBLE) END
           AS price_difference
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey
"""

ORACLES["truncate_table"] = """
    SELECT 'before' AS table_name, count(*) AS row_count, CAST((SELECT count(*) FROM (DESCRIBE lineitem)) AS INTEGER) AS n_columns
    FROM lineitem
    UNION ALL SELECT 'after', 0, CAST((SELECT count(*) FROM (DESCRIBE lineitem)) AS INTEGER)
"""

ORACLES["replaced_table"] = "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderstatus = 'O'"


def _counted(table: str, rules: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS "constraint", count(*) AS n_violations FROM {table} WHERE {broken}"""
        for name, broken in rules.items()
    )


ORACLES["audit_row_rules"] = _counted(
    "lineitem",
    {
        "l_orderkey_not_null": "l_orderkey IS NULL",
        "l_shipdate_not_null": "l_shipdate IS NULL",
        "quantity_at_least_2": "l_quantity < 2",
        "discount_range": "l_discount < 0.0 OR l_discount > 0.05",
        "shipped_after_1996": "l_shipdate <= DATE '1996-01-01'",
        "l_returnflag_domain": "l_returnflag NOT IN ('A', 'N')",
        "tax_not_above_discount": "l_tax > l_discount",
        "status_upper_case": "l_linestatus <> upper(l_linestatus)",
        "unknown_passes": "nullif(l_quantity, 1) <= 1",
        "l_returnflag_length": "length(l_returnflag) > 0",
        "l_extendedprice_decimal": "l_extendedprice >= 9999.995",
    },
)

_REPEATED_LINES = """
    SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY ALL HAVING count(*) > 1
"""
_LINE_REPEATS = f"""
    SELECT 'l_orderkey_l_linenumber_unique' AS "constraint", CAST(sum(n_rows - 1) AS BIGINT) AS n_violations
    FROM ({_REPEATED_LINES})
"""
ORACLES["audit_unique_lines"] = _LINE_REPEATS
ORACLES["repeated_line_keys"] = _REPEATED_LINES

ORACLES["audit_primary_keys"] = f"""
    {_LINE_REPEATS}
    UNION ALL SELECT 'l_orderkey_not_null', count(*) FROM lineitem WHERE l_orderkey IS NULL
    UNION ALL SELECT 'l_linenumber_not_null', count(*) FROM lineitem WHERE l_linenumber IS NULL
    UNION ALL SELECT 'o_orderkey_not_null', count(*) FROM orders WHERE o_orderkey IS NULL
    UNION ALL SELECT 'o_orderkey_unique', count(*) - count(DISTINCT o_orderkey) FROM orders
"""

ORACLES["audit_foreign_keys"] = """
    SELECT 'doc_id_reference' AS "constraint", count(*) AS n_violations FROM documents
    WHERE doc_id NOT IN (SELECT doc_id FROM labels)
    UNION ALL
    SELECT 'l_orderkey_reference', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
"""

ORACLES["orphan_documents"] = """
    SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
"""

ORACLES["audit_full_report"] = f"""
    {_counted("orders", {
        "o_orderkey_not_null": "o_orderkey IS NULL",
        "o_custkey_not_null": "o_custkey IS NULL",
        "total_not_negative": "o_totalprice < 0",
        "o_orderstatus_domain": "o_orderstatus NOT IN ('F', 'O')",
        "o_custkey_reference": "o_custkey NOT IN (SELECT c_custkey FROM customer)",
    })}
    UNION ALL SELECT 'o_orderkey_unique', count(*) - count(DISTINCT o_orderkey) FROM orders
    UNION ALL SELECT 'o_custkey_unique', count(*) - count(DISTINCT o_custkey) FROM orders
"""

ORACLES["row_policy"] = f"""
    SELECT o_custkey AS customer_id, o_orderkey AS rental_id, o_orderdate AS rental_date
    FROM orders WHERE o_custkey = {OWNER}
"""

ORACLES["row_policy_leaks"] = f"""
    SELECT 'visible' AS table_name, CAST(0 AS BIGINT) AS row_count
    UNION ALL SELECT 'all', count(*) FROM orders WHERE o_custkey <> {OWNER}
"""

ORACLES["principal_access"] = f"""
    SELECT 'rental' AS table_name, count(*) AS visible, CAST(0 AS BIGINT) AS leaked FROM orders WHERE o_custkey = {OWNER}
    UNION ALL
    SELECT 'payment', count(*), CAST(0 AS BIGINT) FROM orders WHERE o_custkey = {OWNER}
"""

ORACLES["generated_sequence"] = """
    SELECT 'veeeeeeery_long_string' || row_number() OVER () AS col FROM lineitem
"""

ORACLES["bulk_lifecycle"] = """
    WITH t AS (SELECT count(*) AS n FROM lineitem)
    SELECT 0 AS step, 'made' AS table_name, n AS row_count FROM t
    UNION ALL SELECT 1, 'kept', n - n // 3 FROM t
    UNION ALL SELECT 2, 'emptied', 0 FROM t
"""

ORACLES["add_films_recipe"] = f"""
    WITH film AS ({FILMS}), added AS (
        SELECT (SELECT max(film_id) FROM film) + row_number() OVER (ORDER BY s_name) AS film_id, s_name AS title
        FROM supplier
    )
    SELECT film_id, title, 2001 AS release_year, (SELECT r_regionkey FROM region WHERE r_name = 'ASIA') AS language_id,
           CAST(1 AS BIGINT) AS n_links
    FROM added
    UNION ALL
    SELECT -1, 'all links', 0, 0,
           (SELECT count(*) FROM added) + (SELECT count(*) FROM film WHERE category_id <> 1)
"""

ORACLES["add_actors_recipe"] = f"""
    WITH film AS ({FILMS}),
    fresh AS (
        SELECT (SELECT max(s_suppkey) FROM supplier) + row_number() OVER (ORDER BY c_name, c_mktsegment) AS actor_id,
               c_mktsegment AS first_name, c_name AS last_name, c_custkey AS film_id
        FROM customer JOIN film ON film_id = c_custkey
    )
    SELECT title AS movie_title, first_name, last_name, actor_id, film_id FROM fresh JOIN film USING (film_id)
    UNION ALL
    SELECT title, 'Supplier', s_name, s_suppkey, film_id FROM supplier JOIN film ON film_id = s_suppkey
"""

ORACLES["add_actors_links"] = f"""
    WITH film AS ({FILMS})
    SELECT (SELECT max(s_suppkey) FROM supplier) + row_number() OVER (ORDER BY c_name, c_mktsegment) AS actor_id,
           c_custkey AS film_id
    FROM customer JOIN film ON film_id = c_custkey
    UNION ALL
    SELECT s_suppkey, film_id FROM supplier JOIN film ON film_id = s_suppkey
    WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_suppkey = s_suppkey AND l_partkey = film_id)
"""

COPIES = """
    SELECT DISTINCT l_partkey * 100 + s_nationkey AS inventory_id, l_partkey AS film_id, s_nationkey AS store_id
    FROM lineitem JOIN supplier ON s_suppkey = l_suppkey
"""

ORACLES["stock_first_store_recipe"] = f"""
    WITH copies AS ({COPIES}), lacking AS (
        SELECT p_partkey AS film_id FROM part
        WHERE NOT EXISTS (SELECT 1 FROM copies WHERE film_id = p_partkey
                          AND store_id = (SELECT min(n_nationkey) FROM nation))
    )
    SELECT (SELECT max(inventory_id) FROM copies) + row_number() OVER (ORDER BY film_id) AS inventory_id, film_id,
           (SELECT min(n_nationkey) FROM nation) AS store_id
    FROM lacking
"""

_FIRST_REGULAR = "(SELECT min(o_custkey) FROM (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) >= 10))"

ORACLES["preview_customer_recipe"] = f"""
    SELECT customer_id, first_name, last_name, email, address_id, store_id FROM ({CUSTOMERS})
    WHERE customer_id = {_FIRST_REGULAR}
"""

ORACLES["retarget_customer_recipe"] = f"""
    SELECT customer_id,
           CASE WHEN hit THEN 'Ada' ELSE first_name END AS first_name,
           CASE WHEN hit THEN 'Example' ELSE last_name END AS last_name,
           CASE WHEN hit THEN 'target@example.com' ELSE email END AS email,
           CASE WHEN hit THEN (SELECT min(n_nationkey) FROM nation) ELSE address_id END AS address_id,
           CASE WHEN hit THEN (SELECT min(n_nationkey) FROM nation) ELSE store_id END AS store_id
    FROM (SELECT *, customer_id = {_FIRST_REGULAR} AS hit FROM ({CUSTOMERS}))
"""

_PURGED = f"(SELECT customer_id FROM ({CUSTOMERS}) WHERE upper(coalesce(email, '')) = 'CUSTOMER#000000001@EXAMPLE.COM')"

ORACLES["preview_purge_recipe"] = f"""
    SELECT 'payment' AS table_name, count(*) AS row_count FROM orders WHERE o_custkey IN {_PURGED}
    UNION ALL SELECT 'rental', count(*) FROM orders WHERE o_custkey IN {_PURGED}
"""

ORACLES["purge_customer_recipe"] = f"""
    SELECT 'payment' AS table_name, count(*) AS row_count FROM orders WHERE o_custkey NOT IN {_PURGED}
    UNION ALL SELECT 'rental', count(*) FROM orders WHERE o_custkey NOT IN {_PURGED}
"""

ORACLES["purge_customer_rows"] = f"""
    SELECT table_name, o_orderkey AS row_id, o_custkey AS customer_id
    FROM orders, (VALUES ('payment'), ('rental')) v(table_name) WHERE o_custkey IN {_PURGED}
"""

ORACLES["rent_and_pay_recipe"] = f"""
    WITH renter AS (SELECT customer_id, store_id FROM ({CUSTOMERS}) WHERE email = 'customer#000000001@example.com'),
    wanted AS (
        SELECT title, inventory_id, rental_rate, TIMESTAMP '2002-01-01' + rental_duration * INTERVAL 1 DAY AS rental_date
        FROM ({FILMS}) JOIN ({COPIES}) USING (film_id) JOIN renter USING (store_id)
        WHERE store_id IN (SELECT s_nationkey FROM supplier)
    ), numbered AS (
        SELECT *, (SELECT max(o_orderkey) FROM orders) + row_number() OVER (ORDER BY rental_date, inventory_id) AS id
        FROM wanted
    )
    SELECT title, id AS rental_id, rental_date, id AS payment_id, CAST(rental_rate AS DOUBLE) AS amount,
           rental_date AS payment_date
    FROM numbered
"""

ORACLES["touched_rental"] = """
    SELECT max(o_orderkey) + 1 AS rental_id, TIMESTAMP '2002-01-01 12:00:00' AS rental_date,
           CAST(2 AS BIGINT) AS inventory_id, CAST(2 AS BIGINT) AS customer_id,
           TIMESTAMP '2002-01-03 12:00:00' AS return_date, CAST(1 AS BIGINT) AS staff_id,
           TIMESTAMP '2002-01-02' AS last_update
    FROM orders
"""

ORACLES["load_dates"] = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS n_dated, '2002-01-01' AS record_ts FROM {name}"
    for name in ("customer", "orders", "part", "supplier", "nation", "region")
)

ORACLES["load_dates_today"] = "SELECT count(*) AS n_today, count(*) AS n_rows FROM lineitem"

ORACLES["fleet_load"] = """
    SELECT 'vehicle_type' AS table_name, count(DISTINCT p_type) AS row_count FROM part
    UNION ALL SELECT 'app_user', count(*) FROM customer
    UNION ALL SELECT 'employee', count(*) FROM supplier
    UNION ALL SELECT 'vehicle', count(*) FROM part
    UNION ALL SELECT 'maintenance_event', count(*) FROM part
    UNION ALL SELECT 'inspection_event', count(*) FROM supplier JOIN part ON p_partkey = s_suppkey
    UNION ALL SELECT t, count(*)
              FROM orders JOIN customer ON c_custkey = o_custkey JOIN part ON p_partkey = o_custkey,
                   (VALUES ('reservation'), ('trip'), ('payment'), ('rating')) v(t)
              GROUP BY t
    UNION ALL SELECT 'maintenance_event_employee', count(*) FROM supplier JOIN part ON p_partkey = s_suppkey
    UNION ALL SELECT 'vehicle_status_history', count(*) FROM orders JOIN part ON p_partkey = o_custkey
"""

ORACLES["fleet_load_again"] = f"""
    WITH loaded AS ({ORACLES["fleet_load"]}),
    added(table_name, n) AS (
        SELECT 'vehicle_type', count(DISTINCT p_brand) FROM part UNION ALL SELECT 'app_user', count(*) FROM customer
    )
    SELECT table_name, row_count + coalesce(n, 0) AS n_rows, row_count AS n_dated_first, coalesce(n, 0) AS n_dated_later
    FROM loaded LEFT JOIN added USING (table_name)
"""

_MOMENT = "strftime({}, '%Y-%m-%d %H:%M:%S')".format


def _named(table: str, name: str, source: str, **columns: str) -> str:
    """One table's part of `fleet_rows`."""
    row = " || ';' || ".join(f"'{c}=' || CAST({value} AS VARCHAR)" for c, value in columns.items())
    return f"SELECT '{table}' AS table_name, {name} AS name, {row} AS row FROM {source}"


def _fleet_rows() -> str:
    mail, vin = "lower(c_name) || '@example.com'", "'V' || o_custkey"
    booked = "o_orderdate + INTERVAL 10 YEAR + to_seconds(o_orderkey)"
    off = f"{booked} + INTERVAL 15 MINUTE"
    hour = "INTERVAL 1 HOUR"
    opened = "TIMESTAMP '2001-01-01' + to_days(p_size)"
    ridden = "orders JOIN customer ON c_custkey = o_custkey JOIN part ON p_partkey = o_custkey"
    looked = "supplier JOIN part ON p_partkey = s_suppkey"
    agent = "lower(s_name) || '@example.com'"
    cost = "CAST(o_totalprice AS DECIMAL(12,2))"
    of_user = "CAST(o_totalprice AS DECIMAL(10,2))"
    reservation = f"{mail} || '/' || {vin} || '/' || {_MOMENT(booked)}"
    serviced = f"'V' || p_partkey || '/Tyre swap/' || {_MOMENT(opened)}"
    km = "CAST(p_retailprice AS DECIMAL(12,2))"
    start = "'2001-01-01 00:00:00'"
    parts = [
        _named("vehicle_type", "p_type", "(SELECT DISTINCT p_type FROM part)", type_name="p_type", description="p_type"),
        _named("app_user", mail, "customer", first_name="c_mktsegment", last_name="c_name", email=mail, phone_number="c_custkey",
               driver_license_no="'L' || c_custkey", registered_at=start, is_active="true"),
        _named("employee", agent, "supplier", first_name="'Agent'", last_name="s_name", email=agent, phone_number="'-'",
               job_title="'Examiner'", hired_at="'2001-01-01'", is_active="true"),
        _named("vehicle", "'V' || p_partkey", "part", vehicle_type_id="p_type", vin="'V' || p_partkey", registration_plate="'P' || p_partkey", brand="p_brand",
               model="p_name", production_year="2000 + p_size % 20", commissioned_at="'-'", retired_at="'-'", current_odometer_km=km),
        _named("maintenance_event", serviced, "part", vehicle_id="'V' || p_partkey", maintenance_type="'Tyre swap'", description="'-'", opened_at=_MOMENT(opened),
               completed_at=_MOMENT(f"{opened} + {hour}"), odometer_km=km, maintenance_status="'completed'", cost_amount="'-'"),
        _named("inspection_event", f"'V' || s_suppkey || '/' || {agent} || '/Yearly review/2001-01-06 00:00:00'", looked, vehicle_id="'V' || s_suppkey",
               employee_id=agent, inspection_type="'Yearly review'", inspection_result="'passed'", notes="'-'", inspected_at="'2001-01-06 00:00:00'", odometer_km="'1.00'"),
        _named("reservation", reservation, ridden, user_id=mail, vehicle_id=vin, reserved_from=_MOMENT(booked), reserved_until=_MOMENT(f"{booked} + {hour}"),
               created_at=_MOMENT(booked), cancelled_at="'-'", reservation_status="'fulfilled'"),
        _named("trip", reservation, ridden, user_id=mail, vehicle_id=vin, reservation_id=reservation, started_at=_MOMENT(off),
               ended_at=_MOMENT(f"{off} + to_minutes(o_orderkey % 600)"), start_odometer_km="'0.00'", end_odometer_km=cost, distance_km=cost,
               duration_minutes="o_orderkey % 600", total_cost=of_user, trip_status="'completed'"),
        _named("payment", reservation, ridden, trip_id=reservation, user_id=mail, amount=of_user, currency_code="'USD'", payment_method="'card'",
               payment_status="'pending'", paid_at="'-'", created_at=_MOMENT(off)),
        _named("rating", reservation, ridden, trip_id=reservation, user_id=mail, vehicle_id=vin, score="o_orderkey % 5 + 1", comment_text="'-'", created_at=_MOMENT(off)),
        _named("maintenance_event_employee", f"{serviced} || '/' || {agent}", looked, maintenance_event_id=serviced, employee_id=agent, assigned_role="'Lead'",
               assigned_at=_MOMENT(opened)),
        _named("vehicle_status_history", f"{vin} || '/in_use/' || {_MOMENT(off)}", "orders JOIN part ON p_partkey = o_custkey LEFT JOIN customer ON c_custkey = o_custkey",
               vehicle_id=vin, status_code="'in_use'", reservation_id=f"coalesce({reservation}, '-')", trip_id=f"coalesce({reservation}, '-')", maintenance_event_id="'-'",
               inspection_event_id="'-'", valid_from=_MOMENT(off), valid_to=_MOMENT(f"{off} + {hour}"), recorded_at=_MOMENT(off)),
    ]
    return " UNION ALL ".join(parts)


ORACLES["fleet_rows"] = _fleet_rows()

ORACLES["fleet_trip_rows"] = f"""
    WITH booked AS (
        SELECT *, o_orderdate + INTERVAL 10 YEAR + to_seconds(o_orderkey) AS reserved_from FROM orders
    )
    SELECT lower(c_name) || '@example.com' AS email, true AS is_active, 'V' || o_custkey AS vin, p_type AS type_name,
           CAST(o_orderkey % 600 AS INTEGER) AS duration_minutes,
           CAST({MONEY.format('o_totalprice')} AS DOUBLE) AS distance_km,
           CAST({MONEY.format('o_totalprice')} AS DOUBLE) AS total_cost,
           reserved_from, reserved_from + INTERVAL 15 MINUTE AS started_at
    FROM booked JOIN customer ON c_custkey = o_custkey JOIN part ON p_partkey = o_custkey
"""

ORACLES["fleet_trip_measures"] = f"""
    SELECT CAST(o_orderkey % 600 AS INTEGER) AS duration_minutes, count(*) AS n_trips,
           CAST(sum({MONEY.format('o_totalprice')}) AS DOUBLE) AS distance_km
    FROM orders JOIN customer ON c_custkey = o_custkey JOIN part ON p_partkey = o_custkey
    GROUP BY 1
"""

ORACLES["fleet_trip_audit"] = f"""
    WITH trip AS (
        SELECT {MONEY.format('o_totalprice')} AS cost
        FROM orders JOIN customer ON c_custkey = o_custkey JOIN part ON p_partkey = o_custkey
    )
    SELECT "constraint", CAST(0 AS BIGINT) AS n_violations
    FROM (VALUES ('trip_id_not_null'), ('user_id_not_null'), ('vehicle_id_not_null'), ('started_at_not_null'),
                 ('start_odometer_km_not_null'), ('trip_status_not_null'), ('trip_status_length'),
                 ('start_odometer_km_decimal'), ('end_odometer_km_decimal'), ('distance_km_decimal'),
                 ('total_cost_decimal'), ('trip_status_domain'), ('started_after_2000'), ('ended_not_before_started'),
                 ('start_odometer_not_negative'), ('end_odometer_not_below_start'), ('trip_id_unique'),
                 ('reservation_id_unique'), ('user_id_reference'), ('reservation_id_reference')) v("constraint")
    UNION ALL SELECT 'cost_not_negative', count(*) FROM trip WHERE cost < 100000
    UNION ALL SELECT 'vehicle_id_reference', count(*) FROM trip
"""

ORACLES["principal_name_forms"] = r"""
    SELECT s_suppkey, 'client_O_NEIL_' || regexp_replace(upper(s_name), '[^A-Z0-9]+', '_', 'g') AS normal,
           'client_o''neil_' || s_name AS "raw"
    FROM supplier
"""
