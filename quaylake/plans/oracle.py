"""ANSI SQL for each named query, runnable by DuckDB on the same parquet
tables (views ``orders``, ``customer``, ``nation``, ``events`` ...).

The fixture views are spelled once here as CTE text; the same text also runs
on Spark SQL. Regex dots are written ``[.]`` to avoid escape differences.
"""

from __future__ import annotations

SHIPMENTS = """
SELECT concat('SH-', CAST(o_orderkey AS STRING)) AS shipment_id,
       n1.n_name AS origin, n2.n_name AS destination,
       concat('V-', CAST(100 + o_orderkey % 201 AS STRING)) AS vehicle_id,
       CAST(10 + o_orderkey % 1491 AS DOUBLE) AS weight,
       CASE WHEN o_orderpriority IN ('1-URGENT','2-HIGH') THEN 'High'
            WHEN o_orderpriority = '3-MEDIUM' THEN 'Medium' ELSE 'Low' END AS priority,
       CAST(10 + o_orderkey % 1491 AS DOUBLE) *
         CASE WHEN o_orderpriority IN ('1-URGENT','2-HIGH') THEN 15.0 ELSE 10.0 END AS revenue,
       CASE o_orderstatus WHEN 'F' THEN 'Delivered' WHEN 'O' THEN 'In Transit'
            ELSE 'Shipment Created' END AS status,
       concat(CAST(CAST(o_orderdate AS DATE) AS STRING), ' 00:00:00') AS timestamp
FROM orders JOIN customer ON o_custkey = c_custkey
JOIN nation n2 ON c_nationkey = n2.n_nationkey
JOIN nation n1 ON n1.n_nationkey = o_orderkey % 25
"""

RETAIL_ORDERS = """
SELECT CASE WHEN o_orderkey % 97 = 0 THEN NULL
            WHEN o_orderkey % 50 = 0 THEN concat('ORD_', CAST(o_orderkey + 1 AS STRING))
            ELSE concat('ORD_', CAST(o_orderkey AS STRING)) END AS order_id,
       CASE WHEN o_orderkey % 61 = 0 THEN NULL ELSE concat('CUST_', CAST(o_custkey AS STRING)) END AS customer_id,
       CASE WHEN o_orderkey % 41 = 0 THEN NULL ELSE concat('PROD_', CAST(o_orderkey % 200 AS STRING)) END AS product_id,
       CASE WHEN o_orderkey % 37 = 0 THEN -2 ELSE CAST(1 + o_orderkey % 10 AS INT) END AS quantity,
       CASE WHEN o_orderkey % 43 = 0 THEN -o_totalprice
            WHEN o_orderkey % 83 = 0 THEN 0.0 ELSE o_totalprice END AS price,
       CAST(CAST(o_orderdate AS DATE) AS STRING) AS transaction_date,
       CASE WHEN o_orderkey % 53 = 0 THEN 'john.doe@'
            WHEN o_orderkey % 59 = 0 THEN 'test.com@test'
            WHEN o_orderkey % 71 = 0 THEN NULL
            ELSE concat('user', CAST(o_custkey AS STRING), '@gmail.com') END AS customer_email
FROM orders
"""

RETAIL_COLS = "order_id, customer_id, product_id, quantity, price, transaction_date, customer_email"
SHIP_COLS = "shipment_id, origin, destination, vehicle_id, weight, priority, revenue, status, timestamp"

# (index, column, expectation, failing predicate, percent base counts NULLs)
RULES = [
    (0, "order_id", "expect_column_values_to_not_be_null", "order_id IS NULL", True),
    (1, "order_id", "expect_column_values_to_be_unique",
     "COALESCE(order_id IN (SELECT order_id FROM dups), FALSE)", False),
    (2, "product_id", "expect_column_values_to_not_be_null", "product_id IS NULL", True),
    (3, "customer_id", "expect_column_values_to_not_be_null", "customer_id IS NULL", True),
    (4, "price", "expect_column_values_to_be_between", "COALESCE(price < 0.01, FALSE)", False),
    (5, "quantity", "expect_column_values_to_be_between", "COALESCE(quantity < 1, FALSE)", False),
    (6, "customer_email", "expect_column_values_to_match_regex",
     "COALESCE(NOT regexp_matches(customer_email, '^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+[.][a-zA-Z]{2,}$'), FALSE)",
     False),
    (7, "transaction_date", "expect_column_values_to_be_between",
     "COALESCE(transaction_date > '2001-06-30', FALSE)", False),
]


def _flags_ctes() -> str:
    flags = ",\n       ".join(f"{pred} AS f{i}" for i, _, _, pred, _ in RULES)
    return f"""
retail_orders AS ({RETAIL_ORDERS}),
dups AS (SELECT order_id FROM retail_orders WHERE order_id IS NOT NULL
         GROUP BY order_id HAVING count(*) > 1),
flags AS (SELECT {RETAIL_COLS},
       {flags}
  FROM retail_orders)"""


def _any_failed() -> str:
    return "(" + " OR ".join(f"f{i}" for i, *_ in RULES) + ")"


def _reason(i: int, col: str, exp: str) -> str:
    return f"concat('{col} failed {exp} (value: ', COALESCE(CAST({col} AS STRING), 'None'), ')')"


def _reasons_text() -> str:
    parts = ", ".join(f"CASE WHEN f{i} THEN {_reason(i, c, e)} END" for i, c, e, _, _ in RULES)
    return f"concat_ws(', ', {parts})"


def _rule_stats() -> str:
    selects = []
    for i, col, exp, _, counts_nulls in RULES:
        base = "count(*)" if counts_nulls else f"count({col})"
        selects.append(
            f"""SELECT {i} AS rule_index, '{col}' AS rule_column, '{exp}' AS expectation,
       CAST(count_if(f{i}) AS BIGINT) = 0 AS success, count(*) AS element_count,
       count(*) - count({col}) AS missing_count, CAST(count_if(f{i}) AS BIGINT) AS unexpected_count,
       CASE WHEN {base} > 0 THEN CAST(CAST(count_if(f{i}) AS BIGINT) AS DOUBLE) / CAST({base} AS DOUBLE) * CAST(100 AS DOUBLE) END
         AS unexpected_percent
  FROM flags"""
        )
    return "\nUNION ALL\n".join(selects)


def _batch_stats() -> str:
    return f"""SELECT count(*) AS total, CAST(count_if(NOT {_any_failed()}) AS BIGINT) AS clean,
       count(*) - CAST(count_if(NOT {_any_failed()}) AS BIGINT) AS quarantine,
       CASE WHEN count(*) > 0 THEN CAST(CAST(count_if(NOT {_any_failed()}) AS BIGINT) AS DOUBLE) / CAST(count(*) AS DOUBLE)
            * CAST(100 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS success_rate
  FROM flags"""


NEXT_STATUS = """CASE status WHEN 'Shipment Created' THEN 'Vehicle Assigned'
       WHEN 'Vehicle Assigned' THEN 'In Transit' WHEN 'In Transit' THEN 'Out for Delivery'
       ELSE 'Delivered' END"""

NEW_SHIPMENTS = """
SELECT concat('SH-N', CAST(c_custkey AS STRING)) AS shipment_id, n1.n_name AS origin, n2.n_name AS destination,
       concat('V-', CAST(100 + c_custkey % 201 AS STRING)) AS vehicle_id,
       CAST(10 + c_custkey % 1491 AS DOUBLE) AS weight, 'Low' AS priority,
       CAST(10 + c_custkey % 1491 AS DOUBLE) * 10.0 AS revenue, 'Shipment Created' AS status,
       '2001-08-02 10:05:00' AS timestamp
FROM customer JOIN nation n1 ON c_nationkey = n1.n_nationkey
JOIN nation n2 ON n2.n_nationkey = c_custkey % 25
"""

MERGE_SOURCE = f"""
SELECT shipment_id, origin, destination, vehicle_id, weight, priority, revenue,
       {NEXT_STATUS} AS status, concat(substr(timestamp, 1, 10), ' 10:00:00') AS timestamp
FROM shipments WHERE status <> 'Delivered'
UNION ALL
SELECT * FROM new_shipments
"""

UPDATED_STATUS = "CASE WHEN priority = 'High' AND status = 'In Transit' THEN 'Out for Delivery' ELSE status END"

MALFORMED_ROWS = """
SELECT CAST(NULL AS STRING) AS shipment_id, CAST(NULL AS STRING) AS origin, CAST(NULL AS STRING) AS destination,
       CAST(NULL AS STRING) AS vehicle_id, CAST(NULL AS DOUBLE) AS weight, CAST(NULL AS STRING) AS priority,
       CAST(NULL AS DOUBLE) AS revenue, CAST(NULL AS STRING) AS status, CAST(NULL AS STRING) AS timestamp
FROM (SELECT 1 AS k UNION ALL SELECT 2) two
UNION ALL
SELECT 'SH-STR', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL
"""


def _ships(*extra: str) -> str:
    ctes = [f"shipments AS ({SHIPMENTS})", f"new_shipments AS ({NEW_SHIPMENTS})", f"src AS ({MERGE_SOURCE})"]
    return "WITH " + ",\n".join(ctes + list(extra)) + "\n"


def _merge(src: str = "src", update: bool = True, insert: bool = True) -> str:
    if update:
        matched = f"""SELECT t.shipment_id, t.origin, t.destination, t.vehicle_id, t.weight, t.priority, t.revenue,
       CASE WHEN s.shipment_id IS NOT NULL THEN s.status ELSE t.status END AS status,
       CASE WHEN s.shipment_id IS NOT NULL THEN s.timestamp ELSE t.timestamp END AS timestamp
FROM shipments t LEFT JOIN (SELECT DISTINCT shipment_id, status, timestamp FROM {src}
                            WHERE shipment_id IS NOT NULL) s ON t.shipment_id = s.shipment_id"""
    else:
        matched = f"SELECT {SHIP_COLS} FROM shipments"
    if not insert:
        return matched
    return f"""{matched}
UNION ALL
SELECT {SHIP_COLS} FROM {src} s
WHERE s.shipment_id IS NULL OR NOT EXISTS (SELECT 1 FROM shipments t WHERE t.shipment_id = s.shipment_id)"""


# The criteria text expected for each rule of the suite.
CRITERIA = (
    (0, "Expect order_id to contain no null values."),
    (1, "Expect order_id to contain only unique values."),
    (2, "Expect product_id to contain no null values."),
    (3, "Expect customer_id to contain no null values."),
    (4, "Expect price to be at least 0.01."),
    (5, "Expect quantity to be at least 1."),
    (6, "Expect customer_email to match standard format."),
    (7, "Expect transaction_date to be at most 2001-06-30."),
)

# Further arguments of the rules of the suite, as text.
RULE_LIMITS = {
    4: (("min_value", "0.01"),),
    5: (("min_value", "1"),),
    6: (("regex", "^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\\.[a-zA-Z]{2,}$"),),
    7: (("max_value", "2001-06-30"),),
}

ODD_PRODUCT = """CASE (length(customer_id) + length(product_id)) % 7
  WHEN 1 THEN '  ' || product_id || ' ' WHEN 2 THEN 'say "' || product_id || '", ok'
  WHEN 3 THEN product_id || chr(10) || 'second line' WHEN 4 THEN '' WHEN 5 THEN 'back' || chr(92) || product_id
  ELSE product_id END"""

VERSION_LOG = """entered AS (
  SELECT *, CAST(substr(timestamp, 1, 4) AS BIGINT) * 12 + CAST(substr(timestamp, 6, 2) AS BIGINT) AS commit_id
  FROM shipments),
log AS (
  SELECT *, 'I' AS op FROM entered
  UNION ALL SELECT * REPLACE ('Out for Delivery' AS status, commit_id + 1 AS commit_id), 'U' FROM entered
    WHERE priority = 'High' AND status = 'In Transit'
  UNION ALL SELECT * REPLACE (commit_id + 2 AS commit_id), 'D' FROM entered WHERE status = 'Delivered'),
commits AS (
  SELECT commit_id, CAST(make_date(CAST((commit_id - 1) // 12 AS INTEGER), CAST((commit_id - 1) % 12 + 1 AS INTEGER), 1) AS TIMESTAMP)
           AS committed_at, CAST(count_if(op = 'I') AS BIGINT) AS added_records,
         CAST(count_if(op = 'U') AS BIGINT) AS updated_records, CAST(count_if(op = 'D') AS BIGINT) AS deleted_records
  FROM log GROUP BY commit_id)"""


def _state(upto: str) -> str:
    return f"""SELECT {SHIP_COLS} FROM (
  SELECT * FROM log WHERE commit_id <= {upto}
  QUALIFY row_number() OVER (PARTITION BY shipment_id ORDER BY commit_id DESC) = 1) v WHERE op <> 'D'"""


def oracle_queries() -> dict[str, str]:
    q: dict[str, str] = {}
    flags = _flags_ctes()

    q["dq_rule_stats"] = f"WITH {flags},\nstats AS ({_rule_stats()})\nSELECT * FROM stats"
    q["dq_batch_stats"] = f"WITH {flags}\n{_batch_stats()}"
    q["dq_clean"] = f"WITH {flags}\nSELECT {RETAIL_COLS} FROM flags WHERE NOT {_any_failed()}"
    q["dq_split_semi_anti"] = q["dq_clean"]
    q["dq_quarantine"] = (
        f"WITH {flags}\nSELECT {RETAIL_COLS}, {_reasons_text()} AS quarantine_reasons FROM flags WHERE {_any_failed()}"
    )
    longs = "\nUNION ALL\n".join(
        f"SELECT {RETAIL_COLS}, {i} AS rule_index, '{c}' AS rule_column, '{e}' AS expectation, "
        f"COALESCE(CAST({c} AS STRING), 'None') AS value, {_reason(i, c, e)} AS reason FROM flags WHERE f{i}"
        for i, c, e, _, _ in RULES
    )
    q["dq_reasons_long"] = f"WITH {flags}\n{longs}"
    per_rule_keys = [
        "dq_order_id_not_null",
        "dq_order_id_unique",
        "dq_product_id_not_null",
        "dq_customer_id_not_null",
        "dq_price_min",
        "dq_quantity_min",
        "dq_email_regex",
        "dq_date_max",
    ]
    for key, (i, c, e, _, _) in zip(per_rule_keys, RULES):
        q[key] = f"WITH {flags}\nSELECT {RETAIL_COLS}, {_reason(i, c, e)} AS reason FROM flags WHERE f{i}"

    # ------------------------------------------------------ quality extras
    q["dq_between_two_sided"] = f"""WITH retail_orders AS ({RETAIL_ORDERS})
SELECT {RETAIL_COLS}, {_reason(0, 'quantity', 'expect_column_values_to_be_between')} AS reason
FROM retail_orders WHERE COALESCE(quantity < 1 OR quantity > 5, FALSE)"""
    q["dq_gate"] = f"""WITH {flags},\nb AS ({_batch_stats()})
SELECT *, CAST(85 AS DOUBLE) AS threshold,
       CASE WHEN success_rate >= 85 THEN 'INGEST' ELSE 'STOP' END AS decision FROM b"""
    for key, thr in (("dq_gated_load", 85), ("dq_gated_load_low_threshold", 80)):
        q[key] = f"""WITH {flags},\nb AS ({_batch_stats()})
SELECT {RETAIL_COLS} FROM flags WHERE NOT {_any_failed()} AND (SELECT success_rate >= {thr} FROM b)"""
    crit = ",\n".join(f"({i}, '{text}')" for i, text in CRITERIA)
    q["dq_report_checks"] = f"""WITH {flags},\nstats AS ({_rule_stats()}),
crit(rule_index, criteria) AS (VALUES {crit})
SELECT stats.rule_index + 1 AS check_number, rule_column, expectation, criteria,
       CASE WHEN success THEN 'Passed' ELSE 'Failed' END AS status,
       unexpected_count, COALESCE(unexpected_percent, CAST(0 AS DOUBLE)) AS unexpected_percent
FROM stats JOIN crit ON stats.rule_index = crit.rule_index"""
    q["dq_report_summary"] = f"""WITH {flags},\nstats AS ({_rule_stats()}),\nb AS ({_batch_stats()})
SELECT total AS total_rows, clean AS clean_rows, quarantine AS quarantine_rows, success_rate,
       CAST(100 AS DOUBLE) - success_rate AS quarantine_rate, CAST(85 AS DOUBLE) AS threshold,
       CASE WHEN success_rate >= 85 THEN 'Ingestion Allowed' ELSE 'Pipeline Stopped' END AS gate_status,
       (SELECT count(*) FROM stats) AS total_checks,
       (SELECT CAST(count_if(success) AS BIGINT) FROM stats) AS passed_checks,
       (SELECT count(*) - CAST(count_if(success) AS BIGINT) FROM stats) AS failed_checks,
       (SELECT element_count FROM stats WHERE rule_index = 0) AS row_count
FROM b"""
    q["dq_results_json"] = f"""WITH {flags},\nstats AS ({_rule_stats()})
SELECT rule_index, success, expectation, rule_column, element_count, missing_count, unexpected_count,
       unexpected_percent FROM stats"""
    q["csv_scan"] = f"""SELECT * REPLACE ({ODD_PRODUCT} AS product_id, CASE WHEN quantity <> 7 THEN quantity END AS quantity),
       COALESCE(quantity = 7, FALSE) AS is_bad FROM ({RETAIL_ORDERS}) r"""
    q["csv_roundtrip"] = f"SELECT * REPLACE ({ODD_PRODUCT} AS product_id) FROM ({q['dq_quarantine']}) r"
    mixed = f"""WITH m AS (SELECT * REPLACE (CAST(CASE WHEN quantity <> 7 THEN quantity END AS BIGINT) AS quantity,
         CAST(transaction_date AS DATE) AS transaction_date), quantity > 5 AS is_bulk FROM ({RETAIL_ORDERS}) r)"""
    q["csv_inferred_scan"] = f"{mixed} SELECT * FROM m"
    types = [("order_id", "string"), ("customer_id", "string"), ("product_id", "string"), ("quantity", "bigint"),
             ("price", "double"), ("transaction_date", "date"), ("customer_email", "string"), ("is_bulk", "boolean")]
    # whole numbers among the prices are written without a point only where they are 0
    fits = {"bigint": "count(quantity)", "double": "count_if(price = 0)"}
    q["csv_inferred_schema"] = mixed + " UNION ALL ".join(
        f"""SELECT '{c}' AS name, '{t}' AS type, count(*) AS n_rows, count(*) - count({c}) AS n_missing,
       {f'count({c})' if t == 'boolean' else 'CAST(0 AS BIGINT)'} AS n_boolean,
       CAST({fits.get(t, 0)} AS BIGINT) AS n_integer, {f'count({c})' if t in fits else 'CAST(0 AS BIGINT)'} AS n_number,
       {f'count({c})' if t == 'date' else 'CAST(0 AS BIGINT)'} AS n_date FROM m
""" for c, t in types)
    q["dq_load_twice"] = q["dq_gated_load_low_threshold"]
    price = "CASE WHEN quantity = 3 THEN CAST('nan' AS DOUBLE) ELSE round(price, -2) END"
    q["dq_unique_later_column"] = f"""WITH r AS (SELECT * REPLACE ({price} AS price) FROM ({RETAIL_ORDERS}) o)
SELECT {RETAIL_COLS}, concat('price failed expect_column_values_to_be_unique (value: ', CAST(price AS STRING), ')') AS reason
FROM r WHERE NOT isnan(price) QUALIFY count(*) OVER (PARTITION BY price) > 1"""
    q["dq_validate_batch"] = q["dq_quarantine"]

    arguments = [(i, e, a, v) for i, c, e, _, _ in RULES for a, v in (("column", c), *RULE_LIMITS.get(i, ()))]
    told = ",\n".join(f"({i}, '{e}', '{a}', '{v}')" for i, e, a, v in arguments)
    q["dq_results_arguments"] = f"""WITH told(rule_index, expectation, argument, value) AS (VALUES {told})
SELECT rule_index, expectation, argument, 'string' AS kind, value FROM told
WHERE EXISTS (SELECT 1 FROM orders)"""

    # ------------------------------------------------------------ shipments
    q["scan_shipments"] = f"{_ships()}SELECT * FROM shipments"
    q["incoming_batch"] = f"{_ships()}SELECT * FROM src"
    q["kpi_summary"] = f"""{_ships()}SELECT count(*) AS total_shipments,
       COALESCE(sum(revenue), CAST(0 AS DOUBLE)) AS total_revenue, avg(weight) AS avg_weight,
       count(DISTINCT vehicle_id) AS unique_vehicles FROM shipments"""
    q["kpi_merged_parts"] = q["kpi_summary"]
    q["kpi_months_from_parts"] = f"""{_ships()}SELECT substr(timestamp, 1, 7) AS month, count(*) AS total_shipments,
       COALESCE(sum(revenue), CAST(0 AS DOUBLE)) AS total_revenue, avg(weight) AS avg_weight,
       count(DISTINCT vehicle_id) AS unique_vehicles FROM shipments GROUP BY 1"""
    q["kpi_display"] = f"""{_ships()}, k AS (SELECT count(*) AS n, COALESCE(sum(revenue), 0.0) AS rev,
       avg(weight) AS w, count(DISTINCT vehicle_id) AS v FROM shipments)
SELECT format('{{:,}}', n) AS total_shipments_text, concat('$', format('{{:,.2f}}', rev)) AS total_revenue_text,
       concat(format('{{:.2f}}', w), ' kg') AS avg_weight_text, CAST(v AS STRING) AS unique_vehicles_text FROM k"""
    q["kpi_missing_column"] = f"""{_ships()}SELECT count(*) AS total_shipments, CAST(0 AS DOUBLE) AS total_revenue,
       CAST(0 AS DOUBLE) AS avg_weight, count(DISTINCT vehicle_id) AS unique_vehicles FROM shipments"""
    q["kpi_empty_table"] = f"""{_ships()}SELECT count(*) = 0 AS is_empty, 'all' AS rows FROM shipments
UNION ALL SELECT count(*) = 0, 'lost' FROM shipments WHERE status = 'Lost'"""
    q["revenue_by_destination"] = f"""{_ships()}SELECT destination, COALESCE(sum(revenue), CAST(0 AS DOUBLE)) AS revenue
FROM shipments WHERE destination IS NOT NULL GROUP BY destination"""
    for key, col in (("priority_distribution", "priority"), ("status_breakdown", "status")):
        q[key] = f"{_ships()}SELECT {col}, count(*) AS count FROM shipments WHERE {col} IS NOT NULL GROUP BY {col}"
    q["dashboard_breakdowns"] = f"""{_ships()}SELECT * FROM (
  SELECT CASE WHEN GROUPING(destination) = 0 THEN 'destination' WHEN GROUPING(priority) = 0 THEN 'priority'
              WHEN GROUPING(status) = 0 THEN 'status' ELSE 'all' END AS dimension,
         COALESCE(destination, priority, status) AS key, count(*) AS rows,
         COALESCE(sum(revenue), CAST(0 AS DOUBLE)) AS revenue
  FROM shipments GROUP BY GROUPING SETS ((destination), (priority), (status), ())) g
WHERE dimension = 'all' OR key IS NOT NULL"""
    q["recent_shipments"] = f"""{_ships()}SELECT *, try_strptime(timestamp, '%Y-%m-%d %H:%M:%S') AS event_time
FROM shipments ORDER BY event_time DESC NULLS LAST, shipment_id ASC NULLS LAST LIMIT 20"""
    q["derive_revenue"] = f"""{_ships()}SELECT shipment_id, weight, priority,
       round(weight * CASE WHEN priority = 'High' THEN 15.0 ELSE 10.0 END, 2) AS revenue FROM shipments"""

    # --------------------------------------------------------------- events
    q["event_encode"] = f"""{_ships()}SELECT shipment_id, CAST(to_json(struct_pack(shipment_id := shipment_id,
       origin := origin, destination := destination,
       vehicle_id := CASE WHEN status <> 'Delivered' THEN vehicle_id END, weight := weight,
       priority := priority, revenue := revenue, status := status, timestamp := timestamp)) AS STRING) AS value
FROM shipments"""
    q["event_decode"] = f"{_ships()}SELECT * FROM shipments"
    q["json_props"] = "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events"
    q["stream_ingest"] = f"{_ships()}SELECT * FROM shipments UNION ALL {MALFORMED_ROWS}"
    q["stream_restart"] = f"{_ships()}SELECT * FROM shipments UNION ALL {MALFORMED_ROWS} UNION ALL SELECT * FROM src"
    q["stream_versioned"] = q["stream_restart"]

    q["stream_latest"] = f"{_ships()}SELECT * FROM src UNION ALL SELECT * FROM new_shipments"
    q["stream_bounded"] = q["stream_crash_restart"] = q["stream_restart"]

    q["catalog_lifecycle"] = f"""{_ships()}SELECT *, CAST(NULL AS INTEGER) AS delivery_rating FROM shipments
UNION ALL SELECT *, 5 FROM new_shipments"""

    # ------------------------------------------------------------------ DML
    q["insert_append"] = f"{_ships()}SELECT * FROM shipments UNION ALL SELECT * FROM new_shipments"
    q["update_where"] = f"""{_ships()}SELECT shipment_id, origin, destination, vehicle_id, weight, priority, revenue,
       {UPDATED_STATUS} AS status, timestamp FROM shipments"""
    q["delete_where"] = f"{_ships()}SELECT * FROM shipments WHERE NOT COALESCE(status = 'Delivered', FALSE)"
    q["merge_upsert"] = f"{_ships()}{_merge()}"
    q["merge_new_only"] = f"{_ships()}{_merge(update=False)}"
    q["merge_matched_only"] = f"{_ships()}{_merge(insert=False)}"
    dup_src = ("dup_src AS (SELECT * FROM src UNION ALL SELECT * FROM new_shipments UNION ALL "
               "SELECT CAST(NULL AS STRING) AS shipment_id, origin, destination, vehicle_id, weight, priority, "
               "revenue, status, timestamp FROM new_shipments)")
    q["merge_dup_source"] = f"{_ships(dup_src)}{_merge('dup_src')}"

    q["merge_bucketed"] = q["merge_upsert"]
    some = "chosen AS (SELECT * FROM src WHERE origin IN ('NATION_1', 'NATION_2', 'NATION_3'))"
    q["merge_partitions"] = f"""{_ships(some, f'merged AS ({_merge("chosen")})')}
SELECT shipment_id, CASE WHEN origin = 'NATION_6' AND priority = 'High' THEN 'NATION_7' ELSE origin END AS origin, destination,
       vehicle_id, CASE WHEN origin = 'NATION_6' AND priority = 'High' THEN weight + 1 ELSE weight END AS weight, priority, revenue,
       status, timestamp FROM merged
WHERE NOT (origin = 'NATION_14' OR (origin = 'NATION_17' AND status = 'Delivered'))"""

    # ------------------------------------------------------------- versions
    versioned = _ships(VERSION_LOG)
    q["as_of_commit"] = f"{versioned}{_state(str(1995 * 12 + 6))}"
    q["as_of_latest"] = f"{versioned}{_state('(SELECT max(commit_id) FROM commits)')}"
    q["first_commit"] = f"{versioned}{_state('(SELECT min(commit_id) FROM commits)')}"
    q["commit_history"] = f"""{versioned}SELECT committed_at AS made_current_at, commit_id AS snapshot_id,
       lag(commit_id) OVER (ORDER BY commit_id) AS parent_id, TRUE AS is_current_ancestor FROM commits"""
    q["commit_snapshots"] = f"""{versioned}SELECT committed_at, commit_id AS snapshot_id,
       CASE WHEN updated_records = 0 AND deleted_records = 0 THEN 'append'
            WHEN updated_records = 0 AND added_records = 0 THEN 'delete' ELSE 'overwrite' END AS operation,
       added_records, updated_records, deleted_records,
       CAST(sum(added_records - deleted_records) OVER (ORDER BY commit_id) AS BIGINT) AS total_records FROM commits"""

    keys = ("added_records", "updated_records", "deleted_records", "total_records")
    rows = " UNION ALL ".join(
        f"SELECT committed_at, snapshot_id, operation, '{k.replace('_', '-')}' AS key, CAST({k} AS VARCHAR) AS value FROM s" for k in keys)
    q["commit_snapshot_summary"] = f"WITH s AS ({q['commit_snapshots']}) {rows}"

    # ------------------------------------------------------------ evolution
    q["add_column"] = f"""{_ships()}SELECT shipment_id, status,
       CASE WHEN status = 'Delivered' THEN 5 END AS delivery_rating FROM shipments"""
    q["partition_evolved_read"] = f"{_ships()}SELECT * FROM shipments"
    q["partition_evolved_pruned"] = f"""{_ships()}SELECT s.*, r_name AS region FROM shipments s
JOIN nation n ON n.n_name = s.origin JOIN region r ON r.r_regionkey = n.n_regionkey WHERE r_name = 'ASIA'"""
    return q
