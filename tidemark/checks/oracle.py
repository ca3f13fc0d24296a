"""The catalogue's queries as DuckDB SQL."""

from __future__ import annotations

from tidemark.checks.bronze import BRONZE_SQL
from tidemark.checks.catalogue import BATCH_ID, BATCHES
from tidemark.spec import COMMIT_COL

_SILVER_SQL = f"""{BRONZE_SQL},
typed AS (
  SELECT id, ver, ts, category, customer_id, discount_pct, {COMMIT_COL},
    try_cast(amount AS double) AS amount,
    try_cast(trunc(try_cast(quantity AS double)) AS integer) AS quantity,
    try_cast(transaction_date AS date) AS transaction_date
  FROM bronze
),
silver AS (
  SELECT *, coalesce(amount > 0, false) AS is_valid, upper(category) AS category_code,
    strftime(transaction_date, '%Y-%m-%d') AS dt, customer_id IS NOT NULL AS has_customer_id,
    CASE WHEN discount_pct IS NULL THEN 0.0::double ELSE amount * discount_pct END AS discount_raw
  FROM typed
)"""

_DATE = "cast(transaction_date AS varchar) AS transaction_date"
_DISCOUNT = "round(discount_raw + 1e-9, 4) AS discount_amount"


def _silver_list(commit: str = COMMIT_COL) -> str:
    return f"""id, ver, ts, category, customer_id, amount, quantity, discount_pct, {_DATE},
  dt, {commit} AS {COMMIT_COL}, is_valid, category_code, has_customer_id, {_DISCOUNT}"""


_CATEGORY_AGGREGATES = """count(id) AS transaction_count, round(sum(amount), 2) AS total_amount,
  round(avg(amount) + 1e-9, 4) AS avg_amount, round(max(amount), 2) AS max_amount,
  round(min(amount), 2) AS min_amount, round(stddev_samp(amount) + 1e-9, 4) AS stddev_amount"""
_CATEGORY_KEY = "category_code || '_' || dt AS agg_key"
_HOUR = "cast(hour(ts) AS integer)"
_HOUR_AGGREGATES = """count(id) AS transaction_count, round(sum(amount), 2) AS total_amount,
  count(DISTINCT customer_id) AS unique_customers"""
_HOUR_KEY = f"dt || '_' || {_HOUR} AS agg_key"


def _by_category(source: str, batch: str, extra: str = "") -> str:
    return f"""SELECT category_code, dt, {_CATEGORY_AGGREGATES}, {batch} AS batch_id, {_CATEGORY_KEY}
FROM {source} WHERE is_valid {extra} GROUP BY ALL"""


def _by_hour(source: str, batch: str, extra: str = "") -> str:
    return f"""SELECT dt, {_HOUR} AS hour, {_HOUR_AGGREGATES}, {batch} AS batch_id, {_HOUR_KEY}
FROM {source} WHERE is_valid {extra} GROUP BY ALL"""


def _silver_columns(columns: str) -> str:
    return f"WITH {_SILVER_SQL} SELECT id, ver, {columns} FROM silver"


_LATEST = "ROW_NUMBER() OVER (PARTITION BY dt, category_code, id ORDER BY ts DESC, ver DESC) = 1"

_LINEITEM_REST = (
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
)


def _two_upserts(order: str, first_ver: int) -> str:
    """Silver after the rows of one version, then of the other."""
    mark = f"CASE WHEN ver = {first_ver} THEN 1 ELSE 2 END"
    return f"""WITH {_SILVER_SQL}
SELECT {_silver_list(f"cast({mark} AS bigint)")} FROM silver
QUALIFY ROW_NUMBER() OVER (PARTITION BY dt, category_code, id ORDER BY {order}) = 1"""


# Cuts the commits into windows; each batch keeps the latest row per key and drops
# those older than what earlier batches stored.
def _batched(batches: int) -> str:
    cut = "first_us - 1 + (? * (last_us - first_us + 1)) // " + str(batches)
    cuts = [cut.replace("?", str(i)) for i in range(batches + 1)]
    number = " ".join(f"WHEN {COMMIT_COL} <= {cuts[i]} THEN {i}" for i in range(1, batches + 1))
    end = " ".join(f"WHEN batch = {i} THEN {cuts[i]}" for i in range(1, batches + 1))
    return f"""{_SILVER_SQL},
bounds AS (SELECT min({COMMIT_COL}) AS first_us, max({COMMIT_COL}) AS last_us FROM bronze),
numbered AS (SELECT *, CASE {number} END AS batch FROM silver, bounds),
ended AS (
  SELECT *, CASE {end} END AS end_us,
    strftime(make_timestamp(CASE {end} END), '%Y%m%d%H%M%S') AS batch_id FROM numbered
),
sent AS (
  SELECT * FROM ended
  QUALIFY ROW_NUMBER() OVER (
    PARTITION BY batch, dt, category_code, id ORDER BY ts DESC, ver DESC) = 1
),
ranked AS (
  SELECT *, max(ts) OVER (PARTITION BY dt, category_code, id ORDER BY batch
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS stored_ts
  FROM sent
),
accepted AS (SELECT * FROM ranked WHERE stored_ts IS NULL OR ts >= stored_ts),
stored AS (
  SELECT * FROM accepted
  QUALIFY ROW_NUMBER() OVER (PARTITION BY dt, category_code, id ORDER BY batch DESC) = 1
),
day_batch AS (SELECT dt, max(batch_id) AS day_batch_id FROM accepted GROUP BY dt),
dayed AS (
  SELECT s.*, d.day_batch_id FROM stored s JOIN day_batch d ON s.dt IS NOT DISTINCT FROM d.dt
)"""


def _last_batch(gold: str) -> str:
    return f"""WITH {_batched(BATCHES)}, gold AS ({gold})
SELECT * FROM gold WHERE agg_key IS NOT NULL
QUALIFY ROW_NUMBER() OVER (PARTITION BY dt, agg_key ORDER BY batch_id DESC) = 1"""


def _refreshed(gold: str) -> str:
    return f"WITH {_batched(BATCHES)}, gold AS ({gold}) SELECT * FROM gold WHERE agg_key IS NOT NULL"


def _audit(batches: int, also: str = "") -> str:
    return f"""WITH {_batched(batches)},
categories AS ({_by_category("accepted", "batch_id")}),
hours AS ({_by_hour("accepted", "batch_id")}),
sizes AS (SELECT batch_id, count(*) AS n FROM ended GROUP BY batch_id)
SELECT batch_id, n AS bronze_record_count, n AS silver_record_count,
  (SELECT count(*) FROM accepted a WHERE a.batch_id = s.batch_id) AS silver_slice_count,
  (SELECT count(*) FROM categories c WHERE c.batch_id = s.batch_id) AS gold_by_category_count,
  (SELECT count(*) FROM hours h WHERE h.batch_id = s.batch_id) AS gold_by_hour_count,
  (SELECT count(*) FROM categories c WHERE c.batch_id = s.batch_id)
    + (SELECT count(*) FROM hours h WHERE h.batch_id = s.batch_id) AS total_gold_records,
  cast(0 AS bigint) AS silver_rejected_count,
  (SELECT count(*) FROM categories c WHERE c.batch_id = s.batch_id AND agg_key IS NULL)
    + (SELECT count(*) FROM hours h WHERE h.batch_id = s.batch_id AND agg_key IS NULL)
    AS gold_rejected_count
FROM sizes s {also}"""


_ZERO = "cast(0 AS bigint)"
_EMPTY_BATCH = f"""UNION ALL
SELECT strftime(make_timestamp(max({COMMIT_COL})) + INTERVAL 1 HOUR, '%Y%m%d%H%M%S') AS batch_id,
  {", ".join([_ZERO] * 8)} FROM bronze"""

_MINUTE_US = 60_000_000

ORACLE: dict[str, str] = {
    "bronze_fixture": f"WITH {BRONZE_SQL} SELECT * FROM bronze",
    "silver_processed_at": _silver_columns("TIMESTAMP '2024-03-01 00:00:00' AS processed_at"),
    "silver_amount_cast": _silver_columns("amount"),
    "silver_quantity_cast": _silver_columns("quantity"),
    "silver_transaction_date": _silver_columns(_DATE),
    "silver_is_valid": _silver_columns("is_valid"),
    "silver_category_code": _silver_columns("category_code"),
    "silver_dt": _silver_columns("dt"),
    "silver_has_customer_id": _silver_columns("has_customer_id"),
    "silver_discount_amount": _silver_columns(_DISCOUNT),
    "silver_full": f"WITH {_SILVER_SQL} SELECT {_silver_list()} FROM silver",
    "gold_valid_filter": f"""WITH {_SILVER_SQL}
SELECT id, ver, amount, category_code, dt FROM silver WHERE is_valid""",
    "gold_by_category": f"WITH {_SILVER_SQL} {_by_category('silver', repr(BATCH_ID))}",
    "gold_by_hour": f"WITH {_SILVER_SQL} {_by_hour('silver', repr(BATCH_ID))}",
    "gold_agg_keys": f"""WITH {_SILVER_SQL}
SELECT 'by_category' AS aggregation, dt, agg_key FROM ({_by_category("silver", repr(BATCH_ID))})
UNION ALL
SELECT 'by_hour' AS aggregation, dt, agg_key FROM ({_by_hour("silver", repr(BATCH_ID))})""",
    "precombine_events": f"WITH {_SILVER_SQL} SELECT {_silver_list()} FROM silver QUALIFY {_LATEST}",
    "precombine_lineitem": f"""SELECT * FROM lineitem
QUALIFY ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate DESC, {", ".join(f"{c} DESC" for c in _LINEITEM_REST)}) = 1""",
    "insert_append": f"""WITH {BRONZE_SQL}
SELECT * REPLACE (cast(ver + 1 AS bigint) AS {COMMIT_COL}) FROM bronze""",
    "bulk_insert": f"WITH {_SILVER_SQL} SELECT {_silver_list()} FROM silver",
    "snapshot_read": f"WITH {BRONZE_SQL} SELECT * FROM bronze",
    "partitioned_layout": f"""WITH {_SILVER_SQL},
placed AS (SELECT dt, CASE WHEN ver = 0 THEN category_code END AS category_code FROM silver)
SELECT dt, category_code, count(*) AS row_count FROM placed GROUP BY ALL""",
    "incremental_read": f"""WITH {BRONZE_SQL},
bounds AS (SELECT min({COMMIT_COL}) - 1 AS begin_us, max({COMMIT_COL}) AS end_us FROM bronze)
SELECT bronze.* FROM bronze, bounds
WHERE {COMMIT_COL} > begin_us + (end_us - begin_us) // {BATCHES}
  AND {COMMIT_COL} <= begin_us + (2 * (end_us - begin_us)) // {BATCHES}""",
    "upsert_two_batches": _two_upserts("ts DESC, ver DESC", 0),
    "upsert_older_ts_loses": _two_upserts("ts DESC, ver ASC", 1),
    "upsert_commit_time": _two_upserts("ver ASC", 1),
    "upsert_partition_move": f"""WITH {_SILVER_SQL},
stored AS (SELECT * FROM silver QUALIFY {_LATEST})
SELECT id, count(*) AS partitions FROM stored GROUP BY id HAVING count(*) > 1""",
    "batch_metadata": f"""WITH {BRONZE_SQL},
slots AS (
  SELECT DISTINCT {COMMIT_COL} AS end_us, {COMMIT_COL} - {5 * _MINUTE_US} AS begin_us FROM bronze
)
SELECT begin_us, end_us, strftime(make_timestamp(end_us), '%Y%m%d%H%M%S') AS batch_id,
  strftime(make_timestamp(begin_us), '%Y-%m-%d %H:%M:%S.%f') AS start_time,
  strftime(make_timestamp(end_us), '%Y-%m-%d %H:%M:%S.%f') AS end_time,
  strftime(make_timestamp(end_us), '%Y-%m-%d') AS batch_date,
  strftime(make_timestamp(end_us), '%H') AS batch_hour,
  strftime(make_timestamp(end_us), '%M') AS batch_minute
FROM slots""",
    "batch_counts": _audit(BATCHES),
    "empty_batch_guard": _audit(1, _EMPTY_BATCH),
    "batches_end_to_end": f"WITH {_batched(BATCHES)} SELECT {_silver_list('end_us')} FROM stored",
    "gold_last_batch_wins": _last_batch(_by_category("accepted", "batch_id")),
    "gold_last_batch_wins_by_hour": _last_batch(_by_hour("accepted", "batch_id")),
    "gold_refresh": _refreshed(_by_category("dayed", "day_batch_id")),
    "gold_refresh_by_hour": _refreshed(_by_hour("dayed", "day_batch_id")),
    "gold_processed_at": f"""WITH {_batched(BATCHES)}
SELECT category_code, dt, max(make_timestamp(end_us)) AS processed_at
FROM accepted WHERE is_valid AND {_CATEGORY_KEY.split(" AS ")[0]} IS NOT NULL GROUP BY ALL""",
    "gold_refresh_emptied_day": _refreshed(_by_category("dayed", "day_batch_id"))
    + " AND dt <> (SELECT min(dt) FROM silver)",
    "scheduled_batches": f"""WITH {_batched(BATCHES)},
seen AS (SELECT batch, max({COMMIT_COL}) AS seen_us FROM ended GROUP BY batch)
SELECT {_silver_list("seen_us")} FROM stored JOIN seen USING (batch)""",
    "backfill_older_window": f"""WITH {_batched(BATCHES)}
SELECT {_silver_list("CASE WHEN batch = 1 THEN last_us + 1 ELSE end_us END")} FROM stored""",
    "bronze_new_column": f"""WITH {_batched(1)}
SELECT {_silver_list("end_us")}, CASE WHEN ver = 1 THEN concat('c', id) END AS extra FROM stored""",
    "upsert_replay": _two_upserts("ts DESC, ver DESC", 0),
    "stream_available_now": _two_upserts("ts DESC, ver DESC", 0),
    "gold_totals": _refreshed(_by_category("dayed", "day_batch_id")),
    "gold_totals_by_hour": _refreshed(_by_hour("dayed", "day_batch_id")),
    "gold_totals_emptied_day": _refreshed(_by_category("dayed", "day_batch_id"))
    + " AND dt <> (SELECT min(dt) FROM silver)",
    "table_probe": """SELECT * FROM (VALUES ('bronze_events', true), ('silver_events', true),
  ('gold_agg_by_category', true), ('gold_agg_by_day', false)) AS t(table_name, present)
WHERE (SELECT count(*) FROM events) > 0""",
    "stream_epoch_replay": f"""WITH {_SILVER_SQL}
SELECT {_silver_list("cast(7 AS bigint)")} FROM silver QUALIFY {_LATEST}""",
    "stream_then_scheduled": f"""WITH {_SILVER_SQL}
SELECT * EXCLUDE ({COMMIT_COL}) FROM (SELECT {_silver_list()} FROM silver
QUALIFY ROW_NUMBER() OVER (PARTITION BY dt, category_code, id ORDER BY ts DESC, ver ASC) = 1)""",
    "stream_progress": f"""WITH {BRONZE_SQL}
SELECT cast(ver AS bigint) AS epoch_id, count(*) > 0 AS read_rows FROM bronze GROUP BY ver""",
    "bulk_insert_clustered": f"WITH {_SILVER_SQL} SELECT {_silver_list()} FROM silver",
}
