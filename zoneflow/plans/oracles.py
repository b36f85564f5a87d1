"""The SQL each registered query is checked against; plain text for any SQL engine."""

from __future__ import annotations

from zoneflow.operators.cv import FEATURES
from zoneflow.plans.tables import ROW_KEYS

KEYS = ", ".join(ROW_KEYS)


def r(expr: str, digits: int, name: str | None = None) -> str:
    return f"round({expr}, {digits}) AS {name or expr}"


TRIPS = f"""
trips AS (
  SELECT {KEYS}, l_shipdate AS tpep_pickup_datetime, CAST(l_suppkey AS INTEGER) AS PULocationID,
         l_quantity AS trip_distance, CAST(l_linenumber AS DOUBLE) AS passenger_count,
         l_extendedprice AS fare_amount, l_extendedprice * l_tax AS tip_amount
  FROM lineitem),
m AS (
  SELECT * FROM trips
  WHERE tpep_pickup_datetime >= TIMESTAMP '1996-01-01' AND tpep_pickup_datetime < TIMESTAMP '2000-01-01'
    AND fare_amount > 0 AND trip_distance > 0 AND PULocationID IS NOT NULL AND passenger_count IS NOT NULL),
zones AS (
  SELECT CAST(s_suppkey AS INTEGER) AS LocationID, n_name AS Borough, s_name AS Zone
  FROM supplier JOIN nation ON s_nationkey = n_nationkey)"""

FEATS = """
feat AS (
  SELECT PULocationID, count(*) AS n_trips, avg(fare_amount) AS mean_fare,
         avg(tip_amount / greatest(fare_amount, 0.01)) AS mean_tip_ratio,
         quantile_cont(trip_distance, 0.9) AS p90_distance,
         median(fare_amount / greatest(trip_distance, 0.1)) AS fare_per_km
  FROM m LEFT JOIN zones ON PULocationID = LocationID GROUP BY PULocationID)"""

ZONE_FEATURES = f"""WITH {TRIPS}, {FEATS}
SELECT PULocationID AS zone, n_trips, {r('mean_fare', 6)}, {r('mean_tip_ratio', 6)},
       {r('p90_distance', 6)}, {r('fare_per_km', 6)} FROM feat"""


def _hash(seed: str, columns: list[str] = ROW_KEYS) -> str:
    """Keys that are never null, each with its length."""
    keys = " || '/' || ".join(f"length(CAST({k} AS VARCHAR)) || ':' || CAST({k} AS VARCHAR)" for k in columns)
    return f"CAST('0x' || substr(md5('{seed}/' || {keys}), 1, 15) AS BIGINT)"


BUCKET = _hash("sample436")
FOLD = f"CAST({_hash('fold')} % 5 AS INTEGER)"

SAMPLE = f"""
s AS (SELECT m.*, f.mean_fare, f.mean_tip_ratio, f.p90_distance, f.fare_per_km, {FOLD} AS fold
      FROM m JOIN feat f ON m.PULocationID = f.PULocationID)"""

_ROUNDED = ", ".join(r(c, 6) for c in FEATURES[2:])


def _moments() -> dict[str, str]:
    p = len(FEATURES)
    out = {"my": "avg(y)", "vyy": "var_pop(y)"} | {f"m{i}": f"avg(x{i})" for i in range(p)}
    out |= {f"v{i}y": f"covar_pop(y, x{i})" for i in range(p)}
    return out | {f"v{i}x{k}": f"covar_pop(x{k}, x{i})" for i in range(p) for k in range(i, p)}


def _moment_sql(per: str) -> str:
    digits = lambda c: 1 if c == "vyy" else 3 if c.endswith("y") else 5
    named = ", ".join(f"{c} AS x{i}" for i, c in enumerate(FEATURES))
    sums = ", ".join(f"round({e}, {digits(c)}) + 0.0 AS {c}" for c, e in _moments().items())
    source = "z" if per == "fold" else "(SELECT h.fold, z.* EXCLUDE (fold) FROM z JOIN (SELECT DISTINCT fold FROM z) h ON h.fold <> z.fold)"
    return f"""WITH {TRIPS}, {FEATS}, {SAMPLE}, z AS (SELECT fold, {named}, fare_amount AS y FROM s)
SELECT fold, CAST(count(*) AS BIGINT) AS n, {sums} FROM {source} GROUP BY fold"""


ZONE_FARE = """zf AS (SELECT CAST(l_orderkey % 265 AS INTEGER) AS zone,
  ((l_orderkey * 7919) % 10000) / CAST(100.0 AS DOUBLE) AS fare FROM lineitem)"""
BY_ZONE = f"WITH {ZONE_FARE} SELECT zone, count(*) AS n, {r('avg(fare)', 6, 'avg_fare')} FROM zf GROUP BY zone"

# What the logs of every line item say, straight from its columns.
PATH = "concat_ws('/', l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(floor(l_extendedprice) AS BIGINT))"
BLOCKS = f"""
li AS (SELECT *, {PATH} AS path, CAST(floor(l_quantity) AS BIGINT) AS q, CAST(floor(l_extendedprice) AS BIGINT) AS price,
              CAST(floor(l_discount * 100 + 0.5) AS BIGINT) AS d, l_linenumber % 2 = 1 AS odd,
              CAST(floor(l_discount * 100 + 0.5) AS BIGINT) = 10 AS died FROM lineitem),
blocks AS (
  SELECT path, l_orderkey, CAST(0 AS INTEGER) AS block, 'duckdb' AS mode, '1_duckdb' AS stage, 'scan' AS phase, q AS wall,
         CAST(NULL AS BIGINT) AS bytes, CAST(NULL AS VARCHAR) AS rest_target, CAST(NULL AS VARCHAR) AS note, 9 AS n_keys
  FROM li WHERE NOT odd AND NOT died
  UNION ALL
  SELECT path, l_orderkey, 0, 'rest', '2_emr', 'A_aggregate', q, price, 'advertised', 'a=b=' || l_suppkey, 12 FROM li WHERE odd AND NOT died
  UNION ALL
  SELECT path, l_orderkey, 1, CASE WHEN l_returnflag = 'R' THEN 'degraded' ELSE 'rest' END, '2_emr', 'B_fit', q + 7,
         NULL, 'advertised', NULL, 12 FROM li WHERE odd AND NOT died)"""


def _ledger_sql(resource: str, nodes: int, startup: str) -> str:
    return f"""SELECT path, stage, {resource} AS resource_id, '{nodes}' AS nodes, phase, '' AS predicted_s,
  CAST(wall AS VARCHAR) AS wall_s, '{startup}' AS startup_s, coalesce(CAST(bytes AS VARCHAR), '') AS shuffle_write_bytes,
  '' AS task_min_s, '' AS task_med_s, '' AS task_max_s, '' AS cost_usd FROM blocks"""


STAGES = """
jobs AS (SELECT o_custkey AS run, o_orderkey AS stage_id, CASE WHEN o_orderkey % 7 <> 0 THEN o_orderpriority END AS phase, o_orderkey * 1000 AS t0,
                o_orderkey * 1000 + CAST(floor(o_totalprice) AS BIGINT) * 100 AS t1 FROM orders WHERE o_orderkey % 11 <> 0),
tasks AS (
  SELECT o_custkey AS run, o_orderkey AS stage_id, CAST(l_linenumber % 2 AS BIGINT) AS attempt_id,
         l_returnflag <> 'R' AS ok, CAST(l_quantity * 1000 AS DOUBLE) AS ms,
         CAST(floor(l_extendedprice) AS BIGINT) AS w,
         CASE WHEN l_discount > 0.05 THEN CAST(floor(l_extendedprice) AS BIGINT) ELSE 0 END AS r
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_orderkey % 17 <> 0),
ended AS (
  SELECT o_custkey AS run, o_orderkey AS stage_id, CAST(a AS BIGINT) AS attempt_id, o_custkey % 50 + 1 AS num_tasks,
         CASE WHEN o_orderstatus = 'F' AND a = 0 THEN 'FAILED' ELSE 'COMPLETE' END AS status
  FROM orders, (VALUES (0), (1)) v(a) WHERE (a = 0 OR o_orderkey % 3 = 0) AND o_orderkey % 13 <> 0),
sums AS (
  SELECT run, stage_id, attempt_id, count(*) FILTER (ok) AS done, count(*) FILTER (NOT ok) AS failed,
         sum(w) AS w, sum(r) AS r FROM tasks GROUP BY ALL),
attempts AS (
  SELECT e.*, coalesce(done, 0) AS done, coalesce(failed, 0) AS failed, coalesce(w, 0) AS w, coalesce(r, 0) AS r
  FROM ended e LEFT JOIN sums s USING (run, stage_id, attempt_id)),
per_stage AS (
  SELECT run, stage_id, max(attempt_id) AS attempt_id, count(*) AS n_attempts, bool_or(status <> 'COMPLETE') AS bad
  FROM attempts GROUP BY run, stage_id),
latest AS (
  SELECT a.*, p.n_attempts, j.phase, (p.n_attempts > 1 OR p.bad OR a.failed > 0) AS retried
  FROM attempts a JOIN per_stage p USING (run, stage_id, attempt_id) LEFT JOIN jobs j USING (run, stage_id)),
q AS (
  SELECT run, stage_id, attempt_id, min(ms) AS min_ms, max(ms) AS max_ms,
         list_sort(list(ms))[least(CAST(floor(count(*) * 0.5) AS BIGINT), count(*) - 1) + 1] AS med_ms
  FROM tasks WHERE ok GROUP BY run, stage_id, attempt_id)"""

TASK_QUANTILES = f"WITH {STAGES} SELECT run, stage_id, attempt_id, min_ms, max_ms, med_ms FROM q"

ROLLUP = """
span AS (SELECT run, phase, round((max(t1) - min(t0)) / 1000, 1) AS job_span_s, round(max(t1) / 1000, 1) AS ended_at_epoch_s, true AS known
         FROM jobs GROUP BY run, phase),
roll AS (
  SELECT run, phase, CAST(sum(w) AS BIGINT) AS shuffle_write_bytes,
         coalesce(max(CASE WHEN r > 0 THEN num_tasks END), max(num_tasks)) AS partitions,
         CAST(sum(done) AS BIGINT) AS tasks, CAST(max(CAST(retried AS INTEGER)) AS INTEGER) AS retried,
         count(*) FILTER (retried) AS n_retried_stages,
         round(coalesce(min(min_ms), 0) / 1000, 1) AS task_min_s, round(coalesce(max(med_ms), 0) / 1000, 1) AS task_med_s,
         round(coalesce(max(max_ms), 0) / 1000, 1) AS task_max_s, true AS seen
  FROM latest LEFT JOIN q USING (run, stage_id, attempt_id) GROUP BY run, phase),
rolled AS (
  SELECT coalesce(s.run, r.run) AS run, CASE WHEN known THEN s.phase ELSE r.phase END AS phase, job_span_s, ended_at_epoch_s,
         CASE WHEN seen THEN 'rest' ELSE 'degraded' END AS mode, coalesce(shuffle_write_bytes, 0) AS shuffle_write_bytes,
         coalesce(partitions, 0) AS partitions, coalesce(tasks, 0) AS tasks, coalesce(retried, 0) AS retried,
         coalesce(n_retried_stages, 0) AS n_retried_stages, coalesce(task_min_s, 0) AS task_min_s,
         coalesce(task_med_s, 0) AS task_med_s, coalesce(task_max_s, 0) AS task_max_s
  FROM span s FULL JOIN roll r ON s.run = r.run AND s.phase IS NOT DISTINCT FROM r.phase)"""

LEDGER = """
led AS (
  SELECT CASE WHEN l_linenumber = 7 THEN '1_duckdb' ELSE '2_emr' END AS stage, l_orderkey AS resource_id,
         CAST(CASE WHEN l_linenumber = 7 THEN 1 WHEN l_linenumber % 2 = 0 THEN 2 ELSE 4 END AS INTEGER) AS nodes,
         CASE WHEN l_linenumber = 7 THEN 'scan' WHEN l_linenumber <= 3 THEN 'A_aggregate' ELSE 'B_fit' END AS phase,
         l_quantity AS wall_s, l_discount * 100 AS startup_s, l_partkey AS instance_type FROM lineitem)"""

# The same stages under the names of twenty applications.
APP_STAGES = STAGES.replace("o_custkey AS run", "'app-' || (o_custkey % 20) AS run")
SKEWED = "k AS (SELECT CASE WHEN l_orderkey % 10 < 3 THEN 0 ELSE l_partkey END AS key FROM lineitem)"


def _at(value: str, nodes: int) -> str:
    return f"max(CASE WHEN nodes = {nodes} THEN {value} END)"


def _grid_map_sql() -> str:
    """Rounds 1 to 4 of the one-feature fit: regression on the other folds, scored on this one."""
    return f"""WITH {TRIPS},
d AS (SELECT {FOLD} AS fold, trip_distance AS x, fare_amount AS y FROM m),
w AS (SELECT h.fold, regr_slope(d.y, d.x) AS w1, regr_intercept(d.y, d.x) AS w0, avg(d.y) AS my
      FROM d JOIN (SELECT DISTINCT fold FROM d) h ON d.fold <> h.fold GROUP BY h.fold),
c AS (SELECT CAST(range AS INTEGER) AS combo, CAST(range + 1 AS INTEGER) AS rounds FROM range(4))
SELECT combo, d.fold, rounds,
       {r('avg(power(power(0.5, rounds) * (w0 + w1 * x) + (1 - power(0.5, rounds)) * my - y, 2))', 2, 'score')}
FROM d JOIN w ON d.fold = w.fold, c GROUP BY combo, d.fold, rounds"""


def _grid_two_sql() -> str:
    """Rounds 1 to 4 of the two-feature fit, solved by hand from centred moments of the other folds."""
    return f"""WITH {TRIPS},
d AS (SELECT {FOLD} AS fold, trip_distance AS x, passenger_count AS z, fare_amount AS y FROM m),
t AS (SELECT h.fold, avg(x) AS mx, avg(z) AS mz, avg(y) AS my, var_pop(x) AS xx, var_pop(z) AS zz, covar_pop(x, z) AS xz,
             covar_pop(x, y) AS xy, covar_pop(z, y) AS zy
      FROM d JOIN (SELECT DISTINCT fold FROM d) h ON d.fold <> h.fold GROUP BY h.fold),
w AS (SELECT *, (xy * zz - zy * xz) / (xx * zz - xz * xz) AS bx, (zy * xx - xy * xz) / (xx * zz - xz * xz) AS bz FROM t),
c AS (SELECT CAST(range AS INTEGER) AS combo, CAST(range + 1 AS INTEGER) AS rounds FROM range(4))
SELECT combo, d.fold, rounds, {r('avg(power(my + power(0.5, rounds) * (bx * (x - mx) + bz * (z - mz)) - y, 2))', 2, 'score')}
FROM d JOIN w ON d.fold = w.fold, c GROUP BY combo, d.fold, rounds"""


# File sizes and footers are read where the checked tables lie.
CHECKED_DIR = "/root/testdata/sf0.01"
NEEDED = "'l_shipdate', 'l_suppkey', 'l_quantity', 'l_linenumber', 'l_extendedprice', 'l_tax'"
BYTES = f"""CAST(sum(total_compressed_size) AS BIGINT) AS bytes_on_disk,
  CAST(sum(CASE WHEN path_in_schema IN ({NEEDED}) THEN total_compressed_size END) AS BIGINT) AS bytes_needed"""

ORACLES: dict[str, str] = {
    "scan_count": "SELECT count(*) AS rows_in FROM lineitem",
    "union_by_name": """SELECT l_suppkey AS loc, CAST(l_linenumber AS DOUBLE) AS pc, l_quantity AS dist,
  CASE WHEN l_linenumber > 3 THEN l_tax END AS surcharge FROM lineitem""",
    "csv_lookup": f"WITH {TRIPS} SELECT LocationID, Borough, Zone FROM zones",
    "gen_zone_fare": f"WITH {ZONE_FARE} SELECT zone, fare FROM zf",
    "model_matrix": f"""WITH {TRIPS} SELECT tpep_pickup_datetime, PULocationID, trip_distance, passenger_count,
  fare_amount, tip_amount FROM m""",
    "matrix_profile": f"""WITH {TRIPS} SELECT (SELECT count(*) FROM trips) AS rows_in, count(*) AS rows_out,
  {r('sum(passenger_count)', 2, 'sum_passengers')}, {r('sum(tip_amount)', 2, 'sum_tip')},
  {r('sum(fare_amount)', 2, 'sum_fare')}, {r('sum(trip_distance)', 2, 'sum_distance')},
  max(tpep_pickup_datetime) AS max_ts, max(PULocationID) AS max_zone,
  count(*) FILTER (tip_amount IS NULL) AS nulls_tip, count(*) FILTER (passenger_count IS NULL) AS nulls_passengers FROM m""",
    "dropna_subset": f"""SELECT {KEYS}, l_extendedprice, l_quantity, l_tax FROM lineitem
  WHERE NOT (l_discount = 0.05) AND NOT (l_tax = 0.03)""",
    "null_counts": """SELECT CAST(0 AS BIGINT) AS nulls_l_orderkey, count(*) FILTER (l_discount = 0.05) AS nulls_l_extendedprice,
  count(*) FILTER (l_tax = 0.03) AS nulls_l_quantity, CAST(0 AS BIGINT) AS nulls_l_tax FROM lineitem""",
    "zone_lookup_join": f"""WITH {TRIPS} SELECT Borough, count(*) AS n_trips, {r('sum(fare_amount)', 2, 'sum_fare')},
  max(Zone) AS last_zone FROM m LEFT JOIN zones ON PULocationID = LocationID GROUP BY Borough""",
    "lookup_unique": f"""WITH {TRIPS}, k AS (SELECT LocationID, count(*) AS n FROM zones GROUP BY LocationID)
SELECT count(*) AS n_keys, count(*) FILTER (n > 1) AS n_duplicated, count(*) FILTER (n > 1) = 0 AS is_unique FROM k""",
    "key_skew": f"""WITH {TRIPS}, k AS (SELECT PULocationID, count(*) AS n FROM m GROUP BY PULocationID)
SELECT CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_keys, max(n) AS max_rows, {r('max(n) / sum(n)', 9, 'max_share')} FROM k""",
    "zone_features": ZONE_FEATURES,
    "zone_features_skewed": ZONE_FEATURES,
    "zone_features_grouped": ZONE_FEATURES,
    "zone_features_approx": f"""WITH {TRIPS}, {FEATS} SELECT PULocationID AS zone, n_trips, true AS p90_distance_fine,
  true AS fare_per_km_fine FROM feat""",
    "agg_native": BY_ZONE,
    "agg_sql": BY_ZONE,
    "agg_grouped_map": BY_ZONE,
    "agg_two_level": BY_ZONE,
    "agg_two_level_pandas": BY_ZONE,
    "five_way_agreement": f"""WITH {ZONE_FARE} SELECT zone, CAST(5 AS BIGINT) AS n_methods, count(*) AS n, true AS agree
  FROM zf GROUP BY zone""",
    "agreement_totals": f"""WITH {ZONE_FARE} SELECT count(DISTINCT zone) AS n_zones, count(*) AS n_rows, true AS all_agree FROM zf""",
    "distinct_keys": f"WITH {TRIPS} SELECT DISTINCT PULocationID FROM m ORDER BY PULocationID",
    "any_value_by": f"""WITH {TRIPS} SELECT PULocationID, any_value(Zone) AS Zone, count(*) AS n
  FROM m LEFT JOIN zones ON PULocationID = LocationID GROUP BY PULocationID""",
    "hash_sample": f"SELECT {KEYS}, l_extendedprice AS fare_amount FROM lineitem WHERE {BUCKET} < {int(0.4 * 2**60)}",
    "target_sample": f"""SELECT {KEYS} FROM lineitem
  WHERE {BUCKET} < CAST(floor(least(1.0, CAST(20000 AS DOUBLE) / (SELECT count(*) FROM lineitem)) * CAST({2**60} AS DOUBLE)) AS BIGINT)""",
    "kfold_assign": f"SELECT {KEYS}, {FOLD} AS fold FROM lineitem",
    "sample_features": f"""WITH {TRIPS}, {FEATS}, {SAMPLE} SELECT {KEYS}, PULocationID, trip_distance, passenger_count,
  {_ROUNDED}, fare_amount FROM s WHERE {BUCKET} < {int(0.4 * 2**60)}""",
    "design_matrix": f"""WITH {TRIPS}, {FEATS}, {SAMPLE} SELECT {KEYS}, CAST(1.0 AS DOUBLE) AS intercept, trip_distance,
  passenger_count, {_ROUNDED}, fare_amount FROM s""",
    "fold_statistics": _moment_sql("fold"),
    "kfold_train_stats": _moment_sql("others"),
    "grid_scores": f"""WITH {TRIPS}, d AS (SELECT {FOLD} AS fold, fare_amount AS y FROM m),
w AS (SELECT h.fold, avg(d.y) AS my FROM d JOIN (SELECT DISTINCT fold FROM d) h ON d.fold <> h.fold GROUP BY h.fold),
c AS (SELECT CAST(range AS INTEGER) AS combo, CAST(50 * (1 + range) AS INTEGER) AS rounds FROM range(12))
SELECT combo, d.fold, rounds, {r('avg((y - my) * (y - my))', 2, 'score')}
FROM d JOIN w ON d.fold = w.fold, c GROUP BY combo, d.fold, rounds""",
    "grid_map": _grid_map_sql(),
    "grid_scores_two": _grid_two_sql(),
    "pinned_partitions": f"""WITH {TRIPS} SELECT count(*) AS n_rows, count(DISTINCT PULocationID) AS n_keys, true AS whole_keys, true AS pinned FROM m""",
    "grid_parallelism": f"""SELECT CAST(12 * count(DISTINCT {FOLD}) AS BIGINT) AS cells, CAST(1 AS INTEGER) AS one_cell, true AS some FROM lineitem""",
    "stored_matrix": f"WITH {TRIPS} SELECT count(*) AS rows_out, true AS same_rows, true AS same_values FROM m",
    "throughput": f"""WITH {BLOCKS} SELECT path, round(price * 1000 * d / 8.0 / 1e6 / l_linenumber / 8, 1) AS mb_per_s_per_core
  FROM li WHERE NOT odd AND NOT died""",
    "shipping_seconds": """SELECT o_orderpriority, count(*) AS n, sum(CAST(epoch_us(l_shipdate) - epoch_us(o_orderdate) AS DOUBLE) / 1e6) AS seconds,
  min(CAST(epoch_us(l_shipdate) - epoch_us(o_orderdate) AS DOUBLE) / 1e6) AS least,
  max(CAST(epoch_us(l_shipdate) - epoch_us(o_orderdate) AS DOUBLE) / 1e6) AS most
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_orderpriority""",
    "file_inventory": f"""SELECT count(*) AS n_files, CAST(sum(size) AS BIGINT) AS total_bytes, count(*) = 14 AS complete
  FROM read_blob('{CHECKED_DIR}/*.parquet')""",
    "column_footprint": f"""SELECT path_in_schema, CAST(sum(total_compressed_size) AS BIGINT) AS compressed_bytes,
  path_in_schema IN ({NEEDED}) AS needed FROM parquet_metadata('{CHECKED_DIR}/lineitem.parquet') GROUP BY path_in_schema""",
    "byte_totals": f"SELECT {BYTES} FROM parquet_metadata('{CHECKED_DIR}/lineitem.parquet')",
    "scan_block": f"""WITH {TRIPS}, b AS (SELECT {BYTES} FROM parquet_metadata('{CHECKED_DIR}/lineitem.parquet'))
SELECT 'duckdb' AS mode, bytes_on_disk, bytes_needed, (SELECT count(*) FROM trips) AS rows_in, (SELECT count(*) FROM m) AS rows_out FROM b""",
    "timed_scan": f"""WITH {TRIPS}, b AS (SELECT {BYTES} FROM parquet_metadata('{CHECKED_DIR}/lineitem.parquet'))
SELECT bytes_on_disk, bytes_needed, (SELECT count(*) FROM trips) AS rows_in, (SELECT count(*) FROM m) AS rows_out, true AS times_fit, true AS rate_fits FROM b""",
    "timed_grid": f"""SELECT CAST(4 * count(DISTINCT {FOLD}) AS BIGINT) AS fits_done, true AS timed, CAST(4 * count(DISTINCT {FOLD}) AS BIGINT) AS n_scores
  FROM lineitem""",
    "format_blocks": f"""SELECT {PATH} AS path, '===A2-METRICS v2.0 mode=rest phase=' || l_returnflag || '===' || chr(10)
  || 'wall_s=' || l_linenumber || chr(10) || 'zone=' || l_suppkey || chr(10) || 'status=' || l_linestatus || chr(10)
  || '===END===' AS text FROM lineitem""",
    "parse_run_log": f"""WITH {BLOCKS} SELECT path, block, '2.0' AS listener_version, mode, phase, CAST(wall AS VARCHAR) AS wall_s,
  rest_target, note, CAST(n_keys AS INTEGER) AS n_keys FROM blocks""",
    "parse_log_files": f"""WITH {BLOCKS} SELECT phase, mode, count(*) AS n_blocks, CAST(sum(wall) AS BIGINT) AS sum_wall_s
  FROM blocks GROUP BY phase, mode""",
    "ledger_rows": f"WITH {BLOCKS} {_ledger_sql("'r-' || l_orderkey", 2, '60')}",
    "ledger_lines": f"""WITH {BLOCKS} SELECT path, concat_ws(',', stage, 'r-1', '4', phase, '', wall, '',
  coalesce(CAST(bytes AS VARCHAR), ''), '', '', '', '') AS line FROM blocks""",
    "ledger_csv": f"""WITH {BLOCKS} SELECT stage, phase, count(*) AS n_rows, count(*) AS n_wall_s,
  count(bytes) AS n_shuffle_write_bytes, CAST(0 AS BIGINT) AS n_predicted_s FROM blocks GROUP BY stage, phase""",
    "log_line_counts": f"""SELECT {PATH} AS path,
  CAST(CASE WHEN floor(l_discount * 100 + 0.5) = 10 THEN 0 WHEN l_linenumber % 2 = 1 THEN 2 ELSE 1 END AS BIGINT) AS n_blocks,
  CAST(l_linenumber AS BIGINT) AS n_executors FROM lineitem""",
    "document_line_counts": """WITH l AS (SELECT source AS path, unnest(string_split(text, chr(10))) AS line FROM documents)
SELECT path, count(*) AS n_lines, count(*) FILTER (contains(line, 'License')) AS n_license,
  count(*) FILTER (contains(line, 'http')) AS n_links FROM l GROUP BY path""",
    "lines_with_prefix": """WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
SELECT doc_id, line FROM l
WHERE starts_with(line, 'The') OR starts_with(line, 'Copyright') OR starts_with(line, 'Licensed')""",
    "run_checks": f"""WITH {BLOCKS}, c AS (
  SELECT path, CAST(CASE WHEN died THEN 0 WHEN odd THEN 2 ELSE 1 END AS BIGINT) AS n_blocks, NOT died AS blocks_ok,
    died OR NOT odd OR l_returnflag <> 'R' AS mode_ok, died OR NOT odd OR l_returnflag <> 'A' AS retried_ok,
    died OR NOT odd OR (l_linestatus = 'O' AND l_suppkey % 10 <> 3) AS pin_ok, died OR odd OR (d > 0 AND d * 125 < 1000) AS bytes_ok,
    died OR odd OR price * d * 125 * 8 / 1e9 / l_linenumber < 12.5 AS rate_ok,
    CASE WHEN died OR odd THEN l_suppkey % 2 = 0 OR l_linenumber = 4 END AS executors_ok FROM li)
SELECT *, blocks_ok AND mode_ok AND retried_ok AND pin_ok AND bytes_ok AND rate_ok AND coalesce(executors_ok, true) AS valid FROM c""",
    "rolled_event_logs": f"WITH {APP_STAGES}, {ROLLUP} SELECT * FROM rolled",
    "run_nodes": """SELECT 'app-' || (o_custkey % 20) AS run, count(*) AS n_executors, count(DISTINCT o_orderpriority) AS nodes
  FROM orders GROUP BY ALL""",
    "busy_times": """WITH j AS (
  SELECT o_custkey % 20 AS run, CASE WHEN o_orderkey % 7 <> 0 THEN o_orderpriority END AS phase, o_orderkey * 1000 AS t0,
         o_orderkey * 1000 + CAST(floor(o_totalprice) AS BIGINT) * 100 AS t1 FROM orders WHERE o_orderkey % 11 <> 0),
b AS (SELECT *, coalesce(t0 > max(t1) OVER (PARTITION BY run, phase ORDER BY t0, t1 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS new FROM j),
i AS (SELECT *, sum(CAST(new AS INTEGER)) OVER (PARTITION BY run, phase ORDER BY t0, t1 ROWS UNBOUNDED PRECEDING) AS island FROM b),
s AS (SELECT run, phase, island, min(t0) AS t0, max(t1) AS t1 FROM i GROUP BY ALL)
SELECT run, phase, round(CAST(sum(t1 - t0) AS DOUBLE) / 1000, 1) AS busy_s,
       round(CAST(max(t1) - min(t0) - sum(t1 - t0) AS DOUBLE) / 1000, 1) AS idle_s, count(*) AS n_islands FROM s GROUP BY run, phase""",
    "pruned_bytes": f"""WITH g AS (
  SELECT regexp_extract(file_name, '([a-z]+)[.]parquet', 1) AS name, row_group_id, sum(total_compressed_size) AS b,
    sum(CASE WHEN path_in_schema IN ({NEEDED}, 'o_orderdate', 'o_totalprice') THEN total_compressed_size END) AS need,
    max(CASE WHEN path_in_schema IN ('l_shipdate', 'o_orderdate') THEN CAST(stats_max_value AS TIMESTAMP) END) AS most,
    min(CASE WHEN path_in_schema IN ('l_shipdate', 'o_orderdate') THEN CAST(stats_min_value AS TIMESTAMP) END) AS least
  FROM parquet_metadata(['{CHECKED_DIR}/lineitem.parquet', '{CHECKED_DIR}/orders.parquet']) GROUP BY file_name, row_group_id),
k AS (SELECT *, coalesce(NOT (most < TIMESTAMP '2001-09-01' OR least >= TIMESTAMP '2001-11-01'), true) AS kept FROM g)
SELECT name, count(*) AS n_groups, count(*) FILTER (kept) AS n_kept, CAST(sum(b) AS BIGINT) AS bytes_on_disk, CAST(sum(need) AS BIGINT) AS bytes_needed,
  CAST(coalesce(sum(need) FILTER (kept), 0) AS BIGINT) AS bytes_kept FROM k GROUP BY name""",
    "longest_gaps": f"""WITH {TRIPS}, g AS (
  SELECT PULocationID, epoch_us(tpep_pickup_datetime) - lag(epoch_us(tpep_pickup_datetime)) OVER (PARTITION BY PULocationID ORDER BY tpep_pickup_datetime) AS gap FROM m)
SELECT PULocationID, count(*) AS n, max(gap) / 1e6 AS longest_gap FROM g GROUP BY PULocationID""",
    "grid_scores_factors": _grid_two_sql(),
    "hot_keys": f"WITH {SKEWED} SELECT key, count(*) AS n FROM k GROUP BY key HAVING count(*) >= ceil(0.01 * (SELECT count(*) FROM k))",
    "split_hot_key": "SELECT count(*) AS n_rows, CAST(10 AS BIGINT) AS hot_chunks, true AS even FROM lineitem",
    "exact_sample": f"""SELECT {KEYS}, l_extendedprice FROM lineitem ORDER BY {_hash('sample436', [*ROW_KEYS, 'l_extendedprice'])}, {KEYS}, l_extendedprice LIMIT 20000""",
    "kfold_by_place": f"""SELECT {KEYS}, l_extendedprice,
  CAST((row_number() OVER (ORDER BY {KEYS}, l_extendedprice) - 1) % 5 AS INTEGER) AS fold FROM lineitem""",
    "changed_rows": """WITH a AS (SELECT l_linenumber, l_returnflag, l_linestatus, l_tax, count(*) AS n FROM lineitem
  WHERE l_linenumber = 7 AND l_returnflag = 'R' GROUP BY ALL)
SELECT l_linenumber, l_returnflag, l_linestatus, l_tax, n AS n_left, CAST(0 AS BIGINT) AS n_right FROM a WHERE l_tax IS NOT NULL
UNION ALL SELECT l_linenumber, l_returnflag, l_linestatus, NULL, 0, CAST(sum(n) AS BIGINT) FROM a WHERE l_tax IS NOT NULL GROUP BY ALL""",
    "grid_task_map": f"""WITH {TRIPS}, f AS (SELECT {FOLD} AS fold, count(*) AS n, sum(trip_distance) AS s FROM m GROUP BY ALL),
c AS (SELECT CAST(range AS INTEGER) AS combo, CAST(range + 1 AS INTEGER) AS rounds FROM range(4))
SELECT combo, fold, rounds, CAST((SELECT sum(n) FROM f) - n AS BIGINT) AS n_train,
       {r('((SELECT sum(s) FROM f) - s) / ((SELECT sum(n) FROM f) - n) * (1 - power(0.5, rounds))', 6, 'damped')} FROM f, c""",
    "stage_rollup": f"WITH {STAGES}, {ROLLUP} SELECT * FROM rolled",
    "event_ledger": f"""WITH {STAGES}, {ROLLUP}
SELECT run, '2_emr' AS stage, 'r-1' AS resource_id, '4' AS nodes, split_part(coalesce(phase, 'None'), ' ', 1) AS phase, '' AS predicted_s,
  coalesce(CAST(job_span_s AS VARCHAR), 'None') AS wall_s, '' AS startup_s, CAST(shuffle_write_bytes AS VARCHAR) AS shuffle_write_bytes,
  CAST(task_min_s AS VARCHAR) AS task_min_s, CAST(task_med_s AS VARCHAR) AS task_med_s, CAST(task_max_s AS VARCHAR) AS task_max_s,
  '' AS cost_usd FROM rolled""",
    "latest_attempts": f"""WITH {STAGES} SELECT run, stage_id, phase, n_attempts, failed AS num_failed_tasks FROM latest WHERE retried""",
    "task_quantiles": TASK_QUANTILES,
    "task_quantiles_skewed": TASK_QUANTILES,
    "not_seen_before": f"""WITH {STAGES} SELECT run, stage_id, attempt_id, num_tasks, status FROM attempts
  WHERE stage_id NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""",
    "ledger_compare": f"""WITH {LEDGER},
p AS (SELECT o_orderkey AS resource_id, stage, phase, nodes, o_totalprice / nodes AS predicted_s FROM orders,
      (VALUES ('1_duckdb', 'scan', 1), ('2_emr', 'A_aggregate', 2), ('2_emr', 'A_aggregate', 4),
              ('2_emr', 'B_fit', 2), ('2_emr', 'B_fit', 4)) v(stage, phase, nodes) WHERE o_orderkey % 5 <> 0),
j AS (SELECT led.*, predicted_s FROM led LEFT JOIN p USING (resource_id, stage, phase, nodes))
SELECT resource_id, phase, {r(_at('predicted_s', 2), 6, 'predicted_small_s')},
  {r(_at('predicted_s', 4), 6, 'predicted_large_s')}, {r(_at('wall_s', 2), 6, 'wall_small_s')},
  {r(_at('wall_s', 4), 6, 'wall_large_s')}, {r(_at('wall_s', 2) + ' / ' + _at('wall_s', 4), 6, 'speedup')},
  count(*) FILTER (nodes = 2) AS n_small, count(*) FILTER (nodes = 4) AS n_large FROM j GROUP BY resource_id, phase""",
    "ledger_complete": f"""WITH {LEDGER}, c AS (SELECT resource_id, stage, phase, nodes, count(*) AS n FROM led GROUP BY ALL)
SELECT resource_id, CAST(sum(n) AS BIGINT) AS n_rows, max(n) = 1 AS is_unique, sum(n) = 5 AND max(n) = 1 AS complete
FROM c GROUP BY resource_id""",
    "seconds_per_fit": f"""SELECT {PATH} AS path, {r('(floor(l_quantity) + 7) * l_linenumber / CAST(60 AS DOUBLE)', 6, 'seconds_per_fit')}
  FROM lineitem WHERE l_linenumber % 2 = 1 AND floor(l_discount * 100 + 0.5) <> 10""",
    "ledger_cost": f"""WITH {LEDGER} SELECT stage, phase, nodes, count(*) AS n_rows, count(p_partkey) AS n_priced,
  {r('sum((startup_s + wall_s) / 3600 * (p_retailprice / 1000) * (nodes + CASE WHEN nodes > 1 THEN 1 ELSE 0 END))', 4, 'cost_usd')}
  FROM led LEFT JOIN part ON instance_type = p_partkey AND p_partkey % 10 <> 0 GROUP BY stage, phase, nodes""",
}
