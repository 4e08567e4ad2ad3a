"""The same results in SQL."""

from __future__ import annotations

_P1_ROWS = """
WITH r AS (
  SELECT 'rule_performance' AS t, load_no, unnest([
    {'c': 'evaluations', 'v': CAST(evaluations AS VARCHAR), 'num': evaluations, 'bad': evaluations < 0 OR evaluations > 10000000},
    {'c': 'failures', 'v': CAST(failures AS VARCHAR), 'num': failures, 'bad': failures < 0 OR failures > 10000000 OR coalesce(failures > evaluations, false)},
    {'c': 'severity', 'v': severity, 'num': NULL, 'bad': false},
    {'c': 'column_name', 'v': column_name, 'num': NULL, 'bad': NOT regexp_full_match(column_name, '[a-z][a-z0-9]*(_[a-z0-9]+)*')},
    {'c': 'run_id', 'v': run_id, 'num': NULL, 'bad': NOT regexp_full_match(run_id, 'run_[0-9a-f]{12}')}]) AS x
  FROM rule_performance
  UNION ALL
  SELECT 'stage_summary', load_no, unnest([
    {'c': 'rows_read', 'v': CAST(rows_read AS VARCHAR), 'num': rows_read, 'bad': rows_read < 0},
    {'c': 'rows_rejected', 'v': CAST(rows_rejected AS VARCHAR), 'num': rows_rejected, 'bad': rows_rejected < 0 OR rows_rejected > 50000000 OR coalesce(rows_rejected > rows_read, false)},
    {'c': 'layer', 'v': layer, 'num': NULL, 'bad': false},
    {'c': 'run_id', 'v': run_id, 'num': NULL, 'bad': NOT regexp_full_match(run_id, 'run_[0-9a-f]{12}')}])
  FROM stage_summary),
m AS (SELECT t, load_no, x.c AS c, x.v AS v, x.num AS num, coalesce(x.bad, false) AND x.v IS NOT NULL AS bad FROM r),
f AS (SELECT t, load_no, c, count(*) AS n, count(*) - count(v) AS nulls, count(v) AS k, count(DISTINCT v) AS d, count(*) FILTER (bad) AS b,
        count(*) FILTER (num = 0) AS z, min(num) AS lo, max(num) AS hi, median(CASE WHEN num IS NOT NULL THEN greatest(num, 0) END) AS med, median(num) AS plain_med FROM m GROUP BY ALL)
"""
_P1_FOUND = (
    _P1_ROWS
    + """,
g AS (SELECT *, nulls / n AS ns, CASE WHEN k > 0 THEN b / k END AS bs, CASE WHEN k > 0 THEN z / k END AS zs, med + 1 AS lvl, c NOT IN ('severity', 'layer', 'column_name', 'run_id') AS isnum FROM f),
u AS (SELECT t, c, median(ns) AS uns, median(d) AS ud, median(lvl) AS ul, median(zs) AS uz FROM g GROUP BY ALL),
plain AS (SELECT t, load_no, c FROM g JOIN u USING (t, c) WHERE abs(ns - uns) >= 0.1 - 1e-9 OR bs >= 0.06 - 1e-9
   OR isnum AND (d <= ud * 0.1 + 1e-9 AND ud > 0 OR greatest(lvl / ul, ul / lvl) >= 3 - 1e-9 OR abs(zs - uz) >= 0.25 - 1e-9)),
cat AS (SELECT DISTINCT t, c, v FROM m WHERE c IN ('severity', 'layer') AND v IS NOT NULL),
grid AS (SELECT g.t, g.c, g.load_no, cat.v, g.k FROM g JOIN cat USING (t, c) WHERE g.k > 0),
held AS (SELECT t, c, load_no, v, count(*) AS n FROM m WHERE c IN ('severity', 'layer') AND v IS NOT NULL GROUP BY ALL),
sh AS (SELECT t, c, load_no, v, coalesce(n, 0) / k AS s FROM grid LEFT JOIN held USING (t, c, load_no, v)),
ush AS (SELECT t, c, v, median(s) AS us FROM sh GROUP BY ALL)
SELECT DISTINCT t AS table_name, load_no, c AS column_name FROM (
  SELECT t, load_no, c FROM plain UNION ALL SELECT t, load_no, c FROM sh JOIN ush USING (t, c, v) WHERE abs(s - us) >= 0.25 - 1e-9)
"""
)
_NUM = "c IN ('evaluations', 'failures', 'rows_read', 'rows_rejected')"
_P1_PROFILE = (
    _P1_ROWS
    + f""",
e AS (SELECT t, load_no, c, sum(n * log2(n)) AS s FROM (SELECT t, load_no, c, v, count(*) AS n FROM m WHERE v IS NOT NULL GROUP BY ALL) GROUP BY ALL)
SELECT t AS table_name, load_no, c AS column_name, n AS n_rows, nulls, d AS n_distinct, lo::DOUBLE AS min_value, hi::DOUBLE AS max_value, round(plain_med, 3) AS median,
  round(nulls / n, 6) AS null_share, round(b / nullif(k, 0), 6) AS broken_share, CASE WHEN {_NUM} THEN round(z / nullif(k, 0), 6) END AS zero_share,
  CASE WHEN k > 0 THEN round(log2(k) - s / k, 6) ELSE 0.0 END AS entropy
FROM f LEFT JOIN e USING (t, load_no, c)
"""
)
_P1_STATE = (
    _P1_ROWS
    + """,
e AS (SELECT t, c, sum(n * log2(n)) AS s FROM (SELECT t, c, v, count(*) AS n FROM m WHERE v IS NOT NULL GROUP BY ALL) GROUP BY ALL),
w AS (SELECT t, c, count(*) AS n, count(*) - count(v) AS nulls, count(v) AS k, count(DISTINCT v) AS d, min(num) AS lo, max(num) AS hi, median(num) AS med FROM m GROUP BY ALL)
SELECT t AS table_name, c AS column_name, n AS n_rows, nulls, d AS n_distinct, lo::DOUBLE AS min_value, hi::DOUBLE AS max_value, round(med, 3) AS median,
  CASE WHEN k > 0 THEN round(log2(k) - s / k, 6) ELSE 0.0 END AS entropy FROM w LEFT JOIN e USING (t, c)
"""
)
_P1_WITHDRAWN = _P1_STATE.replace("coalesce(x.bad, false) AND x.v IS NOT NULL AS bad FROM r)", "coalesce(x.bad, false) AND x.v IS NOT NULL AS bad FROM r SEMI JOIN (SELECT t, load_no FROM r QUALIFY load_no < max(load_no) OVER (PARTITION BY t)) z ON z.t = r.t AND z.load_no = r.load_no)")
_P1_PRICES = """
WITH c AS (SELECT unnest([{'c': 'l_discount', 'v': l_discount}, {'c': 'margin', 'v': l_extendedprice - 30000}, {'c': 'price', 'v': l_extendedprice},
    {'c': 'ship_day', 'v': CAST(date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) AS DOUBLE)}, {'c': 'l_shipdate', 'v': CAST(epoch_us(l_shipdate) AS DOUBLE)}]) AS x FROM lineitem),
m AS (SELECT x.c AS c, x.v AS v FROM c), f AS (SELECT c, v, count(*) AS n FROM m GROUP BY ALL), e AS (SELECT c, sum(n * log2(n)) FILTER (v IS NOT NULL) AS s FROM f GROUP BY 1)
SELECT 'lineitem' AS table_name, c AS column_name, count(*) AS n_rows, count(*) - count(v) AS nulls, count(DISTINCT v) AS n_distinct, min(v) AS min_value, max(v) AS max_value, round(median(v), 3) AS median,
  round(log2(count(v)) - any_value(s) / count(v), 6) AS entropy FROM m JOIN e USING (c) GROUP BY c
"""

_P2 = r"""
WITH e AS (
  SELECT row_no, regexp_replace(customer_id, '^\s+|\s+$', '', 'g') AS customer_id,
    make_timestamptz(CASE incremental_column WHEN 'purchased_at' THEN purchased_at * 1000000 WHEN 'delivered_at' THEN delivered_at * 1000000
      WHEN 'updated_at' THEN s.updated_at * 1000000 WHEN 'arrived_at' THEN epoch_us(arrived_at) END) AS t
  FROM shop_orders s JOIN source_object o ON o.id = s.source_object_id)
SELECT row_no, version_no FROM (
  SELECT row_no, arg_max({'n': version_no, 'd': is_deleted}, {'f': valid_from, 'i': ingested_at, 'n': version_no}) AS x
  FROM e JOIN customer_history h ON h.customer_id = e.customer_id AND valid_from <= t AND ingested_at <= t GROUP BY row_no), LATERAL (SELECT x.n AS version_no, x.d AS gone)
WHERE NOT coalesce(gone, false)
"""

_P2_AS_KNOWN = _P2.replace("SELECT row_no, regexp", "SELECT row_no, arrived_at, regexp").replace("ingested_at <= t", "ingested_at <= arrived_at")

_P3_CASES = r"""
WITH o AS (SELECT DISTINCT id AS source_object_id, coalesce(load_strategy = 'incremental', false) AS inc FROM source_object),
sn AS (SELECT source_object_id, snapshot_no, row_number() OVER (PARTITION BY source_object_id ORDER BY taken, snapshot_no) AS rk
  FROM (SELECT source_object_id, snapshot_no, min(taken_at) AS taken FROM customer_snapshots GROUP BY ALL)),
d AS (SELECT source_object_id, rk, inc, customer_id, {'e': customer_email, 'p': customer_phone, 'c': regexp_replace(customer_city, '^\s+|\s+$', '', 'g'), 's': customer_state, 'z': customer_zip_prefix} AS v
  FROM customer_snapshots JOIN sn USING (source_object_id, snapshot_no) JOIN o USING (source_object_id)
  QUALIFY row_number() OVER (PARTITION BY source_object_id, snapshot_no, customer_id ORDER BY updated_at DESC NULLS LAST) = 1),
l AS (SELECT *, lag(rk) OVER w AS rk0, lag(v) OVER w AS v0, lead(rk) OVER w AS rk1 FROM d WINDOW w AS (PARTITION BY source_object_id, customer_id ORDER BY rk)),
cases AS (
  SELECT source_object_id, rk, customer_id, CASE WHEN rk0 IS NULL OR (NOT inc AND rk0 < rk - 1) THEN 'added' ELSE 'changed' END AS change_type FROM l
  WHERE rk > 1 AND (rk0 IS NULL OR (NOT inc AND rk0 < rk - 1) OR v IS DISTINCT FROM v0)
  UNION ALL
  SELECT l.source_object_id, l.rk + 1, customer_id, 'removed' FROM l JOIN sn ON sn.source_object_id = l.source_object_id AND sn.rk = l.rk + 1 WHERE NOT inc AND (rk1 IS NULL OR rk1 > l.rk + 1))
"""
_P3 = _P3_CASES + "SELECT source_object_id, snapshot_no, customer_id, change_type FROM cases JOIN sn USING (source_object_id, rk)"
_P3_COUNTS = (
    _P3_CASES
    + """SELECT sn.source_object_id, sn.snapshot_no, count(*) FILTER (change_type = 'added') AS n_added, count(*) FILTER (change_type = 'removed') AS n_removed,
  count(*) FILTER (change_type = 'changed') AS n_changed, any_value(h.n) - count(*) FILTER (change_type IN ('added', 'changed')) AS n_unchanged
FROM sn JOIN (SELECT source_object_id, rk, count(*) AS n FROM d GROUP BY ALL) h USING (source_object_id, rk) LEFT JOIN cases USING (source_object_id, rk) WHERE rk > 1 GROUP BY ALL"""
)
_P6_VERSIONS = (
    _P3_CASES
    + """, opened AS (
  SELECT source_object_id, rk, customer_id, 0 AS deleted FROM d WHERE rk = 1
  UNION ALL SELECT source_object_id, rk, customer_id, CAST(change_type = 'removed' AS INT) FROM cases),
v6 AS (SELECT *, lead(rk) OVER w AS nxt, CASE WHEN deleted = 1 THEN lag(rk) OVER w ELSE rk END AS shown FROM opened WINDOW w AS (PARTITION BY source_object_id, customer_id ORDER BY rk))
"""
)
_P6 = (
    _P6_VERSIONS
    + """SELECT v6.source_object_id, customer_id, a.snapshot_no AS from_snapshot, coalesce(b.snapshot_no, 0) AS to_snapshot, CAST(deleted AS BIGINT) AS deleted
FROM v6 JOIN sn a ON a.source_object_id = v6.source_object_id AND a.rk = v6.rk LEFT JOIN sn b ON b.source_object_id = v6.source_object_id AND b.rk = v6.nxt"""
)

_P6_HISTORY = (
    _P6_VERSIONS
    + """, tk AS (SELECT source_object_id, snapshot_no, epoch_us(min(taken_at)) AS us FROM customer_snapshots GROUP BY ALL),
snt AS (SELECT sn.*, us FROM sn JOIN tk USING (source_object_id, snapshot_no)),
raw AS (SELECT source_object_id, rk, customer_id, customer_email, customer_phone, customer_city, customer_state, customer_zip_prefix FROM customer_snapshots JOIN sn USING (source_object_id, snapshot_no)
  QUALIFY row_number() OVER (PARTITION BY source_object_id, snapshot_no, customer_id ORDER BY updated_at DESC NULLS LAST) = 1)
SELECT v6.source_object_id, v6.customer_id, a.snapshot_no AS from_snapshot, coalesce(b.snapshot_no, 0) AS to_snapshot, a.us AS from_us, b.us AS to_us, b.snapshot_no IS NULL AS is_current, deleted = 1 AS is_deleted,
  customer_email, customer_phone, customer_city, customer_state, customer_zip_prefix
FROM v6 JOIN snt a ON a.source_object_id = v6.source_object_id AND a.rk = v6.rk LEFT JOIN snt b ON b.source_object_id = v6.source_object_id AND b.rk = v6.nxt
LEFT JOIN raw ON raw.source_object_id = v6.source_object_id AND raw.customer_id IS NOT DISTINCT FROM v6.customer_id AND raw.rk = v6.shown"""
)

_P4_EVIDENCE = """
WITH sv AS (SELECT source_object_id AS o, version AS v, arg_max(schema_json, {'c': captured_at, 'j': schema_json}) AS j FROM schema_version WHERE schema_json IS NOT NULL GROUP BY ALL),
f AS (SELECT o, v, x->>'name' AS n, x->>'type' AS t FROM (SELECT o, v, unnest(CAST(CAST(j AS JSON) AS JSON[])) AS x FROM sv)),
p AS (SELECT o, v, lag(v) OVER (PARTITION BY o ORDER BY v) AS p FROM sv QUALIFY p IS NOT NULL),
a AS (SELECT p.o, p.v, p.p, f.n, f.t FROM p JOIN f ON f.o = p.o AND f.v = p.p),
b AS (SELECT p.o, p.v, p.p, f.n, f.t FROM p JOIN f ON f.o = p.o AND f.v = p.v),
gone AS (SELECT * FROM a ANTI JOIN b USING (o, v, n)), fresh AS (SELECT * FROM b ANTI JOIN a USING (o, v, n)),
rec AS (SELECT source_object_id AS o, version AS v, CAST(payload AS JSON)->>'record_key' AS k, any_value(CAST(payload AS JSON)) AS r FROM landed_rows
  WHERE CASE WHEN json_valid(payload) THEN CAST(payload AS JSON)->>'record_key' END IS NOT NULL GROUP BY ALL),
c AS (SELECT g.o, g.v, g.p, g.n AS gn, n.n AS nn FROM gone g JOIN fresh n USING (o, v)),
ev AS (SELECT c.o, c.v, gn, nn FROM c JOIN rec x ON x.o = c.o AND x.v = c.p JOIN rec y ON y.o = c.o AND y.v = c.v AND y.k = x.k
  GROUP BY ALL HAVING bool_and(json_extract_string(x.r, '$."' || gn || '"') IS NOT DISTINCT FROM json_extract_string(y.r, '$."' || nn || '"')))
"""
_P4 = (
    _P4_EVIDENCE
    + """SELECT DISTINCT o AS source_object_id, v AS version, change_type, column_name FROM (
  SELECT o, v, 'retyped' AS change_type, n AS column_name FROM a JOIN b USING (o, v, n) WHERE a.t <> b.t
  UNION ALL SELECT o, v, 'renamed', nn FROM ev
  UNION ALL SELECT o, v, 'removed', n FROM gone WHERE NOT EXISTS (SELECT 1 FROM ev WHERE ev.o = gone.o AND ev.v = gone.v AND ev.gn = gone.n)
  UNION ALL SELECT o, v, 'added', n FROM fresh WHERE NOT EXISTS (SELECT 1 FROM ev WHERE ev.o = fresh.o AND ev.v = fresh.v AND ev.nn = fresh.n))
"""
)
_P4_VALUES = (
    _P4_EVIDENCE.replace("WITH sv", "WITH RECURSIVE sv")
    + """, walk(o, v0, f0, v, n) AS (SELECT o, v, n, v, n FROM f UNION ALL
  SELECT w.o, w.v0, w.f0, p.v, coalesce(ev.nn, w.n) FROM walk w JOIN p ON p.o = w.o AND p.p = w.v LEFT JOIN ev ON ev.o = p.o AND ev.v = p.v AND ev.gn = w.n JOIN f ON f.o = p.o AND f.v = p.v AND f.n = coalesce(ev.nn, w.n)),
term AS (SELECT o, v0, f0, max(v) AS v, arg_max(n, v) AS n FROM walk GROUP BY ALL),
names AS (SELECT t.o, t.v0 AS v, t.f0 AS n, CASE WHEN u.n IS NULL THEN t.n ELSE t.n || '__v' || t.v END AS c FROM term t LEFT JOIN p ON p.o = t.o AND p.p = t.v LEFT JOIN (SELECT DISTINCT o, v0, n FROM term) u ON u.o = p.o AND u.v0 = p.v AND u.n = t.n),
line AS (SELECT row_number() OVER () AS i, source_object_id AS o, version AS v, CAST(payload AS JSON)->>'record_key' AS k, CAST(payload AS JSON) AS r FROM landed_rows WHERE CASE WHEN json_valid(payload) THEN CAST(payload AS JSON)->>'record_key' END IS NOT NULL),
e AS (SELECT i, o, v, k, unnest(json_keys(r)) AS n, r FROM line),
x AS (SELECT i, e.o, e.v, e.k, coalesce(names.c, CASE WHEN e.n IN (SELECT c FROM names z WHERE z.o = e.o AND z.v = e.v) THEN e.n || '__raw' ELSE e.n END) AS c, json_extract_string(r, '$."' || e.n || '"') AS val FROM e LEFT JOIN names ON names.o = e.o AND names.v = e.v AND names.n = e.n),
once AS (SELECT DISTINCT o, v, k, l FROM (SELECT i, o, v, k, list({'c': c, 'val': val} ORDER BY c) FILTER (val IS NOT NULL) AS l FROM x GROUP BY ALL))
SELECT o AS source_object_id, v AS version, k AS record_key, y.c AS column_name, y.val AS value FROM (SELECT o, v, k, unnest(l) AS y FROM once)
"""
)

_P5_BASE = r"""
WITH c AS (
  SELECT c.*, CASE incremental_column WHEN 'seq' THEN seq WHEN 'updated_at' THEN c.updated_at WHEN 'arrived_at' THEN epoch_us(arrived_at) WHEN 'change_no' THEN change_no END AS ord,
    coalesce(lower(trim(CASE cdc_operation_column WHEN 'op_code' THEN op_code WHEN 'change_kind' THEN change_kind END)) = lower(trim(cdc_delete_value)), false) AS del,
    CASE WHEN contains(primary_key_columns, 'customer_state') THEN {'i': customer_id, 's': customer_state} ELSE {'i': customer_id, 's': NULL} END AS k
  FROM customer_changes c JOIN source_object o ON o.id = c.source_object_id),
u AS (SELECT source_object_id, k, ord, del, customer_id, customer_state, op_code, change_kind, seq, customer_city, customer_zip_prefix, updated_at, min(change_no) AS change_no FROM c GROUP BY ALL),
cur AS (SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY source_object_id, k ORDER BY ord DESC NULLS LAST, change_no DESC) = 1)
"""
_P5 = _P5_BASE + "SELECT source_object_id, change_no FROM cur WHERE NOT del"
_P5_CURRENT = _P5_BASE + "SELECT source_object_id, change_no, customer_id, customer_state, customer_city, customer_zip_prefix FROM cur WHERE NOT del"

_P5_BUCKETS = (
    _P5_BASE
    + """, e AS (SELECT min(arrived_at) AS a, max(arrived_at) AS b FROM customer_changes),
m AS (SELECT quantile_disc(load_order, 0.5) AS mid FROM source_object WHERE id IN (SELECT source_object_id FROM customer_changes)),
b AS (SELECT c.source_object_id AS o, k, CASE WHEN epoch_us(arrived_at) <= epoch_us(a) + (epoch_us(b) - epoch_us(a)) * 9 / 10 THEN 0 WHEN load_order <= mid THEN 1 ELSE 2 END AS batch,
    coalesce('v' || k.i, 'n') || CASE WHEN contains(primary_key_columns, 'customer_state') THEN chr(31) || coalesce('v' || k.s, 'n') ELSE '' END AS txt
  FROM c JOIN source_object s ON s.id = c.source_object_id, e, m),
first AS (SELECT o, min(batch) AS fb FROM b GROUP BY 1),
sizes AS (SELECT b.o, greatest(1, -(-count(DISTINCT k) // 100000)) AS n FROM b JOIN first ON first.o = b.o AND batch = fb GROUP BY 1),
hit AS (SELECT DISTINCT batch, b.o, CAST('0x' || substr(md5(txt), 1, 15) AS BIGINT) % n AS h FROM b JOIN sizes ON sizes.o = b.o)
SELECT x.batch::BIGINT AS batch, (SELECT count(*) FROM hit WHERE hit.batch = x.batch) AS touched,
  (SELECT count(*) FROM (SELECT DISTINCT o, h FROM hit WHERE hit.batch < x.batch EXCEPT SELECT o, h FROM hit WHERE hit.batch = x.batch)) AS kept
FROM (SELECT DISTINCT batch FROM hit) x"""
)

_P7 = r"""
WITH once AS (SELECT row_no, source_object_id, arrived_at FROM shop_orders
  QUALIFY row_number() OVER (PARTITION BY source_object_id, order_id, regexp_replace(customer_id, '^\s+|\s+$', '', 'g'), order_status, purchased_at, delivered_at, updated_at ORDER BY arrived_at, row_no) = 1),
runs AS (SELECT source_object_id, started_at, min(run_no) AS run_no FROM incremental_runs WHERE status = 'succeeded' AND started_at IS NOT NULL GROUP BY ALL)
SELECT r.run_no, o.row_no FROM once o ASOF JOIN runs r ON o.source_object_id = r.source_object_id AND o.arrived_at <= r.started_at
"""

_P7_RUNS = """
WITH e AS (SELECT source_object_id AS o, arrived_at AS a, CASE incremental_column WHEN 'purchased_at' THEN purchased_at WHEN 'delivered_at' THEN delivered_at WHEN 'updated_at' THEN s.updated_at END AS w FROM shop_orders s JOIN source_object t ON t.id = s.source_object_id),
r AS (SELECT source_object_id AS o, started_at AS st, min(run_no) AS run_no, any_value(watermark_grace) AS g FROM incremental_runs JOIN source_object t ON t.id = source_object_id WHERE status = 'succeeded' AND started_at IS NOT NULL GROUP BY ALL),
first AS (SELECT e.o, e.w, r.run_no, r.st FROM e ASOF JOIN r ON e.o = r.o AND e.a <= r.st),
own AS (SELECT o, run_no, count(*) AS n, max(w) AS m FROM first GROUP BY ALL),
m AS (SELECT r.*, coalesce(n, 0) AS n, max(m) OVER (PARTITION BY r.o ORDER BY st) AS wt FROM r LEFT JOIN own ON own.o = r.o AND own.run_no = r.run_no),
k AS (SELECT *, lag(wt) OVER (PARTITION BY o ORDER BY st) AS wf FROM m),
again AS (SELECT k.o, k.run_no, count(*) AS x FROM k JOIN first f ON f.o = k.o AND f.st < k.st AND f.w > k.wf - k.g GROUP BY ALL)
SELECT k.o AS source_object_id, k.run_no, wf AS watermark_from, wt AS watermark_to, n AS rows_new, coalesce(x, 0) AS rows_reprocessed FROM k LEFT JOIN again ON again.o = k.o AND again.run_no = k.run_no
"""

ORACLES = {
    "p1_found": _P1_FOUND, "p1_profile": _P1_PROFILE, "p1_state": _P1_STATE, "p1_withdrawn": _P1_WITHDRAWN, "p1_prices": _P1_PRICES, "p2_found": _P2, "p2_as_known": _P2_AS_KNOWN, "p3_found": _P3, "p3_counts": _P3_COUNTS,
    "p4_found": _P4, "p4_values": _P4_VALUES, "p5_found": _P5, "p5_buckets": _P5_BUCKETS, "p5_current": _P5_CURRENT, "p6_found": _P6, "p6_history": _P6_HISTORY, "p7_found": _P7, "p7_runs": _P7_RUNS,
}
