"""The registered questions in plain SQL, written without reference to how the operators work."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

# --- shared views ---------------------------------------------------------------------------

_VIEWS = {
    "li": """SELECT CAST(year(l_shipdate) AS INTEGER) AS yr, l_orderkey, l_linenumber, l_quantity, l_discount, l_tax,
        l_returnflag, l_linestatus, l_extendedprice AS price,
        l_extendedprice * (1 - l_discount) * (1 + l_tax) AS prediction FROM lineitem""",
    "train": "SELECT * FROM li WHERE yr <= 1998 AND l_orderkey % 5 <> 0",
    "valid": "SELECT * FROM li WHERE yr <= 1998 AND l_orderkey % 5 = 0",
    "batch": """SELECT CAST(yr AS VARCHAR) AS batch_id, yr, l_orderkey, l_linenumber, l_discount, l_tax, l_returnflag, l_linestatus,
        CASE WHEN yr = 2001 THEN l_quantity * 1000 ELSE l_quantity END AS l_quantity,
        CASE WHEN yr = 2000 THEN price * 100 WHEN yr <> 2001 THEN price END AS price, prediction FROM li WHERE yr > 1998""",
    "ref": """SELECT 'l_quantity' AS series, l_quantity AS value FROM train UNION ALL
        SELECT 'l_discount', l_discount FROM train UNION ALL SELECT 'l_tax', l_tax FROM train UNION ALL
        SELECT '__target__', price FROM train UNION ALL SELECT '__prediction__', prediction FROM valid""",
    "edges": """SELECT series, list_slice(d, 2, len(d) - 1) AS edges FROM (
        SELECT series, list_sort(list_distinct(list_transform(
            quantile_cont(value, [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1]), lambda x: round(x, 6)))) AS d
        FROM ref GROUP BY series)""",
    "grid": "SELECT series, edges, unnest(range(0, len(edges) + 1)) AS bin FROM edges",
    "refbin": """SELECT g.series, g.bin, g.edges, count(r.bin) / sum(count(r.bin)) OVER (PARTITION BY g.series) AS freq
        FROM grid g LEFT JOIN (SELECT ref.series, len(list_filter(edges, lambda e: e <= value)) AS bin FROM ref JOIN edges USING (series)) r
        ON r.series = g.series AND r.bin = g.bin GROUP BY g.series, g.bin, g.edges""",
    "long": """SELECT batch_id, 'l_quantity' AS series, l_quantity AS value FROM batch UNION ALL
        SELECT batch_id, 'l_discount', l_discount FROM batch UNION ALL SELECT batch_id, 'l_tax', l_tax FROM batch UNION ALL
        SELECT batch_id, '__target__', price FROM batch UNION ALL SELECT batch_id, '__prediction__', prediction FROM batch""",
    "counts": """SELECT b.batch_id, g.series, g.bin, count(x.bin) AS n FROM (SELECT DISTINCT batch_id FROM batch) b CROSS JOIN grid g
        LEFT JOIN (SELECT batch_id, long.series, len(list_filter(edges, lambda e: e <= value)) AS bin FROM long JOIN edges USING (series)
                   WHERE value IS NOT NULL) x
        ON x.batch_id = b.batch_id AND x.series = g.series AND x.bin = g.bin GROUP BY b.batch_id, g.series, g.bin""",
    "npsi": """SELECT batch_id, series, CASE WHEN max(total) = 0 THEN 0.0 ELSE sum((a - r) * ln(a / r)) END AS psi FROM (
        SELECT batch_id, series, total, ca / sum(ca) OVER (PARTITION BY batch_id, series) AS a,
            cr / sum(cr) OVER (PARTITION BY batch_id, series) AS r FROM (
            SELECT c.batch_id, c.series, sum(c.n) OVER (PARTITION BY c.batch_id, c.series) AS total,
                greatest(c.n / greatest(sum(c.n) OVER (PARTITION BY c.batch_id, c.series), 1), 1e-6) AS ca, greatest(f.freq, 1e-6) AS cr
            FROM counts c JOIN refbin f USING (series, bin))) GROUP BY batch_id, series""",
    "cat_ref": """SELECT feature, category, count(*) / sum(count(*)) OVER (PARTITION BY feature) AS freq FROM (
        SELECT 'l_returnflag' AS feature, lower(l_returnflag) AS category FROM train UNION ALL
        SELECT 'l_linestatus', lower(l_linestatus) FROM train) GROUP BY feature, category""",
    "cat_batch": """SELECT batch_id, feature, category, count(*) AS n FROM (
        SELECT batch_id, 'l_returnflag' AS feature, lower(l_returnflag) AS category FROM batch UNION ALL
        SELECT batch_id, 'l_linestatus', lower(l_linestatus) FROM batch) WHERE category IS NOT NULL GROUP BY ALL""",
    "cpsi": """SELECT batch_id, feature, sum((a - r) * ln(a / r)) AS psi FROM (
        SELECT batch_id, feature, ca / sum(ca) OVER (PARTITION BY batch_id, feature) AS a, cr / sum(cr) OVER (PARTITION BY batch_id, feature) AS r
        FROM (SELECT u.batch_id, u.feature, greatest(coalesce(a.n, 0) / sum(a.n) OVER (PARTITION BY u.batch_id, u.feature), 1e-6) AS ca,
                     greatest(coalesce(f.freq, 0), 1e-6) AS cr
              FROM (SELECT DISTINCT batch_id, feature, category FROM cat_batch UNION
                    SELECT batch_id, feature, category FROM cat_ref, (SELECT DISTINCT batch_id FROM cat_batch)) u
              LEFT JOIN cat_batch a USING (batch_id, feature, category) LEFT JOIN cat_ref f USING (feature, category)))
        GROUP BY batch_id, feature""",
    "fpsi": """SELECT batch_id, series AS feature, psi FROM npsi WHERE series NOT LIKE '\\_\\_%' ESCAPE '\\' UNION ALL
        SELECT batch_id, feature, psi FROM cpsi""",
    "rule": """SELECT * FROM (VALUES
        (NULL, 'l_quantity', 'psi_warn', 0.05, 1, 'feature:l_quantity'), (NULL, 'l_quantity', 'psi_alert', 0.15, 1, 'feature:l_quantity'),
        (NULL, 'l_discount', 'psi_warn', 0.2, 1, 'feature:l_discount'), (NULL, 'l_discount', 'psi_alert', 0.4, 1, 'feature:l_discount'),
        (NULL, 'l_returnflag', 'psi_alert', 0.5, 1, 'feature:l_returnflag'),
        ('2000', NULL, 'schema_alert_pct', 99.5, 2, 'batch:2000'), ('2000', NULL, 'psi_warn', 0.2, 2, 'batch:2000'),
        ('2000', NULL, 'psi_alert', 0.4, 2, 'batch:2000'),
        ('2001', NULL, 'psi_warn', 0.05, 2, 'batch:2001'), ('2001', NULL, 'psi_alert', 0.15, 2, 'batch:2001'),
        ('2001', 'l_tax', 'psi_warn', 0.2, 3, 'batch:2001/feature:l_tax')) t(batch, feature, field, value, priority, label)""",
    "threshold": """SELECT s.batch_id, s.feature,
            coalesce(CAST(max_by(value, priority) FILTER (field = 'psi_warn') AS DOUBLE), 0.1) AS psi_warn,
            coalesce(CAST(max_by(value, priority) FILTER (field = 'psi_alert') AS DOUBLE), 0.25) AS psi_alert,
            CAST(0.0 AS DOUBLE) AS schema_warn_pct,
            coalesce(CAST(max_by(value, priority) FILTER (field = 'schema_alert_pct') AS DOUBLE), 1.0) AS schema_alert_pct,
            CAST(0.05 AS DOUBLE) AS r2_warn_drop,
            coalesce(max_by(label, priority) FILTER (field LIKE 'psi%'), 'default') AS psi_source,
            coalesce(max_by(label, priority) FILTER (field LIKE 'schema%'), 'default') AS schema_source,
            'default' AS perf_source,
            coalesce(array_to_string(list_transform(list_sort(list(DISTINCT {'p': priority, 'l': label}) FILTER (label IS NOT NULL)),
                lambda x: x.l), '+'), 'default') AS source
        FROM (SELECT * FROM (SELECT DISTINCT batch_id FROM batch), (SELECT unnest(['l_quantity', 'l_discount', 'l_tax', 'l_returnflag',
              'l_linestatus', '']) AS feature)) s
        LEFT JOIN rule r ON (r.batch IS NULL OR r.batch = s.batch_id) AND (r.feature IS NULL OR r.feature = s.feature)
        GROUP BY s.batch_id, s.feature""",
    "bound": """SELECT * FROM (VALUES ('l_quantity', 'l_quantity', 1.0, 50.0), ('l_discount', 'l_discount', 0.0, 0.1),
        ('l_tax', 'l_tax', 0.0, 0.08), ('__target__', 'price', 900.0, 105000.0)) t(series, name, low, high)""",
    "violation": """SELECT batch_id, name AS "column", count_if(value < low OR value > high) AS n_rows, count(*) AS total,
            100.0 * count_if(value < low OR value > high) / count(*) AS pct FROM long JOIN bound USING (series)
        WHERE series <> '__target__' OR batch_id <> '2001' GROUP BY ALL HAVING count_if(value < low OR value > high) > 0""",
    "val_metric": """SELECT sqrt(avg((price - prediction) ** 2)) AS val_rmse,
        1 - sum((price - prediction) ** 2) / (count(*) * var_pop(price)) AS val_r2 FROM valid""",
    "metric": """SELECT batch_id, count(*) AS n, sqrt(avg((price - prediction) ** 2)) AS rmse, avg(abs(price - prediction)) AS mae,
        1 - sum((price - prediction) ** 2) / (count(*) * var_pop(price)) AS r2, avg(abs((price - prediction) / price)) * 100 AS mape,
        avg(price) AS mean_price FROM batch WHERE yr <> 2001 GROUP BY batch_id""",
    "raw_signal": """SELECT v.batch_id, 'schema:' || "column" || ':out_of_range' AS name, 'schema' AS category, pct AS value,
            schema_warn_pct AS warn, schema_alert_pct AS alert, schema_source AS thresholds_source
        FROM violation v JOIN threshold t ON t.batch_id = v.batch_id AND t.feature = '' UNION ALL
        SELECT batch_id, 'schema', 'schema', 0.0, 0.0, 1.0, schema_source FROM threshold WHERE feature = ''
            AND batch_id NOT IN (SELECT batch_id FROM violation) UNION ALL
        SELECT p.batch_id, 'drift:' || p.feature, 'feature_drift', psi, psi_warn, psi_alert, psi_source
        FROM fpsi p JOIN threshold t ON t.batch_id = p.batch_id AND t.feature = p.feature UNION ALL
        SELECT p.batch_id, 'drift:predictions', 'prediction_drift', psi, psi_warn, psi_alert, psi_source
        FROM npsi p JOIN threshold t ON t.batch_id = p.batch_id AND t.feature = '' WHERE series = '__prediction__' UNION ALL
        SELECT batch_id, 'performance:rmse_ratio', 'performance', rmse / val_rmse, 1.25, 1.5, 'default' FROM metric, val_metric UNION ALL
        SELECT batch_id, 'performance:r2_drop', 'performance', val_r2 - r2, 0.05, 0.15, 'default' FROM metric, val_metric UNION ALL
        SELECT batch_id, 'target:mean_shift', 'target_drift', abs(mean_price / (SELECT avg(price) FROM train) - 1), 0.25, 1.0, 'default'
        FROM metric UNION ALL
        SELECT p.batch_id, 'target:psi', 'target_drift', psi, psi_warn, psi_alert, psi_source
        FROM npsi p JOIN threshold t ON t.batch_id = p.batch_id AND t.feature = '' WHERE series = '__target__' AND p.batch_id <> '2001'""",
    "signal": """SELECT batch_id, name, category, value, CASE WHEN value > alert THEN 'ALERT' WHEN value > warn THEN 'WARNING' ELSE 'OK' END AS status,
        thresholds_source FROM raw_signal""",
    "flag": """SELECT batch_id, batch_id <> '2001' AS has_target,
            max(CASE status WHEN 'ALERT' THEN 2 WHEN 'WARNING' THEN 1 ELSE 0 END) AS worst,
            bool_or(status <> 'OK' AND (category = 'feature_drift' OR (category = 'schema' AND name NOT LIKE 'schema:price:%'))) AS f,
            bool_or(status <> 'OK' AND (category = 'target_drift' OR (category = 'schema' AND name LIKE 'schema:price:%'))) AS t,
            bool_or(status <> 'OK' AND category = 'performance') AS p, bool_or(status <> 'OK' AND category = 'prediction_drift') AS q
        FROM signal GROUP BY batch_id""",
    "status": """SELECT batch_id, has_target, CASE worst WHEN 2 THEN 'ALERT' WHEN 1 THEN 'WARNING' ELSE 'OK' END AS status,
            CASE WHEN NOT has_target AND f THEN 'FEATURES_BROKEN_UNVERIFIABLE' WHEN NOT has_target AND q THEN 'PREDICTIONS_SHIFTED'
                WHEN NOT has_target THEN 'UNLABELLED_STABLE' WHEN t AND NOT f THEN 'LABEL_DATA_QUALITY' WHEN f AND p THEN 'RETRAIN_CANDIDATE'
                WHEN f THEN 'COVARIATE_DRIFT_ONLY' WHEN p THEN 'CONCEPT_DRIFT' ELSE 'HEALTHY' END AS diagnosis,
            (SELECT count(*) FROM batch b WHERE b.batch_id = flag.batch_id) AS n_rows,
            (SELECT count(*) FROM violation v WHERE v.batch_id = flag.batch_id) AS n_violations,
            (SELECT max(psi) FROM fpsi p WHERE p.batch_id = flag.batch_id) AS psi_max,
            (SELECT max_by(feature, psi) FROM fpsi p WHERE p.batch_id = flag.batch_id) AS psi_max_feature FROM flag""",
    "transition": """SELECT batch_id, name, CASE WHEN now AND was THEN 'ONGOING' WHEN now THEN 'NEW' ELSE 'RESOLVED' END AS transition FROM (
        SELECT b.batch_id, n.name, bool_or(s.status IS NOT NULL) AS now,
            bool_or(n.name IN (SELECT name FROM signal WHERE batch_id = '2000' AND status <> 'OK')
                    AND (b.batch_id, n.name) IN (SELECT (batch_id, name) FROM signal)) AS was
        FROM (SELECT DISTINCT batch_id FROM batch) b CROSS JOIN (SELECT DISTINCT name FROM signal) n
        LEFT JOIN (SELECT * FROM signal WHERE status <> 'OK') s ON s.batch_id = b.batch_id AND s.name = n.name GROUP BY ALL)
        WHERE now OR was""",
    # alerts over events
    "mean_value": """SELECT CAST(floor(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) / 7) AS INTEGER) AS run,
        'u' || (user_id % 20) AS batch_id, 'mean:' || event_type AS name, avg(value) AS value FROM events GROUP BY ALL""",
    "observed": """SELECT r.run, r.batch_id, n.name, CASE WHEN value > 60 THEN 2 WHEN value > 50 THEN 1 ELSE 0 END AS level
        FROM (SELECT DISTINCT run, batch_id FROM mean_value) r CROSS JOIN (SELECT DISTINCT name FROM mean_value) n
        LEFT JOIN mean_value m ON m.run = r.run AND m.batch_id = r.batch_id AND m.name = n.name""",
    "stepped": """SELECT *, coalesce(lag(level) OVER w, 0) AS before FROM observed WINDOW w AS (PARTITION BY batch_id, name ORDER BY run)""",
    "island": """SELECT *, sum(CASE WHEN level > 0 AND before = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY batch_id, name ORDER BY run) AS no
        FROM stepped WHERE level > 0 OR before > 0""",
    "alert": """SELECT *, count_if(level > 0) OVER w AS occurrences, min(run) OVER w AS first_run,
            max(CASE WHEN level > 0 THEN run END) OVER w AS last_run,
            last_value(CASE WHEN level > 0 THEN level END IGNORE NULLS) OVER w AS severity
        FROM island WINDOW w AS (PARTITION BY batch_id, name, no ORDER BY run)""",
    # ledger
    "named": """SELECT p_brand AS model, p_partkey AS version, 'r' || p_partkey AS run_id, CASE WHEN p_partkey % 13 <> 0 THEN p_type END AS family,
            p_retailprice AS val_rmse, CASE WHEN p_partkey % 11 <> 0 THEN p_size / 50 END AS val_r2,
            CASE WHEN p_partkey % 17 <> 0 THEN (p_partkey % 40) / 200 END AS overfit, p_size AS size,
            CAST(regexp_extract(p_brand, '(\\d+)', 1) AS INTEGER) AS no,
            p_partkey % 7 <> 0 AND p_partkey % 5 <> 0 AS eligible FROM part""",
    "alias": """SELECT model, 'production' AS alias, min(version) AS version FROM named WHERE no % 3 <> 0 AND size < 25 GROUP BY model UNION ALL
        SELECT model, 'staging', max(version) FROM named WHERE no % 2 = 0 AND size >= 38 GROUP BY model""",
    "candidate": """SELECT model, arg_min(version, priority) AS version, arg_min(source, priority) AS source FROM (
        SELECT model, min(version) AS version, 0 AS priority, 'requested' AS source FROM named WHERE model = 'Brand#5' GROUP BY model UNION ALL
        SELECT model, version, 1, 'staging' FROM alias WHERE alias = 'staging' UNION ALL
        SELECT model, max(version), 2, 'latest' FROM named GROUP BY model) GROUP BY model""",
    "decision": """SELECT model, version, source, production_version, r2_gate, overfitting_gate, improvement_gate,
            CASE WHEN version = production_version THEN 'NOOP' WHEN r2_gate LIKE 'REJECT%' OR overfitting_gate LIKE 'REJECT%'
                OR improvement_gate LIKE 'REJECT%' THEN 'REJECT' ELSE 'PROMOTE' END AS action,
            'r2: ' || r2_gate || '; overfitting: ' || overfitting_gate || '; improvement: ' || improvement_gate AS reasons FROM (
        SELECT c.model, c.version, c.source, p.version AS production_version,
            CASE WHEN n.val_r2 IS NULL THEN 'REJECT_MISSING' WHEN n.val_r2 < 0.7 THEN 'REJECT' ELSE 'OK' END AS r2_gate,
            CASE WHEN n.overfit IS NULL THEN 'NOTICE_MISSING' WHEN n.overfit >= 0.15 THEN 'REJECT' ELSE 'OK' END AS overfitting_gate,
            CASE WHEN pn.val_rmse IS NULL THEN 'OK_NO_PRODUCTION' WHEN n.val_rmse <= pn.val_rmse THEN 'OK' ELSE 'REJECT' END AS improvement_gate
        FROM candidate c JOIN named n USING (model, version) LEFT JOIN (SELECT * FROM alias WHERE alias = 'production') p ON p.model = c.model
        LEFT JOIN named pn ON pn.model = p.model AND pn.version = p.version)""",
    # selection
    "contender": """SELECT p_brand, p_type AS family, floor(max(p_retailprice) / 50) * 50 AS val_rmse, avg(p_size) / 50 AS val_r2,
            max(p_size) / 50 AS train_r2, round(stddev_pop(p_retailprice), 6) AS cv_rmse_log,
            CAST(list_position(['LARGE', 'ECONOMY', 'SMALL', 'STANDARD', 'PROMO', 'MEDIUM'], p_type) AS INTEGER) AS catalog_order
        FROM part GROUP BY p_brand, p_type""",
    "price_text": """SELECT CAST(l_orderkey % 6 AS INTEGER) AS kind, l_linenumber, CAST(l_extendedprice AS DECIMAL(18, 2)) AS price FROM lineitem""",
    "orders_raw": """SELECT CAST(year(o_orderdate) AS VARCHAR) AS batch_id, o_orderkey AS k, year(o_orderdate) = 1997 OR o_orderkey % 101 = 0 AS lost,
        CASE WHEN o_orderkey % 97 <> 0 THEN o_totalprice END AS price, CASE WHEN o_orderkey % 89 <> 0 THEN o_orderpriority END AS priority,
        o_orderstatus FROM orders""",
}

_USES = {
    "train": ["li"], "valid": ["li"], "batch": ["li"], "ref": ["train", "valid"], "edges": ["ref"], "grid": ["edges"],
    "refbin": ["grid", "ref", "edges"], "long": ["batch"], "counts": ["batch", "grid", "long", "edges"],
    "npsi": ["counts", "refbin"], "cat_ref": ["train"], "cat_batch": ["batch"], "cpsi": ["cat_ref", "cat_batch"],
    "fpsi": ["npsi", "cpsi"], "threshold": ["rule", "batch"], "violation": ["long", "bound"], "val_metric": ["valid"],
    "metric": ["batch"], "raw_signal": ["violation", "threshold", "fpsi", "npsi", "metric", "val_metric", "train"],
    "signal": ["raw_signal"], "flag": ["signal"], "status": ["flag", "batch", "violation", "fpsi"], "transition": ["signal", "batch"],
    "observed": ["mean_value"], "stepped": ["observed"], "island": ["stepped"], "alert": ["island"], "alias": ["named"],
    "candidate": ["named", "alias"], "decision": ["candidate", "named", "alias"],
}


def _needed(names: list[str], seen: list[str]) -> list[str]:
    for name in names:
        if name not in seen:
            _needed(_USES.get(name, []), seen)
            seen.append(name)
    return seen


def _sql(final: str, *views: str) -> str:
    if not views:
        return final
    parts = ",\n".join(f"{name} AS MATERIALIZED ({_VIEWS[name]})" for name in _needed(list(views), []))
    return f"WITH {parts},\n{final[5:]}" if final.startswith("WITH ") else f"WITH {parts}\n{final}"


def oracle(name: str, final: str, *views: str) -> None:
    ORACLES[name] = _sql(final, *views)


def _severity(pct: str) -> str:
    return f"CASE WHEN {pct} > 1.0 THEN 'ALERT' WHEN {pct} > 0.0 THEN 'WARNING' ELSE 'OK' END"


# --- text and files -------------------------------------------------------------------------

oracle("decimal_text", """SELECT kind, count(*) AS n, count_if(kind < 5) AS n_parsed,
    count_if(kind = 5 AND l_linenumber <> 2) AS n_failed, round(CAST(sum(CASE WHEN kind < 5 THEN price END) AS DOUBLE), 2) + 0.0 AS total
    FROM price_text GROUP BY kind""", "price_text")
oracle("decimal_conventions", """SELECT kind, CASE WHEN kind IN (2, 3) THEN 'mixed' WHEN kind IN (1, 4) THEN 'comma' ELSE 'dot' END AS convention
    FROM price_text GROUP BY kind""", "price_text")
oracle("discovered_batches", """SELECT CAST(yr AS VARCHAR) AS batch_id, yr <> 2001 AS has_target,
    CASE yr WHEN 2001 THEN NULL WHEN 2000 THEN 'dot' ELSE 'comma' END AS convention FROM li GROUP BY yr""", "li")
oracle("loaded_batches", """SELECT CAST(yr AS VARCHAR) AS batch_id, yr <> 2001 AS has_target, count(*) AS n_features,
    CASE yr WHEN 2001 THEN NULL WHEN 2000 THEN count_if(price <= 100000) ELSE count(*) END AS n_target,
    CASE yr WHEN 2000 THEN count_if(price <= 100000) ELSE count(*) END AS n_scored, count(*) - 1 AS last_index,
    round(sum(l_quantity * l_discount), 2) + 0.0 AS features_sum,
    round(sum(CASE WHEN yr < 2000 OR yr > 2001 OR (yr = 2000 AND price <= 100000) THEN l_quantity * price END), 1) + 0.0 AS pairs_sum,
    count_if(l_returnflag = 'R') AS n_returned FROM li GROUP BY yr""", "li")
oracle("loaded_batch_violations", """SELECT '2001' AS batch_id, 'l_tax' AS "column", 'missing_column' AS kind, 'ALERT' AS severity,
    count(*) AS n_rows, CAST(100.0 AS DOUBLE) AS pct_rows FROM li WHERE yr = 2001 UNION ALL
    SELECT '2000', 'price', 'row_count_mismatch', 'ALERT', count_if(price > 100000), 100.0 FROM li WHERE yr = 2000""", "li")
oracle("training_ingest", """SELECT l_returnflag, count(*) AS n, sum(l_quantity) AS quantity, round(sum(l_tax), 4) + 0.0 AS tax FROM (
    SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber, l_quantity, l_discount, l_tax FROM lineitem) GROUP BY l_returnflag""")
oracle("random_sample", """SELECT CAST(least(500, (SELECT count(*) FROM orders)) AS BIGINT) AS n,
    CAST(least(500, (SELECT count(*) FROM orders)) AS BIGINT) AS n_distinct""")
oracle("prediction_sinks", """SELECT batch_id, count(*) AS n, count(price) AS n_actual, round(avg(abs(price - prediction)), 4) + 0.0 AS abs_error,
    round(avg(abs((price - prediction) / price) * 100), 6) + 0.0 AS pct_error, '3' AS model_version, 'run-1' AS run_id,
    '2024-05-01 12:00:00' AS scored_at, count(*) AS n_csv FROM batch GROUP BY batch_id""", "batch")
oracle("baseline_in_use", """SELECT 'new' AS requested, 'new' AS model_id, true AS exact,
    round(sqrt(avg((price - prediction) ** 2)), 4) + 0.0 AS val_rmse FROM valid UNION ALL
    SELECT 'unknown', 'newest', false, round(sqrt(avg((price - prediction) ** 2)), 4) + 0.0 FROM li WHERE yr <= 1998""", "li", "valid")

# --- projections ----------------------------------------------------------------------------

oracle("derived_features", """SELECT yr, round(sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END), 4) + 0.0 AS quantity_returned,
    round(sum(CASE WHEN l_linestatus = 'O' THEN l_tax ELSE 0 END), 4) + 0.0 AS tax_open,
    round(sum(l_quantity * l_quantity), 4) + 0.0 AS quantity_squared, round(sum(l_discount * l_discount), 4) + 0.0 AS discount_squared,
    CAST(count_if(l_quantity > 30) AS DOUBLE) AS large_order, CAST(count_if(l_discount > 0.05) AS DOUBLE) AS high_discount FROM li GROUP BY yr""", "li")
oracle("log_target", """SELECT yr, round(avg(ln(1 + price)), 6) + 0.0 AS mean_log, round(avg(price), 4) + 0.0 AS mean_back FROM li GROUP BY yr""", "li")
oracle("features_without_bookkeeping", """SELECT o_orderstatus, o_orderpriority, count(*) AS n, CAST(NULL AS DOUBLE) AS target_sum
    FROM orders GROUP BY ALL UNION ALL SELECT NULL, NULL, NULL, round(sum(o_totalprice), 1) + 0.0 FROM orders""")
oracle("row_errors", """SELECT batch_id, count(p) AS n_abs, count(CASE WHEN p <> 0 THEN 1 END) AS n_pct,
    round(avg(abs(p - prediction)), 4) + 0.0 AS abs_error, round(avg(CASE WHEN p <> 0 THEN abs((p - prediction) / p) * 100 END), 6) + 0.0 AS pct_error
    FROM (SELECT batch_id, prediction, CASE WHEN l_linenumber = 7 THEN 0.0 ELSE price END AS p FROM batch) GROUP BY batch_id""", "batch")
oracle("one_hot_columns", """SELECT l_returnflag, l_linestatus, count(*) AS n, count_if(l_returnflag = 'N') AS l_returnflag_n,
    count_if(l_linestatus = 'O') AS l_linestatus_o, 11 AS width FROM lineitem GROUP BY l_returnflag, l_linestatus""")
oracle("category_code_columns", """SELECT o_orderpriority, dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS o_orderpriority_code, count(*) AS n
    FROM orders GROUP BY o_orderpriority""")
oracle("labelled_flag", """SELECT CASE WHEN l_quantity > 30 THEN 'large' ELSE 'small' END AS size, count(*) AS n, round(avg(price), 4) + 0.0 AS mean_price
    FROM li GROUP BY 1""", "li")

# --- contract -------------------------------------------------------------------------------

_ORDER_CHECKS = """SELECT batch_id, 'o_custkey' AS "column", 'nulls' AS kind, count_if(lost) AS n, count(*) AS total FROM orders_raw
    WHERE batch_id <> '1997' GROUP BY ALL UNION ALL
    SELECT batch_id, 'o_totalprice', 'nulls', count_if(price IS NULL), count(*) FROM orders_raw GROUP BY ALL UNION ALL
    SELECT batch_id, 'o_totalprice', 'out_of_range', count_if(price < 5000 OR price > 400000), count(*) FROM orders_raw GROUP BY ALL UNION ALL
    SELECT batch_id, 'o_orderpriority', 'nulls', count_if(priority IS NULL), count(*) FROM orders_raw GROUP BY ALL UNION ALL
    SELECT batch_id, 'o_orderpriority', 'unknown_category', count_if(priority = '4-NOT SPECIFIED'), count(*) FROM orders_raw GROUP BY ALL"""
oracle("contract_violations", f"""SELECT batch_id, "column", kind, {_severity('100.0 * n / total')} AS severity, n AS n_rows,
    round(100.0 * n / total, 6) + 0.0 AS pct_rows FROM ({_ORDER_CHECKS}) WHERE n > 0 UNION ALL
    SELECT batch_id, 'o_custkey', 'not_numeric', 'ALERT', count(*), 100.0 FROM orders_raw WHERE batch_id = '1997' GROUP BY batch_id UNION ALL
    SELECT batch_id, 'o_clerk', 'missing_column', 'ALERT', count(*), 100.0 FROM orders_raw GROUP BY batch_id""", "orders_raw")
oracle("unknown_levels", """SELECT batch_id, 'o_orderpriority' AS "column", lower(priority) AS level, count(*) AS n_rows
    FROM orders_raw WHERE priority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW') GROUP BY ALL""", "orders_raw")
oracle("contract_severity", f"""SELECT CAST(c_nationkey AS VARCHAR) AS batch_id,
    {_severity('100.0 * count_if(c_acctbal < 0 OR c_acctbal > 9990) / count(*)')} AS severity FROM customer GROUP BY c_nationkey
    HAVING count_if(c_acctbal < 0 OR c_acctbal > 9990) > 0""")
oracle("training_contract", f"""SELECT 'train' AS batch_id, 'l_quantity' AS "column", 'out_of_range' AS kind,
    {_severity('100.0 * count_if(l_quantity < 2) / count(*)')} AS severity, count_if(l_quantity < 2) AS n_rows,
    round(100.0 * count_if(l_quantity < 2) / count(*), 6) + 0.0 AS pct_rows FROM train UNION ALL
    SELECT 'train', 'price', 'out_of_range', {_severity('100.0 * count_if(price < 1000 OR price > 104000) / count(*)')},
    count_if(price < 1000 OR price > 104000), round(100.0 * count_if(price < 1000 OR price > 104000) / count(*), 6) + 0.0 FROM train""", "train")

# --- profiles and drift ---------------------------------------------------------------------

oracle("numeric_profile", """SELECT series, count(*) AS n, round(avg(value), 4) + 0.0 AS mean, round(stddev_samp(value), 4) + 0.0 AS std,
    min(value) AS min, max(value) AS max, round(quantile_cont(value, 0.01), 6) + 0.0 AS p01, round(quantile_cont(value, 0.25), 6) + 0.0 AS p25,
    round(quantile_cont(value, 0.5), 6) + 0.0 AS p50, round(quantile_cont(value, 0.75), 6) + 0.0 AS p75,
    round(quantile_cont(value, 0.99), 6) + 0.0 AS p99 FROM ref WHERE series LIKE 'l%' GROUP BY series""", "ref")
oracle("target_and_prediction_profile", """SELECT series, count(*) AS n, round(avg(value), 4) + 0.0 AS mean, round(stddev_samp(value), 4) + 0.0 AS std,
    round(min(value), 4) + 0.0 AS min, round(max(value), 4) + 0.0 AS max, round(quantile_cont(value, 0.25), 4) + 0.0 AS p25,
    round(quantile_cont(value, 0.5), 4) + 0.0 AS p50, round(quantile_cont(value, 0.75), 4) + 0.0 AS p75
    FROM ref WHERE series NOT LIKE 'l%' GROUP BY series""", "ref")
oracle("level_frequencies", """SELECT feature, category, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY feature), 6) + 0.0 AS freq FROM (
    SELECT 'l_returnflag' AS feature, lower(l_returnflag) AS category FROM train UNION ALL SELECT 'l_linestatus', lower(l_linestatus) FROM train)
    GROUP BY feature, category""", "train")
oracle("quantile_bins", """SELECT series, CAST(bin AS INTEGER) AS bin, CASE WHEN bin > 0 THEN round(edges[bin], 6) + 0.0 END AS lower_edge,
    round(freq, 6) + 0.0 AS freq FROM refbin""", "refbin")
oracle("batch_bin_counts", """SELECT batch_id, series, CAST(bin AS INTEGER) AS bin, n FROM counts WHERE NOT (batch_id = '2001' AND series = '__target__')""", "counts")
oracle("numeric_psi", "SELECT batch_id, series, round(psi, 6) + 0.0 AS psi FROM npsi", "npsi")
ORACLES["numeric_psi_many_bins"] = ORACLES["numeric_psi"].replace(
    "[0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1]", str([k / 20 for k in range(21)]))
oracle("categorical_psi", """WITH r AS (SELECT feature, category, count(*) / sum(count(*)) OVER (PARTITION BY feature) AS freq FROM (
        SELECT 'l_returnflag' AS feature, lower(l_returnflag) AS category FROM lineitem WHERE year(l_shipdate) <= 1998 AND l_returnflag <> 'R' UNION ALL
        SELECT 'l_linestatus', lower(l_linestatus) FROM lineitem WHERE year(l_shipdate) <= 1998) GROUP BY feature, category),
    b AS (SELECT batch_id, feature, category, count(*) AS n FROM (
        SELECT CAST(year(l_shipdate) AS VARCHAR) AS batch_id, 'l_returnflag' AS feature, lower(l_returnflag) AS category FROM lineitem
        WHERE year(l_shipdate) > 1998 AND (year(l_shipdate) <> 2000 OR l_returnflag <> 'A') UNION ALL
        SELECT CAST(year(l_shipdate) AS VARCHAR), 'l_linestatus', lower(l_linestatus) FROM lineitem WHERE year(l_shipdate) > 1998) GROUP BY ALL),
    u AS (SELECT batch_id, feature, category FROM b UNION SELECT batch_id, feature, category FROM r, (SELECT DISTINCT batch_id FROM b)),
    f AS (SELECT u.batch_id, u.feature, greatest(coalesce(b.n, 0) / sum(b.n) OVER (PARTITION BY u.batch_id, u.feature), 1e-6) AS a,
        greatest(coalesce(r.freq, 0), 1e-6) AS r FROM u LEFT JOIN b USING (batch_id, feature, category) LEFT JOIN r USING (feature, category)),
    g AS (SELECT batch_id, feature, a / sum(a) OVER w AS a, r / sum(r) OVER w AS r FROM f WINDOW w AS (PARTITION BY batch_id, feature))
    SELECT batch_id, feature, round(sum((a - r) * ln(a / r)), 6) + 0.0 AS psi FROM g GROUP BY batch_id, feature""")
oracle("regression_metrics", """SELECT batch_id, count(*) AS n_samples, round(sqrt(avg((y - p) ** 2)), 3) + 0.0 AS rmse, round(avg(abs(y - p)), 3) + 0.0 AS mae,
    round(1 - sum((y - p) ** 2) / (count(*) * var_pop(y)), 6) + 0.0 AS r2,
    round(avg(CASE WHEN y <> 0 THEN abs((y - p) / y) END) * 100, 6) + 0.0 AS mape,
    round(sqrt(avg((ly - lp) ** 2)), 6) + 0.0 AS rmse_log, round(avg(abs(ly - lp)), 6) + 0.0 AS mae_log,
    round(1 - sum((ly - lp) ** 2) / (count(*) * var_pop(ly)), 6) + 0.0 AS r2_log,
    round(avg(CASE WHEN ly <> 0 THEN abs((ly - lp) / ly) END) * 100, 6) + 0.0 AS mape_log,
    round(1 - sum((y - p) ** 2) / (count(*) * var_pop(y)) * (count(*) - 1) / (count(*) - 7), 6) + 0.0 AS adj_r2
    FROM (SELECT batch_id, y, p, ln(1 + y) AS ly, ln(1 + p) AS lp FROM (
        SELECT batch_id, CASE WHEN l_linenumber = 7 THEN 0.0 ELSE price END AS y, prediction AS p FROM batch
        WHERE yr <> 2001 AND l_linenumber <> 6)) GROUP BY batch_id
    UNION ALL SELECT DISTINCT batch_id, 0, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM batch WHERE yr = 2001""", "batch")
oracle("prediction_summaries", """SELECT batch_id, round(avg(prediction), 4) + 0.0 AS pred_mean, round(stddev_pop(prediction), 4) + 0.0 AS pred_std,
    round(min(prediction), 4) + 0.0 AS pred_min, round(max(prediction), 4) + 0.0 AS pred_max FROM batch GROUP BY batch_id""", "batch")
oracle("largest_psi", """SELECT batch_id, round(max(psi), 6) + 0.0 AS psi_max, max_by(feature, psi) AS psi_max_feature,
    CAST(count(*) AS INTEGER) AS n_features FROM fpsi GROUP BY batch_id""", "fpsi")
# validation as the only batch
ORACLES["split_reference_psi"] = _sql(
    "SELECT feature, round(psi, 6) + 0.0 AS psi, psi > 0.10 AS above_warning FROM fpsi", "fpsi").replace(
    _VIEWS["batch"], "SELECT 'validation' AS batch_id, * FROM li WHERE yr <= 1998 AND l_orderkey % 5 = 0")

# --- rules, signals and reports -------------------------------------------------------------

oracle("resolved_thresholds", "SELECT * FROM threshold WHERE feature <> ''", "threshold")
oracle("monitoring_signals", """SELECT batch_id, name, category, round(value, 4) + 0.0 AS value, status, thresholds_source FROM signal""", "signal")
oracle("batch_diagnosis", """SELECT batch_id, n_rows, has_target, status, diagnosis AS diagnosis_code, true AS reconciled, n_violations, psi_max_feature
    FROM status UNION ALL SELECT '2002', 0, true, 'ALERT', 'UNREADABLE', false, 0, NULL""", "status")
oracle("worst_signal", "SELECT batch_id, status FROM status", "status")
oracle("custom_threshold_sources", """SELECT batch_id, thresholds_source, string_agg(name, ',' ORDER BY name) AS signals FROM signal
    WHERE thresholds_source <> 'default' GROUP BY batch_id, thresholds_source""", "signal")
oracle("flat_monitoring_report", """SELECT s.batch_id, '2024-05-01 12:00:00' AS scored_at, s.n_rows, s.has_target, s.status,
    round(m.rmse, 3) + 0.0 AS rmse, round(m.mae, 3) + 0.0 AS mae, round(m.r2, 6) + 0.0 AS r2, round(m.mape, 6) + 0.0 AS mape,
    round(val_rmse, 3) + 0.0 AS baseline_rmse, round(val_r2, 6) + 0.0 AS baseline_r2, round(psi_max, 4) + 0.0 AS psi_max, psi_max_feature,
    n_violations, round((SELECT avg(prediction) FROM batch b WHERE b.batch_id = s.batch_id), 4) + 0.0 AS pred_mean,
    coalesce((SELECT count_if(transition = 'NEW') FROM transition t WHERE t.batch_id = s.batch_id), 0) AS alerts_new,
    coalesce((SELECT count_if(transition = 'ONGOING') FROM transition t WHERE t.batch_id = s.batch_id), 0) AS alerts_ongoing,
    coalesce((SELECT count_if(transition = 'RESOLVED') FROM transition t WHERE t.batch_id = s.batch_id), 0) AS alerts_resolved,
    diagnosis, 'price' AS model_name, '3' AS model_version, 'registry:production' AS model_source, 'train-9' AS training_run_id, 'run-2' AS run_id
    FROM (SELECT * FROM status UNION ALL SELECT '2002', true, 'ALERT', 'UNREADABLE', 0, 0, 0.0, NULL) s
    LEFT JOIN metric m USING (batch_id) CROSS JOIN val_metric""", "status", "metric", "val_metric", "transition")
oracle("consolidated_report", """SELECT 'ALERT' AS overall_status, count(*) + 1 AS n_batches, count_if(status = 'OK') AS n_ok, count_if(status = 'WARNING') AS n_warning,
    count_if(status = 'ALERT') + 1 AS n_alert, (SELECT count_if(transition = 'NEW') FROM transition) AS new,
    (SELECT count_if(transition = 'ONGOING') FROM transition) AS ongoing, (SELECT count_if(transition = 'RESOLVED') FROM transition) AS resolved
    FROM status""", "status", "transition")
oracle("alert_transition_counts", """SELECT s.batch_id, true AS reconciled, count_if(transition = 'NEW') AS new, count_if(transition = 'ONGOING') AS ongoing,
    count_if(transition = 'RESOLVED') AS resolved FROM status s LEFT JOIN transition t USING (batch_id) GROUP BY s.batch_id
    UNION ALL SELECT '2002', false, NULL, NULL, NULL""", "status", "transition")
oracle("report_sinks", """SELECT batch_id, status, diagnosis, CAST((SELECT count(*) FROM signal g WHERE g.batch_id = s.batch_id) AS INTEGER) AS n_signals,
    status AS json_status, status AS csv_status FROM status s UNION ALL SELECT '2002', 'ALERT', 'UNREADABLE', NULL, 'ALERT', 'ALERT'""", "status", "signal")

# --- alerts ---------------------------------------------------------------------------------

_NAME_OF = "CASE {} WHEN 2 THEN 'ALERT' WHEN 1 THEN 'WARNING' END"
_DAY_OF = "strftime(DATE '2024-05-01' + 7 * CAST({} AS INTEGER), '%Y-%m-%d')"
oracle("alert_transitions", f"""SELECT 'run-' || run AS run_id, batch_id, name AS signal_name, {_NAME_OF.format('severity')} AS severity,
    CASE WHEN level = 0 THEN 'RESOLVED' WHEN before = 0 THEN 'NEW' ELSE 'ONGOING' END AS transition, occurrences,
    {_DAY_OF.format('first_run')} AS first_seen, {_DAY_OF.format('last_run')} AS last_seen,
    CASE WHEN level > 0 AND before > 0 AND level <> before THEN {_NAME_OF.format('before')} END AS escalated_from,
    CASE WHEN level > before AND before > 0 THEN 'up' WHEN level < before AND level > 0 THEN 'down' END AS direction FROM alert""", "alert")
_STATE = f"""SELECT batch_id, name AS signal_name, {_NAME_OF.format('max_by(severity, run)')} AS severity,
    CASE WHEN max_by(level, run) = 0 THEN 'resolved' ELSE 'open' END AS state, max(occurrences) AS occurrences,
    {_DAY_OF.format('min(run)')} AS first_seen, {_DAY_OF.format('max(last_run)')} AS last_seen,
    CASE WHEN max_by(level, run) = 0 THEN {_DAY_OF.format('max(run)')} END AS resolved_at,
    CAST(count_if(level > 0 AND level <> before) AS INTEGER) AS n_changes,
    string_agg(CASE WHEN level > 0 AND level <> before THEN {_NAME_OF.format('level')} END, '>' ORDER BY run) AS history,
    'week ' || max(last_run) AS last_detail FROM alert GROUP BY batch_id, name, no"""
oracle("alert_state", _STATE, "alert")
oracle("open_alert_history", f"""SELECT batch_id, signal_name, severity, occurrences, last_seen FROM ({_STATE}) WHERE state = 'open'
    ORDER BY last_seen DESC, batch_id, signal_name LIMIT 50""", "alert")
oracle("duplicate_open_alerts", f"""SELECT batch_id, signal_name, CAST(2 AS BIGINT) AS count FROM ({_STATE})
    WHERE state = 'open' AND occurrences > 1""", "alert")
oracle("alert_report_order", """SELECT batch_id, name AS signal_name, transition, CAST(row_number() OVER (PARTITION BY batch_id ORDER BY
    list_position(['NEW', 'ONGOING', 'RESOLVED'], transition), name) AS INTEGER) AS position FROM (
    SELECT *, CASE WHEN level = 0 THEN 'RESOLVED' WHEN before = 0 THEN 'NEW' ELSE 'ONGOING' END AS transition FROM alert WHERE run = 2)""", "alert")

# --- exploration ----------------------------------------------------------------------------

_ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
oracle("table_shape", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {i} AS position, count(*) AS n_rows, {len(_ORDER_COLUMNS)} AS n_columns FROM orders"
    for i, c in enumerate(_ORDER_COLUMNS)))
_FEW = "l_returnflag, l_linestatus, l_linenumber, l_quantity, l_discount, l_tax"
oracle("duplicate_rows", f"""SELECT count(*) AS n_rows, count(DISTINCT ({_FEW})) AS n_distinct, count(*) - count(DISTINCT ({_FEW})) AS n_duplicates FROM lineitem""")
oracle("duplicate_copies", f"""SELECT l_returnflag, n_copies, CAST(sum(n_copies) AS BIGINT) AS n_rows, sum(l_quantity * n_copies) AS quantity FROM (
    SELECT {_FEW}, count(*) AS n_copies FROM lineitem GROUP BY ALL HAVING count(*) > 1) GROUP BY l_returnflag, n_copies""")
oracle("null_counts", """SELECT unnest(['batch_id', 'o_custkey', 'o_totalprice', 'o_orderpriority', 'o_orderstatus']) AS "column",
    unnest([0, 0, count_if(o_orderkey % 97 = 0), count_if(o_orderkey % 89 = 0), 0]) AS n_null FROM orders""")
_MELTED = """(SELECT 'l_quantity' AS series, l_quantity AS value FROM lineitem UNION ALL SELECT 'l_extendedprice', l_extendedprice FROM lineitem
    UNION ALL SELECT 'l_discount', l_discount FROM lineitem UNION ALL SELECT 'l_tax', l_tax FROM lineitem)"""
oracle("described_columns", f"""SELECT series, count(*) AS n, round(avg(value), 4) + 0.0 AS mean, round(stddev_samp(value), 4) + 0.0 AS std, min(value) AS min,
    max(value) AS max, round(quantile_cont(value, 0.25), 4) + 0.0 AS p25, round(quantile_cont(value, 0.5), 4) + 0.0 AS p50,
    round(quantile_cont(value, 0.75), 4) + 0.0 AS p75 FROM {_MELTED} GROUP BY series""")
oracle("level_counts", """SELECT feature, category, n, round(n / sum(n) OVER (PARTITION BY feature), 6) + 0.0 AS freq,
    CAST(row_number() OVER (PARTITION BY feature ORDER BY n DESC, category) AS INTEGER) AS position FROM (
    SELECT 'o_orderstatus' AS feature, lower(o_orderstatus) AS category, count(*) AS n FROM orders GROUP BY ALL UNION ALL
    SELECT 'o_orderpriority', lower(o_orderpriority), count(*) FROM orders GROUP BY ALL)""")
oracle("column_moments", f"""SELECT series, count(*) AS n, round(avg(value), 4) + 0.0 AS mean, round(median(value), 4) + 0.0 AS median,
    round(stddev_samp(value), 4) + 0.0 AS std, min(value) AS min, max(value) AS max, round(skewness(value), 4) + 0.0 AS skewness,
    round(kurtosis(value), 4) + 0.0 AS kurtosis FROM {_MELTED} WHERE series <> 'l_tax' GROUP BY series""")
oracle("log_transform_effect", """SELECT 'raw' AS series, round(skewness(value), 4) + 0.0 AS skewness, round(kurtosis(value), 4) + 0.0 AS kurtosis FROM events
    UNION ALL SELECT 'log1p', round(skewness(ln(1 + value)), 4) + 0.0, round(kurtosis(ln(1 + value)), 4) + 0.0 FROM events""")
oracle("group_statistics", """SELECT l_returnflag, l_linestatus, count(*) AS n, round(avg(l_extendedprice), 4) + 0.0 AS mean,
    round(median(l_extendedprice), 4) + 0.0 AS median, round(stddev_samp(l_extendedprice), 4) + 0.0 AS std, min(l_extendedprice) AS min,
    max(l_extendedprice) AS max FROM lineitem GROUP BY l_returnflag, l_linestatus""")
oracle("mean_ratio", """SELECT round(avg(CASE WHEN l_returnflag = 'R' THEN l_extendedprice END) / avg(CASE WHEN l_returnflag <> 'R' THEN l_extendedprice END), 6)
    + 0.0 AS ratio FROM lineitem""")
_ENCODED = {
    "l_quantity": "l_quantity", "l_discount": "l_discount", "l_tax": "l_tax",
    "quantity_returned": "CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END",
    "tax_open": "CASE WHEN l_linestatus = 'O' THEN l_tax ELSE 0 END", "quantity_squared": "l_quantity * l_quantity",
    "discount_squared": "l_discount * l_discount", "large_order": "CASE WHEN l_quantity > 30 THEN 1 ELSE 0 END",
    "high_discount": "CASE WHEN l_discount > 0.05 THEN 1 ELSE 0 END", "is_open": "CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END"}
_WITH_PRICE = _ENCODED | {"price": "l_extendedprice"}
oracle("correlation_matrix", " UNION ALL ".join(
    f"SELECT '{a}' AS \"left\", '{b}' AS \"right\", {'1.0' if a == b else f'round(corr({x}, {y}), 6) + 0.0'} AS corr FROM lineitem"
    for a, x in _WITH_PRICE.items() for b, y in _WITH_PRICE.items() if a != b)
    + " UNION ALL " + " UNION ALL ".join(f"SELECT '{a}', '{a}', CAST(1.0 AS DOUBLE)" for a in _WITH_PRICE))
oracle("correlation_ranking", "SELECT feature, round(c, 6) + 0.0 AS corr, c > 0.5 AS strong, CAST(row_number() OVER (ORDER BY c DESC, feature) AS INTEGER) AS position FROM ("
    + " UNION ALL ".join(f"SELECT '{a}' AS feature, corr({x}, l_quantity) AS c FROM lineitem" for a, x in _ENCODED.items() if a != "l_quantity") + ")")
oracle("flag_shares", """SELECT 'large_order' AS flag, count_if(l_quantity > 30) AS n_true, round(100.0 * count_if(l_quantity > 30) / count(*), 6) + 0.0 AS pct_true
    FROM lineitem UNION ALL SELECT 'high_discount', count_if(l_discount > 0.05), round(100.0 * count_if(l_discount > 0.05) / count(*), 6) + 0.0 FROM lineitem""")
_MIXED = """(SELECT 'l_quantity' AS series, l_quantity AS value FROM lineitem UNION ALL SELECT 'l_extendedprice', l_extendedprice FROM lineitem
    UNION ALL SELECT 'value', value FROM events)"""
oracle("iqr_outliers", f"""WITH s AS {_MIXED}, q AS (SELECT series, quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS b FROM s GROUP BY series)
    SELECT series, round(a - 1.5 * (b - a), 4) + 0.0 AS lower, round(b + 1.5 * (b - a), 4) + 0.0 AS upper,
    count_if(value < a - 1.5 * (b - a) OR value > b + 1.5 * (b - a)) AS n_outliers,
    round(100.0 * count_if(value < a - 1.5 * (b - a) OR value > b + 1.5 * (b - a)) / count(*), 6) + 0.0 AS pct_outliers
    FROM s JOIN q USING (series) GROUP BY series, a, b""")
oracle("histogram", f"""WITH s AS {_MIXED}, l AS (SELECT series, min(value) AS lo, max(value) AS hi, (max(value) - min(value)) / 30 AS w FROM s
        WHERE series <> 'l_quantity' GROUP BY series),
    c AS (SELECT series, least(CAST(floor((value - lo) / w) AS INTEGER), 29) AS bin, count(*) AS n FROM s JOIN l USING (series) GROUP BY ALL)
    SELECT l.series, CAST(g.bin AS INTEGER) AS bin, round(lo + g.bin * w, 4) + 0.0 AS low, round(lo + (g.bin + 1) * w, 4) + 0.0 AS high, coalesce(n, 0) AS n
    FROM l CROSS JOIN (SELECT unnest(range(30)) AS bin) g LEFT JOIN c ON c.series = l.series AND c.bin = g.bin""")

# --- selection and training -----------------------------------------------------------------

def _selected(metric: str, order: str, shown: str) -> str:
    return f"""SELECT p_brand, max(CASE WHEN pos = 1 THEN family END) AS winner, max(CASE WHEN pos = 1 THEN {shown} END) AS winner_value,
    max(CASE WHEN pos = 2 THEN family END) AS runner_up, max(CASE WHEN pos = 2 THEN {shown} END) AS runner_up_value,
    max(CASE WHEN cv = 1 THEN family END) AS cv_winner, max(CASE WHEN pos = 1 THEN family END) <> max(CASE WHEN cv = 1 THEN family END) AS rankings_disagree
    FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY {metric} {order}, catalog_order) AS pos,
        row_number() OVER (PARTITION BY p_brand ORDER BY cv_rmse_log, catalog_order) AS cv FROM contender) GROUP BY p_brand"""


oracle("selected_families", _selected("val_rmse", "ASC", "val_rmse"), "contender")
oracle("selected_by_r2", _selected("val_r2", "DESC", "round(val_r2, 6) + 0.0"), "contender")
oracle("family_comparison", """SELECT c.p_brand, c.family, c.val_rmse, round(c.val_r2, 6) + 0.0 AS val_r2, round(c.train_r2, 6) + 0.0 AS train_r2, c.cv_rmse_log,
    c.catalog_order, round(c.train_r2 - c.val_r2, 6) + 0.0 AS overfitting_r2_diff, CASE WHEN c.train_r2 - c.val_r2 > 0.15 THEN 'severe'
    WHEN c.train_r2 - c.val_r2 > 0.1 THEN 'moderate' WHEN c.train_r2 - c.val_r2 > 0.05 THEN 'minor' ELSE 'none' END AS overfitting_band,
    c.val_rmse AS selection_value, round(f.val_rmse - c.val_rmse, 4) + 0.0 AS delta_to_linear
    FROM contender c LEFT JOIN contender f ON f.p_brand = c.p_brand AND f.family = 'STANDARD'""", "contender")
oracle("top_trials", """SELECT family, trial, mean_test_rmse, CAST(r AS INTEGER) AS rank FROM (SELECT p_type AS family, p_partkey AS trial,
    CAST(p_size AS DOUBLE) AS mean_test_rmse, rank() OVER (PARTITION BY p_type ORDER BY p_size) AS r,
    row_number() OVER (PARTITION BY p_type ORDER BY p_size, p_partkey) AS pos FROM part) WHERE pos <= 5""")
oracle("hashed_split", "SELECT count(DISTINCT o_orderkey) AS n_keys, CAST(0 AS BIGINT) AS n_moved, true AS near_a_fifth FROM orders")
_PRICED = """SELECT l_quantity AS x, l_discount AS d, l_tax, ln(1 + y) AS ly, y, l_orderkey % 5 = 0 AS held, l_linenumber % 2 AS fold FROM (
    SELECT *, 1000 + 50 * l_quantity + 4000 * l_discount + CASE WHEN l_returnflag = 'R' THEN 900 ELSE 0 END + price / 1000 AS y
    FROM li WHERE yr <= 1998)"""
_VIEWS["priced"], _USES["priced"] = _PRICED, ["li"]
oracle("cross_validated_trials", """WITH fit AS (SELECT f.fold AS left_out, regr_slope(ly, x) AS s, regr_intercept(ly, x) AS b
        FROM priced, (SELECT DISTINCT fold FROM priced) f WHERE NOT held AND priced.fold <> f.fold GROUP BY f.fold),
    e AS (SELECT left_out, sqrt(avg((ly - b - s * x) ** 2) FILTER (fold = left_out)) AS test,
        sqrt(avg((ly - b - s * x) ** 2) FILTER (fold <> left_out)) AS train FROM priced, fit WHERE NOT held GROUP BY left_out)
    SELECT 'ols' AS family, 0 AS trial, round(avg(test), 6) + 0.0 AS mean_test_rmse, round(stddev_pop(test), 6) + 0.0 AS std_test_rmse,
    round(avg(train), 6) + 0.0 AS mean_train_rmse FROM e""", "priced")
oracle("evaluated_splits", """WITH fit AS (SELECT regr_slope(ly, x) AS s, regr_intercept(ly, x) AS b FROM priced WHERE NOT held),
    p AS (SELECT held, y, exp(b + s * x) - 1 AS q FROM priced, fit),
    m AS (SELECT held, sqrt(avg((y - q) ** 2)) AS rmse, avg(abs(y - q)) AS mae, 1 - sum((y - q) ** 2) / (count(*) * var_pop(y)) AS r2 FROM p GROUP BY held)
    SELECT round(t.rmse, 3) + 0.0 AS train_rmse, round(v.rmse, 3) + 0.0 AS val_rmse, round(t.mae, 3) + 0.0 AS train_mae, round(v.mae, 3) + 0.0 AS val_mae,
    round(t.r2, 6) + 0.0 AS train_r2, round(v.r2, 6) + 0.0 AS val_r2, CASE WHEN t.r2 - v.r2 > 0.15 THEN 'severe' WHEN t.r2 - v.r2 > 0.1 THEN 'moderate'
    WHEN t.r2 - v.r2 > 0.05 THEN 'minor' ELSE 'none' END AS overfitting_band FROM m t, m v WHERE NOT t.held AND v.held""", "priced")
oracle("coefficient_importance", """SELECT 'abs_coef' AS kind, CAST(row_number() OVER (ORDER BY c DESC) AS INTEGER) AS position, feature, round(c, 5) + 0.0 AS importance FROM (
    SELECT 'l_quantity' AS feature, abs(covar_pop(ly, x) * var_pop(d) - covar_pop(ly, d) * covar_pop(x, d)) / (var_pop(x) * var_pop(d) - covar_pop(x, d) ** 2) AS c
    FROM priced WHERE NOT held UNION ALL
    SELECT 'l_discount', abs(covar_pop(ly, d) * var_pop(x) - covar_pop(ly, x) * covar_pop(x, d)) / (var_pop(x) * var_pop(d) - covar_pop(x, d) ** 2)
    FROM priced WHERE NOT held)""", "priced")
_SLOPES = """(covar_pop(ly, x) * var_pop(d) - covar_pop(ly, d) * covar_pop(x, d)) / (var_pop(x) * var_pop(d) - covar_pop(x, d) ** 2) AS a,
    (covar_pop(ly, d) * var_pop(x) - covar_pop(ly, x) * covar_pop(x, d)) / (var_pop(x) * var_pop(d) - covar_pop(x, d) ** 2) AS b,
    avg(x) AS mx, avg(d) AS md, avg(ly) AS my"""
oracle("elastic_net_path", f"""WITH fit AS (SELECT f.fold AS left_out, {_SLOPES}
        FROM priced, (SELECT DISTINCT fold FROM priced) f WHERE NOT held AND priced.fold <> f.fold GROUP BY f.fold),
    e AS (SELECT left_out, sqrt(avg((ly - my - a * (x - mx) - b * (d - md)) ** 2) FILTER (fold = left_out)) AS test,
        sqrt(avg((ly - my - a * (x - mx) - b * (d - md)) ** 2) FILTER (fold <> left_out)) AS train FROM priced, fit WHERE NOT held GROUP BY left_out)
    SELECT CAST(g.trial AS INTEGER) AS trial, round(avg(test), 6) + 0.0 AS mean_test_rmse, round(stddev_pop(test), 6) + 0.0 AS std_test_rmse,
    round(avg(train), 6) + 0.0 AS mean_train_rmse, (SELECT count(*) FROM priced WHERE NOT held) AS n_rows
    FROM e, (SELECT unnest(range(5)) AS trial) g GROUP BY g.trial""", "priced")
oracle("scaled_ridge", """WITH m AS (SELECT avg(x) AS mx, avg(d) AS md, avg(ly) AS my, stddev_samp(x) AS sx, stddev_samp(d) AS sd,
        covar_pop(x, ly) / stddev_samp(x) AS tx, covar_pop(d, ly) / stddev_samp(d) AS td, (count(*) - 1.0) / count(*) + 0.5 AS g,
        covar_pop(x, d) / (stddev_samp(x) * stddev_samp(d)) AS r FROM priced WHERE NOT held),
    w AS (SELECT *, (tx * g - r * td) / (g * g - r * r) / sx AS wx, (td * g - r * tx) / (g * g - r * r) / sd AS wd FROM m)
    SELECT 'l_quantity' AS feature, round(wx, 6) + 0.0 AS weight, round(my - wx * mx - wd * md, 6) + 0.0 AS intercept FROM w
    UNION ALL SELECT 'l_discount', round(wd, 6) + 0.0, round(my - wx * mx - wd * md, 6) + 0.0 FROM w""", "priced")
_MOMENT_COLUMNS = {"l_quantity": "x", "l_tax": "t", "label": "ly"}
oracle("fold_moments", "WITH s AS (SELECT fold, x, CASE WHEN l_tax > 0 THEN l_tax END AS t, ly FROM priced WHERE NOT held) " + " UNION ALL ".join(
    f"""SELECT fold, '{a}' AS "left", '{b}' AS "right", count(*) AS n, round(avg({x}), 6) + 0.0 AS mean_left, round(avg({y}), 6) + 0.0 AS mean_right,
    round(var_pop({x}), 6) + 0.0 AS m2_left, round(var_pop({y}), 6) + 0.0 AS m2_right, round(covar_pop({x}, {y}), 6) + 0.0 AS co
    FROM s WHERE {x} IS NOT NULL AND {y} IS NOT NULL GROUP BY fold"""
    for i, (a, x) in enumerate(_MOMENT_COLUMNS.items()) for b, y in list(_MOMENT_COLUMNS.items())[i:]), "priced")
oracle("linear_batch_predictions", """WITH fit AS (SELECT regr_slope(ln(1 + price), l_quantity) AS slope, regr_intercept(ln(1 + price), l_quantity) AS base
        FROM li WHERE yr <= 1998)
    SELECT yr AS batch, count(*) AS n, round(avg(exp(base + slope * l_quantity) - 1), 2) + 0.0 AS pred_mean,
    round(min(exp(base + slope * l_quantity) - 1), 2) + 0.0 AS pred_min FROM li, fit WHERE yr > 1998 GROUP BY yr""")
ORACLES["linear_batch_predictions"] = f"WITH li AS ({_VIEWS['li']}), " + ORACLES["linear_batch_predictions"].removeprefix("WITH ")

# --- ledger ---------------------------------------------------------------------------------

oracle("latest_versions", """SELECT model, max(version) AS version, max_by(run_id, version) AS run_id, arg_max_null(family, version) AS family
    FROM named GROUP BY model""", "named")
oracle("best_runs", """SELECT model, arg_min(run_id, (val_rmse, run_id)) AS run_id, min(val_rmse) AS val_rmse FROM named WHERE eligible GROUP BY model""", "named")
oracle("alias_metrics", """SELECT a.model, a.alias, a.version, n.run_id, n.family, n.val_rmse, round(n.val_r2, 6) + 0.0 AS val_r2,
    round(n.overfit, 6) + 0.0 AS overfitting_r2_diff FROM alias a JOIN named n USING (model, version)""", "alias")
oracle("duplicate_versions", "SELECT model, max(version) AS duplicate_of FROM named WHERE no % 4 IN (0, 1) GROUP BY model", "named")
oracle("resolved_models", """SELECT model, arg_min(source, p) AS source, arg_min_null(version, p) AS version, arg_min(run_id, p) AS run_id FROM (
    SELECT a.model, CASE alias WHEN 'production' THEN 0 ELSE 1 END AS p, 'registry:' || alias AS source, a.version, 'r' || a.version AS run_id FROM alias a UNION ALL
    SELECT model, 2, 'run:best', NULL, arg_min(run_id, (val_rmse, run_id)) FROM named WHERE eligible GROUP BY model) GROUP BY model""", "alias")
oracle("promotion_decisions", "SELECT * FROM decision", "decision")
oracle("promoted_aliases", """SELECT a.model, a.alias, a.version FROM alias a LEFT JOIN (SELECT * FROM decision WHERE action = 'PROMOTE') d USING (model)
    WHERE d.model IS NULL OR (a.alias = 'staging' AND a.version <> d.version) UNION ALL
    SELECT model, 'production', version FROM decision WHERE action = 'PROMOTE'""", "decision")
oracle("registered_versions", """SELECT model, max(version) + 1 AS version, 'Staging' AS stage, max(version) + 1 AS staged FROM named
    WHERE no % 2 = 1 GROUP BY model""", "named")
oracle("rejected_versions", """SELECT model, version, 'Staging' AS stage, replace(reasons, '; ', ' | ') AS rejection_reason,
    '2024-05-01 12:00:00' AS rejected_at FROM decision WHERE action = 'REJECT'""", "decision")
oracle("promoted_versions", """SELECT model, version, 'Production' AS stage, CAST(NULL AS BIGINT) AS superseded_by, replace(reasons, '; ', ' | ') AS promotion_reason
    FROM decision WHERE action = 'PROMOTE' UNION ALL
    SELECT model, production_version, 'Archived', version, NULL FROM decision WHERE action = 'PROMOTE' AND production_version IS NOT NULL""", "decision")
oracle("reproduced_metrics", """SELECT model, metric, round(d, 4) + 0.0 AS declared, round(m, 4) + 0.0 AS measured, round(m - d, 4) + 0.0 AS delta,
    round(abs(m - d) / abs(d), 6) + 0.0 AS relative, abs(m - d) / abs(d) <= 0.01 AS reproduced FROM (
    SELECT p_brand AS model, 'rmse' AS metric, avg(p_retailprice) FILTER (p_partkey % 2 = 0) AS d, avg(p_retailprice) AS m FROM part GROUP BY p_brand UNION ALL
    SELECT p_brand, 'mape', avg(p_size) FILTER (p_partkey % 2 = 0), avg(p_size) FROM part GROUP BY p_brand) WHERE d IS NOT NULL""")

oracle("damaged_batches", """SELECT CAST(yr AS VARCHAR) AS batch_id, CASE WHEN yr IN (2000, 2001) THEN 0 ELSE count(*) END AS n_features,
    CASE WHEN yr IN (2000, 2001) THEN 0 ELSE count(*) END AS n_target, CASE yr WHEN 2000 THEN 'damaged' WHEN 2001 THEN 'encoding' END AS reason,
    CASE WHEN yr IN (2000, 2001) THEN 0 ELSE count(*) END AS n_scored, CASE WHEN yr NOT IN (2000, 2001) THEN round(sum(l_quantity), 2) + 0.0 END AS quantity
    FROM li GROUP BY yr""", "li")
