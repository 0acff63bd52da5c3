"""Monitoring queries over the lineitem ⋈ part scored table."""

from __future__ import annotations

from vigil.operators import metrics
from vigil.plans import monitoring as mon
from vigil.plans.catalog import register, round_doubles, sql_rnd as R
from vigil.tables import table

_METRICS_SQL = f"""
    count(*) AS n_rows,
    {R("avg(pred - price)")} AS mean_error,
    {R("abs(avg(pred - price))")} AS abs_mean_error,
    {R("avg(abs(pred - price))")} AS mae,
    {R("sqrt(avg((pred - price) * (pred - price)))")} AS rmse,
    {R("100.0 * avg(CASE WHEN price <> 0 THEN abs(pred - price) / abs(price) END)")} AS mape,
    {R("avg(pred)")} AS prediction_mean,
    {R("avg(price)")} AS target_mean,
    {R("abs(avg(pred) - avg(price))")} AS prediction_target_mean_gap,
    {R("max(abs(pred - price))")} AS max_abs_error
"""


@register("daily_regression_quality", sql=f"""
    WITH m AS ({mon.MONITORING_SQL})
    SELECT CAST(start_date AS DATE) AS data_date, CAST(start_date AS DATE) + 1 AS report_date,
           {_METRICS_SQL}
    FROM m GROUP BY CAST(start_date AS DATE)
""")
def daily_regression_quality(spark, sf_dir):
    df = mon.monitoring_table(spark, sf_dir)
    return round_doubles(metrics.daily_regression_quality(df, mon.TIMESTAMP, mon.TARGET, mon.PREDICTION))


@register("hourly_regression_quality", sql=f"""
    WITH m AS ({mon.MONITORING_SQL})
    SELECT CAST(start_date AS DATE) AS data_date, CAST(hour(start_date) AS INTEGER) AS hour, {_METRICS_SQL}
    FROM m GROUP BY 1, 2
""")
def hourly_regression_quality(spark, sf_dir):
    """The same metrics per (day, hour of day)."""
    df = mon.monitoring_table(spark, sf_dir)
    return round_doubles(metrics.hourly_regression_quality(df, mon.TIMESTAMP, mon.TARGET, mon.PREDICTION))


@register("hourly_event_quality", sql=f"""
    WITH m AS (SELECT ts, value AS price, user_id % 100 AS pred FROM events)
    SELECT CAST(ts AS DATE) AS data_date, CAST(hour(ts) AS INTEGER) AS hour, {_METRICS_SQL}
    FROM m GROUP BY 1, 2
""")
def hourly_event_quality(spark, sf_dir):
    """A16 over timestamps that have hours: the events' values against a stand-in prediction from the user id."""
    ev = table(spark, sf_dir, "events").select("ts", F.col("value").alias("price"), (F.col("user_id") % 100).alias("pred"))
    return round_doubles(metrics.hourly_regression_quality(ev, "ts", "price", "pred"))


# ---------------------------------------------------------------- drift

from itertools import combinations  # noqa: E402

from pyspark.sql import functions as F  # noqa: E402

from vigil.operators import drift, profile, suite  # noqa: E402
from vigil.plans.catalog import rnd  # noqa: E402
from vigil.session import cut_lineage  # noqa: E402

_SPLIT_SQL = f"""
    m AS ({mon.MONITORING_SQL}),
    ref AS (SELECT * FROM m WHERE NOT coalesce(start_date >= TIMESTAMP '{mon.CURRENT_FROM}', false)),
    cur AS (SELECT * FROM m WHERE start_date >= TIMESTAMP '{mon.CURRENT_FROM}')
"""


def _stack_sql(src: str, cols, cast: str, extra: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT {extra}'{c}' AS column_name, CAST({c} AS {cast}) AS value FROM {src}" for c in cols)


_NUMERIC_DRIFT_COLS = mon.NUMERIC


_NUM_SQL = f"""
    ns AS (SELECT column_name, value, 1 AS r FROM ({_stack_sql("ref", _NUMERIC_DRIFT_COLS, "DOUBLE")})
          UNION ALL SELECT column_name, value, 0 AS r FROM ({_stack_sql("cur", _NUMERIC_DRIFT_COLS, "DOUBLE")})),
    nv_ AS (SELECT column_name, value, sum(r) AS nr, sum(1 - r) AS nc FROM ns
          WHERE value IS NOT NULL AND NOT isnan(value) GROUP BY ALL),
    nc_ AS (SELECT *, sum(nr) OVER w AS cr, sum(nc) OVER w AS cc,
                 sum(nr) OVER (PARTITION BY column_name) AS tr, sum(nc) OVER (PARTITION BY column_name) AS tc,
                 lead(value) OVER (PARTITION BY column_name ORDER BY value) AS nv
          FROM nv_ WINDOW w AS (PARTITION BY column_name ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
    nwd AS (SELECT column_name, coalesce(sum(CASE WHEN nv IS NOT NULL THEN abs(cr / tr - cc / tc) * (nv - value) END), 0) AS w,
                  max(tr) AS tr, max(tc) AS tc FROM nc_ GROUP BY column_name),
    nsd AS (SELECT column_name, stddev_pop(value) AS sd FROM ns WHERE r = 1 AND value IS NOT NULL AND NOT isnan(value)
           GROUP BY column_name),
    nsc AS (SELECT column_name, w / greatest(sd, {drift.STD_FLOOR}) AS score FROM nwd JOIN nsd USING (column_name)
           WHERE tr > 0 AND tc > 0)
"""


@register("numeric_drift_wasserstein", sql=f"""
    WITH {_SPLIT_SQL}, {_NUM_SQL}
    SELECT column_name, 'wasserstein_normed' AS stattest, {R("score")} AS drift_score,
           {drift.DRIFT_THRESHOLD} AS threshold, score >= {drift.DRIFT_THRESHOLD} AS drift_detected FROM nsc
""")
def numeric_drift_wasserstein(spark, sf_dir):
    d = mon.monitoring_cube(spark, sf_dir).overall_drift(categorical=False)
    return d.withColumn("drift_score", rnd("drift_score"))


_CAT_SQL = f"""
    s AS (SELECT column_name, value, 1 AS r FROM ({_stack_sql("ref", mon.CATEGORICAL_FEATURES, "VARCHAR")})
          UNION ALL SELECT column_name, value, 0 AS r FROM ({_stack_sql("cur", mon.CATEGORICAL_FEATURES, "VARCHAR")})),
    v AS (SELECT column_name, value, sum(r) AS nr, sum(1 - r) AS nc FROM s WHERE value IS NOT NULL GROUP BY ALL),
    t AS (SELECT column_name, sum(nr) AS tr, sum(nc) AS tc FROM v GROUP BY column_name),
    j AS (SELECT column_name, nr / tr AS p, nc / tc AS q FROM v JOIN t USING (column_name)),
    sc AS (SELECT column_name, sqrt(greatest(sum(
              (CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2)) ELSE 0 END)
            + (CASE WHEN q > 0 THEN q * ln(q / ((p + q) / 2)) ELSE 0 END)) / 2, 0)) AS score
           FROM j GROUP BY column_name)
"""


@register("categorical_drift_js", sql=f"""
    WITH {_SPLIT_SQL}, {_CAT_SQL}
    SELECT column_name, 'jensen_shannon' AS stattest, {R("score")} AS drift_score,
           {drift.DRIFT_THRESHOLD} AS threshold, score >= {drift.DRIFT_THRESHOLD} AS drift_detected FROM sc
""")
def categorical_drift_js(spark, sf_dir):
    d = mon.monitoring_cube(spark, sf_dir).overall_drift(numeric=False)
    return d.withColumn("drift_score", rnd("drift_score"))


@register("drift_share", sql=f"""
    WITH {_SPLIT_SQL}, {_CAT_SQL}, {_NUM_SQL}, both_kinds AS (SELECT score FROM sc UNION ALL SELECT score FROM nsc)
    SELECT count(*) AS n_columns, count(*) FILTER (WHERE score >= {drift.DRIFT_THRESHOLD}) AS n_drifted_columns,
           {R(f"count(*) FILTER (WHERE score >= {drift.DRIFT_THRESHOLD}) / count(*)")} AS share_of_drifted_columns,
           count(*) FILTER (WHERE score >= {drift.DRIFT_THRESHOLD}) / count(*) >= {drift.DATASET_DRIFT_SHARE} AS dataset_drift
    FROM both_kinds
""")
def drift_share(spark, sf_dir):
    t = mon.monitoring_cube(spark, sf_dir).overall_drift()
    return drift.drift_share(t).withColumn("share_of_drifted_columns", rnd("share_of_drifted_columns"))


_DAY_JS_SQL = f"""
    rs AS (SELECT * FROM ({_stack_sql("ref", mon.CATEGORICAL_FEATURES, "VARCHAR")}) WHERE value IS NOT NULL),
    rc AS (SELECT column_name, value, count(*) AS nr FROM rs GROUP BY ALL),
    rt AS (SELECT column_name, sum(nr) AS tr FROM rc GROUP BY ALL),
    cs AS (SELECT * FROM ({_stack_sql("cur", mon.CATEGORICAL_FEATURES, "VARCHAR", "CAST(start_date AS DATE) AS data_date, ")})
           WHERE value IS NOT NULL),
    cc AS (SELECT data_date, column_name, value, count(*) AS nc FROM cs GROUP BY ALL),
    ct AS (SELECT data_date, column_name, sum(nc) AS tc FROM cc GROUP BY ALL),
    b AS (SELECT cc.data_date, cc.column_name, rc.nr / rt.tr AS p, cc.nc / ct.tc AS q
          FROM cc JOIN rc USING (column_name, value) JOIN rt USING (column_name) JOIN ct USING (data_date, column_name)),
    sb AS (SELECT data_date, column_name, sum(p * ln(2 * p / (p + q)) + q * ln(2 * q / (p + q))) AS s_both,
                  sum(p) AS p_both, sum(q) AS q_both FROM b GROUP BY ALL),
    js AS (SELECT ct.data_date, ct.column_name,
                  sqrt(greatest((coalesce(s_both, 0) + ln(2) * ((1 - coalesce(p_both, 0)) + (1 - coalesce(q_both, 0)))) / 2, 0)) AS score
           FROM ct JOIN rt USING (column_name) LEFT JOIN sb USING (data_date, column_name))
"""


@register("daily_categorical_drift", sql=f"""
    WITH {_SPLIT_SQL}, {_DAY_JS_SQL}
    SELECT data_date, column_name, {R("score")} AS drift_score, score >= {drift.DRIFT_THRESHOLD} AS drift_detected FROM js
""")
def daily_categorical_drift(spark, sf_dir):
    d = mon.monitoring_cube(spark, sf_dir).daily_drift(numeric=False)
    return d.select("data_date", "column_name", rnd("drift_score").alias("drift_score"), "drift_detected")


# Direct integral over the merged grid of every day: each day sees all reference
# values, so this oracle costs O(days × reference values); the Spark side does not.
_DAY_W_SQL = f"""
    nrs AS (SELECT * FROM ({_stack_sql("ref", _NUMERIC_DRIFT_COLS, "DOUBLE")}) WHERE value IS NOT NULL AND NOT isnan(value)),
    nrk AS (SELECT column_name, value, count(*) AS n FROM nrs GROUP BY ALL),
    nrf AS (SELECT column_name, value, sum(n) OVER (PARTITION BY column_name ORDER BY value)
                   / sum(n) OVER (PARTITION BY column_name) AS fr FROM nrk),
    nsd AS (SELECT column_name, stddev_pop(value) AS sd FROM nrs GROUP BY ALL),
    ncs AS (SELECT * FROM ({_stack_sql("cur", _NUMERIC_DRIFT_COLS, "DOUBLE", "CAST(start_date AS DATE) AS data_date, ")})
            WHERE value IS NOT NULL AND NOT isnan(value)),
    nck AS (SELECT data_date, column_name, value, count(*) AS n FROM ncs GROUP BY ALL),
    ncf AS (SELECT data_date, column_name, value, sum(n) OVER (PARTITION BY data_date, column_name ORDER BY value)
                   / sum(n) OVER (PARTITION BY data_date, column_name) AS fc FROM nck),
    ndy AS (SELECT DISTINCT data_date, column_name FROM ncf),
    ng AS (SELECT ndy.data_date, ndy.column_name, nrf.value, nrf.fr, CAST(NULL AS DOUBLE) AS fc
           FROM ndy JOIN nrf USING (column_name)
           UNION ALL SELECT data_date, column_name, value, NULL, fc FROM ncf),
    nf AS (SELECT data_date, column_name, value,
                  coalesce(last_value(fr IGNORE NULLS) OVER w, 0) AS fr,
                  coalesce(last_value(fc IGNORE NULLS) OVER w, 0) AS fc,
                  lead(value) OVER (PARTITION BY data_date, column_name ORDER BY value) AS nv
           FROM ng WINDOW w AS (PARTITION BY data_date, column_name ORDER BY value
                                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
    nw AS (SELECT data_date, column_name, coalesce(sum(abs(fr - fc) * (nv - value)), 0) AS w FROM nf GROUP BY ALL),
    nws AS (SELECT data_date, column_name, w / greatest(sd, {drift.STD_FLOOR}) AS score FROM nw JOIN nsd USING (column_name))
"""


@register("daily_numeric_drift", sql=f"""
    WITH {_SPLIT_SQL}, {_DAY_W_SQL}
    SELECT data_date, column_name, {R("score")} AS drift_score, score >= {drift.DRIFT_THRESHOLD} AS drift_detected FROM nws
""")
def daily_numeric_drift(spark, sf_dir):
    d = mon.monitoring_cube(spark, sf_dir).daily_drift(categorical=False)
    return d.select("data_date", "column_name", rnd("drift_score").alias("drift_score"), "drift_detected")


@register("daily_drift_share", sql=f"""
    WITH {_SPLIT_SQL}, {_DAY_JS_SQL}, {_DAY_W_SQL},
    a AS (SELECT data_date, score >= {drift.DRIFT_THRESHOLD} AS d FROM js
          UNION ALL SELECT data_date, score >= {drift.DRIFT_THRESHOLD} FROM nws)
    SELECT data_date, count(*) AS n_columns, count(*) FILTER (WHERE d) AS n_drifted_columns,
           {R("count(*) FILTER (WHERE d) / count(*)")} AS share_of_drifted_columns
    FROM a GROUP BY data_date
""")
def daily_drift_share(spark, sf_dir):
    """Q3 + Q12 per day over every column: numeric (Wasserstein) and categorical (JS)."""
    d = mon.monitoring_cube(spark, sf_dir).daily_drift()
    return (d.groupBy("data_date")
             .agg(F.count(F.lit(1)).alias("n_columns"), F.count_if("drift_detected").alias("n_drifted_columns"))
             .withColumn("share_of_drifted_columns", rnd(F.col("n_drifted_columns") / F.col("n_columns"))))


# ---------------------------------------------------------------- suite

def _suite_sql(fixed: dict | None = None) -> str:
    cols = list(mon.COLUMNS)
    types = {"start_date": "ts", "price": "d", "pred": "d", "l_quantity": "d", "l_discount": "d", "l_tax": "d",
             "p_size": "i", "p_retailprice": "d", "l_returnflag": "s", "l_linestatus": "s", "p_brand": "s",
             "p_type": "s"}
    k = len(cols)
    nullcells = " + ".join(f"({c} IS NULL)::INT" for c in cols)
    mape = "100.0 * avg(CASE WHEN price <> 0 THEN abs(pred - price) / abs(price) END)"
    rmse = "sqrt(avg((pred - price) * (pred - price)))"
    missing = f"sum({nullcells}) / (count(*) * {float(k)})"
    pairs = [(i, j) for i, j in combinations(range(k), 2) if types[cols[i]] == types[cols[j]]]
    dup_terms = []
    for j in range(k):
        earlier = [f"count(*) FILTER (WHERE {cols[i]} IS DISTINCT FROM {cols[j]}) = 0" for i, jj in pairs if jj == j]
        if earlier:
            dup_terms.append("(" + " OR ".join(earlier) + ")::INT")
    d = f"""d AS (SELECT CAST(start_date AS DATE) AS data_date, count(*) AS n_rows, {mape} AS mape, {rmse} AS rmse,
              {missing} AS missing, count(*) FILTER (WHERE {nullcells} = {k}) AS empty_rows,
              {" + ".join(f"coalesce(min({c}) = max({c}), true)::INT" for c in cols)} AS constant_columns,
              {" + ".join(f"(count({c}) = 0)::INT" for c in cols)} AS empty_columns,
              {" + ".join(dup_terms) if dup_terms else "0"} AS duplicated_columns
            FROM cur GROUP BY 1)"""
    r = f"r AS (SELECT {mape} AS r_mape, {rmse} AS r_rmse, {missing} AS r_missing FROM ref)"

    def st(ok, val):
        return f"CASE WHEN {val} IS NULL THEN 'ERROR' WHEN coalesce({ok}, false) THEN 'SUCCESS' ELSE 'FAIL' END"

    def tol(x):
        return f"greatest({suite.RELATIVE} * abs({x}), {suite.ABSOLUTE})"

    tests = [
        ("mape", "eq", "r_mape", f"abs(mape - r_mape) <= {tol('r_mape')}"),
        ("rmse", "eq", "r_rmse", f"abs(rmse - r_rmse) <= {tol('r_rmse')}"),
        ("missing", "lte", "r_missing", f"missing <= r_missing + {tol('r_missing')}"),
        ("CAST(constant_columns AS DOUBLE)", "eq", "0.0", "constant_columns = 0"),
        ("CAST(empty_rows AS DOUBLE)", "eq", "0.0", "empty_rows = 0"),
        ("CAST(empty_columns AS DOUBLE)", "eq", "0.0", "empty_columns = 0"),
        ("CAST(duplicated_columns AS DOUBLE)", "eq", "0.0", "duplicated_columns = 0"),
        ("drift_share", "lt", f"{suite.MAX_DRIFT_SHARE}", f"drift_share < {suite.MAX_DRIFT_SHARE}"),
        ("CAST(n_rows AS DOUBLE)", "gt", "0.0", "n_rows > 0"),
        (f"{float(k)}", "eq", f"{float(k)}", "true"),
    ]
    for i, (cond, limit) in (fixed or {}).items():  # by test index
        tests[i] = (tests[i][0], cond, f"{limit}", f"{tests[i][0]} < {limit}")
    parts = []
    for i, (val, cond, thr, ok) in enumerate(tests):
        parts.append(f"""SELECT data_date, {i} AS test_index, '{suite.TEST_NAMES[i]}' AS test_name,
                         {st(ok, val)} AS status, CAST({val} AS DOUBLE) AS value, '{cond}' AS condition,
                         CAST({thr} AS DOUBLE) AS threshold, {str(i < suite.BASE_TESTS).lower()} AS is_base_test
                         FROM dd, r""")
    return f"""WITH {_SPLIT_SQL}, {_DAY_JS_SQL}, {_DAY_W_SQL}, {d}, {r},
        dr AS (SELECT data_date, avg(CASE WHEN score >= {drift.DRIFT_THRESHOLD} THEN 1.0 ELSE 0.0 END) AS drift_share
               FROM (SELECT data_date, score FROM js UNION ALL SELECT data_date, score FROM nws) GROUP BY data_date),
        dd AS (SELECT d.*, dr.drift_share FROM d LEFT JOIN dr USING (data_date)),
        t AS ({" UNION ALL ".join(parts)})
    """


_SUITE_WITH = _suite_sql()


@register("suite_status_by_day", sql=f"""
    {_SUITE_WITH}
    SELECT data_date, data_date + 1 AS report_date, test_index, test_name, status, {R("value")} AS value,
           condition, {R("threshold")} AS threshold, is_base_test FROM t
""")
def suite_status_by_day(spark, sf_dir):
    return round_doubles(suite.suite_of_cube(mon.monitoring_cube(spark, sf_dir)))


# The limits of the suite that does not take them from the reference.
_FIXED_LIMITS = {"mape": ("lt", 16.0), "rmse": ("lt", 5.1e5), "missing": ("lt", 0.0155), "drift_share": ("lt", 0.7)}
_FIXED_DAY = "2000-03-02"


@register("base_failures_on_day", sql=f"""
    {_suite_sql({0: ("lt", 16.0), 1: ("lt", 5.1e5), 2: ("lt", 0.0155), 7: ("lt", 0.7)})}
    SELECT data_date + 1 AS report_date, test_index, test_name, status,
           test_name || ' is ' || coalesce(printf('%.3f', value), 'not known') || '; the condition is ' || condition || ' ' || printf('%.3f', threshold) || '.' AS description,
           '{{"condition":"' || condition || '","threshold":"' || printf('%.3f', threshold) || '"}}' AS parameters, count(*) OVER () AS n_failed
    FROM t WHERE status IN ('FAIL', 'ERROR') AND is_base_test AND data_date + 1 = DATE '{_FIXED_DAY}'
""")
def base_failures_on_day(spark, sf_dir):
    """Q8 with given limits, then the base failures of one report date."""
    s = suite.suite_of_cube(mon.monitoring_cube(spark, sf_dir), checks=_FIXED_LIMITS)
    return suite.failures_on_day(s, _FIXED_DAY)


@register("failed_checks_rollup", sql=f"""
    {_SUITE_WITH},
    g AS (SELECT test_name, count(*) AS n_failures FROM t WHERE status IN ('FAIL', 'ERROR') GROUP BY test_name)
    SELECT test_name, n_failures, CAST(row_number() OVER (ORDER BY n_failures DESC, test_name) AS INTEGER) AS failure_rank FROM g
""")
def failed_checks_rollup(spark, sf_dir):
    s = suite.suite_of_cube(mon.monitoring_cube(spark, sf_dir))
    return suite.failures_by_test(s)


@register("failures_by_day", sql=f"""
    {_SUITE_WITH}
    SELECT data_date + 1 AS window_start, count(*) AS n_failed FROM t WHERE status IN ('FAIL', 'ERROR') GROUP BY 1
""")
def failures_by_day(spark, sf_dir):
    s = suite.suite_of_cube(mon.monitoring_cube(spark, sf_dir))
    return suite.failures_by_day(s)


# ---------------------------------------------------------------- other monitoring views

@register("error_by_length", sql=f"""
    SELECT CAST(length(p.p_name) AS INTEGER) AS name_length, count(*) AS n_rows,
           {R("avg(abs(l.l_quantity * p.p_retailprice - l.l_extendedprice))")} AS mean_abs_error
    FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey GROUP BY 1
""")
def error_by_length(spark, sf_dir):
    from vigil.tables import table
    li, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    j = li.join(part, li.l_partkey == part.p_partkey).select(
        F.length("p_name").alias("name_length"), F.col("l_extendedprice").alias("y"),
        (F.col("l_quantity") * F.col("p_retailprice")).alias("p"))
    return round_doubles(metrics.error_by_group(j, "name_length", "y", "p", name="name_length"))


@register("split_summary", sql=f"""
    WITH {_SPLIT_SQL}
    SELECT 'reference' AS part, count(*) AS n_rows, min(start_date) AS min_start, max(start_date) AS max_start FROM ref
    UNION ALL
    SELECT 'current', count(*), min(start_date), max(start_date) FROM cur
""")
def split_summary(spark, sf_dir):
    part = F.when(mon.is_reference(), "reference").otherwise("current").alias("part")
    return mon.monitoring_table(spark, sf_dir).groupBy(part).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min(mon.TIMESTAMP).alias("min_start"), F.max(mon.TIMESTAMP).alias("max_start"))


def _describe_sql(src: str, numeric, categorical) -> str:
    row = "SELECT '{c}' AS column_name, '{stat}' AS stat, {v} AS value, {t} AS text FROM {src}"
    none = "CAST(NULL AS VARCHAR)"
    parts = []
    for c in numeric:
        x = f"CAST({c} AS DOUBLE)"
        stats = {"count": f"CAST(count({c}) AS DOUBLE)", "mean": R(f"avg({x})"), "std": R(f"stddev_samp({x})"), "min": R(f"min({x})"), "max": R(f"max({x})"),
                 **{k: R(f"quantile_cont({x}, {p})") for k, p in profile.QUARTILES.items()}}
        parts += [row.format(c=c, stat=k, v=v, t=none, src=src) for k, v in stats.items()]
    for c in categorical:
        top = f"(SELECT {c} FROM {src} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"
        freq = f"(SELECT CAST(count(*) AS DOUBLE) FROM {src} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY 1 DESC LIMIT 1)"
        parts += [row.format(c=c, stat=k, v=v, t=t, src=src) for k, v, t in (
            ("count", f"CAST(count({c}) AS DOUBLE)", none), ("unique", f"CAST(count(DISTINCT {c}) AS DOUBLE)", none), ("top", "CAST(NULL AS DOUBLE)", f"any_value({top})"), ("freq", f"any_value({freq})", none))]
    return " UNION ALL ".join(parts)


@register("monitoring_describe", sql=f"""
    WITH m AS MATERIALIZED ({mon.MONITORING_SQL})
    {_describe_sql("m", mon.NUMERIC, mon.CATEGORICAL_FEATURES)}
""")
def monitoring_describe(spark, sf_dir):
    """Count, mean, std, ends and exact quartiles of numbers; count, unique, top and freq of texts."""
    m = cut_lineage(mon.monitoring_table(spark, sf_dir))  # read by several passes
    return profile.describe(m, list(mon.NUMERIC), list(mon.CATEGORICAL_FEATURES)).withColumn("value", rnd("value"))


def _profile_sql(src: str, numeric, texts, times) -> str:
    row = "SELECT '{c}' AS column_name, '{stat}' AS stat, {v} AS value, {t} AS text FROM {src}"
    none, null = "CAST(NULL AS VARCHAR)", "CAST(NULL AS DOUBLE)"
    parts = []
    for c in [*numeric, *texts, *times]:
        x = f"CAST({c} AS DOUBLE)" if c in numeric else f"CAST({c} AS VARCHAR)"
        best = f"FROM {src} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {x} LIMIT 1"
        stats = [("count", f"CAST(count({c}) AS DOUBLE)", none), ("missing", f"CAST(count(*) - count({c}) AS DOUBLE)", none), ("missing_share", R(f"(count(*) - count({c})) / count(*)"), none),
                 ("unique", f"CAST(count(DISTINCT {c}) AS DOUBLE)", none), ("most_common_share", R(f"any_value((SELECT count(*) {best})) / count(*)"), none),
                 ("most_common", R(f"any_value((SELECT {x} {best}))") if c in numeric else null, none if c in numeric else f"any_value((SELECT {x} {best}))")]
        if c in numeric:
            stats += [("mean", R(f"avg({x})"), none), ("std", R(f"stddev_samp({x})"), none), ("min", R(f"min({x})"), none), ("max", R(f"max({x})"), none)]
            stats += [(k, R(f"quantile_cont({x}, {p})"), none) for k, p in profile.QUARTILES.items()]
        if c in times:
            stats += [("first", null, f"CAST(min({c}) AS VARCHAR)"), ("last", null, f"CAST(max({c}) AS VARCHAR)")]
        parts += [row.format(c=c, stat=k, v=v, t=t, src=src) for k, v, t in stats]
    return " UNION ALL ".join(parts)


@register("column_profile", sql=f"""
    WITH m AS MATERIALIZED ({mon.MONITORING_SQL})
    {_profile_sql("m", mon.NUMERIC, mon.CATEGORICAL_FEATURES, [mon.TIMESTAMP])}
""")
def column_profile(spark, sf_dir):
    """Q2: the data-quality profile of every column of the monitoring table."""
    return profile.column_profile(cut_lineage(mon.monitoring_table(spark, sf_dir))).withColumn("value", rnd("value"))
