"""Daily test suite: per-day metrics checked against reference-derived or fixed conditions.

Both sides yield one row of sums per day, from a single grouped aggregate; the
reference's rows add up to a handful of numbers (collected); the checks are
column expressions on the per-day row and are then unpivoted to one row per
(day, test).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.operators.cube import Cube, day_facts, merged_facts
from vigil.operators.digest import first_equal
from vigil.operators.drift import categorical_drift_by_day, numeric_drift_by_day, numeric_drift_by_day_sided

# Relative tolerance of reference-derived conditions and the absolute floor.
RELATIVE = 0.1
ABSOLUTE = 1e-12
# Test names in suite order; the first BASE_TESTS are the base tests.
TEST_NAMES = (
    "Mean Absolute Percentage Error (MAPE)",
    "Root Mean Square Error (RMSE)",
    "Share of Missing Values",
    "Number of Constant Columns",
    "Number of Empty Rows",
    "Number of Empty Columns",
    "Number of Duplicated Columns",
    "Share of Drifted Columns",
    "Number of Rows",
    "Number of Columns",
)
BASE_TESTS = 8
MAX_DRIFT_SHARE = 0.3
#: Conditions of the suite, by test in the order of TEST_NAMES: an operator (eq, lt, lte, gt, gte) and a number, or
#: "reference" for the reference table's own value with the relative tolerance above.
CHECKS = {
    "mape": ("eq", "reference"), "rmse": ("eq", "reference"), "missing": ("lte", "reference"), "constant_columns": ("eq", 0.0), "empty_rows": ("eq", 0.0),
    "empty_columns": ("eq", 0.0), "duplicated_columns": ("eq", 0.0), "drift_share": ("lt", MAX_DRIFT_SHARE), "n_rows": ("gt", 0.0), "n_columns": ("eq", "reference"),
}
FAILED = ("FAIL", "ERROR")


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def _tol(r: float) -> float:
    return max(RELATIVE * abs(r), ABSOLUTE)


def _status(ok: Column, value: Column) -> Column:
    return F.when(value.isNull(), F.lit("ERROR")).when(ok, F.lit("SUCCESS")).otherwise(F.lit("FAIL"))


def _holds(value: Column, op: str, bound: float | None, slack: float) -> Column:
    if bound is None:
        return F.lit(None).cast("boolean")
    tests = {"eq": lambda: F.abs(value - bound) <= slack, "lt": lambda: value < bound + slack, "lte": lambda: value <= bound + slack,
             "gt": lambda: value > bound - slack, "gte": lambda: value >= bound - slack}
    return tests[op]()


def daily_suite(ref: DataFrame, cur: DataFrame, ts: str, target: str, prediction: str,
                categorical, numeric=(), source=None, checks: dict | None = None) -> DataFrame:
    """One row per (data_date, test): data_date, report_date, test_index, test_name, status,
    value, condition, threshold, is_base_test.

    The share of drifted columns covers ``categorical`` (Jensen-Shannon) and
    ``numeric`` (normed Wasserstein) columns, each day against the whole reference.
    ``source`` = (table, is_reference column) names the one table both sides come
    from, so it is read in one pass instead of one per side. ``checks`` replaces conditions of CHECKS.
    ``suite_of_cube`` gives the same from a kept count cube."""
    sided = (source[0].withColumn("_ref", F.coalesce(source[1], F.lit(True))) if source is not None
             else ref.withColumn("_ref", F.lit(True)).unionByName(cur.withColumn("_ref", F.lit(False))))
    facts = day_facts(sided.withColumn("_day", F.to_date(_q(ts))), cur.schema.fields, target, prediction)
    per_column = []
    if categorical:
        per_column.append(categorical_drift_by_day(ref, cur, categorical, ts).select("data_date", "drift_detected"))
    if numeric:
        nd = (numeric_drift_by_day_sided(source[0], source[1], numeric, ts) if source is not None
              else numeric_drift_by_day(ref, cur, numeric, ts))
        per_column.append(nd.select("data_date", "drift_detected"))
    flags = reduce(DataFrame.unionByName, per_column) if per_column else None
    return _suite(facts, flags, cur.schema.fields, len(ref.columns), checks)


def suite_of_cube(cube: Cube, checks: dict | None = None) -> DataFrame:
    """``daily_suite`` from a count cube: the monitored table itself is not read."""
    return _suite(cube.facts(), cube.daily_drift().select("data_date", "drift_detected"), cube.schema.fields, len(cube.schema.fields), checks)


def _suite(facts: DataFrame, flags: DataFrame | None, fields, n_reference_columns: int, checks: dict | None) -> DataFrame:
    columns = [f.name for f in fields]
    mape = F.lit(100.0) * F.try_divide(F.col("shares"), F.col("n_shares"))
    rmse = F.sqrt(F.try_divide(F.col("squares"), F.col("n_squares")))
    missing = F.try_divide(F.col("null_cells"), F.col("n_rows") * len(columns))
    ref_row = merged_facts(facts.filter("is_reference"), []).select(mape.alias("mape"), rmse.alias("rmse"), missing.alias("missing")).first()  # three numbers
    r_mape, r_rmse, r_missing = (ref_row["mape"], ref_row["rmse"], ref_row["missing"])
    const = sum((F.coalesce(F.col(f"least{i}") == F.col(f"most{i}"), F.lit(True)).cast("int") for i in range(len(columns))), F.lit(0))
    empty = sum(((F.col(f"values{i}") == 0).cast("int") for i in range(len(columns))), F.lit(0))
    dups = sum((c.isNotNull().cast("int") for c in first_equal(fields)), F.lit(0))
    day = merged_facts(facts.filter("NOT is_reference"), ["data_date"]).select(
        "data_date", "n_rows", mape.alias("mape"), rmse.alias("rmse"), missing.alias("missing"), "empty_rows",
        const.alias("constant_columns"), empty.alias("empty_columns"), dups.alias("duplicated_columns"))
    if flags is not None:
        drift = flags.groupBy("data_date").agg(F.avg(F.col("drift_detected").cast("double")).alias("drift_share"))
        day = day.join(drift, "data_date", "left")
    else:
        day = day.withColumn("drift_share", F.lit(None).cast("double"))

    of_reference = {"mape": r_mape, "rmse": r_rmse, "missing": r_missing, "n_columns": n_reference_columns}
    day = day.withColumn("n_columns", F.lit(len(columns)))
    tests = []
    for name, (op, limit) in {**CHECKS, **(checks or {})}.items():
        value = F.col(name).cast("double")
        bound = of_reference.get(name) if limit == "reference" else limit
        slack = _tol(bound) if limit == "reference" and name != "n_columns" and bound is not None else 0.0
        tests.append((value, op, F.lit(None if bound is None else float(bound)).cast("double"), _holds(value, op, bound, slack)))
    structs = [F.struct(F.lit(i).alias("test_index"), F.lit(TEST_NAMES[i]).alias("test_name"),
                        _status(F.coalesce(ok, F.lit(False)), val).alias("status"),
                        val.alias("value"), F.lit(cond).alias("condition"), thr.alias("threshold"),
                        F.lit(i < BASE_TESTS).alias("is_base_test"))
               for i, (val, cond, thr, ok) in enumerate(tests)]
    return (day.select("data_date", F.explode(F.array(*structs)).alias("t"))
               .select("data_date", F.date_add("data_date", 1).alias("report_date"), "t.*"))


def failed_tests(suite: DataFrame, base_only: bool = False) -> DataFrame:
    out = suite.filter(F.col("status").isin(*FAILED))
    return out.filter("is_base_test") if base_only else out


def failures_on_day(suite: DataFrame, day: str, base_only: bool = True) -> DataFrame:
    """The failed (base) tests of one report date, each with its number among them and the day's total, a text of what
    failed, and the condition's parameters as JSON."""
    from pyspark.sql import Window
    out = failed_tests(suite, base_only).filter(F.col("report_date") == F.lit(day).cast("date"))
    text = F.concat("test_name", F.lit(" is "), F.coalesce(F.format_string("%.3f", "value"), F.lit("not known")), F.lit("; the condition is "), "condition",
                    F.lit(" "), F.coalesce(F.format_string("%.3f", "threshold"), F.lit("not known")), F.lit("."))
    # at most a row for each test: the windows run over that many rows
    return out.select("report_date", "test_index", "test_name", "status", text.alias("description"),
                      F.to_json(F.struct("condition", F.format_string("%.3f", "threshold").alias("threshold"))).alias("parameters"),
                      F.count(F.lit(1)).over(Window.partitionBy("report_date")).alias("n_failed"))


def failures_by_test(suite: DataFrame) -> DataFrame:
    """Failures per test name, most frequent first (rank 1 = most frequent; ties by name)."""
    from pyspark.sql import Window
    g = failed_tests(suite).groupBy("test_name").agg(F.count(F.lit(1)).alias("n_failures"))
    # one row per test name: the unpartitioned window runs over at most len(TEST_NAMES) rows
    return g.withColumn("failure_rank", F.row_number().over(Window.orderBy(F.desc("n_failures"), "test_name")))


def failures_by_day(suite: DataFrame) -> DataFrame:
    """Failed tests per 1-day window of the report timestamp."""
    # timestamp_ntz keeps the 1-day windows on calendar days whatever the session time zone
    w = F.window(F.col("report_date").cast("timestamp_ntz"), "1 day")
    return (failed_tests(suite).groupBy(w.alias("w"))
            .agg(F.count(F.lit(1)).alias("n_failed"))
            .select(F.to_date(F.col("w.start")).alias("window_start"), "n_failed"))
