"""Table profiles: raw diagnostics, per-column checks, missing-cell share, describe.

Each profile is one or two aggregates with map-side partial aggregation; the
only shuffle is the one that counts exact duplicate rows (group by all columns),
where identical copies collapse before they leave their task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.functions.parse import numeric_or_null
from vigil.functions.text import strip_ws
from vigil.operators.digest import column_digests, column_hashes, first_equal
from vigil.operators.orderstats import most_frequent, quantiles, value_counts


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def _is_blank(c: str, dtype) -> Column:
    if isinstance(dtype, T.StringType):
        return _q(c).isNull() | (strip_ws(_q(c)) == "")
    return _q(c).isNull()


def raw_profile(df: DataFrame, text: str | None = None, target: str | None = None) -> DataFrame:
    """One-row diagnostics of an untrusted table (nulls where not computable).

    n_rows, n_duplicate_rows (rows − distinct rows, nulls equal), n_missing_rows
    (any null), n_empty_rows (all null or blank), n_missing_columns,
    n_empty_columns, duplicate_columns, text length min/max/mean (raw text),
    target min/max/distinct count and positive share over finite numeric values.
    """
    fields = df.schema.fields
    cols = [f.name for f in fields]
    any_null = F.lit(False)
    all_empty = F.lit(True)
    for f in fields:
        any_null = any_null | _q(f.name).isNull()
        all_empty = all_empty & _is_blank(f.name, f.dataType)
    aggs = [
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(any_null).alias("n_missing_rows"),
        F.count_if(all_empty).alias("n_empty_rows"),
    ]
    for i, f in enumerate(fields):
        aggs.append(F.max(_q(f.name).isNull()).alias(f"_miss{i}"))
        aggs.append(F.min(_is_blank(f.name, f.dataType)).alias(f"_empty{i}"))
    if text is not None:
        ln = F.length(_q(text).cast("string"))
        aggs += [F.min(ln).alias("text_min_length"), F.max(ln).alias("text_max_length"),
                 F.try_divide(F.sum(ln), F.count(ln)).alias("text_mean_length")]
    if target is not None:
        num = numeric_or_null(_q(target))
        fin = F.when(~F.isnan(num) & (F.abs(num) != F.lit(float("inf"))), num)
        aggs += [F.min(fin).alias("target_min"), F.max(fin).alias("target_max"),
                 F.try_divide(F.count_if(fin > 0), F.count(fin)).alias("positive_target_share")]
    # a row's digest stands for the row, and a null for itself, so no text is shuffled
    parts = [F.when(_q(c).isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), F.sha2(_q(c).cast("string").cast("binary"), 256))) for c in cols]
    counts = df.select(F.sha2(F.concat(*parts), 256).alias("_d")).distinct().agg(F.count(F.lit(1)).alias("_n_distinct"))
    # three one-row results side by side
    results = [df.agg(*aggs), counts]
    if target is not None:
        results.append(distinct_values(df, target).agg(F.count(F.lit(1)).alias("target_n_unique")))
    rows = results[0]
    for r in results[1:]:
        rows = rows.unionByName(r, allowMissingColumns=True)
    prof = rows.agg(*[F.first(c, ignorenulls=True).alias(c) for c in rows.columns])
    prof = prof.withColumn("n_duplicate_rows", F.col("n_rows") - F.col("_n_distinct"))
    names = ["n_rows", "n_duplicate_rows", "n_missing_rows", "n_empty_rows", "text_min_length", "text_max_length", "text_mean_length",
             "target_min", "target_max", "target_n_unique", "positive_target_share"]
    prof = prof.select(*[c for c in names if c in prof.columns], *[c for c in prof.columns if c.startswith("_")])
    miss = [F.coalesce(F.col(f"_miss{i}"), F.lit(False)).cast("int") for i in range(len(fields))]
    empt = [F.coalesce(F.col(f"_empty{i}"), F.lit(True)).cast("int") for i in range(len(fields))]
    seen, dups = set(), []
    for c in cols:
        if c in seen:
            dups.append(c)
        seen.add(c)
    keep = [c for c in prof.columns if not c.startswith("_")]
    return prof.select(
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) if c in ("n_rows", "n_duplicate_rows") else F.col(c) for c in keep[:4]],
        sum(miss[1:], miss[0]).cast("long").alias("n_missing_columns") if miss else F.lit(0).alias("n_missing_columns"),
        sum(empt[1:], empt[0]).cast("long").alias("n_empty_columns") if empt else F.lit(0).alias("n_empty_columns"),
        F.array(*[F.lit(c) for c in dups]).cast("array<string>").alias("duplicate_columns"),
        *keep[4:],
    )


def distinct_values(df: DataFrame, column: str, numeric: bool = True) -> DataFrame:
    """Sorted-distinct set of a column as rows (finite numeric values when ``numeric``)."""
    v = numeric_or_null(_q(column)) if numeric else _q(column)
    if numeric:
        v = F.when(~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))), v)
    return df.select(v.alias("value")).filter(F.col("value").isNotNull()).distinct()


def missing_share(df: DataFrame) -> DataFrame:
    """Share of null cells over rows × columns (one row)."""
    cols = df.columns
    nulls = sum((_q(c).isNull().cast("long") for c in cols[1:]), _q(cols[0]).isNull().cast("long"))
    return (df.agg(F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum(nulls), F.lit(0)).alias("n_missing_cells"))
              .select("n_rows", F.lit(len(cols)).cast("long").alias("n_columns"), "n_missing_cells",
                      (F.col("n_missing_cells") / (F.col("n_rows") * F.lit(len(cols)))).alias("missing_share")))


def column_checks(df: DataFrame) -> DataFrame:
    """Per column: n_missing, is_empty (all null), is_constant (≤ 1 distinct non-null value),
    duplicate_of (first earlier column with identical content, null-safe, same type).

    One pass, linear in the columns: null counts, the least and greatest hash and an order-free digest per column
    (``digest``), then an unpivot of the single result row. No text leaves its task.
    """
    fields = df.schema.fields
    row = column_hashes(df, [f.name for f in fields]).agg(F.count(F.lit(1)).alias("_rows"), *column_digests(len(fields)))
    same = first_equal(fields)
    structs = []
    for j, f in enumerate(fields):
        name_of = F.coalesce(*[F.when(same[j] == i, F.lit(fields[i].name)) for i in range(j)]) if j else F.lit(None).cast("string")
        structs.append(F.struct(
            F.lit(j).alias("column_index"), F.lit(f.name).alias("column_name"), (F.col("_rows") - F.col(f"values{j}")).alias("n_missing"),
            (F.col(f"values{j}") == 0).alias("is_empty"), F.coalesce(F.col(f"least{j}") == F.col(f"most{j}"), F.lit(True)).alias("is_constant"), name_of.alias("duplicate_of")))
    return row.select(F.explode(F.array(*structs)).alias("c")).select("c.*")


def dataset_checks(df: DataFrame) -> DataFrame:
    """One row: rows, columns, empty rows, empty / constant / duplicated columns, missing share."""
    cc = column_checks(df)
    per_col = cc.agg(F.count_if("is_empty").alias("n_empty_columns"),
                     F.count_if("is_constant").alias("n_constant_columns"),
                     F.count_if(F.col("duplicate_of").isNotNull()).alias("n_duplicated_columns"))
    return per_col


QUARTILES = {"25%": 0.25, "50%": 0.5, "75%": 0.75}


def _long(rows: DataFrame, stats: dict[str, tuple[Column | None, Column | None]]) -> DataFrame:
    """One row per statistic (name: number or None, text or None) of each row of ``rows`` (column_name, ...)."""
    none = (F.lit(None).cast("double"), F.lit(None).cast("string"))
    cells = F.array(*[F.struct(F.lit(k).alias("stat"), (none[0] if v is None else v.cast("double")).alias("value"), (none[1] if t is None else t.cast("string")).alias("text"))
                      for k, (v, t) in stats.items()])
    return rows.select("column_name", F.inline(cells))


def _moments(df: DataFrame, columns: list[str]) -> DataFrame:
    """column_name, n_rows, count, mean, std, min, max of numeric columns (nulls and NaN are no values), in one aggregate of one row."""
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(columns):
        v = F.nanvl(_q(c).cast("double"), F.lit(None).cast("double"))
        aggs += [F.count(v).alias(f"c{i}"), F.avg(v).alias(f"m{i}"), F.stddev_samp(v).alias(f"s{i}"), F.min(v).alias(f"l{i}"), F.max(v).alias(f"h{i}")]
    return df.agg(*aggs).select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col("n").alias("n_rows"), F.col(f"c{i}").alias("count"), F.col(f"m{i}").alias("mean"),
                                                            F.col(f"s{i}").alias("std"), F.col(f"l{i}").alias("min"), F.col(f"h{i}").alias("max")) for i, c in enumerate(columns)])))


def _counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """column_name, n_rows, count of any columns."""
    row = df.agg(F.count(F.lit(1)).alias("n"), *[F.count(_q(c)).alias(f"c{i}") for i, c in enumerate(columns)])
    return row.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col("n").alias("n_rows"), F.col(f"c{i}").alias("count")) for i, c in enumerate(columns)])))


def _quartile_rows(df: DataFrame, numeric: list[str]) -> DataFrame:
    names = F.coalesce(*[F.when(F.col("prob") == p, F.lit(k)) for k, p in QUARTILES.items()])
    return quantiles(df, numeric, list(QUARTILES.values())).select("column_name", names.alias("stat"), "value", F.lit(None).cast("string").alias("text"))


def describe(df: DataFrame, numeric: list[str], categorical: list[str]) -> DataFrame:
    """Long-form describe (column_name, stat, value, text). Numeric: count, mean, std, min, exact quartiles, max; other: count, unique, top (as text), freq."""
    parts = []
    if numeric:
        c = F.col
        parts += [_long(_moments(df, numeric), {"count": (c("count"), None), "mean": (c("mean"), None), "std": (c("std"), None), "min": (c("min"), None), "max": (c("max"), None)}),
                  _quartile_rows(df, numeric)]
    if categorical:
        tops = _counts(df, categorical).join(most_frequent(value_counts(df, categorical)), "column_name", "left")
        parts.append(_long(tops, {"count": (F.col("count"), None), "unique": (F.coalesce("n_unique", F.lit(0)), None), "top": (None, F.col("top")), "freq": (F.col("freq"), None)}))
    return reduce(DataFrame.unionByName, parts)


def column_profile(df: DataFrame) -> DataFrame:
    """Data-quality profile (column_name, stat, value, text) of every column by its type: count, missing, missing_share, unique, most_common and its share for all;
    mean, std, min, exact quartiles and max for numbers; first and last for dates and timestamps (as text)."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    numeric = [n for n, t in kinds.items() if isinstance(t, T.NumericType)]
    others = [n for n in kinds if n not in numeric]
    times = [n for n in others if isinstance(kinds[n], (T.DateType, T.TimestampType, T.TimestampNTZType))]
    c, share = F.col, lambda n: F.try_divide(n, F.col("n_rows"))

    def common(numbers: bool) -> dict:
        top = F.col("top")
        return {"count": (c("count"), None), "missing": (c("n_rows") - c("count"), None), "missing_share": (share(c("n_rows") - c("count")), None),
                "unique": (F.coalesce("n_unique", F.lit(0)), None), "most_common": (top, None) if numbers else (None, top), "most_common_share": (share(c("freq")), None)}

    parts = []
    if numeric:
        rows = _moments(df, numeric).join(most_frequent(value_counts(df, numeric, "double")), "column_name", "left")
        parts += [_long(rows, {**common(True), "mean": (c("mean"), None), "std": (c("std"), None), "min": (c("min"), None), "max": (c("max"), None)}), _quartile_rows(df, numeric)]
    if others:
        rows = _counts(df, others).join(most_frequent(value_counts(df, others)), "column_name", "left")
        parts.append(_long(rows, common(False)))
    if times:
        ends = df.agg(*[f(_q(n)).cast("string").alias(f"{k}{i}") for i, n in enumerate(times) for k, f in (("a", F.min), ("z", F.max))])
        rows = ends.select(F.inline(F.array(*[F.struct(F.lit(n).alias("column_name"), c(f"a{i}").alias("a"), c(f"z{i}").alias("z")) for i, n in enumerate(times)])))
        parts.append(_long(rows, {"first": (None, c("a")), "last": (None, c("z"))}))
    return reduce(DataFrame.unionByName, parts)


# The basic data tests run after validation (name, condition, expected).
BASIC_TESTS = (
    ("Number of Rows", "gt", 0.0),
    ("Share of Missing Values", "eq", 0.0),
    ("Number of Empty Rows", "eq", 0.0),
    ("Number of Empty Columns", "eq", 0.0),
    ("Number of Duplicated Columns", "eq", 0.0),
)


def basic_data_tests(df: DataFrame) -> DataFrame:
    """Non-blocking data tests: rows (test_index, test_name, value, condition, expected, status)
    with status SUCCESS / FAIL; two aggregates (missing cells, per-column checks) over the table."""
    cols = df.columns
    nulls = sum((_q(c).isNull().cast("long") for c in cols[1:]), _q(cols[0]).isNull().cast("long"))
    row = df.agg(F.count(F.lit(1)).cast("double").alias("n"),
                 F.coalesce(F.sum(nulls), F.lit(0)).cast("double").alias("cells"),
                 F.count_if(nulls == len(cols)).cast("double").alias("empty_rows"))
    cc = column_checks(df).agg(F.count_if("is_empty").cast("double").alias("empty_cols"),
                               F.count_if(F.col("duplicate_of").isNotNull()).cast("double").alias("dup_cols"))
    c = F.col
    # two one-row results side by side, as one row
    both = row.unionByName(cc, allowMissingColumns=True).agg(*[F.first(x, ignorenulls=True).alias(x) for x in ("n", "cells", "empty_rows", "empty_cols", "dup_cols")])
    values = [c("n"), F.try_divide(c("cells"), c("n") * len(cols)), c("empty_rows"), c("empty_cols"), c("dup_cols")]
    tests = []
    for i, ((name, condition, expected), v) in enumerate(zip(BASIC_TESTS, values)):
        ok = v > expected if condition == "gt" else v == expected
        tests.append(F.struct(F.lit(i).alias("test_index"), F.lit(name).alias("test_name"), v.cast("double").alias("value"), F.lit(condition).alias("condition"),
                              F.lit(expected).alias("expected"), F.when(F.coalesce(ok, F.lit(False)), "SUCCESS").otherwise("FAIL").alias("status")))
    return both.select(F.inline(F.array(*tests)))
