"""Registry of named queries: a Spark builder ``(spark, sf_dir) -> DataFrame`` and,
where the semantics are SQL-expressible, the DuckDB oracle text for the same result.

Computed columns are rounded to ``DIGITS`` decimals in both forms so results
compare by value across engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DIGITS = 6

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
BENCH: list[str] = []


def register(name: str, sql: str | None = None, bench: bool = True):
    def wrap(fn):
        if name in QUERIES:
            raise KeyError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        if bench:
            BENCH.append(name)
        return fn
    return wrap


# Values whose exact decimal form ends in 5 at digit DIGITS+1 (means of cents
# over counts with factors 2 and 5) would round differently in two engines
# (half-up on the decimal form vs. multiply-and-round); a nudge of NUDGE away
# from zero moves every such tie off the boundary in both engines alike.
NUDGE = 1e-9


def rnd(c, digits: int = DIGITS) -> Column:
    x = F.col(c) if isinstance(c, str) else c
    nudged = x + F.when(x < 0, F.lit(-NUDGE)).otherwise(F.lit(NUDGE))
    return F.round(nudged, digits) + F.lit(0.0)


def sql_rnd(expr: str, digits: int = DIGITS) -> str:
    """DuckDB twin of ``rnd``."""
    return (f"(round(({expr}) + CASE WHEN ({expr}) < 0 THEN -{NUDGE} ELSE {NUDGE} END, {digits}) + 0.0)")


def round_doubles(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round every double column (names unchanged)."""
    return df.select(*[
        rnd(F.col(f.name), digits).alias(f.name) if f.dataType.typeName() in ("double", "float")
        else F.col(f.name)
        for f in df.schema.fields
    ])


def load_all() -> None:
    """Import every plan module so its queries register."""
    from vigil.plans import monitor_queries, quality_queries, text_queries, sample_queries  # noqa: F401
    from vigil.plans import serving_queries, model_queries, landing_queries  # noqa: F401
