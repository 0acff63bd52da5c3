"""Serving-log analyses: consistency of observed versions / instances, latest state per key,
state warnings, and worst error per verification round."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.functions.parse import none_label

NONE = "<none>"


def consistency_check(obs: DataFrame, endpoint: str, instance: str, version: str) -> DataFrame:
    """Per endpoint and over all endpoints (endpoint = null): n_observations, distinct instances
    and versions (null counted as the value ``<none>``), and the two inconsistency flags."""
    inst, ver = none_label(F.col(instance)), none_label(F.col(version))
    out = (obs.rollup(endpoint)
              .agg(F.count(F.lit(1)).alias("n_observations"),
                   F.count_distinct(inst).alias("n_instances"),
                   F.count_distinct(ver).alias("n_versions")))
    return out.withColumns({"multiple_instances": F.col("n_instances") > 1,
                            "multiple_versions": F.col("n_versions") > 1})


def latest_by_key(df: DataFrame, key: str, order: list[str], values: list[str]) -> DataFrame:
    """Latest row per key (largest ``order`` tuple), as one partial aggregate.

    ``max_by`` over a struct merges map-side, so a key that owns a third of
    the rows costs one small buffer per task rather than one sorted partition.
    """
    best = F.max_by(F.struct(*[F.col(v) for v in values]), F.struct(*[F.col(o) for o in order]))
    return df.groupBy(key).agg(best.alias("_s"), F.count(F.lit(1)).alias("n_rows")).select(key, "_s.*", "n_rows")


def state_warnings(state: DataFrame, instance: str = "instance_id", expected_version: str | None = None) -> DataFrame:
    """Per state row: array of warnings (not loaded, reload not successful, unexpected version).

    Fixed values: the message texts, with strings in single quotes and None, True and False without.
    """
    def shown(c: str) -> Column:
        quoted = F.concat(F.lit("'"), F.col(c).cast("string"), F.lit("'"))
        word = F.when(F.col(c).cast("string") == "true", "True").otherwise("False") if dict(state.dtypes)[c] == "boolean" else quoted
        return F.coalesce(F.when(F.col(c).isNotNull(), word), F.lit("None"))

    about = F.concat(F.lit("Serving state diagnostic for instance '"), F.coalesce(F.col(instance).cast("string"), F.lit("None")), F.lit("' "))
    msgs = [
        F.when(~F.coalesce(F.col("model_loaded"), F.lit(False)), F.concat(about, F.lit("reports model_loaded="), shown("model_loaded"), F.lit("."))),
        F.when(~F.coalesce(F.col("last_reload_status") == "success", F.lit(False)),
               F.concat(about, F.lit("reports last_reload_status="), shown("last_reload_status"), F.lit("."))),
    ]
    if expected_version is not None:
        msgs.append(F.when(~F.coalesce(F.col("loaded_version") == expected_version, F.lit(False)),
                           F.concat(about, F.lit("loaded unexpected model version: "), shown("loaded_version"), F.lit(f" != '{expected_version}'."))))
    return state.withColumn("warnings", F.filter(F.array(*msgs), lambda x: x.isNotNull()))


def worst_error_by_round(df: DataFrame, round_col: str, expected: str, got: str,
                         tolerance: float = 0.05) -> DataFrame:
    e = F.abs(F.col(got) - F.col(expected))
    return (df.groupBy(round_col)
              .agg(F.count(F.lit(1)).alias("n_rows"), F.max(e).alias("max_abs_error"))
              .withColumn("within_tolerance", F.col("max_abs_error") <= tolerance))


def first_seen_order(df: DataFrame, key: str, order: str) -> DataFrame:
    """De-duplicate ``key`` keeping its first appearance in ``order`` (ordered de-duplication)."""
    return df.groupBy(key).agg(F.min(order).alias(order))
