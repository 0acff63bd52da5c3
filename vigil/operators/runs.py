"""A training run as one driver script of lazy DataFrames with few actions:
land CSV → validate (gate) → train → register (+ alias read-back) → quality gate → reports.

Step durations are kept as run-report rows (step, seconds).
"""

from __future__ import annotations

import time
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.operators import model as M
from vigil.operators import profile, rules
from vigil.session import cut_lineage
from vigil.sources.csv import read_raw_csv
from vigil.sources.registry import ModelRegistry
from vigil.sources.thresholds import load_thresholds


class StepTimer:
    def __init__(self):
        self.rows: list[tuple[str, float]] = []

    @contextmanager
    def step(self, name: str):
        t0 = time.monotonic()
        try:
            yield
        finally:
            self.rows.append((name, time.monotonic() - t0))

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows, "step string, seconds double")


def _as_map(row: DataFrame, name: str) -> DataFrame:
    """A one-row frame's numbers as one map column."""
    numbers = [f.name for f in row.schema.fields if isinstance(f.dataType, T.NumericType)]
    pairs = [x for c in numbers for x in (F.lit(c), F.col(f"`{c}`").cast("double"))]
    return row.select(F.create_map(*pairs).alias(name))


def merged_report(schema_report: DataFrame, quality: DataFrame | None, schema_metrics: DataFrame | None = None, quality_metrics: DataFrame | None = None) -> DataFrame:
    """Schema report and quality-gate result side by side in one row, with the numbers that they rest on as maps (null where a side did not run).
    All sides are one row; they meet as rows of one small frame, so nothing is collected."""
    parts = [schema_report]
    if quality is not None:
        errors = F.transform(F.sort_array(F.collect_list(F.struct("check_index", "error"))), lambda x: x["error"])
        parts.append(quality.agg(F.min(F.col("passed").cast("int")).cast("boolean").alias("quality_valid"), F.filter(errors, lambda e: e.isNotNull()).alias("quality_errors")))
    parts += [_as_map(m, n) for m, n in ((schema_metrics, "schema_metrics"), (quality_metrics, "quality_metrics")) if m is not None]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    rest = {"quality_valid": "boolean", "quality_errors": "array<string>", "schema_metrics": "map<string,double>", "quality_metrics": "map<string,double>"}
    rows = rows.select("*", *[F.lit(None).cast(t).alias(c) for c, t in rest.items() if c not in rows.columns])
    return rows.agg(*[F.first(F.col(c), ignorenulls=True).alias(c) for c in [*schema_report.columns, *rest]])


def training_run(spark: SparkSession, csv_path: str, registry_root: str, *, text: str = "Password",
                 target: str = "Times", thresholds_path: str | None = None, model_name: str = "text-model",
                 alias: str = "prod", forest: dict | None = None) -> dict:
    """Returns {'valid', 'errors', 'registration', 'report' (DataFrame), 'steps' (DataFrame)}.
    An invalid table stops the run before training (nothing is registered)."""
    timer = StepTimer()
    th = load_thresholds(spark, thresholds_path)
    sch = th["schema"]
    with timer.step("read"):
        landed = read_raw_csv(spark, csv_path)
    if landed.df is None:
        return {"valid": False, "errors": [landed.error], "registration": None, "report": None,
                "steps": timer.table(spark)}
    kw = dict(max_length=int(sch["max_password_length"]), min_positive_share=float(sch["min_positive_target_share"]),
              max_positive_share=float(sch["max_positive_target_share"]), required=[text, target])
    with timer.step("validate"):
        report = rules.validation_report(landed.df, text, target, **kw)
        row = report.collect()[0]
    if not row.is_valid:
        return {"valid": False, "errors": list(row.errors), "registration": None,
                "report": merged_report(report, None), "steps": timer.table(spark)}
    clean = rules.clean_training_table(landed.df, text, target).persist()
    try:
        with timer.step("train"):
            model = M.fit_text_regressor(clean, text, target, forest=forest)
            metrics = M.train_metrics(model, clean, target).collect()[0].asDict()
        with timer.step("register"):
            reg = ModelRegistry(spark, registry_root).register(
                model, model_name, metrics=metrics, params=dict(M.FOREST, **(forest or {})), alias=alias)
        with timer.step("quality"):
            prod, _ = ModelRegistry(spark, registry_root).load(model_name, alias=alias)
            numbers = cut_lineage(M.quality_metrics(M.scored_table(prod, clean, target), target))  # one row, read by the gate and the report
            merged = cut_lineage(merged_report(report, M.quality_gate(numbers, th), profile.raw_profile(clean, text, target), numbers))
    finally:
        clean.unpersist()
    return {"valid": True, "errors": [], "registration": reg, "report": merged, "steps": timer.table(spark)}
