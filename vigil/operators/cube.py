"""Daily count cube: what drift and the daily suite need of a monitored table, gathered once and extended by days.

A store is a folder with two tables, each an append-only set of batches:

- ``counts``: rows of every (column, side, day, value), numbers and texts apart; both kinds of drift, per day and over all,
  are functions of it;
- ``facts``: one row a (side, day) of sums that add up (rows, errors, null cells, column counts, ends and digests); the daily
  suite's checks are functions of it.

``add`` appends what the given rows hold and reads nothing that is there already, so a new day costs that day. Readers
add batches up. ``drift`` keeps the per-day drift of the days it has scored beside the cube: a later day is scored alone, against
the reference counts; new reference rows start a new table, since every score depends on them.

A null timestamp counts as reference. A day may come in several batches. A store without rows gives empty results.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.operators import drift
from vigil.operators.digest import column_digests, column_hashes
from vigil.session import cut_lineage


#: The test of each kind of columns.
STATTEST = {"number": "wasserstein_normed", "text": "jensen_shannon"}


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def day_facts(rows: DataFrame, fields: list[T.StructField], target: str, prediction: str) -> DataFrame:
    """One row a (is_reference, data_date) of ``rows`` (the columns ``fields``, _ref, _day): sums, counts, ends and column digests, which add up."""
    names = [f.name for f in fields]
    y, e = _q(target), _q(prediction) - _q(target)
    nulls = sum((_q(c).isNull().cast("int") for c in names[1:]), _q(names[0]).isNull().cast("int"))
    hashed = column_hashes(rows, names, keep=["_ref", "_day"], extra={"_share": F.when(y != 0, F.abs(e) / F.abs(y)), "_square": e * e, "_nulls": nulls})
    aggs = [F.count(F.lit(1)).alias("n_rows"), F.sum("_share").alias("shares"), F.count("_share").alias("n_shares"), F.sum("_square").alias("squares"), F.count("_square").alias("n_squares"),
            F.sum("_nulls").cast("long").alias("null_cells"), F.count_if(F.col("_nulls") == len(names)).alias("empty_rows"), *column_digests(len(names))]
    return hashed.groupBy(F.col("_ref").alias("is_reference"), F.col("_day").alias("data_date")).agg(*aggs)


def merged_facts(facts: DataFrame, by: list[str]) -> DataFrame:
    """Facts of larger groups: least and most by min and max, all else by adding."""
    merge = {"least": F.min, "most": F.max}
    skip = {*by, "is_reference", "data_date"}
    return facts.groupBy(*by).agg(*[next((f for k, f in merge.items() if c.startswith(k)), F.sum)(c).alias(c) for c in facts.columns if c not in skip])


class Cube:
    """The store under ``path`` for a table with timestamp ``ts``, target, prediction, and columns by kind."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, ts: str, target: str, prediction: str, numeric, categorical):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.ts, self.target, self.prediction = ts, target, prediction
        self.numeric, self.categorical = list(numeric), list(categorical)

    # ---------------------------------------------------------------- writing

    def add(self, df: DataFrame, is_reference: Column) -> None:
        """Append the counts and facts of ``df``, one pass over it for each table."""
        batch = uuid.uuid4().hex
        rows = df.select(*[_q(f.name) for f in self.schema.fields], F.coalesce(is_reference, F.lit(True)).alias("_ref"), F.to_date(_q(self.ts)).alias("_day"))
        self._counts_of(rows).write.mode("append").option("compression", "zstd").parquet(f"{self.path}/counts/batch={batch}")
        day_facts(rows, self.schema.fields, self.target, self.prediction).write.mode("append").parquet(f"{self.path}/facts/batch={batch}")

    def _counts_of(self, rows: DataFrame) -> DataFrame:
        number, text = F.lit(None).cast("double"), F.lit(None).cast("string")
        cells = [F.struct(F.lit(c).alias("column_name"), F.nanvl(_q(c).cast("double"), number).alias("number"), text.alias("text")) for c in self.numeric]
        cells += [F.struct(F.lit(c).alias("column_name"), number.alias("number"), _q(c).cast("string").alias("text")) for c in self.categorical]
        x = rows.select("_ref", F.col("_day").alias("data_date"), F.inline(F.array(*cells))).filter("number IS NOT NULL OR text IS NOT NULL")
        return x.groupBy(F.col("_ref").alias("is_reference"), "data_date", "column_name", "number", "text").agg(F.count(F.lit(1)).alias("n"))

    # ---------------------------------------------------------------- reading

    def _batches(self, table: str) -> list[str]:
        """Names of the batches, in order, by the file system of the path."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{table}")
        fs = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(folder):
            return []
        done = [s.getPath() for s in fs.listStatus(folder)]
        return sorted(p.getName() for p in done if fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))

    def _read(self, table: str, batches: list[str] | None = None) -> DataFrame:
        names = self._batches(table) if batches is None else batches
        return self.spark.read.parquet(*[f"{self.path}/{table}/{b}" for b in names])

    def counts(self, kind: str) -> DataFrame:
        """(is_reference, data_date, column_name, value, n) of the numbers or the texts; days met in several batches are still apart."""
        return self._read("counts").filter(f"{kind} IS NOT NULL").select("is_reference", "data_date", "column_name", F.col(kind).alias("value"), "n")

    def sides(self, kind: str) -> DataFrame:
        """(column_name, value, nr, nc): counts over all days of each side."""
        one = lambda side: F.sum(F.when(F.col("is_reference") == side, F.col("n")).otherwise(0)).cast("long")
        return self.counts(kind).groupBy("column_name", "value").agg(one(True).alias("nr"), one(False).alias("nc"))

    def facts(self) -> DataFrame:
        """One row a (side, day), batches added up."""
        return merged_facts(self._read("facts"), ["is_reference", "data_date"])

    # ---------------------------------------------------------------- drift

    def overall_drift(self, numeric: bool = True, categorical: bool = True) -> DataFrame:
        """Drift of each column, all current days against the whole reference."""
        parts = []
        if numeric:
            parts.append(drift.numeric_drift_of_counts(cut_lineage(self.sides("number"), "zstd"), self.numeric))
        if categorical:
            parts.append(drift.categorical_drift_of_counts(self.sides("text"), self.categorical))
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    def _reference_batches(self) -> list[str]:
        found = []
        for b in self._batches("facts"):  # a footer's statistics each
            if not self._read("facts", [b]).filter("is_reference").isEmpty():
                found.append(b)
        return found

    def daily_drift(self, numeric: bool = True, categorical: bool = True) -> DataFrame:
        """(data_date, column_name, drift_score, stattest, threshold, drift_detected) of every current day, of the kinds of columns
        asked for; a kind asked for alone is scored alone, unless both were scored already. Days of batches that were not scored against
        this reference are scored and appended; of a day scored twice the later score, over all its rows, holds."""
        place = f"drift-{uuid.uuid5(uuid.NAMESPACE_URL, ','.join(self._reference_batches())).hex}"
        only = None if numeric and categorical else "number" if numeric else "text"
        batches, done, had = self._scored(place)
        if only is not None and had < set(batches):
            place = f"{place}-{only}"
            batches, done, had = self._scored(place)
        new = [b for b in batches if b not in had]
        if new:
            self._score(new, len(done), place, *([] if only is None else [only]))
        best = F.max_by(F.struct("drift_score", "stattest", "threshold", "drift_detected"), "version").alias("s")
        scores = self._read(f"{place}/scores").groupBy("data_date", "column_name").agg(best).select("data_date", "column_name", "s.*")
        return scores if only is None else scores.filter(F.col("stattest") == STATTEST[only])

    def _scored(self, place: str) -> tuple[list[str], list[str], set[str]]:
        """All batches, the tables of names of those scored in ``place``, and these names."""
        done = self._batches(f"{place}/covered")
        return self._batches("facts"), done, {r["name"] for r in self._read(f"{place}/covered", done).collect()} if done else set()  # a row a batch

    def _score(self, new: list[str], version: int, place: str, only: str | None = None) -> None:
        days = self._read("facts", new).filter("NOT is_reference AND data_date IS NOT NULL").select("data_date").distinct()
        parts = []
        for kind, columns, by_day in (("number", self.numeric, drift.numeric_drift_by_day_of_counts), ("text", self.categorical, drift.categorical_drift_by_day_of_counts)):
            if columns and only in (None, kind):
                counts = self.counts(kind)
                ref = cut_lineage(counts.filter("is_reference").groupBy("column_name", "value").agg(F.sum("n").alias("nr")))
                cur = counts.filter("NOT is_reference").join(days, "data_date", "left_semi")
                parts.append(by_day(ref, cut_lineage(cur.groupBy("column_name", "data_date", "value").agg(F.sum("n").alias("nc")))))
        out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        batch = uuid.uuid4().hex
        out.withColumn("version", F.lit(version)).write.parquet(f"{self.path}/{place}/scores/batch={batch}")
        self.spark.createDataFrame([(b,) for b in new], "name string").coalesce(1).write.parquet(f"{self.path}/{place}/covered/batch={batch}")
