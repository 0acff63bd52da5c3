"""Model registry as tables: versions, metrics, params and alias moves, plus saved PipelineModels.

Every change appends a row (no in-place update), so the current alias of a
model is the latest alias row by sequence number, read back with ``max_by``.
"""

from __future__ import annotations

import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.functions.redact import SENSITIVE_KEY_PARTS


def _sensitive(key: str) -> bool:
    k = key.lower()
    return any(p in k for p in SENSITIVE_KEY_PARTS)


class ModelRegistry:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _read(self, name: str) -> DataFrame | None:
        """The table, or None if nothing has been appended yet; any other failure is the caller's to see."""
        try:
            return self.spark.read.parquet(self._path(name)).drop("batch")
        except AnalysisException as e:
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):  # the latter: a folder whose first batch is being written
                raise
            return None

    def _claim(self, *place: str) -> bool:
        """Create the marker file of a place in a log; False if another writer has it already.

        The shared store's exclusive create is atomic; a local file system's looks first and then creates, so there the
        operating system's own exclusive create is used."""
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path("/".join([self.root, "claims", *place]))
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        fs.mkdirs(path.getParent())
        try:
            if fs.getUri().getScheme() == "file":
                jvm.java.nio.file.Files.createFile(jvm.java.io.File(path.toUri().getPath()).toPath(), self.spark.sparkContext._gateway.new_array(jvm.java.nio.file.attribute.FileAttribute, 0))
                return True
            return fs.createNewFile(path)
        except Py4JJavaError as e:  # some file systems raise where others answer False
            if "FileAlreadyExists" in str(e.java_exception):
                return False
            raise

    def _append(self, name: str, rows: list[tuple], schema: str) -> None:
        if rows:
            self.spark.createDataFrame(rows, schema).write.parquet(f"{self._path(name)}/batch=b{uuid.uuid4().hex}")  # a folder a batch: writers do not share one job folder

    def versions(self) -> DataFrame | None:
        return self._read("model_versions")

    def register(self, model: PipelineModel, name: str, metrics: dict | None = None,
                 params: dict | None = None, alias: str | None = None) -> dict:
        """Save the model, append its version row, metrics (numeric / other) and params
        (sensitive keys dropped from both); optionally move an alias and verify it by reading it back."""
        prev = self.versions()
        version = 1
        if prev is not None:
            last = prev.filter(F.col("name") == name).agg(F.max("version")).collect()[0][0]
            version = (last or 0) + 1
        while not self._claim(name, f"v{version}"):
            version += 1
        run_id = uuid.uuid4().hex
        uri = f"{self.root}/artifacts/{name}/v{version}-{run_id}"
        model.write().save(uri)  # fails if the folder exists
        now = time.time()
        self._append("model_versions", [(name, version, uri, run_id, now)],
                     "name string, version long, uri string, run_id string, created double")
        metrics = {k: v for k, v in (metrics or {}).items() if not _sensitive(str(k))}
        params = dict(params or {})
        if "n_rows" in metrics:  # describes the run, not the quality
            params.setdefault("n_rows", metrics.pop("n_rows"))
        num = [(name, version, k, float(v)) for k, v in metrics.items()
               if isinstance(v, (int, float)) and not isinstance(v, bool)]
        other = [(name, version, k, str(v)) for k, v in metrics.items()
                 if not (isinstance(v, (int, float)) and not isinstance(v, bool))]
        self._append("model_metrics", num, "name string, version long, metric string, value double")
        self._append("model_tags", other, "name string, version long, tag string, value string")
        pars = [(name, version, k, str(v)) for k, v in params.items() if not _sensitive(str(k))]
        self._append("model_params", pars, "name string, version long, param string, value string")
        out = {"model_name": name, "model_version": version, "model_uri": uri, "run_id": run_id,
               "model_alias": alias, "alias_verified": None}
        if alias:
            self.set_alias(name, alias, version)
            out["alias_verified"] = self.resolve(name, alias=alias) == version
            if not out["alias_verified"]:
                raise RuntimeError(f"alias {alias!r} of {name!r} does not point to version {version}")
        return out

    def set_alias(self, name: str, alias: str, version: int, expected: int | None = None, wait: float = 30.0) -> bool:
        """Append an alias move. With ``expected`` only if the alias is at that version (0: not set) when the move's place in
        the log is taken, else False and nothing changes.

        A move takes the place after the last one by exclusive create, so of two writers that saw the same log one gets the place;
        the other sees the first one's move before it tries again. A writer that took a place and was lost before it appended is
        passed over after ``wait`` seconds."""
        deadline, lost = time.time() + wait, 0
        while True:
            moves = self._read("model_aliases")
            last = None if moves is None else moves.filter((F.col("name") == name) & (F.col("alias") == alias)).agg(F.max("seq").alias("seq"), F.max_by("version", "seq").alias("v")).first()
            if expected is not None and ((last["v"] if last else None) or 0) != expected:
                return False
            seq = ((last["seq"] if last else None) or 0) + 1 + lost
            if self._claim(name, "aliases", alias, f"s{seq}"):
                self._append("model_aliases", [(name, alias, int(version), seq)], "name string, alias string, version long, seq long")
                return True
            if time.time() > deadline:
                lost, deadline = lost + 1, time.time() + wait
            time.sleep(0.05)

    def aliases(self) -> DataFrame | None:
        """Current alias table: latest assignment per (name, alias)."""
        a = self._read("model_aliases")
        if a is None:
            return None
        return a.groupBy("name", "alias").agg(F.max_by("version", "seq").alias("version"))

    def resolve(self, name: str, alias: str | None = None, version: int | None = None) -> int | None:
        """Explicit version wins; else the alias's current version."""
        if version is not None:
            return int(version)
        cur = self.aliases()
        if cur is None:
            return None
        row = cur.filter((F.col("name") == name) & (F.col("alias") == alias)).select("version").collect()
        return int(row[0][0]) if row else None

    def load(self, name: str, alias: str | None = None, version: int | None = None) -> tuple[PipelineModel, int]:
        v = self.resolve(name, alias, version)
        if v is None:
            raise LookupError(f"no version for {name!r} alias={alias!r}")
        uri = (self.versions().filter((F.col("name") == name) & (F.col("version") == v))
               .select("uri").collect()[0][0])
        return PipelineModel.load(uri), v

    def loaded_version_matches(self, name: str, alias: str, loaded_version: int) -> bool:
        return self.resolve(name, alias=alias) == loaded_version
