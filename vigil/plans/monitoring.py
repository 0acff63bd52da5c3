"""The monitoring table: lineitem ⋈ part seen as a scored table with a timestamp.

target ``price`` = l_extendedprice, prediction ``pred`` = l_quantity * p_retailprice,
numeric features, categorical features and ``start_date`` = l_shipdate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.operators.cube import Cube
from vigil.session import checkpoint_dir, cut_lineage
from vigil.tables import source_key, table

# First day of the "current" period; earlier rows are the reference.
CURRENT_FROM = "2000-01-01"
NUMERIC_FEATURES = ("l_quantity", "l_discount", "l_tax", "p_size", "p_retailprice")
CATEGORICAL_FEATURES = ("l_returnflag", "l_linestatus", "p_brand", "p_type")
TARGET, PREDICTION, TIMESTAMP = "price", "pred", "start_date"
COLUMNS = (TIMESTAMP, TARGET, PREDICTION) + NUMERIC_FEATURES + CATEGORICAL_FEATURES


def monitoring_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part")
    # Equi-join on the part key; Catalyst picks broadcast or sort-merge from the
    # size estimate, and AQE re-plans / splits skewed keys at run time.
    return (li.join(part, li.l_partkey == part.p_partkey)
              .select(F.col("l_shipdate").alias(TIMESTAMP),
                      F.col("l_extendedprice").alias(TARGET),
                      (F.col("l_quantity") * F.col("p_retailprice")).alias(PREDICTION),
                      *NUMERIC_FEATURES, *CATEGORICAL_FEATURES))


def is_reference():
    """Rows before CURRENT_FROM; a null timestamp counts as reference."""
    return ~F.coalesce(F.col(TIMESTAMP) >= F.lit(CURRENT_FROM).cast("timestamp_ntz"), F.lit(False))


def reference_part(df: DataFrame) -> DataFrame:
    return df.filter(is_reference())


def current_part(df: DataFrame) -> DataFrame:
    return df.filter(F.col(TIMESTAMP) >= F.lit(CURRENT_FROM).cast("timestamp_ntz"))


NUMERIC = (TARGET, PREDICTION) + NUMERIC_FEATURES
_CUBES: dict[str, Cube] = {}


def monitoring_cube(spark: SparkSession, sf_dir: str) -> Cube:
    """The count cube of the monitoring table, in the checkpoint folder. It is built once for a state of the source files (names, lengths
    and times make its name), and again when they change; queries over the same state share it."""
    key = f"{checkpoint_dir(spark).rstrip('/')}/monitoring-{source_key(spark, sf_dir, ['lineitem', 'part'])}"
    if key not in _CUBES:
        m = monitoring_table(spark, sf_dir)
        cube = Cube(spark, key, m.schema, TIMESTAMP, TARGET, PREDICTION, NUMERIC, CATEGORICAL_FEATURES)
        cube.add(cut_lineage(m, "zstd"), is_reference())  # the join runs once for both tables of the cube
        _CUBES[key] = cube
    return _CUBES[key]


MONITORING_SQL = """
    SELECT l.l_shipdate AS start_date, l.l_extendedprice AS price,
           l.l_quantity * p.p_retailprice AS pred,
           l.l_quantity, l.l_discount, l.l_tax, p.p_size, p.p_retailprice,
           l.l_returnflag, l.l_linestatus, p.p_brand, p.p_type
    FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
"""
