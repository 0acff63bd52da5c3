"""Queries over landed files and streams made of the tables: rejected CSV lines, thresholds from a file, gate phases, streaming windows."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from vigil.functions.text import strip_ws
from vigil.operators import rules
from vigil.plans import sqlfrag as S
from vigil.plans.catalog import register
from vigil.session import checkpoint_dir
from vigil.sources.csv import rejected_lines
from vigil.sources.thresholds import thresholds_table
from vigil.streaming.jobs import daily_error_counts, run_available
from vigil.streaming.latest import latest_per_key
from vigil.tables import table


def _fresh(spark, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@register("csv_rejected_lines", sql="""
    WITH o AS (SELECT o_orderkey, o_orderkey // 5000 AS part, o_orderpriority, o_totalprice, row_number() OVER (PARTITION BY o_orderkey // 5000 ORDER BY o_orderkey) + 1 AS line FROM orders)
    SELECT part, line, CASE WHEN o_orderkey % 97 = 0 THEN 'too many fields' ELSE 'fully empty row' END AS reason FROM o WHERE o_orderkey % 97 = 0 OR o_orderkey % 101 = 0
""")
def csv_rejected_lines(spark, sf_dir):
    """The orders as a folder of CSV files in which some rows are broken, landed, and the refused rows by file and line."""
    path, k = _fresh(spark, "landed"), F.col("o_orderkey")
    row = F.concat_ws(",", F.col("o_orderkey").cast("string"), "o_orderpriority", F.col("o_totalprice").cast("string"))
    line = F.when(k % 97 == 0, F.concat(row, F.lit(",extra"))).when(k % 101 == 0, F.lit(",NA,")).otherwise(row)
    rows = table(spark, sf_dir, "orders").select(F.floor(k / 5000).alias("part"), k, line.alias("value"))
    heads = rows.select("part").distinct().select("part", F.lit(-1).cast("long").alias("o_orderkey"), F.lit("o_orderkey,o_orderpriority,o_totalprice").alias("value"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows.unionByName(heads).repartition(n, "part").sortWithinPartitions("part", "o_orderkey").select("part", "value").write.partitionBy("part").text(path)
    found = rejected_lines(spark, path, 3)
    return found.select(F.regexp_extract("file", r"part=(-?\d+)", 1).cast("long").alias("part"), "line", "reason")


@register("thresholds_from_file", sql="""
    WITH seen AS (SELECT CAST(max(quality) AS DOUBLE) / 4 AS low, count(*) AS n FROM labels)
    SELECT section, key, CAST(value AS DOUBLE) AS value FROM (VALUES ('schema', 'max_positive_target_share', 0.7), ('model_quality', 'max_rmse', 0.23), ('model_quality', 'max_abs_mean_error', 0.09),
        ('model_quality', 'max_prediction_target_mean_gap', 0.1)) t(section, key, value)
    UNION ALL SELECT 'schema', 'min_positive_target_share', low FROM seen
    UNION ALL SELECT 'schema', 'max_password_length', CAST(n AS DOUBLE) FROM seen
    UNION ALL SELECT 'model_quality', 'max_mae', CAST(n AS DOUBLE) / 1e6 FROM seen
""")
def thresholds_from_file(spark, sf_dir):
    """A threshold file made of the labels, over the defaults; text, booleans and unknown keys in it change nothing."""
    seen = table(spark, sf_dir, "labels").agg((F.max("quality").cast("double") / 4).alias("low"), F.count(F.lit(1)).alias("n"))
    doc = F.to_json(F.struct(F.struct(F.col("low").alias("min_positive_target_share"), F.col("n").alias("max_password_length"), F.lit("0.9").alias("max_positive_target_share"), F.lit(1).alias("other")).alias("schema"),
                             F.struct((F.col("n") / 1e6).alias("max_mae"), F.lit(True).alias("max_rmse")).alias("model_quality")))
    path = _fresh(spark, "thresholds")
    seen.select(doc.alias("value")).coalesce(1).write.text(path)
    return thresholds_table(spark, path)


@register("gate_structure", sql=f"""
    WITH v AS ({S.TRAINING_VIEW}),
    s AS (SELECT count(*) AS n, count(*) FILTER (WHERE text IS NULL AND quality IS NULL) AS empty_rows FROM v),
    e AS (SELECT 1 AS ord, printf('DataFrame contains fully empty rows: %d rows', empty_rows) AS error FROM s WHERE empty_rows > 0
          UNION ALL SELECT 2, 'DataFrame contains fully empty columns: spare' FROM s WHERE n > 0
          UNION ALL SELECT 3, 'DataFrame columns must exactly match [''text'', ''quality''] in order; found [''quality'', ''text'', ''spare'']')
    SELECT CAST(row_number() OVER (ORDER BY ord) - 1 AS INTEGER) AS error_index, error FROM e
""")
def gate_structure(spark, sf_dir):
    """Phase A of the gate stops a table whose columns are in another order, with one more that is empty."""
    from vigil.plans.quality_queries import training_view
    v = training_view(spark, sf_dir).select("quality", "text", F.lit(None).cast("string").alias("spare"))
    return rules.validation_errors(v, "text", "quality")


_LETTERS = "substring(regexp_replace(lower(text), '[^a-z]', '', 'g'), 1, 40)"


@register("gate_share", sql=f"""
    WITH v AS (SELECT {_LETTERS} AS text, quality FROM documents JOIN labels USING (doc_id) WHERE {_LETTERS} <> ''),
    s AS (SELECT avg(CASE WHEN quality > 0 THEN 1.0 ELSE 0.0 END) AS share FROM v)
    SELECT 0 AS error_index, printf('Column quality has invalid target distribution: positive share is %.3f; expected between 0.30 and 0.70', share) AS error
    FROM s WHERE NOT share BETWEEN 0.3 AND 0.7
""")
def gate_share(spark, sf_dir):
    """Phase C of the gate, reached by rows that pass phases A and B."""
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id")
    letters = F.substring(F.regexp_replace(F.lower("text"), "[^a-z]", ""), 1, 40)
    v = docs.select(strip_ws(letters).alias("text"), F.col("quality").cast("string").alias("quality")).filter("text <> ''")
    return rules.validation_errors(v, "text", "quality")


_EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def _event_stream(spark, sf_dir):
    """The events as a stream. Watermarks need instants: a wall-clock time becomes the instant that shows it in UTC, whatever the session's zone."""
    schema = table(spark, sf_dir, "events").schema
    # a pattern, since a stream takes a folder or a pattern, and the table may be one file
    events = spark.readStream.schema(schema).parquet(f"{sf_dir.rstrip('/')}/events.parque[t]")
    return events.withColumn("ts", F.expr(f"timestamp_micros(timestampdiff(MICROSECOND, {_EPOCH}, CAST(ts AS TIMESTAMP_NTZ)))"))


def _wall_clock(df, *columns):
    return df.withColumns({c: F.expr(f"timestampadd(MICROSECOND, unix_micros({c}), {_EPOCH})") for c in columns})


@register("streaming_daily_errors", sql="""
    WITH w AS (SELECT date_trunc('day', ts) AS window_start, count(*) AS n_observations, count(*) FILTER (WHERE event_type = 'error') AS n_errors FROM events WHERE ts IS NOT NULL GROUP BY 1)
    SELECT window_start, n_observations, n_errors FROM w WHERE window_start + INTERVAL 1 DAY <= (SELECT date_trunc('milliseconds', max(ts)) FROM events) - INTERVAL 1 DAY
""")
def streaming_daily_errors(spark, sf_dir):
    """Q13 2.10: the events as a stream, errors per 1-day window, appended once the watermark has passed the window's end."""
    out = _fresh(spark, "daily-errors")
    run_available(daily_error_counts(_event_stream(spark, sf_dir), "ts", F.col("event_type") == "error"), out.rsplit("/", 1)[1], out)
    return _wall_clock(spark.read.schema("window_start timestamp, n_observations long, n_errors long").parquet(out), "window_start")


@register("streaming_latest_state", sql="""
    WITH r AS (SELECT date_trunc('day', ts) AS window_start, user_id, ts, event_type, value, row_number() OVER (PARTITION BY date_trunc('day', ts), user_id ORDER BY ts DESC, event_type DESC, value DESC) AS n
               FROM events WHERE ts IS NOT NULL)
    SELECT window_start, user_id, ts, event_type, value FROM r WHERE n = 1 AND window_start + INTERVAL 1 DAY <= (SELECT date_trunc('milliseconds', max(ts)) FROM events) - INTERVAL 1 DAY
""")
def streaming_latest_state(spark, sf_dir):
    """U3 as a stream: the last row of each user and day, expired with the day's window."""
    out = _fresh(spark, "latest")
    stream = latest_per_key(_event_stream(spark, sf_dir), "user_id", "ts", ["event_type", "value"])
    run_available(stream, out.rsplit("/", 1)[1], out)
    return _wall_clock(spark.read.schema(stream.schema).parquet(out), "window_start", "ts")
