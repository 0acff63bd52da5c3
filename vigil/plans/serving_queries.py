"""Serving-log queries over events: endpoint = event_type, instance = user_id,
version = props.k, publish log = events (model = event_type, version = event_id)."""

from __future__ import annotations

from pyspark.sql import functions as F

from vigil.operators import serving
from vigil.plans.catalog import register
from vigil.tables import table


def observations(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return ev.select(F.col("event_type").alias("endpoint"), F.col("event_id").alias("request_number"),
                     F.col("user_id").cast("string").alias("instance_id"),
                     F.nullif(F.get_json_object("props", "$.k"), F.lit("")).alias("loaded_version"))


@register("consistency_check", sql="""
    WITH o AS (SELECT event_type AS endpoint, CAST(user_id AS VARCHAR) AS instance_id,
                      nullif(json_extract_string(props, '$.k'), '') AS loaded_version FROM events)
    SELECT endpoint, count(*) AS n_observations,
           count(DISTINCT coalesce(instance_id, '<none>')) AS n_instances,
           count(DISTINCT coalesce(loaded_version, '<none>')) AS n_versions,
           count(DISTINCT coalesce(instance_id, '<none>')) > 1 AS multiple_instances,
           count(DISTINCT coalesce(loaded_version, '<none>')) > 1 AS multiple_versions
    FROM o GROUP BY ROLLUP (endpoint)
""")
def consistency_check(spark, sf_dir):
    return serving.consistency_check(observations(spark, sf_dir), "endpoint", "instance_id", "loaded_version")


@register("latest_state", sql="""
    WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn,
                      count(*) OVER (PARTITION BY user_id) AS n_rows FROM events)
    SELECT user_id, event_id, ts, event_type, n_rows FROM r WHERE rn = 1
""")
def latest_state(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return serving.latest_by_key(ev, "user_id", ["ts", "event_id"], ["event_id", "ts", "event_type"])


@register("alias_resolve", sql="""
    WITH a AS (SELECT event_type AS model_name, CASE WHEN value >= 50 THEN 'prod' ELSE 'staging' END AS alias,
                      event_id AS version, ts FROM events),
    r AS (SELECT *, row_number() OVER (PARTITION BY model_name, alias ORDER BY ts DESC, version DESC) AS rn,
                 count(*) OVER (PARTITION BY model_name, alias) AS n_assignments FROM a)
    SELECT model_name, alias, version, ts AS assigned_at, n_assignments FROM r WHERE rn = 1
""")
def alias_resolve(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    log = ev.select(F.col("event_type").alias("model_name"),
                    F.when(F.col("value") >= 50, "prod").otherwise("staging").alias("alias"),
                    F.col("event_id").alias("version"), "ts")
    out = serving.latest_by_key(log.withColumn("_k", F.struct("model_name", "alias")), "_k",
                                ["ts", "version"], ["version", "ts"])
    return out.select("_k.model_name", "_k.alias", "version", F.col("ts").alias("assigned_at"),
                      F.col("n_rows").alias("n_assignments"))


# a 'view' as last event stands for a state that was never reported, 'error' for a failed reload
@register("state_warnings", sql="""
    WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events),
    s AS (SELECT 'Serving state diagnostic for instance ''' || user_id || ''' ' AS about, user_id AS instance_id,
                 CASE event_type WHEN 'view' THEN NULL ELSE event_type <> 'error' END AS model_loaded,
                 CASE event_type WHEN 'error' THEN 'failed' WHEN 'view' THEN NULL ELSE 'success' END AS last_reload_status,
                 CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(event_id % 3 AS VARCHAR) END AS loaded_version
          FROM r WHERE rn = 1)
    SELECT instance_id, list_filter([
        CASE WHEN model_loaded IS NULL THEN about || 'reports model_loaded=None.'
             WHEN NOT model_loaded THEN about || 'reports model_loaded=False.' END,
        CASE WHEN last_reload_status IS NULL THEN about || 'reports last_reload_status=None.'
             WHEN last_reload_status <> 'success' THEN about || 'reports last_reload_status=''failed''.' END,
        CASE WHEN loaded_version IS NULL THEN about || 'loaded unexpected model version: None != ''1''.'
             WHEN loaded_version <> '1' THEN about || 'loaded unexpected model version: ''' || loaded_version || ''' != ''1''.' END
    ], lambda x: x IS NOT NULL) AS warnings FROM s
""")
def state_warnings(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    latest = serving.latest_by_key(ev, "user_id", ["ts", "event_id"], ["event_type", "event_id"])
    kind = F.col("event_type")
    state = latest.select(F.col("user_id").alias("instance_id"), F.when(kind != "view", kind != "error").alias("model_loaded"),
                          F.when(kind == "error", "failed").when(kind != "view", "success").alias("last_reload_status"),
                          F.when(F.col("event_id") % 3 != 0, (F.col("event_id") % 3).cast("string")).alias("loaded_version"))
    return serving.state_warnings(state, expected_version="1").select("instance_id", "warnings")
