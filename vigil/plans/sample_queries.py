"""Sampling queries over orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from vigil.operators import sample
from vigil.plans.catalog import register
from vigil.tables import table


def _quota_sql(source: str, key: str, stratum: str) -> str:
    """The quota rule step by step over ``source`` (k, s): an even share of the slots left, then the rest in hash order."""
    return f"""
    WITH RECURSIVE c AS (SELECT k, s, md5(CAST(k AS VARCHAR)) AS h FROM ({source}) WHERE k IS NOT NULL AND s IS NOT NULL),
    st AS (SELECT s, count(*) AS n, row_number() OVER (ORDER BY s) AS idx, count(*) OVER () AS n_strata FROM c GROUP BY s),
    rc AS (SELECT least(20, (SELECT count(*) FROM c)) AS row_count),
    q(idx, s, take, remaining) AS (
        SELECT st.idx, st.s, least(st.n, greatest(1, rc.row_count // st.n_strata)),
               rc.row_count - least(st.n, greatest(1, rc.row_count // st.n_strata))
        FROM st, rc WHERE st.idx = 1 AND rc.row_count > 0
        UNION ALL
        SELECT st.idx, st.s, least(st.n, greatest(1, q.remaining // (st.n_strata - st.idx + 1))),
               q.remaining - least(st.n, greatest(1, q.remaining // (st.n_strata - st.idx + 1)))
        FROM q JOIN st ON st.idx = q.idx + 1 WHERE q.remaining > 0),
    r AS (SELECT c.*, row_number() OVER (PARTITION BY s ORDER BY h, k) AS rn FROM c),
    picked AS (SELECT r.k, r.s FROM r JOIN q ON r.s = q.s WHERE r.rn <= q.take),
    rest AS (SELECT k, s FROM c WHERE k NOT IN (SELECT k FROM picked) ORDER BY h, k
             LIMIT (SELECT row_count FROM rc) - (SELECT coalesce(sum(take), 0) FROM q))
    SELECT k AS {key}, s AS {stratum} FROM (SELECT * FROM picked UNION ALL SELECT * FROM rest)
    """


@register("stratified_sample", sql=_quota_sql("SELECT o_orderkey AS k, o_orderpriority AS s FROM orders", "o_orderkey", "o_orderpriority"))
def stratified_sample(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return sample.stratified_sample(orders, "o_orderkey", "o_orderpriority")


# a numeric stratum that comes as text: one large stratum, two with a row each at any size (the ends of the keys), and values that don't count
_TEXT_STRATUM = """CASE WHEN o_orderkey = (SELECT min(o_orderkey) FROM orders) THEN '1' WHEN o_orderkey = (SELECT max(o_orderkey) FROM orders) THEN '2'
    WHEN o_orderkey % 500 = 3 THEN 'x' WHEN o_orderkey % 500 = 4 THEN '-1' WHEN o_orderkey % 500 = 5 THEN 'NaN' WHEN o_orderkey % 500 = 6 THEN NULL ELSE '0' END"""


@register("stratified_sample_small_strata", sql=_quota_sql(
    f"""SELECT k, CASE WHEN isnan(v) OR v < 0 THEN NULL ELSE v END AS s
        FROM (SELECT o_orderkey AS k, TRY_CAST({_TEXT_STRATUM} AS DOUBLE) AS v FROM orders)""", "o_orderkey", "target"))
def stratified_sample_small_strata(spark, sf_dir):
    # quotas are for few strata, so the two rare ones are taken whole; the ends of the keys are one row of two numbers
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    low, high = orders.agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    stratum = _TEXT_STRATUM.replace("(SELECT min(o_orderkey) FROM orders)", str(low)).replace("(SELECT max(o_orderkey) FROM orders)", str(high))
    orders = orders.selectExpr("o_orderkey", f"{stratum} AS target")
    return sample.stratified_sample(orders, "o_orderkey", "target", numeric=True, ordered=True)


@register("half_split", sql="""
    WITH o AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS pos, count(*) OVER () AS total
               FROM orders)
    SELECT o_orderkey, 'train' AS half FROM o WHERE pos <= total // 2
    UNION ALL SELECT o_orderkey, 'test' AS half FROM o WHERE pos >= total // 2
""")
def half_split(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    return sample.half_split(orders, "o_orderkey")


@register("hash_sample", sql="""
    SELECT o_orderkey, o_totalprice FROM orders ORDER BY md5(CAST(o_orderkey AS VARCHAR)), o_orderkey LIMIT 1000
""")
def hash_sample(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return sample.hash_sample(orders, "o_orderkey", 1000)
