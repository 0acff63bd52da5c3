import __spark_entry__ as E
from vigil.plans import catalog

# iterative fits without an SQL form; tests/test_model.py holds them against exact properties
ROWS_ONLY = {"train_and_gate", "score_batch", "prediction_parity"}


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "rmse" in df.columns


def test_every_query_has_an_oracle_or_is_rows_only():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and set(catalog.QUERIES) <= set(q)
    assert set(catalog.QUERIES) - set(o) == ROWS_ONLY


def test_queries_run_whole_at_smallest_scale(spark):
    for name, fn in catalog.QUERIES.items():
        fn(spark, E.SMOKE_DIR).write.format("noop").mode("overwrite").save()
