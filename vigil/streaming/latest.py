"""Latest state per key over a stream, and event-time windows, as incremental jobs.

``latest_per_key`` keeps, for each key, the row with the greatest event time (ties: the greatest row) as the stream goes on: an
aggregate with ``max_by``, so the state is one row a key and a key's rows are combined in the tasks first. With a watermark
and a ``window`` the state of closed windows is dropped, so keys that stop sending expire.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(stream: DataFrame, key: str, ts: str, columns: list[str], window: str = "1 day", delay: str = "1 day") -> DataFrame:
    """(window_start, key, ts, *columns): the last row of each key in each event-time window, for batch tables and streams alike."""
    last = F.max(F.struct(F.col(ts), *[F.col(c) for c in columns if c != ts])).alias("last")
    rows = stream.withWatermark(ts, delay) if stream.isStreaming else stream
    out = rows.filter(F.col(ts).isNotNull()).groupBy(F.window(ts, window).alias("w"), F.col(key)).agg(last)
    return out.select(F.col("w.start").alias("window_start"), key, f"last.{ts}", *[f"last.{c}" for c in columns if c != ts])
