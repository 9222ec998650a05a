"""Streams of events (an extension: batch is all that curated records need).

The same anchored clusters as operators.events, kept as state: for each key the anchor and the
number of the open cluster. A row that begins more than `days` after the anchor opens the next
cluster. Rows of a key are taken in time order inside a micro-batch; what comes later than the
watermark is dropped by Spark.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def windowed_counts(events: DataFrame, at: str = "ts", key: str = "event_type", window: str = "1 day", late: str = "2 days") -> DataFrame:
    """Counts and sums by tumbling window and key, with a watermark."""
    return events.withWatermark(at, late).groupBy(F.window(at, window).alias("w"), key).agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), key, "n", "total")


def clustered(events: DataFrame, key: str = "user_id", at: str = "ts", days: int = 14, late: str = "30 days") -> DataFrame:
    """(key, at, cluster) of a stream, by anchored clusters."""
    seconds = days * 86400

    def step(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        anchor, n = state.get if state.exists else (None, 0)
        rows = pd.concat(list(batches)).sort_values(at)
        out = []
        for t in rows[at]:
            now = int(t.timestamp())
            if n == 0 or now // 86400 - anchor // 86400 > seconds // 86400:
                anchor, n = now, n + 1
            out.append(n)
        state.update((anchor, n))
        yield pd.DataFrame({key: k[0], at: rows[at].to_numpy(), "cluster": out})

    kind = dict(events.dtypes)[key]
    return events.select(key, at).withWatermark(at, late).groupBy(key).applyInPandasWithState(step, f"{key} {kind}, {at} timestamp, cluster int", "anchor long, n int", "append", GroupStateTimeout.NoTimeout)
