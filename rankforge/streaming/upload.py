"""The two-buffer result sink as a stream.

A producer's results gather in a batch that is flushed at ``size`` results or
``age_s`` seconds after its first one, whichever is first; a timer flushes it
when nothing comes any more.  A flushed batch joins a second buffer, and once
that holds ``least`` results it is uploaded as a whole.

Results are staged at once under the number of the upload they will belong to,
so no row waits in state; a producer's state is five numbers.  When an upload is
complete, a mark for it is written.  ``uploaded`` shows the results that have a
mark: an upload is seen whole or not at all, and a micro-batch that is replayed
after a failure replaces its own rows and marks.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from rankforge.config import SINK_BATCH, SINK_BUFFER, SINK_MAX_WAIT

STATE = T.StructType([T.StructField(c, T.LongType()) for c in ("batch", "start_us", "count", "upload", "buffered")])
OUT = T.StructType([T.StructField(c, T.LongType()) for c in ("producer", "event_id", "batch", "upload")]
                   + [T.StructField("done", T.BooleanType())])


def upload_fn(size: int, age_s: float, least: int):
    age_us = int(age_s * 1_000_000)

    def fn(key, pdfs, state: GroupState):
        batch, start, count, upload, buffered = state.get if state.exists else (0, 0, 0, 0, 0)
        marks: list[tuple[int, int]] = []

        def flush() -> None:
            nonlocal batch, count, upload, buffered
            buffered, batch, count = buffered + count, batch + 1, 0
            if buffered >= least:
                marks.append((batch - 1, upload))
                upload, buffered = upload + 1, 0

        frames = []
        if state.hasTimedOut:
            if count:
                flush()
        else:
            from rankforge.streaming.live import _us
            rows = pd.concat(list(pdfs), ignore_index=True)
            rows = rows.assign(_us=_us(rows["ts"])).sort_values(["_us", "event_id"], kind="stable")
            us = rows["_us"].to_numpy()
            of_batch, of_upload = np.empty(len(us), dtype=np.int64), np.empty(len(us), dtype=np.int64)
            i = 0
            while i < len(us):                                   # one step per flush, not per row
                if count and us[i] >= start + age_us:
                    flush()
                if not count:
                    start = int(us[i])
                end = min(i + size - count, max(i + 1, int(np.searchsorted(us, start + age_us, side="left"))))
                of_batch[i:end], of_upload[i:end] = batch, upload
                count, i = count + end - i, end
                if count >= size:
                    flush()
            frames.append(pd.DataFrame({"producer": key[0], "event_id": rows["event_id"].to_numpy(), "batch": of_batch,
                                        "upload": of_upload, "done": False}))
        state.update((int(batch), int(start), int(count), int(upload), int(buffered)))
        if count:
            state.setTimeoutTimestamp(max((start + age_us) // 1000, state.getCurrentWatermarkMs() + 1))
        if marks:
            frames.append(pd.DataFrame({"producer": key[0], "event_id": pd.array([None] * len(marks), dtype="Int64"),
                                        "batch": [b for b, _ in marks], "upload": [u for _, u in marks], "done": True}))
        for f in frames:
            yield f
    return fn


def uploads(stream: DataFrame, producer: str, size: int = SINK_BATCH, age_s: float = SINK_MAX_WAIT, least: int = SINK_BUFFER,
            watermark: str = "0 seconds") -> DataFrame:
    """Staged results (event_id, batch, upload) and the marks of complete uploads."""
    from rankforge.streaming.live import event_time
    s = event_time(stream).withWatermark("ts", watermark)
    return s.select(F.col(producer).cast("bigint").alias(producer), "ts", "event_id").groupBy(producer) \
        .applyInPandasWithState(upload_fn(size, age_s, least), OUT, STATE, "append", GroupStateTimeout.EventTimeTimeout)


def uploaded(spark: SparkSession, path: str) -> DataFrame:
    """The results of complete uploads: producer, event_id, batch, upload."""
    all_rows = spark.read.parquet(path)
    done = all_rows.filter("done").select("producer", "upload").distinct()
    return all_rows.filter("not done").select("producer", "event_id", "batch", "upload").join(done, ["producer", "upload"], "left_semi")
