"""Rows of a stream beside the earlier rows of their keys, kept as keyed state that expires."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

_STATE = "rows binary"


def _packed(rows: pd.DataFrame) -> bytes:
    table = pa.Table.from_pandas(rows, preserve_index=False)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(data: bytes) -> pd.DataFrame:
    with pa.ipc.open_stream(data) as rows:
        return rows.read_all().to_pandas()


def with_history(stream: DataFrame, key: str, time: str, retention_s: int, buckets: int = 1024) -> DataFrame:
    """Each batch's rows and, for the keys they bring, the rows of earlier batches.

    Keys are held by hash bucket, as a call costs far more than the rows of a
    key: the rows of a bucket are one state, in the state store of the query's
    checkpoint, and a batch reads and writes the buckets its keys fall in. A row
    leaves the state once a row of its key is more than ``retention_s`` newer in
    event time. A key that brings nothing for that long is forgotten when its
    bucket is next read, or with the bucket by a timer, so what is held is
    bounded by twice the retention. Timers run on the time of arrival, whose
    watermark no row is behind: none is dropped, however late it is in event
    time. Rows without a key pass by unkept. ``buckets`` is fixed for the life of
    a checkpoint.
    """
    schema, columns = stream.schema, stream.columns
    mark = F.when(F.col(key).isNotNull(), F.col(key).cast("string"))
    # rows without a key are spread, as they are no group
    spread = F.pmod(F.xxhash64(F.coalesce(mark, F.xxhash64(*columns).cast("string"))), F.lit(buckets)).cast("int")
    keyed = stream.select(
        "*", mark.isNotNull().alias("_kept"), spread.alias("_bucket"),
        F.current_timestamp().alias("_arrived"), F.unix_millis(F.current_timestamp()).alias("_ms"))

    def step(group: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        if not group[0]:
            for new in frames:
                yield new[columns]
            return
        new = pd.concat(frames, ignore_index=True)[[*columns, "_ms"]]
        arrived = int(new["_ms"].max())
        yield new[columns]
        rows = new
        if state.exists:
            before = _unpacked(bytes(state.get[0]))
            last = before.groupby(key, sort=False)["_ms"].transform("max")
            before = before[last + int(retention_s * 1000) >= state.getCurrentWatermarkMs()]
            met = before[before[key].isin(new[key].unique())]
            if len(met):
                yield met[columns]
            if len(before):
                rows = pd.concat([before, new], ignore_index=True)
        newest = rows.groupby(key, sort=False)[time].transform("max")
        rows = rows[~(rows[time] < newest - pd.Timedelta(seconds=retention_s))]
        state.update((_packed(rows),))
        state.setTimeoutTimestamp(max(arrived + int(retention_s * 1000), state.getCurrentWatermarkMs() + 1))

    return keyed.withWatermark("_arrived", "10 seconds").groupBy("_kept", "_bucket").applyInPandasWithState(
        step, schema, _STATE, "append", GroupStateTimeout.EventTimeTimeout)
