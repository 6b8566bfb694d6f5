"""Structured Streaming jobs: fast integrity scan and log monitor.

Each micro-batch is one scan. The case gate needs to see absent cases, so it
runs in ``foreachBatch`` over a stored state table; the batch id is the scan id
and a repeated batch is not taken twice. A batch is judged with the earlier rows
of its round ids. Given a ``retention_s`` these are keyed state that expires, and
a batch costs what its own ids hold; without one, every batch is stored beside
the gate's state and read again, so twins are paired however far apart they are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyscope.operators.casegate import GateStore
from tallyscope.operators.fastpath import fast_signals
from tallyscope.operators.fusion import fuse
from tallyscope.operators.logs import log_signals, parse_entries
from tallyscope.schema import LOG_ENTRY, ROUND
from tallyscope.settings import Thresholds
from tallyscope.sources.durable import materialise
from tallyscope.streaming.history import with_history


def scan_id_of(batch_id: int) -> str:
    return f"b{batch_id:012d}"


def gate_candidates(signals: DataFrame, store: GateStore, scan_id: str, risk_type: str, t: Thresholds) -> DataFrame:
    """Fuse one batch of signals and pass the cases through the gate."""
    cases = fuse(signals, t).withColumn("risk_type", F.lit(risk_type))
    return store.ingest(scan_id, cases)


def with_earlier(batch: DataFrame, batch_id: int, key: str, store: GateStore, name: str) -> DataFrame:
    """The batch and the rows of earlier batches that share its values of ``key``; stores the batch."""
    path = f"{store.path}/{name}"
    batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    spark = batch.sparkSession
    stored = spark.read.schema(f"{_ddl(batch)}, batch_id bigint").parquet(path)
    own = stored.where(F.col("batch_id") == batch_id).drop("batch_id")
    keys = own.where(F.col(key).isNotNull()).select(key).distinct()
    earlier = stored.where(F.col("batch_id") < batch_id).drop("batch_id").join(keys, key, "left_semi")
    return own.unionByName(earlier)


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def integrity_batch(
    store: GateStore, catalog: DataFrame, history: Callable[[], DataFrame] | None = None, t: Thresholds = Thresholds(),
    stateful: bool = False,
) -> Callable[[DataFrame, int], None]:
    """Batch function: absolute rules over new rounds, their twins in earlier batches and, given a
    ``history`` of rounds before the stream, the margin before them. A ``stateful`` stream brings the twins itself."""

    def run(batch: DataFrame, batch_id: int) -> None:
        rounds = materialise(batch, "rounds") if stateful else with_earlier(batch, batch_id, "game_seq_id", store, "rounds")
        batch = rounds if stateful else batch
        if history is not None:
            low = batch.agg(F.min("serial").alias("s")).first()["s"]
            if low is not None:
                before = history().where(
                    (F.col("serial") >= low - t.serial_margin) & (F.col("serial") < low)).select(*batch.columns)
                seen = rounds.select("serial", "game_seq_id").distinct()  # an archive may hold earlier batches too
                rounds = rounds.unionByName(before.join(seen, ["serial", "game_seq_id"], "left_anti").select(*batch.columns))
        gate_candidates(fast_signals(rounds, catalog, t), store, scan_id_of(batch_id), "integrity", t)

    return run


def start_integrity(
    spark: SparkSession, source_dir: str, catalog: DataFrame, store: GateStore, checkpoint: str,
    t: Thresholds = Thresholds(), files_per_batch: int = 1000, history: Callable[[], DataFrame] | None = None,
    available_now: bool = False, retention_s: int | None = None,
) -> StreamingQuery:
    """Watch a folder of round files; the checkpoint replaces a serial watermark."""
    stream = spark.readStream.schema(ROUND).option("maxFilesPerTrigger", files_per_batch).parquet(source_dir)
    if retention_s is not None:
        stream = with_history(stream, "game_seq_id", "game_time", retention_s)
    writer = stream.writeStream.foreachBatch(integrity_batch(store, catalog, history, t, retention_s is not None)).option(
        "checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def log_records(spark: SparkSession, source_dir: str, salt: str, retention_s: int, files_per_batch: int = 1000) -> DataFrame:
    """Stream of parsed records beside the earlier ones of their rounds, which expire."""
    stream = spark.readStream.schema(LOG_ENTRY).option("maxFilesPerTrigger", files_per_batch).json(source_dir)
    return with_history(parse_entries(stream, salt), "gsid", "ts", retention_s)


def record_batch(store: GateStore, t: Thresholds = Thresholds()) -> Callable[[DataFrame, int], None]:
    """Batch function over :func:`log_records`: detect, fuse and gate."""

    def run(batch: DataFrame, batch_id: int) -> None:
        signals = materialise(log_signals(materialise(batch, "log_records")), "log_signals")
        signals.write.mode("overwrite").parquet(f"{store.path}/signals/batch_id={batch_id}")
        gate_candidates(signals, store, scan_id_of(batch_id), "log", t)

    return run


def log_batch(store: GateStore, salt: str, t: Thresholds = Thresholds(),
              overlap: Callable[[DataFrame], DataFrame] | None = None) -> Callable[[DataFrame, int], None]:
    """Batch function: parse, detect, fuse and gate one micro-batch of entries.

    Records of earlier batches with the batch's round ids are added, so a failure
    and its later settlement that straddle batches are paired. ``overlap`` may add
    entries from before the stream.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        entries = batch if overlap is None else overlap(batch)
        records = with_earlier(parse_entries(entries, salt), batch_id, "gsid", store, "records")
        gate_candidates(log_signals(materialise(records, "log_records")), store, scan_id_of(batch_id), "log", t)

    return run


def start_log_monitor(
    spark: SparkSession, source_dir: str, store: GateStore, checkpoint: str, salt: str,
    t: Thresholds = Thresholds(), files_per_batch: int = 1000, available_now: bool = False,
    overlap: Callable[[DataFrame], DataFrame] | None = None, retention_s: int | None = None,
) -> StreamingQuery:
    """Watch a folder of log files. With a ``retention_s`` earlier records of a round are keyed state that expires."""
    if retention_s is not None:
        records = log_records(spark, source_dir, salt, retention_s, files_per_batch)
        writer = records.writeStream.foreachBatch(record_batch(store, t)).option("checkpointLocation", checkpoint)
        return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")).start()
    stream = spark.readStream.schema(LOG_ENTRY).option("maxFilesPerTrigger", files_per_batch).json(source_dir)
    writer = stream.writeStream.foreachBatch(log_batch(store, salt, t, overlap)).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def settlement_counts(entries: DataFrame, t: Thresholds = Thresholds(), salt: str = "") -> DataFrame:
    """Streaming form of the double-settlement count, in event-time windows.

    The watermark is the ingestion lag guard plus the overlap; state older than
    that is dropped, and the overlap pairs responses across a window edge.
    """
    recs = parse_entries(entries, salt).withColumn("event_time", F.col("ts").cast("timestamp"))
    late = t.log_lag_guard_s + t.log_overlap_s
    return (
        recs.where("gsid IS NOT NULL AND res_code = 1000 AND container = 'spin-server'")
        .withWatermark("event_time", f"{late} seconds")
        .groupBy(F.window("event_time", f"{2 * late} seconds", f"{late} seconds"), "gsid")
        .agg(F.count(F.lit(1)).alias("n_responses"))
    )
