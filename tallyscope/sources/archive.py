"""The rounds archive: one-time load, idempotent increments and replay views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyscope.schema import ROUND
from tallyscope.settings import Thresholds
from tallyscope.sources.durable import materialise
from tallyscope.sources.snapshots import Snapshots, range_count, ranged

_COLUMNS = ROUND.fieldNames()


def load_rounds(source: DataFrame) -> DataFrame:
    """Source rounds renamed and typed, without demo traffic."""
    real = source.where("test_demo_play = 'False' AND parent <> 'acdemo'")
    money = ["bet", "valid_bet", "win", "before_balance", "after_balance"]
    return real.withColumnsRenamed({"ReportDate": "report_date", "validBet": "valid_bet"}).withColumns(
        {**{c: F.col(c).cast("double") for c in money}, "triggered": F.col("hasFreegame") == "True"}
    ).select(*_COLUMNS)


TABLE = "rounds"
#: Serials of a block share all but these bits; a block is a folder of the index from serial to day.
SERIAL_BITS = 20
_INDEX = "serial bigint, event_date date, block bigint"


def _dated(rounds: DataFrame) -> DataFrame:
    return rounds.select(*_COLUMNS).withColumn("event_date", F.to_date("game_time"))


def _index(rounds: DataFrame, path: str, n: int) -> None:
    """Add (serial, day) of these rounds to the index of the archive.

    Rows are only ever added: a round that moved is listed under both days, so a
    look-up finds every day that may hold it, also after a writer broke off.
    """
    keyed = _dated(rounds).select("serial", "event_date", F.shiftright("serial", SERIAL_BITS).alias("block")).distinct()
    ranged(keyed, n, "block", "serial").write.mode("append").partitionBy("block").parquet(f"{path}/serials")


def indexed_days(spark: SparkSession, path: str, serials: DataFrame) -> list:
    """Days that may hold these serials, read from the blocks of the index that they fall in, not from any round."""
    roots = [path, *Snapshots(spark, path).version().notes.get("indexes", [])]
    blocks = [r["b"] for r in serials.select(F.shiftright("serial", SERIAL_BITS).alias("b")).distinct().collect()]  # one value a million serials
    days = set()
    for root in roots:
        if not Snapshots(spark, root)._names(f"{root}/serials"):
            continue
        index = spark.read.schema(_INDEX).parquet(f"{root}/serials").where(F.col("block").isin(blocks))
        found = index.join(serials.select("serial").distinct(), "serial", "left_semi").select("event_date").distinct()
        days |= {r["event_date"] for r in found.collect()}  # one value a calendar day
    return sorted(days)


def _stage(rounds: DataFrame, path: str, n: int) -> list[dict]:
    # Ranges end inside a day, or an account, wherever it is large; their number follows the data.
    return Snapshots(rounds.sparkSession, path).stage(ranged(_dated(rounds), n, "event_date", "parent", "uid", "serial"), TABLE)


def _store(rounds: DataFrame, path: str, mode: str) -> None:
    table = Snapshots(rounds.sparkSession, path)
    base = table.version()
    if mode == "errorifexists" and base.number:
        raise FileExistsError(f"an archive exists under {path}")
    n = range_count(rounds)
    _index(rounds, path, n)
    table.commit(base, [*base.entries, *_stage(rounds, path, n)])


def bootstrap_archive(rounds: DataFrame, path: str) -> None:
    """First load, partitioned by UTC event date; refuses an existing archive."""
    _store(rounds, path, "errorifexists")


def read_archive(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """Rounds of one version of the archive, by default the newest; later commits do not change it."""
    table = Snapshots(spark, path)
    return table.read(TABLE, ROUND, table.version(version))


def watermarks(archive: DataFrame) -> DataFrame:
    return archive.agg(F.max("serial").alias("max_serial"), F.max("game_time").alias("max_game_time"))


def increment_slice(source: DataFrame, serial_watermark: int, modified_since) -> DataFrame:
    """Source rows above the serial watermark or modified lately."""
    return source.where(
        (F.col("serial") > serial_watermark)
        | (F.col("last_modify_time") >= F.lit(modified_since).cast("timestamp_ntz")))


def merged_rounds(archive: DataFrame, increment: DataFrame) -> DataFrame:
    """Upsert on ``serial``: a strictly newer source row replaces, a new one is added.

    Both sides meet in one shuffle, and rows stay rows: an aggregate of whole
    rounds would sort each side before and after its own.
    """
    both = archive.select(*_COLUMNS, F.lit(False).alias("_new")).unionByName(
        increment.select(*_COLUMNS, F.lit(True).alias("_new"))).repartition("serial")
    # A merge that broke off may have left a moved round in two days; the newer version counts.
    newest = Window.partitionBy("serial", "_new").orderBy(F.desc_nulls_last("last_modify_time"), F.desc_nulls_last("game_time"))
    kept = both.withColumn("_i", F.row_number().over(newest)).where("_i = 1")
    pair = Window.partitionBy("serial")  # a row of each side at most
    old = F.max(F.when(~F.col("_new"), F.col("last_modify_time"))).over(pair)
    new = F.max(F.when(F.col("_new"), F.col("last_modify_time"))).over(pair)
    replaced = F.coalesce(new > old, F.lit(False))
    only = F.count(F.lit(1)).over(pair) == 1
    keep = F.col("serial").isNull() | only | (F.col("_new") == replaced)
    return kept.withColumn("_keep", keep).where("_keep").select(*_COLUMNS)


def merge_increment(
    spark: SparkSession, path: str, source: DataFrame, t: Thresholds = Thresholds(), *,
    serial_watermark: int | None = None, modified_since=None,
) -> list[str]:
    """Merge new and corrected rounds; rewrites only the touched days.

    A correction may move a round to another day, so the days of both versions
    are rewritten; the index tells where a serial was, and no other day is read.
    The rewritten days are published together, as one version. Returns them.
    """
    table = Snapshots(spark, path)
    base = table.version()
    archive = table.read(TABLE, ROUND, base)
    if serial_watermark is None or modified_since is None:
        from datetime import timedelta

        w = watermarks(archive).first()
        if w["max_serial"] is None:
            raise ValueError("the archive is empty; load it once before merging increments")
        serial_watermark = max(0, w["max_serial"] - t.serial_margin)
        modified_since = w["max_game_time"] - timedelta(days=t.modified_lookback_days)
    inc = materialise(load_rounds(increment_slice(source, serial_watermark, modified_since)), "increment")
    new_days = {r["d"] for r in inc.select(F.to_date("game_time").alias("d")).distinct().collect()}  # one value a calendar day
    days = new_days | set(indexed_days(spark, path, inc))
    if not days:
        return []
    merged = materialise(merged_rounds(touched_days(archive, days), inc), "merged")
    _index(inc, path, range_count(inc))
    kept = base.without(TABLE, {str(d) for d in days})
    table.commit(base, [*kept, *_stage(merged, path, range_count(merged))])
    return sorted(str(d) for d in days)


def touched_days(archive: DataFrame, days) -> DataFrame:
    return archive.where(F.col("event_date").isin(sorted(days)))


def rounds_asof(rounds: DataFrame, as_of: str) -> DataFrame:
    """Rounds visible at a UTC event time (inclusive); the boundary is mandatory."""
    out = rounds.where(F.col("game_time") <= F.expr(f"timestamp_ntz'{as_of}'"))
    if "event_date" in rounds.columns:
        out = out.where(F.col("event_date") <= F.expr(f"date'{as_of[:10]}'"))
    return out


def create_rounds_asof(spark: SparkSession, view: str, name: str = "rounds_asof") -> None:
    """SQL table function over a view; calling it without its argument is an error."""
    extra = " AND event_date <= to_date(as_of)" if "event_date" in spark.table(view).columns else ""
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(as_of TIMESTAMP_NTZ) RETURNS TABLE "
              f"RETURN SELECT * FROM {view} WHERE game_time <= as_of{extra}")


def replay_ticks(spark: SparkSession, start: str, stop: str, t: Thresholds = Thresholds()) -> DataFrame:
    """Replay boundaries from start to stop, inclusive."""
    return spark.range(1).select(F.explode(F.expr(
        f"sequence(timestamp_ntz'{start}', timestamp_ntz'{stop}', interval {int(t.replay_step_hours)} hours)")
    ).alias("as_of"))


def rounds_by_tick(rounds: DataFrame, start: str, stop: str, t: Thresholds = Thresholds()) -> DataFrame:
    """Rounds visible at each replay boundary: every round is counted at its first tick, then summed over ticks."""
    ticks = replay_ticks(rounds.sparkSession, start, stop, t)
    step = int(t.replay_step_hours) * 3_600_000_000
    after = F.timestamp_diff("MICROSECOND", F.expr(f"timestamp_ntz'{start}'"), F.col("game_time"))
    first = F.greatest(F.lit(0), F.ceil(after / step)).cast("bigint")
    counted = rounds.where(F.col("game_time").isNotNull()).groupBy(first.alias("tick")).agg(F.count(F.lit(1)).alias("_n"))
    number = F.timestamp_diff("MICROSECOND", F.expr(f"timestamp_ntz'{start}'"), F.col("as_of")) / step
    so_far = Window.orderBy("as_of").rowsBetween(Window.unboundedPreceding, Window.currentRow)  # one row a tick
    return ticks.withColumn("tick", number.cast("bigint")).join(counted, "tick", "left").select(
        "as_of", F.sum(F.coalesce("_n", F.lit(0))).over(so_far).alias("rounds"))


def clone_archive(spark: SparkSession, source: str, path: str, version: int | None = None) -> None:
    """A new archive that starts as a version of another: its list is copied, no round is read or written."""
    table, origin = Snapshots(spark, path), Snapshots(spark, source)
    base, copied = table.version(), origin.version(version)
    if base.number:
        raise FileExistsError(f"an archive exists under {path}")
    table.commit(base, copied.entries, {**copied.notes, "indexes": [source, *copied.notes.get("indexes", [])]})


def append_rounds(spark: SparkSession, csv_path: str, path: str) -> None:
    """Append typed extra rounds from CSV in schema order."""
    extra = spark.read.schema(ROUND).option("header", True).csv(csv_path)
    _store(extra, path, "append")


def collision_check(rounds: DataFrame, accounts: DataFrame) -> DataFrame:
    """Rounds per given (parent, uid) that already exist."""
    wanted = accounts.select("parent", "uid").distinct()
    return rounds.join(wanted, ["parent", "uid"], "left_semi").groupBy("parent", "uid").agg(
        F.count(F.lit(1)).alias("n"))


def write_artifact(df: DataFrame, root: str, name: str, as_of: str) -> DataFrame:
    """Store an aggregate under its replay boundary and read it back."""
    stamp = as_of.replace(":", "").replace("-", "").replace(" ", "T")
    path = f"{root}/{name}/as_of={stamp}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_row_dumps(spark: SparkSession, pattern: str) -> DataFrame:
    """Row dumps in CSV: demo filter, required columns, missing feature code as 0."""
    d = spark.read.option("header", True).csv(pattern)
    missing = {"serial", "play_type", "bet", "validBet", "win", "game_seq_id"} - set(d.columns)
    if missing:
        raise ValueError(f"dump lacks required columns: {sorted(missing)}")
    return prepare_row_dumps(d)


def prepare_row_dumps(d: DataFrame) -> DataFrame:
    code = F.col("result_feature_code") if "result_feature_code" in d.columns else F.lit("0")
    return (
        d.where((F.lower("test_demo_play") == "false") & (F.col("parent") != "acdemo"))
        .withColumns({
            "serial": F.col("serial").cast("bigint"), "play_type": F.col("play_type").cast("int"),
            "bet": F.col("bet").cast("double"), "valid_bet": F.col("validBet").cast("double"),
            "win": F.col("win").cast("double"), "game_time": F.col("game_time").cast("timestamp_ntz"),
            "report_date": F.col("ReportDate").cast("date"), "triggered": F.lower("hasFreegame") == "true",
            "result_feature_code": F.coalesce(code.cast("int"), F.lit(0)),
        })
    )
