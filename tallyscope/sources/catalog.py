"""The certified game sheet: parsing, issues and a data-quality verdict."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyscope.sources.durable import shared_dir

# Encodings tried in order, header spellings and value patterns.
ENCODINGS = ("cp950", "utf-8-sig", "utf-8")
HEADERS = {
    "game_id": ("gameid",), "play_type": ("gametype",), "game_name": ("gamename",),
    "playway": ("game playway", "playway"), "rtp": ("rtp",),
    "multiplier": ("max mutilipier", "max multiplier", "max mutiplier"),
}
RTP_PATTERN = r"^\s*(\d+(?:\.\d+)?)\s*%\s*$"
MULTIPLIER_PATTERN = r"(\d+(?:[\d,]*\d)?(?:\.\d+)?)\s*[xX]"
BUY_PRICE_PATTERN = r"(\d+(?:\.\d+)?)\s*倍"
GAME_ID_PATTERN = r"^(\d+)([a-z]?)$"


def read_sheet(spark: SparkSession, path: str) -> DataFrame:
    """Raw sheet rows with normalised column names.

    The encoding of this one small file is found on its bytes; a UTF-8 copy in
    the shared folder is what Spark parses.
    """
    head = spark.read.format("binaryFile").load(path).select("content").first()
    if head is None:
        raise FileNotFoundError(path)
    raw = bytes(head["content"])
    for encoding in ENCODINGS:
        try:
            text = raw.decode(encoding)
            break
        except UnicodeDecodeError:
            continue
    else:
        raise ValueError(f"{path}: undecodable with {ENCODINGS}")
    copy = f"{shared_dir(spark)}/sheet-{uuid.uuid4().hex}"
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(copy)
    sheet = (
        spark.read.option("header", True).option("multiLine", True).option("escape", '"')
        .option("inferSchema", False).csv(copy)
    )
    normal = {c.replace("﻿", "").strip().lower(): c for c in sheet.columns}
    if "gameid" not in normal or "rtp" not in normal:
        raise ValueError(f"{path}: not the game sheet")
    cols = []
    for name, spellings in HEADERS.items():
        found = next((normal[x] for x in spellings if x in normal), None)
        cols.append((F.col(f"`{found}`") if found else F.lit(None).cast("string")).alias(name))
    return sheet.withColumn("line", F.monotonically_increasing_id() + 2).select("line", *cols)


def parse_sheet(raw: DataFrame) -> DataFrame:
    """Parsed rows plus their issue codes; nothing is dropped yet."""
    text = lambda c: F.trim(F.coalesce(F.col(c), F.lit("")))
    found = lambda c, p, g: F.nullif(F.regexp_extract(c, p, g), F.lit(""))
    r = raw.select("line", *[text(c).alias(c) for c in HEADERS]).where(
        F.concat("game_id", "play_type", "game_name", "playway", "rtp", "multiplier") != "")
    rtp = (found("rtp", RTP_PATTERN, 1).cast("double") / 100.0)
    r = r.select(
        "line", "game_id", F.expr("try_cast(play_type AS int)").alias("play_type"), "game_name", "playway",
        F.when(rtp.between(0.5, 1.05), rtp).alias("rtp"),
        F.regexp_replace(found("multiplier", MULTIPLIER_PATTERN, 1), ",", "").cast("double").alias("max_multiplier"),
        found("playway", BUY_PRICE_PATTERN, 1).cast("double").alias("buy_price_x"),
        F.col("play_type").alias("_pt"), F.col("rtp").alias("_rtp"), F.col("multiplier").alias("_mult"),
        rtp.alias("_rtp_any"),
    )
    first = Window.partitionBy("game_id", "play_type").orderBy("line")
    r = r.withColumn("_dup", (F.col("game_id") != "") & (F.row_number().over(first) > 1))
    c = F.col
    issue = lambda when, code: F.when(when, F.lit(code))
    shape = F.regexp_extract("game_id", GAME_ID_PATTERN, 1) != ""
    blank = c("game_id") == ""
    live = ~blank & ~c("_dup")
    issues = F.array_compact(F.array(
        issue(blank, "blank_game_id"),
        issue(~blank & ~shape, "game_id_unparseable"),
        issue(~blank & shape & (F.regexp_extract("game_id", GAME_ID_PATTERN, 2) == ""), "game_id_missing_suffix"),
        issue(~blank & (c("_pt") != "") & c("play_type").isNull(), "play_type_unparseable"),
        issue(~blank & (c("_pt") == ""), "play_type_blank"),
        issue(c("_dup"), "duplicate_row"),
        issue(live & (c("_mult") != "") & c("max_multiplier").isNull(), "max_multiplier_unparseable"),
        issue(live & (c("_rtp") == ""), "rtp_missing"),
        issue(live & (c("_rtp") != "") & c("_rtp_any").isNull(), "rtp_unparseable"),
        issue(live & c("_rtp_any").isNotNull() & c("rtp").isNull(), "rtp_out_of_range"),
    ))
    return r.withColumn("issues", issues).withColumn("kept", live).drop("_pt", "_rtp", "_mult", "_rtp_any", "_dup")


def catalog_rows(parsed: DataFrame, overrides: DataFrame | None = None) -> DataFrame:
    """Usable rows; overrides (game_id, play_type, rtp, max_multiplier) win where set."""
    rows = parsed.where("kept").select(
        "line", "game_id", "play_type", "game_name", "playway", "rtp", "max_multiplier", "buy_price_x")
    if overrides is None:
        return rows
    o = overrides.groupBy(F.col("game_id").alias("_g"), F.col("play_type").alias("_p")).agg(
        F.max("rtp").alias("_r"), F.max("max_multiplier").alias("_m"))
    on = (F.col("game_id") == F.col("_g")) & F.col("play_type").eqNullSafe(F.col("_p"))
    return rows.join(o, on, "left").withColumns({
        "rtp": F.coalesce("_r", "rtp"), "max_multiplier": F.coalesce("_m", "max_multiplier"),
    }).drop("_g", "_p", "_r", "_m")


def catalog_issues(parsed: DataFrame, overrides: DataFrame | None = None) -> DataFrame:
    """Issue log: line, game and code; overrides are audited too."""
    out = parsed.select("line", "game_id", F.explode("issues").alias("code"))
    if overrides is None:
        return out
    rows = parsed.where("kept").select(F.col("game_id").alias("_g"), F.col("play_type").alias("_p"), F.lit(1).alias("_hit"))
    on = (F.col("game_id") == F.col("_g")) & F.col("play_type").eqNullSafe(F.col("_p"))
    audit = overrides.join(rows, on, "left").select(
        F.lit(None).cast("bigint").alias("line"), "game_id",
        F.when(F.col("_hit").isNotNull(), "override_applied").otherwise("override_unmatched").alias("code"))
    return out.unionByName(audit)


def catalog_report(rows: DataFrame, issues: DataFrame) -> DataFrame:
    """One row: verdict, row and game counts, issues, games without a return."""
    games = rows.groupBy("game_id").agg(F.every(F.col("rtp").isNull()).alias("_none"))
    g = games.agg(F.count(F.lit(1)).alias("games"), F.count_if("_none").alias("games_without_rtp"))
    n = rows.agg(F.count(F.lit(1)).alias("n_rows"))
    i = issues.agg(F.count(F.lit(1)).alias("n_issues"))
    one = F.lit(True)
    return g.join(n, one, "left").join(i, one, "left").withColumn(
        "verdict", F.when(F.col("n_issues") > 0, "WARN").otherwise("PASS"))


def games_without_rtp(rows: DataFrame) -> DataFrame:
    """Games that no rule can test against a certified return."""
    return rows.groupBy("game_id").agg(F.every(F.col("rtp").isNull()).alias("_none")).where("_none").select("game_id")
