"""Column expressions shared by the jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyscope.settings import NON_CONTRIBUTING_FAMILIES, Thresholds


def ratio(num, den) -> Column:
    """Division that yields NULL for a zero or missing denominator."""
    num = F.col(num) if isinstance(num, str) else num
    den = F.col(den) if isinstance(den, str) else den
    return F.try_divide(num.cast("double"), den.cast("double"))


def multiple() -> Column:
    return ratio("win", "valid_bet")


def log_multiple() -> Column:
    return F.when(F.col("win") > 0, F.ln(multiple()))


def identity_gap() -> Column:
    return F.col("after_balance") - (F.col("before_balance") - F.col("bet") + F.col("win"))


def breaks_identity(t: Thresholds) -> Column:
    return F.abs(identity_gap()) > F.greatest(
        F.lit(t.balance_abs_tol), F.abs("before_balance") * t.balance_rel_tol
    )


def utc_text(ts) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def evidence_key(gsid="game_seq_id", ts="game_time") -> Column:
    return F.concat(F.col(gsid), F.lit("@"), utc_text(F.col(ts)))


def evidence_struct(key: Column, now: str, retention_days: int) -> Column:
    """Parse ``gsid@UTC`` wire text into (gsid, ts, key, retention_ok)."""
    text = F.regexp_extract(key, r"@(\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d)Z$", 1)
    ts = F.when(text != "", F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mm:ss")).cast("timestamp_ntz"))
    floor = F.expr(f"timestamp_ntz'{now}' - interval {int(retention_days)} days")
    return F.struct(
        F.substring_index(key, "@", 1).alias("gsid"),
        ts.alias("ts"),
        key.alias("key"),
        F.coalesce(ts >= floor, F.lit(False)).alias("retention_ok"),
    )


def uid_skeleton(uid="uid") -> Column:
    return F.regexp_replace(F.regexp_replace(uid, "[A-Za-z]", "a"), r"\d", "#")


def uid_trailing_number(uid="uid") -> Column:
    text = F.regexp_extract(uid, r"(\d+)\D*$", 1)
    return F.when(text != "", text.cast("decimal(38,0)"))


def sanitize(c, fallback: str = "NA") -> Column:
    """Identifier reduced to a path-safe token of at most 64 characters."""
    text = F.regexp_replace(F.col(c).cast("string") if isinstance(c, str) else c.cast("string"),
                            "[^A-Za-z0-9_.-]", "_")
    text = F.regexp_replace(text, r"^[._-]+|[._-]+$", "")
    # The first that is neither missing nor empty; a condition on the text would run its patterns again in each branch.
    return F.filter(F.array(F.substring(text, 1, 64), F.lit(fallback)), lambda x: x != "")[0]


def player_case_id(parent="parent", game_id="game_id", uid="uid") -> Column:
    return F.concat_ws("_", F.lit("P"), sanitize(parent), sanitize(game_id, "ALL"), sanitize(uid))


def game_case_id(game_id="game_id", play_type="play_type", sm_tag="sm_tag", day="event_date") -> Column:
    return F.concat_ws(
        "_", F.lit("G"), sanitize(game_id), F.concat(F.lit("pt"), sanitize(play_type)),
        sanitize(sm_tag, "NOTAG"), sanitize(day),
    )


def contributing(families) -> Column:
    return F.array_except(families, F.array(*[F.lit(f) for f in NON_CONTRIBUTING_FAMILIES]))


def trimmed_rounds(df: DataFrame, keys: list[str], k: int = 5) -> DataFrame:
    """The k biggest wins of each group, as rows; those of parts of a group hold those of the group.

    ``row_number() <= k`` lets Spark trim every group to k rows before the
    shuffle, so a hot group moves k rows per input task.
    """
    return _ranked_rounds(df, keys, k).drop("_rank")


def _ranked_rounds(df: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc_nulls_last("win"), F.asc("serial"), F.asc("game_seq_id"), F.asc("game_time"))
    rows = df.select(*keys, "win", "serial", "game_seq_id", "game_time").withColumn("_rank", F.row_number().over(order))
    return rows.where(F.col("_rank") <= k)


def top_rounds(df: DataFrame, keys: list[str], k: int = 5, name: str = "top_win_seq_ids") -> DataFrame:
    """The k biggest wins of each group as one ``gsid@UTC|...`` text."""
    packed = F.array_sort(F.collect_list(F.struct("_rank", evidence_key().alias("key"))))
    return _ranked_rounds(df, keys, k).groupBy(*keys).agg(
        F.array_join(F.transform(packed, lambda s: s["key"]), "|").alias(name)
    )


def join_keys(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join on keys that may be NULL (a missing build tag is a group of its own)."""
    r = right.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return left.join(r, cond, how).drop(*[f"_k_{k}" for k in keys])
