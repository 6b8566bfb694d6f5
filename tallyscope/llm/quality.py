"""Quality rules with cross-document line frequency, in DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyscope.sources.durable import materialise

BLANKS = " \t\n\x0b\x0c\r"
_WORD_GAP = "[\\x20\\x09-\\x0D]+"
_SYMBOLS = "[#*$%&|<>]"


@dataclass(frozen=True)
class LineLimits:
    """A line is boilerplate above ``least`` distinct texts and above ``share`` of its host's texts."""

    least: int = 10
    share: float = 0.01
    #: a document is depleted when fewer than so many words, or this part of them, are left
    least_words: int = 10
    least_part: float = 0.3


def _words(text: Column) -> Column:
    return F.filter(F.split(text, _WORD_GAP), lambda w: w != "")


def _repeat_words(docs: DataFrame) -> DataFrame:
    """``n_repeat_words``: words inside 5-word windows that occur twice or more in the text."""
    window = F.transform(
        F.sequence(F.lit(0), F.greatest(F.size("w_") - 5, F.lit(0))),
        lambda i: F.xxhash64(*[F.get(F.col("h_"), i + k) for k in range(5)]),
    )
    docs = docs.withColumn("h_", F.transform("w_", lambda w: F.xxhash64(w)))
    docs = docs.withColumn("g_", F.when(F.size("w_") >= 6, window).otherwise(F.array().cast("array<long>")))
    placed = F.sort_array(F.transform("g_", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    docs = docs.withColumn("s_", F.when(F.size(F.array_distinct("g_")) < F.size("g_"), placed))

    def same(i: Column, j: Column) -> Column:
        return F.coalesce(F.get(F.col("s_"), i)["g"] == F.get(F.col("s_"), j)["g"], F.lit(False))

    twice = F.filter(
        F.sequence(F.lit(0), F.size("s_") - 1), lambda i: same(i, i - 1) | same(i, i + 1)
    )
    docs = docs.withColumn("p_", F.sort_array(F.transform(twice, lambda i: F.get(F.col("s_"), i)["i"])))
    covered = F.aggregate(
        F.transform("p_", lambda p, k: F.least(F.lit(5), F.coalesce(F.get(F.col("p_"), k + 1) - p, F.lit(5)))),
        F.lit(0).cast("long"), lambda a, x: a + x,
    )
    return docs.withColumn(
        "n_repeat_words", F.when(F.col("s_").isNull(), F.lit(0).cast("long")).otherwise(covered)
    )


def features(docs: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Base figures of every document, its host, and its distinct normalised lines with their words.

    Columns: row, doc_id, host, text, text_hash, n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed, lines (hash, words).
    """
    d = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id"),
        F.coalesce(F.col("source"), F.lit("")).alias("host"), F.col("text"), *[F.col(c) for c in carry],
        F.coalesce(F.col("text"), F.lit("")).alias("t_"),
    )
    d = d.withColumn("w_", _words(F.col("t_")))
    d = d.withColumn("l_", F.filter(F.split("t_", "\n"), lambda x: F.rlike(x, F.lit("[^\\x20\\x09-\\x0D]"))))
    d = _repeat_words(d)
    d = d.withColumn("n_words", F.size("w_").cast("long"))
    normal = F.transform(
        "l_", lambda x: F.struct(
            F.xxhash64(F.lower(F.trim(F.regexp_replace(x, _WORD_GAP, F.lit(" "))))).alias("hash"),
            F.size(_words(x)).alias("words"),
        ),
    )
    d = d.select(
        "row", "doc_id", "host", "text", *carry, F.xxhash64("t_").alias("text_hash"), "n_words",
        F.char_length(F.translate(F.col("t_"), BLANKS, "")).cast("long").alias("word_chars"),
        F.regexp_count("t_", F.lit(_SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("l_") - F.size(F.array_distinct("l_"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        ((F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))).alias("base_failed"),
        normal.alias("lines"),
    )
    return d


def line_frequency(rows: DataFrame, limits: LineLimits) -> DataFrame:
    """Lines above the limits by host: host, hash, the number of texts and the first document.

    Exact copies of a text count once, so a widely copied document is not taken
    for boilerplate. Counting combines on the map side, so a line or host that
    fills a third of the table is a few partial sums.
    """
    texts = rows.groupBy("host", "text_hash").agg(
        F.min("doc_id").alias("doc_id"), F.min_by("lines", "row").alias("lines")
    )
    per_host = texts.groupBy("host").agg(F.count(F.lit(1)).alias("n_host"))
    lines = texts.select("host", "doc_id", F.explode(F.array_distinct(F.transform("lines", lambda x: x["hash"]))).alias("hash"))
    counts = lines.groupBy("host", "hash").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_doc"))
    return counts.where(F.col("n") > limits.least).join(per_host, "host").where(
        F.col("n") > limits.share * F.col("n_host")
    ).select("host", "hash", "n", "first_doc")


def judge(
    docs: DataFrame, limits: LineLimits = LineLimits(), with_text: bool = False, carry: tuple[str, ...] = ()
) -> DataFrame:
    """Every document with its base figures, ``base_failed``, ``n_removed_words`` and ``kept``.

    Lines above the limits of :class:`LineLimits` are removed from all documents
    of their host but the first; a document is depleted, and not kept, when too
    few words remain. ``with_text`` adds ``clean_text``, the text without them;
    ``carry`` names further columns of ``docs`` to hand through.

    Null text: no words, so base_failed. Null source: a host of its own. Null
    doc_id: never the first holder of a line. Repeated rows each get a row, and
    count as one text. An empty table gives no rows. Other columns are ignored.
    """
    rows = features(docs, carry)
    rows = materialise(rows if with_text else rows.drop("text"), "features")
    frequent = materialise(line_frequency(rows, limits), "lines")
    hits = (
        rows.select("row", "host", "doc_id", F.explode("lines").alias("line"))
        .select("row", "host", "doc_id", F.col("line.hash").alias("hash"), F.col("line.words").alias("words"))
        .join(frequent, ["host", "hash"])
        .where(~F.coalesce(F.col("doc_id") == F.col("first_doc"), F.lit(False)))
    )
    taken = hits.groupBy("row").agg(F.sum("words").alias("removed"), F.collect_set("hash").alias("gone"))
    out = rows.join(taken, "row", "left")
    left = F.col("n_words") - F.coalesce(F.col("removed"), F.lit(0))
    depleted = (left < limits.least_words) | (left < limits.least_part * F.col("n_words"))
    columns = [
        "row", "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        F.coalesce(F.col("removed"), F.lit(0)).cast("long").alias("n_removed_words"),
        (~F.col("base_failed") & ~depleted).alias("kept"), *carry,
    ]
    if with_text:
        columns.append(_without(F.col("text"), F.col("gone")).alias("clean_text"))
    return out.select(*columns)


def _without(text: Column, gone: Column) -> Column:
    """The text without the lines whose hash is listed."""
    def stays(x: Column) -> Column:
        return ~F.array_contains(gone, F.xxhash64(F.lower(F.trim(F.regexp_replace(x, _WORD_GAP, F.lit(" "))))))

    return F.when(gone.isNull(), text).otherwise(F.array_join(F.filter(F.split(text, "\n"), stays), "\n"))
