"""Remove credential-shaped text before anything is written."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Credential patterns in order, and credential field names.
PATTERNS = (
    ("jwt", r"\beyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{4,}\b"),
    ("bearer", r"(?i)\b(?:bearer|authorization)\s*[:=]\s*\S+"),
    ("b64_blob", r"\beyJ[A-Za-z0-9_+/=-]*(?:\.[A-Za-z0-9_+/=-]+)*"),
)
FIELD_NAMES = frozenset({
    "token", "access_token", "id_token", "refresh_token", "authorization", "auth", "jwt", "session",
    "cookie", "set-cookie", "apikey", "api_key", "password", "secret", "signature", "sign", "private_key",
})


def _tag(kind: str, secret: Column, salt: str) -> Column:
    return F.concat(
        F.lit(f"REDACTED:{kind}:sha256="), F.substring(F.sha2(F.concat(F.lit(salt), secret), 256), 1, 12))


def _woven(text: Column, pattern: str, tags: Column) -> Column:
    """Text between matches interleaved with what stands for the matches."""
    pieces = F.split(text, pattern, -1)
    woven = F.zip_with(pieces, tags, lambda p, g: F.concat(p, F.coalesce(g, F.lit(""))))
    return F.when(F.size(tags) > 0, F.array_join(woven, "")).otherwise(text)


def _replace(text: Column, kind: str, pattern: str, salt: str) -> Column:
    found = F.regexp_extract_all(text, F.lit("(?U)" + pattern), F.lit(0))
    return _woven(text, "(?U)" + pattern, F.transform(found, lambda m: _tag(kind, m, salt)))


def redact_text(df: DataFrame, column: str, salt: str) -> DataFrame:
    """Redact one text column; adds the number of replacements per kind."""
    out = df
    for kind, pattern in PATTERNS:
        out = out.withColumn(f"n_{kind}", F.regexp_count(F.col(column), F.lit("(?U)" + pattern)))
        out = out.withColumn(column, _replace(F.col(column), kind, pattern, salt))
    return out


# Inside JSON text a match may not run past the end of its string, nor over an escaped blank.
_JSON_PATTERNS = tuple((k, p.replace(r"\S+", r"""(?:[^\s"\\]|\\[^nrtbfu])+""")) for k, p in PATTERNS)
_FIELD = r'(?i)"(?:' + "|".join(sorted(FIELD_NAMES)) + r')"\s*:\s*"(?:[^"\\]|\\.)+"'
_FIELD_START = r'^"[^"]*"\s*:\s*"'


def redact_json(df: DataFrame, column: str, salt: str) -> DataFrame:
    """Redact JSON text: credential-named string fields whole, then patterns inside values.

    Works on the text, so every other character stays; digests of fields are of
    the value as written. Adds the number of replacements.
    """
    text = F.col(column)
    found = F.regexp_extract_all(text, F.lit(_FIELD), F.lit(0))
    start = lambda m: F.regexp_extract(m, _FIELD_START, 0)
    tags = F.transform(found, lambda m: F.concat(
        start(m), _tag("token_field", F.substring(m, F.length(start(m)) + 1, F.length(m) - F.length(start(m)) - 1), salt),
        F.lit('"')))
    out = df.withColumn("redactions", F.size(found)).withColumn(column, _woven(text, _FIELD, tags))
    for kind, pattern in _JSON_PATTERNS:
        out = out.withColumn("redactions", F.col("redactions") + F.regexp_count(text, F.lit("(?U)" + pattern)))
        out = out.withColumn(column, _replace(text, kind, pattern, salt))
    return out.withColumn("redactions", F.coalesce(F.when(text.isNotNull(), F.col("redactions")), F.lit(0)))


def redaction_counts(redacted: DataFrame) -> DataFrame:
    kinds = [k for k, _ in PATTERNS]
    return redacted.agg(*[F.sum(f"n_{k}").alias(k) for k in kinds])


def assert_clean(df: DataFrame, columns: list[str]) -> DataFrame:
    """Refuse to go on when any credential-shaped run is left."""
    left = F.lit(False)
    for c in columns:
        left = left | F.coalesce(F.contains(F.col(c), F.lit("eyJ")), F.lit(False))
    if df.where(left).limit(1).count():
        raise ValueError("credential-shaped text survived redaction; nothing was written")
    return df
