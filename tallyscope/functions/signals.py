"""Builder for rows of the signal table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyscope.schema import SIGNAL


def signals(df: DataFrame, **values) -> DataFrame:
    """Rows of the signal table from a frame of entities.

    A keyword gives a field as a Column or a constant; entity fields that are
    not given are taken from the frame when it has them, else NULL.
    """
    taken = {"parent", "uid", "game_id", "play_type", "currency", "sm_tag"}
    cols = []
    for f in SIGNAL.fields:
        if f.name in values:
            v = values[f.name]
            c = v if isinstance(v, Column) else F.lit(v)
        elif f.name in taken and f.name in df.columns:
            c = F.col(f.name)
        elif f.name == "n" and "rounds" in df.columns:
            c = F.col("rounds")
        elif f.name == "evidence":
            c = (
                F.when(F.col("top_win_seq_ids") != "", F.split("top_win_seq_ids", r"\|"))
                if "top_win_seq_ids" in df.columns else F.lit(None)
            )
        elif f.name == "persistence":
            c = F.lit("not_evaluated")
        elif f.name == "effect_unit":
            c = F.lit("")
        else:
            c = F.lit(None)
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def context(**pairs) -> Column:
    out = []
    for k, v in pairs.items():
        out += [F.lit(k), (v if isinstance(v, Column) else F.lit(str(v))).cast("string")]
    return F.create_map(*out)
