"""Exact copies with the frequent texts split off before the shuffle.

A Misra-Gries type summary (Spark's ``approx_top_k``) names the digests that
may be frequent. Their exact counts and winners are verified by one map-side
aggregation, broadcast (never more rows than the summary tracks) and resolved
without a shuffle of their rows. A digest that is not in the summary has at
most ``SUMMARY_ERROR / tracked`` of the rows, so the ordinary shuffle of the
rest has no hot key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkclaims.llm.words import ascii_lower
from sparkclaims.storage import materialize

TRACKED = 1024
# Rows of a digest that the summary may miss, as a multiple of rows / TRACKED.
SUMMARY_ERROR = 3.5


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One short row per row of ``docs``, written once: the text is read once."""
    normal = ascii_lower(F.coalesce(F.col(text_col), F.lit("")))
    return materialize(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.monotonically_increasing_id().alias("row_no"),
            F.sha2(F.encode(normal, "UTF-8"), 256).alias("text_sha256"),
        ),
        "digests",
    )


def _winners(rows: DataFrame) -> DataFrame:
    return rows.groupBy("text_sha256").agg(
        F.max(F.struct("doc_id", "row_no")).alias("last"), F.count("*").alias("group_size")
    )


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tracked: int = TRACKED
) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of ``docs``.

    Texts are equal when identical after lower-casing A-Z; null counts as the
    empty text. Of equal texts the row with the largest id stays; a null id is
    smaller than any other (``keep_id`` is null when all ids of a group are
    null). Of repeated rows, same id and text, exactly one stays. Other columns
    of ``docs`` are not looked at; an empty table gives an empty result.
    """
    rows = digests(docs, id_col, text_col)
    summary = rows.agg(F.expr(f"approx_top_k(text_sha256, {tracked}, {tracked})").alias("top"))
    candidates = summary.select(F.explode("top").alias("entry")).select(
        F.col("entry.item").alias("text_sha256")
    )
    # At most ``tracked`` rows.
    frequent = materialize(
        _winners(rows.join(F.broadcast(candidates), "text_sha256", "left_semi")), "frequent"
    )
    heavy = rows.join(F.broadcast(frequent), "text_sha256")
    light = rows.join(F.broadcast(frequent.select("text_sha256")), "text_sha256", "left_anti")
    resolved = heavy.unionByName(light.join(_winners(light), "text_sha256"))
    return resolved.select(
        "doc_id",
        F.col("last.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row_no") == F.col("last.row_no")).alias("kept"),
        "text_sha256",
    )
