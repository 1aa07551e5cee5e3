"""Site-relative line frequency.

Within a host, a line is boilerplate when the share of the host's pages that
contain it is over a ratio. Pages and lines are counted by partial sums, so a
host with a third of all pages is no hot group; the boilerplate lines of a
host are few by construction (at most its mean lines per page / ratio). Where
the tables of totals and of boilerplate are too large to broadcast, the rows
of hot hosts are split over sub-keys, as many as their counted rows take.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkclaims.llm.words import WORD
from sparkclaims.operators.joins import fits_broadcast, join_null_safe, skew_join
from sparkclaims.storage import materialize

RATIO = 0.1
LEAST_PAGES = 3
#: Pages (whole texts), and counted lines, of one host that a task may get in a join without broadcast.
HOT_PAGES, HOT_LINES = 1 << 18, 4_000_000


def host_of(url: Column) -> Column:
    """The host of a URL in lower case, for pages that carry one."""
    return F.lower(F.try_parse_url(url, F.lit("HOST")))


def _key(line: Column) -> Column:
    """128 bits that stand for a line."""
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit("line"), line).alias("b"))


def _has_word(line: Column) -> Column:
    return line.rlike(WORD)


def boilerplate(
    docs: DataFrame,
    host_col: str = "source",
    text_col: str = "text",
    ratio: float = RATIO,
    least_pages: int = LEAST_PAGES,
) -> DataFrame:
    """host, keys: the boilerplate lines of each host that has any.

    A page counts once for a line however often it repeats it. Lines on fewer
    than ``least_pages`` pages are never boilerplate, so small hosts are left
    alone. Blank lines are not counted. Pages without a host are one host.
    """
    lines = F.array_distinct(F.filter(F.split(F.col(text_col), "\n"), _has_word))
    pages = docs.select(F.col(host_col).alias("host"), F.transform(lines, _key).alias("keys"))
    totals = materialize(pages.groupBy("host").agg(F.count("*").alias("host_pages")), "host-pages")
    counted = (
        pages.select("host", F.explode("keys").alias("key"))
        .groupBy("host", "key")
        .agg(F.count("*").alias("pages"))
        .filter(F.col("pages") >= least_pages)
    )
    if fits_broadcast(totals):
        shares = join_null_safe(counted, totals, ["host"], "inner")
    else:
        counted = materialize(counted, "line-pages")
        shares = skew_join(counted, totals, ["host"], "inner", null_safe=True, hot_rows=HOT_LINES, may_broadcast=False)
    return (
        shares.filter(F.col("pages") > F.lit(ratio) * F.col("host_pages"))
        .groupBy("host")
        .agg(F.sort_array(F.collect_list("key")).alias("keys"))
    )


def drop_boilerplate(
    docs: DataFrame,
    host_col: str = "source",
    text_col: str = "text",
    ratio: float = RATIO,
    least_pages: int = LEAST_PAGES,
) -> DataFrame:
    """``docs`` with boilerplate lines removed, and two more columns.

    ``lines_before`` counts the lines with a word, ``lines_dropped`` those
    removed. Every row stays, also one whose lines all go (its text is then
    empty); rows without boilerplate keep their text byte by byte; a null text
    stays null with no lines. Columns of ``docs`` that bear these two names
    are replaced; others, whatever their names, are kept as they are. Repeated
    rows count as pages of their own. No rows give none.
    """
    table = materialize(boilerplate(docs, host_col, text_col, ratio, least_pages), "boilerplate")
    # The row is one value here, so no name of its columns meets those below.
    kept_columns = [c for c in docs.columns if c not in ("lines_before", "lines_dropped")]
    rows = docs.select(F.col(host_col).alias("host"), F.struct(*[F.col(f"`{c}`") for c in kept_columns]).alias("row"))
    if fits_broadcast(table):
        joined = join_null_safe(rows, table, ["host"], "left")
    else:
        totals = lambda: docs.groupBy(F.col(host_col).alias("host")).agg(F.count("*").alias("_rows"))
        joined = skew_join(
            rows, table, ["host"], null_safe=True, frequencies=totals, hot_rows=HOT_PAGES, may_broadcast=False
        )
    whole, lines = F.col(f"row.`{text_col}`"), F.col("lines")
    stays = lambda line: ~(_has_word(line) & F.array_contains(F.col("keys"), _key(line)))
    parted = joined.withColumn("lines", F.split(whole, "\n")).withColumn(
        "left", F.when(F.col("keys").isNotNull(), F.filter(lines, stays)).otherwise(lines)
    )
    changed = F.size("left") < F.size(lines)
    text = F.when(changed, F.array_join("left", "\n")).otherwise(whole)
    return parted.select(
        *[text.alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in kept_columns],
        F.coalesce(F.size(F.filter(lines, _has_word)), F.lit(0)).cast("long").alias("lines_before"),
        F.when(changed, F.size(lines) - F.size("left")).otherwise(0).cast("long").alias("lines_dropped"),
    )
