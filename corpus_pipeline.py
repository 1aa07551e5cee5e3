"""From raw documents to packed training sequences, stage by stage.

Each stage takes all rows that the one before it kept. All but the last return
the columns of documents; what a stage decides takes effect in its rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkclaims.llm import line_dedup, mixing, near_dedup, packing, toxicity
from sparkclaims.llm.queries import documents, labels
from sparkclaims.storage import materialize

REJECTED = 0.5
#: Least similarity of near copies, and bands of a side: a pair at it is missed with at most 2e-4.
NEAR_PERCENT, NEAR_GROUPS = 80, 9


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose restored text scores 0.5 or more go."""
    model = toxicity.fit(docs, labels(spark, sf_dir))
    return toxicity.score(docs, model, name="_toxicity").filter(F.col("_toxicity") < REJECTED).select(*docs.columns)


def drop_site_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines on over a tenth of a source's documents go; the documents stay."""
    return _counted(line_dedup.drop_boilerplate(docs).select(*docs.columns))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (similarity 0.8 or more) the document with the smallest id stays."""
    return near_dedup.drop_near_copies(docs, percent=NEAR_PERCENT, groups=NEAR_GROUPS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per copy that the mix takes; a copy taken in part has its first words."""
    return _counted(mixing.mixed_documents(docs).select(*docs.columns))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all copies and their places in the sequences."""
    return packing.pack(docs)


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` is again the length of the text."""
    length = F.length("text").cast("long")
    return docs.select(*[length.alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_site_lines),
    ("near dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# The model, the tokenizer and the draws of the mix are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
