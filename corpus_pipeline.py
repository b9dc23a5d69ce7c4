"""Corpus pipeline: the stages in order, each over all that its predecessor kept.

Every stage takes and returns the columns of ``documents``; the last one returns where each piece of
each document lies in the training sequences. Null and empty texts pass all stages but can be
near duplicates of one another. Further columns may have any names, those that operators use inside
included: stages see them under names of their own. SQL cannot express the stages; ``tests/llm`` hold
them against plain versions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm import toxicity
from tripmart.llm.common import remainder, stored, table
from tripmart.llm.decontamination import BROADCAST_ROWS, contamination
from tripmart.llm.packing import pack_documents
from tripmart.llm.queries import TOKENIZER, TOXIC_FROM, contaminated
from tripmart.llm.simhash import near_duplicate_groups
from tripmart.llm.suffix_dedup import without_repeats


def _guarded(docs: DataFrame, *used: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``docs`` with all but the ``used`` columns under reserved names, told apart by place, and what gives
    the rows of a result the columns of ``docs`` again."""
    names = [c if c in used else f"_col{i}" for i, c in enumerate(docs.columns)]
    return docs.toDF(*names), lambda df: df.select(*names).toDF(*docs.columns)


def _by_id(docs: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """Rows of ``docs`` with (``left_semi``) or without (``left_anti``) an id of ``ids``; null ids
    match each other. Ids are stored and counted; only up to a bound are they broadcast."""
    ids = stored(docs.sparkSession, ids.select(F.col("doc_id").alias("_id")).distinct(), "pipeline-ids")
    side = F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids
    return docs.join(side, docs["doc_id"].eqNullSafe(F.col("_id")), how)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold."""
    labels = table(spark, sf_dir, "labels").filter(remainder("doc_id", 3) != 1)
    docs, named_back = _guarded(docs, "doc_id", "text")
    model = toxicity.fit(docs, labels)
    scored = toxicity.score(docs, model, keep=tuple(docs.columns))
    return named_back(scored.filter(F.col("score") < TOXIC_FROM))


def keep_one_of_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of each near-duplicate group whose id names the group. Rows that repeat an
    id and its text count as one document."""
    docs, named_back = _guarded(docs, "doc_id", "text")
    groups = near_duplicate_groups(docs)
    named = groups.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    return named_back(_by_id(docs, named, "left_semi").dropDuplicates(["doc_id", "text"]))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without the passages that occur elsewhere too; ``n_chars`` follows."""
    docs, named_back = _guarded(docs, "doc_id", "text", "n_chars")
    keep = tuple(c for c in docs.columns if c not in ("text", "n_chars"))
    cut = without_repeats(docs, keep=keep, with_text=True)
    text = F.make_valid_utf8(F.col("kept").cast("string"))
    return named_back(cut.withColumn("text", text).withColumn("n_chars", F.length("text").cast("long")))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no more than a trace of the benchmark."""
    docs, named_back = _guarded(docs, "doc_id", "text")
    found = contamination(docs, table(spark, sf_dir, "benchmark"))
    return named_back(_by_id(docs, found.filter(contaminated()), "left_anti"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where every piece of every document lies in the training sequences."""
    return pack_documents(docs, TOKENIZER, keep_ids=False)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", keep_one_of_group),
    ("repeated_passages", cut_repeats),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; each result is stored and read again as the next input."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
