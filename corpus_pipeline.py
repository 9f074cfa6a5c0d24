"""A corpus pipeline: documents in, packed training sequences out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each result as Parquet in
the shared folder and reads it back as the next stage's documents, so a lost executor costs a stage's
tasks at most.  All stages but the last return the columns of ``documents``.

A stage's result must be written before the next stage is called in the same thread, as ``run`` does:
each stage begins by deleting the working tables of the one before.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarn.llm.common import Scratch, key_mark, table
from tarn.llm.jaccard import near_components
from tarn.llm.quality import quality
from tarn.llm.queries import END, WORD_BPE
from tarn.llm.secrets import redact
from tarn.llm.substrings import dedup_texts
from tarn.llm.tokens import pack

#: The columns of ``documents``.
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


_WORKING: dict[tuple[str, int], list[Scratch]] = {}


def _scratch(spark: SparkSession, name: str) -> Scratch:
    """Working tables of a stage.  Those of the stages before it, whose results are written by now, go."""
    key = (spark.sparkContext.applicationId, threading.get_ident())
    for old in _WORKING.pop(key, []):
        old.clear()
    new = Scratch(spark, f"pipeline-{name}")
    _WORKING[key] = [new]
    return new


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go; others stay, without the lines that are frequent in their host.

    Null, empty and wordless texts are rejected.  A null source is a host of its own; a row without doc_id
    is judged like others, but counts for no line.  Repeated rows are judged alike and count once; a line
    that exactly as many documents hold as the limit says stays.  Texts of any length are one row.  Columns
    beside those of ``documents`` don't go on, whatever their names.  An empty table stays empty.
    """
    found = quality(docs, _scratch(spark, "quality"), carry=COLUMNS[1:], clean=True).where("kept")
    cut = F.col("n_words_left") < F.col("n_words")
    return found.withColumn("n_chars", F.when(cut, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies the document with the smallest doc_id stays.

    Texts without words and rows without doc_id always stay; rows that repeat one doc_id stay or go
    together.  Only rows that may go are joined.  Long texts, other columns and empty tables: as above.
    """
    scratch = _scratch(spark, "jaccard")
    found = near_components(docs, scratch)
    # a row without doc_id can't be told from others and stays
    gone = scratch.save(found.where(F.col("doc_id") != F.col("component_id")).select("doc_id").distinct(), "gone")
    marked = key_mark(docs.select(*COLUMNS), F.col("doc_id"), gone, F.col("doc_id"))
    some = marked.where("_tarn_may").join(gone.hint("merge"), "doc_id", "left_anti")
    return marked.where("not _tarn_may").select(*COLUMNS).union(some.select(*COLUMNS))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that a document with a smaller doc_id holds too are cut; all rows stay.

    Null and empty texts stay as they are, n_chars of a null text is null.  Rows with one doc_id don't cut
    each other and repeated ones are cut alike; rows without doc_id neither cut nor are cut.  Long texts,
    other columns and empty tables: as above.
    """
    return _counted(dedup_texts(docs.select(*COLUMNS), _scratch(spark, "substrings")))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; all rows stay.

    Rows are independent: nulls, empty and repeated ones pass.  Long texts, other columns and empty tables:
    as above.
    """
    _scratch(spark, "secrets")
    return _counted(redact(docs.select(*COLUMNS)))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each piece of a document in a sequence.

    A null or empty text is the end id alone; a null source is a queue of its own; repeated rows are packed
    as often as they occur, a row without doc_id gives pieces without.  Long texts are cut into pieces;
    an empty table gives none; other columns but lang and source don't go on.
    """
    return pack(docs, public_tokenizers.path(WORD_BPE), END, _scratch(spark, "packing"), carry=("lang", "source"))


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", repeated_passages),
    ("secret scans", secret_scan),
    ("packing", packing),
]

#: SQL can't express subword packing; tests/llm hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, scratch = table(spark, sf_dir, "documents"), Scratch(spark, "pipeline")
    for i, (_, stage) in enumerate(STAGES):
        docs = scratch.save(stage(spark, docs, sf_dir), f"stage{i}")
        if i:
            scratch.drop(f"stage{i - 1}")
    for old in _WORKING.pop((spark.sparkContext.applicationId, threading.get_ident()), []):
        old.clear()
    return docs
