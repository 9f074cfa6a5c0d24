"""Quality rules: counts within a text, and lines that too many documents of a host share."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, as_bytes, key_mark, record, salt_of, salted, slices

#: A host's line is removed if more than LEAST of its documents hold it, and more than SHARE of them.
SHARE, LEAST = 0.1, 10
#: A document is depleted if under this share of its words, or under MIN_WORDS, is left of it.
LEFT, MIN_WORDS = 0.3, 20
#: Words of a repeated window.
GRAM = 8

_SYMBOLS = re.compile(rb"[#*$%&|<>]")
_DIGITS = re.compile(rb"[0-9]+")


def normal(line: bytes) -> bytes:
    """A line as it is compared across documents: ASCII case and numbers don't count, nor white space."""
    return b" ".join(_DIGITS.sub(b"0", line.lower()).split())


def repeat_words(words: list[bytes], number: dict[bytes, int]) -> int:
    """Words that lie in windows of GRAM words found twice or more in the text."""
    n = len(words) - GRAM + 1
    if n < 2:
        return 0
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.uint64, len(words))
    key = ids[:n].copy()
    for j in range(1, GRAM):
        key = (key ^ (key >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + ids[j : n + j]
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    if not same.any():
        return 0
    # equal keys are compared word by word, so a collision counts for nothing
    a, b = order[:-1][same], order[1:][same]
    true = np.ones(len(a), bool)
    for j in range(GRAM):
        true &= ids[a + j] == ids[b + j]
    hit = np.zeros(n, bool)
    hit[a[true]] = hit[b[true]] = True
    edge = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(hit)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + GRAM, -1)
    return int((np.cumsum(edge) > 0).sum())


def features(text: bytes) -> tuple[int, int, int, int, int, bool]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    words = text.split()
    joined = b"".join(words)
    chars = len(joined) if joined.isascii() else len(joined.decode("utf-8", "replace"))
    seen: set[bytes] = set()
    dup = 0
    for line in text.split(b"\n"):
        if line in seen:
            dup += 1
        elif line and not line.isspace():
            seen.add(line)
    repeats = repeat_words(words, {})
    return len(words), chars, len(_SYMBOLS.findall(text)), dup, repeats, len(words) < 20 or 100 * repeats > 30 * len(words)


def line_hashes(text: bytes) -> dict[int, int]:
    """Hash of each normalised line that has words -> words of those lines."""
    out: dict[int, int] = {}
    for line in text.split(b"\n"):
        if x := normal(line):
            h = xxhash.xxh3_64_intdigest(x) - (1 << 63)
            out[h] = out.get(h, 0) + x.count(b" ") + 1
    return out


def without(texts: pd.Series, gone: pd.Series) -> pd.Series:
    """The texts without the lines whose hashes are in ``gone``."""

    def one(text, lines):
        if text is None:
            return None
        own = set(lines)
        return b"\n".join(x for x in text.encode().split(b"\n") if xxhash.xxh3_64_intdigest(normal(x)) - (1 << 63) not in own).decode()

    return pd.Series([one(t, x) for t, x in zip(texts, gone, strict=True)], dtype=object)


def quality(docs: DataFrame, scratch: Scratch, carry: tuple[str, ...] = (), clean: bool = False) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, source): the counts, base_failed and kept.

    The host is ``source`` (null: a host of its own).  A line's frequency is the number of the host's
    distinct documents (doc_id) that hold it after normalisation; lines of more than ``max(LEAST, SHARE *
    documents of the host)`` are removed, and a document that passes the base rules is still rejected if
    that leaves it depleted.  Exactly as many documents as the limit keep the line.  Null and empty texts
    have no words and fail; a very long text is one row like others.  Repeated rows each give a row and
    count as one document; rows without doc_id count as none, but lose frequent lines too.  An empty table
    gives no row.  ``carry`` names columns of ``docs`` to pass on (columns of other names may clash with
    anything); with ``clean`` a carried ``text`` comes without its frequent lines.

    The scan's result is written once, each row with a number of its own.  Lines are counted in each scan
    task first; (host, line) pairs are joined with the frequent ones over salted keys and summed by row,
    and only rows that may hold one go through the last join.
    """
    from pyspark import TaskContext

    kept = docs.select("doc_id", "text", F.coalesce(F.col("source").cast("string"), F.lit("\0")).alias("_host"), *(F.col(c).alias(f"_carry_{c}") for c in carry))
    extra = kept.schema.fields[3:]
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    schema = pa.schema([("_row", pa.int64()), ("doc_id", pa.int64()), ("_host", pa.string()), *((n, pa.int64()) for n in names), ("base_failed", pa.bool_()), ("_lines", pa.list_(pa.int64())), ("_sizes", pa.list_(pa.int32()))])
    passed = [f.name for f in extra]
    ddl = "_row long, doc_id long, _host string, " + "".join(f"{n} long, " for n in names) + "base_failed boolean, _lines array<long>, _sizes array<int>" + "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in extra)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            ids, texts, hosts = batch.column(0), as_bytes(batch.column(1)), batch.column(2)
            for a, b in slices(batch, texts):
                part = texts[a:b]
                found = [features(t) for t in part]
                lines = [line_hashes(t) for t in part]
                own = record(schema, (np.arange(row, row + b - a), ids[a:b], hosts[a:b], *zip(*found, strict=True), [list(x) for x in lines], [list(x.values()) for x in lines]))
                row += b - a
                yield pa.RecordBatch.from_arrays([*own.columns, *(c[a:b] for c in batch.columns[3:])], [*schema.names, *passed])

    held = scratch.save(kept.mapInArrow(measure, ddl), "measured")
    limits = held.groupBy("_host").agg(F.greatest(F.lit(LEAST), F.count_distinct("doc_id") * F.lit(SHARE)).alias("_limit"))
    counted = held.select("_host", "doc_id", F.explode("_lines").alias("_line")).groupBy("_host", "_line").agg(F.count_distinct("doc_id").alias("_docs")).where(F.col("_docs") > LEAST)
    frequent = counted.withColumn("_salt", salt_of("_line")).join(salted(limits), ["_host", "_salt"]).where(F.col("_docs") > F.col("_limit")).select("_host", "_line")
    frequent = scratch.save(frequent, "frequent")
    lines = held.select("_row", "_host", F.explode(F.arrays_zip("_lines", "_sizes")).alias("_l")).select("_row", "_host", F.col("_l._lines").alias("_line"), F.col("_l._sizes").alias("_size"))
    hits = lines.withColumn("_salt", salt_of("_row")).join(salted(frequent), ["_host", "_line", "_salt"]).groupBy("_row").agg(F.sum("_size").alias("_lost"), F.collect_list("_line").alias("_gone"))
    hits = scratch.save(hits, "hits")
    marked = key_mark(held.drop("_lines", "_sizes"), F.col("_row"), hits, F.col("_row"))
    some = marked.where("_tarn_may").join(hits, "_row", "left")
    passed_on = {c: F.col(f"_carry_{c}") for c in carry}
    rest_on = dict(passed_on)
    if clean and "text" in passed_on:
        gone = F.col("_gone").isNotNull()
        # texts that lose nothing are not sent to Python
        passed_on["text"] = F.when(gone, F.pandas_udf(without, "string")(F.when(gone, F.col("_carry_text")), F.when(gone, F.col("_gone")))).otherwise(F.col("_carry_text"))
    lost = F.coalesce(F.col("_lost"), F.lit(0))
    left = F.col("n_words") - lost
    depleted = (lost > 0) & ((left < MIN_WORDS) | (left < F.col("n_words") * LEFT))
    some = some.select("doc_id", *names, "base_failed", left.alias("n_words_left"), (~F.col("base_failed") & ~depleted).alias("kept"), *(x.alias(c) for c, x in passed_on.items()))
    rest = marked.where("not _tarn_may").select("doc_id", *names, "base_failed", F.col("n_words").alias("n_words_left"), (~F.col("base_failed")).alias("kept"), *(x.alias(c) for c, x in rest_on.items()))
    return rest.union(some)
