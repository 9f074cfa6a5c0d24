"""Substring dedup: words of long passages that a document with a smaller id holds too.

Texts are cut into stretches of windows that share a minimizer (the least hash of GRAM words inside a
window), so equal windows of any two documents meet under one minimizer.  Stretches whose minimizer
one document alone has cannot repeat and go no further.  The distinct other stretches are dealt to
shards by minimizer; each shard builds an FM-index of those that come first, streams the later ones
through it, and reports where their matching statistics reach a whole window.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import STEP_BYTES, Scratch, as_bytes, key_filter, key_mark, record, slices
from .fmindex import FmIndex
from .words import Rolling, WordHashes, grams, spans

#: Words of a window and of the stretch that is hashed for its minimizer; windows of a stretch at most.
WINDOW, GRAM, RUN = 50, 10, 64
#: Distinct stretches of a shard (about 70 words each), and of one minimizer before it is dealt to several.
SHARD, HOT = 4096, 16384


def sliding_min(values: np.ndarray, size: int) -> np.ndarray:
    width, low = 1, values
    while width * 2 <= size:
        low = np.minimum(low[:-width], low[width:]) if len(low) > width else low[:0]
        width *= 2
    n = max(0, len(values) - size + 1)
    return np.minimum(low[:n], low[size - width : size - width + n])


def stretches(hashes: np.ndarray, lengths: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """(document's place, first word in it, windows, minimizer, hash of all its words) of each stretch."""
    first, ends = spans(lengths)
    least = sliding_min(grams(hashes, gram), window - gram + 1)
    n = len(least)
    doc = np.repeat(np.arange(len(lengths)), lengths)[:n]
    whole = np.arange(n) + window <= ends[doc] if n else np.zeros(0, bool)
    at = np.flatnonzero(whole)
    if not len(at):
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (least[at[1:]] != least[at[:-1]]) | (doc[at[1:]] != doc[at[:-1]])
    start = np.flatnonzero(new)
    within = np.arange(len(at)) - np.repeat(start, np.diff(np.append(start, len(at))))
    start = np.flatnonzero(new | (within % RUN == 0))
    size = np.diff(np.append(start, len(at)))
    place = at[start]
    return doc[place], place - first[doc[place]], size, least[place], Rolling(hashes).hash(place, place + size + window - 1)


def _key(texts: list[bytes]) -> list[int]:
    return [xxhash.xxh3_64_intdigest(t) - (1 << 63) for t in texts]


def _digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def repeats(docs: DataFrame, scratch: Scratch, window: int = WINDOW, gram: int = GRAM, digests: bool = True) -> tuple[DataFrame, DataFrame]:
    """(each row's key and digest, the repeated stretches of words of each key).

    The first has doc_id, _text (hash of the text), n_words and sha256 of all words (null without
    ``digests``); the second doc_id, _text and _cuts, an array of (from, to) word offsets that a smaller
    doc_id's windows cover.

    Of the stretches of one minimizer, a shard's index holds those of documents that a larger doc_id may
    repeat, and streams those of documents that a smaller doc_id may have said before: of two documents,
    the first is indexed and the second streamed.  A minimizer of more than HOT distinct stretches is
    dealt to several shards, each of which indexes and streams its part; windows are then merged by hash.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("_text", pa.int64()), ("n_words", pa.int64()), ("sha256", pa.string()), ("_runs", pa.list_(pa.struct([("pos", pa.int32()), ("n", pa.int32()), ("h", pa.int64()), ("seg", pa.int64())])))])
    ddl = "doc_id long, _text long, n_words long, sha256 string, _runs array<struct<pos:int,n:int,h:long,seg:long>>"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            ids, texts = batch.column(0), as_bytes(batch.column(1))
            for a, b in slices(batch, texts):
                part = texts[a:b]
                words = [t.split() for t in part]
                lengths = np.fromiter(map(len, words), np.int64, b - a)
                doc, pos, size, least, seg = stretches(known.of([w for ws in words for w in ws]), lengths, window, gram)
                bounds = np.concatenate(([0], np.searchsorted(doc, np.arange(b - a), "right"))).astype(np.int32)
                parts = pa.StructArray.from_arrays([pa.array(pos.astype(np.int32)), pa.array(size.astype(np.int32)), pa.array(least.view(np.int64)), pa.array(seg.view(np.int64))], ["pos", "n", "h", "seg"])
                yield record(schema, (ids[a:b], _key(part), lengths, [_digest(w) if digests else None for w in words], pa.ListArray.from_arrays(pa.array(bounds), parts)))

    rows = scratch.save(docs.select("doc_id", "text").mapInArrow(cut, ddl), "rows")
    runs = rows.where(F.col("doc_id").isNotNull()).select("doc_id", "_text", F.explode("_runs").alias("r")).select("doc_id", "_text", "r.*")
    shared = runs.groupBy("h").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi")
    shared = scratch.save(shared, "shared")
    met = scratch.save(key_filter(runs, F.col("h"), shared, F.col("h")).join(shared.hint("merge"), "h"), "met")
    slim = scratch.save(rows.drop("_runs"), "slim") if digests else None
    scratch.drop("rows", "shared")
    carriers = met.groupBy("h", "seg").agg(F.min(F.struct("doc_id", "_text", "pos", "n")).alias("c"), F.max("doc_id").alias("last"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    carriers = scratch.save(carriers.select("h", "seg", "c.*", "last", (F.col("c.doc_id") < F.col("hi")).alias("held"), (F.col("last") > F.col("lo")).alias("asked")), "carriers")
    many = scratch.save(carriers.groupBy("h").agg(F.count("*").alias("_many")).where(F.col("_many") > HOT), "hot")
    n_hot = many.count()
    shards = max(1, -(-carriers.count() // SHARD))
    dealt = carriers.join(many.hint("merge"), "h", "left") if n_hot else carriers.withColumn("_many", F.lit(None).cast("long"))
    salt = F.pmod(F.col("seg"), F.coalesce(F.ceil(F.col("_many") / HOT), F.lit(1)))
    dealt = dealt.withColumn("shard", F.pmod(F.xxhash64("h", salt), F.lit(shards)))

    # the words of each distinct stretch, from the document with the smallest id
    wanted = dealt.groupBy("doc_id", "_text").agg(F.collect_list(F.struct("pos", "n", "h", "seg", "last", "held", "asked", F.col("_many").isNotNull().alias("hot"), "shard")).alias("_wanted"))
    near = key_filter(docs.select("doc_id", "text"), F.col("doc_id"), carriers.select("doc_id"), F.col("doc_id"))
    slots = [("shard", pa.int64()), ("h", pa.int64()), ("seg", pa.int64()), ("n", pa.int32()), ("doc_id", pa.int64()), ("last", pa.int64()), ("held", pa.bool_()), ("asked", pa.bool_()), ("hot", pa.bool_()), ("words", pa.binary())]
    read_schema = pa.schema(slots)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), as_bytes(batch.column(1))
            for a, b in slices(batch, texts):
                out, size = [], 0
                for i, (t, key, want) in enumerate(zip(texts[a:b], batch.column(2)[a:b].to_pylist(), batch.column(3)[a:b].to_pylist(), strict=True)):
                    if _key([t])[0] != key:
                        continue
                    words = t.split()
                    for w in want:
                        own = b" ".join(words[w["pos"] : w["pos"] + w["n"] + window - 1])
                        out.append((w["shard"], w["h"], w["seg"], w["n"], ids[a + i], w["last"], w["held"], w["asked"], w["hot"], own))
                        size += len(own)
                    if size > 4 * STEP_BYTES:
                        yield record(read_schema, zip(*out, strict=True))
                        out, size = [], 0
                if out:
                    yield record(read_schema, zip(*out, strict=True))

    words = near.join(wanted.hint("merge"), "doc_id").select("doc_id", "text", "_text", "_wanted")
    words = words.mapInArrow(read, "shard long, h long, seg long, n int, doc_id long, last long, held boolean, asked boolean, hot boolean, words binary")
    found_schema = pa.schema([("h", pa.int64()), ("seg", pa.int64()), ("at", pa.int32()), ("size", pa.int32()), ("doc", pa.int64()), ("w", pa.int64())])

    def search(table: pa.Table) -> pa.Table:
        h, seg, n, doc, last = (table[c].to_numpy() for c in ("h", "seg", "n", "doc_id", "last"))
        _, once = np.unique(np.stack((h, seg)), axis=1, return_index=True)  # a repeated row's stretches come twice
        hot_ = table["hot"].to_numpy()
        # a hot minimizer's parts don't see each other, so each tells all its windows
        held = once[table["held"].to_numpy()[once] | hot_[once]]
        asked = once[table["asked"].to_numpy()[once] | hot_[once]]
        split = dict(zip(once.tolist(), (x.split() for x in table["words"].take(pa.array(once)).to_pylist()), strict=True))
        number: dict[bytes, int] = {}
        flat = np.array([number.setdefault(w, len(number)) for i in held.tolist() for w in split[i]], np.int64)
        index = FmIndex(flat, np.array([len(split[i]) for i in held.tolist()], np.int64), doc[held], window)
        flat = np.array([number.get(w, -1) for i in asked.tolist() for w in split[i]], np.int64)
        lengths = np.array([len(split[i]) for i in asked.tolist()], np.int64)
        matched, owner = index.stream(flat, lengths)
        # the windows' places, and the smallest document that has each
        first, _ = spans(lengths)
        size = n[asked].astype(np.int64)
        of = np.repeat(np.arange(len(asked)), size)
        within = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        at = first[of] + within
        least = np.where(matched[at] >= window, np.minimum(owner[at], doc[asked][of]), doc[asked][of])
        warm = hot_[asked][of]
        new = np.ones(len(at), bool)
        new[1:] = (of[1:] != of[:-1]) | (least[1:] != least[:-1]) | warm[1:]
        start = np.flatnonzero(new)
        run = np.diff(np.append(start, len(at)))
        # a stretch's carriers have ids up to `last`: only what a smaller one has matters, but for hot ones
        keep = warm[start] | (least[start] < last[asked][of[start]])
        start, run = start[keep], run[keep]
        whose = asked[of[start]]
        key = pa.nulls(len(start), pa.int64())
        if warm.any():
            exact = Rolling(WordHashes().of([w for i in asked.tolist() for w in split[i]]))
            key = pa.array(exact.hash(at[start], at[start] + window).view(np.int64), mask=~warm[start])
        return pa.Table.from_arrays([pa.array(h[whose]), pa.array(seg[whose]), pa.array(within[start].astype(np.int32)), pa.array(run.astype(np.int32)), pa.array(least[start]), key], schema=found_schema)

    found = scratch.save(words.groupBy("shard").applyInArrow(search, "h long, seg long, at int, size int, doc long, w long"), "found")
    scratch.drop("carriers", "hot")
    parts = found.where("w is null").drop("w")
    if n_hot:  # a hot minimizer's shards are merged by window
        several = found.where("w is not null")
        least = several.groupBy("h", "w").agg(F.min("doc").alias("_least"))
        parts = parts.unionByName(several.join(least, ["h", "w"]).select("h", "seg", "at", "size", F.col("_least").alias("doc")))
        parts = scratch.save(parts, "parts")
    cuts = key_filter(met, F.col("seg"), parts, F.col("seg")).join(parts.hint("merge"), ["h", "seg"]).where("doc < doc_id")
    cuts = cuts.select("doc_id", "_text", F.struct((F.col("pos") + F.col("at")).alias("a"), (F.col("pos") + F.col("at") + F.col("size") + (window - 1)).alias("b")).alias("c"))
    cuts = scratch.save(cuts.groupBy("doc_id", "_text").agg(F.collect_set("c").alias("_cuts")), "cuts")
    scratch.drop("met", "found", "parts")
    return slim, cuts


def _kept(words: list[bytes], cuts: list[dict]) -> np.ndarray:
    edge = np.zeros(len(words) + 1, np.int64)
    for c in cuts:
        edge[c["a"]] += 1
        edge[c["b"]] -= 1
    return np.cumsum(edge[:-1]) == 0


def dedup_digests(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 for every row of ``docs`` (doc_id, text).

    A word goes if a window of 50 words of its document that covers it also starts in a document with a
    smaller doc_id.  Null and empty texts have no words.  Rows with one doc_id don't cut each other and a
    null doc_id neither cuts nor is cut; repeated rows give repeated results.
    """
    rows, cuts = repeats(docs, scratch)
    schema = pa.schema([("doc_id", pa.int64()), ("_text", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = as_bytes(batch.column(1))
            for a, b in slices(batch, texts):
                out = []
                for i, t in enumerate(texts[a:b], a):
                    if _key([t])[0] == batch.column(2)[i].as_py():
                        words = t.split()
                        keep = _kept(words, batch.column(3)[i].as_py())
                        out.append((batch.column(0)[i].as_py(), batch.column(2)[i].as_py(), int((~keep).sum()), _digest([w for w, k in zip(words, keep.tolist(), strict=True) if k])))
                if out:
                    yield record(schema, zip(*out, strict=True))

    near = key_filter(docs.select("doc_id", "text"), F.col("doc_id"), cuts, F.col("doc_id")).join(cuts.hint("merge"), "doc_id")
    changed = near.select("doc_id", "text", "_text", "_cuts").mapInArrow(cut, "doc_id long, _text long, n_removed long, kept_sha256 string").dropDuplicates(["doc_id", "_text"])
    whole = rows.join(changed.hint("merge"), ["doc_id", "_text"], "left")
    return whole.select("doc_id", "n_words", F.coalesce("n_removed", F.lit(0)).alias("n_removed"), F.coalesce("kept_sha256", "sha256").alias("kept_sha256"))


def _cut_text(text: str, found: list[dict]) -> str:
    """The text without the words that the cuts of its key cover; a cut leaves a line break."""
    raw = text.encode()
    key = _key([raw])[0]
    cuts = [c for f in found if f["_text"] == key for c in f["_cuts"]]
    if not cuts:
        return text
    words = raw.split()
    out, at, gap = [], 0, False
    for word, keep in zip(words, _kept(words, cuts).tolist(), strict=True):
        start = raw.index(word, at)
        if keep:
            out.append(b"\n" + word if gap and out else word if gap else raw[at : start + len(word)])
        gap, at = not keep, start + len(word)
    return (b"".join(out) if gap else b"".join(out) + raw[at:]).decode()


def dedup_texts(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """The rows of ``docs`` with repeated passages cut from ``text``; all rows and other columns stay.

    White space goes with the words around it only where words are cut; untouched texts stay as they are.
    Null and empty texts stay; rows with one doc_id don't cut each other, rows without one neither cut nor
    are cut; repeated rows are cut alike; an empty table gives none.  Only rows that may have cuts are joined.
    """
    _, cuts = repeats(docs, scratch, digests=False)

    @F.pandas_udf("string")
    def clean(texts, found):
        import pandas as pd

        return pd.Series([t if t is None or f is None else _cut_text(t, f) for t, f in zip(texts, found, strict=True)], dtype=object)

    by_doc = cuts.groupBy(F.col("doc_id").alias("_tarn_doc")).agg(F.collect_list(F.struct("_text", "_cuts")).alias("_tarn_found"))
    marked = key_mark(docs, F.col("doc_id"), by_doc, F.col("_tarn_doc"))
    some = marked.where("_tarn_may").join(by_doc.hint("merge"), F.col("doc_id") == F.col("_tarn_doc"), "left")
    some = some.withColumn("text", F.when(F.col("_tarn_found").isNull(), F.col("text")).otherwise(clean("text", "_tarn_found")))
    return marked.where("not _tarn_may").select(*docs.columns).union(some.select(*docs.columns))
