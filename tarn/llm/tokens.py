"""Token counts, byte-level encoding with decoding, and mixture-controlled packing."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .bpe import byte_bpe, word_bpe
from .common import as_text, record, slices


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row of ``docs`` (doc_id, text).

    A null or empty text has 0 bytes and 0 tokens; exactly ``limit`` tokens are not over it.  Rows are
    independent: repeated rows give equal results, a null doc_id is kept, other columns are not read.  A
    text of any length is one row; an empty table gives none.  One map over the scan, no shuffle.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = word_bpe(tokenizer)
        for batch in batches:
            ids, texts = batch.column(0), as_text(batch.column(1))
            for a, b in slices(batch, texts):
                part = texts[a:b]
                n = np.array([len(x) // 4 for x in bpe.encode(part)], np.int64)
                size = np.array([len(t.encode()) for t in part], np.int64)
                yield record(schema, (ids[a:b], size, n, n > limit))

    return docs.select("doc_id", "text").mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


def byte_encode(docs: DataFrame, ranks: str, pattern: str, keep_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 (and, with ``keep_ids``, ids and byte offsets).

    ``offsets[i]`` is where token i starts in the text's UTF-8; decoding puts each token's bytes there, so
    any span of tokens decodes to its bytes.  A null or empty text has no tokens; both digests are then
    those of the empty string.  Rows are independent: repeated rows give equal results, a null doc_id is
    kept, other columns are not read.  A text of any length is one row; an empty table gives none.  One map
    over the scan, no shuffle.
    """
    fields = [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    ddl = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    if keep_ids:
        fields += [("ids", pa.list_(pa.int64())), ("offsets", pa.list_(pa.int64()))]
        ddl += ", ids array<long>, offsets array<long>"
    schema = pa.schema(fields)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(ranks, pattern)
        for batch in batches:
            doc, texts = batch.column(0), as_text(batch.column(1))
            for a, b in slices(batch, texts, 1 << 20):
                columns: list[list] = [[] for _ in fields[1:]]
                for ids in bpe.encode(texts[a:b]):
                    text_ids, starts = ",".join(map(bpe.decimal.__getitem__, ids.tolist())), bpe.starts(ids)
                    row = [len(ids), hashlib.sha256(text_ids.encode()).hexdigest(), hashlib.sha256(bpe.decode(ids, starts)).hexdigest()]
                    if keep_ids:
                        row += [ids.tolist(), starts[:-1].tolist()]
                    for c, x in zip(columns, row, strict=True):
                        c.append(x)
                yield record(schema, (doc[a:b], *columns))

    return docs.select("doc_id", "text").mapInArrow(encode, ddl)


# --------------------------------------------------------------------------------------- packing

#: Tokens of a sequence, and of the window whose token proportions are controlled (whole sequences).
SEQUENCE, WINDOW = 4096, 16 * 4096
#: A source's target share is in proportion to its tokens to this power: smaller ones are drawn more often
#: than their size says, and run dry sooner.
TEMPERATURE = 0.7


class Mixture:
    """Deficit round-robin over source queues in closed form.

    A window's turn gives every live queue its share of WINDOW tokens; what rounding withholds stays
    in the queue's deficit and is paid in a later window.  Credits up to window w are therefore
    ``floor(share * tokens so far)``, clipped at the queue's length.  When a queue runs dry a new phase
    begins, with the rest sharing its part.  ``total(s, w)`` is what queue s has sent before window w.
    """

    def __init__(self, sizes: dict[str, int], weights: dict[str, float] | None = None, window: int = WINDOW) -> None:
        self.names = sorted(s for s in sizes if sizes[s] > 0)
        self.size = {s: sizes[s] for s in self.names}
        given = {s: self.size[s] if weights is None else max(1, round(weights.get(s, 0) * (1 << 20))) for s in self.names}
        self.window = window
        #: (first window, {queue: (sent before, weight)}, weight of all)
        self.phases: list[tuple[int, dict[str, tuple[int, int]], int]] = []
        sent, first = dict.fromkeys(self.names, 0), 0
        while live := [s for s in self.names if sent[s] < self.size[s]]:
            whole = sum(given[s] for s in live)
            self.phases.append((first, {s: (sent[s], given[s]) for s in live}, whole))
            dry = min(-(-(self.size[s] - sent[s]) * whole // (window * given[s])) for s in live)
            for s in live:
                sent[s] = min(self.size[s], sent[s] + window * dry * given[s] // whole)
            first += dry
        self.windows = first

    def total(self, name: str, w: int) -> int:
        done = 0
        for first, queues, whole in self.phases:
            if w <= first:
                break
            if name in queues:
                base, weight = queues[name]
                done = min(self.size[name], base + self.window * (w - first) * weight // whole)
        return done if w < self.windows else self.size[name]

    def at(self, name: str, x: int) -> int:
        """The window that takes token x of a queue: the last one that begins at or before it."""
        low, high = 0, self.windows
        for first, queues, whole in self.phases:
            if name in queues and queues[name][0] <= x:
                base, weight = queues[name]
                low = first + (x - base) * whole // (self.window * weight)
        low = max(0, min(low, high - 1))
        while self.total(name, low) > x:
            low -= 1
        while self.total(name, low + 1) <= x:
            low += 1
        return low

    def layout(self, w: int) -> tuple[int, dict[str, int]]:
        """Where window w begins in the packed stream, and where in it each queue's part begins."""
        before = {s: self.total(s, w) for s in self.names}
        start = place = sum(before.values())
        starts = {}
        for s in self.names:
            starts[s] = place
            place += self.total(s, w + 1) - before[s]
        return start, starts


def pack(docs: DataFrame, tokenizer: str, end: int, scratch, weights: dict[str, float] | None = None, sequence: int = SEQUENCE, window: int = WINDOW, carry: tuple[str, ...] = (), temperature: float = TEMPERATURE) -> DataFrame:
    """Pieces of ``docs`` (doc_id, text, source) packed into sequences; one row per piece.

    Each source is a queue of its documents' ids (each followed by ``end``) in scan order; windows draw
    from the queues by ``Mixture``, in the proportions of ``weights``, or of the queues' lengths to the power
    ``temperature``.  Every sequence but the last is full.  A null or empty text is the single id ``end``; a
    null source is a queue of its own; repeated rows are packed as often as they occur; a text longer than
    a sequence is cut into pieces.  ``carry`` names columns to pass on (named as an output column, they come
    with an underscore in front).  An empty table gives no piece.

    Ids are computed once and written, with each document's offset in its source within its scan task,
    to the shared folder; the totals of (task, source) become running offsets, which are joined back.
    A mixture sets a share for each source, so driver and tasks hold a few numbers for each source.
    """
    from pyspark import TaskContext
    from pyspark.sql import Window as W
    from pyspark.sql import functions as F

    taken = {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"}
    passed = {c: f"_{c}" if c in taken else c for c in carry}
    kept = docs.select("doc_id", "text", F.coalesce(F.col("source").cast("string"), F.lit("\0")).alias("_queue"), *(F.col(c).alias(f"_carry_{c}") for c in carry))
    extra = kept.schema.fields[3:]
    form = "doc_id long, _queue string, _task int, _within long, _n long, _ids binary"
    ddl = ", ".join([form, *(f"`{f.name}` {f.dataType.simpleString()}" for f in extra)])

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, task, sent = word_bpe(tokenizer), TaskContext.get().partitionId(), {}
        last = np.array([end], "<u4").tobytes()
        for batch in batches:
            texts, queues = as_text(batch.column(1)), batch.column(2).to_pylist()
            for a, b in slices(batch, texts):
                ids = [x + last for x in bpe.encode(texts[a:b])]
                within = []
                for q, x in zip(queues[a:b], ids, strict=True):
                    within.append(sent.get(q, 0))
                    sent[q] = within[-1] + len(x) // 4
                columns = [batch.column(0)[a:b], batch.column(2)[a:b], pa.array([task] * (b - a), pa.int32()), pa.array(within, pa.int64()), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array([narrow(x) for x in ids], pa.binary())]
                names = ["doc_id", "_queue", "_task", "_within", "_n", "_ids", *(f.name for f in extra)]
                yield pa.RecordBatch.from_arrays([*columns, *(batch.column(3 + i)[a:b] for i in range(len(carry)))], names)

    held = scratch.save(kept.mapInArrow(tokenize, ddl), "ids")
    sums = scratch.save(held.groupBy("_queue", "_task").agg(F.sum("_n").alias("_sum")), "sums")
    order = W.partitionBy("_queue").orderBy("_task").rowsBetween(W.unboundedPreceding, -1)
    offsets = sums.select("_queue", "_task", F.coalesce(F.sum("_sum").over(order), F.lit(0)).alias("_before"))
    # written, so that Spark knows its size and broadcasts it only within the session's own bound
    offsets = scratch.save(offsets, "offsets")
    sizes = {r["_queue"]: r["n"] for r in sums.groupBy("_queue").agg(F.sum("_sum").alias("n")).collect()}
    if weights is None:
        weights = {s: (n / max(sizes.values())) ** temperature for s, n in sizes.items()}
    placed = held.join(offsets, ["_queue", "_task"]).withColumn("_at", F.col("_within") + F.col("_before"))
    mix = Mixture(sizes, weights, window)
    out = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    ddl_out = ", ".join([out, *(f"`{passed[c]}` {f.dataType.simpleString()}" for c, f in zip(carry, extra, strict=True))])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, tuple[int, dict[str, int]]] = {}
        for batch in batches:
            rows: list[tuple] = []
            origin: list[int] = []
            doc = batch.column(0).to_pylist()
            for i, (q, x, n, blob) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True)):
                ids, done, w = wide(blob, n), 0, mix.at(q, x)
                while done < n:
                    while mix.total(q, w + 1) <= x + done:
                        w += 1
                    if w not in known:
                        if len(known) > 4096:
                            known.clear()
                        known[w] = mix.layout(w)
                    place = known[w][1][q] + x + done - mix.total(q, w)
                    size = min(n - done, mix.total(q, w + 1) - x - done, sequence - place % sequence)
                    rows.append((doc[i], done, size, zlib.crc32(ids[4 * done : 4 * (done + size)]), n, place // sequence, place % sequence))
                    origin.append(i)
                    done += size
            columns = list(zip(*rows, strict=True)) if rows else [()] * 7
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *passed.values()]
            take = pa.array(origin, pa.int64())
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns), *(batch.column(5 + i).take(take) for i in range(len(carry)))], names)

    return placed.select("doc_id", "_queue", "_at", "_n", "_ids", *(f.name for f in extra)).mapInArrow(cut, ddl_out)


def narrow(ids: bytes) -> bytes:
    """Two bytes an id where all fit."""
    a = np.frombuffer(ids, "<u4")
    return a.astype("<u2").tobytes() if not len(a) or a.max() < 1 << 16 else ids


def wide(blob: bytes, n: int) -> bytes:
    return np.frombuffer(blob, "<u2").astype("<u4").tobytes() if len(blob) == 2 * n else blob
