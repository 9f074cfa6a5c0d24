"""Toxicity: a linear-chain conditional random field over words, and document scores from its marginals.

The field has two tags (clean, toxic).  A word's emission is a constant and the weights of its features:
the word itself and its first letters; two words' tags are tied by transitions, and a document begins
clean.  Labels are given for documents only, so the words' tags are hidden in training: a clean document
says that all its words are clean, a toxic one that they are not.  How likely that is follows from
forward-backward, and weights and transitions climb its gradient together.  Marginals give each word's
probability, their sum and maximum the document's score.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import as_bytes, record, slices

#: Labelled training rows that are fitted, at most, and bytes of their texts: the smallest by a hash of
#: doc_id, up to the first that would exceed the bytes.  Of these, all rows and all words count.
SAMPLE, BYTES = 4000, 24 << 20
#: Letters of the prefixes that are features, besides the whole word.
PREFIXES = (4, 5, 6, 7)
#: A feature gets a weight if this many toxic documents have it and it is likelier there by this log-odds;
#: the weight begins as this part of the log-odds.
SUPPORT, CLEAR, BEGIN = 3, 1.0, 1.0
#: Training steps of a pass over the sample (of LEAST words or more each), passes, speed and decay of the weights.
STEPS, LEAST, PASSES, SPEED, DECAY = 40, 3000, 3, 0.08, 5e-5
EDGE = b".,|;:!?\"'()[]{}#*<>&$%"
MEMO = 200_000
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def tokens(text: bytes) -> list[bytes]:
    return text.lower().split()


def word_features(token: bytes) -> list[tuple[int, str]]:
    """(kind, value): the word without marks at its edges, and its first letters where it is longer."""
    word = token.strip(EDGE).decode("utf-8", "replace")
    return [(0, word), *((i, word[:n]) for i, n in enumerate(PREFIXES, 1) if len(word) > n)] if word else []


class Corpus:
    """Training texts as arrays: words by number, the features of each word, and who has what."""

    def __init__(self, texts: list[bytes], toxic: np.ndarray) -> None:
        number: dict[bytes, int] = {}
        self.docs = [np.array([number.setdefault(w, len(number)) for w in tokens(t)], np.int64) for t in texts]
        self.toxic = toxic
        named: dict[tuple[int, str], int] = {}
        lists = [[named.setdefault(f, len(named)) for f in word_features(w)] for w in number]
        self.names, self.words = list(named), len(number)
        #: feature ``feature[i]`` belongs to word ``word[i]``
        self.feature = np.array([f for x in lists for f in x], np.int64)
        self.word = np.repeat(np.arange(self.words), np.array([len(x) for x in lists], np.int64))

    def emissions(self, chain: Chain) -> np.ndarray:
        """Of each word, by its number."""
        weights = np.array([chain.weights.get(f, 0.0) for f in self.names])
        return chain.constant + np.bincount(self.word, weights[self.feature], minlength=self.words)

    def log_odds(self, chosen: np.ndarray) -> np.ndarray:
        """Of each feature: the log of its smoothed ratio of document shares, or -inf with too little support."""
        begin = np.searchsorted(self.word, np.arange(self.words + 1))
        seen, docs = np.zeros((2, len(self.names))), [1, 1]
        for i in chosen.tolist():
            words = np.unique(self.docs[i])
            size = begin[words + 1] - begin[words]
            at = np.repeat(begin[words] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
            y = int(self.toxic[i])
            seen[y][np.unique(self.feature[at])] += 1
            docs[y] += 1
        odds = np.log((seen[1] + 0.5) / docs[1]) - np.log((seen[0] + 0.5) / docs[0])
        return np.where(seen[1] >= SUPPORT, odds, -math.inf)


class Chain:
    """Log-space weights: of the features and a constant, and of the steps between tags."""

    def __init__(self, weights: dict[tuple[int, str], float], constant: float, steps: np.ndarray) -> None:
        self.weights, self.constant, self.steps = weights, constant, steps
        self.memo: dict[bytes, float] = {}

    def emissions(self, words: list[bytes]) -> np.ndarray:
        if len(self.memo) > MEMO:
            self.memo.clear()
        memo = self.memo
        got = list(map(memo.get, words))
        if None in got:
            for w in {w for w, x in zip(words, got, strict=True) if x is None}:
                memo[w] = self.constant + sum(self.weights.get(f, 0.0) for f in word_features(w))
            got = list(map(memo.get, words))
        return np.array(got, np.float64)


def marginals(emission: np.ndarray, first: np.ndarray, steps: np.ndarray, width: int = 64) -> np.ndarray:
    """Probability of the toxic tag at each word; ``first`` marks words that begin a document."""
    return expectations(emission, first, steps, width, False)[0]


def expectations(emission: np.ndarray, first: np.ndarray, steps: np.ndarray, width: int = 64, full: bool = True) -> tuple[np.ndarray, ...]:
    """(p, clean, pairs): of each word the probability of the toxic tag; with ``full`` also the log probability
    that it is clean if all before it are, and the probabilities of (clean, toxic), (toxic, clean), (toxic,
    toxic) at it and the word before.

    The words' 2x2 step matrices compose, so rows of ``width`` words are multiplied side by side, the
    rows are chained, and then each row runs from its own entry; a document's first word forgets what
    stood before it and follows a clean start.
    """
    n = len(emission)
    if not n:
        return np.zeros(0), np.zeros(0), np.zeros((0, 3))
    rows = -(-n // width)
    psi = np.ones((rows * width, 2))
    psi[:n, 1] = np.exp(np.clip(emission, -50, 50))
    resets = np.ones(rows * width, bool)  # what follows the last word tells nothing about it
    resets[:n] = first
    move = np.exp(steps)
    step = np.where(resets[:, None, None], move[None, :1], move[None]) * psi[:, None, :]
    step = np.ascontiguousarray(step.reshape(rows, width, 2, 2).transpose(1, 0, 2, 3))

    def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = a[..., :, :1] * b[..., :1, :] + a[..., :, 1:] * b[..., 1:, :]
        return out / out.sum((-1, -2), keepdims=True)

    whole = step[0]
    for i in range(1, width):
        whole = product(whole, step[i])
    # entry vectors of the rows, forward and backward: products of all rows before and after, by doubling
    before = after = whole
    reach = 1
    while reach < rows:
        before = np.concatenate((before[:reach], product(before[:-reach], before[reach:])))
        after = np.concatenate((product(after[:-reach], after[reach:]), after[-reach:]))
        reach *= 2
    enter, leave = np.full((rows, 2), 0.5), np.full((rows, 2), 0.5)
    enter[1:] = before[:-1].sum(1)
    leave[:-1] = after[1:].sum(2)
    enter /= enter.sum(1, keepdims=True)
    leave /= leave.sum(1, keepdims=True)
    ahead = np.empty((width + 1, rows, 2))
    ahead[0] = enter
    for i in range(width):
        enter = enter[:, :1] * step[i][:, 0] + enter[:, 1:] * step[i][:, 1]
        enter /= enter.sum(1, keepdims=True)
        ahead[i + 1] = enter
    p = np.empty((width, rows))
    clean, pairs = (np.empty((width, rows)), np.empty((width, rows, 3))) if full else (None, None)
    for i in range(width - 1, -1, -1):
        both = ahead[i + 1] * leave
        p[i] = both[:, 1] / both.sum(1)
        if full:
            out = step[i] * leave[:, None, :]
            clean[i] = np.log(out[:, 0, 0]) - np.log(out[:, 0].sum(1))
            out *= ahead[i][:, :, None]
            pairs[i] = out.reshape(-1, 4)[:, 1:] / out.sum((1, 2))[:, None]
        leave = step[i][:, :, 0] * leave[:, :1] + step[i][:, :, 1] * leave[:, 1:]
        leave /= leave.sum(1, keepdims=True)
    p = p.T.ravel()[:n]
    if not full:
        return p, None, None
    pairs = pairs.transpose(1, 0, 2).reshape(-1, 3)[:n]
    pairs[first] = np.stack((p[first], np.zeros(int(first.sum())), np.zeros(int(first.sum()))), 1)
    return p, clean.T.ravel()[:n], pairs


def begins(docs: list) -> tuple[np.ndarray, np.ndarray]:
    """(lengths, whether each word is a document's first)."""
    lengths = np.fromiter(map(len, docs), np.int64, len(docs))
    first = np.zeros(int(lengths.sum()), bool)
    first[(np.cumsum(lengths) - lengths)[lengths > 0]] = True
    return lengths, first


def likelihood(emission: np.ndarray, lengths: np.ndarray, first: np.ndarray, steps: np.ndarray, toxic: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Log likelihood of documents' labels (none is empty), and its slopes in each word's emission and in the
    steps clean to toxic, toxic to clean and toxic to toxic."""
    p, clean, pairs = expectations(emission, first, steps)
    at = np.cumsum(lengths) - lengths
    all_clean = np.minimum(np.add.reduceat(clean, at), -1e-9)
    some = np.log(-np.expm1(all_clean))
    pull = np.where(toxic == 1, np.exp(np.minimum(all_clean - some, 3.0)), -1.0)  # a cap on one document's pull
    by_word = np.repeat(pull, lengths)
    return float(np.where(toxic == 1, some, all_clean).sum()), by_word * p, by_word @ pairs


def fit_chain(corpus: Corpus, chosen: np.ndarray) -> Chain:
    """Weights and transitions by stochastic gradient ascent (Adam) on the likelihood of the labels of the
    ``chosen`` documents, all their words, in a fixed order, so it can be repeated.  A small sample is passed
    over more often: there are STEPS * PASSES steps at least."""
    odds = corpus.log_odds(chosen)
    kept = np.flatnonzero(odds > CLEAR)
    place = np.full(len(corpus.names), -1)
    place[kept] = np.arange(len(kept))
    own = place[corpus.feature]
    word, own = corpus.word[own >= 0], own[own >= 0]
    #: constant, three steps, then the features
    theta = np.concatenate(([-4.0, -1.0, 0.0, 1.0], BEGIN * odds[kept]))
    mean, square, turn = np.zeros(len(theta)), np.zeros(len(theta)), 0
    docs = chosen[[len(corpus.docs[i]) > 0 for i in chosen.tolist()]] if len(chosen) else chosen
    words = sum(len(corpus.docs[i]) for i in docs.tolist())
    size = max(LEAST, words // STEPS)
    if len(kept):
        for run in range(PASSES * STEPS // max(1, min(STEPS, words // size))):
            order = docs[np.random.default_rng(run).permutation(len(docs))]
            ends = np.cumsum([len(corpus.docs[i]) for i in order.tolist()])
            for part in np.split(order, np.flatnonzero(np.diff(ends // size)) + 1):
                lengths, first = begins([corpus.docs[i] for i in part.tolist()])
                flat = np.concatenate([corpus.docs[i] for i in part.tolist()])
                emission = theta[0] + np.bincount(word, theta[4:][own], minlength=corpus.words)
                _, by_word, by_step = likelihood(emission[flat], lengths, first, np.array([[0.0, theta[1]], theta[2:4]]), corpus.toxic[part])
                total = np.bincount(flat, by_word, minlength=corpus.words)
                slope = np.concatenate(([total.sum()], by_step, np.bincount(own, total[word], minlength=len(kept)))) / len(part) - DECAY * theta
                turn += 1
                mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope**2
                theta = theta + SPEED * (mean / (1 - 0.9**turn)) / (np.sqrt(square / (1 - 0.99**turn)) + 1e-6)
    else:  # nothing tells toxic documents from others: the toxic tag is unlikely everywhere
        theta[0] = -8.0
    return Chain({corpus.names[f]: float(w) for f, w in zip(kept.tolist(), theta[4:].tolist(), strict=True)}, float(theta[0]), np.array([[0.0, theta[1]], theta[2:4]]))


def document_features(p: np.ndarray, first: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Constant, log of the expected toxic words, their largest probability, and their density."""
    out = np.zeros((len(lengths), 4))
    out[:, 0] = 1
    has = lengths > 0
    if len(p):
        at = (np.cumsum(lengths) - lengths)[has]
        total = np.add.reduceat(p, at)
        out[has, 1] = np.log1p(total)
        out[has, 2] = np.maximum.reduceat(p, at)
        out[has, 3] = np.minimum(5.0, 100 * total / np.maximum(lengths[has], 30))
    return out


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.5) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hess = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        w = w + np.linalg.solve(hess, x.T @ (y - p) - ridge * w)
    return w


def evaluate(chain: Chain, docs: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    lengths, first = begins(docs)
    p = marginals(chain.emissions([w for d in docs for w in d]), first, chain.steps)
    return p, document_features(p, first, lengths)


class Model:
    def __init__(self, chain: Chain, weights: np.ndarray) -> None:
        self.chain, self.weights = chain, weights

    def score(self, docs: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """Score of each document, and the marginal of each word."""
        p, x = evaluate(self.chain, docs)
        return 1 / (1 + np.exp(-np.clip(x @ self.weights, -30, 30))), p


def fit(texts: list[bytes], toxic: np.ndarray) -> Model:
    """The field and the document weights; the latter are fitted on halves scored by the other's field."""
    corpus, half = Corpus(texts, toxic), np.arange(len(texts)) % 2
    xs, ys = [], []
    for k in (0, 1):
        a, b = np.flatnonzero(half == k), np.flatnonzero(half != k)
        if len(a) and len(b):
            chain = fit_chain(corpus, a)
            emission = corpus.emissions(chain)
            for at in range(0, len(b), 300):
                docs = [corpus.docs[i] for i in b[at : at + 300].tolist()]
                lengths, first = begins(docs)
                xs.append(document_features(marginals(emission[np.concatenate(docs)], first, chain.steps), first, lengths))
                ys.append(toxic[b[at : at + 300]])
    weights = fit_logistic(np.concatenate(xs), np.concatenate(ys).astype(float)) if xs else np.array([-3.0, 1, 1, 1])
    return Model(fit_chain(corpus, np.arange(len(texts))), weights)


def held_out(column) -> Column:
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, most: int = BYTES) -> Model:
    """Fit on at most ``sample`` labelled rows outside the held-out fold and ``most`` bytes of text, chosen by a
    hash of doc_id.  Repeated rows of a doc_id count once: their smallest text, and toxic if any label says so."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id")).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"), F.max("toxic").alias("toxic"))
    # at most `sample` rows are ordered here
    before = F.sum(F.octet_length("text").cast("long")).over(W.orderBy(F.xxhash64("doc_id"), "doc_id"))
    rows = rows.withColumn("_before", before).where(F.col("_before") <= most).select("doc_id", "text", "toxic").toArrow().sort_by([("doc_id", "ascending")])
    return fit([t.encode() for t in rows["text"].to_pylist()], rows["toxic"].to_numpy().astype(int))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, n_toxic_words, spans for every row of ``docs`` (doc_id, text).

    ``spans`` lists the words whose marginal is at least 1/2 as start:end in code points.  A null or
    empty text has the score of a document without toxic words; a null doc_id is not held out; repeated
    rows and equal texts score alike, in any order.  A text of any length is scored whole; other columns are
    not read; an empty table gives no row.  Without usable labels a fixed prior field is used.
    """
    model = train(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast((model.chain.weights, model.chain.constant, model.chain.steps, model.weights))
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("n_toxic_words", pa.int64()), ("spans", pa.string())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, constant, steps, own = shared.value
        fitted = Model(Chain(weights, constant, steps), own)
        for batch in batches:
            ids, texts = batch.column(0), as_bytes(batch.column(1))
            for a, b in slices(batch, texts):
                words = [tokens(t) for t in texts[a:b]]
                scores, p = fitted.score(words)
                ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
                hits = np.flatnonzero(p >= 0.5)
                of = np.searchsorted(ends, hits, "right")
                marks: dict[int, set[int]] = {}
                for h, i in zip(hits.tolist(), of.tolist(), strict=True):
                    marks.setdefault(i, set()).add(h - int(ends[i]) + len(words[i]))
                spans = [offsets(texts[a + i], marks[i]) if i in marks else "" for i in range(b - a)]
                yield record(schema, (ids[a:b], scores, [len(marks.get(i, ())) for i in range(b - a)], spans))

    out = docs.select("doc_id", "text").mapInArrow(score, "doc_id long, score double, n_toxic_words long, spans string")
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_toxic_words", "spans")


def offsets(text: bytes, chosen: set[int]) -> str:
    """start:end in code points of the words with these numbers."""
    out, at, points = [], 0, 0
    for i, m in enumerate(_WORD.finditer(text)):
        if i in chosen:
            points += len(text[at : m.start()].decode())
            size = len(m[0].decode())
            out.append(f"{points}:{points + size}")
            points, at = points + size, m.end()
    return ",".join(out)
