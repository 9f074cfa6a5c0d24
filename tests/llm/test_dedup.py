"""N-gram Jaccard join and substring dedup against brute force, and their SQL."""

import hashlib
import random

import numpy as np
import pytest
from conftest import DATA, same_rows

from tarn.llm import jaccard, queries, substrings
from tarn.llm.common import Scratch
from tarn.llm.components import components
from tarn.llm.fmindex import FmIndex


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute_components(rows):
    sets = [(d, shingles(t)) for d, t in rows]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (_, a) in enumerate(sets):
        for j, (_, b) in enumerate(sets[:i]):
            both = len(a & b)
            if a and b and 100 * both >= 75 * (len(a) + len(b) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(sets):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(((d, len(s), least.get(find(i))) for i, (d, s) in enumerate(sets)), key=str)


def near_copies(seed, groups=12, most=14, length=60, noise=3):
    """Groups of near copies around the threshold, exact copies, a passage that all share, short texts."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    passage = [f"p{i}" for i in range(25)]
    texts = []
    for _ in range(groups):
        base = [rng.choice(words) for _ in range(length)]
        if rng.random() < 0.5:
            base[10:10] = passage
        for _ in range(rng.randrange(1, most)):
            t = list(base)
            for _ in range(rng.randrange(noise)):
                t[rng.randrange(len(t))] = rng.choice(words)
            texts.append(" ".join(t).title() if rng.random() < 0.3 else "  ".join(t))
    texts += [None, "", " \t\n", "a", "A", "a b c d", "a b c d e", "A B C D E", "no break", "É é", "é É"]
    rows = [(i, t) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    own = [f"z{i}" for i in range(80)]
    rows += [(None, " ".join(own)), (None, " ".join(["new", *own[1:]])), (None, " ".join([*own[:-1], "end"]))]
    return [*rows, rows[0], rows[0], (None, rows[1][1])]


def frame(spark, rows):
    return spark.createDataFrame([(d, t, 1, "x", "y") for d, t in rows], "doc_id long, text string, n long, cid string, _text string")


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(spark, seed):
    rows = near_copies(seed)
    got = jaccard.near_components(frame(spark, rows).repartition(3), Scratch(spark, "test"))
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got.collect()), key=str) == brute_components(rows)


def test_common_shingles_change_nothing(spark, monkeypatch):
    """Everything that occurs twice is common here, so the hub rounds and what follows do all the work."""
    monkeypatch.setattr(jaccard, "MET", 1)
    monkeypatch.setattr(jaccard, "COMMON", 2)
    monkeypatch.setattr(jaccard, "VERIFY", 500)
    monkeypatch.setattr(jaccard, "BLOCK", 40)
    monkeypatch.setattr(jaccard, "CHUNK", 15)
    rows = near_copies(3, groups=8, noise=6)
    got = jaccard.near_components(frame(spark, rows), Scratch(spark, "test"))
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got.collect()), key=str) == brute_components(rows)


def held_excerpts(seed, clusters=8, copies=6):
    """Excerpts of 75 to 82 % of the size of longer texts.  The longer ones of a cluster are alike to the
    excerpt only, and much of their prefixes is their own, so shingles of the excerpt's prefix are in their suffixes."""
    rng, known, texts = random.Random(seed), jaccard.WordHashes(), []
    for c in range(clusters):
        base = [f"c{c}w{i}" for i in range(84)]
        size = rng.randrange(98, 107)
        texts.append(" ".join(base))
        short = set(jaccard.shingle_sets([texts[-1].encode()], known)[0].tolist())
        most = 0 if c % 2 else 8
        while len(texts) % (copies + 1):
            t = " ".join([*base, *(f"e{rng.randrange(1 << 40)}" for _ in range(size - 80))])
            prefix = jaccard.shingle_sets([t.encode()], known)[0][: jaccard.prefix_size(size)].tolist()
            if len(set(prefix) - short) >= most:
                texts.append(t)
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("met", [3, 1])
def test_excerpts_of_larger_texts_are_found(spark, monkeypatch, met):
    monkeypatch.setattr(jaccard, "MET", met)
    monkeypatch.setattr(jaccard, "COMMON", 16 if met == 3 else 2)
    rows = held_excerpts(5)
    got = jaccard.near_components(frame(spark, rows), Scratch(spark, "test"))
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got.collect()), key=str) == brute_components(rows)


@pytest.mark.parametrize("common", [16, 2])
def test_short_variants(spark, monkeypatch, common):
    """Many classes with one prefix and size, of which some are alike and others not."""
    monkeypatch.setattr(jaccard, "MET", 1)
    monkeypatch.setattr(jaccard, "COMMON", common)
    rng, texts = random.Random(6), []
    for b in range(25):
        base = [f"b{b}w{i}" for i in range(rng.randrange(11, 30))]
        for v in range(12):
            t = list(base)
            for _ in range(rng.randrange(1, 3)):
                t[rng.choice([0, 1, 2, -1, -2, -3])] = f"v{rng.randrange(4)}"
            texts.append(" ".join(t))
    rows = list(enumerate(texts))
    scratch = Scratch(spark, "test")
    made = []
    monkeypatch.setattr(jaccard, "_inside_pairs", lambda *a, own=jaccard._inside_pairs: made.append(own(*a)) or made[-1])
    got = jaccard.near_components(frame(spark, rows), scratch)
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got.collect()), key=str) == brute_components(rows)
    assert len(made) == 1


def template(n, own=16, words=84):
    """Documents of one template and some words of their own: many shared shingles, no two alike."""
    base = [f"t{i}" for i in range(words)]
    return [(i, " ".join([*base, *(f"d{i}x{j}" for j in range(own))])) for i in range(n)]


def test_documents_of_one_template_are_not_paired(spark):
    rows = template(300)
    scratch, sizes = Scratch(spark, "test"), []
    own = jaccard.apart_pairs

    def count(rest, few, s):
        sizes.append(rest.count())
        return own(rest, few, s)

    jaccard.apart_pairs = count
    try:
        got = jaccard.near_components(frame(spark, rows), scratch).collect()
    finally:
        jaccard.apart_pairs = own
    assert sizes == [0] and all(r["component_id"] == r["doc_id"] for r in got)


def test_very_long_texts(spark):
    rng = random.Random(8)
    long = [f"w{rng.randrange(9000)}" for _ in range(60_000)]
    rows = [(1, " ".join(long)), (2, " ".join([*long[:55_000], "end"])), (3, " ".join(long[:20_000])), (4, "x" * 200_000), (5, "x" * 200_000)]
    got = jaccard.near_components(frame(spark, rows), Scratch(spark, "test"))
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got.collect()), key=str) == brute_components(rows)
    cuts = substrings.dedup_digests(frame(spark, rows), Scratch(spark, "test"))
    assert sorted(map(tuple, cuts.collect()), key=str) == brute_cuts(rows)


def test_no_documents(spark):
    assert jaccard.near_components(frame(spark, []), Scratch(spark, "test")).collect() == []
    assert jaccard.near_components(frame(spark, [(1, None)]), Scratch(spark, "test")).drop("class_id").collect() == [(1, 0, 1)]


@pytest.mark.parametrize("name", ["op1_ngram_jaccard", "op2_substrings"])
def test_queries_equal_their_sql(spark, duck, name):
    same_rows(queries.queries()[name](spark, DATA), duck.sql(queries.oracle_sql()[name]))


def test_contracted_components(spark):
    rng = random.Random(4)
    links = [(i, i + 1) for i in range(0, 60)] + [(rng.randrange(100, 200), rng.randrange(100, 200)) for _ in range(60)] + [(300, 300)]
    mixed = {i: rng.randrange(1 << 40) for i in range(400)}
    df = spark.createDataFrame([(mixed[a], mixed[b]) for a, b in links], "a long, b long")
    got = dict(map(tuple, components(df, Scratch(spark, "test"), "c").collect()))
    assert len({got[mixed[i]] for i in range(61)}) == 1
    for a, b in links:
        if a != b:
            assert got[mixed[a]] == got[mixed[b]]
    assert len(set(got.values())) == len({frozenset(k for k in got if got[k] == v) for v in set(got.values())})


# ---------------------------------------------------------------------------------- substrings


def occurrences(sequences, owners, depth):
    """The smallest owner of each stretch of up to ``depth`` words."""
    best = {}
    for s, w in zip(sequences, owners, strict=True):
        for n in range(1, depth + 1):
            for i in range(len(s) - n + 1):
                k = tuple(s[i : i + n])
                best[k] = min(best.get(k, w), w)
    return best


def joined(sequences):
    return np.array([x for s in sequences for x in s], np.int64), np.array([len(s) for s in sequences], np.int64)


@pytest.mark.parametrize("depth", [2, 3, 5, 8])
def test_streams_that_the_index_does_not_hold(depth):
    rng = random.Random(depth)
    for _ in range(40):
        kinds = rng.choice([2, 5, 30])
        draw = lambda least, most: [[rng.randrange(kinds) for _ in range(rng.randrange(least, 25))] for _ in range(rng.randrange(most))]  # noqa: B023, E731
        held, asked = draw(1, 12), draw(0, 8)
        number: dict[int, int] = {}
        numbered = [[number.setdefault(x, len(number)) for x in s] for s in held]
        asked = [*asked, *(s[:3] + [99] + s[3:] for s in held[:2])]  # 99 is in no sequence of the index
        owners = [rng.randrange(-5, 50) for _ in held]
        matched, owner = FmIndex(*joined(numbered), np.array(owners, np.int64), depth).stream(*joined([[number.get(x, -1) for x in s] for s in asked]))
        best, at = occurrences(held, owners, depth), 0
        for s in asked:
            longest = [max((n for n in range(1, min(depth, len(s) - i) + 1) if tuple(s[i : i + n]) in best), default=0) for i in range(len(s))]
            last = next((i for i in range(len(s)) if any(n == depth for n in longest[: i + 1])), len(s))  # before it nothing may be told
            for i, n in enumerate(longest):
                assert matched[at] == n or i < last and matched[at] == 0
                assert n < depth or owner[at] == best[tuple(s[i : i + depth])]
                at += 1


def test_an_index_is_smaller_than_a_suffix_array():
    rng = np.random.default_rng(3)
    flat = rng.integers(0, 4000, 200_000)
    flat[100_000:] = flat[:100_000]
    flat = np.unique(flat, return_inverse=True)[1]
    index = FmIndex(flat, np.full(2000, 100), np.arange(2000), 50)
    size = sum(x.nbytes for t in (index.tree, index.owner) for x in [*t.words, *t.before, t.first]) + index.shared.shared.nbytes + index.shared.low.nbytes + sum(x.nbytes for x in index.shared.places) + index.below.nbytes + index.names.nbytes
    assert size < 1.05 * 8 * len(flat)


def brute_cuts(rows, window=50):
    first = {}
    split = [(d, (t or "").encode().split()) for d, t in rows]
    for d, w in split:
        for i in range(len(w) - window + 1):
            if d is not None:
                k = tuple(w[i : i + window])
                first[k] = min(first.get(k, d), d)
    out = []
    for d, w in split:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if d is not None and first[tuple(w[i : i + window])] < d:
                gone[i : i + window] = [True] * window
        kept = [x for x, g in zip(w, gone, strict=True) if not g]
        out.append((d, len(w), sum(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(out, key=str)


def passages(seed):
    rng = random.Random(seed)
    word = lambda: f"v{rng.randrange(4000)}"
    shared = [[word() for _ in range(rng.choice([49, 50, 51, 70, 160]))] for _ in range(6)]
    rows = []
    for i in range(60):
        w = [word() for _ in range(rng.randrange(0, 90))]
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(w) + 1)
            w[at:at] = rng.choice(shared)
        rows.append((i, " ".join(w)))
    rows += [(100, "tick " * 300), (101, "tick " * 120), (102, "tick tock " * 200), (103, None), (104, ""), (105, "tock tick " * 90), (106, rows[5][1]), (107, rows[5][1])]
    rng.shuffle(rows)
    return [*rows, rows[0], (None, rows[3][1]), (None, "tick " * 200)]


@pytest.mark.parametrize("seed", [1, 2])
def test_cuts_equal_brute_force(spark, seed):
    rows = passages(seed)
    got = substrings.dedup_digests(frame(spark, rows).repartition(3), Scratch(spark, "test"))
    assert sorted(map(tuple, got.collect()), key=str) == brute_cuts(rows)


def test_hot_minimizers_are_merged(spark, monkeypatch):
    monkeypatch.setattr(substrings, "HOT", 2)
    monkeypatch.setattr(substrings, "SHARD", 5)
    rows = passages(3)
    got = substrings.dedup_digests(frame(spark, rows), Scratch(spark, "test"))
    assert sorted(map(tuple, got.collect()), key=str) == brute_cuts(rows)


def test_cut_texts(spark):
    rows = passages(4)
    df = frame(spark, rows)
    got = substrings.dedup_texts(df, Scratch(spark, "test"))
    assert got.columns == df.columns
    digest = lambda t: hashlib.sha256(b" ".join((t or "").encode().split())).hexdigest()
    assert sorted(((r["doc_id"], digest(r["text"])) for r in got.collect()), key=str) == sorted(((d, h) for d, _, _, h in brute_cuts(rows)), key=str)
    whole = {d for d, _, n, _ in brute_cuts(rows) if n == 0}
    assert {(d, t) for d, t in rows if d in whole} <= {(r["doc_id"], r["text"]) for r in got.collect()}
    assert substrings.dedup_texts(frame(spark, []), Scratch(spark, "test")).collect() == []


def test_untouched_texts_keep_their_white_space(spark):
    rows = [(1, " a  b\n\nc "), (2, "x " * 60 + "\n\n own  words"), (3, "lead  in\n" + "x " * 60 + "tail\tend ")]
    got = dict((r["doc_id"], r["text"]) for r in substrings.dedup_texts(frame(spark, rows), Scratch(spark, "test")).collect())
    assert got == {1: rows[0][1], 2: rows[1][1], 3: "lead  in\ntail\tend "}
