"""Token counts, byte-level encoding and packing against the public libraries and brute force."""

import base64
import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from conftest import DATA
from tokenizers import Tokenizer

from tarn.llm import bpe, queries, tokens
from tarn.llm.common import Scratch

WORD, BYTE = public_tokenizers.path(queries.WORD_BPE), public_tokenizers.path(queries.BYTE_BPE)
PARTS = ["'", "s", "t", "re", "ve", "ll", "d", "'S", " ", "  ", "\n", "\t", "é", "ß", "中文", "٣", "1", "23", "!", "--", "<|endoftext|>", "\x1c", "\xa0", "\x85", "İ", "Σ", "ς", "ﬁ", "👍🏽", "é", "Ᲊ", "a", "B", "ǅ", "\0"]


def odd_texts(n=400):
    rng = random.Random(7)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randrange(40))) for _ in range(n)] + ["", "=" * 3000, "ab" * 2000, " " * 700, "x" * 900]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORD)


@pytest.fixture(scope="module")
def encoding():
    with open(BYTE, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_word_ids_equal_the_library(library):
    texts = odd_texts()
    for t, ids in zip(texts, bpe.word_bpe(WORD).encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(t, add_special_tokens=False).ids, t


def test_byte_ids_equal_the_library(encoding):
    own, texts = bpe.byte_bpe(BYTE, public_tokenizers.PATTERN), odd_texts()
    for t, ids in zip(texts, own.encode(texts), strict=True):
        assert ids.tolist() == encoding.encode_ordinary(t), t
        assert own.decode(ids) == t.encode()


def merged(symbols, table):
    """One merge at a time: the leftmost of the lowest-ranked pairs."""
    out = list(symbols)
    while True:
        ranked = [(table[p][0], i) for i, p in enumerate(zip(out, out[1:])) if p in table]  # noqa: B905
        if not ranked:
            return out
        i = min(ranked)[1]
        out[i : i + 2] = [table[out[i], out[i + 1]][1]]


def test_merging_equals_one_merge_at_a_time():
    own, rng = bpe.byte_bpe(BYTE, public_tokenizers.PATTERN), random.Random(1)
    for letters in (b"ab", b"abcdef", b"=-", bytes(range(97, 123))):
        batch = [own.single[np.array([rng.choice(letters) for _ in range(rng.randrange(0, 400))], int)] for _ in range(20)]
        ragged = bpe.merge_all(np.concatenate(batch), np.array([len(x) for x in batch]), own.pairs)
        assert [np.frombuffer(x, "<u4").tolist() for x in ragged] == [merged(x.tolist(), own.pairs.table) for x in batch]


def test_merging_in_any_order_of_ranks():
    """Tables in which a merge makes pairs of lower rank, which no trained table has."""
    rng = random.Random(2)
    for _ in range(300):
        size = rng.randrange(2, 7)
        made = [(rng.randrange(size), rng.randrange(size), rng.randrange(size, 2 * size)) for _ in range(rng.randrange(1, 8))]
        made += [(rng.randrange(2 * size), rng.randrange(2 * size), rng.randrange(2 * size, 3 * size)) for _ in range(rng.randrange(1, 12))]
        pairs, ranks = {(a, b): c for a, b, c in made}, list(range(40))
        rng.shuffle(ranks)
        table = {k: (ranks[i], c) for i, (k, c) in enumerate(pairs.items())}
        batch = [np.array([rng.randrange(size) for _ in range(rng.randrange(0, 30))], np.int64) for _ in range(6)]
        ragged = bpe.merge_all(np.concatenate(batch), np.array([len(x) for x in batch]), bpe.Pairs(table))
        assert [np.frombuffer(x, "<u4").tolist() for x in ragged] == [merged(x.tolist(), table) for x in batch]


def test_long_runs_take_few_rounds(encoding):
    own, rng = bpe.byte_bpe(BYTE, public_tokenizers.PATTERN), random.Random(3)
    for t in ("=" * 300_001, "ab" * 100_000, "".join(rng.choice("abcdefgh") for _ in range(20_000))):
        ids = own.encode([t])[0]
        assert own.decode(ids) == t.encode()
        if len(t) < 50_000:
            assert ids.tolist() == encoding.encode_ordinary(t)


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 4096, 5000])
def test_the_scan_equals_one_pass(n):
    inputs = np.random.default_rng(n).integers(0, 9, n).astype(np.uint8)
    assert bpe.scan(inputs).tolist() == bpe.scan(inputs, max(1, n)).tolist()


ROWS = [(1, "Hello world it's"), (2, None), (3, ""), (3, "tie tie"), (3, "tie tie"), (None, "no id"), (4, "long " * 5000), (5, "ünï çödé 中 <|endoftext|>")]


def frame(spark, rows=ROWS):
    return spark.createDataFrame([(d, t, "en", f"src{(d or 0) % 2}", 0, "clash", "clash") for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long, n_tokens string, _n string")


def test_token_counts(spark, library):
    got = sorted(map(tuple, tokens.token_counts(frame(spark), WORD).collect()), key=str)
    expected = []
    for d, t in ROWS:
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        expected.append((d, len((t or "").encode()), n, n > 2048))
    assert got == sorted(expected, key=str)
    assert tokens.token_counts(frame(spark, []), WORD).collect() == []


def test_byte_encoding(spark, encoding):
    df = tokens.byte_encode(frame(spark), BYTE, public_tokenizers.PATTERN, keep_ids=True)
    got = sorted(map(tuple, df.collect()), key=str)
    expected = []
    for d, t in ROWS:
        ids, raw = encoding.encode_ordinary(t or ""), (t or "").encode()
        at = np.cumsum([0, *(len(encoding.decode_single_token_bytes(i)) for i in ids)])[:-1].tolist()
        expected.append((d, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(raw).hexdigest(), ids, at if ids else []))
    assert got == sorted(expected, key=str)


def test_queries_cover_their_whole_table(spark, library, encoding):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    got = {r["doc_id"]: r for r in queries.op3_token_counts(spark, DATA).collect()}
    assert {d: r["n_tokens"] for d, r in got.items()} == {d: len(library.encode(t, add_special_tokens=False).ids) for d, t in texts.items()}
    got = {r["doc_id"]: r for r in queries.op4_byte_bpe(spark, DATA).collect()}
    assert {d: r["n_tokens"] for d, r in got.items()} == {d: len(encoding.encode_ordinary(t)) for d, t in texts.items()}


def check_packing(pieces, ids_of, sequence):
    """Pieces tile every document and every sequence; all sequences but the last are full."""
    by_doc, by_seq = {}, {}
    for p in pieces:
        by_doc.setdefault(p["doc_id"], []).append(p)
        by_seq.setdefault(p["sequence_id"], []).append(p)
    for d, ids in ids_of.items():
        at = 0
        for p in sorted(by_doc[d], key=lambda p: p["start"]):
            assert p["start"] == at and p["length"] > 0 and p["doc_tokens"] == len(ids)
            assert p["ids_crc32"] == zlib.crc32(np.array(ids[at : at + p["length"]], "<u4").tobytes())
            at += p["length"]
        assert at == len(ids)
    assert sorted(by_seq) == list(range(len(by_seq)))
    for s, own in by_seq.items():
        at = 0
        for p in sorted(own, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at == sequence or s == len(by_seq) - 1 and at <= sequence


def test_packing_query(spark, library):
    pieces = [r.asDict() for r in queries.op8_packing(spark, DATA).collect()]
    ids = {r["doc_id"]: [*library.encode(r["text"] or "", add_special_tokens=False).ids, queries.END] for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    check_packing(pieces, ids, 4096)


def test_packing_follows_the_mixture(spark, library):
    rows = [(i, "word " * (20 + i % 7)) for i in range(600)] + [(900, None), (901, "")]
    docs = spark.createDataFrame([(d, t, None if d == 901 else "big" if d % 3 else "small") for d, t in rows], "doc_id long, text string, source string")
    ids = {d: [*library.encode(t or "", add_special_tokens=False).ids, 2] for d, t in rows}
    kind = {d: None if d == 901 else "big" if d % 3 else "small" for d, _ in rows}
    for weights in (None, {"big": 0.5, "small": 0.5}):
        out = tokens.pack(docs.repartition(5), WORD, 2, Scratch(spark, "test"), weights, sequence=64, window=256, carry=("source",), temperature=1.0)
        pieces = [r.asDict() for r in out.collect()]
        check_packing(pieces, ids, 64)
        assert all(p["source"] == kind[p["doc_id"]] for p in pieces)
        total = sum(map(len, ids.values()))
        share = sum(len(ids[d]) for d in ids if kind[d] == "small") / total if weights is None else 0.5
        early = [p for p in pieces if p["sequence_id"] < 100]
        assert abs(sum(p["length"] for p in early if p["source"] == "small") / sum(p["length"] for p in early) - share) < 0.03
    assert tokens.pack(docs.limit(0), WORD, 2, Scratch(spark, "test")).collect() == []


def round_robin(sizes, given, window):
    """Deficit round-robin, window by window: what each queue has sent after each window.  A queue that runs
    dry leaves at the end of its window; the others' deficits then start anew."""
    left, deficit, sent = dict(sizes), {s: Fraction(0) for s in sizes}, {s: [0] for s in sizes}
    while live := [s for s in sizes if left[s]]:
        whole = sum(given[s] for s in live)
        for s in sizes:
            out = 0
            if s in live:
                deficit[s] += Fraction(window * given[s], whole)
                out = min(left[s], int(deficit[s]))
                deficit[s] -= out
                left[s] -= out
            sent[s].append(sent[s][-1] + out)
        if any(not left[s] for s in live):
            deficit = {s: Fraction(0) for s in sizes}
    return sent


def test_mixture_equals_a_round_robin():
    rng = random.Random(12)
    for _ in range(40):
        sizes = {str(i): rng.randrange(1, 4000) for i in range(rng.randrange(1, 7))}
        weights = {s: rng.random() + 0.01 for s in sizes}
        mix = tokens.Mixture(sizes, weights, 100)
        given = {s: max(1, round(w * (1 << 20))) for s, w in weights.items()}
        sent = round_robin(sizes, given, 100)
        for s in sizes:
            assert [mix.total(s, w) for w in range(mix.windows + 1)] == sent[s]


def test_long_texts_and_clashing_columns(spark, library):
    rows = [(1, "word " * 9000, "a"), (2, "=" * 20_000, "a"), (3, "other <|endoftext|> " * 4000, "b")]
    docs = spark.createDataFrame([(d, t, s, d * 10, "x") for d, t, s in rows], "doc_id long, text string, source string, start long, _n string")
    ids = {d: [*library.encode(t, add_special_tokens=False).ids, 2] for d, t, _ in rows}
    got = tokens.pack(docs, WORD, 2, Scratch(spark, "test"), carry=("start", "_n", "source"))
    assert got.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "_start", "_n", "source"]
    pieces = [r.asDict() for r in got.collect()]
    check_packing(pieces, ids, 4096)
    assert all(p["_start"] == p["doc_id"] * 10 and p["_n"] == "x" for p in pieces)


def test_mixture_pays_every_token_once():
    rng = random.Random(2)
    for _ in range(40):
        sizes = {str(i): rng.randrange(0, 5000) for i in range(rng.randrange(1, 8))}
        mix = tokens.Mixture(sizes, rng.choice([None, {s: rng.random() for s in sizes}]), 100)
        for s, n in sizes.items():
            if n:
                totals = [mix.total(s, w) for w in range(mix.windows + 1)]
                assert totals == sorted(totals) and totals[0] == 0 and totals[-1] == n
                for x in {0, n - 1, n // 2}:
                    w = mix.at(s, x)
                    assert totals[w] <= x < totals[w + 1]
