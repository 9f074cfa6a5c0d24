"""The WebP reader on streams with every feature, and exact round trips of the column."""

import base64
import cProfile
import hashlib
import os
import random
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from conftest import DATA

from tarn.llm import media, queries
from tarn.llm.media import CROSS_COLOUR, PALETTE, PREDICTOR, SUBTRACT_GREEN, Writer


def encode(pixels, width, height, *, transforms=(), cache_bits=0, groups=1, copies=True, seed=0):
    """A plain encoder of ARGB pixels for tests: any transforms, a colour cache, copies, code groups."""
    rng = random.Random(seed)
    out = Writer()
    for value, n in ((0x2F, 8), (width - 1, 14), (height - 1, 14), (1, 1), (0, 3)):
        out.put(value, n)
    wide = width
    pixels = np.array(pixels, np.uint32)
    for kind in transforms:
        out.put(1, 1)
        out.put(kind, 2)
        if kind == SUBTRACT_GREEN:
            green = pixels >> 8 & 255
            pixels = (pixels & 0xFF00FF00) | ((pixels >> 16) - green & 255) << 16 | (pixels - green & 255)
        elif kind in (PREDICTOR, CROSS_COLOUR):
            block = 2
            side, tall = -(-wide // 4), -(-height // 4)
            out.put(block - 2, 3)
            if kind == PREDICTOR:
                table = np.array([0xFF000000 | (i % 14) << 8 for i in range(side * tall)], np.uint32)
                source = pixels.tolist()
                left = []
                for i, p in enumerate(source):
                    g = media.predicted(source, i, wide, table, block, side)
                    left.append(sum(((p >> s & 255) - (g >> s & 255) & 255) << s for s in (0, 8, 16, 24)))
                pixels = np.array(left, np.uint32)
            else:
                table = np.array([0xFF000000 | rng.randrange(1 << 24) for _ in range(side * tall)], np.uint32)
                pixels = media.cross_colour(pixels, wide, table, block, side, False)
            entropy(out, table, side, 0, None, False, rng)
        else:
            colours = np.unique(pixels)
            out.put(len(colours) - 1, 8)
            parts = colours.view(np.uint8).reshape(-1, 4)
            entropy(out, np.diff(parts, axis=0, prepend=np.zeros((1, 4), np.uint8)).astype(np.uint8).copy().view(np.uint32).ravel(), len(colours), 0, None, False, rng)
            fold = 3 if len(colours) <= 2 else 2 if len(colours) <= 4 else 1 if len(colours) <= 16 else 0
            index = np.searchsorted(colours, pixels).reshape(height, wide)
            packed_width = -(-wide // (1 << fold))
            padded = np.zeros((height, packed_width << fold), np.uint32)
            padded[:, :wide] = index
            shifts = np.arange(1 << fold, dtype=np.uint32) * (8 >> fold)
            pixels = 0xFF000000 | (padded.reshape(height, packed_width, -1) << shifts).sum(2).astype(np.uint32).ravel() << 8
            wide = packed_width
    out.put(0, 1)
    entropy(out, pixels, wide, cache_bits, groups, copies, rng)
    return media.riff(out.bytes())


def entropy(out, pixels, width, cache_bits, groups, copies, rng):
    """``groups`` None: an image inside a transform, which has no code groups of its own."""
    pixels = np.array(pixels, np.uint32).tolist()
    out.put(1 if cache_bits else 0, 1)
    if cache_bits:
        out.put(cache_bits, 4)
    height = len(pixels) // width
    which = [0] * len(pixels)
    if groups is not None:
        out.put(1 if groups > 1 else 0, 1)
        if groups > 1:
            out.put(0, 3)
            side, tall = -(-width // 4), -(-height // 4)
            table = [rng.randrange(groups) for _ in range(side * tall)]
            table[0] = groups - 1
            entropy(out, [0xFF000000 | t << 8 for t in table], side, 0, None, False, rng)
            which = [table[(i // width // 4) * side + i % width // 4] for i in range(len(pixels))]
    near = {}
    for code, (dx, dy) in enumerate(media.distance_map(), 1):
        near.setdefault(max(1, dy * width + dx), code)
    cache, ops, i = {}, [], 0
    shift = 32 - cache_bits
    remember = lambda p: cache.__setitem__((p * media.CACHE_FACTOR & 0xFFFFFFFF) >> shift, p) if cache_bits else None
    while i < len(pixels):
        match = None
        if copies and i:
            for d in {1, width, rng.randrange(1, i + 1), rng.randrange(1, i + 1)}:
                n = 0
                while d <= i and i + n < len(pixels) and n < 300 and pixels[i + n] == pixels[i + n - d]:
                    n += 1
                if n >= 2 and (match is None or n > match[0]):
                    match = (n, d)
        key = (pixels[i] * media.CACHE_FACTOR & 0xFFFFFFFF) >> shift if cache_bits else None
        if match:
            n, d = match
            ops.append((which[i], "copy", n, near.get(d, d + 120)))
            for p in pixels[i : i + n]:
                remember(p)
            i += n
        else:
            ops.append((which[i], "cache", key, 0) if cache_bits and cache.get(key) == pixels[i] else (which[i], "pixel", pixels[i], 0))
            remember(pixels[i])
            i += 1

    def prefixed(v):
        v -= 1
        if v < 4:
            return v, 0, 0
        n = v.bit_length() - 2
        return 2 * n + 2 + (v >> n & 1), v & (1 << n) - 1, n

    sizes = (280 + (1 << cache_bits if cache_bits else 0), 256, 256, 256, 40)
    counts = [[np.zeros(s, int) for s in sizes] for _ in range(groups or 1)]
    for g, kind, a, b in ops:
        if kind == "pixel":
            for c, v in zip(counts[g], (a >> 8 & 255, a >> 16 & 255, a & 255, a >> 24), strict=False):
                c[v] += 1
        elif kind == "cache":
            counts[g][0][280 + a] += 1
        else:
            counts[g][0][256 + prefixed(a)[0]] += 1
            counts[g][4][prefixed(b)[0]] += 1
    codes = []
    for own in counts:
        lengths = [media.code_lengths(c, 15) for c in own]
        for x in lengths:
            media.write_prefix(out, x)
        codes.append([(media.canonical(x), x if np.count_nonzero(x) > 1 else np.zeros_like(x)) for x in lengths])
    for g, kind, a, b in ops:
        send = lambda k, v: out.put(int(codes[g][k][0][v]) if codes[g][k][1][v] else 0, int(codes[g][k][1][v]))  # noqa: B023, E731
        if kind == "pixel":
            for k, v in enumerate((a >> 8 & 255, a >> 16 & 255, a & 255, a >> 24)):
                send(k, v)
        elif kind == "cache":
            send(0, 280 + a)
        else:
            for k, v in ((0, a), (4, b)):
                symbol, rest, n = prefixed(v)
                send(k, (256 if k == 0 else 0) + symbol)
                out.put(rest, n)


def picture(width, height, colours, seed):
    rng = random.Random(seed)
    palette = [rng.randrange(1 << 32) for _ in range(colours)]
    pixels = []
    while len(pixels) < width * height:
        pixels += [rng.choice(palette)] * rng.choice([1, 1, 1, 2, 9])
    return np.array(pixels[: width * height], np.uint32)


CASES = [
    {}, {"copies": False}, {"cache_bits": 4}, {"cache_bits": 10, "groups": 3}, {"groups": 4},
    {"transforms": (PREDICTOR,)}, {"transforms": (CROSS_COLOUR,)}, {"transforms": (SUBTRACT_GREEN,)},
    {"transforms": (PREDICTOR, CROSS_COLOUR, SUBTRACT_GREEN), "cache_bits": 6, "groups": 2},
    {"transforms": (SUBTRACT_GREEN, PREDICTOR), "copies": False},
]


@pytest.mark.parametrize("case", CASES)
@pytest.mark.parametrize(("width", "height"), [(1, 1), (7, 5), (33, 21), (1, 40), (64, 3)])
def test_reader(case, width, height):
    for colours in (1, 2, 5, 200):
        pixels = picture(width, height, colours, width)
        assert media.decode(encode(pixels, width, height, **case))[2].tolist() == pixels.tolist()


@pytest.mark.parametrize("colours", [1, 2, 3, 4, 11, 16, 17, 200])
def test_palettes(colours):
    pixels = picture(29, 13, colours, colours)
    for more in ({}, {"cache_bits": 3}):
        assert media.decode(encode(pixels, 29, 13, transforms=(PALETTE,), **more))[2].tolist() == pixels.tolist()


#: Fixed values of the format: the short distances as its specification lists them.
SHORT = """0,1 1,0 1,1 -1,1 0,2 2,0 1,2 -1,2 2,1 -2,1 2,2 -2,2 0,3 3,0 1,3 -1,3 3,1 -3,1 2,3 -2,3 3,2 -3,2 0,4 4,0 1,4 -1,4 4,1 -4,1 3,3 -3,3
2,4 -2,4 4,2 -4,2 0,5 3,4 -3,4 4,3 -4,3 5,0 1,5 -1,5 5,1 -5,1 2,5 -2,5 5,2 -5,2 4,4 -4,4 3,5 -3,5 5,3 -5,3 0,6 6,0 1,6 -1,6 6,1 -6,1
2,6 -2,6 6,2 -6,2 4,5 -4,5 5,4 -5,4 3,6 -3,6 6,3 -6,3 0,7 7,0 1,7 -1,7 5,5 -5,5 7,1 -7,1 4,6 -4,6 6,4 -6,4 2,7 -2,7 7,2 -7,2 3,7 -3,7
7,3 -7,3 5,6 -5,6 6,5 -6,5 8,0 4,7 -4,7 7,4 -7,4 8,1 8,2 6,6 -6,6 8,3 5,7 -5,7 7,5 -7,5 8,4 6,7 -6,7 7,6 -7,6 8,5 7,7 -7,7 8,6 8,7"""


def test_short_distances():
    assert media.distance_map() == [tuple(map(int, x.split(","))) for x in SHORT.split()]


def test_a_file_of_a_public_encoder():
    """The one-pixel file by which web pages ask whether a browser reads lossless WebP: a transparent pixel by a palette."""
    width, height, pixels = media.decode(base64.b64decode("UklGRhoAAABXRUJQVlA4TA0AAAAvAAAAEAcQERGIiP4HAA=="))
    assert (width, height, pixels.tolist()) == (1, 1, [0])


def kinds(data):
    """Transforms of a file up to the first that holds an image of its own, in the order written."""
    bits, out = media.Bits(data[20:]), []
    bits.read(40)
    while bits.read(1):
        out.append(bits.read(2))
        if out[-1] != SUBTRACT_GREEN:
            break
    return out


def chosen(monkeypatch, pixels, width):
    """(transforms, copies, places of the cache) of what the writer makes of the pixels, which must come back."""
    met = []
    own = media.symbols

    def spy(bits, codes, total):
        met.append(own(bits, codes, total))
        return met[-1]

    monkeypatch.setattr(media, "symbols", spy)
    data = media.encode(pixels, width)
    assert media.decode(data)[2].tolist() == pixels.tolist()
    monkeypatch.setattr(media, "symbols", own)
    s = met[-1][0]
    return kinds(data), int(((s >= 256) & (s < 280)).sum()), int((s >= 280).sum())


def test_the_writer_chooses_by_content(monkeypatch):
    rng = np.random.default_rng(5)
    pack = lambda b, g, r, a: (np.stack((b, g, r, a), 1) & 255).astype(np.uint8).copy().view(np.uint32).ravel()
    i = np.arange(64 * 64)
    noise = lambda n: rng.integers(0, n, len(i))
    smooth = pack(i // 9 + noise(2), i // 11 + noise(2), i // 13 + noise(2), i * 0 + 255)
    assert chosen(monkeypatch, smooth, 64)[0][0] == PREDICTOR
    grey = noise(200)
    assert chosen(monkeypatch, pack(grey, grey, grey, noise(256)), 64)[0] == [SUBTRACT_GREEN]
    half = (grey.astype(np.int8).astype(np.int64) * 16) >> 5
    assert CROSS_COLOUR in chosen(monkeypatch, pack(noise(200), grey, half + noise(2), noise(256)), 64)[0]
    few = rng.integers(0, 1 << 32, 12, dtype=np.uint32)
    assert chosen(monkeypatch, few[rng.integers(0, 12, len(i))], 64)[0] == [PALETTE]
    fresh, again = rng.integers(0, 1 << 32, len(i), dtype=np.uint32), rng.integers(0, 1 << 32, 60, dtype=np.uint32)
    assert chosen(monkeypatch, np.where(noise(3) == 0, fresh, again[noise(60)]), 64)[2] > 100
    once = rng.integers(0, 1 << 32, 1000, dtype=np.uint32)
    transforms, copied, _ = chosen(monkeypatch, np.concatenate((once, once, once[:48])), 64)
    assert transforms == [] and 0 < copied <= 4


@pytest.mark.parametrize("seed", range(6))
def test_any_pixels_come_back(seed):
    rng = random.Random(seed)
    for _ in range(25):
        width, height = rng.choice([1, 2, 7, 16, 64]), rng.randrange(1, 40)
        pixels = picture(width, height, rng.choice([1, 2, 3, 16, 17, 200, 5000]), rng.random())
        assert media.decode(media.encode(pixels, width))[2].tolist() == pixels.tolist()


def test_query_reads_copies_cache_and_palettes(monkeypatch):
    """On the texts of the test table the writer chooses all that the README says it does on prose."""
    met, own = [], media.symbols
    monkeypatch.setattr(media, "symbols", lambda *a: met.append(own(*a)) or met[-1])
    found = set()
    for t in pq.read_table(f"{DATA}/documents.parquet")["text"].to_pylist():
        found.update(kinds(media.store(t.encode() + b"\0" * (-len(t.encode()) % 64 or (0 if t else 64)))))
        media.load(media.store(t.encode() + b"\0" * (-len(t.encode()) % 64 or (0 if t else 64))))
    symbol = np.concatenate([m[0] for m in met])
    assert PALETTE in found and ((symbol >= 256) & (symbol < 280)).any() and (symbol >= 280).any()


@pytest.mark.parametrize("payload", [b"\0" * 64, bytes(range(256)), os.urandom(64 * 9), b"ab" * 3200, b"a" * 64 * 4096 + b"b" * 128])
def test_payloads(payload):
    assert media.load(media.store(payload)) == payload


def test_broken_files():
    good = media.store(b"x" * 64)
    for bad in (b"", b"RIFF", b"JUNK" + good[4:], good[:20] + b"\0" + good[21:]):
        with pytest.raises(ValueError):
            media.decode(bad)


def test_lengths_are_limited():
    counts = np.array([1, 1, *(2**i for i in range(1, 40))])
    for most in (7, 12, 15):
        lengths = media.code_lengths(counts, most)
        assert lengths.max() <= most and sum(2.0**-x for x in lengths.tolist()) == 1.0


def expected(d, t):
    raw = (t or "").encode()
    padded = raw + b"\0" * (-len(raw) % 64 or (0 if raw else 64))
    return d, len(raw), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-64:])


def test_column(spark):
    rows = [(1, "text"), (2, None), (3, ""), (4, "same"), (5, "same"), (5, "same"), (None, "é" * 32), (6, "long " * 30000)]
    df = spark.createDataFrame([(d, t, "clash") for d, t in rows], "doc_id long, text string, feature string")
    got = media.media_columns(df, keep_media=True).collect()
    assert sorted((tuple(r)[:5] for r in got), key=str) == sorted((expected(d, t) for d, t in rows), key=str)
    for r in got:
        assert hashlib.sha256(r["media"]).hexdigest() == r["media_sha256"] and len(r["media"]) == r["media_bytes"]
    assert len({tuple(r)[1:] for r in got if r["doc_id"] in (4, 5)}) == 1
    assert media.media_columns(df.limit(0)).collect() == []


def test_query(spark):
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    assert sorted(tuple(r)[:5] for r in queries.op9_media(spark, DATA).collect()) == sorted(expected(d, t) for d, t in texts)


def payloads_of_many_kinds():
    rng = np.random.default_rng(3)
    texts = [t.encode() for t in pq.read_table(f"{DATA}/documents.parquet")["text"].to_pylist()[:150]]
    i = np.arange(64 * 64)
    smooth = np.stack([i // k + rng.integers(0, 2, len(i)) for k in (9, 11, 13, 5000)], 1).astype(np.uint8).tobytes()
    grey = np.repeat(rng.integers(0, 256, 4096).astype(np.uint8), 4).tobytes()
    other = [b"", b"a", b"ab" * 3200, smooth, grey, os.urandom(6400), os.urandom(700) * 9, b"x" * 64 * 4100, bytes(range(256)) * 30]
    return [t + b"\0" * (-len(t) % 64 or (0 if t else 64)) for t in [*other, *texts]]


def test_images_written_side_by_side_are_those_written_alone(monkeypatch):
    payloads = payloads_of_many_kinds()
    alone = [media.store(p) for p in payloads]
    assert [media.load(m) for m in alone] == payloads
    assert media.store_many(payloads) == alone and media.store_many([]) == []
    assert media.store_many(payloads[::-1]) == alone[::-1]
    monkeypatch.setattr(media, "GROUP", 7)
    monkeypatch.setattr(media, "STEP_BYTES", 5000)
    assert media.store_many(payloads) == alone
    found = {k for m in alone for k in kinds(m)}
    assert {PALETTE, PREDICTOR} <= found


def test_screen_lets_no_transform_through():
    """What would be transformed is never taken for an image without transforms."""
    images = [np.frombuffer(p, "<u4") for p in payloads_of_many_kinds() if len(p) <= 64 * 4096]
    for pixels, may in zip(images, media.may_transform(images, 16).tolist(), strict=True):
        outs, inner = [Writer()], []
        left, width = media.transformed(outs, inner, pixels, 16)
        assert may or (outs[0].size == 0 and not inner and width == 16 and left is pixels)


def test_writing_takes_few_calls_a_text():
    """The writer's cost is that of its calls: those of a text alone were 2,900."""
    payloads = payloads_of_many_kinds()[9:]
    media.store_many(payloads)
    profile = cProfile.Profile()
    profile.runcall(media.store_many, payloads)
    assert sum(x.callcount for x in profile.getstats()) < 500 * len(payloads)


@pytest.mark.parametrize("most", [7, 15])
def test_trees_side_by_side(most):
    rng = np.random.default_rng(most)
    counts = rng.integers(0, 30, (60, 19)) * (rng.random((60, 19)) < rng.random((60, 1)))
    counts[:4] = 0
    counts[1, 3] = 9
    counts[2, [0, 18]] = 1
    counts[5] = 2 ** np.arange(19)  # too deep for either
    assert np.array_equal(media.code_lengths_many(counts, most), [media.code_lengths(c, most) for c in counts])


@pytest.mark.parametrize("seed", range(20))
def test_resolving_is_that_of_a_plain_loop(seed):
    """Copies that overlap, places of the cache after copies, and places that are read before they are written."""
    rng = random.Random(seed)
    cache_bits, width = 4, 7
    symbol, pixels, lengths, distances, out, held = [], [], [], [], [], [0] * 16
    for k in range(300):
        kind = rng.choice(["pixel", "pixel", "place", "copy"]) if k else "pixel"
        x, n, d = 0, 1, 0
        if kind == "pixel":
            x = rng.choice([rng.randrange(1 << 32), 5 << 8, 77 << 8])
            symbol.append(x >> 8 & 255)
            now = lambda: x  # noqa: B023, E731
        elif kind == "place":
            # every third seed also reads places that nothing was written to
            place = rng.randrange(16) if seed % 3 == 0 else rng.choice([p * media.CACHE_FACTOR % 2**32 >> 28 for p in out])
            symbol.append(280 + place)
            now = lambda: held[place]  # noqa: B023, E731
        else:
            n, d = rng.randrange(1, 9), rng.randrange(1, 200)
            dx, dy = media.distance_map()[min(d, 120) - 1]
            back = d - 120 if d > 120 else max(1, dy * width + dx)
            if back > len(out):
                d, back = 121, 1
            symbol.append(258)
            now = lambda: out[-back]  # noqa: B023, E731
        pixels.append(x)
        lengths.append(n)
        distances.append(d)
        for _ in range(n):
            out.append(now())
            held[(out[-1] * media.CACHE_FACTOR & 0xFFFFFFFF) >> 28] = out[-1]
    got = media.resolve(*(np.array(v, t) for v, t in ((symbol, np.int64), (pixels, np.uint32), (lengths, np.int64), (distances, np.int64))), width, cache_bits)
    assert got.tolist() == out


def test_files_read_side_by_side_are_those_read_alone(monkeypatch):
    payloads = payloads_of_many_kinds()
    stored = media.store_many(payloads)
    assert media.load_many(stored) == payloads and media.load_many([]) == []
    files, want = [], []
    for k, case in enumerate([*CASES, {"transforms": (PALETTE,), "cache_bits": 3}] * 2):
        width, height = [(1, 1), (33, 21), (64, 3)][k % 3]
        want.append(picture(width, height, 5 if "transforms" in case and PALETTE in case["transforms"] else 200, k).tolist())
        files.append(encode(want[-1], width, height, **case))
    assert [x.tolist() for x in media.decode_many(files)] == want
    monkeypatch.setattr(media, "GROUP", 3)
    assert [x.tolist() for x in media.decode_many(files)] == want
    monkeypatch.setattr(media, "STEP_BYTES", 5000)
    assert media.load_many(stored) == payloads
    for bad in (stored[20][: len(stored[20]) // 2], stored[20][:30]):
        with pytest.raises(ValueError):
            media.load_many([stored[0], bad])


def test_query_reader_meets_copies_cache_and_palettes(monkeypatch, spark):
    met, undone, own, before = [], [], media.symbols, media.undone
    monkeypatch.setattr(media, "symbols", lambda *a: met.append(own(*a)) or met[-1])
    monkeypatch.setattr(media, "undone", lambda *a: undone.append(a[3]) or before(*a))
    texts = [t.encode() for t in pq.read_table(f"{DATA}/documents.parquet")["text"].to_pylist()]
    payloads = [t + b"\0" * (-len(t) % 64 or (0 if t else 64)) for t in texts]
    assert media.load_many(media.store_many(payloads)) == payloads
    symbol = np.concatenate([m[0] for m in met])
    assert ((symbol >= 256) & (symbol < 280)).any() and (symbol >= 280).any()
    assert any(x and x[0][0] == PALETTE for x in undone)


def told(out, lengths, limited):
    """A prefix code told with repeats of the last length, and by a count of tokens if ``limited``."""
    tokens, i, last = [], 0, 8
    while i < len(lengths):
        n = 1
        while i + n < len(lengths) and lengths[i + n] == lengths[i]:
            n += 1
        if lengths[i] == 0 and n >= 3:
            n = min(n, 138)
            tokens.append((17, n - 3, 3) if n < 11 else (18, n - 11, 7))
        elif lengths[i] == last and n >= 3:
            n = min(n, 6)
            tokens.append((16, n - 3, 2))
        else:
            n = 1
            tokens.append((lengths[i], 0, 0))
        last = lengths[i] or last
        i += n
    if limited:
        while tokens[-1][0] in (0, 17, 18):
            tokens.pop()
    own = np.array([4] * 13 + [5] * 6)
    codes = media.canonical(own)
    for value, n in ((0, 1), (15, 4), *((int(own[k]), 3) for k in media.LENGTH_ORDER), (1 if limited else 0, 1)):
        out.put(value, n)
    if limited:
        out.put(4, 3)
        out.put(len(tokens) - 2, 10)
    for kind, more, n in tokens:
        out.put(int(codes[kind]), int(own[kind]))
        out.put(more, n)


def test_prefix_codes_read_side_by_side():
    rng = random.Random(1)
    images, alone, ends = [], [], []
    for k in range(40):
        out, cache = Writer(), rng.choice([0, 1, 6])
        out.put(0, k % 7)
        sizes = (280 + (1 << cache if cache else 0), 256, 256, 256, 40)
        for size in sizes:
            counts = np.array([rng.choice([0, 0, 1, 4, rng.randrange(1, 9000)]) for _ in range(size)])
            kind = rng.randrange(5)
            counts[rng.randrange(3, size) :] = 0
            if kind == 0:
                out.put(1 | 1 << 1 | 1 << 2 | 7 << 3 | 30 << 11, 19)  # two symbols
            elif kind == 1:
                out.put(1 | 1 << 3, 4)  # one, of a bit
            elif kind == 2 or np.count_nonzero(counts) < 3:
                media.write_prefix(out, media.code_lengths(counts, 15))
            else:
                told(out, media.code_lengths(counts, 15).tolist(), kind == 3)
        out.put(k, 6)
        one, other = media.Bits(out.bytes()), media.Bits(out.bytes())
        one.at = other.at = k % 7
        images.append((other, cache))
        alone.append([media.read_prefix(one, size) for size in sizes])
        ends.append(one.at)
    for own, other in zip(alone, media.read_prefixes(images), strict=True):
        for a, b in zip(own, other, strict=True):
            assert a.top == b.top and a.symbols.tolist() == b.symbols.tolist() and a.bits.tolist() == b.bits.tolist()
    assert [bits.at for bits, _ in images] == ends
