"""Media columns: payloads as lossless WebP images, written and read back here.

The reader is a whole VP8L decoder: prefix codes, back-references, colour cache, several code groups,
and the predictor, cross-colour, subtract-green and palette transforms.  Where one code group holds for
all pixels, symbols are found without a loop: the length of the symbol that would start at each bit is
looked up for all bits at once, and the chain of true starts is followed by pointer doubling.

The writer takes four bytes of a payload as a pixel, and the transforms, copies and cache that its
estimates say make the image smaller.

``store_many`` and ``load_many`` take many images side by side, as most are so small that an array operation costs
more than its elements; each image comes out as it would alone.
"""

from __future__ import annotations

import hashlib
import heapq
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import STEP_BYTES, as_bytes, record, slices

#: Bytes of an image's row (four a pixel), and rows of an image at most; longer payloads take several images.
WIDTH, HEIGHT = 64, 4096
#: Images that are written side by side at most.
GROUP = 512
# Fixed values of the format.
LENGTH_ORDER = (17, 18, 0, 1, 2, 3, 4, 5, 16, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15)
PREDICTOR, CROSS_COLOUR, SUBTRACT_GREEN, PALETTE = range(4)
CACHE_FACTOR = 0x1E35A7BD
ZEROS = [[0] * n for n in range(139)]


@lru_cache(maxsize=1)
def distance_map() -> list[tuple[int, int]]:
    """(dx, dy) of the 120 short distance codes: pixels above or left of the current one, nearest first;
    at equal distance the more vertical come first, and of a mirrored pair the left one."""
    near = [(dx, dy) for dy in range(8) for dx in range(-7, 9) if dy > 0 or dx > 0]
    return sorted(near, key=lambda p: (p[0] ** 2 + p[1] ** 2, abs(p[0]), -p[0]))


class Bits:
    """Bits of a byte string, least significant first."""

    def __init__(self, data: bytes) -> None:
        self.value, self.at, self.data = 0, 0, data
        self.size = len(data) * 8

    def peek(self, n: int) -> int:
        a, b = self.at >> 3, (self.at + n + 7) >> 3
        return int.from_bytes(self.data[a:b], "little") >> (self.at & 7) & ((1 << n) - 1)

    def read(self, n: int) -> int:
        got = self.peek(n)
        self.at += n
        return got


class Prefix:
    """A canonical prefix code with a flat lookup table of 2**top entries."""

    def __init__(self, lengths: np.ndarray) -> None:
        used = lengths.nonzero()[0]
        self.top = 0
        if len(used) <= 1:  # one symbol takes no bits
            self.symbols, self.bits = np.array([used[0] if len(used) else 0], np.int64), np.zeros(1, np.int64)
            return
        own = lengths.take(used)
        order = own.astype(np.int8).argsort(kind="stable")
        own = own.take(order)
        self.top = top = int(own[-1])
        spans = np.left_shift(1, top - own)
        if spans.sum() != 1 << top:
            raise ValueError("prefix code is not complete")
        # canonical codes count up from the left; the stream has them with their first bit lowest
        table = (used.take(order) << 4 | own).repeat(spans).take(turned(top))
        self.symbols, self.bits = table >> 4, table & 15

    def read(self, bits: Bits) -> int:
        if not self.top:
            return int(self.symbols[0])
        at = bits.at
        v = bits.read(self.top)
        bits.at = at + int(self.bits[v])
        return int(self.symbols[v])


@lru_cache(maxsize=1)
def backward() -> np.ndarray:
    """Each number of 15 bits with its bits in reverse order."""
    values = np.arange(1 << 15)
    return sum(((values >> i) & 1) << (14 - i) for i in range(15))


@lru_cache(maxsize=16)
def turned(n: int) -> np.ndarray:
    """Each number of ``n`` bits with its bits in reverse order."""
    return np.ascontiguousarray(backward()[:: 1 << (15 - n)])


@lru_cache(maxsize=1 << 12)
def short_prefix(lengths: tuple[int, ...]) -> tuple[int, list[tuple[int, int]]]:
    """(bits looked at, symbol and size by these bits) of the code that code lengths are told in."""
    code = Prefix(np.array(lengths, np.int64))
    return code.top, list(zip(code.symbols.tolist(), code.bits.tolist(), strict=True))


def read_prefix(bits: Bits, size: int) -> Prefix:
    lengths = np.zeros(size, np.int64)
    if bits.read(1):
        n = bits.read(1) + 1
        lengths[bits.read(8 if bits.read(1) else 1)] = 1
        if n == 2:
            lengths[bits.read(8)] = 1
        return Prefix(lengths)
    many = 4 + bits.read(4)
    told, own = bits.read(3 * many), [0] * 19
    for s in LENGTH_ORDER[:many]:
        own[s] = told & 7
        told >>= 3
    (top, table), left = short_prefix(tuple(own)), size
    if bits.read(1):
        left = 2 + bits.read(2 + 2 * bits.read(3))
    # a token takes 14 bits at most: those ahead are held as one number
    mask, found, last, at, ahead, begin = (1 << top) - 1, [], 8, 0, 0, 0
    add, start = found.append, bits.at
    held = min(224, bits.size)
    while len(found) < size and left:
        left -= 1
        if at - begin > held - 14 or not at:
            bits.at, begin = start + at, at
            ahead = bits.peek(held)
        s, n = table[ahead & mask]
        ahead >>= n
        if s < 16:
            add(s)
            last = s or last
        elif s == 17:
            found += ZEROS[3 + (ahead & 7)]
            n, ahead = n + 3, ahead >> 3
        elif s == 18:
            found += ZEROS[11 + (ahead & 127)]
            n, ahead = n + 7, ahead >> 7
        else:
            found += [last] * (3 + (ahead & 3))
            n, ahead = n + 2, ahead >> 2
        at += n
    bits.at = start + at
    lengths[: len(found)] = found[:size]
    return Prefix(lengths)


#: Of each symbol of the code that code lengths are told in: its length, how many lengths it tells, and extra bits of that.
TOLD, RUN, RUN_BITS = np.array([*range(16), 0, 0, 0]), np.array([1] * 16 + [3, 3, 11]), np.array([0] * 16 + [2, 3, 7])


def read_prefixes(images: list[tuple[Bits, int]]) -> list[list[Prefix]]:
    """The five prefix codes of images, given their bits and those of their colour cache: ``read_prefix`` of all images
    side by side, a token of each at a step."""
    chunks = [bits.data[bits.at >> 3 :] + bytes(16) for bits, _ in images]
    if not images:
        return []
    data = b"".join(chunks) + bytes(16)
    words = np.empty(len(data) - 8 & ~7, np.int64)  # 64 bits from each byte on
    for k in range(8):
        words[k::8] = np.frombuffer(data, "<i8", len(words) // 8, k)
    ends = np.cumsum([len(x) for x in chunks])
    start = (ends - [len(x) for x in chunks]) * 8 + [bits.at & 7 for bits, _ in images]

    def look(at: np.ndarray) -> np.ndarray:
        """At least 57 bits from these on."""
        return words.take(at >> 3, mode="clip") >> (at & 7)

    at, found = start, []
    for sizes in (280 + np.array([1 << n if n else 0 for _, n in images]), *(np.full(len(images), n) for n in (256, 256, 256, 40))):
        lengths, at = read_lengths(look, at, sizes)
        found.append(prefixes(lengths))
    if (at > ends * 8 - 128).any():
        raise ValueError("the image ends early")
    for (bits, _), n in zip(images, (at - start).tolist(), strict=True):
        bits.at += n
    return [list(own) for own in zip(*found, strict=True)]


def read_lengths(look, at: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code lengths by row, place after them) of a prefix code at each place; ``look`` shows the bits from places on."""
    lengths, after = np.zeros((len(at), int(sizes.max())), np.int64), np.zeros(len(at), np.int64)
    first = look(at)
    short = np.flatnonzero(first & 1)
    if len(short):  # one or two symbols by their numbers
        w = first[short]
        n = np.where(w & 4, 8, 1)
        lengths[short, w >> 3 & (1 << n) - 1] = 1
        after[short] = at[short] + 3 + n
        two = short[w & 2 > 0]
        lengths[two, look(after[two]) & 255] = 1
        after[two] += 8
    row = np.flatnonzero(first & 1 == 0)
    if not len(row):
        return lengths, after
    many, at = 4 + (first[row] >> 1 & 15), at[row] + 5
    own = np.zeros((len(row), 19), np.int64)
    own[:, LENGTH_ORDER] = np.where(np.arange(19) < many[:, None], look(at)[:, None] >> np.arange(0, 57, 3) & 7, 0)
    at = at + 3 * many
    limited = look(at) & 1
    at, left = at + 1, sizes[row].copy()
    if limited.any():
        some = np.flatnonzero(limited)
        n = 2 + 2 * (look(at[some]) & 7)
        at[some] += 3
        left[some] = 2 + (look(at[some]) & (1 << n) - 1)
        at[some] += n
    # each row's table of 7 bits
    who, symbol = np.nonzero(own)
    size = own[who, symbol]
    order = np.argsort(who * 8 + size, kind="stable")
    who, symbol, size = who[order], symbol[order], size[order]
    size = np.where(np.bincount(who, minlength=len(row))[who] == 1, 0, size)
    spans = 128 >> size
    if (np.bincount(who, spans, minlength=len(row)) != 128).any():
        raise ValueError("prefix code is not complete")
    table = (symbol << 3 | size).repeat(spans).reshape(-1, 128)[:, turned(7)].ravel()
    repeats, wide = own[:, 16].any(), lengths.shape[1]
    flat, k, end = lengths.ravel(), row * wide, row * wide + sizes[row]
    entry, last = np.arange(len(row)) * 128, np.full(len(row), 8)
    while len(row):
        w = look(at)
        told = table.take(entry + (w & 127))
        size, told = told & 7, told >> 3
        flat[k] = TOLD.take(told)
        more = RUN_BITS.take(told)
        run = RUN.take(told) + (w >> size & (1 << more) - 1)
        if repeats:
            for i in np.flatnonzero(told == 16).tolist():
                flat[k[i] : min(k[i] + run[i], end[i])] = last[i]
            last = np.where((told > 0) & (told < 16), told, last)
        k += run
        at += size
        at += more
        left -= 1
        over = (k >= end) | (left <= 0)
        if over.any():
            after[row[over]] = at[over]
            keep = np.flatnonzero(~over)
            row, at, k, end, entry, last, left = (x[keep] for x in (row, at, k, end, entry, last, left))
    return lengths, after


def prefixes(lengths: np.ndarray) -> list[Prefix]:
    """``Prefix`` of each row of code lengths, their tables made together."""
    many = len(lengths)
    row, symbol = np.nonzero(lengths)
    own = lengths[row, symbol]
    used = np.bincount(row, minlength=many)
    order = np.argsort(row * 16 + own, kind="stable")
    row, symbol, own = row[order], symbol[order], own[order]
    own = np.where(used[row] == 1, 0, own)  # one symbol takes no bits
    top = np.zeros(many, np.int64)
    top[row] = own  # the last and longest of each row
    spans = 1 << top[row] - own
    if (np.bincount(row, spans, minlength=many) != np.where(used > 0, 1 << top, 0)).any():
        raise ValueError("prefix code is not complete")
    sizes = np.where(used > 0, 1 << top, 0)
    starts = np.cumsum(sizes) - sizes
    # canonical codes count up from the left; the stream has them with their first bit lowest
    begin, by = np.repeat(starts, sizes), np.repeat(15 - top, sizes)
    place = np.arange(len(begin)) - begin
    table = (symbol << 4 | own).repeat(spans).take(begin + backward().take(place << by))
    symbols, bits, none = table >> 4, table & 15, np.zeros(1, np.int64)
    found = []
    for a, n, t in zip(starts.tolist(), sizes.tolist(), top.tolist(), strict=True):
        code = Prefix.__new__(Prefix)
        code.top, code.symbols, code.bits = t, symbols[a : a + n] if n else none, bits[a : a + n] if n else none
        found.append(code)
    return found


def extra(bits: Bits, symbol: int) -> int:
    """Value of a length or distance symbol with its extra bits."""
    if symbol < 4:
        return symbol + 1
    n = (symbol - 2) >> 1
    return ((2 + (symbol & 1)) << n) + bits.read(n) + 1


def read_pixels(bits: Bits, width: int, height: int, main: bool) -> np.ndarray:
    """ARGB pixels of an entropy-coded image, as uint32."""
    cache_bits, codes, blocks = read_codes(bits, width, height, main)
    if blocks is None:
        return resolve(*symbols(bits, codes[0], width * height), width, cache_bits)
    return read_groups(bits, width, height, cache_bits, codes, *blocks)


def read_codes(bits: Bits, width: int, height: int, main: bool) -> tuple[int, list[list[Prefix]], tuple | None]:
    """(bits of the colour cache, groups of five codes, what block takes which group unless there is one for all)."""
    cache_bits = bits.read(4) if bits.read(1) else 0
    cache = 1 << cache_bits if cache_bits else 0
    groups, blocks = 1, None
    if main and bits.read(1):
        block = bits.read(3) + 2
        side = (width + (1 << block) - 1) >> block
        which = (read_pixels(bits, side, (height + (1 << block) - 1) >> block, False) >> 8) & 0xFFFF
        groups = int(which.max()) + 1
        blocks = (which, block, side) if groups > 1 else None
    return cache_bits, [[read_prefix(bits, n) for n in (280 + cache, 256, 256, 256, 40)] for _ in range(groups)], blocks


def read_groups(bits: Bits, width: int, height: int, cache_bits: int, codes: list[list[Prefix]], which: np.ndarray, block: int, side: int) -> np.ndarray:
    """Pixels of an image whose blocks have codes of their own."""
    cache = 1 << cache_bits if cache_bits else 0
    out, at, total = np.zeros(width * height, np.uint32), 0, width * height
    held, near = [0] * cache, distance_map()
    shift = 32 - cache_bits
    while at < total:
        g = codes[int(which[((at // width) >> block) * side + ((at % width) >> block)])]
        s = g[0].read(bits)
        first = at
        if s < 256:
            red, blue, alpha = g[1].read(bits), g[2].read(bits), g[3].read(bits)
            out[at] = alpha << 24 | red << 16 | s << 8 | blue
            at += 1
        elif s < 280:
            n = extra(bits, s - 256)
            d = extra(bits, g[4].read(bits))
            if d > 120:
                d -= 120
            else:
                dx, dy = near[d - 1]
                d = max(1, dy * width + dx)
            for i in range(min(n, total - at)):
                out[at + i] = out[at + i - d]
            at = min(total, at + n)
        else:
            out[at] = held[s - 280]
            at += 1
        if cache:
            for x in out[first:at].tolist():
                held[(x * CACHE_FACTOR & 0xFFFFFFFF) >> shift] = x
    return out


def extras(symbol: np.ndarray) -> np.ndarray:
    """Extra bits of length and distance symbols."""
    return np.where(symbol < 4, 0, (symbol - 2) >> 1)


def valued(symbol: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """Values of length and distance symbols with their extra bits."""
    return np.where(symbol < 4, symbol, ((2 + (symbol & 1)) << extras(symbol)) + rest) + 1


def symbols(bits: Bits, codes: list[Prefix], total: int) -> tuple[np.ndarray, ...]:
    """(green symbols, pixels, lengths, distance codes) of ``total`` pixels, all symbols at once.

    A symbol below 256 is a pixel, one below 280 a copy with a length and a distance code, another is a
    place of the cache.
    """
    start = bits.at
    begin = start & 7
    data = np.frombuffer(bits.data[start >> 3 :] + b"\0\0\0\0", np.uint8).astype(np.int64)
    words = data[:-3] | data[1:-2] << 8 | data[2:-1] << 16 | data[3:] << 24
    n = len(words) * 8
    seen = np.zeros(n + 128, np.int64)  # the longest symbol may start at the last bit
    for k in range(8):
        np.right_shift(words, k, out=seen[k:n:8])

    def look(code: Prefix, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbol and size of what a code reads at these bits."""
        key = seen.take(at) & ((1 << code.top) - 1)
        return code.symbols.take(key), code.bits.take(key)

    key = seen & ((1 << codes[0].top) - 1)
    green = codes[0].symbols.take(key)
    after = np.arange(len(seen))
    after += codes[0].bits.take(key)
    step = after = after[:n]
    green = green[:n]
    for code in codes[1:4]:  # red, blue and alpha follow green
        if code.top:
            key = seen.take(step)
            key &= (1 << code.top) - 1
            step = step + code.bits.take(key)
    others = codes[0].symbols.max() >= 256
    if others:
        step = np.where(green < 256, step, after)
        copy = np.flatnonzero((codes[0].symbols >= 256) & (codes[0].symbols < 280))
        copy = np.flatnonzero((green >= 256) & (green < 280)) if len(copy) else copy
    if others and len(copy):
        at = after[copy] + extras(green[copy] - 256)
        symbol, size = look(codes[4], at)
        step[copy] = at + size + extras(symbol)
    step = np.minimum(step, n - 1)
    # the chain of starts: a symbol's place, then the place of the next one
    if not others and not any(c.top for c in codes[:4]):
        places = np.full(total, begin)
    else:
        jumps = [step]
        while len(jumps) < 4 and 1 << len(jumps) < total:
            jumps.append(jumps[-1].take(jumps[-1]))
        leap, places, p = jumps[-1], [], begin
        for _ in range(-(-total >> (len(jumps) - 1))):
            places.append(p)
            p = leap.item(p)
            if p >= n - 1:
                break
        places = np.array(places)
        for jump in reversed(jumps[:-1]):
            places = np.stack((places, jump.take(places)), 1).ravel()
        places = places[:total]
    symbol = green[places]
    lengths, distances = np.ones(len(places), np.int64), np.zeros(len(places), np.int64)
    if others and len(at := np.flatnonzero((symbol >= 256) & (symbol < 280))):
        p, own = after[places[at]], symbol[at] - 256
        more = extras(own)
        lengths[at] = valued(own, seen[p] & ((1 << more) - 1))
        p = np.minimum(p + more, n - 1)
        own, size = look(codes[4], p)
        more, p = extras(own), np.minimum(p + size, n - 1)
        distances[at] = valued(own, seen[p] & ((1 << more) - 1))
    count = int(np.searchsorted(np.cumsum(lengths), total)) + 1 if total else 0
    symbol, places, lengths, distances = symbol[:count], places[:count], lengths[:count], distances[:count]
    if lengths.sum() < total:
        raise ValueError("the image ends early")
    pixels, p = symbol.astype(np.uint32) << 8, after[places]
    for code, shift in zip(codes[1:4], (16, 0, 24), strict=True):
        own, size = look(code, p)
        pixels |= own.astype(np.uint32) << np.uint32(shift)
        p = np.minimum(p + size, n - 1)
    bits.at = start - begin + (int(step[places[-1]]) if count and (others or any(c.top for c in codes[:4])) else begin)
    return symbol, pixels, lengths, distances


@lru_cache(maxsize=64)
def offsets(width: int) -> np.ndarray:
    """How far back each of the short distance codes is."""
    return np.array([0, *(max(1, dy * width + dx) for dx, dy in distance_map())])


def follow(source: np.ndarray) -> np.ndarray:
    """Each place's first source, where those that have none are their own."""
    while True:
        further = source.take(source)
        if np.array_equal(further, source):
            return source
        source = further


def resolve(symbol: np.ndarray, pixels: np.ndarray, lengths: np.ndarray, distances: np.ndarray, width: int, cache_bits: int) -> np.ndarray:
    """The pixels, with copies and places of the cache filled in."""
    return resolve_many([(symbol, pixels, lengths, distances)], [width], [cache_bits])[0]


def resolve_many(found: list[tuple[np.ndarray, ...]], widths: list[int], cache_bits: list[int]) -> list[np.ndarray]:
    """The pixels of images, with copies and places of the cache filled in: each points at the pixel that it repeats, and
    pointers are followed by doubling.  A place of the cache has the last pixel before it of the same hash; the hash
    of a copied pixel is that of its source."""
    if not any(len(x[0]) for x in found):
        return [x[1] for x in found]
    image = np.repeat(np.arange(len(found)), [len(x[0]) for x in found])  # of each symbol
    symbol, pixels, lengths, distances = (np.concatenate(x) for x in zip(*found, strict=True))
    ends = np.cumsum(lengths)
    begins, total = ends - lengths, int(ends[-1])
    sizes = np.bincount(image, lengths, minlength=len(found)).astype(np.int64)
    starts = np.cumsum(sizes) - sizes
    value, source = np.zeros(total, np.uint32), np.arange(total)
    value[begins] = pixels
    copy = np.flatnonzero((symbol >= 256) & (symbol < 280))
    size, back = lengths[copy], distances[copy]
    across = np.array(widths)[image[copy]]
    for width in np.unique(across).tolist():
        some = np.flatnonzero((across == width) & (back <= 120))
        back[some] = offsets(width).take(back[some]) + 120
    back -= 120
    if (back > begins[copy] - starts[image[copy]]).any():
        raise ValueError("a copy from before the image")
    places = np.repeat(begins[copy] - np.cumsum(size) + size, size) + np.arange(int(size.sum()))
    source[places] -= np.repeat(back, size)
    held, empty = np.flatnonzero(symbol >= 280), []
    if len(held):
        owner, shift = np.repeat(np.arange(len(found)), sizes), (32 - np.array(cache_bits)).astype(np.uint32)
        key = ((value * np.uint32(CACHE_FACTOR)) >> shift[owner]).astype(np.uint16)
        key[begins[held]] = symbol[held] - 280
        if len(places):
            key[places] = key[follow(source)[places]]
        order = by_key(owner, key)
        before = np.full(total, -1)
        before[order[1:]] = np.where((key[order[1:]] == key[order[:-1]]) & (owner[order[1:]] == owner[order[:-1]]), order[:-1], -1)
        before = before[begins[held]]
        empty = np.unique(image[held[before < 0]]).tolist()
        source[begins[held]] = np.where(before < 0, begins[held], before)
    out = np.split(value.take(follow(source)), starts[1:])
    for k in empty:
        out[k] = resolve_in_order(*found[k][:3], back[image[copy] == k], cache_bits[k])
    return out


def resolve_in_order(symbol: np.ndarray, pixels: np.ndarray, lengths: np.ndarray, back: np.ndarray, cache_bits: int) -> np.ndarray:
    """``resolve`` where a place of the cache is read before it is written: it has pixel 0, which has another place."""
    out: list[int] = []
    held, shift, far = [0] * (1 << cache_bits), 32 - cache_bits, iter(back.tolist())
    for s, x, n in zip(symbol.tolist(), pixels.tolist(), lengths.tolist(), strict=True):
        d = next(far) if 256 <= s < 280 else 0
        for _ in range(n):
            now = x if s < 256 else out[-d] if d else held[s - 280]
            out.append(now)
            held[(now * CACHE_FACTOR & 0xFFFFFFFF) >> shift] = now
    return np.array(out, np.uint32)


def average(a: int, b: int) -> int:
    return (((a ^ b) & 0xFEFEFEFE) >> 1) + (a & b)


def add(a: int, b: int) -> int:
    return ((a & 0xFF00FF00) + (b & 0xFF00FF00)) & 0xFF00FF00 | ((a & 0x00FF00FF) + (b & 0x00FF00FF)) & 0x00FF00FF


def _clip(v: int) -> int:
    return 0 if v < 0 else 255 if v > 255 else v


def _channels(p: int) -> tuple[int, int, int, int]:
    return p >> 24, p >> 16 & 255, p >> 8 & 255, p & 255


def _pixel(parts) -> int:
    a, r, g, b = parts
    return a << 24 | r << 16 | g << 8 | b


def predict(mode: int, left: int, top: int, right: int, corner: int) -> int:
    """The prediction of one pixel from its left, top, top-right and top-left neighbours."""
    if mode in (1, 2, 3, 4):
        return (left, top, right, corner)[mode - 1]
    if mode == 5:
        return average(average(left, right), top)
    if mode in (6, 7, 8, 9):
        return average(*((left, corner), (left, top), (corner, top), (top, right))[mode - 6])
    if mode == 10:
        return average(average(left, corner), average(top, right))
    if mode == 11:
        by_left = sum(abs(t - c) for t, c in zip(_channels(top), _channels(corner), strict=True))
        by_top = sum(abs(x - c) for x, c in zip(_channels(left), _channels(corner), strict=True))
        return left if by_left < by_top else top
    if mode == 12:
        return _pixel(_clip(x + t - c) for x, t, c in zip(_channels(left), _channels(top), _channels(corner), strict=True))
    if mode == 13:
        return _pixel(_clip(m + int((m - c) / 2)) for m, c in zip(_channels(average(left, top)), _channels(corner), strict=True))
    return 0xFF000000


def neighbours(out, i: int, width: int) -> tuple[int, int, int, int]:
    """Left, top, top-right (the row's own first pixel beyond its end) and top-left."""
    return int(out[i - 1]), int(out[i - width]), int(out[i - width + 1]), int(out[i - width - 1])


def predicted(out, i: int, width: int, modes: np.ndarray, block: int, side: int) -> int:
    x, y = i % width, i // width
    if i == 0:
        return 0xFF000000
    if y == 0:
        return int(out[i - 1])
    if x == 0:
        return int(out[i - width])
    mode = int(modes[(y >> block) * side + (x >> block)]) >> 8 & 15
    return predict(mode, *neighbours(out, i, width))


def _signed(v):
    return np.asarray(v, np.int64).astype(np.uint8).astype(np.int8).astype(np.int64)


def cross_colour(pixels: np.ndarray, width: int, factors: np.ndarray, block: int, side: int, inverse: bool) -> np.ndarray:
    i = np.arange(len(pixels))
    f = factors[((i // width) >> block) * side + ((i % width) >> block)].astype(np.int64)
    p = pixels.astype(np.int64)
    red, green, blue = p >> 16 & 255, p >> 8 & 255, p & 255
    delta = lambda t, c: (_signed(t & 255) * _signed(c)) >> 5
    sign = 1 if inverse else -1
    new_red = (red + sign * delta(f, green)) & 255
    of_red = new_red if inverse else red
    new_blue = (blue + sign * (delta(f >> 8, green) + delta(f >> 16, of_red))) & 255
    return ((p & 0xFF00FF00) | new_red << 16 | new_blue).astype(np.uint32)


def decode(data: bytes) -> tuple[int, int, np.ndarray]:
    """(width, height, ARGB pixels as uint32) of a lossless WebP file."""
    bits, width, height, wide, undo = opened(data)
    return width, height, undone(read_pixels(bits, wide, height, True), width, height, undo)


def decode_many(files: list[bytes]) -> list[np.ndarray]:
    """The pixels of each of the files, GROUP of them and about STEP_BYTES of pixels at most side by side."""
    found, heads, held = [], [], 0
    for data in files:
        head = opened(data)
        size = 4 * head[1] * head[2]
        if heads and (len(heads) == GROUP or held + size > STEP_BYTES):
            found += decoded(heads)
            heads, held = [], 0
        heads.append(head)
        held += size
    return found + decoded(heads)


def decoded(heads: list[tuple]) -> list[np.ndarray]:
    """The pixels of opened files: prefix codes are read and copies resolved for all at once."""
    plain, read = [], []
    for bits, _, height, wide, _ in heads:
        at = bits.at
        cache_bits = bits.read(4) if bits.read(1) else 0
        if bits.read(1):  # several groups of codes
            bits.at = at
        else:
            plain.append((bits, cache_bits, wide, wide * height))
    for (bits, cache_bits, wide, total), codes in zip(plain, read_prefixes([x[:2] for x in plain]), strict=True):
        read.append((symbols(bits, codes, total), wide, cache_bits))
    pixels = iter(resolve_many(*map(list, zip(*read, strict=True))) if read else [])
    alone = {id(bits) for bits, *_ in heads} - {id(x[0]) for x in plain}
    return [undone(read_pixels(bits, wide, height, True) if id(bits) in alone else next(pixels), width, height, undo) for bits, width, height, wide, undo in heads]


def opened(data: bytes) -> tuple[Bits, int, int, int, list[tuple]]:
    """(bits of the main image and on, width, height, width of the main image, transforms to undo) of a file."""
    if data[:4] != b"RIFF" or data[8:16] != b"WEBPVP8L":
        raise ValueError("not a lossless WebP file")
    size = int.from_bytes(data[16:20], "little")
    bits = Bits(data[20 : 20 + size])
    if bits.read(8) != 0x2F:
        raise ValueError("no VP8L signature")
    width, height = bits.read(14) + 1, bits.read(14) + 1
    bits.read(1)
    if bits.read(3):
        raise ValueError("unknown version")
    undo, wide = [], width
    while bits.read(1):
        kind = bits.read(2)
        if kind in (PREDICTOR, CROSS_COLOUR):
            block = bits.read(3) + 2
            side = (wide + (1 << block) - 1) >> block
            undo.append((kind, wide, block, side, read_pixels(bits, side, (height + (1 << block) - 1) >> block, False)))
        elif kind == PALETTE:
            n = bits.read(8) + 1
            colours = read_pixels(bits, n, 1, False).view(np.uint8).reshape(n, 4)
            colours = np.cumsum(colours, 0, dtype=np.uint8).copy().view(np.uint32).ravel()
            fold = 3 if n <= 2 else 2 if n <= 4 else 1 if n <= 16 else 0
            undo.append((kind, wide, fold, n, colours))
            wide = (wide + (1 << fold) - 1) >> fold
        else:
            undo.append((kind, wide, 0, 0, None))
    return bits, width, height, wide, undo


def undone(pixels: np.ndarray, width: int, height: int, undo: list[tuple]) -> np.ndarray:
    """The pixels as they were before the transforms."""
    for kind, across, block, side, table in reversed(undo):
        if kind == SUBTRACT_GREEN:
            green = pixels >> 8 & 255
            pixels = (pixels & 0xFF00FF00) | ((pixels >> 16) + green & 255) << 16 | (pixels + green & 255)
        elif kind == CROSS_COLOUR:
            pixels = cross_colour(pixels, across, table, block, side, True)
        elif kind == PREDICTOR:
            out = pixels.tolist()
            for i in range(len(out)):
                out[i] = add(out[i], predicted(out, i, across, table, block, side))
            pixels = np.array(out, np.uint32)
        else:
            index = (pixels >> 8 & 255).reshape(height, -1)
            if block:
                width_bits = 8 >> block
                parts = index[:, :, None] >> (np.arange(1 << block, dtype=np.uint32) * width_bits) & ((1 << width_bits) - 1)
                index = parts.reshape(height, -1)[:, :across]
            colours = np.zeros(256, np.uint32)
            colours[:side] = table
            pixels = colours[index.ravel()]
    return pixels


# ---------------------------------------------------------------------------------------- write


def code_lengths(counts: np.ndarray, most: int) -> np.ndarray:
    """Huffman code lengths of at most ``most`` bits; small counts are raised until they fit."""
    lengths, used, least = np.zeros(len(counts), np.int64), np.flatnonzero(counts), 1
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    used = used[np.argsort(counts[used], kind="stable")]
    n = len(used)
    while True:
        # leaves in order of their counts, and sums, which come up in order too
        weight = [*np.maximum(counts[used], least).tolist()] + [0] * (n - 1)
        parent = [0] * (2 * n - 1)
        leaf, node = 0, n
        for new in range(n, 2 * n - 1):
            total = 0
            for _ in (0, 1):
                if leaf < n and (node == new or weight[leaf] <= weight[node]):
                    x, leaf = leaf, leaf + 1
                else:
                    x, node = node, node + 1
                total += weight[x]
                parent[x] = new
            weight[new] = total
        depth = [0] * (2 * n - 1)
        for x in range(2 * n - 3, -1, -1):
            depth[x] = depth[parent[x]] + 1
        if max(depth) <= most:
            lengths[used] = depth[:n]
            return lengths
        least = least * 2 + int(counts.sum()) // (1 << most)


def code_lengths_many(counts: np.ndarray, most: int) -> np.ndarray:
    """``code_lengths`` of every row of ``counts``, the rows' trees built side by side."""
    lengths = np.zeros(counts.shape, np.int64)
    row, symbol = np.nonzero(counts)
    own = counts[row, symbol]
    sizes = np.bincount(row, minlength=len(counts))
    only = sizes[row] == 1
    lengths[row[only], symbol[only]] = 1
    rows = np.argsort(-sizes, kind="stable")  # those with most leaves first, so that those still at work come first
    rows = rows[: int((sizes > 1).sum())]
    if not len(rows):
        return lengths
    order = np.argsort(row * (int(own.max()) + 1) + own, kind="stable")
    n, wide = sizes[rows], int(sizes[rows[0]]) + 1
    rank = np.empty(len(counts), np.int64)
    rank[rows] = np.arange(len(rows))
    leaves = order[~only[order]]
    place = rank[row[leaves]] * wide + within(row[leaves])
    size, never = len(rows) * wide, np.iinfo(np.int64).max
    weight = np.full(2 * size, never)  # leaves in order of their counts, then sums, which come up in order too
    weight[place] = own[leaves]
    parent = np.zeros(2 * size, np.int64)
    base = np.arange(len(rows)) * wide
    leaf, node = base.copy(), base + size
    active = np.searchsorted(-n, -np.arange(1, wide + 1), side="left").tolist()  # rows of more than so many leaves
    for step in range(wide - 2):
        k = active[step]
        x, y, total = leaf[:k], node[:k], 0
        for _ in (0, 1):
            a, b = weight.take(x), weight.take(y)
            first = a <= b
            total = total + np.minimum(a, b)
            parent[np.where(first, x, y)] = step
            x += first
            y += ~first
        weight[base[:k] + (size + step)] = total
    depth = np.zeros(size, np.int64)
    sums = parent[size:]
    for step in range(wide - 4, -1, -1):
        k = active[step + 1]
        at = base[:k] + step
        depth[at] = depth.take(base[:k] + sums.take(at)) + 1
    found = depth.take(place - place % wide + parent.take(place)) + 1
    lengths[row[leaves], symbol[leaves]] = found
    for r in np.flatnonzero(lengths.max(1) > most).tolist():
        lengths[r] = code_lengths(counts[r], most)
    return lengths


def within(owner: np.ndarray) -> np.ndarray:
    """Place of each element among those of its owner; owners are in order."""
    starts = np.flatnonzero(np.concatenate((np.ones(min(1, len(owner)), bool), owner[1:] != owner[:-1])))
    return np.arange(len(owner)) - np.repeat(starts, np.diff(starts, append=len(owner)))


def canonical(lengths: np.ndarray, owner: np.ndarray | None = None) -> np.ndarray:
    """Codes of the canonical prefix code (of at most 15 bits), first bit lowest; of several codes end to end
    if each length has an owner."""
    codes, used = np.zeros(len(lengths), np.int64), np.flatnonzero(lengths)
    own = lengths[used]
    order = np.argsort(own if owner is None else owner[used] * 16 + own, kind="stable")
    used, share = used[order], 1 << (15 - own[order])
    before = np.cumsum(share) - share
    if owner is not None and len(used):
        who = owner[used]
        starts = np.flatnonzero(np.concatenate(([True], who[1:] != who[:-1])))
        before -= np.repeat(before[starts], np.diff(starts, append=len(who)))
    codes[used] = backward()[before & 0x7FFF]
    return codes


class Writer:
    """Bits in the order written; whole arrays of codes at once."""

    def __init__(self) -> None:
        self.value, self.size, self.parts = 0, 0, []

    def put(self, value: int, n: int) -> None:
        self.value |= value << self.size
        self.size += n

    def put_many(self, codes: np.ndarray, sizes: np.ndarray) -> None:
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        within = np.arange(total) - np.repeat(ends - sizes, sizes)
        packed = np.packbits((np.repeat(codes, sizes) >> within & 1).astype(np.uint8), bitorder="little").tobytes()
        self.put(int.from_bytes(packed, "little"), total)

    def bytes(self) -> bytes:
        return self.value.to_bytes((self.size + 7) // 8, "little")


def write_prefix(out: Writer, lengths: np.ndarray) -> None:
    _, values, sizes = prefix_items(lengths, np.zeros(len(lengths), np.int64), 1)
    out.put_many(values, sizes)


def prefix_items(lengths: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, value, size) of the bits that tell ``n`` prefix codes, whose code lengths stand end to end."""
    shown = lengths != 0
    used = np.bincount(owner[shown], minlength=n)
    first = np.zeros(n, np.int64)
    first[owner[shown][::-1]] = within(owner)[shown][::-1]
    simple = (used == 0) | ((used == 1) & (first < 256))
    few = np.flatnonzero(simple)
    parts = [(few, 5 | first[few] << 3, np.full(len(few), 11))]
    if len(few) < n:
        # runs of zeros and of others
        left = ~simple[owner]
        lengths, owner, shown = lengths[left], owner[left], shown[left]
        starts = np.flatnonzero(np.concatenate(([True], (shown[1:] != shown[:-1]) | (owner[1:] != owner[:-1]))))
        run, zero = np.diff(starts, append=len(lengths)), ~shown[starts]
        whole, rest = run // 138, run % 138
        tokens = np.where(zero, whole + np.where(rest < 3, rest, 1), run)
        of = np.repeat(np.arange(len(run)), tokens)
        k = within(of)
        full, rest = k < whole[of], rest[of]
        long, short = full | (rest >= 11), ~full & (rest >= 3) & (rest < 11)
        kinds = np.where(zero[of], np.where(long, 18, np.where(short, 17, 0)), lengths[np.minimum(starts[of] + k, len(lengths) - 1)])
        more = np.where(kinds == 18, np.where(full, 127, rest - 11), np.where(kinds == 17, rest - 3, 0))
        extra_size = np.where(kinds == 18, 7, np.where(kinds == 17, 3, 0))
        owner = owner[starts][of]
        own = code_lengths_many(np.bincount(owner * 19 + kinds, minlength=n * 19).reshape(n, 19), 7)
        codes = canonical(own.ravel(), np.repeat(np.arange(n), 19))
        many_codes = np.flatnonzero(~simple)
        ordered = own[many_codes][:, LENGTH_ORDER]
        many = np.maximum(19 - np.argmax(ordered[:, ::-1] != 0, 1), 4)
        head, size = np.zeros((len(many), 21), np.int64), np.ones((len(many), 21), np.int64)
        head[:, 0], size[:, 0] = (many - 4) << 1, 5
        head[:, 1:20], size[:, 1:20] = ordered, np.where(np.arange(19) < many[:, None], 3, 0)
        parts.append((np.repeat(many_codes, 21), head.ravel(), size.ravel()))
        own[np.count_nonzero(own, axis=1) == 1] = 0
        own, codes = own.ravel()[owner * 19 + kinds], codes[owner * 19 + kinds]
        parts.append((owner, np.where(own > 0, codes, 0) | more << own, own + extra_size))
    return woven(parts, n)


def woven(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, value, size) of items: each owner's of the first part, then those of the next; owners are in order in a part."""
    counts = np.stack([np.bincount(owner, minlength=n) for owner, _, _ in parts], 1)
    starts = (np.cumsum(counts.ravel()) - counts.ravel()).reshape(counts.shape)
    total = int(counts.sum())
    values, sizes = np.zeros(total, np.int64), np.zeros(total, np.int64)
    for i, (owner, value, size) in enumerate(parts):
        at = starts[:, i][owner] + within(owner)
        values[at], sizes[at] = value, size
    return np.repeat(np.arange(n), counts.sum(1)), values, sizes


def packed(owner: np.ndarray, values: np.ndarray, sizes: np.ndarray, n: int) -> list[bytes]:
    """Each owner's items as bytes, least significant bit first; an item has 32 bits at most."""
    bits = np.bincount(owner, sizes, minlength=n).astype(np.int64)
    words = (bits + 31) >> 5
    start = np.cumsum(words) - words
    ends = np.cumsum(sizes)
    at = ends - sizes + np.repeat((start << 5) - (np.cumsum(bits) - bits), np.bincount(owner, minlength=n))
    wide = values.astype(np.uint64) << (at & 31).astype(np.uint64)
    # items share no bits, so a word is the sum of its items' parts, and doubles hold it exactly
    total = int(words.sum()) + 2
    low = np.bincount(at >> 5, (wide & np.uint64(0xFFFFFFFF)).astype(np.float64), minlength=total)
    low += np.bincount((at >> 5) + 1, (wide >> np.uint64(32)).astype(np.float64), minlength=total)
    data = low.astype("<u4").tobytes()
    return [data[4 * a : 4 * a + (b + 7) // 8] for a, b in zip(start.tolist(), bits.tolist(), strict=True)]


def bits_of(values: np.ndarray) -> float:
    """Bits that an ideal code takes for the values."""
    if not len(values):
        return 0.0
    counts = np.bincount(values)
    if len(values) >= len(known := _terms()):
        counts = counts[counts > 0]
        return float(len(values) * np.log2(len(values)) - (counts * np.log2(counts)).sum())
    return float(known[len(values)] - known.take(counts).sum())


@lru_cache(maxsize=1)
def _terms() -> np.ndarray:
    """n log2 n of small numbers."""
    n = np.arange(1, 1 << 14)
    return np.concatenate(([0.0], n * np.log2(n)))


def pixel_bits(pixels: np.ndarray) -> float:
    return sum(bits_of(c) for c in pixels.view(np.uint8).reshape(-1, 4).T)


def minus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Channel by channel difference."""
    return (a.view(np.uint8) - np.ascontiguousarray(b).view(np.uint8)).view(np.uint32)


#: Modes that the writer tries for a block: none, left, above.
MODES = (0, 1, 2)
#: Rows and columns of a block of predictors, as a power of two; rows of one of cross-colour factors.
TILE, CROSS_TILE = 3, 9
#: Factors (of 32) that are tried, and the bits that a transform must spare to be worth its own.
FACTORS, WORTH = (16, 32), 150


def by_predictor(pixels: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(table of modes, differences): each block has the mode by which its differences cost least."""
    height = len(pixels) // width
    shown = lambda by: np.concatenate((np.full(by, 0xFF000000, np.uint32), pixels))[: len(pixels)]
    black, left, top = np.full(len(pixels), 0xFF000000, np.uint32), shown(1), shown(width)
    if min(pixel_bits(minus(pixels, left)), pixel_bits(minus(pixels, top))) > 1.2 * pixel_bits(pixels):
        return np.zeros(0, np.uint32), pixels  # far from its neighbours: no block would gain
    i = np.arange(len(pixels))
    y, x = i // width, i % width
    side, tall = (width + (1 << TILE) - 1) >> TILE, (height + (1 << TILE) - 1) >> TILE
    block = (y >> TILE) * side + (x >> TILE)
    costs = []
    for guess in (black, left, top):
        parts = minus(pixels, guess).view(np.uint8).reshape(-1, 4)
        own = np.zeros(len(pixels))
        for c in range(4):
            counts = np.bincount(parts[:, c], minlength=256)
            own += np.log2(len(pixels) / np.maximum(counts, 1))[parts[:, c]]
        costs.append(np.bincount(block, own, minlength=side * tall))
    best = np.argmin(np.stack(costs) + np.array([0.0, 8, 8])[:, None], 0)
    mode = best[block]
    guess = np.choose(mode, (black, left, top))
    guess = np.where(y == 0, left, np.where(x == 0, top, guess))
    return (np.uint32(0xFF000000) | np.array(MODES, np.uint32)[best] << np.uint32(8)), minus(pixels, guess)


def related(pixels: np.ndarray) -> bool:
    """Whether two of blue, green and red go together at all."""
    with np.errstate(invalid="ignore", divide="ignore"):
        found = np.corrcoef(pixels.view(np.uint8).reshape(-1, 4)[:, :3].T)
    return bool((np.abs(found[[0, 0, 1], [1, 2, 2]]) > 0.25).any())


def by_factors(pixels: np.ndarray) -> tuple[int, float]:
    """(the factors that make red and blue cheapest: green to red, green to blue, red to blue; bits spared)."""
    blue, green, red, _ = pixels.view(np.uint8).reshape(-1, 4).T.astype(np.int64)
    delta = lambda t, c: (t * _signed(c)) >> 5
    found, spared = [], 0.0
    for target, sources in ((red, (green,)), (blue, (green, red))):
        now = bits_of(target)
        for c in sources:
            tried = [(bits_of((target - delta(t, c)) & 255), t) for t in FACTORS]
            least, t = min(tried)
            if least < now:
                target, spared, now = (target - delta(t, c)) & 255, spared + now - least, least
                found.append(t & 255)
            else:
                found.append(0)
    return found[0] | found[1] << 8 | found[2] << 16 | 0xFF000000, spared


def prefixed(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols, extra bits and their sizes of lengths or distance codes."""
    v = values - 1
    top = np.where(v < 4, 2, np.frexp(np.maximum(v, 1).astype(np.float64))[1]) - 2
    return np.where(v < 4, v, 2 * top + 2 + (v >> top & 1)), np.where(v < 4, 0, v & (1 << top) - 1), np.where(v < 4, 0, top)


def by_key(owner: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Order by owner (fewer than 65,536) and key, equal ones as they stand."""
    order = np.argsort(key, kind="stable")
    return order[np.argsort(owner.astype(np.uint16)[order], kind="stable")]


def copies(pixels: np.ndarray, owner: np.ndarray, ends: np.ndarray) -> list[tuple[int, int, int]]:
    """(place, length, distance) of stretches of three pixels or more that stood before in their image.  Images stand end to end."""
    if len(pixels) < 3:
        return []
    wide = pixels.astype(np.uint64)
    key = (wide[:-2] * np.uint64(0x9E3779B97F4A7C15) + wide[1:-1]) * np.uint64(0xC2B2AE3D27D4EB4F) + wide[2:]
    inside = np.flatnonzero(owner[:-2] == owner[2:])
    key, who = key[inside], owner[inside]
    order = by_key(who, key)
    same = np.flatnonzero((key[order[1:]] == key[order[:-1]]) & (who[order[1:]] == who[order[:-1]]))
    before = np.full(len(pixels), -1)
    before[inside[order[same + 1]]] = inside[order[same]]
    starts = np.flatnonzero(before >= 0)
    found, at = [], 0
    for i, from_, end in zip(starts.tolist(), before[starts].tolist(), ends[owner[starts]].tolist(), strict=True):
        if i < at:
            continue
        most = min(4096, end - i)
        differ = pixels[i : i + most] != pixels[from_ : from_ + most]
        size = int(differ.argmax())
        if not differ[size]:
            size = most
        if size >= 3:  # or else equal hashes of different pixels
            found.append((i, size, i - from_))
            at = i + size
    return found


@lru_cache(maxsize=64)
def near_codes(width: int) -> dict[int, int]:
    """The least code of each distance that has a short one."""
    return {max(1, dy * width + dx): k for k, (dx, dy) in reversed(list(enumerate(distance_map(), 1)))}


def coded(images: list[np.ndarray], widths: list[int], main: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(image, value, size) of the bits of images as prefix-coded symbols.  In main images, stretches that stood before
    are copies, and pixels that the colour cache holds are places in it if that makes the codes shorter."""
    many = len(images)
    sizes = np.array([len(x) for x in images])
    pixels, owner = np.concatenate(images), np.repeat(np.arange(many), sizes)
    ends, total = np.cumsum(sizes), int(sizes.sum())
    literal, lengths, far = np.ones(total, bool), np.zeros(total, np.int64), np.zeros(total, np.int64)
    if main:
        for i, size, d in copies(pixels, owner, ends):
            literal[i : i + size] = False
            lengths[i], far[i] = size, near_codes(widths[int(owner[i])]).get(d, d + 120)
    channels = pixels.view(np.uint8).reshape(-1, 4).T.astype(np.int64)  # blue, green, red, alpha
    symbol, cache_bits = channels[1], np.zeros(many, np.int64)
    if main and sizes.max() >= 64:
        tried = np.where(sizes < 600, 6, 9)
        key = ((pixels * np.uint32(CACHE_FACTOR)) >> (32 - tried).astype(np.uint32)[owner]).astype(np.int64)
        order = by_key(owner, key.astype(np.uint16))
        hit = np.zeros(total, bool)
        hit[order[1:]] = (key[order[1:]] == key[order[:-1]]) & (pixels[order[1:]] == pixels[order[:-1]]) & (owner[order[1:]] == owner[order[:-1]])
        mixed = np.where(hit, 280 + key, symbol)
        counts = histogram(owner[literal], mixed[literal], many, 792)
        cost = bits_in(counts) + 6 * np.count_nonzero(counts[:, 280:], axis=1)
        plain = literal & ~hit
        for c in (0, 2, 3):
            cost += bits_in(histogram(owner[plain], channels[c][plain], many, 256))
        best = sum(bits_in(histogram(owner[literal], c[literal], many, 256)) for c in channels)
        cache_bits = np.where((sizes >= 64) & (cost < best), tried, 0)
        symbol = np.where(cache_bits[owner] > 0, mixed, symbol)
    begins = np.flatnonzero(literal | (lengths > 0))
    symbol, who, size, far = symbol[begins], owner[begins], lengths[begins], far[begins]
    copy = np.flatnonzero(size > 0)
    own, more, bits = prefixed(size[copy])
    symbol[copy] = 256 + own
    far_code, far_more, far_bits = prefixed(far[copy])
    plain = np.flatnonzero(symbol < 256)
    seen = [c[begins[plain]] for c in (channels[2], channels[0], channels[3])]  # red, blue, alpha
    counts = np.concatenate([histogram(who[plain], c, many, 256) for c in seen])
    told = [
        code_lengths_many(histogram(who, symbol, many, 792), 15),
        *np.split(code_lengths_many(counts, 15), 3),
        code_lengths_many(histogram(who[copy], far_code, many, 40), 15),
    ]
    # an image's five codes side by side; the first has as many symbols as its cache asks for
    span = 792 + 3 * 256 + 40
    table, five = np.concatenate(told, 1), np.repeat(np.arange(5), (792, 256, 256, 256, 40))
    kept = (five > 0) | (np.arange(span) < (280 + np.where(cache_bits > 0, 1 << cache_bits, 0))[:, None])
    row = (np.arange(many)[:, None] * 5 + five)[kept]
    flat = table[kept]
    codes = np.zeros((many, span), np.int64)
    codes[kept] = canonical(flat, row)
    code_owner, code_value, code_size = prefix_items(flat, row, many * 5)
    alone = np.bincount(row[flat > 0], minlength=many * 5).reshape(many, 5) < 2
    table[alone[:, five]] = 0
    codes[table == 0] = 0
    table, codes = table.ravel(), codes.ravel()
    # two items a symbol: green and red, blue and alpha, or length and distance
    at = who * span
    values, wide = np.zeros((len(symbol), 2), np.int64), np.zeros((len(symbol), 2), np.int64)
    values[:, 0], wide[:, 0] = codes[at + symbol], table[at + symbol]
    red, blue, alpha = (at[plain] + (792 + 256 * k) + c for k, c in enumerate(seen))
    values[plain, 0] |= codes[red] << wide[plain, 0]
    wide[plain, 0] += table[red]
    values[plain, 1], wide[plain, 1] = codes[blue] | codes[alpha] << table[blue], table[blue] + table[alpha]
    values[copy, 0] |= more << wide[copy, 0]
    wide[copy, 0] += bits
    place = at[copy] + (792 + 3 * 256) + far_code
    values[copy, 1], wide[copy, 1] = codes[place] | far_more << table[place], table[place] + far_bits
    each = np.arange(many)
    flag = np.where(cache_bits > 0, 1 | cache_bits << 1, 0), np.where(cache_bits > 0, 5, 1) + (1 if main else 0)  # and one code group
    return woven([(each, *flag), (code_owner // 5, code_value, code_size), (np.repeat(who, 2), values.ravel(), wide.ravel())], many)


def histogram(owner: np.ndarray, values: np.ndarray, many: int, size: int) -> np.ndarray:
    return np.bincount(owner * size + values, minlength=many * size).reshape(many, size)


def bits_in(counts: np.ndarray) -> np.ndarray:
    """Bits that an ideal code takes for values of these counts, by row; in steps of 1/1024, so that sums are exact in any order."""
    total, known = counts.sum(1), _steps()
    if total.max(initial=0) >= len(known):
        steps = lambda x: np.rint(x * np.log2(np.maximum(x, 1)) * 1024).astype(np.int64)
        return (steps(total) - steps(counts).sum(1)) / 1024
    return (known.take(total) - known.take(counts).sum(1)) / 1024


@lru_cache(maxsize=1)
def _steps() -> np.ndarray:
    n = np.arange(WIDTH // 4 * HEIGHT + 1)
    return np.rint(n * np.log2(np.maximum(n, 1)) * 1024).astype(np.int64)


def transformed(outs: list[Writer], inner: list[tuple[np.ndarray, int]], pixels: np.ndarray, width: int) -> tuple[np.ndarray, int]:
    """Writes the transforms that spare bits; the pixels and the width they leave.  An image inside a transform is put
    into ``inner`` with its width, to be coded with others, and the bits after it go to a writer of their own."""
    height = len(pixels) // width

    def entropy_coded(pixels: np.ndarray, width: int) -> None:
        inner.append((pixels, width))
        outs.append(Writer())

    def transform(kind: int) -> None:
        outs[-1].put(1, 1)
        outs[-1].put(kind, 2)

    cost = pixel_bits(pixels)
    colours, index = np.unique(pixels, return_inverse=True)
    fold = 3 if len(colours) <= 2 else 2 if len(colours) <= 4 else 1 if len(colours) <= 16 else 0
    if len(colours) <= 256 and bits_of(index) / (1 << fold) + 20 * len(colours) < cost:
        transform(PALETTE)
        outs[-1].put(len(colours) - 1, 8)
        steps = np.diff(colours.view(np.uint8).reshape(-1, 4), axis=0, prepend=np.zeros((1, 4), np.uint8))
        entropy_coded(steps.astype(np.uint8).copy().view(np.uint32).ravel(), len(colours))
        across = -(-width >> fold)
        padded = np.zeros((height, across << fold), np.uint32)
        padded[:, :width] = index.reshape(height, width)
        bundled = (padded.reshape(height, across, -1) << (np.arange(1 << fold, dtype=np.uint32) * np.uint32(8 >> fold))).sum(2)
        pixels, width = np.uint32(0xFF000000) | bundled.astype(np.uint32).ravel() << np.uint32(8), across
    else:
        table, rest = by_predictor(pixels, width)
        side = (width + (1 << TILE) - 1) >> TILE
        if (spared := cost - pixel_bits(rest)) > WORTH + 2 * len(table):
            transform(PREDICTOR)
            outs[-1].put(TILE - 2, 3)
            entropy_coded(table, side)
            pixels, cost = rest, cost - spared
        factors, spared = by_factors(pixels) if related(pixels) else (0, 0.0)
        green = pixels >> np.uint32(8) & np.uint32(255)
        less = (pixels & np.uint32(0xFF00FF00)) | ((pixels >> np.uint32(16)) - green & np.uint32(255)) << np.uint32(16) | (pixels - green & np.uint32(255))
        if factors and cost - pixel_bits(less) > max(WORTH // 10, spared - WORTH):
            transform(SUBTRACT_GREEN)
            pixels = less
        elif spared > WORTH:
            transform(CROSS_COLOUR)
            outs[-1].put(CROSS_TILE - 2, 3)
            rows = (height + (1 << CROSS_TILE) - 1) >> CROSS_TILE
            table = np.full(rows, factors, np.uint32)
            entropy_coded(table, 1)
            pixels = cross_colour(pixels, width, table, CROSS_TILE, 1, False)
    return pixels, width


def may_transform(images: list[np.ndarray], width: int) -> np.ndarray:
    """Whether an image may gain by a transform: all measures of ``transformed`` for all images at once, one bit more generous."""
    many, sizes = len(images), np.array([len(x) for x in images])
    pixels, owner = np.concatenate(images), np.repeat(np.arange(many), sizes)
    starts = np.cumsum(sizes) - sizes

    def cost_of(px: np.ndarray) -> np.ndarray:
        parts = px.view(np.uint8).astype(np.int64) + np.tile(np.arange(0, 1024, 256), len(px))
        parts += np.repeat(owner * 1024, 4)
        return bits_in(np.bincount(parts, minlength=many * 1024).reshape(many * 4, 256)).reshape(many, 4).sum(1)

    cost = cost_of(pixels)
    ordered = np.sort(owner << 32 | pixels.astype(np.int64))
    edges = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    colours = np.bincount(ordered[edges] >> 32, minlength=many)
    runs = np.diff(edges, append=len(ordered))
    index = sizes * np.log2(sizes) - np.bincount(ordered[edges] >> 32, runs * np.log2(runs), minlength=many)
    fold = np.select([colours <= 2, colours <= 4, colours <= 16], [3, 2, 1], 0)
    found = (colours <= 256) & (index / (1 << fold) + 20 * colours < cost + 1)
    place = within(owner)
    for by in (1, width):
        shown = np.full(len(pixels), 0xFF000000, np.uint32)
        shown[by:] = np.where(place[by:] >= by, pixels[:-by], np.uint32(0xFF000000))
        found |= cost_of(minus(pixels, shown)) <= 1.2 * cost + 1
    blue, green, red, _ = pixels.view(np.uint8).reshape(-1, 4).T.astype(np.int64)
    sums = {c: np.add.reduceat(x, starts) for c, x in (("b", blue), ("g", green), ("r", red), ("bb", blue * blue), ("gg", green * green), ("rr", red * red), ("bg", blue * green), ("br", blue * red), ("gr", green * red))}
    spread = {c: (sizes * sums[c] - sums[c[0]] * sums[c[1]]).astype(np.float64) for c in sums if len(c) == 2}
    linked = np.zeros(many, bool)
    for a, b in ("bg", "br", "gr"):
        linked |= spread[a + b] ** 2 > 0.249**2 * spread[a + a] * spread[b + b]
    rows = np.flatnonzero(linked & ~found)
    if not len(rows):
        return found
    # factors of those whose colours go together
    own = np.zeros(many, np.int64)
    own[rows] = np.arange(len(rows))
    left = (linked & ~found)[owner]
    who, blue, green, red = own[owner[left]], blue[left], green[left], red[left]
    bits = lambda x: bits_in(histogram(who, x & 255, len(rows), 256))
    spared = np.zeros(len(rows))
    for target, sources in ((red, (green,)), (blue, (green, red))):
        now = bits(target)
        for c in sources:
            least, factor = now, np.zeros(len(rows), np.int64)
            for t in FACTORS:
                tried = bits(target - ((t * _signed(c)) >> 5))
                least, factor = np.where(tried < least, tried, least), np.where(tried < least, t, factor)
            target = target - ((factor[who] * _signed(c)) >> 5)
            spared, now = spared + now - least, least
    gain = bits(red) + bits(blue) - bits(red - green) - bits(blue - green)
    found[rows[(spared > WORTH - 1) | (gain > np.maximum(WORTH // 10, spared - WORTH) - 1)]] = True
    return found


def encode(pixels: np.ndarray, width: int) -> bytes:
    """ARGB pixels as a lossless WebP file, with the transforms that spare bits."""
    return encode_many([pixels], width)[0]


def encode_many(images: list[np.ndarray], width: int) -> list[bytes]:
    """Images of one width as lossless WebP files.  What becomes of one does not depend on the others."""
    left, inner, inner_owner = [], [], []
    heads: list[list] = [[], [], []]  # bits before the first inner image of each, before the second and after
    for i, (pixels, may) in enumerate(zip(images, may_transform(images, width).tolist(), strict=True)):
        outs, own = [Writer()], []
        for value, n in ((0x2F, 8), (width - 1, 14), (len(pixels) // width - 1, 14), (1, 1), (0, 3)):
            outs[-1].put(value, n)
        left.append(transformed(outs, own, pixels, width) if may else (pixels, width))
        outs[-1].put(0, 1)
        for k, out in enumerate(outs):
            heads[k].append((i, out))
        for k, image in enumerate(own):
            inner.append(image)
            inner_owner.append((i, k))
    parts = [items(x) for x in heads]
    if inner:
        owner, values, sizes = coded([p for p, _ in inner], [w for _, w in inner], False)
        of, place = np.array(inner_owner).T
        for k in (1, 0):
            mine = place[owner] == k
            parts.insert(k + 1, (of[owner[mine]], values[mine], sizes[mine]))
    parts.append(coded([p for p, _ in left], [w for _, w in left], True))
    return [riff(x) for x in packed(*woven(parts, len(images)), len(images))]


def items(written: list[tuple[int, Writer]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, value, size) of what writers hold, by 32 bits."""
    owners, values, sizes = [], [], []
    for i, out in written:
        for at in range(0, out.size, 32):
            owners.append(i)
            values.append(out.value >> at & 0xFFFFFFFF)
            sizes.append(min(32, out.size - at))
    return np.array(owners, np.int64), np.array(values, np.int64), np.array(sizes, np.int64)


def riff(stream: bytes) -> bytes:
    body = b"WEBPVP8L" + len(stream).to_bytes(4, "little") + stream + b"\0" * (len(stream) & 1)
    return b"RIFF" + len(body).to_bytes(4, "little") + body


def store(payload: bytes) -> bytes:
    """A payload (a positive multiple of WIDTH bytes) as one lossless image, or several end to end."""
    return store_many([payload])[0]


def store_many(payloads: list[bytes]) -> list[bytes]:
    """Payloads as ``store`` gives them; images are written side by side, GROUP of them and about STEP_BYTES at most."""
    most, out = WIDTH * HEIGHT, [[] for _ in payloads]
    owners, images, held = [], [], 0

    def flush() -> None:
        for k, media in zip(owners, encode_many(images, WIDTH // 4), strict=True):
            out[k].append(media)

    for k, payload in enumerate(payloads):
        for i in range(0, len(payload), most):
            piece = payload[i : i + most]
            if images and (len(images) == GROUP or held + len(piece) > STEP_BYTES):
                flush()
                owners, images, held = [], [], 0
            owners.append(k)
            images.append(np.frombuffer(piece, "<u4"))
            held += len(piece)
    if images:
        flush()
    return [b"".join(x) for x in out]


def load(media: bytes) -> bytes:
    """The payload of stored media."""
    return b"".join(decode(x)[2].astype("<u4").tobytes() for x in files_of(media))


def load_many(stored: list[bytes]) -> list[bytes]:
    """The payloads of stored media, whose images are read side by side."""
    files = [files_of(x) for x in stored]
    pixels = iter(decode_many([x for own in files for x in own]))
    return [b"".join(next(pixels).astype("<u4").tobytes() for _ in own) for own in files]


def files_of(media: bytes) -> list[bytes]:
    at, out = 0, []
    while at < len(media):
        size = 8 + int.from_bytes(media[at + 4 : at + 8], "little")
        out.append(media[at : at + size])
        at += size
    return out


def media_columns(docs: DataFrame, keep_media: bool = False) -> DataFrame:
    """Every text of ``docs`` (doc_id, text) stored as WebP and read back, with digests and a feature.

    The payload is the UTF-8 text with zero bytes up to a positive multiple of 64, so a null or empty
    text is 64 zeros.  The feature is the read image's size, sample sum and 8-bin histogram.  Equal texts
    give equal values; rows are independent, a null doc_id is kept, other columns are not read.  A text
    longer than an image takes several; an empty table gives no row.  One map over the scan, no shuffle.
    """
    fields = [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string())]
    ddl = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    if keep_media:
        fields, ddl = [*fields, ("media", pa.binary())], ddl + ", media binary"
    schema = pa.schema(fields)

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), as_bytes(batch.column(1))
            for a, b in slices(batch, texts):
                rows, own = [], texts[a:b]
                stored = store_many([t + b"\0" * (-len(t) % WIDTH or (0 if t else WIDTH)) for t in own])
                for t, media, got in zip(own, stored, load_many(stored), strict=True):
                    bins = np.bincount(np.frombuffer(got, np.uint8) >> 5, minlength=8).tolist()
                    feature = f"{WIDTH}x{len(got) // WIDTH};{int(np.frombuffer(got, np.uint8).sum(dtype=np.int64))};{','.join(map(str, bins))}"
                    row = (len(t), len(got), hashlib.sha256(got).hexdigest(), zlib.crc32(got[-64:]), len(media), hashlib.sha256(media).hexdigest(), feature, media)
                    rows.append(row[: len(fields) - 1])
                yield record(schema, (ids[a:b], *zip(*rows, strict=True)))

    return docs.select("doc_id", "text").mapInArrow(convert, ddl)
