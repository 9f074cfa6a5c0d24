"""Byte-pair machinery: ragged-array merging, word pre-tokens, and a scan that finds byte-level pre-tokens.

Merging works on many pre-tokens at once.  Their symbols lie in one flat array; in each round every
pre-token applies its lowest-ranked pair, wherever it stands, and pre-tokens without a mergeable pair
leave the batch.
"""

from __future__ import annotations

import base64
import json
import re
import unicodedata
from functools import lru_cache

import numpy as np

#: Pre-tokens remembered by a worker; the table is emptied beyond that, so memory is bounded.
MEMO = 500_000
#: Pairs of symbols below this are looked up in a table, others by binary search.
DENSE = 1024
_NONE = np.iinfo(np.int64).max


class Pairs:
    """Mergeable pairs: two symbols to (rank, merged symbol), sorted for binary search."""

    def __init__(self, table: dict[tuple[int, int], tuple[int, int]]) -> None:
        self.table = table
        keys = np.fromiter(((a << 32) | b for a, b in table), np.int64, len(table))
        order = np.argsort(keys)
        self.keys = keys[order]
        self.rank = np.fromiter((r for r, _ in table.values()), np.int64, len(table))[order]
        self.made = np.fromiter((m for _, m in table.values()), np.int64, len(table))[order]

        low = np.flatnonzero((self.keys >> 32 < DENSE) & (self.keys & 0xFFFFFFFF < DENSE))
        self.dense = np.full(DENSE * DENSE, -1, np.int32)
        self.dense[(self.keys[low] >> 32) * DENSE + (self.keys[low] & 0xFFFFFFFF)] = low

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair (_NONE: can't merge) and its place in the table."""
        at = self.dense[np.minimum(left, DENSE - 1) * DENSE + np.minimum(right, DENSE - 1)]
        far = np.flatnonzero((left >= DENSE - 1) | (right >= DENSE - 1))
        if len(far):
            key = (left[far] << 32) | right[far]
            place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            at[far] = np.where(self.keys[place] == key, place, -1)
        return np.where(at >= 0, self.rank[at], _NONE), at


def merge_all(flat: np.ndarray, lengths: np.ndarray, pairs: Pairs) -> list[bytes]:
    """Merge each sequence of the ragged array until no pair of it is mergeable; packed ids of each.

    In every round each sequence applies its lowest-ranked pair, all sequences at once, and at all places
    that it has (see ``places``), so a long sequence takes as many rounds as it has kinds of merges.
    Ranks of the pairs are kept, and only those beside a merge are looked up again.
    """
    out = [b""] * len(lengths)
    flat, owner = flat.astype(np.int64), np.flatnonzero(lengths > 0)
    lengths = lengths[owner]
    if not len(owner):
        return out
    ends = np.cumsum(lengths)
    rank, at = pairs.find(flat, np.append(flat[1:], 0))
    rank[ends - 1] = _NONE  # a pair must not cross into the next sequence
    while len(owner):
        begin = np.cumsum(lengths) - lengths
        least = np.minimum.reduceat(rank, begin)
        live = least < _NONE
        if not live.all():
            done = np.flatnonzero(~live)
            own = lengths[done]
            packed = flat[np.repeat(~live, lengths)].astype("<u4").tobytes()
            stop = np.cumsum(own) * 4
            for i, x, y in zip(owner[done].tolist(), (stop - own * 4).tolist(), stop.tolist(), strict=True):
                out[i] = packed[x:y]
            keep = np.repeat(live, lengths)
            flat, rank, at, owner, lengths, least = flat[keep], rank[keep], at[keep], owner[live], lengths[live], least[live]
            if not len(owner):
                break
        hits, of = places(flat, rank, at, lengths, least, pairs)
        stop = np.cumsum(lengths) - 1
        closes = hits + 1 == stop[of]  # the merge took the sequence's last symbol
        flat[hits] = pairs.made[at[hits]]
        keep = np.ones(len(flat), bool)
        keep[hits + 1] = False
        flat, rank, at = flat[keep], rank[keep], at[keep]
        now = hits - np.arange(len(hits))
        lengths = lengths - np.bincount(of, minlength=len(lengths))
        nearby = np.minimum(now + 1, len(flat) - 1)
        new, place = pairs.find(flat[now], flat[nearby])
        rank[now], at[now] = np.where(closes, _NONE, new), place
        left = now[now > (np.cumsum(lengths) - lengths)[of]]
        rank[left - 1], at[left - 1] = pairs.find(flat[left - 1], flat[left])
    return out


def places(flat: np.ndarray, rank: np.ndarray, at: np.ndarray, lengths: np.ndarray, least: np.ndarray, pairs: Pairs) -> tuple[np.ndarray, np.ndarray]:
    """Where each sequence applies its lowest-ranked pair in this round, and the sequences of these places.

    One merge at a time goes from left to right; its next merge is at the pair's next place unless a merge
    has made a pair of lower rank.  So all places (of overlapping ones every other) go at once where no
    such pair comes up on the way, and the first place alone where one does.
    """
    hits = np.flatnonzero(rank == np.repeat(least, lengths))
    ends = np.cumsum(lengths)
    new = np.ones(len(hits), bool)
    new[1:] = hits[1:] != hits[:-1] + 1
    start = np.flatnonzero(new)
    hits = hits[(np.arange(len(hits)) - np.repeat(start, np.diff(np.append(start, len(hits))))) % 2 == 0]
    of = np.searchsorted(ends, hits, "right")
    first = np.ones(len(hits), bool)
    first[1:] = of[1:] != of[:-1]
    if first.all():
        return hits, of
    several = np.flatnonzero((np.bincount(of, minlength=len(lengths)) > 1)[of])
    i, own = hits[several], of[several]
    made = pairs.made[at[i]]
    beside = np.zeros(len(i), bool)
    beside[1:] = i[1:] == i[:-1] + 2  # the symbol before is made by the merge before
    low = np.zeros(len(i), bool)
    has = i > (ends - lengths)[own]
    low[has] = pairs.find(np.where(beside, made, flat[i - 1])[has], made[has])[0] < least[own[has]]
    has = i + 2 < ends[own]
    low[has] |= pairs.find(made[has], flat[i[has] + 2])[0] < least[own[has]]
    one = np.zeros(len(lengths), bool)
    one[own[low]] = True
    keep = first | ~one[of]
    return hits[keep], of[keep]


# ---------------------------------------------------------------------------------------- words


@lru_cache(maxsize=1)
def byte_letters() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte: printable Latin-1
    stands for itself, every other byte for the next free code point from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = iter(range(256, 512))
    return [chr(b) if b in set(shown) else chr(next(rest)) for b in range(256)]


#: Latin-1 after lower-casing: letters, digits, white space and the rest, as the vocabulary's pattern splits them.
_LETTER = "a-zA-ZªµºÀ-ÖØ-öø-ÿ"
_DIGIT = "0-9²³¹¼-¾"
_SPACE = "\\t-\\r \\x85\\xa0"
_WORD = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_DIGIT}]|[^{_SPACE}{_LETTER}{_DIGIT}]+")


def holes(parts: list) -> list[int]:
    """Places of None."""
    at, i = [], -1
    try:
        while True:
            i = parts.index(None, i + 1)
            at.append(i)
    except ValueError:
        return at


class WordBpe:
    """Lower-casing BPE with word ends, as the library for word_bpe_49k.json gives it.

    Special strings are cut out of a text and stand for their ids; what is between them is split into
    pre-tokens, in Latin-1 here and else by the library's own normaliser and splitter, and merged here.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, end = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"]
        self.special = {t["content"]: np.array([t["id"]], "<u4").tobytes() for t in spec["added_tokens"]}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        letters = byte_letters()
        self.inner = np.array([vocab[c] for c in letters])
        self.last = np.array([vocab[c + end] for c in letters])
        table = {}
        for rank, merge in enumerate(spec["model"]["merges"]):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            table[vocab[a], vocab[b]] = (rank, vocab[a + b])
        self.pairs = Pairs(table)
        self.ids: dict[str, bytes] = dict(self.special)  # no pre-token looks like a special string

    def words(self, text: str) -> list[str]:
        """Pre-tokens of a text without special strings."""
        try:
            text.encode("latin-1")
            return _WORD.findall(text.lower())
        except UnicodeEncodeError:
            normal = self.library.normalizer.normalize_str(text)
            mark = {c: b for b, c in enumerate(byte_letters())}
            return [bytes(mark[c] for c in w).decode("utf-8", "surrogateescape") for w, _ in self.library.pre_tokenizer.pre_tokenize_str(normal)]

    def learn(self, words: set[str]) -> None:
        """Merge the pre-tokens not met yet, all at once."""
        if not words:
            return
        new = list(words)
        encoded = [w.encode("utf-8", "surrogateescape") for w in new]
        lengths = np.fromiter(map(len, encoded), np.int64, len(encoded))
        raw = np.frombuffer(b"".join(encoded), np.uint8)
        flat = self.inner[raw]
        ends = np.cumsum(lengths) - 1
        flat[ends] = self.last[raw[ends]]
        self.ids.update(zip(new, merge_all(flat, lengths, self.pairs), strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        if len(self.ids) > MEMO:
            self.ids = dict(self.special)
        words: list[str] = []
        ends = [0]
        for t in texts:
            if "<|" not in t:
                words += self.words(t)
            else:
                for i, piece in enumerate(self.cut.split(t)):
                    words += [piece] if i % 2 else self.words(piece)
            ends.append(len(words))
        parts = list(map(self.ids.get, words))
        if at := holes(parts):
            self.learn({words[i] for i in at})
            for i in at:
                parts[i] = self.ids[words[i]]
        return [b"".join(parts[a:b]) for a, b in zip(ends, ends[1:])]  # noqa: B905


@lru_cache(maxsize=1)
def word_bpe(path: str) -> WordBpe:
    return WordBpe(path)


# ----------------------------------------------------------------------------------- byte level

#: Codepoint classes.
RESET, LETTER, NUMBER, SYMBOL, BLANK, SPACE = range(6)
#: Inputs of the automaton: classes, with what a look at the neighbours adds.
IN_RESET, IN_LETTER, IN_NUMBER, IN_SYMBOL, IN_QUOTE1, IN_QUOTE2, IN_JOIN, IN_LAST, IN_MID = range(9)
#: States: nothing open, a run of letters, numbers, symbols, a blank that joins what follows, white space,
#: one or two letters of a contraction to come.
FRESH, LETTERS, NUMBERS, SYMBOLS, JOINING, SPACES, ONE, TWO = range(8)


def _automaton() -> tuple[np.ndarray, np.ndarray]:
    """next[input, state] and opens[input, state] (a pre-token starts at this character)."""
    goes, opens = np.zeros((9, 8), np.uint8), np.ones((9, 8), bool)
    for kind, run in ((IN_LETTER, LETTERS), (IN_NUMBER, NUMBERS), (IN_SYMBOL, SYMBOLS)):
        goes[kind] = run
        opens[kind, [run, JOINING]] = False
    goes[IN_LETTER, [TWO, ONE]] = ONE, FRESH
    opens[IN_LETTER, [TWO, ONE]] = False
    for kind, state in ((IN_QUOTE1, ONE), (IN_QUOTE2, TWO)):
        goes[kind] = state
        goes[kind, [SYMBOLS, JOINING]] = SYMBOLS
        opens[kind, [SYMBOLS, JOINING]] = False
    goes[IN_JOIN], goes[IN_LAST], goes[IN_MID] = JOINING, SPACES, SPACES
    opens[IN_MID, SPACES] = False
    goes[IN_RESET] = FRESH
    return goes, opens


_GOES, _OPENS = _automaton()


def scan(inputs: np.ndarray, width: int = 64) -> np.ndarray:
    """The state before each input, starting FRESH.

    Each input is a function from states to states and composing them is associative: rows of
    ``width`` inputs are composed side by side, the rows' functions are scanned in the same way,
    and every row then runs from its own first state.
    """
    n = len(inputs)
    if n <= width:
        states, s = np.empty(n, np.uint8), FRESH
        for i, x in enumerate(inputs.tolist()):
            states[i] = s
            s = int(_GOES[x, s])
        return states
    rows = -(-n // width)
    grid = np.full(rows * width, IN_RESET, np.uint8)
    grid[:n] = inputs
    grid = np.ascontiguousarray(grid.reshape(rows, width).T)
    flat = _GOES.ravel()
    f = np.tile(np.arange(8, dtype=np.uint8), (rows, 1))
    for column in grid:
        f = flat[(column.astype(np.intp) * 8)[:, None] + f]
    entry = _compose(f)
    states = np.empty((width, rows), np.uint8)
    for i, column in enumerate(grid):
        states[i] = entry
        entry = flat[column.astype(np.intp) * 8 + entry]
    return np.ascontiguousarray(states.T).ravel()[:n]


def _compose(f: np.ndarray) -> np.ndarray:
    """The state before each row, given the rows' functions: an exclusive scan by doubling."""
    whole, step = f.copy(), 1
    while step < len(whole):
        later = whole.copy()
        later[step:] = np.take_along_axis(whole[step:], whole[:-step].astype(np.intp), 1)
        whole, step = later, step * 2
    return np.concatenate(([FRESH], whole[:-1, FRESH])).astype(np.uint8)


class ByteBpe:
    """Byte-level BPE by a rank file; pre-tokens as ``pattern`` of the rank files' library splits them."""

    def __init__(self, path: str, pattern: str) -> None:
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.bytes_of = {i: b for b, i in self.ranks.items()}
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)])
        table = {}
        for whole, rank in self.ranks.items():
            for cut in range(1, len(whole)):
                if (a := self.ranks.get(whole[:cut])) is not None and (b := self.ranks.get(whole[cut:])) is not None:
                    table[a, b] = (rank, rank)
        self.pairs = Pairs(table)
        self.classes = np.full(0x110000, 255, np.uint8)
        self.pattern, self.probe = pattern, None
        self.memo: dict[str, bytes] = {}
        self.decimal = [str(i) for i in range(max(self.bytes_of) + 1)]
        #: bytes of all tokens by id, end to end, with each one's size and place
        self.sizes = np.array([len(self.bytes_of.get(i, b"")) for i in range(len(self.decimal))], np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.letters = np.frombuffer(b"".join(self.bytes_of.get(i, b"") for i in range(len(self.decimal))), np.uint8)

    def classify(self, points: np.ndarray) -> np.ndarray:
        """Class of each code point; the table is filled as code points turn up."""
        got = self.classes[points]
        if (got == 255).any():
            for c in np.unique(points[got == 255]).tolist():
                ch = chr(c)
                kind = unicodedata.category(ch)
                if ch == " ":
                    self.classes[c] = BLANK
                elif kind == "Cn":  # perhaps assigned since; the library's own tables decide
                    self.classes[c] = self._ask(ch)
                elif kind[0] in "LN":
                    self.classes[c] = LETTER if kind[0] == "L" else NUMBER
                else:
                    self.classes[c] = SPACE if ch.isspace() and not 0x1C <= c <= 0x1F else SYMBOL
            got = self.classes[points]
        return got

    def _ask(self, ch: str) -> int:
        import tiktoken

        if self.probe is None:
            ranks = {bytes([i]): i for i in range(256)}
            ranks |= {bytes([p, x]): 256 + 256 * k + x for k, p in enumerate(b"a1!") for x in range(128, 256)}
            self.probe = tiktoken.Encoding("classes", pat_str=self.pattern, mergeable_ranks=ranks, special_tokens={})
        joined = [len(self.probe.encode_ordinary(p + ch)) <= len(ch.encode()) for p in "a1!"]
        return (LETTER, NUMBER, SYMBOL)[joined.index(True)] if any(joined) else SPACE

    def offsets(self, texts: list[str]) -> tuple[str, np.ndarray, np.ndarray, np.ndarray]:
        """(joined texts, starts and ends of pre-tokens in it, how many each text has)."""
        joined = "\0".join(texts) + "\0"
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
        kinds = self.classify(points)
        ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1) - 1
        kinds[ends] = RESET
        follow = np.append(kinds[1:], RESET)
        inputs = np.array([IN_RESET, IN_LETTER, IN_NUMBER, IN_SYMBOL, IN_MID, IN_MID], np.uint8)[kinds]
        white = kinds >= BLANK
        last = white & (follow >= LETTER) & (follow <= SYMBOL)
        inputs[last] = np.where(kinds[last] == BLANK, IN_JOIN, IN_LAST)
        quote = np.flatnonzero((points == 39) & (kinds == SYMBOL))
        if len(quote):
            second = points[np.minimum(quote + 1, len(points) - 1)]
            third = points[np.minimum(quote + 2, len(points) - 1)]
            inputs[quote[np.isin(second, [ord(c) for c in "stmd"])]] = IN_QUOTE1
            two = np.isin(second, [ord("r"), ord("v")]) & (third == ord("e")) | (second == ord("l")) & (third == ord("l"))
            inputs[quote[two]] = IN_QUOTE2
        before = scan(inputs)
        opens = _OPENS.ravel()[inputs.astype(np.intp) * 8 + before]
        at = np.flatnonzero(opens)
        stop = np.append(at[1:], len(points))
        real = kinds[at] != RESET
        at, stop = at[real], stop[real]
        return joined, at, stop, np.diff(np.searchsorted(at, ends), prepend=0)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        joined, begin, stop, counts = self.offsets(texts)
        pieces = [joined[a:b] for a, b in zip(begin.tolist(), stop.tolist(), strict=True)]
        if len(self.memo) > MEMO:
            self.memo.clear()
        new, parts = [], []
        found = list(map(self.memo.get, pieces))
        at = holes(found)
        for p in {pieces[i] for i in at}:
            if (whole := self.ranks.get(b := p.encode())) is not None:
                self.memo[p] = whole.to_bytes(4, "little")
            else:
                new.append(p)
                parts.append(b)
        if new:
            lengths = np.fromiter(map(len, parts), np.int64, len(parts))
            flat = self.single[np.frombuffer(b"".join(parts), np.uint8)]
            self.memo.update(zip(new, merge_all(flat, lengths, self.pairs), strict=True))
        for i in at:
            found[i] = self.memo[pieces[i]]
        cut = np.concatenate(([0], np.cumsum(counts))).tolist()
        return [np.frombuffer(b"".join(found[a:b]), "<u4") for a, b in zip(cut, cut[1:])]  # noqa: B905

    def starts(self, ids: np.ndarray) -> np.ndarray:
        """Byte offset of each token in what the ids decode to, and, last, where they end."""
        return np.concatenate((np.zeros(1, np.int64), np.cumsum(self.sizes[ids])))

    def decode(self, ids: np.ndarray, starts: np.ndarray | None = None) -> bytes:
        """The tokens' bytes, each put at its offset."""
        starts = self.starts(ids) if starts is None else starts
        move = np.repeat(self.begins[ids] - starts[:-1], np.diff(starts))
        return self.letters[move + np.arange(int(starts[-1] - starts[0])) + starts[0]].tobytes()


@lru_cache(maxsize=1)
def byte_bpe(path: str, pattern: str) -> ByteBpe:
    return ByteBpe(path, pattern)
