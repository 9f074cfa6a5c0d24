"""Secret scans: fixed patterns, and sliding-window entropy of candidate strings."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from math import log2

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_text, record, slices

# Fixed values of the contract: the base kinds, in the order in which ties are listed.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "entropy")

#: Candidate strings: runs of base64 and URL-safe characters of at least LEAST; `=` only ends one.
WINDOW, LEAST = 24, 16
CANDIDATE = re.compile(rf"[A-Za-z0-9+/_-]{{{LEAST},}}={{0,2}}")
#: Bits a character that a window of WINDOW must reach, for each class of its characters: what all but about 1 %
#: of random strings of the class reach.  Shorter candidates are one window, with bits scaled to its length.
BITS = {"digits": 2.65, "hex": 3.05, "alpha": 3.4, "mixed": 3.6}
#: Candidates that are no secrets: UUIDs, one repeated unit; and see ``plain``.
ALLOWED = re.compile(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}|(.{1,8}?)\1+.{0,8}")
_BETWEEN = re.compile("[^-_]+")
_PARTS, _CONSONANTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+"), re.compile(r"[bcdfghjklmnpqrstvwxz]{6}")
#: How much likelier a letter is in words than in random letters, in bits, rare letters cut to -3.
_LETTER = dict(zip("etaoinshrdlcumwfgypbvkjxqz", (1.7, 1.2, 1.1, 1, 0.9, 0.8, 0.7, 0.7, 0.6, 0.2, 0.1, -0.5, -0.5, -0.7, -0.7, -0.8, -0.9, -0.9, -1, -1.4, -1.9, -2.3, -3, -3, -3, -3), strict=True))

_TERM = [0.0] + [n * log2(n) for n in range(1, WINDOW + 1)]


def character_class(text: str) -> str:
    if text.isdigit():
        return "digits"
    if re.fullmatch("[0-9a-fA-F]+", text):
        return "hex"
    return "alpha" if text.isalpha() else "mixed"


def plain(word: str) -> bool:
    """Whether a candidate is made of words and short numbers: few changes of case and between letters and
    digits, letters as frequent as in words, no long run of consonants."""
    if character_class(word) in ("digits", "hex"):
        return False
    for piece in re.split("[-_/+=]+", word):
        parts = _PARTS.findall(piece)
        if 4 * len(parts) > len(piece) + 8 or any(len(x) > 8 and x[0].isdigit() for x in parts):
            return False
    low = word.lower()
    return sum(_LETTER.get(c, 0) for c in low) >= 0 and not _CONSONANTS.search(low)


def _windows(word: str, start: int) -> list[tuple[int, int]]:
    """Spans of windows of WINDOW characters (all, of a shorter word) that reach the entropy of the class
    of their own characters.

    Counts change by one character entering and one leaving, so a window costs the same whatever its
    length; overlapping windows above the threshold join to one span.
    """
    spans: list[tuple[int, int]] = []
    size = min(WINDOW, len(word))
    scale, most = log2(size) / log2(WINDOW), log2(size)
    counts, total = {}, 0.0
    for i, c in enumerate(word):
        n = counts.get(c, 0)
        total += _TERM[n + 1] - _TERM[n]
        counts[c] = n + 1
        if i >= size:
            old = word[i - size]
            n = counts[old]
            total += _TERM[n - 1] - _TERM[n]
            counts[old] = n - 1
        # only windows that the lowest class would tell are classed
        bits = most - total / size + 1e-9
        if i >= size - 1 and bits >= BITS["digits"] * scale and bits >= BITS[character_class(word[i - size + 1 : i + 1])] * scale:
            a, b = start + i - size + 1, start + i + 1
            if spans and a <= spans[-1][1]:
                a = spans.pop()[0]
            spans.append((a, b))
    return spans


def entropy_spans(text: str) -> list[tuple[int, int]]:
    """Stretches of candidates that look random; a part between dashes or underscores that is shorter than
    a window is a candidate of its own, so that a name before a short key doesn't hide it."""
    spans: list[tuple[int, int]] = []
    for m in CANDIDATE.finditer(text):
        if ALLOWED.fullmatch(m[0]):
            continue
        parts = [(x[0], m.start() + x.start()) for x in _BETWEEN.finditer(m[0]) if LEAST <= len(x[0]) < WINDOW and x[0] != m[0]]
        for word, start in [(m[0], m.start()), *parts]:
            if not ALLOWED.fullmatch(word) and not plain(word):
                spans += _windows(word, start)
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed kinds, by start and then kind."""
    low = text.lower() if ("=" in text or ":" in text) else ""
    found = []
    if low and any(k in low for k in ("passw", "secret", "token", "api")):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def all_spans(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """The base spans, and those together with entropy spans that no base span covers."""
    base = base_spans(text)
    more = [(a, 3, b) for a, b in entropy_spans(text) if not any(x <= a and b <= y for x, _, y in base)]
    return base, sorted(base + more)


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def scan_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans for every row of ``docs`` (doc_id, text).

    Offsets count code points, ends exclusive; spans that begin together are listed by kind.  A null or
    empty text has no spans (the digest is that of the empty string).  Rows are independent: repeated rows
    give equal results, a null doc_id is kept, other columns are not read.  A text of any length is scanned
    whole; an empty table gives no row.  One map over the scan, no shuffle.
    """
    names = ["n_assign", "n_access", "n_hex"]
    schema = pa.schema([("doc_id", pa.int64()), *((n, pa.int64()) for n in names), ("base_sha256", pa.string()), ("spans", pa.string())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), as_text(batch.column(1))
            for a, b in slices(batch, texts):
                rows = []
                for t in texts[a:b]:
                    base, full = all_spans(t)
                    kinds = [k for _, k, _ in base]
                    rows.append((*(kinds.count(k) for k in range(3)), hashlib.sha256(written(base).encode()).hexdigest(), written(full)))
                yield record(schema, (ids[a:b], *zip(*rows, strict=True)))

    return docs.select("doc_id", "text").mapInArrow(scan, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def redact(docs: DataFrame, mark: str = "[REDACTED]") -> DataFrame:
    """The rows of ``docs`` with every span replaced by ``mark``; all rows and other columns stay.

    Overlapping spans become one mark; a null text stays null and an empty one empty.
    """

    @F.pandas_udf("string")
    def clean(texts):
        import pandas as pd

        def one(t):
            if t is None:
                return None
            spans = all_spans(t)[1]
            if not spans:
                return t
            out, at = [], 0
            for a, _, b in spans:
                if a >= at:
                    out += [t[at:a], mark]
                at = max(at, b)
            return "".join([*out, t[at:]])

        return pd.Series([one(t) for t in texts], dtype=object)

    return docs.withColumn("text", clean("text"))
