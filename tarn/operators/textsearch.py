"""Full-text search: MATCH predicates over token arrays, and BM25 ranks.

A query is words (all must occur), ``OR``, ``NOT``, ``"phrases"``, prefixes ending in ``*`` and
parentheses.  Text is tokenised into lower-case runs of letters and digits, inside the JVM.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..domain import Domain
from ..errors import unsupported

MODES = ("websearch", "boolean", "phrase")
#: Published BM25 constants, and the floor of a term's inverse document frequency.
K1, B, FLOOR = 1.2, 0.75, 1e-6
_LEX = re.compile(r'"((?:[^"]|"")*)"|(\()|(\))|([^\s()"]+)')
_WORDS = re.compile(r"[^\W_]+")


def tokens(column: Column) -> Column:
    """Lower-case words of a text (none: an empty array)."""
    split = F.split(F.regexp_replace(F.lower(F.coalesce(column, F.lit(""))), r"[^\p{L}\p{N}]+", " "), " ")
    return F.filter(split, lambda t: t != "")


def mode_of(mode: str | None) -> str:
    if mode is None:
        return "websearch"
    if mode not in MODES:
        raise unsupported("text_search", f"mode {mode!r} is not supported", mode=mode)
    return mode


def phrase(text: str) -> str:
    """The text as a phrase query; one that is quoted already stays."""
    if len(text) >= 2 and text[0] == text[-1] == '"':
        return text
    return '"' + text.replace('"', '""') + '"'


def parse(query: str):
    """Tree of ("term", w), ("prefix", w), ("phrase", [w..]), ("and"|"or", [..]), ("not", a, b)."""
    lexed = []
    for quoted, left, right, word in _LEX.findall(query):
        if left or right:
            lexed.append(left or right)
        elif word in ("AND", "OR", "NOT"):
            lexed.append(word)
        elif word:
            parts = [w.lower() for w in _WORDS.findall(word)]
            if parts and word.endswith("*"):
                lexed += [("term", w) for w in parts[:-1]] + [("prefix", parts[-1])]
            elif len(parts) == 1:
                lexed.append(("term", parts[0]))
            elif parts:
                lexed.append(("phrase", parts))
        elif parts := [w.lower() for w in _WORDS.findall(quoted)]:
            lexed.append(("phrase", parts) if len(parts) > 1 else ("term", parts[0]))
    tree, rest = _either(lexed)
    if rest:
        raise unsupported("text_search", "unbalanced query", query=query)
    if tree is None:
        raise unsupported("text_search", "the query has no words", query=query)
    return tree


def _either(lexed):
    parts = []
    while True:
        tree, lexed = _all(lexed)
        if tree is not None:
            parts.append(tree)
        if not lexed or lexed[0] != "OR":
            break
        lexed = lexed[1:]
    return (None if not parts else parts[0] if len(parts) == 1 else ("or", parts)), lexed


def _all(lexed):
    parts, without = [], []
    while lexed and lexed[0] not in (")", "OR"):
        negative = lexed[0] == "NOT"
        if lexed[0] in ("AND", "NOT"):
            lexed = lexed[1:]
            if not lexed:
                break
        if lexed[0] == "(":
            tree, lexed = _either(lexed[1:])
            lexed = lexed[1:]
        elif isinstance(lexed[0], tuple):
            tree, lexed = lexed[0], lexed[1:]
        else:
            continue
        if tree is not None:
            (without if negative else parts).append(tree)
    tree = None if not parts else parts[0] if len(parts) == 1 else ("and", parts)
    for w in without:
        tree = ("not", tree, w)
    return tree, lexed


def _test(tree, words: Column) -> Column:
    kind = tree[0]
    if kind == "term":
        return F.array_contains(words, tree[1])
    if kind == "prefix":
        return F.exists(words, lambda t: t.startswith(tree[1]))
    if kind == "phrase":  # tokens hold no blanks, so a phrase is a stretch of the joined text
        return F.contains(F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" ")), F.lit(" " + " ".join(tree[1]) + " "))
    if kind == "not":
        return ~_test(tree[2], words) if tree[1] is None else _test(tree[1], words) & ~_test(tree[2], words)
    return reduce(and_ if kind == "and" else or_, (_test(t, words) for t in tree[1]))


def query_terms(tree) -> list[tuple[str, str]]:
    """("term" or "prefix", word) of the tree's positive part, each once."""
    kind = tree[0]
    if kind in ("term", "prefix"):
        return [tree]
    if kind == "phrase":
        return [("term", w) for w in dict.fromkeys(tree[1])]
    if kind == "not":
        return query_terms(tree[1]) if tree[1] else []
    return list(dict.fromkeys(t for part in tree[1] for t in query_terms(part)))


def _fields(domain: Domain | None, fields: Sequence[str] | str) -> list[str]:
    names = [fields] if isinstance(fields, str) else list(fields)
    if not names:
        raise unsupported("text_search", "text search needs a field")
    if domain is not None and (bad := [f for f in names if not domain.is_text_search(f)]):
        raise unsupported("text_search", "fields are not set up for text search", fields=bad)
    return names


def match(fields: Sequence[str] | str, query: str, mode: str | None = None, domain: Domain | None = None) -> Column:
    """Rows where one of the fields matches the query."""
    names = _fields(domain, fields)
    tree = parse(phrase(query) if mode_of(mode) == "phrase" else query)
    return reduce(or_, (_test(tree, tokens(F.col(f))) for f in names))


def bm25(df: DataFrame, key: str, fields: Sequence[str] | str, query: str, weights: Sequence[float] | Mapping[str, float] | None = None, mode: str | None = None, domain: Domain | None = None, alias: str = "rank") -> DataFrame:
    """Matching rows with their BM25 rank under ``alias``; lower is better (the score is negated).

    Two scans: one counts the query's terms and lengths for the statistics of the corpus, which are one row
    (as many numbers as the query has terms) joined back by broadcast; one ranks the rows that match.
    """
    names = _fields(domain, fields)
    if domain is not None and (far := [f for f in names if f in domain.joined]):
        raise unsupported("text_search", "ranks take fields of the root table", fields=far)
    weighed = dict(weights) if isinstance(weights, Mapping) else dict(zip(names, weights or [1.0] * len(names), strict=True))
    if not all(isinstance(w, (int, float)) and not isinstance(w, bool) for w in weighed.values()):
        raise unsupported("text_search", "weights must be numbers", weights=weights)
    tree = parse(phrase(query) if mode_of(mode) == "phrase" else query)
    terms = query_terms(tree)
    counted = df.withColumns({f"_w{i}": tokens(F.col(f)) for i, f in enumerate(names)})
    hit = lambda kind, w: (lambda t: t == w) if kind == "term" else (lambda t: t.startswith(w))
    tf = [sum(F.size(F.filter(F.col(f"_w{i}"), hit(*t))) * F.lit(float(weighed[f])) for i, f in enumerate(names)) for t in terms]
    raw = [sum(F.size(F.filter(F.col(f"_w{i}"), hit(*t))) for i in range(len(names))) for t in terms]
    length = sum(F.size(f"_w{i}") for i in range(len(names)))
    matches = reduce(or_, (_test(tree, F.col(f"_w{i}")) for i in range(len(names))))
    scored = counted.select(*df.columns, length.alias("_len"), matches.alias("_hit"), *(c.alias(f"_tf{j}") for j, c in enumerate(tf)), *(c.alias(f"_n{j}") for j, c in enumerate(raw)))
    totals = scored.agg(F.count("*").alias("_docs"), F.avg("_len").alias("_avg"), *(F.sum((F.col(f"_n{j}") > 0).cast("long")).alias(f"_df{j}") for j in range(len(terms))))
    joined = scored.where("_hit").join(F.broadcast(totals))
    score = F.lit(0.0)
    for j in range(len(terms)):
        df_j = F.col(f"_df{j}")
        idf = F.greatest(F.log((F.col("_docs") - df_j + 0.5) / (df_j + 0.5)), F.lit(FLOOR))
        norm = K1 * (1 - B + B * F.col("_len") / F.col("_avg"))
        score = score + idf * (F.col(f"_tf{j}") * (K1 + 1)) / (F.col(f"_tf{j}") + norm)
    return joined.select(*df.columns, (-score).alias(alias))
