"""A stored text index: postings by word, so that a search reads the words of its query and not the texts.

``postings`` has a row for each word, field and document with the word's places, sorted by word, so a
search's words are pushed down to the files that hold them; ``lengths`` has a row for each document and
field; ``totals`` is one row.  All are Parquet under one folder, built in one pass over the texts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..domain import Domain
from ..errors import unsupported
from .textsearch import FLOOR, K1, B, _fields, mode_of, parse, phrase, query_terms, tokens


class TextIndex:
    """An index in a folder that all executors reach; ``build`` writes it, the other methods read it."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def build(self, df: DataFrame, key: str, fields: Sequence[str] | str, domain: Domain | None = None) -> TextIndex:
        names = _fields(domain, fields)
        rows = [df.select(F.col(key).alias("key"), F.lit(f).alias("field"), tokens(F.col(f)).alias("words")) for f in names]
        words = reduce(DataFrame.unionByName, rows)
        words.select("key", "field", F.size("words").alias("length")).write.parquet(f"{self.root}/lengths")
        placed = words.select("key", "field", F.posexplode("words").alias("place", "term"))
        # dealt by ranges of words, which the grouping below keeps to, so the words are shuffled once
        placed = placed.repartitionByRange("term", "key").groupBy("term", "field", "key").agg(F.sort_array(F.collect_list("place")).alias("places"))
        placed.sortWithinPartitions("term").write.parquet(f"{self.root}/postings")
        by_key = self._read("lengths").groupBy("key").agg(F.sum("length").alias("length"))
        by_key.agg(F.count("*").alias("docs"), F.avg("length").alias("mean")).write.parquet(f"{self.root}/totals")
        return self

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}")

    @staticmethod
    def _is(kind: str, word: str) -> Column:
        return F.col("term") == word if kind == "term" else F.col("term").startswith(word)

    def _found(self, tree) -> DataFrame:
        """(key, field) that a query's tree holds of."""
        kind, postings = tree[0], self._read("postings")
        if kind in ("term", "prefix"):
            found = postings.where(self._is(kind, tree[1])).select("key", "field")
            return found if kind == "term" else found.distinct()
        if kind == "phrase":
            words = tree[1]
            held = postings.where(F.col("term").isin(*set(words))).groupBy("key", "field").agg(F.map_from_entries(F.collect_list(F.struct("term", "places"))).alias("at"))
            follows = lambda p: reduce(lambda a, b: a & b, [F.array_contains(F.col("at")[w], p + i) for i, w in enumerate(words)])
            return held.where((F.size("at") == len(set(words))) & F.exists(F.col("at")[words[0]], follows)).select("key", "field")
        if kind == "not":
            whole = self._read("lengths").select("key", "field") if tree[1] is None else self._found(tree[1])
            return whole.join(self._found(tree[2]), ["key", "field"], "left_anti")
        parts = [self._found(t) for t in tree[1]]
        if kind == "or":
            return reduce(DataFrame.union, parts).distinct()
        return reduce(lambda a, b: a.join(b, ["key", "field"], "left_semi"), parts)

    def search(self, query: str, mode: str | None = None) -> DataFrame:
        """The keys (key) of the documents that match in one of their fields."""
        return self._found(parse(phrase(query) if mode_of(mode) == "phrase" else query)).select("key").distinct()

    def bm25(self, query: str, weights: Mapping[str, float] | None = None, mode: str | None = None, alias: str = "rank") -> DataFrame:
        """(key, rank) of the documents that match; lower is better.  Fields count by their weights (1 if not given)."""
        if weights and not all(isinstance(w, (int, float)) and not isinstance(w, bool) for w in weights.values()):
            raise unsupported("text_search", "weights must be numbers", weights=weights)
        tree = parse(phrase(query) if mode_of(mode) == "phrase" else query)
        terms = query_terms(tree)
        weight = reduce(lambda c, f: c.when(F.col("field") == f, float(weights[f])), weights or {}, F.when(F.lit(False), 0.0)).otherwise(1.0)
        held = self._read("postings").where(reduce(or_, (self._is(*t) for t in terms)))
        counts = held.groupBy("key").agg(*(F.sum(F.when(self._is(*t), F.size("places") * weight).otherwise(0.0)).alias(f"tf{j}") for j, t in enumerate(terms)), *(F.max(self._is(*t).cast("int")).alias(f"has{j}") for j, t in enumerate(terms)))
        # one row each: as many numbers as the query has words
        corpus = self._read("totals").crossJoin(counts.agg(*(F.sum(f"has{j}").alias(f"df{j}") for j in range(len(terms)))))
        lengths = self._read("lengths").groupBy("key").agg(F.sum("length").alias("length"))
        scored = counts.join(self._found(tree).select("key").distinct(), "key", "left_semi").join(lengths, "key").join(F.broadcast(corpus))
        score = F.lit(0.0)
        for j in range(len(terms)):
            df = F.coalesce(F.col(f"df{j}"), F.lit(0))
            idf = F.greatest(F.log((F.col("docs") - df + 0.5) / (df + 0.5)), F.lit(FLOOR))
            score = score + idf * (F.col(f"tf{j}") * (K1 + 1)) / (F.col(f"tf{j}") + K1 * (1 - B + B * F.col("length") / F.col("mean")))
        return scored.select("key", (-score).alias(alias))
