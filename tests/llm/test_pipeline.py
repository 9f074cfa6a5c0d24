"""The pipeline's stages against brute force on a small table."""

import hashlib
import os

import numpy as np
import public_tokenizers
from conftest import DATA
from pyspark.sql import functions as F
from test_dedup import brute_components, brute_cuts
from test_records import brute_quality
from test_tokens import check_packing
from tokenizers import Tokenizer

import corpus_pipeline
from tarn.llm import queries
from tarn.llm.common import Scratch
from tarn.llm.secrets import all_spans


def rows_of(df):
    return {r["doc_id"]: r.asDict() for r in df.collect()}


def test_stages(spark):
    docs, scratch = spark.read.parquet(f"{DATA}/documents.parquet"), Scratch(spark, "test")
    frames = [rows_of(docs)]
    columns = docs.columns
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = scratch.save(stage(spark, docs, DATA), f"s{i}")
        if i < 4:
            assert docs.columns == columns
            frames.append(rows_of(docs))
    start, good, single, cut, clean = frames
    assert set(good) == {d for d, r in start.items() if not brute_quality(r["text"])[-1]}
    parts = brute_components([(d, r["text"]) for d, r in good.items()])
    assert set(single) == {d for d, _, c in parts if d == c}
    digests = {d: h for d, _, _, h in brute_cuts([(d, r["text"]) for d, r in single.items()])}
    assert {d: hashlib.sha256(b" ".join(r["text"].encode().split())).hexdigest() for d, r in cut.items()} == digests
    assert set(clean) == set(cut)
    for d, r in clean.items():
        spans = all_spans(cut[d]["text"])[0]
        assert (r["text"] == cut[d]["text"]) == (not all_spans(cut[d]["text"])[1]) and r["n_chars"] == len(r["text"])
        assert all(cut[d]["text"][a:b] not in r["text"] for a, _, b in spans)
    library = Tokenizer.from_file(public_tokenizers.path(queries.WORD_BPE))
    ids = {d: [*library.encode(r["text"], add_special_tokens=False).ids, queries.END] for d, r in clean.items()}
    check_packing([r.asDict() for r in docs.collect()], ids, 4096)


def test_frequent_lines_leave_the_texts(spark):
    own = lambda i: " ".join(f"d{'x' * (i % 7)}q{chr(97 + i % 26)}{chr(97 + i // 26)}k{chr(97 + k)}" for k in range(26))
    spam = "Buy   OFFER 17 now é at the best price"
    rows = [(i, f"{own(i)}\n{spam.replace('17', str(i))}\nend {chr(97 + i % 26)}{chr(97 + i // 26)}", "en", "a", 7) for i in range(80)] + [(100 + i, f"{own(i)}\n{spam}", "en", "b", 9) for i in range(10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = rows_of(corpus_pipeline.quality_rules(spark, docs.repartition(3), DATA))
    assert set(got) == {r[0] for r in rows}
    for i, text, *_ in rows:
        left = text if i >= 100 else "\n".join(x for x in text.split("\n") if "OFFER" not in x)
        assert got[i]["text"] == left and got[i]["n_chars"] == (9 if i >= 100 else len(left))


def test_run(spark):
    out = corpus_pipeline.run(spark, DATA)
    assert out.count() > 0 and len(corpus_pipeline.STAGES) == 5
    assert np.all(np.array([r["length"] for r in out.select("length").collect()]) > 0)


def test_a_stage_deletes_what_the_one_before_left(spark):
    docs, scratch = spark.read.parquet(f"{DATA}/documents.parquet"), Scratch(spark, "test")
    folders = []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = scratch.save(stage(spark, docs, DATA), f"d{i}")
        folders.append(next(iter(corpus_pipeline._WORKING.values()))[0].root.removeprefix("file:"))
    assert [os.path.exists(f) for f in folders[:-1]] == [False] * 4
    corpus_pipeline.run(spark, DATA)
    assert not corpus_pipeline._WORKING and not os.path.exists(folders[-1])


def test_stages_take_odd_rows(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "x", 0), (None, "word " * 40, "en", "x", 200), (3, " ".join(f"q{i}" for i in range(90)), None, None, 0), (3, " ".join(f"q{i}" for i in range(90)), None, None, 0)]
    docs, scratch = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), Scratch(spark, "test")
    empty = docs.limit(0)
    clash = {c: F.lit("clash") for c in ("kept", "n_words", "_tarn_may", "_row", "_text", "n", "cid", "component_id", "start", "_queue")}
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs, empty = scratch.save(stage(spark, docs.withColumns(clash), DATA), f"a{i}"), scratch.save(stage(spark, empty, DATA), f"b{i}")
        assert empty.count() == 0 and (i == 4 or docs.columns == list(corpus_pipeline.COLUMNS))
    assert docs.count() > 0
