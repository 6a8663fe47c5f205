"""The pipeline's stages against plain versions, each on its own input, over the smallest tables."""

from __future__ import annotations

import re
import zlib
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from segmill.llm.common import stage
from segmill.llm.packing import END_ID
from segmill.llm.tokens import tokenizer_path
from tests.llm import brute


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, held = docs.columns, {}
    for name, step in corpus_pipeline.STAGES:
        before = pairs(docs)
        docs = stage(step(spark, docs, sf))
        if name != "packing":
            assert docs.columns == columns
            held[name] = (before, pairs(docs))

    before, after = held["language_id"]
    assert set(after) <= set(before) and len(after) >= 0.97 * len(before)
    assert all(not re.search(r"[^\W\d_]", t or "") or len(set(t.split())) < 5 or len(t) < 80 for d, t in set(before) - set(after))

    before, after = held["exact_dedup"]
    assert {i for i, _ in after} == {keep for keep, _ in brute.exact_groups(before).values()}

    before, after = held["jaccard_join"]
    assert {i for i, _ in after} == {i for i, _, c in brute.jaccard_components(before, 5, 80) if i == c}

    before, after = held["decontamination"]
    squash = lambda t: " " + " ".join(brute.NAME.findall(brute.lower(t))) + " "
    items = [squash(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    leaked = {i for i, t in before if any(x in squash(t) for x in items)}
    gone = {i for i, _ in before} - {i for i, _ in after}
    assert leaked <= gone and all(any(len(set(x.split()) & set(squash(t).split())) >= 0.8 * len(set(x.split())) for x in items) for i, t in before if i in gone)

    from tokenizers import Tokenizer

    tokenizer, pieces = Tokenizer.from_file(tokenizer_path()), defaultdict(list)
    for r in docs.collect():
        pieces[r.doc_id].append((r.start, r.length, r.ids_crc32))
    assert pieces.keys() == {i for i, _ in after}
    for i, t in after:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, END_ID], "<u4")
        assert sum(n for _, n, _ in pieces[i]) == len(ids)
        assert all(zlib.crc32(ids[s : s + n].tobytes()) == c for s, n, c in pieces[i])


def test_run_equals_the_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, step in corpus_pipeline.STAGES:
        docs = stage(step(spark, docs, sf))
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    expected = sorted(map(tuple, docs.select(*columns).collect()))
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf).select(*columns).collect())) == expected and len(expected) > 100


def test_stages_on_hard_rows(spark, sf):
    """Nulls, empty texts, repeated rows and columns with names that stages use inside: columns stay, repeated rows stand for themselves."""
    long = " ".join(f"wort{i % 17} und satz{i % 5}" for i in range(80))
    rows = [(1, long), (1, long), (2, None), (3, ""), (None, long + " mehr"), (None, None), (4, "12 !!"), (5, "kurz"), (5, "kurz")]
    docs = spark.createDataFrame([(i, t, "de") for i, t in rows], "doc_id long, text string, lang string")
    for name in ("_id", "_key", "_stays", "key", "n", "digest", "_run", "_file", "_row", "normal", "item_id", "piece", "length", "prediction"):
        docs = docs.withColumn(name, F.lit("clash"))
    for name, step in corpus_pipeline.STAGES[:-1]:
        for given in (docs, docs.limit(0)):
            kept = step(spark, given, sf)
            assert kept.dtypes == docs.dtypes
            got = sorted(pairs(kept), key=repr)
            assert set(got) <= set(rows) and (got or given is not docs or name == "language_id")
    lang = sorted(pairs(corpus_pipeline.language(spark, docs, sf)), key=repr)
    assert all(lang.count(r) in (0, rows.count(r)) for r in rows) and not {(2, None), (3, ""), (4, "12 !!")} & set(lang)
    assert sorted(pairs(corpus_pipeline.decontaminate(spark, docs, sf)), key=repr) == sorted(rows, key=repr)
    exact = pairs(corpus_pipeline.exact(spark, docs, sf))
    assert sorted(exact, key=repr) == sorted([(1, long), (3, ""), (None, long + " mehr"), (4, "12 !!"), (5, "kurz")], key=repr)
