"""Every query of the jobs against its SQL on the smallest tables; the rest against properties."""

from __future__ import annotations

import os
import random
from itertools import accumulate

import duckdb
import pytest
import regex

from segmill.jobs import convert, quality
from segmill.jobs.queries import LONG, ORACLES, QUERIES, SMALL, long_samples, usable
from tests.test_segment import plain_inside, plain_split


@pytest.fixture(scope="module")
def tables():
    from tests.conftest import SF

    db = duckdb.connect()
    for name in os.listdir(SF):
        db.sql(f"create view {name.split('.')[0]} as select * from '{SF}/{name}'")
    return db


def ordered(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf, tables, name):
    found = QUERIES[name](spark, sf)
    expected = tables.sql(ORACLES[name])
    assert sorted(found.columns) == sorted(expected.columns)
    assert ordered(found.collect(), found.columns) == ordered(expected.fetchall(), expected.columns)


def test_segments_keep_the_documents(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for name in ("convert_fixed", "convert_random"):
        pieces: dict[int, list[tuple[int, str]]] = {}
        for r in QUERIES[name](spark, sf).collect():
            pieces.setdefault(r.source_idx, []).append((r.k, r.segment))
        for key, parts in pieces.items():
            assert "".join("".join(s for _, s in sorted(parts)).split()) == "".join(texts[key].split())
    assert LONG.fixed_segment_tokens == 128


def test_random_conversion_equals_a_plain_version(spark, sf):
    """Tokens by the regex library, draws and cuts told plainly, pieces by the plain splitter."""
    pattern = regex.compile(r"(?s) ?\p{L}{1,4}| ?\p{N}{1,3}|[ \t\n\x0b\f\r]+|.")

    def plain(text, key, config):
        ends = list(accumulate(len(t) for t in pattern.findall(text)))
        draw, cuts, last = random.Random(config.random_seed + key), [], -1
        while (target := last + draw.randint(config.random_min_tokens, config.random_max_tokens)) < len(ends) - 1:
            last = next((i for i in range(target, len(ends) - 1) if not plain_inside(text, ends[i])), None)
            if last is None:
                break
            cuts.append(last)
        return cuts, plain_split(text, ends, cuts, config.min_step_chars)

    docs = spark.read.parquet(f"{sf}/documents.parquet").where("text <> '' and source <> ''").collect()
    expected = {(r.doc_id, k, s) for r in docs for k, s in enumerate(plain(r.text, r.doc_id, LONG)[1])}
    converted = quality.segment_rows(convert.convert(long_samples(spark, sf), LONG.with_(mode="random")))
    assert {tuple(r) for r in converted.collect()} == expected
    rows = usable(spark, sf).select("source_idx", "gt_output").collect()
    expected = {(r.source_idx, b) for r in rows for b in plain(r.gt_output, r.source_idx, SMALL)[0]}
    assert {tuple(r) for r in QUERIES["boundaries_mersenne"](spark, sf).collect()} == expected


def test_random_boundaries(spark, sf):
    by_row: dict[int, list[int]] = {}
    for r in QUERIES["boundaries_random"](spark, sf).collect():
        by_row.setdefault(r.source_idx, []).append(r.boundary)
    for cuts in by_row.values():
        cuts.sort()
        assert all(b - a >= SMALL.random_min_tokens for a, b in zip([-1, *cuts], cuts, strict=False))


def test_quality_query(spark, sf):
    rows = QUERIES["segment_quality"](spark, sf).collect()
    assert rows and all(r.n_in_word == 0 and r.n_protected_lost == 0 for r in rows)
