"""Filter audit, best-fit packing and token alignment against plain versions, on hard small tables."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from segmill.llm import best_fit, filter_audit, token_alignment, tokens
from tests.llm import brute
from tests.llm.test_operators import corpus, frame, rows_of

_PIECES = ["a", "b", "é", "ß", "1", "23", " ", "  ", "   ", "\n", "\t", "'", "'s", "'t", "'ll", "'re", "!", "?!", "-", "A", "The", "hello", "12", ".", "x" * 300]
_ODD = ["中", "文字", " ", "　", "😀", "<|endoftext|>", "²", "×", "\x1c", "\x00", "́", "ي", "▁", "<0x41>", "<s>", "ﬁ"]


def mixed(seed, n=300):
    rng = random.Random(seed)
    return ["".join(rng.choices(_PIECES if k % 2 else _PIECES + _ODD, k=rng.randint(0, 30))) for k in range(n)]


@settings(max_examples=25, deadline=None)
@given(st.integers(0, 2**30))
def test_encoders_equal_their_libraries(seed):
    texts = mixed(seed)
    for plain in (False, True):
        own = tokens.ByteLevelEncoder(tokens.tokenizer_path("byte_bpe_50k.json"), plain_specials=plain)
        ids, ends = own.encode(pa.array(texts))
        expected = [e.ids for e in own.tokenizer.encode_batch(texts, add_special_tokens=False)]
        assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:], strict=False)] == expected
    texts = [t for t in texts if t and "▁" not in t]  # a text with the mark itself never aligns
    pieces = tokens.PieceEncoder(tokens.tokenizer_path("piece_bpe_32k.model"))
    ids, ends = pieces.encode(pa.array([" " + t for t in texts]))
    assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:], strict=False)] == pieces.model.encode(texts)


def test_what_encoders_keep_is_bounded():
    """40 MB of texts without spaces: words are not kept, ids go before they pass the bound."""
    rng = random.Random(1)
    path, most = tokens.tokenizer_path(), 4 << 20
    letters = [chr(c) for c in range(0x4E00, 0x4E00 + 3000)]
    encoder = tokens.WordEncoder(path, cache_bytes=most)
    for _ in range(20):
        column = pa.array(["".join(rng.choices(letters, k=5000)) for _ in range(130)])
        ids, ends = encoder.encode(column)
        assert encoder.held <= most + 16 * len(ids) and len(encoder.ids) * 4 <= 2 * most + 16 * len(ids) and sum(map(len, encoder.places[1])) < most
    again, _ = tokens.WordEncoder(path).encode(column)
    assert (again == ids).all()


def labels_of(spark, rows):
    ids = sorted({i for i, _ in rows if i is not None})
    return spark.createDataFrame([(i, i % 3 == 0 and 1 or 0, None if i % 7 == 0 else i % 2) for i in ids if i % 5] + [(ids[0], 1, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")


def plain_audit(rows, labels):
    key = lambda i: (i is not None, i or 0)
    least = {}
    for i, part, text in rows:
        least[text or ""] = min(least.get(text or "", key(i)), key(i))
    marks = defaultdict(lambda: [0, 0])
    for i, quality, toxic in labels:
        marks[i] = [max(marks[i][0], quality == 1), max(marks[i][1], toxic == 1)]
    docs = defaultdict(list)
    for i, part, text in rows:
        t = text or ""
        w = brute.WORD.findall(t)
        fails = {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t), "D": any(c in "#$%&*|" for c in t), "E": key(i) > least[t]}
        docs[part or ""].append((fails, *(marks[i] if i is not None else (0, 0))))
    out = []
    for part, own in docs.items():
        found, total = [], Counter()
        for order in map("".join, permutations("ABCDE")):
            left = list(own)
            for step, f in enumerate(order, 1):
                gone = [d for d in left if d[0][f]]
                left = [d for d in left if not d[0][f]]
                total[f] += len(gone)
                found.append((part, order, step, len(left), len(gone), sum(d[0][f] for d in own) - len(gone), sum([x for x, v in d[0].items() if v] == [f] for d in own), sum(d[1] for d in gone), sum(d[2] for d in gone)))
        out += [(*r, total[r[1][r[2] - 1]]) for r in found]
    return sorted(out)


@pytest.mark.parametrize("block", (filter_audit.BLOCK_ROWS, 7))
def test_filter_audit(spark, monkeypatch, block):
    monkeypatch.setattr(filter_audit, "BLOCK_ROWS", block)
    rng = random.Random(4)
    rows = [(i, rng.choice(["x", "x", "y", None, ""]), rng.choice([t, t, (t or "").upper(), (t or "") + " #"])) for i, t in corpus()]
    labels = labels_of(spark, corpus())
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").withColumn("part", F.lit("clash")).withColumn("fails", F.lit(1)).withColumn("n", F.lit(0)).repartition(3)
    got = filter_audit.filter_audit(spark, docs, labels.withColumn("good", F.lit("clash")))
    assert rows_of(got, *filter_audit.RESULT.names) == sorted(plain_audit(rows, [tuple(r) for r in labels.collect()]), key=repr)
    assert filter_audit.filter_audit(spark, docs.limit(0), labels).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text("ab \t\x0b\n\x1cé", max_size=30), max_size=8), st.integers(1, 9))
def test_word_counts_do_not_depend_on_stretches(texts, stretch):
    before, filter_audit.STRETCH = filter_audit.STRETCH, stretch
    try:
        for t in texts:
            w = brute.WORD.findall(t)
            assert filter_audit.word_counts(memoryview(t.encode())) == (len(w), len(set(w)))
    finally:
        filter_audit.STRETCH = before


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=60))
def test_best_fit_takes_the_fullest_bin_with_room(sizes):
    got = best_fit.best_fit_decreasing(np.array(sizes, np.int64), 20)
    free, out = [], []
    for k in sorted(range(len(sizes)), key=lambda k: -sizes[k]):
        room = [f for f in free if f >= sizes[k]]
        at = free.index(min(room)) if room else len(free)
        free[at : at + 1] = [(free[at] if room else 20) - sizes[k]]
        out.append((k, sizes[k], min(room) if room else 20))
    assert len(set(got[0].tolist())) == len(free)
    assert sorted(out) == [(k, sizes[k], 20 - int(got[1][k])) for k in range(len(sizes))]


def check_packing(got, rows, sequence, end_id):
    encoder = tokens.ByteLevelEncoder(tokens.tokenizer_path("byte_bpe_50k.json"))
    expected = []
    for i, t in rows:
        ids = [*encoder.tokenizer.encode(t or "", add_special_tokens=False).ids, end_id]
        cuts = [0, *range(len(ids) - (len(ids) - 1) // sequence * sequence, len(ids) + 1, sequence)]
        expected += [(i, p, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for p, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]
    assert rows_of(got, "doc_id", "piece", "start", "length", "ids_crc32") == sorted(expected, key=repr)
    places = defaultdict(list)
    for r in got.collect():
        places[r.sequence_id].append((r.offset, r.length))
    for own in places.values():
        own.sort()
        assert all(a + n == b for (a, n), (b, _) in zip(own, own[1:], strict=False)) and own[0][0] == 0 and sum(own[-1]) <= sequence
    return len(places), sum(e[3] for e in expected)


def test_best_fit_packing(spark):
    rows = corpus()
    for more in ({}, dict(block_pieces=10), dict(block_pieces=5, fan=2, residuals=3), dict(block_pieces=1, residuals=2, fan=3)):
        used, total = check_packing(best_fit.best_fit_packing(spark, frame(spark, rows), sequence=256, **more), rows, 256, 0)
        assert used <= -(-total // 256) * (1.3 if more else 1.15) + 2
    assert best_fit.best_fit_packing(spark, frame(spark, rows).limit(0)).count() == 0


def test_residuals_meet_across_tasks(spark):
    """Each task has one short document: only rounds of merging can fill sequences with them."""
    rows = [(i, "word " * 9) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(40, "doc_id")
    got = best_fit.best_fit_packing(spark, docs, sequence=100, fan=3)
    used, total = check_packing(got, rows, 100, 0)
    assert used <= -(-total // 100) + 1


def plain_alignment(rows):
    first = tokens.ByteLevelEncoder(tokens.tokenizer_path("byte_bpe_50k.json"), plain_specials=True).tokenizer
    second = tokens.PieceEncoder(tokens.tokenizer_path("piece_bpe_32k.model")).model
    of_a, of_b = (tokens.TokenBytes.of_byte_level(tokens.tokenizer_path("byte_bpe_50k.json")), tokens.TokenBytes.of_pieces(tokens.tokenizer_path("piece_bpe_32k.model")))
    docs = []
    for i, t in rows:
        whole = (" " + (t or "")).encode()
        a, b = (first.encode(" " + t, add_special_tokens=False).ids, second.encode(t)) if t else ([], [])
        if not t or of_a.joined(np.array(a)).tobytes() != whole or of_b.joined(np.array(b)).tobytes() != whole:
            docs.append((i, [], []))
            continue
        groups, ga, gb, at, bt = [], [], [], 0, 0
        a, b = a[::-1], b[::-1]
        while a or b:
            if at <= bt:
                ga.append(a.pop())
                at += int(of_a.lengths[ga[-1]])
            else:
                gb.append(b.pop())
                bt += int(of_b.lengths[gb[-1]])
            if at == bt:
                groups.append((ga, gb))
                ga, gb = [], []
        docs.append((i, groups, [(x, y) for ga, gb in groups for x in ga for y in gb]))
    counts = Counter(p for _, _, links in docs for p in set(links))
    best = {}
    for (x, _), n in counts.items():
        best[x] = max(best.get(x, 0), n)
    out = []
    for i, groups, links in docs:
        shown = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in groups)
        out.append((i, sum(len(g[0]) for g in groups), sum(len(g[1]) for g in groups), len(groups), len(links), sum(counts[p] == best[p[0]] for p in links), sum(counts[p] for p in links), brute.sha(shown.encode()) if groups else ""))
    return sorted(out, key=repr)


def test_token_alignment(spark, monkeypatch):
    rows = corpus() + [(500 + k, t) for k, t in enumerate(mixed(8, 60))] + [(700, "▁ mark"), (701, "ab" * 900), (702, "".join(chr(0x1F300 + k * 7 % 400) for k in range(300)))]
    expected = plain_alignment(rows)
    assert sum(r[3] > 0 for r in expected) > 100 and any(r[1] == 0 and r[0] == 700 for r in expected)
    for more in ({}, dict(part_text=500), dict(part_text=2000, most_hot=5)):
        got = token_alignment.align_tokenizers(spark, frame(spark, rows), **more)
        assert rows_of(got, *token_alignment.RESULT.names) == expected
    assert token_alignment.align_tokenizers(spark, frame(spark, rows).limit(0)).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.tuples(st.integers(1, 6), st.integers(1, 6)), max_size=6), max_size=4), st.integers(0, 2**30), st.integers(1, 12))
def test_links_and_digests_of_any_group(texts, seed, many):
    """Large groups by distinct ids, digests in stretches: the same as one by one."""
    rng = np.random.default_rng(seed)
    groups = [g for t in texts for g in t]
    of_a, of_b = (np.array([g[k] for g in groups], np.int64) for k in (0, 1))
    a, b = rng.integers(0, 4, of_a.sum()), rng.integers(0, 12000, of_b.sum())
    cuts = token_alignment._before(np.array([len(t) for t in texts], np.int64))
    x = token_alignment.Aligned(a, b, of_a, of_b, token_alignment._before(of_a)[cuts], token_alignment._before(of_b)[cuts], cuts)
    before = token_alignment.MANY_LINKS, token_alignment.PAIRED, token_alignment.WRITTEN
    token_alignment.MANY_LINKS, token_alignment.PAIRED, token_alignment.WRITTEN = many, 7, 3
    try:
        found, shown = token_alignment.linked_pairs(x, 32000), token_alignment.group_digests(x)
    finally:
        token_alignment.MANY_LINKS, token_alignment.PAIRED, token_alignment.WRITTEN = before
    links, written, k = Counter(), [], 0
    ends_a, ends_b = token_alignment._before(of_a), token_alignment._before(of_b)
    for i, t in enumerate(texts):
        pieces = []
        for _ in t:
            ga, gb = a[ends_a[k] : ends_a[k + 1]].tolist(), b[ends_b[k] : ends_b[k + 1]].tolist()
            links.update((i, x * 32000 + y) for x in ga for y in gb)
            pieces.append(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)))
            k += 1
        written.append(brute.sha(";".join(pieces).encode()) if t else "")
    assert list(zip(*(f.tolist() for f in found), strict=True)) == [(*p, n) for p, n in sorted(links.items())] and shown == written


def test_long_texts_take_memory_in_proportion():
    """Peak of what a worker holds for one text of 4 MB, as a multiple of the text."""
    import tracemalloc

    rng = random.Random(1)
    words = ["".join(rng.choices("abcdefghé", k=rng.randint(1, 9))) for _ in range(5000)]
    text = " ".join(rng.choices(words, k=600_000))
    column = pa.array([" " + text], pa.large_string())
    path_a, path_b = tokens.tokenizer_path("byte_bpe_50k.json"), tokens.tokenizer_path("piece_bpe_32k.model")
    first, second = tokens.ByteLevelEncoder(path_a, plain_specials=True), tokens.PieceEncoder(path_b)
    of_a, of_b = tokens.TokenBytes.of_byte_level(path_a), tokens.TokenBytes.of_pieces(path_b)
    aligned = token_alignment.align_texts(column, first, second, of_a, of_b, token_alignment.SpanCounts())
    for work, most in (
        (lambda: filter_audit.text_flags(column), 12), (lambda: first.encode(column), 24), (lambda: token_alignment.align_texts(column, first, second, of_a, of_b, token_alignment.SpanCounts()), 36),
        (lambda: token_alignment.linked_pairs(aligned, 32000), 60), (lambda: token_alignment.group_digests(aligned), 28),
    ):
        tracemalloc.start()
        work()
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < most * len(text.encode()), (most, peak / len(text.encode()))
