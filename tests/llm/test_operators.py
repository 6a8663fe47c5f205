"""Each operator against a plain version, on hard small tables: nulls, ties, empties, clashing columns."""

from __future__ import annotations

import hashlib
import random
import re
import time
import zlib
from collections import Counter, defaultdict
from xml.etree import ElementTree

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from segmill.llm import common, exact_dedup, jaccard_join, langid, license_scan, packing, site_style_tree, string_tiling, suffix_dedup, token_binary, tokens, window_dedup
from segmill.llm.common import stage, text_bytes
from segmill.llm.components import components
from segmill.llm.words import words_of
from tests.llm import brute

#: Names that operators use inside; as columns of the input they must not matter.
CLASH = ("key", "n", "bucket", "part", "answers", "count", "cid", "normal", "digest", "piece", "copied", "low", "row", "flags")


def vocabulary(rng, n=60):
    return ["".join(rng.choices("abcdeé", k=rng.randint(1, 8))) for _ in range(n)]


def corpus(seed=3):
    """Copies, edited copies, shared passages, ties, nulls, empties and a long text."""
    rng = random.Random(seed)
    words = vocabulary(rng)
    text = lambda n: " ".join(rng.choices(words, k=n))
    texts = [text(rng.randint(1, 160)) for _ in range(30)]
    passage = text(50)
    for k in range(14):
        parts = texts[k].split(" ")
        for _ in range(rng.randint(0, 3)):
            parts[rng.randrange(len(parts))] = "changed" + str(rng.randint(0, 5))
        texts.append(" ".join(parts))
    texts += [f"{text(9)} {passage} {text(7)}" for _ in range(4)] + [passage] * 3
    texts += [None, None, "", " \n\t", "a", "a", "A", "!!!", "x" * 150, "x" * 150 + "y", text(3000), texts[0].upper(), texts[1], texts[1], "é" * 70 + " z" * 80]
    rows = [(i * 3 % 101, t) for i, t in enumerate(texts)]
    rows += [(None, texts[2]), (None, "only here " + text(40)), rows[5], rows[5], (7, "other text of a used id")]
    rng.shuffle(rows)
    return rows


def frame(spark, rows, lang=None):
    df = spark.createDataFrame([(i, t) for i, t in rows], "doc_id long, text string")
    df = df.withColumn("lang", F.lit(lang).cast("string"))
    for name in CLASH:
        df = df.withColumn(name, F.lit("clash"))
    return df.repartition(3)


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_suffix_dedup(spark):
    rows = corpus()
    for length, gram, more in ((100, 24, {}), (30, 8, dict(buckets=5)), (30, 8, dict(buckets=3, part_text=400, hot=2)), (100, 24, dict(part_text=3000, hot=3))):
        got = suffix_dedup.suffix_dedup(spark, frame(spark, rows), length=length, gram=gram, **more)
        assert rows_of(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == sorted(brute.suffix_dedup(rows, length), key=repr)


@settings(max_examples=100, deadline=None)
@given(st.integers(0, 40), st.integers(1, 3), st.integers(0, 2**30))
def test_deep_shallow_sorts(n, words, seed):
    rng = np.random.default_rng(seed)
    rows, group = rng.integers(0, 3, (n, 8 * words)).astype(np.uint8), rng.integers(0, 3, n)
    rows[rng.integers(0, max(n, 1), n // 2) if n else []] = rows[:1]
    for shallow in (0, 8, 16):
        strings = [(group[i], rows[i].tobytes()) for i in suffix_dedup.deep_shallow(rows, group, shallow)]
        assert strings == sorted(strings) and len(strings) == n


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**30), st.integers(2, 5))
def test_repeated_strings_at_one_anchor(seed, letters):
    """Places of some anchors, each in random bytes (zeros among them): strings against a set of those seen."""
    rng, length, gram = random.Random(seed), 12, 4
    raw, group, at, back, strings, expected, seen = b"", [], [], [], [], [], set()
    for _ in range(40):
        own = rng.randrange(2)
        b = rng.randint(0, length - gram)
        n = rng.randint(1, b + 1)
        whole = bytes(rng.randrange(letters) for _ in range(b)) + bytes([own] * gram) + bytes(rng.randrange(letters) for _ in range(length + n - 1 - b - gram))
        group, at, back, strings, raw = [*group, own], [*at, len(raw) + b], [*back, b], [*strings, n], raw + whole
        for j in range(n):
            key = (own, b - j, whole[j : j + length])
            expected.append(key in seen)
            seen.add(key)
    flags = suffix_dedup.repeated_strings(np.frombuffer(raw, np.uint8), *map(np.array, (group, at, back, strings)), length, gram, 8)
    assert [bool(x) for f, n in zip(flags, strings, strict=True) for x in f[:n]] == expected


def test_anchors_do_not_depend_on_stretches(monkeypatch):
    data, offsets = np.random.default_rng(1).integers(0, 4, 9000).astype(np.uint8), np.array([0, 50, 50, 3000, 3099, 3199, 9000])
    whole = suffix_dedup.anchors_of(data, offsets, 100, 24)
    monkeypatch.setattr(suffix_dedup, "_STRINGS", 777)
    assert all((x == y).all() for x, y in zip(vars(whole).values(), vars(suffix_dedup.anchors_of(data, offsets, 100, 24)).values(), strict=True))


def test_long_texts_need_little_beside_themselves():
    """Peak of what a worker holds for one text of 50 MB, as a multiple of the text."""
    import tracemalloc

    import pyarrow as pa

    text = (b"word " * 3 + b"other words and more of them 12345 ") * (1 << 20)
    column = pa.array([text.decode()], pa.large_string())
    for work, most in (
        (lambda: suffix_dedup.anchors_of(*text_bytes(column), 100, 24), 12),
        (lambda: window_dedup.window_hashes(words_of(column), 35), 16),
        (lambda: words_of(column).hashes(), 12),
        (lambda: langid.mean_scores(langid.ByteNet(["a", "b"], 1, 1), *text_bytes(column), langid.WINDOW), 2),
    ):
        tracemalloc.start()
        work()
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < most * len(text)


def test_window_dedup(spark):
    rows = corpus()
    for window, part_text in ((35, 4 << 20), (4, 4 << 20), (4, 500)):
        got = window_dedup.window_dedup(spark, frame(spark, rows), window=window, buckets=4, part_text=part_text)
        assert rows_of(got, "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(brute.window_dedup(rows, window), key=repr)
    text = rows_of(window_dedup.window_dedup(spark, frame(spark, rows), with_text=True), "kept_text", "kept_sha256")
    assert all(hashlib.sha256(t.encode()).hexdigest() == s for t, s in text)


@pytest.mark.parametrize(("gram", "percent"), [(3, 90), (5, 80), (1, 50)])
def test_jaccard_components(spark, gram, percent):
    rows = corpus()
    got = jaccard_join.jaccard_components(spark, frame(spark, rows), gram, percent, buckets=3, part_text=2000)
    assert rows_of(got, "doc_id", "n_shingles", "component_id") == sorted(brute.jaccard_components(rows, gram, percent), key=repr)


def test_jaccard_chains_and_many_near_copies(spark):
    rng = random.Random(9)
    base = [f"w{i}" for i in range(80)]
    rows = []
    for i in range(70):  # copies of copies: the ends of the chain do not link
        base = base[:]
        base[rng.randrange(80)] = f"e{i}"
        rows.append((i, " ".join(base)))
    got = jaccard_join.jaccard_components(spark, frame(spark, rows), buckets=2)
    assert rows_of(got, "doc_id", "n_shingles", "component_id") == sorted(brute.jaccard_components(rows), key=repr)


def test_hot_ngrams_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(common, "MOST_HOT", 4)
    rng = random.Random(3)
    base = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(w if rng.random() > 0.02 else f"e{rng.randrange(9)}" for w in base)) for i in range(120)] + corpus()
    got = jaccard_join.jaccard_components(spark, frame(spark, rows), buckets=2, part_text=3000)
    assert rows_of(got, "doc_id", "n_shingles", "component_id") == sorted(brute.jaccard_components(rows), key=repr)


def test_shares_of_pivots_and_of_ngrams(spark, monkeypatch):
    """With shares of two, nearly every member is there in copies; links stay the same."""
    for name in ("count_overlaps", "_pairs_across"):
        real = getattr(jaccard_join, name)
        monkeypatch.setattr(jaccard_join, name, lambda *a, real=real: real(*a, share=2))
    rng = random.Random(4)
    base = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(w if rng.random() > 0.03 else f"e{rng.randrange(9)}" for w in base)) for i in range(80)] + corpus()
    got = jaccard_join.jaccard_components(spark, frame(spark, rows), buckets=2)
    assert rows_of(got, "doc_id", "n_shingles", "component_id") == sorted(brute.jaccard_components(rows), key=repr)


def test_a_hub_of_100000_members_is_dealt_out(spark, monkeypatch):
    """No key of the overlap's joins has much more than a share of the pairs, whichever side the pivot is on."""
    monkeypatch.setattr(common, "MOST_HOT", 8)  # so that the pivots' counts are broadcast
    grams = F.array(F.array(*[F.lit(g).cast("long") for g in range(9)]), F.array(F.col("id")))
    sets = stage(spark.range(100_003).select(F.col("id").alias("cid"), F.lit(10).cast("long").alias("n"), grams.alias("fragments")))
    for hub, a, b in ((0, F.lit(0).cast("long"), F.col("id")), (100_002, F.col("id"), F.lit(100_002).cast("long"))):
        pairs = stage(spark.range(1, 100_001).select(a.alias("a"), b.alias("b")))
        dealt, copies = jaccard_join._dealt(pairs, pairs, sets, *(("a", "b") if hub == 0 else ("b", "a")), 1000)
        own = "a" if hub == 0 else "b"
        per_key = dealt.groupBy(own, f"copy_{own}").count().agg(F.max("count"), F.count("*")).first()
        assert per_key[0] < 1200 and per_key[1] == 100 and copies.count() == 200
        assert jaccard_join.count_overlaps(pairs, sets, 80).count() == 100_000  # 9 of 11 n-grams
        assert jaccard_join.count_overlaps(pairs, sets, 90).isEmpty()
        assert components(pairs, hub_edges=1000).select("comp").distinct().count() == 1


def test_keep_one(spark):
    rows = [r for r in corpus() if r[0] is not None and r[0] != 7]
    kept = jaccard_join.keep_one(spark, frame(spark, rows))
    expected = {i for i, _, c in brute.jaccard_components(rows, 5, 80) if i == c}
    assert {r.doc_id for r in kept.collect()} == expected and kept.columns == frame(spark, rows).columns


@pytest.mark.parametrize("digest_bytes", [32, 1])
def test_exact_dedup(spark, digest_bytes):
    rows = corpus()
    got = exact_dedup.exact_dedup(spark, frame(spark, rows), digest_bytes=digest_bytes, files_per_batch=1).collect()
    groups = brute.exact_groups(rows)
    expected = sorted(((i, *groups[brute.lower(t or "")], brute.sha(brute.lower(t or "").encode())) for i, t in rows), key=repr)
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=repr) == expected
    kept = [r for r in got if r.kept]
    assert len(kept) == len({r.text_sha256 for r in got}) and all(r.doc_id == r.keep_id for r in kept)


@pytest.mark.parametrize("digest_bytes", [32, 1])
def test_a_store_meets_the_documents_of_earlier_runs(spark, tmp_path, digest_bytes):
    rows = corpus()
    thirds, store, seen = [rows[::3], rows[1::3], rows[2::3]], f"file://{tmp_path}/store", []
    for k, part in enumerate(thirds):
        docs, located = frame(spark, part), k == 1
        if located:
            docs.write.parquet(f"{tmp_path}/docs")
            docs = spark.read.parquet(f"{tmp_path}/docs")
        seen += part
        groups = brute.exact_groups(seen)
        got = exact_dedup.exact_dedup(spark, docs, digest_bytes, store=store, located=located).collect()
        assert sorted(((r.doc_id, r.keep_id, r.group_size) for r in got), key=repr) == sorted(((i, *groups[brute.lower(t or "")]) for i, t in part), key=repr)
    assert "RocksDB" in (tmp_path / "store/checkpoint/offsets/0").read_text()
    assert exact_dedup.exact_dedup(spark, frame(spark, []), digest_bytes, store=store).count() == 0
    again = exact_dedup.exact_dedup(spark, frame(spark, rows[:5]), digest_bytes, store=store).collect()
    assert all(r.group_size == 1 + groups[brute.lower(t or "")][1] for (i, t), r in zip(sorted(rows[:5], key=repr), sorted(again, key=lambda r: repr((r.doc_id, dict(rows[:5])[r.doc_id]))), strict=True))


def plain_groups(runs, k):
    """exact_dedup() of run k, told plainly: its rows among those of all runs up to it."""
    every = [(i, brute.lower(t or "")) for rows in runs[: k + 1] for i, t in rows]
    groups = defaultdict(list)
    for i, t in every:
        groups[t].append(i)
    last = {t: max(own, key=lambda i: (i is not None, i or 0)) for t, own in groups.items()}
    return sorted(((i, last[brute.lower(t or "")], len(groups[brute.lower(t or "")])) for i, t in runs[k]), key=repr)


@pytest.mark.parametrize("fails", ("stream_groups", "stage", "join_counted"))
def test_a_failed_run_is_taken_up_again(spark, tmp_path, monkeypatch, fails):
    """It fails after its events are written, after its stream, or later; the same documents again count once."""
    rows, store = corpus(), f"file://{tmp_path}/store"
    first, second = rows[::2], rows[1::2]
    read = lambda df: rows_of(df, "doc_id", "keep_id", "group_size")
    assert read(exact_dedup.exact_dedup(spark, frame(spark, first), store=store)) == plain_groups([first], 0)
    docs = stage(frame(spark, second))
    for _ in range(2):
        with monkeypatch.context() as m:
            real = getattr(exact_dedup, fails)
            m.setattr(exact_dedup, fails, lambda *a: real(*a) if fails == "stage" and len(a) > 1 else (_ for _ in ()).throw(RuntimeError("lost")))
            with pytest.raises(RuntimeError, match="lost"):
                exact_dedup.exact_dedup(spark, docs, store=store, located=True)
    assert read(exact_dedup.exact_dedup(spark, docs.select("*"), store=store, located=True)) == plain_groups([first, second], 1)
    assert read(exact_dedup.exact_dedup(spark, docs, store=store, located=True)) == plain_groups([first, second, second], 2)  # done, so a run of its own
    assert sorted(p.name for p in (tmp_path / "store/events").iterdir()) == ["run-0", "run-1", "run-2"]


def test_half_written_events_are_replaced_and_a_run_id_repeats(spark, tmp_path):
    rows, store = corpus(), f"file://{tmp_path}/store"
    read = lambda df: rows_of(df, "doc_id", "keep_id", "group_size")
    exact_dedup.exact_dedup(spark, frame(spark, rows[:9]), store=store, run_id="a").count()
    other = f"file://{tmp_path}/other"
    exact_dedup.exact_dedup(spark, frame(spark, rows[:3]), store=other).count()
    (tmp_path / "other/events/run-0").rename(tmp_path / "store/events/run-1")  # another job's events, without the mark that they are whole
    (tmp_path / "store/events/run-1/_SUCCESS").unlink()
    for _ in range(2):
        assert read(exact_dedup.exact_dedup(spark, frame(spark, rows[9:]), store=store, run_id="b")) == plain_groups([rows[:9], rows[9:]], 1)
    assert read(exact_dedup.exact_dedup(spark, frame(spark, rows[:9]), store=store, run_id="a")) == plain_groups([rows[:9]], 0)


def test_hot_digests_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(common, "MOST_HOT", 3)
    rows = [(i, "hot" if i % 2 else f"t{i % 20}") for i in range(200)]
    got = exact_dedup.exact_dedup(spark, frame(spark, rows)).collect()
    groups = brute.exact_groups(rows)
    assert sorted((r.doc_id, r.keep_id, r.group_size) for r in got) == sorted((i, *groups[t]) for i, t in rows)
    assert sum(r.kept for r in got) == 11


def test_drop_copies(spark):
    rows = corpus()
    kept = exact_dedup.drop_copies(spark, frame(spark, rows))
    assert kept.columns == frame(spark, rows).columns
    found = rows_of(kept, "doc_id", "text")
    assert sorted(brute.lower(t or "") for _, t in found) == sorted(brute.exact_groups(rows))
    assert all(i == brute.exact_groups(rows)[brute.lower(t or "")][0] for i, t in found)


def test_language_id(spark):
    rng = random.Random(4)
    words = {"aa": vocabulary(rng), "bb": ["".join(rng.choices("mnopqr", k=5)) for _ in range(60)]}
    rows = [(i, " ".join(rng.choices(words[x], k=rng.randint(5, 200))), x) for i in range(300) for x in [rng.choice(["aa", "bb"])]]
    rows += [(1000, None, "aa"), (1001, "", None), (1002, "123 !!", "bb"), (1003, " ".join(words["aa"] * 90), None), (None, "mnop qrmn", "bb")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    got = {r.doc_id: r for r in langid.language_id(spark, docs, train_rows=150).collect()}
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got.values())
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (1000, 1001, 1002)) and got[1003].lang_pred == "aa"
    held = [i for i, _, _ in rows[:300] if zlib.crc32(str(i).encode()) % 4 == 2]
    assert held and all(got[i].held_out for i in held) and sum(r.held_out for r in got.values()) >= len(held)
    assert np.mean([got[i].lang_pred == x for i, _, x in rows[:300]]) > 0.97
    none = langid.language_id(spark, docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in none} == {"und"}
    again = {r.doc_id: r.score for r in langid.language_id(spark, docs.repartition(2), train_rows=150).collect()}
    assert all(abs(again[i] - r.score) < 1e-5 for i, r in got.items())
    assert langid.keep_known(spark, docs).columns == docs.columns


def test_language_id_on_the_given_tables(spark):
    """Held-out accuracy; lang of held-out documents is never read."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lang = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    hidden = docs.withColumn("lang", F.when(~langid.held_out(F.col("doc_id")), F.col("lang")))
    got = langid.language_id(spark, hidden).collect()
    right = [r.lang_pred == lang[r.doc_id] for r in got if r.held_out and lang[r.doc_id] is not None and r.lang_pred != "und"]
    assert len(right) > 200 and np.mean(right) > 0.98


def test_network_gradients():
    net = langid.ByteNet(["a", "b", "c"], embed=3, filters=2)
    rng = np.random.default_rng(0)
    net.weights = [w.astype(np.float64) for w in net.weights]
    x, y, weight = rng.integers(0, 256, (4, 20)).astype(np.uint8), np.array([0, 1, 2, 1]), np.ones(4)
    loss = lambda: -np.log(net.predict(x).astype(np.float64)[np.arange(4), y]).mean()
    grads = net._gradients(x, y, weight, net.mask())
    for w, g in zip(net.weights, grads, strict=True):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        w[at] += 1e-3
        up = loss()
        w[at] -= 2e-3
        down = loss()
        w[at] += 1e-3
        assert abs((up - down) / 2e-3 - g[at]) < 1e-2 * max(1, abs(g[at]))


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a="</p><p>no";</script></head><body>
<nav><ul><li><a href=x>Home</a><li>News</ul></nav><div class="cookie-notice">We use cookies</div>{body}
<aside>See also</aside><section id=comments><p>First!</p></section><form>Name <input></form><footer>&copy; me</footer></body></html>"""


def test_main_text(spark):
    article = "<article><h1>A &amp; B</h1><p><b>One\n  two<br>three<p>Four&nbsp;five</p><div class=share>Share</div><ul><li>six<li>seven</ul></article>"
    plain = "<div class=x1><p>Unique text number {i} of this page, long enough to matter.</p></div><div class=x2>Same words everywhere</div>"
    rows = [(1, "http://h/1", PAGE.format(body=article)), (2, None, None), (3, "http://h/3", ""), (4, "http://h/4", "just text"), (1, "http://h/1", PAGE.format(body=article))]
    rows += [(100 + i, f"https://site.example/{i}", PAGE.format(body=plain.format(i=i))) for i in range(12)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("clash")).withColumn("blocks", F.lit(1)).repartition(3)
    got = defaultdict(list)
    for r in site_style_tree.extract_main_text(spark, pages).collect():
        got[r.page_id].append(r.text)
        assert r.n_chars == len(r.text)
    assert got[1] == ["A & B\nOne two three\nFour five\nsix\nseven"] * 2
    assert got[2] == got[3] == [""] and got[4] == ["just text"]
    assert all(got[100 + i] == [f"Unique text number {i} of this page, long enough to matter."] for i in range(12))


def test_packing(spark):
    rows = corpus()
    encoder = tokens.WordEncoder(tokens.tokenizer_path()).tokenizer
    for sequence in (4096, 64):
        got = packing.pack_documents(spark, frame(spark, rows), sequence=sequence, group_pieces=40).collect()
        bins, whole = defaultdict(list), defaultdict(list)
        for r in got:
            bins[r.sequence_id].append((r.offset, r.length))
            whole[r.doc_id].append((r.start, r.length, r.ids_crc32, r.doc_tokens))
        for held in bins.values():
            held.sort()
            assert [o for o, _ in held] == [sum(n for _, n in held[:i]) for i in range(len(held))] and sum(n for _, n in held) <= sequence
        expected = defaultdict(list)
        for i, t in rows:
            ids = np.array([*encoder.encode(t or "", add_special_tokens=False).ids, packing.END_ID], "<u4")
            for s in range(0, len(ids), sequence):
                part = ids[s : s + sequence]
                expected[i].append((s, len(part), zlib.crc32(part.tobytes()), len(ids)))
        assert {k: sorted(v) for k, v in whole.items()} == {k: sorted(v) for k, v in expected.items()}


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=60))
def test_first_fit_decreasing(sizes):
    bins, offsets = packing.first_fit_decreasing(np.array(sizes), 20)
    room, place = [], {}
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        k = next((k for k, r in enumerate(room) if r >= sizes[i]), len(room))
        room += [20] * (k == len(room))
        place[i] = (k, 20 - room[k])
        room[k] -= sizes[i]
    assert {i: (b, o) for i, (b, o) in enumerate(zip(bins.tolist(), offsets.tolist(), strict=True))} == place


def test_string_tiling(spark):
    rng = random.Random(8)
    words = [f"{a}{b}" for a in "bcdfgh" for b in "aeiou"]
    item = " ".join(rng.choices(words, k=40))
    w = item.split()
    reordered = " ".join(w[20:] + ["noise"] * 3 + w[:20])
    docs = [
        (1, f"intro {item.upper()}! outro"), (2, reordered), (3, " ".join(w[:20])), (4, None), (5, ""), (None, item), (6, " ".join(rng.choices(words, k=5000)) + " " + item),
        (7, item.replace(" ", ", ")), (8, " ".join(x for i, x in enumerate(w) if i % 4)), (1, f"intro {item.upper()}! outro"),
    ]
    items = [(10, item), (11, "too short here"), (12, None), (13, ""), (14, " ".join(rng.choices(words, k=30)))]
    documents, tests = frame(spark, docs), spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1))
    for block in (4 << 20, 200):
        got = string_tiling.tile_documents(spark, documents, tests, block_bytes=block).collect()
        assert sorted(((r.doc_id, r.item_id) for r in got), key=repr) == sorted([(i, 10) for i in (1, 1, 2, None, 6, 7)], key=repr)
        assert {r.doc_id: (r.tiles, r.covered_words) for r in got}[2] == (2, 40)
    kept = string_tiling.drop_contaminated(spark, documents, tests)
    assert rows_of(kept, "doc_id") == sorted([(3,), (4,), (5,), (8,)], key=repr) and kept.columns == documents.columns


def test_repeated_words_take_little_memory():
    """An item and a text of one word, or of three in turn: tiles are right, and memory follows the item and the text."""
    import tracemalloc

    for words, item, text in (([7], 200, 4000), ([1, 2, 3], 90, 3000)):
        a, b = (np.resize(np.array(words, np.uint64), n) for n in (item, text))
        tracemalloc.start()
        tiles = string_tiling.tile(a, b, 5)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert tiles == [(0, 0, item)] and peak < 8 << 20


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=24), st.lists(st.integers(0, 3), max_size=40), st.integers(1, 4), st.sampled_from([2, 5, 20]))
def test_tiles_equal_plain_greedy_tiling(a, b, least, search):
    tiles = string_tiling.tile(np.array(a, np.uint64), np.array(b, np.uint64), least, search)
    free_a, free_b, expected = [True] * len(a), [True] * len(b), []
    while True:  # mark the longest common run of what is unmarked, the first in a, then in b
        runs = {}
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and free_a[i + n] and free_b[j + n]:
                    n += 1
                runs[i, j] = n
        i, j = min(runs, key=lambda k: (-runs[k], k), default=(0, 0))
        n = runs.get((i, j), 0)
        if n < least:
            break
        free_a[i : i + n], free_b[j : j + n] = [False] * n, [False] * n
        expected.append((i, j, n))
    assert tiles == expected


def test_short_and_equal_test_items(spark):
    docs = [(1, "it says: To BE, or not! the end"), (2, "to be not or"), (3, "to"), (4, None), (5, "or not to be"), (1, "to be or not")]
    items = [(1, "to be or not"), (2, "To be; or NOT"), (1, "to be or not"), (3, "or"), (None, "to be or not"), (4, "... !"), (5, "\n")]
    tests = spark.createDataFrame(items, "item_id long, text string")
    for block in (1 << 20, 1):
        got = string_tiling.tile_documents(spark, frame(spark, docs), tests, block_bytes=block).collect()
        whole = [(i, k) for i in (1, 1) for k in (1, 2, 1, None)]
        assert sorted(((r.doc_id, r.item_id) for r in got), key=repr) == sorted(whole + [(i, 3) for i in (1, 2, 5, 1)], key=repr)
        assert all(r.coverage == 1 and r.tiles == 1 for r in got)
    kept = string_tiling.drop_contaminated(spark, frame(spark, docs + docs), tests.where("item_id <> 3"))
    assert rows_of(kept, "doc_id") == sorted([(i,) for i in (2, 3, 4, 5)] * 2, key=repr) and kept.columns == frame(spark, docs).columns


def test_token_binary(spark):
    rows = corpus()
    encoder = tokens.WordEncoder(tokens.tokenizer_path()).tokenizer
    got = token_binary.token_binary(spark, frame(spark, rows)).collect()
    expected, at = [], 0
    by_start = sorted(((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in got))
    for start, _, n, _ in by_start:
        assert start == at
        at += n
    assert [i if i is not None else -1 for _, i, _, _ in by_start] == sorted(-1 if i is None else i for i, _ in rows)
    for i, t in rows:
        ids = np.array([*encoder.encode(t or "", add_special_tokens=False).ids, token_binary.END_ID], "<u4")
        expected.append((i, len(ids), zlib.crc32(ids.tobytes())))
    assert sorted(((i, n, c) for _, i, n, c in by_start), key=repr) == sorted(expected, key=repr)


def test_token_files_stand_alone(spark, tmp_path):
    rows = corpus()
    token_binary.write_files(spark, frame(spark, rows), f"file://{tmp_path}/tokens")
    got = token_binary.read_files(spark.newSession(), f"file://{tmp_path}/tokens", with_ids=True).collect()
    expected = [(i, [*ENCODER.tokenizer.encode(t or "", add_special_tokens=False).ids, token_binary.END_ID]) for i, t in rows]
    assert sorted(((r.doc_id, r.ids) for r in got), key=repr) == sorted(expected, key=repr)
    assert all(r.n_tokens == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in got)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1)))
def test_packed_ranks_round_trip(ranks):
    control, data = token_binary.pack(np.array(ranks, np.uint32))
    assert token_binary.unpack(control, data, len(ranks)).tolist() == ranks and len(control) == -(-len(ranks) // 4)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="aEé ÀßσΣ'’strevmld1٣!#<|>\n\t́中×endoftx", max_size=30), max_size=6))
def test_word_encoder_equals_the_tokenizer(texts):
    import pyarrow as pa

    texts.append("<|endoftext|> it's")
    ids, ends = ENCODER.encode(pa.array([*texts, None], pa.string()))
    assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:], strict=False)] == [ENCODER.tokenizer.encode(t, add_special_tokens=False).ids for t in [*texts, ""]]


ENCODER = tokens.WordEncoder(tokens.tokenizer_path(), cache_bytes=9000)


def test_license_scan(spark):
    texts = [
        "Under the GNU General Public License, or GNU general\npublic-license.", "the MIT License and the submit license", "cc-by and CC BY 4.0", None, "", "!!!",
        "Permision is hereby granted, free of charge, to any persn obtaining a copy", "apache licence", "nothing here", "word " * 4000 + "apache license", "gnu generall public licens",
    ]
    rows = [*enumerate(texts), (0, texts[0]), (None, "mit license")]
    got = license_scan.license_scan(spark, frame(spark, rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        text = "mit license" if r.doc_id is None else texts[r.doc_id]
        n, hits = brute.phrases(text, license_scan.BASE)
        assert (r.n_words, r.n_base) == (n, len(hits)) and (r.first_word, r.last_word) == (min((i for i, _ in hits), default=None), max((i for i, _ in hits), default=None))
        assert r.base_labels == ",".join(sorted({x for _, x in hits})) and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
    by_id = {r.doc_id: r for r in got}
    assert by_id[6].labels == "mit" and by_id[6].spans[0].edits == 2 and by_id[10].labels == "gpl" and by_id[8].labels == "" == by_id[3].labels


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def test_notices_against_plain_edit_distance():
    """Every stretch of whole words within the edits is a span or meets one with no more edits: recall 1."""
    phrase, rng = "free software foundation", random.Random(1)
    scanner = license_scan.Scanner({}, {phrase: "x"}, 12, 4)

    def noisy():
        p = list(phrase)
        for _ in range(rng.randint(0, 4)):
            at, new = rng.randrange(len(p)), rng.choice("abefo ")
            p[at : at + rng.randint(0, 1)] = rng.choice([[], [new]])
        return "".join(p)

    for _ in range(1500):
        parts = [rng.choice([noisy(), noisy(), "free", "software foundation", "xyz abc"]) for _ in range(rng.randint(1, 5))]
        text = " " + " ".join(" ".join(parts).split()) + " "
        found = sorted((a, b, e) for _, a, b, e, _ in scanner.scan(text)[1])
        assert all(x[1] <= y[0] for x, y in zip(found, found[1:], strict=False)) and all(edits(text[a:b], phrase) == e for a, b, e in found)
        spaces = [i for i, c in enumerate(text) if c == " "]
        for a in spaces:
            for b in spaces:
                if abs(b - a - 1 - len(phrase)) <= 2 and (d := edits(text[a + 1 : b], phrase)) <= 2:
                    assert any(e <= d and s < b and t > a + 1 for s, t, e in found), (text, a, b)
    assert [s[:4] for s in sorted(scanner.scan(" free softwre foundation free software foundation ")[1])] == [("x", 1, 24, 1), ("x", 25, 49, 0)]
    assert len(scanner.scan(" " + "free softwre foundation " * 5000)[1]) == 5000


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(80), rng.randrange(80)) for _ in range(60)] + [(100 + i, 101 + i) for i in range(40)]
    edges += [(500, 501 + i) for i in range(60)] + [(561 + i, 500) for i in range(60)]  # a hub from both sides
    got = {r.node: r.comp for r in components(spark.createDataFrame(edges, "a long, b long"), hub_edges=7).collect()}
    least = {n: n for e in edges for n in e}
    for _ in range(200):
        for a, b in edges:
            least[a] = least[b] = min(least[a], least[b])
    assert all(got[n] == c for n, c in least.items() if any(n in e and e[0] != e[1] for e in edges))


def test_empty_tables(spark):
    none = frame(spark, corpus()).limit(0)
    items = spark.createDataFrame([], "item_id long, text string")
    for found in (
        suffix_dedup.suffix_dedup(spark, none), window_dedup.window_dedup(spark, none), jaccard_join.jaccard_components(spark, none), exact_dedup.exact_dedup(spark, none),
        exact_dedup.drop_copies(spark, none), langid.language_id(spark, none), packing.pack_documents(spark, none), token_binary.token_binary(spark, none), license_scan.license_scan(spark, none),
        string_tiling.tile_documents(spark, none, items), string_tiling.tile_documents(spark, frame(spark, corpus()), items), jaccard_join.keep_one(spark, none),
        site_style_tree.extract_main_text(spark, spark.createDataFrame([], "page_id long, url string, html string")),
    ):
        assert found.count() == 0


def main_texts(spark, pages):
    """Texts by page number of pages (host, html)."""
    rows = [(i, f"http://{host}/{i}", html) for i, (host, html) in enumerate(pages)]
    got = site_style_tree.extract_main_text(spark, spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3))
    return [t for _, t in sorted((r.page_id, r.text) for r in got.collect())]


def test_main_text_of_copies_and_short_articles_stays(spark):
    article = "<html><body><article><h1>Title {0}</h1><p>The text {0} of an article.</p></article></body></html>"
    menu = "<div class=x1>" + "Words of a long menu that every page has. " * 30 + "</div>"
    short = "<html><body>" + menu + "<article><p>Short {0}.</p></article></body></html>"
    plain = "<html><body><div class=x0>" + menu + "<div class=x2><p>Short {0}.</p></div></div></body></html>"
    pages = [("copies", article.format("one"))] * 12 + [("partly", article.format(max(0, i - 30))) for i in range(40)]
    pages += [("short", short.format(i)) for i in range(12)] + [("plain", plain.format(i)) for i in range(12)]
    got = main_texts(spark, pages)
    assert got[:12] == ["Title one\nThe text one of an article."] * 12
    assert got[12:52] == [f"Title {max(0, i - 30)}\nThe text {max(0, i - 30)} of an article." for i in range(40)]
    assert got[52:] == [f"Short {i}." for i in range(12)] * 2


def test_importance_decides_inside_and_outside_the_main_branch(spark):
    page = "<html><body><div class=top>Unique words {0} outside.</div><div class=x1>Same line</div><article><p>Unique text {0} of an article.</p><div class=n1>The same note everywhere</div>"
    page += "<div class=related><p>" + "Long text {0} under a name. " * 40 + "</p></div><div class=share>Share</div></article></body></html>"
    long = ("Long text {0} under a name. " * 40).strip()
    assert main_texts(spark, [("h", page.format(i)) for i in range(12)]) == [f"Unique words {i} outside.\nUnique text {i} of an article.\n{long.format(i)}" for i in range(12)]


def test_entropies_count_from_two_pages(spark):
    page = "<html><body><div class=x1>Same words everywhere</div><div class=x2><p>Unique text {0}.</p></div></body></html>"
    pages = [(f"h{m}", page.format(i)) for m in (2, 3, 7) for i in range(m)]
    assert main_texts(spark, pages) == [f"Unique text {i}." for m in (2, 3, 7) for i in range(m)]


def test_names_do_not_cover_articles(spark):
    article = "<article><header class=entry-header><h1 class=header>Head</h1></header><p>Some text.</p>{}</article>"
    whole = [f"<div class='content {name}'>{article}</div>" for name in ("has-sidebar", "with-sidebar", "no-sidebar", "has-header", "sidebar")]
    whole += [f"<form id=aspnetForm>{article}</form>", "<form id=aspnetForm><h1>Head</h1><p>Some text.</p></form>"]
    inside = ["<section class=search-results><p>Found.</p></section>", "<div class=related-work><p>Found.</p></div>"]
    chrome = ["<div class='related-posts list'><p>Found.</p></div>", "<div id=comments-2>Found.</div>", "<nav>Found.</nav>"]
    pages = [*(h.format("") for h in whole), *(article.format(h) for h in (*inside, *chrome))]
    got = main_texts(spark, [(f"h{i}", f"<html><body>{html}</body></html>") for i, html in enumerate(pages)])
    assert got == ["Head\nSome text."] * len(whole) + ["Head\nSome text.\nFound."] * len(inside) + ["Head\nSome text."] * len(chrome)


def test_head_without_end_tag(spark):
    heads = ["<html><head><meta charset=utf-8><title>T</title><script>1</script>{}", "<head><title>T</title><noscript><p>no</p></noscript>{}", "<title>T</title>{}"]
    pages = [h.format(body) for h in heads for body in ("<body><p>Some text.</p></body></html>", "<p>Some text.")]
    assert main_texts(spark, [(f"h{i}", html) for i, html in enumerate(pages)]) == ["Some text."] * len(pages)
    assert site_style_tree.PageTree().read("<head><title>T</title></head><p>Some text.").blocks[0].text == "Some text."


class PlainSite:
    """One host's pages, well formed, read with an XML parser; importance and texts told plainly (see the module's docstring)."""

    def __init__(self, pages):
        self.pages = [self.blocks(ElementTree.fromstring(p)) for p in pages]
        self.groups = defaultdict(list)
        for k, (blocks, _) in enumerate(self.pages):
            if main := self.main(blocks) or blocks:
                self.groups[tuple((b["path"], b["text"]) for b in main)].append(k)

    def blocks(self, root):
        found, styles = [], []
        holds = {e for e in root.iter() if any(x is not e and x.tag in ("article", "main") for x in e.iter())}

        def label(e):
            return re.sub(r"\d{3,}", "#", ".".join([e.tag, *(w for k in e.attrib if k in ("class", "id", "role") for w in re.findall("[a-z0-9]+", e.attrib[k].lower()))]))

        def mark(e, inside):
            if e.tag in ("article", "main"):
                return "*"
            if e in holds or e.tag in ("html", "body"):
                return ""
            names = " ".join(e.attrib.get(k, "") for k in ("class", "id", "role")).split()
            return "?" if "comments" in names else "!" if {"ad", "share", "related"} & set(names) or e.tag in ("nav", "footer") or (e.tag == "aside" and not inside) else "~" if e.tag == "aside" else ""

        def walk(e, path, above, inside):
            own = mark(e, inside)
            path = (*path, (label(e), own))
            above = (*above, (path, own)) if own in ("!", "?", "~") else above
            inside = inside or own == "*"
            text, links = [], []

            def flush():
                if words := " ".join("".join(text).split()):
                    found.append(dict(path=path, text=words, links=min(len(words), len("".join(links))), inside=inside, names=[p for p, m in above if m == "!"], sure=any(m == "?" for _, m in above), aside=any(m == "~" for _, m in above)))
                text.clear()
                links.clear()

            text.append(e.text or "")
            children = []
            for c in e:
                if c.tag in ("a", "b"):
                    text.append(c.text or "")
                    links.append(c.text or "" if c.tag == "a" else "")
                else:
                    flush()
                    walk(c, path, above, inside)
                    children += [label(c)] if not children or children[-1] != label(c) else []
                text.append(c.tail or "")
            flush()
            if children:
                styles.append((path, tuple(children)))

        walk(root, (), (), False)
        return found, styles

    @staticmethod
    def main(blocks):
        free = [b for b in blocks if not b["names"] and not b["sure"]]
        return [b for b in free if b["inside"]] or free

    def importance(self):
        groups = list(self.groups.values())
        m, mains = len(groups), sum(any(b["inside"] for k in g for b in self.pages[k][0]) for g in groups)

        def entropy(counts, base):
            p = np.array(list(counts)) / max(1, sum(counts))
            return float(np.clip(-(p * np.log(p)).sum() / np.log(base), 0, 1)) if base > 1 else 0.0

        places, styles, node = defaultdict(lambda: defaultdict(dict)), defaultdict(Counter), {}
        for j, g in enumerate(groups):
            shown = Counter()
            for k in g:
                own, links = Counter((b["path"], b["text"]) for b in self.pages[k][0]), Counter()
                for b in self.pages[k][0]:
                    node[b["path"]] = b
                    links[b["path"], b["text"]] += b["links"]
                for (path, text), c in own.items():
                    before = places[path][text].get(j, (0, 0))
                    places[path][text][j] = (max(c, before[0]), max(links[path, text], before[1]))
                shown |= Counter(self.pages[k][1])
            for (path, style), c in shown.items():
                styles[path][style] += c
        size, rare, free, links = Counter(), Counter(), Counter(), Counter()
        for path, texts in places.items():
            for text, at in texts.items():
                n, own = sum(c for c, _ in at.values()) * len(text), sum(x for _, x in at.values())
                e = entropy([c for c, _ in at.values()], m)
                size[path] += n
                links[path] += own
                rare[path] += n * (1 - e)
                free[path] += (n - own) * (1 - e)
        counts = {p: b for p, b in node.items() if b["inside"] or mains / m < 0.5}
        held = Counter()
        for p, b in counts.items():
            for branch in b["names"]:
                held[branch, b["inside"]] += free[p]
        whole = {True: sum(free[p] for p, b in counts.items() if b["inside"]), False: sum(free[p] for p in counts)}
        wraps = {branch for (branch, inside), x in held.items() if 2 * x > whole[inside]}
        out = {}
        for p, b in node.items():
            look = entropy(styles[p[:-1]].values(), sum(styles[p[:-1]].values())) if styles.get(p[:-1]) else 0
            x = min(1.0, rare[p] / size[p] * (1 - 0.5 * min(1, links[p] / size[p]) + 0.2 * look))
            x *= 0.2 if b["sure"] or any(n not in wraps for n in b["names"]) else 0.5 if b["aside"] else 1
            out[p] = x * (1 if b["inside"] else 1 - 0.5 * mains / m)
        return out

    def texts(self, least=0.3):
        of = self.importance()
        return ["\n".join(b["text"] for b in [b for b in blocks if of[b["path"]] >= least] or self.main(blocks)) for blocks, _ in self.pages]


def test_main_text_equals_a_plain_version(spark):
    rng = random.Random(5)
    bits = ["<p>Same words on all pages</p>", "<p>Unique words {0} here</p>", "<div class='ad'><p>Buy {1}</p></div>", "<div class='x1 x2'><p>One of {1}</p><p>Two {0}</p></div>", "<ul><li><a href='x'>Link {1}</a></li><li>Item {0}</li></ul>",
            "<nav><a href='y'>Home</a></nav>", "<div id='post-{0}000'>Post text</div>", "<section><h2>Head {1}</h2>Text {0}</section>", "<aside>Aside {1}</aside>", "<div class='comments'><p>Comment {0} by a reader.</p></div>",
            "<div class='related'><p>Related long text {0} that goes on and on {0}.</p></div>", "<footer>Same foot {1}</footer>"]
    some = lambda most: "".join(rng.choice(bits).format(rng.randint(0, 30), rng.randint(0, 3)) for _ in range(rng.randint(1, most)))
    pages = []
    for host in range(14):
        for _ in range(rng.choice([1, 2, 3, 7, 12])):
            page = some(6) + (f"<article><p>Article {rng.randint(0, 30)}</p>{some(4)}</article>" if rng.random() < host % 3 / 2 else "") + some(2)
            pages += [(host, f"<html><body>{page}</body></html>")] * rng.choice([1, 1, 2])
            if rng.random() < 0.3:  # the same main text beside another advert
                pages.append((host, pages[-1][1].replace("</body>", "<div class='ad'>Other</div></body>")))
    sites = {h: PlainSite([p for k, p in pages if k == h]) for h in range(14)}
    rows = spark.createDataFrame([(i, f"http://h{h}/{i}", p) for i, (h, p) in enumerate(pages)], "page_id long, url string, html string").repartition(3)
    got = sorted((r.host, round(r.importance, 9), r.size) for r in site_style_tree.style_tree(stage(site_style_tree.parse_pages(rows))).collect())
    assert sorted({x[0] for x in got}) == sorted({f"h{h}" for h in sites}) and len(got) > 150
    assert [x[:2] for x in got] == sorted((f"h{h}", round(x, 9)) for h, site in sites.items() for x in site.importance().values())
    texts, whole = ({r.page_id: r.text for r in site_style_tree.extract_main_text(spark, rows, least).collect()} for least in (site_style_tree.LEAST_IMPORTANCE, 0.0))
    own = {h: iter(site.texts()) for h, site in sites.items()}
    assert [texts[i] for i in range(len(pages))] == [next(own[h]) for h, _ in pages]
    assert sum(texts[i] != whole[i] for i in texts) > len(pages) / 4  # without low branches nothing goes


@pytest.mark.parametrize("length", (20, 500, 20_000))
def test_comments_of_any_length_go(spark, length):
    comments = "<section class=comments><h3>Comments</h3>" + "<div id=comment-{0}><p>A reader said {0} things.</p></div>" * max(1, length // 30) + "</section>"
    body, inside = "<p>The text {0} of the article, in some words.</p>", "<article>{}</article>"
    hosts = {"inside": [inside.format(body + comments)] * 12, "outside": [inside.format(body) + comments] * 12, "none": [f"<div class=x>{body}</div>" + comments] * 12}
    hosts |= {"mixed": [inside.format(body + comments), f"<div class=x>{body}</div>" + comments] * 6, "one": [inside.format(body + comments)], "single": [f"<div class=x>{body}</div>" + comments]}
    pages = [(h, f"<html><body>{p.replace('{0}', str(i))}</body></html>") for h, own in hosts.items() for i, p in enumerate(own)]
    assert main_texts(spark, pages) == [f"The text {i} of the article, in some words." for own in hosts.values() for i in range(len(own))]


def test_the_tree_alone_finds_boilerplate(spark):
    """No tag and no name tells: only entropies do, in and out of the article, and without them it all stays."""
    page = "<html><body><div class=q1><p>Home News About us and all the rest</p></div><article><h1>Title {0}</h1><p>Body {0} words.</p><div class=q2>Sign up for our letter</div></article><div class=q3>All rights reserved</div></body></html>"
    aside = "<html><body><article><p>Body {0} of the text.</p><aside>Quote {0} from it.</aside><aside class=q4>Read more of ours.</aside></article></body></html>"
    pages = [("a", page.format(i)) for i in range(5)] + [("b", aside.format(i)) for i in range(5)] + [("c", page.format(0))]
    whole = "Home News About us and all the rest\nTitle 0\nBody 0 words.\nSign up for our letter\nAll rights reserved"
    assert main_texts(spark, pages) == [f"Title {i}\nBody {i} words." for i in range(5)] + [f"Body {i} of the text.\nQuote {i} from it." for i in range(5)] + [whole]


def test_broken_markup(spark):
    read = lambda html: [b.text for b in site_style_tree.PageTree().read(html).blocks]
    for html, expected in (
        ("<p>a</p><![foo[ x ]]><p>b</p>", ["a", "b"]), ("<p>a<![ >b", ["ab"]), ("<![", []), ("<!", []), ("</", ["</"]), ("a<", ["a<"]), ("a < b <3", ["a < b <3"]), ("<!-->a<!--->b<!-- c", ["ab"]), ("<?x y?>a", ["a"]),
        ("<select><option>1<p>after</p>", ["after"]), ("<textarea>in<p>after</p>", ["after"]), ("<textarea><p>in</p></textarea><p>after</p>", ["after"]), ("<title>t<p>after", ["after"]), ("<button>b<p>after", ["after"]),
        ("<button><div>b</div></button><p>after", ["after"]), ("<svg><text>x<p>after", ["after"]), ("<script>var a='</p>'<p>gone", []), ("<p title='a>b'>c", ["c"]), ("<p title=a>b</p>", ["b"]), ("<p a=\"x>y", []),
        ("<P CLASS=X>a&#x41;&amp;&lt;b&gt;</P >c", ["aA&<b>", "c"]), ("<p>&#55296;\ud800x", ["\ufffd\ud800x"]), ("<iframe>gone</iframe>a<iframe>b<p>c", ["a", "c"]), ("</p></div></article>x", ["x"]), ("a\x00b", ["a\x00b"]),
    ):
        assert read(html) == expected, html
    for html in ("<a " * 400_000, "<div><p>x" * 40_000, "<!--" * 400_000, "<p class='" * 200_000, "<textarea>" * 100_000, "<main>" * 20_000 + "x", "<x-a>" * 20_000 + "<p>" * 20_000, "<" * 800_000, "= " * 500_000, "<p " + "=" * 800_000, "<p " + "a" * 800_000 + ">"):
        began = time.process_time()
        site_style_tree.PageTree().read(html)
        assert time.process_time() - began < 6, html[:9]
    got = main_texts(spark, [("h", "<p>a</p><![foo[ x ]]><p>b</p>"), ("h", "<![ >"), ("h", None)])
    assert got == ["a\nb", "", ""]


def test_deep_pages_and_many_names(spark):
    deep = "<html><body><article><p>Text {0}.</p>" + "<div class=a>" * 5000 + "<p>Deep text {0}.</p>" + "</div>" * 5000 + "</article></body></html>"
    names = "<html><body><div class='a b c d e menu1'>Same words</div><div class='a b c d f'>Unique words {0}.</div></body></html>"
    numbers = "<html><body><div id=post-{0}00{0}>Same words</div><div class=x2>Unique words {0}.</div></body></html>"
    pages = [(h, page.format(i)) for h, page in (("deep", deep), ("names", names), ("numbers", numbers)) for i in range(1, 9)]
    assert main_texts(spark, pages) == [f"Text {i}.\nDeep text {i}." for i in range(1, 9)] + [f"Unique words {i}." for i in range(1, 9)] * 2
    tree = site_style_tree.parse_pages(spark.createDataFrame([(1, "http://h/", deep.format(1))], "page_id long, url string, html string"))
    assert tree.select(F.length(F.to_json(F.struct("features", "styles")))).first()[0] < 400_000


def test_keep_one_with_repeated_and_null_ids(spark):
    text = {k: " ".join(f"{k}{j}" for j in range(60)) for k in "abcd"}
    near = {k: t + " end" for k, t in text.items()}
    rows = [(1, text["a"]), (2, near["a"]), (2, text["b"]), (3, near["b"]), (None, text["c"]), (None, near["c"]), (None, near["c"]), (1, near["d"]), (None, text["d"])]
    rows += [(1, near["a"]), (9, None), (9, ""), (None, "")]
    kept = [(r.doc_id, r.text) for r in jaccard_join.keep_one(spark, frame(spark, rows)).collect()]
    c = [t for i, t in kept if i is None and t and t.startswith("c")]
    a = [t for i, t in kept if t in (text["a"], near["a"])]
    assert len(c) == 1 and len(a) == 1 and len(kept) == 7
    assert {(2, text["b"]), (1, near["d"]), (9, None), (9, ""), (None, "")} <= set(kept)
