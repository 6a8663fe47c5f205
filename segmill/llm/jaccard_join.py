"""N-gram Jaccard self-join of documents by vertical partitioning.

A document is its set of distinct word n-grams. The global n-gram order is by frequency (unique ones
first, then classes of twice the frequency, then hash). With similarity t, two sets that link share
an n-gram among the first n - ceil(t n) + 1 of each, so only these prefixes meet. The order is cut
into fragments that hold about equal shares of all n-grams; a pair's overlap is counted in each
fragment separately and summed.

What the result needs is who is connected, so members of a prefix n-gram are not paired with each
other: each is paired with one pivot, the member with the smallest share of unique n-grams (in a group of edited
copies, the original). What links becomes one component; pairs inside one are settled. After two
rounds of pivots every pair that still lies across components is tested, so no link is lost.

Frequencies come from packed hashes per part and bucket (see parts). A text and its exact copies are
one member throughout: only the first copy sends n-grams, and a part hears of a copied text once,
however many rows have it. Nothing is capped: a hot n-gram stands last in the order. A pivot that many
members meet, and a member with many links, is there in copies, so no task gets all its partners.

Cases: null or blank text has an empty set and links with nothing; with fewer words than n the whole
sequence is one n-gram; a null doc_id is no component's id (null if it is alone); repeated rows
share their component; a text of any length is hashed in stretches; an empty table gives no row;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segmill.llm import hashing
from segmill.llm.common import configure, copies_for, copy_numbers, copy_of, join_counted, ragged, stage, stage_groups
from segmill.llm.components import components
from segmill.llm.parts import LATER, PART_TEXT, Part, ask, ask_copies, bucket_number, heard, heard_copies, keyed, parts_of, stage_parts, tell, text_size
from segmill.llm.words import words_of

GRAM, PERCENT, FRAGMENTS, PIVOT_ROUNDS = 3, 90, 4, 2
#: Pairs that one copy of a member's n-grams serves, on average; members of an n-gram in one of its shares.
PAIRS_A_COPY = 4096

_SETS = (
    T.StructType().add("key", T.BinaryType()).add("doc_ids", T.ArrayType(T.LongType())).add("n", T.LongType()).add("cid", T.LongType())
    .add("alone", T.LongType()).add("prefix", T.ArrayType(T.LongType())).add("fragments", T.ArrayType(T.ArrayType(T.LongType())))
)
#: An n-gram's place in the global order: its class in the upper byte, its hash below.
_CLASS_BITS = 56


def keyed_lower(docs: DataFrame) -> DataFrame:
    """(doc_id, key, text) with A-Z in lower case, so texts that differ in case only are one member."""
    return keyed(docs, _lower())


def _lower(text: str = "text"):
    return F.translate(F.coalesce(F.col(text).cast("string"), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def gram_sets(column: pa.Array, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct n-gram hashes of each text, joined; cuts)."""
    words = words_of(column)
    counts = words.counts
    own = words.hashes()
    every = hashing.rolling(own, gram, hashing.WORD_BASE)
    many = np.maximum(counts - gram + 1, 0)
    short = np.flatnonzero((counts > 0) & (counts < gram))
    hashes = every[ragged(words.cuts[:-1], many)]
    text = np.repeat(np.arange(len(counts)), many)
    if len(short):
        sums = hashing.prefix(own, hashing.WORD_BASE)
        hashes = np.concatenate([hashes, hashing.spans(sums, words.cuts[short], words.cuts[short + 1], hashing.WORD_BASE)])
        text = np.concatenate([text, short])
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    return hashes[new], np.searchsorted(text[new], np.arange(len(counts) + 1))


def _members(p: Part, buckets: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(rows and numbers of distinct(), those that are no later copies, their n-grams and cuts)."""
    rows, text, state = heard_copies(p, p.rest[0], buckets)
    first = np.flatnonzero(state != LATER)
    return rows, text, first, *gram_sets(p.texts.take(pa.array(rows[first])), gram)


def order_cuts(answers: DataFrame, fragments: int) -> np.ndarray:
    """Cuts of the global order into fragments of about equal numbers of n-grams that texts share."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = b"".join(a["flags"] for said in batch.column(0).to_pylist() for a in said)
            number = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(256)), pa.array(number)], names=["class", "n"])

    counts = answers.select("said").mapInArrow(count, "class long, n long").where("class > 0 and n > 0").groupBy("class").agg(F.sum("n").alias("n"))
    classes = sorted(tuple(r) for r in counts.collect())  # at most 64 rows
    total, before, cuts = sum(n for _, n in classes), 0, []
    for c, n in classes:
        while len(cuts) < fragments - 1 and (want := total * (len(cuts) + 1) / fragments) <= before + n:
            cuts.append((c << _CLASS_BITS) + int((want - before) / n * ((1 << _CLASS_BITS) - 1)))
        before += n
    return np.array(cuts, np.uint64)


def order_sets(parts: DataFrame, gram: int, percent: int, copy_buckets: int, buckets: int, cuts: np.ndarray) -> DataFrame:
    """A row per part and distinct text: key, doc_ids; if no earlier copy stands elsewhere, the set's size and, if it can link, prefix and fragments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p in parts_of(batches):
            rows, text, first, hashes, bounds = _members(p, copy_buckets, gram)
            classes = heard(hashes, p.rest[1], buckets)
            keys, by_text = p.keys.to_pylist(), np.argsort(text, kind="stable")
            ids = pa.ListArray.from_arrays(pa.array(np.searchsorted(text[by_text], np.arange(len(rows) + 1)), pa.int32()), p.doc_ids.take(pa.array(by_text)))
            out = {name: [None] * len(rows) for name in _SETS.names if name != "doc_ids"}
            out["key"] = [keys[i] for i in rows.tolist()]
            for j, i in enumerate(first.tolist()):
                own, kind = hashes[bounds[j] : bounds[j + 1]], classes[bounds[j] : bounds[j + 1]]
                n = out["n"][i] = len(own)
                prefix = n - -(-percent * n // 100) + 1
                shared = np.flatnonzero(kind)
                alone = n - len(shared)
                if n and alone < prefix:
                    place = (kind[shared].astype(np.uint64) << np.uint64(_CLASS_BITS)) | (own[shared] >> np.uint64(64 - _CLASS_BITS))
                    order = np.argsort(place, kind="stable")
                    held = own[shared][order]  # in the global order, and so are its fragments
                    cut = [0, *np.searchsorted(place[order], cuts).tolist(), len(held)]
                    out["cid"][i], out["alone"][i] = (p.part << 22) + int(rows[i]), alone
                    out["prefix"][i] = held[: prefix - alone].view(np.int64)
                    out["fragments"][i] = [held[a:b].view(np.int64) for a, b in zip(cut, cut[1:], strict=False)]
            kinds = {"key": pa.binary(), "prefix": pa.list_(pa.int64()), "fragments": pa.list_(pa.list_(pa.int64()))}
            columns = [ids if n == "doc_ids" else pa.array(out[n], kinds.get(n, pa.int64())) for n in _SETS.names]
            yield pa.RecordBatch.from_arrays(columns, names=_SETS.names)

    return parts.mapInArrow(run, _SETS)


def _dealt(pairs: DataFrame, dealt: DataFrame, sets: DataFrame, own: str, other: str, share: int) -> tuple[DataFrame, DataFrame]:
    """(dealt, the pairs so far, with the copy of `own` that serves each; the copies with their fragments).

    Members that may link have sets of about one size, so copies add about one part in `share` to what
    the pairs carry anyway.
    """
    counts, seen = stage_groups(pairs.groupBy(own).agg(_pairs_number()))
    copies = copies_for(F.col("n"), share)
    dealt = join_counted(dealt, counts, own, seen=seen).withColumn(f"copy_{own}", copy_of(F.col(other), copies)).drop("n")
    copied = counts.select(own, copy_numbers(copies).alias(f"copy_{own}"))
    held = copied.join(sets.select(F.col("cid").alias(own), F.col("n").alias(f"n_{own}"), "fragments"), own)
    return dealt, held.select(own, f"copy_{own}", f"n_{own}", F.posexplode("fragments").alias("fragment", f"grams_{own}"))


def count_overlaps(pairs: DataFrame, sets: DataFrame, percent: int, share: int = PAIRS_A_COPY) -> DataFrame:
    """Of pairs(a, b), staged, those that link: partial overlaps of each fragment, summed for each pair.

    A pivot with a million partners is not one key: its fragments are there in copies, each for `share` partners.
    """
    dealt, left = _dealt(pairs, pairs, sets, "a", "b", share)
    dealt, right = _dealt(pairs, dealt, sets, "b", "a", share)
    met = dealt.join(left, ["a", "copy_a"]).join(right, ["b", "copy_b", "fragment"])
    partial = met.select("a", "b", "n_a", "n_b", F.size(F.array_intersect("grams_a", "grams_b")).cast("long").alias("shared"))
    total = partial.groupBy("a", "b", "n_a", "n_b").agg(F.sum("shared").alias("shared"))
    return total.where(100 * F.col("shared") >= percent * (F.col("n_a") + F.col("n_b") - F.col("shared"))).select("a", "b")


def _can_link(percent: int):
    """If this n-gram is the first that two sets share, whether what follows it can reach the similarity.

    place is its position in a set's order. A pair that links passes at the first n-gram it shares, so
    failing at a later one loses nothing.
    """
    shared = F.least(F.col("n") - F.col("place"), F.col("other_n") - F.col("other_place"))
    return 100 * shared >= percent * (F.col("n") + F.col("other_n") - shared)


def _pivot_pairs(known: DataFrame, percent: int, k: int) -> DataFrame:
    """Each member with its n-gram's pivot, unless they are connected or cannot link."""
    share = F.col("alone") / F.col("n")
    rank = F.struct(share, F.col("cid")) if k == 0 else F.struct(F.xxhash64("comp", "gram"), share, F.col("cid"))
    pivot = known.groupBy("gram").agg(F.min_by(F.struct("cid", "n", "place", "comp"), rank).alias("p"), F.min("comp").alias("low"), F.max("comp").alias("high"), _members_number())
    pivot = pivot.where("low <> high").select("gram", "members", *[F.col(f"p.{c}").alias(f"other_{c}") for c in ("cid", "n", "place", "comp")])
    return _met(known, pivot).where((F.col("comp") != F.col("other_comp")) & _can_link(percent))


def _members_number():
    return F.count(F.lit(1)).alias("members")


def _pairs_number():
    return F.count(F.lit(1)).alias("n")


def _met(known: DataFrame, groups: DataFrame) -> DataFrame:
    """Members with what their n-gram's group says (with its number of members)."""
    own = known.withColumnRenamed("n", "own_n")
    groups, seen = stage_groups(groups.withColumnRenamed("members", "n"))
    return join_counted(own, groups, "gram", seen=seen).drop("n").withColumnRenamed("own_n", "n")


def _pairs_across(known: DataFrame, percent: int, share: int = PAIRS_A_COPY) -> DataFrame:
    """All pairs of an n-gram's members that lie in two components and can link.

    A member whose place in its own order rules out even the best partner that its n-gram could offer
    goes first. Of the
    rest, members outside the n-gram's largest component meet all others; inside it nothing meets.
    Both sides of a frequent n-gram are cut into shares, and each meets copies of the other's.
    """
    best = known.groupBy("gram").agg(F.min("n").alias("least_n"), F.min("place").alias("least_place"), F.min("comp").alias("low"), F.max("comp").alias("high"), _members_number())
    held = F.col("n") - F.col("place")
    open_ = _met(known, best.where("low <> high")).where(100 * held >= percent * (F.col("n") + F.greatest(F.col("least_n") - held, F.col("least_place"))))
    open_ = stage(open_.select("gram", "cid", "n", "place", "comp"))
    sizes = open_.groupBy("gram", "comp").agg(F.count(F.lit(1)).alias("m"))
    largest = sizes.groupBy("gram").agg(F.max_by("comp", F.struct("m", "comp")).alias("largest"), F.count(F.lit(1)).alias("comps"), F.sum("m").alias("members"))
    largest = largest.where("comps > 1").withColumn("copies", copies_for(F.col("members"), share)).drop("comps")
    marked = stage(_met(open_, largest))
    own, copy = copy_of(F.col("cid"), F.col("copies")), copy_numbers(F.col("copies"))
    outside = marked.where("comp <> largest").withColumn("share", own).withColumn("other_share", copy)
    others = marked.withColumn("other_share", own).withColumn("share", copy)
    others = others.select("gram", "share", "other_share", *[F.col(c).alias(f"other_{c}") for c in ("cid", "n", "place", "comp")])
    once = (F.col("other_comp") == F.col("largest")) | (F.col("cid") < F.col("other_cid"))
    return outside.join(others, ["gram", "share", "other_share"]).where((F.col("comp") != F.col("other_comp")) & once & _can_link(percent))


def link_sets(sets: DataFrame, percent: int, pivot_rounds: int = PIVOT_ROUNDS) -> DataFrame:
    """Links (a, b) that connect what is connected; pairs inside a known component are left out."""
    prefixes = sets.select("cid", "n", "alone", F.posexplode("prefix").alias("place", "gram")).withColumn("place", F.col("alone") + F.col("place"))
    met = prefixes.groupBy("gram").agg(_members_number()).where("members > 1")
    prefixes = stage(_met(prefixes, met))
    links = tested = None
    for k in range(pivot_rounds + 1):
        known = prefixes.withColumn("comp", F.col("cid"))
        if links is not None:
            labels = components(links)
            known = stage(prefixes.join(labels, prefixes["cid"] == labels["node"], "left").select("gram", "cid", "n", "alone", "place", F.coalesce("comp", "cid").alias("comp")))
        pairs = _pivot_pairs(known, percent, k) if k < pivot_rounds else _pairs_across(known, percent)
        pairs = pairs.select(F.least("cid", "other_cid").alias("a"), F.greatest("cid", "other_cid").alias("b")).distinct()
        pairs = stage(pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti"))
        found = stage(count_overlaps(pairs, sets, percent))
        links = found if links is None else links.union(found)
        tested = pairs if tested is None else tested.union(pairs)
    return links


def jaccard_components(spark: SparkSession, docs: DataFrame, gram: int = GRAM, percent: int = PERCENT, fragments: int = FRAGMENTS, buckets: int | None = None, part_text: int = PART_TEXT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, key (of its text, ignoring case)."""
    return _components(spark, docs, gram, percent, fragments, buckets, part_text).drop("kept_key")


def _components(spark: SparkSession, docs: DataFrame, gram: int, percent: int, fragments: int = FRAGMENTS, buckets: int | None = None, part_text: int = PART_TEXT) -> DataFrame:
    """jaccard_components() with kept_key: the component's text of smallest (doc_id, key), null doc_ids last."""
    configure(spark)
    size = text_size(docs)
    buckets, copy_buckets = buckets or bucket_number(size), bucket_number(size)
    parts = stage_parts(keyed_lower(docs), size, part_text)
    parts = tell(parts, ask_copies(parts, copy_buckets), "copies")
    answers = ask(parts, lambda p: _members(p, copy_buckets, gram)[3], buckets)
    every = stage(order_sets(tell(parts, answers, "answers"), gram, percent, copy_buckets, buckets, order_cuts(answers, fragments)))
    sets = every.where("cid is not null").select("cid", "n", "alone", "prefix", "fragments")
    labels = components(link_sets(sets, percent))
    texts = every.groupBy("key").agg(F.min(F.array_min("doc_ids")).alias("first_id"), F.max("n").alias("n"), F.max("cid").alias("cid"))
    texts = stage(texts.join(labels, F.col("cid") == F.col("node"), "left").select("key", "first_id", "n", "comp"))
    linked = texts.where("comp is not null").withColumnRenamed("n", "n_shingles")
    least = linked.groupBy("comp").agg(F.min("first_id").alias("component_id"), F.min_by("key", F.struct(F.col("first_id").isNull(), "first_id", "key")).alias("kept_key"), F.count(F.lit(1)).alias("n"))
    least, seen = stage_groups(least)
    of_text = join_counted(linked, least, "comp", seen=seen).select("key", "n_shingles", "component_id", "kept_key")
    of_text = of_text.union(texts.where("comp is null").select("key", "n", "first_id", "key"))
    rows = every.select("key", "doc_ids").join(of_text, "key").select(F.explode("doc_ids").alias("doc_id"), "n_shingles", "component_id", "key", "kept_key")
    return rows.withColumn("component_id", F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id")))


def keep_one(spark: SparkSession, docs: DataFrame, gram: int = 5, percent: int = 80) -> DataFrame:
    """docs without the members of each component but one; columns stay.

    The one that stays has the smallest (doc_id, key of its text); a null doc_id comes after all others,
    so a component without ids keeps one row as well. A row goes for its own text only: where a doc_id
    occurs with several texts, each is a document of its own. Rows that repeat (same id and text, ignoring
    case, null ids alike) stay once. Documents without a word link with nothing and stay.
    """
    found = stage(_components(spark, docs, gram, percent).where("n_shingles > 0"))
    rows = found.groupBy("doc_id", "key").agg(F.first("component_id").alias("component_id"), F.first("kept_key").alias("kept_key"), F.count(F.lit(1)).alias("n"))
    stays = F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("key") == F.col("kept_key"))
    decided = stage(rows.select("doc_id", "key", stays.alias("stays"), "n").where("not stays or n > 1"))
    again = decided.where("stays").select("doc_id", "key")
    every = docs.select(F.struct(*docs.columns).alias("doc"))  # columns of the input have names of their own
    same = F.col("doc.doc_id").cast("long").eqNullSafe(F.col("doc_id")) & (F.unhex(F.md5(_lower("doc.text").cast("binary"))) == F.col("key"))
    kept = every.join(decided, same, "left_anti")
    if not again.isEmpty():
        kept = kept.union(every.join(again, same).dropDuplicates(["doc_id", "key"]).select("doc"))
    return kept.select("doc.*")
