"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0d]+")
NAME = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lower(text):
    return text.translate({c: c + 32 for c in range(65, 91)})


def sha(data):
    return hashlib.sha256(data).hexdigest()


def suffix_dedup(docs, length=100):
    """Rows in order of (doc_id, digest); of repeated rows the first comes first."""
    seen, out = set(), []
    for doc_id, text in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0, hashlib.md5((d[1] or "").encode()).digest())):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            if (s := data[i : i + length]) in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(s)
        spans = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        out.append((doc_id, len(data), sum(gone), spans, sha(bytes(c for c, g in zip(data, gone, strict=True) if not g))))
    return out


def window_dedup(docs, window=35):
    counts = Counter()
    words = [WORD.findall(t or "") for _, t in docs]
    for w in words:
        counts.update(tuple(w[i : i + window]) for i in range(len(w) - window + 1))
    out = []
    for (doc_id, _), w in zip(docs, words, strict=True):
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if counts[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        out.append((doc_id, len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone, strict=True) if not g).encode())))
    return out


def shingles(text, n):
    w = WORD.findall(lower(text or ""))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def jaccard_components(docs, n=3, percent=90):
    sets = [shingles(t, n) for _, t in docs]
    parent = list(range(len(docs)))

    def find(a):
        while parent[a] != a:
            parent[a] = a = parent[parent[a]]
        return a

    inverse = defaultdict(list)
    for i, s in enumerate(sets):
        shared = Counter(j for g in s for j in inverse[g])
        for j, k in shared.items():
            if 100 * k >= percent * (len(s) + len(sets[j]) - k):
                parent[find(i)] = find(j)
        for g in s:
            inverse[g].append(i)
    least = defaultdict(list)
    for i, (doc_id, _) in enumerate(docs):
        if doc_id is not None:
            least[find(i)].append(doc_id)
    return [(d, len(sets[i]), min(least[find(i)], default=None)) for i, (d, _) in enumerate(docs)]


def exact_groups(docs):
    groups = defaultdict(list)
    for doc_id, text in docs:
        groups[lower(text or "")].append(doc_id)
    return {t: (max((i for i in ids if i is not None), default=None), len(ids)) for t, ids in groups.items()}


def phrases(text, names):
    words = NAME.findall(lower(text or ""))
    hits = [(i, label) for phrase, label in names.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    return len(words), hits
