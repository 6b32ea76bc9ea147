"""Plain versions of the operators, for small inputs, and frames of odd documents."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def sha(text: str | bytes) -> str:
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def documents(spark, rows):
    """Documents from (id, text) or (id, text, source); one extra column has a clashing name."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
    return spark.createDataFrame(full, DOCS)


def odd_documents(spark):
    """Nulls, empty and long texts, repeated rows and clashing extra columns."""
    long = " ".join(f"w{i % 977}x{i}" for i in range(30000))
    rows = [
        (1, None, None), (2, "", "a"), (2, "", "a"), (3, "one two", "a"), (4, "one two", None),
        (5, long, "b"), (6, long + " end", "b"), (None, "no id here at all", "b"),
        (None, "no id here at all", "b"), (7, "   \n\t\n", "c"), (8, "\u00a0\u0130 é漢字 \x1c x", "c"),
    ]
    return spark.createDataFrame(
        [(i, t, None, s, None, 1, "x", [1]) for i, t, s in rows],
        DOCS + ", kept int, key string, ids array<int>",
    )


def removed_words(rows, window=20):
    """doc_id to (words, removed, digest of the rest); rows of (id, text) with ids distinct."""
    first, result = {}, {}
    for doc, text in sorted(rows):
        own = words(text)
        gone = [False] * len(own)
        for start in range(len(own) - window + 1):
            run = tuple(own[start : start + window])
            if run in first:
                gone[start : start + window] = [True] * window
            else:
                first[run] = (doc, start)
        kept = [w for w, g in zip(own, gone, strict=True) if not g]
        result[doc] = (len(own), sum(gone), sha(" ".join(kept)))
    return result


def jaccard_classes(rows, size=5):
    """doc_id to (least connected id, number of links); ids distinct."""
    sets = {}
    for doc, text in rows:
        own = words(text)
        sets[doc] = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} or {tuple(own)}
    holders = defaultdict(list)
    for doc, own in sets.items():
        for shingle in own:
            holders[shingle].append(doc)
    common = Counter()
    for docs in holders.values():
        common.update((a, b) for i, a in enumerate(docs) for b in docs[:i])
    parent, links = {d: d for d in sets}, Counter()

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for (a, b), n in common.items():
        if 5 * n >= 4 * (len(sets[a]) + len(sets[b]) - n):
            links[a] += 1
            links[b] += 1
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    return {d: (root(d), links[d]) for d in sets}
