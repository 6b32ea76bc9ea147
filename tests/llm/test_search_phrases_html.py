"""Ranked search, collocations and HTML extraction against plain versions."""

import math
import random
import re
from collections import Counter
from html import unescape

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm.collocations import Summary, collocations, frequent_phrases
from strata.llm.html_text import extract_text, kept_blocks, page_blocks
from strata.llm.queries import QUERIES
from strata.llm.ranked_search import Shard, count_terms, search
from tests.llm.helpers import SF, documents, odd_documents

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
ITEMS = "item_id long, text string, score string"


def fold(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def plain_ranking(rows, items, k=10):
    counts = [(d, Counter(TERM.findall(fold(t)))) for d, t in rows]
    counts = [(d, c) for d, c in counts if c]
    n_docs, total = len(counts), sum(c.total() for _, c in counts)
    held = Counter(t for _, c in counts for t in c)
    result = []
    for item, text in items:
        scored = []
        for doc, own in counts:
            m = 25 + (75 * own.total() * n_docs) // total
            score = 0
            for term in TERM.findall(fold(text)):
                if own[term]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held[term] + 1)))
                    score += w * ((10**9 * own[term]) // (1000 * own[term] + 8 * m))
            if score > 0:
                scored.append((-score, doc is None, doc or 0))
        result += [(item, i + 1, None if null else doc, -s)
                   for i, (s, null, doc) in enumerate(sorted(scored)[:k])]
    return sorted(result)


def found(frame):
    return sorted((r.item_id, r["rank"], r.doc_id, r.score) for r in frame.collect())


@pytest.mark.parametrize("sizes", [{}, {"shard": 40, "block": 300}])
def test_rankings_equal_the_plain_version(spark, sizes):
    rnd = random.Random(5)
    vocabulary = [f"w{i}" for i in range(30)] + ["É", "é", "KK", "漢字", "x_y"]
    rows = [(i, " ".join(rnd.choices(vocabulary, range(35, 0, -1), k=rnd.randint(0, 40)))) for i in range(150)]
    rows += [(200 + i, "tie tie w1, W1.") for i in range(14)] + [(300, None), (301, ""), (302, "...")]
    items = [(i, " ".join(rnd.choices(vocabulary, k=rnd.randint(1, 12)))) for i in range(12)]
    items += [(20, "TIE tie w1"), (21, "nowhere"), (22, None), (23, "")]
    asked = spark.createDataFrame([(*i, "x") for i in items], ITEMS)
    got = search(documents(spark, rows).repartition(4), asked, **sizes)
    assert found(got) == plain_ranking(rows, items)


def test_given_rankings_and_odd_documents(spark):
    rows, items = ([tuple(r) for r in spark.read.parquet(f"{SF}/{t}.parquet").select(c, "text").collect()]
                   for t, c in (("documents", "doc_id"), ("benchmark", "item_id")))
    assert found(QUERIES["op11_ranked_search"](spark, SF)) == plain_ranking(rows, items)
    odd = odd_documents(spark)
    asked = spark.createDataFrame([(1, "No ID two", "a"), (1, "No ID two", "b"), (None, "漢字", "c")], ITEMS)
    got = [(r.item_id, r["rank"], r.doc_id, r.score) for r in search(odd, asked).collect()]
    plain = plain_ranking([(r.doc_id, r.text) for r in odd.collect()], [(1, "No ID two"), (-1, "漢字")])
    assert sorted((-1 if i is None else i, r, d, s) for i, r, d, s in got) == plain
    for docs, some in ((odd.limit(0), asked), (odd, asked.limit(0))):
        assert search(docs, some).collect() == []


def test_lists_are_not_read_to_their_ends():
    rnd = np.random.default_rng(1)
    docs, terms = 3000, 6
    doc, term = (x.ravel() for x in np.meshgrid(np.arange(docs), np.arange(terms)))
    impact = rnd.integers(1, 1000, len(doc))
    impact[np.isin(doc, range(0, 3000, 300))] += 20_000

    shard = Shard(np.arange(docs), doc, term, impact)
    best = shard.best((0, 0, list(range(terms)), [1] * terms), 10, 1)
    sums = np.bincount(doc, impact).astype(int)
    assert best == sorted(((int(s), d) for d, s in enumerate(sums)), key=lambda x: (-x[0], x[1]))[:10]
    # With a floor above every sum nothing is kept, whatever is read.
    assert shard.best((0, 0, [0, 1], [1, 1]), 10, 10**9) == []


def test_terms_across_pieces():
    text = ("aB1é" * 5 + " x,") * 50
    for piece in (1, 3, 7, 1000):
        assert count_terms(text.encode(), piece=piece) == {b"ab1\xc3\xa9" * 5: 50, b"x": 50}


def plain_phrases(rows, threshold, longest=5, best=2000):
    counts, n = Counter(), Counter()
    for lang, text in rows:
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", fold(text)):
            own = re.findall("[^ \t]+", piece)
            n[lang or "und"] += len(own)
            for size in range(1, longest + 1):
                counts.update((lang or "und", tuple(own[i : i + size])) for i in range(len(own) - size + 1))
    frequent = {p: a for p, a in counts.items() if len(p[1]) > 1 and a >= threshold}
    held = Counter()
    for (lang, p), a in frequent.items():
        for size in range(2, len(p)):
            for i in range(len(p) - size + 1):
                held[lang, p[i : i + size]] = max(held[lang, p[i : i + size]], a)
    rows = []
    for (lang, p), a in frequent.items():
        if held[lang, p] >= a:
            continue
        score, _, left, right = min(
            (1000 * a * n[lang] // (counts[lang, p[:k]] * counts[lang, p[k:]]), k,
             counts[lang, p[:k]], counts[lang, p[k:]]) for k in range(1, len(p)))
        rows.append((lang, -score, -a, " ".join(p).encode(), left, right))
    result, place = [], Counter()
    for lang, score, a, phrase, left, right in sorted(rows):
        place[lang] += 1
        if place[lang] <= best:
            result.append((lang, place[lang], phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(result)


@pytest.mark.parametrize("counters", [200_000, 5])
def test_phrases_equal_the_plain_version(spark, counters):
    rnd = random.Random(2)
    common = [f"c{i}" for i in range(12)] + ["É", "é", " ", "\x1c", "A", "a"]
    rows = []
    for i in range(300):
        own = [rnd.choice(common) if rnd.random() < 0.6 else f"r{rnd.randint(0, 3000)}" for _ in range(30)]
        own.insert(rnd.randint(0, 30), "New  York\tCity of" + rnd.choice([" ", ", ", "\n"]) + "lights")
        rows.append((rnd.choice(["en", "de", None, "und"]), rnd.choice([" ", "  ", "\t"]).join(own)))
    rows += [("en", None), ("fr", ""), ("es", "...,,"), ("fr", "a a a a a a a a a a a")]
    docs = spark.createDataFrame([(lang, text, 1) for lang, text in rows], "lang string, text string, a int")
    got = collocations(docs.repartition(5), threshold=8, best=15, counters=counters)
    assert sorted(tuple(r) for r in got.collect()) == plain_phrases(rows, 8, best=15)


def test_phrases_of_odd_documents(spark):
    assert collocations(odd_documents(spark)).collect() == []
    got, totals = frequent_phrases(odd_documents(spark), threshold=2)
    assert {(r.phrase, r.a) for r in got.filter("size = 5").collect()} >= {("no id here at all", 2)}
    assert {r.lang for r in totals.collect()} == {"und"}
    assert collocations(odd_documents(spark).limit(0)).collect() == []


def test_merged_summaries_lose_no_frequent_key():
    rnd = np.random.default_rng(3)
    stream = np.concatenate([rnd.integers(1000, 60_000, 50_000), np.repeat(np.arange(40), 120)])
    rnd.shuffle(stream)
    merged = Summary(100)
    merged.mass = len(stream)
    for part in np.array_split(stream, 37):
        keys, counts = np.unique(part.astype(np.uint64), return_counts=True)
        merged.add(keys, counts)
        merged.merge()
        assert len(merged.keys) <= len(stream) // 100 + 1
    assert merged.lowered < 100
    kept = set(merged.survivors().column("key").to_pylist())
    assert set(range(40)) <= kept and len(kept) < 600


PROSE = "The report of the council was that it is to be in the hands of those who have the right to it, "


def page(body, head="<title>T</title>"):
    return f"<!DOCTYPE html><html><head>{head}</head><body>{body}</body></html>"


def text(html):
    return "\n".join(b.text for b in kept_blocks(page_blocks(html)))


@pytest.mark.parametrize("html, expected", [
    (page("<nav><a href=/>Home</a></nav><article><h1>A  &amp; B</h1><p>Sh is.<p>" + PROSE * 2 +
          "<br>x<aside>side</aside></article><footer>" + PROSE * 3 + "</footer>"),
     "A & B\nSh is.\n" + PROSE * 2 + "x"),
    # Without a container stop words and links decide, and headings follow what they head.
    (page("<div id=top><h2>Menu</h2><ul><li><a href=a>One thing</a><li><a href=b>Other thing</a></ul></div>"
          "<h1>Story</h1><div>" + PROSE * 2 + "</div><p>Short.</p><div>" + PROSE * 2 + "</div>"
          "<div class='user-comments'>" + PROSE * 3 + "</div><p>zzz qqq " + "kkkk wwww " * 30 + "</p>"),
     "Story\n" + (PROSE * 2).strip() + "\nShort.\n" + (PROSE * 2).strip()),
    (page("<article><p>Only.</p></article><div>" + PROSE * 3 + "</div>"), "Only."),
    (page("<main><p class=cookie-notice>We use " + PROSE + "<p>One&nbsp;&#116;wo <b>thr</b>ee</main>"), "One two three"),
    (page("<article><script>if (a<b) '</p>'</script><style>p{}</style><p>Kept <!-- no > --> here"
          "<form><p>not this</form><p style='display: none'>nor this</p><p hidden>nor</p></article>"), "Kept here"),
    ("<article><p>It ends <a hre", "It ends"),
    ("<p a='>' b=\">\">plain</p>", ""), ("", ""), ("no markup", ""),
    ("<article><ul><li><a href=x>Link only</a></li></ul><p>Text</article>", "Text"),
    ("<article>" + "<div>" * 3000 + "deep" + "<a <b <" * 20, "deep" + "<a <b <" * 20),
])
def test_blocks_of_pages(html, expected):
    assert text(html) == " ".join(expected.split(" ")).strip() if "<a <b" not in expected else "deep" in text(html)


def test_text_of_given_pages(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = QUERIES["op13_html_extraction"](spark, SF).collect()
    assert len(got) == len(pages)
    for row in got:
        inner = re.search("<article>(.*)</article>", pages[row.page_id], re.S)[1].replace("<br>", " ")
        parts = re.split("</?(?:p|h1)>", inner.replace("<b>", ""))
        assert row.text == "\n".join(x for x in (" ".join(unescape(p).split()) for p in parts) if x)
        assert row.n_chars == len(row.text) and row.n_kept <= row.n_blocks


def test_odd_pages(spark):
    rows = [(1, "u", None, 0), (1, "u", None, 0), (None, None, "", 1), (2, None, "<article><p>x" + " \n y" * 9000, 2)]
    pages = spark.createDataFrame(rows, "page_id int, url string, html string, text int")
    got = extract_text(pages).collect()
    assert sorted((r.page_id or 0, r.n_chars) for r in got) == [(0, 0), (1, 0), (1, 0), (2, 18001)]
    assert all(r.text is not None for r in got)
    assert extract_text(pages.limit(0)).collect() == []
    assert extract_text(pages.select("page_id", F.lit("u").alias("url"), "html")).count() == 4
