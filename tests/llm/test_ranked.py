"""Ranked search against SQL and brute force, and the Best Position Algorithm against full scoring."""

import math
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from recordloom.llm import queries, ranked

NAMES = ["item_id", "rank", "doc_id", "score"]
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return [re.sub("[A-Z]", lambda m: m.group().lower(), t) for t in TERM.findall(text or "")]


def brute(docs, items, k=10):
    bags = [(i, Counter(words(t))) for i, t in docs]
    n_docs, n_words = sum(bool(b) for _, b in bags), sum(b.total() for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scores = []
        for doc, bag in bags:
            m = 100 - 90 + (90 * bag.total() * n_docs) // max(n_words, 1)
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * bag[t] // (1000 * bag[t] + 8 * m))
                    for t in set(words(text)) if bag[t])
            if s > 0:
                scores.append((-s, doc is None, doc or 0, doc))
        out += [(item, r, x[3], -x[0]) for r, x in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def ranked_rows(docs, items, **names):
    return sorted((tuple(r) for r in ranked.search(docs, items, **names).select(*NAMES).collect()), key=str)


def test_whole_table_equals_sql(spark, sf, con):
    got = sorted(tuple(r) for r in queries.QUERIES["op11_ranked_search"](spark, sf).select(*NAMES).collect())
    assert got and got == sorted(con.execute(queries.SQL["op11_ranked_search"]).fetchall())


def test_odd_rows(spark, odd, empty):
    items = [(1, "One two THREE four"), (2, None), (3, ""), (4, "-- !!"), (5, "nowhere"), (6, "Ünïcode ſtraße привет"), (None, "w5x5 w1x1 short"),
             (1, "five. five FIVE six"), (7, "with id short another w29999x29999")]
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit("x")).withColumn("score", F.lit("x"))
    docs = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    assert ranked_rows(odd, asked) == brute(docs, items)
    assert ranked_rows(empty, asked) == ranked_rows(odd, asked.where("false")) == []


def test_small_shards_and_blocks(spark, docs, con, monkeypatch):
    """Blocks of few terms and many shards give the same rows."""
    monkeypatch.setattr(ranked, "BLOCK_TERMS", 300)
    texts = con.execute("SELECT doc_id, text FROM documents").fetchall()
    items = con.execute("SELECT item_id, text FROM benchmark WHERE item_id % 2 = 0").fetchall()
    asked = spark.createDataFrame(items, "i long, t string")
    assert len(list(ranked.blocks_of(iter(items)))) > 1
    assert ranked_rows(docs, asked, item_id="i", item_text="t") == brute(texts, items)


def impact_lists(rng, docs, terms, ties):
    term, doc = np.nonzero(rng.random((terms, docs)) < rng.random((terms, 1)))
    impact = rng.integers(1, 4 if ties else 10_000, len(term))
    order = np.argsort(doc, kind="stable")
    return term[order], doc[order], impact[order]


def test_best_positions_give_the_exact_top(monkeypatch):
    """Full lists of ties, missing terms, few documents; and reading stops early where scores fall quickly."""
    rng = np.random.default_rng(7)
    monkeypatch.setattr(ranked, "FIRST_READ", 2)
    for case in range(120):
        docs, terms = int(rng.integers(1, 80)), int(rng.integers(1, 7))
        term, doc, impact = impact_lists(rng, docs, terms, case % 2)
        lists = ranked.Lists(term, doc, impact, docs)
        asked = sorted(set(rng.integers(0, terms + 2, 4).tolist()))
        total = np.zeros(docs, dtype=int)
        for t in asked:
            total[doc[term == t]] += impact[term == t]
        want = sorted(((-s, d) for d, s in enumerate(total.tolist()) if s), key=lambda x: x)[:5]
        found, scores, _ = lists.best(asked, 5)
        assert [(-s, d) for d, s in zip(found.tolist(), scores.tolist(), strict=True)] == want
        # With a score that others have already, what could still enter is found.
        least = -want[-1][0] if len(want) == 5 else 0
        found, scores, _ = lists.best(asked, 5, least)
        assert {(-s, d) for d, s in zip(found.tolist(), scores.tolist(), strict=True) if s >= max(least, 1)} == set(want)


def test_reading_stops_early():
    docs = 5_000
    term = np.repeat([0, 1], docs)
    doc = np.tile(np.arange(docs), 2)
    impact = np.concatenate([np.arange(docs, 0, -1) ** 2, np.arange(docs, 0, -1) ** 2])
    order = np.argsort(doc, kind="stable")
    found, _, read = ranked.Lists(term[order], doc[order], impact[order], docs).best([0, 1], 10)
    assert found.tolist() == list(range(10)) and read < 200
