from __future__ import annotations

import collections
import math
import random
import re

import numpy as np
from pyspark.sql import functions as F

from quire.llm import maxscore

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def plain(docs, items, k=50):
    """Every document scored for every item."""
    tf = [collections.Counter(words(t)) for _, t in docs]
    n, size = sum(bool(x) for x in tf), sum(x.total() for x in tf)
    df = collections.Counter(t for x in tf for t in x)
    asked = collections.defaultdict(set)
    for i, t in items:
        if i is not None:
            asked[i].update(words(t))
    out = []
    for item, own in asked.items():
        found = []
        for (d, _), x in zip(docs, tf):
            if x:
                m = 50 + (50 * x.total() * n) // size
                s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * x[t]) // (1000 * x[t] + 20 * m)) for t in own if x[t])
                if s > 0:
                    found.append((-s, d is not None, d))
        out += [(item, rank, d, -s) for rank, (s, _, d) in enumerate(sorted(found, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return sorted(out, key=str)


def check(spark, docs, items, more=(), **kw):
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in docs], DOCS).repartition(3).withColumns({c: F.lit(1) for c in more})
    asked = spark.createDataFrame(items, "item_id bigint, text string").withColumns({c: F.lit(1) for c in more})
    got = maxscore.search(df, asked, **kw)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == plain(docs, items, kw.get("k", 50))


def made(seed, n_docs, n_items):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)] + ["the", "The", "OF", "é́ſ", "中文", "a1"]
    pick = lambda n: r.choice([" ", "-", "\n", "_"]).join(vocabulary[min(int(r.paretovariate(0.6)), len(vocabulary)) - 1] for _ in range(n))
    texts = [pick(r.choice([1, 5, 30, 200])) for _ in range(n_docs)]
    return [(i, r.choice(texts)) for i in range(n_docs)], [(i, pick(r.choice([1, 3, 12, 40]))) for i in range(n_items)]


def test_search_against_every_score(spark):
    docs, items = made(1, 600, 40)
    check(spark, docs, items)
    check(spark, docs, items, k=7, shard_postings=500, block_terms=60)


def test_threshold_skips_but_loses_nothing(spark, monkeypatch):
    monkeypatch.setattr(maxscore, "BLOCK_DOCS", 16)
    docs, items = made(2, 500, 20)
    tf = [maxscore.terms(t.encode()) for _, t in docs]
    number = {t: i for i, t in enumerate(sorted({t for x in tf for t in x}))}
    sized = [len(x) for x in tf]
    df = np.bincount([number[t] for x in tf for t in x])
    weight = np.floor(1000 * np.log((2 * len(docs) + 2) / (2 * df + 1))).astype(np.int64)
    n, size = len(docs), sum(x.total() for x in tf)
    gain = np.array([(10**9 * c) // (1000 * c + 20 * (50 + 50 * x.total() * n // size)) for x in tf for c in x.values()])
    shard = maxscore.Shard([i for i, _ in docs], np.repeat(np.arange(n), sized), np.array([number[t] for x in tf for t in x]), gain, weight)
    want = plain(docs, items, 5)
    looked = []
    real = np.searchsorted
    monkeypatch.setattr(maxscore.np, "searchsorted", lambda a, v, *x, **y: (looked.append(np.size(v)), real(a, v, *x, **y))[1])
    for item, text in items:
        best = maxscore.Best(5)
        shard.search([number[t.encode()] for t in set(words(text)) if t.encode() in number], best)
        assert [(item, k, d, int(s)) for k, (s, d) in enumerate(zip(best.score, best.doc), 1)] == [x for x in sorted(want, key=lambda x: x[1]) if x[0] == item]
    lists = sum(len(docs) * sum(w.encode() in number for w in {*words(t)}) for _, t in items)
    assert sum(looked) < lists  # far from every document is probed for every term


def test_search_odd_rows(spark):
    texts = [None, "", "!!!", "word", "word", "a b c " * 300_000, "É́ ſ K", "\n\n", "Word WORD"]
    docs = [*enumerate(texts), (None, "word"), (3, "other word")] * 2
    items = [(1, "word"), (1, "a"), (1, "word"), (2, None), (3, ""), (None, "word"), (4, "K ſ É́"), (5, "zzz")]
    check(spark, docs, items, ["doc", "term", "item", "score", "rank", "n", "tf", "t"])
    check(spark, [], items)
    check(spark, docs, [])
    check(spark, [(1, None)], items)


def test_long_text_in_pieces(monkeypatch):
    text = (" ".join(f"w{i % 97}" for i in range(5000)) + "x" * 500).encode()
    whole = maxscore.terms(text)
    monkeypatch.setattr(maxscore, "PIECE", 64)
    assert maxscore.terms(text) == whole == collections.Counter(w.encode() for w in words(text.decode()))
