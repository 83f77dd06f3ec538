from __future__ import annotations

import random

from pyspark.sql import functions as F

from quire.llm import license_scan

DOCS = "doc_id bigint, text string"
MIT = " ".join(license_scan.TEXTS["mit-text"].split())


def labels(spark, texts, **kw):
    rows = license_scan.license_scan(spark.createDataFrame(list(enumerate(texts)), DOCS), **kw).collect()
    return {r["doc_id"]: (r["labels"], round(r["score"], 6)) for r in rows}


def test_word_pairs_of_a_license_are_no_license(spark):
    w = MIT.split()
    salad = [x for a, b in zip(w[::2], w[1::2]) for x in (a, b, "zzz")]
    triples = [x for i in range(0, len(w) - 2, 3) for x in (*w[i : i + 3], "zzz")]
    shuffled = w[:]
    random.Random(1).shuffle(shuffled)
    halves = w[len(w) // 2 :] + w[: len(w) // 2]
    got = labels(spark, [" ".join(x) for x in (salad, triples, shuffled, halves)] + ["Sit under the tree; the MIT hosts. MIT license plates", "released under the tree the mit license"])
    # pairs, pieces of three words, any order, words near each other
    assert {got[i] for i in (0, 1, 2, 4)} == {("", 0.0)}
    # the notice stands whole in the halves that changed places, the text does not; the last one says the phrase in rising words
    assert got[3] == ("mit", 1.0)
    assert got[5][0] == ""


def test_licenses_with_changed_words(spark):
    w = MIT.split()
    fewer = [x for i, x in enumerate(w) if i % 40 != 7]
    more = [x for i, x in enumerate(w) for x in ([x, "very"] if i % 40 == 7 else [x])]
    other = [("sold" if i % 30 == 9 else x) for i, x in enumerate(w)]
    got = labels(spark, ["before " * 50 + MIT.upper() + " after", " ".join(fewer), " ".join(more), " ".join(other), " ".join(w[: len(w) * 7 // 10]), MIT + " x " + MIT])
    assert got[0] == ("mit,mit-text", 1.0) == got[5]
    assert all("mit-text" in got[i][0].split(",") for i in (1, 2, 3))
    assert got[4][0] == "mit"


def plain_cover(text, phrase, slack):
    """Best rising coverage over windows of diagonals, word by word."""
    t, p = text.split(), phrase.split()
    k = min(3, len(p))
    hits = sorted((i, j) for i in range(len(t) - k + 1) for j in range(len(p) - k + 1) if t[i : i + k] == p[j : j + k])
    best = 0.0
    for start in {i - j for i, j in hits}:
        high, took = -1, []
        for i, j in hits:
            if start <= i - j <= start + slack:
                if j > high:
                    took.append(j)
                high = max(high, j)
        best = max(best, len({j + x for j in took for x in range(k)}) / len(p))
    return best


def test_spans_against_plain_windows(spark):
    r = random.Random(5)
    phrases = {"a": "one two three four five six seven eight", "b": "one two three one two three four", "c": "red blue", "d": " ".join(r.choice("pqrstuv") for _ in range(70))}
    texts = []
    for _ in range(150):
        w = []
        for _ in range(r.randint(1, 4)):
            own = r.choice(list(phrases.values())).split()
            for _ in range(r.choice([0, 1, 2, 8])):
                at = r.randrange(len(own) + 1)
                own[at : at + r.choice([0, 1])] = r.choice([[], ["x"], ["one"], ["p", "q"]])
            w += own + ["y"] * r.randint(0, 2)
        texts.append(" ".join(w))
    templates = spark.createDataFrame(list(phrases.items()), "label string, phrase string")
    got = labels(spark, texts, templates=templates)
    some = set()
    for i, t in enumerate(texts):
        cover = {label: plain_cover(t, p, min(len(p.split()) // 8, 12)) for label, p in phrases.items()}
        held = {label: c for label, c in cover.items() if c >= 0.75}
        some |= set(held)
        assert got[i] == (",".join(sorted(held)), round(max(held.values(), default=0.0), 6))
    assert some == set(phrases)


def test_templates_beyond_the_broadcast_bound(spark, monkeypatch):
    texts = ["x all rights reserved", MIT, None, ""]
    want = labels(spark, texts)
    monkeypatch.setattr(license_scan, "BROADCAST_GRAMS", 0)
    assert labels(spark, texts) == want and want[0] == ("reserved", 1.0)


def test_repeated_rows_and_long_text(spark):
    df = spark.createDataFrame([(1, "word " * 200_000 + MIT), (None, "cc by"), (2, None)], DOCS).withColumns({c: F.lit(1) for c in ("row", "id", "tmpl", "at", "label", "base", "n_words")})
    got = sorted((str(r["doc_id"]), r["n_words"], r["labels"], r["first_word"]) for r in license_scan.license_scan(df.unionByName(df)).collect())
    n = 200_000 + len(MIT.split())
    assert got == [x for y in [("1", n, "mit,mit-text", None), ("2", 0, "", None), ("None", 2, "cc-by", 0)] for x in (y, y)]
