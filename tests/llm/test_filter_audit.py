from __future__ import annotations

import collections
import itertools
import random
import re

from pyspark.sql import functions as F

from quire.llm import filter_audit

LABELS = "doc_id bigint, quality int, toxic int"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def plain(docs, labels):
    """Every order applied to every document, one after the other."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    least = {}
    for i, t, _ in docs:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    rows = collections.defaultdict(list)
    for i, t, s in docs:
        t, words = t or "", [w for w in re.split(r"[\x20\x09-\x0D]+", t or "") if w]
        bad = {
            "A": len(words) < 50,
            "B": 100 * len(set(words)) < 65 * len(words),
            "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)),
            "E": i is not None and t in least and least[t] < i,
        }
        rows[s or ""].append(({k for k, v in bad.items() if v}, i in good, i in toxic))
    out, share = {}, collections.Counter()
    for part, own in rows.items():
        for order in map("".join, itertools.permutations("ABCDE")):
            for step, f in enumerate(order, 1):
                before = set(order[: step - 1])
                removed = [x for x in own if f in x[0] and not x[0] & before]
                share[part, f] += len(removed)
                out[part, order, step] = (
                    sum(not x[0] & (before | {f}) for x in own), len(removed), sum(f in x[0] and bool(x[0] & before) for x in own),
                    sum(x[0] == {f} for x in own), sum(x[1] for x in removed), sum(x[2] for x in removed))
    return {k: (*v, share[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def check(spark, docs, labels, more=()):
    df = spark.createDataFrame([(i, t, "en", s, 0) for i, t, s in docs], DOCS).repartition(3).withColumns({c: F.lit(1) for c in more})
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    got = filter_audit.filter_audit(df, spark.createDataFrame(labels, LABELS)).collect()
    assert {(x["part"], x["filter_order"], x["step"]): tuple(x[n] for n in names) for x in got} == plain(docs, labels)
    assert len(got) == 600 * len({s or "" for _, _, s in docs})


def test_audit_against_every_order(spark):
    r = random.Random(4)
    words = ["one", "Two", "THREE", "4%", "five|", "six", *(f"w{i}" for i in range(200))]
    texts = [" ".join(r.choice(words if r.random() < 0.9 else words[:6]) for _ in range(r.choice([3, 49, 50, 51, 120]))) for _ in range(120)]
    texts += [" ".join(["a", "B", "c"] * 20), "X " * 60, " ".join(f"v{i}" for i in range(60))]
    docs = [(i, r.choice(texts), r.choice(["s0", "s0", "s1", "", None])) for i in range(400)]
    labels = [(i, r.choice([0, 1, None]), r.choice([0, 1, None])) for i in range(0, 400, 2)]
    check(spark, docs, labels)


def test_audit_odd_rows(spark):
    texts = [None, "", "!!!", "word", "word", "a b c " * 40000, "É́ ſ K", "\n\n", "\x0b\x0c", "#"]
    docs = [(i, t, None if i % 3 == 0 else "s") for i, t in enumerate(texts)] + [(None, "word", "s"), (None, None, None), (3, "word", "s"), (4, "word", "s")]
    labels = [(0, 1, 0), (0, 0, 1), (3, None, None), (3, 1, 1), (None, 1, 1), (99, 1, 1)]
    check(spark, docs * 2, labels, ["id", "part", "mask", "good", "toxic", "n", "digest", "first", "own", "t", "quality"])


def test_audit_of_nothing(spark):
    none, labels = spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)
    assert filter_audit.filter_audit(none, labels).count() == 0
    docs = spark.createDataFrame([(1, "x", "en", "s", 1)], DOCS)
    assert filter_audit.filter_audit(docs, labels).count() == 600


def test_audit_keeps_a_hot_copy_whole(spark):
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "same").otherwise(F.concat(F.lit("t"), F.col("id"))).alias("text"), F.lit("s").alias("source"))
    got = filter_audit.filter_audit(docs, spark.createDataFrame([], LABELS)).where("filter_order = 'EABCD' AND step = 1").first()
    assert (got["kept"], got["removed"]) == (4001, 1999)
