from __future__ import annotations

import collections
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.llm import katz

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
START, END = "<s>", "</s>"


def tokens(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), END]


def ratios(counts):
    """Good-Turing ratio of each count by the plain formula, with the same rule where it fails."""
    n = collections.Counter(counts)
    for k in range(5, 0, -1):
        if all(n[r] for r in range(1, k + 2)):
            common = (k + 1) * n[k + 1] / n[1]
            d = {r: ((r + 1) * n[r + 1] / (r * n[r]) - common) / (1 - common) for r in range(1, k + 1)} if common < 1 else {}
            if d and all(0 < x < 1 for x in d.values()):
                return lambda r: d.get(r, d[k])
    return lambda r: 0.75


class Plain:
    """The model as dictionaries, evaluated token by token."""

    def __init__(self, texts):
        self.word, self.pair = collections.Counter(), collections.defaultdict(collections.Counter)
        for t in texts:
            before = START
            for w in tokens(t):
                self.word[w] += 1
                self.pair[before][w] += 1
                before = w
        self.total = sum(self.word.values())
        d1 = ratios(self.word.values())
        self.share = {w: d1(c) * c / self.total for w, c in self.word.items()}
        self.unknown = 1 - sum(self.share.values()) if self.word else 1.0
        self.d2 = ratios([c for own in self.pair.values() for c in own.values()])

    def probability(self, before, w):
        own = self.pair.get(before)
        if own and w in own:
            return self.d2(own[w]) * own[w] / sum(own.values())
        p = self.share.get(w, self.unknown)
        if own:
            p *= (1 - sum(self.d2(c) * c for c in own.values()) / sum(own.values())) / (1 - sum(self.share[x] for x in own))
        return p

    def score(self, text):
        own = tokens(text)
        return sum(math.log10(self.probability(a, b)) for a, b in zip([START, *own], own))

    def base(self, text):
        return sum(math.log10((self.word[w] + 0.5) / (self.total + 0.5 * (len(self.word) + 1))) for w in tokens(text))


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 1


def check(spark, docs, more=(), **kw):
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in docs], DOCS).repartition(5).withColumns({c: F.lit(1) for c in more})
    model = Plain([t for i, t in docs if i is not None and not held(i)])
    got = sorted((tuple(x) for x in katz.score(df, **kw).collect()), key=str)
    want = sorted(((i, held(i), len(tokens(t)), sum(w in model.word for w in tokens(t)), model.total, model.base(t), model.score(t)) for i, t in docs), key=str)
    assert [x[:5] for x in got] == [x[:5] for x in want]
    np.testing.assert_allclose([x[5:] for x in got], [x[5:] for x in want], rtol=1e-9, atol=1e-9)
    return model


def made(seed, n):
    r = random.Random(seed)
    vocabulary = ["The", "the", "é́ſ", "中文", "a-b"] + [f"w{i}" for i in range(3000)]
    texts = [" ".join(vocabulary[min(int(r.paretovariate(0.55)), len(vocabulary)) - 1] for _ in range(r.choice([0, 1, 8, 60]))) for _ in range(n)]
    return list(enumerate(texts))


@pytest.mark.parametrize("sizes", [(10**9, 10**9), (200, 150)])
def test_scores_against_plain_model(spark, sizes):
    model = check(spark, made(1, 400), block_tokens=sizes[0], bucket_tokens=sizes[1])
    d = [model.d2(r) for r in range(1, 8)]
    assert len(set(d)) > 1 and all(0 < x < 1 for x in d)


def test_plain_model_is_normalised():
    """What the operator is held against sums to one in every context, unknown words being one class."""
    model = Plain([t for _, t in made(2, 200)])
    for before in [*list(model.pair)[:80], START, "never seen"]:
        assert math.isclose(sum(model.probability(before, w) for w in model.word) + model.probability(before, "never seen"), 1, rel_tol=1e-9)


def test_hot_words_are_spread(spark):
    """One word is half of all tokens, one pair a quarter."""
    r = random.Random(3)
    docs = [(i, " ".join(r.choice(["x", "x", "x x", f"v{r.randint(0, 30)}"]) for _ in range(40))) for i in range(150)]
    check(spark, docs, block_tokens=100, bucket_tokens=80)


def test_scores_odd_rows(spark):
    texts = [None, "", "!!!", "word", "Word", "a b c " * 30000, "É́ ſ K", "\n\n", "\x0b\x0c x y \x1f", "never-again"]
    check(spark, [*enumerate(texts), (None, "word zzz"), (3, "other word")] * 2, ["t", "key", "held", "learn", "kind", "bucket", "block", "data", "score", "n_tokens"])


def test_scores_without_training(spark):
    none = [i for i in range(40) if held(i)]
    check(spark, [(i, "a b") for i in none] + [(None, "a")])
    assert katz.score(spark.createDataFrame([], DOCS)).count() == 0


def test_discounts_fall_back():
    assert katz.Discounts.of([0, 0, 0, 0, 0, 0]).low == [0.75] * 5
    d = katz.Discounts.of([100, 40, 20, 12, 8, 6])
    assert abs(d.low[0] - 0.6875) < 1e-12 and 0 < min(d.low) and d.high == d.low[-1] < 1
    short = katz.Discounts.of([100, 40, 20, 12, 8, 0])
    assert short.low[3] == short.low[4] == short.high
