"""Language ID and BPE held against plain versions over a whole table."""

from __future__ import annotations

import collections
import hashlib
import zlib

import numpy as np
from pyspark.sql import functions as F

from quire.llm import bpe, langid
from quire.llm.queries import tokenizer_path

TABLE = "/root/testdata/sf0.001/documents.parquet"
MASK = (1 << 64) - 1


def plain_features(text):
    """Letter n-grams counted one by one."""
    if not text or not any(c.isalpha() for c in text.lower()):
        return None
    letters, before = [32], True
    for c in text.lower():
        if c.isalpha() or before:
            letters.append(ord(c) if c.isalpha() else 32)
        before = c.isalpha()
    letters.append(32)
    counts = collections.Counter()

    def add(h):
        h ^= h >> 29
        h = h * 0xBF58476D1CE4E5B9 & MASK
        counts[h >> 52] += 1

    for k, a in enumerate(letters):
        one = a * 0x9E3779B97F4A7C15 & MASK
        add(one)
        if k + 1 < len(letters):
            two = one ^ (letters[k + 1] * 0xC2B2AE3D27D4EB4F & MASK)
            add(two * 0xD6E8FEB86659FD93 & MASK)
        if k + 2 < len(letters):
            add((two ^ (letters[k + 2] * 0x165667B19E3779F9 & MASK)) * 0xA0761D6478BD642F & MASK)
    v = np.zeros(langid.DIMS)
    for h, n in counts.items():
        v[h] = n**0.5
    return v / np.linalg.norm(v)


def plain_predict(model, v):
    """Family by the highest machine, then every pair of its languages votes; of equal ones the first of the alphabet."""
    if v is None:
        return "und"
    marks = [(float(v @ w + b), f) for f, (w, b) in model.family_machines.items()]
    family = min((f for m, f in marks if m == max(marks)[0]), default=model.families[0])
    votes, total = collections.Counter(), collections.Counter()
    for a, b, w, c in model.pairs[family]:
        m = float(v @ w + c)
        votes[a if m >= 0 else b] += 1
        total[a] += m
        total[b] -= m
    return min(model.members[family], key=lambda x: (-votes[x], -total[x], x))


def test_features_one_by_one():
    for text in ["", None, "...", "a", "Ab c", " x", "ÉÀ où\n\nß 3 中文", "a  b--c"]:
        want, got = plain_features(text), langid.features(text)
        assert (want is None) == (got is None)
        if want is not None:
            np.testing.assert_allclose(got, want, atol=1e-6)


def test_language_of_a_whole_table(spark):
    rows = spark.read.parquet(TABLE).collect()
    held = {r["doc_id"]: zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 for r in rows}
    train = [r for r in rows if r["lang"] is not None and not held[r["doc_id"]]]
    known = [(r["lang"], f.astype(np.float32)) for r in train if (f := plain_features(r["text"])) is not None]
    known.sort(key=lambda x: (x[0], x[1].tobytes()))
    model = langid.Model(np.array([f for _, f in known], dtype=np.float64), [v for v, _ in known])
    got = {r["doc_id"]: (r["held_out"], r["lang_pred"]) for r in langid.identify(spark.read.parquet(TABLE)).collect()}
    want = {r["doc_id"]: (held[r["doc_id"]], plain_predict(model, plain_features(r["text"]))) for r in rows}
    assert got == want and len(got) == len(rows)


def test_ties_go_by_the_alphabet():
    model = langid.Model(np.zeros((4, langid.DIMS)), ["nl", "en", "de", "fr"])
    v = np.zeros(langid.DIMS)
    for own in model.pairs:
        model.pairs[own] = [(a, b, v, 0.0) for a, b, _, _ in model.pairs[own]]
    model.family_machines = {f: (v, 0.0) for f in model.families}
    assert model.predict(v)[0] == "de" == plain_predict(model, v)


def test_bpe_of_a_whole_table(spark):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(tokenizer_path())
    docs = spark.read.parquet(TABLE).union(spark.range(1).select(F.lit(-1).cast("long"), F.repeat(F.lit("A very long text, é 中文 123 'll. "), 40000), F.lit("en"), F.lit("s"), F.lit(1).cast("long")))
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in bpe.encode(docs, tokenizer_path(), digests_only=True).collect()}
    for r in docs.collect():
        ids = lib.encode(r["text"] or "", add_special_tokens=False).ids
        digest = hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert got[r["doc_id"]] == (len(ids), digest, hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest())
