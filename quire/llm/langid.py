"""Language identification by hierarchical discrimination.

A linear support vector machine for each language family decides the family first; within a family of several
languages, one-versus-one machines vote between them.  Features are counts of letters, letter pairs and letter triples
of the whole text, hashed to DIMS, square-rooted and scaled to unit length.

The machines are fitted on a bounded sample of labelled rows: at most TRAIN_ROWS different rows in all, shared evenly
between the languages and chosen by a hash of id and text.  Prediction reads only the text.

Defined results: null text and text without letters are "und" with score 0; without any labelled row everything is
"und"; null ids are never learned from and count as not held out; ties go to the language first in the alphabet;
repeated rows give a row each and are learned from once; with more languages than TRAIN_ROWS those with the most rows
are learned.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import trim

DIMS = 4096
#: Bound of the training sample.
TRAIN_ROWS = 2000

#: Families of ISO 639-1 codes; any other code is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af lb fy yi",
    "romance": "fr es it pt ro ca gl oc la",
    "slavic": "ru uk be pl cs sk bg mk sr hr bs sl",
    "baltic": "lt lv",
    "uralic": "fi et hu",
    "turkic": "tr az kk uz ky tk",
    "iranian": "fa ku ps tg",
    "indic": "hi bn ur pa mr gu ne si",
    "semitic": "ar he mt am",
    "celtic": "ga gd cy br",
}
FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes.split()}

_letters: np.ndarray | None = None


def letters() -> np.ndarray:
    """Which code points are letters."""
    global _letters
    if _letters is None:
        _letters = np.array([chr(i).isalpha() for i in range(0x110000)])
    return _letters


def features(text: str | None) -> np.ndarray | None:
    """Unit vector of hashed letter n-gram counts, or None without letters."""
    if not text:
        return None
    code = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    is_letter = letters()[code]
    if not is_letter.any():
        return None
    before = np.concatenate([[True], is_letter[:-1]])
    code = np.where(is_letter, code, 32)[is_letter | before].astype(np.uint64)
    a = np.concatenate([np.array([32], dtype=np.uint64), code, np.array([32], dtype=np.uint64)])
    one = a * np.uint64(0x9E3779B97F4A7C15)
    two = one[:-1] ^ (a[1:] * np.uint64(0xC2B2AE3D27D4EB4F))
    three = two[:-1] ^ (a[2:] * np.uint64(0x165667B19E3779F9))
    mixed = np.concatenate([one, two * np.uint64(0xD6E8FEB86659FD93), three * np.uint64(0xA0761D6478BD642F)])
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    counts = np.sqrt(np.bincount((mixed >> np.uint64(52)).astype(np.int64), minlength=DIMS).astype(np.float32))
    return counts / np.linalg.norm(counts)


def fit_svm(parts: list[np.ndarray], y: np.ndarray, rounds: int = 300, cost: float = 10.0) -> tuple[np.ndarray, float]:
    """Linear machine with squared hinge loss, by accelerated gradient steps; y is ±1, classes are weighted evenly.

    The rows stand in `parts`, which are views of one matrix: nothing of it is copied."""
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
    ends = np.cumsum([len(p) for p in parts])[:-1]
    w, b, vw, vb = np.zeros(parts[0].shape[1]), 0.0, np.zeros(parts[0].shape[1]), 0.0
    step = 1 / (1 + 4 * cost)
    for t in range(rounds):
        m = t / (t + 3)
        aw, ab = w + m * vw, b + m * vb
        near = aw.astype(np.float32)
        slack = np.maximum(0, 1 - y * (np.concatenate([p @ near for p in parts]) + ab)) * y * share
        pull = sum((p.T @ s).astype(np.float64) for p, s in zip(parts, np.split(slack.astype(np.float32), ends)))
        nw = aw - step * (aw / cost - 2 * cost * pull)
        nb = ab + step * 2 * cost * slack.sum()
        vw, vb, w, b = nw - w, nb - b, nw, nb
    return w, b


class Model:
    """Families, then languages within a family.  The rows of a language stand together."""

    def __init__(self, x: np.ndarray, lang: list[str]) -> None:
        self.langs = sorted(set(lang))
        of = [FAMILY.get(v, f"other:{v}") for v in lang]
        self.families = sorted(set(of))
        self.members = {f: sorted({v for v, g in zip(lang, of) if g == f}) for f in self.families}
        fam, count = np.array(of), Counter(lang)
        first = {v: lang.index(v) for v in self.langs}
        self.family_machines = {f: fit_svm([x], np.where(fam == f, 1.0, -1.0)) for f in self.families} if len(self.families) > 1 else {}
        self.pairs: dict[str, list[tuple[str, str, np.ndarray, float]]] = {}
        for f, own in self.members.items():
            self.pairs[f] = []
            for i, a in enumerate(own):
                for b in own[i + 1 :]:
                    parts = [x[first[v] : first[v] + count[v]] for v in (a, b)]
                    self.pairs[f].append((a, b, *fit_svm(parts, np.repeat([1.0, -1.0], [count[a], count[b]]))))

    @staticmethod
    def sure(margin: float) -> float:
        return float(1 / (1 + np.exp(-4 * margin)))

    def predict(self, v: np.ndarray | None) -> tuple[str, float]:
        if v is None or not self.langs:
            return "und", 0.0
        family, score = self.families[0], 1.0
        if self.family_machines:
            marks = {f: float(v @ w + b) for f, (w, b) in self.family_machines.items()}
            family = max(self.families, key=lambda f: marks[f])
            score = self.sure(marks[family] - max(m for f, m in marks.items() if f != family))
        own = self.members[family]
        votes, total = dict.fromkeys(own, 0), dict.fromkeys(own, 0.0)
        least = {}
        for a, b, w, c in self.pairs[family]:
            m = float(v @ w + c)
            votes[a if m >= 0 else b] += 1
            total[a] += m
            total[b] -= m
            least[a, b], least[b, a] = m, -m
        best = max(own, key=lambda x: (votes[x], total[x]))
        if len(own) > 1:
            score *= self.sure(min(least[best, o] for o in own if o != best))
        return best, score


def held_out(key: str = "doc_id") -> F.Column:
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", train_rows: int = TRAIN_ROWS) -> Model:
    """Fit on labelled rows that are not held out; only features of the bounded sample reach the driver."""
    known = docs.where(F.col(key).isNotNull() & F.col(lang).isNotNull() & ~held_out(key)).select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(F.col(key), F.col(text)).alias("h"))
    sizes = known.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).orderBy(F.desc("n"), "lang").limit(train_rows).collect()
    if not sizes:
        return Model(np.zeros((0, DIMS)), [])
    each = max(1, train_rows // len(sizes))
    # Twice the wanted texts and some more are left of each language before any language meets in one task.
    share = F.create_map(*[F.lit(x) for r in sizes for x in (r["lang"], (2 * each + 100) / max(1, r["n"]))])
    near = known.where(F.xxhash64("h") / 2.0**64 + 0.5 < share[F.col("lang")]).select("lang", "h").distinct()
    at = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("h"), "h"))
    chosen = near.withColumn("at", at).where(F.col("at") <= each).select("lang", "h")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(v.as_py()) for v in batch.column(2)]
            some = pa.array([f is not None for f in found], pa.bool_())
            f = pa.array([f.astype(np.float32).tobytes() for f in found if f is not None], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(some), batch.column(1).filter(some), f], names=["lang", "h", "f"])

    # `chosen` has at most train_rows rows, so the broadcast side is bounded; repeated rows are one row of the sample.
    picked = known.join(F.broadcast(chosen), ["lang", "h"]).groupBy("lang", "h").agg(F.min("text").alias("text"))
    # The sample comes as Arrow batches into one matrix of 16 KB a row: neither rows of the driver's JVM nor copies in Python.
    got = picked.mapInArrow(run, "lang string, h long, f binary").toArrow()
    langs, hashes = got.column("lang").to_pylist(), got.column("h").to_pylist()
    order = sorted(range(len(langs)), key=lambda i: (langs[i], hashes[i]))
    x, f = np.empty((len(langs), DIMS), dtype=np.float32), got.column("f")
    for at, i in enumerate(order):
        x[at] = np.frombuffer(f[i].as_buffer(), dtype=np.float32)
    del got, f
    model = Model(x, [langs[i] for i in order])
    del x
    trim()
    return model


def identify(docs: DataFrame, model: Model | None = None, key: str = "doc_id", text: str = "text", lang: str = "lang", keep: list[str] | None = None) -> DataFrame:
    """key, held_out, lang_pred, score for every row, and the columns in `keep`."""
    model = model or fit(docs, key, text, lang)
    more = keep or []
    source = docs.select(F.col(key), held_out(key).alias("held_out"), F.col(text).alias("_text"), *[F.col(c).alias(f"_keep_{c}") for c in more])
    fields = {f.name: f.dataType.simpleString() for f in source.schema.fields}
    schema = ", ".join(f"`{n}` {fields[n]}" for n in [key, "held_out", *[f"_keep_{c}" for c in more]]) + ", lang_pred string, score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [model.predict(features(v.as_py())) for v in batch.column(2)]
            columns = [batch.column(0), batch.column(1), *[batch.column(3 + i) for i in range(len(more))]]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())], names=[key, "held_out", *[f"_keep_{c}" for c in more], "lang_pred", "score"])
        trim()

    return source.mapInArrow(run, schema)
