"""How alike two texts are, statements in front of solutions, and the best pairing of blocks with problems."""

from __future__ import annotations

import re
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

# Shares of the score, words looked at, least score of a pair, bounds of restatements and prefixes.
RATIO_SHARE, SCORE_WORDS, LEAST_SCORE = 0.7, 180, 0.12
RESTATED_LENGTH, RESTATED_RATIO, PREFIX_WORDS, PREFIX_SHARE, OPENING_WORDS, OPENING_RATIO = 1.3, 0.85, 12, 0.85, 8, 0.75


def words(x: str | None) -> list[str]:
    return re.findall("[a-z0-9]+", (x or "").lower())


def match_scores(left: list[str | None], right: list[str | None]) -> np.ndarray:
    """For each text of `left` with each of `right` order and choice of words: ratio of the first words' sequences, and
    Jaccard similarity of all words.  Each text is read once; equal sequences have ratio 1."""
    a, b = ([(" ".join(w[:SCORE_WORDS]), set(w)) for w in map(words, x)] for x in (left, right))
    out, matcher = np.zeros((len(a), len(b))), SequenceMatcher(None)
    for j, (second, these) in enumerate(b):
        ready = False
        for i, (first, those) in enumerate(a):
            if not those or not these:
                continue
            ratio = 1.0
            if first != second:
                if not ready:
                    matcher.set_seq2(second)
                    ready = True
                matcher.set_seq1(first)
                ratio = matcher.ratio()
            both = len(those & these)
            out[i, j] = RATIO_SHARE * ratio + (1 - RATIO_SHARE) * both / (len(those) + len(these) - both)
    return out


def match_score(a: str | None, b: str | None) -> float:
    return float(match_scores([a], [b])[0, 0])


@F.pandas_udf(DoubleType())
def score(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([match_score(x, y) for x, y in zip(a, b)], dtype="float64")


def is_restated(body: str | None, statement: str | None) -> bool:
    """Whether a body only says the statement again."""
    x, y = words(body), words(statement)
    if not x or not y or len(x) > RESTATED_LENGTH * len(y):
        return False
    return SequenceMatcher(None, x, y).ratio() >= RESTATED_RATIO


@F.pandas_udf(StringType())
def without_restatement(body: pd.Series, statement: pd.Series) -> pd.Series:
    """The body, or null if it only says the statement again."""
    return pd.Series([None if is_restated(x, y) else x for x, y in zip(body, statement)])


def _after(text: str, count: int) -> str:
    """What follows the first `count` words."""
    at = 0
    for m in list(re.finditer("[A-Za-z0-9]+", text))[:count]:
        at = m.end()
    return re.sub(r"^[\s.,:;!?$*_)\]}]+", "", text[at:])


def without_statement(body: str | None, statement: str | None) -> str | None:
    """A body without the statement it begins with: the same words (most of at least PREFIX_WORDS), or the same opening and
    much the same words after."""
    x, y = words(body), words(statement)
    if not x or len(y) < OPENING_WORDS:
        return body
    same = next((i for i, (a, b) in enumerate(zip(x, y)) if a != b), min(len(x), len(y)))
    if same >= PREFIX_WORDS and same >= PREFIX_SHARE * len(y):
        return _after(body, same)
    if same >= OPENING_WORDS and SequenceMatcher(None, x[: len(y)], y).ratio() >= OPENING_RATIO:
        return _after(body, len(y))
    return body


@F.pandas_udf(StringType())
def statement_off(body: pd.Series, statement: pd.Series) -> pd.Series:
    return pd.Series([without_statement(x, y) for x, y in zip(body, statement)])


def exact_statement_off(body: Column, statement: Column) -> Column:
    """A body without its statement where it begins with it, spaces aside."""
    flexible = F.regexp_replace(F.regexp_replace(F.trim(statement), r"([\\^$.|?*+()\[\]{}])", r"\\$1"), r"\s+", r"\\s+")
    return F.when(F.length(F.trim(statement)) > 0, F.regexp_replace(body, F.concat(F.lit(r"^\s*"), flexible, F.lit(r"\s*")), F.lit(""))).otherwise(body)


def best_pairs(scores: np.ndarray, least: float = LEAST_SCORE) -> list[tuple[int, int]]:
    """(row, column) pairs, each used once, of the greatest total score; pairs under `least` are left apart.

    Shortest augmenting paths over a square table filled up with zeros."""
    n, m = scores.shape
    size = max(n, m)
    cost = np.zeros((size + 1, size + 1))
    cost[1 : n + 1, 1 : m + 1] = -np.where(scores >= least, scores, 0.0)
    u, v, owner, way = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1, dtype=int), np.zeros(size + 1, dtype=int)
    for i in range(1, size + 1):
        owner[0], j = i, 0
        near, used = np.full(size + 1, np.inf), np.zeros(size + 1, dtype=bool)
        while True:
            used[j] = True
            slack = cost[owner[j]] - u[owner[j]] - v
            better = ~used & (slack < near)
            near[better], way[better] = slack[better], j
            k = int(np.argmin(np.where(used, np.inf, near)))
            step = near[k]
            u[owner[used]] += step
            v[used] -= step
            near[~used] -= step
            j = k
            if not owner[j]:
                break
        while j:
            owner[j], j = owner[way[j]], way[j]
    return sorted((int(owner[j]) - 1, j - 1) for j in range(1, m + 1) if owner[j] <= n and scores[owner[j] - 1, j - 1] >= least)


def assigned(problems: DataFrame, blocks: DataFrame, key: str) -> DataFrame:
    """key, problem, block_no, score: the pairing of a test's problems (key, problem, text) and blocks (key, block_no, text)
    with the greatest total score.  A test is the unit: its problems and blocks meet in one task."""
    kind = problems.schema[key].dataType.simpleString()

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        a, b = left.to_pylist(), right.to_pylist()
        table = match_scores([x["text"] for x in a], [y["text"] for y in b])
        got = best_pairs(table) if a and b else []
        return pa.table({key: pa.array([a[i][key] for i, _ in got], left.schema.field(key).type), "problem": pa.array([a[i]["problem"] for i, _ in got], pa.int64()), "block_no": pa.array([b[j]["block_no"] for _, j in got], pa.int64()), "score": pa.array([float(table[i, j]) for i, j in got], pa.float64())})

    other = blocks.select(F.col(key).alias("__key"), F.col("block_no").alias("block_no"), F.col("text").alias("text"))
    return problems.select(key, "problem", "text").groupBy(key).cogroup(other.groupBy("__key")).applyInArrow(run, f"`{key}` {kind}, problem bigint, block_no bigint, score double")
