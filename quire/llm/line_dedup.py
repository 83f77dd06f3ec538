"""Line deduplication by pairwise alignment.

Lines that hold words are hashed and counted; lines of one document only are left out.  Of the shared lines, every shortest
run of consecutive ones that holds `min_block_words` words, from each line on and up to each line, is an anchor: its key
is the hash of its rarest line (the one with the least count in the table) followed by the hash of the whole run.  Each
later document is paired with the first document that holds the anchor, so an anchor of n documents gives n - 1 pairs
however frequent it is, and no common run is missed whether its lines are rare or not: a block of that many words that
two documents share holds such runs, which cover all of it, and the first holder of each is an earlier document.

Each pair's sequences of shared lines are aligned with patience diff (lines that occur once in both anchor the alignment,
gaps are aligned in turn), and aligned blocks of at least `min_block_words` words are deleted from the later document.
What is left of it is aligned again, which finds passages that moved or repeat, until no block is found.  Only where the
alignment has no anchors, as lines of the first document repeat, are the gaps looked up in it by a suffix automaton.  So a line goes if and only if it stands in a run of at least that many words that an earlier
document holds too.

Documents are ordered by id.  Defined results: null texts and null ids pass unchanged; rows of one id are never compared
with each other, repeated rows get the same result; lines are equal when identical; words are runs of
non-space characters, in scripts without spaces single characters; lines without words are passed over, and go when they
stand between two deleted lines; a text whose lines are all deleted becomes empty; an empty table gives no rows; all
columns of the input are kept, but those named n_lines and n_deleted give way to the result's when counts are asked for.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ROW, hot_join, rejoin, row_key, saved, shuffled, spread_join

MIN_BLOCK_WORDS = 25
# Thai, Lao, Tibetan, Burmese, Khmer, kana and Han: scripts without spaces, where each character counts as a word.
NO_SPACE = r"\u0E00-\u0EFF\u0F00-\u109F\u1780-\u17FF\u2E80-\u2FDF\u3005-\u3007\u3021-\u30FA\u30FC-\u30FF\u3400-\u9FFF\uF900-\uFAFF\uFF66-\uFF9F\x{20000}-\x{3FFFF}"
# Marks of these scripts, which stand in no word.
MARKS = r"\u3001-\u3003\u3008-\u3011\u30FB\uFF01-\uFF0F\uFF1A-\uFF20"
# All of both lie here: a character below needs one comparison, not one with each range.
HIGH = r"\u0E00-\x{10FFFF}"
WORD = rf"[{HIGH}&&[{NO_SPACE}]]|[[^\s{HIGH}][{HIGH}&&[^{NO_SPACE}{MARKS}]]]+"


def _rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest run of pairs, given in order of the first part, whose second parts rise."""
    tails, at, back = [], [], []
    for n, (_, j) in enumerate(pairs):
        k = bisect_left(tails, j)
        if k == len(tails):
            tails.append(j)
            at.append(n)
        else:
            tails[k] = j
            at[k] = n
        back.append(at[k - 1] if k else -1)
    out, n = [], at[-1] if at else -1
    while n >= 0:
        out.append(pairs[n])
        n = back[n]
    return out[::-1]


def align(a: list, b: list) -> list[tuple[int, int]]:
    """Positions that patience diff pairs up, in order."""
    found, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        i, n, j, m = todo.pop()
        while i < n and j < m and a[i] == b[j]:
            found.append((i, j))
            i, j = i + 1, j + 1
        while i < n and j < m and a[n - 1] == b[m - 1]:
            n, m = n - 1, m - 1
            found.append((n, m))
        if i >= n or j >= m:
            continue
        once: dict = {}
        for k in range(i, n):
            once[a[k]] = -1 if a[k] in once else k
        there: dict = {}
        for k in range(j, m):
            if b[k] in once:
                there[b[k]] = -1 if b[k] in there else k
        anchors = _rising(sorted((once[x], k) for x, k in there.items() if k >= 0 and once[x] >= 0))
        if not anchors:
            continue
        for x, y in anchors:
            todo.append((i, x, j, y))
            found.append((x, y))
            i, j = x + 1, y + 1
        todo.append((i, n, j, m))
    return sorted(found)


def copied_runs(a: list, b: list, words: list[int], least: int) -> list[int]:
    """Positions of b in runs of at least `least` words that stand in a in one piece, in any order and any number of times.

    A suffix automaton of a gives for each position of b the longest run that ends there, in time linear in both."""
    after, link, size, last = [{}], [-1], [0], 0
    for x in a:
        new, p = len(after), last
        after.append({})
        link.append(0)
        size.append(size[last] + 1)
        while p >= 0 and x not in after[p]:
            after[p][x] = new
            p = link[p]
        if p >= 0:
            q = after[p][x]
            if size[q] != size[p] + 1:
                twin = len(after)
                after.append(dict(after[q]))
                link.append(link[q])
                size.append(size[p] + 1)
                link[q] = twin
                while p >= 0 and after[p].get(x) == q:
                    after[p][x] = twin
                    p = link[p]
                q = twin
            link[new] = q
        last = new
    total = [0]
    for n in words:
        total.append(total[-1] + n)
    state, run, starts = 0, 0, []
    for x in b:
        while state and x not in after[state]:
            state = link[state]
            run = size[state]
        if x in after[state]:
            state, run = after[state][x], run + 1
        starts.append(run)
    out, low = [], len(b)
    for j in range(len(b) - 1, -1, -1):
        if total[j + 1] - total[j + 1 - starts[j]] >= least:
            low = min(low, j + 1 - starts[j])
        if low <= j:
            out.append(j)
    return out[::-1]


def aligned_blocks(a: list, b: list, words: list[int], least: int) -> list[int]:
    """Positions of b in blocks of at least `least` words that patience diff aligns in one piece."""
    out, block, size, before = [], [], 0, None
    for x, y in [*align(a, b), (-9, -9)]:
        if before is None or (x, y) != (before[0] + 1, before[1] + 1):
            if size >= least:
                out += block
            block, size = [], 0
        if y >= 0:
            block.append(y)
            size += words[y]
        before = (x, y)
    return out


def _stretches(gone: set[int], b: list, words: list[int], least: int) -> list[tuple[int, int]]:
    """(first, end) of what is left of b, each with as much on both sides as a run may reach into what went."""
    out, i, n = [], 0, len(b)
    while i < n:
        if i in gone:
            i += 1
            continue
        z = i
        while z < n and z not in gone:
            z += 1
        low, high, left, right = i, z, 0, 0
        while low > 0 and left < least:
            low -= 1
            left += words[low]
        while high < n and right < least:
            right += words[high]
            high += 1
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], high)
        else:
            out.append((low, high))
        i = z
    return out


def common_blocks(a: list, b: list, words: list[int], least: int) -> list[int]:
    """Positions of b in blocks that it shares with a.

    Patience diff aligns a with b, then again with what is left of b (cut where blocks went), for passages that moved or
    repeat, as long as it finds blocks.  What it cannot anchor, because a's lines repeat, goes to the suffix automaton."""
    known = set(a)
    gone: set[int] = set()
    least = max(least, 1)
    while True:
        left, place = [], []
        for k, x in enumerate(b):
            if k not in gone:
                left.append(x)
                place.append(k)
            elif place and place[-1] >= 0:
                left.append(object())
                place.append(-1)
        if sum(words[k] for k in place if k >= 0 and b[k] in known) < least and len(gone) == 0:
            return []
        found = {place[k] for k in aligned_blocks(a, left, [words[k] if k >= 0 else 0 for k in place], least)} - {-1}
        gone |= found
        if not found:
            break
    for i, z in _stretches(gone, b, words, least):
        if any(b[k] in known and k not in gone for k in range(i, z)) and sum(words[k] for k in range(i, z) if b[k] in known) >= least:
            gone.update(i + k for k in copied_runs(a, b[i:z], words[i:z], least))
    return sorted(gone)


def runs(at: list[int], words: list[int], least: int) -> list[tuple[int, int]]:
    """(first, last) of the shortest runs of consecutive lines with at least `least` words, from each line on and up to each line."""
    found, n, i = set(), len(at), 0
    while i < n:
        end = i + 1
        while end < n and at[end] == at[end - 1] + 1:
            end += 1
        total = [0]
        for w in words[i:end]:
            total.append(total[-1] + w)
        hi = 0
        for lo in range(end - i):
            while hi < end - i and total[hi] - total[lo] < least:
                hi += 1
            if total[hi] - total[lo] < least:
                break
            found.add((i + lo, i + hi - 1))
        lo = 0
        for hi in range(1, end - i + 1):
            while total[hi] - total[lo + 1] >= least:
                lo += 1
            if total[hi] - total[lo] >= least:
                found.add((i + lo, i + hi - 1))
        i = end
    return sorted(found)


def _parted(at: list[int], hashes: list[bytes], words: list[int]) -> tuple[list, list[int], list[int]]:
    """Hashes, words and places of a document's shared lines, with a line of its own wherever others stand between."""
    out, size, place = [], [], []
    for k, x in enumerate(at):
        if k and x != at[k - 1] + 1:
            out.append(object())
            size.append(0)
            place.append(-1)
        out.append(hashes[k])
        size.append(words[k])
        place.append(k)
    return out, size, place


def deletions(docs: DataFrame, key: str = "doc_id", text: str = "text", min_block_words: int = MIN_BLOCK_WORDS) -> DataFrame:
    """ROW, gone: for each document that loses lines, whether each line goes, up to the last that does.  `docs` must hold ROW (see row_key)."""
    lines = docs.where(F.col(key).isNotNull() & F.col(text).isNotNull()).select(F.col(ROW).alias("row"), F.col(key).alias("id"), F.split(text, "\n", -1).alias("s"))
    lines = lines.select("row", "id", F.transform("s", lambda x, i: F.struct(i.alias("pos"), F.unhex(F.md5(x)).alias("h"), F.regexp_count(x, F.lit(WORD)).cast("int").alias("w"))).alias("s"))
    lines = lines.select("row", "id", F.posexplode(F.filter("s", lambda x: x["w"] > 0)).alias("at", "x"))
    lines = saved(lines.select("row", "id", "at", "x.*"), "lines")
    shared = lines.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("lo"), F.max("row").alias("hi")).where("lo <> hi").select("h", "n")
    held = hot_join(lines, saved(shared, "shared"), "h", "n", lines.count()).where("n IS NOT NULL")
    # repeated rows share ROW: one copy of each line
    held = held.groupBy("row").agg(F.min("id").alias("id"), F.array_sort(F.collect_set(F.struct("at", "pos", "h", "w", "n"))).alias("s"))
    of = lambda c: F.transform("s", lambda x: x[c]).alias(c)
    held = saved(held.select("row", "id", *map(of, ["at", "pos", "h", "w", "n"])), "sequences")

    def anchored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, ids, anchors = [], [], []
            for i in range(batch.num_rows):
                row, id_, at, h, w, n = (batch.column(k)[i].as_py() for k in range(6))
                own = set()
                for a, z in runs(at, w, min_block_words):
                    rare = min(range(a, z + 1), key=lambda k: (n[k], h[k]))
                    own.add(h[rare] + hashlib.md5(b"".join(h[a : z + 1]), usedforsecurity=False).digest())
                rows += [row] * len(own)
                ids += [id_] * len(own)
                anchors += own
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary()), pa.array(ids, batch.schema.field(1).type), pa.array(anchors, pa.binary())], names=["row", "id", "a"])

    id_type = held.schema["id"].dataType.simpleString()
    anchors = saved(held.select("row", "id", "at", "h", "w", "n").mapInArrow(anchored, f"row binary, id {id_type}, a binary"), "anchors")
    first = anchors.groupBy("a").agg(F.min(F.struct("id", "row")).alias("o"), F.max(F.struct("id", "row")).alias("z"), F.count(F.lit(1)).alias("n"))
    first = saved(first.where("o.id <> z.id").select("a", F.col("o.id").alias("owner_id"), F.col("o.row").alias("owner"), "n"), "owners")
    pairs = hot_join(anchors, first, "a", "n", anchors.count()).where("owner IS NOT NULL AND id > owner_id")
    pairs = saved(pairs.select("row", "owner").distinct(), "pairs")
    owners = pairs.groupBy("owner").agg(F.count(F.lit(1)).alias("n")).join(shuffled(held.select(F.col("row").alias("owner"), F.col("at").alias("oat"), F.col("h").alias("oh"))), "owner")
    # a document of many owners is dealt over copies, as an owner of many documents is
    laters = pairs.groupBy("row").agg(F.count(F.lit(1)).alias("m")).join(shuffled(held.select("row", "at", "pos", "h", "w")), "row")
    total = pairs.count()
    both = spread_join(spread_join(pairs, owners, "owner", "n", total).select("row", "owner", "oat", "oh"), laters, "row", "m", total)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, gone = [], []
            for i in range(batch.num_rows):
                row, oat, oh, at, pos, h, w = (batch.column(k)[i].as_py() for k in range(7))
                if oh == h and oat == at and sum(w) >= min_block_words and at[-1] - at[0] == len(at) - 1:
                    cut = range(len(at))
                else:
                    b, size, place = _parted(at, h, w)
                    cut = [place[k] for k in common_blocks(_parted(oat, oh, oat)[0], b, size, min_block_words)]
                if cut:
                    rows.append(row)
                    gone.append([{"at": at[k], "pos": pos[k]} for k in cut])
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary()), pa.array(gone, pa.list_(pa.struct([("at", pa.int32()), ("pos", pa.int32())])))], names=[ROW, "gone"])

    cut = both.select("row", "oat", "oh", "at", "pos", "h", "w").mapInArrow(run, f"{ROW} binary, gone array<struct<at:int,pos:int>>")
    cut = cut.groupBy(ROW).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("gone")))).alias("gone"))

    def mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for gone in batch.column(1).to_pylist():
                own = [False] * (gone[-1]["pos"] + 1)
                for k, x in enumerate(gone):
                    own[x["pos"]] = True
                    if k and gone[k - 1]["at"] == x["at"] - 1:  # what stands between holds no words
                        own[gone[k - 1]["pos"] : x["pos"]] = [True] * (x["pos"] - gone[k - 1]["pos"])
                out.append(own)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.bool_()))], names=[ROW, "__quire_gone"])

    return saved(cut.mapInArrow(mask, f"{ROW} binary, __quire_gone array<boolean>"), "gone")


def line_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", min_block_words: int = MIN_BLOCK_WORDS, counts: bool = True) -> DataFrame:
    """The input with the deleted lines taken out of `text`; with counts also n_lines and n_deleted."""
    more = ["n_lines", "n_deleted"] if counts else []
    docs = docs.drop(*more)
    keyed = docs.withColumn(ROW, row_key(key, text))
    out = rejoin(keyed, deletions(keyed, key, text, min_block_words), "left")
    gone, lines = F.col("__quire_gone"), F.split(text, "\n", -1)
    left = F.array_join(F.filter(lines, lambda x, i: ~F.coalesce(F.get(gone, i), F.lit(False))), "\n")
    if counts:
        out = out.withColumns({
            "n_lines": F.when(F.col(text).isNull(), F.lit(0)).otherwise(F.size(lines)).cast("long"),
            "n_deleted": F.when(gone.isNull(), F.lit(0)).otherwise(F.size(F.filter(gone, lambda x: x))).cast("long"),
        })
    out = out.withColumn(text, F.when(gone.isNull(), F.col(text)).otherwise(left))
    return out.select(*docs.columns, *more)
