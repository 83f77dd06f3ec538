"""Ordered-row operators: marker filters, segmentation folds, islands, as-of joins, boxes."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rising(df: DataFrame, by: list[str], order: list[str], number: str) -> DataFrame:
    """kept: the number is over every earlier one (a rejected number never exceeds the running maximum)."""
    before = F.max(number).over(Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    return df.withColumn("kept", before.isNull() | (F.col(number) > before))


State = Callable[[], Callable[..., object]]


def scan(df: DataFrame, by: list[str], order: str, columns: list[Column], start: State, result: str, kind: str) -> DataFrame:
    """by, order, result: each group's rows in order go through one function, made anew by `start` for every group.

    Groups are dealt by key and sorted, and the state is carried from row to row, so a long group takes time in
    proportion and no more memory than a batch.  (A null result is kept.)"""
    names = [f"__c{i}" for i in range(len(columns))]
    rows = df.select(*by, F.col(order).cast("long").alias(order), *[c.alias(n) for c, n in zip(columns, names)])
    rows = rows.repartition(*by).sortWithinPartitions(*by, order, *names)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[: len(by) + 1]) + f", `{result}` {kind}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, step = None, None
        for batch in batches:
            keys = list(zip(*[batch.column(i).to_pylist() for i in range(len(by))]))
            found = []
            for key, values in zip(keys, zip(*[c.to_pylist() for c in batch.columns[len(by) + 1 :]])):
                if step is None or key != group:
                    group, step = key, start()
                found.append(step(*values))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(by) + 1], pa.array(found, pa.int64())], names=[*by, order, result])

    return rows.mapInArrow(run, schema)


def consecutive(df: DataFrame, by: list[str], order: str, number: str) -> DataFrame:
    """by, order, kept: 1 for numbers that follow the last kept one directly (the first is always kept)."""

    def start() -> Callable[[int], int]:
        last: int | None = None

        def step(n: int) -> int:
            nonlocal last
            good = last is None or n == last + 1
            last = n if good else last
            return int(good)

        return step

    return scan(df.where(F.col(number).isNotNull()), by, order, [F.col(number).cast("long")], start, "kept", "bigint")


def restarting(df: DataFrame, by: list[str], order: str, number: str) -> DataFrame:
    """by, order, problem: numbers that restart at 1 continue the count of the section before; other falls are rejected (null)."""
    return numbered(df.where(F.col(number).isNotNull()).withColumn("__never", F.lit(False)), by, order, number, "__never")


@dataclass(frozen=True)
class Numbering:
    """Which markers count, by the options of a series' layout.

    flat: no sections.  strict: only a heading begins a section.  consecutive: within a section a number must be the
    next one.  backward: a smaller number returns to that problem.  point_values: once a marker with a point value has
    counted, others without one do not.  page_restart: the first marker of a page that carries a problem on begins a
    section if it is 1 with a point value and nothing stands before it."""

    flat: bool = False
    strict: bool = False
    consecutive: bool = False
    backward: bool = False
    point_values: bool = False
    page_restart: bool = False


class Counter:
    """Numbers problems from a stream of markers and headings; `first` is the problem that is open at the start."""

    def __init__(self, rules: Numbering, first: int | None = None) -> None:
        self.rules, self.first = rules, first
        self.open = self.last = first  # running number and printed number of the open problem
        self.top, self.shift = first or 0, 0
        self.heading = self.pointed = self.met = False

    def accept(self, n: int, points: bool = False, fresh: bool = False) -> bool:
        """Whether marker n opens a problem; `fresh` says that nothing stands before it on its page."""
        rules = self.rules
        if rules.point_values and self.pointed and not points:
            return False
        initial, self.met = not self.met, True
        if self.last is None or n > self.last:
            if rules.consecutive and self.last is not None and n - self.last != 1:
                return False
            self.top, self.open = max(self.top, n), n + self.shift
        elif rules.backward and n < self.last:
            self.open = n
        elif not rules.flat and (self.heading or self._begins(n, points, fresh and initial)):
            self.shift, self.top = self.shift + self.top, n
            self.open = n + self.shift
        else:
            return False
        self.last, self.heading, self.pointed = n, False, self.pointed or points
        return True

    def _begins(self, n: int, points: bool, fresh: bool) -> bool:
        if not self.rules.strict and (n == 1 or (self.first is not None and n < self.first)):
            return True
        return self.rules.page_restart and self.first is not None and fresh and n == 1 and points


def numbered(df: DataFrame, by: list[str], order: str, number: str, heading: str, first: int | None = None, points: Column | None = None, **rules: bool) -> DataFrame:
    """by, order, problem: running problem numbers for markers amid section headings, by the rules of Numbering; null
    where a marker does not count.  Rows with a null number are headings only; a null heading is none; `points` says
    whether a marker has a point value."""
    options = Numbering(**rules)

    def start() -> Callable[[int | None, bool, bool], int | None]:
        counter = Counter(options, first)

        def step(n: int | None, head: bool, pointed: bool) -> int | None:
            counter.heading = counter.heading or head
            return counter.open if n is not None and counter.accept(n, pointed) else None

        return step

    flag = lambda x: F.coalesce(x, F.lit(False))
    return scan(df, by, order, [F.col(number).cast("long"), flag(F.col(heading)), flag(points if points is not None else F.lit(False))], start, "problem", "bigint")


def islands(df: DataFrame, by: list[str], start: str, end: str, gap: float, running: bool, name: str = "island") -> DataFrame:
    """Number of the run a row belongs to; a gap of at least `gap` after the last end (or the running maximum) begins a new one."""
    w = Window.partitionBy(*by).orderBy(start, end)
    before = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1)) if running else F.lag(end).over(w)
    fresh = F.when(F.col(start) - before >= gap, 1).otherwise(0)
    return df.withColumn("__fresh", fresh).withColumn(name, F.sum("__fresh").over(w) + 1).drop("__fresh")


def as_of(rows: DataFrame, marks: DataFrame, by: list[str], at: list[str], value: str) -> DataFrame:
    """Each row with the value of the last mark at or before it (one pass: union and last non-null; no range join)."""
    fields = [f"`{f.name}`" for f in rows.schema.fields]
    both = rows.select(*fields, F.lit(1).alias("__side"), F.lit(None).cast(marks.schema[value].dataType).alias("__value"))
    marked = marks.select(*[F.col(f.name) if f.name in [*by, *at] else F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema.fields], F.lit(0).alias("__side"), F.col(value).alias("__value"))
    w = Window.partitionBy(*by).orderBy(*at, "__side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return both.unionByName(marked).withColumn("owner", F.last("__value", ignorenulls=True).over(w)).where("__side = 1").select(*fields, "owner")


def area(p: str = "") -> Column:
    return F.greatest(F.lit(0.0), F.col(f"{p}x1") - F.col(f"{p}x0")) * F.greatest(F.lit(0.0), F.col(f"{p}y1") - F.col(f"{p}y0"))


def overlap(p: str, q: str) -> Column:
    side = lambda a: F.greatest(F.lit(0.0), F.least(F.col(f"{p}{a}1"), F.col(f"{q}{a}1")) - F.greatest(F.col(f"{p}{a}0"), F.col(f"{q}{a}0")))
    return side("x") * side("y")


def without_nested(boxes: DataFrame, page: str, box: str, least: float = 0.9) -> DataFrame:
    """Boxes not lying (to `least` of their area) in a strictly larger box of their page."""
    outer = boxes.select(F.col(page).alias("__page"), *[F.col(c).alias(f"o_{c}") for c in ("x0", "y0", "x1", "y1")])
    inside = (F.col(page) == F.col("__page")) & (area("o_") > area()) & (area() > 0) & (overlap("", "o_") >= least * area())
    return boxes.join(outer, inside, "left_anti")


def union_area(boxes: DataFrame, by: list[str]) -> DataFrame:
    """Exact area that the boxes of each group cover together, by coordinate compression inside the group."""
    xs = F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.array("x0", "x1")))))
    rects = boxes.groupBy(*by).agg(xs.alias("xs"), F.array_sort(F.collect_list(F.struct("y0", "y1", "x0", "x1"))).alias("r"))
    strips = rects.select(*by, "r", F.explode(F.expr("transform(sequence(1, size(xs) - 1), i -> struct(element_at(xs, i) AS a, element_at(xs, i + 1) AS b))")).alias("s"))
    held = strips.select(*by, (F.col("s.b") - F.col("s.a")).alias("w"), F.expr("filter(r, q -> q.x0 <= s.a AND q.x1 >= s.b)").alias("r"))
    covered = F.expr("aggregate(r, struct(CAST(0 AS DOUBLE) AS sum, CAST('-Infinity' AS DOUBLE) AS top), (a, q) -> struct(a.sum + greatest(0D, q.y1 - greatest(q.y0, a.top)) AS sum, greatest(a.top, q.y1) AS top)).sum")
    return held.select(*by, (F.col("w") * covered).alias("part")).groupBy(*by).agg(F.sum("part").alias("area"))


def joined(rows: DataFrame, keys: list[str], order: str, line: str, name: str, between: str = "\n") -> DataFrame:
    """keys, name: the lines of each group in order as one text."""
    parts = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(line).alias("t"))))
    return rows.groupBy(*keys).agg(F.array_join(F.transform(parts, lambda x: x["t"]), between).alias(name))


def offsets(rows: DataFrame, by: list[str], order: str, size: Column, name: str = "start") -> DataFrame:
    """With `name`: the sizes of all rows of the group before this one, added up."""
    before = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("__size", size).withColumn(name, F.coalesce(F.sum("__size").over(before), F.lit(0))).drop("__size")


def spans(rows: DataFrame, by: list[str], order: str, start: str, total: str) -> DataFrame:
    """With `size`: from a mark to the next one of its group, the last to the total."""
    return rows.withColumn("size", F.coalesce(F.lead(start).over(Window.partitionBy(*by).orderBy(order)), F.col(total)) - F.col(start))


def gap_groups(rows: DataFrame, by: list[str], order: list[str], start: str, end: str, gap: float) -> DataFrame:
    """With `group`: a row that begins `gap` or more behind the end of the one before opens the next group."""
    w = Window.partitionBy(*by).orderBy(*order)
    fresh = F.when(F.col(start) - F.lag(end).over(w) >= gap, 1).otherwise(0)
    return rows.withColumn("__fresh", fresh).withColumn("group", F.sum("__fresh").over(w) + 1).drop("__fresh")


def paired(left: DataFrame, right: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """The i-th row of one side with the i-th of the other, in groups where both have as many."""
    w = Window.partitionBy(*by)
    numbered = [x.withColumns({"__i": F.row_number().over(w.orderBy(*order)), "__n": F.count(F.lit(1)).over(w)}).drop(*order) if i else x.withColumns({"__i": F.row_number().over(w.orderBy(*order)), "__n": F.count(F.lit(1)).over(w)}) for i, x in enumerate((left, right))]
    return numbered[0].join(numbered[1], [*by, "__i", "__n"]).drop("__i", "__n")


def is_rising(rows: DataFrame, by: list[str], order: str, value: str) -> DataFrame:
    """by, rising: whether every value is over the one before."""
    ok = F.coalesce(F.col(value) > F.lag(value).over(Window.partitionBy(*by).orderBy(order)), F.lit(True))
    return rows.withColumn("__ok", ok).groupBy(*by).agg(F.bool_and("__ok").alias("rising"))


def dense_numbers(rows: DataFrame, universe: DataFrame, by: list[str], code: str) -> DataFrame:
    """With `number`: sparse codes as 1, 2, 3, … in the order of all codes of the universe, whether rows have them or not."""
    codes = universe.select(*by, code).distinct()
    return rows.join(codes.withColumn("number", F.row_number().over(Window.partitionBy(*by).orderBy(code))), [*by, code])


def top_share_median(rows: DataFrame, by: list[str], value: str, key: str, parts: int = 5) -> DataFrame:
    """by, top_median, n: the median of the largest 1/parts of a group's values."""
    top = rows.withColumn("__q", F.ntile(parts).over(Window.partitionBy(*by).orderBy(F.desc(value), key))).where("__q = 1")
    return top.groupBy(*by).agg(F.percentile(value, F.lit(0.5)).alias("top_median"), F.count(F.lit(1)).alias("n"))


def nothing_above_later(rows: DataFrame, by: list[str], order: str, value: str, counts: Column) -> DataFrame:
    """With `last_of_all`: no later row of the group that counts has a larger value."""
    later = F.max(F.when(counts, F.col(value))).over(Window.partitionBy(*by).orderBy(order).rowsBetween(1, Window.unboundedFollowing))
    return rows.withColumn("last_of_all", F.coalesce(later <= F.col(value), F.lit(True)))


def runs(rows: DataFrame, by: list[str], order: str, flag: str, least: int = 2) -> DataFrame:
    """With `in_run`: whether a flagged row stands in a run of at least `least` flagged ones."""
    w = Window.partitionBy(*by).orderBy(order)
    part = rows.withColumn("__part", F.sum(F.when(F.col(flag), 0).otherwise(1)).over(w))
    size = F.sum(F.col(flag).cast("int")).over(Window.partitionBy(*by, "__part"))
    return part.withColumn("in_run", F.col(flag) & (size >= least)).drop("__part")


def same_sets(left: DataFrame, right: DataFrame, by: list[str], value: str) -> DataFrame:
    """by, added, gone, same: values of one side only, and whether both hold the same ones."""
    collect = lambda x, name: x.groupBy(*by).agg(F.array_sort(F.collect_set(value)).alias(name))
    both = collect(left, "a").join(collect(right, "b"), by, "full")
    none = F.array().cast(f"array<{left.schema[value].dataType.simpleString()}>")
    a, b = F.coalesce("a", none), F.coalesce("b", none)
    return both.select(*by, F.array_except(b, a).alias("added"), F.array_except(a, b).alias("gone"), (a == b).alias("same"))
