"""Documents of several tests, packets of statements and solutions, attempts at a page, and blocks within a text."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from quire.functions.guards import runaway
from quire.functions.text import strip
from quire.operators.segment import marked_lines


def _ordered(doc: str, page: str):
    return Window.partitionBy(doc).orderBy(page).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def compendium(pages: DataFrame, switch: Column, title: Column, doc: str = "doc", page: str = "page_no") -> DataFrame:
    """doc, page, test_id: a document of many tests cut up by its headings.  `switch` turns reading on or off from a page on,
    a `title` opens a test there while reading is on, pages that follow belong to it; a title met again gets _2, _3, …"""
    w = _ordered(doc, page)
    on = F.coalesce(F.last(F.col("__switch"), ignorenulls=True).over(w), F.lit(False))
    rows = pages.withColumns({"__switch": switch, "__title": title}).withColumn("__on", on)
    opens = F.col("__on") & F.col("__title").isNotNull()
    rows = rows.withColumns({"__from": F.last(F.when(opens, F.col(page)), ignorenulls=True).over(w), "__base": F.last(F.when(opens, F.col("__title")), ignorenulls=True).over(w)})
    rows = rows.where(F.col("__on") & F.col("__from").isNotNull())
    nth = F.dense_rank().over(Window.partitionBy(doc, "__base").orderBy("__from"))
    return rows.withColumn("__nth", nth).select(doc, page, F.when(F.col("__nth") == 1, F.col("__base")).otherwise(F.concat_ws("_", "__base", F.col("__nth").cast("string"))).alias("test_id"))


def packet(pages: DataFrame, solutions: Column, event: Column, excluded: list[str], doc: str = "doc", page: str = "page_no") -> DataFrame:
    """doc, page, role: once a page opens the solutions all later ones are solutions; pages of excluded events are left out
    until another event opens (`event`: its name on pages that open one)."""
    w = _ordered(doc, page)
    rows = pages.withColumns({"__sol": F.max(F.coalesce(solutions, F.lit(False))).over(w), "__event": F.last(event, ignorenulls=True).over(w)})
    keep = F.coalesce(~F.col("__event").isin(excluded), F.lit(True)) if excluded else F.lit(True)
    return rows.where(keep).select(doc, page, F.when(F.col("__sol"), "solution").otherwise("statement").alias("role"))


def section(text: Column, start: str, stop: str) -> Column:
    """What stands between a heading and the next one, or the end; null without the heading."""
    found = F.regexp_extract(text, rf"(?is){start}(.*?)(?:{stop}|\z)", 1)
    return F.when(text.rlike(rf"(?is){start}"), found)


def bracketed_answers(text: Column) -> Column:
    """Entries `(N) value` of a text: array of STRUCT<number, answer>."""
    numbers, values = (F.regexp_extract_all(text, F.lit(r"\((\d+)\)\s*([^()\s][^()\n]*)"), F.lit(i)) for i in (1, 2))
    return F.zip_with(numbers, values, lambda n, v: F.struct(n.cast("int").alias("number"), F.trim(v).alias("answer")))


def line_answers(lines: DataFrame, keys: list[str], pos: str = "pos", line: str = "line") -> DataFrame:
    """keys, number, answer of terse lines `Solution N. value`; a value on the next line counts; of several the first."""
    label = r"(?i)^\s*Solution\s+(\d+)\s*[.:]\s*(.*?)\s*$"
    rows = lines.withColumns({"__n": F.regexp_extract(line, label, 1), "__v": F.regexp_extract(line, label, 2), "__next": F.lead(line).over(Window.partitionBy(*keys).orderBy(pos))})
    value = F.coalesce(F.nullif("__v", F.lit("")), F.nullif(F.trim("__next"), F.lit("")))
    return rows.where("__n <> ''").withColumn("__value", value).where("__value IS NOT NULL").groupBy(*keys, F.col("__n").cast("int").alias("number")).agg(F.min_by("__value", pos).alias("answer"))


def first_match(names: DataFrame, keywords: list[str], name: str = "name", position: str = "position") -> DataFrame:
    """The first name that holds a keyword, earlier keywords first; else the first of all."""
    rank = F.coalesce(*[F.when(F.contains(F.lower(name), F.lit(k.lower())), F.lit(i)) for i, k in enumerate(keywords)], F.lit(len(keywords)))
    return names.orderBy(rank, position).limit(1)


def crops(paths: DataFrame, path: str = "path") -> DataFrame:
    """path, problem, solution, figure of picture files `P.png`, `P_F.png`, `P_solution_S_F.png`; others are left out."""
    name = F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[^.]*$", "")
    part = lambda i: F.nullif(F.regexp_extract(name, r"^(\d+)(?:_solution_(\d+))?(?:_(\d+))?$", i), F.lit("")).cast("int")
    return paths.withColumns({"problem": part(1), "solution": part(2), "figure": F.coalesce(part(3), F.lit(1))}).where("problem IS NOT NULL")


def page_of(paths: Column) -> Column:
    """The page number at the end of a file's name."""
    return F.nullif(F.regexp_extract(F.regexp_replace(F.element_at(F.split(paths, "/"), -1), r"\.[^.]*$", ""), r"(\d+)$", 1), F.lit("")).cast("int")


def nested_figures(found: DataFrame, keys: list[str]) -> DataFrame:
    """keys, figures: problem → solution → paths in order."""
    lists = found.groupBy(*keys, "problem", F.coalesce("solution", F.lit(1)).alias("solution")).agg(F.transform(F.array_sort(F.collect_list(F.struct("figure", "path"))), lambda x: x["path"]).alias("paths"))
    inner = lists.groupBy(*keys, "problem").agg(F.array_sort(F.collect_list(F.struct("solution", "paths"))).alias("solutions"))
    outer = inner.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("problem", "solutions"))).alias("e"))
    return outer.select(*keys, F.map_from_entries(F.transform("e", lambda x: F.struct(x["problem"], F.map_from_entries(x["solutions"])))).alias("figures"))


def ladder(attempts: DataFrame, valid: Column, page: str = "page") -> DataFrame:
    """page, rung, text, status: of the attempts (page, rung, text) at a page the first that does not run away and is valid
    (`clean`), else the first that does not run away (`invalid`), else the first (`runaway`)."""
    rows = attempts.withColumn("__loop", runaway("text"))
    status = F.when(F.col("__loop"), 2).when(F.coalesce(valid, F.lit(False)), 0).otherwise(1)
    # Two aggregates: who does not ask for the text shuffles none.
    best = rows.withColumn("__s", status).groupBy(page).agg(F.min(F.struct("__s", "rung")).alias("x"), F.min_by("text", F.struct("__s", "rung", "text")).alias("text"))
    return best.select(page, "x.rung", "text", F.element_at(F.array(*map(F.lit, ["clean", "invalid", "runaway"])), F.col("x.__s") + 1).alias("status"))


def suppressed(pages: DataFrame, raw: str, cleaned: str) -> DataFrame:
    """Pages that had text of which cleaning left nothing are dropped."""
    has = lambda c: F.length(strip(F.coalesce(c, F.lit("")))) > 0
    return pages.where(~(has(F.col(raw)) & ~has(F.col(cleaned))))


def verdicts(found: DataFrame, expected: DataFrame, key: str, number: str = "problem") -> DataFrame:
    """key, n, missing, verdict: `empty`, `lone` (one marker alone is no page of problems), `incomplete` or `ok`."""
    have = found.groupBy(key).agg(F.collect_set(number).alias("__have"))
    want = expected.groupBy(key).agg(F.collect_set(number).alias("__want"))
    both = want.join(have, key, "full").select(key, F.size(F.coalesce("__have", F.array())).alias("n"), F.array_sort(F.array_except(F.coalesce("__want", F.array().cast("array<int>")), F.coalesce("__have", F.array().cast("array<int>")))).alias("missing"))
    return both.withColumn("verdict", F.when(F.col("n") == 0, "empty").when(F.size("missing") > 0, "incomplete").when(F.col("n") == 1, "lone").otherwise("ok"))


def marker_blocks(docs: DataFrame, key: str, text: str, rules: str = "default") -> DataFrame:
    """key, number, block: a text cut before every marker; documents without one or with a number twice give nothing."""
    lines = marked_lines(docs.where(F.col(text).isNotNull()), key, text, rules)
    w = Window.partitionBy(key).orderBy("pos")
    at = lines.withColumn("__i", F.count("number").over(w)).where("__i > 0")
    parts = F.array_sort(F.collect_list(F.struct("pos", "line")))
    blocks = at.groupBy(key, "__i").agg(F.max("number").alias("number"), F.array_join(F.transform(parts, lambda x: x["line"]), "\n").alias("block"))
    every = Window.partitionBy(key)
    return blocks.withColumns({"__n": F.count(F.lit(1)).over(every), "__d": F.size(F.collect_set("number").over(every))}).where("__n = __d").select(key, "number", "block")


def labelled_markers(lines: DataFrame, label: str, own_line: bool = False, key: str = "doc_id") -> DataFrame:
    """Marker lines (of marked_lines) that count: where any line of a document is labelled, a marker needs a label between
    itself and the next marker (its own line counts with `own_line`)."""
    w = Window.partitionBy(key).orderBy("pos")
    said = F.col("line").rlike(label)
    span = lines.withColumns({"__i": F.count("number").over(w), "__said": said})
    inner = F.col("__said") & (F.col("number").isNull() | F.lit(own_line))
    span = span.withColumns({"__has": F.max(inner).over(Window.partitionBy(key, "__i")), "__any": F.max("__said").over(Window.partitionBy(key))})
    return span.where(F.col("number").isNotNull() & (~F.col("__any") | F.col("__has"))).select(key, "pos", "number")


def without_lists(lines: DataFrame, longest: int = 60, least: int = 3, key: str = "doc_id") -> DataFrame:
    """key, pos, line: runs of at least `least` markers 1, 2, 3, … on adjoining short lines are a list within a statement;
    they join the line before them."""
    w = Window.partitionBy(key).orderBy("pos")
    short = F.col("number").isNotNull() & (F.length("line") <= longest)
    run = F.when(short, F.struct((F.col("pos") - F.col("number")).alias("shift"), (F.sum(F.when(short, 0).otherwise(1)).over(w)).alias("gap")))
    rows = lines.withColumn("__run", run)
    group = Window.partitionBy(key, "__run")
    listed = F.col("__run").isNotNull() & (F.count(F.lit(1)).over(group) >= least) & (F.min("number").over(group) == 1) & (F.min("pos").over(group) > 0)
    rows = rows.withColumn("__listed", listed)
    rows = rows.withColumn("__to", F.sum(F.when(F.col("__listed"), 0).otherwise(1)).over(w))
    parts = F.array_sort(F.collect_list(F.struct("pos", "line")))
    return rows.groupBy(key, "__to").agg(F.min("pos").alias("pos"), F.array_join(F.transform(parts, lambda x: x["line"]), " ").alias("line")).select(key, "pos", "line")


def routed_preambles(elements: DataFrame, heading: str, doc: str = "doc", problem: str = "problem", pos: str = "pos", text: str = "text") -> DataFrame:
    """doc, problem, pos, text: what follows a section heading belongs to the next problem, and headings go.  Each problem
    gives up what follows one heading, also of what was moved to it; beyond the last problem `problem` is null.

    With problems ranked and headings numbered, heading j is met at problem t(j) = max(rank(j), t(j - 1) + 1), which is
    j + max over i up to j of rank(i) - i: a running maximum."""
    w = Window.partitionBy(doc).orderBy("__rank", pos)
    rows = elements.withColumns({"__rank": F.dense_rank().over(Window.partitionBy(doc).orderBy(problem)), "__head": F.col(text).rlike(heading)})
    rows = rows.withColumn("__j", F.sum(F.col("__head").cast("int")).over(w))
    met = F.max(F.when(F.col("__head"), F.col("__rank") - F.col("__j"))).over(w) + F.col("__j")
    rows = rows.withColumn("__to", F.greatest(F.col("__rank"), F.coalesce(met + 1, F.lit(0)))).where("NOT __head")
    ranks = elements.select(doc, problem).distinct().withColumn("__to", F.row_number().over(Window.partitionBy(doc).orderBy(problem)))
    out = rows.drop(problem).join(ranks, [doc, "__to"], "left")
    at = F.row_number().over(Window.partitionBy(doc, "__to").orderBy("__rank", pos))
    return out.withColumn("__at", at).select(doc, problem, F.col("__at").alias(pos), text)


# Ordinals of solutions.
ORDINALS = ["first", "second", "third", "fourth", "fifth", "sixth"]


def solution_index(text: Column) -> Column:
    """Number of the last heading of a solution in a text: `Solution 2`, `Second Solution`."""
    pattern = r"(?im)^[ \t*_#]*(?:(?:Alternate\s+)?Solution\s+(?:\d+)|(?:" + "|".join(ORDINALS) + r")\s+Solution)\b"
    last = F.lower(F.try_element_at(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.lit(-1)))
    word = F.array_position(F.lit(ORDINALS), F.regexp_extract(last, "(" + "|".join(ORDINALS) + ")", 1)).cast("int")
    return F.coalesce(F.nullif(F.regexp_extract(last, r"(\d+)", 1), F.lit("")).cast("int"), F.nullif(word, F.lit(0)))


def solution_blocks(blocks: DataFrame, keys: list[str], text: str, header: str, secondary: str | None = None, keep_headers: bool = False) -> DataFrame:
    """keys, part, text: a block cut at headers, of which only what follows in their line is kept.  What precedes the first
    one stays with the first part, unless that header is a secondary one, which closes it."""
    lines = blocks.select(*keys, F.posexplode(F.split(text, "\n", -1)).alias("pos", "line"))
    w, every = Window.partitionBy(*keys).orderBy("pos"), Window.partitionBy(*keys)
    second = F.col("line").rlike(secondary) if secondary else F.lit(False)
    at = lines.withColumns({"__first": F.col("line").rlike(header), "__second": second}).withColumn("__head", F.col("__first") | F.col("__second"))
    closes = F.min(F.when(F.col("__head"), F.struct("pos", "__second"))).over(every)["__second"]
    at = at.withColumns({"__n": F.sum(F.col("__head").cast("int")).over(w), "__closes": F.coalesce(closes, F.lit(False))})
    at = at.withColumn("part", F.when(F.col("__closes"), F.col("__n") + 1).otherwise(F.greatest("__n", F.lit(1))))
    parts = F.array_sort(F.collect_list(F.struct("pos", "line")))
    rest = F.col("line")
    for p in [header, *([secondary] if secondary else [])]:
        rest = F.regexp_replace(rest, rf"(?:{p})[ \t*_]*[.:]?[ \t*_]*", "")
    at = at if keep_headers else at.withColumn("line", F.when(F.col("__head"), rest).otherwise(F.col("line"))).where(~F.col("__head") | (F.col("line") != ""))
    whole = at.groupBy(*keys, "part").agg(F.trim(F.array_join(F.transform(parts, lambda x: x["line"]), "\n")).alias(text)).where(F.length(strip(F.col(text))) > 0)
    return whole.withColumn("part", F.row_number().over(Window.partitionBy(*keys).orderBy("part")))


def key_blocks(lines: DataFrame, keys: list[str], furniture: str) -> DataFrame:
    """keys, number, text of an answer key: lines belong to the last marker before them; furniture closes an entry."""
    w = Window.partitionBy(*keys).orderBy("pos")
    bar = F.col("line").rlike(furniture)
    rows = lines.withColumn("__open", F.last(F.when(bar, F.lit(-1)).otherwise(F.col("number")), ignorenulls=True).over(w)).where(~bar & (F.col("__open") >= 0))
    body = F.when(F.col("number").isNotNull(), F.expr("substring(line, end + 1)")).otherwise(F.col("line"))
    parts = F.array_sort(F.collect_list(F.struct("pos", F.trim(body).alias("t"))))
    return rows.groupBy(*keys, F.col("__open").alias("number")).agg(F.trim(F.array_join(F.filter(F.transform(parts, lambda x: x["t"]), lambda t: t != ""), "\n")).alias("text"))


# Fixed value: heading of a key of answers.
KEY_HEADING = re.compile(r"(?im)^[ \t*_#]*Answers?(?:\s+Key)?[ \t*_#:]*$")
KEY = StructType([StructField("answers", ArrayType(StructType([StructField("number", IntegerType()), StructField("answer", StringType())]))), StructField("rest", StringType())])
_entry = re.compile(r"^\s*(\d{1,2})\s*[.)]\s*(\S.{0,23})\s*$")


def split_key(text: str) -> tuple[list[tuple[int, str]], str]:
    """(entries, rest): a key of answers behind its heading, as a run of short numbered lines, and the text without it."""
    m = KEY_HEADING.search(text)
    if not m:
        return [], text
    found, kept, inside = [], [], True
    for line in text[m.end() :].split("\n"):
        entry = _entry.match(line) if inside else None
        if entry:
            found.append((int(entry[1]), entry[2].strip()))
        elif inside and not line.strip():
            continue
        else:
            inside = False
            kept.append(line)
    return (found, "\n".join([text[: m.start()].rstrip("\n"), *kept]).strip("\n")) if found else ([], text)


@F.pandas_udf(KEY)
def answer_key(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    """STRUCT<answers, rest> of split_key."""
    for batch in texts:
        got = [split_key(x or "") for x in batch]
        yield pd.DataFrame({"answers": [[{"number": n, "answer": a} for n, a in found] for found, _ in got], "rest": [rest for _, rest in got]})


def merged_blocks(whole: str, sliced: str) -> str:
    """A page with the problems that only a reading in slices found: each run of missing numbers takes the place of what
    stands between its neighbours, from the end to the start; unchanged unless the slices hold all of the page's numbers
    and more, none of them twice."""
    mark = re.compile(r"(?m)^[ \t*_#]*(\d{1,3})[.)]\s")
    cut = lambda x: [(int(m[1]), m.start()) for m in mark.finditer(x)]
    a, b = cut(whole), cut(sliced)
    have, all_ = [n for n, _ in a], [n for n, _ in b]
    if len(set(have)) != len(have) or len(set(all_)) != len(all_) or not set(have) < set(all_):
        return whole
    span = {n: sliced[s : (b[i + 1][1] if i + 1 < len(b) else len(sliced))].rstrip() for i, (n, s) in enumerate(b)}
    out, held = [whole[: a[0][1]].rstrip()] if a else [], {n: whole[s : (a[i + 1][1] if i + 1 < len(a) else len(whole))].rstrip() for i, (n, s) in enumerate(a)}
    for i, n in enumerate(all_):
        # A block before a gap may have swallowed what is missing, so the slice's own takes its place too.
        gap = i + 1 < len(all_) and all_[i + 1] not in held
        out.append(span[n] if n not in held or gap else held[n])
    return "\n".join(x for x in out if x)


@F.pandas_udf(StringType())
def repaired_page(whole: pd.Series, sliced: pd.Series) -> pd.Series:
    return pd.Series([merged_blocks(a or "", b or "") if b else a for a, b in zip(whole, sliced)])


def recovered_statements(problems: DataFrame, reset: str, doc: str = "doc", problem: str = "problem", pos: str = "pos", text: str = "text") -> DataFrame:
    """doc, problem, pos, text: where a `reset` line (the first solution's heading) stands a second time within a problem and
    the next number is missing, what follows from there on is that next problem."""
    w = Window.partitionBy(doc, problem).orderBy(pos)
    rows = problems.withColumn("__r", F.col(text).rlike(reset))
    rows = rows.withColumn("__n", F.sum(F.col("__r").cast("int")).over(w))
    have = problems.select(doc, (F.col(problem) - 1).alias(problem)).distinct().withColumn("__next", F.lit(True))
    rows = rows.join(have, [doc, problem], "left")
    return rows.select(doc, (F.col(problem) + F.when((F.col("__n") >= 2) & F.col("__next").isNull(), 1).otherwise(0)).alias(problem), pos, text)


def unlisted(found: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose problem stands in the statements; a document without statements keeps all."""
    docs = [k for k in keys if k != "problem"]
    has = known.select(*docs).distinct().withColumn("__has", F.lit(True))
    ok = known.select(*keys).distinct().withColumn("__ok", F.lit(True))
    return found.join(has, docs, "left").join(ok, keys, "left").where(F.col("__has").isNull() | F.col("__ok")).drop("__has", "__ok")


def first_pages(pages: DataFrame, key: str, page: str, content: str) -> DataFrame:
    """Of pages with the same bytes in a document the first one stays."""
    same = Window.partitionBy(key, F.sha2(content, 256)).orderBy(page)
    return pages.withColumn("__nth", F.row_number().over(same)).where("__nth = 1").drop("__nth")


def renumbered(lines: DataFrame, offset: Column, key: str = "doc_id") -> DataFrame:
    """key, pos, line: leading numbers of marker lines raised by an offset."""
    m = r"^(\s*)(\d+)(\s*[.)])"
    new = F.concat(F.regexp_extract("line", m, 1), (F.regexp_extract("line", m, 2).cast("int") + offset).cast("string"), F.regexp_extract("line", m, 3), F.regexp_replace("line", m, ""))
    return lines.select(key, "pos", F.when(F.col("line").rlike(m), new).otherwise(F.col("line")).alias("line"))


def tiers(answers: DataFrame, keys: list[str]) -> DataFrame:
    """keys, answer, tier: of answers by tier (1 first) the first that is not blank; of one tier the first by `pos`."""
    best = answers.where(F.length(F.trim("answer")) > 0).groupBy(*keys).agg(F.min_by(F.struct("answer", "tier"), F.struct("tier", "pos")).alias("x"))
    return best.select(*keys, "x.answer", "x.tier")


def existing(tests: DataFrame, done: DataFrame, key: str = "test_id") -> DataFrame:
    """Tests that have output already."""
    return tests.join(done.select(key).distinct(), key, "left_semi")


def round_text(lines: DataFrame, header: str, wanted: Column, keys: list[str]) -> DataFrame:
    """keys, text: the sections of a document whose header line fits `wanted` (over `header_line`); a document without
    headers stays whole, one none of whose headers fits becomes empty."""
    w = Window.partitionBy(*keys).orderBy("pos")
    rows = lines.withColumn("header_line", F.last(F.when(F.col("line").rlike(header), F.col("line")), ignorenulls=True).over(w))
    rows = rows.withColumn("__any", F.max(F.col("header_line").isNotNull()).over(Window.partitionBy(*keys)))
    kept = F.when(~F.col("__any") | F.coalesce(wanted, F.lit(False)), F.struct("pos", "line"))
    parts = F.array_sort(F.collect_list(kept))
    return rows.groupBy(*keys).agg(F.array_join(F.transform(parts, lambda x: x["line"]), "\n").alias("text"))


# What tells of a document's type.
TYPES = {
    "answer_key": r"(?im)^[ \t*_#]*answer\s+key\b",
    "integral_answers": r"(?im)^[ \t*_#]*Integral\s+\d+\s+Answer",
    "solutions": r"(?i)\bsolutions?\s+packet\b|proposed by",
}


def document_type(text: Column) -> Column:
    """The first type whose sign a text shows, else `statements`."""
    return F.coalesce(*[F.when(text.rlike(p), F.lit(n)) for n, p in TYPES.items()], F.lit("statements"))


def looked_up(rows: DataFrame, statements: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """With `statement`: the statement of the same number, empty without one."""
    side = statements.groupBy(*keys).agg(F.min(text).alias("statement"))
    return rows.join(side, keys, "left").withColumn("statement", F.coalesce("statement", F.lit("")))


def with_figures(statements: DataFrame, refs: DataFrame, keys: list[str]) -> DataFrame:
    """Statements with the references (keys, figure, ref) of their problem in the places of their placeholders."""
    from quire.functions.text import place_refs

    lists = refs.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("figure", "ref"))), lambda x: x["ref"]).alias("refs"))
    none = F.array().cast("array<string>")
    return statements.join(lists, keys, "left").withColumn("text", place_refs(F.col("text"), F.coalesce("refs", none))).drop("refs")


# Bases of the numbers of clues.
CLUES = {"across": 1000, "down": 2000}


def clue_numbers(lines: DataFrame, keys: list[str]) -> DataFrame:
    """keys, pos, line, code: clues under headings of their direction, as the direction's base plus their number; a line of a
    heading has none."""
    w = Window.partitionBy(*keys).orderBy("pos")
    head = F.lower(F.regexp_extract("line", r"(?i)^[ \t*_#]*(Across|Down)[ \t*_:]*$", 1))
    rows = lines.withColumn("__dir", F.last(F.nullif(head, F.lit("")), ignorenulls=True).over(w)).withColumn("__head", head != "")
    number = F.nullif(F.regexp_extract("line", r"^\s*(\d{1,2})\s*[.)]?\s", 1), F.lit("")).cast("int")
    base = F.coalesce(*[F.when(F.col("__dir") == d, F.lit(b)) for d, b in CLUES.items()])
    return rows.select(*keys, "pos", "line", F.when(~F.col("__head"), base + number).alias("code"))


def anchors(boxes: DataFrame, pages: DataFrame, number: Column, end: Column, margin: float = 0.12, inline: int = 12) -> DataFrame:
    """page, det, problem, y, inline: boxes that open problems: text with a marker (`number`, `end`), or nothing but digits in a
    narrow box at the left margin.  A marker is inline if text enough follows it; of all only rising numbers stay."""
    rows = boxes.join(pages.select("page", F.col("width").alias("__w")), "page").withColumns({"__n": number, "__rest": F.length(F.rtrim("text")) - end})
    digits = F.regexp_extract("text", r"^\s*(\d{1,3})\s*[.)]?\s*$", 1)
    alone = (digits != "") & (F.col("x1") <= margin * F.col("__w"))
    rows = rows.withColumn("problem", F.coalesce("__n", F.when(alone, digits.cast("int")))).where("problem IS NOT NULL")
    before = F.max("problem").over(Window.partitionBy("page").orderBy("y0", "det").rowsBetween(Window.unboundedPreceding, -1))
    return rows.withColumn("__top", before).where(F.col("__top").isNull() | (F.col("problem") > F.col("__top"))).select("page", "det", "problem", F.col("y0").alias("y"), F.coalesce(F.col("__rest") >= inline, F.lit(False)).alias("inline"))


def key_answers(blocks: DataFrame, keys: list[str], least: int = 5, digits: int = 3) -> DataFrame:
    """keys, number, answer: keys of answers in tables (number and value in neighbouring cells) or lists, where at least `least` entries stand.
    Numbers have up to `digits` digits (9 at most): on a page a longer one is a year or a value, in a long key it is an entry's."""
    number = rf"(\d{{1,{digits}}})"
    cells, values = (F.regexp_extract_all("text", F.lit(rf"(?is)<t[dh][^>]*>\s*{number}\s*[.)]?\s*</t[dh]>\s*<t[dh][^>]*>([^<]*)</t[dh]>"), F.lit(i)) for i in (1, 2))
    numbers, said = (F.regexp_extract_all("text", F.lit(rf"(?m)^\s*{number}\s*[.)]\s+(\S.{{0,40}}?)\s*$"), F.lit(i)) for i in (1, 2))
    pairs = lambda a, b: F.zip_with(a, b, lambda n, v: F.struct(n.cast("int").alias("number"), F.trim(v).alias("answer")))
    entries = F.when(F.size(cells) >= least, pairs(cells, values)).when(F.size(numbers) >= least, pairs(numbers, said))
    return blocks.select(*keys, F.explode(entries).alias("x")).select(*keys, "x.*").where("answer <> '' AND upper(answer) <> 'N/A'")


# Labels of a relay (pair and leg), pairs of its first set, problems of a set.
RELAY = r"(?m)^[ \t]*[*_#]{0,3}[ \t]*(\d{1,2})-([12])[ \t]*[.]"
RELAY_PAIRS, RELAY_SET = 5, 10


def relay_number(pair: Column, leg: Column) -> Column:
    """Number of a leg: the sets of pairs swap their places between the legs."""
    return pair + F.when((pair <= RELAY_PAIRS) == (leg == 1), 0).otherwise(RELAY_SET)


def relay_blocks(docs: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """keys, problem, text of documents whose pairs and legs run through each other: the blocks behind the labels of one
    problem in their order, joined by newlines.  What stands before the first label belongs to none; null texts have none."""
    whole, pairs, legs = F.col(text), *(F.regexp_extract_all(text, F.lit(RELAY), F.lit(i)) for i in (1, 2))
    bodies = F.slice(F.split(whole, RELAY, -1), F.lit(2), F.size(pairs))
    rows = docs.where(whole.isNotNull()).select(*keys, F.posexplode(F.arrays_zip(pairs.alias("pair"), legs.alias("leg"), bodies.alias("body"))).alias("pos", "x"))
    rows = rows.withColumn("problem", relay_number(F.col("x.pair").cast("int"), F.col("x.leg").cast("int")))
    held = F.array_sort(F.collect_list(F.struct("pos", F.regexp_replace("x.body", r"^\s+|\s+$", "").alias("t"))))
    return rows.groupBy(*keys, "problem").agg(strip(F.array_join(F.transform(held, lambda x: x["t"]), "\n")).alias("text"))


# How paragraphs on the origin of a problem begin.
PROVENANCE = ["This problem", "The problem", "Comment", "We thank"]


def headerless_solution(block: Column) -> Column:
    """A solution without a header: of several paragraphs the first is the statement and goes, and so do those behind it
    that tell where the problem comes from; the rest stays.  One paragraph alone is the solution."""
    parts = F.filter(F.transform(F.split(block, r"\n(?:[ \t]*\n)+", -1), lambda x: F.regexp_replace(x, r"^\n+|\n+$", "")), lambda x: F.trim(x) != "")
    told = r"(?i)^\s*(?:" + "|".join(PROVENANCE) + r")\b"
    rest = F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0)))
    # first paragraph of the rest that is no provenance
    from_here = F.array_position(F.transform(rest, lambda x: ~x.rlike(told)), True)
    kept = F.when(from_here > 0, F.array_join(F.slice(rest, F.greatest(from_here, F.lit(1)).cast("int"), F.greatest(F.size(rest), F.lit(1))), "\n\n")).otherwise("")
    return F.when(F.size(parts) > 1, strip(kept)).otherwise(strip(block))
