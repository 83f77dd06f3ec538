"""Text expressions: normalisation, shingles, furniture, markers, answers.  Columns in, columns out."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

FIGURE = "￼"
# Layout commands that carry no content.
NOISE_COMMANDS = ["qquad", "quad", "thinspace", "textbf", "textit", "textrm", "text", "mathrm", "mathbf", "left", "right", "displaystyle", "dfrac", "tfrac", ",", ";", ":", "!", r"\s"]
# What marks a footer line.
FOOTER = r"(?i)\bcopyright\b|©|all rights reserved|www\.|https?://|^\s*page\s*\d+\s*$|^\s*score\s*:?\s*$"
# Problem markers, first match wins; the number is the last group.
MARKERS = [
    r"(?i)^\s*(?:Problem|Question|Prob\.?)\s+(\d+)",
    r"^\s*\d+\s*/\s*\d+\s*/\s*(\d+)\s*\.",
    r"^\s*(\d+)\s*[.)]",
]
# An entry of an answer key.
ENTRY = r"(?:^|(?<=\s))(\d{1,3})\s*[.)]\s+"


def strip(x: Column) -> Column:
    return F.regexp_replace(x, r"(?U)^\s+|\s+$", "")


def without_images(x: str) -> str:
    r"""A space for each image reference `![label](path)`: brackets nest to any depth, `\` hides the next sign; one that
    does not close stays."""
    partner, waiting = {}, {"[": [], "(": []}
    for m in _brackets.finditer(x):
        if m[0] in waiting:
            waiting[m[0]].append(m.start())
        elif m[0] in "])" and (opens := waiting["[" if m[0] == "]" else "("]):
            partner[opens.pop()] = m.start()
    out, done, start = [], 0, x.find("![")
    while start >= 0:
        path = partner.get(start + 1, len(x)) + 1
        end = partner.get(path) if x[path : path + 1] == "(" else None
        if end is None:
            start = x.find("![", start + 2)
            continue
        out += [x[done:start], " "]
        done, start = end + 1, x.find("![", end + 1)
    return "".join(out) + x[done:]


_brackets = re.compile(r"\\.|[\[\]()]", re.DOTALL)


@F.pandas_udf(StringType())
def _images_out(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in texts:
        yield batch.map(without_images, na_action="ignore")


def drop_images(x: Column) -> Column:
    """A space for each image reference; only texts that hold `![` go through Python."""
    has = F.contains(x, F.lit("!["))
    return F.when(has, _images_out(F.when(has, x))).otherwise(x)


def normalize(x: Column) -> Column:
    """Figures, images and content-free commands out, lower case, runs of other signs to one space."""
    noise = r"\\(?:" + "|".join(NOISE_COMMANDS) + ")"
    bare = F.lower(F.regexp_replace(drop_images(F.replace(x, F.lit(FIGURE), F.lit(" "))), r"(?i)<img[^>]*>", " "))
    return F.trim(F.regexp_replace(F.regexp_replace(bare, noise, " "), "[^a-z0-9]+", " "))


def shingles(x: Column, k: int) -> Column:
    """Distinct substrings of length k; a shorter text is its own shingle; none for an empty text."""
    # The letters are bound once: substring() would walk the text from its start for every shingle.
    each = F.transform(F.array(F.split(x, "")), lambda c: F.transform(F.sequence(F.lit(0), F.greatest(F.size(c) - k, F.lit(0))), lambda i: F.concat(*[F.get(c, i + j) for j in range(k)])))[0]
    return F.when(F.length(x) == 0, F.array().cast("array<string>")).when(F.length(x) <= k, F.array(x)).otherwise(F.array_distinct(each))


def jaccard(a: Column, b: Column) -> Column:
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).otherwise(both / F.greatest(F.size(a) + F.size(b) - both, F.lit(1)))


def is_footer(x: Column) -> Column:
    return F.coalesce(x.rlike(FOOTER), F.lit(False))


def without_footers(x: Column) -> Column:
    return F.array_join(F.filter(F.split(x, "\n", -1), lambda line: ~line.rlike(FOOTER)), "\n")


def without_furniture(x: Column, line_patterns: list[str], inline_patterns: list[str] = ()) -> Column:
    """Inline patterns deleted, then lines dropped whose plain form matches a line pattern."""
    for p in inline_patterns:
        x = F.regexp_replace(x, p, "")
    plain = lambda line: F.regexp_replace(strip(F.regexp_replace(line, "[*_#]", "")), r"(?U)\s+", " ")
    runs = "|".join(f"(?:{p})" for p in line_patterns)
    return strip(F.array_join(F.filter(F.split(x, r"\r\n|[\n\r]", -1), lambda line: ~plain(line).rlike(runs)), "\n") if runs else x)


def marker(x: Column) -> Column:
    """STRUCT<number, end> of the leading problem marker, null without one."""
    out = F.lit(None).cast("struct<number:int,end:int>")
    for p in reversed(MARKERS):
        hit = F.regexp_extract(x, p, 0)
        out = F.when(hit != "", F.struct(F.regexp_extract(x, p, 1).cast("int").alias("number"), F.length(hit).alias("end"))).otherwise(out)
    return out


def strip_marker(x: Column) -> Column:
    m = marker(x)
    return F.when(m.isNull(), x).otherwise(F.regexp_replace(F.substring(x, m["end"] + 1, F.length(x)), r"(?U)^\s+", ""))


def key_entries(line: Column) -> Column:
    """Entries of an answer-key line: array of STRUCT<number, answer>; tags and blanks are dropped first."""
    bare = strip(F.regexp_replace(F.regexp_replace(line, "<[^>]+>", " "), "_{2,}", " "))
    numbers = F.regexp_extract_all(bare, F.lit(ENTRY), F.lit(1))
    values = F.slice(F.split(bare, ENTRY, -1), 2, F.greatest(F.size(numbers), F.lit(1)))
    return F.when(F.size(numbers) == 0, F.array().cast("array<struct<number:int,answer:string>>")).otherwise(
        F.zip_with(numbers, values, lambda n, v: F.struct(n.cast("int").alias("number"), F.trim(v).alias("answer"))))


# What goes, in this order, before two answers are compared.
ANSWER_DROPS = [r"\\[a-z]+", r"[\s${}]", "[^a-z0-9./-]"]


def answer_form(x: Column) -> Column:
    """Loose form in which two answers are compared: commands, space, $ and braces out, few signs kept."""
    x = F.lower(x)
    for pattern in ANSWER_DROPS:
        x = F.regexp_replace(x, pattern, "")
    return x


def last_boxed(x: Column) -> Column:
    r"""Text of the last \boxed{...} with balanced braces; null if there is none or it does not close."""
    rest = F.substring_index(x, r"\boxed{", -1)
    step = lambda a, c: F.when(a["d"] == 0, a).otherwise(F.struct((a["d"] + F.when(c == "{", 1).when(c == "}", -1).otherwise(0)).alias("d"), (a["n"] + 1).alias("n")))
    end = F.aggregate(F.split(rest, ""), F.struct(F.lit(1).alias("d"), F.lit(0).alias("n")), step)
    return F.when(F.contains(x, F.lit(r"\boxed{")) & (end["d"] == 0), F.substring(rest, F.lit(1), end["n"] - 1))


def place_refs(x: Column, refs: Column) -> Column:
    """Figure placeholders replaced by references one to one; surplus placeholders go, surplus references are appended."""
    parts = F.split(x, FIGURE, -1)
    holes = F.size(parts) - 1
    filled = F.array_join(F.zip_with(parts, F.slice(refs, 1, F.greatest(holes, F.lit(1))), lambda p, r: F.concat(p, F.when(F.lit(True), F.coalesce(r, F.lit(""))))), "")
    body = F.when(holes == 0, x).otherwise(filled)
    extra = F.slice(refs, holes + 1, F.greatest(F.size(refs) - holes, F.lit(0)))
    return strip(F.concat_ws("\n", body, F.when(F.size(refs) > holes, F.array_join(extra, "\n"))))


def preview(x: Column, most: int = 160) -> Column:
    flat = F.trim(F.regexp_replace(x, r"\s+", " "))
    return F.when(F.length(flat) <= most, flat).otherwise(F.concat(F.rtrim(F.substring(flat, 1, most - 1)), F.lit("…")))


# A line of rules or bare emphasis, and a line that is an image reference.
RULE_LINE = r"[ \t]*(?:(?:\*[ \t]*){2,}|(?:_[ \t]*){2,}|(?:-[ \t]*){3,})"
IMAGE_LINE = r"\s*!\[[^]]*\]\([^)]+\)\s*"


def boundary_clean(x: Column) -> Column:
    """Rule lines and blank ones at both edges go; image lines are looked through, so a rule between text and image goes
    too.  Bold signs around the whole, or a single one at an edge, are taken off."""
    lines = F.split(x, r"\r\n|[\n\r]", -1)
    blank, rule, image = (lambda y: y.rlike(r"^\s*$")), (lambda y: y.rlike(f"^{RULE_LINE}$")), (lambda y: y.rlike(f"^{IMAGE_LINE}$"))
    marks = F.transform(lines, lambda y: F.when(blank(y), "b").when(rule(y), "r").when(image(y), "i").otherwise("t"))
    # One sign a line: blank, rule, image, text.  Rules before the first and after the last text line go.
    shape = F.array_join(marks, "")
    head, tail = F.length(F.regexp_extract(shape, "^[bri]*", 0)), F.length(F.regexp_extract(shape, "[bri]*$", 0))
    kept = F.filter(lines, lambda y, i: ~((F.get(marks, i) == "r") & ((i < head) | (i >= F.size(lines) - tail))))
    bare = strip(F.array_join(kept, "\n"))
    odd = lambda y: F.regexp_count(y, F.lit(r"\*\*")) % 2 == 1
    cut = lambda y, a, b: strip(F.substring(y, F.lit(a), F.greatest(F.length(y) - b, F.lit(0))))
    whole = bare.rlike(r"^\*\*[ \n]") & F.endswith(bare, F.lit("**")) & (F.length(bare) > 4)
    front = F.when(F.startswith(bare, F.lit("** ")) & odd(bare), cut(bare, 3, 2)).otherwise(bare)
    back = F.when(F.endswith(front, F.lit(" **")) & odd(front), cut(front, 1, 2)).otherwise(front)
    return F.when(whole, cut(bare, 3, 4)).otherwise(back)


def strip_tail(x: Column, heading: str) -> Column:
    """Text before the first line that matches the heading."""
    return strip(F.regexp_replace(x, rf"(?ms)^(?:{heading}).*", ""))


def words(x: Column) -> Column:
    return F.regexp_extract_all(F.lower(x), F.lit("[a-z0-9]+"), F.lit(0))


def labelled_answer(x: Column) -> Column:
    """Value of the first `Answer:` line, on that line or the next."""
    return F.nullif(strip(F.regexp_extract(x, r"(?im)^[ \t*_]*(?:Final\s+)?Answer[*_]*\s*[:.][*_ \t]*\n?[ \t]*([^\n]+)", 1)), F.lit(""))


def stated_answer(x: Column) -> Column:
    """Value of the last `answer is ...` in prose, up to the end of the sentence: a dot or comma within a number is no end."""
    return F.nullif(strip(F.regexp_extract(x, r"(?is).*\banswer\s+is\s*:?\s*((?:[^\n.,;]|[.,](?=\d))+)", 1)), F.lit(""))


def valid_answer(x: Column) -> Column:
    """One line, 120 characters at most, no implication, at most one equality."""
    return F.coalesce((F.length(F.trim(x)) > 0) & (F.length(x) <= 120) & ~F.contains(x, F.lit("\n")) & ~x.rlike(r"\\iff|\\implies") & (F.regexp_count(x, F.lit("=")) <= 1), F.lit(False))


def answer_cascade(block: Column) -> Column:
    """STRUCT<answer, tier>: label, then box, then prose; a tier without a valid answer passes on to the next."""
    out = F.lit(None).cast("struct<answer:string,tier:string>")
    for tier, value in reversed([("label", labelled_answer(block)), ("box", last_boxed(block)), ("prose", stated_answer(block))]):
        out = F.when(valid_answer(value), F.struct(value.alias("answer"), F.lit(tier).alias("tier"))).otherwise(out)
    return out


def solution_body(block: Column) -> Column:
    """Text after the first Solution label, else after the Answer line, else the whole block."""
    label, answer = r"(?im)^[ \t*_#]*Solution[*_]*\s*\d*\s*[:.]?[*_ \t]*", r"(?im)^[ \t*_]*(?:Final\s+)?Answer[*_]*\s*[:.][^\n]*\n?"
    after = lambda p: F.get(F.split(block, p, 2), F.lit(1))
    return strip(F.coalesce(after(label), after(answer), block))


def list_items(html: Column) -> Column:
    """Texts of the items of lists, up to their first tag."""
    return F.regexp_extract_all(html, F.lit("<li[^>]*>([^<]*)<"), F.lit(1))


def first_heading(html: Column) -> Column:
    return F.regexp_extract(html, "<h1[^>]*>([^<]*)</h1>", 1)


def without_tags(html: Column) -> Column:
    """Tags as spaces, runs of spaces as one."""
    return F.trim(F.regexp_replace(F.regexp_replace(html, "<[^>]+>", " "), "[ \t\n\r]+", " "))


def word_grams(x: Column, n: int) -> Column:
    """Hashes of the distinct word n-grams of a text's normal form; a shorter text is one gram, an empty one has none."""
    found = F.filter(F.split(normalize(x), " "), lambda w: w != "")
    each = F.transform(F.array(found), lambda w: F.transform(F.sequence(F.lit(0), F.greatest(F.size(w) - n, F.lit(0))), lambda i: F.xxhash64(F.array_join(F.slice(w, i + 1, n), " "))))[0]
    return F.when(F.size(found) > 0, F.array_distinct(each)).otherwise(F.array().cast("array<bigint>"))
