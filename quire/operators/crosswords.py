"""Pages of crosswords: clue lines get one rising number each, whatever page their heading stands on.

A clue is named by its direction and its number; the direction is told by the line itself ("7 Across") or by the last
heading before it, which may stand on an earlier page.  So the direction is a register that the pages of a document
carry on: the last heading in the order of pages and lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Directions with the number that their clues start from, and how headings call them.
BASES = {"across": 1000, "down": 2000, "down_left": 2000, "down_right": 3000}
LABELS = {"across": "Across", "down": "Down", "down_left": "Down-left", "down_right": "Down-right"}
SIDE = r"(?i)\bdown\s+and\s+to\s+the\s+(left|right)\b"
# Lines of furniture, without their emphasis.
FURNITURE = r"(?i)^(?:(?:<page_number>\d+</page_number>\s*)?page\s+\d+\s+of\s+\d+|PUMaC\s+20\d\d|---)\s*$"
NAMED = r"(?i)^\s*(\d{1,2})\s+(across|down)\b\s*[.:]?"
NUMBERED = r"^\s*(\d{1,2})\s*[.)]\s*"


def _of(names: dict[str, object], key: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for pair in names.items() for x in pair]), key)


def clue_lines(pages: DataFrame, keys: list[str], page: str, text: str, bare: Column) -> DataFrame:
    """keys, page, pos, line, code: the pages' lines, clues rewritten as "code. [number direction] clue".

    `bare` says of a document that its clues are plain numbers under headings; elsewhere a clue names its direction.
    Null texts are pages without lines; order is by page and line, of equal pages the result is the same."""
    rows = pages.select(*keys, page, bare.alias("__bare"), F.posexplode(F.split(text, r"\r\n|\n", -1)).alias("pos", "raw"))
    probe = F.regexp_replace("raw", r"^[*_#>\- •]+", "")
    rows = rows.withColumn("__probe", probe).where(~F.col("__probe").rlike(FURNITURE) & (F.trim("raw") != "---"))
    said, side = F.lower(F.regexp_extract("__probe", NAMED, 2)), F.lower(F.regexp_extract("__probe", SIDE, 1))
    tail = F.regexp_replace(F.regexp_replace("__probe", NAMED, ""), r"^[*_ .:\-]+", "")
    heading = F.when(F.col("__probe").rlike(r"(?i)\bacross\b"), "across").when(side != "", F.concat(F.lit("down_"), side)).when((said != "") & (tail == ""), said)
    rows = rows.withColumns({"__said": F.nullif(said, F.lit("")), "__tail": tail, "__head": heading})
    order = Window.partitionBy(*keys).orderBy(page, "pos")
    rows = rows.withColumn("__now", F.last("__head", ignorenulls=True).over(order))
    title = F.col("__bare") & F.col("__probe").rlike(rf"(?i)\bacross\b|{SIDE[4:]}")
    number = F.regexp_extract("__probe", NUMBERED, 1)
    plain = F.col("__bare") & F.col("__now").isNotNull() & (number != "")
    direction = F.when(~title, F.coalesce(F.when(F.col("__tail") != "", F.col("__said")), F.when(plain & F.col("__said").isNull(), F.col("__now"))))
    clue = F.when(F.col("__said").isNotNull(), F.regexp_extract("__probe", NAMED, 1)).otherwise(number).try_cast("int")
    rest = F.when(F.col("__said").isNotNull(), F.col("__tail")).otherwise(F.regexp_replace(F.regexp_replace("__probe", NUMBERED, ""), r"^[*_ ]+", ""))
    rows = rows.withColumns({"__dir": direction, "__clue": clue, "__rest": rest})
    code = F.when(F.col("__dir").isNotNull(), _of(BASES, F.col("__dir")) + F.col("__clue"))
    made = F.concat(code.cast("string"), F.lit(". ["), F.col("__clue").cast("string"), F.lit(" "), _of(LABELS, F.col("__dir")), F.lit("] "), F.col("__rest"))
    head = F.concat(F.lit("## "), _of(LABELS, F.when(title, F.col("__head")).otherwise(F.col("__said"))))
    alone = title | (F.col("__said").isNotNull() & (F.col("__tail") == ""))
    return rows.select(*keys, page, "pos", F.when(code.isNotNull(), made).when(alone, head).otherwise(F.col("raw")).alias("line"), code.alias("code"))


def clue_pages(pages: DataFrame, keys: list[str], page: str, text: str, bare: Column) -> DataFrame:
    """keys, page, text: the pages with their clues rewritten, as the page reader takes them."""
    lines = clue_lines(pages, keys, page, text, bare)
    held = F.array_sort(F.collect_list(F.struct("pos", "line")))
    return lines.groupBy(*keys, page).agg(F.array_join(F.transform(held, lambda x: x["line"]), "\n").alias(text))
