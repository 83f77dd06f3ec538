"""Boxes on pages: what a detection is, which pictures count, and which problem each belongs to.

Boxes are rows (page, det, label, score, x0, y0, x1, y1, text, ink); `ink` is the share of dark points in the box.  Pages
are rows (page, width, height).  Every window and join is within a page, so pages are the unit of distribution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.series import Layout
from quire.functions.text import is_footer
from quire.operators.sequence import area, as_of, overlap, scan, union_area, without_nested

# Labels of a detector, shares and distances.
TEXT_LABELS = ["Text", "Formula", "List-item", "Section-header", "Title", "Caption"]
IMAGE_LABELS = ["Picture", "Table"]
HEADER_LABELS = ["Section-header", "Title"]
BLANK_INK, ROW_TOLERANCE, GAP_SHARE, START_SHARE, NESTED, CLUSTER_SHARE, MIN_ASPECT = 0.004, 12, 0.06, 0.02, 0.9, 0.02, 2.5
DRAWN, BOX_GAP, COLOURS = 0.5, 1.5, 10
GUTTER_SHARE, GUTTER_BAND, GUTTER_SPAN = 0.03, (0.3, 0.7), 0.6
CUE = r"(?i)\b(?:shown|diagram|figure|graph|grid|number line|chart|pictured|illustration|below|at right)\b"


def is_blank(ink: Column | str = "ink") -> Column:
    """A box that is all but empty, or of no size."""
    ink = F.col(ink) if isinstance(ink, str) else ink
    return (F.coalesce(ink, F.lit(0.0)) < BLANK_INK) | (area() <= 0)


def ink_ratio(points: Column, dark: int = 200) -> Column:
    """Share of points darker than `dark` in an array of brightnesses; 0 for none."""
    return F.coalesce(F.try_divide(F.size(F.filter(points, lambda p: p < dark)), F.size(points)), F.lit(0.0))


def kind_of(is_anchor: Column, inline: Column, clean: Column) -> Column:
    """`image`, `text` or null for a detection: null for containers, page furniture, footers, blank boxes and markers that stand alone."""
    text = F.trim(F.coalesce(F.col("text"), F.lit("")))
    alone = is_anchor & ~inline & (F.trim(F.coalesce(clean, F.lit(""))) == "")
    picture = F.when(~is_blank(), "image")
    said = F.when(~is_footer(text) & ~F.coalesce(alone, F.lit(False)) & ~is_blank(), "text")
    return F.when(F.col("label").isin(IMAGE_LABELS), picture).when(F.col("label").isin(TEXT_LABELS), said)


def by_score(dets: DataFrame, text: float, picture: float, equation: float = 0.4) -> DataFrame:
    """One scan with a flag for each use: is_text, is_picture, is_equation_text, each with a threshold of its own."""
    texts = F.col("label").isin(TEXT_LABELS)
    return dets.where(F.col("score") >= min(text, picture, equation)).withColumns({
        "is_text": texts & (F.col("score") >= text), "is_picture": F.col("label").isin(IMAGE_LABELS) & (F.col("score") >= picture), "is_equation_text": texts & (F.col("score") >= equation),
    })


def scaled(boxes: DataFrame, pages: DataFrame) -> DataFrame:
    """Boxes in points of a document (page sizes pdf_width, pdf_height) in points of the rendered page."""
    sized = boxes.join(pages.select("page", (F.col("width") / F.col("pdf_width")).alias("__sx"), (F.col("height") / F.col("pdf_height")).alias("__sy")), "page")
    return sized.withColumns({c: F.col(c) * F.col(f"__s{c[0]}") for c in ("x0", "y0", "x1", "y1")}).drop("__sx", "__sy")


def reading_order(boxes: DataFrame) -> DataFrame:
    """With `at`: rows of ten points of height, then from left to right."""
    band = F.bround(F.col("y0") / 10).alias("__band")
    return boxes.withColumn("at", F.row_number().over(Window.partitionBy("page").orderBy(band, "x0", "det")))


def _inside(boxes: DataFrame, others: DataFrame, least: Column, how: str = "left_anti", more: Column | None = None) -> DataFrame:
    """Boxes without (or with: left_semi) another box that covers more than `least` of them."""
    outer = others.select(F.col("page").alias("__page"), *[F.col(c).alias(f"o_{c}") for c in ("x0", "y0", "x1", "y1")])
    cond = (F.col("page") == F.col("__page")) & (area() > 0) & (overlap("", "o_") > least * area())
    return boxes.join(outer, cond & more if more is not None else cond, how)


def union_within(boxes: DataFrame, rects: DataFrame) -> DataFrame:
    """page, det, covered: the area of a box that rectangles cover together, each point once."""
    r = rects.select(F.col("page").alias("__page"), *[F.col(c).alias(f"r_{c}") for c in ("x0", "y0", "x1", "y1")])
    cut = boxes.join(r, (F.col("page") == F.col("__page")) & (overlap("", "r_") > 0)).select("page", "det", *[F.greatest(c, f"r_{c}").alias(c) for c in ("x0", "y0")], *[F.least(c, f"r_{c}").alias(c) for c in ("x1", "y1")])
    return union_area(cut, ["page", "det"]).withColumnRenamed("area", "covered")


def pictures(dets: DataFrame, pages: DataFrame, layout: Layout, texts: DataFrame | None = None, words: DataFrame | None = None, drawings: DataFrame | None = None) -> DataFrame:
    """The pictures that count, with `at` in the order of height: blank ones go, then those a layout's filters name, then
    those within a larger one.  `texts` are the text boxes that show equations; `words` and `drawings` come from the
    document's own text layer, in rendered points."""
    texts = texts if texts is not None else dets.where(F.col("label").isin(TEXT_LABELS))
    found = dets.where((F.col("label") == "Picture") & ~is_blank()).join(pages.select("page", "width", "height"), "page")
    middle, height = (F.col("y0") + F.col("y1")) / 2, F.col("y1") - F.col("y0")
    for share, keep in (
        (layout.max_area, lambda s: area() <= s * F.col("width") * F.col("height")),
        (layout.header, lambda s: middle > s * F.col("height")),
        (layout.right_margin, lambda s: F.col("x1") < (1 - s) * F.col("width")),
        (layout.footer, lambda s: middle < (1 - s) * F.col("height")),
        (layout.min_height, lambda s: height >= s * F.col("height")),
    ):
        found = found if share is None else found.where(keep(share))
    if layout.equation_overlap is not None:
        aspect = MIN_ASPECT if layout.equation_aspect is None else layout.equation_aspect
        found = _inside(found, texts, F.lit(layout.equation_overlap), more=(height > 0) & ((F.col("x1") - F.col("x0")) / height > aspect))
    if layout.glyph_coverage is not None and words is not None:
        found = without_set_equations(found, words, drawings, layout.glyph_coverage)
    found = without_nested(found, "page", "det", NESTED)
    return found.withColumn("at", F.row_number().over(Window.partitionBy("page").orderBy("y0", "x0", "det")))


def without_set_equations(found: DataFrame, words: DataFrame, drawings: DataFrame | None, least: float) -> DataFrame:
    """Pictures that the document's words cover to `least` and that hold no drawing are display equations, and go."""
    covered = found.join(union_within(found, words), ["page", "det"], "left")
    dense = (area() > 0) & (F.coalesce("covered", F.lit(0.0)) >= least * area())
    if drawings is not None:
        d = drawings.select(F.col("page").alias("__page"), *[F.col(c).alias(f"d_{c}") for c in ("x0", "y0", "x1", "y1")])
        drawn = found.join(d, (F.col("page") == F.col("__page")) & (area("d_") > 0) & (overlap("", "d_") > DRAWN * area("d_")), "left_semi").select("page", "det").withColumn("drawn", F.lit(True))
        covered = covered.join(drawn, ["page", "det"], "left")
        dense = dense & F.col("drawn").isNull()
    return covered.where(~F.coalesce(dense, F.lit(False))).select(*found.columns)


def answer_rows(words: DataFrame) -> DataFrame:
    """Words that stand on the row of a word `Answer`, in the same block and to its right: at least half their height in common."""
    bare = F.lower(F.rtrim(F.trim("word"), F.lit(":")))
    label = words.where(bare == "answer").select(F.col("page").alias("__page"), F.col("block").alias("__block"), F.col("x1").alias("a_x1"), F.col("y0").alias("a_y0"), F.col("y1").alias("a_y1"))
    common, least = F.greatest(F.lit(0.0), F.least("y1", "a_y1") - F.greatest("y0", "a_y0")), F.least(F.col("y1") - F.col("y0"), F.col("a_y1") - F.col("a_y0"))
    # Not written as equality of blocks, which would shuffle words by page and block that are dealt by page.
    cond = (F.col("page") == F.col("__page")) & F.col("block").between(F.col("__block"), F.col("__block")) & (F.col("x0") >= F.col("a_x1")) & (least > 0) & (common >= 0.5 * least)
    return words.where(bare != "answer").join(label, cond, "left_semi")


def drawn_rectangles(lines: DataFrame, pages: DataFrame) -> DataFrame:
    """page, x0, y0, x1, y1: rectangles that four drawn lines (ax, ay, bx, by) close, small enough to frame an answer."""
    lines = lines.join(pages.select("page", "pdf_width", "pdf_height"), "page")
    flat, steep = F.abs(F.col("ay") - F.col("by")) <= 0.75, F.abs(F.col("ax") - F.col("bx")) <= 0.75
    h = lines.where(flat).select("page", "pdf_width", "pdf_height", F.least("ax", "bx").alias("l"), F.greatest("ax", "bx").alias("r"), ((F.col("ay") + F.col("by")) / 2).alias("y"))
    v = lines.where(~flat & steep).select("page", ((F.col("ax") + F.col("bx")) / 2).alias("x"), F.least("ay", "by").alias("t"), F.greatest("ay", "by").alias("b"))
    near = lambda a, b: F.abs(a - b) <= BOX_GAP
    c = lambda a, b: F.col(f"{a}.{b}")
    gap = c("q", "y") - c("p", "y")
    frames = h.alias("p").join(h.alias("q"), (c("p", "page") == c("q", "page")) & (gap > 4) & (gap <= 0.08 * c("p", "pdf_height")) & near(c("p", "l"), c("q", "l")) & near(c("p", "r"), c("q", "r")) & (c("p", "r") - c("p", "l") <= 0.2 * c("p", "pdf_width")))
    frames = frames.select(c("p", "page").alias("page"), c("p", "l").alias("x0"), c("p", "y").alias("y0"), c("p", "r").alias("x1"), c("q", "y").alias("y1")).distinct()
    for side in ("x0", "x1"):
        w = v.select(F.col("page").alias("__page"), "x", "t", "b")
        frames = frames.join(w, (F.col("page") == F.col("__page")) & near(F.col("x"), F.col(side)) & near(F.col("t"), F.col("y0")) & near(F.col("b"), F.col("y1")), "left_semi")
    return frames


def _holds_middle(boxes: DataFrame, others: DataFrame, slack: float) -> Column:
    mx, my = (F.col("o_x0") + F.col("o_x1")) / 2, (F.col("o_y0") + F.col("o_y1")) / 2
    return (F.col("page") == F.col("__page")) & mx.between(F.col("x0") - slack, F.col("x1") + slack) & my.between(F.col("y0") - slack, F.col("y1") + slack)


def without_answer_boxes(found: DataFrame, words: DataFrame, lines: DataFrame, pages: DataFrame, widest: float = 0.30) -> DataFrame:
    """Flat pictures around a value on an answer row or in a drawn frame are boxed answers, and go.  `words` and `lines` are
    in points of the document."""
    outer = lambda x: x.select(F.col("page").alias("__page"), *[F.col(c).alias(f"o_{c}") for c in ("x0", "y0", "x1", "y1")])
    frames = drawn_rectangles(lines, pages)
    framed = frames.join(outer(words), _holds_middle(frames, words, 1), "left_semi")
    sized = found.join(pages.select("page", F.col("width").alias("__w"), F.col("height").alias("__h")), "page")
    flat, width = (F.col("y1") - F.col("y0")) <= 0.08 * F.col("__h"), F.col("x1") - F.col("x0")
    for others, slack, share in ((answer_rows(words), 0, 0.30), (framed, 4, widest)):
        sized = sized.join(outer(scaled(others, pages)), _holds_middle(sized, others, slack) & flat & (width <= share * F.col("__w")), "left_anti")
    return sized.drop("__w", "__h")


# What marks a table of answers on a page, and a sponsor's mark.
ANSWER_TABLE = r"(?is)(?:^|\n)\s*(?:[*_#]+\s*)*(?:\d+\s+)?Answers?\b[\s\S]{0,300}<table>"


def without_answer_table(dets: DataFrame, pages: DataFrame) -> DataFrame:
    """Wide pictures low on a page whose text (`markdown` of pages) holds a table of answers go."""
    sized = dets.join(pages.select("page", F.col("width").alias("__w"), F.col("height").alias("__h"), F.coalesce(F.col("markdown").rlike(ANSWER_TABLE), F.lit(False)).alias("__told")), "page")
    grid = F.col("label").isin(IMAGE_LABELS) & (F.col("x1") - F.col("x0") >= 0.5 * F.col("__w")) & ((F.col("y0") + F.col("y1")) / 2 >= 0.45 * F.col("__h"))
    return sized.where(~(F.col("__told") & grid)).drop("__w", "__h", "__told")


def without_sponsor(dets: DataFrame, pages: DataFrame, told: Column) -> DataFrame:
    """Of a page whose text tells of a sponsor (`told`, over pages), the lowest very flat picture at the foot goes (of equally low ones the widest)."""
    sized = dets.join(pages.select("page", F.col("width").alias("__w"), F.col("height").alias("__h"), F.coalesce(told, F.lit(False)).alias("__told")), "page")
    middle, height, width = (F.col("y0") + F.col("y1")) / 2, F.col("y1") - F.col("y0"), F.col("x1") - F.col("x0")
    logo = F.col("__told") & F.col("label").isin(IMAGE_LABELS) & (height > 0) & (middle >= 0.86 * F.col("__h")) & (height <= 0.08 * F.col("__h")) & (width >= 4.5 * height)
    rank = F.row_number().over(Window.partitionBy("page", "__logo").orderBy(F.desc(middle), F.desc(width), "det"))
    return sized.withColumn("__logo", F.coalesce(logo, F.lit(False))).withColumn("__rank", rank).where(~(F.col("__logo") & (F.col("__rank") == 1))).drop("__w", "__h", "__told", "__logo", "__rank")


def above(found: DataFrame, floors: DataFrame) -> DataFrame:
    """Pictures whose middle is not below their page's floor (page, floor); pages without one keep all."""
    return found.join(floors, "page", "left").where(F.coalesce((F.col("y0") + F.col("y1")) / 2 <= F.col("floor"), F.lit(True))).drop("floor")


def outside(found: DataFrame, regions: DataFrame) -> DataFrame:
    """Pictures whose middle lies in none of their page's regions (page, x0, y0, x1, y1)."""
    r = regions.select(F.col("page").alias("__page"), *[F.col(c).alias(f"r_{c}") for c in ("x0", "y0", "x1", "y1")])
    mx, my = (F.col("x0") + F.col("x1")) / 2, (F.col("y0") + F.col("y1")) / 2
    return found.join(r, (F.col("page") == F.col("__page")) & mx.between(F.col("r_x0"), F.col("r_x1")) & my.between(F.col("r_y0"), F.col("r_y1")), "left_anti")


def owners(boxes: DataFrame, marks: DataFrame, value: str, tolerance: float = ROW_TOLERANCE) -> DataFrame:
    """With `owner`: the value of the last mark (page, y, value) at or above a box's middle, within the tolerance; null above the first."""
    rows = boxes.withColumn("y", (F.col("y0") + F.col("y1")) / 2 + tolerance)
    return as_of(rows, marks.select("page", "y", value), ["page"], ["y"], value).drop("y")


def column_owners(boxes: DataFrame, marks: DataFrame, gutter: str, value: str) -> DataFrame:
    """As owners on pages of two columns (`gutter` of a page, null for one column): the order is column, then height."""
    side = lambda x: F.when(x < F.col(gutter), 0).otherwise(F.when(F.col(gutter).isNull(), 0).otherwise(1))
    rows = boxes.withColumns({"col": side((F.col("x0") + F.col("x1")) / 2), "y": (F.col("y0") + F.col("y1")) / 2 + ROW_TOLERANCE})
    return as_of(rows, marks.withColumn("col", side(F.col("x"))).select("page", "col", "y", value), ["page"], ["col", "y"], value).drop("col", "y")


def offset_owners(boxes: DataFrame, pages: DataFrame, spans: DataFrame) -> DataFrame:
    """With `owner` where only the page's text is known: the problem of the span (page, item_no, problem, text) that stands
    as far down the text as the box's middle down the page; spans of no problem are passed over."""
    w = Window.partitionBy("page").orderBy("item_no")
    length = F.length("text")
    at = spans.withColumn("at", F.coalesce(F.sum(length).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("double"))
    total = spans.groupBy("page").agg(F.sum(length).alias("__total"))
    rows = boxes.join(pages.select("page", F.col("height").alias("__h")), "page").join(total, "page", "left")
    rows = rows.withColumn("at", F.try_divide((F.col("y0") + F.col("y1")) / 2, F.col("__h")) * F.col("__total"))
    return as_of(rows, at.where("problem IS NOT NULL"), ["page"], ["at"], "problem").drop("at", "__h", "__total")


def groups_by_gaps(boxes: DataFrame, pages: DataFrame) -> DataFrame:
    """With `problem`: boxes in the order of height; one that begins far below the end of the one before opens the next."""
    w = Window.partitionBy("page").orderBy("y0", "det")
    sized = boxes.join(pages.select("page", F.col("height").alias("__h")), "page")
    fresh = F.when(F.col("y0") - F.lag("y1").over(w) >= GAP_SHARE * F.col("__h"), 1).otherwise(0)
    return sized.withColumn("__fresh", fresh).withColumn("problem", F.sum("__fresh").over(w) + 1).drop("__h", "__fresh")


def spaced_starts(boxes: DataFrame, pages: DataFrame, headers: bool = False) -> DataFrame:
    """page, y: where problems start by the left margin.  Of text boxes that begin at it, one within a row of the last
    start taken is the same start.  Headings are left out unless only they count and there are any."""
    heads = F.col("label").isin(HEADER_LABELS)
    texts = boxes.where(F.col("label").isin(TEXT_LABELS) & ~is_blank())
    wanted = heads if headers else ~heads
    has = F.max(F.when(wanted, 1).otherwise(0)).over(Window.partitionBy("page"))
    texts = texts.withColumn("__has", has).where((F.col("__has") == 0) | wanted).drop("__has")
    left = texts.withColumn("__left", F.min("x0").over(Window.partitionBy("page"))).join(pages.select("page", "width"), "page")
    ys = left.where(F.col("x0") <= F.col("__left") + START_SHARE * F.col("width")).select("page", "y0").distinct()

    def start():
        last = None

        def step(y: float) -> int:
            nonlocal last
            if last is not None and y - last <= ROW_TOLERANCE:
                return 0
            last = y
            return 1

        return step

    at = ys.withColumn("i", F.row_number().over(Window.partitionBy("page").orderBy("y0")))
    taken = scan(at, ["page"], "i", [F.col("y0")], start, "taken", "bigint")
    return at.join(taken.where("taken = 1"), ["page", "i"]).select("page", F.col("y0").alias("y"))


def merged_bands(boxes: DataFrame, start: str = "y0", end: str = "y1") -> DataFrame:
    """page, island, lo, hi: boxes that touch or overlap along one axis as one band."""
    w = Window.partitionBy("page").orderBy(start, end)
    before = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    marked = boxes.withColumn("__fresh", F.when(F.col(start) > before, 1).otherwise(0)).withColumn("island", F.sum("__fresh").over(w) + 1)
    return marked.groupBy("page", "island").agg(F.min(start).alias("lo"), F.max(end).alias("hi"))


def gap_starts(boxes: DataFrame, wanted: DataFrame) -> DataFrame:
    """page, y: the starts of `n` parts (page, n) of a page, cut at its widest gaps; of equally wide ones at the upper."""
    w = Window.partitionBy("page").orderBy("island")
    gaps = merged_bands(boxes).join(wanted, "page").withColumn("__gap", F.col("lo") - F.lag("hi").over(w))
    rank = F.row_number().over(Window.partitionBy("page", F.col("__gap").isNull()).orderBy(F.desc("__gap"), "island"))
    return gaps.withColumn("__rank", rank).where(F.col("__gap").isNull() | (F.col("__rank") < F.col("n"))).select("page", F.col("lo").alias("y"))


def gutters(boxes: DataFrame, pages: DataFrame) -> DataFrame:
    """page, gutter: the middle of the first gap between columns that is wide and central enough; boxes across both columns do not count."""
    w = Window.partitionBy("page").orderBy("island")
    narrow = boxes.join(pages.select("page", "width"), "page").where(F.col("x1") - F.col("x0") <= GUTTER_SPAN * F.col("width"))
    gaps = merged_bands(narrow, "x0", "x1").withColumn("before", F.lag("hi").over(w)).join(pages.select("page", "width"), "page")
    at = (F.col("before") + F.col("lo")) / 2
    good = (F.col("lo") - F.col("before") >= GUTTER_SHARE * F.col("width")) & at.between(GUTTER_BAND[0] * F.col("width"), GUTTER_BAND[1] * F.col("width"))
    return gaps.where(good).groupBy("page").agg(F.min_by(at, "island").alias("gutter"))


def clusters(found: DataFrame, pages: DataFrame) -> DataFrame:
    """With `cluster`: pictures in order; one that begins clearly below all before opens the next."""
    w = Window.partitionBy("page").orderBy("at")
    sized = found.join(pages.select("page", F.col("height").alias("__h")), "page")
    before = F.max("y1").over(w.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when(F.col("y0") > before + CLUSTER_SHARE * F.col("__h"), 1).otherwise(0)
    return sized.withColumn("__fresh", fresh).withColumn("cluster", F.sum("__fresh").over(w) + 1).drop("__fresh", "__h")


def midpoints(centres: DataFrame) -> DataFrame:
    """page, y: borders between markers at `c`: half way to the one before; the first as far above as the second is below; a lone one at itself."""
    w = Window.partitionBy("page").orderBy("c")
    first = F.when(F.lead("c").over(w).isNull(), F.col("c")).otherwise(F.col("c") - (F.lead("c").over(w) - F.col("c")) / 2)
    return centres.select("page", F.coalesce((F.col("c") + F.lag("c").over(w)) / 2, first).alias("y"))


def ink_bands(rows: DataFrame, wanted: DataFrame, gap: int = 3, low: float = 6, high: float = 40) -> DataFrame:
    """page, c: middles of runs of inked rows (page, y) with gaps of at most `gap` and a height from `low` to `high`; none at all for a page with another number of them than wanted (page, n)."""
    w = Window.partitionBy("page").orderBy("y")
    marked = rows.withColumn("__fresh", F.when(F.col("y") - F.lag("y").over(w) > gap + 1, 1).otherwise(0)).withColumn("band", F.sum("__fresh").over(w))
    bands = marked.groupBy("page", "band").agg(F.min("y").alias("a"), (F.max("y") + 1).alias("b")).where((F.col("b") - F.col("a")).between(low, high))
    counted = bands.withColumn("__n", F.count(F.lit(1)).over(Window.partitionBy("page"))).join(wanted, "page").where("__n = n")
    return counted.select("page", ((F.col("a") + F.col("b")) / 2).alias("c"))


def trusted_tags(tags: DataFrame, found: DataFrame, plain: DataFrame, items: DataFrame) -> DataFrame:
    """Pages on which the i-th inline tag (page, item_no, problem) may stand for the i-th picture: as many tags as pictures,
    with and without filters by place (`plain`), their problems rising, and no text of a later problem before one's own
    tag is the last."""
    later = Window.partitionBy("page").orderBy("item_no").rowsBetween(1, Window.unboundedFollowing)
    shown = items.withColumn("__later", F.max(F.when((F.col("kind") == "text"), F.col("problem"))).over(later)).where("kind = 'image' AND problem IS NOT NULL")
    w = Window.partitionBy("page").orderBy("item_no")
    told = shown.withColumn("__up", F.coalesce(F.col("problem") > F.lag("problem").over(w), F.lit(True)) & F.coalesce(F.col("__later") > F.col("problem"), F.lit(False)))
    pages = told.groupBy("page").agg(F.count(F.lit(1)).alias("n"), F.bool_and("__up").alias("ok")).where("ok")
    for x in (found, plain):
        pages = pages.join(x.groupBy("page").agg(F.count(F.lit(1)).alias("n")), ["page", "n"], "left_semi")
    return tags.join(pages.select("page"), "page", "left_semi")


def zipped(found: DataFrame, tags: DataFrame, unit: str = "at") -> DataFrame:
    """page, det, problem: the i-th picture (or, by `cluster`, the pictures of the i-th cluster) with the i-th tag's problem, on pages where both are equally many."""
    ranked = found.withColumn("__i", F.dense_rank().over(Window.partitionBy("page").orderBy(unit)))
    mine = ranked.groupBy("page").agg(F.max("__i").alias("n"))
    theirs = tags.withColumn("__i", F.row_number().over(Window.partitionBy("page").orderBy("item_no")))
    equal = mine.join(theirs.groupBy("page").agg(F.max("__i").alias("n")), ["page", "n"], "left_semi").select("page")
    return ranked.join(equal, "page", "left_semi").join(theirs.select("page", "__i", "problem"), ["page", "__i"]).select("page", "det", "problem")


def by_starts(found: DataFrame, starts: DataFrame, problems: DataFrame, carry: DataFrame) -> DataFrame:
    """page, det, problem: pictures to the problems (page, pos, problem) of a page by its starts (page, y).  Above the first
    start a picture belongs to the problem carried on (page, carry), or to none; beyond the last problem to the last; a
    page without starts gives all to its first problem, one without problems to the one carried on."""
    rank = starts.select("page", "y", F.row_number().over(Window.partitionBy("page").orderBy("y")).alias("rank"))
    placed = owners(found, rank, "rank").join(carry, "page", "left")
    count = problems.groupBy("page").agg(F.max("pos").alias("__n"))
    placed = placed.join(count, "page", "left").join(starts.groupBy("page").agg(F.count(F.lit(1)).alias("__s")), "page", "left")
    pos = F.when(F.col("__s").isNull(), F.lit(1)).when(F.col("owner").isNotNull(), F.least("owner", "__n")).cast("long")
    placed = placed.withColumn("pos", pos).join(problems.select("page", F.col("pos").cast("long").alias("pos"), "problem"), ["page", "pos"], "left")
    problem = F.coalesce("problem", F.when(F.col("__n").isNull() | F.col("pos").isNull(), F.col("carry")))
    return placed.select("page", "det", problem.alias("problem")).where("problem IS NOT NULL")


def reconciled(placed: DataFrame, tagged: DataFrame, cues: DataFrame) -> DataFrame:
    """page, det, problem by place, but by tag where the tag's problem speaks of a figure (cues: page, problem) and the other does not."""
    spoken = cues.select("page", "problem").distinct().withColumn("__cue", F.lit(True))
    t = tagged.select("page", "det", F.col("problem").alias("__tag")).join(spoken.withColumnsRenamed({"problem": "__tag", "__cue": "__tag_cue"}), ["page", "__tag"], "left")
    both = placed.join(t, ["page", "det"], "full").join(spoken, ["page", "problem"], "left")
    problem = F.when(F.col("__tag_cue") & F.col("__cue").isNull(), F.col("__tag")).otherwise(F.col("problem"))
    return both.select("page", "det", F.coalesce(problem, "problem").alias("problem")).where("problem IS NOT NULL")


def figure_cues(items: DataFrame) -> DataFrame:
    """page, problem of problems whose text speaks of a figure."""
    return items.where("kind = 'text' AND problem IS NOT NULL").groupBy("page", "problem").agg(F.max(F.col("text").rlike(CUE)).alias("cue")).where("cue").drop("cue")


def overlay(dets: DataFrame) -> DataFrame:
    """What a drawing of the boxes says: `det:P<problem>` and a colour of ten, by problem."""
    return dets.withColumns({"caption": F.concat(F.col("det").cast("string"), F.when(F.col("problem").isNotNull(), F.concat(F.lit(":P"), F.col("problem").cast("string"))).otherwise("")), "colour": F.coalesce(F.col("problem") % COLOURS, F.lit(-1))})
