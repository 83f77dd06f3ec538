"""Jobs: statements, solutions and answers from cached pages, duplicate manifests, and what is left to solve.

Inputs and outputs are tables: pages (series, test_id, role, page_no, markdown, text_layer), statements (series, test_id,
problem, text), solutions (series, test_id, problem, texts), answers (series, test_id, problem, answer, tier).  Results are
written by test, so a run touches only the tests it reads; a test that has output already is left out unless forced."""

from __future__ import annotations

import argparse
import json
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.functions import answers, cleaners, text
from quire.functions.series import LAYOUTS, REGISTRY, Layout, response_kind
from quire.operators import boxes, dedup, documents, expectations, layout, sinks
from quire.sources.commits import PageCache, TestOutputs

KEYS = ["series", "test_id"]
#: Numbers of solutions per problem that are parsed as several.
HEADERS = r"(?i)^[ \t*_#]*(?:Alternate\s+)?Solution\s*\d+\b", r"(?i)^[ \t*_#]*(?:First|Second|Third|Fourth)\s+Solution\b"


def options(name: str, temperature: float | None = None) -> Layout:
    """A series' layout; a temperature given by the caller wins."""
    found = LAYOUTS.get(name, Layout())
    return found if temperature is None else replace(found, temperature=temperature)


def select_tests(tests: DataFrame, test_id: str | None) -> DataFrame:
    """One test by its id, or all; an unknown id is an error that lists some of those known."""
    if test_id is None:
        return tests
    found = tests.where(F.col("test_id") == test_id)
    if found.isEmpty():
        some = [r["test_id"] for r in tests.select("test_id").distinct().orderBy("test_id").limit(20).collect()]
        raise ValueError(f"no test {test_id!r}; there are {', '.join(some) or 'none'}")
    return found


def source_kind(paths: list[str], test_name: str | None = None) -> str:
    """What a user's paths are: one PDF, a folder of page images, or a batch of PDFs; anything mixed, empty or else is an error."""
    ends = {p.rsplit(".", 1)[-1].lower() if "." in p.rsplit("/", 1)[-1] else "" for p in paths}
    if not paths:
        raise ValueError("nothing to read")
    if ends == {"pdf"}:
        if len(paths) > 1 and test_name:
            raise ValueError("a batch of documents takes no name of a test")
        return "pdf" if len(paths) == 1 else "batch"
    if ends <= {"png", "jpg", "jpeg"}:
        return "images"
    raise ValueError("documents and images, or neither, cannot be read together")


def parse(pages: DataFrame, name: str, temperature: float | None = None) -> DataFrame:
    """Statements of a series' cached pages: covers are skipped, pages cleaned, emptied ones dropped, the rest read in order."""
    rows = pages.where(~cleaners.skip_page(name, F.coalesce("text_layer", F.lit(""))))
    rows = rows.withColumn("clean", cleaners.clean_page(name, F.col("markdown")))
    rows = documents.suppressed(rows, "markdown", "clean").withColumn("key", F.concat_ws("\u0001", *KEYS))
    found = layout.paged_items(rows, "key", "page_no", "clean", name if name in REGISTRY else "default", options(name, temperature))
    out = layout.statements(found, ["key"], ["page_no", "item_no"])
    part = F.split("key", "\u0001")
    return out.select(part[0].alias("series"), part[1].alias("test_id"), "problem", text.strip(F.col("text")).alias("text")).where("text <> ''")


def believed(attempts: DataFrame, name: str, role: str = "statement") -> DataFrame:
    """series, test_id, page_no, markdown, text_layer, status: of the attempts (with `rung`) at each page the first that does
    not run away and holds what the series expects of such a page (see expectations); else the best there is."""
    page, own = F.to_json(F.struct(*KEYS, "page_no")), F.to_json(F.struct(*KEYS, "page_no", "rung"))
    rows = attempts.withColumns({"page": page, "page_key": own})
    facts = rows.select("page_key", F.lit(name).alias("series"), F.lit(role).alias("role"), F.col("markdown").alias("text"), F.col("text_layer").alias("layer"))
    found = rows.select("page_key", F.explode(expectations.numbers_of(cleaners.clean_page(name, F.col("markdown")))).alias("problem"))
    valid = expectations.judged(facts, found).select("page_key", "valid")
    best = documents.ladder(rows.join(valid, "page_key", "left").select("page", "rung", F.col("markdown").alias("text"), "valid"), F.col("valid"))
    layers = rows.groupBy("page", *KEYS, "page_no").agg(F.max("text_layer").alias("text_layer"))
    return layers.join(best, "page").select(*KEYS, "page_no", F.col("text").alias("markdown"), "text_layer", "status")


def illustrated(attempts: DataFrame, detections: DataFrame, sizes: DataFrame, name: str) -> DataFrame:
    """series, test_id, problem, text, figures: statements with references to their figures, in one plan.

    attempts: series, test_id, page_no, rung, markdown, text_layer.  detections and sizes are those of operators.boxes, keyed
    by series, test_id, page_no.  Pages are chosen by what is expected of them, cleaned and read in order; the pictures that
    a series' filters leave go to the problems of the page's image tags where they are equally many, else to the last
    problem that begins at or above them; they are numbered within their problem and take the places of its placeholders."""
    rules, opts = name if name in REGISTRY else "default", options(name)
    pages = believed(attempts, name)
    pages = pages.where(~cleaners.skip_page(name, F.coalesce("text_layer", F.lit(""))))
    pages = documents.suppressed(pages.withColumn("clean", cleaners.clean_page(name, F.col("markdown"))), "markdown", "clean")
    pages = pages.withColumn("key", F.to_json(F.struct(*KEYS)))
    items = layout.paged_items(pages, "key", "page_no", "clean", rules, opts).checkpoint()
    said = layout.statements(items, ["key"], ["page_no", "item_no"]).withColumn("text", text.strip(F.col("text"))).where("text <> ''")
    keyed = lambda df: df.withColumn("page", F.to_json(F.struct(F.to_json(F.struct(*KEYS)).alias("key"), "page_no")))
    at = F.to_json(F.struct("key", "page_no"))
    dets, shapes = keyed(detections), keyed(sizes)
    found = boxes.pictures(dets, shapes, opts).select("page", "det", "x0", "y0", "x1", "y1", "at").checkpoint()
    tags = items.where("kind = 'image' AND problem IS NOT NULL").select(at.alias("page"), "item_no", "problem")
    tagged = boxes.zipped(found, tags).select("page", "det", "problem")
    marker = text.marker(F.col("text"))
    heads = documents.anchors(dets.withColumns({"__m": marker["number"], "__e": marker["end"]}), shapes, F.col("__m"), F.col("__e")).select("page", "y", F.col("problem").cast("long").alias("problem"))
    placed = boxes.owners(found.join(tagged.select("page").distinct(), "page", "left_anti"), heads, "problem").where("owner IS NOT NULL").select("page", "det", F.col("owner").alias("problem"))
    shown = tagged.unionByName(placed).join(found.select("page", "det", "at"), ["page", "det"])
    shown = shown.select(F.get_json_object("page", "$.key").alias("key"), F.get_json_object("page", "$.page_no").cast("long").alias("page_no"), "at", "problem")
    number = F.row_number().over(Window.partitionBy("key", "problem").orderBy("page_no", "at"))
    refs = shown.withColumn("figure", number).withColumn("ref", F.concat(F.lit("problem_"), F.col("problem").cast("string"), F.lit("_image_"), F.col("figure").cast("string"), F.lit(".png")))
    out = documents.with_figures(said.select("key", "problem", "text"), refs.select("key", "problem", "figure", "ref"), ["key", "problem"])
    count = refs.groupBy("key", "problem").agg(F.count(F.lit(1)).alias("figures"))
    part = F.from_json("key", "struct<series:string,test_id:string>")
    return out.join(count, ["key", "problem"], "left").select(part["series"].alias("series"), part["test_id"].alias("test_id"), "problem", "text", F.coalesce("figures", F.lit(0)).alias("figures"))


def blocks(pages: DataFrame, name: str) -> DataFrame:
    """One block of solution text for each problem; images are placeholders."""
    rules = f"{name}_solutions" if f"{name}_solutions" in REGISTRY else name
    rows = pages.withColumn("key", F.concat_ws("\u0001", *KEYS)).withColumn("clean", cleaners.placeholders(cleaners.clean_page(name, F.col("markdown"))))
    found = layout.paged_items(rows, "key", "page_no", "clean", rules if rules in REGISTRY else "default", options(name))
    part = F.split("key", "\u0001")
    return layout.statements(found, ["key"], ["page_no", "item_no"]).select(part[0].alias("series"), part[1].alias("test_id"), "problem", "text")


def solutions(pages: DataFrame, name: str, statements: DataFrame | None = None) -> DataFrame:
    """Solutions by problem: cut at their headers, then bodies without statement and labels, clean at their edges."""
    rows = blocks(pages, name)
    if statements is not None:
        rows = documents.unlisted(rows, statements.select(*KEYS, "problem"), [*KEYS, "problem"])
    parts = documents.solution_blocks(rows, [*KEYS, "problem"], "text", *HEADERS).withColumn("text", text.solution_body(F.col("text")))
    lists = parts.groupBy(*KEYS, "problem").agg(F.array_sort(F.collect_list(F.struct("part", "text"))).alias("x")).select(*KEYS, "problem", F.transform("x", lambda p: p["text"]).alias("texts"))
    clean = F.filter(F.transform("texts", text.boundary_clean), lambda x: x != "")
    return lists.withColumn("texts", clean).where(F.size("texts") > 0)


def answer_table(pages: DataFrame, name: str, keys: DataFrame | None = None) -> DataFrame:
    """Answers by problem with the tier each was found in; none for proofs.  An answer of a key (series, test_id, problem,
    answer; see files.spaced_answers, files.tab_answers and documents.key_answers) goes before what solutions say."""
    if name not in answers.CASCADES and keys is None:
        raise ValueError(f"no answers are read for {name!r} without a key")
    found = None
    if name in answers.CASCADES:
        rows = blocks(pages, name).where(response_kind(name, F.col("test_id")) == "answer")
        found = rows.select(*KEYS, "problem", answers.answer(name)("text").alias("a")).select(*KEYS, "problem", "a.*").where("answer IS NOT NULL")
        found = answers.clean_candidates(found)
    if keys is None:
        return found
    printed = keys.where((F.col("series") == name) & (response_kind(name, F.col("test_id")) == "answer")).select(*KEYS, F.col("problem").cast("long").alias("problem"), F.regexp_replace("answer", r"^\s+|\s+$", "").alias("answer"), F.lit("key").alias("tier")).where("answer <> ''")
    if found is None:
        return printed.groupBy(*KEYS, "problem").agg(F.min("answer").alias("answer"), F.first("tier").alias("tier"))
    both = printed.withColumn("__t", F.lit(0)).unionByName(found.withColumn("__t", F.lit(1)))
    return both.groupBy(*KEYS, "problem").agg(F.min_by(F.struct("answer", "tier"), F.struct("__t", "answer")).alias("x")).select(*KEYS, "problem", "x.*")


def duplicates(statements: DataFrame, by_prefix: bool = True, across: bool = False) -> DataFrame:
    """Groups of near-duplicate statements of each scope."""
    rows = statements.select(dedup.scope_of(F.col("test_id"), by_prefix, across).alias("scope"), F.col("test_id").alias("test"), F.col("problem").cast("string").alias("problem"), "text")
    return dedup.duplicate_problems(rows)


def to_solve(statements: DataFrame, solved: DataFrame, known: DataFrame, limit: int | None = None) -> DataFrame:
    """test_id, problem, prompt, known: problems without a solution, by number, at most `limit` a test."""
    left = statements.join(solved.select(*KEYS, "problem").distinct(), [*KEYS, "problem"], "left_anti").join(known.select(*KEYS, "problem", F.col("answer").alias("known")), [*KEYS, "problem"], "left")
    at = F.row_number().over(Window.partitionBy(*KEYS).orderBy("problem"))
    left = left.withColumn("__at", at)
    left = left if limit is None else left.where(F.col("__at") <= limit)
    return left.select(*KEYS, "problem", cleaners.solver_prompt(F.col("text"), F.coalesce("known", F.lit(""))).alias("prompt"), "known")


def checked(solved: DataFrame) -> DataFrame:
    """test_id, problem, answer, verdict of solver texts (text, known): the last box against the known answer, `derived` without one."""
    rows = solved.withColumn("answer", text.last_boxed(F.col("text")))
    same = text.answer_form(F.col("answer")) == text.answer_form(F.col("known"))
    return rows.withColumn("verdict", F.when(F.col("answer").isNull(), "no answer").when(F.col("known").isNull(), "derived").when(same, "match").otherwise("mismatch"))


def counts(rows: DataFrame, status: str) -> DataFrame:
    return rows.groupBy(status).agg(F.count(F.lit(1)).alias("n"))


def backoff(attempt: int, jitter: float = 0.0, retry_after: float | None = None) -> float:
    """Milliseconds before another attempt: what the server asks for, else twice as long each time up to half a minute."""
    return 1000 * retry_after if retry_after is not None else min(30_000, 1000 * 2**attempt) + 500 * jitter


def sidecar(rows: DataFrame, path: str, columns: list[str]) -> bool:
    """A sorted JSON sidecar; none is kept where there are no rows.  Returns whether there is one."""
    spark = rows.sparkSession
    if rows.isEmpty():
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
        return False
    rows.select(*columns).repartitionByRange(1, *columns).sortWithinPartitions(*columns).write.mode("overwrite").json(path)
    return True


def write(rows: DataFrame, path: str) -> None:
    """By series and test; tests not in `rows` keep what they have."""
    rows.repartition(*KEYS).write.partitionBy(*KEYS).option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame | None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)
    return spark.read.parquet(path) if there else None


def run(spark: SparkSession, args: argparse.Namespace) -> dict[str, int]:
    """One command over the tables below `args.root`; returns how many tests it read and rows it wrote.  `cache` appends the
    rows (key, value) of a Parquet folder to the page cache below the root, and compacts it when told to."""
    if args.command == "cache":
        cache = PageCache(spark, f"{args.root}/cache")
        if args.rows:
            cache.append(spark.read.parquet(args.rows))
        if args.compact:
            cache.compact()
        return {"pages": cache.read().count()}
    if args.command == "dedup":
        found = duplicates(spark.read.parquet(f"{args.root}/statements").where(F.col("series") == args.series), not args.across, args.across)
        sinks_rows = dedup.manifest(found, args.series)
        sinks_rows.write.mode("overwrite").text(f"{args.root}/duplicates/series={args.series}")
        return {"groups": found.count()}
    pages = spark.read.parquet(f"{args.root}/pages").where((F.col("series") == args.series) & (F.col("role") == ("statement" if args.command == "parse" else "solution")))
    pages = select_tests(pages, args.test)
    target = f"{args.root}/{'statements' if args.command == 'parse' else 'solutions'}"
    done = read(spark, target)
    if done is not None:
        pages = sinks.todo(pages, done.where(F.col("series") == args.series), force=args.force)
    tests = pages.select("test_id").distinct().count()
    if args.command == "parse":
        rows = parse(pages, args.series, args.temp)
    else:
        known = read(spark, f"{args.root}/statements")
        rows = solutions(pages, args.series, known.where(F.col("series") == args.series) if known is not None else None)
        if args.series in answers.CASCADES:
            write(answer_table(pages, args.series), f"{args.root}/answers")
    write(rows, target)
    if args.command == "parse":
        outputs = TestOutputs(spark, f"{args.root}/problems/series={args.series}")
        maps = sinks.problem_maps(spark.read.parquet(target).where(F.col("series") == args.series).join(pages.select("test_id").distinct(), "test_id", "left_semi"))
        outputs.publish(maps, removed=pages.select("test_id").distinct().join(maps.select("test_id"), "test_id", "left_anti"))
    return {"tests": tests, "written": spark.read.parquet(target).where(F.col("series") == args.series).count()}


def arguments() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="quire", description="Statements, solutions and duplicates from tables of cached pages.")
    sub = p.add_subparsers(dest="command", required=True)
    for name in ("parse", "solutions", "dedup"):
        s = sub.add_parser(name)
        s.add_argument("--root", required=True, help="folder of the tables pages, statements, solutions and answers")
        s.add_argument("--series", required=True, choices=sorted(LAYOUTS))
        s.add_argument("--test", default=None)
        s.add_argument("--force", action="store_true")
        s.add_argument("--temp", type=float, default=None)
        s.add_argument("--across", action="store_true")
    s = sub.add_parser("cache")
    s.add_argument("--root", required=True, help="folder below which the cache lies")
    s.add_argument("--rows", default=None, help="Parquet folder with key and value of each page")
    s.add_argument("--compact", action="store_true")
    return p


def main(argv: list[str] | None = None) -> None:
    args = arguments().parse_args(argv)
    print(json.dumps(run(SparkSession.builder.appName("quire").getOrCreate(), args)))
