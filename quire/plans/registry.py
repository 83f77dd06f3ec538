"""Registered queries and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.functions import guards, sets, text
from quire.functions.series import series
from quire.operators import dedup, documents, segment, sequence, sinks
from quire.sources import files
from quire.streaming import guard

Query = Callable[[SparkSession, str], DataFrame]
_made: dict[str, Query] = {}
_sql: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def keep(f: Query) -> Query:
        _made[f.__name__] = f
        if sql:
            _sql[f.__name__] = sql
        return f

    return keep


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def dealt(rows: DataFrame, key: str, each: int = 200_000) -> DataFrame:
    """Rows dealt by a key over partitions whose number grows with the rows (counted from the files' footers): what one
    task sorts stays the same, and windows, groups and joins by the key need no further shuffle."""
    least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(max(least, -(-rows.count() // each)), key)


def entries(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select(F.col("lang").alias("scope"), F.col("doc_id").alias("id"), "text")


NOISE = r"\\(?:" + "|".join(text.NOISE_COMMANDS) + ")"
NORM = rf"trim(regexp_replace(regexp_replace(lower(coalesce(text, '')), '{NOISE}', ' ', 'g'), '[^a-z0-9]+', ' ', 'g'))"
NUMBERED = "SELECT conv_id, turn, CAST(turn + 1 AS VARCHAR) || '. ' || text AS line FROM conversations"


def numbered(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "conversations").select("conv_id", "turn", F.concat((F.col("turn") + 1).cast("string"), F.lit(". "), "text").alias("line"))


@query(f"SELECT {NORM} AS norm, count(*) AS n, min(doc_id) AS first_id FROM documents GROUP BY 1 HAVING count(*) > 1")
def dedup_exact_norm(spark: SparkSession, d: str) -> DataFrame:
    forms = table(spark, d, "documents").select("doc_id", text.normalize(F.coalesce("text", F.lit(""))).alias("norm"))
    return forms.groupBy("norm").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_id")).where("n > 1")


# distinct normal forms, their character 4-grams, and all pairs of a scope whose lengths allow the threshold
FORMS = f"SELECT lang AS scope, norm, min(doc_id) AS node FROM (SELECT lang, doc_id, {NORM} AS norm FROM documents WHERE lang IS NOT NULL) q WHERE norm <> '' GROUP BY 1, 2"
SETS = "SELECT scope, node, list_distinct(list_transform(range(1, greatest(length(norm) - 3, 1) + 1), lambda i: substr(norm, i, 4))) AS s FROM forms WHERE length(norm) >= 40"
PAIRS = f"""forms AS ({FORMS}), sets AS MATERIALIZED ({SETS}), pairs AS MATERIALIZED (SELECT * FROM (SELECT x.scope, x.node AS a, y.node AS b,
len(list_intersect(x.s, y.s)) AS n, len(x.s) + len(y.s) AS m FROM sets x JOIN sets y ON x.scope = y.scope AND x.node < y.node
AND least(len(x.s), len(y.s)) >= 0.85 * greatest(len(x.s), len(y.s)) - 1e-9) q WHERE n / (m - n) >= 0.85)"""


@query(f"WITH {PAIRS} SELECT scope, a, b, n / (m - n) AS similarity FROM pairs")
def dedup_pairs(spark: SparkSession, d: str) -> DataFrame:
    return dedup.similar_pairs(entries(spark, d))


DUPLICATES = f"""WITH RECURSIVE {PAIRS}, links AS (SELECT a, b FROM pairs UNION SELECT b, a FROM pairs), reach AS (SELECT node AS a, node AS b FROM forms UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
roots AS (SELECT a AS node, min(b) AS root FROM reach GROUP BY a),
docs AS (SELECT lang AS scope, source, doc_id, text, {NORM} AS norm FROM documents WHERE lang IS NOT NULL),
members AS (SELECT d.scope, r.root, d.source, d.doc_id, d.text, r.node FROM docs d JOIN forms f ON f.scope = d.scope AND f.norm = d.norm JOIN roots r ON r.node = f.node),
grouped AS (SELECT scope, root, count(*) AS members, string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY doc_id) AS ids,
trim(regexp_replace(arg_min(text, doc_id), '[ \\t\\n\\f\\r\\x0B]+', ' ', 'g')) AS flat FROM members GROUP BY scope, root HAVING count(*) > 1),
nodes AS (SELECT DISTINCT m.scope, m.root, m.node, s.s FROM members m JOIN sets s ON s.scope = m.scope AND s.node = m.node),
floor AS (SELECT x.scope, x.root, min(len(list_intersect(x.s, y.s)) / (len(x.s) + len(y.s) - len(list_intersect(x.s, y.s)))) AS sim FROM nodes x JOIN nodes y ON x.scope = y.scope AND x.root = y.root AND x.node < y.node GROUP BY 1, 2)"""


@query(f"""{DUPLICATES}
SELECT g.scope, g.root, g.members, g.ids, round(coalesce(f.sim, 1.0), 4) AS similarity,
CASE WHEN length(g.flat) <= 160 THEN g.flat ELSE rtrim(substr(g.flat, 1, 159)) || '…' END AS preview FROM grouped g LEFT JOIN floor f ON f.scope = g.scope AND f.root = g.root""")
def dedup_groups(spark: SparkSession, d: str) -> DataFrame:
    found = dedup.duplicate_groups(entries(spark, d))
    return found.withColumn("ids", F.array_join(F.transform("ids", lambda x: x.cast("string")), ","))


@query(f"""{DUPLICATES}, listed AS (SELECT m.scope, m.root, string_agg('{{"test":' || to_json(m.source) || ',"problem":"' || m.doc_id || '"}}', ',' ORDER BY m.source, m.doc_id) AS members,
arg_min(m.text, struct_pack(a := m.source, b := m.doc_id)) AS body FROM members m GROUP BY 1, 2 HAVING count(*) > 1),
shown AS (SELECT l.*, trim(regexp_replace(l.body, '[ \t\n\f\r\x0B]+', ' ', 'g')) AS flat FROM listed l)
SELECT g.scope, g.members, round(coalesce(f.sim, 1.0), 4) AS similarity, CASE WHEN length(flat) <= 160 THEN flat ELSE rtrim(substr(flat, 1, 159)) || '…' END AS preview FROM shown g LEFT JOIN floor f ON f.scope = g.scope AND f.root = g.root""")
def dedup_manifest(spark: SparkSession, d: str) -> DataFrame:
    """The entries of a duplicates manifest: languages as scopes, sources as tests, document ids as problems."""
    docs = table(spark, d, "documents").select(F.col("lang").alias("scope"), F.col("source").alias("test"), F.col("doc_id").cast("string").alias("problem"), "text")
    entry = F.from_json("entry", "scope string, similarity double, preview string, members string")
    listed = dedup.manifest(dedup.duplicate_problems(docs), "documents").select(entry.alias("x")).select("x.*")
    return listed.withColumn("members", F.regexp_replace("members", r"^\[|\]$", ""))


@query(r"""SELECT doc_id, count(*) AS n FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
WHERE regexp_matches(line, '(?i)\bcopyright\b|©|all rights reserved|www\.|https?://|^\s*page\s*\d+\s*$|^\s*score\s*:?\s*$') GROUP BY doc_id""")
def footer_lines(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "documents").select("doc_id", F.explode(F.split("text", "\n", -1)).alias("line"))
    return lines.where(text.is_footer(F.col("line"))).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))


@query(r"""SELECT doc_id, length(array_to_string(list_filter(string_split(text, chr(10)),
lambda x: NOT regexp_matches(x, '(?i)\bcopyright\b|©|all rights reserved|www\.|https?://|^\s*page\s*\d+\s*$|^\s*score\s*:?\s*$')), chr(10))) AS n_left FROM documents WHERE text IS NOT NULL""")
def footer_strip(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").where("text IS NOT NULL").select("doc_id", F.length(text.without_footers(F.col("text"))).cast("long").alias("n_left"))


@query(rf"SELECT conv_id, turn, CAST(regexp_extract(line, '^\s*(\d+)\s*[.)]', 1) AS INTEGER) AS number, length(regexp_extract(line, '^\s*(\d+)\s*[.)]', 0)) AS stop FROM ({NUMBERED}) q")
def marker_parse(spark: SparkSession, d: str) -> DataFrame:
    m = text.marker(F.col("line"))
    return numbered(spark, d).select("conv_id", "turn", m["number"].alias("number"), m["end"].cast("long").alias("stop"))


# line numbers repeat within an order, so rows are numbered by all that tells them apart
MARKS = "SELECT l_orderkey, l_partkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) AS i, CAST(l_partkey % 8 + 1 AS BIGINT) AS raw FROM lineitem"


def marks(spark: SparkSession, d: str) -> DataFrame:
    i = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"))
    return table(spark, d, "lineitem").select("l_orderkey", "l_partkey", i.cast("long").alias("i"), (F.col("l_partkey") % 8 + 1).alias("raw"))


@query(f"""SELECT l_orderkey, i, raw, coalesce(raw > max(raw) OVER (PARTITION BY l_orderkey ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS kept FROM ({MARKS}) q""")
def seg_increasing(spark: SparkSession, d: str) -> DataFrame:
    return sequence.rising(marks(spark, d), ["l_orderkey"], ["i"], "raw").drop("l_partkey")


ORDERED = MARKS


@query(f"""WITH RECURSIVE m AS ({ORDERED}), f AS (
SELECT l_orderkey, i, raw AS last, CAST(1 AS BIGINT) AS kept FROM m WHERE i = 1 UNION ALL
SELECT m.l_orderkey, m.i, CASE WHEN m.raw = f.last + 1 THEN m.raw ELSE f.last END, CAST(CASE WHEN m.raw = f.last + 1 THEN 1 ELSE 0 END AS BIGINT)
FROM f JOIN m ON m.l_orderkey = f.l_orderkey AND m.i = f.i + 1)
SELECT l_orderkey, i, kept FROM f""")
def seg_consecutive(spark: SparkSession, d: str) -> DataFrame:
    return sequence.consecutive(marks(spark, d), ["l_orderkey"], "i", "raw")


@query(f"""WITH RECURSIVE m AS ({ORDERED}), f AS (
SELECT l_orderkey, i, raw AS last, raw AS top, CAST(0 AS BIGINT) AS off, raw AS problem FROM m WHERE i = 1 UNION ALL
SELECT m.l_orderkey, m.i,
CASE WHEN m.raw > f.last OR m.raw = 1 THEN m.raw ELSE f.last END,
CASE WHEN m.raw > f.last THEN greatest(f.top, m.raw) WHEN m.raw = 1 THEN m.raw ELSE f.top END,
CASE WHEN m.raw <= f.last AND m.raw = 1 THEN f.off + f.top ELSE f.off END,
CASE WHEN m.raw > f.last THEN m.raw + f.off WHEN m.raw = 1 THEN m.raw + f.off + f.top END
FROM f JOIN m ON m.l_orderkey = f.l_orderkey AND m.i = f.i + 1)
SELECT l_orderkey, i, problem FROM f""")
def seg_restart(spark: SparkSession, d: str) -> DataFrame:
    return sequence.restarting(marks(spark, d), ["l_orderkey"], "i", "raw")


@query(f"""WITH RECURSIVE m AS (SELECT *, l_partkey % 3 = 0 AS h FROM ({ORDERED}) q), f AS (
SELECT l_orderkey, i, raw AS last, raw AS top, CAST(0 AS BIGINT) AS off, false AS head, raw AS problem FROM m WHERE i = 1 UNION ALL
SELECT m.l_orderkey, m.i,
CASE WHEN m.raw > f.last OR f.head OR m.h THEN m.raw ELSE f.last END,
CASE WHEN m.raw > f.last THEN greatest(f.top, m.raw) WHEN f.head OR m.h THEN m.raw ELSE f.top END,
CASE WHEN m.raw <= f.last AND (f.head OR m.h) THEN f.off + f.top ELSE f.off END,
false,
CASE WHEN m.raw > f.last THEN m.raw + f.off WHEN f.head OR m.h THEN m.raw + f.off + f.top END
FROM f JOIN m ON m.l_orderkey = f.l_orderkey AND m.i = f.i + 1)
SELECT l_orderkey, i, problem FROM f""")
def seg_sections(spark: SparkSession, d: str) -> DataFrame:
    """Numbers that begin a new section only after a heading."""
    found = marks(spark, d).withColumn("heading", F.col("l_partkey") % 3 == 0)
    return sequence.numbered(found, ["l_orderkey"], "i", "raw", "heading", strict=True)


@query("SELECT conv_id, string_agg(text, chr(10) ORDER BY turn) AS body FROM conversations GROUP BY conv_id")
def group_concat(spark: SparkSession, d: str) -> DataFrame:
    return sequence.joined(table(spark, d, "conversations"), ["conv_id"], "turn", "text", "body")


@query("SELECT conv_id, turn, coalesce(sum(length(text)) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start, length(text) AS size FROM conversations")
def running_offset(spark: SparkSession, d: str) -> DataFrame:
    rows = sequence.offsets(table(spark, d, "conversations"), ["conv_id"], "turn", F.length("text"))
    return rows.select("conv_id", "turn", "start", F.length("text").cast("long").alias("size"))


@query("SELECT page_id, unnest(regexp_extract_all(html, '<li[^>]*>([^<]*)<', 1)) AS item FROM pages")
def list_items(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", F.explode(text.list_items(F.col("html"))).alias("item"))


@query("SELECT page_id, regexp_extract(html, '<h1[^>]*>([^<]*)</h1>', 1) AS heading FROM pages")
def heading_starts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", text.first_heading(F.col("html")).alias("heading"))


@query("SELECT page_id, trim(regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '[ \\t\\n\\r]+', ' ', 'g')) AS plain FROM pages")
def tag_strip(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", text.without_tags(F.col("html")).alias("plain"))


@query("""SELECT e.event_id, (SELECT max(a.ts) FROM events a WHERE a.event_type = 'error' AND a.user_id = e.user_id AND a.ts <= e.ts) AS owner FROM events e WHERE e.event_type <> 'error'""")
def asof_owner(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events").select("event_id", "user_id", "ts", "event_type")
    found = sequence.as_of(events.where("event_type <> 'error'"), events.where("event_type = 'error'").withColumn("at", F.col("ts")), ["user_id"], ["ts"], "at")
    return found.select("event_id", "owner")


BOXES = "SELECT l_orderkey AS page, l_linenumber AS box, CAST(l_partkey % 100 AS DOUBLE) AS x0, CAST(l_suppkey % 100 AS DOUBLE) AS y0, l_partkey % 100 + 1 + l_quantity AS x1, CAST(l_suppkey % 100 + 1 + l_linenumber * 9 AS DOUBLE) AS y1 FROM lineitem"


def boxes(spark: SparkSession, d: str) -> DataFrame:
    x, y = (F.col("l_partkey") % 100).cast("double"), (F.col("l_suppkey") % 100).cast("double")
    return table(spark, d, "lineitem").select(F.col("l_orderkey").alias("page"), F.col("l_linenumber").alias("box"), x.alias("x0"), y.alias("y0"), (x + 1 + F.col("l_quantity")).alias("x1"), (y + 1 + F.col("l_linenumber") * 9).cast("double").alias("y1"))


@query(f"""WITH b AS ({BOXES}) SELECT page, box FROM b WHERE NOT EXISTS (SELECT 1 FROM b o WHERE o.page = b.page
AND (o.x1 - o.x0) * (o.y1 - o.y0) > (b.x1 - b.x0) * (b.y1 - b.y0)
AND greatest(0, least(b.x1, o.x1) - greatest(b.x0, o.x0)) * greatest(0, least(b.y1, o.y1) - greatest(b.y0, o.y0)) >= 0.9 * ((b.x1 - b.x0) * (b.y1 - b.y0)))""")
def containment_anti(spark: SparkSession, d: str) -> DataFrame:
    return sequence.without_nested(boxes(spark, d), "page", "box").select("page", "box")


@query(f"""WITH b AS ({BOXES}), g AS (SELECT DISTINCT page, x0 AS x FROM b UNION SELECT DISTINCT page, x1 FROM b), h AS (SELECT DISTINCT page, y0 AS y FROM b UNION SELECT DISTINCT page, y1 FROM b),
sx AS (SELECT page, x AS a, lead(x) OVER (PARTITION BY page ORDER BY x) AS z FROM g), sy AS (SELECT page, y AS a, lead(y) OVER (PARTITION BY page ORDER BY y) AS z FROM h)
SELECT sx.page, sum((sx.z - sx.a) * (sy.z - sy.a)) AS area FROM sx JOIN sy ON sx.page = sy.page WHERE sx.z IS NOT NULL AND sy.z IS NOT NULL
AND EXISTS (SELECT 1 FROM b WHERE b.page = sx.page AND b.x0 <= sx.a AND b.x1 >= sx.z AND b.y0 <= sy.a AND b.y1 >= sy.z) GROUP BY sx.page""")
def union_area(spark: SparkSession, d: str) -> DataFrame:
    return sequence.union_area(boxes(spark, d), ["page"])


@query(f"""WITH b AS ({BOXES}), f AS (SELECT *, CASE WHEN y0 - lag(y1) OVER (PARTITION BY page ORDER BY y0, y1, box) >= 6 THEN 1 ELSE 0 END AS fresh FROM b)
SELECT page, count(*) AS boxes, sum(fresh) + 1 AS groups FROM f GROUP BY page""")
def islands_gap(spark: SparkSession, d: str) -> DataFrame:
    grouped = sequence.gap_groups(boxes(spark, d), ["page"], ["y0", "y1", "box"], "y0", "y1", 6)
    return grouped.groupBy("page").agg(F.count(F.lit(1)).alias("boxes"), F.max("group").alias("groups"))


@query(f"""WITH b AS ({BOXES}), m AS (SELECT *, max(x1) OVER (PARTITION BY page ORDER BY x0, x1 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM b),
i AS (SELECT *, sum(CASE WHEN x0 - before >= 1 THEN 1 ELSE 0 END) OVER (PARTITION BY page ORDER BY x0, x1 ROWS UNBOUNDED PRECEDING) + 1 AS island FROM m)
SELECT page, island, min(x0) AS x0, max(x1) AS x1 FROM i GROUP BY page, island""")
def interval_merge(spark: SparkSession, d: str) -> DataFrame:
    return sequence.islands(boxes(spark, d), ["page"], "x0", "x1", 1, True).groupBy("page", "island").agg(F.min("x0").alias("x0"), F.max("x1").alias("x1"))


@query("""WITH r AS (SELECT user_id, event_type, event_id, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS i, count(*) OVER (PARTITION BY user_id, event_type) AS n FROM events)
SELECT a.user_id, a.event_id AS click, b.event_id AS view FROM r a JOIN r b ON a.user_id = b.user_id AND a.i = b.i AND a.n = b.n WHERE a.event_type = 'click' AND b.event_type = 'view'""")
def zip_guarded(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events").select("user_id", "event_type", "event_id", "ts")
    side = lambda kind, name: events.where(F.col("event_type") == kind).select("user_id", "ts", F.col("event_id").alias("id"), F.col("event_id").alias(name))
    return sequence.paired(side("click", "click"), side("view", "view"), ["user_id"], ["ts", "id"]).select("user_id", "click", "view")


@query(f"SELECT l_orderkey, bool_and(ok) AS rising FROM (SELECT l_orderkey, coalesce(l_partkey > lag(l_partkey) OVER (PARTITION BY l_orderkey ORDER BY i), true) AS ok FROM ({MARKS}) m) q GROUP BY l_orderkey")
def monotone_test(spark: SparkSession, d: str) -> DataFrame:
    return sequence.is_rising(marks(spark, d), ["l_orderkey"], "i", "l_partkey")


@query("SELECT l_orderkey, l_partkey, dense_rank() OVER (PARTITION BY l_orderkey ORDER BY l_partkey) AS number FROM lineitem")
def renumber_dense(spark: SparkSession, d: str) -> DataFrame:
    items = table(spark, d, "lineitem").select("l_orderkey", "l_partkey")
    return sequence.dense_numbers(items, items, ["l_orderkey"], "l_partkey").select("l_orderkey", "l_partkey", "number")


@query("SELECT doc_id, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def anti_incremental(spark: SparkSession, d: str) -> DataFrame:
    return sinks.todo(table(spark, d, "documents").select("doc_id", "source"), table(spark, d, "labels"), "doc_id")


@query("SELECT p_name AS target, count(DISTINCT p_partkey) AS sources FROM part GROUP BY p_name HAVING count(DISTINCT p_partkey) > 1")
def collision(spark: SparkSession, d: str) -> DataFrame:
    return sinks.collisions(table(spark, d, "part").select(F.col("p_name").alias("target"), F.col("p_partkey").alias("source")))


@query("SELECT d.doc_id, coalesce(CAST(l.quality AS VARCHAR), nullif(d.lang, ''), d.source) AS answer, CASE WHEN l.quality IS NOT NULL THEN 'label' WHEN nullif(d.lang, '') IS NOT NULL THEN 'lang' ELSE 'source' END AS tier FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id")
def tiered_answer(spark: SparkSession, d: str) -> DataFrame:
    """The first of three sources that says something, with its name."""
    docs = table(spark, d, "documents").select("doc_id", "lang", "source").join(table(spark, d, "labels"), "doc_id", "left")
    told = [("label", F.col("quality").cast("string")), ("lang", F.col("lang")), ("source", F.col("source"))]
    rows = docs.select("doc_id", F.posexplode(F.array(*[F.struct(v.alias("answer"), F.lit(n).alias("name")) for n, v in told])).alias("tier", "x"))
    best = documents.tiers(rows.select("doc_id", "tier", F.lit(0).alias("pos"), "x.answer"), ["doc_id"])
    return best.select("doc_id", "answer", F.element_at(F.array(*[F.lit(n) for n, _ in told]), F.col("tier") + 1).alias("tier"))


@query(r"SELECT p_partkey, regexp_replace(regexp_replace(regexp_replace(lower(p_name || ' ' || p_brand), '\\[a-z]+', '', 'g'), '[\s${}]', '', 'g'), '[^a-z0-9./-]', '', 'g') AS form FROM part")
def answer_compare(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", text.answer_form(F.concat_ws(" ", "p_name", "p_brand")).alias("form"))


@query()
def runaway_batch(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", guards.runaway("text").alias("runaway"))


@query("SELECT doc_id, source FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY sha256(coalesce(text, '')) ORDER BY doc_id) AS i FROM documents) q WHERE i = 1")
def hash_dedupe(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "source", F.coalesce("text", F.lit("")).alias("text"), F.lit(0).alias("all"))
    return documents.first_pages(docs, "all", "doc_id", "text").select("doc_id", "source")


@query("SELECT user_id, count(*) AS n, sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS k FROM events GROUP BY user_id")
def props_json(spark: SparkSession, d: str) -> DataFrame:
    values = files.json_map(table(spark, d, "events").select("user_id", "event_id", "props"), "props")
    return values.where("key = 'k'").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast("long")).alias("k"))


@query("""WITH t AS (SELECT o_orderstatus, o_totalprice, ntile(5) OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice DESC, o_orderkey) AS q FROM orders)
SELECT o_orderstatus, round(median(o_totalprice), 4) AS top_median, count(*) AS n FROM t WHERE q = 1 GROUP BY o_orderstatus""")
def topk_median(spark: SparkSession, d: str) -> DataFrame:
    return sequence.top_share_median(table(spark, d, "orders"), ["o_orderstatus"], "o_totalprice", "o_orderkey").withColumn("top_median", F.round("top_median", 4))


# a text's distinct word 5-grams; a shorter text is one gram
GRAMS = "SELECT {key}, unnest(list_distinct(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(list_slice(w, i, i + 4), ' ')))) AS g FROM (SELECT {key}, list_filter(string_split(" + NORM + ", ' '), lambda x: x <> '') AS w FROM {table}) q WHERE len(w) > 0"


@query(f"""WITH i AS ({GRAMS.format(key="item_id", table="benchmark")}), d AS ({GRAMS.format(key="doc_id", table="documents")}), m AS (SELECT item_id, count(*) AS m FROM i GROUP BY 1),
h AS (SELECT item_id, doc_id, count(*) AS n FROM d JOIN i ON d.g = i.g GROUP BY 1, 2)
SELECT item_id, doc_id, round(n / m, 4) AS share FROM h JOIN m USING (item_id) WHERE round(n / m, 4) >= 0.5""")
def bench_overlap(spark: SparkSession, d: str) -> DataFrame:
    """Share of a benchmark item's word 5-grams that a document holds; every 5-gram of both tables takes part."""
    grams = lambda df, key: df.select(key, F.explode(text.word_grams(F.coalesce("text", F.lit("")), 5)).alias("g"))
    items = grams(table(spark, d, "benchmark"), "item_id")
    size = items.groupBy("item_id").agg(F.count(F.lit(1)).alias("m"))
    # The items' grams as one bitmap of a fixed size: what it does not hold is dropped within the text's own array.
    known = sets.bitmap(items, "g")
    docs = table(spark, d, "documents").select("doc_id", text.word_grams(F.coalesce("text", F.lit("")), 5).alias("all"))
    few = docs.crossJoin(F.broadcast(known)).select("doc_id", F.explode(F.filter("all", lambda g: sets.may_hold(F.col("bitmap"), g))).alias("g"))
    hits = few.join(items, "g").groupBy("item_id", "doc_id").agg(F.count(F.lit(1)).alias("n"))
    return hits.join(size, "item_id").select("item_id", "doc_id", F.round(F.col("n") / F.col("m"), 4).alias("share")).where("share >= 0.5")


@query("""SELECT CAST(c_custkey AS VARCHAR) AS page_key, CASE WHEN c_custkey % 10 = 0 THEN 1536 ELSE 399 + CAST(list_sum(list_transform(range(1, 401), lambda i: length(CAST((c_custkey * 7919 + i * 104729) % 1000003 AS VARCHAR)))) AS BIGINT) END AS chars,
c_custkey % 10 = 0 AS runaway FROM customer""")
def stream_guard(spark: SparkSession, d: str) -> DataFrame:
    """Pages in chunks of 512 characters through the stream guard until all are read.  Every tenth page loops and is flagged
    at the third chunk; the others are read to their end."""
    words = F.transform(F.sequence(F.lit(1), F.lit(400)), lambda i: ((F.col("c_custkey") * 7919 + i * 104729) % 1000003).cast("string"))
    page = F.when(F.col("c_custkey") % 10 == 0, F.repeat(F.lit("the same words over and over again, once more from the start. "), F.lit(96))).otherwise(F.array_join(words, " "))
    pages = dealt(table(spark, d, "customer").select("c_custkey"), "c_custkey", 20_000).select(F.col("c_custkey").cast("string").alias("page_key"), F.regexp_extract_all(page, F.lit("(?s).{1,512}"), F.lit(0)).alias("parts"))
    # _outer: else a test whether there are parts would make all texts before they are dealt, in as few tasks as there are files
    chunks = pages.select("page_key", F.size("parts").alias("n"), F.posexplode_outer("parts").alias("seq", "chunk"))
    return guard.guard_files(chunks.withColumn("last", F.col("seq") == F.col("n") - 1))


@query(r"""SELECT conv_id, CAST(turn + 1 AS BIGINT) AS problem, trim(text, ' ') AS text FROM conversations""")
def seg_problems(spark: SparkSession, d: str) -> DataFrame:
    """Turns rendered as numbered problems of one document and segmented again."""
    parts = F.array_sort(F.collect_list(F.struct("turn", "line")))
    docs = numbered(spark, d).groupBy("conv_id").agg(F.array_join(F.transform(parts, lambda x: x["line"]), "\n").alias("text"))
    return segment.problems(docs, "conv_id")


@query(f"SELECT conv_id, turn, coalesce(lead(start) OVER (PARTITION BY conv_id ORDER BY turn), total) - start AS size FROM (SELECT conv_id, turn, sum(length(line)) OVER (PARTITION BY conv_id ORDER BY turn) - length(line) AS start, sum(length(line)) OVER (PARTITION BY conv_id) AS total FROM ({NUMBERED}) q) r")
def slice_between(spark: SparkSession, d: str) -> DataFrame:
    """Characters from each mark to the next, the last one to the end."""
    lines = numbered(spark, d).withColumn("total", F.sum(F.length("line")).over(Window.partitionBy("conv_id")))
    return sequence.spans(sequence.offsets(lines, ["conv_id"], "turn", F.length("line")), ["conv_id"], "turn", "start", "total").select("conv_id", "turn", "size")


@query("SELECT doc_id FROM documents WHERE NOT (doc_id % 3 = 0)")
def page_suppress(spark: SparkSession, d: str) -> DataFrame:
    """Pages of which cleaning leaves nothing though they had text are dropped; every third page is furniture only."""
    raw = F.when(F.col("doc_id") % 3 == 0, "Copyright 2019\nPage 3").when(F.col("doc_id") % 3 == 1, "").otherwise("text\nwww.example.org")
    rows = table(spark, d, "documents").select("doc_id", raw.alias("raw")).withColumn("clean", text.without_footers(F.col("raw")))
    return documents.suppressed(rows, "raw", "clean").select("doc_id")


@query("""SELECT e.event_id, (SELECT max_by(a.event_id, struct_pack(a.ts, a.event_id)) FROM events a WHERE a.event_type = 'error' AND CAST(a.ts AS DATE) = CAST(e.ts AS DATE) AND (a.user_id % 10) = (e.user_id % 10)
AND (a.user_id < e.user_id OR (a.user_id = e.user_id AND a.ts <= e.ts)) AND a.user_id = (SELECT max(c.user_id) FROM events c WHERE c.event_type = 'error' AND CAST(c.ts AS DATE) = CAST(e.ts AS DATE) AND (c.user_id % 10) = (e.user_id % 10) AND (c.user_id < e.user_id OR (c.user_id = e.user_id AND c.ts <= e.ts)))) AS owner FROM events e WHERE e.event_type <> 'error'""")
def asof_composite(spark: SparkSession, d: str) -> DataFrame:
    """As-of on an order of two columns, as boxes are ordered by column, then height."""
    events = table(spark, d, "events").select("event_id", "user_id", "ts", "event_type", F.to_date("ts").alias("day"), (F.col("user_id") % 10).alias("part"))
    marks = events.where("event_type = 'error'").withColumn("mark", F.col("event_id"))
    return sequence.as_of(events.where("event_type <> 'error'"), marks, ["day", "part"], ["user_id", "ts"], "mark").select("event_id", "owner")


@query("SELECT p_partkey, p_name || '{' || p_brand || '}' AS boxed FROM part")
def boxed_last(spark: SparkSession, d: str) -> DataFrame:
    """Content of the last balanced box, with braces of its own."""
    full = F.concat(F.lit(r"so \boxed{"), "p_type", F.lit(r"} or \boxed{"), "p_name", F.lit("{"), "p_brand", F.lit("}} is it {"))
    return table(spark, d, "part").select("p_partkey", text.last_boxed(full).alias("boxed"))


@query("SELECT o_orderkey, (o_custkey % 8) * 5 + o_orderkey % 5 + 1 AS number FROM orders")
def grid_markers(spark: SparkSession, d: str) -> DataFrame:
    """Grid labels 1A to 5H to running numbers."""
    label = F.concat((F.col("o_orderkey") % 5 + 1).cast("string"), F.char((F.col("o_custkey") % 8 + 65).cast("long")), F.lit(". find it"))
    return table(spark, d, "orders").select("o_orderkey", series("grid").marker(label)["number"].cast("long").alias("number"))


@query("SELECT o_orderkey, CASE WHEN o_custkey % 3 = 0 THEN 'label' WHEN o_custkey % 3 = 1 THEN 'box' ELSE 'prose' END AS tier, CAST(o_orderkey AS VARCHAR) AS answer FROM orders")
def extract_cascade(spark: SparkSession, d: str) -> DataFrame:
    """Answers from labelled, boxed and prose blocks."""
    k, kind = F.col("o_orderkey").cast("string"), F.col("o_custkey") % 3
    block = F.when(kind == 0, F.concat(F.lit("work\nAnswer: "), k, F.lit("\nmore"))).when(kind == 1, F.concat(F.lit(r"so \boxed{"), k, F.lit("} is it"))).otherwise(F.concat(F.lit("hence the answer is "), k, F.lit(". Done")))
    return table(spark, d, "orders").select("o_orderkey", text.answer_cascade(block).alias("a")).select("o_orderkey", "a.tier", "a.answer")


def _load() -> None:
    """The modules whose queries register themselves."""
    from quire.plans import answers, jobs, more, pages, rest, spatial, wide  # noqa: F401


def queries() -> dict[str, Query]:
    _load()
    return dict(_made)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_sql)
