"""Queries by name over the test tables, with the same in DuckDB's SQL where it can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import geometry, latex, text
from ..operators import dataset, layout, manifest, runs, seams, segments, vectors
from ..session import ship, spread
from ..sources import sinks

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    def add(f: Callable[[Callable[[str], DataFrame]], DataFrame]) -> Callable:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return f(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))

        QUERIES[f.__name__] = run
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def values(table: DataFrame, rows: list[tuple], schema: str) -> DataFrame:
    return table.sparkSession.createDataFrame(rows, schema)


# -- orders as pages: a page is an order, its lines are what recognizers find on pages -----------------------

#: A line of text for each line of an order, by its place: prose with a panel mark before it, a formula, a mark
#: note, prose with a formula in it, a misread formula, an answer option and its body.
LINE = r"""CASE rn % 7 WHEN 1 THEN '<<<nup:v' || (page % 2) || '>>>' || chr(10) || 'Order ' || page || ' goes on here with a line too long for any option before it'
    WHEN 2 THEN '$q_' || p || '=' || s || '$' WHEN 3 THEN (s % 4 + 1) || 'M+1A' WHEN 4 THEN '設 $x=' || p || '$' WHEN 5 THEN '\feac{1}{' || p || '}=y' WHEN 6 THEN 'B.' ELSE '-' || p END"""
PLACED = "SELECT l_orderkey AS page, l_partkey AS p, l_suppkey AS s, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS rn FROM lineitem"
ORDERS = f"o AS (SELECT *, {LINE} AS line FROM ({PLACED}))"


def order_lines(t) -> DataFrame:
    # Named before they are dealt, so that windows and groups of pages share one shuffle; what readers do with a page then takes
    # longer than its bytes tell, so pages are dealt to as many tasks as there are shuffle partitions.
    lines = spread(t("lineitem").select(F.col("l_orderkey").alias("page"), F.col("l_partkey").alias("p"), F.col("l_suppkey").alias("s"), "l_linenumber", "l_quantity", "l_extendedprice"), "page")
    placed = lines.select("page", "p", "s", F.row_number().over(Window.partitionBy("page").orderBy("l_linenumber", "p", "s", "l_quantity", "l_extendedprice")).alias("rn"))
    return placed.withColumn("line", F.expr(LINE.replace("'\\feac", "r'\\feac")))


def order_drafts(t) -> DataFrame:
    """Pages of documents of up to eight pages."""
    found = order_lines(t).groupBy("page").agg(F.array_sort(F.collect_list(F.struct("rn", "line"))).alias("x"))
    return found.select(F.floor(F.col("page") / 8).alias("doc_id"), F.col("page").alias("page_index"), F.array_join(F.transform("x", lambda x: x["line"]), "\n").alias("draft"))


#: What the segments of such pages have to be.
SEGMENTS = ORDERS + r""", n AS (SELECT *, lead(p) OVER (PARTITION BY page ORDER BY rn) AS np FROM o),
    g AS (SELECT page, rn, 0 AS sub, CASE rn % 7 WHEN 1 THEN 'prose' WHEN 3 THEN 'mark_note' WHEN 4 THEN 'prose' WHEN 6 THEN 'prose' ELSE 'math' END AS kind,
            CASE rn % 7 WHEN 1 THEN string_split(line, chr(10))[2] WHEN 2 THEN 'q_' || p || '=' || s WHEN 3 THEN line WHEN 4 THEN '設' WHEN 5 THEN '\frac{1}{' || p || '}=y' ELSE 'B.' || coalesce(' -' || np, '') END AS text,
            CASE WHEN rn % 7 = 5 THEN 'repaired' ELSE 'ok' END AS integrity FROM n WHERE rn % 7 <> 0
          UNION ALL SELECT page, rn, 1, 'math', 'x=' || p, 'ok' FROM n WHERE rn % 7 = 4),
    z AS (SELECT page // 8 AS doc_id, page, row_number() OVER (PARTITION BY page ORDER BY rn, sub) - 1 AS pos, kind, text, integrity, 'v' || (page % 2) AS version_id FROM g),
    r AS (SELECT *, CASE kind WHEN 'math' THEN '$' || text || '$' WHEN 'mark_note' THEN '(分註: ' || text || ')' ELSE text END AS shown FROM z)"""


def order_segments(t) -> DataFrame:
    return segments.check_segments(segments.segment(order_drafts(t), ["doc_id"]))


@query(f"WITH {SEGMENTS} SELECT page AS page_index, pos::INT AS pos, kind, text, integrity, version_id, 'p' || page || '_stitched' AS source_block_id FROM z")
def q_segments(t):
    return order_segments(t).select("page_index", "pos", "kind", "text", "integrity", "version_id", "source_block_id")


@query(f"WITH {SEGMENTS} SELECT kind, integrity, version_id, count(*) AS n, sum(length(text))::BIGINT AS chars FROM z GROUP BY ALL")
def line_kinds(t):
    return order_segments(t).groupBy("kind", "integrity", "version_id").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars"))


@query(f"WITH {SEGMENTS}, t AS (SELECT doc_id, page, string_agg(shown, chr(10) ORDER BY pos) AS t FROM r GROUP BY ALL) SELECT doc_id, string_agg(t, chr(10) || chr(10) ORDER BY page) AS text FROM t GROUP BY 1")
def render_documents(t):
    return segments.render_documents(order_segments(t), ["doc_id"])


@query(f"""WITH {SEGMENTS}, j AS (SELECT *, '{{"kind":"' || kind || '","text":"' || replace(text, '\\', '\\\\') || '","source_block_id":"p' || page || '_stitched","integrity":"' || integrity || '","version_id":"' || version_id || '"}}' AS j FROM z),
    u AS (SELECT doc_id, page, '{{"page_index":' || page || ',"segments":[' || string_agg(j, ',' ORDER BY pos) || ']}}' AS pj FROM j GROUP BY doc_id, page)
    SELECT doc_id, '{{"pages":[' || string_agg(pj, ',' ORDER BY page) || ']}}' AS page_ir FROM u GROUP BY doc_id""".replace("'\\', '\\\\'", r"'\', '\\'"))
def page_ir(t):
    return segments.page_ir(order_segments(t), ["doc_id"])


@query(f"WITH {ORDERS}, l AS (SELECT page, rn, unnest(string_split(line, chr(10))) AS line, generate_subscripts(string_split(line, chr(10)), 1) AS i FROM o) SELECT page, row_number() OVER (PARTITION BY page ORDER BY rn, i) - 1 AS pos, line FROM l")
def lines_explode(t):
    return order_drafts(t).select(F.col("page_index").alias("page"), F.posexplode(segments.linear_lines("draft")).alias("pos", "line")).withColumn("pos", F.col("pos").cast("bigint"))


@query("WITH c AS (SELECT p_partkey, unnest(['Part ' || p_partkey, 'size ' || p_size, 'b', 'c ' || p_partkey, 'd', 'e', 'f']) AS cell, generate_subscripts(range(7), 1) - 1 AS pos FROM part) SELECT p_partkey, pos, cell FROM c")
def table_cells(t):
    """Cells of a Markdown row with a break, of a LaTeX row, and of list items, without the markup around them."""
    key, size = F.col("p_partkey").cast("string"), F.col("p_size").cast("string")
    table = F.concat(F.lit("\\begin{table}[h]\n| Part "), key, F.lit(" | size "), size, F.lit("<br/>b |\n| --- | :---: |\n\\end{table}\\begin{tabular}{|c|c|}\\hline c "), key, F.lit(" & d \\\\ \\end{tabular}\n\\begin{itemize}\n\\item[1] e\n\\item f\n\\end{itemize}"))
    return spread(t("part"), "p_partkey").select("p_partkey", F.posexplode(segments.linear_lines(table)).alias("pos", "cell")).withColumn("pos", F.col("pos").cast("bigint"))


#: Blocks glued: an option and its body on one line, all else parted by blank lines, one mark at a page's begin.
GLUED = ORDERS + """, n AS (SELECT *, CASE WHEN rn % 7 = 1 THEN string_split(line, chr(10))[2] ELSE line END AS said, lead(line) OVER (PARTITION BY page ORDER BY rn) AS after FROM o)
    SELECT page, '<<<nup:v' || (page % 2) || '>>>' || chr(10) || chr(10) || string_agg(CASE WHEN rn % 7 = 6 THEN said || coalesce(' ' || after, '') ELSE said END, chr(10) || chr(10) ORDER BY rn) AS draft FROM n WHERE rn % 7 <> 0 GROUP BY page"""


@query(f"WITH {GLUED}")
def stitch_pages(t):
    said = F.when(F.col("rn") % 7 == 1, F.get(F.split("line", "\n"), F.lit(1))).otherwise(F.col("line"))
    blocks = order_lines(t).select("page", F.col("rn").alias("order"), said.alias("raw_text"), F.concat(F.lit("v"), (F.col("page") % 2).cast("string")).alias("version_id"))
    return segments.stitch(blocks, ["page"])


@query(f"WITH {ORDERS} SELECT page // 8 AS doc_id, page AS page_index, string_agg(CASE WHEN rn % 7 = 1 THEN CASE WHEN rn > 1 THEN chr(10) || chr(10) ELSE '' END || split_part(line, chr(10), 1) || chr(10) || chr(10) || upper(split_part(line, chr(10), 2)) ELSE chr(10) || upper(line) END, '' ORDER BY rn) AS draft FROM o GROUP BY ALL")
def polish_chunks(t):
    """Drafts through a model that writes capitals; marks stay where they are."""
    return segments.polish(order_drafts(t), ["doc_id", "page_index"], str.upper)


@query(r"""SELECT p_partkey, '\documentclass{a}' || chr(10) || '\usepackage{x}' || chr(10) || CASE WHEN p_size % 2 = 0 THEN '\usepackage{longtable,array}' || chr(10) ELSE '' END || '\begin{document}' || chr(10) || 'Part ' || p_partkey || chr(10) || chr(10) || '$\frac{' || p_partkey || '}{b}$ $$' || chr(10) || 'x^{2}' || chr(10) || '$$ '
        || CASE WHEN p_size % 2 = 0 THEN '\begin{longtable}' ELSE '\begin{tabular}' END || '{c}$y_{1}$\\{p；q}' || CASE WHEN p_size % 2 = 0 THEN '\end{longtable}' ELSE '\end{tabular}' END
        || CASE WHEN p_partkey % 3 = 0 THEN ' costs $5' || chr(10) || '% TODO: verify unpaired dollar' ELSE '' END || chr(10) || '\end{document}' AS tex FROM part""")
def sanitize_tex(t):
    key, even = F.col("p_partkey").cast("string"), F.col("p_size") % 2 == 0
    env = F.when(even, "longtable").otherwise("tabular")
    tex = F.concat(F.lit("<|im_start|>\\documentclass{a}\n\\usepackage{x}\n\\begin{document}\nPart "), key, F.lit("<br>$"), key, F.lit("/b$ $$x²$$ \\begin{"), env, F.lit("}{c}$$y₁$$<BR />{p \\\\ q}\\end{"), env, F.lit("}"), F.when(F.col("p_partkey") % 3 == 0, " costs $5\n").otherwise("\n"), F.lit("\\end{document}</box>"))
    # A part is few bytes, so readers would put its whole table in a few tasks.
    return spread(t("part"), "p_partkey").select("p_partkey", latex.sanitize_tex(tex).alias("tex"))


@query(r"""WITH f AS (SELECT p_partkey, CASE p_partkey % 7 WHEN 0 THEN '\feac{1}{' || p_partkey || '}' WHEN 1 THEN '\frac{a}{b}\\ ' || p_name WHEN 2 THEN 'x=1分' WHEN 3 THEN '1M' WHEN 4 THEN '\hline x' WHEN 5 THEN '\dfrac {a}{b \\ ' || p_partkey || '}' ELSE p_name END AS body FROM part)
    SELECT p_partkey, CASE p_partkey % 7 WHEN 0 THEN 'repaired' WHEN 6 THEN 'ok' ELSE 'fail' END AS status, replace(body, '\feac', '\frac') AS body,
        CASE p_partkey % 7 WHEN 0 THEN 'repaired typo \feac -> \frac' WHEN 1 THEN '\\\\ near frac (mid-formula break)' WHEN 2 THEN 'CJK fen in math body' WHEN 3 THEN 'bare 1M/1A pattern in math body' WHEN 4 THEN 'tabular/table chrome in math body' WHEN 5 THEN '\\\\ inside frac/dfrac/tfrac argument' ELSE '' END AS warnings FROM f""")
def integrity_status(t):
    body = F.expr(r"CASE p_partkey % 7 WHEN 0 THEN concat(r'\feac{1}{', p_partkey, '}') WHEN 1 THEN concat(r'\frac{a}{b}\\ ', p_name) WHEN 2 THEN 'x=1分' WHEN 3 THEN '1M' WHEN 4 THEN r'\hline x' WHEN 5 THEN concat(r'\dfrac {a}{b \\ ', p_partkey, '}') ELSE p_name END")
    return t("part").select("p_partkey", latex.integrity(body).alias("c")).select("p_partkey", "c.status", "c.body", F.array_join("c.warnings", "; ").alias("warnings"))


@query(r"""SELECT p_partkey, '\frac{' || p_partkey || ' + b}{c} - d = x^{2} \frac{7}{' || p_size || '}' AS t FROM part""")
def slash_fractions(t):
    body = F.concat(F.lit(" "), F.col("p_partkey").cast("string"), F.lit(" + b / c - d = x² 7/"), F.col("p_size").cast("string"))
    return spread(t("part"), "p_partkey").select("p_partkey", latex.text_udf(latex.fix_math)(body).alias("t"))


# -- documents as page drafts: whole texts with a formula, a mark note and a panel mark behind them --------

DRAFT = r"'<<<nup:v' || (doc_id % 2) || '>>>' || chr(10) || text || chr(10) || '$x_' || doc_id || '=' || (doc_id % 7) || '$' || chr(10) || (doc_id % 3 + 1) || 'M+1A'"


def drafts(t) -> DataFrame:
    return t("documents").select("doc_id", (F.col("doc_id") % 5).cast("int").alias("page_index"), F.expr(DRAFT).alias("draft"))


LINES = f"l AS (SELECT doc_id, unnest(string_split(d, chr(10))) AS line, generate_subscripts(string_split(d, chr(10)), 1) AS line_no FROM (SELECT doc_id, {DRAFT} AS d FROM documents))"


def draft_lines(t) -> DataFrame:
    found = drafts(t).select("doc_id", F.posexplode(text.lines("draft")).alias("i", "line"))
    return found.select("doc_id", (F.col("i") + 1).cast("bigint").alias("line_no"), "line")


KIND = r"CASE WHEN regexp_full_match(s, '(?i)\d+\s*[MA](\s*\+\s*\d+\s*[MA])*') THEN 'mark_note' WHEN s LIKE '%=%' OR s LIKE '%^%' OR s LIKE '%\_%' ESCAPE '\' THEN 'math' ELSE 'prose' END"


def blocks_of_lines(t) -> DataFrame:
    return draft_lines(t).where("not startswith(line, '<<<')").select(F.floor(F.col("doc_id") / 4).alias("page"), (F.col("doc_id") * 100000 + F.col("line_no")).alias("order"), F.col("line").alias("raw_text"), F.concat(F.lit("v"), (F.col("doc_id") % 3).cast("string")).alias("version_id"))


@query(rf"""WITH {LINES}, b AS (SELECT doc_id // 4 AS page, doc_id * 100000 + line_no AS "order", trim(line, ' ') AS s, 'v' || (doc_id % 3) AS v FROM l WHERE NOT starts_with(line, '<<<')),
    c AS (SELECT *, lag(v) OVER (PARTITION BY page ORDER BY "order") AS before FROM b WHERE s <> '')
    SELECT page, "order", CASE WHEN before IS DISTINCT FROM v THEN '<<<nup:' || v || '>>>' END AS mark, length(s) AS chars FROM c""")
def version_marks(t):
    return segments.version_marks(blocks_of_lines(t), ["page"]).select("page", "order", "mark", F.length("raw_text").cast("bigint").alias("chars"))


@query(f"SELECT doc_id // 4 AS grp, string_agg({DRAFT}, chr(10) || chr(10) ORDER BY doc_id) AS draft FROM documents GROUP BY 1")
def document_drafts(t):
    return segments.document_draft(drafts(t).select(F.floor(F.col("doc_id") / 4).alias("grp"), F.col("doc_id").alias("page_index"), "draft"), ["grp"])


# -- boxes: order lines of a part as blocks of a page ------------------------------------------------------

BOX = "l_partkey AS page, l_orderkey * 10 + l_linenumber AS id, (l_suppkey % 2) * 220 + l_linenumber * 3.0 AS x1, l_quantity * 10.0 AS y1, (l_suppkey % 2) * 220 + l_linenumber * 3.0 + 90 + l_quantity AS x2, l_quantity * 10.0 + 20 AS y2"


def boxes(t) -> DataFrame:
    return t("lineitem").selectExpr(*[f"cast({c.rpartition(' AS ')[0]} as {'bigint' if c.endswith(('page', 'id')) else 'double'}) as {c.rpartition(' AS ')[2]}" for c in BOX.split(", ")])


GATE = f"""b AS (SELECT {BOX} FROM lineitem),
    w AS (SELECT *, max(x2) OVER p - min(x1) OVER p AS width, min(x1) OVER p + (max(x2) OVER p - min(x1) OVER p) / 2 AS mid, (x1 + x2) / 2 AS c, count(*) OVER p AS n FROM b WINDOW p AS (PARTITION BY page)),
    m AS (SELECT *, x2 - x1 < 0.45 * width AS narrow FROM w), k AS (SELECT *, count(*) FILTER (narrow) OVER (PARTITION BY page) < 8 OR narrow AS counts FROM m),
    g AS (SELECT page, any_value(n) >= 8 AND any_value(width) > 1 AND count(*) FILTER (counts AND c < mid) >= 3 AND count(*) FILTER (counts AND c >= mid) >= 3
        AND min(x1) FILTER (counts AND c >= mid) - max(x2) FILTER (counts AND c < mid) >= 0.03 * any_value(width)
        AND avg(c) FILTER (counts AND c >= mid) - avg(c) FILTER (counts AND c < mid) >= 0.25 * any_value(width) AS two FROM k GROUP BY page)"""


@query(f"""WITH {GATE} SELECT page, id, CASE WHEN coalesce(two, false) THEN 'column_major' ELSE 'row_major' END AS reading_order,
    row_number() OVER (PARTITION BY page ORDER BY CASE WHEN coalesce(two, false) AND c >= mid THEN 1 ELSE 0 END, y1, x1, id) - 1 AS "order" FROM k JOIN g USING (page)""")
def reading_order(t):
    rows = boxes(t).withColumn("order", F.col("id"))
    return layout.reading_order(rows, ["page"]).select("page", "id", "reading_order", F.col("order").cast("bigint").alias("order"))


@query(f"WITH {GATE} SELECT coalesce(two, false) AS two_columns, count(*) AS pages FROM g GROUP BY 1")
def two_column_pages(t):
    rows = layout.reading_order(boxes(t).withColumn("order", F.col("id")), ["page"]).select("page", "reading_order").distinct()
    return rows.groupBy((F.col("reading_order") == "column_major").alias("two_columns")).agg(F.count(F.lit(1)).alias("pages"))


LABELS = "Text,Section-header,List-group,Equation,Picture,Page-footer,Table,plain text,paragraph title,display_formula,isolate_formula"


@query(f"""WITH l AS (SELECT string_split('{LABELS}', ',')[l_linenumber + (l_partkey % 5)::INT] AS label FROM lineitem)
    SELECT label, CASE regexp_replace(lower(label), '[^a-z]', '', 'g') WHEN 'text' THEN 'text' WHEN 'sectionheader' THEN 'title' WHEN 'listgroup' THEN 'list' WHEN 'equation' THEN 'equation' WHEN 'picture' THEN 'figure' WHEN 'table' THEN 'table' ELSE 'other' END AS surya,
    CASE regexp_replace(lower(label), '[^a-z]', '', 'g') WHEN 'text' THEN 'text' WHEN 'sectionheader' THEN 'title' WHEN 'equation' THEN 'equation' WHEN 'table' THEN 'table' WHEN 'plaintext' THEN 'text' WHEN 'isolateformula' THEN 'formula' ELSE 'other' END AS doclayout,
    CASE replace(lower(label), ' ', '_') WHEN 'text' THEN 'text' WHEN 'plain_text' THEN 'text' WHEN 'paragraph_title' THEN 'title' WHEN 'table' THEN 'table' WHEN 'display_formula' THEN 'formula' WHEN 'equation' THEN 'equation' WHEN 'picture' THEN 'figure' ELSE 'other' END AS mineru, count(*) AS n
    FROM l GROUP BY ALL""")
def label_map(t):
    label = F.element_at(F.split(F.lit(LABELS), ","), (F.col("l_linenumber") + F.col("l_partkey") % 5).cast("int"))
    counts = t("lineitem").groupBy(label.alias("label")).agg(F.count(F.lit(1)).alias("n"))
    return counts.select("label", *[layout.block_type("label", d).alias(d) for d in ("surya", "doclayout", "mineru")], "n")


@query("""SELECT l_orderkey, l_linenumber, CASE WHEN k IN ('formula', 'equation') THEN 'math' WHEN k IN ('text', 'title', 'list') THEN 'text' WHEN k IN ('table', 'figure') THEN k ELSE 'none' END AS route, k IN ('figure', 'other') AS skipped
    FROM (SELECT *, string_split('text,title,list,formula,equation,table,figure,other', ',')[(l_partkey % 8)::INT + 1] AS k FROM lineitem)""")
def route_blocks(t):
    kind = F.element_at(F.split(F.lit("text,title,list,formula,equation,table,figure,other"), ","), (F.col("l_partkey") % 8 + 1).cast("int"))
    return layout.route(t("lineitem").withColumn("block_type", kind)).select("l_orderkey", "l_linenumber", "route", "skipped")


@query(f"WITH b AS (SELECT {BOX} FROM lineitem) SELECT id, greatest(0.0, least(x1, 299.0))::DOUBLE AS x1, greatest(0.0, least(y1, 399.0))::DOUBLE AS y1, greatest(1.0, least(x2, 300.0))::DOUBLE AS x2, greatest(1.0, least(y2, 400.0))::DOUBLE AS y2 FROM b")
def bbox_clamp(t):
    b = geometry.clamp(geometry.box(*[F.col(c) for c in ("x1", "y1", "x2", "y2")]), F.lit(300), F.lit(400))
    return boxes(t).select("id", b.alias("b")).select("id", "b.*")


@query(f"WITH b AS (SELECT {BOX} FROM lineitem) SELECT id, (x1 + CASE WHEN page % 2 = 1 THEN 0.5 * 800 ELSE 0 END)::DOUBLE AS x1, y1::DOUBLE AS y1, (x2 + CASE WHEN page % 2 = 1 THEN 0.5 * 800 ELSE 0 END)::DOUBLE AS x2, y2::DOUBLE AS y2 FROM b")
def panel_remap(t):
    panel = F.get(geometry.panel_boxes(F.lit("2_lr"), F.lit(0.0), F.lit(0.5)), (F.col("page") % 2).cast("int"))["box"]
    b = geometry.remap(geometry.box(*[F.col(c) for c in ("x1", "y1", "x2", "y2")]), panel, F.lit(800.0), F.lit(600.0))
    return boxes(t).select("id", b.alias("b")).select("id", "b.*")


# -- text functions ----------------------------------------------------------------------------------------


@query(r"SELECT doc_id, regexp_replace(regexp_replace(d, '(?s)\\\((.+?)\\\)', '$\1$', 'g'), '(?s)\\\[(.+?)\\\]', '$$\1$$', 'g') AS t FROM (SELECT doc_id, text || ' \(x_' || doc_id || '\) \[y\]' AS d FROM documents)")
def dollar_math(t):
    return t("documents").select("doc_id", text.dollar_math(F.concat("text", F.lit(r" \(x_"), "doc_id", F.lit(r"\) \[y\]"))).alias("t"))


@query(r"SELECT doc_id, trim(regexp_replace(regexp_replace('<|im_end|> <BOX>' || text || '</box> ', '<\|[^|>]+\|>', '', 'g'), '(?i)</?box>', '', 'g'), ' ' || chr(10)) AS t FROM documents")
def model_junk(t):
    return t("documents").select("doc_id", text.strip_model_junk(F.concat(F.lit("<|im_end|> <BOX>"), "text", F.lit("</box> "))).alias("t"))


@query(rf"""WITH {LINES}, h AS (SELECT doc_id, line_no, sha1(from_hex('{vectors.NAMESPACE}') || encode(concat_ws('|', doc_id, 0, 'p0_s' || line_no, '{vectors.MODEL}', '{vectors.VERSION}'))) AS h FROM l)
    SELECT doc_id, line_no::BIGINT AS line_no, h[1:8] || '-' || h[9:12] || '-5' || h[14:16] || '-' || substr('89ab89ab89ab89ab', ('0x' || h[17])::INT + 1, 1) || h[18:20] || '-' || h[21:32] AS id FROM h""")
def point_ids(t):
    return draft_lines(t).select("doc_id", "line_no", vectors.point_id("doc_id", F.lit(0), F.concat(F.lit("p0_s"), F.col("line_no").cast("string"))).alias("id"))


@query(r"""SELECT doc_id, CASE WHEN length(s) < 8 THEN NULL WHEN cjk / greatest(cjk + lat, 1) >= 0.4 THEN 'zh' WHEN lat / greatest(cjk + lat, 1) >= 0.6 THEN 'en' END AS semantic
    FROM (SELECT doc_id, trim(text, ' ' || chr(10)) AS s, len(regexp_extract_all(text, '[A-Za-z]')) AS lat, len(regexp_extract_all(text, '[\x{4e00}-\x{9fff}]')) AS cjk FROM documents)""")
def lang_guess(t):
    return t("documents").select("doc_id", text.guess_language("text").alias("semantic"))


# -- chat rows from conversations --------------------------------------------------------------------------


def chat(t) -> DataFrame:
    status = F.element_at(F.split(F.lit("approved,rejected,draft,extract_failed, approved "), ","), (F.col("conv_id") % 5 + 1).cast("int"))
    found = t("conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("x"))
    message = lambda m: F.struct(m["role"].alias("role"), F.when((m["role"] == "assistant") & (F.col("conv_id") % 3 == 0), F.concat(F.lit("[待補解答] "), m["text"])).otherwise(m["text"]).alias("content"))
    page = (F.col("conv_id") / 10).cast("int")
    qid = F.when(F.col("conv_id") % 4 == 0, F.concat((F.col("conv_id") / 4).cast("int").cast("string"), F.lit("(a)"))).when(F.col("conv_id") % 4 == 1, F.lit("(b)")).otherwise((F.col("conv_id") / 3).cast("int").cast("string"))
    source = F.struct(F.lit("exam.pdf").alias("pdf"), page.alias("page"), qid.alias("question_id"), F.lit("p.png").alias("image"), F.lit("zh").alias("lang"))
    return found.select(F.col("conv_id").alias("row_no"), F.concat(F.lit("r"), F.col("conv_id").cast("string")).alias("id"), status.alias("status"), F.when(F.col("conv_id") % 7 == 0, "en").alias("language"), F.lit(None).cast("string").alias("notes"), (F.col("conv_id") % 2 == 0).alias("has_figure"), F.when(F.col("conv_id") % 2 == 0, "fig").alias("figure_description"), source.alias("source"), F.transform("x", message).alias("messages"))


CHAT = """c AS (SELECT conv_id, turn, role, CASE WHEN role = 'assistant' AND conv_id % 3 = 0 THEN '[待補解答] ' || text ELSE text END AS content FROM conversations),
    r AS (SELECT conv_id AS row_no, string_split('approved,rejected,draft,extract_failed, approved ', ',')[(conv_id % 5)::INT + 1] AS status0, count(*) AS n,
        bool_or(role = 'user') AS has_user, bool_or(role = 'assistant') AS has_assistant, count(*) FILTER (trim(content, ' ' || chr(10)) = '') AS n_blank,
        coalesce(trim(arg_min(content, turn) FILTER (role = 'assistant'), ' ' || chr(10)), '') AS answer, coalesce(trim(arg_min(content, turn) FILTER (role = 'user'), ' ' || chr(10)), '') AS question FROM c GROUP BY conv_id),
    s AS (SELECT *, trim(status0) AS status, answer = '' OR contains(answer, '[待補解答]') AS open FROM r),
    d AS (SELECT *, CASE WHEN status = 'rejected' THEN 'rejected' WHEN status <> 'approved' OR open OR n < 2 OR NOT has_user OR NOT has_assistant OR n_blank > 0 THEN 'remain' ELSE 'promoted' END AS disposition FROM s)"""


@query(f"WITH {CHAT} SELECT row_no, question, answer, open FROM s")
def first_role_text(t):
    return chat(t).select("row_no", dataset.first_text("messages", "user").alias("question"), dataset.first_text("messages", "assistant").alias("answer"), dataset.is_open("messages").alias("open"))


@query(f"""WITH {CHAT} SELECT CASE WHEN status IN ('approved', 'extract_failed') THEN status ELSE 'pending' END AS bucket, count(*) AS n, count(*) FILTER (open) AS open FROM s GROUP BY 1""")
def status_counts(t):
    return dataset.status_counts(chat(t))


@query(f"WITH {CHAT} SELECT row_no, disposition FROM d")
def promote_disposition(t):
    return dataset.disposition(chat(t)).select("row_no", "disposition")


@query(f"WITH {CHAT} SELECT row_no, status FROM d WHERE disposition = 'rejected'")
def rejected_rows(t):
    return dataset.promote(chat(t))["rejected"].select("row_no", text.strip("status").alias("status"))


@query(f"WITH {CHAT} SELECT row_no, status FROM d WHERE disposition = 'remain'")
def remain_rows(t):
    return dataset.promote(chat(t))["remain"].select("row_no", text.strip("status").alias("status"))


@query("""SELECT conv_id AS row_no, rn <= greatest(1, floor(n * 0.1)) AS is_eval FROM (SELECT conv_id, row_number() OVER (ORDER BY md5(conv_id || ':42')) AS rn, count(*) OVER () AS n FROM (SELECT DISTINCT conv_id FROM conversations))""")
def train_eval_split(t):
    return dataset.split_eval(chat(t).select("row_no"), "row_no")


@query(f"WITH {CHAT} SELECT count(*) FILTER (question <> '' AND length(question) >= 8) AS written, count(*) FILTER (NOT (question <> '' AND length(question) >= 8)) AS skipped FROM s")
def junk_filter(t):
    return dataset.export_counts(chat(t))


QID = "CASE conv_id % 4 WHEN 0 THEN (conv_id // 4) || '(a)' WHEN 1 THEN '(b)' ELSE (conv_id // 3) || '' END"


@query(f"""WITH {CHAT} SELECT row_no, '% id=r' || row_no || '  page=' || (row_no // 10) || '  exam_q=' || {QID.replace("conv_id", "row_no")} || '  has_figure=' || CASE WHEN row_no % 2 = 0 THEN 'True' ELSE 'False' END
    || '  image=p.png' || chr(10) || '題目：' || chr(10) || question || CASE WHEN row_no % 2 = 0 THEN chr(10) || chr(10) || '[圖] fig' ELSE '' END || chr(10) AS block FROM s WHERE length(question) >= 8""")
def question_blocks(t):
    return dataset.question_blocks(chat(t)).select("row_no", "block")


@query(f"""SELECT row_no, nullif(CASE WHEN q LIKE '(%' THEN '' ELSE regexp_extract(q, '^\\d+') END, '') AS main, CASE WHEN q LIKE '%(%' THEN lower(regexp_extract(q, '\\((.)\\)', 1)) END AS sub
    FROM (SELECT DISTINCT conv_id AS row_no, {QID} AS q FROM conversations)""".replace("\\\\", "\\"))
def parse_qid(t):
    return chat(t).select("row_no", dataset.parse_question_id("source.question_id").alias("q")).select("row_no", "q.main", "q.sub")


# -- jobs, points and runs ---------------------------------------------------------------------------------


def jobs(t) -> DataFrame:
    path = F.concat(F.when(F.col("doc_id") % 10 == 3, "../").otherwise(""), F.lit("d"), F.col("doc_id").cast("string"), F.lit(".txt"))
    sha = F.when(F.col("doc_id") % 10 == 5, F.lit("XYZ")).otherwise(F.sha2("text", 256))
    item = F.struct(path.alias("path"), sha.alias("sha256"))
    items = F.when(F.col("doc_id") % 10 == 7, F.array(item, item)).otherwise(F.array(item))
    job = F.struct(F.when(F.col("doc_id") % 10 == 1, 2).otherwise(1).alias("done_schema"), F.concat(F.lit("job-"), "doc_id").alias("job_id"), F.concat(F.lit("d"), "doc_id").alias("doc_id"), F.lit("2026-01-01T00:00:00Z").alias("created_at"), items.alias("artifacts"), F.lit("1").alias("ocr_pipeline_version"), F.when(F.col("doc_id") % 10 == 9, "x").alias("extra"))
    return t("documents").select("doc_id", F.to_json(job).alias("manifest"))


@query("""SELECT doc_id, CASE doc_id % 10 WHEN 1 THEN 'done_schema must be 1' WHEN 3 THEN 'unsafe artifact path; missing text artifact' WHEN 5 THEN 'bad sha256' WHEN 7 THEN 'duplicate artifact path' WHEN 9 THEN 'unknown fields: extra' ELSE '' END AS errors FROM documents""")
def manifest_errors(t):
    return jobs(t).select("doc_id", F.array_join(manifest.errors("manifest"), "; ").alias("errors"))


@query("""SELECT 'job-' || doc_id AS job_id, CASE WHEN doc_id % 10 = 3 THEN '../' ELSE '' END || 'd' || doc_id || '.txt' AS path, CASE WHEN doc_id % 4 = 0 THEN 'missing' ELSE 'mismatch' END AS problem
    FROM documents WHERE doc_id % 4 = 0 OR doc_id % 10 = 5 OR doc_id % 6 = 1""")
def hash_mismatch(t):
    listed = manifest.artifacts(jobs(t)).distinct()
    where = F.concat(F.when(F.col("doc_id") % 10 == 3, "../").otherwise(""), F.lit("d"), F.col("doc_id").cast("string"), F.lit(".txt"))
    disk = t("documents").where("doc_id % 4 <> 0").select(F.concat(F.lit("job-"), "doc_id").alias("job_id"), where.alias("path"), F.when(F.col("doc_id") % 6 == 1, F.sha2(F.lit("other"), 256)).otherwise(F.sha2("text", 256)).alias("sha256"))
    return manifest.against_disk(listed, disk)


@query("SELECT 'job-' || doc_id AS job_id, 'd' || doc_id || '.tex' AS path FROM documents UNION ALL SELECT 'job-' || doc_id, 'figures/f.png' FROM documents WHERE doc_id % 2 = 0")
def unlisted_files(t):
    job, d = F.concat(F.lit("job-"), "doc_id").alias("job_id"), t("documents")
    disk = d.select(job, F.concat(F.lit("d"), "doc_id", F.lit(".tex")).alias("path")).union(d.where("doc_id % 2 = 0").select(job, F.lit("figures/f.png"))).union(d.select(job, F.concat(F.lit("d"), "doc_id", F.lit(".log"))))
    return manifest.unlisted(manifest.artifacts(jobs(t)), disk)


@query("""SELECT doc_id, 0 AS page, 'p0_s' || (i - 1) AS segment_id, 'prose' AS kind, trim(s, ' ') AS text FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS s, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents WHERE doc_id % 3 <> 0) WHERE trim(s, ' ') <> ''
    UNION ALL SELECT doc_id, 0, 'p0_all', 'prose', text FROM documents WHERE doc_id % 3 = 0""")
def ingest_segments(t):
    d = t("documents")
    segment = lambda x: F.struct(F.lit("prose").alias("kind"), x.alias("text"), F.lit(None).cast("string").alias("crop_relpath"))
    irs = d.where("doc_id % 3 <> 0").select("doc_id", F.array(F.struct(F.lit(0).alias("page_index"), F.transform(F.split("text", "\n", -1), segment).alias("segments"))).alias("pages"))
    return vectors.ingest_segments(irs, d.select("doc_id", "text")).select("doc_id", "page", "segment_id", "kind", "text")


def point_table(t) -> tuple[DataFrame, DataFrame]:
    e = t("embeddings").select(F.col("vec_id").alias("id"), (F.col("vec_id") % 20).alias("doc_id"), "label")
    return e, e.where("id % 3 = 0").select((F.col("id") + F.when(F.col("id") % 2 == 0, 0).otherwise(1000000)).alias("id"), "doc_id", (F.col("label") + 100).alias("label"))


NEW = "n AS (SELECT vec_id + CASE WHEN vec_id % 2 = 0 THEN 0 ELSE 1000000 END AS id, vec_id % 20 AS doc_id, label + 100 AS label FROM embeddings WHERE vec_id % 3 = 0)"


@query(f"WITH {NEW} SELECT vec_id AS id, vec_id % 20 AS doc_id, label FROM embeddings WHERE vec_id NOT IN (SELECT id FROM n) UNION ALL SELECT * FROM n")
def vector_upsert(t):
    return vectors.upsert(*point_table(t))


@query(f"WITH {NEW} SELECT vec_id AS id, vec_id % 20 AS doc_id, label FROM embeddings WHERE vec_id NOT IN (SELECT id FROM n) AND vec_id % 20 NOT IN (SELECT doc_id FROM n) UNION ALL SELECT * FROM n")
def vector_reindex(t):
    return vectors.reindex(*point_table(t))


@query("SELECT count(*) AS n FROM embeddings WHERE embedding IS NULL OR len(embedding) <> 64")
def vector_dim_check(t):
    return vectors.wrong_size(t("embeddings"), 64, "embedding").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH s AS (SELECT q.vec_id AS query_id, e.vec_id AS id, list_cosine_similarity(q.embedding::DOUBLE[], e.embedding::DOUBLE[]) AS s FROM embeddings q, embeddings e WHERE q.vec_id % 20 = 0 AND e.vec_id <> q.vec_id)
    SELECT query_id, rank::INT AS rank, id, round(s, 5) AS score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, id) AS rank FROM s) WHERE rank <= 5""")
def vector_topk(t):
    e = t("embeddings").withColumnRenamed("vec_id", "id")
    return vectors.top_k(e.where("id % 20 = 0"), e, 5, "id", "embedding").withColumn("score", F.round("score", 5))


@query("""SELECT doc_id, 0 AS page_index, 0 AS pos, 'prose' AS kind FROM documents UNION ALL SELECT doc_id, 0, 1, 'figure' FROM documents WHERE doc_id % 2 = 0 UNION ALL SELECT doc_id, 2, 0, 'figure' FROM documents WHERE doc_id % 2 = 1""")
def figure_append(t):
    d = t("documents")
    base = d.select("doc_id", F.lit(0).alias("page_index"), F.lit(0).alias("pos"), F.lit("prose").alias("kind"))
    figures = d.select("doc_id", F.when(F.col("doc_id") % 2 == 0, "p009_b001").otherwise("p002_b777").alias("source_block_id"), F.lit(1).alias("figure_no"))
    blocks = d.select("doc_id", F.lit("p009_b001").alias("block_id"), F.lit(0).alias("page"), F.lit(1).alias("order"))
    return segments.append_figures(base, figures, blocks, ["doc_id"])


@query("""WITH w AS (SELECT user_id, trim(event_type) AS m, min(event_id) AS seq FROM events GROUP BY ALL) SELECT user_id, string_agg(m, '; ' ORDER BY seq, m) AS warnings FROM w WHERE m <> '' GROUP BY 1""")
def warnings_dedup(t):
    found = runs.distinct_warnings(t("events"), ["user_id"], "event_id", "event_type")
    return found.select("user_id", F.array_join("warnings", "; ").alias("warnings"))


@query("SELECT user_id % 10 AS run_id, event_type AS stage, round(sum(value), 4) AS seconds FROM events GROUP BY ALL")
def stage_timings(t):
    rows = t("events").select((F.col("user_id") % 10).alias("run_id"), F.col("event_type").alias("stage"), F.col("value").alias("seconds"))
    return runs.stage_seconds(rows).withColumn("seconds", F.round("seconds", 4))


@query(f"""WITH {LINES} SELECT doc_id, line_no::BIGINT AS line_no, substr('[demo] ' || line, 1, 500) AS text FROM l WHERE line_no <= 8""")
def demo_slice(t):
    cut = sinks.demo_slice

    rows = draft_lines(t).select("doc_id", F.lit(3).alias("page_index"), (F.col("line_no") - 1).alias("pos"), F.col("line").alias("text"))
    return cut(rows, ["doc_id"]).select("doc_id", (F.col("pos") + 1).alias("line_no"), "text")


@query("SELECT l_partkey, l_orderkey, l_linenumber FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey * 10 + l_linenumber) <= 3")
def page_limit(t):
    rows = t("lineitem").select("l_partkey", "l_orderkey", "l_linenumber", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("at"))
    return runs.page_limit(rows, ["l_partkey"], 3, "at").drop("at")


@query("SELECT count(*) AS n, count(*) FILTER (toxic = 0) AS passed, round(avg(quality::DOUBLE), 6) AS quality_rate, round(avg(toxic::DOUBLE), 6) AS toxic_rate FROM labels")
def error_rates(t):
    return runs.failure_rates(t("labels").withColumn("overall", F.when(F.col("toxic") == 0, "pass").otherwise("fail")), ["quality", "toxic"])


@query("SELECT doc_id, coalesce(nullif(CASE WHEN doc_id % 3 = 0 THEN text ELSE '' END, ''), nullif(CASE WHEN doc_id % 3 = 1 THEN lang END, ''), source) AS t FROM documents")
def page_text(t):
    d = t("documents").select("doc_id", F.when(F.col("doc_id") % 3 == 0, F.col("text")).otherwise("").alias("tex_body"), F.when(F.col("doc_id") % 3 == 1, F.col("lang")).alias("txt"), F.col("source").alias("draft"))
    return d.select("doc_id", runs.page_text().alias("t"))


# -- names, replies and sizes ------------------------------------------------------------------------------


@query("SELECT p_partkey, (p_size * 28 * 2)::BIGINT AS budget FROM part")
def int_products(t):
    return t("part").select("p_partkey", text.int_product(F.concat(F.col("p_size").cast("string"), F.lit("*28 * 2")), 7).alias("budget"))


@query("""WITH s AS (SELECT p_partkey, p_size * 40 AS w, (p_partkey % 50 + 1) * 30 AS h FROM part), d AS (SELECT *, sqrt(500000.0::DOUBLE / (w * h)) AS k FROM s),
    m AS (SELECT p_partkey, CASE WHEN w * h > 500000 THEN greatest(1, floor(w * k)::INT) ELSE w END AS w, CASE WHEN w * h > 500000 THEN greatest(1, floor(h * k)::INT) ELSE h END AS h FROM d), u AS (SELECT *, sqrt(20000.0::DOUBLE / (w * h)) AS k FROM m)
    SELECT p_partkey, (CASE WHEN w * h < 20000 THEN greatest(1, floor(w * k)::INT) ELSE w END)::INT AS width, (CASE WHEN w * h < 20000 THEN greatest(1, floor(h * k)::INT) ELSE h END)::INT AS height FROM u""")
def pixel_budgets(t):
    size = geometry.pixel_budget(F.col("p_size") * 40, (F.col("p_partkey") % 50 + 1) * 30, 500000, 20000)
    return t("part").select("p_partkey", size.alias("s")).select("p_partkey", "s.*")


@query(f"""WITH b AS (SELECT {BOX} FROM lineitem), c AS (SELECT id, trunc(greatest(0, least(x1, 299)))::INT AS x1, trunc(greatest(0, least(y1, 399)))::INT AS y1, trunc(greatest(1, least(x2, 300)))::INT AS x2, trunc(greatest(1, least(y2, 400)))::INT AS y2 FROM b)
    SELECT id, greatest(0, x1 - 2) AS x1, greatest(0, y1 - 2) AS y1, least(300, greatest(x2, x1 + 1) + 2) AS x2, least(400, greatest(y2, y1 + 1) + 2) AS y2 FROM c""")
def crop_boxes(t):
    b = geometry.crop_box(geometry.box(*[F.col(c) for c in ("x1", "y1", "x2", "y2")]), F.lit(300), F.lit(400))
    return boxes(t).select("id", b.alias("b")).select("id", "b.*")


@query("""SELECT p_partkey, 'v' || i AS version_id, CASE WHEN i = 0 THEN 0.0 ELSE round(s, 6) END AS x1, CASE WHEN i = 0 THEN round(s, 6) ELSE 1.0 END AS x2
    FROM (SELECT p_partkey, greatest(0.25, least(0.75, p_size / 50.0)) AS s FROM part), (VALUES (0), (1)) v(i)""")
def panel_boxes(t):
    made = geometry.panel_boxes(F.lit("2_lr"), F.lit(0.0), F.col("p_size") / 50)
    return t("part").select("p_partkey", F.explode(made).alias("p")).select("p_partkey", "p.version_id", F.round("p.box.x1", 6).alias("x1"), F.round("p.box.x2", 6).alias("x2"))


@query("""SELECT l_partkey AS page, l_orderkey AS src, printf('p%03d_b%03d', l_partkey, row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey * 10 + l_linenumber) - 1) AS block_id FROM lineitem WHERE l_linenumber <> 3""")
def detections(t):
    rows = t("lineitem").select(F.col("l_partkey").alias("page"), F.col("l_orderkey").alias("src"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("index"), F.lit("text").alias("label"), F.when(F.col("l_linenumber") == 3, F.array(F.lit(0.0))).otherwise(F.array(*[F.lit(0.0)] * 4)).alias("bbox"))
    return layout.detections(rows, "mineru", ["page"]).select("page", "src", "block_id")


@query("SELECT p_partkey AS page, 'b000' AS block_id, p_size::DOUBLE AS x2 FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_linenumber = 7)")
def whole_page_blocks(t):
    pages = t("part").select(F.col("p_partkey").alias("page"), F.col("p_size").alias("width"), F.lit(10).alias("height"))
    found = t("lineitem").where("l_linenumber = 7").select(F.col("l_partkey").alias("page"))
    return layout.whole_page_blocks(pages, found, ["page"]).select("page", "block_id", F.col("bbox.x2").alias("x2"))


@query("SELECT page_id, CASE WHEN page_id % 2 = 0 THEN '/new/' || page_id || '.png' ELSE '/old/' || page_id || '.png' END AS image_path FROM pages")
def match_images(t):
    name = F.concat(F.col("page_id").cast("string"), F.lit(".png"))
    pages = t("pages").select("page_id", F.concat(F.lit("/old/"), name).alias("image_path"))
    return layout.match_images(pages, t("pages").where("page_id % 2 = 0").select(F.concat(F.lit("/new/"), name).alias("path"))).select("page_id", "image_path")


@query("SELECT vec_id AS pos, label, vec_id % 7 AS v FROM embeddings")
def zip_vectors(t):
    e = t("embeddings")
    return vectors.zip_vectors(e.select(F.col("vec_id").alias("pos"), "label"), e.select(F.col("vec_id").alias("pos"), (F.col("vec_id") % 7).alias("v")))


@query("SELECT vec_id AS id, label FROM embeddings WHERE vec_id % 20 NOT IN (SELECT vec_id % 20 FROM embeddings WHERE label = 3 AND vec_id % 9 = 0)")
def vector_delete(t):
    table, _ = point_table(t)
    gone = t("embeddings").where("label = 3 and vec_id % 9 = 0").select((F.col("vec_id") % 20).alias("doc_id"))
    return vectors.delete_documents(table, gone).select("id", "label")


@query("""WITH g AS (SELECT source, string_agg(DISTINCT lang, ',' ORDER BY lang) AS langs, count(*) AS n FROM documents GROUP BY 1) SELECT source, langs, n FROM g""")
def language_sets(t):
    found = runs.distinct_warnings(t("documents").select("source", F.lit(1).alias("seq"), F.col("lang").alias("message")), ["source"])
    counts = t("documents").groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    return found.join(counts, "source").select("source", F.array_join("warnings", ",").alias("langs"), "n")


@query("SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN text || chr(10) || '% TODO: verify unpaired dollar' || chr(10) ELSE text END AS t FROM (SELECT doc_id, replace(rtrim(text, ' ' || chr(10)), '$', '') || CASE WHEN doc_id % 2 = 0 THEN ' $5' ELSE ' $5$' END AS text FROM documents)")
def unpaired_dollars(t):
    d = F.concat(F.replace(text.rstrip("text"), F.lit("$"), F.lit("")), F.when(F.col("doc_id") % 2 == 0, " $5").otherwise(" $5$"))
    return t("documents").select("doc_id", text.mark_unpaired_dollars(d).alias("t"))


# -- texts as they are ---------------------------------------------------------------------------------------

#: Specials escaped in a text without dollar signs.
ESCAPED = r"replace(replace(replace(regexp_replace(translate(x, '\~^', chr(57344) || chr(57345) || chr(57346)), '([&%#_{}])', '\\\1', 'g'), chr(57344), '\textbackslash{}'), chr(57345), '\textasciitilde{}'), chr(57346), '\textasciicircum{}')"
#: A text without white space at its ends, as far as the test tables have any.
BARE = "trim(text, ' ' || chr(9) || chr(10) || chr(13))"


@query(rf"SELECT doc_id, {ESCAPED} || ' $a_b$ 5\%' AS t FROM (SELECT doc_id, replace(text, '$', '') || ' \~^' AS x FROM documents)")
def latex_escape(t):
    d = F.concat(F.replace("text", F.lit("$"), F.lit("")), F.lit(" \\~^ $a_b$ 5%"))
    return t("documents").select("doc_id", text.escape_outside_math(d).alias("t"))


@query(rf"""SELECT doc_id, sha256('% Auto OCR export: d' || doc_id || chr(10) || CASE WHEN doc_id % 2 = 0 THEN '\documentclass[12pt]{{ctexart}}' || chr(10) ELSE '\documentclass[12pt]{{article}}' || chr(10) || '\usepackage[utf8]{{inputenc}}' || chr(10) END || '\usepackage{{amsmath,amssymb}}' || chr(10) || '\usepackage{{geometry}}' || chr(10) || '\geometry{{margin=2.2cm}}'
    || chr(10) || '\begin{{document}}' || chr(10) || chr(10) || regexp_replace({ESCAPED}, '\n{{3,}}', chr(10) || chr(10), 'g') || chr(10) || chr(10) || '\end{{document}}' || chr(10)) AS tex_sha256 FROM (SELECT doc_id, replace({BARE}, '$', '') || '~' AS x FROM documents)""")
def latex_documents(t):
    body = F.concat(F.replace(text.strip("text"), F.lit("$"), F.lit("")), F.lit("~"))
    return t("documents").select("doc_id", F.sha2(text.latex_document(body, F.when(F.col("doc_id") % 2 == 0, "zh").otherwise("en"), F.concat(F.lit("d"), F.col("doc_id").cast("string"))), 256).alias("tex_sha256"))


@query(rf"""SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN {BARE} WHEN 1 THEN 'a ' || doc_id ELSE 'draft ' || {BARE} END AS txt,
        CASE doc_id % 3 WHEN 0 THEN '\documentclass{{x}}' WHEN 1 THEN '\documentclass{{x}}\begin{{document}}' || chr(10) || 'a ' || doc_id || chr(10) || '\end{{document}}' END AS tex, doc_id % 3 = 2 AS warned FROM documents""")
def polish_parse(t):
    """Replies with marks, with a fenced document, and with neither."""
    key = F.col("doc_id").cast("string")
    marked = F.concat(F.lit("<<<TXT>>>\n"), "text", F.lit("\n<<<TEX>>>\n\\documentclass{x}"))
    fenced = F.concat(F.lit("Here it is:\n```latex\n\\documentclass{x}\\begin{document}\na "), key, F.lit("\n\\end{document}\n```\nDone."))
    p = text.parse_polish(F.when(F.col("doc_id") % 3 == 0, marked).when(F.col("doc_id") % 3 == 1, fenced).otherwise(F.col("text")), F.concat(F.lit("draft "), text.strip("text")))
    return t("documents").select("doc_id", p.alias("p")).select("doc_id", "p.txt", F.when(F.col("doc_id") % 3 < 2, F.col("p.tex")).alias("tex"), F.col("p.warning").isNotNull().alias("warned"))


@query(rf"SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN {BARE} WHEN 1 THEN {BARE} WHEN 2 THEN 'ASSISTANT: ' || {BARE} ELSE '$$' || chr(10) || doc_id || chr(10) || '$$' END AS t FROM documents")
def replies(t):
    fence, k = F.concat(F.lit("```latex\n"), "text", F.lit("\n```")), F.col("doc_id") % 4
    said = F.when(k == 0, text.clean_reply(fence)).when(k == 1, text.clean_reply(F.concat(F.lit("Assistant： "), "text"))).when(k == 2, text.clean_reply(F.concat(F.lit("ASSISTANT: "), text.strip("text")))).otherwise(text.display_math(F.concat(F.lit("$ "), F.col("doc_id").cast("string"), F.lit("$"))))
    return t("documents").select("doc_id", said.alias("t"))


@query(f"SELECT doc_id, {BARE} AS body FROM documents")
def document_bodies(t):
    return t("documents").select("doc_id", text.document_body(text.wrap_document("text")).alias("body"))


#: A file name without folder and ending.
STEM = r"regexp_replace(string_split(url, '/')[-1], '(.)\.[^.]*$', '\1')"


@query(rf"SELECT page_id, coalesce(TRY_CAST(regexp_extract({STEM}, '(\d+)', 1) AS INT), 0) AS page FROM pages")
def page_numbers(t):
    return t("pages").select("page_id", layout.page_number("url").alias("page"))


@query(rf"SELECT page_id, coalesce(nullif(trim(regexp_replace({STEM}, '[^\p{{L}}\p{{M}}\p{{Nd}}\p{{Pc}}\-]+', '_', 'g'), '_'), ''), 'pdf') AS stem FROM pages")
def safe_stems(t):
    return t("pages").select("page_id", text.safe_stem("url").alias("stem"))


@query(rf"SELECT doc_id, sha256(array_to_string(list_transform(string_split(replace(d, chr(13) || chr(10), chr(10)), chr(10)), lambda x: rtrim(x, ' ' || chr(9))), chr(10)) || chr(10)) AS content_hash FROM (SELECT doc_id, replace(replace(replace(text, chr(10), '  ' || chr(13) || chr(10)), 'a', 'A'), 'e', '1') || 'fi' AS d FROM documents)")
def content_hash(t):
    """The shipped hash, with NFKC: full-width letters and digits and a ligature become plain ones."""
    d = F.concat(F.translate(F.replace("text", F.lit("\n"), F.lit("  \r\n")), "ae", "Ａ１"), F.lit("ﬁ"))
    return t("documents").select("doc_id", vectors.content_hash(d).alias("content_hash"))


# -- chat rows, whole values ---------------------------------------------------------------------------------


@query(f"""WITH {CHAT}, b AS (SELECT conv_id, string_agg('; #' || conv_id || ' message[' || i || ']: content 不可為空', '' ORDER BY i) AS blank FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, content) - 1 AS i FROM c) WHERE trim(content, ' ' || chr(10)) = '' GROUP BY 1)
    SELECT row_no, CASE WHEN n < 2 THEN '#' || row_no || ': 需要 messages 陣列，且至少含 user + assistant' ELSE ltrim(CASE WHEN NOT has_user OR NOT has_assistant THEN '; #' || row_no || ': 缺少 user 或 assistant 角色' ELSE '' END || coalesce(blank, ''), '; ') END AS errors FROM s LEFT JOIN b ON row_no = conv_id""")
def chat_validate(t):
    rows = chat(t)
    found = dataset.all_errors(rows).groupBy("row_no").agg(F.array_sort(F.collect_list(F.struct("error_no", "error"))).alias("x"))
    return rows.select("row_no").join(found, "row_no", "left").select("row_no", F.coalesce(F.array_join(F.transform("x", lambda e: e["error"]), "; "), F.lit("")).alias("errors"))


@query(f"""WITH {CHAT} SELECT c.role, sha256(CASE WHEN c.role = 'system' AND conv_id % 7 <> 0 THEN '{dataset.SYSTEM}' ELSE coalesce(content, '') END) AS content_sha256, count(*) AS n FROM c JOIN d ON row_no = conv_id WHERE disposition = 'promoted' GROUP BY ALL""")
def train_rows(t):
    m = dataset.promote(chat(t))["train"].select(F.explode("messages").alias("m"))
    return m.groupBy("m.role", F.sha2("m.content", 256).alias("content_sha256")).agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {CHAT}, q AS (SELECT row_no, question, {QID.replace("conv_id", "row_no")} AS qid, row_no // 10 AS page, 'exam' || (row_no // 10 % 8) AS doc, CASE WHEN row_no % 4 = 1 THEN NULL WHEN row_no % 4 = 0 THEN (row_no // 4) || '' ELSE (row_no // 3) || '' END AS main, row_no % 4 = 1 AS orphan FROM s),
    k AS (SELECT *, last_value(CASE WHEN NOT orphan THEN {{'page': page, 'main': main}} END IGNORE NULLS) OVER (PARTITION BY doc ORDER BY row_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM q),
    m AS (SELECT *, CASE WHEN NOT orphan THEN main WHEN before.page = page THEN before.main END AS m FROM k),
    g AS (SELECT *, sum(CASE WHEN changed THEN 1 ELSE 0 END) OVER (PARTITION BY doc ORDER BY row_no) AS grp FROM (SELECT *, coalesce(lag(page || '|' || coalesce(m, 'row' || row_no)) OVER (PARTITION BY doc ORDER BY row_no) <> page || '|' || coalesce(m, 'row' || row_no), true) AS changed FROM m)),
    l AS (SELECT *, CASE row_no % 4 WHEN 0 THEN 'a' WHEN 1 THEN 'b' END AS sub FROM g),
    p AS (SELECT *, CASE WHEN question = '' THEN NULL WHEN sub IS NULL OR regexp_matches(question, '(?i)^[(（]?' || sub || '[)）]?') OR regexp_matches(question, '(?i)^[(（][a-z0-9ivx]+[)）]') THEN question ELSE '(' || sub || ') ' || question END AS part FROM l)
    SELECT min(row_no) AS row_no, CASE WHEN count(*) = 1 THEN 'r' || min(row_no) ELSE doc || '_p' || printf('%03d', any_value(page)) || '_q' || any_value(m) END AS id, CASE WHEN count(*) = 1 THEN any_value(qid) ELSE any_value(m) END AS question_id,
        CASE WHEN count(*) = 1 THEN any_value(question) ELSE coalesce(string_agg(part, chr(10) || chr(10) ORDER BY row_no), '') END AS question, CASE WHEN bool_or(row_no % 2 = 0) THEN 'fig' END AS figure_description, bool_or(row_no % 2 = 0) AS has_figure,
        CASE WHEN count(*) > 1 THEN 'merged ' || count(*) || ' subparts' END AS notes, count(*) AS merged FROM p GROUP BY doc, grp""")
def merge_subparts(t):
    rows = chat(t).withColumn("source", F.col("source").withField("pdf", F.concat(F.lit("in/exam"), ((F.col("row_no") / 10).cast("bigint") % 8).cast("string"), F.lit(".pdf"))))
    found = dataset.merge_subparts(rows)
    return found.select("row_no", "id", "source.question_id", dataset.first_text("messages", "user").alias("question"), "figure_description", "has_figure", "notes", "merged")


# -- runs ----------------------------------------------------------------------------------------------------


@query("""SELECT DISTINCT event_type AS doc_id, CASE WHEN length(event_type) % 2 = 0 THEN 'publish' ELSE 'check' END AS stage, length(event_type) % 2 = 0 AS ok, CASE WHEN length(event_type) % 2 = 1 THEN 'ValueError: odd name ' || event_type END AS error FROM events WHERE event_type IS NOT NULL""")
def doc_batch_status(t):
    """Kinds of events as documents of a batch: those with odd names fail in the first step, and the others go on."""
    kinds = t("events").where("event_type is not null").select("event_type").distinct()

    def check(doc: str) -> None:
        if len(doc) % 2:
            raise ValueError(f"odd name {doc}")

    return runs.run_batch(kinds.sparkSession, sorted(r[0] for r in kinds.collect()), [("check", check), ("publish", lambda doc: None)])  # a few kinds


#: Lines of a part as blocks of two panels a page; equal ids are told apart by their boxes.
PANEL_BLOCKS = f"b AS (SELECT {BOX} FROM lineitem), n AS (SELECT *, row_number() OVER (PARTITION BY page, id % 2 ORDER BY id, x1, y1, x2, y2) - 1 AS i FROM b)"


@query(f"""WITH {PANEL_BLOCKS} SELECT page, id, x1::DOUBLE AS x1, y1::DOUBLE AS y1, (i + CASE WHEN id % 2 = 1 THEN count(*) FILTER (id % 2 = 0) OVER (PARTITION BY page) ELSE 0 END)::INT AS "order", printf('p%03d_v%d_b%03d', page, id % 2, i) AS block_id FROM n""")
def merge_panels(t):
    rows = boxes(t).withColumn("order", F.col("id")).withColumn("version_id", F.concat(F.lit("v"), (F.col("id") % 2).cast("string"))).withColumn("bbox", geometry.box(*[F.col(c) for c in ("x1", "y1", "x2", "y2")]))
    panel = F.get(geometry.panel_boxes(F.lit("2_lr"), F.lit(0.0), F.lit(0.5)), (F.col("id") % 2).cast("int"))["box"]
    rows = rows.withColumn("panel", panel).withColumn("page_width", F.lit(800.0)).withColumn("page_height", F.lit(600.0))
    merged = layout.merge_panels(rows, ["page"], last=["x1", "y1", "x2", "y2"])
    return merged.select("page", "id", "x1", "y1", F.col("order").cast("int").alias("order"), "block_id")


@query()
def split_scores(t):
    ink = t("lineitem").groupBy("l_partkey").agg(F.array_sort(F.collect_list(F.struct("l_orderkey", "l_linenumber", (F.col("l_quantity") / 50).alias("v")))).alias("x"))
    return ink.select("l_partkey", geometry.split_of(F.transform("x", lambda x: x["v"])).alias("s")).select("l_partkey", F.round("s.score", 6).alias("score"), F.round("s.split", 6).alias("split"))


@query()
def document_segments(t):
    """Segments of whole document texts, whatever stands in them."""
    found = segments.check_segments(segments.segment(drafts(t), ["doc_id"]))
    return found.groupBy("page_index", "kind", "integrity", "version_id").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars"))


# -- seams with plain functions for models -------------------------------------------------------------------


def shown(t) -> DataFrame:
    """Parts as page images: the bytes of an image are its page's number and size."""
    return t("part").select(F.col("p_partkey").alias("page"), F.encode(F.concat_ws(" ", "p_partkey", "p_size"), "UTF-8").alias("content"), F.lit(100).alias("width"), F.lit(200).alias("height"))


def found_on(data: bytes) -> list[tuple]:
    """Two blocks a page, the second one predicted to come first; pages whose number ends in 7 fail."""
    page, size = map(int, bytes(data).split())
    if page % 10 == 7:
        raise ValueError("blurred")
    return [("text", 1, 100, 60, 120 + size, 0.9, 1), ("picture", 1, 10, 60, 40, 0.8, 0)]


@query("SELECT p_partkey AS page, 'ValueError: blurred' AS error FROM part WHERE p_partkey % 10 = 7")
def page_errors(t):
    return seams.scan(shown(t), lambda: found_on, ["page"]).where("error is not null").select("page", "error")


@query("SELECT p_partkey AS page, i AS \"order\", printf('p%03d_b%03d', p_partkey, 1 - i) AS block_id, CASE WHEN i = 0 THEN 'figure' ELSE 'text' END AS block_type FROM part, (VALUES (0), (1)) v(i) WHERE p_partkey % 10 <> 7")
def predicted_order(t):
    """Blocks by the position that the layout model predicts."""
    found = seams.scan(shown(t), lambda: found_on, ["page"]).where("error is null").drop("error")
    return layout.detections(found, "surya", ["page"]).select("page", "order", "block_id", "block_type")


@query("SELECT p_partkey AS page, i AS index, CASE WHEN p_partkey % 2 = 0 THEN 1 - i ELSE i END AS \"order\" FROM part, (VALUES (0), (1)) v(i)")
def order_merge(t):
    """Blocks with the order of a second model, which speaks about even pages alone."""
    blocks = t("part").select(F.col("p_partkey").alias("page"), F.explode(F.array(F.lit(0), F.lit(1))).alias("index")).withColumn("order", F.col("index"))
    predicted = blocks.where("page % 2 = 0").select("page", "index", (F.lit(1) - F.col("index")).alias("position"))
    return layout.merge_order(blocks, predicted, ["page"]).select("page", "index", F.col("order").cast("int").alias("order"))


@query("SELECT p_partkey AS page, nullif(CASE p_partkey % 5 WHEN 1 THEN '' WHEN 2 THEN '' ELSE 'page ' || p_partkey || ' ' || p_size END, '') AS text, CASE p_partkey % 5 WHEN 1 THEN 'RuntimeError: no memory' WHEN 2 THEN 'empty text' END AS error FROM part")
def page_ocr(t):
    """Whole pages through one engine: some fail, some have no text, and none of these stops the others."""

    def engine(data: bytes) -> str:
        page = int(bytes(data).split()[0])
        if page % 5 == 1:
            raise RuntimeError("no memory")
        return "```\n```" if page % 5 == 2 else f"```text\nAssistant: page {bytes(data).decode()}\n```"

    return seams.page_texts(shown(t), lambda: engine, ["page"])


@query("""SELECT p_partkey AS page, i AS "order", CASE WHEN i = 0 THEN '' ELSE p_partkey || ' ' || p_size || ' @0,98,62,' || least(200, 122 + p_size) END AS raw_text FROM part, (VALUES (0), (1)) v(i) WHERE p_partkey % 10 <> 7""")
def block_crops(t):
    """Each block's part of its page, cut with a margin, to the engine of its route; figures are skipped."""
    blocks = layout.route(seams.detect(shown(t), lambda: found_on, "surya", ["page"]))
    cropped = seams.crops(blocks, shown(t), ["page"], lambda data, box: data + b" @" + ",".join(map(str, box)).encode())
    read = seams.read_blocks(cropped, {"math": lambda: None, "text": lambda: lambda data: bytes(data).decode()}, isolate=True)
    return read.select("page", F.col("order").cast("int").alias("order"), "raw_text")


@query("""SELECT p_partkey AS page, 'v' || v AS version_id, printf('p%03d_v%d_b%03d', p_partkey, v, 1 - i) AS block_id, (2 * v + i)::INT AS "order", 1.0::DOUBLE + 50 * v AS x1 FROM part, (VALUES (0), (1)) p(v), (VALUES (0), (1)) b(i) WHERE p_partkey % 10 <> 7""")
def panel_blocks(t):
    """Panels analysed on their own, their blocks moved to the page: the left panel's first."""
    box = lambda i: F.struct(F.lit(i * 0.5).alias("x1"), F.lit(0.0).alias("y1"), F.lit(i * 0.5 + 0.5).alias("x2"), F.lit(1.0).alias("y2"))
    each = F.explode(F.array(*[F.struct(F.lit(f"v{i}").alias("version_id"), box(i).alias("panel")) for i in (0, 1)]))
    panels = shown(t).select("page", "content", each.alias("p"), F.lit(100.0).alias("page_width"), F.lit(200.0).alias("page_height")).select("page", "content", "p.*", "page_width", "page_height")
    found = seams.detect_panels(panels, lambda: found_on, "surya", ["page"])
    number = F.regexp_extract("block_id", r"b(\d+)$", 1).cast("int")
    return found.select("page", "version_id", F.format_string("p%03d_%s_b%03d", F.col("page"), F.col("version_id"), F.lit(1) - number).alias("block_id"), F.col("order").cast("int").alias("order"), "x1")


@query(r"""SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN '<<<nup:v0>>>' || chr(10) || chr(10) || 'left ' || p_size || chr(10) || chr(10) || '<<<nup:v1>>>' || chr(10) || chr(10) ELSE '' END || 'right' AS txt,
    CASE WHEN p_partkey % 2 = 0 THEN 'polish parse fail; draft wrapped' ELSE '' END AS warnings, CASE WHEN p_partkey % 2 = 0 THEN contains('x', 'y') ELSE true END AS own FROM part""")
def polish_documents(t):
    """Replies of a model as texts and documents: one stretch's reply holds a document, the other's nothing to read."""
    draft = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("<<<nup:v0>>>\nleft "), F.col("p_size").cast("string"), F.lit("\n<<<nup:v1>>>\nright"))).otherwise(F.lit("right"))
    model = lambda piece: "?" if piece.endswith(tuple("0123456789")) else "<<<TXT>>>\nright<|im_end|>\n<<<TEX>>>\n\\documentclass{x}\\begin{document}right\\end{document}"
    done = segments.polish_documents(t("part").select("p_partkey", draft.alias("draft")), ["p_partkey"], seams.with_prompt(model, "Polish: "))
    return done.select("p_partkey", "txt", F.array_join("warnings", "; ").alias("warnings"), F.startswith("tex", F.lit("\\documentclass{x}")).alias("own"))


@query("SELECT row_no AS at, 1 AS part, sha256(block) AS content_sha256 FROM (SELECT p_partkey AS row_no, p_name || chr(10) || 'x' AS block FROM part) UNION ALL SELECT NULL, 0, sha256('% questions: ' || count(*) || chr(10)) FROM part UNION ALL SELECT NULL, 2, sha256('% END')")
def question_document(t):
    blocks = t("part").select(F.col("p_partkey").alias("row_no"), F.concat("p_name", F.lit("\nx")).alias("block"))
    return sinks.question_document(blocks).select("at", F.col("part").cast("int").alias("part"), F.sha2("content", 256).alias("content_sha256"))


@query("SELECT p_partkey, greatest(0, trunc(p_size / 50.0::DOUBLE * 100)::INT) AS x1, least(100, greatest(1, trunc((p_size / 50.0::DOUBLE + 0.1::DOUBLE) * 100)::INT)) AS x2 FROM part")
def norm_boxes(t):
    """Boxes in shares of a page as whole pixels."""
    b = geometry.box(F.col("p_size") / 50, F.lit(0.0), F.col("p_size") / 50 + 0.1, F.lit(1.0))
    px = geometry.to_pixels(b, F.lit(100), F.lit(200))
    return t("part").select("p_partkey", px.alias("b")).select("p_partkey", "b.x1", "b.x2")


@query("SELECT p_partkey, (p_size)::DOUBLE AS x1, (p_size - 1)::DOUBLE AS y1, (p_size + 9)::DOUBLE AS x2, (p_size + 7)::DOUBLE AS y2 FROM part")
def polygon_boxes(t):
    s = F.col("p_size").cast("double")
    points = F.array(F.array(s, s + 2), F.array(s + 9, s - 1), F.array(s + 4, s + 7))
    return t("part").select("p_partkey", geometry.polygon_box(points).alias("b")).select("p_partkey", "b.*")


@query("SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'zh' ELSE 'en' END AS lang, '20260101-000000-d' || doc_id AS job FROM documents")
def job_names(t):
    said = F.when(F.col("doc_id") % 2 == 0, " ZH\n").otherwise("En")
    return t("documents").select("doc_id", text.normalize_lang(said).alias("lang"), text.job_id(F.concat(F.lit("d"), F.col("doc_id").cast("string")), F.lit("2026-01-01 00:00:00").cast("timestamp_ntz")).alias("job"))


@query("SELECT p_partkey AS pos, 'search_document: ' || p_name AS prompt, 3 AS n FROM part")
def embed_input(t):
    """What the model gets for a segment, seen through a model that keeps the code points of its last letters."""
    model = lambda texts: [[float(ord(c)) for c in x[-3:]] for x in texts]
    rows = vectors.embed(t("part").select(F.col("p_partkey").alias("pos"), F.col("p_name").alias("text")), model, 3)
    tail = F.array_join(F.transform("vector", lambda x: F.char(x.cast("int"))), "")
    return rows.select("pos", F.when(tail == F.substring("text", -3, 3), F.concat(F.lit(vectors.PREFIX), "text")).alias("prompt"), F.size("vector").alias("n"))
