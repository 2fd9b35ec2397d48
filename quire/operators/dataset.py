"""Chat rows: checks, promotion to training rows, question export and merged subparts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import col, dollar_math, strip

# What marks an answer as open and a question as junk.
OPEN = "[待補解答]"
JUNK = ["寫於邊界以外", "請在此貼上電腦條碼", "考生須知", "Time is up"]
SYSTEM = "你是一位專業的香港 DSE 數學中學老師。用 Step 1、Step 2 逐步解釋，公式用 LaTeX（行內 $...$，區塊 $$...$$），繁體中文回覆。"


def first_text(messages: Column | str, role: str) -> Column:
    """The first message of a role, stripped; empty without one."""
    found = F.get(F.filter(col(messages), lambda m: m["role"] == role), F.lit(0))
    return strip(F.coalesce(found["content"], F.lit("")))


def is_open(messages: Column | str) -> Column:
    answer = first_text(messages, "assistant")
    return (answer == "") | F.contains(answer, F.lit(OPEN))


def row_errors(messages: Column | str, number: Column | str, real: bool = False) -> Column:
    """What is wrong with a row, in order."""
    m, at = col(messages), F.concat(F.lit("#"), col(number).cast("string"))
    has = lambda role: F.exists(m, lambda x: F.coalesce(x["role"] == role, F.lit(False)))
    blank = F.filter(F.transform(m, lambda x, j: F.when(strip(F.coalesce(x["content"], F.lit(""))) == "", F.concat(at, F.lit(" message["), j.cast("string"), F.lit("]: content 不可為空")))), F.isnotnull)
    head = F.array(F.when(~has("user") | ~has("assistant"), F.concat(at, F.lit(": 缺少 user 或 assistant 角色"))))
    tail = F.array(F.when(is_open(m), F.concat(at, F.lit(": assistant 仍是待補解答，不可寫入 train.jsonl")))) if real else F.array().cast("array<string>")
    few = F.array(F.concat(at, F.lit(": 需要 messages 陣列，且至少含 user + assistant")))
    return F.when(F.coalesce(F.size(m), F.lit(0)) < 2, few).otherwise(F.array_compact(F.concat(head, blank, tail)))


def status_of(status: Column | str) -> Column:
    return strip(F.coalesce(F.nullif(col(status), F.lit("")), F.lit("draft")))


def status_counts(rows: DataFrame) -> DataFrame:
    """(bucket, n, open): rows by status, others being pending, and how many have no answer yet."""
    s = status_of("status")
    bucket = F.when(s.isin("approved", "extract_failed"), s).otherwise("pending")
    return rows.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"), F.count_if(is_open("messages")).alias("open"))


def all_errors(rows: DataFrame, number: str = "row_no") -> DataFrame:
    """(row_no, error_no, error)."""
    return rows.select(number, F.posexplode(row_errors("messages", number)).alias("error_no", "error"))


def disposition(rows: DataFrame, number: str = "row_no") -> DataFrame:
    """Rows with where they go: rejected, promoted, or remain and why."""
    s = status_of("status")
    where = F.when(s == "rejected", "rejected").when(s != "approved", "remain").when(is_open("messages"), "remain").when(F.size(row_errors("messages", number, True)) > 0, "remain").otherwise("promoted")
    return rows.withColumn("disposition", where)


def language_of(language: Column | str, source_lang: Column | str) -> Column:
    some = lambda c: F.nullif(col(c), F.lit(""))
    return F.lower(strip(F.coalesce(some(language), some(source_lang), F.lit("zh"))))


def train_messages(messages: Column | str, language: Column, system: str = SYSTEM) -> Column:
    """Messages to learn from: the system text is the fixed one but for en."""
    return F.transform(col(messages), lambda m: F.struct(m["role"].alias("role"), F.when((m["role"] == "system") & (language != "en"), F.lit(system)).otherwise(F.coalesce(m["content"], F.lit(""))).alias("content")))


def promote(rows: DataFrame, train: DataFrame | None = None, rejected: DataFrame | None = None, number: str = "row_no") -> dict[str, DataFrame]:
    """train and rejected with this draft's rows behind theirs, and what remains of the draft."""
    told = disposition(rows, number)
    fresh = told.where("disposition = 'promoted'").select(train_messages("messages", language_of("language", "source.lang")).alias("messages"))
    gone = told.where("disposition = 'rejected'").drop("disposition")
    return {
        "train": train.unionByName(fresh) if train is not None else fresh,
        "rejected": rejected.unionByName(gone, allowMissingColumns=True) if rejected is not None else gone,
        "remain": told.where("disposition = 'remain'").drop("disposition"),
    }


def split_eval(rows: DataFrame, key: str, ratio: float = 0.1, seed: int = 42) -> DataFrame:
    """Rows with is_eval for the first tenth, one at least, of an order by hash. The order is fixed by key and
    seed; counts by hash prefix find the border, so that no task sees all rows."""
    h = F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))
    hashed = rows.withColumn("_h", h)
    n = hashed.count()
    wanted = max(1, int(n * ratio))
    prefix, above = "", 0
    while True:
        size = len(prefix) + 2
        counts = hashed.where(F.col("_h").startswith(prefix)).groupBy(F.substring("_h", 1, size).alias("p")).count().collect()  # at most 256 rows
        for p, k in sorted(map(tuple, counts)):
            if above + k >= wanted:
                prefix = p
                break
            above += k
        else:
            return hashed.withColumn("is_eval", F.lit(True)).drop("_h")
        if k <= 1000 or size >= 32:
            inside = sorted(r[0] for r in hashed.where(F.col("_h").startswith(prefix)).select("_h").limit(1000).collect())
            border = inside[min(wanted - above, len(inside)) - 1]
            return hashed.withColumn("is_eval", F.col("_h") <= border).drop("_h")


def is_junk(question: Column | str) -> Column:
    q = strip(question)
    out = F.length(q) < 8
    for mark in JUNK:
        out |= F.contains(q, F.lit(mark))
    return out


def question_block(row: Column | None = None) -> Column:
    """A row's question with a comment line before it."""
    question, figure = dollar_math(first_text("messages", "user")), strip(F.coalesce("figure_description", F.lit("")))
    flag = F.coalesce("has_figure", F.lit(False))
    shown = flag & (figure != "") & ~F.contains(question, F.lit("[圖]")) & ~F.contains(question, F.lit("[Figure]"))
    question = F.when(shown, F.concat(question, F.lit("\n\n[圖] "), dollar_math(figure))).otherwise(question)
    meta = F.concat(F.lit("% id="), F.coalesce(F.nullif("id", F.lit("")), F.lit("unknown")), F.lit("  page="), F.coalesce(F.col("source.page").cast("string"), F.lit("?")), F.lit("  exam_q="), F.coalesce("source.question_id", F.lit("")), F.lit("  has_figure="), F.when(flag, "True").otherwise("False"))
    image = F.coalesce("source.image", F.lit(""))
    return F.concat(meta, F.when(image != "", F.concat(F.lit("  image="), image)).otherwise(""), F.lit("\n題目：\n"), question, F.lit("\n"))


def question_blocks(rows: DataFrame, everything: bool = False) -> DataFrame:
    """Rows with their block, but for those without a question and, if not everything is wanted, junk."""
    q = first_text("messages", "user")
    return rows.where((q != "") & (F.lit(everything) | ~is_junk(q))).withColumn("block", question_block())


def export_counts(rows: DataFrame, everything: bool = False) -> DataFrame:
    q = first_text("messages", "user")
    keep = (q != "") & (F.lit(everything) | ~is_junk(q))
    return rows.agg(F.count_if(keep).alias("written"), F.count_if(~keep).alias("skipped"))


PART = r"[a-zA-Z0-9ivxIVX]+"


def parse_question_id(c: Column | str) -> Column:
    """(main, sub) of ids like 4(a), (a) and 7; any other id is a main one."""
    q = strip(F.coalesce(col(c), F.lit("")))
    both, sub, main = rf"(?U)\A(\d+)\s*[\(（]\s*({PART})[\)）]\s*\z", rf"(?U)\A[\(（]\s*({PART})[\)）]\s*\z", r"(?U)\A(\d+)\s*\z"
    pair = lambda a, b: F.struct(a.cast("string").alias("main"), b.cast("string").alias("sub"))
    none = F.lit(None)
    return F.when(q.rlike(both), pair(F.regexp_extract(q, both, 1), F.lower(F.regexp_extract(q, both, 2)))).when(q.rlike(sub), pair(none, F.lower(F.regexp_extract(q, sub, 1)))).when(q.rlike(main), pair(F.regexp_extract(q, main, 1), none)).otherwise(pair(F.nullif(q, F.lit("")), none))


def part_text(sub: Column, text: Column) -> Column:
    """A subpart's text, labelled unless it seems to be."""
    bare = strip(text)
    own = F.regexp_like(bare, F.concat(F.lit(r"(?i)\A[\(（]?\Q"), F.coalesce(sub, F.lit("")), F.lit(r"\E[\)）]?")))
    labelled = sub.isNull() | own | bare.rlike(r"(?i)\A[\(（][a-z0-9ivx]+[\)）]")
    return F.when(bare == "", None).when(labelled, bare).otherwise(F.concat(F.lit("("), sub, F.lit(") "), bare))


def merge_subparts(rows: DataFrame, number: str = "row_no", document: str = "source.pdf") -> DataFrame:
    """Rows with following ones of one page and main number as one question, and ``merged``, how many each was made of. A subpart
    without a number belongs to the number before it if that is on its page and nothing but such subparts stands between; a row
    without any id stands alone. A merged row is its first one's with the texts, figures and notes of all. Rows come in the order
    of pages; windows are by document."""
    doc = Window.partitionBy("_doc").orderBy(number)
    before = doc.rowsBetween(Window.unboundedPreceding, -1)
    told = rows.withColumn("_doc", F.coalesce(F.col(document), F.lit(""))).withColumn("_page", F.col("source.page")).withColumn("_q", parse_question_id("source.question_id"))
    orphan = F.col("_q.main").isNull() & F.col("_q.sub").isNotNull()
    told = told.withColumn("_last", F.last(F.when(~orphan, F.struct(F.col("_page").alias("page"), F.col("_q.main").alias("main"))), ignorenulls=True).over(before))
    same = orphan & F.col("_last.page").eqNullSafe(F.col("_page"))
    told = told.withColumn("_main", F.when(orphan, F.when(same, F.col("_last.main"))).otherwise(F.col("_q.main")))
    mark = F.struct(F.col("_page").alias("p"), F.coalesce("_main", F.concat(F.lit("\x00"), F.col(number).cast("string"))).alias("m"))
    told = told.withColumn("_mark", mark).withColumn("_new", F.when(F.lag("_mark").over(doc).eqNullSafe(F.col("_mark")), 0).otherwise(1))
    told = told.withColumn("_group", F.sum("_new").over(doc.rowsBetween(Window.unboundedPreceding, 0)))
    figure = strip(F.coalesce("figure_description", F.lit("")))
    item = F.struct(F.col(number).alias("n"), part_text(F.col("_q.sub"), first_text("messages", "user")).alias("t"), F.nullif(figure, F.lit("")).alias("f"))
    whole = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
    found = told.groupBy("_doc", "_group").agg(F.array_sort(F.collect_list(item)).alias("_x"), F.min_by(whole, number).alias("_row"), F.bool_or(F.coalesce("has_figure", F.lit(False))).alias("_figure"), F.first("_main").alias("_main"), F.first("_page").alias("_page"), F.count(F.lit(1)).alias("merged"))
    one, row = F.col("merged") == 1, lambda c: F.col(f"_row.`{c}`")
    stem = F.regexp_replace(F.regexp_replace(F.coalesce(F.nullif("_doc", F.lit("")), F.lit("draft")), r"\A.*/", ""), r"(?<=.)\.[^.]*\z", "")
    note = F.concat(F.lit("merged "), F.col("merged").cast("string"), F.lit(" subparts"))
    old = strip(F.coalesce(row("notes"), F.lit("")))
    text = F.array_join(F.array_compact(F.transform("_x", lambda r: r["t"])), "\n\n")
    figures = F.array_distinct(F.array_compact(F.transform("_x", lambda r: r["f"])))
    messages = row("messages")
    first = F.array_position(F.transform(messages, lambda m: F.coalesce(m["role"], F.lit(""))), "user")
    new = {
        "id": F.concat(stem, F.lit("_p"), F.format_string("%03d", F.coalesce("_page", F.lit(0)).cast("long")), F.lit("_q"), F.coalesce("_main", F.lit("merged"))),
        "source": row("source").withField("question_id", F.coalesce("_main", row("source")["question_id"])),
        "messages": F.transform(messages, lambda m, i: F.when(i + 1 == first, m.withField("content", text)).otherwise(m)),
        "has_figure": F.col("_figure"),
        "figure_description": F.when(F.size(figures) > 0, F.array_join(figures, "；")).otherwise(row("figure_description")),
        "notes": F.when(old == "", note).otherwise(F.concat(old, F.lit(" | "), note)),
    }
    return found.select(*[F.when(one, row(c)).otherwise(new[c]).alias(c) if c in new else row(c).alias(c) for c in rows.columns], F.col("merged").cast("bigint").alias("merged"))
