"""Text functions as Column expressions.

White space, line and match rules are those of Python strings: Unicode white space and the separators
U+001C to U+001F are stripped, all line boundaries split lines, patterns are Unicode-aware.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What Python strips: Unicode white space and the separators U+001C to U+001F.
WHITE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    return F.btrim(col(c), F.lit(WHITE))


def rstrip(c: Column | str) -> Column:
    return F.rtrim(col(c), F.lit(WHITE))


def lstrip(c: Column | str) -> Column:
    return F.ltrim(col(c), F.lit(WHITE))


def full(c: Column | str, pattern: str, flags: str = "U") -> Column:
    """Whether all of the text matches."""
    return col(c).rlike(rf"(?{flags})\A(?:{pattern})\z")


def lines(c: Column | str) -> Column:
    """Lines without their ends; no last empty line, and none for an empty text."""
    whole = F.regexp_replace(col(c), rf"(?:{LINE_END})\z", "")
    return F.when(col(c) == "", F.array().cast("array<string>")).otherwise(F.split(whole, LINE_END, -1))


def truthy(c: Column | str) -> Column:
    """Null for an empty text."""
    return F.nullif(col(c), F.lit(""))


def strip_code_fence(c: Column | str) -> Column:
    """Without one outer fence of backticks and its language word."""
    s = strip(c)
    bare = F.regexp_replace(F.regexp_replace(s, r"(?U)\A```\w*\s*", ""), r"(?U)\s*```\z", "")
    return strip(F.when(F.startswith(s, F.lit("```")), bare).otherwise(s))


def clean_reply(c: Column | str) -> Column:
    """Without a fence and a leading speaker name."""
    return strip(F.regexp_replace(strip_code_fence(c), r"(?U)\A(?:assistant|Assistant)\s*[:：]\s*", ""))


def int_product(c: Column | str, default: int) -> Column:
    """Products like 1280*28*28; default where it is null."""
    text = col(c).cast("string")
    parts = F.filter(F.transform(F.split(text, r"\*"), strip), lambda x: x != "")
    return F.coalesce(F.aggregate(F.transform(parts, lambda x: x.cast("double").cast("bigint")), F.lit(1).cast("bigint"), lambda a, x: a * x), F.lit(default).cast("bigint"))


SPECIALS = {"\\": r"\textbackslash{}", "&": r"\&", "%": r"\%", "#": r"\#", "_": r"\_", "{": r"\{", "}": r"\}", "~": r"\textasciitilde{}", "^": r"\textasciicircum{}"}


MATH = r"(?s)(\$\$.*?\$\$|\$[^$]*\$)"


def escape_outside_math(c: Column | str) -> Column:
    """LaTeX specials escaped, but for what stands between dollar signs."""
    cut = F.split(F.regexp_replace(col(c), MATH, "\ue003$1\ue003"), "\ue003", -1)

    def escaped(x: Column) -> Column:
        marked = F.regexp_replace(F.translate(x, "\\~^", "\ue000\ue001\ue002"), "([&%#_{}])", r"\\$1")
        for mark, key in (("\ue000", "\\"), ("\ue001", "~"), ("\ue002", "^")):
            marked = F.replace(marked, F.lit(mark), F.lit(SPECIALS[key]))
        return marked

    return F.array_join(F.transform(cut, lambda x, i: F.when(i % 2 == 1, x).otherwise(escaped(x))), "")


def latex_document(body: Column | str, lang: Column | str, source: Column | str) -> Column:
    """A whole document: ctexart for zh, else article; at most one blank line in a row."""
    tight = F.regexp_replace(escape_outside_math(strip(body)), r"\n{3,}", "\n\n")
    head = F.when(col(lang) == "zh", F.lit("\\documentclass[12pt]{ctexart}\n")).otherwise(F.lit("\\documentclass[12pt]{article}\n\\usepackage[utf8]{inputenc}\n"))
    return F.concat(F.lit("% Auto OCR export: "), col(source), F.lit("\n"), head, F.lit("\\usepackage{amsmath,amssymb}\n\\usepackage{geometry}\n\\geometry{margin=2.2cm}\n\\begin{document}\n\n"), tight, F.lit("\n\n\\end{document}\n"))


def safe_stem(c: Column | str, default: str = "pdf") -> Column:
    """A file name's stem with runs of other characters as one underscore each."""
    name = F.regexp_replace(F.regexp_replace(col(c), r"\A.*/", ""), r"(?<=.)\.[^.]*\z", "")
    return F.coalesce(truthy(F.regexp_replace(F.regexp_replace(name, r"(?U)[^\w\x{4e00}-\x{9fff}-]+", "_"), r"\A_+|_+\z", "")), F.lit(default))


def dollar_math(c: Column | str) -> Column:
    r"""\( \) and \[ \] as dollar signs."""
    return F.regexp_replace(F.regexp_replace(col(c), r"(?s)\\\((.+?)\\\)", r"\$$1\$"), r"(?s)\\\[(.+?)\\\]", r"\$\$$1\$\$")


def strip_model_junk(c: Column | str) -> Column:
    """Without <|…|> tokens and box tags."""
    return strip(F.regexp_replace(F.regexp_replace(col(c), r"<\|[^|>]+\|>", ""), r"(?i)</?box>", ""))


TODO = "% TODO: verify unpaired dollar"


def mark_unpaired_dollars(c: Column | str) -> Column:
    """One comment, before the document's end, where single dollar signs don't pair."""
    plain = F.regexp_replace(col(c), r"(?s)\$\$.*?\$\$", "")
    odd = (F.regexp_count(plain, F.lit(r"\$")) % 2 == 1) & ~F.contains(col(c), F.lit(TODO))
    end = r"(?si)\A(.*?)(\\end\{document\})"
    inside = F.regexp_replace(col(c), end, f"$1{TODO}\n$2")
    return F.when(odd & col(c).rlike(end), inside).when(odd, F.concat(rstrip(c), F.lit(f"\n{TODO}\n"))).otherwise(col(c))


def ensure_table_packages(c: Column | str) -> Column:
    """longtable and array loaded where a longtable needs them and no preamble names it."""
    named = F.contains(col(c), F.lit("\\usepackage{longtable")) | F.contains(F.substring_index(col(c), "\\begin{document}", 1), F.lit("longtable"))
    need = F.contains(col(c), F.lit("\\begin{longtable}")) & ~named
    added = r"\\usepackage{longtable,array}" + "\n"
    packages, head = r"(?s)\A(.*?\\usepackage\{[^}]*\}\n)", r"(?s)\A(.*?\\documentclass(?:\[[^\]]*\])?\{[^}]*\}\n)"
    put = lambda pattern: F.regexp_replace(col(c), pattern, "$1" + added)
    return F.when(~need, col(c)).when(col(c).rlike(packages), put(packages)).when(col(c).rlike(head), put(head)).otherwise(F.concat(F.lit("\\usepackage{longtable,array}\n"), col(c)))


def display_math(c: Column | str) -> Column:
    """A formula on its own, between double dollar signs; an empty one stays empty."""
    bare = strip(F.regexp_replace(strip(strip_code_fence(c)), r"\A\$+|\$+\z", ""))
    return F.when(bare == "", F.lit("")).otherwise(F.concat(F.lit("$$\n"), bare, F.lit("\n$$")))


DOCUMENT = r"(\\documentclass.*?\\end\{document\})"


def extract_document(c: Column | str) -> Column:
    """A whole document inside a reply, null if there is none."""
    fenced = F.regexp_extract(col(c), rf"(?si)```(?:latex|tex)?\s*{DOCUMENT}\s*```", 1)
    return F.coalesce(truthy(strip(fenced)), truthy(strip(F.regexp_extract(col(c), rf"(?si){DOCUMENT}", 1))))


def document_body(c: Column | str) -> Column:
    """What stands between \\begin{document} and \\end{document}, else all."""
    pattern = r"(?si)\\begin\{document\}(.*)\\end\{document\}"
    return strip(F.when(col(c).rlike(pattern), F.regexp_extract(col(c), pattern, 1)).otherwise(col(c)))


def wrap_document(body: Column | str) -> Column:
    head = "\\documentclass[12pt]{ctexart}\n\\usepackage{amsmath,amssymb,booktabs}\n\\usepackage{longtable,array}\n\\usepackage{geometry}\n\\geometry{margin=2.2cm}\n\\begin{document}\n\n"
    return F.concat(F.lit(head), strip(body), F.lit("\n\n\\end{document}\n"))


def parse_polish(reply: Column | str, draft: Column | str) -> Column:
    """(txt, tex, warning) of a reply: its marked parts, else a document in it, else the draft."""
    txt, tex = r"(?si)<<<TXT>>>\s*(.*?)\s*<<<TEX>>>", r"(?si)<<<TEX>>>\s*(.*)\z"
    marked = col(reply).rlike(txt) & col(reply).rlike(tex)
    found = extract_document(reply)
    answer = lambda a, b, w: F.struct(a.alias("txt"), b.alias("tex"), w.cast("string").alias("warning"))
    return F.when(marked, answer(strip(F.regexp_extract(col(reply), txt, 1)), strip(F.regexp_extract(col(reply), tex, 1)), F.lit(None))).when(
        found.isNotNull(), answer(document_body(found), found, F.lit(None))
    ).otherwise(answer(col(draft), wrap_document(draft), F.lit("polish parse fail; draft wrapped")))


def normal_lines(c: Column | str) -> Column:
    """LF line ends and no white space at line ends; for ASCII text all there is to normalising."""
    unix = F.regexp_replace(col(c), r"\r\n?", "\n")
    return F.array_join(F.transform(F.split(unix, "\n", -1), rstrip), "\n")


def guess_language(c: Column | str) -> Column:
    """zh or en by shares of CJK and Latin letters, null for short or mixed text."""
    text = strip(F.coalesce(col(c), F.lit("")))
    cjk = F.regexp_count(text, F.lit(r"[\x{4e00}-\x{9fff}]"))
    latin = F.regexp_count(text, F.lit("[A-Za-z]"))
    total = F.greatest(cjk + latin, F.lit(1))
    return F.when(F.length(text) < 8, F.lit(None)).when(cjk / total >= 0.4, "zh").when(latin / total >= 0.6, "en")


def normalize_lang(c: Column | str) -> Column:
    low = F.lower(strip(c))
    return F.when(low.isin("zh", "en"), low).otherwise(F.raise_error(F.concat(F.lit("unsupported language: "), F.coalesce(col(c), F.lit("null")))).cast("string"))


def job_id(doc: Column | str, clock: Column) -> Column:
    """Time and document, by a clock that callers pass."""
    return F.concat(F.date_format(clock, "yyyyMMdd-HHmmss"), F.lit("-"), col(doc))
