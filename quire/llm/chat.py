"""Operator 7: chat formatting by schema fingerprints, in DataFrame operations only.

Records are JSON objects of different layouts: messages, whose content may be a text or a list of parts, turns with from and
value, prompt and response, instruction with input and output. A record's fingerprint is the hash of the nested
field paths that it has itself, as far as some mapping knows them; it selects the declarative mapping of its layout, which
gives canonical turns (role, text). A mapping lists the paths it needs and those that may come with them.

Paths are read off the record's schema. For this its texts are cut out first, so that texts of any length do.

Turns are formatted as ``<|im_start|>role``, a line end, the text, ``<|im_end|>`` and a line end. Control strings inside
texts get a backslash behind their first character, and one more where there are some already, so that
``parse`` gets back exactly what was formatted. The output is a list of segments with the loss mask on them:
assistant texts alone are learnt from.

Defined cases: null roles and texts are empty; a record that is null, no JSON object or of no known layout has a null
layout, no turns and an empty format; fields that no mapping knows, nulls and empty lists are no paths and change nothing; of a text
in two fields of one meaning (output and response) the first that isn't empty counts; turns with equal numbers come
in the order of role and text; null conversation ids are one conversation; repeated rows are repeated turns.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
LONGEST = 2**31 - 1  # characters of a string in JSON: more than a string of Spark can hold
CONTROL = r"([<\[])(\\*)(\|im_start\|>|\|im_end\|>|\|endoftext\|>|/?s>|/?INST\]|/?SYS>)"
ESCAPED = r"([<\[])\\(\\*)(\|im_start\|>|\|im_end\|>|\|endoftext\|>|/?s>|/?INST\]|/?SYS>)"
SCHEMA = "messages array<struct<role:string,content:string>>, conversations array<struct<`from`:string,value:string>>, system string, prompt string, response string, completion string, instruction string, input string, output string"
PARTS = "array<struct<text:string>>"


def turn(role: Column | str, text: Column) -> Column:
    return F.struct(F.coalesce(role if isinstance(role, Column) else F.lit(role), F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))


def skeleton(record: Column) -> Column:
    """A record with all its texts empty, but for its keys; escapes go first, so that quotes are those around texts."""
    flat = F.replace(F.replace(record, F.lit("\\\\")), F.lit('\\"'))
    marked = F.regexp_replace(flat, r'("[^"]*+"\s*+:)|"[^"]*+"', "$1\x01")  # a key and a mark, or a text's mark
    texts = F.regexp_replace(marked, ":\x01(\\s*+)\x01", ':$1""')
    return F.replace(F.replace(texts, F.lit(":\x01"), F.lit(":")), F.lit("\x01"), F.lit('""'))


def paths(record: Column) -> Column:
    """Nested paths of a JSON record's fields that hold something, in order; a list adds [] to its path. Null for what
    is no JSON. They come of the record's schema, by one fold over its signs with a stack of open brackets."""
    schema = F.schema_of_variant(F.try_parse_json(skeleton(record)))
    signs = F.regexp_extract_all(schema, F.lit(r"((?:`(?:[^`]|``)*`|[^<>,:`()]+): |OBJECT<|ARRAY<|>|VOID|[A-Z]+)"), F.lit(1))
    state = F.struct(F.array(F.lit("")).alias("open"), F.lit("").alias("at"), F.array().cast("array<string>").alias("found"))

    def step(x: Column, sign: Column) -> Column:
        top = F.element_at(x["open"], -1)
        pushed = lambda y: F.concat(x["open"], F.array(y))
        make = lambda opened, at, found: F.struct(opened.alias("open"), at.alias("at"), found.alias("found"))
        listed = F.concat(x["at"], F.lit("[]"))
        return (
            F.when(F.endswith(sign, F.lit(": ")), make(x["open"], F.concat(top, F.btrim(F.substring_index(sign, ": ", 1), F.lit(" `"))), x["found"]))
            .when(sign == "OBJECT<", make(pushed(F.when(x["at"] == "", F.lit("")).otherwise(F.concat(x["at"], F.lit(".")))), x["at"], x["found"]))
            .when(sign == "ARRAY<", make(pushed(listed), listed, x["found"]))
            .when(sign == ">", make(F.slice(x["open"], 1, F.size(x["open"]) - 1), x["at"], x["found"]))
            .when(sign == "VOID", x)
            .otherwise(make(x["open"], x["at"], F.concat(x["found"], F.array(x["at"]))))
        )

    return F.when(schema.startswith("OBJECT<"), F.array_sort(F.array_distinct(F.aggregate(signs, state, step, lambda x: x["found"]))))


def fingerprint(found: Column) -> Column:
    return F.xxhash64(F.array_join(found, "\n"))


def first_of(*texts: Column) -> Column:
    """The first text that isn't empty, else the last."""
    return F.coalesce(*[F.nullif(t, F.lit("")) for t in texts], texts[-1])


ASK = lambda r: F.when(F.coalesce(r["input"], F.lit("")) == "", r["instruction"]).otherwise(F.concat(r["instruction"], F.lit("\n\n"), r["input"]))
ROLES = {"human": "user", "gpt": "assistant"}
NAMED = lambda role: reduce(lambda out, kv: F.when(role == kv[0], kv[1]).otherwise(out), ROLES.items(), role)
JOINED = lambda content: F.array_join(F.transform(F.from_json(content, PARTS, {"maxStringLen": str(LONGEST)}), lambda p: F.coalesce(p["text"], F.lit(""))), "")
#: Name, paths a layout needs, paths that may come with them, and what makes turns of it. A system text comes first.
LAYOUTS: list[tuple[str, set[str], set[str], Callable[[Column], Column]]] = [
    ("messages", {"messages[].role"}, {"messages[].content", "system"}, lambda r: F.transform(r["messages"], lambda m: turn(m["role"], m["content"]))),
    ("texts", {"messages[].content"}, {"system"}, lambda r: F.transform(r["messages"], lambda m: turn(m["role"], m["content"]))),
    ("parts", {"messages[].role", "messages[].content[].text"}, {"messages[].content[].type", "system"}, lambda r: F.transform(r["messages"], lambda m: turn(m["role"], JOINED(m["content"])))),
    ("conversations", {"conversations[].from"}, {"conversations[].value", "system"}, lambda r: F.transform(r["conversations"], lambda m: turn(NAMED(m["from"]), m["value"]))),
    ("values", {"conversations[].value"}, {"system"}, lambda r: F.transform(r["conversations"], lambda m: turn(NAMED(m["from"]), m["value"]))),
    ("pair", {"prompt", "response"}, {"system", "instruction", "completion"}, lambda r: F.array(turn("user", r["prompt"]), turn("assistant", first_of(r["response"], r["completion"])))),
    ("completion", {"prompt", "completion"}, {"system", "instruction"}, lambda r: F.array(turn("user", r["prompt"]), turn("assistant", r["completion"]))),
    ("prompt", {"prompt"}, {"system", "instruction"}, lambda r: F.array(turn("user", r["prompt"]))),
    ("task", {"instruction", "output"}, {"input", "response", "system"}, lambda r: F.array(turn("user", ASK(r)), turn("assistant", first_of(r["output"], r["response"])))),
    ("answer", {"instruction", "response"}, {"input", "system"}, lambda r: F.array(turn("user", ASK(r)), turn("assistant", r["response"]))),
]
KNOWN = sorted(set().union(*(need | may for _, need, may, _ in LAYOUTS)))


def with_system(made: Column, r: Column, name: str) -> Column:
    """Turns with a system text before them, where the record has one; beside a prompt an instruction is one too."""
    said = F.coalesce(r["system"], F.nullif(r["instruction"], F.lit(""))) if name in ("pair", "completion", "prompt") else r["system"]
    return F.when(said.isNotNull(), F.concat(F.array(turn("system", said)), made)).otherwise(made)


def combinations(need: set[str], may: set[str]) -> list[list[str]]:
    """All sets of paths that a layout takes, each sorted."""
    return [sorted(need.union(more)) for n in range(len(may) + 1) for more in itertools.combinations(sorted(may), n)]


NO_TURNS = "array<struct<role:string,text:string>>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once, however often body names it."""
    return F.get(F.transform(F.array(value), lambda x: body(x)), F.lit(0))


def layout_of(record: Column) -> Column:
    """The name of the layout whose fingerprint a record has, null if there is none."""
    told = F.array_intersect(F.array(*map(F.lit, KNOWN)), paths(record))
    marks: dict[str, str] = {}
    for name, need, may, _ in LAYOUTS:  # of layouts that take the same paths the first counts
        for found in combinations(need, may):
            marks.setdefault("\n".join(found), name)
    table = F.create_map(*[x for found, name in marks.items() for x in (F.xxhash64(F.lit(found)), F.lit(name))])
    return F.try_element_at(table, fingerprint(F.array_sort(told)))


def canonical(record: Column, layout: Column | None = None) -> Column:
    """Turns of a JSON record by the mapping that its fingerprint selects."""

    def chosen(r: Column, name: Column) -> Column:
        out = F.array().cast(NO_TURNS)
        for own, _, _, make in LAYOUTS:
            out = F.when(name == own, with_system(make(r), r, own)).otherwise(out)
        return out

    name = layout_of(record) if layout is None else layout
    return let(F.from_json(record, SCHEMA, {"maxStringLen": str(LONGEST)}), lambda r: let(name, lambda mark: chosen(r, mark)))


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def escape_role(role: Column) -> Column:
    """A role on one line: per cent signs and line ends are escaped too."""
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def segments(turns: Column) -> Column:
    """The format of turns as (text, loss) pieces; joined, they are the formatted text."""
    part = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    no = F.lit(False)
    return F.flatten(F.transform(turns, lambda t: F.array(part(F.concat(F.lit(START), escape_role(t["role"]), F.lit("\n")), no), part(escape(t["text"]), t["role"] == "assistant"), part(F.lit(END + "\n"), no))))


def joined(pieces: Column) -> Column:
    return F.array_join(F.transform(pieces, lambda p: p["text"]), "")


def unescape_each(pieces: Column) -> Column:
    """All text under the loss mask, as it was before formatting."""
    return F.array_join(F.transform(F.filter(pieces, lambda p: p["loss"]), lambda p: unescape(p["text"])), "")


def parse(formatted: Column) -> Column:
    """The turns of a formatted text."""
    parts = F.split(formatted, r"<\|im_end\|>\n", -1)
    body = F.transform(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))), lambda p: F.substr(p, F.lit(len(START) + 1)))
    return F.transform(body, lambda p: F.struct(unescape_role(F.substring_index(p, "\n", 1)).alias("role"), unescape(F.substr(p, F.instr(p, "\n") + 1)).alias("text")))


def format_records(df: DataFrame, id_col: str = "conv_id", record_col: str = "record") -> DataFrame:
    """(id, layout, segments) of records; a null layout tells of a record that no mapping takes."""
    named = df.select(id_col, F.col(record_col).alias("record"), layout_of(F.col(record_col)).alias("layout"))
    told = named.select(id_col, "layout", canonical(F.col("record"), F.col("layout")).alias("turns"))
    return told.select(id_col, "layout", segments(F.col("turns")).alias("segments"))


def records_of(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(id, record) of a table with a row for each turn: the shortest layout that holds a conversation as it is."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    grouped = turns.groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct(F.col(turn_col).alias("turn"), text(role_col).alias("role"), text(text_col).alias("text")))).alias("t"))
    roles, t = F.array_join(F.transform("t", lambda x: x["role"]), "\n"), F.col("t")
    record = F.to_json(F.struct(F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("content"))).alias("messages")))
    # Roles that go by other names in this layout come back as they were; others would change.
    back = {v: k for k, v in ROLES.items()}
    alien = lambda role: reduce(lambda out, kv: F.when(role == kv[0], kv[1]).otherwise(out), back.items(), role)
    plain = F.forall("t", lambda x: x["role"].isin("user", "assistant", "system"))
    record = F.when(plain, F.to_json(F.struct(F.transform("t", lambda x: F.struct(alien(x["role"]).alias("from"), x["text"].alias("value"))).alias("conversations")))).otherwise(record)
    record = F.when(roles == "user\nassistant", F.to_json(F.struct(F.get(t, F.lit(0))["text"].alias("prompt"), F.get(t, F.lit(1))["text"].alias("response")))).otherwise(record)
    record = F.when(roles == "system\nuser\nassistant", F.to_json(F.struct(F.get(t, F.lit(0))["text"].alias("system"), F.get(t, F.lit(1))["text"].alias("instruction"), F.get(t, F.lit(2))["text"].alias("output")))).otherwise(record)
    return grouped.select(id_col, record.alias("record"))
