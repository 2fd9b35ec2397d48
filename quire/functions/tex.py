"""A small reader of TeX: tokens, commands with their arguments, and one pass that rewrites commands."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from typing import NamedTuple


class Token(NamedTuple):
    kind: str  # pair (a backslash and a sign), command, open, close, dollar, cjk or text
    start: int
    end: int


MARKS = {"{": "open", "}": "close", "$": "dollar"}
LETTERS, CJK = re.compile("[A-Za-z]*"), re.compile("[\u4e00-\u9fff]")


def is_cjk(c: str) -> bool:
    return "\u4e00" <= c <= "\u9fff"


def is_letter(c: str) -> bool:
    return c.isascii() and c.isalpha()


def word_sign(c: str) -> bool:
    return c.isalnum() or c == "_"


def run(text: str, at: int, good: Callable[[str], bool]) -> int:
    """Where a run of good signs from a place on ends."""
    while at < len(text) and good(text[at]):
        at += 1
    return at


def tokens(text: str, at: int = 0) -> Iterator[Token]:
    """A text's tokens; a backslash takes the sign or the letters behind it along."""
    n = len(text)
    while at < n:
        c = text[at]
        if c == "\\" and at + 1 < n:
            end = run(text, at + 1, is_letter)
            kind = "command" if end > at + 1 else "pair"
            end = max(end, at + 2)
        elif is_cjk(c):
            kind, end = "cjk", run(text, at, is_cjk)
        elif c in MARKS:
            kind, end = MARKS[c], at + 1
        else:
            kind, end = "text", at + 1
        yield Token(kind, at, end)
        at = end


def name_at(text: str, at: int) -> tuple[str, int]:
    """The letters behind the backslash at a place, and where they end."""
    if not text.startswith("\\", at):
        return "", at
    end = LETTERS.match(text, at + 1).end()
    return text[at + 1 : end], end


def whole_word(text: str, end: int) -> bool:
    """Whether a name that ends here isn't part of a longer word."""
    return end >= len(text) or not word_sign(text[end])


def argument(text: str, at: int, marks: str = "{}") -> tuple[str, int] | None:
    """What stands between the marks that open at a place, up to the first that closes, and where that ends."""
    end = text.find(marks[1], at) if text[at : at + 1] == marks[0] else -1
    return None if end < 0 else (text[at + 1 : end], end + 1)


def rewritten(text: str, rule: Callable[[str, int], tuple[str, int] | None]) -> str:
    """A text with commands replaced: rule gets the text and the place of each backslash, and gives
    what to put there and where to go on, or null to leave it."""
    out, done, at = [], 0, 0
    while (at := text.find("\\", at)) >= 0:
        if put := rule(text, at):
            out += [text[done:at], put[0]]
            done = at = put[1]
        else:
            at += 1
    return "".join(out) + text[done:] if out else text


def commands(text: str) -> Iterator[int]:
    """Places of backslashes."""
    at = -1
    while (at := text.find("\\", at + 1)) >= 0:
        yield at


def balanced(text: str, at: int) -> int | None:
    """Behind the brace that closes the one at a place; null where none opens or it doesn't close."""
    depth = 0
    if text[at : at + 1] != "{":
        return None
    for t in tokens(text, at):
        depth += {"open": 1, "close": -1}.get(t.kind, 0)
        if not depth:
            return t.end
    return None
