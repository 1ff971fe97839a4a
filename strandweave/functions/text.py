"""Text values: white space, folding, buckets, splitting outside brackets."""

from __future__ import annotations

import json
import re
import unicodedata
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Punctuation trimmed from manufacturer names.
EDGE_PUNCTUATION = r"^[-.,;:/()\[\]{}]+|[-.,;:/()\[\]{}]+$"


#: White space: the ASCII controls among it, and all separators of Unicode.
WHITE = "\t\n\x0b\x0c\r" + "".join(chr(i) for i in range(0x10000) if unicodedata.category(chr(i))[0] == "Z")


def strip(c: Column) -> Column:
    """Without Unicode white space at the ends."""
    return F.btrim(c, F.lit(WHITE))


def text_or_empty(c: Column) -> Column:
    return strip(F.coalesce(c, F.lit("")))


def fold(c: Column) -> Column:
    """A key for comparing without case."""
    return F.lower(F.upper(c))


def collapse_whitespace(c: Column) -> Column:
    """Runs of white space become one space; none at the ends; null becomes empty."""
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"[\s\p{Z}]+", " "))


def empty_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def digits(c: Column, kind: str = "bigint") -> Column:
    """The number if the trimmed text is digits only, else null."""
    t = strip(c)
    return F.when(t.rlike("^[0-9]+$"), t.try_cast(kind))


def truthy(c: Column) -> Column:
    """yes, true, 1, y and t in any case are true; all else, null too, is false."""
    return F.coalesce(F.lower(strip(c)).isin("1", "true", "yes", "y", "t"), F.lit(False))


def yes_no(c: Column) -> Column:
    return F.when(F.coalesce(c, F.lit(False)), "yes").otherwise("no")


def year_bucket(c: Column) -> Column:
    t = text_or_empty(c)
    return F.when(t.rlike("^[0-9]{4}$"), t).otherwise("unknown")


def manufacturer_bucket(c: Column) -> Column:
    t = strip(F.regexp_replace(text_or_empty(c), EDGE_PUNCTUATION, ""))
    return F.when(t == "", "unknown").otherwise(t)


def number_bucket(c: Column) -> Column:
    """The number as text, or unknown."""
    return F.coalesce(c.cast("string"), F.lit("unknown"))


def pieces(c: Column, marks: str) -> Column:
    """A text cut to an array: each of the characters ``marks`` alone, and what stands between them."""
    some = re.escape(marks)
    return F.regexp_extract_all(c, F.lit(f"[{some}]|[^{some}]+"), F.lit(0))


def split_outside_parens(c: Column) -> Column:
    """Trimmed, non-empty parts between slashes that are not inside parentheses; an unmatched ) closes nothing."""
    begin = F.struct(F.lit(0).alias("depth"), F.lit("").alias("out"))

    def step(acc: Column, ch: Column) -> Column:
        depth = F.when(ch == "(", acc["depth"] + 1).when(ch == ")", F.greatest(F.lit(0), acc["depth"] - 1)).otherwise(acc["depth"])
        piece = F.when((ch == "/") & (acc["depth"] == 0), F.lit("\x1f")).otherwise(ch)
        return F.struct(depth.alias("depth"), F.concat(acc["out"], piece).alias("out"))

    marked = F.aggregate(pieces(F.coalesce(c, F.lit("")), "()/"), begin, step, lambda acc: acc["out"])
    return F.filter(F.transform(F.split(marked, "\x1f"), strip), lambda p: p != "")


def join_ampersand(items: Column) -> Column:
    """a; a & b; a, b & c."""
    n = F.size(items)
    return F.when(n < 2, F.array_join(items, "")).otherwise(F.concat(F.array_join(F.slice(items, F.lit(1), F.greatest(n - 1, F.lit(0))), ", "), F.lit(" & "), F.element_at(items, -1)))


def format_manufacturers(c: Column) -> Column:
    return join_ampersand(split_outside_parens(c))


def not_available(c: Column) -> Column:
    """Whether a label is a form of <not available>."""
    return F.coalesce(c.rlike(r"(?i)^\s*<\s*not\s+available\s*>\s*$"), F.lit(False))


def section_label(c: Column) -> Column:
    return F.upper(collapse_whitespace(c))


def text_hash(c: Column) -> Column:
    """The first 8 hex digits of SHA-1."""
    return F.substring(F.sha1(c), 1, 8)


def finding_key(rule: Column, machine: Column, section: Column, source_text: Column, value: Column) -> Column:
    """A key that stays the same over releases: SHA-256 of the finding as JSON with sorted keys, nulls left out."""
    return F.sha2(F.to_json(F.struct(machine.alias("machine"), rule.alias("rule_id"), section.alias("section"), source_text.alias("source_text"), value.alias("value"))), 256)


def _code_char(code: Column) -> Column:
    """The character of a numeric reference, by HTML's rules; a null code is one past all characters.

    0x80 to 0x9F mean what Windows-1252 has there, surrogates, zero and codes past the last give U+FFFD, other
    controls and the code points that Unicode keeps out of text give nothing.
    """
    legacy = {n: bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(0x80, 0xA0)}
    table = F.create_map(*(F.lit(x) for pair in legacy.items() for x in pair))
    control = ((code < 0x20) & ~code.isin(0x09, 0x0A, 0x0C, 0x0D)) | (code == 0x7F)
    kept_out = code.between(0xFDD0, 0xFDEF) | (code.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE)
    char = F.decode(F.unhex(F.concat(F.lit("0000FEFF"), F.lpad(F.hex(code), 8, "0"))), "UTF-32")  # a byte order mark, then the code
    bad = code.isNull() | (code == 0) | (code > 0x10FFFF) | code.between(0xD800, 0xDFFF)
    return F.when(bad, "\ufffd").when(code.between(0x80, 0x9F), F.element_at(table, code)).when(control | kept_out, "").otherwise(char)


def unescape_html(c: Column) -> Column:
    """Character references of HTML decoded in one pass from left to right; what isn't one stays, null stays null.

    Names are those of Python's html.entities, looked up whole, else by their longest beginning that may go without a
    semicolon (&notit; is &not and it;). What a reference gives is not decoded again.
    """
    table = F.from_json(F.lit(json.dumps(html5)), "map<string,string>")
    bare = "|".join(sorted((n for n in html5 if n[-1] != ";"), key=len, reverse=True))

    def first(value: Column, then) -> Column:  # a lambda's variable is computed once
        return F.get(F.transform(F.array(value), then), F.lit(0))

    def numeric(piece: Column, pattern: str, base: int, most: int) -> Column:
        digits = F.regexp_replace(F.regexp_extract(piece, pattern, 1), "^0+(?=.)", "")
        code = F.when(F.length(digits) <= most, F.conv(digits, base, 10).cast("int"))
        return F.concat(first(code, _code_char), F.regexp_replace(piece, pattern, ""))

    def named(piece: Column) -> Column:
        def decoded(name: Column) -> Column:
            start = F.regexp_extract(name, f"^(?:{bare})", 0)
            rest = lambda n: F.substring(piece, F.length(n) + 1, F.length(piece))
            whole = F.element_at(table, name)
            return F.when(whole.isNotNull(), F.concat(whole, rest(name))).when(start != "", F.concat(F.element_at(table, start), rest(start))).otherwise(F.concat(F.lit("&"), piece))

        return first(F.regexp_extract(piece, r"^[^\t\n\f <&#;]{1,32};?", 0), decoded)

    decimal, hexa = r"^#([0-9]+);?", r"^#[xX]([0-9a-fA-F]+);?"

    def one(piece: Column, at: Column) -> Column:
        return F.when(at == 0, piece).when(piece.rlike(decimal), numeric(piece, decimal, 10, 7)).when(piece.rlike(hexa), numeric(piece, hexa, 16, 6)).otherwise(named(piece))

    return F.array_join(F.transform(F.split(c, "&", -1), one), "")


def unbalanced(c: Column, opening: str, closing: str) -> Column:
    """Whether opening and closing brackets differ in number."""
    t = F.coalesce(c, F.lit(""))
    return F.length(F.replace(t, F.lit(opening), F.lit(""))) != F.length(F.replace(t, F.lit(closing), F.lit("")))


def infix_brackets(c: Column) -> Column:
    """Whether a parenthesis stands inside a word, as in a(b)c."""
    return F.coalesce(c.rlike(r"[A-Za-z0-9]\([^()\[\]]+\)[A-Za-z0-9]"), F.lit(False))
