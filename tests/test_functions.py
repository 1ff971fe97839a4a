"""Column expressions against the standard library and by hand."""

import html
import random
from html.entities import html5

from pyspark.sql import functions as F

from strandweave.functions import text


def test_unescape_html(spark):
    rng = random.Random(3)
    names = sorted(html5)
    odd = [None, "", "plain", "&", "&&amp;", "a&b", "&#;", "&#x;", "&#38;lt;", "&amp;lt;", "&#128;", "&#x81;", "&#1114112;", "&#99999999999999999999999;", "&#xD800;", "&#0;", "&#x0;", "&#00000065;", "&#xFFFE", "&#x1FFFF;", "&#xFEFF;", "&#64976;", "&#11;", "&#13;", "&#127;", "&notit;", "&notin;", "&NotEqualTilde;", "&ampamp;", "&am", "& amp;", "&amp", "é&eacute;日&#x65E5", "&#X41;&#x41"]
    made = ["".join(rng.choice(["&" + rng.choice(names), "&" + rng.choice(names)[:-1], f"&#{rng.randint(0, 1200000)};", f"&#x{rng.randint(0, 0x11FFFF):x}", "&", ";", "x", " ", "<"]) for _ in range(rng.randint(1, 9))) for _ in range(1500)]
    rows = list(enumerate([*odd, *("&" + n for n in names), *made, "&amp; " * 20000]))
    df = spark.createDataFrame(rows, "id long, t string")
    for r in df.select("id", "t", text.unescape_html(F.col("t")).alias("got")).collect():
        assert r["got"] == (None if r["t"] is None else html.unescape(r["t"])), r["t"][:80]


def test_strip(spark):
    texts = [None, "", " ", "a", " \t a b \u00a0\u3000", "\u2003x\u2029", "\x0b\x0c\r\n", "\u200bx\u200b", "é "]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(text.strip(F.col("t"))).collect()] == [None if t is None else t.strip() for t in texts]


def test_pieces(spark):
    """Folds over brackets go over the marks and what is between them, not over every character."""
    row = spark.sql("SELECT 'ab (c]) 日' AS t, '' AS e").select(text.pieces(F.col("t"), "()[]"), text.pieces(F.col("e"), "()")).first()
    assert list(row) == [["ab ", "(", "c", "]", ")", " 日"], []]
