"""Secret scans: fixed patterns, and character Markov models of random strings against ordinary identifiers."""

from __future__ import annotations

import json
from dataclasses import dataclass
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import hash01, materialize

#: The base kinds in order, with what counts of a match.
NAME = r"""(?i:password|passwd|secret|token|api_?key)"""
ASSIGN = NAME + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA([A-Z0-9]{12,})"
HEX = r"([0-9a-f]{32,})"
MIN_VALUE = 8
#: Strings that the models judge, and the characters they know. Matches of ASSIGN go first: a candidate never begins in one.
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
#: A candidate with one of these holds a base span, or the name of one.
BASE = NAME + "|AKIA[A-Z0-9]{12}|[0-9a-f]{32}"
WORD = r"[A-Za-z0-9+/_=-]{6,}"
#: What a text has to hold for any base span or candidate: found by one search, which most texts end without a match.
ANY = r"""(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20}|[:=]\x20*["']?[A-Za-z0-9+/_.=-]{8}|AKIA"""
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: Documents of each class, with base spans and without, that give training samples, at most (the smallest id hashes).
TRAIN_DOCS = 2000
#: Counts added to each character, and to each character's followers in proportion to the characters' frequencies.
SMOOTHING, BACKOFF = 0.5, 30.0
#: A candidate is random if its log-likelihood ratio is at least this much in all, and this much a character pair or, if that
#: is more, as much as only so small a share of ordinary strings held back from training reaches.
MIN_RATIO, MIN_MEAN, FALSE_SHARE = 12.0, 0.1, 0.001
#: One in so many ordinary strings, by hash, is held back; strings shorter than a candidate tell too little.
HELD, LEAST_CHARS = 5, 20
#: Ordinary identifiers are so many words in a row, joined in each of these ways.
JOINED_WORDS, JOINTS = 4, ("_", "-", "/")
_CUT, _MID, _OTHER = "\x01", "\x02", "\x03"
SPAN = "array<struct<start:int,kind:int,end:int,value:string>>"
#: Pieces between marks that are folded together: a fold copies what it has at each step, so it never takes more.
FOLD = 64


def spans(text: Column, pattern: str, kind: int, group: int = 1, least: int = 1) -> Column:
    """Leftmost non-overlapping matches of ``pattern`` whose value, the given ``group``, has ``least`` characters, as SPAN.

    Each is put between marks and followed by its value again, behind another mark, and read off the pieces between
    the marks; control characters of the text that could be marks give way to another one first, which moves nothing.

    Pieces are folded in groups of FOLD, then the groups' lengths are summed, so the work is linear in the matches."""
    plain = F.translate(text, _CUT + _MID, _OTHER + _OTHER)
    pieces = F.split(F.regexp_replace(plain, pattern, f"{_CUT}$0{_MID}${group}{_CUT}"), _CUT, -1)
    empty = F.expr(f"cast(array() as {SPAN})")

    def step(acc: Column, piece: Column) -> Column:
        hit = F.contains(piece, F.lit(_MID))
        value = F.substring_index(piece, _MID, -1)
        end = acc["at"] + F.char_length(F.substring_index(piece, _MID, 1))
        one = F.struct(acc["at"].alias("start"), F.lit(kind).alias("kind"), end.alias("end"), value.alias("value"))
        return F.struct(end.alias("at"), F.when(hit & (F.char_length(value) >= least), F.concat(acc["out"], F.array(one))).otherwise(acc["out"]).alias("out"))

    start = F.struct(F.lit(0).alias("at"), empty.alias("out"))
    groups = lambda p: F.transform(F.sequence(F.lit(1), F.size(p), F.lit(FOLD)), lambda i: F.aggregate(F.slice(p, i, F.lit(FOLD)), start, step))

    def place(acc: Column, group: Column) -> Column:
        return F.struct((acc["at"] + group["at"]).alias("at"), F.concat(acc["before"], F.array(acc["at"])).alias("before"))

    def joined(g: Column) -> Column:
        first = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<int>)").alias("before"))
        before = F.aggregate(g, first, place, lambda acc: acc["before"])
        move = lambda group, at: F.transform(group["out"], lambda s: F.struct((s["start"] + at).alias("start"), s["kind"].alias("kind"), (s["end"] + at).alias("end"), s["value"].alias("value")))
        return F.flatten(F.zip_with(g, before, move))

    # a lambda's variable is computed once, where an expression used twice would be computed twice
    once = lambda value, then: F.get(F.transform(F.array(value), then), F.lit(0))
    return once(pieces, lambda p: F.when(F.size(p) > 1, once(groups(p), joined)).otherwise(empty))


def candidates(text: Column) -> Column:
    """The strings that the models judge, as SPAN of kind 3: runs of 20 or more characters of ALPHABET that neither
    begin in an assign match nor hold a base span of another kind or the name of an assign match."""
    found = spans(text, f"{ASSIGN}|({CANDIDATE})", 3, group=2)  # the value of an assign match is empty here
    return F.filter(found, lambda s: ~s["value"].rlike(BASE))


def base_spans(text: Column) -> Column:
    """The spans of the three fixed kinds, in the order of the kinds."""
    return F.concat(spans(text, ASSIGN, 0, least=MIN_VALUE), spans(text, ACCESS, 1), spans(text, HEX, 2))


@dataclass
class Models:
    """Log-likelihood ratios (random over ordinary) of each pair of characters, row after row of the alphabet, and how much a
    pair a random string has at least."""

    ratio: list[float]
    mean: float = MIN_MEAN

    def column(self) -> Column:
        return F.from_json(F.lit(json.dumps(self.ratio)), "array<double>")


def train(samples: DataFrame) -> Models:
    """Two first-order Markov models from labelled samples (value string, random boolean), each value once.

    Pair counts of all samples are summed in Spark; at most two per pair of ALPHABET come to the driver. Pairs never
    seen fall back on the frequency of the second character; without samples of a class all are equally likely; null
    values and characters outside ALPHABET are left out. Ordinary strings of LEAST_CHARS that are held back set the
    threshold; without any it is MIN_MEAN.
    """
    samples = materialize(samples.where("value <> ''").distinct(), "secret-values")
    held = ~F.col("random") & (F.char_length("value") >= LEAST_CHARS) & (F.pmod(hash01("value", seed=13), F.lit(HELD)) == 0)
    ordinary = samples.where(held)
    models = _fit(samples.where(~held))
    mean = log_ratio(F.col("value"), models) / (F.char_length("value") - 1)
    told = ordinary.agg(F.percentile_approx(mean, 1 - FALSE_SHARE, 10_000).alias("mean")).first()["mean"]
    return Models(models.ratio, max(MIN_MEAN, round(told, 4)) if told is not None else MIN_MEAN)


def _fit(samples: DataFrame) -> Models:
    n = len(ALPHABET)
    index = F.transform(F.split("value", ""), lambda c: F.instr(F.lit(ALPHABET), c))
    pairs = samples.where("value <> ''").select("random", index.alias("x")).withColumn("x", F.filter("x", lambda i: i > 0))
    pairs = pairs.where(F.size("x") > 1).select("random", F.explode(F.arrays_zip(F.expr("slice(x, 1, size(x) - 1)").alias("a"), F.expr("slice(x, 2, size(x) - 1)").alias("b"))).alias("p"))
    counts = {(r["random"], r["a"] - 1, r["b"] - 1): r["count"] for r in pairs.groupBy("random", F.col("p.a").alias("a"), F.col("p.b").alias("b")).count().collect()}

    def logs(which: bool) -> list[float]:
        out = []
        single = [SMOOTHING + sum(counts.get((which, a, b), 0) for a in range(n)) for b in range(n)]
        share = [x / sum(single) for x in single]
        for a in range(n):
            row = [counts.get((which, a, b), 0) for b in range(n)]
            out += [log((x + BACKOFF * p) / (sum(row) + BACKOFF)) for x, p in zip(row, share, strict=True)]
        return out

    return Models([round(r - o, 4) for r, o in zip(logs(True), logs(False), strict=True)])


def samples(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Labelled samples: values of base spans are random; words are ordinary if no base span is in their document, and so
    are names made of words in a row (joined by JOINTS or as CamelCase).

    At most TRAIN_DOCS documents of each class give them, those of the smallest id hashes: of all documents with a
    base span, however rare they are, and of all without. They are chosen by one search of every text that ends at
    the first match, and written before spans are cut from them. Null ids give none.
    """
    every = docs.select(F.col(id_col).alias("_sw_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).where("_sw_id is not null")
    holds = F.col("text").rlike(ANY) & F.col("text").rlike(f"{ASSIGN[: -len('+)')]}{{{MIN_VALUE},}})|{ACCESS}|{HEX}")
    known = materialize(every.select("_sw_id", holds.alias("holds"), hash01("_sw_id", seed=9).alias("h")), "secret-classes")
    some = [known.where(F.col("holds") == which).select("_sw_id", "h").distinct().orderBy("h", "_sw_id").limit(TRAIN_DOCS).select("_sw_id") for which in (True, False)]
    text = materialize(every.join(F.broadcast(some[0].union(some[1]).distinct()), "_sw_id"), "secret-sample")
    text = text.withColumn("found", F.transform(base_spans(F.col("text")), lambda s: s["value"]))
    none = F.expr("cast(array() as array<string>)")
    words = F.regexp_extract_all("text", F.lit("[A-Za-z0-9]+"), F.lit(0))
    row = lambda i: F.slice("words", i * JOINED_WORDS + 1, F.lit(JOINED_WORDS))
    ways = [lambda i, j=j: F.array_join(row(i), j) for j in JOINTS] + [lambda i: F.array_join(F.transform(row(i), lambda w: F.initcap(w)), "")]
    each = F.when(F.size("words") > 0, F.transform(F.sequence(F.lit(0), F.floor((F.size("words") - 1) / JOINED_WORDS).cast("int")), lambda i: F.element_at(F.array(*(way(i) for way in ways)), (i % len(ways) + 1).cast("int")))).otherwise(none)
    text = text.withColumn("words", words)
    plain = F.when(F.size("found") == 0, F.array_distinct(F.concat(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), each))).otherwise(none)
    return text.select(F.explode("found").alias("value"), F.lit(True).alias("random")).union(text.select(F.explode(plain).alias("value"), F.lit(False)))


def log_ratio(value: Column, models: Models) -> Column:
    """Sum over the pairs of neighbouring characters."""
    n = len(ALPHABET)
    x = F.transform(F.split(value, ""), lambda c: F.instr(F.lit(ALPHABET), c))
    table = models.column()
    begin = F.struct(F.lit(0).alias("last"), F.lit(0.0).alias("sum"))

    def step(acc: Column, i: Column) -> Column:
        add = F.when((acc["last"] > 0) & (i > 0), F.get(table, (acc["last"] - 1) * n + i - 1)).otherwise(0.0)
        return F.struct(i.alias("last"), (acc["sum"] + add).alias("sum"))

    return F.aggregate(x, begin, step, lambda acc: acc["sum"])


def scan(docs: DataFrame, models: Models, text_col: str = "text", spans_col: str = "spans") -> DataFrame:
    """``docs`` with ``spans_col`` (SPAN; replaced if there): kinds 0 assign, 1 access, 2 hex, 3 random, by start, kind.

    Whole texts, positions in code points, ends exclusive; null text counts as empty and has none. Base matches are
    leftmost and do not overlap within their kind. A candidate (``candidates``) is random if the models'
    log-likelihood ratio says so. One search (ANY) passes over texts that can hold neither. Built-in expressions only; nothing is shuffled. Repeated rows and ties are judged
    alike, an empty table stays empty, other columns stay as they are.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    least = lambda c: F.greatest(F.lit(MIN_RATIO), F.lit(models.mean) * (F.char_length(c["value"]) - 1))
    random = F.filter(candidates(text), lambda c: log_ratio(c["value"], models) >= least(c))
    found = F.array_sort(F.concat(base_spans(text), random))
    return docs.withColumn(spans_col, F.when(text.rlike(ANY), found).otherwise(F.expr(f"cast(array() as {SPAN})")))
