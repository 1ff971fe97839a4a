"""Readers of catalogue files: XML, sectioned lists, archives, keyed JSON.

Each reader is one Spark source and a DataFrame transformation; the transformation also takes lines from elsewhere,
as rows (path, line_no, line).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions.dates import iso_date
from ..functions.text import collapse_whitespace, empty_to_null, strip, text_or_empty
from .keyed_json import scan_keyed_json
from .lines import first_lines, read_lines

#: Fixed value: the end of a heading that marks mature content.
MATURE = " * Mature *"
#: A list's header is looked for in so many characters, a category list's in so many lines.
HEAD_CHARS, HEAD_LINES = 16384, 30

#: What the header of a list tells, and that of a category list.
LIST_VERSION, LIST_BUILD = r"(?i)\bMAME\s+([0-9.]+)\b", r"(?i)\((mame[0-9]+)\)"
LIST_DATE = r"(?i)(?:generated|updated)\s*(?:@|on|:)?\s*([0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{4}-[0-9]{2}-[0-9]{2})"
CATEGORY_VERSION, CATEGORY_DATE, CATEGORY_RELEASE = r"(?i)catlist(?:\.ini)?\s+v?([0-9.]+)", r"\b([0-9]{1,2}[-/][A-Za-z0-9]{2,3}[-/][0-9]{4})\b", r"(?i)MAME\s+0?\.?([0-9]{3,4})\b"

_ATTR = lambda *names: [T.StructField(f"_{n}", T.StringType()) for n in names]


def _many(name: str, *attributes: str) -> T.StructField:
    return T.StructField(name, T.ArrayType(T.StructType(_ATTR(*attributes))))


MACHINE = T.StructType(
    [
        *_ATTR("name", "cloneof", "sampleof", "sourcefile", "isbios", "isdevice", "ismechanical"),
        T.StructField("description", T.StringType()),
        T.StructField("year", T.StringType()),
        T.StructField("manufacturer", T.StringType()),
        _many("rom", "name", "size"),
        _many("disk", "name", "region"),
        _many("chip", "type", "name", "tag", "clock"),
        _many("display", "tag", "type", "rotate", "width", "height", "refresh"),
        T.StructField("sound", T.StructType(_ATTR("channels"))),
        T.StructField("input", T.StructType([*_ATTR("players"), _many("control", "player", "type", "buttons", "reqbuttons", "ways", "ways2", "ways3")])),
        _many("device_ref", "name"),
        _many("sample", "name"),
    ]
)
ENTRY = T.StructType(
    [
        T.StructField("systems", T.StructType([_many("system", "name")])),
        T.StructField("software", T.StructType([_many("item", "list", "name")])),
        T.StructField("text", T.StringType()),
    ]
)


def scan_machine_xml(spark: SparkSession, path: str, row_tag: str = "machine", limit: int | None = None, split: bool = False) -> DataFrame:
    """One row per machine element: name, attributes and nested arrays; nameless ones are left out, of one name the last
    in document order counts: by the file's name, the byte range and the place in it, whatever tasks read them. ``split``
    reads ranges of a file in parallel. ``limit`` caps the rows read, as a preview does."""
    raw = spark.read.format("xml").option("rowTag", row_tag).option("multiLine", str(not split).lower()).schema(MACHINE).load(path)
    at = F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    rows = raw.where(F.col("_name").isNotNull()).withColumn("_at", at)
    rows = rows.limit(limit) if limit else rows
    last = F.row_number().over(Window.partitionBy("_name").orderBy(F.desc("_at")))
    return rows.withColumn("_n", last).where("_n = 1").drop("_n", "_at").withColumnRenamed("_name", "name")


def scan_entry_xml(spark: SparkSession, path: str) -> DataFrame:
    """(ordinal, kind, primary_name, aliases, text): one row per entry; line breaks of the text stay.

    Entries with systems take the first name as primary and the rest as aliases; those with software are of that
    kind, all others unknown.
    """
    raw = spark.read.format("xml").option("rowTag", "entry").option("ignoreSurroundingSpaces", "false").schema(ENTRY).load(path)
    header = entry_header(F.col("systems.system"), F.col("software"))
    # systems without a name inside are systems all the same
    kind = F.when(F.col("systems").isNotNull(), "systems").otherwise(F.col("h.kind"))
    return raw.withColumn("h", header).select(F.monotonically_increasing_id().alias("ordinal"), kind.alias("kind"), "h.primary_name", "h.aliases", F.coalesce("text", F.lit("")).alias("text"))


def entry_header(systems: Column, software: Column) -> Column:
    """struct(kind, primary_name, aliases) of an entry: systems take the first name as primary and the rest as aliases
    (names are trimmed, empty ones left out); an entry with software alone is of that kind, any other unknown."""
    names = F.filter(F.transform(systems, lambda s: strip(s["_name"])), lambda n: n.isNotNull() & (n != ""))
    kind = F.when(systems.isNotNull(), "systems").when(software.isNotNull(), "software").otherwise("unknown")
    rest = F.when(F.size(names) > 1, F.slice(names, F.lit(2), F.size(names))).otherwise(F.array().cast("array<string>"))
    return F.struct(kind.alias("kind"), F.get(names, F.lit(0)).alias("primary_name"), rest.alias("aliases"))


def root_attributes(lines: DataFrame, tag: str, names: list[str]) -> DataFrame:
    """(path, names...): attributes of the root element, from the first line that opens it."""
    opening = lines.where(F.col("line").rlike(rf"<{tag}[\s>]"))
    first = opening.groupBy("path").agg(F.min_by("line", "line_no").alias("line"))
    return first.select("path", *(empty_to_null(F.regexp_extract("line", rf'\s{n}="([^"]*)"', 1)).alias(n) for n in names))


def _headings() -> Column:
    t = text_or_empty(F.col("line"))
    return F.when(t.rlike(r"^\[.*\]$"), collapse_whitespace(F.substring(t, F.lit(2), F.length(t) - 2)))


def sectioned_lines(spark: SparkSession, path: str) -> DataFrame:
    """(path, section, text, line_no): lines below a [Section] heading of their file, trimmed, without blank ones."""
    rows = read_lines(spark, path, _headings()).select("path", F.col("heading").alias("section"), text_or_empty(F.col("line")).alias("text"), "line_no")
    return rows.where(F.col("section").isNotNull() & (F.col("text") != "") & ~F.col("text").rlike(r"^\[.*\]$"))


def scan_sectioned_list(spark: SparkSession, path: str) -> DataFrame:
    """(path, section, machine, line_no) of [Section] files: no blank lines, ;; comments or FOLDER_SETTINGS."""
    rows = sectioned_lines(spark, path).where((F.col("section") != "FOLDER_SETTINGS") & ~F.col("text").startswith(";;"))
    return rows.select("path", "section", F.col("text").alias("machine"), "line_no")


def list_header(lines: DataFrame) -> DataFrame:
    """(path, version, build, date_raw, date) told in the lines of a list's head."""
    head = lines.groupBy("path").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]), " ").alias("t"))
    part = lambda p: empty_to_null(F.regexp_extract("t", p, 1))
    raw = part(LIST_DATE)
    return head.select("path", part(LIST_VERSION).alias("version"), F.lower(part(LIST_BUILD)).alias("build"), raw.alias("date_raw"), iso_date(raw).alias("date"))


def scan_list_header(spark: SparkSession, path: str) -> DataFrame:
    """``list_header`` of files, of each the first HEAD_CHARS characters."""
    return list_header(first_lines(spark, path, HEAD_CHARS))


def scan_root_attributes(spark: SparkSession, path: str, tag: str, names: list[str]) -> DataFrame:
    """``root_attributes`` of files whose root opens in the first HEAD_CHARS characters."""
    return root_attributes(first_lines(spark, path, HEAD_CHARS), tag, names)


def scan_category_list(spark: SparkSession, path: str) -> DataFrame:
    """(path, machine, grp, category, subcategory, line_no): headings that start with Arcade: give that group, the rest is
    split at the first ' / '; lines with = or a comment sign are no machines."""
    rows = sectioned_lines(spark, path).where(~F.col("section").isin("FOLDER_SETTINGS", "ROOT_FOLDER") & ~F.col("text").rlike("^[;#]") & ~F.col("text").contains("="))
    arcade = F.col("section").startswith("Arcade: ")
    kind = F.regexp_replace(F.when(arcade, F.substring("section", F.lit(9), F.length("section"))).otherwise(F.col("section")), r" \* Mature \*$", "")
    at = F.instr(kind, " / ")
    return rows.select(
        "path",
        F.col("text").alias("machine"),
        F.when(arcade, "Arcade").otherwise("Non-Arcade").alias("grp"),
        strip(F.when(at > 0, F.substring(kind, F.lit(1), at - 1)).otherwise(kind)).alias("category"),
        strip(F.when(at > 0, F.substring(kind, at + 3, F.length(kind))).otherwise("")).alias("subcategory"),
        "line_no",
    )


def category_list_header(lines: DataFrame) -> DataFrame:
    """(path, version, date, release) told in the first HEAD_LINES lines."""
    top = lines.where(F.col("line_no") <= HEAD_LINES)
    first = lambda p, n: F.min_by(empty_to_null(F.regexp_extract("line", p, 1)), F.when(F.col("line").rlike(p), F.col("line_no"))).alias(n)
    return top.groupBy("path").agg(first(CATEGORY_VERSION, "version"), first(CATEGORY_DATE, "date"), first(CATEGORY_RELEASE, "release"))


def scan_category_list_header(spark: SparkSession, path: str) -> DataFrame:
    """``category_list_header`` of files."""
    return category_list_header(first_lines(spark, path, HEAD_CHARS))


MEMBER = "archive string, member string, crc long, size long, modified string, is_xml boolean, is_ini boolean, readable boolean, content binary"
#: Members are handed on in frames of so many, or of so many bytes where their content is asked for.
FRAME_ROWS, FRAME_BYTES = 4096, 16 << 20


def scan_zip_members(spark: SparkSession, path: str, content: bool = False) -> DataFrame:
    """Members of zip archives with their facts, whether their check sums hold and, if asked, their bytes."""
    return zip_members(spark.read.format("binaryFile").load(path).select(F.col("path").alias("archive"), F.col("content").alias("bytes")), content)


def zip_members(files: DataFrame, content: bool = False) -> DataFrame:
    """The same for archives in a table (archive, bytes)."""
    return files.mapInPandas(lambda batches: read_members(batches, content), MEMBER)


def read_members(batches: Iterator[pd.DataFrame], content: bool) -> Iterator[pd.DataFrame]:
    """Members as ``zip_members`` tells them: a frame for many archives, for a frame costs more than to read a small one."""
    import io
    import zipfile

    columns = ["archive", "member", "crc", "size", "modified", "is_xml", "is_ini", "readable", "content"]
    rows, held = [], 0
    for b in batches:
        for archive, raw in zip(b["archive"], b["bytes"], strict=True):
            try:
                with zipfile.ZipFile(io.BytesIO(raw)) as z:
                    for m in z.infolist():
                        if m.is_dir():
                            continue
                        try:
                            data, fine = z.read(m), True
                        except (zipfile.BadZipFile, OSError):
                            data, fine = None, False
                        low = m.filename.lower()
                        rows.append((archive, m.filename, m.CRC, m.file_size, "%04d-%02d-%02d %02d:%02d:%02d" % m.date_time, low.endswith(".xml"), low.endswith(".ini"), fine, data if content else None))
                        held += len(data or b"") if content else 0
                        if len(rows) >= FRAME_ROWS or held >= FRAME_BYTES:
                            yield pd.DataFrame(rows, columns=columns)
                            rows, held = [], 0
            except zipfile.BadZipFile:
                rows.append((archive, None, None, None, None, False, False, False, None))
        if rows:
            yield pd.DataFrame(rows, columns=columns)
            rows, held = [], 0


def select_member(members: DataFrame, token: str, suffix: str = ".xml", rule: str = "digits") -> DataFrame:
    """The best member of each archive whose name ends in ``suffix`` and holds ``token``.

    Rules: digits (most digits, then longest name), exact (the name <token><suffix> itself, then shortest), largest,
    first (by name). Ties go by name.
    """
    leaf = F.lower(F.regexp_extract("member", r"([^/\\]+)$", 1))
    rows = members.where(leaf.endswith(suffix) & F.contains(leaf, F.lit(token)))
    score = {
        "digits": [F.desc(F.regexp_count("member", F.lit("[0-9]"))), F.desc(F.length("member"))],
        "exact": [F.desc(leaf == f"{token}{suffix}"), F.length("member")],
        "largest": [F.desc("size")],
        "first": [],
    }[rule]
    best = F.row_number().over(Window.partitionBy("archive").orderBy(*score, "member"))
    return rows.withColumn("_n", best).where("_n = 1").drop("_n")


def detect_encoding(content: Column) -> Column:
    """struct(encoding, source, ascii_only): a byte order mark, an XML declaration, valid UTF-8, else windows-1252."""
    mark = F.hex(F.substring(content, 1, 3))
    told = F.lower(F.regexp_extract(F.decode(F.substring(content, 1, 4096), "ISO-8859-1"), r"""<\?xml[^>]*encoding=["']([A-Za-z0-9._-]+)["']""", 1))
    ascii_only = ~F.decode(content, "ISO-8859-1").rlike(r"[^\x00-\x7F]")
    valid = F.is_valid_utf8(content.cast("string"))
    made = lambda e, s: F.struct(F.lit(e).alias("encoding") if isinstance(e, str) else e.alias("encoding"), F.lit(s).alias("source"), ascii_only.alias("ascii_only"))
    named = F.when(told.isin("utf8", "ascii", "us-ascii"), "utf-8").when(told.isin("latin-1", "latin1", "iso-8859-1"), "windows-1252").otherwise(told)
    return F.when(mark == "EFBBBF", made("utf-8", "bom")).when(mark.startswith("FFFE"), made("utf-16-le", "bom")).when(mark.startswith("FEFF"), made("utf-16-be", "bom")).when(told != "", made(named, "declaration")).when(valid, made("utf-8", "guess")).otherwise(made("windows-1252", "guess"))


OVERRIDE = "struct<description:string,apply_if_unbalanced:boolean,note:string>"


def scan_overrides(spark: SparkSession, path: str) -> DataFrame:
    """(machine, new_description, only_if_unbalanced, note) of a file of title overrides, a JSON object keyed by
    machine; only_if_unbalanced is true unless told otherwise. Where there is no such file, there are no overrides."""
    try:
        found = scan_keyed_json(spark, path, OVERRIDE)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        found = spark.createDataFrame([], f"key string, value {OVERRIDE}")
    return found.select(F.col("key").alias("machine"), F.col("value.description").alias("new_description"), F.coalesce("value.apply_if_unbalanced", F.lit(True)).alias("only_if_unbalanced"), F.coalesce("value.note", F.lit("")).alias("note"))


def vocabulary_violations(phrases: DataFrame) -> DataFrame:
    """(grp, category, subcategory, rule): rows of a phrase list that break a rule: untrimmed values, a phrase that
    doesn't start with a or an, or a key that occurs twice."""
    keys = ["grp", "category", "subcategory"]
    trimmed = F.lit(True)
    for c in [*keys, "phrase"]:
        trimmed = trimmed & F.col(c).eqNullSafe(strip(F.col(c))) & (F.coalesce(c, F.lit("")) != "")
    rows = phrases.withColumn("_n", F.count("*").over(Window.partitionBy(*keys)))
    rules = F.array(F.when(~trimmed, F.lit("untrimmed")), F.when(~F.coalesce(F.col("phrase").rlike("^an? "), F.lit(False)), F.lit("article")), F.when(F.col("_n") > 1, F.lit("duplicate")))
    return rows.select(*keys, F.explode(F.filter(rules, lambda r: r.isNotNull())).alias("rule"))


#: Files up to so many bytes are hashed as a value; larger ones are streamed, BLOCK bytes at a time.
WHOLE_BYTES, BLOCK = 64 << 20, 8 << 20


def fingerprint_files(spark: SparkSession, path: str, whole_bytes: int = WHOLE_BYTES) -> DataFrame:
    """(path, size, modified, sha256) of files of any size but 0, which Spark passes over.

    A digest is one stream, so a file is one task's; no task holds more than ``whole_bytes`` of it. Large files are opened
    by Arrow on the executors (local and mounted folders, HDFS, the object stores it knows); another scheme raises there.
    """
    files = spark.read.format("binaryFile").load(path)
    told = ["path", F.col("length").alias("size"), F.col("modificationTime").alias("modified")]
    whole = files.where(F.col("length") <= whole_bytes).select(*told, F.sha2("content", 256).alias("sha256"))
    large = files.where(F.col("length") > whole_bytes).select(*told)

    def digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import hashlib

        from pyarrow import fs

        for b in batches:
            out = []
            for name in b["path"]:
                system, place = fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", name))
                digest = hashlib.sha256()
                with system.open_input_stream(place) as stream:
                    while block := stream.read(BLOCK):
                        digest.update(block)
                out.append(digest.hexdigest())
            yield b.assign(sha256=out)

    return whole.union(large.repartition("path").mapInPandas(digests, "path string, size long, modified timestamp, sha256 string"))
