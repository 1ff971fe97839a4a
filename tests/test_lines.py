"""Lists read by byte ranges, and blocks aligned between releases."""

import pytest
from pyspark.sql import functions as F

from strandweave.operators import diffs
from strandweave.sources import files, lines

CATEGORIES = """
[FOLDER_SETTINGS]
RootFolderIcon cabinet

[ROOT_FOLDER]
stray
[Arcade: Maze / Collect]
one
two
; note
key=value
[Handheld / Plug n' Play TV Game / Console]
three
[Arcade: Puzzle / Drop * Mature *]
four
[Utilities]
five
"""


@pytest.fixture
def small_ranges(spark):
    """Files are cut every 2000 bytes."""
    keys = {"spark.sql.files.maxPartitionBytes": "2000", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_category_list(spark, tmp_path):
    (tmp_path / "c.ini").write_text(CATEGORIES)
    got = {r["machine"]: (r["grp"], r["category"], r["subcategory"]) for r in files.scan_category_list(spark, str(tmp_path / "c.ini")).collect()}
    assert got == {"one": ("Arcade", "Maze", "Collect"), "two": ("Arcade", "Maze", "Collect"), "three": ("Non-Arcade", "Handheld", "Plug n' Play TV Game / Console"), "four": ("Arcade", "Puzzle", "Drop"), "five": ("Non-Arcade", "Utilities", "")}


def test_long_heading(spark, tmp_path):
    (tmp_path / "c.ini").write_text("[Arcade: " + "x" * 30_000 + " / y]\nm\n")
    row = files.scan_category_list(spark, str(tmp_path / "c.ini")).first()
    assert (len(row["category"]), row["subcategory"]) == (30_000, "y")


def test_list_in_ranges(spark, tmp_path, small_ranges):
    """One large list with a heading over many ranges, small lists beside it, a byte order mark, CR LF, an empty file."""
    heads = [f"[s{k}]" for k in range(4)]
    big = ["before any", heads[0], *(f"m{i}" for i in range(1500)), heads[1], "", *(f"n{i}" for i in range(10)), heads[2], heads[3], *(f"o{i}" for i in range(900))]
    (tmp_path / "big.ini").write_text("\n".join(big))
    (tmp_path / "crlf.ini").write_bytes("﻿[a]\r\nx\r\n;; y\r\n[FOLDER_SETTINGS]\r\nz\r\n".encode())
    (tmp_path / "none.ini").write_text("")
    (tmp_path / "plain.ini").write_text("p\nq\n")
    raw = spark.read.text(str(tmp_path / "big.ini"))
    assert raw.rdd.getNumPartitions() > 5
    rows = files.scan_sectioned_list(spark, str(tmp_path / "*.ini")).withColumn("path", F.regexp_extract("path", r"([^/]+)$", 1)).collect()
    want, head = set(), None
    for no, line in enumerate(big, 1):
        head = line[1:-1] if line.startswith("[") else head
        if head and line and not line.startswith("["):
            want.add(("big.ini", head, line, no))
    assert {tuple(r) for r in rows} == want | {("crlf.ini", "a", "x", 2)}
    every = lines.read_lines(spark, str(tmp_path / "*.ini")).withColumn("path", F.regexp_extract("path", r"([^/]+)$", 1))
    assert [r["line"] for r in every.where("path = 'big.ini'").orderBy("line_no").collect()] == big
    assert sorted(r["line_no"] for r in every.where("path = 'big.ini'").collect()) == list(range(1, len(big) + 1))


def test_heads(spark, tmp_path):
    (tmp_path / "a.ini").write_text(";; list for MAME 0.287 (MAME0287)\n;; Generated on 17/01/2026\n" + "x\n" * 50_000 + ";; MAME 0.111\n")
    row = files.scan_list_header(spark, str(tmp_path / "a.ini")).first()
    assert (row["version"], row["build"], row["date"]) == ("0.287", "mame0287", "2026-01-17")
    assert lines.first_lines(spark, str(tmp_path / "a.ini"), 40).count() == 2
    (tmp_path / "c.ini").write_text(";; CATLIST.ini 1.5\n;; 17-Jan-2026 / MAME 0.287\n" + "x\n" * 100)
    assert tuple(files.scan_category_list_header(spark, str(tmp_path / "c.ini")).first())[1:] == ("1.5", "17-Jan-2026", "287")


def blocks(spark, *rows):
    """machine, section, texts: a text that starts with = is a pair, with * a list, else a paragraph."""
    kind = {"=": "pair", "*": "bullet_list"}
    return spark.createDataFrame([(m, s, k, kind.get(t[0], "paragraph"), t.lstrip("=*"), k * 7) for m, s, texts in rows for k, t in enumerate(texts)], "machine string, section string, block_index int, type string, text string, source_line int")


def detail(spark, before, after):
    out = diffs.changed_block_detail(blocks(spark, *before), blocks(spark, *after))
    return sorted((tuple(r) for r in out.collect()), key=lambda r: (r[0], r[1], r[5] if r[5] is not None else 99, r[6] if r[6] is not None else 99))


LONG = "Opening words that stay. " * 40, " Closing words that stay." * 40


@pytest.mark.parametrize(
    ("was", "now", "want"),
    [
        (["Keep.", "Out in December 1982."], ["Keep.", "Out on December 22, 1982."], [("MODIFIED", "modified", "paragraph", 1, 1)]),
        (["Start", "End"], ["Start", "New fact", "End"], [("MODIFIED", "added", "paragraph", None, 1)]),
        (["Old words"], [], [("REMOVED", "removed", "paragraph", 0, None)]),
        ([], ["a", "b"], [("ADDED", "added", "paragraph", None, 0), ("ADDED", "added", "paragraph", None, 1)]),
        (["Same"], ["Same"], []),
        (["=Record: 100", "*A | B"], ["=Record: 150", "*A | C"], [("MODIFIED", "modified", "pair", 0, 0), ("MODIFIED", "modified", "bullet_list", 1, 1)]),
        (["a", "b", "c", "d"], ["d", "a", "b", "c"], [("MODIFIED", "removed", "paragraph", 3, None), ("MODIFIED", "added", "paragraph", None, 0)]),
        (["x", "=k: v", "y"], ["x", "words", "more", "y"], [("MODIFIED", "removed", "pair", 1, None), ("MODIFIED", "added", "paragraph", None, 1), ("MODIFIED", "added", "paragraph", None, 2)]),
        (["p", "q", "p", "q"], ["q", "p", "q"], [("MODIFIED", "removed", "paragraph", 0, None)]),
        (["a", "a", "a"], ["a", "a"], [("MODIFIED", "removed", "paragraph", 2, None)]),
    ],
)
def test_changed_blocks(spark, was, now, want):
    got = detail(spark, [("m", "trivia", was), ("n", "trivia", ["same"])], [("m", "trivia", now), ("n", "trivia", ["same"])])
    assert [r[2:7] for r in got] == want


def test_long_blocks_show_the_change_only(spark):
    got = detail(spark, [("m", "t", [LONG[0] + "July 1991" + LONG[1]])], [("m", "t", [LONG[0] + "25 July 1991" + LONG[1]])])
    (row,) = got
    assert "25 July 1991" in row[8] and len(row[7]) < 200 and row[7].startswith("...") and row[8].endswith("...")


def test_written_lines(spark, tmp_path):
    """Files lie in one folder, whole and in order."""
    rows = [(f"f{k}.{k % 2}.txt", n, None if n == 2 else f"é{k} {n}") for k in range(50) for n in range(4)]
    path = lines.write_lines(spark.createDataFrame(rows, "file string, line_no int, line string").repartition(3), f"file://{tmp_path}/out")
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == sorted({r[0] for r in rows})
    assert (tmp_path / "out" / "f7.1.txt").read_text() == "é7 0\né7 1\n\né7 3\n"
    got = lines.read_lines(spark, path).select(F.regexp_extract("path", "([^/]+)$", 1).alias("file"), "line_no", "line").collect()
    assert sorted(map(tuple, got)) == sorted((f, n + 1, t or "") for f, n, t in rows)
