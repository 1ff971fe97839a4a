"""Histories, stamps, pages, member lists, dictionaries and fingerprints."""

import hashlib
import itertools
import random

import pytest
from pyspark.sql import functions as F

from strandweave.functions.dates import parse_loose_date
from strandweave.operators import ordering
from strandweave.operators.dictionary import by_distinct
from strandweave.sources import files
from strandweave.streaming import findings as N
from strandweave.streaming import incremental as I

FOUND = "release string, rule_id string, machine string, section string, source_text string, value string"
RELEASES = ["0286", "0287", "0288"]


def found(spark):
    keep = [("a", "011"), ("b", "101"), ("c", "111"), ("d", "100"), ("e", "010")]
    rows = [(r, "rule", m, "PORTS", "line", None if m == "a" else m) for m, there in keep for r, yes in zip(RELEASES, there, strict=True) if yes == "1"]
    return spark.createDataFrame(rows + [rows[0]], FOUND)  # one occurs twice


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_history_in_any_order(spark, tmp_path):
    rows = found(spark)
    whole = rows_of(N.finding_lifecycle(rows, RELEASES))
    by = {r["machine"]: r for r in N.finding_lifecycle(rows, RELEASES).collect()}
    assert (by["b"]["first_absent"], by["b"]["disappeared"], by["b"]["reappeared"], by["b"]["present_in_latest"]) == ("0287", ["0287"], ["0288"], True)
    assert (by["d"]["last_observed"], by["d"]["disappeared"], by["d"]["reappeared"]) == ("0286", ["0287"], []) and by["a"]["occurrences"] == 3
    for order in itertools.permutations(RELEASES):
        states = [N.finding_state(rows.where(F.col("release") == r).select(*N.KEYS), r) for r in order]
        assert rows_of(N.lifecycle(N.merge_states(N.merge_states(*states[:2]), states[2]), RELEASES)) == whole
    history = N.FindingHistory(spark, str(tmp_path / "h"))
    for r in ("0287", "0286"):
        history.add(rows.where(F.col("release") == r), r, "v1")
    with pytest.raises(ValueError, match="detectors"):
        history.add(rows.where("release = '0288'"), "0288", "v2")
    with pytest.raises(ValueError, match="already"):
        history.add(rows.where("release = '0287'"), "0287", "v1")
    assert rows_of(history.lifecycle()) == rows_of(N.finding_lifecycle(rows, RELEASES[:2]))
    history.add(rows.where("release = '0288'"), "0288", "v1")
    assert rows_of(history.lifecycle()) == whole


def test_freshness(spark):
    facts = "stage string, path string, size long, digest string"
    now = spark.createDataFrame([("ini", "a", 1, "x"), ("ini", "b", 2, "y"), ("mame", "c", 3, "z"), ("gh", "d", 4, "w")], facts)
    then = spark.createDataFrame([("ini", "a", 1, "x"), ("ini", "b", 9, "y"), ("mame", "c", 3, "z"), ("gh", "d", 4, "w")], facts)
    tools = spark.createDataFrame([("ini", "1", "1"), ("mame", "2", "1"), ("gh", "1", "1"), ("other", "1", None)], "stage string, version string, stamped string")
    outputs = spark.createDataFrame([("gh", "o", True), ("gh", "p", False), ("mame", "q", True)], "stage string, path string, present boolean")
    got = {r["stage"]: tuple(r)[1:] for r in I.stage_freshness(now, then, tools, outputs).collect()}
    assert got == {"ini": (1, 0, 0, False, 0, False), "mame": (0, 0, 0, True, 0, False), "gh": (0, 0, 0, False, 1, False), "other": (0, 0, 0, True, 0, False)}
    assert {r["stage"]: r["fresh"] for r in I.stage_freshness(now, then).collect()} == {"ini": False, "mame": True, "gh": True}


def test_staleness_goes_down_the_graph(spark):
    fresh = spark.createDataFrame([("ini", False), ("gh", True), ("mame", True), ("transform", True)], "stage string, fresh boolean")
    needs = [("transform", "ini"), ("transform", "gh"), ("wiki", "transform"), ("pages", "wiki"), ("audit", "gh"), ("loop1", "loop2"), ("loop2", "loop1"), ("lost", "unknown")]
    got = {r["stage"]: (r["stale"], r["waiting_for"], r["blocked"]) for r in I.blocked_stages(fresh, spark.createDataFrame(needs, "stage string, needs string")).collect()}
    assert got["transform"] == (True, ["ini"], True) and got["wiki"] == (True, ["transform"], True) and got["pages"] == (True, ["wiki"], True)
    assert got["ini"] == (True, [], False) and got["audit"] == (False, [], False) and got["loop1"] == (False, [], False) and got["lost"] == (True, ["unknown"], True)


def test_multiset_hash(spark):
    facts = [("s", f"p{k}", k) for k in range(200)]
    sign = lambda rows: I.dependency_signature(spark.createDataFrame(rows, "stage string, path string, size int"), ["path", "size"]).first()["signature"]
    shuffled = random.Random(1).sample(facts, len(facts))
    assert sign(facts) == sign(shuffled) and len(sign(facts)) == 64
    others = [facts[:-1], [*facts, facts[0]], [*facts[:-1], ("s", "p199", 198)], [*facts[2:], ("s", "p0", 1), ("s", "p1", 0)]]
    assert len({sign(facts), *map(sign, others)}) == 5
    stamp = lambda version, rows: I.stage_stamps(spark.createDataFrame(rows, "stage string, path string, size int, digest string"), spark.createDataFrame([("s", version), ("t", "1")], "stage string, version string")).orderBy("stage").collect()
    rows = [("s", "a", 1, "x"), ("s", "b", 2, "y")]
    a, b = stamp("1", rows), stamp("2", rows[::-1])
    assert a[0]["files"] == 2 and a[1]["files"] == 0 and a[1] == b[1] and a[0]["digest"] != b[0]["digest"] and stamp("1", rows[::-1]) == a


@pytest.mark.parametrize("values", ["distinct", "few", "one"])
def test_pages(spark, monkeypatch, values):
    for name, value in (("SORT_ROWS", 120), ("CUTS", 8), ("SAMPLE", 300)):
        monkeypatch.setattr(ordering, name, value)
    rng = random.Random(3)
    keys = [None if rng.random() < 0.02 else {"distinct": f"n{rng.random()}", "few": f"n{rng.randint(0, 5)}", "one": "x"}[values] for _ in range(3000)]
    df = spark.createDataFrame(list(enumerate(keys)), "id int, name string").repartition(7)
    want = sorted(range(3000), key=lambda i: (keys[i] is not None, keys[i] or ""))
    for page in (0, 1, 17, 59, 60, 99):
        got = ordering.page_of_rows(df, [F.col("name")], page).orderBy("place").collect()
        at = min(max(page, 1), 60)
        assert [r["place"] for r in got] == list(range((at - 1) * 50 + 1, at * 50 + 1)) and got[0]["pages"] == 60 and got[0]["total"] == 3000
        assert [r["name"] for r in got] == [keys[i] for i in want[(at - 1) * 50 : at * 50]]
    assert ordering.page_of_rows(df.limit(0), [F.col("name")], 1).isEmpty()


def test_page_reads_no_shuffle_of_the_table(spark):
    df = spark.range(1000).withColumn("name", F.col("id").cast("string"))
    plan = ordering.page_of_rows(df, [F.col("name")], 3)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan and "hashpartitioning" not in plan


def test_member_lists(spark):
    rows = [("all", f"m{k:04}") for k in range(250)] + [("all", "m0001"), ("some", "m0007"), ("some", "m0240"), (None, "m0003"), ("some", None)]
    got = ordering.member_lists(spark.createDataFrame(rows, "value string, machine string"), ["value"], "machine", 100).collect()
    assert max(len(r["members"]) for r in got) == 100
    lists = {v: [m for r in sorted(got, key=lambda r: r["bucket"]) if r["value"] == v for m in r["members"]] for v in ("all", "some", None)}
    assert lists == {"all": [f"m{k:04}" for k in range(250)], "some": ["m0007", "m0240"], None: ["m0003"]}
    assert {r["value"]: r["systems"] for r in got} == {"all": 250, "some": 2, None: 1}


@pytest.mark.parametrize("worth", [0.0, 1.0])
def test_by_distinct(spark, worth):
    rows = [(k, ["x", "3 May 1990", None, "1990-02-31", "1990"][k % 5], "old") for k in range(40)]
    df = spark.createDataFrame(rows, "id int, raw string, date string")
    parse = lambda d, c: d.withColumn("date", parse_loose_date(F.col(c)))
    got = by_distinct(df, "raw", parse, worth)
    assert got.columns == ["id", "raw", "date"] and rows_of(got) == rows_of(parse(df, "raw"))
    assert {r["raw"]: r["date"] for r in got.collect()} == {"x": None, "3 May 1990": "1990-05-03", None: None, "1990-02-31": None, "1990": "1990-XX-XX"}


def test_dates(spark):
    cases = {"12/31/1990": "1990-12-31", "31/12/1990": "1990-12-31", "5/6/1990": "1990-06-05", "Feb. 29, 1989": None, "Sept 1988": "1988-09-XX", "Dec ??, 1991": "1991-12-XX", "???. ??, 1991": "1991-XX-XX", "199?": "199X-XX-XX", "21st March 1990": "1990-03-21", "March 3rd, 1990": "1990-03-03", "Monday 3 May 1990": None, "1990 2001": None, "1990/7": "1990-07-XX", "1990-13": None, "mayo 1990": None, "1990 may": None, "": None}
    df = spark.createDataFrame([(k,) for k in cases], "raw string")
    assert {r["raw"]: r["d"] for r in df.select("raw", parse_loose_date(F.col("raw")).alias("d")).collect()} == cases


def test_fingerprint_of_a_large_file(spark, tmp_path):
    """A sparse file that no row can hold, and a small one; Spark passes over an empty one."""
    size = 2**31 + 5
    with open(tmp_path / "large.bin", "wb") as f:
        f.truncate(size)
    (tmp_path / "small.bin").write_bytes(b"abc")
    (tmp_path / "empty.bin").write_bytes(b"")
    digest, block = hashlib.sha256(), bytes(1 << 24)
    for _ in range(size >> 24):
        digest.update(block)
    digest.update(bytes(size & ((1 << 24) - 1)))
    got = {r["path"].rsplit("/", 1)[1]: (r["size"], r["sha256"]) for r in files.fingerprint_files(spark, str(tmp_path / "*.bin")).collect()}
    assert got == {"large.bin": (size, digest.hexdigest()), "small.bin": (3, hashlib.sha256(b"abc").hexdigest())}


def test_last_of_a_name_in_document_order(spark, tmp_path):
    """One file, a file in ranges, and several files give the same answer."""
    machines = [f'<machine name="m{k % 40}"><description>{k} {"x" * 90}</description></machine>\n' for k in range(400)]
    (tmp_path / "one.xml").write_text("<mame>\n" + "".join(machines) + "</mame>\n")
    (tmp_path / "many").mkdir()
    for n in range(4):
        (tmp_path / "many" / f"{n}.xml").write_text("<mame>\n" + "".join(machines[n * 100 : n * 100 + 100]) + "</mame>\n")
    want = {f"m{k}": str(360 + k) for k in range(40)}
    keys = {"spark.sql.files.maxPartitionBytes": "3000", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        for path, split in (("one.xml", False), ("one.xml", True), ("many", False), ("many", True)):
            rows = files.scan_machine_xml(spark, str(tmp_path / path), split=split)
            assert {r["name"]: r["description"].split()[0] for r in rows.collect()} == want, (path, split)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_signature_is_the_digest_of_ordered_facts(spark):
    rows = [("s", "b", 2), ("t", "x", 9), (None, "n", 1), ("s", "a", 10), ("s", "a", 2), ("s", "é", None)]
    df = spark.createDataFrame(rows, "stage string, path string, size int").repartition(3)
    want = {
        "s": '[{"path":"a","size":2},{"path":"a","size":10},{"path":"b","size":2},{"path":"é"}]',
        "t": '[{"path":"x","size":9}]',
        None: '[{"path":"n","size":1}]',
    }
    got = {r["stage"]: r["signature"] for r in I.dependency_signature(df, ["path", "size"]).collect()}
    assert got == {k: hashlib.sha256(v.encode()).hexdigest() for k, v in want.items()}
