"""Text blocks, one convention after the other."""

import pytest

from strandweave.operators import blocks as B


def shown(r):
    body = "|".join(r["items"]) if r["items"] is not None else f"{r['label']}={r['value']}" if r["type"] == "pair" else r["text"]
    return r["type"], body


CASES = {
    "trivia lines": ("TRIVIA", ["First line", "second line", "", "* one", "goes on", "* two.", "not this"], [("paragraph", "First line"), ("paragraph", "second line"), ("bullet_list", "one goes on|two."), ("paragraph", "not this")]),
    "block mode": ("SERIES", ["First line", "second line", "", "1) one", "2) two", "Label : value", "A - b", "HEADING HERE"], [("paragraph", "First line\nsecond line"), ("numbered_list", "one|two"), ("pair", "Label=value"), ("pair", "A=b"), ("subheading", "HEADING HERE")]),
    "hyphens part": ("SERIES", ["a b", "-----", "c d"], [("paragraph", "a b"), ("paragraph", "c d")]),
    "staff": ("STAFF", ["*Design*: A. B.", "*Music*", "C : D"], [("pair", "Design=A. B."), ("subheading", "Music"), ("pair", "C=D")]),
    "star colon": ("TRIVIA", ["* Things:", "* a", "- Foo -"], [("subheading", "Things:"), ("bullet_list", "a"), ("subheading", "Foo")]),
    "updates": ("UPDATES", ["* Version 1", "- fixed", "- added"], [("subheading", "Version 1"), ("bullet_list", "fixed|added")]),
    "updates plain": ("UPDATES", ["One thing changed", "Another thing changed"], [("paragraph", "One thing changed"), ("paragraph", "Another thing changed")]),
    "scoring": ("SCORING", ["* Enemies", "Red : 10 points", "Blue : 20 points", "* note", "Explained here", "* last"], [("subheading", "Enemies"), ("pair", "Red=10 points"), ("pair", "Blue=20 points"), ("bullet_list", "note\nExplained here|last")]),
    "overview topics": ("OVERVIEW", ["Features are:", "", "* One : first words", "more about it", "", "* Two : second words", "and more"], [("paragraph", "Features are:"), ("subheading", "One"), ("paragraph", "First words"), ("paragraph", "more about it"), ("subheading", "Two"), ("paragraph", "Second words"), ("paragraph", "and more")]),
    "overview heading": ("OVERVIEW", ["Intro text", "", "* Short title", "A description that is longer than the title"], [("paragraph", "Intro text"), ("subheading", "Short title"), ("paragraph", "A description that is longer than the title")]),
    "tips topics": ("TIPS AND TRICKS", ["* Cheat : press start", "Then do this", "", "* Skip : hold up"], [("subheading", "Cheat"), ("paragraph", "Press start"), ("paragraph", "Then do this"), ("subheading", "Skip"), ("paragraph", "Hold up")]),
    "tips single": ("TIPS AND TRICKS", ["* Cheat : press start"], [("bullet_list", "Cheat : press start")]),
}


@pytest.mark.parametrize("name", list(CASES))
def test_text_blocks(spark, name):
    section, lines, want = CASES[name]
    df = spark.createDataFrame([("m", section, i, t) for i, t in enumerate(lines)], "machine string, section string, line_no int, line string")
    assert [shown(r) for r in B.text_blocks(df).orderBy("block_index").collect()] == want


def test_preambles(spark):
    lines = ["Known releases:", "first one", "second one:", "third one", "", "after"]
    df = spark.createDataFrame([("m", "TRIVIA", i, t) for i, t in enumerate(lines)], "machine string, section string, line_no int, line string")
    got = B.attach_preambles(B.promote_preambles(B.text_blocks(df))).orderBy("block_index").collect()
    assert [shown(r) for r in got] == [("paragraph", "Known releases:"), ("bullet_list", "first one|second one:|third one"), ("paragraph", "after")]
    assert got[0]["preamble_target"] == 1 and got[1]["preamble_text"] == "Known releases:"


def test_article(spark):
    text = ["Arcade Video game published 40 years ago", "", "A (c) 1985 B.", "A fine story, told well.", "- TRIVIA -", "* a", "* b", "- PORTS -", "x", "- TECHNICAL -", "Players : 2", "Kept: no"]
    df = spark.createDataFrame([("m", i, t) for i, t in enumerate(text)], "machine string, line_no int, line string")
    got = [(r["section"], *shown(r)) for r in B.article_blocks(df).orderBy("section", "block_index").collect()]
    assert got == [("OVERVIEW", "paragraph", "A fine story, told well."), ("TECHNICAL", "pair", "Kept=no"), ("TRIVIA", "bullet_list", "a|b")]


def test_lines_are_dealt_by_their_number(spark, monkeypatch):
    """Lines that compress well do not gather in few tasks: shuffles have as many as the lines ask for, results are the same."""
    rows = [(f"m{k}", "TRIVIA", n, "Intro goes:" if (n + k) % 3 == 0 else "Words end.") for k in range(40) for n in range(6)]
    df = spark.createDataFrame(rows, "machine string, section string, line_no int, line string")
    want = sorted(map(str, B.promote_preambles(B.text_blocks(df)).collect()))
    monkeypatch.setattr(B, "TASK_LINES", 10)
    got = B.promote_preambles(B.text_blocks(df))
    assert B.tasks_for(df) == 25 and sorted(map(str, got.collect())) == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert ", 25), REPARTITION_BY_NUM" in plan
