"""Conversation repair, hard negatives and token counts against brute force, with every awkward row."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from strandweave.llm import hard_negatives, queries, structure, token_counts

VISIBLE = re.compile(r"[^\x20\x09-\x0D]")
FILE = public_tokenizers.path("byte_bpe_50k.json")
CONV = "conv_id long, turn long, role string, text string, conv string, pos string, edit string"


def repair_by_hand(rows: list[tuple[str, str]]) -> tuple[int, str, list[str]]:
    """(cost, audit, lines) by the least (cost, audit) of each state, forward; nothing is left out or cut in chunks."""
    seen, best = set(), {"": (0, "", ())}
    follows = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    def put(to: dict, state: str, way: tuple) -> None:
        to[state] = min(to.get(state, way), way)

    def insert(ways: dict) -> dict:
        for _ in range(3):
            for (q, initial), then in follows.items():
                if q in ways and initial in "ua":
                    c, audit, lines = ways[q]
                    put(ways, then, (c + 2, audit + "I", (*lines, {"u": "user:", "a": "assistant:"}[initial])))
        return ways

    for role, text in rows:
        visible = VISIBLE.findall(text)
        must, cut = not visible or (role, text) in seen, bool(visible) and visible[-1] not in ".!?"
        seen.add((role, text))
        now = {}
        for q, (c, audit, lines) in insert(best).items():
            put(now, q, (c + 3, audit + "D", lines))
            for initial in "sua" if not must else "":
                if (q, initial) in follows:
                    then = follows[q, initial]
                    if role[:1] == initial:
                        put(now, then, (c + cut, audit + "K", (*lines, f"{role}:{text}")))
                    if initial in "ua":
                        put(now, then, (c + 2 + cut, audit + "R", (*lines, {"u": "user", "a": "assistant"}[initial] + ":" + text)))
        best = now
    ways = insert(best)
    cost, audit, lines = min(ways[q] for q in ("", "a") if q in ways)
    return cost, audit, list(lines)


def faults_by_hand(rows: list[tuple]) -> tuple:
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    blank = dup = cut = bad = 0
    seen = set()
    for k, (_, role, text) in enumerate(rows):
        visible = VISIBLE.findall(text)
        if not visible:
            blank += 1
        elif (role, text) in seen:
            dup += 1
        elif visible[-1] not in ".!?":
            cut += 1
        seen.add((role, text))
        bad += bool(k) and rows[k - 1][1][:1] + role[:1] not in ("su", "ua", "au")
    return gaps, blank, dup, cut, bad


def talks(rng: random.Random) -> list[tuple]:
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None]
    texts = ["Hi.", "Yes!", "and then", "", None, " \t", "Really? ", "é 日本"]
    rows = [(c, t if rng.random() < 0.9 else None, rng.choice(roles), rng.choice(texts) if rng.random() < 0.5 else f"{rng.random()}{rng.choice('.!?,')}") for c in range(60) for t in range(rng.randint(1, 9))]
    rows += [(100, t, ["user", "assistant"][t % 2], f"t{t}{'.' if t % 7 else ''}") for t in range(400)]  # long and plain
    rows += [(101, t, "tool", f"t{t}") for t in range(300)]  # costs of each chunk hang on what follows
    rows += [(102, t, rng.choice(["system", "user", "assistant", "tool"]), f"{t}{rng.choice('.,')}") for t in range(500)]
    rows += [(103, 5, "user", "same")] * 200 + [(104, None, "user", "x.")] + [(None, 1, "user", "a."), (None, 2, "user", "b.")] + [(105, 1, "user", "long " * 20_000)]
    return [(*r, "junk", "junk", "junk") for r in rows]


def in_order(rows: list[tuple]) -> dict:
    by = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        by[conv].append((turn, " " if role is None else role, " " if text is None else text))
    return {c: sorted(r, key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode() + b"\0" + x[2].encode())) for c, r in by.items()}


@pytest.mark.parametrize(("chunk", "passes"), [(structure.CHUNK, structure.PASSES), (4, 3), (7, 1)])
def test_repair(spark, chunk, passes):
    """Whole, in small chunks whose passes converge, and in chunks whose costs come from matrices."""
    rows = talks(random.Random(3))
    steps, found = structure.repair(spark.createDataFrame(rows, CONV).repartition(5), chunk_rows=chunk, passes=passes)
    got = {r["conv"]: r for r in structure.digests(steps).collect()}
    counted = {r["conv"]: tuple(r)[1:] for r in found.collect()}
    want = in_order(rows)
    assert set(got) == set(counted) == set(want)
    for c, own in want.items():
        cost, audit, lines = repair_by_hand([(role, text) for _, role, text in own])
        assert (got[c]["cost"], got[c]["audit"]) == (cost, audit), c
        assert got[c]["repaired_sha256"] == hashlib.sha256("\n".join(lines).encode()).hexdigest()
        assert counted[c] == faults_by_hand(own), c


def test_repair_of_nothing(spark):
    steps, found = structure.repair(spark.createDataFrame([], CONV))
    assert steps.isEmpty() and found.isEmpty() and structure.digests(steps).isEmpty()


def test_chunks_converge():
    """From any costs at its end a plain chunk has the same costs before it, but for a constant; a rerun stops early."""
    codes = bytes([2, 4] * 50)
    start = structure.through(codes, list(structure.LAST))
    for after in ([0, 5, 2, 0], [3, 0, 2, 4], [0, 0, 2, 2]):
        assert structure.rerun(codes, list(structure.LAST), after, start) == structure.through(codes, after)


def test_damage(spark, tmp_path):
    rows = [(c, t, ["user", "assistant"][t % 2], f"Text {c} {t}! Ok.") for c in range(30) for t in range(6)] + [(None, None, None, None), (40, None, "user", "a.")]
    got = sorted(map(tuple, queries.damaged(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()), key=str)
    want = []
    for c, t, role, text in rows:
        d = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if d == 1 else re.sub("[.!?]", "", text) if d == 2 else text
        want += [(c, t, "user" if d == 4 else role, text)] * (0 if d == 0 else 2 if d == 3 else 1)
    assert got == sorted(want, key=str)


def negatives_by_hand(rows: list[tuple], anchors, k: int = 5) -> set:
    sound = [(i, y, [int(np.floor(256 * float(x))) for x in v]) for i, v, y in rows if None not in (i, v, y) and all(x is not None and np.isfinite(x) for x in v)]
    out = set()
    for a, label, v in sound:
        if not anchors(a):
            continue
        scored = sorted((-min(hard_negatives.LONG, sum(p * q for p, q in zip(v, w, strict=True))), i, y) for i, y, w in sound if i != a and len(v) == len(w))
        for minus, p, _ in [s for s in scored if s[2] == label][:k]:
            fit = [s for s in scored if s[2] != label and 80 * -minus <= 100 * -s[0] <= 100 * -minus][:k]
            out |= {(a, p, n + 1, s[1], -minus, -s[0]) for n, s in enumerate(fit)}
    return out


def embeddings(rng: np.random.Generator) -> list[tuple]:
    rows = [(i, rng.normal(size=4).astype(np.float32).tolist(), int(rng.integers(0, 4))) for i in range(300)]
    rows += [(300 + i, [0.5, 0.5, 0.25, 0.0], i % 3) for i in range(90)]  # equal vectors: ties everywhere
    rows += [(400, None, 1), (401, [1.0] * 4, None), (None, [1.0] * 4, 1), (402, [float("nan")] * 4, 1), (403, [float("inf"), 0.0, 0.0, 0.0], 1), (404, [None, 1.0, 1.0, 1.0], 1), (405, [0.0] * 4, 2), (406, [], 1), (407, [1.0, 2.0], 1), (408, [1.0, 2.5], 1), (409, [1.0, 2.2], 2), (410, [3e9] * 4, 3), (411, [2e9] * 4, 1), (412, [2.5e9] * 4, 3)]
    return rows


@pytest.mark.parametrize("slice_bytes", [hard_negatives.SLICE_BYTES, 700])
def test_hard_negatives(spark, monkeypatch, slice_bytes):
    """With all anchors together, and in slices of a few."""
    monkeypatch.setattr(hard_negatives, "SLICE_BYTES", slice_bytes)
    rows = embeddings(np.random.default_rng(8))
    df = spark.createDataFrame([(*r, "junk", 1) for r in rows], "vec_id long, embedding array<float>, label int, id string, v int").repartition(6)
    got = [tuple(r) for r in hard_negatives.mine(df, F.col("vec_id") % 10 == 0).collect()]
    want = negatives_by_hand([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], y) for i, v, y in rows], lambda i: i % 10 == 0)
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 500
    assert hard_negatives.mine(df.limit(0), F.col("vec_id") % 10 == 0).isEmpty() and hard_negatives.mine(df, F.lit(False)).isEmpty()


def test_products_beyond_doubles():
    a = np.array([[float(1 << 40), 1.0], [float(1 << 30), 3.0]])
    assert hard_negatives.products(a, a).tolist() == [[hard_negatives.LONG, hard_negatives.LONG], [hard_negatives.LONG, (1 << 60) + 9]]


TEXTS = [None, "", " ", "a<|endoftext|>b  <|endoftext|>", "don't stop12 3a  x", "日本語のテキスト。" * 50, "word " * 30_000, "x" * 80_000, "\x1c!\x85 \n\n a", "ab12" * 20_000, "é́ " * 9000, "<|endoftext|>" * 700]


def test_token_counts(spark):
    library = Tokenizer.from_file(FILE)
    rng = random.Random(2)
    texts = TEXTS + ["".join(rng.choice("ab1 .\n\té日!'s<|>") for _ in range(rng.randint(0, 4000))) for _ in range(60)]
    df = spark.createDataFrame([(i, t, "junk") for i, t in enumerate([*texts, texts[3]])], "doc_id long, text string, n_tokens string")
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts.count_tokens(df, FILE, batch_bytes=1000, part_chars=50).collect()}
    assert got == {i: len(library.encode(t or "", add_special_tokens=False).ids) for i, t in enumerate([*texts, texts[3]])}
    assert token_counts.count_tokens(df.limit(0), FILE).isEmpty()


@pytest.mark.parametrize("name", ["piece_bpe_32k.model", "word_bpe_49k.json"])
def test_token_counts_of_other_files(spark, name):
    """Tokenizers that rewrite texts or have no split pattern count whole texts."""
    file = public_tokenizers.path(name)
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    got = [r["n_tokens"] for r in token_counts.count_tokens(df, file, part_chars=50).orderBy("doc_id").collect()]
    if name.endswith(".model"):
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_file=file)
        assert got == [len(library.encode(t or "")) for t in TEXTS]
    else:
        library = Tokenizer.from_file(file)
        assert got == [len(library.encode(t or "", add_special_tokens=False).ids) for t in TEXTS]
