"""Each operator against a brute-force version, and on nulls, empty and long texts, ties, repeated rows, empty tables
and clashing column names."""

from __future__ import annotations

import hashlib
import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from strandweave.llm import bpe, chat, common, exact_dedup, golay, hnsw, line_dedup, mixing, quality, secret_scan, sharding, simhash
from strandweave.llm.common import connected_components, strip_spaces, word_count

WIDE = "doc_id long, text string, lang string, source string, n_chars long, keep_id string, h string, size string, shard string, score string, ids string, spans string, norm string"
SPACE = re.compile(r"[\x20\x09-\x0D]")


def sentence(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(n))


@pytest.fixture(scope="module")
def odd_rows() -> list[tuple]:
    """Documents with every awkward property; clashing columns hold junk."""
    rng = random.Random(4)
    text = [sentence(rng, 60) for _ in range(12)]
    rows = [(i, t) for i, t in enumerate(text)]
    rows += [(100, text[0]), (101, text[0] + "  "), (102, "\t" + text[0]), (103, None), (104, ""), (105, " \n\t"), (106, text[1].upper())]
    rows += [(107, text[2] + " more"), (107, text[2] + " more"), (None, text[3]), (None, None), (108, "ß é 日本   x"), (109, "a" * 50_000), (110, sentence(rng, 20_000))]
    return [(i, t, None, None if i == 5 else f"s{(i or 0) % 3}", None, "junk", "junk", "junk", "junk", "junk", "junk", "junk", "junk") for i, t in rows]


@pytest.fixture(scope="module")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, WIDE).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], WIDE)


# 1 chat


def conversations(rng: random.Random) -> list[tuple]:
    rows, pool = [], ["hi", "<s>[INST] ok [/INST]</s>", "a\\b", "", "é\n日本", "\\<s>", "[INST", "/INST]"]
    for c in range(60):
        for t in range(rng.randint(1, 5)):
            rows.append((c, t, ["user", "assistant"][t % 2], rng.choice(pool)))
    rows += [(200, None, None, None), (200, 1, "assistant", None), (201, 0, "user", "x"), (201, 0, "user", "x"), (None, 0, "assistant", "z" * 30_000), (202, 0, "<s>", "hi")]
    return rows


def test_chat_round_trip(spark):
    rows = conversations(random.Random(1))
    df = spark.createDataFrame([(*r, "junk", "junk") for r in rows], "conv_id long, turn long, role string, text string, turns string, key string")
    packs = chat.pack(df)
    got = {r["conv_id"]: r for r in chat.unpack(packs).collect()}
    want = defaultdict(list)
    for c, t, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        want[c].append((role or "", text or ""))
    assert set(got) == set(want)
    for c, turns in want.items():
        assert [(t["role"], t["text"]) for t in got[c]["turns"]] == turns
        assert got[c]["loss_text"] == "".join(t for r, t in turns if r == "assistant")
        assert got[c]["formatted_chars"] == sum(20 + len(chat.escape(r)) + len(chat.escape(t)) for r, t in turns)


def test_chat_shares_prefixes_once(spark):
    rows = conversations(random.Random(2))
    packs = chat.pack(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").coalesce(1)).collect()
    turns = defaultdict(list)
    for c, _, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        turns[c].append((role or "", text or ""))
    for p in packs:
        here = {c["conv_id"] for c in p["convs"]}
        prefixes = {tuple(turns[c][: k + 1]) for c in here for k in range(len(turns[c]))}
        assert len(p["segments"]) == len(prefixes)  # each shared turn once
        for k, s in enumerate(p["segments"]):
            assert s["start"] == (p["segments"][k - 1]["end"] if k else 0)
            assert s["position"] == sum(a["end"] - a["start"] for a in s["ancestors"])
            assert s["parent"] < k
    assert sum(len(p["convs"]) for p in packs) == len(turns)


def test_chat_small_packs_and_empty(spark):
    rows = [(c, t, "user", "same" if t == 0 else f"{c}") for c in range(50) for t in range(2)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    packs = chat.pack(df, pack_convs=7)
    assert packs.where(F.size("convs") > 7).count() == 0
    assert chat.unpack(packs).where(F.size("turns") == 2).count() == 50
    assert chat.unpack(chat.pack(df.limit(0))).count() == 0


def test_chat_reads_back_in_slices(spark, monkeypatch):
    """Many conversations behind one long first turn: what stands for 120 MB never stands in one batch."""
    monkeypatch.setattr(chat, "SLICE_CHARS", 1 << 20)
    first = "x" * 200_000
    df = spark.createDataFrame([(c, t, ["user", "assistant"][t], first if t == 0 else f"reply {c // 2}") for c in range(600) for t in (0, 1)], "conv_id long, turn long, role string, text string")
    packs = chat.pack(df)
    assert packs.agg(F.sum(F.length("text"))).first()[0] < 3_000_000
    got = {r["conv_id"]: (r["n"], r["loss_text"]) for r in chat.unpack(packs).select("conv_id", F.length(F.get(F.col("turns"), F.lit(0))["text"]).alias("n"), "loss_text").collect()}
    assert got == {c: (200_000, f"reply {c // 2}") for c in range(600)}


# 2 nearest neighbours


def brute(vectors: dict, queries: list, k: int) -> dict:
    out = {}
    for q in queries:
        s = [(-float(np.dot(vectors[q].astype(float), v.astype(float))), i) for i, v in vectors.items() if i != q and len(v) == len(vectors[q])]
        out[q] = [i for _, i in sorted((round(a, 9), i) for a, i in s)[:k]]
    return out


def test_hnsw_recall(spark, monkeypatch):
    monkeypatch.setattr(hnsw, "LEAST_ROWS", 250)
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(12, 16))
    x = {i: (centres[i % 12] + 0.4 * rng.normal(size=16)).astype(np.float32) * (1 + i % 3) for i in range(1000)}
    df = spark.createDataFrame([(i, v.tolist()) for i, v in x.items()], "vec_id long, embedding array<float>")
    got = defaultdict(list)
    for r in hnsw.nearest(df, df.where("vec_id % 20 = 0"), 20).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append(r["vec_id"])
        assert r["score"] == pytest.approx(float(np.dot(x[r["query_id"]].astype(float), x[r["vec_id"]].astype(float))))
    want = brute(x, list(range(0, 1000, 20)), 20)
    assert np.mean([len(set(got[q]) & set(want[q])) / 20 for q in want]) >= 0.95


def test_hnsw_recall_with_many_shards(spark, monkeypatch):
    """Vectors without any clusters, 14 graphs."""
    monkeypatch.setattr(hnsw, "LEAST_ROWS", 200)
    x = np.random.default_rng(2).normal(size=(2900, 32)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = defaultdict(set)
    for r in hnsw.nearest(df, df.where("vec_id % 20 = 0"), 20, shards=99).collect():
        got[r["query_id"]].add(r["vec_id"])
    score = x[::20].astype(float) @ x.astype(float).T
    score[np.arange(len(score)), np.arange(0, 2900, 20)] = -9
    want = np.argsort(-score, axis=1)[:, :20]
    assert np.mean([len(got[20 * q] & set(row.tolist())) / 20 for q, row in enumerate(want)]) >= 0.95


def test_hnsw_shards_grow_before_they_multiply():
    most = hnsw.SHARD_BYTES // (4 * (64 + hnsw.LOWEST + 4))
    assert [hnsw.shard_count(n, 64) for n in (0, 100, 5000, 10**4, 10**5, 4 * most, 4 * most + 1, 10 * most)] == [1, 1, 2, 4, 4, 4, 5, 10]


def test_hnsw_copies_and_odd_vectors(spark):
    rows = [(i, [1.0, 0.0]) for i in range(400)] + [(1000, [0.0, 1.0]), (1001, [0.9, 0.1]), (1002, None), (1003, [0.0, 0.0]), (1004, [float("nan"), 1.0]), (1005, [None, 1.0]), (1006, [float("inf"), 1.0]), (1007, []), (1008, [1.0, 2.0, 3.0]), (None, [1.0, 0.0])]
    df = spark.createDataFrame([(*r, "junk") for r in rows], "vec_id long, embedding array<float>, rank string")
    got = defaultdict(list)
    for r in hnsw.nearest(df, df, 20).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append(r["vec_id"])
    assert got[0] == list(range(1, 21)) and got[7] == [*range(7), *range(8, 21)] and got[399] == list(range(20))
    assert got[1000][:2] == [1001, 0]
    assert not {1002, 1003, 1004, 1005, 1006, 1007, 1008, None} & set(got)
    few = hnsw.nearest(df.where("vec_id >= 1000"), df.where("vec_id = 1000"), 20).collect()
    assert [r["vec_id"] for r in few] == [1001]
    assert hnsw.nearest(df.limit(0), df.limit(0), 20).count() == 0


# 3 exact dedup


def classes_by_hand(rows: list[tuple]) -> dict:
    groups = defaultdict(list)
    for r in rows:
        groups[SPACE.sub("", r[1] or "")].append(r)
    return groups


@pytest.mark.parametrize("digest", [exact_dedup.md5_128, lambda c: F.substring(F.md5(c), 1, 1).cast("binary"), lambda c: F.lit(b"x")])
def test_exact_dedup(odd, odd_rows, digest):
    got = exact_dedup.classes(odd, digest=digest).collect()
    assert len(got) == len(odd_rows)
    groups = classes_by_hand(odd_rows)
    best = {hashlib.sha256(n.encode()).hexdigest(): (min(g, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0))[0], len(g)) for n, g in groups.items()}
    for r in got:
        assert (r["keep_id"], r["group_size"]) == best[r["text_sha256"]]
    assert Counter(r["text_sha256"] for r in got if r["kept"]) == Counter(best.keys())


def test_drop_copies(odd, odd_rows, none):
    got = exact_dedup.drop_copies(odd)
    assert got.columns == odd.columns
    rows = got.collect()
    groups = classes_by_hand(odd_rows)
    assert Counter(SPACE.sub("", r["text"] or "") for r in rows) == Counter(groups.keys())
    unique = odd.where("doc_id is not null").dropDuplicates(["doc_id"])
    assert exact_dedup.drop_copies(unique).count() == unique.select(strip_spaces(F.col("text"))).distinct().count()
    assert exact_dedup.drop_copies(none).count() == 0 and exact_dedup.classes(none).count() == 0


# 4 quality


def test_quality_learns_and_scores(spark, odd, none):
    rng = random.Random(3)
    docs, labels = [], []
    for i in range(400):
        good = i % 3 > 0
        t = sentence(rng, 80)
        docs.append((i, t if good else " ".join(f"{w.upper()}!!" for w in t.split())))
        labels.append((i, int(good)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    lab = spark.createDataFrame([*labels, (None, 1), (3, None)], "doc_id long, quality int")
    model = quality.fit(df, lab)
    got = {r["doc_id"]: r["score"] for r in quality.score(df, model).collect()}
    held = [(i, y) for i, y in labels if __import__("zlib").crc32(str(i).encode()) % 5 == 0]
    assert len(held) > 40 and np.mean([(got[i] >= 0.3) == bool(y) for i, y in held]) >= 0.97
    scored = quality.score(odd, model).collect()  # an input column named score is replaced
    assert len(scored) == odd.count() and all(0 <= r["score"] <= 1 for r in scored)
    assert quality.score(none, model).count() == 0
    assert quality.keep_good(df, lab).columns == df.columns
    flat = quality.fit(df, lab.limit(0))
    assert [r["score"] for r in quality.score(df, flat).collect()] == pytest.approx([0.3] * 400)


def test_quality_learns_from_every_labelled_row(spark):
    """Means of the model are those of all labelled rows, thousands of each class, and the threshold leaves the share of bad ones."""
    texts = {i: f"w{i} " * (i % 13 + 1) if i % 8 else f"W{i}!! " * (i % 5 + 1) for i in range(10_000)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    model = quality.fit(df, df.selectExpr("doc_id", "CAST(doc_id % 8 > 0 AS INT) AS quality"))
    seen = [i for i in texts if __import__("zlib").crc32(str(i).encode()) % 5]
    x = np.array([quality.features(texts[i]) for i in seen])
    assert model.mean == pytest.approx(x.mean(0), abs=1e-9)
    assert int((model.raw(x) < model.cut).sum()) == sum(i % 8 == 0 for i in seen)


# 5 lines


def maximal_repeats_by_hand(docs: list[tuple], min_words: int) -> dict:
    """Lines in any run of ``min_words`` words or more that occurred earlier, by comparing lines one by one."""
    out, before = {}, []
    for key, text in docs:
        own = [(i, t.strip()) for i, t in enumerate((text or "").split("\n")) if t.strip()]
        out[key] = set()
        for a in range(len(own)):
            for other in [*before, own]:
                for c in range(a if other is own else len(other)):
                    n = words = 0
                    while a + n < len(own) and c + n < (a if other is own else len(other)) and own[a + n][1] == other[c + n][1]:
                        words += len(own[a + n][1].split())
                        n += 1
                    if words >= min_words:
                        out[key] |= set(range(own[a][0], own[a + n - 1][0] + 1))
        before.append(own)
    return out


def test_line_dedup(spark, odd, none):
    rng = random.Random(8)
    pool = [sentence(rng, rng.randint(1, 9)) for _ in range(12)]
    docs = [(i, "\n".join(rng.choice([*pool, "", "  "]) for _ in range(rng.randint(0, 40)))) for i in range(80)]
    docs += [(80, docs[0][1]), (81, "\n".join(["same words here"] * 40)), (82, None)]
    df = spark.createDataFrame([(*d, "junk", "junk") for d in docs], "doc_id long, text string, runs string, n_removed string")
    got = {r["doc_id"]: r for r in line_dedup.drop_repeated_lines(df.repartition(4), min_words=10).collect()}
    want = maximal_repeats_by_hand(docs, 10)
    assert sum(map(len, want.values())) > 200
    for i, t in docs:
        lines = (t or "").split("\n")
        assert got[i]["n_removed"] == len(want[i]), i
        assert (got[i]["text"] or "") == "\n".join(x for k, x in enumerate(lines) if k not in want[i])
    assert line_dedup.drop_repeated_lines(odd).count() == odd.count()
    assert line_dedup.drop_repeated_lines(none).count() == 0


def test_line_dedup_extends_to_the_end_of_runs(spark):
    rng = random.Random(9)
    pool = [sentence(rng, rng.randint(1, 9)) for _ in range(12)]
    docs = [(i, "\n".join(rng.choice([*pool, "", "  "]) for _ in range(rng.randint(0, 30)))) for i in range(40)]
    run = [sentence(rng, 60), sentence(rng, 6), sentence(rng, 3)]
    docs += [(k, "\n".join([sentence(rng, 4), *run[:n], sentence(rng, 15)])) for k, n in ((50, 1), (51, 3), (52, 3), (53, 2))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: r for r in line_dedup.drop_repeated_lines(df.repartition(4), min_words=10).collect()}
    want = maximal_repeats_by_hand(docs, 10)
    assert [len(want[k]) for k in (50, 51, 52, 53)] == [0, 1, 3, 2]
    for i, t in docs:
        lines = (t or "").split("\n")
        assert got[i]["n_removed"] == len(want[i]), i
        assert got[i]["text"] == "\n".join(x for k, x in enumerate(lines) if k not in want[i])


# 6 tokens


def test_bpe(odd, none):
    import tiktoken

    ranks, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    plain = bpe.encoding(ranks, pattern)
    assert isinstance(plain, tiktoken.Encoding)
    got = bpe.decode(bpe.encode(odd, ranks, pattern), ranks, pattern)
    for r in got.select("text", "ids", "decoded").collect():
        assert list(r["ids"]) == plain.encode_ordinary(r["text"] or "")
        assert bytes(r["decoded"]) == (r["text"] or "").encode()
    assert bpe.encode(none, ranks, pattern).count() == 0


def test_bpe_parts():
    rng = random.Random(5)
    enc = bpe.encoding(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    for _ in range(300):
        text = "".join(rng.choice(["a", "B", "7", " ", "  ", "\n", "'s", "'", "é", "!", " ", "日", "<|endoftext|>", "٣"]) for _ in range(rng.randint(0, 60)))
        assert "".join(bpe.parts(text, 5)) == text
        assert bpe.encode_text(text, enc, 5) == enc.encode_ordinary(text), text


# 7 SimHash


def fingerprint_by_hand(text: str | None) -> int:
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components_by_hand(nodes, linked) -> dict:
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def test_golay_is_perfect():
    words = np.arange(1 << 23, dtype=np.int32)[::1001]
    index = golay.nearest(words)
    row, near = golay.around(words, 23)
    assert set(np.bincount(row)) <= {1, 6}
    assert all((near[row == k] == index[k]).any() for k in range(50))
    other = words ^ np.int32(1 << 7)
    found = {(r, i) for r, i in zip(row, near, strict=True)}
    assert all((k, i) in found for k, i in enumerate(golay.nearest(other)))


def test_simhash_fingerprints(odd, odd_rows, none):
    got = simhash.near_duplicates(odd).collect()
    assert Counter((r["doc_id"], r["fingerprint"]) for r in got) == Counter((r[0], f"{fingerprint_by_hand(r[1]):016x}") for r in odd_rows)
    assert simhash.near_duplicates(none).count() == 0
    empty = [r for r in got if r["doc_id"] in (103, 104, 105)]
    assert {r["fingerprint"] for r in empty} == {"0" * 16} and {r["component_id"] for r in empty} == {103}


@pytest.mark.parametrize("pairs", [simhash.PAIRS, 0])
def test_simhash_links_are_exact(spark, monkeypatch, pairs):
    monkeypatch.setattr(simhash, "PAIRS", pairs)  # 0: every bucket takes the way of crowded ones
    rng = random.Random(2)
    fps = set()
    for _ in range(25):
        f = rng.getrandbits(64)
        for _ in range(rng.randint(1, 8)):
            fps.add(f)
            for _ in range(rng.randint(1, 3)):
                f ^= 1 << rng.randrange(64)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    got = {r["node"]: r["component"] for r in connected_components(simhash.links(df), "t").collect()}
    want = components_by_hand(signed, lambda a, b: (a ^ b).bit_count() <= 2 if (a < 0) == (b < 0) else ((a & (1 << 64) - 1) ^ (b & (1 << 64) - 1)).bit_count() <= 2)
    assert {f: got.get(f, f) for f in signed} == want


def broadcasts(df) -> int:
    return df._jdf.queryExecution().sparkPlan().toString().count("BroadcastHashJoin")


@pytest.fixture
def uncounted(monkeypatch):
    """Broadcast joins of the tables that are written, once no counted side is small: those that Spark sized itself."""
    seen, write = [], common.materialize

    def watched(df, name):
        if broadcasts(df):
            seen.append(name)
        return write(df, name)

    monkeypatch.setattr(common, "BROADCAST_BYTES", -1)
    for module in (common, simhash, exact_dedup):
        monkeypatch.setattr(module, "materialize", watched)
    return seen


def test_simhash_broadcasts_nothing_uncounted(spark, uncounted):
    """Keys are many times the rows that they are made from, and Spark sizes them by those."""
    rng = random.Random(14)
    fps = common.materialize(spark.createDataFrame([(rng.getrandbits(63) >> 9,) for _ in range(300)], "fp long"), "t-fps")
    assert not broadcasts(simhash.links(fps))
    docs = spark.createDataFrame([(i, sentence(rng, 30)) for i in range(60)] * 2, "doc_id long, text string")
    assert not broadcasts(simhash.near_duplicates(docs)) and not uncounted


def test_near_copies_broadcast_nothing_uncounted(spark, monkeypatch, uncounted):
    monkeypatch.setattr(simhash, "CROWD", 3)
    rng = random.Random(15)
    words = [sentence(rng, 60).split() for _ in range(8)]
    docs = [edited(rng, w, k % 4) for w in words for k in range(8)]
    df = common.materialize(spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string"), "t-docs")
    out = exact_dedup.drop_copies(simhash.drop_near_copies(df))
    assert not broadcasts(out) and not uncounted
    monkeypatch.undo()
    assert {r["doc_id"] for r in out.collect()} == {r["doc_id"] for r in exact_dedup.drop_copies(simhash.drop_near_copies(df)).collect()}


def test_near_copies(spark, none, odd):
    rng = random.Random(6)
    docs, groups = [], 30
    for g in range(groups):
        words = sentence(rng, 200).split()
        docs.append((g, " ".join(words)))
        for k in range(3):
            near = list(words)
            near[rng.randrange(200)] = "changed"
            near[rng.randrange(200)] = "again"
            docs.append((100 + 3 * g + k, " ".join(near)))
    df = spark.createDataFrame([(*d, "junk") for d in docs], "doc_id long, text string, sketch string")
    kept = {r["doc_id"] for r in simhash.drop_near_copies(df).collect()}
    assert set(range(groups)) <= kept and len(kept) <= groups + 4
    assert simhash.drop_near_copies(none).count() == 0
    assert simhash.drop_near_copies(odd).columns == odd.columns


def near_copies_by_hand(docs: list[tuple], similarity: float) -> set:
    """Ids that stay, by comparing the whole sets of five-word shingles of all pairs."""
    sets = {i: set(simhash.shingle_hashes(simhash.words_of(t), 5).tolist()) for i, t in docs}
    comp = components_by_hand([i for i in sets if sets[i]], lambda a, b: len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b]) - 1e-9)
    return {i for i in sets if comp.get(i, i) == i}


def edited(rng: random.Random, words: list[str], times: int) -> str:
    words = list(words)
    for _ in range(times):
        words[rng.randrange(len(words))] = sentence(rng, 1)
    return " ".join(words)


@pytest.mark.parametrize(("crowd", "near"), [(simhash.CROWD, simhash.NEAR), (1, simhash.NEAR), (1, 2.0)])
def test_near_copies_in_crowds_are_all_compared(spark, monkeypatch, crowd, near):
    monkeypatch.setattr(simhash, "CROWD", crowd)  # 1: every shared hash takes the way of crowded ones
    monkeypatch.setattr(simhash, "NEAR", near)  # 2: leaders settle nothing, the rest is compared in all pairs
    rng = random.Random(11)
    common, base, long, docs = sentence(rng, 40), sentence(rng, 60).split(), sentence(rng, 200).split(), []
    docs += [f"{common} {sentence(rng, rng.randint(3, 60))}" for _ in range(60)]  # one passage in unrelated documents
    docs += [edited(rng, base, rng.randint(0, 3)) for _ in range(60)]  # a group of copies, near and not so near
    docs += [edited(rng, long, rng.randint(1, 5)) for _ in range(120)] + [edited(rng, long, rng.randint(5, 9)) for _ in range(30)]  # a larger one, without its text
    docs += [edited(rng, words, 1) for words in [f"{common} {sentence(rng, 30)}".split() for _ in range(10)] for _ in range(2)]
    docs += ["few words", "Few  words", "few other words", ""]
    rng.shuffle(docs)
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").repartition(3)
    assert {r["doc_id"] for r in simhash.drop_near_copies(df).collect()} == near_copies_by_hand(list(enumerate(docs)), 0.8)


def test_near_copies_are_judged_on_whole_sets(spark):
    rng = random.Random(12)
    docs = []
    for size in (130, 180, 250, 600):  # about the limit: some pairs over 0.8, some under
        for _ in range(12):
            words = sentence(rng, size).split()
            docs += [" ".join(words), edited(rng, words, round(size * 0.11 / 5) + rng.randint(-1, 1))]
    want = near_copies_by_hand(list(enumerate(docs)), 0.8)
    assert len(docs) / 2 < len(want) < len(docs)
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").repartition(3)
    assert {r["doc_id"] for r in simhash.drop_near_copies(df).collect()} == want


def test_near_copies_are_found_by_fingerprints(spark, monkeypatch):
    """The SimHash links that whole sets prove, without the prefixes that follow."""
    monkeypatch.setattr(simhash, "shared_prefixes", lambda sets, every=simhash.shared_prefixes: simhash.materialize(every(sets).limit(0), "none"))
    rng = random.Random(13)
    docs = []
    for _ in range(10):
        words = sentence(rng, 200).split()
        docs += [" ".join(words), " ".join(words[:53] + words[50:])]  # three words twice: the same fingerprint
        docs += [edited(rng, words, 1) for _ in range(4)]  # some bits away
        words = sentence(rng, 60).split()
        docs += [" ".join(words), " ".join(words[::-1])]  # the same fingerprint, not alike
    fps = [simhash.word_fingerprint(simhash.words_of(t)) & (1 << 64) - 1 for t in docs]
    sets = [set(simhash.shingle_hashes(simhash.words_of(t), 5).tolist()) for t in docs]
    comp = components_by_hand(range(len(docs)), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 2 and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]))
    want = {i for i in comp if comp[i] == i}
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").repartition(3)
    assert {r["doc_id"] for r in simhash.drop_near_copies(df).collect()} == want and len(want) < 65


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 50 + i) for i in range(20)] + [(7, 7), (None, 3), (200, 201)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long"), "t").collect()}
    assert {got[i] for i in range(41)} == {0} and {got[50 + i] for i in range(20)} | {got[100]} == {50} and got[201] == 200
    assert connected_components(spark.createDataFrame([], "a long, b long"), "t").count() == 0


# 8 secrets


def base_by_hand(text: str) -> list[tuple]:
    assign = re.compile(r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    out = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[1]) >= 8]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(out)


def test_secret_spans(spark, odd, none):
    rng = random.Random(9)
    bits = ["token", "PassWord", "api_key", "APIKEY", "secret", '"', "'", " ", "=", ":", "abcd1234", "deadbeef" * 4, "AKIA", "ABCDEFGHIJKL", "x", "\x01", "\x02", "é", "日本", "😀", ".", "/", "\n", "a1b2"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 25))) for _ in range(400)] + [None, "", "token=secret: abcdefghijk"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    models = secret_scan.train(secret_scan.samples(df, "doc_id", "text"))
    for r in secret_scan.scan(df, models).collect():
        got = [(s["start"], s["kind"], s["end"]) for s in r["spans"]]
        assert got == sorted(got) and [s for s in got if s[1] < 3] == base_by_hand(r["text"] or ""), r["text"]
    many = spark.createDataFrame([(1, "token=a1b2c3d4 x " * 5000 + "deadbeef" * 4 + " é " * 3000)], "doc_id long, text string")
    begin = time.time()
    found = secret_scan.scan(many, models).first()["spans"]
    assert time.time() - begin < 5 and [(s["start"], s["kind"], s["end"]) for s in found] == base_by_hand(many.first()["text"])
    assert secret_scan.scan(odd, models).count() == odd.count() and secret_scan.scan(none, models).count() == 0


def test_markov_models(spark):
    rng = random.Random(10)
    word = ["get", "user", "name", "token", "value", "list", "item", "count", "index", "table", "row", "total"]
    plain = ["_".join(rng.choice(word) for _ in range(4)) for _ in range(300)]
    keys = ["".join(rng.choice(secret_scan.ALPHABET[:62]) for _ in range(32)) for _ in range(300)]
    df = spark.createDataFrame([(x, False) for x in plain[:200]] + [(x, True) for x in keys[:200]] + [(None, True), ("", False)], "value string, random boolean")
    models = secret_scan.train(df)
    probe = spark.createDataFrame([(x,) for x in plain[200:] + keys[200:]], "value string")
    ratio = dict(probe.select("value", secret_scan.log_ratio(F.col("value"), models)).collect())
    assert np.mean([ratio[x] < 0 for x in plain[200:]]) > 0.98 and np.mean([ratio[x] > secret_scan.MIN_RATIO for x in keys[200:]]) > 0.98
    text = spark.createDataFrame([(1, f"see {keys[250]} and {plain[250]}")], "doc_id long, text string")
    found = secret_scan.scan(text, models).first()["spans"]
    assert [s["value"] for s in found] == [keys[250]]


WORDS = "user account create update delete request response handler config index table value result process stream batch window event parser buffer manager service client server session cache worker queue thread format number string object array matrix vector".split()


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_added_spans(spark, sf):
    """Models of whole tables find planted keys, at their places, and take no names for keys."""
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").select("doc_id", "text")
    models = secret_scan.train(secret_scan.samples(docs, "doc_id", "text"))
    rng = random.Random(9)
    letters = secret_scan.ALPHABET[:62]
    some = lambda make: [v for v in (make() for _ in range(400)) if len(v) >= 20][:300]
    named = lambda joint: some(lambda: joint.join(rng.choice(WORDS) for _ in range(rng.randint(4, 6))))
    kinds = {
        "base62": some(lambda: "".join(rng.choice(letters) for _ in range(rng.randint(24, 48)))),
        "base64": some(lambda: "".join(rng.choice(letters + "+/") for _ in range(rng.randint(24, 48))) + rng.choice(["", "="])),
        "snake": named("_"),
        "path": named("/"),
        "dashed": named("-"),
        "camel": some(lambda: "".join(rng.choice(WORDS).title() for _ in range(rng.randint(4, 6)))),
    }
    rows = [(f"{kind}", f"é see {v}, here", v) for kind, values in kinds.items() for v in values]
    found = Counter()
    for r in secret_scan.scan(spark.createDataFrame(rows, "kind string, text string, v string"), models).collect():
        added = [s for s in r["spans"] if s["kind"] == 3]
        assert all((s["start"], s["end"]) == (6, 6 + len(r["v"])) for s in added)
        found[r["kind"]] += bool(added)
    assert found["base62"] >= 270 and found["base64"] >= 270
    assert max(found[k] for k in ("snake", "path", "dashed", "camel")) < 3


# 9 shards


def test_shuffle_is_exact(spark, odd, none, monkeypatch):
    monkeypatch.setattr(sharding, "PART_ROWS", 20)
    df = spark.range(1003).withColumn("slot", F.lit("junk"))
    a = sharding.shuffle(df, [F.col("id")], 7).select("id", "shard", "slot").collect()
    b = sharding.shuffle(df.repartition(5), [F.col("id")], 7).select("id", "shard", "slot").collect()
    assert set(a) == set(b) and len(a) == 1003
    by = defaultdict(list)
    for r in a:
        by[r["shard"]].append(r["slot"])
    assert len(by) == 7 and all(sorted(s) == list(range(len(s))) and len(s) in (143, 144) for s in by.values())
    even = Counter(r["shard"] for r in a if r["id"] < 500)
    assert all(40 < n < 105 for n in even.values())
    keys = [F.col("doc_id"), F.xxhash64("text")]
    assert sharding.shuffle(odd, keys, 40).count() == odd.count() and sharding.shuffle(none, keys, 40).count() == 0


def test_matrix_margins():
    rng = np.random.default_rng(1)
    m = sharding.matrix(rng, [10, 0, 5, 7], [8, 7, 7])
    assert m.sum(0).tolist() == [8, 7, 7] and m.sum(1).tolist() == [10, 0, 5, 7]
    big = [sharding.hypergeometric(rng, 900_000_000, 1_100_000_000, 5000) for _ in range(500)]
    assert abs(np.mean(big) - 2250) < 10 and 25 < np.std(big) < 46


# 10 mixtures


def targets(sizes: list[int], weights: list[float], total: float, most: float) -> list[float]:
    """Shares of ``total`` by weight, each stopped at ``most`` times its size, the excess reshared until none is above."""
    out, free, left = [0.0] * len(sizes), list(range(len(sizes))), total
    while free:
        by = sum(weights[i] for i in free)
        over = [i for i in free if left * weights[i] / by > most * sizes[i]]
        if not over:
            for i in free:
                out[i] = left * weights[i] / by
            break
        for i in over:
            out[i] = float(most * sizes[i])
        left -= sum(out[i] for i in over)
        free = [i for i in free if i not in set(over)]
    return out

def test_targets():
    assert targets([100, 100, 100], [3, 1, 2], 450, 2) == [200, pytest.approx(250 / 3), pytest.approx(500 / 3)]
    assert targets([], [], 0, 2) == [] and targets([0, 10], [3, 1], 15, 2) == [0, 15]


def test_split_quotas():
    q = np.array([100, 7, 0, 33])
    m = mixing.split_quotas(np.random.default_rng(1), q, 6)
    assert m.sum(0).tolist() == q.tolist() and m.shape == (6, 4) and m.sum(1).max() - m.sum(1).min() <= 3


@pytest.mark.parametrize(("fan", "rows"), [(mixing.FAN, mixing.BROADCAST_ROWS), (2, 1)])
def test_mixing(spark, odd, none, monkeypatch, fan, rows):
    monkeypatch.setattr(mixing, "FAN", fan)  # 2: sources are parted in levels
    monkeypatch.setattr(mixing, "BROADCAST_ROWS", rows)  # 1: their tables are joined by shuffles
    rng = random.Random(11)
    rows = [(i, sentence(rng, rng.randint(0, 30)) or None, None if i % 10 == 0 else f"s{i % 5}") for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.plan(df).select("doc_id", "source", "size", "source_size", "target", "copies", "taken", "shards").collect()
    again = mixing.plan(df.repartition(7)).select("doc_id", "source", "size", "source_size", "target", "copies", "taken", "shards").collect()
    assert sorted(got, key=str) == sorted(again, key=str)
    taken, target, size = Counter(), {}, {}
    for r in got:
        taken[r["source"]] += r["taken"]
        target[r["source"]], size[r["source"]] = r["target"], r["source_size"]
        assert r["copies"] <= 2 and r["taken"] == r["copies"] * r["size"] and len(r["shards"]) == r["copies"]
    assert sum(target.values()) == pytest.approx(1.5 * sum(size.values()))
    assert all(target[s] - 30 < taken[s] <= target[s] for s in target)
    want = dict(zip(sorted(size, key=lambda s: (s is None, s or "")), targets([size[s] for s in sorted(size, key=lambda s: (s is None, s or ""))], [3, 1, 2] * 2, 1.5 * sum(size.values()), 2), strict=False))
    assert target == pytest.approx(want)
    dealt = Counter(shard for r in got for shard in r["shards"])
    assert set(dealt) == set(range(mixing.SHARDS)) and max(dealt.values()) < 3 * min(dealt.values())
    copies = {r["doc_id"]: r["copies"] for r in got}
    drawn = mixing.draw(df)
    assert drawn.columns == df.columns
    # the rows of a partition are of one shard and in its order; the pieces of a shard follow each other
    parts = mixing.draw(df, task_words=100).select("doc_id", F.spark_partition_id().alias("part")).collect()
    order = {}
    for r in parts:
        order.setdefault(r["part"], []).append(r["doc_id"])
    shuffled = sorted((shard, place, r["doc_id"]) for r in mixing.plan(df).collect() for shard, place in zip(r["shards"], r["places"], strict=True))
    assert [i for part in sorted(order) for i in order[part]] == [i for _, _, i in shuffled]
    assert max(map(len, order.values())) < 60 and len(order) > mixing.SHARDS
    assert Counter(r["doc_id"] for r in drawn.collect()) == Counter({i: n for i, n in copies.items() if n})
    assert mixing.draw(odd).count() == mixing.plan(odd).agg(F.sum("copies")).first()[0]
    assert mixing.plan(none).count() == 0 and mixing.draw(none).count() == 0


@pytest.mark.parametrize("fan", [mixing.FAN, 3])
def test_split_sources(spark, monkeypatch, fan):
    """Exact shares of shards and sources, with one level or three; the same draw again."""
    monkeypatch.setattr(mixing, "FAN", fan)
    quotas = [(s, (s * 7) % 5) for s in range(20)]
    uses = spark.createDataFrame(quotas, "_sw_s long, uses long")
    got = {r["_sw_s"]: r["drawn"] for r in mixing.split_sources(uses, 6, 1).collect()}
    assert {s: sum(d) for s, d in got.items()} == dict(quotas)
    shares = [sum(d[j] for d in got.values()) for j in range(6)]
    assert sum(shares) == sum(n for _, n in quotas) and max(shares) - min(shares) <= 1
    assert got == {r["_sw_s"]: r["drawn"] for r in mixing.split_sources(uses.repartition(5), 6, 1).collect()}


def test_word_count(spark):
    df = spark.createDataFrame([(None,), ("",), (" a\tb\n\x0bc ",), ("a b",)], "t string")
    assert [r[0] for r in df.select(word_count(F.col("t"))).collect()] == [0, 0, 3, 1]
