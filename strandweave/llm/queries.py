"""The registered queries of the operators in this package, over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, exact_dedup, hard_negatives, hnsw, line_dedup, mixing, quality, secret_scan, sharding, simhash, structure, token_counts
from .common import materialize

#: Place of the rank file; a parameter of the operators.
RANKS = "byte_bpe_50k.tiktoken"
#: Place of the tokenizer file that counts tokens, and the count beyond which a text is over the limit.
TOKENIZER, TOKEN_LIMIT = "byte_bpe_50k.json", 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8(text: Column) -> Column:
    return F.coalesce(text, F.lit("")).cast("binary")


def op1_chat_prefix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", own), (-7, 1, "assistant", own)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(extra)
    read = chat.unpack(chat.pack(rows))
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"), F.char_length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"), "formatted_chars")


def op2_hnsw_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return hnsw.nearest(vectors, vectors.where(F.col("vec_id") % 20 == 0), k=20)


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.classes(table(spark, sf_dir, "documents"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    out = quality.score(docs, model).withColumn("held_out", quality.fold(F.col("doc_id")) == 0)
    return out.select("doc_id", "held_out", "score", (F.col("score") >= quality.CUT).cast("int").alias("predicted"))


def op5_line_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_removed", F.coalesce(F.char_length("text"), F.lit(0)).cast("long").alias("kept_chars"), F.sha2(utf8(F.col("text")), 256).alias("kept_sha256"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks, pattern = public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    ids = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), ranks, pattern).drop("text")
    both = bpe.decode(ids, ranks, pattern)
    joined = F.array_join(F.col("ids").cast("array<string>"), " ")
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(joined, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    models = secret_scan.train(secret_scan.samples(docs, "doc_id", "text"))
    found = secret_scan.scan(docs, models).select("doc_id", "spans")
    names = F.array(*(F.lit(k) for k in ("assign", "access", "hex", "random")))
    line = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    base = F.filter("spans", lambda s: s["kind"] < 3)
    return found.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"), F.sha2(line(base), 256).alias("base_sha256"), line(F.col("spans")).alias("spans"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    docs = table(spark, sf_dir, "documents").select("doc_id", (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("long").alias("size"), F.crc32(utf8(text)).alias("text_crc32"))
    docs = materialize(docs, "shard-rows")
    out = sharding.shuffle(docs, [F.col("doc_id"), F.col("text_crc32"), F.col("size")], shards=40)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.plan(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", F.col("taken").cast("long").alias("taken"), "copies", "shards", "places")


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.octet_length(utf8(F.col("text"))).cast("long").alias("n_bytes"))
    out = token_counts.count_tokens(docs, public_tokenizers.path(TOKENIZER))
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


def damaged(rows: DataFrame) -> DataFrame:
    """``conversations`` with the faults that the contract of op12 sets by crc32 of conversation and turn; nulls: a space."""
    text, space = F.coalesce("text", F.lit(" ")), F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    named = rows.select("conv_id", "turn", F.coalesce("role", space).alias("role"), text.alias("text"), (F.crc32(key.cast("binary")) % 20).alias("_d")).where("_d <> 0")
    changed = F.when(F.col("_d") == 1, "").when(F.col("_d") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("_d") == 4, "user").otherwise(F.col("role"))
    twice = F.explode(F.when(F.col("_d") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return named.select("conv_id", "turn", role.alias("role"), changed.alias("text"), twice.alias("_n")).drop("_n")


def op12_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    steps, found = structure.repair(damaged(rows))
    every = rows.select("conv_id").distinct()
    out = every.join(found, every["conv_id"].eqNullSafe(found["conv"]), "left").drop("conv")
    made = structure.digests(steps)
    out = out.join(made, out["conv_id"].eqNullSafe(made["conv"]), "left").drop("conv")
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    zero = [F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in names]
    return out.select("conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.select("vec_id", "embedding", label.alias("label")), F.col("vec_id") % 100 == 0)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_prefix_tree": op1_chat_prefix_tree,
    "op2_hnsw_search": op2_hnsw_search,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_line_winnowing": op5_line_winnowing,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_simhash_near_dedup": op7_simhash_near_dedup,
    "op8_secret_scan": op8_secret_scan,
    "op9_sharding": op9_sharding,
    "op10_mixing": op10_mixing,
    "op11_token_counts": op11_token_counts,
    "op12_structure_repair": op12_structure_repair,
    "op13_hard_negatives": op13_hard_negatives,
    "pipeline": pipeline,
}

def repair_sql() -> str:
    """SQL of op12: the cheapest (cost, audit, text) of each state, forward over a conversation's rows."""

    def step(state: str, cost: str, edit: str, line: str = "''") -> str:
        return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{edit}', 't': {state}.t || {line}}}"

    def least(*ways: str) -> str:
        return f"list_sort([{', '.join(ways)}])[1]"

    def only(initial: str, way: str) -> str:
        return f"CASE WHEN x.role[1] = '{initial}' THEN {way} ELSE {{'c': 1000000, 'a': '', 't': ''}} END"

    own, user, assistant = "chr(10) || x.role || ':' || x.text", "chr(10) || 'user:'", "chr(10) || 'assistant:'"
    keep, rerole, must = "x.broken", "2 + x.broken", "CASE WHEN x.must THEN 1000000 ELSE 0 END + "

    def filled(rows: str) -> str:
        return f"""(SELECT conv_id, i, e, s, u, {least("a", step("u", "2", "I", assistant))} AS a FROM
            (SELECT conv_id, i, e, s, a, {least("u", step("e", "2", "I", user), step("s", "2", "I", user), step("a", "2", "I", user))} AS u FROM {rows}))"""

    to_user = [way for q in ("e", "s", "a") for way in (only("u", step(f"f.{q}", must + keep, "K", own)), step(f"f.{q}", must + rerole, "R", user + " || x.text"))]
    to_assistant = [only("a", step("f.u", must + keep, "K", own)), step("f.u", must + rerole, "R", assistant + " || x.text")]
    return rf"""
        WITH RECURSIVE k AS (
          SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                 coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key
          FROM conversations),
        crc AS (
          SELECT *, xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)],
                   flatten(list_transform(range(length(key)), lambda n: [CAST(ascii(substr(key, CAST(n AS INTEGER) + 1, 1)) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))),
                   lambda h, b: xor(xor(h, b) >> 1, 3988292384 * (xor(h, b) & 1))), 4294967295) % 20 AS d
          FROM k),
        damaged AS (
          SELECT conv_id, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role,
                 CASE d WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
          FROM (SELECT *, unnest(CASE WHEN d = 3 THEN [0, 1] ELSE [0] END) FROM crc) WHERE d <> 0),
        numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged),
        seen AS (
          SELECT *, NOT regexp_matches(text, '[^ 	-
]') AS blank,
                 row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
                 regexp_extract(text, '([^ 	-
])[ 	-
]*$', 1) NOT IN ('.', '!', '?') AS cut,
                 lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) || role[1] AS pair
          FROM numbered),
        x AS (SELECT *, blank OR again AS must, CASE WHEN cut THEN 1 ELSE 0 END AS broken FROM seen),
        r AS (
          SELECT conv_id, CAST(0 AS BIGINT) AS i, {{'c': 0, 'a': '', 't': ''}} AS e, {{'c': 1000000, 'a': '', 't': ''}} AS s,
                 {{'c': 1000000, 'a': '', 't': ''}} AS u, {{'c': 1000000, 'a': '', 't': ''}} AS a
          FROM (SELECT DISTINCT conv_id FROM x)
          UNION ALL
          SELECT f.conv_id, x.i, {step("f.e", "3", "D")},
                 {least(step("f.s", "3", "D"), only("s", step("f.e", must + keep, "K", own)))},
                 {least(step("f.u", "3", "D"), *to_user)},
                 {least(step("f.a", "3", "D"), *to_assistant)}
          FROM {filled("r")} f JOIN x ON x.conv_id IS NOT DISTINCT FROM f.conv_id AND x.i = f.i + 1),
        ends AS (
          SELECT conv_id, {least("e", "a")} AS best
          FROM {filled("(SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1)")}),
        found AS (
          SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
                 count(*) FILTER (again AND NOT blank) AS duplicate, count(*) FILTER (cut AND NOT must) AS truncated,
                 count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
          FROM x GROUP BY conv_id)
        SELECT o.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
               coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(best.c, 0) AS BIGINT) AS cost,
               coalesce(best.a, '') AS audit, sha256(coalesce(substr(best.t, 2), '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) o
        LEFT JOIN found f ON f.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN ends n ON n.conv_id IS NOT DISTINCT FROM o.conv_id"""


ORACLE_SQL: dict[str, str] = {
    "op1_chat_prefix_tree": r"""
        WITH t AS (
          SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
          UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
          UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
        SELECT conv_id,
               count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
               CAST(sum(20 + length(role) + length(text)
                        + len(regexp_extract_all(role || chr(10) || text, '\\|</?s>|\[/?INST\]'))) AS BIGINT) AS formatted_chars
        FROM t GROUP BY conv_id""",
    "op3_exact_dedup": r"""
        WITH t AS (
          SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm, length(coalesce(text, '')) AS n_cp
          FROM documents)
        SELECT doc_id,
               first_value(doc_id) OVER (PARTITION BY norm ORDER BY n_cp DESC, doc_id) AS keep_id,
               count(*) OVER (PARTITION BY norm) AS group_size,
               doc_id = first_value(doc_id) OVER (PARTITION BY norm ORDER BY n_cp DESC, doc_id) AS kept,
               sha256(norm) AS text_sha256
        FROM t""",
    "op13_hard_negatives": """
        WITH t AS (
          SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                 list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
          FROM embeddings
          WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        pairs AS (
          SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS same,
                 CAST(list_sum(list_transform(list_zip(a.v, r.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
          FROM t a JOIN t r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0),
        positives AS (
          SELECT anchor_id, id AS positive_id, score AS positive_score FROM pairs WHERE same
          QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
        SELECT p.anchor_id, p.positive_id,
               CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.id) AS INTEGER) AS rank,
               n.id AS negative_id, p.positive_score, n.score AS negative_score
        FROM positives p JOIN pairs n ON n.anchor_id = p.anchor_id AND NOT n.same
         AND 80 * p.positive_score <= 100 * n.score AND n.score <= p.positive_score
        QUALIFY rank <= 5""",
    "op12_structure_repair": repair_sql(),
}
