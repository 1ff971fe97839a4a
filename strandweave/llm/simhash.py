"""SimHash near-duplicates: Golay-code keys of fingerprint segments, joined, verified and merged into components."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import golay
from .common import PAIR_BYTES, connected_components, discard, materialize, shuffled, small, small_batches

SEED = 42
#: Fingerprints link up to this many differing bits; the keys and the words in between are made for 2.
BITS = 2
#: (lowest bit, length) of the segments of a 64-bit fingerprint; each fits a 23-bit Golay word.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: A bucket with more candidate pairs than this is linked in linear time instead (``links``).
PAIRS = 10_000
_STEP = 1 << 16


def shingle_hashes(words: list[bytes], n: int) -> np.ndarray:
    """XXH64 (seed 42) of the space-joined word n-grams, repeats included; of fewer words, of all of them."""
    h, join = xxhash.xxh64_intdigest, b" ".join
    if len(words) < n:
        return np.array([h(join(words), SEED)] if words else [], dtype=np.uint64)
    return np.fromiter((h(join(s), SEED) for s in zip(*(words[i:] for i in range(n)))), dtype=np.uint64, count=len(words) - n + 1)


def majority(hashes: np.ndarray) -> int:
    """The 64 bits that are set in over half the hashes; 0 for none. Signed, as Spark's long."""
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), _STEP):
        part = hashes[at : at + _STEP].astype("<u8", copy=False)
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def words_of(text: str | None) -> list[bytes]:
    """Words between white space, A-Z lower-cased; as bytes, lower() and split() know ASCII alone."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 3) -> DataFrame:
    """(id, fp long) for every row and whole text; no words: 0. Null text counts as empty."""
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [majority(shingle_hashes(words_of(t.as_py()), n)) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps, pa.int64())], names=["id", "fp"])

    return small_batches(docs).select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


def bucket_keys(fps: DataFrame, cols: list[str]) -> DataFrame:
    """(columns of ``fps``, key long, probe boolean) for each 64-bit fingerprint in ``cols``.

    Two fingerprints at most 2 bits apart have one of the three SEGMENTS equal and, of the other two, one that
    differs in at most one bit. Each ordered pair of segments thus gives keys: the first segment's bits, and the
    index of a Golay codeword of the second. The index side takes the nearest codeword, the probe side all that
    are nearest to a word up to one bit away (one or six): if the pair differs in one bit there, either row's probe
    meets the other's index.
    """
    names = list(fps.columns)
    schema = T.StructType([*(fps.schema[c] for c in fps.columns), T.StructField("key", T.LongType()), T.StructField("probe", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2048):
                b = whole.slice(at, 2048)
                rows, keys, probes = [], [], []
                for number, c in enumerate(cols):
                    v = b.column(names.index(c)).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
                    seg = [(v >> np.uint64(lo)).astype(np.int64) & ((1 << size) - 1) for lo, size in SEGMENTS]
                    every = np.arange(len(v))
                    for j, (_, size) in enumerate(SEGMENTS):
                        near = golay.nearest(seg[j])
                        row, index = golay.around(seg[j], size)
                        for i in range(3):
                            if i != j:
                                table = ((number * 9 + i * 3 + j) << 34) + (seg[i] << 12)
                                rows += [every, row]
                                keys += [table + near, table[row] + index]
                                probes += [np.zeros(len(v), bool), np.ones(len(row), bool)]
                take = pa.array(np.concatenate(rows))
                kept = [b.column(k).take(take) for k in range(len(names))]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(np.concatenate(keys)), pa.array(np.concatenate(probes))], names=[*names, "key", "probe"])

    return fps.mapInArrow(run, schema)


def crowded(keys: DataFrame, pairs: int) -> DataFrame:
    """Keys whose buckets hold more than ``pairs`` candidate pairs."""
    n = keys.groupBy("key").agg(F.count(F.when(F.col("probe"), 1)).alias("p"), F.count(F.when(~F.col("probe"), 1)).alias("i"))
    return n.where(F.col("p") * F.col("i") > pairs).select("key")


def distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def links(fps: DataFrame) -> DataFrame:
    """(a, b): pairs of distinct fingerprints that join all those at most BITS apart into components.

    Small buckets: index rows join probe rows on the key, and the exact distance decides. Crowded buckets, as a
    large group of near copies makes them, never emit their pairs: each fingerprint in one is linked, through the
    65 words at most one bit away, to the smallest fingerprint at such a word. Two fingerprints are at most 2 bits
    apart just when they share such a word, so no link is lost, and each row makes 65 rows whatever the group.
    """
    keys = bucket_keys(fps.select("fp"), ["fp"])
    hot = materialize(crowded(keys, PAIRS), "simhash-hot")
    n_hot = hot.count()
    cold = keys if not n_hot else keys.join(small(hot, n_hot, PAIR_BYTES), "key", "left_anti")
    index = cold.where("not probe").select("key", F.col("fp").alias("a"))
    probe = cold.where("probe").select("key", F.col("fp").alias("b"))
    pairs = index.join(shuffled(probe), "key").where((F.col("a") != F.col("b")) & (distance(F.col("a"), F.col("b")) <= BITS)).select("a", "b")
    if n_hot:
        packed = keys.join(small(hot, n_hot, PAIR_BYTES), "key", "left_semi").select("fp").distinct()
        masks = [0, *(1 << b for b in range(63)), -(1 << 63)]
        words = packed.select("fp", F.explode(F.array(*(F.lit(m).cast("long") for m in masks))).alias("m")).select("fp", F.col("fp").bitwiseXOR(F.col("m")).alias("w"))
        least = words.groupBy("w").agg(F.min("fp").alias("a"), F.count("*").alias("n")).where("n > 1").select("w", "a")
        star = words.join(shuffled(least), "w").where("a <> fp").select("a", F.col("fp").alias("b"))
        pairs = pairs.union(star)
    return pairs.distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 3) -> DataFrame:
    """One row per input row: id, fingerprint (16 hex digits), component_id (smallest id that links reach).

    Rows with one fingerprint are a class; ``links`` joins the classes, ``connected_components`` merges them.
    Null or empty text has fingerprint zero and links like any other. Null ids count as larger than all others;
    a component of null ids alone has a null component_id. Repeated rows each get a row. Only the two columns are
    read. No text is shuffled: what moves is a fingerprint, its id, and some forty keys per distinct fingerprint.
    """
    sig = materialize(fingerprints(docs, id_col, text_col, n), "simhash-fp")
    reps = materialize(sig.groupBy("fp").agg(F.min("id").alias("least")), "simhash-reps")
    n_reps = reps.count()
    comp = connected_components(links(reps), "simhash-cc")
    n_comp = comp.count()
    joined = reps.join(small(comp, n_comp, PAIR_BYTES), reps["fp"] == comp["node"])
    least = joined.groupBy("component").agg(F.min("least").alias("component_id"))
    moved = joined.join(small(least, n_comp, PAIR_BYTES), "component").select(F.col("node").alias("moved"), "component_id")
    label = reps.join(small(moved, n_comp, PAIR_BYTES), reps["fp"] == moved["moved"], "left").select(reps["fp"], F.when(F.col("moved").isNull(), F.col("least")).otherwise(F.col("component_id")).alias("component_id"))
    label = materialize(label, "simhash-label")
    return sig.join(small(label, n_reps, PAIR_BYTES), "fp").select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


# --- similarity of word shingles: SimHash links decided on whole sets, then an exact join of what they do not hold together ---

#: Hashes in this lowest share of their range are ordered by how many sets hold them; sets are told apart by those.
LOW = 0.3
#: A prefix hash with more sets than this is crowded: its sets meet a leader first.
CROWD = 16
#: Sets at least this much like their leader are compared by what they differ from it in.
NEAR = 0.25


def prefix_size(n: int, similarity: float) -> int:
    """Sets of n members and more that are ``similarity`` alike share one of this many first members in any order."""
    return n - math.ceil(similarity * n - 1e-9) + 1


def prefix_size_of(n: Column, similarity: float) -> Column:
    """The same of a column."""
    return (n - F.ceil(n * similarity - 1e-9) + 1).cast("int")


def word_fingerprint(words: list[bytes]) -> int:
    """SimHash of the set of words. Repeats do not count: the most frequent words would decide the bits, and unrelated
    texts of one language would link."""
    return majority(shingle_hashes(list(set(words)), 1))


def shingle_sets(docs: DataFrame, id_col: str, text_col: str, n: int, similarity: float, whole: bool = False) -> DataFrame:
    """(id, node, fp, size, prefix, hashes) of every row with words: a hash of its set of n-word shingles, the SimHash of
    its words (null if ``whole``), the set's and its prefix's size, and its hashes: all if ``whole``, else those in the
    LOW share of the range, or the prefix if longer."""
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), *(T.StructField(c, T.LongType()) for c in ("node", "fp")), *(T.StructField(c, T.IntegerType()) for c in ("size", "prefix")), T.StructField("hashes", T.ArrayType(T.LongType()))])
    bound = np.uint64(int(LOW * 2**64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, nodes, fps, sizes, prefixes, hashes = [], [], [], [], [], []
            for k, t in enumerate(b.column(1)):
                words = words_of(t.as_py())
                own = np.unique(shingle_hashes(words, n))
                if not len(own):
                    continue
                at.append(k)
                fps.append(None if whole else word_fingerprint(words))
                nodes.append(int(np.uint64(xxhash.xxh64_intdigest(own.astype("<u8").tobytes(), SEED)).view(np.int64)))
                sizes.append(len(own))
                prefixes.append(prefix_size(len(own), similarity))
                hashes.append((own if whole else own[: max(int(np.searchsorted(own, bound)), prefixes[-1])]).view(np.int64))
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int32())), pa.array(nodes, pa.int64()), pa.array(fps, pa.int64()), pa.array(sizes, pa.int32()), pa.array(prefixes, pa.int32()), pa.array(hashes, pa.list_(pa.int64()))], names=schema.names)

    return small_batches(docs).select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


def fingerprint_pairs(nodes: DataFrame) -> DataFrame:
    """(a, b): candidate pairs of the nodes of (node, fp), by fingerprints at most BITS apart.

    A fingerprint's smallest node stands for it: its other nodes are paired with that one, and ``links`` (Golay keys)
    pairs those of different fingerprints. So a large class makes a pair a node.
    """
    reps = materialize(nodes.groupBy("fp").agg(F.min("node").alias("rep")), "similar-reps")
    own = nodes.join(shuffled(reps), "fp").where("node <> rep").select(F.col("node").alias("a"), F.col("rep").alias("b"))
    one, two = reps.select(F.col("fp").alias("a"), F.col("rep").alias("ra")), reps.select(F.col("fp").alias("b"), F.col("rep").alias("rb"))
    pairs = materialize(own.union(links(reps).join(shuffled(one), "a").join(shuffled(two), "b").select("ra", "rb")), "similar-simhash")
    discard(reps)
    return pairs


def shared_prefixes(sets: DataFrame) -> DataFrame:
    """(node, size, lone, hash): the prefix hashes of each distinct set that another set has in its prefix too.

    All sets take one order of hashes: those of the LOW share by the number of rows that hold them, the others after
    them. A set with fewer of the LOW share than its prefix keeps its whole prefix. ``lone`` is the share of a set's
    hashes that no other row holds.
    """
    every = sets.select("node", "size", "prefix", F.size("hashes").alias("kept"), F.explode("hashes").alias("hash"))
    many = materialize(every.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1"), "similar-many")
    shared = materialize(every.join(shuffled(many), "hash").distinct(), "similar-shared")
    discard(many)
    own = Window.partitionBy("node")
    ranked = shared.withColumn("rank", F.row_number().over(own.orderBy("n", "hash"))).withColumn("lone", F.col("kept") - F.count("*").over(own))
    first = materialize(ranked.where("rank <= prefix - lone").select("node", "size", (F.col("lone") / F.col("kept")).alias("lone"), "hash"), "similar-first")
    again = materialize(first.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1"), "similar-again")
    prefixes = materialize(first.join(shuffled(again), "hash").select("node", "size", "lone", "hash", "n"), "similar-prefixes")
    discard(shared, first, again)
    return prefixes


def alike(pairs: DataFrame, whole: DataFrame, similarity: float) -> DataFrame:
    """The distinct pairs (a, b) of nodes whose whole sets are at least ``similarity`` alike."""
    pairs = materialize(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "similar-pairs")
    one, two = whole.select(F.col("node").alias("a"), F.col("hashes").alias("ha")), whole.select(F.col("node").alias("b"), F.col("hashes").alias("hb"))
    both = F.size(F.array_intersect("ha", "hb"))
    found = materialize(pairs.join(shuffled(one), "a").join(shuffled(two), "b").where(both / (F.size("ha") + F.size("hb") - both) >= similarity).select("a", "b"), "similar-alike")
    discard(pairs)
    return found


def fits(a: Column, b: Column, similarity: float) -> Column:
    """Whether sets of these sizes can be that much alike."""
    return F.least(a, b) >= F.greatest(a, b) * similarity - 1e-6


def met_leaders(ties: DataFrame, whole: DataFrame) -> DataFrame:
    """(node, lead, held, size, leading, likeness, apart) of the pairs of sets (node, lead, held): their sizes, how alike
    they are, and, from NEAR on, the hashes that just one of them has."""
    leaders = whole.join(shuffled(ties.select(F.col("lead").alias("node")).distinct()), "node", "left_semi")
    leaders = materialize(leaders.select(F.col("node").alias("lead"), F.col("hashes").alias("hl")), "similar-lead")
    held = leaders.agg(F.coalesce(F.sum(F.size("hl")), F.lit(0)).alias("n")).first()["n"]
    both = F.size(F.array_intersect("hashes", "hl"))
    met = ties.join(shuffled(whole), "node").join(small(leaders, held, 8), "lead").withColumn("both", both)
    met = met.withColumns({"size": F.size("hashes"), "leading": F.size("hl"), "likeness": F.col("both") / (F.size("hashes") + F.size("hl") - F.col("both"))})
    apart = F.when(F.col("likeness") >= NEAR, F.concat(F.array_except("hashes", "hl"), F.array_except("hl", "hashes")))
    out = materialize(met.select("node", "lead", "held", "size", "leading", "likeness", apart.alias("apart")), "similar-met")
    discard(leaders)
    return out


def apart_pairs(met: DataFrame, similarity: float) -> DataFrame:
    """(a, b): candidate pairs among the sets of one leader, of which at most one is ``similarity`` like it or ``held``
    together with it.

    Sets a and b differ in just what their differences from the leader differ in. So a pair that is alike has
    differences with many hashes in common, and those in turn have one among their first ones, as prefixes do: the
    rarest in the leader's group first. If a is not like the leader, at least one is needed, and nearly half of all
    that b has; edits of one text of which each is another share none. Hashes of one set alone are never emitted.
    """
    k = (1 - similarity) / (1 + similarity)  # sets alike differ in at most this share of both their sizes
    every = met.where(F.col("likeness") >= NEAR).select("lead", "node", "size", F.size("apart").alias("m"), ((F.col("likeness") < similarity) & ~F.col("held")).alias("rest"), (F.size("apart") - k * (F.col("size") + F.col("leading"))).alias("slack"), F.explode("apart").alias("hash"))
    many = materialize(every.groupBy("lead", "hash").agg(F.count("*").alias("c"), F.bool_or("rest").alias("any")).where("c > 1"), "similar-apart")
    own = Window.partitionBy("lead", "node")
    ranked = every.join(shuffled(many), ["lead", "hash"]).withColumn("place", F.row_number().over(own.orderBy("c", "hash")) + F.col("m") - F.count("*").over(own))
    # the least that any partner asks for, before the partner is known
    needed = F.ceil(F.when(F.col("rest"), (F.col("slack") + 1 - k) / 2).otherwise((1 - k) * F.col("m") / 2) - 1e-6)
    ranked = materialize(ranked.where(F.col("any") & (F.col("place") <= F.col("m") - needed + 1)).select("lead", "hash", "node", "size", "m", "rest", "place"), "similar-ranked")
    discard(many)
    one = ranked.where("rest").select("lead", "hash", F.col("node").alias("a"), F.col("size").alias("na"), F.col("m").alias("ma"), F.col("place").alias("pa"))
    two = ranked.select("lead", "hash", F.col("node").alias("b"), F.col("size").alias("nb"), F.col("m").alias("mb"), F.col("place").alias("pb"), F.col("rest").alias("rb"))
    need = F.ceil((F.col("ma") + F.col("mb") - k * (F.col("na") + F.col("nb"))) / 2 - 1e-6)
    reach = (F.col("pa") <= F.col("ma") - need + 1) & (F.col("pb") <= F.col("mb") - need + 1)
    once = (F.col("a") != F.col("b")) & (~F.col("rb") | (F.col("a") < F.col("b")))
    return one.join(shuffled(two), ["lead", "hash"]).where(once & reach & fits(F.col("na"), F.col("nb"), similarity)).select("a", "b")


def similar_links(known: DataFrame, prefixes: DataFrame, whole: DataFrame, similarity: float) -> DataFrame:
    """(a, b): pairs of nodes at least ``similarity`` alike that join all such pairs into components.

    The ``known`` pairs are alike (SimHash links that whole sets have proved) and lead: what their components hold
    together is not compared again. Prefixes of the sets find the pairs that join two of the components, for which
    fingerprints give no guarantee. The sets of a hash that few hold are all compared. Of a crowded one, the set with
    the fewest hashes of its own leads and is compared with all the others. Two sets that are like the leader, or in
    its component, need no comparison, as they are joined through it; other pairs of sets that are at least NEAR it are found by their differences from it
    (``apart_pairs``). Of a pair that is left, one set is less than NEAR the leader, and so, as 1 - likeness is a
    metric, is the other less than NEAR + 1 - ``similarity``. Only those sets go on: the next round takes prefixes of
    their whole sets, ordered by how many of these sets hold a hash. Should rounds stop to thin them out, all their
    pairs of different components are compared. So none that could join two components is left out.
    """
    side = lambda df, name: df.select("hash", F.col("node").alias(name), F.col("size").alias(f"n{name}"), *(F.col(c).alias(f"{c}{name}") for c in df.columns if c == "label"))
    labels = materialize(connected_components(known, "similar-cc").withColumnRenamed("component", "label"), "similar-labels")
    labels = small(labels, labels.count(), PAIR_BYTES)
    apart = (F.col("a") < F.col("b")) & (F.col("labela") != F.col("labelb")) & fits(F.col("na"), F.col("nb"), similarity)
    found, before = known, None
    while True:
        few = prefixes.where(F.col("n") <= CROWD).join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        pairs = side(few, "a").join(shuffled(side(few, "b")), "hash").where(apart)
        close = alike(pairs.select("a", "b"), whole, similarity)
        crowd = prefixes.where(F.col("n") > CROWD)
        leads = materialize(crowd.groupBy("hash").agg(F.min(F.struct("lone", F.xxhash64("node").alias("_h"), "node")).alias("x")).select("hash", F.col("x.node").alias("lead")), "similar-leads")
        n_leads = leads.count()
        if not n_leads:
            return materialize(found.union(close), "similar-found")
        tied = materialize(crowd.join(small(leads, n_leads, PAIR_BYTES), "hash").where("node <> lead"), "similar-tied")
        ties = tied.select("node", "lead").distinct().join(labels, "node", "left")
        ties = ties.join(labels.select(F.col("node").alias("lead"), F.col("label").alias("leading")), "lead", "left")
        met = met_leaders(ties.select("node", "lead", F.coalesce(F.col("label") == F.col("leading"), F.lit(False)).alias("held")), whole)
        near = met.where((F.col("likeness") >= similarity) & ~F.col("held")).select(F.least("node", "lead").alias("a"), F.greatest("node", "lead").alias("b"))
        rest = alike(apart_pairs(met, similarity), whole, similarity)
        more = materialize(found.union(close).union(near).union(rest), "similar-found")
        far = materialize(tied.join(shuffled(met.where(F.col("likeness") < NEAR + 1 - similarity).select("node", "lead")), ["node", "lead"]).select("hash", "node", "size"), "similar-far")
        discard(found, close, rest, leads, tied, met)
        found = more
        left = materialize(far.select("node").distinct(), "similar-left")
        held = left.count()
        if not held or before is not None and held > 0.8 * before:
            break
        before = held
        sets = whole.join(small(left, held, PAIR_BYTES), "node").withColumns({"size": F.size("hashes"), "prefix": prefix_size_of(F.size("hashes"), similarity)})
        prefixes = shared_prefixes(sets)
        discard(far, left)
    if held:
        comp = connected_components(found, "similar-cc").withColumnRenamed("component", "label")
        rows = materialize(far.join(small(comp, comp.count(), PAIR_BYTES), "node", "left").withColumn("label", F.coalesce("label", "node")), "similar-rows")
        pairs = side(rows, "a").join(shuffled(side(rows, "b")), "hash").where(apart)
        found = materialize(found.union(alike(pairs.select("a", "b"), whole, similarity)), "similar-found")
    return found


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, similarity: float = 0.8) -> DataFrame:
    """``docs`` with one row of each group of near copies (the smallest id), all columns kept.

    Near copies share at least ``similarity`` of their sets of n-word shingles (Jaccard, judged on the whole sets). Equal
    sets are one node. Candidates are the nodes whose SimHash fingerprints, of their words, link by Golay keys
    (``fingerprint_pairs``); whole sets decide, and components hold the links together. Fingerprints promise nothing
    about likeness, so an exact way for the rest follows (``similar_links``): two sets that are so alike share a hash of their
    prefixes (``prefix_size``) in any one order of hashes. Whole sets are made again from the texts of those that have a
    candidate or share a prefix hash. Rows without words (null
    and empty texts among them) have no shingles and are not near copies. Rows of one id share its fate. Null ids are kept.
    """
    sets = materialize(shingle_sets(docs, id_col, text_col, n, similarity).where("id is not null"), "similar-sets")
    signed = materialize(sets.groupBy("node").agg(F.min("fp").alias("fp")), "similar-fp")
    pairs = fingerprint_pairs(signed)
    discard(signed)
    prefixes = shared_prefixes(sets)
    some = prefixes.select("node").union(pairs.select("a")).union(pairs.select("b")).distinct()
    nodes = materialize(sets.join(shuffled(some), "node").groupBy("node").agg(F.min("id").alias("_sw_id")), "similar-nodes")
    held = nodes.count()
    some = docs.join(small(nodes.select("_sw_id"), held, PAIR_BYTES), docs[id_col] == F.col("_sw_id"), "left_semi")
    whole = shingle_sets(some, id_col, text_col, n, similarity, whole=True).join(small(nodes.select("node"), held, PAIR_BYTES), "node", "left_semi")
    whole = materialize(whole.groupBy("node").agg(F.first("hashes").alias("hashes")), "similar-whole")
    found = similar_links(alike(pairs, whole, similarity), prefixes, whole, similarity)
    discard(pairs, prefixes, nodes, whole)
    comp = connected_components(found, "similar-cc")
    named = sets.select("id", "node").join(small(comp, comp.count(), PAIR_BYTES), "node", "left").select("id", F.coalesce("component", "node").alias("component"))
    least = materialize(named.groupBy("component").agg(F.min("id").alias("least"), F.count("*").alias("m")).where("m > 1"), "similar-least")
    gone = materialize(named.join(small(least, least.count(), PAIR_BYTES), "component").where("id <> least").select(F.col("id").alias("_sw_id")).distinct(), "similar-out")
    discard(sets, least)
    return docs.join(small(gone, gone.count(), PAIR_BYTES), docs[id_col] == F.col("_sw_id"), "left_anti")
