"""Conversation structure repair: least-cost edits by a Viterbi search whose chunks run in parallel until their ranks converge."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .common import SPACES, discard, materialize

#: Rows of a conversation that one chunk of the search has.
CHUNK = 4096
#: Fix-up passes; conversations whose chunks have not converged by then are solved by products of their matrices.
PASSES = 6
#: Costs: an edit of each kind, and of keeping a row that breaks off.
DELETE, INSERT, REROLE, BROKEN = 3, 2, 2, 1
#: Place of what is inserted after the last row.
END = (1 << 63) - 1

# What has been written so far: nothing, a system turn, a user turn, an assistant turn. The roles have the form (s?(ua)+)?.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state that writing a user or assistant turn leads to (only one of them may follow), and that turn's role.
NEXT, WRITES = (USER, USER, ASSISTANT, USER), ("user", "user", "assistant", "user")
#: The state that keeping a row of each initial (s, u, a, other) leads to, by state; -1: it may not be kept there.
KEEPS = ((SYSTEM, -1, -1, -1), (USER, USER, -1, USER), (-1, -1, ASSISTANT, -1), (-1, -1, -1, -1))
#: Cost from each state to a whole conversation when no rows are left, and what then is inserted.
LAST, CLOSING = (0, 2 * INSERT, INSERT, 0), (0, 2, 1, 0)
FAR = 1 << 60


def back(code: int, after: list[int]) -> list[int]:
    """Costs before a row (code: initial * 2 + broken off) from those after it."""
    keep, broken = KEEPS[code >> 1], BROKEN if code & 1 else 0
    now = []
    for q in range(4):
        least = min(DELETE + after[q], REROLE + broken + after[NEXT[q]])
        if keep[q] >= 0:
            least = min(least, broken + after[keep[q]])
        now.append(least)
    now[USER] = min(now[USER], INSERT + now[ASSISTANT])
    now[ASSISTANT] = min(now[ASSISTANT], INSERT + now[USER])
    now[START] = min(now[START], INSERT + now[USER])
    now[SYSTEM] = min(now[SYSTEM], INSERT + now[USER])
    return now


def level(costs: list[int]) -> list[int]:
    """The vector less its least cost: equal for vectors that differ by a constant only."""
    least = min(costs)
    return [c - least for c in costs]


def through(codes: bytes, after: list[int]) -> list[int]:
    for code in reversed(codes):
        after = back(code, after)
    return level(after)


def rerun(codes: bytes, old: list[int], new: list[int], before: list[int]) -> list[int]:
    """The costs before a chunk that started from ``old`` with result ``before``, now from ``new``: the pass ends where
    both differ by a constant only."""
    for code in reversed(codes):
        old, new = level(back(code, old)), level(back(code, new))
        if old == new:
            return before
    return new


def trace(codes: bytes, costs: list[list[int]], state: int) -> tuple[list[tuple[int, str, str | None, int]], int]:
    """([(row, edit, role written if not the row's own, cost)], state at the end): of the cheapest edits those whose
    initials are ASCII-least. ``costs`` are those before each row and after the last; constants do not matter."""
    out = []
    for k, code in enumerate(codes):
        keep, broken = KEEPS[code >> 1][state], BROKEN if code & 1 else 0
        while costs[k][state] != DELETE + costs[k + 1][state] and costs[k][state] == INSERT + costs[k][NEXT[state]]:
            out.append((k, "I", WRITES[state], INSERT))
            state = NEXT[state]
            keep = KEEPS[code >> 1][state]
        if costs[k][state] == DELETE + costs[k + 1][state]:
            out.append((k, "D", None, DELETE))
        elif keep >= 0 and costs[k][state] == broken + costs[k + 1][keep]:
            out.append((k, "K", None, broken))
            state = keep
        else:
            out.append((k, "R", WRITES[state], REROLE + broken))
            state = NEXT[state]
    return out, state


def all_costs(codes: bytes, after: list[int]) -> list[list[int]]:
    costs = [list(after)]
    for code in reversed(codes):
        costs.append(back(code, costs[-1]))
    return costs[::-1]


def _mapped(df: DataFrame, schema: str, make) -> DataFrame:
    """``df`` through ``make``: from its rows as dicts to rows as tuples of ``schema``, in Arrow batches."""
    kind = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                made = list(make(b.slice(at, 256).to_pylist()))
                yield pa.RecordBatch.from_arrays([pa.array([m[k] for m in made], f.type) for k, f in enumerate(kind)], schema=kind)

    return df.mapInArrow(run, schema)


def place(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv, turn, role, text, part, pos), written: rows by conversation and turn (nulls first), of one turn by role and
    text (64 bytes of both, then a hash); ``pos`` rises in that order, ``part`` is the range a row lies in.

    Ranges are cut between rows, not between conversations: one that holds a third of all rows lies in many.
    """
    null = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    named = rows.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), null(role_col).alias("role"), null(text_col).alias("text"))
    head = F.substring(F.concat("role", F.lit("\0"), F.substring("text", 1, 64)).cast("binary"), 1, 64)
    keyed = named.withColumns({"_head": head, "_hash": F.xxhash64("role", "text"), "_tie": F.monotonically_increasing_id()})
    order = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), "_head", "_hash", "_tie"]
    placed = keyed.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("pos", F.monotonically_increasing_id())
    return materialize(placed.withColumn("part", F.shiftright("pos", 33)).drop("_head", "_hash", "_tie"), "repair-places")


def faults(placed: DataFrame) -> DataFrame:
    """(conv, turn, part, pos, initial, fault, previous, live), written. fault: blank, duplicate, truncated or null;
    previous: the initial of the row before, inside a range; live: how many rows of the conversation in this range, up
    to this one, need not be deleted.

    Whether role and text were seen earlier is a minimum per text, joined back by place, which is unique.
    """
    last = F.right(F.rtrim("text", F.lit(SPACES)), F.lit(1))
    size = F.octet_length("role").cast("string")
    light = placed.select("conv", "turn", "part", "pos", F.substring("role", 1, 1).alias("initial"), last.alias("last"), F.unhex(F.md5(F.concat(size, F.lit(":"), "role", "text").cast("binary"))).alias("key"))
    firsts = light.where("last <> ''").groupBy("conv", "key").agg(F.min("pos").alias("pos")).select("pos", F.lit(True).alias("first"))
    fault = F.when(F.col("last") == "", "blank").when(F.col("first").isNull(), "duplicate").when(~F.col("last").isin(".", "!", "?"), "truncated")
    marked = light.drop("key").join(firsts, "pos", "left").withColumn("fault", fault).drop("first", "last")
    own = Window.partitionBy("part", "conv").orderBy("pos")
    live = F.sum((F.coalesce("fault", F.lit("")).isin("", "truncated")).cast("long")).over(own.rowsBetween(Window.unboundedPreceding, 0))
    return materialize(marked.withColumns({"previous": F.lag("initial").over(own), "live": live}), "repair-faults")


def counts(marked: DataFrame) -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated, illegal) of the rows of ``faults``, as longs."""
    runs = marked.groupBy("part", "conv").agg(F.min_by("initial", "pos").alias("lo"), F.max_by("initial", "pos").alias("hi"))
    bad = lambda a, b: ~F.concat(a, b).isin("su", "ua", "au")
    seams = runs.withColumn("before", F.lag("hi").over(Window.partitionBy("conv").orderBy("part")))  # a row a range at most
    seams = seams.groupBy("conv").agg(F.count_if(bad(F.col("before"), F.col("lo"))).alias("_seams"))
    fault = lambda name: F.count_if(F.col("fault") == name).alias(name)
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps")
    per = marked.groupBy("conv").agg(gaps, fault("blank"), fault("duplicate"), fault("truncated"), F.count_if(bad(F.col("previous"), F.col("initial"))).alias("illegal"))
    both = per.alias("p").join(seams.alias("s"), F.expr("p.conv <=> s.conv"))
    return both.select("p.conv", "gaps", "blank", "duplicate", "truncated", (F.col("illegal") + F.col("_seams")).alias("illegal"))


def chunks(marked: DataFrame, size: int) -> DataFrame:
    """(conv, chunk, codes, places), written: rows that need not be deleted, ``size`` to a chunk, numbered without gaps.

    Deleting the others costs the same whatever else is done and comes first among equals, so the search leaves them out.
    """
    alive = marked.where("fault is null or fault = 'truncated'")
    runs = marked.groupBy("part", "conv").agg(F.max("live").alias("n"))
    before = F.sum("n").over(Window.partitionBy("conv").orderBy("part")) - F.col("n")
    runs = runs.select(F.col("part").alias("_part"), F.col("conv").alias("_conv"), before.alias("before"))
    code = F.when(F.col("initial") == "s", 0).when(F.col("initial") == "u", 1).when(F.col("initial") == "a", 2).otherwise(3)
    code = (code * 2 + F.col("fault").isNotNull().cast("int")).cast("int")
    numbered = alive.join(runs, (F.col("part") == F.col("_part")) & F.col("conv").eqNullSafe(F.col("_conv")))
    numbered = numbered.select("conv", F.floor((F.col("before") + F.col("live") - 1) / size).cast("long").alias("chunk"), F.struct("pos", code.alias("code")).alias("row"))
    held = numbered.groupBy("conv", "chunk").agg(F.array_sort(F.collect_list("row")).alias("rows"))
    codes = F.transform("rows", lambda r: r["code"])
    return materialize(held.select("conv", "chunk", codes.alias("codes"), F.transform("rows", lambda r: r["pos"]).alias("places")), "repair-chunks")


STATE = "conv {conv}, chunk long, codes array<int>, after array<long>, before array<long>, changed boolean"


def converge(many: DataFrame, passes: int) -> DataFrame:
    """(conv, chunk, after): costs after each chunk, but for a constant, of conversations with several chunks.

    Every chunk starts from the costs at an end. In a fix-up pass each takes the costs before its successor and, where
    they differ by more than a constant from those it started with, runs again until they do not. Passes end when no
    chunk's result changes. After ``passes`` of them, conversations that still change are solved by ``multiply``.
    """
    conv = many.schema["conv"].dataType.simpleString()
    schema = STATE.format(conv=conv)

    def begin(rows: list[dict]) -> Iterator[tuple]:
        for r in rows:
            yield r["conv"], r["chunk"], r["codes"], list(LAST), through(bytes(r["codes"]), list(LAST)), True

    def fix(rows: list[dict]) -> Iterator[tuple]:
        for r in rows:
            want = r["want"]
            if want is None or want == r["after"]:
                yield r["conv"], r["chunk"], r["codes"], r["after"], r["before"], False
            else:
                before = rerun(bytes(r["codes"]), r["after"], want, r["before"])
                yield r["conv"], r["chunk"], r["codes"], want, before, before != r["before"]

    now = materialize(_mapped(many, schema, begin), "repair-pass")
    for _ in range(passes):
        successor = now.select(F.col("conv").alias("_conv"), (F.col("chunk") - 1).alias("_chunk"), F.col("before").alias("want"))
        beside = now.join(successor, F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("chunk") == F.col("_chunk")), "left")
        new = materialize(_mapped(beside.drop("_conv", "_chunk"), schema, fix), "repair-pass")
        discard(now)
        now = new
        if now.where("changed").isEmpty():
            return now.select("conv", "chunk", "after")
    unsettled = now.where("changed").select(F.col("conv").alias("_conv")).distinct()
    same = F.col("conv").eqNullSafe(F.col("_conv"))
    settled = now.join(unsettled, same, "left_anti").select("conv", "chunk", "after")
    return settled.union(multiply(now.join(unsettled, same, "left_semi").select("conv", "chunk", "codes")))


def with_chunk(df: DataFrame, other: DataFrame, ahead: int, **names: str) -> DataFrame:
    """``df`` with columns of ``other`` (by their names here), from the chunk ``ahead`` of each."""
    beside = other.select(F.col("conv").alias("_conv"), (F.col("chunk") - ahead).alias("_chunk"), *(F.col(c).alias(n) for n, c in names.items()))
    return df.join(beside, F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("chunk") == F.col("_chunk")), "left").drop("_conv", "_chunk")


def multiply(many: DataFrame) -> DataFrame:
    """``converge`` for any conversation: a chunk's costs as a matrix of min-plus, doubled until it spans to the end."""
    schema = f"conv {many.schema['conv'].dataType.simpleString()}, chunk long, matrix array<long>"

    def begin(rows: list[dict]) -> Iterator[tuple]:
        for r in rows:  # columns: costs before the chunk if only one state may follow it
            columns = []
            for q in range(4):
                now = [0 if k == q else FAR for k in range(4)]
                for code in reversed(r["codes"]):
                    now = back(code, now)
                columns.append(now)
            yield r["conv"], r["chunk"], [min(FAR, columns[q][k]) for k in range(4) for q in range(4)]

    def double(rows: list[dict]) -> Iterator[tuple]:
        for r in rows:
            a, b = r["matrix"], r["then"]
            if b is not None:
                a = [min(FAR, *(a[4 * i + k] + b[4 * k + j] for k in range(4))) for i in range(4) for j in range(4)]
            yield r["conv"], r["chunk"], a

    def vector(rows: list[dict]) -> Iterator[tuple]:
        for r in rows:
            then = r["then"]
            yield r["conv"], r["chunk"], list(LAST) if then is None else level([min(then[4 * i + j] + LAST[j] for j in range(4)) for i in range(4)])

    now = materialize(_mapped(many, schema, begin), "repair-matrix")
    longest, step = now.agg(F.max("chunk").alias("n")).first()["n"] or 0, 1
    while step <= longest:
        new = materialize(_mapped(with_chunk(now, now, step, then="matrix"), schema, double), "repair-matrix")
        discard(now)
        now, step = new, 2 * step
    return materialize(_mapped(with_chunk(now, now, 1, then="matrix").drop("matrix"), schema.replace("matrix", "after"), vector), "repair-costs")


def entries(many: DataFrame) -> DataFrame:
    """(conv, chunk, state) at which the cheapest edits enter each chunk, from chunks with ``after``.

    A chunk is traced from every state; where all end alike, the next chunk's state is known, else the ends of chunks
    further back decide: spans double until they do or reach the first chunk.
    """
    conv = many.schema["conv"].dataType.simpleString()

    def begin(rows: list[dict]) -> Iterator[tuple]:
        for r in rows:
            costs = all_costs(bytes(r["codes"]), r["after"])
            yield r["conv"], r["chunk"], [trace(bytes(r["codes"]), costs, q)[1] for q in range(4)]

    now, step = materialize(_mapped(many, f"conv {conv}, chunk long, ends array<int>", begin), "repair-ends"), 1
    while not now.where((F.col("chunk") >= step) & (F.size(F.array_distinct("ends")) > 1)).isEmpty():
        beside = with_chunk(now, now, -step, first="ends")
        through_both = F.transform(F.coalesce("first", F.array(*map(F.lit, range(4)))), lambda q: F.get("ends", q))
        new = materialize(beside.select("conv", "chunk", through_both.alias("ends")), "repair-ends")
        discard(now)
        now, step = new, 2 * step
    state = F.coalesce(F.get("ends", F.lit(START)), F.lit(START))
    return with_chunk(now.select("conv", "chunk"), now, -1, ends="ends").select("conv", "chunk", state.alias("state"))


def edits(marked: DataFrame, size: int = CHUNK, passes: int = PASSES) -> DataFrame:
    """(conv, pos, nth, edit, role, cost): the cheapest edits, in order of pos and nth; role: what is written, null for the
    row's own. Of equally cheap ones those whose initials (Delete, Insert, Keep, Rerole) are ASCII-least."""
    held = chunks(marked, size)
    conv = held.schema["conv"].dataType.simpleString()
    lengths = held.groupBy("conv").agg(F.max("chunk").alias("last")).withColumnRenamed("conv", "_conv")
    sized = held.join(lengths, F.col("conv").eqNullSafe(F.col("_conv"))).drop("_conv")
    many = materialize(sized.where("last > 0").select("conv", "chunk", "codes"), "repair-many")
    if many.isEmpty():
        ready = sized.withColumns({"after": F.lit(None).cast("array<long>"), "state": F.lit(None).cast("int")})
    else:
        solved = with_chunk(many, converge(many, passes), 0, after="after")
        solved = materialize(with_chunk(solved, entries(solved), 0, state="state").drop("codes"), "repair-costs")
        ready = with_chunk(sized, solved, 0, after="after", state="state")

    def walk(rows: list[dict]) -> Iterator[tuple]:
        for r in rows:
            codes, places = bytes(r["codes"]), r["places"]
            found, state = trace(codes, all_costs(codes, r["after"] or list(LAST)), START if r["state"] is None else r["state"])
            nth = 0
            for k, (row, edit, role, cost) in enumerate(found):
                nth = nth + 1 if k and found[k - 1][0] == row else 0
                yield r["conv"], places[row], nth, edit, role, cost
            for nth in range(CLOSING[state] if r["chunk"] == r["last"] else 0):
                yield r["conv"], END, nth, "I", WRITES[state], INSERT
                state = NEXT[state]

    chosen = _mapped(ready, f"conv {conv}, pos long, nth int, edit string, role string, cost int", walk)
    gone = marked.where("fault in ('blank', 'duplicate')")
    none = F.lit(None).cast("string")
    return chosen.union(gone.select("conv", "pos", F.lit(0), F.lit("D"), none, F.lit(DELETE)))


def repair(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", chunk_rows: int = CHUNK, passes: int = PASSES) -> tuple[DataFrame, DataFrame]:
    """(steps, faults per conversation) of the least-cost repair of each conversation to roles of the form (s?(ua)+)?.

    Steps: conv, pos, nth, edit, cost, role, text: every edit in order of pos and nth. Keep (0), Rerole to user or assistant
    (2) and Insert of an empty user or assistant turn (2) write role and text; Delete (3) writes nothing and shows the row's
    own. Blank rows (no visible character) and duplicates (role and text seen earlier in the conversation) must go; truncated
    ones (last visible character none of .!?) cost 1 if they stay. Of equally cheap repairs the one whose edits' initials
    are ASCII-least. Faults: conv, gaps, blank, duplicate, truncated, illegal.

    Rows are ordered in ranges that cut long conversations (``place``). Those left by ``faults`` are numbered in chunks,
    which a backward Viterbi search takes in parallel from speculative costs, again where its start proves to differ by
    more than a constant (``converge``); the costs then drive the choice of edits forward, chunk by chunk (``entries``).
    No task holds a conversation.

    Null roles and texts are one space (such a text is blank); rows with a null conversation are one; null turns come
    first and do not count for gaps. Rows of one turn go by role and text; repeated rows are duplicates. Other columns
    are not read. An empty table gives empty ones.
    """
    placed = place(rows, conv_col, turn_col, role_col, text_col)
    marked = faults(placed)
    made = edits(marked, chunk_rows, passes).withColumnsRenamed({"role": "written", "pos": "at", "conv": "of"})
    own = placed.select("pos", F.col("role").alias("own"), "text")
    steps = made.join(own, F.col("at") == F.col("pos"), "left")
    steps = steps.select(F.col("of").alias("conv"), F.col("at").alias("pos"), "nth", "edit", "cost", F.coalesce("written", "own").alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return steps.withColumn("text", F.when(F.col("edit") == "I", "").otherwise(F.col("text"))), counts(marked)


def digests(steps: DataFrame) -> DataFrame:
    """(conv, cost, audit, repaired_sha256): the edits' initials in order, and the digest of the ``role:text`` lines that
    are written. A digest is one stream, so a conversation passes through one task, in order, and is not held there."""
    conv = steps.schema["conv"].dataType.simpleString()
    sent = steps.select("conv", "pos", "nth", "edit", "cost", "role", F.when(F.col("edit") != "D", F.col("text")).alias("text"))
    sent = sent.repartition("conv").sortWithinPartitions("conv", "pos", "nth")
    schema = f"conv {conv}, cost long, audit string, repaired_sha256 string"

    kind = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        now, digest, audit, cost, lines = None, None, [], 0, 0
        for b in batches:
            for conv_id, edit, own, role, text in zip(*(b.column(b.schema.get_field_index(c)).to_pylist() for c in ("conv", "edit", "cost", "role", "text")), strict=True):
                if digest is None or conv_id != now:
                    if digest is not None:
                        done.append((now, cost, "".join(audit), digest.hexdigest()))
                    now, digest, audit, cost, lines = conv_id, hashlib.sha256(), [], 0, 0
                audit.append(edit)
                cost += own
                if edit != "D":
                    digest.update((("\n" if lines else "") + role + ":" + text).encode())
                    lines += 1
            if len(done) >= 1024:
                yield pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], f.type) for k, f in enumerate(kind)], schema=kind)
                done = []
        if digest is not None:
            done.append((now, cost, "".join(audit), digest.hexdigest()))
        yield pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], f.type) for k, f in enumerate(kind)], schema=kind)

    return sent.mapInArrow(run, schema)
