"""Chat formatting: conversations that share first turns become prefix trees, written depth-first with shared turns once."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import small_batches

#: Control strings of the template; they never occur in escaped text.
BEGIN, TEXT, CLOSE, END = "<s>", "[INST]", "[/INST]", "</s>"
#: A packed sequence is closed when it holds so many characters or conversations.
PACK_CHARS, PACK_CONVS = 1 << 18, 4096
#: Characters of formatted conversations that are read back together.
SLICE_CHARS = 1 << 22
#: The role whose texts are under the loss mask.
LOSS_ROLE = "assistant"
_CONTROL = re.compile(r"\\|<(?=/?s>)|\[(?=/?INST\])")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(re.escape(BEGIN) + "(.*?)" + re.escape(TEXT) + "(.*?)" + re.escape(CLOSE + END), re.DOTALL)

SPAN = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
SEGMENT = T.StructType(
    [
        *SPAN.fields,
        T.StructField("position", T.IntegerType()),
        T.StructField("parent", T.IntegerType()),
        T.StructField("ancestors", T.ArrayType(SPAN)),
        T.StructField("loss", T.ArrayType(SPAN)),
    ]
)
_SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32())])
_SEGMENT = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("position", pa.int32()), ("parent", pa.int32()), ("ancestors", pa.list_(_SPAN)), ("loss", pa.list_(_SPAN))])
_TURNS = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))


def escape(text: str) -> str:
    """Backslashes doubled, and a backslash put behind the first character of each control string."""
    return _CONTROL.sub(lambda m: "\\\\" if m[0] == "\\" else m[0] + "\\", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


@dataclass
class Pack:
    """A packed sequence under construction; ``path`` is the open branch: (turn, segment number) from the root."""

    text: list[str] = field(default_factory=list)
    segments: list[tuple] = field(default_factory=list)
    convs: list[tuple] = field(default_factory=list)
    path: list[tuple] = field(default_factory=list)
    size: int = 0

    def add(self, conv_id, turns: list[tuple[str, str]]) -> None:
        shared = 0
        while shared < min(len(self.path), len(turns)) and self.path[shared][0] == turns[shared]:
            shared += 1
        del self.path[shared:]
        for role, text in turns[shared:]:
            head, body = BEGIN + escape(role) + TEXT, escape(text)
            whole = head + body + CLOSE + END
            start, parent = self.size, self.path[-1][1] if self.path else -1
            above = self.attended(parent) if parent >= 0 else []
            position = sum(e - s for s, e in above)
            loss = [(start + len(head), start + len(head) + len(body))] if role == LOSS_ROLE else []
            self.segments.append((start, start + len(whole), position, parent, above, loss))
            self.text.append(whole)
            self.size += len(whole)
            self.path.append(((role, text), len(self.segments) - 1))
        self.convs.append((conv_id, self.path[-1][1]))

    def attended(self, segment: int) -> list[tuple[int, int]]:
        """The intervals of a segment and its ancestors; neighbours are merged."""
        start, end, _, _, above, _ = self.segments[segment]
        return [*above[:-1], (above[-1][0], end)] if above and above[-1][1] == start else [*above, (start, end)]


def turn_lists(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((role_col, "role"), (text_col, "text"))]
    one = rows.select(F.col(conv_col).alias("conv_id"), F.struct(F.col(turn_col).alias("turn"), *text).alias("turn"))
    listed = one.groupBy("conv_id").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    return listed.select("conv_id", F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))


def pack(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", pack_chars: int = PACK_CHARS, pack_convs: int = PACK_CONVS) -> DataFrame:
    """Packed sequences: pack_id, text, segments, convs (conv_id, leaf).

    A turn is written ``<s>role[INST]text[/INST]</s>`` with control strings in roles and texts escaped. Conversations
    (rows by turn, ties by role and text; null role or text: empty; null turns first; a null conv_id is one
    conversation) are sorted by the hashes of their prefixes and dealt out in ranges of that order, so a first turn
    that a third of them share spreads over many tasks. A task streams its range into packs: each turn that the
    open branch already has is shared, every other one becomes a segment, once, depth-first. A segment has its
    interval in the pack's text (code points), the position id of its first character (positions go on inside it),
    its parent, the intervals of its ancestors, which with its own are all it may attend to, and the interval under
    the loss mask. A pack is closed at ``pack_chars`` or ``pack_convs``; a tree that goes on in the next pack, or
    in the next range, repeats its open branch there, for attention can't leave a sequence. What a task holds is
    one pack, so one conversation at least. Hashes only order: turns are compared as they are. An empty table
    gives no packs; other columns are not read.
    """
    lists = turn_lists(small_batches(rows), conv_col, turn_col, role_col, text_col)
    kind = lists.schema["conv_id"].dataType
    keyed = T.StructType([*lists.schema.fields, T.StructField("key", T.BinaryType())])

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = []
            for turns in b.column(1):
                chain, h = [], xxhash.xxh64()
                for t in turns.as_py():
                    h.update(f"{len(t['role'])}:{t['role']}{len(t['text'])}:{t['text']}".encode("utf-8", "surrogatepass"))
                    chain.append(h.digest())
                made.append(b"".join(chain))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(made, pa.binary())], names=["conv_id", "turns", "key"])

    conv = T.StructType([T.StructField("conv_id", kind), T.StructField("leaf", T.IntegerType())])
    out = T.StructType([T.StructField("pack_id", T.StringType()), T.StructField("text", T.StringType()), T.StructField("segments", T.ArrayType(SEGMENT)), T.StructField("convs", T.ArrayType(conv))])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, id_type = Pack(), None

        def flush(p: Pack) -> pa.RecordBatch:
            text = "".join(p.text)
            name = xxhash.xxh128_hexdigest(f"{p.convs[0][0]}:{len(p.convs)}:{text}".encode("utf-8", "surrogatepass"))
            convs = pa.array([[{"conv_id": c, "leaf": leaf} for c, leaf in p.convs]], pa.list_(pa.struct([("conv_id", id_type), ("leaf", pa.int32())])))
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([text]), pa.array([p.segments], pa.list_(_SEGMENT)), convs], names=out.names)

        for b in batches:
            id_type = b.column(0).type
            for conv_id, turns in zip(b.column(0), b.column(1), strict=True):
                if now.size >= pack_chars or len(now.convs) >= pack_convs:
                    yield flush(now)
                    now = Pack()
                now.add(conv_id.as_py(), [(t["role"], t["text"]) for t in turns.as_py()])
        if now.convs:
            yield flush(now)

    ranged = lists.mapInArrow(keys, keyed).repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    return ranged.select("conv_id", "turns").mapInArrow(build, out)


def unpack(packs: DataFrame) -> DataFrame:
    """Read conversations back: conv_id, turns (role, text), loss_text, formatted_chars.

    A conversation is what its leaf attends to; its turns are parsed from that text and unescaped. loss_text is all
    text under the loss mask, in order, unescaped; formatted_chars counts the characters of the formatted text. The
    conversations of a pack come out in slices of SLICE_CHARS: a worker holds a pack, one slice of what it stands for
    (shared turns are there once for each conversation), and one conversation more. No packs give no rows.
    """
    kind = packs.schema["convs"].dataType.elementType["conv_id"].dataType
    turn = T.StructType([T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])
    out = T.StructType([T.StructField("conv_id", kind), T.StructField("turns", T.ArrayType(turn)), T.StructField("loss_text", T.StringType()), T.StructField("formatted_chars", T.LongType())])

    def leaf_parts(text: str, segments: list[dict], leaf: int) -> tuple:
        own = segments[leaf]
        formatted = "".join(text[a["start"] : a["end"]] for a in (*own["ancestors"], own))
        turns = [{"role": unescape(r), "text": unescape(t)} for r, t in _TURN.findall(formatted)]
        loss, at = [], leaf
        while at >= 0:
            loss += reversed([text[x["start"] : x["end"]] for x in segments[at]["loss"]])
            at = segments[at]["parent"]
        return turns, "".join(unescape(x) for x in reversed(loss)), len(formatted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            id_type = b.schema.field("convs").type.value_type.field("conv_id").type
            for at in range(b.num_rows):
                row = b.slice(at, 1).to_pylist()[0]
                ids, parts, held = [], [], 0
                for k, c in enumerate(row["convs"]):
                    # equal conversations follow each other and share what was read from their leaf
                    if not k or c["leaf"] != row["convs"][k - 1]["leaf"]:
                        part = leaf_parts(row["text"], row["segments"], c["leaf"])
                    ids.append(c["conv_id"])
                    parts.append(part)
                    held += part[2]
                    if held >= SLICE_CHARS or k == len(row["convs"]) - 1:
                        yield pa.RecordBatch.from_arrays([pa.array(ids, id_type), pa.array([p[0] for p in parts], _TURNS), pa.array([p[1] for p in parts], pa.string()), pa.array([p[2] for p in parts], pa.int64())], names=out.names)
                        ids, parts, held = [], [], 0

    return packs.select("text", "segments", "convs").mapInArrow(run, out)
