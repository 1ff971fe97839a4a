"""Byte-level BPE encoding and decoding with a local rank file."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import small_batches

#: Texts longer than this many characters are encoded in parts, cut where a match of the pattern must end anyway.
PART_CHARS = 1 << 16
#: Rows handled together in a worker, so that a batch of long texts never stands beside all its ids.
ROWS = 256
#: A boundary at which every match of the split pattern ends: white space after something else, or digits beside letters.
_SAFE = regex.compile(r"(?<=\S)(?=\s)|(?<=\p{L})(?=\p{N})|(?<=\p{N})(?=\p{L})")


@lru_cache(maxsize=4)
def encoding(rank_file: str, pattern: str) -> tiktoken.Encoding:
    """The encoding of a rank file (base64 of the bytes and the rank on each line); one load per worker."""
    with open(rank_file, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def parts(text: str, size: int = PART_CHARS) -> Iterator[str]:
    """``text`` cut at the first safe boundary after every ``size`` characters.

    A match that holds other characters than white space ends before white space, and letters and digits are never
    in one match; nothing in the pattern looks behind. So the parts have just the matches of the whole text.
    """
    start = 0
    while len(text) - start > size:
        cut = _SAFE.search(text, start + size)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def encode_text(text: str | None, enc: tiktoken.Encoding, size: int = PART_CHARS) -> list[int]:
    text = text or ""
    if len(text) <= size:
        return enc.encode_ordinary(text)
    return [i for p in parts(text, size) for i in enc.encode_ordinary(p)]


def _mapped(df: DataFrame, source: str, target: str, kind: T.DataType, arrow: pa.DataType, make) -> DataFrame:
    """``df`` with column ``target`` (replaced if there) made from column ``source`` by ``make``(list) in Arrow batches."""
    kept = [c for c in df.columns if c != target]
    schema = T.StructType([*(df.schema[c] for c in kept), T.StructField(target, kind)])
    at = len(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS):
                b = whole.slice(start, ROWS)
                made = pa.array(make(b.column(at)), arrow)
                yield pa.RecordBatch.from_arrays([*b.columns[:at], made], names=[*kept, target])

    return small_batches(df).select(*(df[c] for c in kept), df[source].alias("_sw_in")).mapInArrow(run, schema)


def encode(df: DataFrame, rank_file: str, pattern: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``df`` with ``ids_col`` (array of int): the token ids of the whole text, without special tokens.

    Null counts as empty, which has no ids; strings that look like special tokens are ordinary text. Long texts are
    split at safe boundaries (``parts``), which never changes the ids. An existing ``ids_col`` is replaced. The
    rank file must be at ``rank_file`` on every worker.
    """

    def make(texts: pa.Array) -> list[list[int]]:
        enc = encoding(rank_file, pattern)
        return [encode_text(t.as_py(), enc) for t in texts]

    return _mapped(df.withColumn(text_col, F.col(text_col).cast("string")), text_col, ids_col, T.ArrayType(T.IntegerType()), pa.list_(pa.int32()), make)


def decode(df: DataFrame, rank_file: str, pattern: str, ids_col: str = "ids", bytes_col: str = "decoded") -> DataFrame:
    """``df`` with ``bytes_col`` (binary): the raw bytes of the ids, UTF-8 or not; null ids count as none."""

    def make(rows: pa.Array) -> list[bytes]:
        enc = encoding(rank_file, pattern)
        return [enc.decode_bytes(r.as_py() or []) for r in rows]

    return _mapped(df, ids_col, bytes_col, T.BinaryType(), pa.binary(), make)
