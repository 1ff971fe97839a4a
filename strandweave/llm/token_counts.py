"""Token counts: batches balanced by bytes, encoded in Arrow functions that return lengths only."""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: UTF-8 bytes that are encoded together, and characters beyond which a text is cut into parts.
BATCH_BYTES, PART_CHARS = 1 << 18, 1 << 16
#: Where every match of the byte-level split pattern ends, whatever Unicode version a library has: ASCII white space
#: after a visible character, or an ASCII letter beside a digit.
SAFE = regex.compile(r"(?<=[\p{L}\p{N}\p{P}\p{S}])(?=[ \t\r\n])|(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])")


def may_cut(spec: dict) -> bool:
    """Whether texts may be cut at SAFE under this tokenizer: the byte-level pattern splits them, nothing rewrites them
    before, and no added token holds such a place or reaches over white space beside it."""
    split = spec.get("pre_tokenizer") or {}
    byte_level = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space", True)
    plain = all(not (t["lstrip"] or t["rstrip"] or t["single_word"] or SAFE.search(t["content"])) for t in spec.get("added_tokens") or [])
    return bool(byte_level and plain and not spec.get("normalizer"))


@lru_cache(maxsize=4)
def counter(file: str) -> tuple[Callable[[list[str]], list[int]], bool]:
    """(counts of a list of texts, whether long texts may be cut) for a tokenizer file: .json is read by tokenizers,
    .model by sentencepiece. One load per worker."""
    if file.endswith(".model"):
        import sentencepiece

        pieces = sentencepiece.SentencePieceProcessor(model_file=file)
        return (lambda texts: [len(ids) for ids in pieces.encode(texts, num_threads=1)]), False
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(file)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    with open(file, encoding="utf-8") as f:
        cut = may_cut(json.load(f))
    return (lambda texts: [len(e) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]), cut


def parts(text: str, size: int) -> Iterator[str]:
    """``text`` cut at the first safe place after every ``size`` characters; whole where there is none."""
    start = 0
    while len(text) - start > size:
        at = SAFE.search(text, start + size)
        if at is None:
            break
        yield text[start : at.start()]
        start = at.start()
    yield text[start:]


def count_texts(texts: Iterator[str | None], file: str, batch_bytes: int = BATCH_BYTES, part_chars: int = PART_CHARS) -> list[int]:
    """Tokens of each text. Parts are encoded in batches that close at ``batch_bytes``, however texts fall on them."""
    count, cut = counter(file)
    totals: list[int] = []
    owners: list[int] = []
    batch: list[str] = []
    held = 0

    def flush() -> None:
        nonlocal held
        for owner, n in zip(owners, count(batch) if batch else [], strict=True):
            totals[owner] += n
        owners.clear()
        batch.clear()
        held = 0

    for text in texts:
        totals.append(0)
        for part in parts(text, part_chars) if cut and text else [text or ""]:
            owners.append(len(totals) - 1)
            batch.append(part)
            held += len(part.encode())
            if held >= batch_bytes:
                flush()
    flush()
    return totals


def count_tokens(df: DataFrame, file: str, text_col: str = "text", out_col: str = "n_tokens", batch_bytes: int = BATCH_BYTES, part_chars: int = PART_CHARS) -> DataFrame:
    """``df`` without ``text_col`` but with ``out_col`` (long): the tokens of the whole text by the tokenizer of ``file``.

    No begin, end or other special tokens are added; such strings inside texts are what the library makes of them by
    default; nothing is truncated or padded. Null counts as empty, which has 0 tokens. Long texts are cut where the
    byte-level pattern ends a match anyway, and stay whole under tokenizers for which that is not known (sentencepiece,
    normalizers). Only ids leave Python, so the texts go one way. Repeated rows are counted each; an ``out_col`` that is
    there already is replaced; an empty table stays empty. ``file`` must be there on every worker.
    """
    kept = [c for c in df.columns if c not in (out_col, text_col)]
    schema = T.StructType([*(df.schema[c] for c in kept), T.StructField(out_col, T.LongType())])
    at = len(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(at)
            made = pa.array(count_texts((texts[i].as_py() for i in range(len(texts))), file, batch_bytes, part_chars), pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns[:at], made], names=[*kept, out_col])

    return df.select(*(df[c] for c in kept), F.col(text_col).cast("string").alias("_sw_in")).mapInArrow(run, schema)
