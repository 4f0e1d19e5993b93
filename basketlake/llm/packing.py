"""Operator 5: packing by power-of-two decomposition."""

from __future__ import annotations

import base64
import os
from array import array
from functools import lru_cache

import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from basketlake.llm.common import release_memory, table

LENGTH, LONG_TEXT, OUT_ROWS = 1024, 50_000, 4_096
VOCABULARY = "byte_bpe_50k"


@lru_cache(maxsize=2)
def _whole_text_encoder(folder: str, name: str) -> Tokenizer:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    slow = Tokenizer.from_file(os.path.join(folder, f"{name}.json"))
    slow.encode_special_tokens = True
    release_memory()
    return slow


@lru_cache(maxsize=2)
def _fast_encoder(folder: str, name: str) -> tiktoken.Encoding:
    """The same vocabulary in `tiktoken`, four times as fast. A worker loads either encoder for its first text only."""
    with open(os.path.join(folder, f"{name}.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    del ranks
    release_memory()
    return fast


def token_ids(text: str, folder: str, name: str = VOCABULARY) -> array:
    """The ids that `tokenizers` gives without special tokens; strings of special tokens are ordinary text.

    Long texts go to `tokenizers` itself, as the other library's pattern matcher can run out of stack on very long
    white space.
    """
    if len(text) > LONG_TEXT:
        return array("I", _whole_text_encoder(folder, name).encode(text, add_special_tokens=False).ids)
    return array("I", _fast_encoder(folder, name).encode_ordinary(text))


def piece_lengths(n: int, most: int = LENGTH) -> list[int]:
    """Pieces of the greatest length, then the binary digits of the rest from the largest."""
    rest = n % most
    return [most] * (n // most) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pieces(docs: DataFrame, folder: str | None = None, most: int = LENGTH) -> DataFrame:
    """(doc_id, start, length, ids, doc_tokens, sequence_id, offset): every document cut into power-of-two pieces.

    A document is its token ids, then id 0. Each piece is a sequence of its own, so no sequence crosses documents and,
    as every length is a power of two, none is padded. ids are 32-bit little-endian. Sequences of equal length form a
    bucket: the logarithm of the length is the highest digit of sequence_id, so a bucket is a range of ids and batches
    of one length are read by range or by length. Ids are numbered within input partitions, without a shuffle. Null
    and empty texts are the id 0 alone; repeated rows are packed as often; an empty table gives no rows.
    """
    folder = folder or os.path.dirname(public_tokenizers.path(f"{VOCABULARY}.json"))
    schema = "doc_id long, start long, length long, ids binary, doc_tokens long"

    def cut(batches):
        release_memory()
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                ids = token_ids(text.as_py() or "", folder)
                ids.append(0)
                data, start = memoryview(ids).cast("B"), 0
                for n in piece_lengths(len(ids), most):
                    for column, value in zip(out, (doc_id.as_py(), start, n, bytes(data[4 * start : 4 * (start + n)]), len(ids)), strict=True):
                        column.append(value)
                    start += n
                if len(out[0]) >= OUT_ROWS:
                    yield _batch(out)
                    out = [[], [], [], [], []]
            yield _batch(out)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, schema)
    digit = F.shiftleft(F.log2("length").cast("long"), 59)
    return rows.withColumn("sequence_id", digit.bitwiseOR(F.monotonically_increasing_id())).withColumn("offset", F.lit(0).cast("long"))


def _batch(columns: list[list]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64())
    names = ("doc_id", "start", "length", "ids", "doc_tokens")
    return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, kinds, strict=True)], names=list(names))


def write_buckets(docs: DataFrame, path: str) -> None:
    """Writes the sequences below path/length=1 to path/length=1024, for batches of one length."""
    pieces(docs).write.partitionBy("length").parquet(path)


def packed(docs: DataFrame) -> DataFrame:
    """The pieces with a CRC-32 of their ids in place of the ids."""
    return pieces(docs).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op5(spark, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))
