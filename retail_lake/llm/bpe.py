"""Byte-level BPE encoding and decoding with a local rank file.

The rank file's folder must be readable at the same path on every executor; it is
read once per worker. Texts are cut at safe boundaries (see ``segments``) and the
parts encoded by the tiktoken library, so a text of any length needs no more
memory than its own bytes and ids. NULL and empty texts give no ids; invalid
UTF-8 is encoded with replacement characters. Decoding joins the bytes of the ids.
"""

import base64
import hashlib
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from retail_lake.llm.common import renamed, table
from retail_lake.llm.segments import SegmentEncoder, gathered, slices

RANKS = "byte_bpe_50k.tiktoken"
#: Characters of a run of white space from which it is kept from the pattern, whose
#: engine backs up over white space and runs out of stack on a long run.
LONG_RUN = 4096
# The characters that the pattern takes for white space.
_WHITE = "[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
DIGESTS = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def encoding(library: tiktoken.Encoding) -> Callable[[str], list[int]]:
    """Ids of a text, by the library but for long runs of white space. Such a run is one
    match up to its last character, which goes with what follows, or up to the text's
    end; no match reaches into it from before. The match is merged as one piece."""
    long = re.compile(f"{_WHITE}{{{LONG_RUN},}}")

    def encode(text: str) -> list[int]:
        ids, done = [], 0
        for run in long.finditer(text):
            stop = run.end() - (run.end() < len(text))
            ids += library.encode_ordinary(text[done : run.start()])
            ids += library._encode_single_piece(text[run.start() : stop])
            done = stop
        return ids + library.encode_ordinary(text[done:])

    return encode


@lru_cache(maxsize=2)
def vocabulary(path: str, pattern: str) -> tuple[SegmentEncoder, np.ndarray, np.ndarray]:
    """The encoder, and where each id's bytes start in one buffer of all of them."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    library = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    tokens = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    widths = np.array([len(t) for t in tokens], np.int64)
    encoder = SegmentEncoder(encoding(library), widths)
    return encoder, np.cumsum(widths) - widths, np.frombuffer(b"".join(tokens), np.uint8)


def encoded(batches: Iterator[pa.RecordBatch], text: str, ids: str, path: str, pattern: str) -> Iterator[pa.RecordBatch]:
    """Batches with the column ``ids`` (list of int32) in place of, or added to, theirs."""
    encoder = vocabulary(path, pattern)[0]
    for batch in batches:
        for first, last, offsets, values in encoder.column(batch.column(text)):
            lists = pa.ListArray.from_arrays(
                pa.array(offsets.astype(np.int32)), pa.array(values.view(np.int32))
            )
            yield _with_column(batch.slice(first, last - first), ids, lists)


def decoded(batches: Iterator[pa.RecordBatch], ids: str, out: str, path: str, pattern: str) -> Iterator[pa.RecordBatch]:
    """Batches with the column ``out``: the raw bytes of ``ids``."""
    encoder, starts, tokens = vocabulary(path, pattern)
    for batch in batches:
        column = batch.column(ids)
        values = column.flatten().to_numpy(zero_copy_only=False)
        counts = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        widths = encoder.widths[values]
        data = gathered(starts[values], widths, tokens)
        ends = np.concatenate([[0], np.cumsum(widths)])[np.concatenate([[0], np.cumsum(counts)])]
        binary = pa.Array.from_buffers(
            pa.binary(), len(batch), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data)]
        )
        yield _with_column(batch, out, binary)


def _with_column(batch: pa.RecordBatch, name: str, column: pa.Array) -> pa.RecordBatch:
    columns = dict(zip(batch.schema.names, batch.columns, strict=True)) | {name: column}
    return pa.RecordBatch.from_pydict(columns)


def _plus(df: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    fields = {f.name: f for f in df.schema.fields} | {name: T.StructField(name, kind)}
    return T.StructType(list(fields.values()))


def encode(df: DataFrame, ranks: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with the ids of each text; a column already named ``ids`` is replaced."""
    return df.mapInArrow(
        lambda batches: encoded(batches, text, ids, ranks, pattern), _plus(df, ids, T.ArrayType(T.IntegerType()))
    )


def decode(df: DataFrame, ranks: str, pattern: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with the raw bytes that ids stand for; NULL ids give no bytes."""
    return df.mapInArrow(
        lambda batches: decoded(batches, ids, out, ranks, pattern), _plus(df, out, T.BinaryType())
    )


def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("ids")
        flat = ids.flatten().to_numpy(zero_copy_only=False).astype("<u4")
        counts = ids.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        ends = 4 * np.concatenate([[0], np.cumsum(counts)])
        each = slices(ends, flat.view(np.uint8))
        yield pa.RecordBatch.from_pydict(
            {
                "doc_id": batch.column("doc_id"),
                "n_tokens": pa.array(counts),
                "ids_sha256": [hashlib.sha256(x).hexdigest() for x in each],
                "decoded_sha256": [hashlib.sha256(x.as_buffer()).hexdigest() for x in batch.column("decoded")],
            }
        )


def op10_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded, in one pass over the batches."""
    path, pattern = public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    docs = renamed(table(spark, sf_dir, "documents"), doc_id="doc_id", text="text")

    def round_trip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = encoded(batches, "text", "ids", path, pattern)
        return digests(decoded(ids, "ids", "decoded", path, pattern))

    return docs.mapInArrow(round_trip, DIGESTS)
