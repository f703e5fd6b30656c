"""Sizes of texts in tokens of a public tokenizer."""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship
from .batches import slices

#: Where the public vocabulary files are; the same on driver and executors.
VOCABULARY = os.environ.get("TOKENIZER_FILE", "/opt/tokenizers/byte_bpe_multi_50k.tiktoken")
#: Fixed value: how text is split before the merges.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=2)
def encoder(path: str):
    """The byte-level tokenizer of a vocabulary file; once in each worker."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def _count(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode_ordinary
        for batch in slices(batches, "text"):
            sizes = np.fromiter((len(encode(t)) if t else 0 for t in batch.column(batch.num_columns - 1).to_pylist()), np.int64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sizes)], [*batch.schema.names[:-1], "tokens"])

    return run


def token_sizes(df: DataFrame, columns: list[str], text_col: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """The named columns and ``tokens``, the size of the text; null and empty texts have 0."""
    ship(df.sparkSession)
    rows = df.select(*columns, F.col(text_col).alias("text"))
    schema = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes[:-1])
    return rows.mapInArrow(_count(vocabulary), f"{schema}, tokens bigint")
