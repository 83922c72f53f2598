"""Sizes in tokens of a public subword tokenizer.

The vocabulary files are read from a folder that every machine has (``vocab_dir``); they are never copied here.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, types as T

VOCAB_DIR = "/opt/tokenizers"
VOCABULARY = "byte_bpe_50k.tiktoken"
#: Fixed value: the splitting pattern that belongs to the byte-level vocabularies.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=4)
def encoding(vocab_dir: str = VOCAB_DIR, vocabulary: str = VOCABULARY):
    """The tokenizer, loaded once per process."""
    import tiktoken

    with open(Path(vocab_dir) / vocabulary, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def with_tokens(docs: DataFrame, text_col: str = "text", out: str = "tokens", vocab_dir: str = VOCAB_DIR, vocabulary: str = VOCABULARY) -> DataFrame:
    """Replace the text by its number of tokens (0 for null and empty); the text itself travels no further."""
    keep = [f for f in docs.schema.fields if f.name not in (text_col, out)]
    schema = T.StructType([*keep, T.StructField(out, T.LongType(), False)])
    at = [f.name for f in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(vocab_dir, vocabulary)
        for b in batches:
            sizes = [len(enc.encode_ordinary(x)) if x else 0 for x in b.column(b.num_columns - 1).to_pylist()]
            cols = [b.column(i) for i in range(len(at))]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(sizes, pa.int64())], [*at, out])

    return docs.select(*at, text_col).mapInArrow(run, schema)
