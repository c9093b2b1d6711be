"""Token counts of texts by a public tokenizer."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.arrow import spread

#: Splits a text before byte pairs are merged (fixed value that belongs to the vocabulary).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Where the vocabulary lies if the caller names no other place; a file of (base64 token, rank) lines.
DEFAULT_VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"


@lru_cache(maxsize=2)
def _encoding(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_counts(texts: DataFrame, keep: list[str], text: str = "text", vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """The columns ``keep`` and ``tokens``, the whole text's number of tokens (0 for null and empty texts).

    vocabulary: a path that every worker can read.
    """
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in texts.select(*keep).schema) + ", tokens bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = _encoding(vocabulary)
        for batch in batches:
            own = batch.column(len(keep)).to_pylist()
            counts = np.fromiter((len(e.encode_ordinary(t)) if t else 0 for t in own), np.int64, len(own))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(counts)], names=[*keep, "tokens"])

    return spread(texts.select(*keep, text)).mapInArrow(run, schema)
