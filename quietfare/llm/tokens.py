"""Token counts of texts with a public byte-level BPE vocabulary."""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from functools import lru_cache
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quietfare.session import spread

#: Folder of the vocabulary files; pass another as a parameter where it lies elsewhere.
TOKENIZERS = "/opt/tokenizers"
VOCABULARY = "byte_bpe_multi_50k.tiktoken"

# Fixed value: the split pattern that belongs to the vocabulary's merges.
SPLIT_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=2)
def _encoder(path: str):
    import tiktoken

    lines = Path(path).read_bytes().split(b"\n")
    ranks = {base64.b64decode(token): int(rank) for token, rank in (x.split() for x in lines if x)}
    return tiktoken.Encoding(Path(path).stem, pat_str=SPLIT_PATTERN, mergeable_ranks=ranks, special_tokens={})


def counter(path: str) -> Callable[[str | None], int]:
    """A function that counts the tokens of whole texts; null and empty texts have 0."""
    encode = _encoder(path).encode_ordinary
    return lambda text: len(encode(text)) if text else 0


def with_token_counts(df: DataFrame, text: str = "text", name: str = "tokens", folder: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> DataFrame:
    """``df`` with the token count of each whole text; 0 for null. The vocabulary file must be readable on every executor."""
    path = f"{folder}/{vocabulary}"

    @F.pandas_udf("bigint")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokens = counter(path)
        for texts in batches:
            yield pd.Series([tokens(t) for t in texts], dtype="int64")

    return spread(df).withColumn(name, count(F.col(text)))
