"""Token counts by a public tokenizer, given by the path of its ranks file."""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import spread

#: Where the tokenizer's ranks are read; the files must be at this path on every executor.
RANKS = os.environ.get("LEDGERLOOM_RANKS", "/opt/tokenizers/byte_bpe_50k.tiktoken")
# Fixed value: the public splitting pattern of this vocabulary.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(maxsize=2)
def encoding(path: str):
    """The tokenizer, loaded once a worker."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def with_token_counts(records: DataFrame, text: str = "text", path: str = RANKS, name: str = "n_tokens") -> DataFrame:
    """The columns of `records` but its text, and the text's number of tokens; 0 for null and empty texts."""
    rest = [c for c in records.columns if c not in (text, name)]
    kinds = dict(records.dtypes)

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoding(path)
        for pdf in frames:
            texts = pdf[text]
            pdf = pdf[rest]
            pdf[name] = [len(enc.encode_ordinary(t)) if t else 0 for t in texts]
            yield pdf

    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in rest), f"{name} bigint"])
    return spread(records.select(*rest, F.col(text))).mapInPandas(count, schema)
