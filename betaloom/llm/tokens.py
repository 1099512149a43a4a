"""Sizes of texts in tokens of a public tokenizer, whose vocabulary file is a parameter."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Rank file of a byte-level BPE vocabulary (one token and its rank a line).
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: How that family of vocabularies splits text before merging (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def token_count(text: str, vocabulary: str = VOCABULARY) -> Column:
    """Tokens of the column, 0 for a null or empty text; whole texts, however long."""

    @F.pandas_udf("long")
    def count(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import tiktoken
        from tiktoken import registry

        # a worker process serves many tasks: what it has loaded stays in the library's own table of encodings
        enc = registry.ENCODINGS.get(f"sizes:{vocabulary}")
        if enc is None:
            with open(vocabulary, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            enc = registry.ENCODINGS[f"sizes:{vocabulary}"] = tiktoken.Encoding("sizes", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        for s in parts:
            yield s.map(lambda t: len(enc.encode_ordinary(t)) if t else 0).astype("int64")

    return count(F.col(text))
