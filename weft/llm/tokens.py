"""Sizes of texts in tokens of a public tokenizer; its file is a parameter and must lie at the same path on every executor."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
_loaded: dict = {}


def encoding(path: str = DEFAULT, pattern: str | None = None):
    """The tokenizer of a rank file, loaded once in each worker."""
    if (path, pattern) not in _loaded:
        import tiktoken

        if pattern is None:
            import public_tokenizers

            pattern = public_tokenizers.PATTERN
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        _loaded[path, pattern] = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _loaded[path, pattern]


def token_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", *, keep: list[str] = (), path: str = DEFAULT) -> DataFrame:
    """(doc_id, n_tokens, *keep): null and empty texts have none; whole texts are counted."""
    keep = list(keep)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), *keep)

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoding(path)
        for pdf in it:
            n = [len(enc.encode_ordinary(t)) if t else 0 for t in pdf["text"]]
            yield pdf[["doc_id"]].assign(n_tokens=pd.Series(n, dtype="int64", index=pdf.index), **{k: pdf[k] for k in keep})

    kinds = dict(rows.dtypes)
    return rows.mapInPandas(run, f"doc_id {kinds['doc_id']}, n_tokens bigint" + "".join(f", {k} {kinds[k]}" for k in keep))
