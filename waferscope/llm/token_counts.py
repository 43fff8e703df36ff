"""Token counts of texts, without their tokens.

Texts are read in Arrow batches; what goes back is lengths. A batch is cut into runs of about the same number of
bytes, so that one very long text does not decide a task's memory, and texts are split before spaces that always start a
word of the tokenizer, so the counts of the pieces add up to the count of the text. Each distinct piece is encoded once for
as long as a task remembers it, in batches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from waferscope.llm import wordwise

BYTES_AT_ONCE = 1 << 21


def counter(tokenizer: str) -> wordwise.Remembered:
    return wordwise.remembered(tokenizer, wordwise.SPACED, len)


def count_tokens(texts: list[str], remembered: wordwise.Remembered) -> list[int]:
    """Token counts of texts, from a counter()."""
    counts = []
    for some in wordwise.runs(texts, BYTES_AT_ONCE):
        cut = [wordwise.spaced_pieces(text) for text in some]
        known = remembered.learn(set().union(*cut))
        counts += [sum(map(known.__getitem__, pieces)) for pieces in cut]
    return counts


def with_token_counts(
    docs: DataFrame,
    tokenizer: str = "byte_bpe_50k.json",
    limit: int = 512,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row of docs, whatever other columns it has.

    tokenizer is a file of the tokenizers library, byte-level BPE that reads a space as the start of the next word:
    byte_bpe_50k.json of the public tokenizers or a path that every executor can open. Special strings inside texts are
    handled as the library's default. A null or empty text has 0 bytes and 0 tokens. Repeated rows and ids, and null
    ids, keep a row each. No rows: no rows.
    """

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        remembered = counter(tokenizer)
        for batch in found:
            texts = batch.column(1)
            sizes = np.diff(np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, texts.offset * 4))
            ends = np.cumsum(sizes)
            start = 0
            while start < len(texts):
                done = ends[start - 1] if start else 0
                end = max(start + 1, int(np.searchsorted(ends, done + BYTES_AT_ONCE, "right")))
                counts = count_tokens(texts.slice(start, end - start).to_pylist(), remembered)
                counted = np.array(counts, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, end - start),
                        pa.array(sizes[start:end].astype(np.int64)),
                        pa.array(counted),
                        pa.array(counted > limit),
                    ],
                    names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
                )
                start = end

    narrow = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(batches, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
