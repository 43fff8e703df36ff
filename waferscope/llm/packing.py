"""Packing by power-of-two decomposition: no padding, and no sequence crosses documents.

A document's token ids are cut into pieces whose lengths are the binary digits of its length (whole pieces of the
longest length first), so that each piece fills a sequence of its own exactly. Sequences of one length are numbered one after
another, so that a bucket of equal lengths can be read as a range and batched without padding.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from waferscope.llm import wordwise
from waferscope.llm.storage import stored

BYTES_AT_ONCE = 1 << 21


def binary_pieces(length: int, longest: int) -> list[int]:
    """Lengths of the pieces: as many of the longest as fit, then a falling power of two for each binary digit left.

    longest is a power of two. A length of 0 has no pieces.
    """
    pieces = [longest] * (length // longest)
    rest, power = length % longest, longest
    while rest:
        power //= 2
        if rest >= power:
            pieces.append(power)
            rest -= power
    return pieces


def _ids_bytes(ids: np.ndarray) -> bytes:
    return ids.astype("<u4", copy=False).tobytes()


def pieces(
    docs: DataFrame,
    tokenizer: str = "word_bpe_49k.json",
    end_id: int = 2,
    longest: int = 4096,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, start, length, ids, doc_tokens): every document's ids and end_id, cut into binary pieces.

    ids is binary: little-endian unsigned 32-bit ids. tokenizer is a file of the tokenizers library that lower-cases and
    drops white space: word_bpe_49k.json of the public tokenizers or a path that every executor can open. A null or
    empty text is end_id alone. Repeated rows and ids, and null ids, are documents of their own. No rows: no rows.
    """
    if longest & (longest - 1):
        raise ValueError("longest must be a power of two")
    end = _ids_bytes(np.array([end_id]))

    def cut(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        remembered = wordwise.remembered(tokenizer, wordwise.PLAIN, _ids_bytes)
        for batch in found:
            start = 0
            for texts in wordwise.runs(batch.column(1).to_pylist(), BYTES_AT_ONCE):
                cut_texts = [wordwise.plain_pieces(text) for text in texts]
                known = remembered.learn(set().union(*cut_texts))
                rows: tuple[list, ...] = ([], [], [], [], [])
                for doc_id, words in zip(batch.column(0).slice(start, len(texts)).to_pylist(), cut_texts, strict=True):
                    ids = b"".join(map(known.__getitem__, words)) + end
                    at, total = 0, len(ids) // 4
                    for length in binary_pieces(total, longest):
                        made = (doc_id, at, length, ids[4 * at : 4 * (at + length)], total)
                        for column, value in zip(rows, made, strict=True):
                            column.append(value)
                        at += length
                start += len(texts)
                yield _batch(rows)

    def _batch(rows: tuple[list, ...]) -> pa.RecordBatch:
        kinds = (id_type, pa.int64(), pa.int64(), pa.binary(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(rows, kinds, strict=True)], names=names)

    names = ["doc_id", "start", "length", "ids", "doc_tokens"]
    id_type = pa.int64()
    narrow = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    )
    return narrow.mapInArrow(cut, "doc_id long, start long, length long, ids binary, doc_tokens long")


def numbered(found: DataFrame) -> DataFrame:
    """Pieces with sequence_id and offset: each piece is a sequence, ordered by falling length, document and start.

    The order covers every column but the ids, for which their checksum stands, so the numbers are those of the rows even if a task is run again.
    sequence_id grows along the order but has gaps between ranges. Pieces are stored first, as finding the ranges would
    otherwise make them twice.
    """
    found = stored(found)
    order = [F.col("length").desc()] + [F.col(c) for c in found.columns if c not in ("length", "ids")]
    parts = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        found.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .withColumns({"sequence_id": F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")})
    )


def pack(docs: DataFrame, **options) -> DataFrame:
    """Every piece with its ids and their crc32, numbered as a sequence of its own: see pieces() and numbered()."""
    return numbered(pieces(docs, **options).withColumn("ids_crc32", F.crc32("ids")))
