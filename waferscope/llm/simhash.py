"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints that differ in at most d bits share a variant that is at most d // 2 bits from one and d - d // 2
from the other. So every distinct fingerprint emits all variants within half the radius, equal variants meet, and each
meeting links its fingerprints. Meetings are exact in both directions: no pair is missed, and none that meets lies
farther apart than d. The members of one meeting are linked to one of them, never to each other, so a group of
thousands of near copies costs links in proportion to its size.

A variant is shuffled by its leading bits only; the variants of the other bits are made where it arrives. That moves
some eighty rows for each fingerprint instead of two thousand, and the rest of the work is sorting numbers.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from waferscope.llm.graph import components, forest
from waferscope.llm.storage import stored

BITS = 64
SEED = 42
# Variants sorted at once in a task: about 100 MB of memory.
VARIANTS_AT_ONCE = 2_000_000
# Leading bits by which variants may be shuffled, and the fingerprints that should share them at most.
LEADING = (12, 16, 20, 24, 28, 32)
CROWD = 4_096
_HASHES_AT_ONCE = 1 << 20


def fingerprint(text: str | None, shingle_words: int = 4) -> int:
    """The 64-bit SimHash of a text, unsigned.

    Words are runs without ASCII white space, A-Z lower-cased; a shorter text is one shingle; no words: zero.
    """
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    if len(words) < shingle_words:
        shingles = iter([b" ".join(words)])
        total = 1
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle_words)), strict=False))
        total = len(words) - shingle_words + 1
    hashes = map(xxhash.xxh64_intdigest, shingles, repeat(SEED))
    counts = np.zeros(BITS, np.int64)
    for start in range(0, total, _HASHES_AT_ONCE):
        some = np.fromiter(hashes, np.uint64, min(_HASHES_AT_ONCE, total - start))
        counts += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > total, bitorder="little").view(np.uint64)[0])


def with_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 4) -> DataFrame:
    """(doc_id, fp): one row per row of docs; fp is the fingerprint as a signed long. Null texts count as empty."""

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            prints = np.array([fingerprint(t.as_py(), shingle_words) for t in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], names=["doc_id", "fp"])

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return narrow.mapInArrow(batches, "doc_id long, fp long")


def _masks(low_bits: int, radius: int) -> list[np.ndarray]:
    """By number of flipped bits, the masks over the lowest bits."""
    return [
        np.array([sum(1 << b for b in some) for some in combinations(range(low_bits), n)], np.uint64)
        for n in range(radius + 1)
    ]


def _meetings(prints: np.ndarray, variants: np.ndarray, owners: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between the owners of equal variants: the nearest owner of each variant with the others."""
    order = np.argsort(variants)
    ordered = variants[order]
    same = ordered[1:] == ordered[:-1]
    if not same.any():
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    meets = np.concatenate([[False], same]) | np.concatenate([same, [False]])
    owner, variant = prints[owners[order[meets]]], ordered[meets]
    apart = np.bitwise_count(owner ^ variant)
    order = np.lexsort((owner, apart, variant))
    owner, variant = owner[order], variant[order]
    first = np.concatenate([[True], variant[1:] != variant[:-1]])
    centre = owner[first][np.cumsum(first) - 1]
    linked = (centre != owner) & (np.bitwise_count(centre ^ owner) <= distance)
    return centre[linked], owner[linked]


def _links_of(keys: np.ndarray, prints: np.ndarray, leading: int, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links among fingerprints that were dealt by leading variant bits; rows of a key come all together."""
    low, radius = BITS - leading, distance - distance // 2
    masks = _masks(low, radius)
    shift, rest = np.uint64(low), np.uint64((1 << low) - 1)
    left = radius - np.bitwise_count(keys ^ (prints >> shift)).astype(int)
    base = (keys << shift) | (prints & rest)
    size = np.cumsum([len(m) for m in masks])[left].sum()
    slices = 1
    while size / slices > VARIANTS_AT_ONCE:
        slices *= 2
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for part in range(slices):
        variants, owners = [], []
        for flips in range(radius + 1):
            able = np.flatnonzero(left >= flips)
            step = max(1, VARIANTS_AT_ONCE // len(masks[flips]))
            for at in range(0, len(able), step):
                some = able[at : at + step]
                made = (base[some, None] ^ masks[flips]).ravel()
                own = np.repeat(some, len(masks[flips]))
                if slices > 1:
                    # Slices by a hash, as variants of a crowd of near copies share most of their bits.
                    kept = (made * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)) % np.uint64(slices) == part
                    made, own = made[kept], own[kept]
                variants.append(made)
                owners.append(own)
        found.append(_meetings(prints, np.concatenate(variants), np.concatenate(owners), distance))
    a, b = (np.concatenate(side) for side in zip(*found, strict=True))
    return forest(a, b) if len(a) else (a, b)


def _leading_bits(prints: DataFrame) -> int:
    """The fewest leading bits under which no crowd of fingerprints is larger than CROWD, from whole counts."""
    keys = F.array(*[F.struct(F.lit(n).alias("bits"), F.shiftrightunsigned("fp", BITS - n).alias("key")) for n in LEADING])
    crowds = prints.select(F.inline(keys)).groupBy("bits", "key").count().groupBy("bits").agg(F.max("count").alias("most"))
    fit = [row.bits for row in crowds.collect() if row.most <= CROWD]
    return min(fit, default=LEADING[-1])


def links(prints: DataFrame, distance: int = 4) -> DataFrame:
    """(a, b): links that connect exactly the distinct fingerprints (fp) that differ in at most `distance` bits."""
    leading = _leading_bits(prints)
    radius = distance - distance // 2
    near = np.concatenate(_masks(leading, min(radius, leading)))

    def dealt(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            fps = batch.column(0).to_numpy().view(np.uint64)
            for at in range(0, len(fps), 2_000):
                some = fps[at : at + 2_000]
                keys = ((some >> np.uint64(BITS - leading))[:, None] ^ near).ravel()
                own = np.repeat(some, len(near))
                yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (keys, own)], names=["key", "fp"])

    def linked(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masks_in = np.cumsum([len(m) for m in _masks(BITS - leading, radius)])
        held_keys, held_fps = np.empty(0, np.uint64), np.empty(0, np.uint64)

        def flush(keys: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
            a, b = _links_of(keys, fps, leading, distance)
            return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (a, b)], names=["a", "b"])

        for batch in found:
            keys, fps = (batch.column(i).to_numpy().view(np.uint64) for i in (0, 1))
            held_keys, held_fps = np.concatenate([held_keys, keys]), np.concatenate([held_fps, fps])
            # Whole keys only: what follows may still belong to the last one.
            last = np.flatnonzero(held_keys != held_keys[-1])
            whole = last[-1] + 1 if len(last) else 0
            left = radius - np.bitwise_count(held_keys ^ (held_fps >> np.uint64(BITS - leading))).astype(int)
            size, start = np.cumsum(masks_in[left]), 0
            ends = np.flatnonzero(held_keys[1:] != held_keys[:-1]) + 1
            for end in ends:
                if size[end - 1] - (size[start - 1] if start else 0) >= VARIANTS_AT_ONCE // 2:
                    yield flush(held_keys[start:end], held_fps[start:end])
                    start = end
            if start < whole and size[whole - 1] - (size[start - 1] if start else 0) >= VARIANTS_AT_ONCE // 2:
                yield flush(held_keys[start:whole], held_fps[start:whole])
                start = whole
            held_keys, held_fps = held_keys[start:], held_fps[start:]
        if len(held_keys):
            yield flush(held_keys, held_fps)

    return (
        prints.select("fp")
        .mapInArrow(dealt, "key long, fp long")
        .repartition(int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions")), "key")
        .sortWithinPartitions("key")
        .mapInArrow(linked, "a long, b long")
        .distinct()
    )


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 4, distance: int = 4
) -> DataFrame:
    """(doc_id, fp, component_id) for every row of docs, whatever other columns it has.

    component_id is the smallest id reachable by links of at most `distance` bits, the row's own included. Rows with equal
    fingerprints are one node, so exact copies cost nothing beyond their fingerprint; texts without words (null, empty)
    have fingerprint zero and are linked like any other. Repeated ids keep a row each. A row without an id is linked like
    others; a component of such rows alone has a null component_id. No rows: no rows.
    """
    marked = stored(with_fingerprints(docs, id_col, text_col, shingle_words))
    distinct = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    of = components(links(distinct, distance)).withColumnsRenamed({"node": "fp"})
    grouped = distinct.join(of, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    smallest = grouped.groupBy("component").agg(F.min("first_id").alias("component_id"))
    by_print = grouped.join(smallest, "component").select("fp", "component_id")
    return marked.join(by_print, "fp").select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 4, distance: int = 4) -> DataFrame:
    """The rows of docs whose id is the smallest of their component, all columns kept.

    An id names one document: it goes if any of its rows has a smaller id in its component, and of rows that repeat a
    kept id the one with the smallest text stays. Rows without an id cannot be told apart and stay. No rows: no rows.
    """
    found = near_duplicates(docs, id_col, text_col, shingle_words, distance)
    by_id = found.where("doc_id is not null").groupBy("doc_id").agg(
        F.count("*").alias("rows"), F.max(F.col("doc_id") > F.col("component_id")).alias("goes")
    )
    # Few ids are dropped or repeated, so only those are matched with the texts.
    marked = stored(by_id.where("goes or rows > 1").select(F.col("doc_id").alias("_id"), "goes"))
    own = F.col(id_col).cast("long")
    single = docs.join(marked, own == marked["_id"], "left_anti")
    repeated = marked.where("not goes")
    again = docs.join(repeated, own == repeated["_id"], "left_semi")
    order = Window.partitionBy(id_col).orderBy(F.col(text_col).asc_nulls_first(), *[c for c in _orderable(docs) if c != text_col])
    place = _unused(docs, "_place")
    return single.unionByName(again.withColumn(place, F.row_number().over(order)).where(F.col(place) == 1).drop(place))


def _orderable(docs: DataFrame) -> list[str]:
    return [f.name for f in docs.schema.fields if f.dataType.typeName() not in ("map", "variant", "array", "struct")]


def _unused(docs: DataFrame, name: str) -> str:
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    return name
