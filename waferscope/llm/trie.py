"""The prefix trie of conversations, in shards of flat arrays.

Each distinct sequence of turns is one path: the digests of its turns. Paths are dealt to shards in the order of their digests, so
that the members of a node stand side by side, whatever share of all conversations begins alike. A shard enumerates the distinct prefix
digests of its paths and gives each a slot of a minimal perfect hash; the digest kept in a slot is compared with every
digest that is sent there. Counts are scattered into flat arrays by slot and added up through an array of parents' slots, deepest
nodes first.

Only prefixes of a shard's first and last path can go on in another shard. They are left open: the two paths, with what the shard
found under their nodes, are the paths of the next round, of which a last, small one closes the root. A conversation is one value; its turns'
digests meet in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from waferscope.llm.skew import with_facts
from waferscope.llm.storage import stored

# Turns in a shard, which has LEAST_PATHS or more however long they are; paths that one last task closes. A round leaves two
# paths of a shard open, so that a round's paths are an eighth of the last round's, or a little more.
TURNS_AT_ONCE = 200_000
LEAST_PATHS = 16
LAST_PATHS = 4_000
# Ids whose digits one task writes at a time.
IDS_AT_ONCE = 8_192
_NOBODY = np.iinfo(np.int64).max
_TURN = "array<struct<said:binary,chars:int>>"
# What is known of the nodes of a path, from the root on.
_SUMS = ("ends", "least", "children", "leaves", "saved")


def conversations(
    rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """(conv_id, turns): each conversation's turns by turn (null first) as (digest of role and text, code points of the text).

    Rows of one turn are ordered by that digest; each row is a turn, repeated rows too. Null roles and texts are empty. Rows
    without a conv_id belong to no conversation. No rows: no rows.
    """
    said_by, said = F.coalesce(F.col(role).cast("string"), F.lit("")), F.coalesce(F.col(text).cast("string"), F.lit(""))
    digest = F.unhex(F.sha2(F.concat(F.octet_length(said_by).cast("string"), F.lit(":"), said_by, said).cast("binary"), 256))
    message = F.struct(F.col(turn).alias("turn"), digest.alias("said"), F.length(said).alias("chars"))
    named = rows.select(F.col(conv).alias("conv_id"), message.alias("m")).where("conv_id IS NOT NULL")
    grouped = named.groupBy("conv_id").agg(F.array_sort(F.collect_list("m")).alias("m"))
    return grouped.select("conv_id", F.transform("m", lambda m: F.struct(m["said"], m["chars"])).cast(_TURN).alias("turns"))


class SlotTable:
    """Slots 0..n-1 for n distinct 16-byte digests: levels of bits, each for the digests that met others on the levels before."""

    LOAD = 1.5

    def __init__(self, digests: np.ndarray):
        """digests: distinct rows of two unsigned 64-bit numbers."""
        self.levels: list[tuple[int, np.ndarray]] = []
        left, taken = digests, 0
        while len(left):
            size = max(2, int(self.LOAD * len(left)))
            at = self._place(left, len(self.levels), size)
            alone = np.bincount(at, minlength=size) == 1
            # The slot of a bit is the number of bits before it, on all levels.
            self.levels.append((size, np.where(alone, np.cumsum(alone) - 1 + taken, -1)))
            taken += int(alone.sum())
            left = left[~alone[at]]
        self.kept = np.zeros((taken, 2), np.uint64)
        self.kept[self._slots(digests)] = digests
        if len(digests) != taken or not (self.kept[self._slots(digests)] == digests).all():
            raise AssertionError("two digests have one slot")

    @staticmethod
    def _place(digests: np.ndarray, level: int, size: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            mixed = digests[:, 0] ^ (digests[:, 1] * np.uint64(2 * level + 1) + np.uint64(level))
            mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
        return (mixed % np.uint64(size)).astype(np.int64)

    def _slots(self, digests: np.ndarray) -> np.ndarray:
        slots = np.full(len(digests), -1)
        open_ = np.arange(len(digests))
        for level, (size, slot_of) in enumerate(self.levels):
            slots[open_] = slot_of[self._place(digests[open_], level, size)]
            open_ = open_[slots[open_] < 0]
            if not len(open_):
                break
        return slots

    def slots(self, digests: np.ndarray) -> np.ndarray:
        """The slots of digests that the table was made of; any other digest raises."""
        slots = self._slots(digests)
        if (slots < 0).any() or not (self.kept[slots] == digests).all():
            raise KeyError("a digest has no slot")
        return slots


@dataclass
class Path:
    """A sequence of turns with, for its nodes from the root on, what was found under them so far."""

    said: list[bytes]
    chars: list[int]
    sums: np.ndarray  # one row of _SUMS for each node


def _digests(paths: list[Path]) -> list[list[bytes]]:
    """The digests of all prefixes of each path; the part that a path shares with the one before is not digested again."""
    made: list[list[bytes]] = []
    before: list[bytes] = []
    states = [hashlib.sha256()]
    for path in paths:
        shared = 0
        for a, b in zip(path.said, before, strict=False):
            if a != b:
                break
            shared += 1
        del states[shared + 1 :]
        digests = made[-1][: shared + 1] if made else [states[0].digest()]
        for said in path.said[shared:]:
            state = states[-1].copy()
            state.update(said)
            states.append(state)
            digests.append(state.digest())
        made.append(digests)
        before = path.said
    return made


_NODES = (
    ("digest", pa.binary()), ("parent", pa.binary()), ("depth", pa.int64()), ("conv_id", pa.int64()), ("parent_conv_id", pa.int64()),
    ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()),
)
_OPEN = (("turns", pa.list_(pa.struct([("said", pa.binary()), ("chars", pa.int32())]))), ("sums", pa.list_(pa.list_(pa.int64()))))
_MADE = pa.schema([*_NODES, *_OPEN])
_MADE_DDL = (
    "digest binary, parent binary, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    f"saved_tokens long, turns {_TURN}, sums array<array<bigint>>"
)


def shard(paths: list[Path], last: bool) -> Iterator[pa.RecordBatch]:
    """The nodes of neighbouring paths, and the first and last path left open; with `last` all nodes are closed."""
    by_path = _digests(paths)
    sizes = np.array([len(d) for d in by_path])
    each = [d for digests in by_path for d in digests]
    whole = np.frombuffer(b"".join(each), np.uint64).reshape(-1, 4)
    halves = whole[:, :2]
    distinct, firsts = np.unique(halves, axis=0, return_index=True)
    table = SlotTable(distinct)
    slots = table.slots(halves)
    n = len(distinct)
    first_at = np.empty(n, np.int64)
    first_at[table.slots(distinct)] = firsts
    # Half a digest finds the slot; the whole digest must agree with the slot's.
    if not (whole[first_at[slots]] == whole).all():
        raise AssertionError("two digests agree in their first half")
    starts = np.cumsum(sizes) - sizes
    places = np.arange(len(whole)) - np.repeat(starts, sizes)
    depth = places[first_at]
    parent = np.where(depth > 0, slots[np.maximum(first_at - 1, 0)], -1)
    lengths = np.concatenate([[0, *path.chars] for path in paths]).astype(np.int64)[first_at]

    ends, children, leaves, saved = (np.zeros(n, np.int64) for _ in range(4))
    least = np.full(n, _NOBODY)
    sums = np.concatenate([path.sums for path in paths])
    for array, column in ((ends, 0), (children, 2), (leaves, 3), (saved, 4)):
        np.add.at(array, slots, sums[:, column])
    np.minimum.at(least, slots, sums[:, 1])

    closed = np.ones(n, bool)
    edges = sorted({0, len(paths) - 1}) if not last else []
    for i in edges:
        closed[slots[starts[i] : starts[i] + sizes[i]]] = False

    deepest_first = np.argsort(-depth, kind="stable")
    cuts = np.flatnonzero(np.diff(depth[deepest_first])) + 1
    levels = np.split(deepest_first, cuts)
    # What lies under a node goes to its parent only from closed nodes: an open one is added up when it is closed.
    for level in levels:
        level = level[closed[level]]
        leaves[level] += children[level] == 0
        saved[level] += (ends[level] - 1) * lengths[level]
        up = level[parent[level] >= 0]
        for array in (ends, leaves, saved):
            np.add.at(array, parent[up], array[up])
        np.minimum.at(least, parent[up], least[up])
        np.add.at(children, parent[up], 1)

    digests = np.array(each, object)[first_at]
    done = np.flatnonzero(closed)
    known = (parent[done] >= 0) & closed[np.maximum(parent[done], 0)]
    above = np.where(known, least[np.maximum(parent[done], 0)], 0)
    columns = {
        "digest": pa.array(digests[done], pa.binary()),
        "parent": pa.array(np.where(known | (parent[done] < 0), None, digests[np.maximum(parent[done], 0)]), pa.binary()),
        "depth": pa.array(depth[done]),
        "conv_id": pa.array(least[done]),
        "parent_conv_id": pa.array(above, mask=~known),
        "n_convs": pa.array(ends[done]),
        "n_children": pa.array(children[done]),
        "n_leaves": pa.array(leaves[done]),
        "saved_tokens": pa.array(saved[done]),
    }
    yield _made(columns, len(done))
    told = np.zeros(n, bool)
    open_: dict[str, list] = {"turns": [], "sums": []}
    for i in edges:
        own = slots[starts[i] : starts[i] + sizes[i]]
        found = np.stack([ends[own], least[own], children[own], leaves[own], saved[own]], axis=1)
        # What both paths share is told once.
        found[told[own]] = [0, _NOBODY, 0, 0, 0]
        told[own] = True
        open_["turns"].append([{"said": s, "chars": c} for s, c in zip(paths[i].said, paths[i].chars, strict=True)])
        open_["sums"].append(found.tolist())
    if edges:
        yield _made({name: pa.array(open_[name], kind) for name, kind in _OPEN}, len(edges))


def _made(columns: dict[str, pa.Array], rows: int) -> pa.RecordBatch:
    arrays = [columns[f.name] if f.name in columns else pa.nulls(rows, f.type) for f in _MADE]
    return pa.RecordBatch.from_arrays(arrays, schema=_MADE)


def _paths(found: Iterator[pa.RecordBatch]) -> Iterator[Path]:
    for batch in found:
        for row in batch.to_pylist():
            said = [t["said"] for t in row["turns"]]
            if row["sums"] is None:
                sums = np.zeros((len(said) + 1, len(_SUMS)), np.int64)
                sums[:, 1] = _NOBODY
                sums[-1, :2] = row["copies"], row["least"]
            else:
                sums = np.array(row["sums"], np.int64)
            yield Path(said, [t["chars"] for t in row["turns"]], sums)


def _round(paths: DataFrame, last: bool) -> DataFrame:
    """One round over paths (turns, copies, least, sums), sorted by turns within partitions that do not overlap."""

    def shards(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, turns = [], 0
        for path in _paths(found):
            held.append(path)
            turns += len(path.sums)
            if not last and turns >= TURNS_AT_ONCE and len(held) >= LEAST_PATHS:
                yield from shard(held, False)
                held, turns = [], 0
        if held:
            yield from shard(held, last)

    return paths.select("turns", "copies", "least", "sums").mapInArrow(shards, _MADE_DDL)


def _batched(found: Iterator[tuple], names: list[str], kinds: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
    rows, size = [], 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    for row in found:
        rows.append(row)
        size += len(row[-1])
        if size >= 1 << 20:
            yield batch()
            rows, size = [], 0
    if rows:
        yield batch()


def _runs_of_ids(found: Iterator[pa.RecordBatch]) -> Iterator[tuple[bytes, int, str]]:
    """(digest, first id, ids as text) of runs of sorted ids."""
    of, held = None, []
    for batch in found:
        for digest, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if held and (digest != of or len(held) >= IDS_AT_ONCE):
                yield of, held[0], ",".join(map(str, held))
                held = []
            of = digest
            held.append(conv)
    if held:
        yield of, held[0], ",".join(map(str, held))


def _digested(found: Iterator[pa.RecordBatch]) -> Iterator[tuple[bytes, str]]:
    """(digest, SHA-256 of its texts joined by commas)."""
    of, state = None, None
    for batch in found:
        for digest, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if digest == of:
                state.update(b"," + ids.encode())
                continue
            if of is not None:
                yield of, state.hexdigest()
            of, state = digest, hashlib.sha256(ids.encode())
    if of is not None:
        yield of, state.hexdigest()


def ends(convs: DataFrame) -> DataFrame:
    """(digest, ends_sha256): the ids of the conversations whose turns end at a node, by the node's digest.

    Ids are sorted over all tasks and written as text where they lie, in runs; a node's digest, which has to be taken in order, reads those
    texts one after another and holds one of them.
    """
    said = F.array_join(F.transform("turns", lambda t: F.hex(t["said"])), "")
    whole = F.unhex(F.sha2(F.unhex(said), 256))
    ids = convs.select(whole.alias("digest"), "conv_id").repartitionByRange("digest", "conv_id").sortWithinPartitions("digest", "conv_id")
    names, kinds = ["digest", "first", "ids"], [pa.binary(), pa.int64(), pa.string()]
    texts = ids.mapInArrow(lambda found: _batched(_runs_of_ids(found), names, kinds), "digest binary, first long, ids string")
    met = texts.repartition("digest").sortWithinPartitions("digest", "first").select("digest", "ids")
    made = ["digest", "ends_sha256"], [pa.binary(), pa.string()]
    return met.mapInArrow(lambda found: _batched(_digested(found), *made), "digest binary, ends_sha256 string")


def prefix_trie(convs: DataFrame) -> DataFrame:
    """A row for each distinct sequence of first turns of convs (conv_id, turns), the textless root included.

    conv_id is the smallest of its n_convs members, the conversations that begin so; parent_conv_id its parent's, null for the root. n_children are
    its longer neighbours, n_leaves the childless nodes under it, itself included. saved_tokens adds up (members - 1) x code points of
    the last text over the nodes under it. ends_sha256 digests the ids, ascending, of members that end there.

    turns is as conversations() makes it; an empty or null array is a conversation that ends at the root. conv_id is distinct and not
    null. No conversations: no rows, not even the root.
    """
    convs = convs.select(F.col("conv_id").cast("long").alias("conv_id"), F.coalesce("turns", F.array().cast(_TURN)).alias("turns"))
    grouped = convs.groupBy("turns").agg(F.count(F.lit(1)).alias("copies"), F.min("conv_id").alias("least"))
    paths = stored(grouped.withColumn("sums", F.lit(None).cast("array<array<bigint>>")))
    rounds = []
    dealt = paths.repartitionByRange("turns")
    while True:
        made = stored(_round(dealt.sortWithinPartitions("turns"), last=False))
        rounds.append(made.where("digest IS NOT NULL"))
        nothing = F.lit(None).cast("long")
        paths = made.where("digest IS NULL").select("turns", nothing.alias("copies"), nothing.alias("least"), "sums")
        left = paths.count()
        if left <= LAST_PATHS:
            break
        dealt = paths.repartitionByRange(max(2, left // LAST_PATHS), "turns")
    closing = stored(_round(paths.coalesce(1).sortWithinPartitions("turns"), last=True))
    rounds.append(closing.where("digest IS NOT NULL"))

    def union(some: list[DataFrame]) -> DataFrame:
        whole = some[0]
        for other in some[1:]:
            whole = whole.unionByName(other)
        return whole

    nodes = union(rounds)
    # A node's parent that was open in its round was closed in a later one.
    above = union(rounds[1:]).select(F.col("digest").alias("parent"), F.col("conv_id").alias("above"), "n_children")
    own = ["digest", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    settled = nodes.where("parent IS NULL").select(*own)
    waiting = nodes.where("parent IS NOT NULL").drop("parent_conv_id", "turns", "sums")
    found = with_facts(waiting, above.withColumnRenamed("n_children", "_children"), "parent", F.col("_children"), waiting.count())
    whole = settled.unionByName(found.withColumnRenamed("above", "parent_conv_id").select(*own))
    nobody = F.lit(hashlib.sha256().hexdigest())
    result = whole.join(ends(convs), "digest", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", nobody))
    return result.select(*own[1:], "ends_sha256")
