"""Prefix trie of conversations, with totals of subtrees by time-forward processing.

Each conversation is rebuilt: the first h turns of its root conversation (c - c % 100; h = crc32(c) % 6), then its own
turns after its first h. Every distinct sequence of first turns is a node, every rebuilt conversation that
starts with it a member. A node is known by the exclusive or of two 64-bit hashes of (place, role, text) of its turns, so
its parent's name is its own without the last turn, and the names of a conversation's nodes are running totals,
taken in slices of sorted rows: a conversation with a third of all turns spreads over tasks.

Nodes belong to their smallest member, so the nodes of one owner are a path. Shards hold the paths of neighbouring
owners, in bands of depth. Inside a shard nodes come sorted in reverse level order; a node takes the totals that its
children sent ahead from a priority queue, adds its own and sends the sum to its parent. The queue spills
sorted runs to disk and merges them. A node whose parent lies in another shard is a shard root; its total goes
to all nodes above it, which are prefixes of its owner: again a running total along the owner's turns, added up by node
before it moves. So no task gets a group that grows with the number of conversations under a node.

One exception is asked for: ``ends_sha256`` runs over the sorted ids of all conversations that end at a node; a task streams
them with bounded memory. Null roles and texts count as empty; turns are ordered by turn (null first), role and text, and
repeated rows are turns of their own. Rows without conv_id are left out. An empty table has no root and gives an empty
result. Other columns are not looked at. Texts are hashed once and then left behind, however long they are.
"""

from __future__ import annotations

import hashlib
import heapq
import pickle
from collections.abc import Iterator
from tempfile import TemporaryFile

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldledger.llm.common import cut, shuffle_width, written
from fieldledger.operators.running import running

#: Fixed by the contract: conversations of one root, and how many turns at most come from it, plus one.
FAMILY, LEADS = 100, 6
#: Neighbouring owners and depths that make a shard; messages that a queue holds in memory.
OWNERS, BAND = 64, 1 << 16
HELD = 200_000
NO_ENDS = hashlib.sha256(b"").hexdigest()


class SpillingQueue:
    """A priority queue of tuples. Beyond ``held`` of them it goes to a temporary file as a sorted run."""

    def __init__(self, held: int = HELD) -> None:
        self._heap: list[tuple] = []
        self._runs: list[tuple] = []  # (next tuple, number, rest)
        self._held, self._made = held, 0

    def __len__(self) -> int:
        return len(self._heap) + len(self._runs)

    def push(self, item: tuple) -> None:
        heapq.heappush(self._heap, item)
        if len(self._heap) > self._held:
            self._spill(sorted(self._heap))
            self._heap = []
            if len(self._runs) > 64:  # few files stay open
                runs, self._runs = self._runs, []
                self._spill(heapq.merge(*[self._rest(run) for run in runs]))

    @staticmethod
    def _rest(run: tuple) -> Iterator[tuple]:
        yield run[0]
        yield from run[2]

    def _spill(self, items) -> None:
        file, block = TemporaryFile(), []
        for item in items:
            block.append(item)
            if len(block) == 4096:
                pickle.dump(block, file, pickle.HIGHEST_PROTOCOL)
                block = []
        pickle.dump(block, file, pickle.HIGHEST_PROTOCOL)
        file.seek(0)
        self._next(self._read(file), self._made)
        self._made += 1

    @staticmethod
    def _read(file) -> Iterator[tuple]:
        with file:
            while True:
                try:
                    yield from pickle.load(file)  # noqa: S301 - written by this task
                except EOFError:
                    return

    def _next(self, rest: Iterator[tuple], number: int) -> None:
        item = next(rest, None)
        if item is not None:
            heapq.heappush(self._runs, (item, number, rest))

    def least(self) -> tuple | None:
        heads = [h for h in (self._heap[0] if self._heap else None, self._runs[0][0] if self._runs else None) if h is not None]
        return min(heads, default=None)

    def pop(self) -> tuple:
        if self._runs and (not self._heap or self._runs[0][0] <= self._heap[0]):
            item, number, rest = heapq.heappop(self._runs)
            self._next(rest, number)
            return item
        return heapq.heappop(self._heap)


# Rebuilding --------------------------------------------------------------


def _leads(conv: Column) -> Column:
    return F.pmod(F.crc32(conv.cast("string").cast("binary")), F.lit(LEADS))


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 1), a and b (hashes of role and text), chars of every turn."""
    named = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")],
    )
    placed = running(named, ["conv_id"], [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")], place=("count", F.lit(1)))
    return placed.select(
        "conv_id",
        "place",
        F.xxhash64(F.lit(1), "role", "text").alias("a"),
        F.xxhash64("text", F.lit(2), "role").alias("b"),
        F.length("text").cast("long").alias("chars"),
    )


def rebuilt(said: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns of the rebuilt conversations (conv_id, depth, a, b, chars, last) and the ids of those without any."""
    sizes = said.groupBy("conv_id").agg(F.max("place").alias("n"))
    families = sizes.where(F.col("conv_id") % FAMILY == 0).select(F.col("conv_id").alias("root"), F.col("n").alias("root_n"))
    own = sizes.withColumn("root", F.col("conv_id") - F.col("conv_id") % FAMILY).withColumn("h", _leads(F.col("conv_id")))
    led = F.least("h", F.coalesce("root_n", F.lit(0).cast("long")))
    plans = own.join(families, "root", "left").withColumn("led", led)
    plans = cut(plans.select("conv_id", "root", "h", "led", (F.col("led") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("total")))
    # a root gives at most five turns to at most a hundred conversations
    heads = said.where((F.col("conv_id") % FAMILY == 0) & (F.col("place") < LEADS)).withColumnRenamed("conv_id", "root")
    lead = plans.where("led > 0").join(heads, "root").where("place <= led").withColumn("depth", F.col("place"))
    rest = said.join(plans, "conv_id").where("place > h").withColumn("depth", F.col("led") + F.col("place") - F.col("h"))
    columns = ["conv_id", "depth", "a", "b", "chars", (F.col("depth") == F.col("total")).alias("last")]
    both = lead.select(*columns).unionByName(rest.select(*columns))
    return both, plans.where("total = 0").select("conv_id")


def prefixes(both: DataFrame) -> DataFrame:
    """conv_id, depth, ka, kb (the node's name), pa, pb (its parent's), chars, last: one row for each member of each node but the root."""
    salted = both.select("conv_id", "depth", F.xxhash64("depth", "a").alias("a"), F.xxhash64("b", "depth").alias("b"), "chars", "last")
    named = running(salted, ["conv_id"], [F.col("depth")], ka=("bit_xor", F.col("a")), kb=("bit_xor", F.col("b")))
    parent = [F.col(k).bitwiseXOR(F.col(h)).alias(p) for k, h, p in (("ka", "a", "pa"), ("kb", "b", "pb"))]
    return named.select("conv_id", "depth", "ka", "kb", *parent, "chars", "last")


# Nodes -------------------------------------------------------------------


def nodes(members: DataFrame, silent: DataFrame) -> DataFrame:
    """ka, kb, pa, pb, conv_id, depth, n_convs, parent_conv_id, n_children, leaves, saved (its own) of every node."""
    inner = members.groupBy("ka", "kb").agg(
        F.min("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"),
        *[F.min(c).alias(c) for c in ("depth", "pa", "pb", "chars")],
    )
    everyone = members.select("conv_id").unionByName(silent).groupBy("conv_id").agg(F.lit(1).alias("one"))
    zero = F.lit(0).cast("long")
    root = everyone.agg(F.min("conv_id").alias("conv_id"), F.count("one").alias("n_convs")).where("n_convs > 0")
    root = root.select(zero.alias("ka"), zero.alias("kb"), "conv_id", "n_convs", zero.alias("depth"), F.lit(None).cast("long").alias("pa"), F.lit(None).cast("long").alias("pb"), zero.alias("chars"))
    every = written(inner.unionByName(root))
    children = every.groupBy("pa", "pb").agg(F.count(F.lit(1)).alias("n_children")).withColumnsRenamed({"pa": "ka", "pb": "kb"})
    parents = every.select(F.col("ka").alias("pa"), F.col("kb").alias("pb"), F.col("conv_id").alias("parent_conv_id"))
    joined = every.join(children, ["ka", "kb"], "left").join(parents, ["pa", "pb"], "left")
    count = F.coalesce("n_children", zero)
    own = (F.col("n_convs") - 1) * F.col("chars")
    return joined.select(
        "ka", "kb", "pa", "pb", "conv_id", "depth", "n_convs", "parent_conv_id", count.alias("n_children"), (count == 0).cast("long").alias("leaves"), own.alias("saved")
    )


def forward(every: DataFrame, owners: int = OWNERS, band: int = BAND, held: int = HELD) -> DataFrame:
    """ka, kb, conv_id, depth, leaves, saved (with what lies below in its shard), top (a shard root) of every node."""

    def shard(owner: Column, depth: Column) -> Column:
        return F.xxhash64(F.floor(owner / owners), F.floor(depth / band))

    own, above = shard(F.col("conv_id"), F.col("depth")), shard(F.col("parent_conv_id"), F.col("depth") - 1)
    inside = F.coalesce(own == above, F.lit(False))
    columns = ["shard", "depth", "ka", "kb", "pa", "pb", "conv_id", "leaves", "saved", "inside"]
    rows = every.withColumn("shard", own).withColumn("inside", inside).select(*columns)
    levels = rows.repartition(shuffle_width(every.sparkSession), "shard").sortWithinPartitions("shard", F.col("depth").desc(), "ka", "kb")
    layout = "ka long, kb long, conv_id long, depth long, leaves long, saved long, top boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue = SpillingQueue(held)
        for batch in batches:
            leaves, saved = [], []
            for at, depth, ka, kb, pa_, pb, _, own_leaves, own_saved, sends in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                # messages of a shard are all for nodes still to come in it, in the order of the rows
                me = (at, -depth, ka, kb)
                while len(queue) and queue.least()[:4] == me:
                    message = queue.pop()
                    own_leaves += message[4]
                    own_saved += message[5]
                if sends:
                    queue.push((at, 1 - depth, pa_, pb, own_leaves, own_saved))
                leaves.append(own_leaves)
                saved.append(own_saved)
            sums = [pa.array(x, pa.int64()) for x in (leaves, saved)]
            top = pa.array(np.logical_not(batch.column("inside").to_numpy(zero_copy_only=False)))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("ka", "kb", "conv_id", "depth")], *sums, top], [x.split()[0] for x in layout.split(", ")])
        if len(queue):
            raise RuntimeError("a parent is missing from its shard")

    return levels.mapInArrow(run, layout)


def across(local: DataFrame, members: DataFrame) -> DataFrame:
    """ka, kb, leaves, saved: what nodes get from shard roots below them."""
    tops = local.where("top AND depth > 0").select("conv_id", "depth", "leaves", "saved")
    owners = tops.select("conv_id").distinct()
    along = members.select("conv_id", "depth", "ka", "kb").join(owners, "conv_id", "left_semi").join(tops, ["conv_id", "depth"], "left")
    sums = {c: ("sum", F.coalesce(F.col(f"own_{c}"), F.lit(0).cast("long"))) for c in ("leaves", "saved")}
    along = along.withColumnsRenamed({c: f"own_{c}" for c in sums})
    added = running(along, ["conv_id"], [F.col("depth").desc()], **sums)
    below = [(F.col(c) - F.coalesce(f"own_{c}", F.lit(0).cast("long"))).alias(c) for c in sums]
    inner = added.select("ka", "kb", *below).where("leaves > 0").groupBy("ka", "kb").agg(*[F.sum(c).alias(c) for c in sums])
    zero = F.lit(0).cast("long")
    root = tops.agg(*[F.sum(c).alias(c) for c in sums]).where("leaves > 0").select(zero.alias("ka"), zero.alias("kb"), *sums)
    return inner.unionByName(root)


def ends(members: DataFrame, silent: DataFrame) -> DataFrame:
    """ka, kb, ends_sha256 of the nodes at which conversations end."""
    zero = F.lit(0).cast("long")
    stops = members.where("last").select("ka", "kb", "conv_id").unionByName(silent.select(zero.alias("ka"), zero.alias("kb"), "conv_id"))
    rows = stops.repartition(shuffle_width(members.sparkSession), "ka", "kb").sortWithinPartitions("ka", "kb", "conv_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(found: list[tuple]) -> pa.RecordBatch:
            ka, kb, digest = zip(*found, strict=True) if found else ([], [], [])
            return pa.RecordBatch.from_arrays([pa.array(ka, pa.int64()), pa.array(kb, pa.int64()), pa.array(digest, pa.string())], ["ka", "kb", "ends_sha256"])

        key, digest = None, hashlib.sha256()
        for batch in batches:
            found = []
            for ka, kb, conv in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (ka, kb) != key:
                    if key is not None:
                        found.append((*key, digest.hexdigest()))
                    key, digest = (ka, kb), hashlib.sha256(str(conv).encode())
                else:
                    digest.update(f",{conv}".encode())
            yield out(found)
        if key is not None:
            yield out([(*key, digest.hexdigest())])

    return rows.mapInArrow(run, "ka long, kb long, ends_sha256 string")


def trie(conversations: DataFrame, owners: int = OWNERS, band: int = BAND, held: int = HELD) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every node."""
    both, silent = rebuilt(written(turns(conversations)))
    members, silent = written(prefixes(both)), cut(silent)
    every = written(nodes(members, silent))
    local = written(forward(every, owners, band, held))
    more = across(local, members).withColumnsRenamed({"leaves": "more_leaves", "saved": "more_saved"})
    facts = every.select("ka", "kb", "parent_conv_id", "n_convs", "n_children")
    joined = local.join(facts, ["ka", "kb"]).join(more, ["ka", "kb"], "left").join(ends(members, silent), ["ka", "kb"], "left")
    zero = F.lit(0).cast("long")
    return joined.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        (F.col("leaves") + F.coalesce("more_leaves", zero)).alias("n_leaves"),
        (F.col("saved") + F.coalesce("more_saved", zero)).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"),
    )
