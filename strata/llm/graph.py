"""Links between near copies: shared keys, candidate pairs, connected components.

Nodes are 64-bit ids.  Nothing here gathers a group, a list or a component in
one place: keys shared by many rows are folded within each batch first, and
groups are linked through their smallest member.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.store import partitions, written

#: Fields of an entry: the key, the node that has it, and 32 bits for the caller.
ENTRY = np.dtype([("key", "<u8"), ("node", "<i8"), ("note", "<u4")])
#: The same of callers that have nothing to note.
PLAIN_ENTRY = np.dtype([("key", "<u8"), ("node", "<i8")])
#: Components of a key up to which their nodes are compared by that key.
MANY = 16
#: Entries or edges that a task folds at once.
HELD_ENTRIES = 400_000
#: Bits of ``may_have``.
MARK_BITS = 1 << 24
_ENTRIES = "bucket int, key long, node long, note long, blob binary"


def entry_rows(key: np.ndarray, node: np.ndarray, note: np.ndarray, buckets: int, entry: np.dtype = ENTRY) -> pa.RecordBatch:
    """A batch's entries as rows for ``shared_keys``.

    Entries of a key that several nodes of the batch have are rows of their
    own, dealt to salted buckets; of every key the entry of its smallest node
    goes on in the blob of the key's bucket.
    """
    order = np.lexsort((node, key))
    key, node, note = key[order], node[order], note[order]
    fresh = np.ones(len(key), bool)
    fresh[1:] = (key[1:] != key[:-1]) | (node[1:] != node[:-1])
    key, node, note = key[fresh], node[fresh], note[fresh]
    lead = np.ones(len(key), bool)
    lead[1:] = key[1:] != key[:-1]
    many = ~lead
    many[:-1] |= ~lead[1:]
    blob = np.empty(int(lead.sum()), entry)
    blob["key"], blob["node"] = key[lead], node[lead]
    if "note" in entry.names:
        blob["note"] = note[lead]
    bucket = ((blob["key"] >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64)
    at = np.argsort(bucket, kind="stable")
    blob, bucket = blob[at], bucket[at]
    ids, first = np.unique(bucket, return_index=True)
    blobs = [blob[a:b].tobytes() for a, b in zip(first, [*first[1:], len(blob)])]
    k, m = int(many.sum()), len(ids)
    salt = int(key[0]) & 0xFFFF if len(key) else 0
    none = np.zeros(m, np.int64)
    return pa.RecordBatch.from_arrays([
        pa.array(np.concatenate([(np.arange(k) + salt) % buckets, ids]).astype(np.int32)),
        pa.array(np.concatenate([key[many].view(np.int64), none])), pa.array(np.concatenate([node[many], none])),
        pa.array(np.concatenate([note[many].astype(np.int64), none])), pa.array([None] * k + blobs, pa.binary())],
        ["bucket", "key", "node", "note", "blob"])


def shared_keys(source: DataFrame, entries: Callable[[pa.RecordBatch], Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]],
                name: str, noted: bool = True) -> DataFrame:
    """key, node and note of every key that at least two nodes have.

    ``entries`` gives (key, node, note) arrays of a batch; without ``noted`` notes are 0 and don't move.  All entries move
    once, packed as blobs, to the bucket of their key; only keys met in several
    batches are written from there, beside those shared within a batch.
    """
    buckets = 2 * partitions(source.sparkSession)
    entry = ENTRY if noted else PLAIN_ENTRY

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = 0
        for batch in batches:
            for part in entries(batch):
                held.append(part)
                size += len(part[0])
                if size >= HELD_ENTRIES:
                    yield entry_rows(*(np.concatenate(c) for c in zip(*held)), buckets, entry)
                    held, size = [], 0
        if size:
            yield entry_rows(*(np.concatenate(c) for c in zip(*held)), buckets, entry)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs: list[np.ndarray] = []
        for batch in batches:
            rows = batch.select(["key", "node", "note"])
            plain = pa.compute.is_null(batch.column("blob"))
            yield rows.filter(plain)
            blobs += [np.frombuffer(b.as_buffer(), entry) for b in batch.column("blob").drop_null()]
        if not blobs:
            return
        all_entries = np.concatenate(blobs)
        blobs.clear()
        order = np.argsort(all_entries["key"], kind="stable")
        key = all_entries["key"][order]
        lead = np.ones(len(key) + 1, bool)
        lead[1:-1] = key[1:] != key[:-1]
        pick = order[~(lead[:-1] & lead[1:])]  # keys that stand alone are gone from here on
        pick = all_entries[pick]
        key, node, note = pick["key"], pick["node"], pick["note"] if noted else np.zeros(len(pick), np.uint32)
        order = np.lexsort((node, key))
        key, node, note = key[order], node[order], note[order]
        fresh = np.ones(len(key), bool)
        fresh[1:] = (key[1:] != key[:-1]) | (node[1:] != node[:-1])
        key, node, note = key[fresh], node[fresh], note[fresh]
        lead = np.ones(len(key) + 1, bool)
        lead[1:-1] = key[1:] != key[:-1]
        keep = ~(lead[:-1] & lead[1:])
        yield pa.RecordBatch.from_arrays([pa.array(key[keep].view(np.int64)), pa.array(node[keep]), pa.array(note[keep].astype(np.int64))], ["key", "node", "note"])

    # a partition is a bucket; mapInArrow sees all of its rows
    dealt = source.mapInArrow(emit, _ENTRIES).repartitionById(buckets, F.col("bucket"))
    return written(dealt.mapInArrow(meet, "key long, node long, note long"), name)


class NodeFilter:
    """A bit for each hash of a node set: no false negatives, a fixed size.

    It is broadcast to drop, before a shuffle, rows that a join drops anyway.
    ``bits`` bounds its size; when very many nodes fill it, more rows move and
    the join decides alone.
    """

    def __init__(self, nodes: DataFrame, column: str, bits: int = 1 << 26):
        spark = nodes.sparkSession
        slot = F.pmod(F.shiftright(F.col(column), 7), F.lit(bits)) + 1  # the bitmap functions count from 1
        chunks = (nodes.select(slot.alias("slot"))
                  .groupBy(F.bitmap_bucket_number("slot").alias("chunk")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bitmap")).collect())
        # bucket k of the bitmap functions holds the positions (k - 1) * 32768 + 1 to k * 32768
        table = np.zeros(bits // 8 + 4096, np.uint8)
        for row in chunks:
            part = np.frombuffer(bytes(row["bitmap"]), np.uint8)
            at = (row["chunk"] - 1) * 4096 + 4096
            table[at : at + len(part)] = part
        self.bits = bits
        self.table = spark.sparkContext.broadcast(table)

    def has(self, nodes: np.ndarray) -> np.ndarray:
        """Whether each node may be in the set."""
        position = (nodes.view(np.int64) >> 7) % self.bits + 32768  # chunk 1 is the first
        return (self.table.value[position >> 3] >> (position & 7).astype(np.uint8)) & 1 == 1


def may_have(rows: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """The rows with ``__may``, false only where the column (64-bit hashes) has no value of the single column of keys.

    Like NodeFilter, but for columns that stay out of Python: rows that a join
    drops or leaves as they are need not be shuffled for it.  Its MARK_BITS are
    broadcast as longs; keys that fill them say less but never rule out.
    """
    slot = f"pmod(shiftright(`{{}}`, 7), {MARK_BITS}L)"
    words = (keys.select(F.expr(slot.format(keys.columns[0])).alias("slot")).groupBy(F.expr("shiftright(slot, 6)").alias("__at"))
             .agg(F.expr("bit_or(shiftleft(1L, cast(slot & 63 as int)))").alias("__bits")))
    return (rows.join(F.broadcast(words), F.expr(f"shiftright({slot.format(column)}, 6)") == F.col("__at"), "left")
            .withColumn("__may", F.expr(f"coalesce(shiftright(__bits, cast({slot.format(column)} & 63 as int)) & 1L = 1L, false)")).drop("__at", "__bits"))


def with_both(pairs: DataFrame, values: DataFrame, name: str) -> DataFrame:
    """a, b and the values of both nodes (``name``_a and ``name``_b) of pairs, from a table of (node, value)."""
    few = may_have(values, "node", pairs.select(F.explode(F.array("a", "b")).alias("n"))).where("__may").drop("__may")
    x, y = few.toDF("a", f"{name}_a"), few.toDF("b", f"{name}_b")
    return pairs.join(x, "a").join(y, "b").select("a", "b", f"{name}_a", f"{name}_b")


def local_forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, smallest node of its component) of the given edges."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        rx, ry = root[x], root[y]
        low = np.minimum(rx, ry)
        if (rx == ry).all():
            break
        np.minimum.at(root, rx, low)
        np.minimum.at(root, ry, low)
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
    keep = root != np.arange(len(nodes))
    return nodes[keep], nodes[root[keep]]


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges (a, b) as spanning forests of up to HELD_ENTRIES edges at a time."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0
    for batch in batches:
        held.append(tuple(batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1)))
        size += len(batch)
        if size >= HELD_ENTRIES:
            held = [local_forest(*(np.concatenate(c) for c in zip(*held)))]
            size = len(held[0][0])
            if 2 * size >= HELD_ENTRIES:  # little is left to fold
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in held[0]], ["a", "b"])
                held, size = [], 0
    if size:
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in local_forest(*(np.concatenate(c) for c in zip(*held)))], ["a", "b"])


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """node and component of every node of the edges (a, b), of which there are no more than a task folds."""
    held = [tuple(batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1)) for batch in batches]
    if held:
        node, component = local_forest(*(np.concatenate(c) for c in zip(*held)))
        root = np.unique(component)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([node, root])), pa.array(np.concatenate([component, root]))], ["node", "component"])


def _all_stars(edges: DataFrame) -> bool:
    """Whether every node a has one edge and no b is itself an a, so that edges lead to components."""
    ends = edges.select(F.col("a").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(edges.select("b", F.lit(0), F.lit(1)))
    open_ = ends.groupBy("n").agg(F.sum("up").alias("up"), F.sum("down").alias("down")).where("up > 1 or (up > 0 and down > 0)")
    return not open_.limit(1).count()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """node and component (its smallest node) of every node of the edges (a, b).

    Up to HELD_ENTRIES edges are folded by one task, in one stage.  More take
    union-find in rounds: the edges of a task are first replaced by spanning
    forests, then every node moves to its smallest neighbour and the edges
    follow, until all that is left are stars.  Nodes are hashes, in no order
    along a path, and on such paths a round leaves a fixed share of the nodes;
    ids in the order of a path would take a round a node beyond what a task
    folds.  Whether the edges are stars is all that reaches the driver.
    """

    def folded(e: DataFrame) -> DataFrame:
        return written(e.where("a <> b").distinct().mapInArrow(_forests, "a long, b long"), f"{name}-edges")

    edges = edges.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b")
    if edges.count() <= HELD_ENTRIES:
        return written(edges.coalesce(1).mapInArrow(_stars, "node long, component long"), name)
    left = folded(edges)
    maps: list[DataFrame] = []
    while not _all_stars(left):
        both = left.union(left.select("b", "a"))
        up = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                     .select("node", F.least("node", "m").alias("up")), f"{name}-round")
        maps.append(up)
        x, y = up.toDF("na", "ua"), up.toDF("nb", "ub")
        left = folded(left.join(x, F.col("a") == F.col("na")).join(y, F.col("b") == F.col("nb"))
                      .select(F.col("ua").alias("a"), F.col("ub").alias("b")))
    # a node's way up through the rounds; later maps hold ever fewer nodes
    out = left.toDF("node", "component").union(left.select("b", "b").distinct())
    if not maps:
        return out
    for up in reversed(maps):
        later = out.select(F.col("node").alias("l_node"), F.col("component").alias("l_component"))
        out = (up.join(later, F.col("up") == F.col("l_node"), "left")
               .select("node", F.coalesce("l_component", "up").alias("component")))
    return written(out, name)


def link_groups(shared: DataFrame, verify: Callable[[DataFrame], DataFrame], name: str,
                possible: Callable[[str, str], object] | None = None, rounds: int = 8, least_yield: float = 0.05,
                rest: Callable[[DataFrame, bool], DataFrame] | None = None) -> DataFrame:
    """Components of the verified links between nodes that share a key.

    Pairs within a component need no check.  In each round every key that
    still holds several components has a leader, another one each time (first
    the one with the smallest note), and each node outside the leader's
    component is checked against the leader it meets most often: one check a
    node, so a large group of copies collapses without its pairs.  When a
    round links fewer than ``least_yield`` of its pairs (or after ``rounds``),
    all pairs that could still join two components are checked, so no link is
    lost.  ``possible`` narrows the pairs of a key by the notes of both nodes.
    For keys that many unlike nodes have (more than MANY components), ``rest``
    takes their nodes and components (node, comp) and gives pairs of them that
    can still link, found by other keys: first those with the other keys'
    leaders, then, by the components these leave, all.
    """
    links: list[DataFrame] = []
    tried: list[DataFrame] = []
    entries = _rounds(shared.select("key", "node", "note", F.col("node").alias("comp")), verify, name, possible, rounds, least_yield, links, tried)
    pairs = []
    if rest is not None:
        per_key = entries.groupBy("key").agg(F.count_distinct("comp").alias("comps"))
        entries = written(entries.join(per_key.where("comps > 1"), "key"), f"{name}-mixed")
        crowd = written(entries.where(F.col("comps") > MANY).select("node", "comp").distinct(), f"{name}-rest")
        entries = entries.where(F.col("comps") <= MANY).drop("comps")
        tried.append(written(_untried(rest(crowd, True), tried), f"{name}-pairs"))
        links.append(written(verify(tried[-1]).select("a", "b"), f"{name}-links"))
        up = components(_union(links), f"{name}-round").toDF("u_node", "up")
        crowd = crowd.join(up, F.col("node") == F.col("u_node"), "left").select("node", F.coalesce("up", "comp").alias("comp"))
        pairs.append(rest(crowd, False))
    pairs.append(_cross(entries, possible))
    left = written(_untried(_union(pairs).distinct(), tried), f"{name}-cross")
    links.append(written(verify(left).select("a", "b"), f"{name}-links"))
    return components(_union(links), f"{name}-components")


def _cross(entries: DataFrame, possible: Callable | None) -> DataFrame:
    """Pairs of nodes of a key that stand in different components."""
    x = entries.select("key", F.col("node").alias("a"), F.col("note").alias("a_note"), F.col("comp").alias("ca"))
    y = entries.select("key", F.col("node").alias("b"), F.col("note").alias("b_note"), F.col("comp").alias("cb"))
    cross = x.join(y, "key").where((F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb")))
    if possible is not None:
        cross = cross.where(possible("a_note", "b_note"))
    return cross.select("a", "b")


def _rounds(entries: DataFrame, verify: Callable, name: str, possible: Callable | None, rounds: int, least_yield: float,
            links: list[DataFrame], tried: list[DataFrame]) -> DataFrame:
    """Leader rounds over (key, node, note, comp); adds to links and tried, returns the entries of keys still open."""
    for r in range(rounds):
        order = F.struct((F.col("note") if r == 0 else F.lit(0)).alias("n"), F.xxhash64(F.lit(r), "node").alias("h"), "node", "note", "comp")
        lead = (entries.groupBy("key").agg(F.min(order).alias("lead"), F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi")
                .select("key", F.col("lead.node").alias("a"), F.col("lead.note").alias("a_note"), F.col("lead.comp").alias("ca")))
        led = entries.join(lead, "key").where(F.col("comp") != F.col("ca"))
        if possible is not None:
            led = led.where(possible("a_note", "note"))
        met = led.groupBy(F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b"), F.col("node").alias("of")).agg(F.count(F.lit(1)).alias("n"))
        best = _untried(met, tried).groupBy("of").agg(F.max(F.struct("n", "a", "b")).alias("p")).select("p.a", "p.b").distinct()
        pairs = written(best, f"{name}-pairs")
        found = written(verify(pairs).select("a", "b"), f"{name}-links")
        tried.append(pairs)
        n, k = pairs.count(), found.count()
        if k:
            links.append(found)
            up = components(_union(links), f"{name}-round").select(F.col("node").alias("u_node"), F.col("component").alias("up"))
            moved = (entries.select("key", "node", "note").join(up, F.col("node") == F.col("u_node"), "left")
                     .select("key", "node", "note", F.coalesce("up", "node").alias("comp")))
            mixed = moved.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("key")
            entries = written(moved.join(mixed, "key", "left_semi"), f"{name}-open")
        if k < least_yield * n or not k:
            break
    return entries


def _untried(pairs: DataFrame, tried: list[DataFrame]) -> DataFrame:
    return pairs.join(_union(tried), ["a", "b"], "left_anti") if tried else pairs


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.union(f)
    return out
