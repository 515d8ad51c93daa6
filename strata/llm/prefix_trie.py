"""Trie of shared conversation prefixes from vertical bitmaps.

A conversation is a sequence of turns; every distinct sequence of first d turns
is a node.  Conversations are range-partitioned by id and read as shards of at
most ``shard`` neighbouring ids.  A shard indexes (position, turn) to a bitset
of its conversations.  Going depth first, a node's children are the non-empty
intersections of its bitset with the postings of the next position; popcounts
are its members and the members that end there are its end list.  A node is
known across shards by the exclusive-or of its (position, turn) hashes, 128
bits, so that shards' counts add up in one aggregation.

Sums over subtrees need no walk up the merged trie.  The smallest conversation
through a node owns it; since members only leave on the way down, a
conversation owns its path from some depth on to its end.  A node's leaves are
its members that own a childless end, and the bytes of its distinct subtree
are, summed over owning members, those of the turns they own below it.

Long conversations are cut into segments of ``SEGMENT`` turns, each a shard
member of its own that starts from the hash of the turns before it.  So a task
holds ``shard`` segments at most, whatever is hot: copies meet as bits of a
bitset, and one row a shard and node is shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.manifest import crc32_sql
from strata.llm.ranks import placed
from strata.llm.store import partitions, written

SHARD = 1024
SEGMENT = 4096
#: Rows that a shard takes before it is cut, and ids of a piece of an end list.
SHARD_ROWS = 100_000
PIECE = 256

KEY = ["depth", "k1", "k2"]
_OUT = "kind int, depth long, k1 long, k2 long, p1 long, p2 long, conv_id long, n_convs long, bytes long, total long, tail long, ends string"
_COLUMNS = [f.split()[0] for f in _OUT.split(", ")]


def numbered(conversations: DataFrame) -> DataFrame:
    """(conv_id, at, n, t1, t2, bytes): turns by place in their conversation, as hashes.

    Turns are ordered by ``turn``, null first; equal ones by their hash.  Null
    role and text are empty.  Rows without a conversation id belong to none and
    are left out.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.xxhash64(F.lit(1), role, text).alias("t1"), F.xxhash64(F.lit(2), role, text).alias("t2"), F.octet_length(text).cast("long").alias("bytes"))
    return written(placed(rows, ["conv_id"], ["turn", "t1", "t2"], "trie-turns").select("conv_id", "at", "n", "t1", "t2", "bytes"), "trie-turns")


class Shard:
    """Segments of neighbouring conversations as vertical bitmaps."""

    def __init__(self, rows: dict[str, np.ndarray]):
        conv, self.z1, self.z2, self.depth = rows["conv_id"], rows["z1"], rows["z2"], rows["depth"]
        first = np.flatnonzero(np.concatenate(([True], conv[1:] != conv[:-1])))
        self.ids = conv[first].tolist()
        self.start, size = first, np.diff(np.concatenate((first, [len(conv)])))
        self.member = np.repeat(np.arange(len(first)), size)
        self.length = rows["n"][first]
        self.base = int(self.depth[0])
        self.before = list(zip(rows["b1"][first].tolist(), rows["b2"][first].tolist()))
        self.bytes = rows["bytes"]
        sums = np.concatenate(([0], np.cumsum(self.bytes)))
        self.tail = rows["later"] + (sums[first + size] - 0)[self.member] - sums[:-1]  # bytes of this and all later turns
        self.k1, self.k2 = self._paths(self.z1, rows["b1"]), self._paths(self.z2, rows["b2"])

    def _paths(self, z: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Hash of the turns up to each row: running exclusive-or, restarted at each segment."""
        run = np.bitwise_xor.accumulate(z)
        reset = np.concatenate(([0], run[self.start[1:] - 1]))
        return run ^ reset[self.member] ^ before

    def index(self) -> None:
        """Bitsets of conversations by (position, turn), by position, and of those that end at a position."""
        self.postings: dict[tuple, int] = {}
        self.present: dict[int, int] = {}
        self.ending: dict[int, int] = {}
        for d, a, b, i in zip(self.depth.tolist(), self.z1.tolist(), self.z2.tolist(), self.member.tolist()):
            bit = 1 << i
            self.postings[d, a, b] = self.postings.get((d, a, b), 0) | bit
            self.present[d] = self.present.get(d, 0) | bit
        for i, n in enumerate(self.length.tolist()):
            self.ending[n] = self.ending.get(n, 0) | 1 << i

    def members(self, bits: int) -> np.ndarray:
        raw = np.frombuffer(bits.to_bytes((len(self.ids) + 7) // 8, "little"), np.uint8)
        return np.flatnonzero(np.unpackbits(raw, bitorder="little"))

    def walk(self) -> Iterator[tuple]:
        """The shard's nodes, depth first: (depth, k1, k2, p1, p2, conv_id, n_convs, bytes, total, tail, end list)."""
        self.index()
        starts: dict[tuple, int] = {}
        for i, key in enumerate(self.before):
            starts[key] = starts.get(key, 0) | 1 << i
        stack = [(bits, self.base - 1, *key) for key, bits in starts.items()]
        z1, z2, base, start = self.z1, self.z2, self.base, self.start
        while stack:
            bits, depth, p1, p2 = stack.pop()
            depth += 1
            left = bits & self.present.get(depth, 0)
            ends = self.ending.get(depth, 0)
            while left:
                i = (left & -left).bit_length() - 1
                row = int(start[i]) + depth - base
                child = left & self.postings[depth, int(z1[row]), int(z2[row])]
                left ^= child
                k1, k2 = p1 ^ int(z1[row]), p2 ^ int(z2[row])
                count = child.bit_count()
                total = int(self.tail[row]) if count == 1 else int(self.tail[self.start[self.members(child)] + depth - base].sum())
                at_end = child & ends
                ended = [self.ids[x] for x in self.members(at_end)] if at_end else []
                yield depth, k1, k2, p1, p2, self.ids[i], count, int(self.bytes[row]), total, int(self.tail[row]), ended
                if child ^ at_end:
                    stack.append((child, depth, k1, k2))


def _emit(rows: dict[str, np.ndarray], long_from: int) -> Iterator[pa.RecordBatch]:
    """A shard's nodes (kind 0), the paths of members that own a node in it or are long (1), and end lists in pieces (2)."""
    shard = Shard(rows)
    nodes, pieces, owners = [], [], set()
    for *node, ended in shard.walk():
        nodes.append((0, *node, None))
        owners.add(node[5])
        for i in range(0, len(ended), PIECE):
            pieces.append((2, *node[:3], 0, 0, ended[i], 0, 0, 0, 0, ",".join(map(str, ended[i : i + PIECE]))))
    keep = np.array([c in owners for c in shard.ids], bool) | (shard.length > long_from)
    at = np.flatnonzero(keep[shard.member])
    for some in (nodes, pieces):
        if some:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some), [pa.int32(), *[pa.int64()] * 10, pa.string()])], _COLUMNS)
    zero = pa.array(np.zeros(len(at), np.int64))
    yield pa.RecordBatch.from_arrays([pa.array(np.ones(len(at), np.int32)), pa.array(shard.depth[at]), pa.array(shard.k1[at]), pa.array(shard.k2[at]), zero, zero,
                                      pa.array(rows["conv_id"][at]), zero, zero, zero, pa.array(shard.tail[at]), pa.nulls(len(at), pa.string())], _COLUMNS)


def _shards(batches: Iterator[pa.RecordBatch], size: int, long_from: int) -> Iterator[pa.RecordBatch]:
    """Sorted rows, cut where a conversation's segment ends once a shard is full, and where a segment number ends."""
    held: dict[str, np.ndarray] | None = None
    for batch in batches:
        new = {f: batch.column(i).to_numpy() for i, f in enumerate(batch.schema.names)}
        rows = new if held is None else {f: np.concatenate((held[f], new[f])) for f in new}
        fresh = np.concatenate(([True], (rows["conv_id"][1:] != rows["conv_id"][:-1]) | (rows["seg"][1:] != rows["seg"][:-1])))
        begins = np.flatnonzero(fresh)
        lo = 0  # index into begins
        for k in range(1, len(begins)):
            a, b = begins[lo], begins[k]
            if k - lo >= size or b - a >= SHARD_ROWS or rows["seg"][b] != rows["seg"][a]:
                yield from _emit({f: v[a:b] for f, v in rows.items()}, long_from)
                lo = k
        held = {f: v[begins[lo] :] for f, v in rows.items()} if len(begins) else None
    if held is not None and len(held["seg"]):
        yield from _emit(held, long_from)


def _hashed_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's end list, from its pieces in order; only the running hash is held."""
    key, sha = None, None
    for batch in batches:
        done = []
        for *node, text in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2, 4))):
            if node != key:
                if key is not None:
                    done.append((*key, sha.hexdigest()))
                key, sha = node, hashlib.sha256(text.encode())
            else:
                sha.update(("," + text).encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], [*KEY, "ends_sha256"])
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*key, sha.hexdigest())], [*KEY, "ends_sha256"])


def _with_segments(turns: DataFrame, segment: int) -> DataFrame:
    """Sorted input of the shards: a row a turn and one of depth 0 a conversation, with what other segments add."""
    long_seg = F.floor(F.col("at") / segment)
    z = [F.xxhash64(F.col("at") + 1, c).alias(f"z{i}") for i, c in ((1, "t1"), (2, "t2"))]
    rows = turns.where("at >= 0").select(long_seg.alias("seg"), "conv_id", (F.col("at") + 1).alias("depth"), *z, "bytes", "n")
    roots = turns.where("at <= 0").select(F.lit(0).cast("long").alias("seg"), "conv_id", *[F.lit(0).cast("long").alias(c) for c in ("depth", "z1", "z2", "bytes")], "n")
    every = rows.unionByName(roots)
    none = {c: F.lit(0).cast("long") for c in ("b1", "b2", "later")}
    short = every.where(F.col("n") <= segment).withColumns(none)
    parts = rows.where(F.col("n") > segment).groupBy(F.col("conv_id").alias("s_conv"), F.col("seg").alias("s_seg")).agg(
        F.bit_xor("z1").alias("x1"), F.bit_xor("z2").alias("x2"), F.sum("bytes").alias("x3"))
    conv = Window.partitionBy("s_conv").orderBy("s_seg")
    before, after = conv.rowsBetween(Window.unboundedPreceding, -1), conv.rowsBetween(1, Window.unboundedFollowing)
    carried = parts.select("s_conv", "s_seg", F.coalesce(F.bit_xor("x1").over(before), F.lit(0)).alias("b1"),
                           F.coalesce(F.bit_xor("x2").over(before), F.lit(0)).alias("b2"), F.coalesce(F.sum("x3").over(after), F.lit(0)).alias("later"))
    long = every.where(F.col("n") > segment).join(carried, (F.col("conv_id") == F.col("s_conv")) & (F.col("seg") == F.col("s_seg"))).drop("s_conv", "s_seg")
    return short.unionByName(long)


def trie(turns: DataFrame, shard: int = SHARD, segment: int = SEGMENT) -> DataFrame:
    """Every node of the trie of the conversations.

    ``turns``: (conv_id, at from 0, n turns, t1, t2, bytes) as ``numbered``
    gives them; a conversation without turns is one row with at -1 and n 0.
    Gives conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens and ends_sha256.  Without conversations there is no
    node, not even a root.  Equal conversations are members of the same nodes
    and stand in the same end list.  Texts come as hashes and lengths, so their
    size plays no part; extra columns are dropped, whatever their names.
    """
    spark = turns.sparkSession
    by = ["seg", "conv_id", "depth"]
    rows = (_with_segments(turns, segment).select(*by, "z1", "z2", "bytes", "n", "b1", "b2", "later")
            .repartitionByRange(partitions(spark), "seg", "conv_id").sortWithinPartitions(*by))
    parts = written(rows.mapInArrow(lambda batches: _shards(batches, shard, segment), _OUT), "trie-parts")
    merged = (parts.where("kind = 0").groupBy(*KEY)
              .agg(F.first("p1").alias("p1"), F.first("p2").alias("p2"), F.min(F.struct("conv_id", "tail")).alias("owner"),
                   F.sum("n_convs").alias("n_convs"), F.sum("total").alias("total"))
              .select(*KEY, "p1", "p2", F.col("owner.conv_id").alias("conv_id"), F.col("owner.tail").alias("tail"), "n_convs", "total"))
    merged = written(merged, "trie-nodes")
    below = (merged.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2"))
             .agg(F.count(F.lit(1)).alias("n_children")))
    nodes = written(merged.join(below, KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))), "trie-nodes")
    owned = (nodes.groupBy(F.col("conv_id").alias("o_conv")).agg(F.min(F.struct("depth", "tail")).alias("top"), F.max((F.col("n_children") == 0).cast("int")).alias("leaf")))
    sums = (parts.where("kind = 1").select(*KEY, "conv_id", "tail").join(owned, F.col("conv_id") == F.col("o_conv"))
            .select(*KEY, F.col("leaf").cast("long").alias("leaf"), F.least("tail", "top.tail").alias("own"))
            .groupBy(*KEY).agg(F.sum("leaf").alias("n_leaves"), F.sum("own").alias("own")))
    ends = (parts.where("kind = 2").select(*KEY, F.col("conv_id").alias("first"), "ends").repartition(partitions(spark), *KEY)
            .sortWithinPartitions(*KEY, "first").mapInArrow(_hashed_ends, "depth long, k1 long, k2 long, ends_sha256 string"))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    return (nodes.join(sums, KEY).join(ends, KEY, "left").join(parents, ["depth", "p1", "p2"], "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", (F.col("total") - F.col("own")).alias("saved_tokens"),
                    F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256")))


def prefix_trie(conversations: DataFrame, shard: int = SHARD, segment: int = SEGMENT) -> DataFrame:
    """The trie of (conv_id, turn, role, text) rows; nulls and ties as in ``numbered``."""
    return trie(numbered(conversations), shard, segment)


def with_turns(nodes: DataFrame, conversations: DataFrame) -> DataFrame:
    """Nodes with the turn, role and text of their last turn (null at the root), from their smallest member."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"),
        F.xxhash64(F.lit(1), role, text).alias("t1"), F.xxhash64(F.lit(2), role, text).alias("t2"))
    at = placed(rows, ["conv_id"], ["turn", "t1", "t2"], "trie-texts").select("conv_id", (F.col("at") + 1).alias("depth"), "turn", "role", "text")
    return nodes.join(at, ["conv_id", "depth"], "left")


def _head(conv_id: Column) -> Column:
    """How many first turns the query takes from another conversation."""
    return F.crc32(conv_id.cast("string").cast("binary")) % 9


def rebuilt(turns: DataFrame) -> DataFrame:
    """The query's conversations: the first turns of conversation c - c % 5, then c's own after as many.

    Every id stays; one whose turns all go and whose model is absent is left
    without turns (at -1).  ``%`` has the sign of c.
    """
    convs = turns.where("at = 0").select(F.col("conv_id").alias("c"), F.col("n").alias("c_n"), (F.col("conv_id") - F.col("conv_id") % 5).alias("model"), _head(F.col("conv_id")).alias("h"))
    models = turns.where("at = 0").select(F.col("conv_id").alias("model"), F.col("n").alias("m_n"))
    convs = written(convs.join(models, "model", "left")
                    .withColumn("taken", F.least("h", F.coalesce("m_n", F.lit(0))))
                    .select("c", "model", "h", "taken", (F.col("taken") + F.greatest(F.col("c_n") - F.col("h"), F.lit(0))).alias("n")), "trie-rebuilt")
    own = (turns.drop("n").join(convs.drop("model"), F.col("conv_id") == F.col("c")).where("at >= h")
           .select("conv_id", (F.col("taken") + F.col("at") - F.col("h")).alias("at"), "n", "t1", "t2", "bytes"))
    head = (turns.where("at < 8 and conv_id % 5 = 0").drop("n").join(convs, F.col("conv_id") == F.col("model")).where("at < h")
            .select(F.col("c").alias("conv_id"), "at", "n", "t1", "t2", "bytes"))
    empty = convs.where("n = 0").select(F.col("c").alias("conv_id"), F.lit(-1).cast("long").alias("at"), "n", *[F.lit(0).cast("long").alias(c) for c in ("t1", "t2", "bytes")])
    return written(own.unionByName(head).unionByName(empty), "trie-rebuilt")


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the trie of all rebuilt conversations."""
    return trie(rebuilt(numbered(spark.read.parquet(f"{sf_dir}/conversations.parquet"))))


ORACLE_SQL = f"""WITH t AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS pos, coalesce(role, '') AS r, coalesce(text, '') AS x
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT c, c - c % 5 AS b, {crc32_sql('CAST(c AS VARCHAR)')} % 9 AS h FROM (SELECT DISTINCT c FROM t) AS d),
re AS (SELECT v.c, 0 AS k, pos, r, x FROM convs AS v JOIN t ON t.c = v.b AND pos < h UNION ALL SELECT v.c, 1, pos, r, x FROM convs AS v JOIN t ON t.c = v.c AND pos >= h),
steps AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY k, pos) AS d, r, x FROM re),
paths AS (SELECT c, 0 AS d, '' AS node, 0 AS bytes FROM convs UNION ALL
  SELECT c, d, sha256(string_agg(strlen(r) || ':' || r || strlen(x) || ':' || x, '') OVER (PARTITION BY c ORDER BY d ROWS UNBOUNDED PRECEDING)), strlen(x) FROM steps),
linked AS (SELECT *, lag(node) OVER w AS up, row_number() OVER (PARTITION BY c ORDER BY d DESC) = 1 AS last FROM paths WINDOW w AS (PARTITION BY c ORDER BY d)),
nodes AS (SELECT node, d AS depth, min(c) AS conv_id, min(up) AS up, count(*) AS n_convs, max(bytes) AS bytes,
  sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (last), '')) AS ends_sha256 FROM linked GROUP BY node, d),
kids AS (SELECT up, count(*) AS k FROM nodes WHERE depth > 0 GROUP BY up),
under AS (SELECT DISTINCT a.node, b.node AS sub FROM paths AS a JOIN paths AS b ON a.c = b.c AND b.d >= a.d),
sums AS (SELECT under.node, count(*) FILTER (kids.k IS NULL) AS n_leaves, sum((n_convs - 1) * bytes) AS saved FROM under JOIN nodes ON sub = nodes.node LEFT JOIN kids ON kids.up = sub GROUP BY under.node)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(kids.k, 0) AS n_children, n_leaves, CAST(saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes AS n JOIN sums ON sums.node = n.node LEFT JOIN nodes AS p ON n.depth > 0 AND p.node = n.up LEFT JOIN kids ON kids.up = n.node"""
