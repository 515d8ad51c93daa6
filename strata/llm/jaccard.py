"""N-gram Jaccard self-join of documents by a size-aware heavy-light join.

A document's set is its distinct 5-word shingles.  Sets are ordered by one
global order, rare shingles first (a fixed-size sketch of document counts over
the whole corpus, then the hash), so that a shingle found in very many
documents stands in few prefixes.  Two sets that reach the threshold share
k shingles within their prefixes of s - ceil(t*s) + k shingles, for any k they
can share.  Sets fall into two classes:

* light (up to ``boundary`` shingles): enumerate the subsets of two of the
  prefix for k = 2; equal subsets are candidates;
* heavy: post the single shingles of the prefix for k = 1 and scan the posting
  lists; sets near the boundary do both, so that light and heavy ones meet.

The boundary is where a light set's subsets would cost more than the postings
of a heavy one and the lists they scan, from the measured share of shingles
that others have.  Candidates pass size and position bounds, and are verified
by their exact sets; links are closed by union-find.  Equal sets are one node.

Nulls and texts without words have the empty set, which links with nothing; a
text of fewer than five words has its whole sequence as its only shingle; null
ids are kept (with no id to offer as component); repeated rows are rows each;
an empty table gives none.  A text of any length is read whole, one batch of
bytes at a time, and its set is as large as it has shingles.  Extra columns are
left aside, whatever their names; only ``one_of_each`` keeps them.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.graph import NodeFilter, link_groups, shared_keys, with_both
from strata.llm.store import partitions, written
from strata.llm.text import SMALL_BATCH_BYTES, PrefixHash, give_back, lower_ascii, mix, row_sets, shared_counts, shingles, text_batches, words

WIDTH = 5
THRESHOLD = 0.75
#: Counters of the sketch of document counts.
SKETCH_BITS = 20
_SLICES = 16


def text_sets(data: np.ndarray, offsets: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of each row's set, ascending, and the sets' sizes."""
    low = lower_ascii(data)
    start, end, counts = words(low, offsets)
    return row_sets(*shingles(PrefixHash(low).slices(start, end), counts, width))


def fingerprints(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A 64-bit identity of each set (0 for the empty set)."""
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(values ^ np.uint64(0x5BF03635)))))
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    f = mix(sums[bounds[1:]] - sums[bounds[:-1]] + sizes.astype(np.uint64))
    return np.where(sizes > 0, f | np.uint64(1), np.uint64(0)).view(np.int64)


def overlap_needed(size: np.ndarray, threshold: float) -> np.ndarray:
    """The least number of shingles shared with any partner."""
    return np.ceil(size * threshold - 1e-9).astype(np.int64)


def similar(values: np.ndarray, sizes: np.ndarray, x: np.ndarray, y: np.ndarray, threshold: float) -> np.ndarray:
    """Whether the sets x[k] and y[k] of the given ones reach the threshold."""
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    ok = np.minimum(sizes[x], sizes[y]) >= threshold * np.maximum(sizes[x], sizes[y]) - 1e-9
    both = shared_counts(values, bounds, x[ok], y[ok])
    ok[ok] = both >= threshold * ((sizes[x] + sizes[y])[ok] - both) - 1e-9
    return ok


class Order:
    """Rare-first order of shingles: logarithm of the sketched count, then the hash."""

    def __init__(self, counts: np.ndarray):
        self.level = np.floor(4 * np.log2(np.maximum(counts, 1) + 0.0)).astype(np.uint8)
        mean = counts.sum() / len(counts)
        # shingles that share a counter by chance say nothing: what exceeds the mean is shared
        light = np.sort(counts)[: len(counts) * 3 // 4]
        self.list_length = 1.0 + float(np.maximum(light - 2 * mean, 0).mean()) if len(light) else 1.0

    def rank(self, values: np.ndarray) -> np.ndarray:
        return (self.level[values >> np.uint64(64 - SKETCH_BITS)].astype(np.uint64) << np.uint64(56)) | (values & np.uint64((1 << 56) - 1))


def boundary(list_length: float, threshold: float, posting_cost: float = 3.0) -> int:
    """The largest set size whose subsets of two cost no more than its postings.

    A posting costs ``posting_cost`` times an enumerated subset (it meets lists
    that hold more than its partners), times the length of the list it scans.
    """
    size = 3
    while True:
        prefix = size + 1 - int(np.ceil((size + 1) * threshold - 1e-9)) + 2
        if prefix * (prefix - 1) / 2 > (prefix - 1) * posting_cost * list_length or size >= 200:
            return size
        size += 1


#: Gives (values, sizes, node) of the sets of a batch: hashes ascending by set, set sizes, 64-bit identities.
Sets = Callable[[pa.RecordBatch], Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]]


def _sketch(source: DataFrame, sets: Sets) -> np.ndarray:
    """Numbers of sets by element, added up in a fixed number of counters."""
    piece = (1 << SKETCH_BITS) // _SLICES

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << SKETCH_BITS, np.uint32)
        for batch in batches:
            for values, _, _ in sets(batch):
                total += np.bincount((values >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=len(total)).astype(np.uint32)
        parts = [zlib.compress(total[a : a + piece].tobytes(), 1) for a in range(0, len(total), piece)]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array(parts, pa.binary())], ["part", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                c = np.frombuffer(zlib.decompress(blob.as_py()), np.uint32).astype(np.uint64)
                sums[part] = sums.get(part, 0) + c
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([zlib.compress(s.tobytes(), 1) for s in sums.values()], pa.binary())], ["part", "counts"])

    schema = "part int, counts binary"
    rows = source.mapInArrow(count, schema).repartitionById(_SLICES, F.col("part")).mapInArrow(add, schema).collect()
    out = np.zeros(1 << SKETCH_BITS, np.float64)
    for r in rows:
        out[r["part"] * piece : (r["part"] + 1) * piece] = np.frombuffer(zlib.decompress(bytes(r["counts"])), np.uint64)
    return out


def checked(threshold: float) -> float:
    """The threshold, if the join is exact for it.

    From 2/3 down, sets of one or two shingles may link with others, and sets of
    three with ones that they share a single shingle with; the subsets of two
    don't find these.
    """
    if not 2 / 3 < threshold <= 1:
        raise ValueError(f"the join is exact for thresholds over 2/3 and up to 1, not for {threshold}")
    return threshold


def prefix_keys(source: DataFrame, sets: Sets, threshold: float, name: str) -> DataFrame:
    """Keys of light subsets and heavy prefixes that at least two sets share, for ``link_groups``."""
    order = Order(_sketch(source, sets))
    limit = boundary(order.list_length, threshold)
    shared_order = source.sparkSession.sparkContext.broadcast(order)

    def entries(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        for values, sizes, node in sets(batch):
            yield prefix_entries(values, sizes, node, shared_order.value, limit, threshold)

    return shared_keys(source, entries, name)


_CROWD = np.dtype([("key", "<u8"), ("node", "<i8"), ("comp", "<i8"), ("note", "<u4")])


def crowd_pairs(source: DataFrame, sets: Callable[[pa.RecordBatch], Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]],
                threshold: float, name: str, leaders: bool = False) -> DataFrame:
    """Pairs (a, b) of sets of different components that size and position bounds let link.

    With ``leaders`` only pairs with the set of each list that has the fewest
    shingles rarer than the list's own: what is left of a family links with it.

    ``sets`` gives (values, sizes, node, comp) of a batch.  Postings of the
    prefixes move once, packed; a bucket compares the postings of each shingle
    in order of size, as far as the sizes allow, and gives possible pairs only.
    """
    buckets = 2 * partitions(source.sparkSession)
    order = source.sparkSession.sparkContext.broadcast(Order(_sketch(source, lambda batch: (x[:3] for x in sets(batch)))))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for values, sizes, node, comp in sets(batch):
                key, at, note = prefix_entries(values, sizes, np.arange(len(node)), order.value, 0, threshold)
                e = np.empty(len(key), _CROWD)
                e["key"], e["node"], e["comp"], e["note"] = key, node[at], comp[at], note
                bucket = ((key >> np.uint64(33)) % np.uint64(buckets)).astype(np.int32)
                by = np.argsort(bucket, kind="stable")
                e, bucket = e[by], bucket[by]
                ids, first = np.unique(bucket, return_index=True)
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array([e[a:b].tobytes() for a, b in zip(first, [*first[1:], len(e)])], pa.binary())], ["bucket", "blob"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs = [np.frombuffer(b.as_buffer(), _CROWD) for batch in batches for b in batch.column(1)]
        if not blobs:
            return
        e = np.concatenate(blobs)
        blobs.clear()
        size = (e["note"] & np.uint32((1 << 20) - 1)).astype(np.int64)
        by = np.lexsort((size, e["key"]))
        e, size = e[by], size[by]
        key, node, comp, pos = e["key"], e["node"], e["comp"], (e["note"] >> np.uint32(20)).astype(np.int64)

        def pairs_of(x: np.ndarray, y: np.ndarray) -> np.ndarray:
            small, large = np.minimum(size[x], size[y]), np.maximum(size[x], size[y])
            most = np.minimum(size[x] - pos[x], size[y] - pos[y]) + 1
            bound = (small >= threshold * large - 1e-9) & ((1 + threshold) * most >= threshold * (small + large) - 1e-9)
            ok = (comp[x] != comp[y]) & (bound | (large >= (1 << 20) - 1) | (np.maximum(pos[x], pos[y]) >= 4095))
            return np.stack([np.minimum(node[x], node[y])[ok], np.maximum(node[x], node[y])[ok]], axis=1)

        def batch_of(pairs: list[np.ndarray]) -> pa.RecordBatch:
            found = np.unique(np.concatenate(pairs), axis=0)
            return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(found[:, k])) for k in (0, 1)], ["a", "b"])

        if leaders:
            by = np.lexsort((pos, key))
            first = np.ones(len(by), bool)
            first[1:] = key[by][1:] != key[by][:-1]
            yield batch_of([pairs_of(by[first][np.cumsum(first) - 1], by)])
            return
        here, step, held, n = np.arange(len(e)), 1, [], 0
        while len(here):
            here = here[here + step < len(e)]
            there = here + step
            wide = size[there] >= (1 << 20) - 1
            near = (key[there] == key[here]) & (wide | (size[here] >= threshold * size[there] - 1e-9))
            here = here[near]  # sizes grow: who is out of reach once stays so
            held.append(pairs_of(here, here + step))
            n += len(held[-1])
            step += 1
            if n > 200_000 or (not len(here) and n):
                yield batch_of(held)
                held, n = [], 0
        give_back()

    dealt = source.mapInArrow(emit, "bucket int, blob binary").repartitionById(buckets, F.col("bucket"))
    return written(dealt.mapInArrow(meet, "a long, b long").distinct(), name)


def prefix_entries(values: np.ndarray, sizes: np.ndarray, node: np.ndarray, order: Order, limit: int, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, node, note) of the distinct sets; the note holds size class and position of heavy keys.

    A note is 0 for subsets, else 1 + position in the order, up to 2**12 - 1,
    beside the size up to 2**20 - 1; larger ones say less but never rule out.
    """
    rank = order.rank(values)
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    low = int(np.floor(threshold * (limit + 1)))
    keys, nodes, notes = [], [], []
    seen: set[int] = set()
    for k, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
        s = b - a
        if s < 3 or int(node[k]) in seen:  # smaller sets have no partners but equal ones
            continue
        seen.add(int(node[k]))
        need = int(np.ceil(s * threshold - 1e-9))
        p = min(s, s - need + 2)
        r = rank[a:b]
        top = np.argpartition(r, p - 1)[:p] if p < s else np.arange(s)
        top = top[np.argsort(r[top], kind="stable")]
        v = values[a:b][top]
        if s <= limit:
            i, j = np.triu_indices(p, 1)
            keys.append(mix(np.minimum(v[i], v[j]) * np.uint64(0x9E3779B97F4A7C15) + np.maximum(v[i], v[j])))
            notes.append(np.zeros(len(i), np.uint32))
            nodes.append((node[k], len(i)))
        if s > limit or s >= low:
            n = s - need + 1
            keys.append(v[:n])
            at = np.minimum(np.arange(1, n + 1), 4095)
            notes.append((at.astype(np.uint32) << np.uint32(20)) | np.uint32(min(s, (1 << 20) - 1)))
            nodes.append((node[k], n))
    if not keys:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.uint32)
    return (np.concatenate(keys), np.repeat(np.array([n for n, _ in nodes], np.int64), [c for _, c in nodes]), np.concatenate(notes))


def possible(threshold: float):
    """Size and position bounds on two heavy postings of one shingle."""

    def test(x: str, y: str):
        sx, sy = F.col(x).bitwiseAND((1 << 20) - 1), F.col(y).bitwiseAND((1 << 20) - 1)
        px, py = F.shiftright(x, 20), F.shiftright(y, 20)
        small, large = F.least(sx, sy), F.greatest(sx, sy)
        # a pair meets at the first shingle it shares: this one and what follows in both
        most = F.least(sx - px, sy - py) + 1
        capped = (large >= (1 << 20) - 1) | (F.greatest(px, py) >= 4095)
        return (F.col(x) == 0) | (F.col(y) == 0) | capped | ((small >= threshold * large - 1e-9) & ((1 + threshold) * most >= threshold * (sx + sy) - 1e-9))

    return test


def document_sets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """row_key (of id and text), doc_id, n_shingles and node (identity of the set, 0 if empty) of every row."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in text_batches(batch.column(2), SMALL_BATCH_BYTES):
                values, sizes = text_sets(data, offsets)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i), pa.array(sizes), pa.array(fingerprints(values, sizes))],
                                                 ["row_key", "doc_id", "n_shingles", "node"])

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .select(_row_key().alias("row_key"), "doc_id", "text").mapInArrow(sets, "row_key long, doc_id long, n_shingles long, node long"))


def _row_key() -> Column:
    return F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def node_components(docs: DataFrame, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """node and component of the sets that link with a different set."""
    texts = docs.select(F.col(text_col).cast("string").alias("text"))

    def text_nodes(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        for _, _, data, offsets in text_batches(batch.column(0), SMALL_BATCH_BYTES):
            values, sizes = text_sets(data, offsets)
            yield values, sizes, fingerprints(values, sizes)

    checked(threshold)
    shared = prefix_keys(texts, text_nodes, threshold, "prefixes")
    nodes = shared.select("node").distinct()
    wanted = NodeFilter(nodes, "node")

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for values, sizes, node in text_nodes(batch):
                bounds = np.concatenate(([0], np.cumsum(sizes)))
                node, first = np.unique(node, return_index=True)
                ok = wanted.has(node)
                yield pa.RecordBatch.from_arrays([pa.array(node[ok]), pa.array([values[bounds[k] : bounds[k + 1]].tobytes() for k in first[ok]], pa.binary())], ["node", "hashes"])

    sets = written(texts.mapInArrow(pick, "node long, hashes binary").join(nodes, "node", "left_semi")
                   .groupBy("node").agg(F.min("hashes").alias("hashes")), "sets")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(k, 512) for k in range(0, batch.num_rows, 512)):
                sets = [np.frombuffer(x.as_buffer(), np.uint64) for k in (2, 3) for x in part.column(k)]
                at = np.arange(part.num_rows)
                ok = similar(np.concatenate(sets), np.array([len(x) for x in sets], np.int64), at, at + len(at), threshold)
                yield part.select([0, 1]).filter(pa.array(ok))

    def verify(pairs: DataFrame) -> DataFrame:
        return with_both(pairs, sets, "set").mapInArrow(check, "a long, b long")

    return link_groups(shared, verify, "sets", possible(threshold))


def jaccard_groups(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """row_key, doc_id, n_shingles and component (identity of the group, null if empty) of every row."""
    members = written(document_sets(docs, id_col, text_col), "document-sets")
    comp = node_components(docs, threshold, text_col).select(F.col("node").alias("c_node"), "component")
    return (members.join(comp, F.col("node") == F.col("c_node"), "left")
            .select("row_key", "doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.coalesce("component", "node")).alias("component")))


def one_of_each(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows, with their columns, that come first of their group of near copies.

    First is the smallest doc_id (nulls last); rows without words are groups of
    their own; of equal rows one stays.
    """
    rows = written(jaccard_groups(docs, threshold).where("n_shingles > 0").select("row_key", "doc_id", "component"), "jaccard-groups")
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row_key")
    first = rows.groupBy("component").agg(F.min(place).alias("first"), F.max(place).alias("final")).where("first <> final").select("component", "first")
    gone = rows.join(first, "component").where(place != F.col("first")).select(F.col("row_key").alias("__gone")).distinct()
    return (docs.withColumn("__key", _row_key()).join(written(gone, "near-copies"), F.col("__key") == F.col("__gone"), "left_anti")
            .dropDuplicates(["__key"]).drop("__key"))


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its set size and the smallest document it is linked with."""
    rows = jaccard_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    smallest = rows.where("component is not null").groupBy(F.col("component").alias("s_component")).agg(F.min("doc_id").alias("smallest"))
    return (rows.join(smallest, F.col("component") == F.col("s_component"), "left")
            .select("doc_id", "n_shingles", F.when(F.col("component").isNotNull(), F.col("smallest")).otherwise(F.col("doc_id")).alias("component_id")))
