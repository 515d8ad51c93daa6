"""Fuzzy line dedup: one line of each component of near copies stays.

Lines are compared by the set of their character shingles (``shingle`` code
points; a shorter line is one shingle).  With 8 code points a changed character
breaks 8 shingles, so only lines from 63 characters on stay alike; with 5, lines
from 39 on do, at several times the candidates.  MinHash signatures are cut into bands
that make candidates of lines alike with high recall (0.9895 at the threshold,
rising above it); candidates are verified by the exact Jaccard index of their
shingles; links are closed by distributed union-find.  Bands that many unlike
lines share (lines around one common passage) are not compared pair by pair:
their lines meet by their rarest shingles, which no similar pair lacks.  Of each component, the
line that comes first by doc_id and line number stays and all others go; equal
lines are one node from the start.

Lines are what line feeds separate.  Lines of white space only are neither
compared nor removed.  A null text has no lines and stays null; an empty text
stays empty; a document all of whose lines go gets the empty text.  Null ids
come last in order.  Equal rows are one document: they keep the same lines.
Empty tables give no rows.  A text of any length is split whole, a line of any
length is one line.  Extra columns stay; ``n_lines`` and ``n_removed`` of the
input give way to those of the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.graph import NodeFilter, link_groups, may_have, shared_keys, with_both
from strata.llm.jaccard import checked, crowd_pairs, similar
from strata.llm.store import written
from strata.llm.text import SMALL_BATCH_BYTES, PrefixHash, is_space, mix, row_sets, text_batches

#: Code points of a shingle, if the caller says nothing else.
SHINGLE = 8
THRESHOLD = 0.75
BANDS, ROWS = 12, 4

_rng = np.random.default_rng(99)
_FACTORS = _rng.integers(1, 1 << 31, BANDS * ROWS, dtype=np.uint64).astype(np.uint32) * np.uint32(2) + np.uint32(1)
_OFFSETS = _rng.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint64).astype(np.uint32)
_CHUNK = 1 << 16


def line_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, number in the row, start and end of every line; a row of n line feeds has n + 1 lines."""
    feeds = np.flatnonzero(data == 10)
    feed_row = np.searchsorted(offsets, feeds, side="right") - 1
    start = np.concatenate([offsets[:-1], feeds + 1])
    row = np.concatenate([np.arange(len(offsets) - 1), feed_row])
    order = np.lexsort((start, row))
    start, row = start[order], row[order]
    end = np.empty_like(start)
    end[:-1] = start[1:] - 1
    last = np.ones(len(row), bool)
    last[:-1] = row[1:] != row[:-1]
    end[last] = offsets[row[last] + 1]
    number = np.arange(len(row)) - np.searchsorted(row, row)
    return row, number, start, end


def _lines(data: np.ndarray, offsets: np.ndarray) -> tuple[PrefixHash, np.ndarray, ...]:
    """Prefix hash, row, number, start, end and node of the lines that hold more than white space."""
    row, number, start, end = line_spans(data, offsets)
    ink = np.concatenate(([0], np.cumsum(~is_space(data))))
    keep = ink[end] > ink[start]
    row, number, start, end = row[keep], number[keep], start[keep], end[keep]
    hashes = PrefixHash(data)
    return hashes, row, number, start, end, hashes.slices(start, end).view(np.int64)


def band_entries(data: np.ndarray, offsets: np.ndarray, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(band key, node, 0) of the distinct lines of a byte batch that may have near copies."""
    hashes, _, _, start, end, node = _lines(data, offsets)
    node, first = np.unique(node, return_index=True)
    start, end = start[first], end[first]
    order = np.argsort(start)
    node, start, end = node[order], start[order], end[order]
    chars = np.flatnonzero((data & 0xC0) != 0x80)
    a, b = np.searchsorted(chars, start), np.searchsorted(chars, end)
    n = b - a - shingle + 1
    chars = np.concatenate([chars, [len(data)]])
    # One or two shingles have no near sets but equal ones, and another line has an equal set
    # only if the shingles' ends (one character shorter) repeat, as in rules and rows of dots.
    may = n >= 3
    short = np.flatnonzero((n == 1) | (n == 2))
    x, y, z = (hashes.slices(chars[at], chars[at + shingle - 1]) for at in (a[short], a[short] + 1, a[short] + n[short]))
    may[short] = (x == y) | (x == z) | ((y == z) & (n[short] == 2))
    node, a, n = node[may], a[may], n[may]
    if not len(node):
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.uint32)
    signature = np.empty((len(node), BANDS * ROWS), np.uint32)
    bounds = np.concatenate(([0], np.cumsum(n)))
    lo = 0
    while lo < len(node):  # runs of lines whose shingles stay in the processor's cache
        hi = max(lo + 1, int(np.searchsorted(bounds, bounds[lo] + _CHUNK, side="right")) - 1)
        size = n[lo:hi]
        first_of = bounds[lo:hi] - bounds[lo]
        at = np.arange(bounds[hi] - bounds[lo]) - np.repeat(first_of, size) + np.repeat(a[lo:hi], size)
        x = (hashes.slices(chars[at], chars[at + shingle]) >> np.uint64(32)).astype(np.uint32)
        y = np.empty_like(x)
        for k in range(BANDS * ROWS):
            np.multiply(x, _FACTORS[k], out=y)
            np.add(y, _OFFSETS[k], out=y)
            signature[lo:hi, k] = np.minimum.reduceat(y, first_of)
        lo = hi
    keys = []
    for band in range(BANDS):
        h = np.full(len(node), band + 1, np.uint64)
        for k in range(band * ROWS, (band + 1) * ROWS):
            h = mix(h * np.uint64(0x9E3779B97F4A7C15) + signature[:, k])
        keys.append(h)
    return np.concatenate(keys), np.tile(node, BANDS), np.zeros(len(node) * BANDS, np.uint32)


def line_sets(data: np.ndarray, offsets: np.ndarray, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of each line's set, ascending, and the sets' sizes; rows are lines."""
    hashes = PrefixHash(data)
    chars = np.flatnonzero((data & 0xC0) != 0x80)
    bounds = np.searchsorted(chars, offsets)
    size = np.diff(bounds)
    n = np.where(size >= shingle, size - shingle + 1, (size > 0).astype(size.dtype))
    row = np.repeat(np.arange(len(n)), n)
    at = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + bounds[row]
    ends = np.append(chars, len(data))[np.minimum(at + shingle, bounds[row + 1])]
    return row_sets(hashes.slices(chars[at], ends), n)


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string")).alias("row_key"),
                       F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def removed_lines(docs: DataFrame, threshold: float = THRESHOLD, shingle: int = SHINGLE) -> DataFrame:
    """row_key, doc_id and the numbers (from 0) of the lines that go, for documents that lose any."""
    checked(threshold)
    texts = docs.select(F.col("text").cast("string").alias("text"))

    def entries(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        for _, _, data, offsets in text_batches(batch.column(0)):
            yield band_entries(data, offsets, shingle)

    shared = shared_keys(texts, entries, "line-bands", noted=False)
    wanted = NodeFilter(shared.select("node").distinct(), "node")

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in text_batches(batch.column(0), SMALL_BATCH_BYTES):
                _, _, _, start, end, node = _lines(data, offsets)
                node, first = np.unique(node, return_index=True)
                ok = wanted.has(node)
                yield pa.RecordBatch.from_arrays([pa.array(node[ok]), pa.array([bytes(data[a:b]).decode() for a, b in zip(start[first[ok]], end[first[ok]])], pa.string())], ["node", "line"])

    lines = written(texts.mapInArrow(pick, "node long, line string").join(shared.select("node").distinct(), "node", "left_semi")
                    .groupBy("node").agg(F.min("line").alias("line")), "lines")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            _, first, at = np.unique(np.concatenate([a, b]), return_index=True, return_inverse=True)
            values, sizes = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
            for _, _, data, offsets in text_batches(pa.concat_arrays([batch.column(2), batch.column(3)]).take(pa.array(first)), SMALL_BATCH_BYTES):
                v, s = line_sets(data, offsets, shingle)
                values.append(v)
                sizes.append(s)
            yield batch.select([0, 1]).filter(pa.array(similar(np.concatenate(values), np.concatenate(sizes), at[: len(a)], at[len(a) :], threshold)))

    def verify(pairs: DataFrame) -> DataFrame:
        return with_both(pairs, lines, "line").mapInArrow(check, "a long, b long")

    def line_nodes(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        nodes, comps = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 2))
        for i, j, data, offsets in text_batches(batch.column(1), SMALL_BATCH_BYTES):
            yield *line_sets(data, offsets, shingle), nodes[i:j], comps[i:j]

    def rest(crowd: DataFrame, leaders: bool) -> DataFrame:
        """Pairs of the lines in bands that unlike lines share, as lines around one common passage do, by exact keys."""
        source = written(lines.join(crowd, "node").select("node", "line", "comp"), "line-crowd")
        return crowd_pairs(source, line_nodes, threshold, "line-crowd-pairs", leaders)

    comp = link_groups(shared, verify, "lines", rounds=2, rest=rest).select(F.col("node").alias("c_node"), "component")

    def occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in text_batches(batch.column(2), SMALL_BATCH_BYTES):
                _, row, number, _, _, node = _lines(data, offsets)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row + i)), batch.column(1).take(pa.array(row + i)), pa.array(number), pa.array(node)], ["row_key", "doc_id", "line", "node"])

    places = (_keyed(docs).mapInArrow(occurrences, "row_key long, doc_id long, line long, node long")
              .join(comp, F.col("node") == F.col("c_node"), "left")
              .select("row_key", "doc_id", "line", F.coalesce("component", "node").alias("component")))
    places = written(places, "line-places")
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row_key", "line")
    # groups of one line need no join: only components with more than one place go on
    first = places.groupBy("component").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("component", "first")
    gone = places.join(first, "component").where(place != F.col("first")).select("row_key", "doc_id", "line").distinct()
    return gone.groupBy("row_key", "doc_id").agg(F.array_sort(F.collect_list("line")).alias("gone"))


def dedup_lines(docs: DataFrame, threshold: float = THRESHOLD, shingle: int = SHINGLE) -> DataFrame:
    """The documents with their columns, ``text`` without the lines that go, plus n_lines and n_removed."""
    gone = written(removed_lines(docs, threshold, shingle), "lines-gone").select(F.col("row_key").alias("__key"), F.col("gone").alias("__gone"))
    key = F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    split = F.split(F.col("text"), "\n", -1)
    kept = F.array_join(F.filter(split, lambda line, i: ~F.array_contains(F.col("__gone"), i.cast("long"))), "\n")
    feeds = F.octet_length("text") - F.octet_length(F.replace(F.col("text"), F.lit("\n"), F.lit("")))
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("text", "n_lines", "n_removed")]

    def result(rows: DataFrame, text: Column, removed: Column) -> DataFrame:
        return rows.select(*others, text.alias("text"), F.coalesce(feeds + 1, F.lit(0)).cast("long").alias("n_lines"), removed.cast("long").alias("n_removed"))

    # texts that surely lose no line stay where they are
    marked = may_have(docs.withColumn("__k", key), "__k", gone.select("__key"))
    some = marked.where("__may").join(gone, F.col("__k") == F.col("__key"), "left")
    return (result(marked.where("not __may"), F.col("text"), F.lit(0))
            .union(result(some, F.when(F.col("__gone").isNull(), F.col("text")).otherwise(kept), F.coalesce(F.size("__gone"), F.lit(0)))))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's lines before, lines removed and digest of what stays."""
    out = dedup_lines(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))
