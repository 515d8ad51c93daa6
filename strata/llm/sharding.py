"""Uniform shuffle into shards of exact sizes, with column functions only.

Rows are dealt by a hash into blocks.  How many rows of block i go to shard j
is drawn exactly: row by row of the communication matrix from the multivariate
hypergeometric law, given the block sizes and the shard sizes.  Each block
permutes its rows (order of a keyed hash) and sends its first n[i,0] to shard
0, the next n[i,1] to shard 1 and so on; each shard permutes what it received.
The composition is a uniformly drawn assignment, and shard sizes differ by one
row at most whatever the data.

Only block and cell counts reach the driver: ``blocks`` numbers, fixed by a
parameter.  Null ids and texts are kept (null text: size 8, crc32 of the empty
string); repeated rows are separate rows and tied ones are interchangeable; an
empty table gives no rows; texts are read for their size and checksum only,
whatever their length; extra columns are dropped, whatever their names.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SHARDS = 24
BLOCKS = 1024
SEED = 7


def communication_matrix(rows: list[int], shards: int, seed: int) -> np.ndarray:
    """Rows of each block that go to each shard, drawn exactly."""
    total = sum(rows)
    left = np.full(shards, total // shards, np.int64)
    left[: total % shards] += 1
    rng = np.random.default_rng(seed)
    out = np.zeros((len(rows), shards), np.int64)
    for i, n in enumerate(rows):
        # one hypergeometric draw per shard: exact also where counts are large
        pool, need = int(left.sum()), int(n)
        for j in range(shards):
            have = int(left[j])
            pool -= have
            k = need if pool == 0 else _draw(rng, have, pool, need)
            out[i, j], need = k, need - k
        left -= out[i]
    return out


def _draw(rng: np.random.Generator, good: int, bad: int, sample: int) -> int:
    """Hypergeometric draw of any size: the law's distribution function, inverted.

    Probabilities follow from the mode by the exact ratios of neighbours, so
    there are no large factorials to cancel; they are summed over twelve
    standard deviations and more, beyond which less lies than a double tells
    from nothing.
    """
    low, high = max(0, sample - bad), min(good, sample)
    total = good + bad
    if low == high:
        return low
    mode = min(high, max(low, (good + 1) * (sample + 1) // (total + 2)))
    spread = (sample * (good / total) * (bad / total) * ((total - sample) / max(1, total - 1))) ** 0.5
    reach = int(13 * spread) + 60
    first, last = max(low, mode - reach), min(high, mode + reach)
    k = np.arange(first, last, dtype=np.float64)
    # log of P(k + 1) / P(k)
    step = np.log((good - k) / (k + 1)) + np.log((sample - k) / (bad - sample + k + 1))
    log = np.concatenate(([0.0], np.cumsum(step)))
    weight = np.cumsum(np.exp(log - log[mode - first]))
    return first + int(np.searchsorted(weight, rng.random() * weight[-1], side="right"))


def shuffle_into_shards(docs: DataFrame, shards: int = SHARDS, blocks: int = BLOCKS, seed: int = SEED,
                        id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       (F.octet_length(text) + F.lit(8)).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"))
    # repeated rows meet in a block whatever its key; the text's hash spreads equal ids
    key = F.xxhash64(F.lit(seed), "doc_id", "text_crc32")
    keyed = rows.withColumn("block", F.pmod(key, F.lit(blocks)).cast("int"))
    counts = {r["block"]: r["n"] for r in keyed.groupBy("block").agg(F.count(F.lit(1)).alias("n")).collect()}
    matrix = communication_matrix([counts.get(i, 0) for i in range(blocks)], shards, seed)
    # cells: ranks [lo, hi) of block i go to shard j, at slots from first_slot on of the
    # shard's sub-shard; shards are permuted in as many parts as there are blocks
    ends = np.cumsum(matrix, axis=1)
    cells = [(i, j, int(ends[i, j] - matrix[i, j]), int(ends[i, j]))
             for i in range(blocks) for j in range(shards) if matrix[i, j]]
    sent = spark.createDataFrame(cells, "c_block int, shard int, lo long, hi long")
    inside = Window.partitionBy("block").orderBy(F.xxhash64(F.lit(seed + 1), "doc_id", "text_crc32"), "doc_id", "text_crc32", "size")
    ranked = keyed.withColumn("rank", F.row_number().over(inside) - 1)
    exchanged = (ranked.join(F.broadcast(sent), (F.col("block") == F.col("c_block")) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")))
                 .select("doc_id", "size", "text_crc32", "shard", "block", "rank"))
    # second permutation: a shard's rows are dealt into parts by another hash (parts in
    # order), and permuted within each part, so that no task holds a whole shard
    parts = max(1, blocks // shards)
    dealt = exchanged.withColumn("part", F.pmod(F.xxhash64(F.lit(seed + 2), "block", "rank"), F.lit(parts)).cast("int"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = (dealt.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
             .select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first_slot")))
    within = Window.partitionBy("shard", "part").orderBy(F.xxhash64(F.lit(seed + 3), "block", "rank"), "block", "rank")
    return (dealt.withColumn("at", F.row_number().over(within) - 1)
            .join(F.broadcast(first), ["shard", "part"])
            .select("doc_id", "size", "text_crc32", "shard", (F.col("first_slot") + F.col("at")).cast("long").alias("slot")))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards whose row counts are at most one apart."""
    placed = shuffle_into_shards(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))
