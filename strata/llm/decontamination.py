"""Benchmark decontamination: short test items found inside long documents.

Size-partitioned MinHash containment search.  A text's set is its distinct
5-word shingles as 64-bit hashes.  Items are partitioned by the size of their
sets; an item of s shingles has its s - ceil(t*s) + 1 smallest hashes as its
MinHash sketch.  A document that holds a share t of the item holds at least
one of them, so probing every document shingle against the sketches finds all
such pairs, however long the document; documents too small for the smallest
item of a partition don't probe it.  Candidates are verified by the exact
share of the item's shingles that the document holds.

Only column functions are used.  Sketches are broadcast if their number, which
is counted first, is within a bound; else the join shuffles.

An item with fewer than five words is one shingle of all its words, and is
looked for among the documents' shingles of that many words.  Null or empty
texts and items match nothing; rows with null ids are judged like others;
repeated document rows give one row of the result; equal items are reported
each; empty tables give no rows.  Texts of any length are searched whole.
Extra columns stay in the cleaned documents and are dropped from the report;
their names clash with none of the operator's own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.store import written

WIDTH = 5
THRESHOLD = 0.75
#: Sketch rows (16 bytes each) up to which they are broadcast.
BROADCAST_ROWS = 1_000_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def word_hashes(text: Column) -> Column:
    """Hashes of the white-space separated words, A-Z lowered; null if there are none."""
    trimmed = F.regexp_replace(F.translate(text, _UPPER, _LOWER), r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+\z", "")
    return F.when(F.length(trimmed) > 0, F.transform(F.split(trimmed, r"[\x20\x09-\x0D]+"), lambda w: F.xxhash64(w)))


def shingle_hashes(words: Column, width: int) -> Column:
    """Hashes of all ``width``-word shingles of a word-hash array (none if it is shorter)."""
    n = F.size(words)
    return F.when(n >= width, F.transform(F.sequence(F.lit(1), n - (width - 1)), lambda i: F.xxhash64(F.slice(words, i, width))))


def item_shingles(items: DataFrame) -> DataFrame:
    """item_key, item_id, width, n_item and the sorted distinct shingle hashes of every item with words."""
    words = (items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
             .select(F.xxhash64("item_id", "text").alias("item_key"), "item_id", word_hashes(F.col("text")).alias("words"))
             .where(F.col("words").isNotNull()).dropDuplicates(["item_key"]))
    size = F.size("words")
    hashes = F.when(size >= WIDTH, shingle_hashes(F.col("words"), WIDTH)).otherwise(F.array(F.xxhash64("words")))
    return (words.select("item_key", "item_id", F.least(size, F.lit(WIDTH)).alias("width"), F.array_sort(F.array_distinct(hashes)).alias("hashes"))
            .withColumn("n_item", F.size("hashes")))


def _document_shingles(docs: DataFrame, widths: list[int], keep: list[str]) -> DataFrame:
    """The kept columns, width and shingle hash, a row for each shingle."""
    per_width = [F.struct(F.lit(w).alias("width"), shingle_hashes(F.col("words"), w).alias("hs")) for w in widths]
    words = docs.select(*keep, word_hashes(F.col("text")).alias("words"))
    if len(widths) == 1:
        return words.select(*keep, F.lit(widths[0]).alias("width"), F.size("words").alias("n_words"), F.explode(shingle_hashes(F.col("words"), widths[0])).alias("hash"))
    each = words.select(*keep, F.size("words").alias("n_words"), F.explode(F.array(*per_width)).alias("s"))
    return each.select(*keep, F.col("s.width").alias("width"), "n_words", F.explode("s.hs").alias("hash"))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text and a key that tells rows apart by both."""
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .withColumn("row_key", F.xxhash64("doc_id", "text")))


def contaminated_pairs(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD,
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """row_key, doc_id, item_id, n_item, n_common and containment of every pair at or above the threshold."""
    rows = _keyed(docs, id_col, text_col)
    sets = written(item_shingles(items), "items")
    needed = F.ceil(F.col("n_item") * F.lit(threshold) - F.lit(1e-9)).cast("int")
    sketches = (sets.withColumn("needed", needed)
                .select("item_key", F.col("width").alias("s_width"), F.floor(F.log2("n_item")).cast("int").alias("size_class"), "needed",
                        F.explode(F.slice("hashes", F.lit(1), F.col("n_item") - F.col("needed") + 1)).alias("sketch_hash")))
    # one entry per hash and size class, with the smallest item of the class that has it
    entries = sketches.groupBy("s_width", "size_class", "sketch_hash").agg(
        F.min("needed").alias("least"), F.collect_set("item_key").alias("item_keys"))
    stats = sets.groupBy("width").agg(F.sum("n_item").alias("n")).collect()
    widths = sorted(r["width"] for r in stats) or [WIDTH]
    small = sum(r["n"] for r in stats) <= BROADCAST_ROWS
    probe = _document_shingles(rows.select("row_key", "text"), widths, ["row_key"])
    hits = probe.join(F.broadcast(entries) if small else entries,
                      (F.col("hash") == F.col("sketch_hash")) & (F.col("width") == F.col("s_width")) & (F.col("n_words") >= F.col("least")))
    candidates = written(hits.select("row_key", F.explode("item_keys").alias("item_key")).distinct(), "candidates")
    keys = candidates.select("row_key").distinct()
    full = sets.select("item_key", "item_id", F.col("width").alias("f_width"), "n_item", F.explode("hashes").alias("f_hash"))
    chosen = rows.join(keys, "row_key", "left_semi").dropDuplicates(["row_key"])
    held = _document_shingles(chosen, widths, ["row_key", "doc_id"])
    found = (held.join(F.broadcast(full) if small else full, (F.col("hash") == F.col("f_hash")) & (F.col("width") == F.col("f_width")))
             .select("row_key", "doc_id", "item_key", "item_id", "n_item", "hash").distinct()
             .groupBy("row_key", "doc_id", "item_key", "item_id", "n_item").agg(F.count(F.lit(1)).alias("n_common")))
    # a pair outside the candidates can't reach the threshold: the join keeps the method's pairs only
    return (found.where(F.col("n_common") >= F.col("n_item") * F.lit(threshold) - F.lit(1e-9))
            .join(candidates, ["row_key", "item_key"], "left_semi")
            .select("row_key", "doc_id", "item_id", F.col("n_item").cast("long"), "n_common", (F.col("n_common") / F.col("n_item")).alias("containment")))


def decontaminate(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that hold no item, with their columns."""
    bad = written(contaminated_pairs(docs, items, threshold).select(F.col("row_key").alias("__bad_key")).distinct(), "contaminated")
    key = F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return docs.withColumn("__row_key", key).join(bad, F.col("__row_key") == F.col("__bad_key"), "left_anti").drop("__row_key")


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and benchmark item of which the document holds 75 % or more."""
    pairs = contaminated_pairs(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return pairs.select("doc_id", "item_id", "n_item", "n_common", "containment")


ORACLE_SQL = r"""
WITH w AS (
  SELECT 'd' AS kind, doc_id AS id, string_split_regex(regexp_replace(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), '[\x20\x09-\x0D]+') AS words FROM documents
  UNION ALL
  SELECT 'b', item_id, string_split_regex(regexp_replace(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), '[\x20\x09-\x0D]+') FROM benchmark
), s AS (
  SELECT DISTINCT kind, id, unnest(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i+4], ' '))) AS shingle FROM w WHERE len(words) >= 5
), n AS (SELECT id, count(*) AS n_item FROM s WHERE kind = 'b' GROUP BY id)
SELECT d.id AS doc_id, b.id AS item_id, n.n_item, count(*) AS n_common, count(*) / n.n_item AS containment
FROM s d JOIN s b ON d.shingle = b.shingle AND d.kind = 'd' AND b.kind = 'b' JOIN n ON n.id = b.id
GROUP BY d.id, b.id, n.n_item HAVING count(*) >= 0.75 * n.n_item
"""
