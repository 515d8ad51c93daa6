"""Best-fit packing of tokenised documents into fixed-size sequences.

A document becomes its token ids plus one end id; only longer ones are cut
into full-size pieces.  Bins have three capacities: tokens, documents and
attention cost (the sum of squared lengths).  All pieces of one length have
the same demand, so vector best-fit in order of decreasing length needs only
the number of pieces of each length: the plan is made from that histogram (at
most one entry per length, whatever the size of the corpus), placing runs of
equal pieces into runs of equal bins, and every piece then finds its place
from its rank among the pieces of its length.

Nulls and ties: a null text is empty and gives one piece (the end id alone);
null ids are kept; repeated rows are packed each; an empty table gives none.  A
text of any length is tokenised whole and cut into as many pieces as it needs.
Extra columns are dropped, whatever their names.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.store import partitions, written

MAX_TOKENS = 4096
#: Words whose ids a worker keeps; beyond it the memory starts anew.
MEMO_WORDS = 500_000

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_tokenizers: dict[str, WordEncoder] = {}

#: Texts without these characters fall apart into the parts below, whatever stands beside them:
#: no combining marks, no apostrophes (contractions), no special tokens.
_UNSAFE = re.compile("[^\\t\\n\\r\\x20-\\x26\\x28-\\x7eÀ-ÖØ-öø-ÿ]|<\\|")
_PARTS = re.compile("[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9\\s]+")


class WordEncoder(dict):
    """Little-endian unsigned 32-bit ids of words, each encoded once.

    For tokenizers that lower case, drop white space and merge only within
    runs of letters, single digits and runs of other characters, such as
    word_bpe_49k.json.  Keys are lower-cased parts of safe texts, or " " and a
    white-space separated piece of any other, which the whole tokenizer encodes.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        # bytes as the characters that the byte-level vocabulary uses for them
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        moved = (b for b in range(256) if b not in plain)
        self.byte_chars = {b: b for b in plain} | {b: 256 + n for n, b in enumerate(moved)}

    def __missing__(self, word: str) -> bytes:
        if len(self) >= MEMO_WORDS:
            self.clear()
        if word[0] == " ":
            ids = self.tokenizer.encode(word[1:], add_special_tokens=False).ids
        else:
            ids = [t.id for t in self.model.tokenize(word.encode().decode("latin-1").translate(self.byte_chars))]
        self[word] = out = struct.pack(f"<{len(ids)}I", *ids)
        return out

    def encode(self, text: str) -> bytes:
        get = self.__getitem__
        if not _UNSAFE.search(text):
            return b"".join(map(get, _PARTS.findall(text.lower())))
        out = []
        for piece in _BLANKS.split(text):
            if _UNSAFE.search(piece):
                out.append(get(" " + piece))
            else:
                out += map(get, _PARTS.findall(piece.lower()))
        return b"".join(out)


_BLANKS = re.compile("[ \\t\\n\\r]+")


def encoder(path: str) -> WordEncoder:
    """The encoder of a tokenizer file, once per worker."""
    if path not in _tokenizers:
        _tokenizers[path] = WordEncoder(path)
    return _tokenizers[path]


def token_pieces(docs: DataFrame, tokenizer_path: str, max_tokens: int = MAX_TOKENS, end_id: int = 1,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, crc32 of its ids."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = struct.pack("<I", end_id)
        encode = encoder(tokenizer_path).encode
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encode(text.as_py() or "") + end
                n = len(ids) // 4
                for k, a in enumerate(range(0, n, max_tokens)):
                    b = min(n, a + max_tokens)
                    rows.append((doc, k, a, b - a, zlib.crc32(ids[4 * a : 4 * b])))
            columns = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(pieces, _PIECES)


def best_fit_plan(histogram: dict[int, int], max_tokens: int = MAX_TOKENS, max_docs: int | None = None,
                  max_cost: int | None = None, rule: str = "norm",
                  weights: tuple[float, float, float] = (1.0, 1.0, 1.0)) -> tuple[list[tuple], int]:
    """Vector best-fit over a histogram of piece lengths.

    Returns segments (length, first rank, last rank + 1, first bin, pieces per
    bin, first offset) and the number of bins.  A bin is open to a piece if
    tokens, documents and cost all fit; among the open ones ``rule`` "norm"
    takes the smallest weighted residual after placing, "dot" the largest
    weighted product of demand and residual (then the smaller residual).
    Capacities left out are those that max_tokens implies.
    """
    if rule not in ("norm", "dot"):
        raise ValueError("rule must be 'norm' or 'dot'")
    cap = np.array([max_tokens, max_docs or max_tokens, max_cost or max_tokens**2], np.float64)
    w = np.array(weights, np.float64)
    lengths = sorted((n for n in histogram if histogram[n] > 0), reverse=True)
    if lengths and (lengths[0] > cap[0] or float(lengths[0]) ** 2 > cap[2]):
        raise ValueError(f"a piece of {lengths[0]} tokens is larger than a bin")
    # runs of equal bins: residuals, first bin, number of bins, tokens used
    residual = np.zeros((0, 3))
    runs: list[tuple[int, int, int]] = []
    segments: list[tuple] = []
    bins = 0
    for length in lengths:
        todo, rank = histogram[length], 0
        demand = np.array([length, 1.0, float(length) ** 2])
        alive = np.flatnonzero((residual[:, 0] >= lengths[-1]) & (residual[:, 1] >= 1)) if len(runs) else []
        residual, runs = residual[alive], [runs[i] for i in alive]
        while todo:
            left = (residual - demand) / cap
            open_runs = np.flatnonzero((left >= 0).all(axis=1)) if len(runs) else []
            if len(open_runs):
                norm = (w * left[open_runs] ** 2).sum(axis=1)
                if rule == "norm":
                    best = open_runs[int(np.argmin(norm))]
                else:
                    dot = (w * (residual[open_runs] / cap) * (demand / cap)).sum(axis=1)
                    best = open_runs[int(np.lexsort((norm, -dot))[0])]
                r, (first, count, used) = residual[best], runs[best]
                residual = np.delete(residual, best, axis=0)
                runs.pop(best)
            else:
                per = int((cap // demand).min())
                r, first, used = cap, bins, 0
                count = -(-todo // per)
                bins += count
            per = int((r // demand).min())
            full = min(count, todo // per)
            new = []
            if full:
                segments.append((length, rank, rank + full * per, first, per, used))
                new.append((r - per * demand, first, full, used + per * length))
                rank, todo = rank + full * per, todo - full * per
            rest = 0
            if todo and full < count:  # one more bin takes what is left
                segments.append((length, rank, rank + todo, first + full, per, used))
                new.append((r - todo * demand, first + full, 1, used + todo * length))
                rank, todo, rest = rank + todo, 0, 1
            if count - full - rest:
                new.append((r, first + full + rest, count - full - rest, used))
            residual = np.vstack([residual, *[x[0][None] for x in new]])
            runs += [x[1:] for x in new]
    return segments, bins


def _ranked(pieces: DataFrame, parts: int) -> DataFrame:
    """Rank of each piece among those of its length, without one task per length.

    Pieces of a length are dealt by hash into parts; a part's first rank is the
    number of pieces in the parts before it.
    """
    part: Column = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(parts)).cast("int")
    dealt = pieces.withColumn("part", part)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = (dealt.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
              .select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first_rank")))
    inside = Window.partitionBy("length", "part").orderBy("doc_id", "piece", "start", "ids_crc32")
    return (dealt.withColumn("at", F.row_number().over(inside) - 1)
            .join(counts, ["length", "part"])
            .withColumn("rank", F.col("first_rank") + F.col("at")).drop("part", "at", "first_rank"))


def pack(pieces: DataFrame, max_tokens: int = MAX_TOKENS, max_docs: int | None = None,
         max_cost: int | None = None, rule: str = "norm") -> DataFrame:
    """Adds sequence_id and offset to the rows of a written table of pieces.

    The driver sees the histogram of lengths (at most ``max_tokens`` rows) and
    sends back the plan, whose size depends on the lengths alone.
    """
    spark = pieces.sparkSession
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    segments, _ = best_fit_plan(histogram, max_tokens, max_docs, max_cost, rule)
    plan = spark.createDataFrame(segments, "length long, lo long, hi long, first_bin long, per long, first_offset long")
    step = F.col("rank") - F.col("lo")
    return (_ranked(pieces, 4 * partitions(spark))
            .join(F.broadcast(plan.withColumnRenamed("length", "p_length")),
                  (F.col("length") == F.col("p_length")) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")))
            .select("doc_id", "piece", "start", "length", "ids_crc32",
                    (F.col("first_bin") + F.floor(step / F.col("per"))).cast("long").alias("sequence_id"),
                    (F.col("first_offset") + F.pmod(step, F.col("per")) * F.col("length")).cast("long").alias("offset")))


def pack_documents(docs: DataFrame, tokenizer_path: str, max_tokens: int = MAX_TOKENS, end_id: int = 1,
                   max_docs: int | None = None, max_cost: int | None = None, rule: str = "norm") -> DataFrame:
    """Tokenise, cut and pack: one row per piece with its sequence and offset."""
    pieces = written(token_pieces(docs, tokenizer_path, max_tokens, end_id), "pieces")
    return pack(pieces, max_tokens, max_docs, max_cost, rule)


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 4096 tokens."""
    import public_tokenizers

    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"),
                          public_tokenizers.path("word_bpe_49k.json"))
