"""Removal of repeated passages by longest-previous-factor arrays.

A byte goes if a string of WIDTH bytes that covers it also starts in a
document with a smaller id.  In suffix order, the nearest suffixes on either
side that belong to smaller documents (previous and next smaller values) are
the longest earlier matches of a suffix; where that longest previous factor
reaches WIDTH, the string goes.

No suffix array of the whole corpus is built.  Every string of WIDTH bytes is
assigned to its minimizer, the GRAM-byte piece in it with the smallest hash,
so equal strings have equal minimizers at equal places.

1. Minimizers of all documents meet by hash as packed 64-bit entries; what no
   other document has goes no further.
2. Documents with shared minimizers send each one's context, the bytes of the
   strings assigned to it, to the minimizer's bucket (contexts that a batch
   holds several times go once).  A minimizer that very many documents have is
   split: its strings go to buckets by their own hash.
3. A bucket sorts the suffixes that start its strings, up to the ends of their
   contexts, with the bytes that neighbours share; previous and next smaller
   documents give every suffix the length of its longest previous factor, and
   where it reaches WIDTH the string goes.

Equal texts are one text from the start; its first document stands for it.

A null text is empty.  Null ids come after all others and are equal to each
other; repeated rows are equal too, so neither removes the other.  Texts
shorter than WIDTH bytes lose nothing.  An empty table gives no rows.  A text of
any length is cut whole; a task holds a batch's texts, so the longest one bounds
it.  Extra columns are dropped, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.store import partitions, written
from strata.llm.text import PrefixHash, text_batches

WIDTH = 50
GRAM = 20
#: Documents with a minimizer from which its strings are dealt by their own hash.
SPLIT_FROM = 2000
#: Strings that a bucket sorts at once.
SORT_ROWS = 250_000

_LAST_ID = (1 << 63) - 1
_CONTEXT = np.dtype([("row", "<i8"), ("doc", "<i8"), ("pos", "<u4"), ("sub", "<u2"), ("n", "u1")])
_SPAN = np.dtype([("row", "<i8"), ("start", "<i8"), ("end", "<i8")])


def window_minimizers(gram_hash: np.ndarray, width: int, gram: int) -> np.ndarray:
    """Place of the smallest gram hash (the leftmost of equals) in every window, by its start."""
    span = width - gram + 1
    low, at = gram_hash, np.arange(len(gram_hash), dtype=np.int32 if len(gram_hash) < 1 << 31 else np.int64)
    have = 1
    while have < span:
        step = min(have, span - have)
        later = low[step:] < low[:-step]
        at = np.where(later, at[step:], at[:-step])
        low = np.where(later, low[step:], low[:-step])
        have += step
    return at


def anchors(data: np.ndarray, offsets: np.ndarray, width: int = WIDTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Row, key (48 bits), first window and number of windows of every minimizer, and the prefix hash."""
    hashes = PrefixHash(data)
    grams = hashes.rolling(gram) if len(data) >= width else np.empty(0, np.uint64)
    n = np.maximum(0, np.diff(offsets) - width + 1)
    row = np.repeat(np.arange(len(n)), n)
    if not len(row):
        none = np.empty(0, np.int64)
        return none, none.astype(np.uint64), none, none, hashes
    start = np.arange(len(row)) + np.repeat(offsets[:-1] - np.concatenate(([0], np.cumsum(n)))[:-1], n)
    at = window_minimizers(grams, width, gram)[start]
    fresh = np.ones(len(at), bool)
    fresh[1:] = at[1:] != at[:-1]
    first = np.flatnonzero(fresh)
    count = np.diff(np.concatenate([first, [len(at)]]))
    return row[first], grams[at[first]] >> np.uint64(16), start[first], count, hashes


def suffix_array(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes data[start:end] in order, and how many bytes each shares with the one before it.

    A suffix ends with its context, so all bytes are compared.
    """
    size = ends - starts
    span = int(size.max())
    short = int(starts.max()) + span - len(data)
    if short > 0:
        data = np.concatenate([data, np.zeros(short, np.uint8)])
    heads = np.lib.stride_tricks.sliding_window_view(data, span)[starts]
    heads[np.arange(span) >= size[:, None]] = 0
    order = np.argsort(size, kind="stable")  # of suffixes alike up to zero bytes the shorter comes first
    order = order[np.argsort(heads[order].view(f"S{span}").ravel(), kind="stable")]
    heads, size = heads[order], size[order]
    differ = heads[1:] != heads[:-1]
    lcp = np.zeros(len(order), np.int64)
    first = differ.argmax(axis=1)
    first[~differ[np.arange(len(first)), first]] = span
    lcp[1:] = np.minimum(first, np.minimum(size[1:], size[:-1]))
    return order, lcp


def previous_smaller(values: np.ndarray, joined: np.ndarray, lcp: np.ndarray | None = None):
    """Place of the nearest earlier smaller value, -1 if none; joined[i] says that i still goes with i - 1.

    With ``lcp`` also the least of it between the two, from behind the earlier
    one up to i itself.
    """
    n = len(values)
    group = np.cumsum(~joined)
    at = np.arange(-1, n - 1)
    at[~joined] = -1
    low = None if lcp is None else lcp.copy()
    while True:
        look = np.flatnonzero(at >= 0)
        look = look[values[at[look]] >= values[look]]
        if not len(look):
            return at if low is None else (at, low)
        over = at[look]
        if low is not None:
            low[look] = np.minimum(low[look], low[over])
        up = at[over]
        at[look] = np.where((up >= 0) & (group[up] == group[look]), up, -1)


def nearest_smaller(values: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    """Bytes shared with the nearest earlier smaller value's suffix, 0 if there is none.

    ``lcp[i]`` is what suffix i shares with the one before it; what two suffixes
    share is the least of those between them.
    """
    joined = np.ones(len(values), bool)
    joined[:1] = False
    at, low = previous_smaller(values, joined, lcp)
    return np.where(at >= 0, low, 0)


def longest_previous_factors(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """For each suffix data[start:end] the most bytes of its begin that a suffix of a smaller document begins with.

    In suffix order the longest match with a smaller document is that with the
    previous or that with the next smaller one.
    """
    out = np.zeros(len(starts), np.int64)
    if not len(starts):
        return out
    order, lcp = suffix_array(data, starts, ends)
    d = docs[order]
    before = nearest_smaller(d, lcp)
    after = nearest_smaller(d[::-1], np.concatenate(([0], lcp[1:][::-1])))[::-1]
    out[order] = np.maximum(before, after)
    return out


def repeated_windows(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, docs: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """Which of the strings data[start:start + width] also start in a smaller document: previous factors reach ``width``."""
    return longest_previous_factors(data, starts, ends, docs) >= width


def _first_of_equal(own: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For equal values of ``own``: which belong to a later document than the first, and one entry for each of the first's."""
    order = np.lexsort((docs, own))
    lead = np.ones(len(order), bool)
    lead[1:] = own[order][1:] != own[order][:-1]
    least = docs[order][lead][np.cumsum(lead) - 1]
    later = np.zeros(len(order), bool)
    later[order] = docs[order] > least
    return later, ~later


def _packed(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def _unpacked(data: bytes) -> bytes:
    return pa.decompress(data[8:], decompressed_size=int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return (docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST_ID)).alias("doc"), F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
            .withColumn("row_key", F.xxhash64("doc", "text")))


def _shared_anchors(rows: DataFrame, width: int, gram: int, split_from: int) -> DataFrame:
    """row_key, its minimizer keys that other documents have, and those to be split."""
    buckets = 2 * partitions(rows.sparkSession)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        number = (task.partitionId() if task else 0) << 32
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            for i, j, data, offsets in text_batches(batch.column(1)):
                row, key, _, _, _ = anchors(data, offsets, width, gram)
                entries = np.unique((key << np.uint64(16)) | row.astype(np.uint64))
                bucket = ((entries >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)
                at = np.argsort(bucket, kind="stable")
                entries, bucket = entries[at], bucket[at]
                ids, first = np.unique(bucket, return_index=True)
                blobs = [entries[a:b].tobytes() for a, b in zip(first, [*first[1:], len(entries)])]
                n = len(ids)
                # the rows of this piece of a batch go along once, to meet the answers
                yield pa.RecordBatch.from_arrays([
                    pa.array([*ids, number % buckets], pa.int32()), pa.array([number] * (n + 1), pa.int64()),
                    pa.array([*blobs, None], pa.binary()), pa.array([None] * n + [keys[i:j].tobytes()], pa.binary())], ["bucket", "piece", "entries", "rows"])
                number += 1

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, pieces = [], []
        for batch in batches:
            plain = pa.compute.is_valid(batch.column("rows"))
            names = batch.filter(plain)
            yield pa.RecordBatch.from_arrays([names.column("piece"), pa.nulls(len(names), pa.binary()), pa.nulls(len(names), pa.binary()), names.column("rows")], ["piece", "keys", "split", "rows"])
            found = batch.filter(pa.compute.invert(plain))
            parts += [np.frombuffer(b.as_buffer(), np.uint64) for b in found.column("entries")]
            pieces += found.column("piece").to_pylist()
        if not parts:
            return
        source = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        entries = np.concatenate(parts)
        parts.clear()
        order = np.argsort(entries, kind="stable")
        key = entries[order] >> np.uint64(16)
        lead = np.ones(len(key) + 1, bool)
        lead[1:-1] = key[1:] != key[:-1]
        first = np.flatnonzero(lead[:-1])
        count = np.repeat(np.diff(np.append(first, len(key))), np.diff(np.append(first, len(key))))
        order, count = order[count > 1], count[count > 1]
        back = np.argsort(source[order], kind="stable")
        order, count = order[back], count[back]
        ids, first = np.unique(source[order], return_index=True)
        none = np.empty(0, np.uint64)
        keys, split = [], []
        for a, b in zip(first, [*first[1:], len(order)]):
            e, many = entries[order[a:b]], count[a:b] >= split_from
            keys.append(e[~many].tobytes())
            split.append(e[many].tobytes() if many.any() else none.tobytes())
        yield pa.RecordBatch.from_arrays([pa.array([pieces[k] for k in ids], pa.int64()), pa.array(keys, pa.binary()), pa.array(split, pa.binary()), pa.nulls(len(ids), pa.binary())], ["piece", "keys", "split", "rows"])

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: dict[int, list] = {}
        rows_of: dict[int, np.ndarray] = {}
        for batch in batches:
            for piece, k, s, r in zip(*(batch.column(c) for c in range(4))):
                piece = piece.as_py()
                if r.is_valid:
                    rows_of[piece] = np.frombuffer(r.as_py(), np.int64)
                else:
                    keys.setdefault(piece, []).append((k.as_py(), s.as_py()))
        for piece, found in keys.items():
            blobs = []
            for part in (0, 1):
                e = np.frombuffer(b"".join(f[part] for f in found), np.uint64)
                row, key = (e & np.uint64(0xFFFF)).astype(np.int64), e >> np.uint64(16)
                order = np.lexsort((key, row))
                blobs.append((row[order], key[order]))
            rows = np.unique(np.concatenate([blobs[0][0], blobs[1][0]]))
            cut = [[blobs[p][1][np.searchsorted(blobs[p][0], r) : np.searchsorted(blobs[p][0], r, side="right")].tobytes() for r in rows] for p in (0, 1)]
            yield pa.RecordBatch.from_arrays([pa.array(rows_of[piece][rows]), pa.array(cut[0], pa.binary()), pa.array(cut[1], pa.binary())], ["row_key", "keys", "split"])

    met = (rows.select("row_key", "text").mapInArrow(emit, "bucket int, piece long, entries binary, rows binary")
           .repartitionById(buckets, F.col("bucket")).mapInArrow(meet, "piece long, keys binary, split binary, rows binary"))
    home = F.pmod(F.xxhash64("piece"), F.lit(buckets)).cast("int")
    return met.repartitionById(buckets, home).mapInArrow(answer, "row_key long, keys binary, split binary")


def _spans(chosen: DataFrame, width: int, gram: int) -> DataFrame:
    """row_key and its removed byte spans (merged, as packed pairs) for rows with row_key, doc, text, keys, split."""
    buckets = 2 * partitions(chosen.sparkSession)
    schema = "bucket int, meta binary, data binary, spans binary"

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row_keys, doc_ids = (batch.column(c).to_numpy(zero_copy_only=False) for c in (0, 1))
            for i, j, data, offsets in text_batches(batch.column(2)):
                row, key, first, count, hashes = anchors(data, offsets, width, gram)
                entry = (key << np.uint64(16)) | row.astype(np.uint64)
                take = np.zeros(len(row), np.int8)
                for mark, column in ((1, 3), (2, 4)):
                    blobs = [b.as_py() or b"" for b in batch.column(column).slice(i, j - i)]
                    known = np.frombuffer(b"".join(blobs), np.uint64)
                    of = np.repeat(np.arange(j - i, dtype=np.uint64), [len(b) // 8 for b in blobs])
                    known = np.sort((known << np.uint64(16)) | of)
                    if len(known):
                        at = np.minimum(np.searchsorted(known, entry), len(known) - 1)
                        take[known[at] == entry] = mark
                one, split = take == 1, np.flatnonzero(take == 2)
                # split minimizers send every string alone
                k = count[split]
                start = np.concatenate([first[one], np.repeat(first[split], k) + np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)])
                size = np.concatenate([count[one], np.ones(k.sum(), count.dtype)])
                of_row = np.concatenate([row[one], np.repeat(row[split], k)])
                end = start + size + width - 1
                own = hashes.slices(start, end)
                group = np.concatenate([key[one], own[int(one.sum()) :] >> np.uint64(16)])
                meta = np.empty(len(start), _CONTEXT)
                meta["row"], meta["doc"] = row_keys[i:j][of_row], doc_ids[i:j][of_row]
                meta["pos"], meta["n"] = start - offsets[of_row], size
                meta["sub"] = (group >> np.uint64(8)) & np.uint64(0xFFFF)
                # equal contexts of a batch: those of later documents go at once, the first one's is asked for
                later, asked = _first_of_equal(own, meta["doc"])
                gone = np.empty(int(later.sum()), _SPAN)
                gone["row"], gone["start"] = meta["row"][later], meta["pos"][later]
                gone["end"] = gone["start"] + size[later] + width - 1
                ask = np.flatnonzero(asked)
                bucket = ((group[ask] >> np.uint64(24)) % np.uint64(buckets)).astype(np.int64)
                at = np.argsort(bucket, kind="stable")
                ask, bucket = ask[at], bucket[at]
                ids, f = np.unique(bucket, return_index=True)
                metas, datas = [], []
                for a, b in zip(f, [*f[1:], len(ask)]):
                    part = ask[a:b]
                    metas.append(_packed(meta[part].tobytes()))
                    datas.append(_packed(b"".join([data[x:y].tobytes() for x, y in zip(start[part].tolist(), end[part].tolist())])))
                n = len(ids)
                yield pa.RecordBatch.from_arrays([
                    pa.array([*ids, int(row_keys[i]) % buckets], pa.int32()), pa.array([*metas, None], pa.binary()), pa.array([*datas, None], pa.binary()),
                    pa.array([None] * n + [gone.tobytes()], pa.binary())], ["bucket", "meta", "data", "spans"])

    def homes(spans: np.ndarray) -> pa.RecordBatch:
        home = spans["row"] % buckets
        at = np.argsort(home, kind="stable")
        spans, home = spans[at], home[at]
        ids, first = np.unique(home, return_index=True)
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array([spans[a:b].tobytes() for a, b in zip(first, [*first[1:], len(spans)])], pa.binary())], ["home", "spans"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        metas, datas = [], []
        for batch in batches:
            for m, d, s in zip(*(batch.column(c) for c in (1, 2, 3))):
                if s.is_valid:
                    yield homes(np.frombuffer(s.as_py(), _SPAN))
                else:
                    metas.append(np.frombuffer(_unpacked(m.as_py()), _CONTEXT))
                    datas.append(np.frombuffer(_unpacked(d.as_py()), np.uint8))
        if not metas:
            return
        meta, data = np.concatenate(metas), np.concatenate(datas)
        metas.clear()
        datas.clear()
        length = meta["n"].astype(np.int64) + width - 1
        begin = np.cumsum(length) - length
        own = np.empty(len(meta), np.uint64)
        for a in range(0, len(meta), 10_000):
            b = min(len(meta), a + 10_000)
            lo = begin[a]
            own[a:b] = PrefixHash(data[lo : begin[b - 1] + length[b - 1]]).slices(begin[a:b] - lo, begin[a:b] - lo + length[a:b])
        # what several batches hold as a whole goes without sorting
        later, asked = _first_of_equal(own, meta["doc"])
        whole = np.empty(int(later.sum()), _SPAN)
        whole["row"], whole["start"] = meta["row"][later], meta["pos"][later]
        whole["end"] = whole["start"] + length[later]
        if len(whole):
            yield homes(whole)
        order = np.flatnonzero(asked)
        order = order[np.argsort(meta["sub"][order], kind="stable")]
        total = np.cumsum(meta["n"][order].astype(np.int64))
        sub = meta["sub"][order]
        a = 0
        while a < len(order):  # whole groups of about SORT_ROWS strings
            b = int(np.searchsorted(total, (total[a - 1] if a else 0) + SORT_ROWS, side="right"))
            b = max(b, a + 1)
            b = int(np.searchsorted(sub, sub[b - 1], side="right"))
            part = order[a:b]
            n = meta["n"][part].astype(np.int64)
            context = np.repeat(np.arange(len(part)), n)
            inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            stop = (begin[part] + length[part])[context]
            hit = repeated_windows(data, begin[part][context] + inside, stop, meta["doc"][part][context], width)
            # runs of removed strings within a context are one span
            runs = hit.copy()
            runs[1:] &= ~(hit[:-1] & (context[1:] == context[:-1]))
            ends = hit.copy()
            ends[:-1] &= ~(hit[1:] & (context[1:] == context[:-1]))
            f, e = np.flatnonzero(runs), np.flatnonzero(ends)
            spans = np.empty(len(f), _SPAN)
            of = part[context[f]]
            spans["row"], spans["start"] = meta["row"][of], meta["pos"][of] + inside[f]
            spans["end"] = meta["pos"][of] + inside[e] + width
            yield homes(spans)
            a = b

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [np.frombuffer(s.as_py(), _SPAN) for batch in batches for s in batch.column(1)]
        if not parts:
            return
        spans = np.concatenate(parts)
        parts.clear()
        spans = spans[np.lexsort((spans["start"], spans["row"]))]
        rows, first = np.unique(spans["row"], return_index=True)
        out = []
        for a, b in zip(first, [*first[1:], len(spans)]):
            s, e = spans["start"][a:b], np.maximum.accumulate(spans["end"][a:b])
            fresh = np.ones(len(s), bool)
            fresh[1:] = s[1:] > e[:-1]
            last = np.append(np.flatnonzero(fresh)[1:], len(s)) - 1
            out.append(np.stack([s[fresh], e[last]], axis=1).astype("<i8").tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array(out, pa.binary())], ["row_key", "spans"])

    return (chosen.select("row_key", "doc", "text", "keys", "split").mapInArrow(emit, schema).repartitionById(buckets, F.col("bucket"))
            .mapInArrow(meet, "home int, spans binary").repartitionById(buckets, F.col("home")).mapInArrow(merge, "row_key long, spans binary"))


def remove_repeats(docs: DataFrame, width: int = WIDTH, gram: int = GRAM, split_from: int = SPLIT_FROM,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (the remaining bytes, null if all or none go) and kept_sha256 of every row."""
    rows = _keyed(docs, id_col, text_col)
    found = written(_shared_anchors(rows, width, gram, split_from), "anchors")
    facts = written(rows.select("row_key", "doc", "doc_id", F.octet_length("text").cast("long").alias("n_bytes"),
                                F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2"),
                                F.sha2(F.col("text").cast("binary"), 256).alias("whole")), "facts")
    # one document stands for all with its text
    first = facts.groupBy("h1", "h2").agg(F.min(F.struct("doc", "row_key")).alias("f")).select(
        F.col("h1").alias("f1"), F.col("h2").alias("f2"), F.col("f.doc").alias("first_doc"), F.col("f.row_key").alias("first_key"))
    # one exchange of the texts by row serves both joins: contexts go out from it and spans come back to it
    texts = rows.select("row_key", "doc", "text").repartition("row_key")
    wanted = written(found.join(first.select(F.col("first_key").alias("w_key")), F.col("row_key") == F.col("w_key"), "left_semi")
                     .toDF("w_key", "keys", "split"), "wanted")
    chosen = texts.join(wanted, F.col("row_key") == F.col("w_key"))
    spans = _spans(chosen, width, gram).select(F.col("row_key").alias("s_key"), "spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, pieces, kept, digest = [], [], [], []
            for text, s in zip(batch.column(1), batch.column(2)):
                data, at, left = text.as_py().encode(), 0, []
                pairs = np.frombuffer(s.as_py(), "<i8").reshape(-1, 2).tolist()
                for a, b in pairs:
                    left.append(data[at:a])
                    at = b
                rest = b"".join([*left, data[at:]])
                removed.append(len(data) - len(rest))
                pieces.append(len(pairs))
                kept.append(rest)
                digest.append(hashlib.sha256(rest).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(removed, pa.int64()), pa.array(pieces, pa.int64()), pa.array(kept, pa.binary()), pa.array(digest, pa.string())], ["c_key", "removed", "pieces", "kept", "digest"])

    cuts = (texts.join(spans, F.col("row_key") == F.col("s_key")).select("row_key", "text", "spans", "doc")  # doc too: the exchange is the same
            .mapInArrow(cut, "c_key long, removed long, pieces long, kept binary, digest string").dropDuplicates(["c_key"]))
    copy = (F.col("doc") > F.col("first_doc")) & (F.col("n_bytes") >= width)
    empty = hashlib.sha256(b"").hexdigest()
    return (facts.join(first, (F.col("h1") == F.col("f1")) & (F.col("h2") == F.col("f2"))).join(cuts, F.col("row_key") == F.col("c_key"), "left")
            .select("doc_id", "n_bytes",
                    F.when(copy, F.col("n_bytes")).otherwise(F.coalesce("removed", F.lit(0))).cast("long").alias("n_removed"),
                    F.when(copy, 1).otherwise(F.coalesce("pieces", F.lit(0))).cast("long").alias("n_spans"),
                    F.when(~copy, F.col("kept")).alias("kept"),
                    F.when(copy, F.lit(empty)).otherwise(F.coalesce("digest", "whole")).alias("kept_sha256")))


def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What goes from every document as a repeat of 50 bytes or more of an earlier one."""
    out = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
