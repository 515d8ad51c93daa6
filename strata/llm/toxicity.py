"""Toxicity scores from a bidirectional gated recurrent network in numpy.

Input of a step is a word's vector (words of the training sample, one vector
for all others) beside the mean vector of its character trigrams.  A GRU reads
each window of words forwards and backwards, attention pools the states, and a
logistic unit gives the window's score.  A document is scored by the largest
logit over all its overlapping windows, calibrated on training rows set aside.

The network is fitted on a bounded sample of the labelled rows (``sample``
documents, up to ``windows_per_doc`` windows of each); every window of every
whole text is scored.  Labels come only from rows whose crc32(doc_id as text)
mod 5 is not 0.

Null and empty texts are one window without words; null ids are kept; repeated
rows are scored each; extra columns play no part, whatever their names; an empty
table gives no rows; a text of any length is scored whole, in pieces of memory
that its longest text bounds; without labelled rows of both classes every score
is the share of toxic labels (0 if there are none).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.store import hashed_sample
from strata.llm.text import SMALL_BATCH_BYTES, PrefixHash, lower_ascii, text_batches

WINDOW = 64
#: Words from window to window, of those that are learnt from and of those that are scored: a passage
#: of up to WINDOW - SCORE_STRIDE + 1 words lies whole in a scored window.
STRIDE = 48
SCORE_STRIDE = 24
SAMPLE = 4000
WINDOWS_PER_DOC = 12
WORD_DIM, CHAR_DIM, HIDDEN, ATT = 10, 6, 8, 8
TRIGRAMS = 4096
MIN_DOCS = 4
EPOCHS = 6
#: Small samples are passed over more often, up to about so many batches.
LEAST_BATCHES = 900

_LETTER = np.zeros(256, bool)
_LETTER[48:58] = _LETTER[97:123] = _LETTER[128:] = True


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of runs of letters and digits in lower-cased bytes; words by row."""
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = _LETTER[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    filled = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[filled] = inside[filled]
    start = np.flatnonzero(begins)
    ends = inside[:-1] & ~inside[1:]
    last = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    ends[last] = inside[last]
    return start, np.flatnonzero(ends) + 1, np.diff(np.searchsorted(start, offsets))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return np.float32(0.5) * (np.tanh(np.float32(0.5) * x) + np.float32(1))


class Words:
    """The distinct words of a batch: hashes and character trigram buckets."""

    def __init__(self, data: np.ndarray, start: np.ndarray, end: np.ndarray):
        hashes = PrefixHash(data).slices(start, end)
        self.hash, first, self.index = np.unique(hashes, return_index=True, return_inverse=True)
        s, e = start[first], end[first]
        size = e - s
        self.count = size  # a word of n bytes has n trigrams, counting its borders
        self.bounds = np.concatenate(([0], np.cumsum(size)))
        at = np.arange(self.bounds[-1]) - np.repeat(self.bounds[:-1], size) + np.repeat(s, size)
        middle = data[at].astype(np.int64)
        left, right = np.zeros_like(middle), np.zeros_like(middle)
        left[1:], right[:-1] = middle[:-1], middle[1:]
        left[self.bounds[:-1]] = 0
        right[self.bounds[1:] - 1] = 0
        self.trigram = ((left * 961 + middle * 31 + right) * 40503 >> 3) % TRIGRAMS


def char_means(words: Words, table: np.ndarray) -> np.ndarray:
    """Mean trigram vector of each distinct word."""
    if not len(words.hash):
        return np.zeros((0, table.shape[1]), np.float32)
    return np.add.reduceat(table[words.trigram], words.bounds[:-1], axis=0) / words.count[:, None].astype(np.float32)


def windows_of(counts: np.ndarray, window: int, stride: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first word (in all words) and length of every window; an empty row has one of length 0."""
    n = 1 + np.maximum(0, -(-(counts - window) // stride))
    row = np.repeat(np.arange(len(counts)), n)
    k = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    first = (np.cumsum(counts) - counts)[row] + k * stride
    length = np.minimum(window, counts[row] - k * stride)
    return row, first, length


class Network:
    """Parameters, forward pass and gradients."""

    def __init__(self, vocabulary: np.ndarray, seed: int = 5):
        rng = np.random.default_rng(seed)
        f = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
        d = WORD_DIM + CHAR_DIM
        self.vocabulary = vocabulary  # sorted hashes; vector 0 is for other words
        self.p = {"word": f(len(vocabulary) + 1, WORD_DIM, scale=0.3), "char": f(TRIGRAMS, CHAR_DIM, scale=0.3),
                  "att_w": f(2 * HIDDEN, ATT, scale=0.4), "att_b": np.zeros(ATT, np.float32), "att_v": f(ATT, scale=0.4),
                  "out_w": f(2 * HIDDEN, scale=0.4), "out_b": np.full(1, -1.0, np.float32)}
        for side in "fb":
            self.p |= {f"x{side}": f(d, 3 * HIDDEN, scale=d**-0.5), f"u{side}": f(HIDDEN, 3 * HIDDEN, scale=HIDDEN**-0.5),
                       f"b{side}": np.zeros(3 * HIDDEN, np.float32)}
        self.calibration = (1.0, 0.0)

    def lookup(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.vocabulary):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at + 1, 0)

    def project(self, word: np.ndarray, chars: np.ndarray) -> dict[str, np.ndarray]:
        """What each distinct word puts into the gates; the last row is the padding."""
        x = np.concatenate([self.p["word"][word], chars], axis=1)
        x = np.concatenate([x, np.zeros((1, x.shape[1]), np.float32)])
        return {s: x @ self.p[f"x{s}"] + self.p[f"b{s}"] for s in "fb"} | {"x": x}

    def _gru(self, side: str, steps: np.ndarray, live: np.ndarray | None, keep: list | None) -> np.ndarray:
        """States after each step; steps: time x windows x gates."""
        t_max, n, _ = steps.shape
        u, h = self.p[f"u{side}"], np.zeros((n, HIDDEN), np.float32)
        out = np.empty((t_max, n, HIDDEN), np.float32)
        for t in range(t_max) if side == "f" else range(t_max - 1, -1, -1):
            a = h @ u
            g = _sigmoid(steps[t, :, : 2 * HIDDEN] + a[:, : 2 * HIDDEN])
            z, r = g[:, :HIDDEN], g[:, HIDDEN:]
            c = np.tanh(steps[t, :, 2 * HIDDEN :] + r * a[:, 2 * HIDDEN :])
            new = c + z * (h - c)
            if live is not None:
                new = np.where(live[t][:, None], new, h)
            if keep is not None:
                keep.append((t, h, z, r, c, a[:, 2 * HIDDEN :]))
            out[t] = h = new
        return out

    def forward(self, proj: dict[str, np.ndarray], index: np.ndarray, length: np.ndarray, tape: dict | None = None) -> np.ndarray:
        """Logits of windows; index: windows x time, pointing to the padding beyond the length."""
        t_max = index.shape[1]
        live = None if (length == t_max).all() else (np.arange(t_max)[:, None] < length[None])
        keep = {"f": [], "b": []} if tape is not None else {"f": None, "b": None}
        by_time = np.ascontiguousarray(index.T)
        h = np.concatenate([self._gru(s, proj[s][by_time], live, keep[s]) for s in "fb"], axis=2)
        e = np.tanh(h @ self.p["att_w"] + self.p["att_b"])
        score = e @ self.p["att_v"]
        if live is not None:
            score = np.where(live, score, np.float32(-1e9))
        score -= score.max(axis=0)
        alpha = np.exp(score)
        alpha /= alpha.sum(axis=0)
        if live is not None:
            alpha = alpha * live  # a window without words pools nothing
        pooled = np.einsum("tn,tnh->nh", alpha, h)
        if tape is not None:
            tape.update(by_time=by_time, live=live, keep=keep, h=h, e=e, alpha=alpha, pooled=pooled)
        return pooled @ self.p["out_w"] + self.p["out_b"][0]

    def backward(self, proj: dict[str, np.ndarray], tape: dict, d_logit: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """Gradients of the dense parameters, and of the distinct words' inputs."""
        p, g = self.p, {}
        h, e, alpha, live = tape["h"], tape["e"], tape["alpha"], tape["live"]
        g["out_w"], g["out_b"] = tape["pooled"].T @ d_logit, d_logit.sum(keepdims=True)
        d_pooled = d_logit[:, None] * p["out_w"]
        d_h = alpha[:, :, None] * d_pooled[None]
        d_alpha = np.einsum("nh,tnh->tn", d_pooled, h)
        d_score = alpha * (d_alpha - (alpha * d_alpha).sum(axis=0))
        g["att_v"] = np.einsum("tn,tna->a", d_score, e)
        d_e = d_score[:, :, None] * p["att_v"] * (1 - e * e)
        g["att_w"] = h.reshape(-1, 2 * HIDDEN).T @ d_e.reshape(-1, ATT)
        g["att_b"] = d_e.sum(axis=(0, 1))
        d_h += d_e @ p["att_w"].T
        d_x = np.zeros_like(proj["x"])
        for k, side in enumerate("fb"):
            u, g_u = p[f"u{side}"], np.zeros_like(p[f"u{side}"])
            d_steps = np.zeros((*d_h.shape[:2], 3 * HIDDEN), np.float32)
            carry = np.zeros(d_h.shape[1:2] + (HIDDEN,), np.float32)
            for t, before, z, r, c, an in reversed(tape["keep"][side]):
                d = d_h[t, :, k * HIDDEN : (k + 1) * HIDDEN] + carry
                passed = 0
                if live is not None:
                    m = live[t][:, None]
                    passed, d = np.where(m, 0, carry), np.where(m, d, 0)
                dc = d * (1 - z) * (1 - c * c)
                da = np.concatenate([d * (before - c) * z * (1 - z), dc * an * r * (1 - r), dc * r], axis=1)
                d_steps[t, :, : 2 * HIDDEN], d_steps[t, :, 2 * HIDDEN :] = da[:, : 2 * HIDDEN], dc
                g_u += before.T @ da
                carry = da @ u.T + d * z + passed
            g[f"u{side}"] = g_u
            by_word = np.zeros_like(proj[side])
            np.add.at(by_word, tape["by_time"].ravel(), d_steps.reshape(-1, 3 * HIDDEN))
            by_word[-1] = 0
            g[f"b{side}"] = by_word.sum(axis=0)
            g[f"x{side}"] = proj["x"].T @ by_word
            d_x += by_word @ p[f"x{side}"].T
        return g, d_x[:-1]


def _index(row_words: np.ndarray, first: np.ndarray, length: np.ndarray, padding: int) -> np.ndarray:
    t = np.arange(max(1, int(length.max(initial=0))))
    inside = t[None] < length[:, None]
    if not len(row_words):
        return np.full(inside.shape, padding)
    return np.where(inside, row_words[np.where(inside, first[:, None] + t[None], 0)], padding)


def score_bytes(net: Network, data: np.ndarray, offsets: np.ndarray, chunk: int = 4096, stride: int = STRIDE) -> np.ndarray:
    """The largest window logit of each row of a byte batch."""
    low = lower_ascii(data)
    start, end, counts = word_spans(low, offsets)
    words = Words(low, start, end)
    proj = net.project(net.lookup(words.hash), char_means(words, net.p["char"]))
    row, first, length = windows_of(counts, WINDOW, stride)
    logits = np.empty(len(row), np.float32)
    order = np.argsort(length, kind="stable")  # windows of like length together: little padding
    for a in range(0, len(order), chunk):
        w = order[a : a + chunk]
        logits[w] = net.forward(proj, _index(words.index, first[w], length[w], len(words.hash)), length[w])
    best = np.full(len(counts), -np.inf)
    np.maximum.at(best, row, logits)
    return best


def fit(rows: list[tuple[int, int, str]], toxic_share: float, epochs: int = EPOCHS, seed: int = 11,
        whole: Callable[[Network, list[int]], dict[int, float]] | None = None) -> Network | None:
    """A network from (document, label, window text) rows; None without both classes.

    ``whole`` gives the largest logit over all windows of documents, on which
    those held back are calibrated; without it their rows have to do.

    A document's label holds for its largest logit: the first epoch takes all
    windows of clean and a third of toxic documents' weight each, later ones
    take a toxic document's best window and all of a clean one's.
    """
    labels = {d: y for d, y, _ in rows}
    if len(set(labels.values())) < 2:
        return None
    rng = np.random.default_rng(seed)
    doc_ids, doc = np.unique([d for d, _, _ in rows], return_inverse=True)
    label = np.array([labels[d] for d in doc_ids])
    held = rng.random(len(doc_ids)) < 0.2  # for the calibration
    texts = [t.encode() for _, _, t in rows]
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    data = lower_ascii(np.frombuffer(b"".join(texts), np.uint8))
    start, end, counts = word_spans(data, offsets)
    words = Words(data, start, end)
    word_doc = np.unique(np.stack([words.index, doc[np.repeat(np.arange(len(rows)), counts)]]), axis=1)
    seen_in = np.bincount(word_doc[0], minlength=len(words.hash))
    net = Network(np.sort(words.hash[seen_in >= MIN_DOCS]))
    vocab = net.lookup(words.hash)
    first, length = np.cumsum(counts) - counts, np.minimum(counts, WINDOW)
    history = {k: np.full_like(v, 1e-7) for k, v in net.p.items()}
    moment = {k: np.zeros_like(v) for k, v in net.p.items() if k not in ("word", "char")}
    steps = 0
    weight = {0: (1 - toxic_share) / max(1, (label == 0).sum()), 1: toxic_share / max(1, (label == 1).sum())}
    scale = np.array([weight[0], weight[1]]) / (weight[0] + weight[1])
    scale = np.maximum(scale, 0.25) * 2

    def proj_of(part: np.ndarray, drop: float) -> tuple[dict, np.ndarray, np.ndarray]:
        flat = _index(words.index, first[part], length[part], -1)
        used, index = np.unique(flat, return_inverse=True)
        index = index.reshape(flat.shape)
        pad = len(used) - (used[0] == -1)
        if used[0] == -1:
            used, index = used[1:], np.where(flat == -1, pad, index - 1)
        ids = vocab[used]
        if drop:
            ids = np.where(rng.random(len(ids)) < drop, 0, ids)
        sizes = words.count[used]
        bounds = np.concatenate(([0], np.cumsum(sizes)))
        at = np.arange(bounds[-1]) - np.repeat(bounds[:-1], sizes) + np.repeat(words.bounds[:-1][used], sizes)
        grams = words.trigram[at]
        chars = np.add.reduceat(net.p["char"][grams], bounds[:-1], axis=0) / sizes[:, None].astype(np.float32) if len(used) else np.zeros((0, CHAR_DIM), np.float32)
        return net.project(ids, chars), index, (ids, grams, sizes)

    def logits_of(part: np.ndarray) -> np.ndarray:
        out = np.empty(len(part), np.float32)
        for a in range(0, len(part), 1024):
            proj, index, _ = proj_of(part[a : a + 1024], 0)
            out[a : a + 1024] = net.forward(proj, index, length[part[a : a + 1024]])
        return out

    learn = np.flatnonzero(~held[doc])
    epochs = max(epochs, min(60, -(-LEAST_BATCHES * 128 // max(1, len(learn)))))
    for epoch in range(epochs):
        chosen = learn
        if epoch:
            z = logits_of(learn)
            best = np.full(len(doc_ids), -np.inf)
            np.maximum.at(best, doc[learn], z)
            clean = label[doc[learn]] == 0
            hard = clean & ((rng.random(len(learn)) < 0.5) | (z > -3))
            chosen = learn[hard | (~clean & (z >= best[doc[learn]]))]
        chosen = chosen[np.argsort(length[chosen] + rng.random(len(chosen)) * 12)]
        batches = [chosen[a : a + 128] for a in range(0, len(chosen), 128)]
        rng.shuffle(batches)
        rate = 0.05 if epoch < epochs - 2 else 0.02
        for part in batches:
            proj, index, (ids, grams, sizes) = proj_of(part, 0.1)
            tape: dict = {}
            logit = net.forward(proj, index, length[part], tape)
            y = label[doc[part]]
            d_logit = ((_sigmoid(logit) - y) * scale[y] / len(part)).astype(np.float32)
            g, d_x = net.backward(proj, tape, d_logit)
            steps += 1
            for k, v in g.items():  # Adam for the dense parameters, Adagrad for the vectors of words and trigrams
                moment[k] += np.float32(0.1) * (v - moment[k])
                history[k] += np.float32(0.01) * (v * v - history[k])
                net.p[k] -= np.float32(rate / 5 / (1 - 0.9**steps)) * moment[k] / (np.sqrt(history[k] / np.float32(1 - 0.99**steps)) + np.float32(1e-6))
            for k, at, v in (("word", ids, d_x[:, :WORD_DIM]), ("char", grams, np.repeat(d_x[:, WORD_DIM:] / np.maximum(1, sizes)[:, None], sizes, axis=0))):
                rows_at, inverse = np.unique(at, return_inverse=True)
                total = np.zeros((len(rows_at), v.shape[1]), np.float32)
                np.add.at(total, inverse, v)
                history[k][rows_at] += total * total
                net.p[k][rows_at] -= np.float32(rate) * total / np.sqrt(history[k][rows_at])
    # calibration: logistic fit of the label on a document's largest logit
    aside = held if len(set(label[held])) == 2 else np.ones(len(doc_ids), bool)
    best = np.full(len(doc_ids), -np.inf)
    if whole is not None:
        scored = whole(net, [int(d) for d in doc_ids[aside]])
        best[aside] = [scored.get(int(d), -np.inf) for d in doc_ids[aside]]
    else:
        part = np.flatnonzero(aside[doc])
        np.maximum.at(best, doc[part], logits_of(part))
    ok = np.isfinite(best)
    x, y = best[ok], label[ok]
    wy = np.where(y == 1, toxic_share / max(1, (y == 1).sum()), (1 - toxic_share) / max(1, (y == 0).sum()))
    center, spread = float((wy * x).sum() / wy.sum()), float(x.std()) or 1.0
    x = (x - center) / spread
    a, b = 1.0, -1.0
    for _ in range(300):
        q = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        r, s = wy * (q - y), wy * q * (1 - q)
        m = np.array([[(s * x * x).sum() + 1e-3, (s * x).sum()], [(s * x).sum(), s.sum() + 1e-3]])
        step = np.linalg.solve(m, np.array([(r * x).sum() + 1e-3 * a, r.sum() + 1e-3 * (b + 1)]))
        a, b = a - np.clip(0.5 * step[0], -0.5, 0.5), b - np.clip(0.5 * step[1], -0.5, 0.5)
    a = max(a, 0.05)
    net.calibration = (float(a / spread), float(b - a * center / spread))
    return net


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _training_windows(docs: DataFrame, labels: DataFrame, sample: int, per_doc: int) -> tuple[list, float]:
    """Bounded rows (document, label, window text) and the share of toxic labels."""
    labelled = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
                .groupBy(F.col("doc_id").cast("long").alias("l_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic")))
    count = labelled.agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("t")).first()
    if not count["n"]:
        return [], 0.0
    share = count["t"] / count["n"]
    picked = []
    for y, n in ((1, sample * 3 // 8), (0, sample - sample * 3 // 8)):
        of_class = count["t"] if y else count["n"] - count["t"]
        picked += hashed_sample(labelled.where(F.col("toxic") == y), "l_id", n, of_class, 3).collect()
    chosen = docs.sparkSession.createDataFrame([(r["l_id"], r["toxic"]) for r in picked], "l_id long, toxic int")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            ids, ys = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for a, _, data, offsets in text_batches(batch.column(1)):
                start, end, counts = word_spans(lower_ascii(data), offsets)
                row, first, length = windows_of(counts, WINDOW, STRIDE)
                for r in range(len(counts)):
                    of = np.flatnonzero(row == r)
                    if len(of) > per_doc:
                        of = np.sort(np.random.default_rng(ids[a + r] & 0xFFFFFFFF).choice(of, per_doc, replace=False))
                    for k in of:
                        text = bytes(data[start[first[k]] : end[first[k] + length[k] - 1]][: 64 * WINDOW]) if length[k] else b""
                        out.append((ids[a + r], ys[a + r], text.decode("utf-8", "ignore")))
            columns = list(zip(*out)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.string())], ["d", "y", "t"])

    # an id that stands in several rows counts once, by its smallest text
    one = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), F.col("doc_id") == F.col("l_id"))
           .groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).select("doc_id", "text", "toxic"))
    rows = one.mapInArrow(cut, "d long, y int, t string").collect()
    return sorted((r["d"], r["y"], r["t"]) for r in rows), share


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, windows_per_doc: int = WINDOWS_PER_DOC) -> tuple[Network | None, float]:
    """The fitted network (None without both classes) and the share of toxic labels."""
    rows, share = _training_windows(docs, labels, sample, windows_per_doc)
    return (fit(rows, share, whole=lambda net, ids: whole_logits(docs, net, ids)) if rows else None), share


def whole_logits(docs: DataFrame, net: Network, ids: list[int]) -> dict[int, float]:
    """The largest logit over all windows of the whole texts of some documents (no more than the sample has), scored by tasks."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(net)
    chosen = spark.createDataFrame([(i,) for i in ids], "w_id long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.empty(batch.num_rows)
            for i, j, data, offsets in text_batches(batch.column(1), SMALL_BATCH_BYTES):
                out[i:j] = score_bytes(shared.value, data, offsets, stride=SCORE_STRIDE)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.float64())], ["id", "logit"])

    few = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), F.col("doc_id") == F.col("w_id"))
    rows = few.select("doc_id", "text").mapInArrow(run, "id long, logit double").groupBy("id").agg(F.max("logit").alias("logit")).collect()
    return {r["id"]: r["logit"] for r in rows}


def score(docs: DataFrame, model: tuple[Network | None, float], carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, score and the columns to carry, for every row; a text that is carried moves to the tasks once."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    others = [c for c in carry if c != "text" or dict(docs.dtypes)["text"] != "string"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, share = shared.value
        for batch in batches:
            text = batch.column(1)
            out = np.full(len(text), share)
            if net is not None:
                a, b = net.calibration
                for i, j, data, offsets in text_batches(text, SMALL_BATCH_BYTES):
                    out[i:j] = 1 / (1 + np.exp(-np.clip(a * score_bytes(net, data, offsets, stride=SCORE_STRIDE) + b, -500, 500)))
            carried = [batch.column(2 + others.index(c)) if c in others else text for c in carry]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.float64()), *carried], ["doc_id", "score", *carry])

    fields = docs.select(*carry).schema.fields if carry else []
    schema = ", ".join(["doc_id long", "score double", *(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)])
    return (docs.select(F.col("doc_id").cast("long").alias("in_id"), F.col("text").cast("string").alias("in_text"), *(F.col(c).alias(f"carry_{k}") for k, c in enumerate(others)))
            .mapInArrow(run, schema))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A toxicity score of every whole text of documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scored = score(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
