"""Longest previous factors, draws of any size, thresholds, and time that grows with the text."""

import random
import time

import numpy as np
import pytest

from strata.llm import jaccard, lines, pii, sharding, suffix, toxicity

from .conftest import documents


def test_suffix_arrays_and_previous_factors_equal_comparing_all():
    rng = random.Random(4)
    for _ in range(400):
        alphabet = rng.choice([b"a", b"ab", b"abc\x00", bytes(range(200, 256))])
        contexts = [bytes(rng.choice(alphabet) for _ in range(rng.randint(1, 9))) for _ in range(rng.randint(1, 12))]
        data = np.frombuffer(b"".join(contexts), np.uint8)
        begins = np.cumsum([0] + [len(c) for c in contexts])
        starts, ends, docs = [], [], []
        for k, c in enumerate(contexts):
            doc = rng.randrange(5)
            for i in range(rng.randint(1, len(c))):
                starts.append(begins[k] + i), ends.append(begins[k + 1]), docs.append(doc)
        starts, ends, docs = (np.array(x, np.int64) for x in (starts, ends, docs))
        text = [bytes(data[a:b]) for a, b in zip(starts, ends)]
        shared = lambda x, y: next((i for i, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))
        order, lcp = suffix.suffix_array(data, starts, ends)
        assert sorted(order.tolist()) == list(range(len(text)))
        assert all(text[a] <= text[b] for a, b in zip(order[:-1], order[1:]))
        assert lcp.tolist() == [0] + [shared(text[a], text[b]) for a, b in zip(order[:-1], order[1:])]
        want = [max([shared(t, u) for u, e in zip(text, docs) if e < d] or [0]) for t, d in zip(text, docs)]
        assert suffix.longest_previous_factors(data, starts, ends, docs).tolist() == want
    assert len(suffix.longest_previous_factors(np.zeros(0, np.uint8), *(np.zeros(0, np.int64),) * 3)) == 0


@pytest.mark.parametrize("good,bad,sample", [(7, 5, 6), (0, 9, 4), (3, 0, 2), (50, 1, 30), (400, 900, 333)])
def test_draws_follow_the_law(good, bad, sample):
    from math import comb
    rng = np.random.default_rng(1)
    n = 40_000
    seen = np.bincount([sharding._draw(rng, good, bad, sample) for _ in range(n)], minlength=good + 1) / n
    law = [comb(good, k) * comb(bad, sample - k) / comb(good + bad, sample) if 0 <= sample - k <= bad else 0 for k in range(good + 1)]
    assert np.abs(seen - law).max() < 0.012


@pytest.mark.parametrize("good,bad,sample", [(10**9, 3 * 10**9, 10**8), (4 * 10**10, 9 * 10**11, 10**9), (10**12, 23 * 10**12, 10**10)])
def test_draws_beyond_a_thousand_million(good, bad, sample):
    rng = np.random.default_rng(2)
    draws = np.array([sharding._draw(rng, good, bad, sample) for _ in range(1500)], np.float64)
    total = good + bad
    mean, var = sample * good / total, sample * good / total * bad / total * (total - sample) / (total - 1)
    assert abs(draws.mean() - mean) < 5 * (var / 1500) ** 0.5 and 0.85 < draws.var() / var < 1.15
    z = np.sort((draws - mean) / var**0.5)
    assert abs(np.interp(1.0, z, np.linspace(0, 1, len(z))) - 0.8413) < 0.04 and len(set(draws.tolist())) > 1000


def test_the_matrix_of_a_large_table_has_exact_margins():
    rows = [3 * 10**9 + k for k in range(12)]
    m = sharding.communication_matrix(rows, 24, 5)
    assert m.sum(axis=1).tolist() == rows and set(np.unique(m.sum(axis=0))) <= {sum(rows) // 24, sum(rows) // 24 + 1} and (m >= 0).all()


def test_thresholds_that_the_join_is_not_exact_for(spark):
    docs = documents(spark, ["a b", "a b c"])
    for bad in (0.5, 2 / 3, 0.0, 1.01):
        for run in (jaccard.jaccard_groups, lines.removed_lines):
            with pytest.raises(ValueError, match="exact"):
                run(docs, bad)


def test_thresholds_between_two_thirds_and_one(spark):
    from .conftest import sentence
    from .test_near_copies import edited
    rng = random.Random(8)
    texts = ["one two three", "a b c d e", "a b c d e f", "a b c d e f g", "a b c d e f g h"]
    for n in (6, 7, 8, 12, 30):
        base = sentence(rng, n)
        texts += [base, base + " more", edited(rng, base, 1)]
    for threshold in (0.68, 0.9, 1.0):
        rows = jaccard.jaccard_groups(documents(spark, texts), threshold).collect()
        least: dict = {}
        for r in rows:
            least[r.component] = min(r.doc_id, least.get(r.component, r.doc_id))
        out = {r.doc_id: least[r.component] for r in rows}
        sets = []
        for t in texts:
            w = t.split()
            sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} or {tuple(w)})
        root = list(range(len(texts)))
        for _ in texts:
            for i, x in enumerate(sets):
                for j, y in enumerate(sets):
                    if len(x & y) >= threshold * len(x | y) - 1e-9:
                        root[i] = root[j] = min(root[i], root[j])
        assert out == dict(enumerate(root))


def test_personal_data_in_hostile_texts_takes_time_in_proportion():
    for piece in ("ssn-", "iban a-", "a@", "1.", "1-", "+1", "http://", "account A0-"):
        t0 = time.perf_counter()
        pii.find_spans(piece * (300_000 // len(piece)))
        assert time.perf_counter() - t0 < 8, piece


def test_toxicity_scores_in_little_memory_and_moves_texts_once(spark, monkeypatch):
    import tracemalloc

    import pyarrow as pa

    docs = documents(spark, [(1, "Some words"), (2, None)])
    scored = toxicity.score(docs, (None, 0.25), ("lang", "text", "source"))
    assert "carry_2" not in scored._jdf.queryExecution().analyzed().toString()
    assert sorted(map(tuple, scored.collect()), key=str) == [(1, 0.25, "en", "Some words", "src1"), (2, 0.25, "en", None, "src2")]
    tasks = []
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, task, schema: tasks.append(task) or self)
    toxicity.score(docs, (toxicity.Network(np.zeros(0, np.uint64)), 0.25), ("text",))
    rng = random.Random(3)
    texts = [" ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(400)) for _ in range(800)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(800), pa.int64()), pa.array(texts)], ["in_id", "in_text"])
    tracemalloc.start()
    try:
        out = list(tasks[0](iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert sum(b.num_rows for b in out) == 800 and out[0].column(2).equals(batch.column(1))
    assert peak < 60e6, peak  # 81 MB with batches of 1 MB
