"""Decontamination, nearest neighbours, sharding, packing and the pipeline."""

import itertools
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from strata.llm import ann, decontamination, jaccard, lines, packing, sharding, toxicity

from .conftest import documents, odd_texts, sentence
from .test_near_copies import brute_groups, brute_lines, edited

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


# ----------------------------------------------------------- decontamination

def item_words(text):
    return (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).split()


def brute_pairs(docs, items):
    out = set()
    for (i, t), (j, u) in itertools.product(docs, items):
        w, v = item_words(t), item_words(u)
        n = min(5, len(v))
        if n:
            item = {tuple(v[k : k + n]) for k in range(len(v) - n + 1)}
            held = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)}
            if len(item & held) >= 0.75 * len(item) - 1e-9:
                out.add((i, j, len(item), len(item & held)))
    return out


def contaminated(rng):
    items = [(k, sentence(rng, n)) for k, n in enumerate((1, 2, 4, 5, 6, 8, 9, 20, 40, 41, 90))] + [(20, None), (21, ""), (22, " \t"), (None, sentence(rng, 12))]
    items.append((23, items[8][1]))
    docs = [t for t in odd_texts(rng) if t is None or "\x00" not in t]
    for _, text in items:
        for k in (0, 1, 2, 4, 12):
            if text and text.strip():
                docs.append(sentence(rng, rng.choice((0, 5, 600))) + " " + (edited(rng, text, k) if k else text.upper()) + "\n" + sentence(rng, rng.choice((0, 7))))
                cut = text.split()
                docs.append(sentence(rng, 9) + " " + " ".join(cut[: max(1, len(cut) * (10 - k // 2) // 10)]))
    return docs, items


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_pairs_equal_brute_force(spark, rng, monkeypatch, limit):
    monkeypatch.setattr(decontamination, "BROADCAST_ROWS", limit)
    docs, items = contaminated(rng)
    rows = [*enumerate(docs), (3, docs[3])]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1))
    out = decontamination.contaminated_pairs(documents(spark, rows, extra=True), bench)
    assert {(r.doc_id, r.item_id, r.n_item, r.n_common) for r in out.collect()} == brute_pairs(rows, items)


def test_decontamination_is_native_and_keeps_clean_documents(spark, rng):
    docs, items = contaminated(rng)
    df = documents(spark, [*enumerate(docs), (None, "clean words only here and there")], extra=True)
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = decontamination.decontaminate(df, bench)
    bad = {i for i, *_ in brute_pairs(list(enumerate(docs)), items)}
    assert sorted(str(r.doc_id) for r in out.select("doc_id").collect()) == sorted([str(i) for i in range(len(docs)) if i not in bad] + ["None"])
    assert out.columns == df.columns
    plan = decontamination.contaminated_pairs(df, bench)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
    assert decontamination.contaminated_pairs(documents(spark, []), bench).count() == 0
    assert decontamination.contaminated_pairs(df, bench.limit(0)).count() == 0


# --------------------------------------------------------- nearest neighbours

def test_walk_is_in_order_of_distance():
    rng = np.random.default_rng(1)
    for _ in range(200):
        da, db, counts = rng.random(6), rng.random(5), rng.integers(0, 4, (6, 5))
        need = rng.integers(0, 60)
        got = ann.walk(da, db, counts, need)
        assert got == [(i, j) for _, i, j in sorted((da[i] + db[j], i, j) for i in range(6) for j in range(5))][: len(got)]
        assert sum(counts[p] for p in got) >= need or len(got) == 30


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumns({"a": F.lit(1), "v": F.lit(2), "score": F.lit(3)})


def test_neighbours_recall_and_exact_scores(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK_ROWS", 300)
    monkeypatch.setattr(ann, "QUERY_ROWS", 20)
    rng = np.random.default_rng(2)
    x = rng.standard_normal((3000, 32)).astype(np.float32)
    x[1000:2000] = x[7] + rng.standard_normal((1000, 32)).astype(np.float32) * 0.05  # a third in one place
    out = ann.search(vectors(spark, [(i, v.tolist(), 0) for i, v in enumerate(x)]), F.col("vec_id") % 50 == 0, centroids=24)
    got = defaultdict(list)
    for r in out.orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    unit = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    hits = 0
    for q in range(0, 3000, 50):
        s = unit @ unit[q]
        s[q] = -2
        assert [r for r, _, _ in got[q]] == [1, 2, 3, 4, 5]
        assert all(abs(score - s[v]) < 1e-9 for _, v, score in got[q])
        assert [score for *_, score in got[q]] == sorted((score for *_, score in got[q]), reverse=True)
        hits += len({v for _, v, _ in got[q]} & set(np.lexsort((np.arange(3000), -s))[:5]))
    assert hits / 300 >= 0.9


def test_neighbours_edge_cases(spark):
    rows = [(0, [1.0, 0.0], 0), (50, [0.0, 2.0], 0), (3, [1.0, 0.0], 0), (2, [5.0, 0.0], 0), (1, [1.0, 1.0], 0), (1, [1.0, 1.0], 0), (4, None, 0), (5, [0.0, 0.0], 0),
            (6, [float("nan"), 1.0], 0), (7, [float("inf"), 1.0], 0), (8, [], 0), (9, [1.0, 2.0, 3.0], 0), (None, [1.0, 0.0], 0), (10, [None, 1.0], 0)]
    out = ann.search(vectors(spark, rows), F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in out] == [(0, 1, 2), (0, 2, 3), (0, 3, 1), (0, 4, 50), (50, 1, 1), (50, 2, 0), (50, 3, 2), (50, 4, 3)]
    assert [r.score for r in out][:2] == [1.0, 1.0]
    assert ann.search(vectors(spark, [(4, None, 0)]), F.col("vec_id") % 50 == 0).count() == 0
    assert ann.search(vectors(spark, []), F.col("vec_id") % 50 == 0).count() == 0


def brute_neighbours(rows, k=5):
    """Ids and scores by query: an id counts by its best row, and so does the query."""
    ids = np.array([i for i, _ in rows])
    unit = np.array([v for _, v in rows])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    out = {}
    for q in {int(i) for i in ids if i % 50 == 0}:
        best = {}
        for i, s in zip(ids.tolist(), (unit @ unit[ids == q].T).max(axis=1).tolist()):
            best[i] = max(best.get(i, -2), s)
        best.pop(q)
        out[q] = sorted(((i, s) for i, s in best.items()), key=lambda x: -x[1])[:k]
    return out


@pytest.mark.parametrize("block_rows", [65_536, 300])
def test_neighbours_of_repeated_rows(spark, monkeypatch, block_rows):
    monkeypatch.setattr(ann, "BLOCK_ROWS", block_rows)
    rng = np.random.default_rng(5)
    once = [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((400, 8)).astype(np.float32).astype(np.float64))]
    some = [(i, (np.array(v) + (0.01, *[0.0] * 7)).astype(np.float32).astype(np.float64).tolist()) for i, v in once if i % 3 == 0 for _ in range(2)]
    unlike = [(i, once[(7 * i + 1) % 400][1]) for i in range(0, 400, 2)]
    for rows in (once * 6, once + some + unlike):
        want = brute_neighbours(rows)
        out = ann.search(vectors(spark, [(i, v, 0) for i, v in rows]), F.col("vec_id") % 50 == 0, centroids=8, share=1.0)
        got = defaultdict(list)
        for r in out.orderBy("query_id", "rank").collect():
            got[r.query_id].append((r.rank, r.vec_id, r.score))
        assert set(got) == set(want)
        for q in want:
            assert [r for r, _, _ in got[q]] == [1, 2, 3, 4, 5] and len({i for _, i, _ in got[q]}) == 5
            assert np.allclose([s for *_, s in got[q]], [s for _, s in want[q]], rtol=0, atol=1e-9)


def test_neighbours_of_few_ids_with_many_vectors(spark):
    """A near id with many vectors doesn't end the walk before k ids are met."""
    rng = np.random.default_rng(6)
    rows = [(0, [1.0, 0.0, 0.0, 0.0])] + [(1, [1.0, float(e), 0.0, 0.0]) for e in rng.random(300) / 50] + [(i, rng.standard_normal(4).tolist()) for i in range(2, 12)]
    out = ann.search(vectors(spark, [(i, v, 0) for i, v in rows]), F.col("vec_id") == 0, centroids=8).orderBy("rank").collect()
    assert len({r.vec_id for r in out}) == 5 and out[0].vec_id == 1


# ------------------------------------------------------------------ sharding

def test_matrix_has_exact_margins_and_the_right_law():
    rows = [0, 5, 100, 3, 17]
    seen = np.zeros((5, 4))
    for seed in range(400):
        m = sharding.communication_matrix(rows, 4, seed)
        assert (m.sum(axis=1) == rows).all() and sorted(m.sum(axis=0)) == [31, 31, 31, 32]
        seen += m
    assert np.abs(seen / 400 - np.array(rows)[:, None] / 4).max() < 0.6


def test_shards_are_exact_gapless_and_mixed(spark, rng):
    texts = [*odd_texts(rng), *["the same text"] * 500, *[sentence(rng, 3) for _ in range(1000)]]
    rows = [*enumerate(texts), (5, texts[5]), (None, "x"), (None, None)]
    df = documents(spark, rows, extra=True)
    out = sharding.shuffle_into_shards(df, shards=7, blocks=32)
    got = out.collect()
    sizes = Counter(r.shard for r in got)
    assert len(got) == len(rows) and max(sizes.values()) - min(sizes.values()) <= 1 and set(sizes) == set(range(7))
    for s in sizes:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sizes[s]))
    expected = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == expected
    copies = Counter(r.shard for r in got if r.text_crc32 == zlib.crc32(b"the same text"))
    assert max(copies.values()) < 1.5 * 500 / 7
    assert got and sorted(map(str, got)) == sorted(map(str, sharding.shuffle_into_shards(df.repartition(9), shards=7, blocks=32).collect()))
    plan = out._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
    assert sharding.shuffle_into_shards(documents(spark, [])).count() == 0
    assert sharding.shuffle_into_shards(documents(spark, ["a", "b"])).count() == 2


# ------------------------------------------------------------------- packing

def tokens(text):
    from tokenizers import Tokenizer
    return [*Tokenizer.from_file(VOCABULARY).encode(text or "", add_special_tokens=False).ids, 1]


def test_word_encoder_equals_the_tokenizer(rng):
    from tokenizers import Tokenizer
    whole = Tokenizer.from_file(VOCABULARY)
    parts = packing.WordEncoder(VOCABULARY)
    alphabet = "aAbzé ÉßÿÀñ0123.,!-'\"<|>endoftext\t\n\r\x1f ć²½ªµ中文İ  s't re;ÇŒœſ"
    for k in range(20_000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 16)))
        text += rng.choice(("", "", "", "<|endoftext|>", " it's", "́x"))
        assert parts.encode(text) == np.array(whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), text


def check_packing(rows, pieces, most=4096, max_docs=None, max_cost=None):
    by_doc = defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
    for i, t in rows:
        ids = tokens(t)
        mine = sorted(by_doc[i], key=lambda p: p.piece)
        assert [(p.piece, p.start, p.length) for p in mine] == [(k, a, min(most, len(ids) - a)) for k, a in enumerate(range(0, len(ids), most))]
        for p in mine:
            assert p.ids_crc32 == zlib.crc32(np.array(ids[p.start : p.start + p.length], "<u4").tobytes())
    bins = defaultdict(list)
    for p in pieces:
        bins[p.sequence_id].append(p)
    for b in bins.values():
        at = 0
        for p in sorted(b, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= most and len(b) <= (max_docs or most) and sum(p.length**2 for p in b) <= (max_cost or most**2)
    return len(bins)


def test_packing_round_trip(spark, rng):
    rows = [*enumerate([*odd_texts(rng), *[sentence(rng, rng.choice((1, 10, 200, 900))) for _ in range(150)]])]
    df = documents(spark, rows, extra=True).drop("length")
    pieces = packing.pack_documents(df, VOCABULARY).collect()
    total = sum(p.length for p in pieces)
    assert check_packing(rows, pieces) <= -(-total // 4096) + 1
    for rule, docs, cost in (("norm", 3, None), ("dot", None, 3_000_000), ("dot", 4, 4096 * 2048)):
        small = [r for r in rows if len(tokens(r[1])) ** 2 <= (cost or 1 << 62)]
        out = packing.pack_documents(documents(spark, small), VOCABULARY, max_docs=docs, max_cost=cost, rule=rule).collect() if not cost else \
            packing.pack(packing.written(packing.token_pieces(documents(spark, small), VOCABULARY), "p"), max_docs=docs, max_cost=cost, rule=rule).collect()
        check_packing(small, out, max_docs=docs, max_cost=cost)


def test_packing_edge_cases(spark):
    assert packing.pack_documents(documents(spark, []), VOCABULARY).count() == 0
    out = packing.pack_documents(documents(spark, [(1, None), (1, None), (None, "a")]), VOCABULARY).collect()
    assert Counter((p.doc_id, p.length) for p in out) == Counter({(1, 1): 2, (None, 2): 1}) and len({p.sequence_id for p in out}) == 1
    with pytest.raises(ValueError):
        packing.best_fit_plan({100: 1}, 50)


def test_plan_of_runs_equals_best_fit_of_single_pieces():
    """Placing runs of equal pieces gives the bins of best-fit decreasing, piece by piece."""
    rng = np.random.default_rng(5)
    for _ in range(40):
        lengths = rng.integers(1, 60, rng.integers(1, 200))
        segments, bins = packing.best_fit_plan(dict(Counter(lengths.tolist())), 64)
        free: list[int] = []
        for n in sorted(lengths.tolist(), reverse=True):
            fit = [f for f in free if f >= n]
            if fit:
                free[free.index(min(fit))] -= n
            else:
                free.append(64 - n)
        assert bins == len(free)
        assert sum(hi - lo for _, lo, hi, *_ in segments) == len(lengths)


# ------------------------------------------------------------------ pipeline

def test_pipeline_stages(spark, rng, tmp):
    import corpus_pipeline as pipeline
    item = sentence(rng, 30)
    base = sentence(rng, 80)
    texts = [sentence(rng, rng.choice((20, 60, 200))) for _ in range(240)]
    for i in range(0, 240, 4):
        texts[i] += " idiot scum trash " + sentence(rng, 5)
    texts += [base, edited(rng, base, 2), base + "\n" + sentence(rng, 10), sentence(rng, 50) + " " + item, "", None]
    docs = documents(spark, list(enumerate(texts)))
    docs.write.parquet(f"{tmp}/documents.parquet")
    spark.createDataFrame([(i, 0, int(i < 240 and i % 4 == 0)) for i in range(240)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp}/labels.parquet")
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{tmp}/benchmark.parquet")
    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "line_dedup", "ngram_jaccard_join", "benchmark_decontamination", "best_fit_packing"]

    def rows(df):
        return sorted(((r.doc_id, r.text) for r in df.collect()), key=lambda r: r[0])

    at, frame = rows(docs), docs
    for k, (name, stage) in enumerate(pipeline.STAGES):
        out = stage(spark, frame, tmp)
        if name != "best_fit_packing":
            assert out.columns == docs.columns
            out.write.parquet(f"{tmp}/stage{k}")
            frame = spark.read.parquet(f"{tmp}/stage{k}")
            got = rows(frame)
        if name == "toxicity":
            model = toxicity.train(docs, spark.read.parquet(f"{tmp}/labels.parquet"))
            kept = {r.doc_id for r in toxicity.score(docs, model).collect() if r.score < 0.5}
            assert got == [r for r in at if r[0] in kept]
            assert sum(i % 4 == 0 for i in kept if i < 240) <= 5 and sum(i % 4 != 0 for i in kept if i < 240) >= 172
        elif name == "line_dedup":
            assert got == [(i, t) for (i, _), t in zip(at, brute_lines(at))]
            assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in frame.collect())
        elif name == "ngram_jaccard_join":
            groups = {i: c for i, n, c in brute_groups(at) if n}
            assert got == [r for r in at if groups.get(r[0], r[0]) == r[0]]
        elif name == "benchmark_decontamination":
            bad = {i for i, *_ in brute_pairs(at, [(0, item)])}
            assert bad and got == [r for r in at if r[0] not in bad]
        else:
            check_packing(at, out.collect())
        at = got
    assert pipeline.run(spark, tmp).count() == out.count()


def test_near_copies_meet_in_the_stage_itself(spark, rng):
    """Each stage by itself: copies given to the Jaccard stage leave one."""
    import corpus_pipeline as pipeline
    base = sentence(rng, 80)
    docs = documents(spark, [(5, base), (3, edited(rng, base, 2)), (9, base), (7, sentence(rng, 80)), (1, "")])
    out = dict(pipeline.STAGES)["ngram_jaccard_join"](spark, docs, "")
    assert sorted(r.doc_id for r in out.collect()) == [1, 3, 7]
    assert lines.dedup_lines(docs).count() == 5 and jaccard.jaccard_groups(docs).count() == 5
