"""Jaccard join, line dedup and suffix removal against brute force."""

import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from strata.llm import graph, jaccard, lines, suffix

from .conftest import documents, odd_texts, sentence

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def find(parent, x):
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def word_set(text):
    words = [w for w in (text or "").translate(UPPER).replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def brute_groups(rows):
    sets = [word_set(t) for _, t in rows]
    parent = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(parent, a), find(parent, b)
                parent[max(x, y)] = min(x, y)
    members = defaultdict(list)
    for i in range(len(rows)):
        members[find(parent, i)].append(rows[i][0])
    return [(rows[i][0], len(sets[i]), min((d for d in members[find(parent, i)] if d is not None), default=None) if sets[i] else rows[i][0]) for i in range(len(rows))]


def edited(rng, text, n):
    words = text.split()
    for _ in range(n):
        words[rng.randrange(len(words))] = sentence(rng, 1)
    return " ".join(words)


def near_copies(rng):
    texts = odd_texts(rng)
    passage = sentence(rng, 45)
    for size in (4, 5, 6, 7, 8, 9, 12, 16, 20, 30, 60, 150, 400):
        base = sentence(rng, size)
        texts += [base, base.upper() if size % 2 else base, *(edited(rng, base, k) for k in (1, 1, 2, 3, 5, 8))]
        texts += [base + " " + sentence(rng, k) for k in (1, 2, 4)]
    texts += [sentence(rng, k) + " " + passage for k in (1, 2, 5, 8, 12, 20) for _ in range(3)]
    return texts


def ids(rng, texts):
    order = list(range(100, 100 + len(texts)))
    rng.shuffle(order)
    return list(zip(order, texts))


def compare_groups(spark, rows):
    got = sorted(map(str, op2(spark, rows)))
    assert got == sorted(map(str, brute_groups(rows)))


def op2(spark, rows):
    df = documents(spark, rows, extra=True).repartition(5)
    rows = jaccard.jaccard_groups(df)
    smallest = rows.where("component is not null").groupBy(F.col("component").alias("c")).agg(F.min("doc_id").alias("m"))
    out = rows.join(smallest, F.col("component") == F.col("c"), "left")
    return [(r.doc_id, r.n_shingles, r.m if r.component is not None else r.doc_id) for r in out.collect()]


def test_groups_equal_brute_force(spark, rng):
    rows = ids(rng, near_copies(rng))
    rows += [rows[20], (None, rows[21][1]), (None, None)]
    compare_groups(spark, rows)


def test_groups_of_empty_and_wordless_tables(spark):
    assert op2(spark, []) == []
    assert sorted(op2(spark, [(1, ""), (2, None), (3, " \n")])) == [(1, 0, 1), (2, 0, 2), (3, 0, 3)]


def test_one_of_each_keeps_clean_documents_and_columns(spark, rng):
    rows = ids(rng, near_copies(rng))
    df = documents(spark, rows, extra=True)
    out = jaccard.one_of_each(df)
    assert out.columns == df.columns
    groups = {i: c for i, _, c in brute_groups(rows)}
    firsts = {i for i, t in rows if not word_set(t) or groups[i] == i}
    assert sorted(r.doc_id for r in out.select("doc_id").collect()) == sorted(firsts)
    again = documents(spark, [(1, "same old text"), (1, "same old text"), (None, "same old text"), (None, None)])
    assert sorted(str(r.doc_id) for r in jaccard.one_of_each(again).collect()) == ["1", "None"]


def test_a_light_set_meets_a_heavy_one(rng):
    limit = jaccard.boundary(1.0, 0.75)
    assert 8 <= limit <= 60
    assert jaccard.boundary(5.0, 0.75) > limit


def test_components_equal_union_find(spark, rng):
    for n, e in ((300, 260), (50, 400)):
        edges = [(rng.randrange(n) - n // 2, rng.randrange(n) - n // 2) for _ in range(e)]
        edges += [(i, i + 1) for i in range(1000, 1200)]  # a long chain
        parent = {x: x for ab in edges for x in ab}
        for a, b in edges:
            a, b = find(parent, a), find(parent, b)
            parent[max(a, b)] = min(a, b)
        got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long").repartition(7)).collect()}
        assert got == {x: find(parent, x) for a, b in edges if a != b for x in (a, b)}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_node_filter_has_no_false_negatives(spark, rng):
    import numpy as np
    nodes = [rng.randrange(-(2**63), 2**63) for _ in range(3000)] + [0, -1, 127, 128, 2**63 - 1]
    f = graph.NodeFilter(spark.createDataFrame([(x,) for x in nodes], "node long"), "node", bits=1 << 20)
    assert f.has(np.array(nodes)).all()
    others = np.array([rng.randrange(-(2**63), 2**63) for _ in range(3000)])
    assert f.has(others).mean() < 0.02


def brute_lines(rows, shingle=8):
    """Lines that stay, by row: the first place of each component of similar lines."""
    places = defaultdict(list)
    for at, (i, t) in enumerate(rows):
        for k, line in enumerate((t or "").split("\n")):
            if line.strip(" \t\n\r\x0b\x0c"):
                places[line].append((i is None, i or 0, at, k))
    texts = sorted(places)
    sets = [{t[i : i + shingle] for i in range(max(1, len(t) - shingle + 1))} for t in texts]
    parent = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both >= 0.75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(parent, a), find(parent, b)
                parent[max(x, y)] = min(x, y)
    group = defaultdict(list)
    for n, t in enumerate(texts):
        group[find(parent, n)] += places[t]
    gone = {p[2:] for g in group.values() for p in sorted(g)[1:]}
    return [None if t is None else "\n".join(line for k, line in enumerate(t.split("\n")) if (at, k) not in gone) for at, (_, t) in enumerate(rows)]


def line_texts(rng):
    out = odd_texts(rng)
    shared = sentence(rng, 25)
    for _ in range(25):
        some = [sentence(rng, rng.randint(1, 30)) for _ in range(rng.randint(1, 5))]
        some.insert(rng.randrange(len(some) + 1), edited(rng, shared, rng.choice((0, 0, 1, 2, 4, 9))))
        out.append("\n".join(some))
    return out


def test_lines_equal_brute_force(spark, rng):
    rows = list(enumerate(line_texts(rng)))
    df = documents(spark, rows, extra=True).repartition(4)
    out = lines.dedup_lines(df)
    assert set(df.columns) <= set(out.columns)
    got = {r.doc_id: r for r in out.collect()}
    expected = brute_lines(rows)
    missed = sum(got[i].text != t for i, t in enumerate(expected))
    assert missed == 0
    assert all(got[i].n_lines == (0 if t is None else t.count("\n") + 1) for i, t in rows)
    assert all(got[i].n_removed == (0 if t is None else t.count("\n") - expected[i].count("\n") + (1 if got[i].n_lines == got[i].n_removed else 0)) for i, t in rows)


def test_lines_by_shorter_shingles_equal_brute_force(spark, rng):
    """Shingles of 5: short footers with another year link too."""
    rows = list(enumerate(line_texts(rng) + [f"all rights reserved by the owners of this site {y}" for y in (2019, 2021, 2024)] + ["ab" * 3, "-" * 6, "-" * 9]))
    out = lines.dedup_lines(documents(spark, rows).repartition(4), shingle=5)
    got = {r.doc_id: r.text for r in out.collect()}
    assert [got[i] for i, _ in rows] == brute_lines(rows, 5)
    assert got[len(rows) - 5] == got[len(rows) - 4] == ""


def test_shared_keys_equal_a_count(spark, rng):
    """Keys of several nodes with their notes; rows that repeat a node don't make a key shared."""
    import numpy as np

    rows = [(rng.choice((rng.randrange(40), rng.randrange(1 << 30))) << 33, rng.randrange(-60, 60)) for _ in range(900)]
    rows = [(k, n, (k + n) % 3) for k, n in rows + rows[:300]]

    def entries(batch):
        yield tuple(np.array(batch.column(c).to_pylist(), t) for c, t in ((0, np.uint64), (1, np.int64), (2, np.uint32)))

    source = spark.createDataFrame(rows, "key long, node long, note long").repartition(6)
    got = {(r.key, r.node, r.note) for r in graph.shared_keys(source, entries, "counted").collect()}
    nodes = defaultdict(set)
    for k, n, _ in rows:
        nodes[k].add(n)
    assert got == {(k, n, note) for k, n, note in rows if len(nodes[k]) > 1}


def test_lines_of_a_crowded_passage(spark, rng, monkeypatch):
    """Many unlike lines around one passage: the exact keys find the same links."""
    monkeypatch.setattr(graph, "MANY", 2)
    passage = sentence(rng, 40)
    rows = list(enumerate(sentence(rng, rng.randint(1, 40)) + " " + passage for _ in range(80)))
    got = {r.doc_id: r.text for r in lines.dedup_lines(documents(spark, rows).repartition(3)).collect()}
    assert [got[i] for i, _ in rows] == brute_lines(rows)


def test_short_lines_with_equal_sets(spark, rng):
    """Lines of 8 and 9 characters meet longer ones of the same shingles."""
    short = ["-" * 8, "=" * 9, "é" * 8, "ab" * 4, "ba" * 4 + "b", "a" * 8 + "b", "b" + "a" * 8, "abcabcab", "abcabcabc", "-" * 7, "one line", "two lines"]
    longer = ["-" * 11, "=" * 30, "é" * 10, "ab" * 6, "a" * 12 + "b", "b" + "a" * 11, "abcabcabcabc", "one lines", "=" * 8]
    for first, second in ((short, longer), (longer, short)):
        rows = [(1, "\n".join(first)), (2, "\n".join(second)), (3, sentence(rng, 9))]
        got = {r.doc_id: r.text for r in lines.dedup_lines(documents(spark, rows).repartition(2)).collect()}
        assert [got[i] for i, _ in rows] == brute_lines(rows)
        assert got[2] != rows[1][1]


def test_lines_of_empty_table_and_equal_rows(spark):
    assert lines.dedup_lines(documents(spark, [])).count() == 0
    out = lines.dedup_lines(documents(spark, [(1, "a line"), (1, "a line"), (None, "a line"), (None, "b")])).collect()
    assert sorted((str(r.doc_id), r.text) for r in out) == [("1", "a line"), ("1", "a line"), ("None", ""), ("None", "b")]


def brute_repeats(rows, width=50):
    """(removed bytes, spans, digest) by row."""
    first = {}
    order = [2**63 - 1 if i is None else i for i, _ in rows]
    data = [(t or "").encode() for _, t in rows]
    for i, b in zip(order, data):
        for k in range(len(b) - width + 1):
            s = b[k : k + width]
            first[s] = min(first.get(s, i), i)
    out = []
    for i, b in zip(order, data):
        gone = bytearray(len(b))
        for k in range(len(b) - width + 1):
            if first[b[k : k + width]] < i:
                gone[k : k + width] = b"\1" * width
        rest = bytes(c for c, g in zip(b, gone) if not g)
        out.append((len(b), sum(gone), len([s for s in bytes(gone).split(b"\0") if s]), hashlib.sha256(rest).hexdigest()))
    return out


def repeat_texts(rng):
    out = odd_texts(rng)
    passages = [sentence(rng, 12) for _ in range(3)] + ["é" * 24 + "x", "é" * 26, "ab" * 25, "a" * 49, "a" * 50, "a" * 51]
    for _ in range(40):
        parts = [sentence(rng, rng.randint(0, 15))]
        for _ in range(rng.randint(0, 3)):
            parts += [rng.choice(passages), sentence(rng, rng.randint(0, 6))]
        out.append("".join(parts))
    return out


@pytest.mark.parametrize("split_from", [2000, 3])
def test_repeats_equal_brute_force(spark, rng, split_from):
    rows = ids(rng, repeat_texts(rng))
    rows += [rows[15], (None, rows[16][1]), (None, "z" * 60), (None, "z" * 60), (rows[3][0], "y" * 70)]
    out = suffix.remove_repeats(documents(spark, rows, extra=True).repartition(4), split_from=split_from).collect()
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out)
    assert got == sorted((str(i), *b) for (i, _), b in zip(rows, brute_repeats(rows)))


def test_repeats_of_empty_table(spark):
    assert suffix.remove_repeats(documents(spark, [])).count() == 0


def test_previous_smaller_equals_a_scan(rng):
    import numpy as np
    for _ in range(200):
        n = rng.randint(1, 30)
        v = np.array([rng.randrange(6) for _ in range(n)])
        joined = np.array([False] + [rng.random() < 0.8 for _ in range(n - 1)])
        got = suffix.previous_smaller(v, joined)
        for i in range(n):
            j = i
            while j > 0 and joined[j] and not (j < i and v[j] < v[i]):
                j -= 1
            want = j if j < i and v[j] < v[i] else -1
            assert got[i] == want


def test_components_in_one_task_and_in_rounds(spark, rng, monkeypatch):
    """Few edges are folded in one stage; the rounds that more of them take give the same components."""
    edges = [(rng.randrange(400) - 200, rng.randrange(400) - 200) for _ in range(420)]
    df = spark.createDataFrame(edges, "a long, b long").repartition(5)
    few = graph.components(df)
    assert few.inputFiles() and len(few.inputFiles()) == 1
    want = sorted(map(tuple, few.collect()))
    monkeypatch.setattr(graph, "HELD_ENTRIES", 10)
    assert sorted(map(tuple, graph.components(df).collect())) == want


def test_pairs_move_only_the_sets_that_they_need(spark):
    """Sets of no pair are dropped before the joins that shuffle them, and none that a pair has."""
    values = spark.range(0, 1 << 16).select((F.col("id") * 1_000_003 * 4_099 - 5).alias("node"), F.col("id").cast("string").alias("set"))
    nodes = [r.node for r in values.where("cast(set as long) % 4096 < 2").orderBy(F.expr("cast(set as long)")).collect()]
    pairs = spark.createDataFrame(list(zip(nodes[::2], nodes[1::2])), "a long, b long")
    got = graph.with_both(pairs, values, "set").collect()
    assert sorted((r.a, r.b) for r in got) == sorted(zip(nodes[::2], nodes[1::2])) and all(int(r.set_b) == int(r.set_a) + 1 for r in got)
    kept = graph.may_have(values, "node", spark.createDataFrame([(n,) for n in nodes], "n long")).where("__may")
    assert {r.node for r in kept.collect()} >= set(nodes) and kept.count() < 1 << 10
    assert graph.may_have(values, "node", spark.createDataFrame([], "n long")).where("__may").count() == 0


def test_texts_that_lose_no_line_are_not_shuffled(spark, rng):
    """Only documents that may lose lines meet the table of what goes; the others pass by a broadcast bit."""
    rows = [(i, sentence(rng, 60)) for i in range(2000)] + [(9000, "kept\n\n" + sentence(rng, 30)), (9001, None), (9002, "")]
    twice = [(9500, rows[5][1] + "\nits own last line of text"), (9501, rows[6][1])]
    out = lines.dedup_lines(documents(spark, rows + twice))
    got = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in out.collect()}
    assert got[9500] == ("its own last line of text", 2, 1) and got[9501] == ("", 1, 1)
    assert got[9000] == (rows[2000][1], 3, 0) and got[9001] == (None, 0, 0) and got[9002] == ("", 1, 0)
    assert all(got[i] == (t, 1, 0) for i, t in rows[:2000])
    assert "__may" in out._jdf.queryExecution().analyzed().toString()


def test_sets_and_shared_counts_equal_python_sets(rng):
    import numpy as np

    from strata.llm.text import row_sets, shared_counts
    for _ in range(40):
        rows = [[rng.randrange(9) << 40 for _ in range(rng.randrange(6))] for _ in range(rng.randrange(1, 9))]
        values, sizes = row_sets(np.array(sum(rows, []), np.uint64), np.array([len(r) for r in rows], np.int64))
        assert values.tolist() == [v for r in rows for v in sorted(set(r))] and sizes.tolist() == [len(set(r)) for r in rows]
        x, y = (np.array([rng.randrange(len(rows)) for _ in range(600)]) for _ in "xy")
        assert shared_counts(values, np.append(0, np.cumsum(sizes)), x, y).tolist() == [len(set(rows[i]) & set(rows[j])) for i, j in zip(x, y)]


def test_entries_without_notes_are_packed_without_them(spark):
    import numpy as np

    key, node = np.arange(1000, dtype=np.uint64) << np.uint64(33), np.arange(1000, dtype=np.int64)
    sizes = [sum(len(b) for b in graph.entry_rows(key, node, np.zeros(1000, np.uint32), 4, e).column("blob").to_pylist() if b) for e in (graph.ENTRY, graph.PLAIN_ENTRY)]
    assert sizes == [20_000, 16_000]
