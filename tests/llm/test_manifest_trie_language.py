"""Merkle manifest, prefix trie and language: against versions in plain Python."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from strata.llm import language, manifest, prefix_trie
from strata.llm.queries import oracle

from .conftest import CLASHING, SCHEMA, documents, odd_texts, sentence

TREE_CLASHING = ("leaf", "seen", "at", "n", "src", "block", "node", "proof", "root", "placed_row", "r_part", "before")
TRIE_CLASHING = ("at", "n", "t1", "t2", "depth", "seg", "k1", "kind", "c", "h", "model", "placed_tie")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_tree(digests, fanout):
    """The root, and of every digest its siblings from the bottom up as (before, after)."""
    level, proofs, at = list(digests), [[] for _ in digests], list(range(len(digests)))
    while len(level) > 1:
        for i, p in enumerate(at):
            run = level[p - p % fanout : p - p % fanout + fanout]
            proofs[i].append(("".join(run[: p % fanout]), "".join(run[p % fanout + 1 :])))
            at[i] = p // fanout
        level = [sha("".join(level[i : i + fanout])) for i in range(0, len(level), fanout)]
    return level[0], proofs


def brute_leaf(row, text):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[0], row[2], row[3], row[4], text)))


def brute_manifest(rows, fanout):
    """Rows (doc_id, text, source, lang, n_chars) to the query's rows, as a sorted list."""
    by_source = defaultdict(list)
    for r in rows:
        by_source[r[2]].append(r)
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in sources:
        leaves = sorted(((r, brute_leaf(r, r[1])) for r in by_source[s]), key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        trees[s] = (leaves, *brute_tree([d for _, d in leaves], fanout))
    root, tops = brute_tree([trees[s][1] for s in sources], fanout)
    out = []
    for s, top in zip(sources, tops):
        leaves, subroot, proofs = trees[s]
        for (r, leaf), proof in zip(leaves, proofs):
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            lower = r[1] and "".join(c.lower() if "A" <= c <= "Z" else c for c in r[1])
            have = brute_leaf(r, lower if hit else r[1])
            for before, after in proof + top:
                have = sha(before + have + after)
            out.append((r[0], leaf, subroot, root, sha("".join(a + b for a, b in proof + top)), have, have == root))
    return sorted(out, key=repr)


def manifest_rows(df, fanout, levels):
    out = manifest.manifest(manifest.documents_leaves(df), ["seen"], fanout, levels)
    folded = manifest.fold(F.coalesce("seen", "leaf"), F.col("proof"))
    return sorted((tuple(r) for r in out.select("doc_id", "leaf", "subroot", "root", manifest.proof_hash(F.col("proof")), folded, folded == F.col("root")).collect()), key=repr)


def source_rows(rng, sizes):
    texts = [*odd_texts(rng)[:8], "AbÇ É", "ABC" * 3000]
    names = [None, "", "src", "É", "Z", "a", *(f"s{k}" for k in range(40))]
    rows = [(rng.randint(-50, 10**12), rng.choice(texts), names[k], rng.choice(["en", None]), rng.choice([1, None])) for k, n in enumerate(sizes) for _ in range(n)]
    return rows + [(None, "A", "src", None, None), (None, None, None, None, None)] + rows[:3] + rows[:1]


def tree_frame(spark, rows):
    df = spark.createDataFrame([(r[0], r[1], r[3], r[2], r[4]) for r in rows], SCHEMA)
    return df.withColumns({c: F.lit(c) for c in TREE_CLASHING})


@pytest.mark.parametrize("fanout,levels,sizes", [(2, 1, (1, 37, 5, 2)), (3, 1, (28, 1, 90, 10, 4, 9, 27)), (16, 3, (300, 1, 17)), (2, 2, (1,) * 11 + (70,))])
def test_manifest_equals_brute_force(spark, rng, fanout, levels, sizes):
    rows = source_rows(rng, sizes)
    got = manifest_rows(tree_frame(spark, rows), fanout, levels)
    assert got == brute_manifest(rows, fanout)
    assert any(not r[-1] for r in got) and any(r[-1] for r in got)


def test_manifest_of_one_row_one_source_and_none(spark, rng):
    one = [(7, "AB", "s", "en", 2)]
    assert manifest_rows(tree_frame(spark, one), 16, 3) == brute_manifest(one, 16)
    only = [(i % 30, sentence(rng, 4), None, None, None) for i in range(70)]  # a single source, equal ids
    assert manifest_rows(tree_frame(spark, only), 2, 1) == brute_manifest(only, 2)
    assert manifest_rows(documents(spark, []), 16, 3) == []


def test_a_row_that_stands_very_often_goes_over_many_tasks(spark):
    df = spark.range(30_000).select(F.lit(5).cast("long").alias("doc_id"), F.lit("x").alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(1).cast("long").alias("n_chars"))
    out = manifest.manifest(manifest.documents_leaves(df))
    assert out.agg(F.count_distinct("at"), F.min("at"), F.max("at"), F.count_distinct("root")).first()[:] == (30_000, 0, 29_999, 1)
    from strata.llm.ranks import placed
    places = placed(df.select("source", "doc_id"), ["source"], ["doc_id"], "test-places")
    assert places.select(F.spark_partition_id()).distinct().count() > 1


def test_proofs_verify_by_themselves(spark, rng):
    out = manifest.manifest(manifest.documents_leaves(tree_frame(spark, source_rows(rng, (40, 9, 3)))), fanout=2, levels=1)
    assert out.where(manifest.fold(F.col("leaf"), F.col("proof")) != F.col("root")).isEmpty()
    assert out.where(manifest.fold(F.sha2(F.lit("other"), 256), F.col("proof")) == F.col("root")).isEmpty()


# ------------------------------------------------------------------ prefix trie

def brute_rebuilt(convs):
    out = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        model = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        out[c] = convs.get(model, [])[:h] + turns[h:]
    return out


def brute_trie(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    out = []
    for node, of in members.items():
        leaves = saved = 0
        stack = [node]
        while stack:
            x = stack.pop()
            leaves += not kids.get(x)
            saved += (len(members[x]) - 1) * (len(x[-1][1].encode()) if x else 0)
            stack += kids.get(x, [])
        ends = ",".join(map(str, sorted(c for c in of if len(convs[c]) == len(node))))
        out.append((min(of), len(node), min(members[node[:-1]]) if node else None, len(of), len(kids.get(node, [])), leaves, saved, sha(ends)))
    return sorted(out, key=repr)


def by_conversation(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [(r, x) for _, _, r, x in sorted(turns)] for c, turns in convs.items()}


def conversation_rows(rng):
    """Shared prefixes, copies, gaps in ids and turns, nulls, negative ids and a long conversation."""
    words = [(rng.choice(["user", "assistant", None]), rng.choice(["hi", "é" * 3, "", None, "long " * 50, "a", "b"])) for _ in range(9)]
    rows = []
    for c in [*range(-12, 40), 10**15, 10**15 + 1, *range(100, 130)]:
        if c % 10 == 5:
            continue
        seed = random.Random(c // 7 if c < 100 else 100)
        for d in range(seed.randint(1, 12)):
            rows.append((c, None if d == 0 and c % 3 == 0 else d * 2 + (c > 20), *(seed.choice(words) if c % 4 else words[d % 9])))
    rows += [(77, d, "user", f"t{d % 11}") for d in range(300)] + [(78, d, "user", f"t{d % 11}") for d in range(150)]
    return rows + [(None, 1, "user", "nobody's")]


def turn_frame(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    return df.withColumns({c: F.lit(c) for c in TRIE_CLASHING})


def trie_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("shard,segment", [(1024, 4096), (3, 8), (1, 1), (7, 100)])
def test_trie_equals_brute_force(spark, rng, shard, segment):
    rows = conversation_rows(rng)
    df = turn_frame(spark, rows)
    assert trie_rows(prefix_trie.trie(prefix_trie.rebuilt(prefix_trie.numbered(df)), shard, segment)) == brute_trie(brute_rebuilt(by_conversation(rows)))


def test_plain_trie_and_its_texts(spark, rng):
    rows = conversation_rows(rng)
    nodes = prefix_trie.prefix_trie(turn_frame(spark, rows), 10, 50)
    assert trie_rows(nodes) == brute_trie(by_conversation(rows))
    convs = by_conversation(rows)
    texts = prefix_trie.with_turns(nodes, turn_frame(spark, rows)).select("conv_id", "depth", "role", "text").collect()
    assert len(texts) == nodes.count()
    assert all((r["role"], r["text"]) == (convs[r["conv_id"]][r["depth"] - 1] if r["depth"] else (None, None)) for r in texts)


def test_copies_and_long_end_lists(spark):
    rows = [(c, d, "user", f"x{d}") for c in range(700) for d in range(3)] + [(c, 0, "user", "x0") for c in range(700, 720)]
    assert trie_rows(prefix_trie.prefix_trie(turn_frame(spark, rows), 300)) == brute_trie(by_conversation(rows))


def test_trie_of_nothing_and_of_turnless(spark):
    empty = turn_frame(spark, [])
    assert trie_rows(prefix_trie.trie(prefix_trie.rebuilt(prefix_trie.numbered(empty)))) == []
    # ids whose few turns all go, while their model is absent
    rows = [(c, 0, "user", "only") for c in range(11, 15) if zlib.crc32(str(c).encode()) % 9 > 0]
    assert rows
    got = trie_rows(prefix_trie.trie(prefix_trie.rebuilt(prefix_trie.numbered(turn_frame(spark, rows)))))
    assert got == brute_trie(brute_rebuilt(by_conversation(rows))) and len(got) == 1


# -------------------------------------------------------------------- language

TONGUES = {"xa": "bcdeio", "xb": "fghuya", "xc": "klmnoe", "xd": "pqrsté"}


def tongue_text(rng, lang, n):
    """Words of a language's own small vocabulary, some of them in any case."""
    words = random.Random(lang)
    vocabulary = ["".join(words.choice(TONGUES[lang]) for _ in range(words.randint(3, 9))) for _ in range(90)]
    return " ".join(rng.choice(vocabulary) if rng.random() < 0.9 else rng.choice(vocabulary).upper() for _ in range(n))


def spoken(rng, n=160):
    rows = []
    for i in range(n):
        lang = rng.choice(["xa", "xa", "xa", "xb", "xc", "xd"])
        rows.append((i, tongue_text(rng, lang, rng.choice((6, 20, 200))), lang))
    return rows + [(n + k, rows[0][1], rows[0][2]) for k in range(60)]  # a group of copies


def spoken_frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", None) for i, t, lang in rows], SCHEMA).withColumns({c: F.lit(c) for c in (*CLASHING, "h", "l_lang", "piece", "order", "place", "n")})


def test_language_of_held_out_texts(spark, rng):
    rows = spoken(rng)
    model = language.dictionaries(spoken_frame(spark, [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 != 2]))
    assert [name for name, _ in model][0] == "xa" and {name for name, _ in model} == set(TONGUES)
    truth = {i: lang for i, _, lang in rows}
    out = [r for r in language.classify(spoken_frame(spark, rows), model).collect() if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert len(out) > 30 and sum(r["lang_pred"] == truth[r["doc_id"]] for r in out) >= 0.97 * len(out)
    assert all(0 <= r["score"] <= 1 for r in out)


def test_later_parts_of_a_long_text_count(spark, rng):
    model = language.dictionaries(spoken_frame(spark, spoken(rng)))
    text = tongue_text(rng, "xa", 300) + " " + tongue_text(rng, "xc", 3000)
    assert language.Encoders(model).classify(text)[0] == "xc"


def test_sizes_are_those_of_encoding_each_chunk(rng):
    import zstandard
    model = [("p", tongue_text(rng, "xa", 900).encode()), ("q", tongue_text(rng, "xb", 900).encode()), ("tiny", b"abc"), ("none", b"")]
    encoders = language.Encoders(model)
    text = tongue_text(rng, "xa", 1000).upper()
    data = text.lower().encode()
    for k, (_, content) in enumerate(model[:2]):
        params = zstandard.ZstdCompressionParameters.from_level(language.LEVEL, source_size=language.CHUNK, dict_size=len(content), write_content_size=0)
        one = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        parts = [zstandard.ZstdCompressor(dict_data=one, compression_params=params).compress(data[i : i + language.CHUNK]) for i in range(0, len(data), language.CHUNK)]
        back = b"".join(zstandard.ZstdDecompressor(dict_data=one).decompress(p, max_output_size=language.CHUNK) for p in parts)
        assert back == data and abs(encoders.sizes(text)[k] - sum(map(len, parts))) <= 0.02 * sum(map(len, parts))
    assert encoders.classify(text)[0] == "p"


def test_language_edge_cases(spark, rng):
    rows = [(None, "abc"), (1, None), (2, ""), (3, " 123 .,;\n"), (4, "É"), (5, "x" * 300_000), (5, "x" * 300_000), (6, "1²٣"), (7, "\x00a")]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], SCHEMA).withColumns({c: F.lit(c) for c in CLASHING})
    model = language.dictionaries(spoken_frame(spark, spoken(rng, 40)))
    out = language.classify(docs, model).collect()
    assert len(out) == len(rows)
    names = {r["doc_id"]: r["lang_pred"] for r in out}
    assert [names[i] for i in (1, 2, 3, 6)] == ["und"] * 4 and names[4] in TONGUES and names[5] in TONGUES and names[None] in TONGUES
    assert all(r["rejected"] and r["score"] == 0 for r in out if r["lang_pred"] == "und")
    # nothing learnt, one language learnt, an empty table
    assert language.dictionaries(docs) == []
    assert {r["lang_pred"] for r in language.classify(docs, []).collect()} == {"und"}
    assert language.Encoders([("only", b"some text of it")]).classify("abc") == ("only", 1.0)
    assert language.classify(documents(spark, []), model).collect() == []


def test_held_out_rows_are_not_learnt(spark, rng, tmp):
    rows = [(i, t, "wrong" if zlib.crc32(str(i).encode()) % 4 == 2 else lang) for i, t, lang in spoken(rng)]
    spoken_frame(spark, rows).write.parquet(f"{tmp}/documents.parquet")
    out = language.op13_language(spark, tmp).collect()
    assert "wrong" not in {r["lang_pred"] for r in out} and len(out) == len(rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in out)


def test_queries_with_sql():
    assert {"op11_merkle_manifest", "op12_prefix_trie"} <= set(oracle())


@pytest.mark.parametrize("query,table", [("op11_merkle_manifest", "documents"), ("op12_prefix_trie", "conversations")])
def test_sql_equals_the_query(spark, query, table):
    import duckdb

    from strata.llm.queries import registry
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf}/{table}.parquet')")
    df = registry()[query](spark, sf)
    cur = con.execute(oracle()[query])
    names = [d[0] for d in cur.description]
    assert sorted((tuple(r) for r in df.select(*names).collect()), key=repr) == sorted(cur.fetchall(), key=repr)
