"""Merkle manifest of a dataset, with every row's proof, by butterfly exchange.

A row is a leaf; the leaves of a source, by id, are a tree of fanout F, and the
sources' roots, by source, are the leaves of one more.  F ** levels consecutive
leaves of a source are a block.  A block hashes its own leaves up to one node.
Then blocks swap nodes in rounds: in round r the F blocks of a group whose
numbers differ in digit r only (base F) send each other their node, and all of
them hash the common parent.  After the last round every block holds the root
and the digests beside its path, so no second pass goes down the tree.  Where
the last subtree of a level has fewer blocks than its siblings, its blocks
answer for the missing ones in turn.  The sources' tree goes on in the same
way: a block of source s swaps with blocks of the other sources in its group.

A block's leaves are the only rows that meet in a task (F ** levels of them);
the exchange moves F short rows a block and round.  The driver sees the number
of sources and the blocks of the largest one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.ranks import placed
from strata.llm.store import written

FANOUT = 16
#: A block holds FANOUT ** LEVELS leaves.
LEVELS = 3

PROOF = "array<struct<before: string, after: string>>"


def leaf_hash(values: Sequence[Column]) -> Column:
    """SHA-256 of the values in order: ``-`` for null, else number of UTF-8 bytes, ``:`` and the value."""
    parts = []
    for v in values:
        text = v.cast("string")
        parts.append(F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)))
    return F.sha2(F.concat(*parts), 256)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf's digest gives with a proof."""
    return F.aggregate(proof, leaf, lambda have, step: F.sha2(F.concat(step["before"], have, step["after"]), 256))


def proof_hash(proof: Column) -> Column:
    """SHA-256 of all sibling digests of a proof, from the leaf up, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda step: F.concat(step["before"], step["after"])), ""), 256)


def ladder(digests: list[str], levels: int | None, fanout: int) -> list[list[str]]:
    """The levels of a block's tree, its leaves first, up to ``levels`` (None: until one node is left)."""
    out = [digests]
    while len(out[-1]) > 1 if levels is None else len(out) <= levels:
        below = out[-1]
        out.append([hashlib.sha256("".join(below[i : i + fanout]).encode()).hexdigest() for i in range(0, len(below), fanout)])
    return out


def _block_levels(table: pa.Table, levels: int, fanout: int) -> tuple[np.ndarray, list[list[str]]]:
    """The order of a block's rows and its levels; the only block of a source ends at the source's root."""
    order = np.argsort(table.column("at").to_numpy(), kind="stable")
    digests = table.column("leaf").take(pa.array(order)).to_pylist()
    alone = table.column("n")[0].as_py() <= fanout**levels
    return order, ladder(digests, None if alone else levels, fanout)


def block_nodes(leaves: DataFrame, levels: int, fanout: int) -> DataFrame:
    """(src, block, node): the digest of each block."""
    def run(table: pa.Table) -> pa.Table:
        _, steps = _block_levels(table, levels, fanout)
        return pa.table({"src": table.column("src").slice(0, 1), "block": table.column("block").slice(0, 1), "node": [steps[-1][0]]})

    return leaves.select("src", "block", "at", "n", "leaf").groupBy("src", "block").applyInArrow(run, "src long, block long, node string")


def _swap(state: DataFrame, asked: DataFrame, name: str) -> DataFrame:
    """One round: each block gets the nodes it asked for, hashes them and notes those beside its own.

    ``asked``: (src, block, own, j, from_src, from_block), ``own`` and ``j``
    being the places of its own and of the asked node in their run.
    """
    sent = state.select(F.col("src").alias("s_src"), F.col("block").alias("s_block"), F.col("node").alias("s_node"))
    run = (asked.join(sent, (F.col("from_src") == F.col("s_src")) & (F.col("from_block") == F.col("s_block")))
           .groupBy("src", "block").agg(F.first("own").alias("own"), F.array_sort(F.collect_list(F.struct("j", "s_node"))).alias("run")))
    text = lambda keep: F.array_join(F.transform(F.filter("run", lambda x: keep(x["j"])), lambda x: x["s_node"]), "")
    swapped = run.select(F.col("src").alias("g_src"), F.col("block").alias("g_block"), F.sha2(text(lambda j: F.lit(True)), 256).alias("parent"),
                         F.struct(text(lambda j: j < F.col("own")).alias("before"), text(lambda j: j > F.col("own")).alias("after")).alias("step"))
    out = (state.join(swapped, (F.col("src") == F.col("g_src")) & (F.col("block") == F.col("g_block")), "left")
           .withColumns({"node": F.coalesce("parent", "node"),
                         "proof": F.when(F.col("parent").isNull(), F.col("proof")).otherwise(F.concat("proof", F.array("step")))})
           .select(*state.columns))
    return written(out, name)


def _nodes(count: Column, width: int) -> Column:
    """Subtrees of ``width`` members that ``count`` members make."""
    return F.ceil(count / F.lit(width)).cast("long")


def _member(j: Column, low: Column, count: Column, width: int) -> Column:
    """The member of subtree j that answers a block whose lower digits are ``low``: the last subtree's take turns."""
    first = j * width
    return first + F.pmod(low, F.least(F.lit(width).cast("long"), count - first))


def exchange(nodes: DataFrame, sources: DataFrame, fanout: int) -> DataFrame:
    """(src, block, subroot, root, proof): the upper part of the tree, as each block learns it.

    ``sources``: (src, blocks), numbered from 0 without a gap.
    """
    state = written(nodes.join(sources, "src").select("src", "block", "blocks", "node", F.array().cast(PROOF).alias("proof")), "manifest-round")
    bounds = sources.agg(F.max("blocks").alias("blocks"), F.count(F.lit(1)).alias("sources")).first()
    width = 1
    while width < (bounds["blocks"] or 0):
        group = F.floor(F.col("block") / (width * fanout)) * fanout
        asked = (state.where(_nodes(F.col("blocks"), width) > 1)
                 .select("src", "block", "blocks", group.alias("first"), F.explode(F.sequence(group, F.least(group + fanout, _nodes(F.col("blocks"), width)) - 1)).alias("j"))
                 .select("src", "block", (F.floor(F.col("block") / width) - F.col("first")).alias("own"), (F.col("j") - F.col("first")).alias("j"),
                         F.col("src").alias("from_src"), _member(F.col("j"), F.col("block") % width, F.col("blocks"), width).alias("from_block")))
        state = _swap(state, asked, "manifest-round")
        width *= fanout
    state = state.select("src", "block", "blocks", "node", F.col("node").alias("subroot"), "proof")
    count, width = F.lit(bounds["sources"]).cast("long"), 1
    others = sources.select(F.col("src").alias("from_src"), F.col("blocks").alias("from_blocks"))
    while width < bounds["sources"]:
        group = F.floor(F.col("src") / (width * fanout)) * fanout
        asked = (state.select("src", "block", group.alias("first"), F.explode(F.sequence(group, F.least(group + fanout, _nodes(count, width)) - 1)).alias("j"))
                 .select("src", "block", (F.floor(F.col("src") / width) - F.col("first")).alias("own"), (F.col("j") - F.col("first")).alias("j"),
                         _member(F.col("j"), F.col("src") % width, count, width).alias("from_src"))
                 .join(others, "from_src").withColumn("from_block", F.col("block") % F.col("from_blocks")).drop("from_blocks"))
        state = _swap(state, asked, "manifest-round")
        width *= fanout
    return state.select("src", "block", "subroot", F.col("node").alias("root"), "proof")


def manifest(leaves: DataFrame, carry: Sequence[str] = (), fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """Each leaf with its place, its source's root, the root and its proof.

    ``leaves``: (source, doc_id, leaf digest) and the columns to carry.  Gives
    doc_id, source, at, leaf, subroot, root, ``proof`` (an array, from the leaf
    up, of the digests before and after the path's node in its run, each
    concatenated) and the carried columns.

    A null source is a source, the first one; null ids come first.  Equal ids
    of a source are ordered by digest; rows that agree in both are
    interchangeable.  Sources are ordered by their UTF-8 bytes.  An empty table
    has no tree and gives no rows.  A text's length matters to ``leaf_hash``
    alone: here a row is its digest.  Other columns are dropped, whatever their
    names.
    """
    own = {f"c{i}": c for i, c in enumerate(carry)}
    rows = leaves.select(F.col("source").cast("string").alias("source"), F.col("doc_id").cast("long").alias("doc_id"), "leaf", *[F.col(c).alias(k) for k, c in own.items()])
    rows = placed(rows, ["source"], ["doc_id", "leaf"], "manifest-leaves")
    per_source = rows.groupBy("source").agg(F.count(F.lit(1)).alias("rows"))
    size = fanout**levels
    sources = written(placed(per_source.withColumn("all", F.lit(0)), ["all"], ["source"], "manifest-sources")
                      .select(F.col("source").alias("s_source"), F.col("at").alias("src"), F.ceil(F.col("rows") / size).cast("long").alias("blocks")), "manifest-sources")
    blocked = (rows.join(sources, F.col("source").eqNullSafe(F.col("s_source")))
               .select("src", F.floor(F.col("at") / size).alias("block"), "at", "n", "source", "doc_id", "leaf", *own))
    upper = exchange(block_nodes(blocked, levels, fanout), sources.select("src", "blocks"), fanout)
    fields = {f.name: f.dataType.simpleString() for f in blocked.schema.fields}

    def run(table: pa.Table, above: pa.Table) -> pa.Table:
        order, steps = _block_levels(table, levels, fanout)
        tail = above.column("proof")[0].as_py()
        before: list[str] = []
        after: list[str] = []
        for i in range(len(order)):
            at = i
            for nodes in steps[:-1]:
                first = at - at % fanout
                before.append("".join(nodes[first:at]))
                after.append("".join(nodes[at + 1 : first + fanout]))
                at //= fanout
            before += [x["before"] for x in tail]
            after += [x["after"] for x in tail]
        height = len(steps) - 1 + len(tail)
        pairs = pa.StructArray.from_arrays([pa.array(before, pa.string()), pa.array(after, pa.string())], names=["before", "after"])
        proof = pa.ListArray.from_arrays(pa.array(np.arange(len(order) + 1, dtype=np.int32) * height), pairs)
        sorted_rows = table.take(pa.array(order))
        const = lambda name: pa.array([above.column(name)[0].as_py()] * len(order), pa.string())
        return pa.table([sorted_rows.column(c) for c in ["doc_id", "source", "at", "leaf"]] + [const("subroot"), const("root"), proof] + [sorted_rows.column(c) for c in own],
                        names=["doc_id", "source", "at", "leaf", "subroot", "root", "proof", *own])

    schema = f"doc_id long, source string, at long, leaf string, subroot string, root string, proof {PROOF}" + "".join(f", {c} {fields[c]}" for c in own)
    out = blocked.groupBy("src", "block").cogroup(upper.groupBy("src", "block")).applyInArrow(run, schema)
    return out.withColumnsRenamed(own)


# The letters that the tampering of the query lower-cases.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def documents_leaves(docs: DataFrame) -> DataFrame:
    """(source, doc_id, leaf, seen): digests of documents, and those of the rows as they are seen after tampering."""
    c = {n: F.col(n) for n in ("doc_id", "source", "lang", "n_chars", "text")}
    hit = F.crc32(c["doc_id"].cast("string").cast("binary")) % 5 == 0
    head = [c["doc_id"], c["source"], c["lang"], c["n_chars"]]
    return docs.select("source", "doc_id", leaf_hash([*head, c["text"]]).alias("leaf"),
                       F.when(hit, leaf_hash([*head, F.translate(c["text"], UPPER, LOWER)])).alias("seen"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest of all documents, and what verifying them after tampering finds."""
    out = manifest(documents_leaves(spark.read.parquet(f"{sf_dir}/documents.parquet")), ["seen"])
    folded = fold(F.coalesce("seen", "leaf"), F.col("proof"))
    return (out.select("doc_id", "leaf", "subroot", "root", proof_hash(F.col("proof")).alias("proof_sha256"), folded.alias("folded_root"))
            .withColumn("verified", F.col("folded_root") == F.col("root")))


def oracle_sql(depth: int = 6) -> str:
    """The query in DuckDB SQL, for up to 16 ** depth leaves a source and as many sources."""
    enc = lambda v: f"CASE WHEN {v} IS NULL THEN '-' ELSE strlen(CAST({v} AS VARCHAR)) || ':' || CAST({v} AS VARCHAR) END"
    head = " || ".join(enc(c) for c in ("doc_id", "source", "lang", "n_chars"))
    lower = f"translate(text, '{UPPER}', '{LOWER}')"
    with_ = [f"""base AS (SELECT doc_id, source, sha256({head} || {enc('text')}) AS leaf,
  CASE WHEN {crc32_sql('CAST(doc_id AS VARCHAR)')} % 5 = 0 THEN sha256({head} || {enc(lower)}) END AS seen FROM documents)""",
             "src AS (SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS s FROM (SELECT DISTINCT source FROM base) AS d)",
             """l0 AS (SELECT base.*, s, row_number() OVER (PARTITION BY s ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p
  FROM base JOIN src ON base.source IS NOT DISTINCT FROM src.source)""",
             "n0 AS (SELECT s AS tree, p, leaf AS h FROM l0)"]

    def climb(first: str, tag: str) -> str:
        nodes = first
        for k in range(1, depth + 1):
            with_.append(f"""{tag}r{k} AS (SELECT tree, p // 16 AS g, string_agg(h, '' ORDER BY p) AS run, bool_and(m = 1) AS top
  FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS m FROM {nodes}) AS x GROUP BY tree, p // 16)""")
            with_.append(f"{tag}n{k} AS (SELECT tree, g AS p, CASE WHEN top THEN run ELSE sha256(run) END AS h FROM {tag}r{k})")
            nodes = f"{tag}n{k}"
        return nodes

    subroots = climb("n0", "a")
    with_.append(f"t0 AS (SELECT 0 AS tree, tree AS p, h FROM {subroots})")
    roots = climb("t0", "b")
    with_.append(f"w0 AS (SELECT l0.doc_id, l0.leaf, l0.s, 0 AS tree, l0.p, sub.h AS subroot, r.h AS root, '' AS proof, coalesce(seen, leaf) AS f "
                 f"FROM l0 JOIN {subroots} AS sub ON sub.tree = s CROSS JOIN {roots} AS r)")
    last = "w0"
    for tag in "ab":
        tree = "s" if tag == "a" else "0"
        for k in range(1, depth + 1):
            q = f"({'w.p' if tag == 'a' else 'w.s'} // {16 ** (k - 1)})"
            before, after = f"substr(run, 1, 64 * ({q} % 16))", f"substr(run, 64 * ({q} % 16) + 65)"
            with_.append(f"""{tag}w{k} AS (SELECT w.* EXCLUDE (proof, f), CASE WHEN top THEN proof ELSE proof || {before} || {after} END AS proof,
  CASE WHEN top THEN f ELSE sha256({before} || f || {after}) END AS f
  FROM {last} AS w JOIN {tag}r{k} AS r ON r.tree = w.{tree if tag == 'a' else 'tree'} AND r.g = {q} // 16)""")
            last = f"{tag}w{k}"
    return f"WITH {', '.join(with_)} SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, f AS folded_root, f = root AS verified FROM {last}"


def crc32_sql(text: str) -> str:
    """CRC-32 of an ASCII text in DuckDB SQL."""
    # The reflected polynomial and the all-ones start of CRC-32.
    return f"""xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({text}, ''), lambda c: ord(c)::BIGINT)),
  lambda a, b: list_reduce(list_prepend(xor(a, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"""


ORACLE_SQL = oracle_sql()
