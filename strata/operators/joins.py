"""Conforming joins of a star schema.

* ``lookup_join``  - fact (many) -> dimension (one): left join on one key that
  brings named attributes under role-specific aliases.  The dimension side is
  pruned to key + attributes before the join.
* ``header_detail_join`` - header (one) -> detail (many) fan-out that keeps
  headers without details, in a form in which a hot detail key can be split.
* ``self_lookup`` - a row's parent attribute through the same table.
* ``exceeds_broadcast`` - whether a table is too large for the driver's memory.

No broadcast is forced: Spark decides from size statistics
(``spark.sql.autoBroadcastJoinThreshold``) and, with AQE, from the runtime
size of the shuffled side.  The statistics of a table are those of its files,
though: compressed keys and patterned text can take fifty times as much on the
driver.  A caller that knows better says ``shuffled=True``: the joined table
goes into a sort-merge join and never to the driver.
"""

from __future__ import annotations

import itertools
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_ids = itertools.count()


def _attr_map(attrs) -> dict[str, str]:
    if attrs is None:
        return {}
    if isinstance(attrs, Mapping):
        return dict(attrs)
    return {a: a for a in attrs}


def exceeds_broadcast(df: DataFrame, rows: int | None = None) -> bool:
    """Whether a table takes more memory than Spark may broadcast (``spark.sql.autoBroadcastJoinThreshold``).

    A row takes 8 bytes a column, 8 more for the nulls, and its texts.  If
    ``rows`` is known the texts are only measured where that alone leaves room.
    """
    spark = df.sparkSession
    setting = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    if setting.startswith("-"):
        return False  # nothing is broadcast by its size
    limit = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(setting)
    fixed = 8 * (1 + len(df.columns))
    if rows is not None and rows * fixed > limit:
        return True
    texts = [F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)) for f in df.schema.fields if f.dataType.simpleString() in ("string", "binary")]
    found = df.agg(F.count(F.lit(1)).alias("rows"), F.sum(sum(texts, F.lit(0))).alias("texts")).first()
    return found["rows"] * fixed + (found["texts"] or 0) > limit


def lookup_join(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str | None = None,
                attrs: Mapping[str, str] | Sequence[str] | None = None, *, how: str = "left",
                null_safe: bool = False, few_keys: bool = False, shuffled: bool = False) -> DataFrame:
    """Left-join ``dim`` attributes onto ``fact`` by ``fact_key = dim_key``.

    ``attrs`` maps dimension column -> output name (a list keeps names).  The
    dimension key is not carried into the output, so repeated lookups of the
    same dimension in different roles never produce ambiguous names.
    ``few_keys`` says that the facts name few distinct keys of a large
    dimension: it is cut down to these first, so that the facts need not be
    shuffled by a key with few values.  ``shuffled`` says that what is joined
    (with ``few_keys``, what is left of it) is too large for a broadcast.
    """
    dim_key = dim_key or fact_key
    amap = _attr_map(attrs)
    clash = [a for a in amap.values() if a in fact.columns]
    if clash:
        raise ValueError(f"lookup attributes would shadow fact columns: {clash}")
    tag = next(_ids)
    k = f"__lk{tag}_key"
    right = dim.select(F.col(f"`{dim_key}`").alias(k), *[F.col(f"`{s}`").alias(d) for s, d in amap.items()])
    left_key = F.col(f"`{fact_key}`")
    if few_keys:
        used = f"__lk{tag}_used"
        named = fact.select(left_key.alias(used)).distinct()
        right = right.join(named, (F.col(k).eqNullSafe(F.col(used)) if null_safe else F.col(k) == F.col(used)), "left_semi")
    if shuffled:
        right = right.hint("merge")
    cond = left_key.eqNullSafe(F.col(k)) if null_safe else left_key == F.col(k)
    return fact.join(right, cond, how).drop(k)


def header_detail_join(header: DataFrame, detail: DataFrame, key: str,
                       detail_cols: Sequence[str] | Mapping[str, str],
                       detail_key: str | None = None, observed: bool = False, shuffled: bool = False) -> DataFrame:
    """Every header row with each of its detail rows; headers without details once, with nulls.

    Same rows as ``header LEFT JOIN detail``, built as inner join + anti join
    (+ the headers without a key): the inner join lets AQE split a hot detail
    key across tasks, which a left join can't.  Both joins take the header
    with the same columns and filter, so its plan, with all lookups before it,
    runs once and its exchange is reused; the anti join adds only the detail's
    key column after a map-side distinct.  ``shuffled`` says that the detail is
    too large for a broadcast.
    """
    detail_key = detail_key or key
    amap = _attr_map(detail_cols)
    clash = [a for a in amap.values() if a in header.columns]
    if clash:
        raise ValueError(f"detail columns would shadow header columns: {clash}")
    tag = next(_ids)
    k = f"__hd{tag}_key"
    right = detail.select(F.col(f"`{detail_key}`").alias(k), *[F.col(f"`{s}`").alias(d) for s, d in amap.items()])
    types = {f.name: f.dataType for f in right.schema.fields}
    hk = F.col(f"`{key}`")
    nulls = [F.lit(None).cast(types[d]).alias(d) for d in amap.values()]
    columns = [F.col(f"`{c}`") for c in header.columns]

    def sized(df: DataFrame) -> DataFrame:
        return df.hint("merge") if shuffled else df

    if observed:
        given = right.where(F.col(k).isNotNull())
        matched = header.join(sized(given), hk.eqNullSafe(F.col(k)), "inner").drop(k)
        unmatched = header.join(sized(given.select(k).distinct()), hk.eqNullSafe(F.col(k)), "left_anti").select(*columns, *nulls)
        return matched.unionByName(unmatched)
    keyed = header.where(hk.isNotNull())
    matched = keyed.join(sized(right), hk == F.col(k), "inner").drop(k)
    keys = right.select(k).where(F.col(k).isNotNull()).distinct()
    unmatched = keyed.join(sized(keys), hk == F.col(k), "left_anti").select(*columns, *nulls)
    keyless = header.where(hk.isNull()).select(*columns, *nulls)
    return matched.unionByName(unmatched).unionByName(keyless)


def self_lookup(df: DataFrame, id_col: str, parent_col: str, value_col: str, alias: str,
                **kw) -> DataFrame:
    """Attach the parent row's ``value_col`` (as ``alias``) via ``parent_col = id_col``."""
    return lookup_join(df, df, parent_col, id_col, {value_col: alias}, **kw)
