"""Extracts and CSV tables that grow: files, tasks and rows a task stay bounded, results are whole."""

import glob
import gzip

from pyspark.sql import functions as F

from strata.harness import extracts, queries
from strata.harness.extracts import write_extract
from strata.sources.csv import read_csv_text
from strata.sources.parquet import write_table
from strata.sources.paths import folder_bytes
from strata.sources.records import worth_splitting


def orders(spark, path, n):
    rows = spark.range(0, n, 1, 1).select((F.col("id") + 1).alias("o_orderkey"), (F.col("id") % 40).alias("o_custkey"), F.lit("F").alias("o_orderstatus"), F.lit(1.5).alias("o_totalprice"),
                                          F.lit("1996-02-03 00:00:00").cast("timestamp_ntz").alias("o_orderdate"), F.lit("1-URGENT").alias("o_orderpriority"))
    rows.write.parquet(f"{path}/orders.parquet")
    return path


def test_extracts_are_bounded_compressed_files(spark, tmp, monkeypatch):
    monkeypatch.setattr(extracts, "FILE_ROWS", 100)
    odd = spark.range(0, 950, 1, 1).select(F.col("id").cast("string").alias("id"), F.when(F.col("id") % 3 > 0, F.concat(F.lit('two\nlines, "'), F.col("id").cast("string"))).alias("note"))
    write_extract(odd, f"{tmp}/odd.csv")
    files = glob.glob(f"{tmp}/odd.csv/part-*.csv.gz")
    assert len(files) == 10 and not glob.glob(f"{tmp}/odd.csv/part-*.csv")
    assert all(gzip.open(f, "rt").readline() == "id,note\n" for f in files)
    key = "spark.sql.files.maxPartitionBytes"
    spark.conf.set(key, "200b")
    try:
        assert not worth_splitting(spark, f"{tmp}/odd.csv")
        assert sorted(map(tuple, read_csv_text(spark, f"{tmp}/odd.csv").collect()), key=repr) == sorted(map(tuple, odd.collect()), key=repr)
    finally:
        spark.conf.unset(key)


def test_many_splits_make_few_tasks(spark, tmp):
    sf = orders(spark, f"{tmp}/sf", 120_000)
    out = queries.q_csv_many_splits(spark, sf)
    assert len(out.inputFiles()) <= 5 * spark.sparkContext.defaultParallelism
    want = queries._odd_rows(spark, sf)
    assert out.count() == 120_000 and out.exceptAll(want).isEmpty()


def test_landed_files_are_bounded(spark, tmp, monkeypatch):
    sf = orders(spark, f"{tmp}/sf", 900)
    monkeypatch.setattr(queries, "LANDING_ROWS", 150)
    monkeypatch.setattr(queries, "scratch_dir", lambda spark, name: f"{tmp}/scratch")
    out = queries.silver_incremental(spark, sf)
    assert len(glob.glob(f"{tmp}/scratch/landing/part-*")) == 6
    assert sorted(r.order_id for r in out.collect()) == list(range(1, 901))


def test_tables_are_written_small(spark, tmp):
    df = spark.range(0, 100_000, 1, 1).select((F.col("id") * 100 + F.col("id") % 7).alias("k"), F.concat(F.lit("Part "), (F.col("id") * 7919 % 60_000).cast("string")).alias("t"))
    write_table(df, f"{tmp}/t")
    df.write.option("compression", "snappy").parquet(f"{tmp}/session")
    assert spark.read.parquet(f"{tmp}/t").exceptAll(df).isEmpty()
    assert folder_bytes(spark, f"{tmp}/t")[1] < 0.8 * folder_bytes(spark, f"{tmp}/session")[1]
