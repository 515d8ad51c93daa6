import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from conftest import write_text
from strata.operators.impute import fill_constants, fill_from_parent_then_mean, impute_report
from strata.operators.ingest import choose_format, parse_first_format, split_by_year
from strata.operators.quality import (duplicate_keys, is_date_like_name, layer_overview, run_summary,
                                      suspicious_dates, table_profile, table_sample, validate_nulls)
from strata.plans.ingest_jobs import snapshot, split_batch
from strata.sources.csv import detect_delimiter, pick_delimiter, read_bronze, read_csv_text, write_csv
from strata.sources.publish import publish_layer


def test_pick_delimiter_rules():
    assert pick_delimiter("a;b;c") == ";"
    assert pick_delimiter("a,b;c") == ","        # tie -> first
    assert pick_delimiter("abc") == ","          # neither -> comma
    assert pick_delimiter(None) == ","           # unreadable -> comma


def test_detect_and_read_semicolon_ragged(spark, tmp):
    p = write_text(f"{tmp}/t.csv", "a;b;c\n1;2;3\n4;5\n6;7;8;9\n")
    assert detect_delimiter(spark, p) == ";"
    rows = read_csv_text(spark, p).collect()
    assert [tuple(r) for r in rows] == [("1", "2", "3"), ("4", "5", None), ("6", "7", "8")]


def test_read_bronze_quoted_and_tokens(spark, tmp):
    p = write_text(f"{tmp}/q.csv", 'id,name,limit\n1,"Acme (Ely, UK)",NULL\n2,"Say ""hi""",N/A\n3,x,12.5\n')
    rows = read_bronze(spark, p).orderBy("id").collect()
    assert rows[0].name == "Acme (Ely, UK)" and rows[0].limit is None
    assert rows[1].name == 'Say "hi"' and rows[1].limit is None
    assert rows[2].limit == "12.5"


def _dates(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, d string")


def test_choose_format_is_all_or_nothing(spark):
    assert choose_format(_dates(spark, ["2013-04-15 12:34:56.123", "2013-04-15 12:00:00", None]), "d") \
        == "yyyy-MM-dd HH:mm:ss[.SSSSSSSSS]"
    assert choose_format(_dates(spark, ["2013-04-15", "2014-01-01"]), "d") == "yyyy-MM-dd"
    assert choose_format(_dates(spark, ["15/04/2013", "01/02/2014"]), "d") == "dd/MM/yyyy"
    assert choose_format(_dates(spark, ["15/04/2013", "2014-01-01"]), "d") is None   # no single format


def test_parse_first_format_unparseable_returns_unchanged(spark):
    df = _dates(spark, ["15/04/2013", "junk"])
    out, fmt = parse_first_format(df, "d")
    assert fmt is None and out.columns == ["id", "d"]


def test_split_by_year_window(spark):
    df = _dates(spark, ["2012-12-31", "2013-01-01", "2014-12-31 23:59:59", "2015-01-01", None])
    # mixed date / datetime text: only the datetime pattern fails on plain dates -> second format
    df = df.withColumn("d", F.substring("d", 1, 10))
    out = split_by_year(df, "d", 2013, 2014)
    assert sorted(r.id for r in out.collect()) == [1, 2]
    assert "d_parsed" in out.columns
    with pytest.raises(ValueError):
        split_by_year(_dates(spark, ["x"]), "d", 2013, 2014)
    assert split_by_year(_dates(spark, ["x"]), "d", 2013, 2014, on_unparsed="keep").count() == 1


def test_split_batch_pass_through_snapshot(spark, tmp):
    raw = f"{tmp}/raw"
    write_text(f"{raw}/sales.order.csv",
               "OrderID;LastEditedWhen\n1;01/01/2012\n2;15/06/2013\n3;31/12/2014\n4;01/01/2015\n5;\n")
    write_text(f"{raw}/warehouse.colors.csv", "ColorID,ColorName\n1,Red\n2,Blue\n")
    write_text(f"{raw}/sales.customer.csv", "CustomerID,ValidFrom\n1,2010-01-01\n")
    st = {r.table: r for r in split_batch(spark, raw, f"{tmp}/bronze", 2013, 2014).collect()}
    assert st["sales.order"].rows == 2 and st["sales.order"].status == "ok"
    assert st["sales.customer"].rows == 0 and st["sales.customer"].status == "empty"
    assert st["warehouse.colors"].rows == 2                       # not configured -> copied
    assert st["purchase.order"].status == "missing"
    kept = read_csv_text(spark, f"{tmp}/bronze/actual/sales.order.csv")
    assert sorted(r.OrderID for r in kept.collect()) == ["2", "3"]
    assert "LastEditedWhen_parsed" in kept.columns
    up = {r.table: r for r in snapshot(spark, raw, f"{tmp}/bronze").collect()}
    assert up["sales.order"].rows == 5 and up["sales.order"].label == "upcoming"


def test_validate_nulls_statuses(spark):
    df = spark.createDataFrame([(1, None, "a"), (None, None, "b")], "id int, opt string, name string")
    rep = {r.column: r for r in validate_nulls(df, {"opt": "not captured", "gone": "n/a"},
                                               ["id", "name", "missing_col"]).collect()}
    assert rep["opt"].status == "expected" and rep["opt"].nulls == 2 and rep["opt"].reason == "not captured"
    assert rep["id"].status == "unexpected" and rep["id"].nulls == 1
    assert rep["name"].status == "ok"
    assert rep["gone"].status == "missing" and rep["missing_col"].status == "missing"


def test_profile_overview_duplicates(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "c")], "k int, v string")
    prof = {r.column: r for r in table_profile(df).collect()}
    assert (prof["v"].nulls, prof["v"].non_nulls, prof["v"].data_type) == (1, 2, "string")
    ov = layer_overview({"t": df}, "silver").first()
    assert (ov.rows, ov.cols, ov.nulls) == (3, 2, 1)
    assert [tuple(r) for r in duplicate_keys(df, "k").collect()] == [(1, 2)]
    assert [r.k for r in table_sample(df, 2, ["k", "v"]).collect()] == [1, 1]


def test_suspicious_dates_substring_and_token(spark):
    df = spark.createDataFrame([("2013-01-01", "x", "y", 1)], "valid_to string, customer_name string, note string, n int")
    cols = {r.column for r in suspicious_dates({"t": df}).collect()}
    assert cols == {"valid_to", "customer_name"}
    assert is_date_like_name("valid_to", whole_token=True)
    assert not is_date_like_name("customer_name", whole_token=True)


def test_impute_helpers(spark):
    df = spark.createDataFrame([(1, 1, 10.0, None), (2, 1, None, "x"), (3, 3, None, None), (4, 3, 30.0, None)],
                               "id bigint, parent bigint, v double, s string")
    out = fill_from_parent_then_mean(df, "id", "parent", "v")
    got = {r.id: r.v for r in out.collect()}
    assert got == {1: 10.0, 2: 10.0, 3: 20.0, 4: 30.0}
    filled = fill_constants(df, {"s": "n/a"})
    assert sorted(r.s for r in filled.collect()) == ["n/a", "n/a", "n/a", "x"]
    rep = {r.column: (r.nulls_before, r.nulls_after, r.pct_before, r.pct_after) for r in impute_report(df, out, ["v"]).collect()}
    assert rep == {"v": (2, 0, 50.0, 0.0)}


def test_publish_layer_isolates_failures(spark, tmp):
    src = f"{tmp}/silver"
    spark.range(5).write.parquet(f"{src}/sales/orders")
    spark.range(3).write.parquet(f"{src}/dimensions/colors")
    os.makedirs(f"{src}/dimensions/broken")
    write_text(f"{src}/dimensions/broken/part-0.parquet", "not parquet")
    st = {r.table: r for r in publish_layer(spark, src, f"{tmp}/pub", domains=["sales", "dimensions"]).collect()}
    assert st["sales/orders"].rows == 5 and st["dimensions/colors"].rows == 3
    assert st["dimensions/broken"].status == "failed" and st["dimensions/broken"].error
    assert spark.read.parquet(f"{tmp}/pub/sales/orders").count() == 5


def test_run_summary(spark):
    st = spark.createDataFrame([("silver", "ok"), ("silver", "failed"), ("gold", "ok")], "layer string, status string")
    got = {r.layer: (r.jobs, r.ok, r.failed) for r in run_summary(st).collect()}
    assert got == {"silver": (2, 1, 1), "gold": (1, 1, 0)}


def test_file_sizes(spark, tmp):
    from strata.operators.quality import file_sizes
    spark.range(1000).repartition(3).write.parquet(f"{tmp}/t")
    r = file_sizes(spark, {"t": f"{tmp}/t"}).first()
    on_disk = sum(os.path.getsize(f"{tmp}/t/{f}") for f in os.listdir(f"{tmp}/t") if f.endswith(".parquet"))
    assert r.files == 3 and r.bytes == on_disk


def test_split_batch_second_format_and_unparseable(spark, tmp):
    raw = f"{tmp}/raw2"
    # dates only as yyyy-MM-dd: the optimistic first format fails, the second fits
    write_text(f"{raw}/sales.order.csv", "OrderID,LastEditedWhen\n1,2012-05-01\n2,2013-05-01\n3,2014-05-01\n")
    write_text(f"{raw}/sales.invoices.csv", "InvoiceID,LastEditedWhen\n1,2013-05-01\n2,May 5th\n")
    st = {r.table: r for r in split_batch(spark, raw, f"{tmp}/bronze", 2013, 2014,
                                          tables={"sales.order": "LastEditedWhen",
                                                  "sales.invoices": "LastEditedWhen"}).collect()}
    assert (st["sales.order"].status, st["sales.order"].rows) == ("ok", 2)
    kept = read_csv_text(spark, f"{tmp}/bronze/actual/sales.order.csv")
    assert sorted(r.OrderID for r in kept.collect()) == ["2", "3"]
    assert st["sales.invoices"].status == "failed"
    assert not os.path.exists(f"{tmp}/bronze/actual/sales.invoices.csv")
    st = {r.table: r for r in split_batch(spark, raw, f"{tmp}/bronze2", 2013, 2014, on_unparsed="keep",
                                          tables={"sales.invoices": "LastEditedWhen"}).collect()}
    assert (st["sales.invoices"].status, st["sales.invoices"].rows) == ("ok", 2)


def test_publish_csv_layer(spark, tmp):
    src = f"{tmp}/bronze_pub/actual"
    write_text(f"{src}/sales.order.csv", "OrderID,Note\n1,a\n2,\"b, c\"\n")
    write_text(f"{src}/warehouse.colors.csv", "ColorID;ColorName\n1;Red\n")
    st = {r.table: r for r in publish_layer(spark, f"{tmp}/bronze_pub", f"{tmp}/pub_csv", fmt="csv",
                                            domains=["actual"]).collect()}
    assert st["actual/sales.order.csv"].rows == 2 and st["actual/warehouse.colors.csv"].rows == 1
    back = read_csv_text(spark, f"{tmp}/pub_csv/actual/sales.order.csv").orderBy("OrderID").collect()
    assert back[1].Note == "b, c"


def test_cli_ingest_and_views(spark, tmp):
    from strata.__main__ import main
    from strata.sources.parquet import register_views
    raw = f"{tmp}/raw3"
    write_text(f"{raw}/sales.order.csv", "OrderID,LastEditedWhen\n1,2013-05-01 10:00:00\n2,2016-01-01 00:00:00\n")
    write_text(f"{raw}/warehouse.colors.csv", "ColorID,ColorName\n1,Red\n")
    assert main(["ingest", raw, f"{tmp}/bronze3"]) == 1      # other configured tables are missing
    assert read_csv_text(spark, f"{tmp}/bronze3/actual/sales.order.csv").count() == 1
    assert read_csv_text(spark, f"{tmp}/bronze3/upcoming/sales.order.csv").count() == 2
    spark.range(3).write.parquet(f"{tmp}/lake/dimensions/colors")
    assert register_views(spark, f"{tmp}/lake", ["dimensions/colors"]) == ["colors"]
    assert spark.sql("SELECT count(*) AS n FROM colors").first().n == 3


def test_validate_nulls_without_policy_and_nan(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "x double")
    assert validate_nulls(df).collect() == []
    assert validate_nulls(df, required=["x"]).first().nulls == 2


def test_failed_or_empty_split_keeps_the_earlier_batch(spark, tmp):
    raw, out = f"{tmp}/raw", f"{tmp}/bronze"
    tables = {"sales.order": "LastEditedWhen"}
    write_text(f"{raw}/sales.order.csv", "OrderID,LastEditedWhen\n1,2013-05-01\n")
    split_batch(spark, raw, out, 2013, 2014, tables=tables).collect()
    for text, status in (("OrderID,LastEditedWhen\n1,2013-05-01\n2,May 5th\n", "failed"), ("OrderID,LastEditedWhen\n1,1999-05-01\n", "empty")):
        write_text(f"{raw}/sales.order.csv", text)
        assert split_batch(spark, raw, out, 2013, 2014, tables=tables).first().status == status
        assert read_csv_text(spark, f"{out}/actual/sales.order.csv").count() == 1
    assert [n for n in os.listdir(f"{out}/actual")] == ["sales.order.csv"]


def test_guess_misled_by_the_first_rows(spark, tmp):
    raw = f"{tmp}/raw"
    rows = "".join(f"{i},2013-05-01\n" for i in range(300)) + "300,2013-06-01 10:00:00\n"
    write_text(f"{raw}/a.csv", "id,d\n" + rows.replace("2013-05-01", "01/05/2013").replace("2013-06-01 10:00:00", "02/06/2013"))
    assert split_batch(spark, raw, f"{tmp}/b", 2013, 2013, tables={"a": "d"}).first().rows == 301
    write_text(f"{raw}/a.csv", "id,d\n" + rows)
    assert split_batch(spark, raw, f"{tmp}/b", 2013, 2013, tables={"a": "d"}).first().status == "failed"


def test_csv_gives_back_what_went_in(spark, tmp):
    rows = [(1, "two\nlines"), (2, "  lead and trail  "), (3, ""), (4, None), (5, 'q"uo;te,"'), (6, "a\r\nb"), (7, "\t")]
    df = spark.createDataFrame([(str(i), v) for i, v in rows], "id string, v string")
    for sep in ",;":
        write_csv(df, f"{tmp}/t.csv", sep=sep)
        assert sorted((int(r.id), r.v) for r in read_csv_text(spark, f"{tmp}/t.csv").collect()) == rows
    with pytest.raises(ValueError, match="line end"):
        read_csv_text(spark, f"{tmp}/t.csv", splittable=True)
    write_text(f"{tmp}/h.csv", '"a;b",c\n1,2\n')
    assert read_csv_text(spark, f"{tmp}/h.csv").columns == ["a;b", "c"]


def test_missing_folders_are_errors(spark, tmp):
    from strata.__main__ import main
    with pytest.raises(FileNotFoundError):
        publish_layer(spark, f"{tmp}/none", f"{tmp}/out")
    with pytest.raises(FileNotFoundError):
        main(["ingest", f"{tmp}/none", f"{tmp}/bronze"])


def test_whole_error_text_is_kept(spark, tmp):
    os.makedirs(f"{tmp}/src/t")
    write_text(f"{tmp}/src/t/part-0.parquet", "not parquet")
    assert len(publish_layer(spark, f"{tmp}/src", f"{tmp}/out").first().error) > 200


def test_shared_folder_is_required_on_a_cluster(spark, monkeypatch):
    import strata.session as session
    monkeypatch.setattr(session, "is_local", lambda s: False)

    class Bare:
        class sparkContext:
            getCheckpointDir = staticmethod(lambda: None)

        class conf:
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(Bare)
