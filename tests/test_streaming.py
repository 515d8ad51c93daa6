import datetime as dt
import os
import subprocess
import sys

from conftest import write_text
from fixtures import table_csv
from strata.plans.specs import BY_NAME
from strata.streaming import incremental_silver


def _run(spark, tdef, landing, silver, ckpt=None, **kw):
    q = incremental_silver(spark, tdef, landing, silver, checkpoint=ckpt, **kw)
    q.awaitTermination(120)
    assert q.exception() is None
    return q


def test_incremental_orders(spark, tmp):
    tdef = BY_NAME["orders"]
    landing, silver, ckpt = f"{tmp}/landing", f"{tmp}/silver", f"{tmp}/ckpt"
    write_text(f"{landing}/a.csv", table_csv("orders", {"OrderID": [1, 2], "PickedByPersonID": ["12.0", "NA"],
                                                       "OrderDate": ["2013-01-01", "2013-01-02"]}, 2))
    q = _run(spark, tdef, landing, silver, ckpt)
    metrics = [p["observedMetrics"]["silver_orders"] for p in q.recentProgress if p.get("observedMetrics")]
    assert metrics and metrics[-1]["rows"] == 2 and metrics[-1]["null_picked_by_id"] == 1
    out = spark.read.parquet(f"{silver}/{tdef.output_path}")
    got = {r.order_id: (r.picked_by_id, r.order_date) for r in out.collect()}
    assert got == {1: (12, dt.datetime(2013, 1, 1)), 2: (None, dt.datetime(2013, 1, 2))}
    # a second load appends; a rerun with nothing new changes nothing
    write_text(f"{landing}/b.csv", table_csv("orders", {"OrderID": [3]}, 1))
    _run(spark, tdef, landing, silver, ckpt)
    _run(spark, tdef, landing, silver, ckpt)
    out = spark.read.parquet(f"{silver}/{tdef.output_path}")
    assert sorted(r.order_id for r in out.collect()) == [1, 2, 3]
    assert dict(out.dtypes)["order_id"] == "bigint" and "ingest_batch" in out.columns


def _load(root):
    """A whole application of its own: start a session, load what has landed, stop."""
    code = f"""
import sys
sys.path[:0] = {[p for p in sys.path if p]!r}
from strata.plans.specs import BY_NAME
from strata.session import get_session
from strata.streaming import incremental_silver
spark = get_session("local[2]", shuffle_partitions=2)
q = incremental_silver(spark, BY_NAME["orders"], "{root}/landing", "{root}/silver")
q.awaitTermination(120)
assert q.exception() is None
spark.stop()
"""
    env = {k: v for k, v in os.environ.items() if not k.startswith("PYSPARK_GATEWAY")}
    subprocess.run([sys.executable, "-c", code], check=True, env=env, timeout=300, capture_output=True)


def test_another_application_goes_on_where_the_last_one_stopped(spark, tmp):
    write_text(f"{tmp}/landing/a.csv", table_csv("orders", {"OrderID": [1]}, 1))
    write_text(f"{tmp}/landing/b.csv", table_csv("orders", {"OrderID": [2]}, 1))
    _load(tmp)
    write_text(f"{tmp}/landing/c.csv", table_csv("orders", {"OrderID": [3]}, 1))
    os.remove(f"{tmp}/landing/a.csv")              # archived meanwhile
    _load(tmp)
    out = spark.read.parquet(f"{tmp}/silver/{BY_NAME['orders'].output_path}")
    assert sorted(r.order_id for r in out.collect()) == [1, 2, 3]


def test_two_landing_folders_and_other_headers(spark, tmp):
    tdef = BY_NAME["orders"]
    text = table_csv("orders", {"OrderID": [1]}, 1)
    write_text(f"{tmp}/l1/a.csv", text)
    write_text(f"{tmp}/l2/a.csv", table_csv("orders", {"OrderID": [2]}, 1).replace(",", ";"))
    _run(spark, tdef, f"{tmp}/l1", f"{tmp}/silver")
    _run(spark, tdef, f"{tmp}/l2", f"{tmp}/silver")
    out = spark.read.parquet(f"{tmp}/silver/{tdef.output_path}")
    assert sorted(r.order_id for r in out.collect()) == [1, 2]
    # a file with its columns in another order fails the stream
    header, *rows = text.strip().split("\n")
    turned = "\n".join(",".join(reversed(line.split(","))) for line in [header, *rows])
    write_text(f"{tmp}/l1/z.csv", turned + "\n")
    q = incremental_silver(spark, tdef, f"{tmp}/l1", f"{tmp}/silver")
    try:
        q.awaitTermination(120)
    except Exception:  # noqa: BLE001 - the stream's failure
        pass
    assert q.exception() is not None
    assert spark.read.parquet(f"{tmp}/silver/{tdef.output_path}").count() == 2
