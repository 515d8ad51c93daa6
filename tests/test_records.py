"""CSV read in many splits: the same rows as by one task a file."""

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strata.sources import csv as csv_source
from strata.sources import records
from strata.sources.csv import read_csv_text, write_csv

PIECES = ["a", "é", '"', '""', ",", ";", " ", "x" * 9, "\t", "1", "'", ""]


@pytest.fixture()
def small_splits(spark):
    """Splits of a few bytes, so that values go over one or many borders."""
    keys = {"spark.sql.files.maxPartitionBytes": "37b", "spark.sql.files.openCostInBytes": "1b"}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k in keys:
        spark.conf.unset(k)


def scan(line, sep, inside):
    """Whether a line ends inside a quoted value, by reading it character by character."""
    state = "quoted" if inside else "start"
    i = 0
    while i < len(line):
        c = line[i]
        if state == "start":
            state = "quoted" if c == '"' else "start" if c == sep else "plain"
        elif state == "plain":
            state = "start" if c == sep else "plain"
        elif c == '"':
            if line[i + 1 : i + 2] == '"':
                i += 1
            else:
                state = "start" if line[i + 1 : i + 2] == sep else "plain"
                i += line[i + 1 : i + 2] == sep
        i += 1
    return state == "quoted"


@pytest.mark.parametrize("sep", [",", ";", "|", "\t", "]", "^"])
def test_line_rules_equal_a_scan(sep):
    rng = random.Random(5)
    rules = records.LineRules.of(sep)
    lines = ["".join(rng.choice(['"', '"', sep, "a", "é", "\r"]) for _ in range(rng.randint(0, 12))) for _ in range(20_000)]
    first, second = rules.after(pa.array([x.encode() for x in lines], pa.binary()))
    for line, a, b in zip(lines, first, second):
        assert (a, b) == (scan(line, sep, False), scan(line, sep, True)), line


def test_following_equals_a_loop():
    rng = np.random.default_rng(3)
    for _ in range(300):
        n = int(rng.integers(1, 30))
        first, second = rng.random(n) < 0.4, rng.random(n) < 0.6
        for state in (False, True):
            want, s = [], state
            for a, b in zip(first, second):
                s = bool(b if s else a)
                want.append(s)
            assert records.follow(first, second, state).tolist() == want


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def whole(spark, path, sep, schema):
    return csv_source._read_files(spark, path, sep, schema, {"multiLine": True})


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_random_text_equals_a_single_task(spark, tmp, small_splits, end):
    rng = random.Random(11)
    values = lambda: "".join(rng.choice([*PIECES, "\n", "\r\n" if end == "\n" else "\n"]) for _ in range(rng.randint(0, 8)))

    def quoted(v):
        plain = not any(c in v for c in '",\n\r') and rng.random() < 0.7
        return v if plain else '"' + v.replace('"', '""') + '"'

    for k in range(3):
        lines = ["a,b,c"]
        for i in range(120):
            lines.append(",".join([str(i), quoted(values()), quoted(values() * rng.choice((1, 1, 30)))][: rng.choice((3, 3, 3, 2))]) + rng.choice(["", "", ",over"]))
            if rng.random() < 0.1:
                lines.append("")
        path = f"{tmp}/t{k}.csv"
        with open(path, "w", encoding="utf-8", newline="") as f:
            f.write(end.join(lines) + rng.choice(["", end]))
        assert records.worth_splitting(spark, path)
        got = read_csv_text(spark, path)
        assert got.rdd.getNumPartitions() > 20
        assert rows_of(got) == rows_of(whole(spark, path, ",", got.schema))


def test_quotes_inside_plain_values_and_an_open_end(spark, tmp, small_splits):
    text = 'id,name\n1,5" pipe\n2,"two\nlines"\n3,say "hi", over\n4,"a ""b""\n\n\nc"\n5, "no quote\n6,"' + "z\n" * 200 + '"\n7,\n8,""\n9,"open to the end\nof file'
    path = f"{tmp}/odd.csv"
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    got = read_csv_text(spark, path)
    assert rows_of(got) == rows_of(whole(spark, path, ",", got.schema))
    by_id = dict(tuple(r) for r in got.collect())
    assert by_id["6"] == "z\n" * 200 and by_id["4"] == 'a "b"\n\n\nc' and by_id["7"] is None and by_id["8"] == ""


def test_lines_without_breaks_stay_in_the_jvm(spark, tmp, small_splits):
    df = spark.range(400).select(F.col("id").cast("string").alias("id"), F.concat(F.lit('say "'), F.col("id").cast("string"), F.lit('", x')).alias("note"))
    write_csv(df.coalesce(2), f"{tmp}/plain.csv")
    got = read_csv_text(spark, f"{tmp}/plain.csv")
    assert "ArrowEvalPython" not in got._jdf.queryExecution().toString() and "MapInArrow" not in got._jdf.queryExecution().toString()
    assert got.rdd.getNumPartitions() > 20 and rows_of(got) == rows_of(df)


def test_a_folder_of_files_with_headers(spark, tmp, small_splits):
    df = spark.range(300).select(F.col("id").cast("string").alias("i d"), F.when(F.col("id") % 3 > 0, F.concat(F.lit("l1\nl2 \""), F.col("id").cast("string"))).alias("x"),
                                 F.when(F.col("id") % 5 > 0, F.lit("")).alias("y"))
    write_csv(df.repartition(5), f"{tmp}/many.csv", sep=";")
    got = read_csv_text(spark, f"{tmp}/many.csv")
    assert got.columns == ["i d", "x", "y"] and rows_of(got) == rows_of(df)
    assert got.select("y").where("y IS NULL").count() == 60


def test_a_single_column_and_blank_values(spark, tmp, small_splits):
    df = spark.createDataFrame([("a\nb",), ("   ",), ("x" * 50,), (" ",), ('"',)] * 9, "only string")
    write_csv(df.coalesce(1), f"{tmp}/one.csv")
    got = read_csv_text(spark, f"{tmp}/one.csv")
    assert rows_of(got) == rows_of(df)


def test_other_splits_than_in_the_first_pass_fail(spark, tmp, small_splits):
    path = f"{tmp}/cut.csv"
    with open(path, "w", encoding="utf-8") as f:
        f.write("a,b\n" + "".join(f'{i},"x\n\n\ny{i}"\n' for i in range(200)))
    got = read_csv_text(spark, path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "53b")
    with pytest.raises(Exception, match="cut into other splits"):
        got.select("a", "b").collect()


def test_the_private_use_character_is_text(spark, tmp):
    df = spark.createDataFrame([("1", ""), ("2", ""), ("3", None)], "id string, v string")
    write_csv(df, f"{tmp}/pua.csv")
    assert rows_of(read_csv_text(spark, f"{tmp}/pua.csv")) == rows_of(df)


def test_states_over_splits_without_quotes():
    row = lambda start, a, b, opens=True: {"file": 1, "start": start, "length": 10, "from_record": a, "from_value": b, "opens": opens}
    for maps in itertools.permutations([row(0, True, False), row(10, False, True), row(20, True, True), row(40, False, False)]):
        assert records.split_states(list(maps)) == {(1, 0): (False, 10, True), (1, 10): (True, 10, True), (1, 20): (True, 10, True), (1, 40): (True, 10, False)}
