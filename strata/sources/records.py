"""Records of large CSV files, found in parallel although quoted values hold line breaks.

A file is read as lines in byte-range splits.  A line either starts a record or
goes on inside a quoted value; what it leaves behind is a map of these two
states, and a split's map is the composition of its lines' maps.  The first
pass keeps one map a split (only lines with a quote are looked at).  Composing
them in file order tells in which state every split begins, so that the second
pass can put the lines of its split together to records.  Records that cross a
border are put together from the pieces of the splits they touch.

Quotes in values that don't start with one are plain text, as the CSV parser
has it.  Every split checks at its end that it arrived where the first pass
said; if the file was cut otherwise meanwhile, the job fails.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.sources.paths import file_lengths

PIECES = "file long, start long, part int, heading boolean, value binary"
RECORDS = "file long, start long, value binary"
MAPS = "file long, start long, length long, from_record boolean, from_value boolean, opens boolean"
#: Ends of the names of compressed files.
COMPRESSED = (".gz", ".bz2", ".deflate", ".lz4", ".snappy", ".zst")
_MAP_COLUMNS = [f.split()[0] for f in MAPS.split(", ")]


@dataclass(frozen=True)
class LineRules:
    """How quotes and the delimiter make a line leave a quoted value open."""

    from_record: str  # matches lines that start a record and end inside a quoted value
    from_value: str  # matches lines that start inside a quoted value and end inside one

    @staticmethod
    def of(sep: str) -> LineRules:
        s = re.escape(sep)
        junk = f'(?:[^"{s}][^{s}]*)?'
        text = '(?:[^"]|"")*'
        field = f'(?:[^"{s}][^{s}]*|"{text}"{junk})?'
        opened = f'(?:{field}{s})*"{text}$'
        return LineRules(f"(?s)^{opened}", f'(?s)^(?:{text}$|{text}"{junk}{s}{opened})')

    def after(self, lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Whether each line ends inside a quoted value: if it starts a record, and if it starts inside one."""
        quoted = pc.match_substring(lines, '"').to_numpy(zero_copy_only=False)
        first, second = np.zeros(len(lines), bool), np.ones(len(lines), bool)
        if quoted.any():
            at = np.flatnonzero(quoted)
            some = lines.take(pa.array(at))
            first[at] = pc.match_substring_regex(some, self.from_record).to_numpy(zero_copy_only=False)
            second[at] = pc.match_substring_regex(some, self.from_value).to_numpy(zero_copy_only=False)
        return first, second


def follow(first: np.ndarray, second: np.ndarray, state: bool) -> np.ndarray:
    """The state after each line, from the state before the first one."""
    constant = first == second
    last = np.maximum.accumulate(np.where(constant, np.arange(len(first)), -1))
    turned = np.cumsum(first & ~second)  # lines that swap the states
    known = last >= 0
    base = np.where(known, first[np.maximum(last, 0)], state)
    since = turned - np.where(known, turned[np.maximum(last, 0)], 0)
    return base ^ (since % 2 == 1)


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[int, int, int, pa.Array]]:
    """(file, start, length, lines) of each split in a batch."""
    file, start = batch.column(1).to_numpy(), batch.column(2).to_numpy()
    cuts = np.flatnonzero((file[1:] != file[:-1]) | (start[1:] != start[:-1])) + 1
    length = batch.column(3)
    for a, b in zip([0, *cuts], [*cuts, len(file)]):
        if b > a:
            yield int(file[a]), int(start[a]), length[int(a)].as_py(), batch.column(0).slice(a, b - a)


def _split_maps(rules: LineRules) -> Callable:
    """First pass over lines with quotes, a row a split: (file, start, length, the state after it from a record and from
    inside a value, whether a record may go over a line end)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, ends, opens = None, (False, True), False
        done: list[tuple] = []
        for batch in batches:
            for file, start, length, lines in _runs(batch):
                if (file, start, length) != at:
                    if at is not None:
                        done.append((*at, *ends, opens))
                    at, ends, opens = (file, start, length), (False, True), False
                first, second = rules.after(lines)
                opens = opens or bool(first.any())
                ends = tuple(bool(follow(first, second, e)[-1]) for e in ends)
        if at is not None:
            done.append((*at, *ends, opens))
        columns = list(zip(*done)) or [()] * 6
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 3 + [pa.bool_()] * 3)], _MAP_COLUMNS)

    return run


def _joined(lines: pa.Array, begins: np.ndarray) -> pa.Array:
    """Lines put together with the line breaks between them; ``begins`` names the first line of each record."""
    if len(begins) == len(lines):
        return lines
    groups = pa.ListArray.from_arrays(pa.array(np.append(begins, len(lines)).astype(np.int32)), lines)
    return pc.binary_join(groups, b"\n")


class _Split:
    """The lines of one split, put together to records."""

    def __init__(self, file: int, start: int, state: bool, ends: bool):
        self.file, self.start, self.state, self.ends = file, start, state, ends
        self.closing = state  # lines before the first record belong to an earlier split's record
        self.heading = start == 0  # the next record to end is the header line
        self.pieces: list[tuple] = []  # (part, value): 0 the end of an earlier record, 1 the begin of an unfinished one
        self.held: list[pa.Array] = []

    def add(self, lines: pa.Array, rules: LineRules) -> pa.Array:
        """The records that end in these lines."""
        first, second = rules.after(lines)
        after = follow(first, second, self.state)
        before = np.concatenate(([self.state], after[:-1]))
        self.state = bool(after[-1])
        if before[0]:  # goes on with what is held
            shut = np.flatnonzero(~after)
            if not len(shut):
                self.held.append(lines)
                return lines.slice(0, 0)
            self.held.append(lines.slice(0, shut[0] + 1))
            record = self._let_go()
            lines, before, after = lines.slice(shut[0] + 1), before[shut[0] + 1 :], after[shut[0] + 1 :]
            if self.closing:
                self.pieces.append((0, False, record[0].as_py()))
                self.closing, found = False, [record.slice(0, 0)]
            else:
                found = [record]
        else:
            found = []
        if len(lines):
            begins = np.flatnonzero(~before)
            whole = len(lines)
            if after[-1]:  # the last record is not finished
                whole = int(begins[-1])
                begins = begins[:-1]
                self.held = [lines.slice(whole)]
            found.append(_joined(lines.slice(0, whole), begins) if whole else lines.slice(0, 0))
        out = pa.concat_arrays(found) if len(found) > 1 else found[0]
        if self.heading and len(out):
            self.heading, out = False, out.slice(1)
        return out

    def _let_go(self) -> pa.Array:
        lines = pa.concat_arrays(self.held)
        self.held = []
        return _joined(lines, np.zeros(1, np.int64))

    def end(self) -> None:
        if self.state != self.ends:
            raise ValueError("a CSV file was cut into other splits, or changed, while it was read")
        if self.state:
            self.pieces.append((0 if self.closing else 1, self.heading, self._let_go()[0].as_py()))


def _put_together(rules: LineRules, borders: Callable[[], dict], pieces: bool) -> Callable:
    """Second pass: the complete records of each split, or (``pieces``) what crosses its borders.

    ``borders`` gives (begins inside a value, length, ends inside a value) by
    (file, start), for splits that don't begin and end with a record.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, at, split = borders(), None, None

        def finished() -> Iterator[pa.RecordBatch]:
            if split is not None:
                split.end()
                if pieces and split.pieces:
                    part, heading, value = zip(*split.pieces)
                    n = len(part)
                    yield pa.RecordBatch.from_arrays([pa.array([split.file] * n, pa.int64()), pa.array([split.start] * n, pa.int64()), pa.array(part, pa.int32()),
                                                      pa.array(heading, pa.bool_()), pa.array(value, pa.binary())], ["file", "start", "part", "heading", "value"])

        for batch in batches:
            for file, start, length, lines in _runs(batch):
                if (file, start) != at:
                    yield from finished()
                    at = (file, start)
                    begins, size, ends = known.get(at, (False, length, False))
                    split = _Split(file, start, begins, ends if size == length else None)
                records = split.add(lines, rules)
                if not pieces and len(records):
                    at_file, at_start = (pa.array(np.full(len(records), x, np.int64)) for x in at)
                    yield pa.RecordBatch.from_arrays([at_file, at_start, records], ["file", "start", "value"])
        yield from finished()

    return run


def _lines(spark: SparkSession, path: str) -> DataFrame:
    # one-byte line ends: what ends in CR LF keeps its CR until records are whole
    return (spark.read.option("lineSep", "\n").text(path)
            .select(F.col("value").cast("binary").alias("value"), F.xxhash64("_metadata.file_path").alias("file"),
                    F.col("_metadata.file_block_start").alias("start"), F.col("_metadata.file_block_length").alias("length")))


def split_states(maps: list) -> dict[tuple[int, int], tuple[bool, int, bool]]:
    """(begins inside a value, length, ends inside one) of the splits of which either is so.

    Only these go to the tasks.
    """
    out, state, file = {}, False, None
    for r in sorted(maps, key=lambda r: (r["file"], r["start"])):
        if r["file"] != file:
            state, file = False, r["file"]
        before, state = state, r["from_value"] if state else r["from_record"]
        if before or state:
            out[r["file"], r["start"]] = (before, r["length"], state)
    return out


def _without_quotes_between(spark: SparkSession, path: str, states: dict) -> dict:
    """Adds the splits without any quote that lie within a value, which the first pass gave no row for."""
    inside = {}
    for (file, start), (_, length, ends) in states.items():
        if ends:
            inside[file, start + length] = None
    missing = [k for k in inside if k not in states]
    if not missing:
        return states
    splits = {}
    for r in _lines(spark, path).groupBy("file", "start").agg(F.max("length").alias("length")).collect():
        splits[r["file"], r["start"]] = r["length"]
    for file, start in missing:
        while (file, start) in splits and (file, start) not in states:
            states[file, start] = (True, splits[file, start], True)
            start += splits[file, start]
    return states


def split_maps(spark: SparkSession, path: str, sep: str) -> list:
    """The first pass over a table: one short row a split that has quotes reaches the driver."""
    quoted = _lines(spark, path).where(F.col("value").cast("string").contains('"'))
    return quoted.mapInArrow(_split_maps(LineRules.of(sep)), MAPS).collect()


def csv_records(spark: SparkSession, path: str, sep: str, crlf: bool, maps: list) -> DataFrame:
    """(file, start, value): the text of every record below the header lines, read in parallel.

    ``file`` is a hash of the path and ``start`` where the split begins that the
    record begins in.  ``maps`` are those of the first pass.  Empty records are
    left out.
    """
    rules = LineRules.of(sep)
    states = _without_quotes_between(spark, path, split_states(maps))
    shared = spark.sparkContext.broadcast(states)
    lines = _lines(spark, path)
    records = lines.mapInArrow(_put_together(rules, lambda: shared.value, False), RECORDS)
    if states:
        touched = spark.createDataFrame(list(states), "t_file long, t_start long")
        crossing = lines.join(F.broadcast(touched), (F.col("file") == F.col("t_file")) & (F.col("start") == F.col("t_start"))).drop("t_file", "t_start")
        pieces = crossing.mapInArrow(_put_together(rules, lambda: shared.value, True), PIECES)
        order = Window.partitionBy("file").orderBy("start", "part")
        ended = (pieces.withColumn("record", F.sum("part").over(order)).groupBy("file", "record")
                 .agg(F.max("heading").alias("heading"), F.array_sort(F.collect_list(F.struct("start", "part", "value"))).alias("all")))
        records = records.unionByName(ended.where("not heading").select("file", F.col("all")[0]["start"].alias("start"),
            F.array_join(F.transform("all", lambda p: p["value"].cast("string")), "\n").cast("binary").alias("value")))
    text = F.col("value").cast("string")
    if crlf:
        text = F.regexp_replace(text, "\\r\\z", "")
    return records.select("file", "start", text.alias("value")).where("value <> ''")


def worth_splitting(spark: SparkSession, path: str) -> bool:
    """Whether the largest file at a path is more than one split of a scan; compressed files can't be split."""
    lengths = file_lengths(spark, path, but=COMPRESSED)
    if not lengths:
        return False
    number = lambda key, default: int(spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key, default)))
    open_cost = number("spark.sql.files.openCostInBytes", "4MB")
    share = sum(n + open_cost for n in lengths) // max(1, spark.sparkContext.defaultParallelism)
    return max(lengths) > min(number("spark.sql.files.maxPartitionBytes", "128MB"), max(open_cost, share))
