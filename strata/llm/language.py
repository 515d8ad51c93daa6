"""Language of texts by compression with per-language dictionaries.

Each language has a zstandard raw-content dictionary: pieces of its labelled
texts.  A text is encoded with every dictionary in chunks of ``CHUNK`` bytes,
so that the dictionary and not the text's own beginning is what later parts are
encoded with, and the language whose encoding is the smallest wins.  The margin
is the share by which the second smallest is larger; a narrow one rejects.

Dictionaries come from a bounded sample: of each language ``SNIPPETS`` distinct
texts with the smallest hashes (copies count once), of each ``SNIPPET``
characters from a place that the hash names, at most ``DICT_BYTES`` a language
and ``MODEL_BYTES`` together.  Whole texts are classified.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SNIPPETS = 200
SNIPPET = 600
DICT_BYTES = 64_000
MODEL_BYTES = 64_000_000
LEVEL = 7
CHUNK = 1024
#: Margin below which a prediction is rejected.
NARROW = 0.005
#: Said of texts without a letter.
UNDETERMINED = "und"

_LETTER = regex.compile(r"\p{L}")


def dictionaries(labelled: DataFrame, snippets: int = SNIPPETS, seed: int = 13) -> list[tuple[str, bytes]]:
    """(language, dictionary), languages with the most rows first, from (text, lang) rows; null ones are left out.

    What reaches the driver is a count a language and the sample.
    """
    rows = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"), F.xxhash64(F.lit(seed), F.col("text").cast("string")).alias("h"))
    counts = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct("h").alias("texts")).collect()
    if not counts:
        return []
    # the hash cuts every language down to about its sample before texts are grouped
    limits = [(r["lang"], int(min(1.0, (1.5 * snippets + 60) / max(1, r["texts"])) * (1 << 30))) for r in counts]
    few = F.broadcast(rows.sparkSession.createDataFrame(limits, "l_lang string, l_limit long"))  # a row a language
    near = rows.join(few, F.col("lang") == F.col("l_lang"))
    near = near.where(F.pmod(F.xxhash64("h"), F.lit(1 << 30)) < F.col("l_limit"))
    room = F.greatest(F.lit(1), F.char_length("text") - F.lit(SNIPPET - 1))
    piece = F.substring("text", (F.pmod("h", room) + 1).cast("int"), F.lit(SNIPPET))
    first = Window.partitionBy("lang").orderBy("order")
    sample = (near.groupBy("lang", "h").agg(F.first(piece).alias("piece")).withColumn("order", F.xxhash64("h"))
              .withColumn("place", F.row_number().over(first)).where(F.col("place") <= snippets).select("lang", "place", "piece").collect())
    size = min(DICT_BYTES, MODEL_BYTES // len(counts))
    pieces: dict[str, list] = {}
    for r in sorted(sample, key=lambda r: (r["lang"], r["place"])):
        pieces.setdefault(r["lang"], []).append(r["piece"].lower())
    most = sorted(counts, key=lambda r: (-r["n"], r["lang"]))
    return [(r["lang"], "\n".join(pieces.get(r["lang"], [])).encode("utf-8", "replace")[:size]) for r in most]


class Encoders:
    """One compressor a language."""

    def __init__(self, model: Sequence[tuple[str, bytes]], level: int = LEVEL):
        self.names = [name for name, _ in model]
        self.compressors = []
        for _, content in model:
            params = zstandard.ZstdCompressionParameters.from_level(level, source_size=CHUNK, dict_size=len(content), write_content_size=0)
            if len(content) < 8:  # zstandard takes no shorter dictionary
                self.compressors.append(zstandard.ZstdCompressor(compression_params=params))
                continue
            shared = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            shared.precompute_compress(compression_params=params)
            self.compressors.append(zstandard.ZstdCompressor(dict_data=shared, compression_params=params))

    def sizes(self, text: str) -> list[int]:
        """Bytes of the lower-cased text under each dictionary."""
        data = text.lower().encode("utf-8", "replace")
        chunks = [data[i : i + CHUNK] for i in range(0, len(data), CHUNK)]
        return [sum(len(c.compress(chunk)) for chunk in chunks) for c in self.compressors]

    def classify(self, text: str | None) -> tuple[str, float]:
        """The language and its margin (0 to 1); ties go to the language learnt from more rows."""
        if not text or not self.names or not _LETTER.search(text):
            return UNDETERMINED, 0.0
        sizes = self.sizes(text)
        best = min(range(len(sizes)), key=lambda i: (sizes[i], i))
        second = min((s for i, s in enumerate(sizes) if i != best), default=None)
        return self.names[best], 1.0 if second is None else (second - sizes[best]) / second


def classify(docs: DataFrame, model: Sequence[tuple[str, bytes]], narrow: float = NARROW) -> DataFrame:
    """doc_id, lang_pred, score (the margin) and rejected (score below ``narrow``), a row for each of docs.

    Null texts, empty ones and those without a letter are ``und`` with score 0
    and rejected, and so is every text if no language was learnt; with a single
    language its margin is 1.  Null ids are kept, repeated rows give repeated
    rows, an empty table gives none, extra columns are dropped whatever their
    names, and texts of any length are read as a whole, a text at a time.
    """
    shared = docs.sparkSession.sparkContext.broadcast(list(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoders = Encoders(shared.value)
        for batch in batches:
            found = [encoders.classify(None if t is None else t.decode("utf-8", "replace")) for t in (x.as_py() for x in batch.column(1).cast(pa.binary()))]
            names, scores = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

    out = docs.select(F.col("doc_id").cast("long").alias("in_id"), F.col("text").cast("string").alias("in_text")).mapInArrow(run, "doc_id long, lang_pred string, score double")
    return out.withColumn("rejected", F.col("score") < narrow)


def held_out(doc_id: Column) -> Column:
    """Rows whose language is never learnt; a null id is none of them and is not learnt from either."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op13_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every whole text of documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = dictionaries(docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))))
    return classify(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")
