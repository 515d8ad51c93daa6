"""The training-corpus pipeline: documents in, packed pieces out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each result as Parquet into the shared folder and reads it again as the next
stage's documents.  All but the last return the columns of documents:

1. toxicity: documents whose score reaches 0.5 go;
2. line dedup: of near-copies of a line, the first stays (in the whole corpus);
3. n-gram Jaccard join: of each group of near-copies, the document with the
   smallest id stays; texts without words are no copies of each other;
4. benchmark decontamination: documents that hold 75 % of a benchmark item go;
5. best-fit packing: the texts as pieces of sequences of at most 4096 tokens.

In every stage null ids, texts and other values are kept as they are, repeated
rows count each unless the stage says otherwise, an empty table gives an empty
one, texts of any length are read whole, and columns beside those of documents
are dropped, whatever their names.

SQL can't express the scores, the tokenizer or union-find, so ORACLE_SQL is
None and the stages are tested against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import decontamination, jaccard, lines, packing, toxicity
from strata.llm.queries import workers_import
from strata.llm.store import written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5.  The network learns from the stage's own documents.

    Null and empty texts are scored as texts without words; equal texts score
    alike, so they stay or go together.
    """
    workers_import(spark)
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, model, tuple(c for c in COLUMNS if c != "doc_id")).where("score < 0.5").select(*COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines of which a near copy comes earlier.

    Of lines in equal places the one of the smaller id stays, null ids come
    last; equal rows are one document.  A null text stays null, and one whose
    lines all go becomes empty.
    """
    workers_import(spark)
    out = lines.dedup_lines(docs.select(*COLUMNS))
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, and all others.

    The smallest id of a group stays, null ids last, of equal rows one.
    Documents without words are in no group and all stay.
    """
    workers_import(spark)
    return jaccard.one_of_each(docs.select(*COLUMNS))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; null and empty texts hold none.  Equal rows stay or go together."""
    return decontamination.decontaminate(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequence and offset; a null text is empty and one piece, equal rows are packed each."""
    import public_tokenizers

    workers_import(spark)
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("best_fit_packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
