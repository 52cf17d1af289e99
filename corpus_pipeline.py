"""Training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir), works on all its predecessor kept and
returns a DataFrame; all but the last return the columns of ``documents``.
``run`` writes every stage but the last as Parquet below the shared folder of
the cluster and reads it again, so a lost executor costs no finished stage; a
stage's folder is removed once the next one is written.

Stages: quality rules (rejected documents go), SimHash near-duplicates (one
document of each group stays), benchmark decontamination (documents that hold
a test item go), personal data (pseudonyms in the text), BPE encoding (ids,
and whether they decode to the very text).

Cases, in every stage: a NULL or empty text is rejected by the quality rules,
and a stage that gets one treats it as a text without words; a NULL id is an id
like any other; rows that repeat are judged alike and of near duplicates one
stays; a text is read whole, however long; an empty table gives an empty one;
columns beside those of ``documents`` pass through all stages but the last, and
one named like a column that a stage works with changes nothing (a column of
the operators' own, beginning with ``__llm_``, is not allowed).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regiocast.llm import bpe, decontamination, pii, quality, simhash
from regiocast.llm.common import table
from regiocast.llm.queries import PSEUDONYM_KEY, vocabulary
from regiocast.session import remove_scratch, scratch_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.fit(docs, quality.trusted_sample(table(spark, sf_dir, "labels")), group_col="lang")
    own = {c: f"__own_{c}" for c in quality.OUTPUT if c in docs.columns}  # these stay the input's
    judged = quality.judge(docs.withColumnsRenamed(own), model, group_col="lang").where("kept")
    return judged.select(*[F.col(own.get(c, c)).alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs, shingle=3, max_bits=2)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    changed = pii.protect(docs, PSEUDONYM_KEY, spans_col="__pii").withColumn("n_chars", F.length("text").cast("long"))
    return changed.select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = vocabulary("byte_bpe_50k.json")
    decoded = bpe.encode(docs, path, decoded_col="decoded")
    return decoded.select(
        "doc_id",
        "lang",
        "source",
        "ids",
        F.floor(F.octet_length("ids") / 4).alias("n_tokens"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("decodes"),
    )


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminate),
    ("pii", pseudonyms),
    ("bpe", encode),
]

#: Hashes, Feistel networks and merges have no SQL form; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, read = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if read:
            remove_scratch(spark, read)
        read = path
    return STAGES[-1][1](spark, docs, sf_dir)
