"""Training-data pipeline over ``documents``: clean, deduplicate, pseudonymise and pack.

STAGES lists (name, function); each function takes (spark, docs, sf_dir), where
docs is what the stage before it kept, and returns a DataFrame.  ``run``
writes every stage's rows as Parquet in the shared checkpoint folder and reads
them again for the next stage, so a lost executor costs one task and lineage
stays short.  All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import dsir, jaccard, members, packing, pii, queries, rules
from ledgerline.operators.membership import fresh_name
from ledgerline.session import shared_folder


#: Settings of the Python workers' allocators: what a slice needed goes back to the system, so that workers that live as
#: long as the pipeline do not each keep the memory of its largest step.
WORKER_MEMORY = {"MALLOC_ARENA_MAX": "1", "MALLOC_TRIM_THRESHOLD_": "131072", "ARROW_DEFAULT_MEMORY_POOL": "system"}
#: The session setting that names the pseudonyms' key; without it they have the demonstration key.
KEY_SETTING = "spark.ledgerline.pii.key"


def _lean(spark: SparkSession) -> None:
    """Workers started from now on have WORKER_MEMORY, where the session's launcher has not set it otherwise."""
    for name, value in WORKER_MEMORY.items():
        spark.sparkContext.environment.setdefault(name, value)


def _keyed(docs: DataFrame, columns: list[str]) -> tuple[DataFrame, str]:
    """docs with one column more, and its name: the row's id and a 128-bit hash of its columns, ordered by id (null last), then hash.

    It depends on the row alone, so every read of the stage's input gives the
    same; rows that are equal in the columns share it and every verdict.  The
    name is one that docs does not have, so no column is lost.
    """
    row = fresh_name(docs, "_row_key")
    parts = [part for c in columns for part in (docs[c].isNull(), docs[c])]
    whole = lambda c: F.unhex(F.lpad(F.hex(c), 16, "0"))
    number = docs["doc_id"].cast("long").bitwiseXOR(F.lit(-1 << 63))
    given = F.coalesce(F.concat(F.unhex(F.lit("00")), whole(number)), F.unhex(F.lit("01")))
    return docs.withColumn(row, F.concat(given, *(whole(F.xxhash64(F.lit(i), *parts)) for i in (1, 2)))), row


def _keep(keyed: DataFrame, row: str, verdicts: DataFrame) -> DataFrame:
    """The rows of keyed whose row key has a kept verdict in verdicts (row key, kept).

    Only row keys and verdicts are shuffled, and the texts of rejected rows;
    the kept texts stay where they were read.
    """
    by_row = verdicts.toDF("row", "kept").groupBy("row").agg(F.max("kept").alias("kept"))
    rejected = by_row.where("not kept").select("row").checkpoint()
    return members.split(keyed, row, rejected)[0]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are no outliers of their language and source.

    Null, empty and wordless texts fail the base rules and go.  Repeated rows
    stay or go together; very long texts are judged whole; an empty table stays
    empty; extra columns of any name come back as they were.
    """
    _lean(spark)
    keyed, row = _keyed(docs, docs.columns)
    plain = keyed.select(F.col(row).alias("row"), *(keyed[c] for c in ("text", "lang", "source")))
    return _keep(keyed, row, rules.verdicts(plain, id_col="row").select("row", "kept")).drop(row)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn by importance resampling towards those labelled good.

    Null, empty and wordless texts are as likely either way and compete like
    others; equal rows may be drawn one by one, but stay or go together; very
    long texts are weighed whole; an empty table stays empty; extra columns of
    any name come back as they were.
    """
    _lean(spark)
    keyed, row = _keyed(docs, docs.columns)
    plain = keyed.select("doc_id", "text", F.col(row).alias("row"))
    drawn = dsir.resample(plain, queries.good_ids(spark, sf_dir), keep=("row",))
    return _keep(keyed, row, drawn.select("row", "kept")).drop(row)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies (five-word shingles, similarity 0.8): the smallest id.

    Repeated rows of it stay once.  Of several texts under the smallest id, or
    of rows that all have no id, one stays, the one with the smallest hash.
    Texts without words are copies of nothing and stay (equal rows once); very
    long texts are compared whole; an empty table stays empty; extra columns of
    any name come back as they were.
    """
    _lean(spark)
    keyed, row = _keyed(docs, ["doc_id", "text"])
    classes = jaccard.linked(keyed.select(F.col(row).alias("row"), "text"), k=5, pct=80, id_col="row")
    left = _keep(keyed, row, classes.select("row", (F.col("component_id") == F.col("row")).alias("kept")))
    repeated = keyed.groupBy(row).count().where("count > 1").select(row).checkpoint()
    if repeated.isEmpty():
        return left.drop(row)
    once, again = members.split(left, row, repeated)
    return once.union(again.dropDuplicates([row])).drop(row)


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its personal data replaced by keyed pseudonyms of the same length.

    The key is the session's KEY_SETTING.  Null and empty texts stay as they
    are; rows pass one by one, repeated ones too; very long texts are searched
    whole; an empty table stays empty; other columns come back as they were.
    """
    _lean(spark)
    key = spark.conf.get(KEY_SETTING, None)
    return pii.pseudonymised(docs, key.encode() if key else queries.PII_KEY, spans_col=None)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every token piece in sequences of at most 2048 tokens.

    Null and empty texts are their end mark alone; repeated rows are packed
    each; longer texts are cut; an empty table gives no rows; only doc_id and
    text are read.
    """
    _lean(spark)
    return packing.packed(docs, public_tokenizers.path(queries.VOCABULARY), public_tokenizers.path(queries.RANKS))


STAGES = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_classifier),
    ("near_duplicates", near_duplicates),
    ("pseudonyms", pseudonyms),
    ("best_fit_packing", best_fit_packing),
]

#: SQL cannot express these stages; tests/llm holds the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, from the whole ``documents`` table."""
    folder = shared_folder(spark, "corpus")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}-{name}")
        docs = spark.read.parquet(f"{folder}/{k}-{name}")
    return docs
