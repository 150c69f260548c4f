"""The registered queries opN_<name> of this subpackage and their oracle SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import bpe, chat, dsir, htmlmain, jaccard, langid, licenses, maxscore, packing, periodic, pii, rules, targets

#: The vocabulary the queries use; every operator takes its path as a parameter.
VOCABULARY, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"
#: The pseudonyms' key in the queries; a user passes their own.
PII_KEY = b"ledgerline demonstration key"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents`` encoded and decoded: token count and digests."""
    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op2_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of ``documents`` that share 85 % of their 4-word shingles: class id of every document."""
    return jaccard.linked(table(spark, sf_dir, "documents"), k=4, pct=85)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` packed into sequences of at most 2048 tokens: the place of every piece."""
    return packing.packed(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), public_tokenizers.path(RANKS))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every whole text of ``documents``, learned from the rows not held out."""
    return langid.identify(table(spark, sf_dir, "documents"))


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page of ``pages``, by a field trained on pages labelled by their structure."""
    pages = table(spark, sf_dir, "pages")
    return htmlmain.extracted(pages, htmlmain.fitted(pages))


def op6_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its validated numbers, dates and addresses replaced by pseudonyms."""
    return pii.pseudonymised(table(spark, sf_dir, "documents").select("doc_id", "text"), PII_KEY)


def op7_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importance resampling of ``documents`` towards those labelled good: weight, noisy key, verdict."""
    return dsir.resample(table(spark, sf_dir, "documents"), good_ids(spark, sf_dir))


def op8_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counted statistics, base rules and the robust outlier verdict of every document."""
    v = rules.verdicts(table(spark, sf_dir, "documents"))
    return v.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance")


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known licences and notices in every document: by its whole text and line by line."""
    return licenses.scanned(table(spark, sf_dir, "documents"), licenses.known(spark))


def op10_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best inner products of every fiftieth of ``embeddings`` against all others."""
    return maxscore.search(table(spark, sf_dir, "embeddings"), k=5)


def op11_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``conversations``, and one that says control strings, formatted by the chat template and read back."""
    tricky = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)], "conv_id long, turn long, role string, text string")
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.read_back(chat.formatted(given.unionByName(extra)), together=True)


def op12_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of ``documents`` drawn towards the words of ``benchmark``: weight, noisy score and rank of every document."""
    return targets.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The periodic runs of every text of ``documents``, one in ten with a periodic tail, and the text without repeats."""
    return periodic.digests(periodic.runs(table(spark, sf_dir, "documents"), planted=periodic.planted_tail))


def good_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of the documents labelled good (the target of the quality classifier)."""
    return table(spark, sf_dir, "labels").where(F.col("quality") == 1).select("doc_id")


QUERIES = {
    "op1_bpe": op1_bpe,
    "op2_jaccard": op2_jaccard,
    "op3_packing": op3_packing,
    "op4_language": op4_language,
    "op5_main_text": op5_main_text,
    "op6_pseudonyms": op6_pseudonyms,
    "op7_importance": op7_importance,
    "op8_rules": op8_rules,
    "op9_licenses": op9_licenses,
    "op10_maxscore": op10_maxscore,
    "op11_chat": op11_chat,
    "op12_targets": op12_targets,
    "op13_periodic": op13_periodic,
}

#: Queries that SQL can express; the others are tested against brute force in tests/llm.
ORACLE: dict[str, str] = {
    "op9_licenses": licenses.oracle(),
    "op10_maxscore": """
        WITH usable AS (
            SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
        scored AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   CAST(list_sum([q.v[i] * c.v[i] FOR i IN range(1, len(q.v) + 1)]) AS BIGINT) AS score
            FROM usable q JOIN usable c ON c.vec_id <> q.vec_id
            WHERE q.vec_id % 50 = 0),
        ranked AS (
            SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
            FROM scored)
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
    "op11_chat": chat.ORACLE,
    "op12_targets": targets.ORACLE,
}
