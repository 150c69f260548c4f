import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from ledgerline.llm import dsir, pii, queries, rules  # noqa: E402

from .test_jaccard import brute  # noqa: E402
from .test_packing import expected  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "quality_classifier", "near_duplicates", "pseudonyms", "best_fit_packing"]


def test_run_equals_a_plain_version(spark):
    """Filters by the operators' own verdicts on what is left, duplicates by all pairs, ids by the tokenizers library."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {r.doc_id for r in rules.verdicts(docs).where("kept").collect()}
    left = docs.where(docs.doc_id.isin(list(kept)))
    kept = {r.doc_id for r in dsir.resample(left, queries.good_ids(spark, SF)).where("kept").collect()}
    rows = [(r.doc_id, r.text) for r in left.collect() if r.doc_id in kept]
    classes = brute(rows, 5, 80)
    first = {int(i) for i, _, low in classes if i == low}
    names = pii.Pseudonyms(queries.PII_KEY)
    texts = [(i, pii.replaced(t, pii.spans(t, names))) for i, t in rows if i in first]
    out = corpus_pipeline.run(spark, SF).collect()
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in out) == expected(texts)
    assert 0 < len(first) < docs.count()
    bins = {}
    for r in out:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for items in bins.values():
        at = 0
        for offset, n in sorted(items):
            assert offset == at
            at += n
        assert at <= 2048


def test_stages_keep_the_columns_and_take_odd_rows(spark, odd, empty):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = ["doc_id", "text", "lang", "source", "n_chars"]
    for df in (odd.select(*names).unionByName(docs.limit(30)), odd, empty):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, df, SF)
            assert out.columns == df.columns, name
            out.count()


def test_columns_of_any_name_come_back_as_they_were(spark):
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    names = ["_row_key", "_hit", "_bucket", "_bits", "_map", "_id", "row", "key", "kept", "Text_", "_Row_Key_"]
    df = docs.select("*", *(F.concat(F.lit(n), F.col("doc_id").cast("string")).alias(n) for n in names))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, df, SF)
        assert out.columns == df.columns, name
        rows = out.collect()
        assert rows and all(r[n] == f"{n}{r.doc_id}" for r in rows for n in names), name


def test_the_key_of_the_pseudonyms_is_the_session_setting(spark):
    df = spark.createDataFrame([(1, "call 415-555-2671 now", "en", "a", 21)], "doc_id long, text string, lang string, source string, n_chars long")
    given = corpus_pipeline.pseudonyms(spark, df, SF).first().text
    spark.conf.set(corpus_pipeline.KEY_SETTING, "another key")
    try:
        other = corpus_pipeline.pseudonyms(spark, df, SF).first().text
    finally:
        spark.conf.unset(corpus_pipeline.KEY_SETTING)
    assert len({given, other, "call 415-555-2671 now"}) == 3


def test_rows_without_an_id_or_with_a_repeated_one_are_judged_one_by_one(spark):
    """Null or equal ids rescue no rejected row: the same texts stay as under ids of their own."""
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = {r.text for r in rules.verdicts(docs).where("kept").join(docs, "doc_id").select("text").collect()}
    for one in (F.lit(None), F.lit(1)):
        out = corpus_pipeline.quality_rules(spark, docs.withColumn("doc_id", one.cast("long")), SF)
        assert {r.text for r in out.collect()} == want and len(want) < docs.count()
    # the middle of a weight list falls between rows of one id
    out = dsir.resample(docs.withColumn("doc_id", F.lit(1).cast("long")), docs.select("doc_id"), k=50, keep=("text",)).where("kept")
    assert out.columns[-1] == "text" and out.count() == 50


def test_near_copies_without_an_id_or_with_a_repeated_one(spark):
    base = [" ".join(f"{c}{i}" for i in range(60)) for c in "abcd"]
    near = [t + " more" for t in base]
    rows = [(None, base[0]), (None, near[0]), (2, base[1]), (None, near[1]), (3, base[2]), (3, near[2]), (3, near[2]), (5, base[3]), (4, near[3])]
    df = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    out = [(r.doc_id, r.text[0]) for r in corpus_pipeline.near_duplicates(spark, df, SF).collect()]
    assert sorted(out, key=str) == [(2, "b"), (3, "c"), (4, "d"), (None, "a")]
