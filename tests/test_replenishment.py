"""Replenishment steps on small rows: repeated and null keys, and what their plans hold in memory."""

from ledgerline.plans import replenishment as R

from .conftest import rows


def plan(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")


def test_outcome_counts_lines_and_answers_without_a_join(spark):
    lines = spark.createDataFrame([("a", "s", "1", False), ("a", "s", "1", False), ("a", "s", "2", True), ("a", None, "3", False), ("b", "s", "1", False), (None, "s", "1", False)],
                                  "REPLENISHMENT_ID string, STORE string, SKU string, IS_MISSING_ERP_DATA boolean")
    answers = spark.createDataFrame([("a", "s", "1", None), ("a", "s", "1", "bad"), ("a", "s", "2", None), ("a", None, "3", None), ("c", "s", "1", None), (None, "s", "1", None)],
                                    "REPLENISHMENT_ID string, STORE string, SKU string, ERROR string")
    out = R.outcome(lines, answers)
    # each of the two lines of a key has both answers; null keys match nothing; an answer alone is no replenishment
    assert rows(out) == [(None, 1, 0, 0, 0, 0, "failed"), ("a", 3, 2, 2, 1, 3, "partial"), ("b", 1, 0, 0, 0, 0, "failed")]
    fresh = plan(R.outcome(lines, answers))
    assert "Join" not in fresh and "SortAggregate" not in fresh


def test_transfer_summary_sorts_no_lines(spark):
    lines = spark.createDataFrame([("t", "s", 2, "new"), ("t", "s", 3, "sent"), ("t", "s", None, None), ("u", None, None, None), (None, "s", 9, "sent")],
                                  "ERP_TR_ID string, STORE string, REPLENISHMENT int, WMS_SEND_STATUS string")
    out = R.transfer_summary(lines)
    assert rows(out) == [("t", "s", 3, 5, "sent"), ("u", None, 1, None, None)]
    # the lines themselves are counted by hash; only their sums are sorted
    assert plan(R.transfer_summary(lines)).split("Exchange")[-1].count("HashAggregate") >= 1
    assert "SortAggregate" not in plan(R.transfer_summary(lines)).split("Exchange")[-1]


def test_numbering_stores_only_wanted_columns(spark, monkeypatch):
    lines = spark.createDataFrame([("r", "s", "b", 1, "d"), ("r", "s", "a", 2, "d"), ("r", "s", "c", 3, None)],
                                  "REPLENISHMENT_ID string, STORE string, SKU string, REPLENISHMENT int, DELIVERY string")
    products = spark.createDataFrame([("a", "i1", "c", "f", "z", "t", "k", "n"), ("c", "i3", "c", "f", "z", "t", "k", "n")],
                                     "SKU string, ITEMNUMBER string, COLOR string, CONFIGURATION string, SIZE string, TEAM string, CATEGORY string, PRODUCTNAME string")
    stored, number = [], R.number_within
    monkeypatch.setattr(R, "number_within", lambda df, *a, **k: (stored.append(df.columns), number(df, *a, **k))[1])
    whole = R.enrich_lines(lines, products)
    wanted = ["REPLENISHMENT_ID", "STORE", "SKU", "LINENUMBER", "LINE_NO", "IS_MISSING_ERP_DATA"]
    few = R.enrich_lines(lines, products, columns=wanted)
    assert whole.columns == list(R.ENRICHED) and set(few.columns) == set(wanted)
    assert rows(few, *wanted) == rows(whole, *wanted) == [("r", "s", "a", 1, 1, False), ("r", "s", "b", 2, None, True), ("r", "s", "c", 3, 2, False)]
    assert set(stored[1]) == {"REPLENISHMENT_ID", "STORE", "SKU", "_known"}
    assert rows(whole, "SKU", "ORDEREDINVENTORYSTATUSID", "PRODUCTCOLORID", "TRANSFERQUANTITY", "DELIVERY")[0] == ("a", R.INVENTORY_STATUS, "c", 2, "d")
