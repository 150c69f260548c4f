"""Event lines and their variants (PL17, JN13)."""

from ledgerline.plans.events import with_variants

from .conftest import rows


def test_variants_are_not_sorted_where_they_are_read(spark):
    lines = spark.createDataFrame([("a", "b", "c", 1), ("a", "b", None, 2), (None, None, None, 3)], "ITEMID string, INVENTCOLORID string, INVENTSIZEID string, n int")
    variants = spark.createDataFrame([("a-b-c", 1), ("a-b-c", 7), ("a-b-c", 3), (None, 9), ("x", None)], "VARIANT_SKU string, VARIANT_ID int")
    out = with_variants(lines, variants)
    assert rows(out, "n", "VARIANT_ID") == [(1, 7), (2, None), (3, None)]
    out = with_variants(lines, variants)
    plan = out._sc._jvm.PythonSQLUtils.explainString(out._jdf.queryExecution(), "simple")
    assert "Aggregate" not in plan.split("REPARTITION_BY_COL")[1]
