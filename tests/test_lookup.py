"""Cascading lookups (JN15-JN17) against the fixed reference tables (B8)."""

from pyspark.sql import functions as F

from ledgerline.operators.lookup import cascading_lookup
from ledgerline.plans import footprint_tables as FT
from ledgerline.plans.ledger import destination_city, distance_table, warehouse_table

from .conftest import rows


def test_distance_cascade(spark):
    vals = spark.createDataFrame([(1, "Temuco"), (2, "temuco "), (3, "Comuna de Providencia"), (4, "Vina"),
                                  (5, "Nowhere"), (6, "   "), (7, None), (8, "San Clemente")], "id int, city string")
    out = cascading_lookup(vals, "city", distance_table(spark), "city", ["zip", "km"], "ordinal",
                           {"zip": FT.DEFAULT_ZIP, "km": FT.DEFAULT_KM})
    got = {r["id"]: (r["match_zip"], r["match_rank"]) for r in out.collect()}
    assert got[1] == ("4780000", 1)          # exact
    assert got[2] == ("4780000", 2)          # case-insensitive after trim
    assert got[3] == ("7500000", 3)          # table name inside the value
    assert got[5] == ("0000000", None)       # no hit -> default
    assert got[6] == ("0000000", None)       # blank -> default (Q16 decision)
    assert got[7] == ("0000000", None)
    assert got[8] == ("3520000", 1)          # listed twice, same value (Q9)
    assert got[4][1] is None                 # 'vina' is not 'viña'


def test_case_fold_and_first_ordinal(spark):
    tbl = spark.createDataFrame([("Los Andes", "A", 1.0, 0), ("Andes", "B", 2.0, 1), ("los andes sur", "C", 3.0, 2)],
                                "city string, zip string, km double, ordinal int")
    vals = spark.createDataFrame([(1, "LOS ANDES"), (2, "andes s")], "id int, city string")
    out = cascading_lookup(vals, "city", tbl, "city", ["zip"], "ordinal", {"zip": "0"})
    got = {r["id"]: (r["match_zip"], r["match_rank"]) for r in out.collect()}
    assert got[1] == ("A", 2)                # case-insensitive, first in table order
    assert got[2] == ("B", 3)                # containment either way, first ordinal wins


def test_destination_city(spark):
    df = spark.createDataFrame([
        ("T1", "ladehesa", "x", "y"),            # warehouse map (upper-cased id)
        ("T2", "ZZ", " Temuco ", "Providencia"),  # district hit before city hit
        ("T3", "ZZ", " Temuco ", "Nada"),         # city hit
        ("T4", "ZZ", "Somewhere", ""),            # raw city
        ("T5", "ZZ", "", "Barrio"),               # raw district
        ("T6", None, None, None),                 # Unknown
    ], "t string, RECEIVING_WAREHOUSE_ID string, RECEIVING_ADDRESS_CITY string, RECEIVING_ADDRESS_DISTRICT_NAME string")
    out = destination_city(df, distance_table(spark), warehouse_table(spark))
    assert rows(out, "t", "DEST") == [("T1", "Lo Barnechea"), ("T2", "Providencia"), ("T3", "Temuco"),
                                      ("T4", "Somewhere"), ("T5", "Barrio"), ("T6", "Unknown")]


def test_one_letter_values_and_repeated_names(spark):
    """Each value has one answer, the first in table order, however often the table repeats a name or letter."""
    names = [(f"{x} town", f"z{i}", i) for i, x in enumerate(["ab", "ab", "AB", "ba", "b"] * 20)]
    tbl = spark.createDataFrame(names, "city string, zip string, ordinal int")
    vals = spark.createDataFrame([(1, "a"), (2, "b"), (3, "Ab Town"), (4, "ab town"), (5, "in ba town"), (6, "q")], "id int, city string")
    out = cascading_lookup(vals, "city", tbl, "city", ["zip"], "ordinal", {"zip": "0"})
    got = sorted((r["id"], r["match_zip"], r["match_rank"]) for r in out.select("id", "match_zip", F.coalesce("match_rank", F.lit(0)).alias("match_rank")).collect())
    assert got == [(1, "z0", 3), (2, "z0", 3), (3, "z0", 2), (4, "z0", 1), (5, "z3", 3), (6, "0", 0)]


def test_exact_lookup_gives_each_row_once(spark):
    from pyspark.sql import functions as F

    from ledgerline.operators.lookup import exact_lookup
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    table = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), (None, 9, "n")], "k string, v int, w string")
    got = exact_lookup(df, F.col("k"), table, "k", ["v", "w"], {"w": "-"})
    assert sorted(map(str, got.collect())) == sorted(["Row(k='a', v=1, w='y')"] * 2 + ["Row(k='b', v=None, w='-')", "Row(k=None, v=None, w='-')"])


def test_contained_equals_comparing_all(spark):
    import random

    from ledgerline.operators.lookup import contained
    rng = random.Random(6)
    word = lambda n: "".join(rng.choice("abcñ. ") for _ in range(n))
    needles = sorted({word(rng.randint(0, 6)) for _ in range(150)} | {"a", "aa", "", "zzz"})
    texts = sorted({word(rng.randint(0, 12)) for _ in range(150)} | {word(2000), "", "a"})
    got = contained(spark.createDataFrame([(n,) for n in needles] + [(None,)], "n string"), "n", spark.createDataFrame([(t,) for t in texts] + [(None,)], "t string"), "t")
    assert sorted(map(tuple, got.collect())) == sorted((n, t) for n in needles if n for t in texts if n in t)


def test_cascade_takes_values_of_any_length(spark):
    table = spark.createDataFrame([(1, "Valparaiso", 10), (2, "Santiago", 20), (3, "a" * 2000 + "x", 30), (4, "Rio", 40)], "ord int, name string, km int")
    values = ["i", "x", "zona de SANTIAGO centro " + "b" * 2000, "a" * 1500, "rio", "q", "valpar", None, " "]
    df = spark.createDataFrame([(v,) for v in values], "city string")
    got = {r["city"]: (r["match_km"], r["match_rank"]) for r in cascading_lookup(df, "city", table, "name", ["km"], "ord", {"km": 0}).collect()}
    assert got == {"i": (10, 3), "x": (30, 3), values[2]: (20, 3), values[3]: (30, 3), "rio": (40, 2), "q": (0, None), "valpar": (10, 3), None: (0, None), " ": (0, None)}
