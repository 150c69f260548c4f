import duckdb
from pyspark.sql import functions as F

from ledgerline.llm import licenses

MIT = dict((i, t) for i, t in reversed(licenses.KNOWN) if len(t) > 400)["MIT"]


def scan(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: r for r in licenses.scanned(df, licenses.known(spark)).collect()}


def test_equal_texts_in_other_dress(spark):
    wrapped = MIT.replace("\n", " ")
    wrapped = "\n".join(wrapped[i:i + 70] for i in range(0, len(wrapped), 70))
    texts = [
        MIT, "Copyright (c) 2020 Some One\n\n" + MIT.upper() + "\nAll rights reserved.\n", "// " + MIT.replace("\n", "\n// ").replace('"', "“"),
        MIT.replace("sublicense", "sub-licence"), MIT + " Also this.", "RELEASED under the MIT licence", "some text\n  * Licensed under CC BY-NC 4.0!\nmore\nReleased under the MIT License.\nReleased under the MIT License.",
        "All rights reserved.", "", None,
    ]
    out = scan(spark, texts)
    assert [out[i].license_id for i in range(len(texts))] == ["MIT", "MIT", "MIT", "MIT", None, "MIT", None, None, None, None]
    assert (out[6].n_license_lines, out[6].line_licenses) == (3, "CC-BY-NC-4.0,MIT")
    assert out[7].digest is None and out[8].digest is None and out[9].digest is None and out[9].n_license_lines == 0


def test_titles_and_licences_from_a_table(spark):
    bsd = dict((i, t) for i, t in reversed(licenses.KNOWN) if len(t) > 400)["BSD-3-Clause"]
    out = scan(spark, ["BSD 3-Clause License\n\nCopyright (c) 2021, A. Nobody\nAll rights reserved.\n\n" + bsd, "The MIT License (MIT)\n\nCopyright 2019 X\n\n" + MIT, "MIT License " + bsd])
    assert [out[i].license_id for i in range(3)] == ["BSD-3-Clause", "MIT", None]
    own = spark.createDataFrame([("House-1", "You may read this."), ("House-2", "YOU MAY READ THIS!"), ("Empty", " "), ("None", None)], "license_id string, text string")
    known = licenses.known(spark).union(licenses.known_from(own))
    df = spark.createDataFrame([(1, "you may read this"), (2, "x\n You may read this. \ny"), (3, MIT)], "doc_id long, text string")
    got = {r.doc_id: (r.license_id, r.line_licenses) for r in licenses.scanned(df, known).collect()}
    assert got == {1: ("House-1", "House-1"), 2: (None, "House-1"), 3: ("MIT", "")}


def test_query_equals_sql(spark, docs, odd, empty):
    con = duckdb.connect()
    for df in (docs, odd):
        documents = df.select("doc_id", "text").toArrow()
        con.register("documents", documents)
        want = sorted(map(str, con.execute(licenses.oracle()).fetchall()))
        got = [tuple(r) for r in licenses.scanned(df, licenses.known(spark)).collect()]
        assert sorted(map(str, got)) == want
    assert licenses.scanned(empty, licenses.known(spark)).count() == 0


def test_no_python_in_the_plan(spark, docs):
    plan = licenses.scanned(docs, licenses.known(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_spelling_table_is_applied_to_words_only(spark):
    assert licenses.scanned(spark.createDataFrame([(1, "sublicence per cent")], "doc_id long, text string").select("doc_id", F.col("text")), licenses.known(spark)).count() == 1
