"""Capitals as SQL has them: one character for each."""

import duckdb

from quern.plans import catalogue


def test_case_fit_has_the_capital_sharp_s_of_its_sql(spark, tmp_path):
    words = ["zuß ab", "ſtraße", "ﬁne x", "ᾳβ y", "ŉa", "abc d", "Größe Z", "😀ßa b"]
    rows = [(5 * i, w) for i, w in enumerate(words)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, catalogue.QUERIES["case_fit"](spark, str(tmp_path)).collect()))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert got == sorted(con.execute(catalogue.ORACLES["case_fit"]).fetchall())
    assert (0, "ZUẞ", "WORD") in got
