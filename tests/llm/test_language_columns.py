"""Columns of the input keep their names and values, even those that the operator uses itself."""

from pyspark.sql import functions as F

from quern.llm import language_id


def test_clashing_names(spark):
    rows = [(i, f"the house of the people {i}" if i % 2 else f"das haus der leute {i}", "en" if i % 2 else "de", "h", i, [1.0], "x") for i in range(60)]
    names = ["doc_id", "text", "lang", "lid_host", "lid_n", "lid_ll", "in_0"]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, lid_host string, lid_n long, lid_ll array<double>, in_0 string")
    model = language_id.fit_text_model(df, "doc_id", "text", F.col("lang"), ("de", "en"), 20)
    got = language_id.identified(df, model, "text", F.col("lang"), F.col("lid_host")).collect()
    assert sorted(tuple(r[c] for c in names) for r in got) == rows
    assert all(r["lid_lang"] == r["lang"] for r in got)
    again = language_id.identified(df.withColumn("lid_lang", F.lit("old")), model, "text", F.col("lang"), keep=["doc_id", "lid_lang"])
    assert again.columns == ["doc_id", "lid_lang", "lid_confidence", "lid_accepted"] and again.filter("lid_lang = 'old'").count() == 0
