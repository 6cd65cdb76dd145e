"""A scarce domain of a small share doesn't lower what is kept of the domain with the largest share."""

import logging

import numpy as np
from pyspark.sql import functions as F

from quern.llm import mixing


def test_scarce_domain_keeps_the_wanted_one(spark):
    kinds = [("fine", 900, (0.98, 0.01, 0.01)), ("low", 95, (0.02, 0.97, 0.01)), ("bad", 5, (0.01, 0.01, 0.98))]
    rows = spark.createDataFrame([(10, [float(x) for x in p]) for _, n, p in kinds for _ in range(n)], "n_tokens long, p array<double>")
    steps, totals, targets = mixing.fit_rates(rows, {"fine": 0.85, "low": 0.05, "bad": 0.10}, ["fine", "low", "bad"], most=1.0)
    p = np.array([p for _, _, p in kinds])
    rate = mixing._replay(p, steps, 1.0)
    assert rate[0] > 0.95 and rate[2] > 0.9 and rate[1] < 0.7
    assert np.allclose(totals, np.array([9000, 950, 50]) * rate @ p) and targets[2] < 0.10 * targets.sum()


def test_totals_are_reported(spark, prose, caplog):
    docs = spark.createDataFrame([(i, t + (" bad worse" if i % 4 == 0 else " fine good")) for i, t in enumerate(prose(80, 5, 20))], "doc_id long, text string")
    labels = docs.select("doc_id", F.when(F.col("doc_id") % 4 == 0, "bad").otherwise("fine").alias("d"))
    with caplog.at_level(logging.INFO, "quern.llm.mixing"):
        mixing.mixed(docs, labels, F.col("d"), {"bad": 0.1, "fine": 0.9}, most=1.0)
    assert "bad" in caplog.text and "fine" in caplog.text and " of " in caplog.text
