"""Greedy keep-first goes on until every set is settled."""

from quern.operators import similarity


def test_greedy_settles_chains_of_over_a_hundred(spark):
    """Neighbours alone are near: every second of them stays."""
    rows = [(i, " ".join(f"w{k}" for k in range(i, i + 10))) for i in range(112)]  # 9 of 11 shared words
    found = {r["id"]: r["kept"] for r in similarity.greedy_kept(spark.createDataFrame(rows, "id long, text string"), "id", "text").collect()}
    assert found == {i: i % 2 == 0 for i in range(112)}
