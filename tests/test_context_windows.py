"""Context windows against a direct loop; they are made without an item-by-item lambda."""
import pytest

from lanestride.operators.ngram import context_windows

ROWS = [(1, [5, 6, 7, 8, 9]), (2, []), (3, None), (4, [3]), (5, [2, None, 4]), (5, [1, 1])]


@pytest.mark.parametrize("n", [0, 1, 3])
def test_against_a_loop(spark, n):
    want = [(key, i, ([0] * n + ids)[i:i + n], ids[i]) for key, ids in ROWS for i in range(len(ids or []))]
    got = context_windows(spark.createDataFrame(ROWS, "level_id long, ids array<long>"), n).collect()
    assert sorted(map(repr, want)) == sorted(repr((r["level_id"], r["pos"], r["context"], r["target"])) for r in got)


def test_text_and_first_examples(spark):
    rows = spark.createDataFrame([(2, ["c"]), (1, ["a", "b"])], "level_id long, ids array<string>")
    got = context_windows(rows, 2, pad="-", max_examples=2).collect()
    assert [(r["level_id"], r["pos"], r["context"], r["target"]) for r in got] == [(1, 0, ["-", "-"], "a"), (1, 1, ["-", "a"], "b")]


def test_no_lambda(spark):
    rows = context_windows(spark.createDataFrame(ROWS, "level_id long, ids array<long>"), 3)
    assert "lambdafunction" not in rows._jdf.queryExecution().optimizedPlan().toString()
