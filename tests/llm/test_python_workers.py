"""The decontamination stage runs one Python worker a task, and drops what ``contamination`` calls contaminated."""
import pytest

from lanestride.llm.decontaminate import contamination, drop_contaminated

PASSAGE = "the quick brown fox jumps over the lazy dog near the old river bank"
OTHER = "several ships sailed north before dawn while harbour lights were still burning"


@pytest.fixture(scope="module")
def tables(spark):
    docs = [(1, f"intro {PASSAGE} outro"), (2, "nothing of the kind"), (3, None), (4, ""), (5, f"{OTHER} {PASSAGE.upper()}"),
            (6, "tiny item"), (6, "a row that repeats an id"), (7, " ".join(PASSAGE.split()[:9])), (8, "before tiny item after")]
    return (spark.createDataFrame(docs, "doc_id long, text string"),
            spark.createDataFrame([("a", PASSAGE), ("b", OTHER), ("c", "Tiny item"), ("d", None)], "item_id string, text string"))


@pytest.mark.parametrize("block_words", [1 << 20, 8])
def test_drops_the_contaminated(tables, block_words):
    docs, benchmark = tables
    hit = {r["doc_id"] for r in contamination(docs, benchmark, block_words=block_words).where("contaminated").collect()}
    assert hit == {1, 5, 6, 8}
    kept = drop_contaminated(docs, benchmark, block_words=block_words).collect()
    assert sorted(r["doc_id"] for r in kept) == [2, 3, 4, 7]


def test_one_python_node(tables):
    docs, benchmark = tables
    plan = drop_contaminated(docs, benchmark)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
