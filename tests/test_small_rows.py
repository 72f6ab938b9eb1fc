from letterloom.operators import contacts as ct
from letterloom.operators import evaluate as ev


def _before_the_move(df):
    """The physical plan below the last exchange by a number of partitions, which adaptive execution does not merge."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan
    return plan.rsplit("REPARTITION_BY_NUM", 1)[1]


def test_pairs_are_counted_after_they_moved(spark):
    rows = [("a", "x", 1), ("a", "x", 1), ("a", "x", 2), ("a", "y", 1), ("b", "x", 3), ("b", "y", None)]
    found = ct.pair_messages(spark.createDataFrame(rows, "sender string, recipient string, mid long"))
    assert "HashAggregate" not in _before_the_move(found)
    assert {tuple(r) for r in found.collect()} == {("a", "x", 2), ("a", "y", 1), ("b", "x", 1), ("b", "y", 0)}
    assert found.schema["n"].dataType.simpleString() == "bigint"


def test_hits_are_reduced_after_they_moved(spark):
    predicted = spark.createDataFrame([(1, 1, "x"), (1, 2, "x"), (1, 3, "y"), (2, 1, "z")], "mid long, rank long, contact string")
    found = ev.average_precision(predicted, spark.createDataFrame([(1, "x"), (1, "y"), (3, "q")], "mid long, recipient string"))
    assert "HashAggregate" not in _before_the_move(found)
    assert {r.mid: round(r.ap, 9) for r in found.collect()} == {1: round((1 + 2 / 3) / 2, 9), 2: 0.0, 3: 0.0}
