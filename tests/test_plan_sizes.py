"""Plans stay small, as the driver holds and compiles them whatever the size of the tables."""

from pyspark.sql import functions as F

from letterloom.operators import greetings as gr
from letterloom.operators import temporal as tm


def _exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange ")


def test_time_features_in_small_plans(spark, monkeypatch):
    sizes, stage = [], getattr(tm, "stage", None)
    if stage:
        monkeypatch.setattr(tm, "stage", lambda df, label: sizes.append(_exchanges(df)) or stage(df, label))
    flat = spark.createDataFrame([(f"s{k % 3}", f"r{k % 5}", k, k) for k in range(40)], "sender string, recipient string, mid long, time long")
    sizes.append(_exchanges(tm.time_features(flat, F.lit(30))))
    assert max(sizes) <= 40, sizes


def test_greeting_value_counts_hot_keys_on_the_pairs(spark):
    pairs = spark.createDataFrame([(k, f"r{k % 5}") for k in range(40)], "mid long, recipient string")
    words = spark.createDataFrame([(k, 0, "Ann") for k in range(40)], "mid long, pos int, word string")
    book = spark.createDataFrame([("r1", "Ann", 0.9)], "recipient string, name string, weight double")
    found = gr.greeting_value(pairs, words, book, pairs.select("recipient").distinct())
    assert _exchanges(found) <= 40
    assert found.where("greet = 1").count() == 8 and found.where("greet = -1").count() == 32
