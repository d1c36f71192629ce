"""The forest on counted points: same class, quality and bookkeeping as MLlib's on rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from contrail.operators import classify as ML
from contrail.operators import forest_training as FT
from contrail.plans import registry

ROWS = "altitude_meters double, velocity_kmh double, altitude_change double, velocity_change double, " \
       "rolling_avg_altitude double, rolling_std_altitude double, rolling_avg_velocity double, flight_phase string"


@pytest.fixture(scope="module")
def rows(spark):
    """3000 rows, each of the first 100 ten times more; the label follows two features, with some noise."""
    r = np.random.default_rng(1)
    x = r.normal(size=(3000, 7)).round(2)
    y = np.where(x[:, 0] > 0.5, "CRUISE", np.where(x[:, 5] > 0, "CLIMB", "GROUND"))
    y = np.where(r.random(3000) < 0.05, "DESCENT", y)
    data = [(*map(float, v), str(p)) for v, p in zip(x, y)]
    return spark.createDataFrame(data + data[:100] * 10, ROWS).repartition(3).localCheckpoint()


def test_counted_forest_is_as_good_as_on_rows(spark, rows):
    on_rows, counted = ML.train(rows, trees=30, depth=6), ML.train(rows, mllib_rows=0, trees=30, depth=6)
    assert type(counted.stages[3]) is type(on_rows.stages[3]) and counted.stages[3].getNumTrees == 30
    assert counted.stages[0].labels == on_rows.stages[0].labels
    assert np.allclose(counted.stages[2].std.toArray(), on_rows.stages[2].std.toArray())
    a, b = (ML.evaluate(ML.score(m, rows)).first() for m in (on_rows, counted))
    assert abs(a.accuracy - b.accuracy) < 0.03 and abs(a.f1 - b.f1) < 0.03 and b.accuracy > 0.85
    a, b = ({r.feature: r.importance for r in ML.feature_importance(m).collect()} for m in (on_rows, counted))
    assert max(abs(a[f] - b[f]) for f in a) < 0.08
    assert max(t.depth for t in counted.stages[3].trees) <= 6
    # a tree's root holds a bootstrap of all rows
    drawn = [sum(t._call_java("rootNode").impurityStats().stats()) for t in counted.stages[3].trees]
    assert abs(np.mean(drawn) - 4000) < 100 and np.std(drawn) > 20


def test_many_blocks_count_like_one(spark, rows):
    points = ML.points(rows, n=F.lit(True))
    index, assemble, scale, forest = ML.build_pipeline(trees=20, depth=5).getStages()
    ready = ML.PipelineModel(stages=[index.fit(rows), assemble, scale.fit(assemble.transform(rows))])
    model = FT.fit_counted(forest, ready.transform(points), "n", 4, block_points=37)
    right = model.transform(ready.transform(rows)).where("prediction = label").count() / rows.count()
    assert right > 0.85


def test_a_point_weighs_as_many_rows_as_it_stands_for(spark):
    """4.5 divides the labels; 10 million rows are counted, not written out one by one as rows with draws."""
    points = spark.range(10).select(F.col("id").cast("double").alias("a"), F.when(F.col("id") < 5, "low").otherwise("high").alias("l"),
                                    F.when(F.col("id") < 5, 1_500_000).otherwise(500_000).cast("long").alias("n"))
    model = ML.train_counted(points, "n", features=["a"], label="l", trees=3, depth=3)
    assert model.stages[0].labels == ["low", "high"]
    assert {t.numNodes for t in model.stages[3].trees} == {3}
    drawn = [list(t._call_java("rootNode").impurityStats().stats()) for t in model.stages[3].trees]
    assert all(abs(low - 7_500_000) < 30_000 and abs(high - 2_500_000) < 20_000 for low, high in drawn)
    out = ML.score(model, points).select("l", "predicted_label").collect()
    assert all(r.l == r.predicted_label for r in out)


def test_written_out(spark):
    counts = {"a": 0, "b": 1, "c": 999, "d": 1000, "e": 2501}
    df = spark.createDataFrame(list(counts.items()), "k string, n long").where("n > 0")
    got = {r.k: r["count"] for r in ML.written_out(df, "n").groupBy("k").count().collect()}
    assert got == {k: n for k, n in counts.items() if n}


def test_thresholds():
    few = np.array([1.0, 3.0, 3.0, 7.0])
    assert FT.thresholds(few, np.ones(4), 32).tolist() == [2.0, 5.0]
    assert FT.thresholds(np.zeros(5), np.ones(5), 32).tolist() == []
    even = FT.thresholds(np.arange(320.0), np.ones(320), 32)
    assert even.tolist() == [10 * i - 0.5 for i in range(1, 32)]
    weighted = FT.thresholds(np.arange(64.0), np.where(np.arange(64) < 32, 3, 1), 4)
    assert len(weighted) == 3 and weighted[-1] < 32


def test_best_split_is_the_one_of_all_splits():
    r = np.random.default_rng(3)
    hist = r.integers(0, 5, size=(6, 2, 8, 3)).astype(float)
    hist[:, 1] = 0
    hist[:, 1, 0] = hist[:, 0].sum(1)  # a feature of one value
    hist[5] = 0
    hist[5, :, 3] = [4, 0, 1]
    got = FT.best_splits(hist)
    gini = lambda s: 1 - ((s / s.sum()) ** 2).sum()
    for node in range(5):
        total, gains = hist[node, 0].sum(0), []
        for b in range(7):
            left = hist[node, 0, :b + 1].sum(0)
            right = total - left
            gains.append(gini(total) - (left.sum() * gini(left) + right.sum() * gini(right)) / total.sum())
        assert got["k"][node] == 0 and got["bin"][node] == int(np.argmax(gains))
        assert got["gain"][node] == pytest.approx(max(gains))
        assert got["left"][node].tolist() == hist[node, 0, :int(np.argmax(gains)) + 1].sum(0).tolist()
    assert got["gain"][5] == 0 and got["stats"][5].tolist() == [4, 0, 1]


def test_score_once_is_score(spark, rows):
    model = ML.train(rows, trees=5, depth=4)
    odd = rows.limit(50).union(spark.createDataFrame([(float("nan"), *[0.0] * 6, "CLIMB"), (*[0.0] * 7, "UNSEEN"), (-0.0, *[0.0] * 6, "CLIMB"), (*[0.0] * 7, "CLIMB")], ROWS))
    table = lambda df: sorted(map(str, df.select(*ML.FEATURES, "flight_phase", "label", "prediction", "predicted_label", "probability").collect()))
    assert table(ML.score_once(model, odd)) == table(ML.score(model, odd))


@pytest.mark.parametrize("query", ["predictions_check", "confusion_matrix"])
def test_forest_queries_on_many_rows(spark, monkeypatch, query):
    """As if the table had more than MLLIB_ROWS rows: no training on the rows themselves, all test rows in the results."""
    sf = "/root/testdata/sf0.001"
    tests = registry.QUERIES["test_rows"](spark, sf).count()
    monkeypatch.setattr(ML, "MLLIB_ROWS", 0)
    out = registry.QUERIES[query](spark, sf)
    if query == "predictions_check":
        assert out.count() == tests
        assert out.where("label_is_likeliest and shares_sum_to_one and walk_agrees").count() == tests
    else:
        assert out.agg(F.sum("count")).first()[0] == tests
