"""Delay models: trains on the feature table, repeatable, sane outputs."""
import pytest
from pyspark.sql import functions as F

from tramline.plans import ml
from tramline.plans.warehouse import Warehouse

from .conftest import SF_SMALL


@pytest.fixture(scope="module")
def trained(spark):
    feats = Warehouse.from_fixture(spark, SF_SMALL).ml_features
    return ml.train(feats, ml.ModelParams(n_estimators=5)), feats


def test_metrics_and_scoring(spark, trained):
    (models, test), feats = trained
    m = {(r["metric"], r["label"]): r["value"] for r in ml.metrics(models, test).collect()}
    assert m[("training_rows", None)] + m[("test_rows", None)] == feats.count()
    assert 0.0 <= m[("accuracy", None)] <= 1.0 and m[("mae_seconds", None)] >= 0
    s = ml.score(models, test.select(*ml.CAT_FEATURES, *ml.NUM_FEATURES))
    r = s.agg(F.min("predicted_delay_seconds"), F.max("predicted_delay_seconds"),
              F.max(F.abs(F.col("p_on_time") + F.col("p_delayed") + F.col("p_severe") - 1))).first()
    assert r[0] >= 0 and r[1] <= 1800 and r[2] < 1e-3
    assert {x[0] for x in s.select("predicted_bucket").distinct().collect()} <= {"on_time", "delayed", "severe"}


def test_unknown_category_and_missing_columns_score(spark, trained):
    (models, _), _ = trained
    df = spark.createDataFrame([("hovercraft", "hail")], "route_mode string, condition string")
    out = ml.score(models, df).first()
    assert out["predicted_bucket"] in {"on_time", "delayed", "severe"}


def test_split_is_deterministic(spark, trained):
    _, feats = trained
    a, _ = ml.split(ml.prepare(feats.repartition(3)))
    b, _ = ml.split(ml.prepare(feats.repartition(7)))
    assert a.count() == b.count()


def test_refuses_tiny_input(spark, trained):
    _, feats = trained
    with pytest.raises(ValueError):
        ml.train(feats.limit(50), ml.ModelParams(n_estimators=2))


def test_save_load_round_trip(spark, trained):
    import tempfile
    (models, test), _ = trained
    d = tempfile.mkdtemp(prefix="tramline-model-")
    ml.save(models, d, ml.metrics(models, test))
    back = ml.load(d)
    x = test.select(*ml.CAT_FEATURES, *ml.NUM_FEATURES).limit(50)
    a = [tuple(r) for r in ml.score(models, x).select("predicted_delay_seconds", "predicted_bucket").collect()]
    b = [tuple(r) for r in ml.score(back, x).select("predicted_delay_seconds", "predicted_bucket").collect()]
    assert a == b
    import json
    contract = json.loads(spark.read.text(f"{d}/features").first()[0])
    assert contract["cat_features"] == ml.CAT_FEATURES and contract["bucket_map"]["severe"] == 2
    assert spark.read.json(f"{d}/metrics").count() > 0


def test_registered_queries_train_the_whole_ensemble(spark, monkeypatch):
    from tramline import registry
    asked = []
    monkeypatch.setattr(registry, "_ML_CACHE", {})
    monkeypatch.setattr(ml, "train", lambda features, p=None: asked.append(p or ml.ModelParams()))
    registry._models(spark, SF_SMALL)
    assert [p.n_estimators for p in asked] == [300]


def test_boosting_fits_a_known_function(spark):
    """Classes and a number that follow from the features: accuracy and error far better than chance, probabilities that
    sum to one, the same model whatever the partitions, lineage cut on the way."""
    import numpy as np
    from tramline.plans import boosting
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 4))
    label = (x[:, 0] > 0).astype(int) + ((x[:, 0] > 0) & (x[:, 1] > 0.3))
    y = 10 * x[:, 2] + 5 * label
    df = spark.createDataFrame([(i, float(y[i]), int(label[i]), x[i].tolist()) for i in range(2400)],
                               "key long, y double, label int, x array<double>")
    params = boosting.BoostParams(rounds=25, max_depth=3, learning_rate=0.3)
    forest = boosting.fit(df.repartition(2), params)
    out = forest.predict(x[2400:])
    assert np.allclose(out[:, 1:].sum(1), 1)
    assert (out[:, 1:].argmax(1) == label[2400:]).mean() > 0.97
    assert np.abs(out[:, 0] - y[2400:]).mean() < 0.25 * np.abs(y[2400:] - y[:2400].mean()).mean()
    again = boosting.fit(df.repartition(5), params)
    assert np.array_equal(forest.feature, again.feature) and np.array_equal(forest.cut, again.cut)
    back = boosting.Forest.from_json(forest.to_json())
    assert np.array_equal(back.predict(x[2400:]), out)


def test_splits_follow_the_penalised_gain():
    """The best split of a node against every split tried by hand."""
    import numpy as np
    from tramline.plans import boosting as B
    rng = np.random.default_rng(1)
    p = B.BoostParams(reg_alpha=0.5, reg_lambda=2.0, min_child_weight=3.0)
    columns = np.array([1, 4])
    g, h = rng.normal(size=(3, 2, B.BINS)), rng.uniform(0, 1, size=(3, 2, B.BINS))
    g[:, 1], h[:, 1] = g[:, 0][:, ::-1], h[:, 0][:, ::-1]  # the same totals in another order
    g[2], h[2] = 0, 0.01  # nothing to gain
    sums = np.rint(np.stack([g, h]) * B.GRAIN).astype(np.int64)
    feature, cut = B.best_splits(sums, columns, p)
    shrunk = lambda v: np.sign(v) * max(abs(v) - 0.5, 0)
    for k in range(2):
        best = (0.0, -1, 0)
        for j in range(2):
            for b in range(B.BINS - 1):
                gl, hl, gr, hr = g[k, j, :b + 1].sum(), h[k, j, :b + 1].sum(), g[k, j, b + 1:].sum(), h[k, j, b + 1:].sum()
                if min(hl, hr) >= 3:
                    gain = shrunk(gl) ** 2 / (hl + 2) + shrunk(gr) ** 2 / (hr + 2) - shrunk(gl + gr) ** 2 / (hl + hr + 2)
                    best = max(best, (gain, columns[j], b), key=lambda t: t[0])
        assert (feature[k], cut[k]) == best[1:] or abs(best[0]) < 1e-6
    assert feature[2] == -1


def test_batch_scores_hold_every_feature_row(spark, trained, monkeypatch):
    from tramline import registry
    (models, test), feats = trained
    monkeypatch.setattr(registry, "_models", lambda s, sf: (models, test))
    assert registry.queries()["ml_batch_scores"](spark, SF_SMALL).count() == feats.count()


def test_metrics_read_stored_predictions(trained):
    """The forest scores each test row once, not once for each metric that reads it."""
    (models, test), _ = trained
    files = ml.metrics(models, test).inputFiles()
    assert files and all("/predictions/" in f for f in files)


@pytest.mark.parametrize("name, stored", [("ml_metrics_of_average", "/predictions/"), ("ml_split_counts", "/prepared/")])
def test_fact_is_built_once(spark, name, stored):
    """The plan of the result reads stored rows instead of holding the fact once for each count."""
    from tramline import registry
    files = registry.queries()[name](spark, SF_SMALL).inputFiles()
    assert files and all(stored in f for f in files)


def test_codes_hold_the_sums_of_every_feature():
    """Sums by code against sums by (node, feature, bin) made by hand; features that exclude each other share a code."""
    import numpy as np
    from tramline.plans import boosting as B
    rng = np.random.default_rng(3)
    n, kind = 500, rng.integers(0, 5, 500)
    bins = np.concatenate([rng.integers(0, 9, (n, 2)), kind[:, None] == np.arange(4), rng.integers(0, 2, (n, 1))], 1).astype(np.uint8)
    sizes = [9, 9, 2, 2, 2, 2, 2]
    above = (bins > 0).astype(int)
    layout = B.bundled(above.T @ above, sizes)
    assert [2, 3, 4, 5] in layout.bundles and sorted(f for b in layout.bundles for f in b) == list(range(7))
    y, label, margins = rng.normal(size=n), rng.integers(0, 3, n), rng.normal(size=(n, 4))
    feature, cut = rng.integers(-1, 7, (4, 7)), rng.integers(0, 2, (4, 7))
    params = B.BoostParams(subsample=2.0)  # every row is drawn
    got = B._sums((np.arange(n), y, label, bins, layout.codes(bins), margins), 2, params, 0, (feature, cut), layout)
    p = B.softmax(margins[:, 1:])
    for o in range(4):
        g = np.rint((margins[:, 0] - y if not o else p[:, o - 1] - (label == o - 1)) * B.GRAIN)
        h = np.rint((np.ones(n) if not o else 2 * p[:, o - 1] * (1 - p[:, o - 1])) * B.GRAIN)
        node = B.nodes_of(bins, feature[o], cut[o], 2) - 3
        want = np.zeros((2, 4, 7, B.BINS), np.int64)
        for j in range(7):
            np.add.at(want, (0, node, j, bins[:, j]), g.astype(np.int64))
            np.add.at(want, (1, node, j, bins[:, j]), h.astype(np.int64))
        assert np.array_equal(layout.dense(got[o], np.arange(7)), want)


def test_a_round_takes_one_job_a_level(spark):
    """No job of its own for the leaves' sums or for the margins, and one checkpoint is left, not one for each cut."""
    import glob
    import numpy as np
    from tramline.plans import boosting
    from tramline.session import checkpoint_dir
    rng = np.random.default_rng(0)
    df = spark.createDataFrame([(i, float(a), int(a > 0), [float(a), float(b)]) for i, (a, b) in enumerate(rng.normal(size=(300, 2)))],
                               "key long, y double, label int, x array<double>").cache()
    context = spark.sparkContext

    def jobs(rounds):
        context.setJobGroup(f"rounds{rounds}", "boosting")
        forest = boosting.fit(df, boosting.BoostParams(rounds=rounds, max_depth=3))
        return len(context.statusTracker().getJobIdsForGroup(f"rounds{rounds}")), forest

    kept = lambda: len(glob.glob(f"{checkpoint_dir(spark)}/*/rdd-*"))
    try:
        (few, short), before = jobs(2), kept()
        more, long = jobs(8)
        assert more - few == 6 * 3 and np.array_equal(long.leaf[:2], short.leaf)
        jobs(32)
        assert kept() - before == 1
    finally:
        context.setJobGroup("", "")
