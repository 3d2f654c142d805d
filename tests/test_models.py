import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tallyspark.operators import evaluate, features, likelihood, models
from tallyspark.sources import sinks


@pytest.fixture(scope="module")
def planted(spark):
    """Three parties that can be told from two columns."""
    rng = np.random.default_rng(3)
    party = rng.choice(["DEM", "REP", "LIB"], 600, p=[0.6, 0.3, 0.1])
    centre = {"DEM": (2, 0), "REP": (-2, 0), "LIB": (0, 3)}
    rows = []
    for i, p in enumerate(party):
        x = np.array(centre[p]) + rng.normal(size=2)
        rows.append((i, str(p), [float(v) for v in x], float(3 * x[0] - x[1] + rng.normal())))
    df = spark.createDataFrame(rows, "id long, primary_party string, x array<double>, dem_amount double")
    df = df.select("id", "primary_party", array_to_vector("x").alias("features"), "dem_amount").cache()
    return df.where("id % 4 <> 0"), df.where("id % 4 = 0"), rows


def test_classifiers_beat_majority(spark, planted, tmp_path):
    train, val, _ = planted
    made = {
        "Logistic Regression": models.logistic(train.count()),
        "Random Forest": models.forest_classifier(trees=10, depth=5, leaf=2),
        "Gradient Boosting": models.boosted_classifier(trees=5, depth=3),
    }
    fitted, metrics = models.party_classifiers(train, val, made)
    rows = {r["model_name"]: r for r in metrics.collect()}
    majority = val.where("primary_party = 'DEM'").count() / val.count()
    assert all(r["val_accuracy"] > majority + 0.1 for r in rows.values())
    best = models.best_classifier(fitted, metrics)
    assert max(rows.values(), key=lambda r: r["val_f1_weighted"])["model_name"] in made and best is not None
    auc = {r["class"]: r["auc"] for r in models.party_auc(fitted["Logistic Regression"], val).collect()}
    assert auc["weighted"] > 0.9 and set(auc) == {"DEM", "REP", "LIB", "weighted"}
    wide = models.with_party_probabilities(val, fitted["Random Forest"])
    assert len(wide.first()["stage2_features"]) > 2
    from pyspark.ml import PipelineModel

    sinks.save_model(PipelineModel([fitted["Random Forest"]]), metrics, str(tmp_path / "m"), names=["a", "b"])
    again, table, facts = sinks.load_model(spark, str(tmp_path / "m"))
    assert facts == {"names": ["a", "b"]} and table.count() == 3
    before = fitted["Random Forest"].transform(val).orderBy("id").select("prediction").collect()
    assert again.transform(val).orderBy("id").select("prediction").collect() == before


def test_logistic_is_at_its_optimum(planted):
    """The gradient of C * weighted loss + |w|^2 / 2 vanishes at the fit."""
    train, _, _ = planted
    rows = models.balanced(models.party_index(train), "label")
    model = models.logistic(train.count()).fit(rows)
    data = rows.select("features", "label", "weight").collect()
    x = np.array([r["features"].toArray() for r in data])
    y = np.array([int(r["label"]) for r in data])
    w = np.array([r["weight"] for r in data])
    coef, bias = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    z = x @ coef.T + bias
    p = np.exp(z - z.max(1, keepdims=True))
    p /= p.sum(1, keepdims=True)
    p[np.arange(len(y)), y] -= 1
    assert np.abs((p * w[:, None]).T @ x + coef).max() < 0.05 * np.abs(coef).max()


def test_ridge_is_closed_form(planted):
    train, _, _ = planted
    model = models.ridge(train, "dem_amount", alpha=5.0).fit(train)
    data = train.select("features", "dem_amount").collect()
    x = np.array([r["features"].toArray() for r in data])
    y = np.array([r["dem_amount"] for r in data])
    xc, yc = x - x.mean(0), y - y.mean()
    exact = np.linalg.solve(xc.T @ xc + 5.0 * np.eye(2), xc.T @ yc)
    assert model.coefficients.toArray() == pytest.approx(exact, rel=1e-8)
    assert models.non_negative(model, train).agg(F.min("prediction")).first()[0] >= 0


def test_amount_models(planted):
    train, val, _ = planted
    make = lambda p: {"Ridge Regression": lambda df: models.ridge(df, "dem_amount"),
                      "Random Forest": lambda df: models.forest_regressor("dem_amount", 5, 4, 5)}
    out, metrics = models.all_amount_models(train, val, parties=("DEM",), make_for=make)
    rows = {r["model_name"]: r["val_mae"] for r in metrics.collect()}
    assert out["DEM"]["best_name"] == min(rows, key=rows.get)


def test_kernel_svm_learns_a_ring(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 2))
    inside = (x ** 2).sum(1) < 1.2
    rows = [(i, "DEM" if a else "REP", [float(v) for v in r]) for i, (a, r) in enumerate(zip(inside, x))]
    df = spark.createDataFrame(rows, "id long, primary_party string, x array<double>").select(
        "id", "primary_party", array_to_vector("x").alias("features")
    )
    fitted, metrics = models.party_classifiers(df, df, {"SVM": models.KernelSvm(size=100)})
    assert metrics.first()["val_accuracy"] > 0.85
    auc = {r["class"]: r["auc"] for r in models.party_auc(fitted["SVM"], df).collect()}
    assert auc["DEM"] > 0.85 and auc["REP"] > 0.85


def test_kernel_svm_is_near_the_exact_kernel_machine(spark):
    """With landmarks for a part of the rows the margins stay close to those of all kernel columns, which satisfy the optimum's conditions."""
    from tallyspark.operators import kernel_svm

    rng = np.random.default_rng(2)
    x = rng.normal(size=(120, 3))
    y = np.where((x ** 2).sum(1) + 0.3 * rng.normal(size=120) < 2.4, 1, 0)
    rows = [(i, float(c), [float(v) for v in r], 1.0) for i, (c, r) in enumerate(zip(y, x))]
    df = spark.createDataFrame(rows, "id long, label double, x array<double>, weight double")
    df = df.select("id", "label", "weight", array_to_vector("x").alias("features"))
    exact = models.KernelSvm(size=120, c=2.0).fit(df)
    few = models.KernelSvm(size=40, c=2.0).fit(df)
    assert exact.unexplained < 1e-8 < few.unexplained < 0.08
    # The dual of the exact machine, by coordinate steps on pairs of rows.
    sign, gamma = np.where(y == 1, 1.0, -1.0), exact.mapping.gamma
    k = kernel_svm.kernel(x, x, gamma)
    a = np.zeros(120)
    f = -sign.copy()
    for _ in range(20_000):
        up = ((sign > 0) & (a < 2 - 1e-12)) | ((sign < 0) & (a > 1e-12))
        low = ((sign < 0) & (a < 2 - 1e-12)) | ((sign > 0) & (a > 1e-12))
        i, j = np.where(up, f, np.inf).argmin(), np.where(low, f, -np.inf).argmax()
        if f[j] - f[i] < 1e-5:
            break
        step = (f[j] - f[i]) / max(k[i, i] + k[j, j] - 2 * k[i, j], 1e-12)
        step = min(step, 2 - a[i] if sign[i] > 0 else a[i], a[j] if sign[j] > 0 else 2 - a[j])
        a[i] += sign[i] * step
        a[j] -= sign[j] * step
        f += step * (k[:, i] - k[:, j])
    want = k @ (a * sign) - (f[i] + f[j]) / 2
    at = list(exact.classes[:, 0]).index(1)
    spread = np.abs(want).mean()
    assert np.abs(exact.margins(x)[:, at] - want).max() < 0.1 * spread
    assert np.abs(few.margins(x)[:, at] - want).mean() < 0.15 * spread


def test_every_classifier_saves_and_loads(spark, planted, tmp_path):
    from pyspark.ml import PipelineModel

    train, val, _ = planted
    made = {
        "Logistic Regression": models.logistic(train.count()), "Random Forest": models.forest_classifier(trees=4, depth=4, leaf=5),
        "Gradient Boosting": models.boosted_classifier(trees=3, depth=3), "SVM": models.KernelSvm(size=32),
    }
    fitted, metrics = models.party_classifiers(train, val, made)
    for name, model in fitted.items():
        sinks.save_model(PipelineModel([model]), metrics, str(tmp_path / name), name=name)
        again, _, facts = sinks.load_model(spark, str(tmp_path / name))
        rows = lambda m: m.transform(val).orderBy("id").select("prediction", "probability").collect()
        assert rows(again) == rows(model) and facts == {"name": name}


def test_every_classifier_gives_probabilities_for_stage_two(planted):
    train, val, _ = planted
    made = {"Gradient Boosting": models.boosted_classifier(trees=3, depth=3), "SVM": models.KernelSvm(size=32)}
    fitted, _ = models.party_classifiers(train, val, made)
    for model in fitted.values():
        assert all(r["auc"] > 0.7 for r in models.party_auc(model, val).collect() if r["auc"] is not None)
        stacked = models.with_party_probabilities(val, model)
        row = stacked.first()
        width, shares = len(row["features"]), row["stage2_features"].toArray()[len(row["features"]):]
        assert len(row["stage2_features"]) > width and shares.sum() == pytest.approx(1.0) and (shares >= 0).all()


def test_metrics_edge_cases(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("c", "a")], "t string, p string")
    rows = {r["label"]: r for r in evaluate.class_metrics(df, "t", "p").collect()}
    assert rows["b"]["support"] == 0 and rows["b"]["recall"] == 0.0 and rows["c"]["precision"] == 0.0
    tied = spark.createDataFrame([(1, 0.5), (0, 0.5), (1, 0.9), (0, 0.6)], "y int, s double")
    assert evaluate.roc_auc(tied, "y", "s").first()["auc"] == pytest.approx(0.625)
    one = evaluate.roc_auc(tied.where("y = 1"), "y", "s").first()
    assert one["auc"] is None
    zero = spark.createDataFrame([(0.0, 1.0), (0.0, 2.0)], "y double, p double")
    m = evaluate.regression_metrics(zero, "y", "p").first()
    assert m["mape"] == float("inf") and m["mae"] is None and m["n_positive"] == 0
    bins = {r["bin"]: r for r in evaluate.calibration(tied.selectExpr("y", "s * 0.6 AS s"), "y", "s").collect()}
    # The third edge is 3 * 0.1, a little above 0.3, so 0.3 is still in the bin below.
    assert (bins[2]["n"], bins[3]["n"], bins[5]["n"]) == (2, 1, 1)
    assert bins[9]["mean_score"] == pytest.approx(0.95) and bins[9]["n"] == 0


def test_feature_scopes(spark):
    train = spark.createDataFrame([(i, "A" if i < 3 else "B", "x") for i in range(5)], "id int, employer string, occupation string")
    other = spark.createDataFrame([(9, "B", " "), (10, None, "x"), (11, "", "x")], "id int, employer string, occupation string")
    rows = {r["id"]: r for r in features.demographic_features(other, train, 1).collect()}
    assert rows[9]["employer_grouped"] == "OTHER" and rows[9]["occupation_grouped"] == "OTHER"
    assert rows[10]["employer"] == "UNKNOWN" and rows[10]["occupation_grouped"] == "X"
    own = {r["id"]: r["employer_grouped"] for r in features.demographic_features(other, None, 1).collect()}
    assert own == {9: "OTHER", 10: "UNKNOWN", 11: "UNKNOWN"}


def test_encoder_unseen_and_scaling(spark):
    columns, numeric = features.feature_columns()
    base = {c: "a" for c in columns} | {c: 0.0 for c in numeric}
    train = spark.createDataFrame([{**base, "total_amount": v, "state": s} for v, s in ((1.0, "x"), (3.0, "y"))])
    model = features.encoder(features.FULL, 2).fit(train)
    val = model.transform(spark.createDataFrame([{**base, "state": "never", "total_amount": 3.0}])).first()
    dense = val["features"].toArray()
    assert list(dense[:2]) == [0.0, 0.0]
    # Population deviation: (3 - 2) / 1.
    assert dense[5 + numeric.index("total_amount")] == pytest.approx(1.0)


def test_label_codes(spark):
    train = spark.createDataFrame([("b",), ("a",), (None,)], "cmte_party string")
    df = spark.createDataFrame([("a",), ("b",), (None,), ("zz",)], "cmte_party string")
    coded = likelihood.encode_labels(df, likelihood.label_encoder(train, ["cmte_party"]))
    got = {r["cmte_party"]: r["cmte_party_encoded"] for r in coded.collect()}
    assert got == {"UNKNOWN": 0.0, "a": 1.0, "b": 2.0, "zz": 0.0}
