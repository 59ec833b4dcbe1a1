import numpy as np
import pytest
from pyspark.sql import functions as F

from hearth.operators import boosting as B
from hearth.operators import cleaning, model as M
from hearth.operators.encoding import SmoothedTargetEncoder
from hearth.session import work_dir
from hearth.sources import adapters
from tests.conftest import SF_SMALL, rows

REQUESTS = [(1, "view", 2, False), (2, "never-seen", 1, True), (3, "click", 6, None), (4, None, 3, True)]


def clean(spark):
    return cleaning.clean_listings(adapters.observations(spark, SF_SMALL))


def listings(spark, n=400, seed=1):
    """Rents that depend on the inputs."""
    rng = np.random.default_rng(seed)
    names = ["a", "b", "c", "d", None]
    out = []
    for i in range(n):
        c, r, p = names[rng.integers(5)], int(rng.integers(1, 5)), bool(rng.integers(2))
        y = {"a": 100, "b": 200, "c": 320, "d": 480, None: 250}[c] + 60 * r + 25 * p * r + float(rng.normal() * 10)
        out.append((i, c, r if i % 17 else None, p if i % 13 else None, round(y, 2)))
    return spark.createDataFrame(out, "id long, neighborhood string, rooms int, is_pet_friendly boolean, monthly_rent_eur double")


def plain_boost(x, y, learning_rate, depth, trees, lam=1.0):
    """Boosting over rows, every split tried at every value; the same gain and leaf rule, no histograms."""
    pred = np.full(len(y), y.mean())
    for _ in range(trees):
        g = y - pred

        def grow(at, left):
            total, n = g[at].sum(), len(at)
            best = (B.LEAST_GAIN * max(1.0, total ** 2 / (n + lam)), None, None)
            if left:
                for f in range(x.shape[1]):
                    for cut in np.unique(x[at, f])[:-1]:
                        a, b = at[x[at, f] <= cut], at[x[at, f] > cut]
                        gain = g[a].sum() ** 2 / (len(a) + lam) + g[b].sum() ** 2 / (len(b) + lam) - total ** 2 / (n + lam)
                        if gain > best[0] + (1e-6 * max(1.0, best[0]) if best[1] is not None else 0):
                            best = (gain, f, cut)
            if best[1] is None:
                pred[at] += learning_rate * total / (n + lam)
                return
            _, f, cut = best
            grow(at[x[at, f] <= cut], left - 1)
            grow(at[x[at, f] > cut], left - 1)

        grow(np.arange(len(y)), depth)
        yield pred.copy()


@pytest.mark.parametrize("learning_rate, depth", [(0.3, 1), (0.1, 3), (0.5, 6)])
def test_boosting_equals_plain_numpy(learning_rate, depth):
    rng = np.random.default_rng(depth)
    x = rng.integers(0, (9, 5, 2), size=(300, 3))
    y = x @ np.array([3.0, -2.0, 1.0]) + x[:, 0] * x[:, 2] + rng.normal(size=300)
    cells, at = np.unique(x, axis=0, return_inverse=True)
    cells = np.vstack([cells, [[9, 5, 2]]])  # a cell without rows
    at = at.ravel()
    count, total = np.bincount(at, minlength=len(cells)).astype(float), np.bincount(at, y, minlength=len(cells))
    staged = {}
    B.boost(cells, count, total, learning_rate, depth, 8, lambda n, p: staged.setdefault(n, p))
    for n, want in enumerate(plain_boost(x, y, learning_rate, depth, 8), 1):
        assert np.allclose(staged[n][at], want, atol=1e-8)


def test_nodes_score_as_the_fit(spark):
    """The table of nodes, walked by joins, gives the predictions of the fit, also in cells without rows."""
    data = listings(spark)
    model = M.fit_model(data, 0.2, 3, 6)
    pdf = model.cells.toPandas().sort_values(list(M.BINS))
    every = model.grid.toPandas().sort_values(list(M.BINS))
    bins = every[list(M.BINS)].to_numpy()
    known = {tuple(r[:3]): r[3:] for r in pdf[[*M.BINS, "rows", "total"]].to_numpy()}
    held = np.array([known.get(tuple(float(c) for c in b), (0.0, 0.0)) for b in bins])
    got = {}
    B.boost(bins, held[:, 0], held[:, 1], 0.2, 3, 6, lambda n, p: got.update({n: p}))
    assert np.allclose(every["prediction"], got[6])
    nodes = model.nodes.toPandas()
    inner = nodes[nodes["input"].notna()]
    assert set(nodes["tree"]) == {-1, *range(6)} and (inner["gain"] > 0).all() and inner["left"].notna().all()
    # the fit follows the rents
    err = model.transform(data).select(F.avg(F.abs(F.col("prediction") - F.col(M.TARGET)))).first()[0]
    base = data.select(F.avg(F.abs(F.col(M.TARGET) - 330))).first()[0]
    assert err < base / 2


def test_save_load_predicts_the_same(spark):
    fitted = M.fit_model(clean(spark), n_estimators=3, max_depth=3)
    loaded = M.load_model(M.save_model(fitted, work_dir(spark, "t-model")), spark)
    req = spark.createDataFrame(REQUESTS, "request_id long, neighborhood string, rooms int, is_pet_friendly boolean")
    a = rows(M.predict(fitted, req), "request_id", "predicted_rent_eur")
    b = rows(M.predict(loaded, req), "request_id", "predicted_rent_eur")
    assert a == b and all(p is not None for _, p in a)  # unseen and missing categories still score
    imp = M.feature_importance(fitted).agg(F.sum("importance_percent")).first()[0]
    assert abs(imp - 100.0) < 1e-6
    assert "view" in [r[0] for r in M.model_vocabulary(fitted).collect()]
    assert M.predict(loaded, req.withColumn("prediction", F.lit("x"))).count() == 4


def test_empty_training_table_gives_null_predictions(spark):
    model = M.fit_model(listings(spark).limit(0), n_estimators=2)
    req = spark.createDataFrame(REQUESTS, "request_id long, neighborhood string, rooms int, is_pet_friendly boolean")
    assert [r["predicted_rent_eur"] for r in M.predict(model, req).collect()] == [None] * 4


def test_search_grid_is_a_seeded_sample():
    a = M.search_grid()
    assert len(a) == 15 and a == M.search_grid()


def test_search_equals_plain_numpy(spark):
    """Encodings, bins, folds, fits and errors of the whole search, over rows and without Spark aggregates."""
    data = listings(spark, 240, 4)
    maps = dict(n_iter=6, folds=3, learning_rates=(0.1, 0.3), max_depths=(2, 4), n_estimators=(2, 5))
    got = {(r["learning_rate"], r["max_depth"], r["n_estimators"]): r["cv_mae"] for r in M.cross_validate(data, **maps).collect()}
    pdf = data.withColumn("part", M.split_bucket(F.col("id"), M.SEED + 1) % 3).toPandas()
    want = {k: [] for k in got}
    for k in range(3):
        learn, check = pdf[pdf["part"] != k], pdf[pdf["part"] == k]
        prior = learn[M.TARGET].mean()
        stats = learn.groupby("neighborhood")[M.TARGET].agg(["count", "mean"])
        w = 1 / (1 + np.exp(-(stats["count"] - 20) / 10.0))
        enc = (prior * (1 - w) + stats["mean"] * w).where(stats["count"] > 1, prior).to_dict()

        def inputs(d):
            return np.array([[enc.get(c, prior), 0.0 if r != r else r, float(p is True)]
                             for c, r, p in zip(d["neighborhood"], d["rooms"], d["is_pet_friendly"])])

        xl, xc = inputs(learn), inputs(check)
        # values in the fold go to the side of the cut midway between the learning rows' values
        for f in range(3):
            v = np.unique(xl[:, f])
            xc[:, f] = v[np.searchsorted((v[:-1] + v[1:]) / 2, xc[:, f], side="left")]
        both, y = np.vstack([xl, xc]), learn[M.TARGET].to_numpy()
        for lr, depth, n in got:
            *_, pred = plain_boost_with_rest(xl, y, both, lr, depth, n)
            want[lr, depth, n].append(np.abs(check[M.TARGET].to_numpy() - pred[len(xl):]).mean())
    for key, errors in want.items():
        assert abs(got[key] - np.mean(errors)) < 1e-6


def plain_boost_with_rest(x, y, every, learning_rate, depth, trees, lam=1.0):
    """``plain_boost`` that also scores the rows of ``every``."""
    pred, out = np.full(len(y), y.mean()), np.full(len(every), y.mean())
    for _ in range(trees):
        g = y - pred

        def grow(at, rest, left):
            total, n = g[at].sum(), len(at)
            best = (B.LEAST_GAIN * max(1.0, total ** 2 / (n + lam)), None, None)
            if left:
                for f in range(x.shape[1]):
                    for cut in np.unique(x[at, f])[:-1]:
                        a, b = at[x[at, f] <= cut], at[x[at, f] > cut]
                        gain = g[a].sum() ** 2 / (len(a) + lam) + g[b].sum() ** 2 / (len(b) + lam) - total ** 2 / (n + lam)
                        if gain > best[0] + (1e-6 * max(1.0, best[0]) if best[1] is not None else 0):
                            best = (gain, f, cut)
            if best[1] is None:
                pred[at] += learning_rate * total / (n + lam)
                out[rest] += learning_rate * total / (n + lam)
                return
            _, f, cut = best
            # between two values of the node's rows lie values of other rows: the cut is at the table's next value
            grow(at[x[at, f] <= cut], rest[every[rest, f] <= cut], left - 1)
            grow(at[x[at, f] > cut], rest[every[rest, f] > cut], left - 1)

        grow(np.arange(len(y)), np.arange(len(every)), depth)
        yield out.copy()


def test_search_prefixes_equal_single_fits(spark):
    data = clean(spark)
    model, results = M.fit_search(data, n_iter=3, folds=2, learning_rates=(0.2,), max_depths=(2,), n_estimators=(1, 2, 4))
    got = {r["n_estimators"]: r["cv_mae"] for r in results.collect()}
    assert set(got) == {1, 2, 4} and sorted(r["rank"] for r in results.collect()) == [1, 2, 3]
    alone = M.cross_validate(data, n_iter=1, folds=2, learning_rates=(0.2,), max_depths=(2,), n_estimators=(2,)).first()
    assert abs(alone["cv_mae"] - got[2]) < 1e-9
    assert model.trees == min(got, key=got.get)


def test_fold_encodings_equal_the_encoder(spark):
    """The encodings of all folds from one aggregate are those of an encoder fitted outside each fold."""
    data = listings(spark).withColumn("part", F.col("id").cast("int") % 3)
    got = {(r["fold"], r["neighborhood"]): r["te"] for r in M.fold_vectors(data, 3).groupBy("fold", "neighborhood")
           .agg(F.max("neighborhood_te").alias("te")).collect()}
    for k in range(3):
        stats = SmoothedTargetEncoder().fit(data.where(F.col("part") != k)).stats.collect()
        for r in stats:
            assert abs(got[k, r["neighborhood"]] - r["encoded"]) < 1e-9


def test_shapley_equals_brute_force(spark):
    model = M.fit_model(listings(spark, 120), 0.3, 3, 5)
    pred = {tuple(r[b] for b in M.BINS): r["prediction"] for r in model.grid.collect()}
    weight = {tuple(r[b] for b in M.BINS): r["rows"] for r in model.cells.collect()}
    total = sum(weight.values())

    def value(x, s):
        return sum(w * pred[tuple(x[i] if i in s else c[i] for i in range(3))] for c, w in weight.items()) / total

    phi = {tuple(r[b] for b in M.BINS): [r[f"phi_{b}"] for b in M.BINS] for r in B.shapley(model.grid, model.cells, M.BINS).collect()}
    assert set(phi) == set(pred)
    for x, got in phi.items():
        for i in range(3):
            a, b = [j for j in range(3) if j != i]
            want = ((value(x, {i}) - value(x, set())) / 3 + (value(x, {i, a}) - value(x, {a})) / 6
                    + (value(x, {i, b}) - value(x, {b})) / 6 + (value(x, {0, 1, 2}) - value(x, {a, b})) / 3)
            assert abs(got[i] - want) < 1e-8
        assert abs(sum(got) - (pred[x] - value(x, set()))) < 1e-8
    out = model.contributions(listings(spark, 10))
    assert out.columns[-4:] == ["prediction", "phi_neighborhood", "phi_rooms", "phi_is_pet_friendly"] and out.count() == 10


def test_many_values_are_binned_by_rows(spark):
    """More values than bins: about the same number of rows in every bin, and a hot value is one bin's edge."""
    df = spark.range(5000).select(F.when(F.col("id") % 3 == 0, 7.5).otherwise(F.col("id") / 10.0).alias("x"), F.lit(1.0).alias("weight"))
    cuts = B.cut_points(df, ["x"], max_bins=16)[("x",)]
    assert 8 <= len(cuts) <= 15 and cuts == sorted(cuts) and 7.5 in cuts
    held = df.groupBy(B.bin_of(F.col("x"), cuts).alias("b")).count().collect()
    assert max(r["count"] for r in held) <= 5000 / 3 + 2 * 5000 / 16
    assert B.cut_points(df.limit(0), ["x"]) == {}
