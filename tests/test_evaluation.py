import numpy as np
import pytest

from aerofeat.operators.evaluation import confusion_matrix, roc_curve


def roc_reference(y, s):
    """Classic ROC points (threshold, fpr, tpr), brute force in NumPy."""
    order = np.argsort(-s, kind="mergesort")
    s, y = s[order], y[order]
    idx = np.r_[np.where(np.diff(s))[0], len(y) - 1]
    tps = np.cumsum(y)[idx]
    fps = 1 + idx - tps
    thr = s[idx]
    if len(fps) > 2:
        keep = np.where(np.r_[True, np.logical_or(np.diff(fps, 2), np.diff(tps, 2)), True])[0]
        fps, tps, thr = fps[keep], tps[keep], thr[keep]
    tps, fps, thr = np.r_[0, tps], np.r_[0, fps], np.r_[thr[0] + 1, thr]
    return thr, fps / fps[-1], tps / tps[-1]


@pytest.mark.parametrize("n_ranges", [1, 3, 8, 40])
@pytest.mark.parametrize("seed,n,levels", [(0, 500, 20), (1, 2000, 400), (2, 50, 5), (3, 3, 3)])
def test_roc_matches_brute_force(spark, n_ranges, seed, n, levels):
    rng = np.random.default_rng(seed)
    s = rng.integers(0, levels, n).astype(float)
    y = rng.random(n) < (0.2 + 0.6 * s / levels)
    if y.all() or not y.any():
        y[0] = not y[0]
    df = spark.createDataFrame([(float(a), bool(b)) for a, b in zip(s, y)], "score double, target boolean")
    got = sorted((r["threshold"], r["fpr"], r["tpr"])
                 for r in roc_curve(df, "target", "score", n_ranges=n_ranges).collect())
    thr, fpr, tpr = roc_reference(y.astype(int), s)
    want = sorted(zip(thr.tolist(), fpr.tolist(), tpr.tolist()))
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g == pytest.approx(w)


def test_roc_monotone(spark):
    rng = np.random.default_rng(7)
    s = rng.random(3000)
    y = rng.random(3000) < s
    df = spark.createDataFrame([(float(a), bool(b)) for a, b in zip(s, y)], "score double, target boolean")
    pts = sorted(((r["threshold"], r["fpr"], r["tpr"]) for r in roc_curve(df, "target", "score").collect()),
                 reverse=True)
    assert pts[0][1:] == (0.0, 0.0) and pts[-1][1:] == (1.0, 1.0)
    assert all(a[1] <= b[1] and a[2] <= b[2] for a, b in zip(pts, pts[1:]))


def test_confusion_always_four_cells(spark):
    df = spark.createDataFrame([(True, True), (True, True), (False, True)],
                               "target boolean, prediction boolean")
    cm = {(r["actual"], r["predicted"]): r["n"] for r in confusion_matrix(df).collect()}
    assert cm == {(False, False): 0, (False, True): 1, (True, False): 0, (True, True): 2}
    assert sum(cm.values()) == df.count()


def test_roc_many_ranges(spark):
    rng = np.random.default_rng(11)
    s = np.round(rng.normal(size=4000), 3)
    y = rng.random(4000) < 1 / (1 + np.exp(-2 * s))
    df = spark.createDataFrame([(float(a), bool(b)) for a, b in zip(s, y)], "score double, target boolean")
    got = sorted((r["threshold"], r["fpr"], r["tpr"])
                 for r in roc_curve(df, "target", "score", n_ranges=300).collect())
    thr, fpr, tpr = roc_reference(y.astype(int), s)
    want = sorted(zip(thr.tolist(), fpr.tolist(), tpr.tolist()))
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g == pytest.approx(w)


def test_area_is_summed_without_one_array(spark):
    import numpy as np
    from aerofeat.operators import evaluation
    from aerofeat.plans import catalog
    rnd = np.random.default_rng(4)
    x, y = np.sort(rnd.random(999).round(2)), np.sort(rnd.random(999))
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "fpr double, tpr double").repartition(5)
    want = ((x[1:] - x[:-1]) * (y[1:] + y[:-1]) / 2).sum()
    for n in (1, 7, 64):
        got = evaluation.roc_area(df, n).first()
        assert (got.fpr_end, got.tpr_end) == (x[-1], y[-1]) and abs(got.area - want) < 1e-9
    assert evaluation.roc_area(df.limit(0)).first().area is None
    plan = catalog.q_training_job_roc(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan


@pytest.mark.parametrize("n_ranges", [None, 1, 7])
def test_grouped_roc_equals_one_curve_for_each_group(spark, n_ranges):
    rng = np.random.default_rng(4)
    rows = [(g, float(s), bool(rng.random() < (s + 1) / 30)) for g, n in (("a", 900), ("b", 40), (None, 60), ("c", 2))
            for s in rng.integers(0, 25, n)]
    rows += [(g, 3.0, y) for g in ("a", "b", None, "c") for y in (True, False)]
    df = spark.createDataFrame(rows, "g string, score double, target boolean")
    got = {}
    for r in roc_curve(df, "target", "score", n_ranges=n_ranges, by=["g"]).collect():
        got.setdefault(r.g, []).append((r.threshold, r.fpr, r.tpr))
    assert set(got) == {"a", "b", "c", None}
    for g, points in got.items():
        part = [(s, y) for k, s, y in rows if k == g]
        thr, fpr, tpr = roc_reference(np.array([y for _, y in part]).astype(int), np.array([s for s, _ in part]))
        assert np.allclose(sorted(points), sorted(zip(thr, fpr, tpr)))


def test_roc_of_no_rows(spark):
    df = spark.createDataFrame([], "g string, score double, target boolean")
    assert roc_curve(df, by=["g"]).collect() == [] and roc_curve(df).collect() == []
