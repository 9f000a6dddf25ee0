import numpy as np
import pandas as pd

from netsift.operators import metrics as M
from netsift.operators.quantiles import exact_quantiles


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.integers(0, 50, 600), np.full(300, 7), rng.normal(0, 100, 100).round(2)])
    df = spark.createDataFrame(pd.DataFrame({"v": x.astype(float)}))
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.95, 1.0]
    got = exact_quantiles(df, "v", probs).first()
    for i, p in enumerate(probs):
        assert abs(got[i] - np.percentile(x, p * 100)) < 1e-9


def _brute_auc_ap(y, s):
    pos, neg = s[y == 1], s[y == 0]
    auc = np.mean([(1.0 if a > b else 0.5 if a == b else 0.0) for a in pos for b in neg])
    ap = 0.0
    P = len(pos)
    for t in sorted(set(s), reverse=True):
        sel = s >= t
        tp = (y[sel] == 1).sum()
        newpos = ((y == 1) & (s == t)).sum()
        ap += newpos / P * tp / sel.sum()
    return auc, ap


def test_auc_ap_with_ties(spark):
    rng = np.random.default_rng(3)
    y = rng.integers(0, 2, 300)
    s = rng.integers(0, 20, 300).astype(float) + y * 2
    df = spark.createDataFrame(pd.DataFrame({"y": y, "score": s}))
    auc, ap = _brute_auc_ap(y, s)
    assert abs(M.roc_auc(df).first()[0] - auc) < 1e-6
    assert abs(M.average_precision(df).first()[0] - ap) < 1e-6


def test_confusion_one_class(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "y int, pred int")
    r = M.prf(df).first()
    assert (r.tn, r.fp, r.fn, r.tp) == (2, 0, 0, 0) and r.f1 == 0.0


def test_corr_matrix_pairwise_deletion(spark):
    from netsift.operators.profile import corr_matrix
    rng = np.random.default_rng(7)
    a = rng.normal(1e6, 5e3, 500)
    b = a * 0.5 + rng.normal(0, 1e3, 500)
    c = rng.normal(0, 1, 500)
    a[::7] = np.nan
    c[::5] = np.nan
    pdf = pd.DataFrame({"a": a, "b": b, "c": c, "k": np.full(500, 3.0)})
    got = {(r.col_a, r.col_b): r.corr for r in corr_matrix(spark.createDataFrame(pdf), ["a", "b", "c", "k"]).collect()}
    want = pdf.corr()
    for (x, y), v in got.items():
        if y == "k" or x == "k":
            assert v is None
        else:
            assert abs(v - want.loc[x, y]) < 1e-6
