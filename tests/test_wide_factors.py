"""Models of many factors are those of the library's ALS, without its rank x rank systems for users of few ratings."""

import numpy as np
import pytest

from kestrel.operators import recommend as rec
from kestrel.operators import wide_factors
from kestrel.operators.wide_factors import FactorModel, solved


@pytest.mark.parametrize("n, reg, alpha", [(3, 1000.0, 40.0), (9, 0.1, 2.0), (30, 0.1, 2.0), (4, 0.0, 1.0), (5, 0.5, 0.0)])
def test_either_system_gives_the_same_factors(n, reg, alpha):
    rng = np.random.default_rng(n)
    z, w = rng.normal(size=(n, 12)), rng.random(12) * 50
    rating = rng.integers(-1, 6, n).astype(float)
    rating[0] = 2.0
    c = alpha * abs(rating)
    a = np.diag(w + reg * (rating > 0).sum()) + (z.T * c) @ z
    want = np.linalg.solve(a, z.T @ np.where(rating > 0, 1 + c, 0.0))
    assert np.allclose(solved(z, rating, w, reg, alpha), want, rtol=1e-8, atol=1e-12)
    assert not solved(z, -abs(rating), w, reg, alpha).any()


def test_wide_models_are_those_of_the_library(spark, monkeypatch):
    rows = [(u, i, float(1 + (u * 7 + i) % 4)) for u in range(40) for i in range(25) if (u * i + u) % 5 < 2] + [(3, 5, 2.0), (3, 5, 2.0), (7, 1, -1.0)]
    data = spark.createDataFrame(rows, "user long, item long, rating double")
    plain = rec.fit_als(data, rank=6, max_iter=4, reg=0.1, alpha=2.0, blocks=3)
    monkeypatch.setattr(rec, "WIDE", 6)
    monkeypatch.setattr(wide_factors, "BLOCK_RATINGS", 40)
    wide = rec.fit_als(data, rank=6, max_iter=4, reg=0.1, alpha=2.0, blocks=3)
    assert isinstance(wide.model, FactorModel)
    for a, b in zip(rec.factor_tables(plain), rec.factor_tables(wide)):
        x, y = ({r[0]: r[1] for r in t.collect()} for t in (a, b))
        assert x.keys() == y.keys() and all(np.allclose(x[k], y[k], atol=1e-4) for k in x)
    pairs = data.select("user", "item").distinct().unionByName(spark.createDataFrame([(999, 1)], "user long, item long"))
    p, q = ({(r.user, r.item): r.score for r in rec.als_scorer(m)(pairs).collect()} for m in (plain, wide))
    assert p.keys() == q.keys() and all(p[k] == pytest.approx(q[k], abs=1e-4) for k in p)


def test_rows_are_read_by_their_places(tmp_path, monkeypatch):
    monkeypatch.setattr(wide_factors, "GAP", 2)
    rng = np.random.default_rng(1)
    files = wide_factors.Files(f"file://{tmp_path}/new", [], 3)
    saved = [(np.sort(rng.choice(1000, n, replace=False)), rng.normal(size=(n, 3)).astype(np.float32)) for n in (1, 40, 7)]
    files.names += [files.save(*saved[0]), "", files.save(*saved[1]), files.save(*saved[2])]
    assert all((a == b).all() for name, want in zip([n for n in files.names if n], saved) for a, b in zip(files.load(name), want))
    by_block = {0: saved[0][1], 2: saved[1][1], 3: saved[2][1]}
    block = rng.choice([0, 2, 3], 200)
    place = np.array([rng.integers(len(by_block[b])) for b in block])
    rows, at = files.rows(block, place)
    assert len(rows) == len(set(zip(block, place))) and all((rows[k] == by_block[b][p]).all() for k, b, p in zip(at, block, place))


def test_factors_are_not_shuffled(spark, monkeypatch):
    data = spark.createDataFrame([(u, i, 1.0) for u in range(9) for i in range(9) if (u + i) % 3], "user int, item int, rating double")
    monkeypatch.setattr(rec, "WIDE", 4)
    model = rec.fit_als(data, rank=4, max_iter=2, blocks=2)
    scored = model.model.transform(data.select("user", "item"))
    assert "features" not in scored._jdf.queryExecution().toString() and scored.count() == data.count()
