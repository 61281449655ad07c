from dataclasses import replace

import numpy as np
import pytest

from fieldcast.plans import department_ridge as G
from fieldcast.settings import Settings

RUN = Settings(crops=(1, 2), last_training_year=2019)


@pytest.fixture(scope="module")
def rows(spark):
    """Crop 1: 40 departments whose yield follows its inputs; crop 2: one constant input, few rows;
    crop 3 is not part of the run."""
    rng = np.random.default_rng(7)
    out = []
    for crop, n in ((1, 40), (2, 3), (3, 2)):
        for dept in range(n):
            level = rng.normal(50, 8)
            for year in range(2012, 2024):
                t, p, r, s = rng.normal(18, 2), rng.normal(26, 2), rng.normal(2e5, 3e4), rng.normal(200, 9)
                if crop == 2:
                    s = 7.0
                y = level + 1.5 * (t - 18) - 0.8 * (p - 26) + (r - 2e5) / 1e4 + rng.normal(0, 1)
                out.append((crop, f"D{dept}", year, float(y), float(t), float(p), float(r), float(s)))
    out += [(1, "D1", 2024, None, 1.0, 1.0, 1.0, 1.0), (1, "D2", 2024, 50.0, None, 26.0, 2e5, 200.0)]
    return spark.createDataFrame(out, "crop_id int, dept_code string, year int, yield_q_ha double, temp_avg double, "
                                 "temp_peak double, rain double, sun_mean double").repartition(6)


def arrays(rows, crop):
    data = [r for r in rows if r["crop_id"] == crop]
    return np.array([[r[c] for c in G.INPUTS] for r in data]), np.array([r["yield_q_ha"] for r in data])


def test_inputs_know_the_years_before_only(rows):
    got = {(r["crop_id"], r["dept_code"], r["year"]): r for r in G.department_inputs(rows).collect()}
    assert (1, "D0", 2012) not in got and (1, "D1", 2024) not in got and (1, "D2", 2024) not in got
    first = [r["yield_q_ha"] for r in rows.where("crop_id = 1 AND dept_code = 'D0' AND year < 2015").orderBy("year").collect()]
    assert got[1, "D0", 2015]["past_mean"] == pytest.approx(np.mean(first))


def test_weights_solve_the_normal_equations(rows):
    train, test = G.split(G.department_inputs(rows), RUN)
    known = train.collect()
    weights = {r["crop_id"]: r for r in G.ridge_weights(G.gram_sums(train)).collect()}
    assert set(weights) == {1, 2}
    predicted = {(r["crop_id"], r["dept_code"], r["year"]): r["predicted"]
                 for r in G.ridge_predictions(test, G.ridge_weights(G.gram_sums(train))).collect()}
    for crop in (1, 2):
        x, y = arrays(known, crop)
        sd = x.std(axis=0)
        z = (x - x.mean(axis=0)) / np.where(sd > 1e-9, sd, 1.0)
        want = np.linalg.solve(z.T @ z + G.PENALTY * np.eye(x.shape[1]), z.T @ (y - y.mean()))
        got = [weights[crop][f"weight_{c}"] for c in G.INPUTS]
        assert got == pytest.approx(want, rel=1e-6, abs=1e-6)
        for r in test.where(f"crop_id = {crop}").collect():
            z = (np.array([r[c] for c in G.INPUTS]) - x.mean(axis=0)) / np.where(sd > 1e-9, sd, 1.0)
            assert predicted[crop, r["dept_code"], r["year"]] == pytest.approx(y.mean() + z @ want, rel=1e-6)
    assert weights[2]["weight_sun_mean"] == pytest.approx(0.0, abs=1e-9)


def test_models_side_by_side(rows):
    inputs = G.department_inputs(rows)
    got = {(r["crop_id"], r["model"]): r for r in G.department_models(inputs, RUN).collect()}
    assert set(got) == {(c, m) for c in (1, 2) for m in ("baseline", "ridge", "boosted")}
    assert len({r["n_rows"] for k, r in got.items() if k[0] == 1}) == 1
    assert got[1, "ridge"]["mae"] < got[1, "baseline"]["mae"] and got[1, "ridge"]["r2"] > 0.9
    assert got[1, "boosted"]["mae"] < got[1, "baseline"]["mae"]
    late = replace(RUN, last_training_year=2030)
    assert G.department_models(inputs, late).count() == 0
