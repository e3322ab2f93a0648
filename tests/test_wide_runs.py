"""The wide runs search the whole grids over all categorical columns."""

from hedonic.models import sweep
from hedonic.plans import q_models


def test_wide_runs_take_whole_grids(monkeypatch):
    asked = []
    for name in ("run_sweep", "run_by_rmse"):
        monkeypatch.setattr(sweep, name, lambda *a, **k: asked.append(a) or {"summary": None, "metrics": None})
    monkeypatch.setattr(q_models, "sales", lambda *a: None)
    monkeypatch.setattr(q_models, "store", lambda *a: None)
    q_models.whole_sweep(None, "")
    q_models.whole_by_rmse(None, "")
    (_, first, *rest), (_, second, *_, candidates) = asked
    assert first["features"]["categorical"] == second["features"]["categorical"] == ["city", "state", "zip_code"]
    assert rest[2:] == [] and candidates == sweep.CANDIDATES
    grids = sweep.sweep_candidates(first)
    assert [c["alpha"] for c in grids["ridge"]] == [1.0, 2.0]
    assert [(c["n_estimators"], c["max_depth"]) for c in grids["boosted"]] == [(400, 6)]
