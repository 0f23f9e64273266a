"""Training, export and scoring through node tables."""
import os

import pytest
from pyspark.sql import functions as F

from pondlens.operators import ensembles as E
from pondlens.operators import models as M
from pondlens.operators import scoring as SC
from pondlens.operators import trees as T

from tests.test_models_scoring import _main

LIGHT = {"rf": T.Settings("forest", trees=8, min_split=5, min_leaf=2),
         "xgb": T.Settings("boost", trees=12, rate=0.3, max_depth=4, min_weight=3, gamma=0.1, l2=1.0, subsample=0.8, colsample=0.8),
         "lgb": T.Settings("boost", trees=12, rate=0.3, max_depth=4, leaves=8, min_leaf=5)}


@pytest.fixture(scope="module")
def trained(spark, tmp_path_factory):
    main, out = _main(spark, 300).cache(), str(tmp_path_factory.mktemp("models"))
    return main, out, E.Export(spark, E.train(main, out, folds=3, settings=LIGHT))


def test_summary_and_choice(spark, trained):
    main, _, e = trained
    rows = E.summary(e).collect()
    assert len(rows) == 9 and all(r.error is None and r.cv_mean is not None and r.cv_std >= 0 for r in rows)
    assert all(r.r2 > 0.7 for r in rows if r.model_type == "Survival Rate" and r.algorithm != "RF")
    for t, best in e.best().items():
        assert best.cv_mean == max(r.cv_mean for r in e.results if r.target == t)
    info = E.export_metadata(e).collect()
    assert {r.target for r in info} == set(M.TARGETS) and all(r.n_features == len(M.feature_columns(main)) for r in info)


def test_errors_and_importance(spark, trained):
    main, _, e = trained
    errors = E.prediction_errors(e, main).collect()
    assert len({(r.target, r.algorithm) for r in errors}) == 9
    assert all(abs(r.error - (r.prediction - r.actual)) < 1e-9 for r in errors)
    test_ids = {r.id for r in main.where(~M.is_train()).collect()}
    assert {r.id for r in errors} == test_ids
    got = E.feature_importance(e).collect()
    for t in M.TARGETS:
        mine = [r for r in got if r.target == t]
        assert sum(r.importance for r in mine) == pytest.approx(1) and not {r.feature for r in mine} & {"start_month_1", "start_quarter_1"}
    assert max((r for r in got if r.target == "sr"), key=lambda r: r.importance).feature == "stocking_density"


def test_scoring_clips_validates_and_fills(spark, trained):
    main, _, e = trained
    recs = SC.records_from_main(main).withColumn(
        "stocking_density", F.when(F.col("id") == 0, F.lit(-1.0)).otherwise(F.col("stocking_density"))).withColumn(
        "culture_duration", F.when(F.col("id") == 2, F.lit(0)).otherwise(F.col("culture_duration"))).withColumn(
        "morning_do", F.lit(None).cast("double"))
    out = {r.id: r for r in E.score(e, recs).collect()}
    assert len(out) == 300 and out[0].survival_rate is None and out[2].fcr is None and out[2].survival_rate is not None
    assert all(0 <= r.survival_rate <= 100 for r in out.values() if r.survival_rate is not None)
    assert all(0.5 <= r.fcr <= 3.0 for r in out.values() if r.fcr is not None)
    assert {r.status for r in E.model_info(e).collect()} == {"loaded"}
    # fields that a request lacks altogether take the training mean
    assert E.score(e, recs.drop("pond_volume", "start_month")).where("survival_rate IS NOT NULL").count() == 299


def test_unfinished_exports_are_passed_over(spark, trained, monkeypatch):
    main, out, e = trained
    assert E.exports(spark, out) == [e.folder] and E.exports(spark, os.path.join(out, "nowhere")) == []
    monkeypatch.setattr(M, "METADATA", "metadata\x00")      # the driver is lost while the metadata is written
    with pytest.raises(Exception):
        E.train(main, out, folds=2, settings={"xgb": LIGHT["xgb"]})
    monkeypatch.undo()
    assert len([d for d in os.listdir(out) if not d.startswith(".")]) == 2
    assert E.Export.latest(spark, out).folder == e.folder
    newer = E.train(main, out, folds=2, settings={"xgb": LIGHT["xgb"]})
    assert E.Export.latest(spark, out).folder == newer and E.exports(spark, out) == [e.folder, newer]


def test_a_failed_algorithm_is_left_out(spark, trained, monkeypatch, tmp_path):
    main = trained[0]
    fit = T.fit_nodes

    def broken(m, fits, *a):
        if fits[0].settings.kind == "forest":
            raise ValueError("no forest")
        return fit(m, fits, *a)

    monkeypatch.setattr(T, "fit_nodes", broken)
    e = E.Export(spark, E.train(main, str(tmp_path), folds=2, settings={k: LIGHT[k] for k in ("rf", "xgb")}))
    assert {r.algorithm: bool(r.error) for r in e.results} == {"rf": True, "xgb": False}
    assert {r.algorithm for r in e.best().values()} == {"xgb"}
    assert "no forest" in E.summary(e).where("error IS NOT NULL").first().error


def test_a_failed_algorithm_gives_no_partial_results(spark, trained, monkeypatch, tmp_path):
    """With one model missing there are no metadata, importances, errors or scores that look whole."""
    main, fit = trained[0], T.fit_nodes

    def broken(m, fits, *a):
        if fits[0].settings.kind == "forest" and fits[0].label == "fcr":
            raise ValueError("no forest")
        return fit(m, fits, *a)

    monkeypatch.setattr(T, "fit_nodes", broken)
    e = E.Export(spark, E.train(main, str(tmp_path), folds=2, settings={k: LIGHT[k] for k in ("rf", "xgb")}))
    for ask in (lambda: E.export_metadata(e), lambda: E.feature_importance(e), lambda: E.prediction_errors(e, main),
                lambda: E.score(e, SC.records_from_main(main))):
        with pytest.raises(RuntimeError, match="1 of 6 models failed; fcr by rf: ValueError: no forest"):
            ask()
    # what reports on the models still does
    assert E.summary(e).where("error IS NOT NULL").count() == 1 and E.model_info(e).count() == 3


def test_search_takes_the_best_draw(spark, trained, monkeypatch, tmp_path):
    main = trained[0]
    few = [T.Settings("boost", trees=2, rate=0.01, max_depth=1), T.Settings("boost", trees=15, rate=0.3, max_depth=4)]
    monkeypatch.setattr(E, "draw_settings", lambda a, n: few[:n])
    e = E.Export(spark, E.train(main, str(tmp_path), n_iter=2, folds=3, settings={"xgb": None}))
    assert all(r.settings == few[1] for r in e.results) and e.meta["search"] == {"n_iter": 2, "folds": 3, "fits": 18}


def test_draws_stay_in_the_ranges():
    for a in ("rf", "xgb", "lgb"):
        draws = E.draw_settings(a, 200)
        assert draws == E.draw_settings(a, 200) and all(100 <= s.trees < 500 for s in draws)
    assert {s.max_depth for s in E.draw_settings("rf", 500)} == {None, *range(5, 30)}
    assert all(3 <= s.max_depth < 10 and 0.01 <= s.rate <= 0.31 and 0.6 <= s.subsample <= 1 and 1 <= s.min_weight < 7
               for s in E.draw_settings("xgb", 200))
    assert all(20 <= s.leaves < 100 and s.min_weight == 1e-3 for s in E.draw_settings("lgb", 200))


def test_scaled_features(spark):
    main = _main(spark, 200).withColumn("pond_volume", F.when(F.col("id") % 9 != 0, F.col("pond_volume")))
    got = E.scaled_features(main).where(M.is_train()).agg(F.avg("stocking_density").alias("m"), F.stddev_pop("stocking_density").alias("s"),
                                                          F.max(F.abs("surface_to_volume_ratio")).alias("flat")).first()
    assert abs(got.m) < 1e-9 and got.s == pytest.approx(1) and got.flat == 0
    assert E.scaled_features(main).where("pond_volume = 0").count() >= 200 // 9
