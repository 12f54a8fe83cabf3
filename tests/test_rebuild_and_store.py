"""Rebuilds that fail and are taken up again, observed checks, merges into stored versions, files with bad rows."""

import json
import os

import pytest

from core_help import SF_SMALL, rows
from personalens.operators import quality, snapshots
from personalens.plans.warehouse import Warehouse
from personalens.sources import io
from personalens.sources.store import VersionedTables

MODELS = ("review_persona_attributes", "ad_persona_attributes", "unified_persona_attributes", "review_ranking")


def _files(top):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(top) for f in names}


def test_killed_build_is_taken_up_and_readers_never_mix_versions(spark, tmp_path, monkeypatch):
    target = str(tmp_path / "models")
    tables = VersionedTables(spark, target)
    assert tables.current() is None and tables.read() == {}
    first = Warehouse.from_driver_tables(spark, SF_SMALL).build_all(target, MODELS, version="a")
    assert first.reused == [] and tables.current() == "a" and set(tables.read()) == set(MODELS)
    before = _files(f"{target}/versions/a")

    write, written = quality.write_observed, []

    def killed(df, model, path):
        if len(written) == 2:
            df.limit(1).write.mode("overwrite").parquet(path)  # half a table, without a marker
            raise RuntimeError("lost")
        written.append(model)
        return write(df, model, path)

    monkeypatch.setattr(quality, "write_observed", killed)
    with pytest.raises(RuntimeError, match="lost"):
        Warehouse.from_driver_tables(spark, SF_SMALL).build_all(target, MODELS, version="b")
    assert tables.current() == "a" and tables.unfinished() == "b"
    assert {t: df.inputFiles()[0].split("/versions/")[1][0] for t, df in tables.read().items()} == dict.fromkeys(MODELS, "a")
    with pytest.raises(RuntimeError, match="unified_persona_attributes"):
        tables.switch("b", list(MODELS))
    reader = tables.read()

    monkeypatch.setattr(quality, "write_observed", write)
    kept = {m: _files(tables.path("b", m)) for m in written}
    again = Warehouse.from_driver_tables(spark, SF_SMALL).build_all(target, MODELS)
    assert again.version == "b" and again.reused == list(MODELS[:2]) == written and again.removed == []
    assert {m: _files(tables.path("b", m)) for m in written} == kept and _files(f"{target}/versions/a") == before
    assert tables.current() == "b" and rows(tables.read()["review_ranking"]) == rows(reader["review_ranking"])
    fresh = Warehouse.from_driver_tables(spark, SF_SMALL)
    assert rows(tables.read()["unified_persona_attributes"]) == rows(fresh.unified_persona_attributes)
    third = Warehouse.from_driver_tables(spark, SF_SMALL).build_all(target, MODELS[:1], version="c")
    assert third.removed == ["a"] and tables.versions() == ["b", "c"]


def test_observed_figures_equal_the_separate_checks(spark, tmp_path):
    wh = Warehouse.from_driver_tables(spark, SF_SMALL)
    report = wh.build_all(str(tmp_path), MODELS)
    for model in MODELS:
        columns = [c for m, c in quality.NOT_NULL_TESTS if m == model]
        want = rows(quality.not_null_counts(getattr(wh, model), columns, model))
        assert sorted((r for r in report.not_null() if r[0] == model), key=repr) == want
    accepted = [(m, c, v) for m, c, v in quality.ACCEPTED_VALUES_TESTS if m in MODELS]
    assert report.accepted_values() == [tuple(quality.accepted_values_counts(getattr(wh, m), c, v, m).first()) for m, c, v in accepted] != []


def test_missing_columns_and_wrong_counts_are_seen(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame([(1, None), (None, "x")], "cad_account_id long, persona_attribute string")
    got = quality.write_observed(df, "gap_analysis", f"{tmp_path}/a")
    assert got["rows"] == 2 and got["null_rows"] == {"cad_account_id": 1, "persona_attribute": 1, "gap_priority": None,
                                                     "gap_type": None, "recommendation": None}

    class Twice(quality.Observation):  # as if a task had run twice
        @property
        def get(self):
            return {k: 2 * v for k, v in super().get.items()}

    monkeypatch.setattr(quality, "Observation", Twice)
    assert quality.write_observed(df, "gap_analysis", f"{tmp_path}/b") == got


def test_close_removes_the_scratch_of_a_run(spark):
    wh = Warehouse.from_driver_tables(spark, SF_SMALL, materialize=("review_problems",))
    assert wh.review_problems.count() > 0
    top = wh._scratch(spark)
    assert os.path.isdir(top.removeprefix("file:"))
    wh.close()
    assert not os.path.isdir(top.removeprefix("file:"))


STATES = [("2024-01-01", [(1, "a"), (2, "b"), (3, None)]), ("2024-02-01", [(1, "a"), (2, "B"), (4, "d")]),
          ("2024-03-01", [(1, None), (2, "B"), (3, "c"), (4, "d")])]


def test_stored_merges_equal_the_whole_merge_and_leave_history_alone(spark, tmp_path):
    store = snapshots.VersionStore(spark, str(tmp_path), "k", ["v"], buckets=4)
    whole, closed = None, {}
    for day, state in STATES:
        df = spark.createDataFrame(state, "k long, v string")
        store.merge(df, day)
        whole = snapshots.first_versions(df, "k", ["v"], day) if whole is None else snapshots.scd2_merge(whole, df, "k", ["v"], day)
        assert rows(store.versions()) == rows(whole)
        now = {f: t for f, t in _files(tmp_path).items() if "is_current=false" in f and f.endswith(".parquet")}
        assert closed.items() <= now.items()
        closed = now
    assert closed and sum("is_current=true" in d for d, _, _ in os.walk(tmp_path)) == 1
    with pytest.raises(ValueError, match="not after"):
        store.merge(df, STATES[-1][0])


def test_a_merge_shuffles_the_snapshot_alone(spark, tmp_path):
    store = snapshots.VersionStore(spark, str(tmp_path), "k", ["v"], buckets=4)
    store.merge(spark.range(1000).selectExpr("id as k", "'x' as v"), "2024-01-01")
    spark.range(1000).selectExpr("id as k", "'y' as v").write.parquet(f"{tmp_path}/state")
    plan = store.after(spark.read.parquet(f"{tmp_path}/state"), "2024-02-01")._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and "is_current=true" not in plan.split("Exchange")[0]
    exchanges = [line for line in plan.splitlines() if "Exchange" in line]
    assert len(exchanges) == 1, plan
    below = plan[plan.index("Exchange"):]
    assert "/state" in below.split("Bucketed: true")[0] or "/state" in below


def test_a_failed_merge_leaves_the_versions_and_may_run_again(spark, tmp_path, monkeypatch):
    store = snapshots.VersionStore(spark, str(tmp_path), "k", ["v"], buckets=4)
    frames = [spark.createDataFrame(s, "k long, v string") for _, s in STATES]
    store.merge(frames[0], STATES[0][0])
    before = rows(store.versions())
    replace = store.folder.replace
    monkeypatch.setattr(store.folder, "replace", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        store.merge(frames[1], STATES[1][0])
    assert rows(store.versions()) == before
    monkeypatch.setattr(store.folder, "replace", replace)
    store.merge(frames[1], STATES[1][0])
    assert rows(store.versions()) == rows(snapshots.scd2_merge(
        snapshots.first_versions(frames[0], "k", ["v"], STATES[0][0]), frames[1], "k", ["v"], STATES[1][0]))


def test_bad_run_documents_are_kept_apart(spark, tmp_path):
    good = {"metadata": {"invocation_id": "r1"}, "results": [{"unique_id": "m", "status": "error", "execution_time": 1.5}]}
    for name, text in {"good": json.dumps(good, indent=1), "cut": json.dumps(good)[:-9], "types": '{"metadata": 3, "results": "x"}', "none": ""}.items():
        (tmp_path / f"{name}.json").write_text(text)
    docs = quality.read_run_documents(spark, str(tmp_path))
    assert sorted((r.run_id, r.bad_text is None) for r in docs.collect() if r.run_id) == [("r1", True)]
    counts = {r.run_id: (r.good_documents, r.bad_documents, r.total_models, r.failed) for r in quality.document_counts(docs).collect()}
    assert counts["r1"] == (1, 0, 1, 1) and counts[None][1] == 2
    assert rows(quality.read_run_results(spark, str(tmp_path)), "run_id", "unique_id") == [("r1", "m")]


def test_seed_rows_over_lines_and_bad_rows(spark, tmp_path):
    path = str(tmp_path / "seed.csv")
    with open(path, "w", newline="") as f:
        f.write("ad_account_id,ad_account_name,product,matched_review_product,review_account_name,review_account_id\n"
                '1,Acme,"a kit\nin two lines",kit,Shop,2\nnot a number,B,p,q,r,3\n4,C,p\n')
    assert rows(io.read_seed_csv(spark, path)) == [(1, "Acme", "a kit\nin two lines", "kit", "Shop", 2)]
    bad = [r.row_text for r in io.bad_seed_rows(spark, path).collect()]
    assert len(bad) == 2 and any("not a number" in b for b in bad) and any(b.startswith("4,C") for b in bad)


def test_contract_names_missing_and_undocumented_columns(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a long, b string")
    assert rows(quality.contract_counts(df, ["a", "c"], "m")) == sorted(
        [("m", "a", "present", 2), ("m", "b", "undocumented", 1), ("m", "c", "missing", None)], key=repr)
    assert rows(quality.contract_counts(df, None, "m"), "status") == [("no_contract",)] * 2
