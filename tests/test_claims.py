"""Two ingests of one run at the same time: one lands it, the other is refused."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest

from lakegate.plans import ingest
from lakegate.sinks.objects import RunClaimedError, break_claims, claimed_runs, claims_folder
from lakegate.sources.documents import read_landing_table
from lakegate.sources.tables import read_manifests
from tests.test_plans import ingest as run_ingest
from tests.test_plans import page_text


def runs(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "run_id string")


def test_a_claim_is_held_by_one_and_given_back(spark, tmp_path):
    root = str(tmp_path)
    with claimed_runs(spark, runs(spark, "a", "a", None), root) as first:
        (claim,) = (tmp_path / "_claims").glob("[0-9]*")
        assert claim.read_text() == first
        with pytest.raises(RunClaimedError), claimed_runs(spark, runs(spark, "b", "a"), root):
            raise AssertionError("not reached")
        # The refused one gives back what it had taken, and leaves the other's claim.
        assert [p.read_text() for p in (tmp_path / "_claims").glob("[0-9]*")] == [first]
    with pytest.raises(KeyError), claimed_runs(spark, runs(spark, "a"), root):
        raise KeyError
    with claimed_runs(spark, runs(spark, "a"), root), claimed_runs(spark, runs(spark), root):
        pass
    assert list((tmp_path / "_claims").glob("[0-9]*")) == []


def test_many_runs_take_a_bounded_number_of_claims(spark, tmp_path):
    with claimed_runs(spark, spark.range(5000).selectExpr("CAST(id AS STRING) AS run_id"), str(tmp_path), slots=7):
        assert len(list((tmp_path / "_claims").glob("[0-9]*"))) == 7


def test_claims_of_a_lost_driver_are_broken_by_age(spark, tmp_path):
    root, now = str(tmp_path), datetime.now()
    assert break_claims(spark, root, now) == 0
    (tmp_path / "_claims").mkdir()
    with claimed_runs(spark, runs(spark, "a"), root):
        assert break_claims(spark, root, now - timedelta(hours=1)) == 0
        assert break_claims(spark, root, now + timedelta(hours=1)) == 1
    assert claims_folder(root).endswith("/_claims")


def test_of_two_interleaved_ingests_one_lands_the_run(spark, tmp_path, monkeypatch):
    requests, moment = [{"run_id": "both"}], datetime(2032, 5, 6, 7)
    pages = [("both", 1, page_text(1, 1))]
    judge, refused = ingest.judge_pages, []

    def meanwhile(*given):
        """A second ingest of the run starts when the first has been let in and has not landed."""
        monkeypatch.setattr(ingest, "judge_pages", judge)
        with pytest.raises(RunClaimedError):
            run_ingest(spark, tmp_path, requests, pages, moment)
        refused.append(True)
        return judge(*given)

    monkeypatch.setattr(ingest, "judge_pages", meanwhile)
    outcome = run_ingest(spark, tmp_path, requests, pages, moment)
    assert refused and [r.status for r in outcome.manifests.collect()] == ["COMPLETED"]
    assert read_landing_table(spark, str(tmp_path / "landing")).count() == 1
    later = run_ingest(spark, tmp_path, requests, pages, moment)
    assert [r.decision for r in later.decisions.collect()] == ["SKIP"]
    assert read_landing_table(spark, str(tmp_path / "landing")).count() == 1
    assert read_manifests(spark, str(tmp_path / "manifests")).count() == 1
