"""Versions of a published run."""

import datetime as dt

import pytest

import parcelwatch
from parcelwatch.plans import process
from parcelwatch.sources.publication import commit_run, drop_versions, new_run, published_version, read_published, version_numbers

NOW = dt.datetime(2025, 10, 7, tzinfo=dt.timezone.utc)
HEAD = "X,RowId,Tracking Number,Carrier Code,Promised Delivery Date,Delivery Tracking Status,A\n"


def run(spark, base, rows, **options):
    (base / "in.csv").write_text(HEAD + "".join(f"d,{i},{i},FDX,2025-10-01,in transit,x\n" for i in range(rows)))
    return parcelwatch.process_and_publish(
        spark,
        str(base / "in.csv"),
        str(base / "out"),
        settings=parcelwatch.Settings(date_filter=False, reference_now=NOW),
        versioned=True,
        **options,
    )


def test_a_failed_run_leaves_the_former_version(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    with pytest.raises(FileNotFoundError):
        published_version(spark, out)
    assert run(spark, tmp_path, 2)["version"] == 1
    before = read_published(spark, out, "processed")

    def fails(*args, **kwargs):
        raise RuntimeError("between two tables")

    with monkeypatch.context() as m:
        m.setattr(process, "sink_views", fails)
        with pytest.raises(RuntimeError):
            run(spark, tmp_path, 3)
    assert version_numbers(spark, out) == [1]
    assert read_published(spark, out, "processed").count() == 2
    assert run(spark, tmp_path, 4, sidecar_order="RowId")["version"] == 2
    newest = published_version(spark, out)
    assert newest.number == 2 and {"all_shipments", "processed", "stalled", "sidecar", "marker"} <= set(newest.tables)
    assert {read_published(spark, out, t).count() for t in ("all_shipments", "processed", "all_issues")} == {4}
    assert before.count() == read_published(spark, out, "processed", 1).count() == 2
    with pytest.raises(FileNotFoundError):
        read_published(spark, out, "sidecar", 1)


def test_numbers_are_given_once_and_old_versions_go(spark, tmp_path):
    out = str(tmp_path / "out")
    for n in range(1, 5):
        folder = new_run(out)
        spark.range(n).write.parquet(f"{folder}/t")
        assert commit_run(spark, out, folder, ["t"]).number == n
    (tmp_path / "out" / "manifests" / "_draft").write_text("{")
    assert drop_versions(spark, out, 2) == [1, 2]
    assert version_numbers(spark, out) == [3, 4] and len(list((tmp_path / "out" / "runs").iterdir())) == 2
    assert read_published(spark, out, "t").count() == 4 and read_published(spark, out, "t", 3).count() == 3
    with pytest.raises(FileNotFoundError):
        published_version(spark, out, 1)
    with pytest.raises(ValueError):
        drop_versions(spark, out, 0)


def test_a_number_taken_meanwhile_is_left_to_the_other_run(spark, tmp_path, monkeypatch):
    from parcelwatch.sources import publication

    out = str(tmp_path / "out")
    for _ in range(2):
        commit_run(spark, out, new_run(out), [])
    monkeypatch.setattr(publication, "version_numbers", lambda *a: [])  # as seen before both were there
    assert commit_run(spark, out, new_run(out), []).number == 3
