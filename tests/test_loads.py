"""Loading: races of merges, quarantine, provenance, reports by snapshot, streams, CSV."""

from __future__ import annotations

import csv
import glob
import json
import os
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
import pytest
from pyspark.sql import functions as F

from faultline import schemas
from faultline.__main__ import main
from faultline.config import CLOUD, LOCAL
from faultline.operators import dedupe, quality
from faultline.plans import jobs
from faultline.sinks import versions, writers
from faultline.sources import facts as fact_source
from faultline.sources import listing, payloads, snapshots
from faultline.streaming import landing
from tests.helpers import COMPLAINT, RECALL


@pytest.fixture
def raw(spark):
    rows = [{name: None if row.get(name) is None else str(row[name]) for name in schemas.RAW_FIELDS} for row in (COMPLAINT, RECALL)]
    return spark.createDataFrame(rows, schemas.RAW)


def rows_of(spark, folder):
    return {r["record_id"]: r["body"] for r in fact_source.scan_facts(spark, folder, CLOUD).collect()}


def named(facts, key, day, body="x"):
    return facts.where("make = 'FORD'").withColumns({"record_id": F.lit(key), "body": F.lit(body), "scraped_at": F.lit(day).cast("timestamp")})


# ------------------------------------------------------------ merges


def test_a_file_is_created_once(spark, tmp_path):
    target = str(tmp_path / "claims" / "7")
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: listing.create_once(spark, target, f"writer {i}"), range(16)))
    assert sum(won) == 1
    assert listing.read_text(spark, target) == f"writer {won.index(True)}"
    assert os.listdir(tmp_path / "claims") == ["7"]


@pytest.mark.parametrize("same_partition", [True, False])
def test_two_merges_that_read_one_manifest_both_survive(spark, raw, tmp_path, monkeypatch, same_partition):
    folder = str(tmp_path / "facts")
    facts = jobs.standardise(raw, CLOUD)
    landing.merge_facts(facts, folder, "all", CLOUD)
    mine = named(facts, "first", "2030-01-01")
    other = named(facts, "second", "2030-01-01")
    if not same_partition:
        other = other.withColumn("year", F.lit(1999).cast("long"))
    commit, tried = versions.commit, []

    def late(entries, path, after):
        tried.append(after.name)
        if len(tried) == 1:  # another writer starts from the same manifest and commits first
            with monkeypatch.context() as plain:
                plain.setattr(versions, "commit", commit)
                landing.merge_facts(other, folder, "all", CLOUD)
        return commit(entries, path, after)

    monkeypatch.setattr(versions, "commit", late)
    path = landing.merge_facts(mine, folder, "all", CLOUD)
    assert tried == ["0000000001", "0000000002"]
    assert {"first", "second", "complaint_1", "recall_1"} <= set(rows_of(spark, folder))
    # rows are made again only where the other writer changed what they came from
    assert len(listing.folders(spark, f"{path}/version=*")) == (4 if same_partition else 3)


def test_many_merges_at_once(spark, raw, tmp_path):
    folder = str(tmp_path / "facts")
    facts = jobs.standardise(raw, CLOUD)
    with ThreadPoolExecutor(5) as pool:
        list(pool.map(lambda i: landing.merge_facts(named(facts, f"r{i}", "2030-01-01"), folder, "all", CLOUD), range(5)))
    assert set(rows_of(spark, folder)) == {f"r{i}" for i in range(5)}


def test_a_first_merge_lost_leaves_a_full_refresh_readable(spark, raw, tmp_path, monkeypatch):
    folder = str(tmp_path / "facts")
    facts = jobs.standardise(raw, CLOUD)
    writers.write_facts(facts, folder, "all")

    def lost(*_args):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as broken:
        broken.setattr(versions, "commit", lost)
        with pytest.raises(RuntimeError):
            landing.merge_facts(named(facts, "new", "2030-01-01"), folder, "all", CLOUD)
    assert set(rows_of(spark, folder)) == {"complaint_1", "recall_1"}
    landing.merge_facts(named(facts, "new", "2030-01-01"), folder, "all", CLOUD)
    assert set(rows_of(spark, folder)) == {"complaint_1", "recall_1", "new"}


def test_merges_leave_a_bounded_number_of_folders(spark, raw, tmp_path):
    folder = str(tmp_path / "facts")
    facts = jobs.standardise(raw, CLOUD).cache()
    path = versions.folder(folder, "all")
    for i in range(9):
        year = F.lit(2000 + i).cast("long")
        landing.merge_facts(named(facts, f"r{i}", "2030-01-01").withColumn("year", year), folder, "all", CLOUD)
        if i % 3 == 2:
            old = fact_source.manifests(spark, path)[-1]
            reader = fact_source.scan_merged(spark, path, CLOUD, old)
            assert versions.compact_facts(spark, folder, "all", CLOUD, most=2)
            versions.vacuum_facts(spark, folder, "all", keep=2, grace=0)
            assert reader.count() == i + 1  # a reader of the manifest before still finds its versions
    assert set(rows_of(spark, folder)) == {f"r{i}" for i in range(9)}
    assert len(listing.folders(spark, f"{path}/version=*")) <= 6  # two manifests, and what compaction made
    assert len(fact_source.manifests(spark, path)) == 2
    # nothing that is younger than the grace goes
    landing.merge_facts(named(facts, "last", "2030-01-01"), folder, "all", CLOUD)
    assert versions.vacuum_facts(spark, folder, "all", keep=1) == []
    assert not versions.compact_facts(spark, folder, "all", CLOUD, most=50)
    facts.unpersist()


# ------------------------------------------------------------ quarantine and provenance

LINES = [
    '{"record_id":"complaint_1","source":"nhtsa_complaints","make":"ford","year":"2015","model":"m"}', '{"record_id":"compl', "[1, 2]", "7",
    '{"record_id":"complaint_2","source":"nhtsa_complaints","make":"ford","year":"2015"}',
]


@pytest.fixture
def landed(tmp_path):
    for stem in ("nhtsa_1", "nhtsa_2"):
        file = tmp_path / "raw" / f"{stem}.json"
        file.parent.mkdir(exist_ok=True)
        file.write_text("\n".join(LINES if stem == "nhtsa_1" else LINES[:1]) + "\n")
    return str(tmp_path / "raw")


def test_corrupt_records_never_become_facts(spark, landed, tmp_path):
    found = snapshots.list_snapshots(spark, landed)
    read = snapshots.read_entries(spark, found, "lines", keep_corrupt=True, provenance=True)
    for refused in (jobs.transform, jobs.standardise):
        with pytest.raises(ValueError, match="unreadable"):
            refused(read, CLOUD)
    good, bad = snapshots.split_corrupt(spark, read)
    assert {(r["raw"], r["reason"], os.path.basename(r["source_file"])) for r in bad.collect()} == {
        (LINES[1], "not JSON", "nhtsa_1.json"), (LINES[2], "no object", "nhtsa_1.json"), (LINES[3], "no object", "nhtsa_1.json"),
    }
    assert good.count() == 3 and schemas.CORRUPT not in good.columns
    facts = jobs.transform(good, CLOUD)
    assert facts.where("record_id is null").count() == 0 and facts.count() == 2


def test_quarantine_is_replaced_by_file(spark, landed, tmp_path):
    read = snapshots.read_entries(spark, snapshots.list_snapshots(spark, landed), "lines", keep_corrupt=True, provenance=True)
    _, bad = snapshots.split_corrupt(spark, read)
    for _ in range(2):
        path = writers.write_quarantine(bad, str(tmp_path / "out"))
    assert spark.read.parquet(path).count() == 3


def test_facts_tell_their_snapshot(spark, landed, tmp_path):
    read = snapshots.read_entries(spark, snapshots.list_snapshots(spark, landed), "lines", keep_corrupt=True, provenance=True)
    good, _ = snapshots.split_corrupt(spark, read)
    folder = str(tmp_path / "facts")
    jobs.run_transform(good, folder, "run", CLOUD)
    rows = fact_source.scan_facts(spark, folder, CLOUD, provenance=True)
    found = {(r["record_id"], r["snapshot"]) for r in rows.select("record_id", snapshots.snapshot_of().alias("snapshot")).collect()}
    # a record that both snapshots hold is one fact, of the first file
    assert found == {("complaint_1", "nhtsa_1"), ("complaint_2", "nhtsa_1")}
    assert not set(schemas.PROVENANCE) & set(fact_source.scan_facts(spark, folder, CLOUD).columns)
    # merges keep it
    landing.merge_facts(rows.withColumn("scraped_at", F.lit("2030-01-01").cast("timestamp")), folder, "run", CLOUD)
    kept = fact_source.scan_facts(spark, folder, CLOUD, provenance=True)
    assert kept.where("source_file is null").count() == 0


def test_provenance_of_an_indented_array(spark, tmp_path):
    file = tmp_path / "nhtsa_3.json"
    file.write_text(json.dumps([COMPLAINT, RECALL], indent=2))
    rows = snapshots.read_snapshot(spark, str(file), provenance=True).collect()
    assert {(r["record_id"], os.path.basename(r["source_file"]), r["source_block"]) for r in rows} == {("complaint_1", "nhtsa_3.json", 0), ("recall_1", "nhtsa_3.json", 0)}
    assert all(r["source_modified"] is not None for r in rows)


def test_copies_are_one_record_whatever_their_origin(spark):
    rows = spark.createDataFrame([("a", "f2", 1), ("a", "f1", 7), ("b", None, 0), (None, "f1", 0), (None, "f3", 0)], "v string, source_file string, source_block long")
    kept = dedupe.drop_exact_duplicates(rows).collect()
    assert {tuple(r) for r in kept} == {("a", "f1", 7), ("b", None, 0), (None, "f1", 0)}


def test_a_null_among_results_is_no_record(spark):
    body = '{"results":[null,{"odiNumber":5,"components":null},null]}'
    frame = spark.createDataFrame([("ford", "m", 2020, "t", body)], "make string, model string, year int, fetched_at string, payload string")
    rows = payloads.flatten_complaints(frame).collect()
    assert [(r["record_id"], r["component"], r["body"], r["injuries"]) for r in rows] == [("complaint_5", None, "", "0")]


# ------------------------------------------------------------ reports


def test_reports_by_snapshot_and_drift(spark, tmp_path):
    folder = str(tmp_path / "reports")
    first = spark.createDataFrame([("s1", "a", "x"), ("s1", "a", None), ("s2", "b", " "), ("s2", "c", None)], "snapshot string, one string, two string")
    profiles = quality.field_profile(first, by="snapshot")
    for _ in range(2):  # a repeated run adds nothing
        path = writers.write_snapshot_profiles(profiles, folder)
    writers.write_snapshot_profiles(profiles.where("snapshot = 's2'"), folder)
    table = spark.read.parquet(path)
    assert table.count() == 4
    for stem in ("s1", "s2"):
        alone = quality.field_profile(first.where(F.col("snapshot") == stem).drop("snapshot"))
        assert sorted(map(str, table.where(F.col("snapshot") == stem).drop("snapshot").collect())) == sorted(map(str, alone.collect()))
    before, after = table.where("snapshot = 's1'"), table.where("snapshot = 's2' and field = 'one'")
    rows = {r["field"]: r for r in quality.profile_drift(before, after).collect()}
    assert rows["one"]["change"] == "changed" and rows["one"]["repeated_points"] == -50.0
    assert rows["two"]["change"] == "removed" and rows["two"]["missing_points"] is None
    assert [r["change"] for r in quality.profile_drift(before, before).collect()] == ["same", "same"]


def test_validation_keeps_profiles_of_each_snapshot(spark, landed, tmp_path):
    found = [e for e in snapshots.list_snapshots(spark, landed) if e.name == "nhtsa_2.json"]
    raw = snapshots.read_entries(spark, found, "lines", provenance=True)
    out = str(tmp_path / "reports")
    path = jobs.run_validate(raw, out, ["nhtsa_2.json"])
    table = spark.read.parquet(f"{out}/field_profiles")
    assert {r["snapshot"] for r in table.collect()} == {"nhtsa_2"}
    assert table.count() == len(schemas.RAW_FIELDS) == spark.read.parquet(f"{path}/field_profile").count()


def test_sketches_unite_without_a_rescan(spark):
    rows = spark.range(60_000).selectExpr("cast(id % 3 as string) as day", "cast(id % 20000 as string) as v", "cast(null as string) as nothing")
    sketches = quality.distinct_sketches(rows, "day")
    assert sketches.count() == 6
    found = {r["field"]: r["distinct_values"] for r in quality.distinct_estimates(sketches).collect()}
    assert abs(found["v"] - 20_000) <= 500 and found["nothing"] == 0


def test_results_are_readable_by_other_readers(spark, tmp_path):
    values = ['BRAKES "ABS", X', "a,b", "line\nbreak", "cr\r\nlf", "  lead", "trail  ", "back\\slash", 'back\\"q', "\\", '"', '""', "", None, " ", 'a"', "#c", "\t", "é漢", "x\\\ny", "end\\"]
    rows = spark.createDataFrame(list(enumerate(values)), "id int, v string")
    (path,) = writers.write_results({"t": rows.coalesce(1)}, str(tmp_path))
    (file,) = glob.glob(f"{path}/*.csv")
    with open(file, newline="", encoding="utf-8") as f:
        plain = [r for r in csv.reader(f)][1:]
    assert [(int(i), v) for i, v in plain] == [(i, v or "") for i, v in enumerate(values)]
    assert pd.read_csv(file, keep_default_na=False)["v"].tolist() == [v or "" for v in values]
    assert {r["id"]: r["v"] for r in writers.read_results(spark, path, rows.schema).collect()} == dict(enumerate(values))


# ------------------------------------------------------------ streams


def test_streams_ask_for_a_lexicon(spark, raw, tmp_path):
    with pytest.raises(ValueError, match="lexicon"):
        jobs.standardise(raw, LOCAL)
    stream = landing.stream_snapshots(spark, str(tmp_path))
    with pytest.raises(ValueError, match="lexicon"):
        landing.start_landing(stream, str(tmp_path / "f"), "all", LOCAL, str(tmp_path / "c"))


def test_stateful_dedupe_over_several_runs(spark, tmp_path):
    """The state outlives the query: a repeat in a later run is still known, a late record is dropped."""
    folder, out, checkpoint = str(tmp_path / "raw"), str(tmp_path / "out"), str(tmp_path / "checkpoint")
    os.makedirs(folder)

    def run(n, *records):
        lines = [json.dumps({"record_id": i, "make": "m", "model": "m", "year": "1", "scraped_at": at, "body": f"{n}"}) for i, at in records]
        with open(f"{folder}/nhtsa_{n}.json", "w") as f:
            f.write("\n".join(lines) + "\n")
        kept = landing.first_of_each(landing.stream_snapshots(spark, folder), within="2 days").select("record_id", "body")
        kept.writeStream.format("parquet").options(checkpointLocation=checkpoint, path=out).trigger(availableNow=True).start().awaitTermination()
        return sorted(tuple(r) for r in spark.read.schema("record_id string, body string").parquet(out).collect())

    assert run(1, ("a", "2024-01-10T00:00:00"), ("b", "2024-01-10T00:00:00")) == [("a", "1"), ("b", "1")]
    assert run(2, ("a", "2024-01-11T00:00:00"), ("c", "2024-01-20T00:00:00")) == [("a", "1"), ("b", "1"), ("c", "2")]
    # before the watermark of 18 January, a record is late; a key whose time has passed may come again
    assert run(3, ("d", "2024-01-05T00:00:00"), ("b", "2024-01-21T00:00:00"), ("e", None)) == [("a", "1"), ("b", "1"), ("b", "3"), ("c", "2"), ("e", "3")]


def test_summary_of_each_batch(spark, landed, tmp_path):
    stream = landing.stream_snapshots(spark, landed, files_per_batch=1, keep_corrupt=True, provenance=True)
    out = str(tmp_path / "facts")
    landing.start_landing(stream, out, "all", CLOUD, str(tmp_path / "c"), summary=str(tmp_path / "summary")).awaitTermination()
    found = {(r["figure"], r["value"]) for r in spark.read.schema(landing.SUMMARY).parquet(str(tmp_path / "summary")).collect()}
    assert {("rows_read", 5), ("unreadable", 3), ("rows", 2), ("make:FORD", 2), ("rows_read", 1), ("unreadable", 0)} <= found
    rows = fact_source.scan_facts(spark, out, CLOUD, provenance=True).collect()
    assert sorted(r["record_id"] for r in rows) == ["complaint_1", "complaint_2"]
    assert all(r["source_file"] for r in rows)


# ------------------------------------------------------------ catalog and command line


def test_latest_view_follows_the_catalog(spark, raw):
    spark.sql("create database loads_test")
    try:
        for stem in ("nhtsa_2", "nhtsa_1"):
            writers.save_snapshot_table(raw.withColumn("body", F.lit(stem)), "loads_test", stem)
        assert writers.latest_snapshot_view(spark, "loads_test") == "nhtsa_2"
        assert {r["body"] for r in spark.table("loads_test.latest").collect()} == {"nhtsa_2"}
        stats = spark.sql("describe extended loads_test.nhtsa_1 record_id").collect()
        assert any(r[0] == "distinct_count" and r[1] == "2" for r in stats)
    finally:
        spark.sql("drop database loads_test cascade")


def test_command_line_quarantines_compares_and_maintains(spark, landed, tmp_path, capsys):
    out = str(tmp_path / "out")
    for stem in ("nhtsa_1", "nhtsa_2"):
        os.makedirs(f"{out}/one/{stem}")
    main(["transform", "--raw", landed, "--out", f"{out}/facts", "--profile", "cloud", "--layout", "lines", "--quarantine", out, "--provenance"])
    assert "rows_written=1" in capsys.readouterr().out
    profiles = quality.field_profile(spark.createDataFrame([("s1", "a"), ("s2", None)], "snapshot string, v string"), by="snapshot")
    writers.write_snapshot_profiles(profiles, f"{out}/reports")
    main(["drift", "--reports", f"{out}/reports", "--before", "s1", "--after", "s2"])
    assert json.loads(capsys.readouterr().out)["change"] == "changed"
    rows = fact_source.scan_facts(spark, f"{out}/facts", CLOUD)
    landing.merge_facts(rows, f"{out}/facts", "all", CLOUD)
    main(["maintain", "--facts", f"{out}/facts", "--stem", "all", "--profile", "cloud", "--grace", "0"])
    assert fact_source.scan_facts(spark, f"{out}/facts", CLOUD, "all").count() == 2
