from __future__ import annotations

import os
import time

import pytest
from pyspark.sql import functions as F

from faultline import schemas, session
from faultline.__main__ import main
from faultline.config import CLOUD, LOCAL
from faultline.functions.lexicon import Lexicon
from faultline.operators import quality
from faultline.plans import analytics as A
from faultline.plans import jobs
from faultline.session import fresh_path, shared_dir
from faultline.sinks import writers
from faultline.sources import facts as fact_source
from faultline.sources import payloads, snapshots
from faultline.streaming import landing
from tests.helpers import COMPLAINT, RECALL, plan, write_array

LEXICON = Lexicon({"good": 1.9, "bad": -2.5})
RECORDS = [COMPLAINT, COMPLAINT, RECALL]


@pytest.fixture()
def folder(tmp_path):
    return str(tmp_path)


@pytest.fixture()
def raw(spark, tmp_path):
    path = write_array(tmp_path / "raw", "nhtsa_20260606_200341.json", RECORDS)
    return snapshots.read_snapshot(spark, str(path))


# ------------------------------------------------------------ snapshots


@pytest.mark.parametrize("layout", ["array", "indented"])
def test_layouts_read_the_same_records(spark, tmp_path, layout):
    path = write_array(tmp_path, "s.json", RECORDS)
    rows = snapshots.read_snapshot(spark, str(path), layout).collect()
    assert len(rows) == 3
    recall = next(r for r in rows if r["record_id"] == "recall_1")
    assert recall["body"] == RECALL["body"]
    assert (recall["injuries"], recall["units_affected"]) == (None, "12")
    assert rows[0]["crash_involved"] == "false" and rows[0]["source_weight"] == "1.0"


def test_indented_layout_splits_over_tasks(spark, tmp_path):
    records = [{**COMPLAINT, "record_id": f"complaint_{i}"} for i in range(2000)]
    path = write_array(tmp_path, "s.json", records)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        df = snapshots.read_snapshot(spark, str(path), "indented")
        assert df.rdd.getNumPartitions() > 3
        assert df.select("record_id").distinct().count() == df.count() == 2000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


@pytest.mark.parametrize("layout", ["array", "indented"])
def test_empty_and_single_record_arrays(spark, tmp_path, layout):
    empty = write_array(tmp_path, "e.json", [])
    single = write_array(tmp_path, "s.json", [COMPLAINT])
    assert snapshots.read_snapshot(spark, str(empty), layout).count() == 0
    assert snapshots.read_snapshot(spark, str(single), layout).count() == 1


@pytest.mark.parametrize("indent", [None, 4])
def test_other_formatting_is_refused_not_lost(spark, tmp_path, indent):
    path = write_array(tmp_path, "s.json", RECORDS, indent)
    with pytest.raises(Exception, match="indent of two"):
        snapshots.read_snapshot(spark, str(path), "indented").collect()
    assert snapshots.read_snapshot(spark, str(path), "array").count() == 3


def test_other_line_ends(spark, tmp_path):
    path = write_array(tmp_path, "s.json", RECORDS)
    path.write_bytes(path.read_bytes().replace(b"\n", b"\r\n"))
    with pytest.raises(Exception, match="line end"):
        snapshots.read_snapshot(spark, str(path), "indented").collect()
    df = snapshots.read_snapshot(spark, str(path), "indented", line_end="\r\n")
    assert [r["record_id"] for r in df.collect()] == ["complaint_1", "complaint_1", "recall_1"]


def test_corrupt_records_end_the_job_or_are_kept(spark, tmp_path):
    path = tmp_path / "s.json"
    path.write_text('{"record_id": "a"}\n{"record_id": \n', encoding="utf-8")
    with pytest.raises(Exception, match="(?i)malformed"):
        snapshots.read_snapshot(spark, str(path), "lines").collect()
    kept = snapshots.read_snapshot(spark, str(path), "lines", keep_corrupt=True).collect()
    assert [r["record_id"] for r in kept] == ["a", None]
    assert kept[1][schemas.CORRUPT] is not None


def test_unknown_layout(spark):
    with pytest.raises(ValueError):
        snapshots.read_snapshot(spark, "x", "xml")


def test_latest_snapshot_by_name_and_time(spark, tmp_path):
    old = time.time() - 1000
    first = write_array(tmp_path, "nhtsa_20260102_000000.json", [COMPLAINT])
    write_array(tmp_path, "nhtsa_20260101_000000.json", [RECALL])
    write_array(tmp_path / "below", "nhtsa_20290101_000000.json", [RECALL])
    (tmp_path / "notes.txt").write_text("x", encoding="utf-8")
    os.utime(first, (old, old))
    name = snapshots.latest_snapshot(spark, str(tmp_path)).name
    assert name == "nhtsa_20260102_000000.json"
    assert snapshots.latest_snapshot(spark, str(tmp_path), "mtime").name == (
        "nhtsa_20260101_000000.json"
    )
    with pytest.raises(FileNotFoundError):
        snapshots.latest_snapshot(spark, str(tmp_path / "none"))


def test_half_written_snapshot_is_not_the_latest(spark, tmp_path, raw):
    writers.write_snapshot(raw, str(tmp_path), "nhtsa_20260101_000000")
    broken = tmp_path / "nhtsa_20260102_000000.json"
    broken.mkdir()
    (broken / "part-0.json").write_text("{}", encoding="utf-8")
    with pytest.warns(UserWarning, match="nhtsa_20260102_000000.json"):
        assert snapshots.latest_snapshot(spark, str(tmp_path)).name == "nhtsa_20260101_000000.json"


def test_layouts_are_told_from_the_first_lines(spark, tmp_path):
    for indent, kind in ((2, "indented"), (None, "array"), (4, "array")):
        path = str(write_array(tmp_path, f"{indent}.json", RECORDS, indent))
        assert snapshots.detect_layout(spark, path)[0] == kind
        assert snapshots.read_snapshot(spark, path).count() == 3
    lines = tmp_path / "l.json"
    lines.write_text('{"record_id": "a"}\n{"record_id": "b"}\n', encoding="utf-8")
    empty = str(write_array(tmp_path, "e.json", []))
    both = snapshots.read_snapshot(spark, [str(lines), empty, str(tmp_path / "2.json")])
    assert snapshots.detect_layout(spark, str(lines))[0] == "lines" and both.count() == 5


def test_unreadable_payloads_are_counted(spark):
    rows = [("FORD", '{"results": []}'), ("FORD", "<html>"), ("FORD", None), ("TESLA", '{"results": [{}]}')]
    found = payloads.unreadable_payloads(spark.createDataFrame(rows, "make string, payload string"))
    assert sorted(map(tuple, found.collect())) == [("FORD", 3, 2), ("TESLA", 1, 0)]


def test_all_snapshots_with_names(spark, tmp_path):
    write_array(tmp_path, "nhtsa_1.json", [COMPLAINT])
    write_array(tmp_path, "nhtsa_2.json", [RECALL, RECALL])
    df, names = snapshots.read_all_snapshots(spark, str(tmp_path))
    assert df.count() == 3 and names == ["nhtsa_1.json", "nhtsa_2.json"]


def test_files_and_folders_are_read_together(spark, tmp_path, raw):
    write_array(tmp_path, "nhtsa_1.json", [COMPLAINT])
    writers.write_snapshot(raw, str(tmp_path), "nhtsa_2")
    df, names = snapshots.read_all_snapshots(spark, str(tmp_path))
    assert df.count() == 4 and names == ["nhtsa_1.json", "nhtsa_2.json"]


def test_snapshot_round_trip(spark, raw, folder):
    path = writers.write_snapshot(raw, folder, "nhtsa_1")
    again = snapshots.read_snapshot(spark, path, "lines")
    assert sorted(map(str, again.collect())) == sorted(map(str, raw.collect()))


def test_request_grid(spark):
    grid = snapshots.request_grid(spark)
    assert grid.count() == 154
    assert "Cartesian" not in plan(grid) and "NestedLoop" not in plan(grid)


def test_payload_defaults_apply_to_absent_keys_only(spark):
    full = '{"odiNumber":7,"crash":true,"numberOfDeaths":null}'
    payload = f'{{"results":[{full},{{"odiNumber":null}},{{}}]}}'
    df = spark.createDataFrame(
        [("Ford", "Escape", 2015, "2026-01-01T00:00:00Z", payload),
         ("Ford", "Escape", 2016, "2026-01-01T00:00:00Z", "no json"),
         ("Ford", "Escape", 2017, "2026-01-01T00:00:00Z", "{}")],
        "make string, model string, year int, fetched_at string, payload string",
    )
    rows = payloads.flatten_complaints(df).collect()
    assert [r["record_id"] for r in rows] == ["complaint_7", "complaint_None", "complaint_"]
    assert [r["deaths"] for r in rows] == [None, "0", "0"]
    assert [r["crash_involved"] for r in rows] == ["true", "false", "false"]
    assert {r["year"] for r in rows} == {"2015"}


# ------------------------------------------------------------ transform


def test_transform_local(spark, raw, folder):
    summary = jobs.run_transform(raw, folder, "s1", LOCAL, LEXICON)
    assert (summary.rows_read, summary.rows_written) == (3, 2)
    assert summary.makes == {"TOYOTA": 0, "FORD": 1, "TESLA": 1, "UNKNOWN": 0}
    assert summary.body_sentiment["critical"] == 1 and summary.body_sentiment["positive"] == 1
    facts = fact_source.scan_facts(spark, folder, LOCAL).orderBy("record_id").collect()
    assert [(r["make"], r["year"], r["model"]) for r in facts] == [
        ("FORD", 2015, "Escape"), ("TESLA", 2016, "N/A"),
    ]
    assert facts[0]["incident_date_missing"] is False and facts[1]["incident_date_missing"]
    assert facts[0]["units_affected"] == -1 and facts[1]["units_affected"] == 12
    assert facts[0]["consequence_sentiment_label"] == "N/A"
    # Every remedy is blank, so the column was dropped.
    written = spark.read.parquet(summary.path).columns
    assert "remedy" not in written and "remedy_sentiment_id" not in written
    dim = spark.read.parquet(f"{folder}/dim_make.parquet")
    assert dim.count() == 4 and spark.read.parquet(f"{folder}/dim_sentiment.parquet").count() == 5


def test_transform_cloud(spark, raw, folder):
    summary = jobs.run_transform(raw, folder, "s1", CLOUD)
    facts = fact_source.scan_facts(spark, folder, CLOUD).orderBy("record_id").collect()
    assert facts[1]["model"] == "Unknown"
    assert [str(r["event_date"]) for r in facts] == ["2020-01-15", "2020-01-15"]
    assert facts[0]["etl_timestamp"] == facts[1]["etl_timestamp"] is not None
    assert "body_sentiment_id" not in facts[0].asDict() and summary.body_sentiment == {}
    assert not os.path.exists(f"{folder}/dim_sentiment.parquet")


def test_transform_drops_the_columns_a_stored_profile_names(spark, raw, folder):
    report = jobs.run_validate(raw, folder, ["nhtsa_1.json"])
    stored = spark.read.parquet(f"{report}/field_profile")
    names = quality.null_fields(stored)
    assert names == ["remedy"]
    assert "remedy" not in jobs.transform(raw, LOCAL, LEXICON, names).columns


def test_transform_is_one_plan_with_one_shuffle_and_no_python(raw):
    text = plan(jobs.transform(raw, LOCAL, LEXICON, ["remedy"]))
    assert text.count("Exchange") == 1 and "Python" not in text


def test_transform_needs_a_lexicon_for_scores(raw):
    with pytest.raises(ValueError, match="lexicon"):
        jobs.transform(raw, LOCAL)


def test_running_twice_keeps_the_rows(spark, raw, folder):
    for _ in range(2):
        jobs.run_transform(raw, folder, "s1", CLOUD)
    assert fact_source.scan_facts(spark, folder, CLOUD).count() == 2


def test_refresh_removes_partitions_that_are_gone(spark, raw, folder):
    jobs.run_transform(raw, folder, "s1", CLOUD)
    jobs.run_transform(raw.where("source = 'nhtsa_recalls'"), folder, "s1", CLOUD)
    makes = fact_source.scan_facts(spark, folder, CLOUD).select("make").collect()
    assert [r["make"] for r in makes] == ["TESLA"]


def test_only_touched_partitions_are_replaced(spark, raw, folder):
    facts = jobs.transform(raw, CLOUD)
    writers.write_facts(facts, folder, "s1")
    changed = facts.where("make = 'FORD'").withColumn("body", F.lit("new"))
    path = writers.write_facts(changed, folder, "s1", only_touched=True)
    bodies = {r["make"]: r["body"] for r in spark.read.parquet(path).collect()}
    assert bodies["FORD"] == "new" and bodies["TESLA"].startswith("good")


def test_latest_or_all_fact_snapshots(spark, raw, folder):
    for stem in ("nhtsa_20260101_000000", "nhtsa_20260102_000000"):
        jobs.run_transform(raw, folder, stem, CLOUD)
    scan = fact_source.scan_facts
    assert scan(spark, folder, CLOUD).count() == 2
    assert scan(spark, folder, CLOUD, "all").count() == 4
    assert scan(spark, folder, CLOUD, "nhtsa_20260101_000000").count() == 2
    with pytest.raises(FileNotFoundError):
        scan(spark, folder, CLOUD, "nhtsa_20200101_000000")


def test_lookup_reads_one_partition(spark, raw, folder):
    jobs.run_transform(raw, folder, "s1", LOCAL, LEXICON)
    facts = fact_source.scan_facts(spark, folder, LOCAL)
    found = A.partition_point_lookup(facts, "FORD", 2015, "critical")
    assert [r["body"] for r in found.collect()] == ["bad brakes"]
    text = plan(found)
    filters = text[text.index("PartitionFilters"):].splitlines()[0]
    assert "make" in filters and "year" in filters
    assert "EqualTo(body_sentiment_label,critical)" in text


def test_text_predicates_on_partitions_prune_too(spark, raw, folder):
    jobs.run_transform(raw, folder, "s1", LOCAL, LEXICON)
    fact_source.register_view(fact_source.scan_facts(spark, folder, LOCAL), "facts")
    found = spark.sql("select * from facts where make = 'FORD' and year = '2015'")
    assert found.count() == 1
    assert "year" in plan(found).split("PartitionFilters")[1].splitlines()[0]


def test_hot_partition_is_written_by_several_tasks(spark, folder):
    rows = spark.range(0, 200_000, 1, 8).selectExpr(
        "'FORD' as make", "2015 as year", "sha2(cast(id as string), 256) as body"
    )
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        path = writers.write_facts(rows, folder, "hot")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    files = [f for f in os.listdir(f"{path}/make=FORD/year=2015") if f.endswith(".parquet")]
    assert len(files) > 3
    assert spark.read.parquet(path).count() == 200_000


def test_writing_without_adaptive_execution_salts(spark, folder):
    rows = spark.range(1000).selectExpr("'FORD' as make", "2015 as year", "id")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert "xxhash64" in plan(writers.spread(rows))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_catalog_table(spark, raw):
    writers.save_facts_table(jobs.transform(raw, CLOUD), "facts_nhtsa_test")
    table = fact_source.scan_table(spark, "facts_nhtsa_test")
    assert table.count() == 2
    assert A.brand_totals(table).count() == 2


# ------------------------------------------------------------ analysis and reports


def test_analysis_writes_every_result(spark, raw, folder):
    jobs.run_transform(raw, folder, "s1", LOCAL, LEXICON)
    facts = fact_source.scan_facts(spark, folder, LOCAL)
    written = jobs.run_analysis(facts, f"{folder}/analysis")
    assert [os.path.basename(path) for path in written] == [f"{n}.csv" for n in A.REPORTS]
    q1 = spark.read.option("header", True).csv(f"{folder}/analysis/q1_recall_complaint_ratio.csv")
    assert [tuple(r) for r in q1.collect()] == [
        ("FORD", "1", "0", "0.0", "0"), ("TESLA", "0", "1", None, "12"),
    ]


def test_cloud_analysis_leaves_its_placeholder_out(spark, raw, folder):
    jobs.run_transform(raw, folder, "s1", CLOUD)
    facts = fact_source.scan_facts(spark, folder, CLOUD)
    jobs.run_analysis(facts, f"{folder}/analysis", profile=CLOUD)
    for name in ("q3_model_recalls", "q6_model_totals", "q8_component_recall_gap"):
        rows = spark.read.option("header", True).csv(f"{folder}/analysis/{name}.csv").collect()
        assert not any("Unknown" in row for row in rows)
    assert set(A.report_questions(CLOUD)) > set(A.report_questions(LOCAL))


def test_results_that_are_no_tables_are_skipped(spark, folder):
    written = writers.write_results({"a": spark.range(2).toDF("n"), "b": None}, folder)
    assert [os.path.basename(path) for path in written] == ["a.csv"]


def test_report_names():
    assert writers.report_name(["nhtsa_1.json"]) == "val_nhtsa_1"
    assert writers.report_name(["a.json", "b.json"]).startswith("val_combined_")


def test_report_holds_every_profile(spark, raw, folder):
    path = jobs.run_validate(raw, folder, ["nhtsa_1.json"])

    def table(name):
        return spark.read.parquet(f"{path}/{name}")

    assert spark.read.text(f"{path}/field_profile_text").count() == len(schemas.RAW_FIELDS)
    direct = {
        "identity_check": quality.identity_check(raw),
        "date_completeness": quality.date_completeness(raw),
        "description_profile": quality.description_profile(raw),
        "numeric_anomalies": quality.numeric_anomalies(raw),
        "value_counts": quality.value_counts(raw, "source", "make"),
        "make_variants": quality.make_variants(raw),
        "make_variant_total": quality.make_variant_total(raw),
        "record_count_summary": quality.record_count_summary(raw),
    }
    for name, expected in direct.items():
        assert sorted(map(str, table(name).collect())) == sorted(map(str, expected.collect()))
    assert tuple(table("duplicate_rows").first()) == (3, 1)
    assert table("duplicate_samples").count() == 2
    # No text was unreadable as a number, so no sample of such texts is written.
    assert not os.path.exists(f"{path}/bad_numeric_values")


def test_report_samples_unreadable_numbers(spark, raw, folder):
    path = jobs.run_validate(raw.withColumn("deaths", F.lit("none")), folder, ["a", "b"])
    bad = spark.read.parquet(f"{path}/bad_numeric_values").collect()
    assert [tuple(r) for r in bad] == [("deaths", 1, "none")]


def test_checks_share_one_pass(raw):
    assert plan(quality.figures(raw)).count("FileScan") <= 1


def test_scratch_follows_the_session_setting(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert fresh_path(spark, "x") != fresh_path(spark, "x")


# ------------------------------------------------------------ incremental


def test_landing_merges_new_snapshots_once(spark, tmp_path, folder):
    landed, checkpoint = str(tmp_path / "raw"), str(tmp_path / "checkpoint")

    def run():
        stream = landing.stream_snapshots(spark, landed, "array", files_per_batch=1)
        landing.start_landing(stream, folder, "all", CLOUD, checkpoint).awaitTermination()
        rows = fact_source.scan_facts(spark, folder, CLOUD, "all").collect()
        return {(r["record_id"], r["year"]): r["body"] for r in rows}, len(rows)

    write_array(landed, "nhtsa_1.json", RECORDS)
    assert run()[1] == 2
    later = {**COMPLAINT, "body": "newer", "scraped_at": "2026-07-01T00:00:00+00:00"}
    stale = {**RECALL, "body": "older", "scraped_at": "2020-07-01T00:00:00+00:00"}
    write_array(landed, "nhtsa_2.json", [later, stale, {**COMPLAINT, "year": 2019}])
    rows, count = run()
    assert count == 3
    assert rows[("complaint_1", 2015)] == "newer"
    assert rows[("recall_1", 2016)].startswith("good")
    assert run()[1] == 3


def test_merge_reads_and_writes_only_touched_partitions(spark, raw, folder):
    facts = jobs.standardise(raw, CLOUD)
    landing.merge_facts(facts, folder, "all", CLOUD)
    path = landing.merge_facts(facts.where("make = 'FORD'"), folder, "all", CLOUD)
    assert sorted(os.listdir(f"{path}/version=1")) == ["._SUCCESS.crc", "_SUCCESS", "make=FORD", "make=TESLA"]
    assert [n for n in os.listdir(f"{path}/version=2") if n.startswith("make")] == ["make=FORD"]
    assert fact_source.scan_facts(spark, folder, CLOUD).count() == 2


@pytest.mark.parametrize("marked", ["true", "false"])
def test_merge_never_drops_other_partitions(spark, raw, folder, marked):
    settings = spark._jsc.hadoopConfiguration()
    settings.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", marked)
    try:
        facts = jobs.standardise(raw, CLOUD)
        writers.write_facts(facts.where("make = 'FORD'"), folder, "all")
        landing.merge_facts(facts.where("make = 'TESLA'"), folder, "all", CLOUD)
        makes = {r["make"] for r in fact_source.scan_facts(spark, folder, CLOUD).collect()}
    finally:
        settings.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")
    assert makes == {"FORD", "TESLA"}


def test_a_merge_lost_before_its_manifest_changes_nothing(spark, raw, folder, monkeypatch):
    facts = jobs.standardise(raw, CLOUD)
    path = landing.merge_facts(facts, folder, "all", CLOUD)
    changed = facts.where("make = 'FORD'").withColumns({"body": F.lit("new"), "scraped_at": F.lit("2030-01-01").cast("timestamp")})

    def lost(*_args):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as broken:
        broken.setattr(landing.facts, "read_manifest", lost)
        with pytest.raises(RuntimeError):
            landing.merge_facts(changed, folder, "all", CLOUD)
    # half a version, as a lost writer leaves it
    os.makedirs(f"{path}/version=2/_temporary")
    before = {r["make"]: r["body"] for r in fact_source.scan_facts(spark, folder, CLOUD).collect()}
    assert before["FORD"] == "bad brakes" and len(before) == 2
    landing.merge_facts(changed, folder, "all", CLOUD)
    after = {r["make"]: r["body"] for r in fact_source.scan_facts(spark, folder, CLOUD).collect()}
    assert after["FORD"] == "new" and after["TESLA"] == before["TESLA"]


def test_merging_the_same_rows_twice_changes_nothing(spark, raw, folder):
    facts = jobs.standardise(raw, CLOUD)
    for _ in range(2):
        landing.merge_facts(facts, folder, "all", CLOUD)
    assert fact_source.scan_facts(spark, folder, CLOUD, "all").count() == 2


# ------------------------------------------------------------ command line and session


def test_command_line_runs_the_whole_chain(spark, tmp_path, capsys):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    write_array(raw, "nhtsa_20260606_200341.json", RECORDS)
    words = tmp_path / "words.tsv"
    words.write_text("good\t1.9\t0.9\t[2, 1]\nbad\t-2.5\t0.6\t[-3]\n:\"(\t-1.0\t0\t[]\n")
    main(["validate", "--raw", raw, "--out", f"{out}/reports", "--layout", "indented"])
    report = capsys.readouterr().out.strip().splitlines()[-1]
    assert report.endswith("val_nhtsa_20260606_200341")
    main(["transform", "--raw", raw, "--out", f"{out}/facts", "--lexicon", str(words),
          "--report", report, "--infer-dates"])
    assert "rows_written=2" in capsys.readouterr().out
    main(["analyse", "--facts", f"{out}/facts", "--out", f"{out}/analysis"])
    assert len(capsys.readouterr().out.strip().splitlines()) == len(A.REPORTS)
    main(["lookup", "--facts", f"{out}/facts", "--make", "FORD", "--year", "2015",
          "--label", "critical"])
    assert "bad brakes" in capsys.readouterr().out


def test_shuffles_grow_with_the_input(spark, tmp_path):
    assert session.shuffle_partitions(10) == 1
    assert session.shuffle_partitions(2**40) == 4096
    assert session.scan_bytes(2**40) == session.BYTES_PER_SCAN_TASK
    assert session.scan_bytes(10**14) == 10**9
    assert session.shuffle_partitions(10**18) == session.MAX_SHUFFLE_PARTITIONS
    (tmp_path / "f").write_bytes(b"x" * 1000)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    session.prepare(spark, str(tmp_path))
    assert session.input_bytes(spark, str(tmp_path)) == 1000
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
