"""Registered queries about loading: quarantine, provenance, reports, merges, streams, catalog."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline import schemas
from faultline.config import CLOUD, Profile
from faultline.operators import dims, makes, quality
from faultline.plans import bindings as B
from faultline.plans import jobs
from faultline.plans import registry as R
from faultline.plans.registry import query
from faultline.session import fresh_path
from faultline.sinks import versions, writers
from faultline.sources import facts as fact_source
from faultline.sources import snapshots
from faultline.streaming import landing

_TEST_CLOUD = Profile(**{**vars(CLOUD), "make_keywords": B.FACT_KEYWORDS})

# ---------------------------------------------------------------- quarantine and provenance

#: Every seventh event is cut short, every eleventh a list, every thirteenth blank.
_LINE = """case when event_id%7=0 then substring(concat('{"record_id":"',cast(event_id as string)),1,8+event_id%3)
    when event_id%11=0 then concat('[',cast(event_id as string),']')
    when event_id%13=0 then concat('  ',chr(9))
    else concat('{"record_id":"',cast(event_id as string),'","component":"',event_type,'"}') end"""


def _lines(spark: SparkSession, folder: str, stems: dict[str, str], line: str) -> str:
    """Snapshots of lines, one for each condition on the events."""
    base = fresh_path(spark, "snapshots")
    events = B.table(spark, folder, "events")
    for stem, rows in stems.items():
        events.where(rows).selectExpr(f"{line} as value").write.text(f"{base}/{stem}.json")
    return base


_HALVES = {"nhtsa_20240101_000000": "dayofmonth(ts)<=15", "nhtsa_20240116_000000": "dayofmonth(ts)>15"}
_STEM = "case when day(ts)<=15 then 'nhtsa_20240101_000000' else 'nhtsa_20240116_000000' end"


@query(
    "quarantined_records",
    f"""select snapshot, reason, count(*) as records from (select {_STEM} as snapshot,
      case when event_id%7=0 then 'not JSON' when event_id%11=0 then 'no object'
        when event_id%13=0 then 'blank' else 'good' end as reason from events)
    where reason<>'blank' group by snapshot, reason""",
)
def _(spark, folder):
    """Good records and unreadable ones by reason; blank lines are no records to Spark."""
    base = _lines(spark, folder, _HALVES, _LINE)
    read = snapshots.read_entries(spark, snapshots.list_snapshots(spark, base), "lines", keep_corrupt=True, provenance=True)
    good, bad = snapshots.split_corrupt(spark, read)
    both = good.select("source_file", F.lit("good").alias("reason")).unionByName(bad.select("source_file", "reason"))
    return both.groupBy(snapshots.snapshot_of().alias("snapshot"), "reason").agg(F.count("*").alias("records"))


@query(
    "fact_provenance",
    f"""select snapshot, event_type as component, count(*) as facts
    from (select {_STEM} as snapshot, event_type from events) group by snapshot, event_type""",
)
def _(spark, folder):
    """Facts by the snapshot they were read from, after the whole transform and a write."""
    line = """concat('{"record_id":"',cast(event_id as string),'","component":"',event_type,'","body":"n","year":"2024","make":"ford"}')"""
    raw, _ = snapshots.read_all_snapshots(spark, _lines(spark, folder, _HALVES, line), "lines", provenance=True)
    base = fresh_path(spark, "facts")
    jobs.run_transform(raw, base, "run", _TEST_CLOUD, empty_columns=())
    rows = fact_source.scan_facts(spark, base, _TEST_CLOUD, provenance=True)
    # a name is taken apart once a file, not once a row
    files = rows.groupBy("source_file", "component").agg(F.count("*").alias("n"))
    return files.groupBy(snapshots.snapshot_of().alias("snapshot"), "component").agg(F.sum("n").alias("facts"))


# ---------------------------------------------------------------- reports

_EVENT_LINE = """concat('{"record_id":"',cast(event_id as string),'"',
    case when event_id%3=0 then '' else concat(',"component":"',event_type,'"') end,
    ',"model":"',case when event_id%5=0 then ' ' else cast(user_id as string) end,'"}')"""
_PROFILED = ["record_id", "component", "model"]


def _side_sql(name: str, inside: str) -> str:
    values = {
        "record_id": "cast(event_id as varchar)",
        "component": "case when event_id%3<>0 then event_type end",
        "model": "case when event_id%5=0 then ' ' else cast(user_id as varchar) end",
    }
    rows = " union all ".join(
        f"""select '{field}' as field, count(*) as total, count(*) filter (where {v} is null or trim({v})='') as missing,
        count(*)-(select count(*) from (select distinct {v} from events where {inside})) as duplicates from events where {inside}"""
        for field, v in values.items()
    )
    return f"{name} as (select *, round_even(missing/total*100,1) as p, round_even(duplicates/total*100,1) as q from ({rows}))"


@query(
    "profile_drift",
    f"""with {_side_sql("a", "day(ts)<=15")}, {_side_sql("b", "day(ts)>15")}
    select field, case when a.total=b.total and a.missing=b.missing and a.duplicates=b.duplicates then 'same' else 'changed' end as change,
      a.total as total_before, b.total as total_after, a.missing as missing_before, b.missing as missing_after,
      a.duplicates as duplicates_before, b.duplicates as duplicates_after,
      round_even(b.p-a.p,1) as missing_points, round_even(b.q-a.q,1) as repeated_points from a join b using (field)""",
)
def _(spark, folder):
    """What changed from one snapshot to the next, from the report table that has a partition for each."""
    raw, _ = snapshots.read_all_snapshots(spark, _lines(spark, folder, _HALVES, _EVENT_LINE), "lines", provenance=True)
    rows = raw.select(snapshots.snapshot_of().alias("snapshot"), *_PROFILED)
    path = writers.write_snapshot_profiles(quality.field_profile(rows, by="snapshot"), fresh_path(spark, "reports"))
    table = spark.read.parquet(path)
    before, after = (table.where(F.col("snapshot") == stem) for stem in _HALVES)
    return quality.profile_drift(before, after)


@query(
    "distinct_by_sketches",
    """select 'user_id' as field, count(distinct user_id) as distinct_values, true as close from events
    union all select 'event_type', count(distinct event_type), true from events
    union all select 'event_id', count(distinct event_id), true from events""",
)
def _(spark, folder):
    """Distinct values over all days, united from one sketch a day, against an exact count.

    `close` is within 2.5 %, three standard errors of the sketches.
    """
    fields = ["user_id", "event_type", "event_id"]
    events = B.table(spark, folder, "events").select(F.to_date("ts").alias("day"), *fields)
    sketches = writers.write_profile(quality.distinct_sketches(events, "day"), fresh_path(spark, "sketches"), "days")
    exact = events.agg(*[F.count_distinct(n).alias(n) for n in fields]).unpivot([], fields, "field", "exact")
    joined = exact.join(quality.distinct_estimates(sketches).withColumnRenamed("field", "of"), F.col("field") == F.col("of"))
    close = F.abs(F.col("distinct_values") - F.col("exact")) <= 0.025 * F.col("exact")
    return joined.select("field", F.col("exact").alias("distinct_values"), close.alias("close"))


#: Tables of a report as rows (report, item, figure, value).
_REPORTS = {
    "field_profile": ["field"], "identity_check": [], "date_completeness": ["field", "expected_in"],
    "description_profile": ["field", "expected_in"], "numeric_anomalies": ["field"], "value_counts": ["field", "value"],
    "make_variants": ["make"], "make_variant_total": [], "record_count_summary": ["source", "make"], "duplicate_rows": [],
    "bad_numeric_values": ["field", "value"],
}


def _named(keys: list[str]) -> str:
    texts = [f"coalesce(cast({key} as string),'-')" for key in keys]
    return "concat(" + ",'/',".join(["''", *texts]) + ")"


def _report_sql() -> str:
    """Every table of the report as SQL over the raw records, figure by figure."""
    fields = list(schemas.RAW_FIELDS)

    def completeness(expected_in: dict[str, str], extra: str, extras: str) -> str:
        return " union all ".join(
            R._completeness_sql(field, "true" if source == "all" else f"source='{source}'", source, extra.replace("FIELD", field), extras).replace("from r)", "from raw)")
            for field, source in expected_in.items()
        )

    dates = completeness(quality.DATE_EXPECTED_IN, "min(FIELD) filter (where {0}) as sample", "sample")
    prose = completeness(
        quality.PROSE_EXPECTED_IN,
        """cast(round_even(avg(length(FIELD)) filter (where {0}),0) as bigint) as avg_length,
        min(length(FIELD)) filter (where {0}) as min_length, max(length(FIELD)) filter (where {0}) as max_length,
        min(substring(FIELD,1,120)) filter (where {0}) as sample""",
        "avg_length, min_length, max_length, sample",
    )
    numbers = " union all ".join(
        f"""select '{name}' as field, count(*) filter (where {name} is null) as nulls,
          count(*) filter (where {name} is not null and try_cast({name} as double) is null) as type_errors,
          count(*) filter (where try_cast({name} as double)<{low}) as negatives,
          count(*) filter (where try_cast({name} as double)>{high}) as outliers from raw"""
        for name, (low, high) in quality.NUMERIC_BOUNDS.items()
    )
    bad = " union ".join(
        f"select '{name}' as field, {name} as value from raw where {name} is not null and try_cast({name} as double) is null"
        for name in quality.NUMERIC_BOUNDS
    )
    tables = {
        "field_profile": R._profile_sql("", "raw", fields),
        "identity_check": "select count(*) filter (where record_id is null) as null_ids, count(*) filter (where record_id in ('complaint_','recall_')) as empty_ids from raw",
        "date_completeness": dates,
        "description_profile": prose,
        "numeric_anomalies": numbers,
        "value_counts": " union all ".join(
            f"select '{f}' as field, {f} as value, count(*) as record_count from raw where {f} is not null group by {f}" for f in ("source", "make")
        ),
        "make_variants": "select make, count(*) as record_count from raw group by make",
        "make_variant_total": "select count(distinct make) as variants from raw",
        "record_count_summary": "select source, make, count(*) as record_count from raw where source is not null and make is not null group by source, make",
        "duplicate_rows": "select count(*) as total_rows, count(*)-(select count(*) from (select distinct * from raw)) as duplicate_rows from raw",
        "bad_numeric_values": f"select field, value, place from (select *, row_number() over (partition by field order by value) as place from ({bad})) where place<=5",
    }
    out = []
    for name, sql in tables.items():
        keys = _REPORTS[name]
        out.append(
            f"""select '{name}' as report, item, figure, value from (
            unpivot (select {_named(keys).replace("as string", "as varchar")} as item, cast(columns(* exclude ({', '.join(keys) or 'item'})) as varchar)
              from (select *, 0 as item from ({sql}))) on * exclude (item) into name figure value value) where figure<>'item'"""
            if not keys
            else f"""select '{name}' as report, item, figure, value from (
            unpivot (select {_named(keys).replace("as string", "as varchar")} as item, cast(columns(* exclude ({', '.join(keys)})) as varchar)
              from ({sql})) on * exclude (item) into name figure value value)"""
        )
    return f"with raw as materialized ({B.raw_sql()}) " + " union all ".join(out)


@query("validation_report", _report_sql())
def _(spark, folder):
    """All figures of all tables of the report, as the job writes them; samples of rows are left out."""
    path = jobs.run_validate(B.raw(spark, folder), fresh_path(spark, "report"), ["nhtsa_1.json"])
    found = None
    for name, keys in _REPORTS.items():
        table = spark.read.parquet(f"{path}/{name}")
        figures = [n for n in table.columns if n not in keys]
        texts = table.select(F.expr(_named(keys)).alias("item"), *[F.col(n).cast("string").alias(n) for n in figures])
        rows = texts.unpivot("item", figures, "figure", "value").where("value is not null")
        rows = rows.select(F.lit(name).alias("report"), "item", "figure", "value")
        found = rows if found is None else found.unionByName(rows)
    return found


_AWKWARD = """case doc_id%8 when 0 then concat('"',text,'"') when 1 then concat(' ',text,'\\\\') when 2 then concat(text,chr(13),chr(10),', "x"')
    when 3 then '' when 4 then null when 5 then concat(chr(9),text,chr(10)) when 6 then concat('a\\\\"',text,'""') else text end"""


@query("csv_awkward_texts", f"select doc_id, {_AWKWARD.replace(chr(92) * 2, chr(92))} as text from documents")
def _(spark, folder):
    """Texts with quotes, separators, backslashes, line ends and blanks, through a CSV result and back."""
    rows = B.table(spark, folder, "documents").selectExpr("doc_id", f"{_AWKWARD} as text")
    (path,) = writers.write_results({"texts": rows}, fresh_path(spark, "results"))
    return writers.read_results(spark, path, rows.schema)


# ---------------------------------------------------------------- jobs


@query(
    "run_summary",
    R._CURATED_SQL
    + """select figure, value from (
      select 'rows_read' as figure, count(*) as value from raw
      union all select 'rows_written', count(*) from scored
      union all select 'columns', 28 union all
      select concat('make:',m), count(*) filter (where make=m) from scored, (values ('BOLT'),('RING'),('WIDGET'),('UNKNOWN')) v(m) group by m
      union all select concat('body_sentiment:',l), count(*) filter (where body_sentiment_label=l)
        from scored, (values ('positive'),('neutral'),('negative'),('critical'),('N/A')) v(l) group by l)""",
)
def _(spark, folder):
    """Figures of the transform, as they come out of its own write."""
    summary = jobs.run_transform(B.raw(spark, folder), fresh_path(spark, "facts"), "run", R._TEST_PROFILE, B.LEXICON)
    return spark.createDataFrame(list(summary.figures().items()), "figure string, value long")


_EVENT = f"case when source='nhtsa_complaints' then coalesce({R._PARSED.format('incident_date')}, date '9999-12-31') else coalesce(try_cast(recall_date as date), date '9999-12-31') end"


@query(
    "curated_facts_cloud",
    f"""with raw as ({B.raw_sql()}), d as (select distinct * from raw)
    select record_id, source, trim(make) as make_raw, cast({R._MAKE_ID_CASE.format(R._MAKE_TEXT)} as bigint) as make_id,
      {R._nullish("model").replace("'N/A'", "'Unknown'")} as model, {R._nullish("component").replace("'N/A'", "'Unknown'")} as component,
      {R._nullish("body")} as body, {R._nullish("consequence")} as consequence,
      cast(coalesce({R._PARSED.format("incident_date")}, date '9999-12-31') as varchar) as incident_date,
      {R._PARSED.format("incident_date")} is null as incident_date_missing,
      cast(coalesce(try_cast(recall_date as date), date '9999-12-31') as varchar) as recall_date, recall_date is null as recall_date_missing,
      {R._true("crash_involved")} as crash_involved, {R._true("fire_involved")} as fire_involved,
      {R._whole("injuries")} as injuries, {R._whole("deaths")} as deaths, {R._whole("units_affected")} as units_affected,
      cast({_EVENT} as varchar) as event_date, {_EVENT}>=date '9999-12-31' as event_date_missing, true as loaded,
      {R._MAKE_CASE.format(R._MAKE_TEXT)} as make, {R._whole("year")} as year from d""",
)
def _(spark, folder):
    """The transform's other dialect, written and read back: event dates, its placeholder, a load time."""
    base = fresh_path(spark, "facts")
    jobs.run_transform(B.raw(spark, folder), base, "run", _TEST_CLOUD)
    rows = fact_source.scan_facts(spark, base, _TEST_CLOUD)
    texts = {name: F.col(name).cast("string") for name in ("incident_date", "recall_date", "event_date")}
    rows = rows.withColumns({**texts, "loaded": F.col("etl_timestamp").isNotNull()})
    return rows.drop("remedy", "source_weight", "scraped_at", "week_added", "etl_timestamp")


@query("written_dims", R.ORACLES["dim_make"])
def _(spark, folder):
    """The make dimension as its file has it, with the records that use it."""
    base = fresh_path(spark, "dims")
    writers.write_dims(spark, base)
    dim = spark.read.schema(schemas.DIM_MAKE).parquet(f"{base}/dim_make.parquet")
    return dims.dim_usage(makes.normalise_make(R._parts(spark, folder), B.FACT_KEYWORDS), dim, "make_id")


@query(
    "touched_partitions",
    R.FACTS + "select make, year, record_id, case when make='BOLT' then injuries+100 else injuries end as injuries from f",
)
def _(spark, folder):
    """A second write of some partitions leaves all others as they were."""
    base, rows = fresh_path(spark, "facts"), B.facts(spark, folder).select("make", "year", "record_id", "injuries")
    writers.write_facts(rows, base, "run")
    changed = rows.where("make='BOLT'").withColumn("injuries", F.col("injuries") + 100)
    return spark.read.parquet(writers.write_facts(changed, base, "run", only_touched=True))


# ---------------------------------------------------------------- merges

_THIRDS = [("year < 1994", "2024-01-01"), ("year >= 1993 and year < 1996", "2024-02-01"), ("year >= 1995", "2024-03-01")]


def _load(rows: DataFrame, where: str, day: str) -> DataFrame:
    kept = rows.where(where).withColumn("scraped_at", F.lit(day).cast("timestamp"))
    return kept.withColumn("injuries", F.col("injuries") + F.month("scraped_at")).withColumn("year", F.col("year").cast("bigint"))


_MERGED = (
    R.FACTS
    + ", loads as ("
    + " union all ".join(f"select *, injuries + {k} as n, {k} as load from f where {where}" for k, (where, _) in enumerate(_THIRDS, 1))
    + """), ranked as (select *, row_number() over (partition by record_id, make, model, year
      order by load desc, component, crash_involved, n, source, units_affected) as place from loads)
    select record_id, make, model, cast(year as bigint) as year, component, n as injuries, source from ranked where place = 1"""
)


@query("concurrent_merges", _MERGED)
def _(spark, folder):
    """Three merges at the same time, of partitions that overlap; none is lost."""
    base, rows = fresh_path(spark, "facts"), B.facts(spark, folder)
    with ThreadPoolExecutor(3) as pool:
        list(pool.map(lambda load: landing.merge_facts(_load(rows, *load), base, "all", CLOUD), _THIRDS))
    merged = fact_source.scan_facts(spark, base, CLOUD)
    return merged.select("record_id", "make", "model", "year", "component", "injuries", "source")


@query("compacted_facts", _MERGED)
def _(spark, folder):
    """Merges, then their versions written together and all that nothing names removed."""
    base, rows = fresh_path(spark, "facts"), B.facts(spark, folder)
    for load in _THIRDS:
        landing.merge_facts(_load(rows, *load), base, "all", CLOUD)
    versions.compact_facts(spark, base, "all", CLOUD, most=1)
    versions.vacuum_facts(spark, base, "all", keep=1, grace=0)
    merged = fact_source.scan_facts(spark, base, CLOUD)
    return merged.select("record_id", "make", "model", "year", "component", "injuries", "source")


# ---------------------------------------------------------------- streams

#: Three landings by day of month; the later ones repeat events, and the last one brings very late ones.
_LANDED = """explode(filter(array(
    named_struct('landing', case when dayofmonth(ts)<=10 then 1 when dayofmonth(ts)<=20 then 2 else 3 end, 'id', event_id),
    case when dayofmonth(ts) between 8 and 10 then named_struct('landing', 2, 'id', event_id) end,
    case when dayofmonth(ts) between 18 and 20 then named_struct('landing', 3, 'id', event_id) end,
    case when dayofmonth(ts)<=3 then named_struct('landing', 3, 'id', -1-event_id) end), x -> x is not null))"""


def _landings(spark: SparkSession, folder: str) -> str:
    base = fresh_path(spark, "landings")
    rows = B.table(spark, folder, "events").selectExpr("event_type", "ts", f"{_LANDED} as x").selectExpr(
        "x.landing", "cast(x.id as string) as record_id", "event_type as component",
        "'ford' as make", "'m' as model", "'2024' as year", "cast(timestamp '2024-01-01' + make_dt_interval(dayofmonth(ts), hour(ts)) as string) as scraped_at",
    )
    landed = writers.write_profile(rows, fresh_path(spark, "landed"), "rows")
    for n in (1, 2, 3):  # one file a landing, in the order of its number
        part = landed.where(F.col("landing") == n).drop("landing").coalesce(1)
        part.write.mode("append").json(f"{base}/nhtsa_{n}.json")
    return base


@query("streamed_first_of_each", "select cast(event_id as varchar) as record_id, event_type as component from events")
def _(spark, folder):
    """Landed files as a stream, one a batch: repeats within five days go, and what is older than the watermark goes as late."""
    stream = landing.stream_snapshots(spark, _landings(spark, folder) + "/*", files_per_batch=1)
    kept = landing.first_of_each(stream, within="5 days").select("record_id", "component")
    out = fresh_path(spark, "streamed")
    options = {"checkpointLocation": fresh_path(spark, "stream-checkpoint"), "path": out}
    kept.writeStream.format("parquet").options(**options).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("record_id string, component string").parquet(out)


@query(
    "streamed_run_summary",
    f"""with e as (select *, {_STEM} as snapshot, event_id%7<>0 as good from events)
    select figure, cast(sum(value) as bigint) as value, cast(count(*) as bigint) as batches from (
      select snapshot, 'rows_read' as figure, count(*) as value from e group by snapshot
      union all select snapshot, 'unreadable', count(*) filter (where not good) from e group by snapshot
      union all select snapshot, 'rows', count(*) filter (where good) from e group by snapshot
      union all select snapshot, concat('make:',m), count(*) filter (where good and (case when event_type='click' then 'BOLT' else 'UNKNOWN' end)=m)
        from e, (values ('BOLT'),('RING'),('WIDGET'),('UNKNOWN')) v(m) group by snapshot, m) group by figure""",
)
def _(spark, folder):
    """Figures of each batch of a stream that merges facts, observed while the batch is written."""
    line = """case when event_id%7=0 then '{"record_id"' else concat('{"record_id":"',cast(event_id as string),'","year":"2024","model":"m","make":"',
        case when event_type='click' then 'bolt' else 'nut' end,'"}') end"""
    base = fresh_path(spark, "landings")
    for stem, rows in _HALVES.items():
        events = B.table(spark, folder, "events").where(rows).selectExpr(f"{line} as value")
        events.coalesce(1).write.text(f"{base}/{stem}.json")
    stream = landing.stream_snapshots(spark, base, files_per_batch=1, keep_corrupt=True)
    summary = fresh_path(spark, "summary")
    landing.start_landing(stream, fresh_path(spark, "facts"), "all", _TEST_CLOUD, fresh_path(spark, "checkpoint"), summary=summary).awaitTermination()
    table = spark.read.schema(landing.SUMMARY).parquet(summary)
    return table.groupBy("figure").agg(F.sum("value").alias("value"), F.count("*").alias("batches"))


# ---------------------------------------------------------------- catalog


@query(
    "latest_snapshot_table",
    f"""select '{list(_HALVES)[-1]}' as snapshot, event_type as component, count(*) as record_count from events
    where day(ts)>15 group by event_type""",
)
def _(spark, folder):
    """One catalog table per snapshot, a view on the latest of those that the catalog lists."""
    base = _lines(spark, folder, _HALVES, _EVENT_LINE.replace("case when event_id%3=0 then '' else ", "").replace(" end,\n    ',\"model\"", ",\n    ',\"model\""))
    database = f"snapshots_{uuid4().hex}"
    spark.sql(f"create database {database}")
    try:
        for entry in snapshots.list_snapshots(spark, base):
            raw = snapshots.read_entries(spark, [entry], "lines")
            writers.save_snapshot_table(raw, database, entry.name.removesuffix(".json"))
        latest = writers.latest_snapshot_view(spark, database)
        counts = spark.table(f"{database}.latest").groupBy("component").agg(F.count("*").alias("record_count"))
        return writers.write_profile(counts.select(F.lit(latest).alias("snapshot"), "*"), fresh_path(spark, "latest"), "counts")
    finally:
        spark.sql(f"drop database {database} cascade")
