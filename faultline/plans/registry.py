"""Every registered query with the SQL it is compared against."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline import schemas
from faultline.config import CLOUD, COMPLAINTS, LOCAL, RECALLS, Profile
from faultline.functions import columns as C
from faultline.functions.columns import WHITESPACE
from faultline.functions.lexicon import MICRO, Lexicon, LexiconTable, to_micro, tokens
from faultline.operators import clean, dedupe, dims, makes, quality, sentiment
from faultline.plans import analytics as A
from faultline.plans import bindings as B
from faultline.plans import jobs
from faultline.session import fresh_path, prepare
from faultline.sinks import writers
from faultline.sources import facts as fact_source
from faultline.sources import listing, payloads, snapshots
from faultline.streaming import landing

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

FACTS = f"with f as ({B.facts_sql()}) "
CLOUD_FACTS = f"with f as ({B.facts_sql('Unknown')}) "
DIRTY = f"with d as ({B.dirty_sql()}) "

_BLANKS = "concat(" + ",".join(f"chr({ord(c)})" for c in WHITESPACE) + ")"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        def prepared(spark: SparkSession, folder: str) -> DataFrame:
            return run(prepare(spark, folder), folder)

        QUERIES[name] = prepared
        if sql is not None:
            ORACLES[name] = sql
        return prepared

    return register


def _pct(part: str, whole: str) -> str:
    return f"round({part}*100.0e0/nullif({whole},0),2)"


_CRASHES = "cast(sum(case when crash_involved then 1 else 0 end) as bigint)"
_N_COMPLAINTS = "count(*) filter (where source='nhtsa_complaints')"
_N_RECALLS = "count(*) filter (where source='nhtsa_recalls')"


# ---------------------------------------------------------------- analytic questions


@query(
    "recall_complaint_ratio",
    FACTS
    + f"""select make, {_N_COMPLAINTS} as complaint_count, {_N_RECALLS} as recall_count,
    {_pct(_N_RECALLS, _N_COMPLAINTS)} as recall_to_complaint_pct,
    cast(sum(case when source='nhtsa_recalls' then units_affected else 0 end) as bigint)
      as total_units_affected
    from f where make!='UNKNOWN' group by make""",
)
def _(spark, folder):
    return A.recall_complaint_ratio(B.facts(spark, folder))


@query(
    "component_crash_rate",
    FACTS
    + f"""select component, count(*) as complaint_count, {_CRASHES} as crash_count,
    {_pct(_CRASHES, "count(*)")} as crash_rate_pct
    from f where source='nhtsa_complaints' and component!='N/A' and make!='UNKNOWN'
    group by component having count(*)>=10
    order by crash_rate_pct desc, complaint_count desc, component limit 20""",
)
def _(spark, folder):
    return A.component_crash_rate(B.facts(spark, folder))


@query(
    "component_brand_crash_rate",
    FACTS
    + f"""select make, component, count(*) as complaint_count, {_CRASHES} as crash_count,
    {_pct(_CRASHES, "count(*)")} as crash_rate_pct
    from f where source='nhtsa_complaints' and component!='N/A' and make!='UNKNOWN'
    group by make, component having count(*)>=5""",
)
def _(spark, folder):
    return A.component_brand_crash_rate(B.facts(spark, folder))


@query(
    "weighted_brand_risk",
    FACTS
    + """, g as (
      select make, component, count(*) as n, count(*) filter (where crash_involved) as crashes
      from f where source='nhtsa_complaints' and component<>'N/A' group by all),
    w as (
      select make, n, sum(n) over everywhere as total,
        sum(crashes) over everywhere * 1.0e0 / sum(n) over everywhere as rate
      from g window everywhere as (partition by component))
    select make, round(100 * sum(n * rate) / sum(n), 2) as weighted_crash_risk_pct
    from w where total >= 10 and make <> 'UNKNOWN' group by make""",
)
def _(spark, folder):
    return A.weighted_brand_risk(B.facts(spark, folder))


@query(
    "model_complaints",
    FACTS
    + f"""select make, model, count(*) as complaint_count, {_CRASHES} as crash_count,
    {_pct(_CRASHES, "count(*)")} as crash_rate_pct
    from f where source='nhtsa_complaints' and model!='N/A' and make!='UNKNOWN'
    group by make, model""",
)
def _(spark, folder):
    return A.model_complaints(B.facts(spark, folder))


@query(
    "model_recalls",
    FACTS
    + """select make, model, count(*) as recall_count,
    cast(sum(units_affected) as bigint) as total_units_affected,
    avg(units_affected) as avg_units_per_recall
    from f where source='nhtsa_recalls' and model!='N/A' and make!='UNKNOWN'
    group by make, model""",
)
def _(spark, folder):
    return A.model_recalls(B.facts(spark, folder))


def _scorecard_sql(ctes: str, placeholder: str) -> str:
    return (
        ctes
        + f""", cards as (
      select make, model, {_N_COMPLAINTS} as complaint_count, {_N_RECALLS} as recall_count,
        cast(coalesce(sum(units_affected) filter (where source='nhtsa_recalls'), 0) as bigint) as units_affected
      from f where make<>'UNKNOWN' and model<>'{placeholder}' group by all)
    select *, {_pct("recall_count", "complaint_count")} as recall_to_complaint_pct
    from cards where complaint_count > 0"""
    )


@query(
    "model_recalls_no_sentinels",
    FACTS
    + """select make, model, count(*) as recall_count,
    cast(sum(nullif(units_affected, -1)) as bigint) as total_units_affected,
    avg(nullif(units_affected, -1)) as avg_units_per_recall
    from f where source='nhtsa_recalls' and model<>'N/A' and make<>'UNKNOWN' group by all""",
)
def _(spark, folder):
    return A.model_recalls(A.roll_up(B.facts(spark, folder)), exclude_sentinels=True)


@query("model_scorecard", _scorecard_sql(FACTS, "N/A"))
def _(spark, folder):
    return A.model_scorecard(B.facts(spark, folder))


@query("model_scorecard_cloud", _scorecard_sql(CLOUD_FACTS, "Unknown"))
def _(spark, folder):
    return A.model_scorecard(B.facts(spark, folder, "Unknown"), "Unknown")


@query(
    "year_trend",
    FACTS
    + f"""select make, year, {_N_COMPLAINTS} as complaints, {_N_RECALLS} as recalls
    from f where make!='UNKNOWN' and year!=9999 and year between 1996 and 2000
    group by make, year""",
)
def _(spark, folder):
    return A.year_trend(B.facts(spark, folder), 1996, 2000)


@query(
    "brand_totals",
    CLOUD_FACTS
    + f"""select make, {_N_COMPLAINTS} as complaints, {_N_RECALLS} as recalls,
    count(*) as total from f where make!='UNKNOWN' group by make""",
)
def _(spark, folder):
    return A.brand_totals(B.facts(spark, folder, "Unknown"))


@query(
    "model_totals",
    CLOUD_FACTS
    + f"""select make, model, {_N_COMPLAINTS} as complaints, {_N_RECALLS} as recalls,
    count(*) as total from f where make!='UNKNOWN' and model!='Unknown'
    group by make, model""",
)
def _(spark, folder):
    return A.model_totals(B.facts(spark, folder, "Unknown"), "Unknown")


@query(
    "model_share_of_brand",
    CLOUD_FACTS
    + f""", n as (
      select make, model, count(*) as complaints,
        cast(sum(count(*)) over (partition by make) as bigint) as brand_total
      from f where source='nhtsa_complaints' and make<>'UNKNOWN' group by make, model)
    select *, {_pct("complaints", "brand_total")} as pct_of_brand_complaints
    from n where model<>'Unknown'""",
)
def _(spark, folder):
    return A.model_share_of_brand(B.facts(spark, folder, "Unknown"), "Unknown")


@query(
    "component_recall_gap",
    CLOUD_FACTS
    + f""", g as (
      select make, component, {_N_COMPLAINTS} as complaint_count, {_N_RECALLS} as recall_count,
        count(*) filter (where source='nhtsa_complaints' and crash_involved) as crash_count,
        cast(coalesce(sum(greatest(injuries, 0)) filter (where source='nhtsa_complaints'), 0) as bigint) as total_injuries,
        cast(coalesce(sum(units_affected) filter (where source='nhtsa_recalls'), 0) as bigint) as units_affected
      from f where make<>'UNKNOWN' and component<>'Unknown' group by all
      having complaint_count > 0)
    select *,
      case when recall_count > 0 then 'recall exists'
        when complaint_count >= 50 and crash_count > 0 then 'high concern — no recall'
        else 'no recall issued' end as recall_status,
      {_pct("complaint_count", "sum(complaint_count) over (partition by make)")} as pct_of_brand_complaints
    from g""",
)
def _(spark, folder):
    return A.component_recall_gap(B.facts(spark, folder, "Unknown"), "Unknown")


@query(
    "coverage_grid",
    FACTS
    + f""", grid as (
      select make, cast(year as int) as year
      from (values ('BOLT'),('RING'),('WIDGET'),('UNKNOWN')) m(make), range(1995,2003) y(year)),
    n as (
      select make, year, {_N_COMPLAINTS} as complaints, {_N_RECALLS} as recalls
      from f group by make, year)
    select g.make, g.year, coalesce(n.complaints,0) as complaints,
      coalesce(n.recalls,0) as recalls
    from grid g left join n on g.make=n.make and g.year=n.year""",
)
def _(spark, folder):
    grid = snapshots.request_grid(spark, {make: ("any",) for make in B.FACT_MAKES}, 1995, 2002)
    return A.coverage_grid(B.facts(spark, folder), grid.drop("model"), ["make", "year"])


# ---------------------------------------------------------------- cleaning


@query(
    "clean_numeric",
    DIRTY
    + """select id, coalesce(cast(trunc(try_cast(raw_num as double)) as bigint),-1) as injuries
    from d""",
)
def _(spark, folder):
    df = B.dirty(spark, folder).selectExpr("id", "raw_num as injuries")
    return clean.clean_numeric(df)


def _text_sql(placeholder: str) -> str:
    return (
        DIRTY
        + f"""select id, case when raw_text is null
          or trim(raw_text) in ('','None','nan','NaN','NULL','null')
        then '{placeholder}' else trim(raw_text) end as component from d"""
    )


@query("clean_text_na", _text_sql("N/A"))
def _(spark, folder):
    df = B.dirty(spark, folder).selectExpr("id", "raw_text as component")
    return clean.clean_text(df, {"component": "N/A"})


@query("clean_text_unknown", _text_sql("Unknown"))
def _(spark, folder):
    df = B.dirty(spark, folder).selectExpr("id", "raw_text as component")
    return clean.clean_text(df, {"component": "Unknown"})


_PARSED = "cast(try_strptime({0},'%m/%d/%Y') as date)"


@query(
    "clean_dates",
    DIRTY
    + f"""select id,
      cast(coalesce({_PARSED.format("raw_date")}, date '9999-12-31') as varchar) as incident_date,
      {_PARSED.format("raw_date")} is null as incident_date_missing from d""",
)
def _(spark, folder):
    df = B.dirty(spark, folder).selectExpr("id", "raw_date as incident_date")
    cleaned = clean.clean_dates(df, LOCAL.date_formats)
    return cleaned.withColumn("incident_date", F.col("incident_date").cast("string"))


@query(
    "event_date",
    DIRTY
    + f""", c as (
      select id, id%2=0 as complaint,
        coalesce({_PARSED.format("raw_date")}, date '9999-12-31') as incident_date,
        case when k=6 then date '2001-02-03' else date '9999-12-31' end as recall_date from d),
    e as (select id, case when complaint then incident_date else recall_date end as e from c)
    select id, cast(e as varchar) as event_date, e>=date '9999-12-31' as event_date_missing
    from e""",
)
def _(spark, folder):
    df = B.dirty(spark, folder).selectExpr(
        "id",
        f"case when id%2=0 then '{COMPLAINTS}' else '{RECALLS}' end as source",
        "raw_date as incident_date",
        "case when k=6 then '2001-02-03' when k=5 then ' ' end as recall_date",
    )
    dated = clean.add_event_date(clean.clean_dates(df, LOCAL.date_formats))
    return dated.select("id", F.col("event_date").cast("string"), "event_date_missing")


@query(
    "scraped_at_zone",
    """select event_id, strftime(ts,'%Y-%m-%d %H:%M:%S.%f') as scraped_at,
      strftime(ts at time zone 'UTC' at time zone 'America/Chicago','%Y-%m-%d %H:%M:%S.%f')
        as scraped_at_local
    from events""",
)
def _(spark, folder):
    pattern = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    texts = B.table(spark, folder, "events").select(
        "event_id",
        F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00")).alias(
            "scraped_at"
        ),
    )
    shown = clean.wall_clock(clean.clean_scraped_at(texts), CLOUD.display_zone)
    return shown.select(
        "event_id",
        F.date_format("scraped_at", pattern).alias("scraped_at"),
        F.date_format("scraped_at_local", pattern).alias("scraped_at_local"),
    )


@query(
    "clean_booleans",
    DIRTY
    + """select id, coalesce(lower(trim(raw_bool)) in ('true','yes','1'), false)
      as crash_involved from d""",
)
def _(spark, folder):
    df = B.dirty(spark, folder).selectExpr("id", "raw_bool as crash_involved")
    return clean.clean_booleans(df)


_MAKE_CASE = """case when contains({0},'bolt') then 'BOLT' when contains({0},'ring') then 'RING'
    when contains({0},'widget') then 'WIDGET' else 'UNKNOWN' end"""
_MAKE_ID_CASE = """case when contains({0},'bolt') then 0 when contains({0},'ring') then 1
    when contains({0},'widget') then 2 else -1 end"""
_PART_MAKE = "concat('  ',upper(p_name),'. ')"


def _parts(spark: SparkSession, folder: str) -> DataFrame:
    parts = B.table(spark, folder, "part")
    return parts.selectExpr("p_partkey", f"{_PART_MAKE} as make")


@query(
    "normalise_make",
    f"""select p_partkey, trim({_PART_MAKE}) as make_raw,
      {_MAKE_CASE.format("lower(p_name)")} as make,
      cast({_MAKE_ID_CASE.format("lower(p_name)")} as bigint) as make_id from part""",
)
def _(spark, folder):
    return makes.normalise_make(_parts(spark, folder), B.FACT_KEYWORDS)


# Keywords for the table variant: several match the same text, the priority decides.
_KEYWORD_TABLE = [
    ("ring", "RING", 1, 3), ("ed", "ED", 2, 5), ("old", "OLD", 3, 2), ("cold", "COLD", 4, 1),
    ("gizmo", "GIZMO", 5, 9), ("l", "L", 6, 8), ("bolt", "BOLT", 7, 4), ("hot rod", "ROD", 8, 0),
]


@query(
    "normalise_make_join",
    f"""with k(keyword, make, make_id, priority) as (values {
        ", ".join(str(row) for row in _KEYWORD_TABLE)}),
    best as (
      select p_partkey, min_by(make, priority) as make, min_by(make_id, priority) as make_id
      from part join k on contains(lower(p_name), keyword) group by p_partkey)
    select p.p_partkey, trim({_PART_MAKE}) as make_raw, coalesce(b.make,'UNKNOWN') as make,
      cast(coalesce(b.make_id,-1) as bigint) as make_id
    from part p left join best b on p.p_partkey=b.p_partkey""",
)
def _(spark, folder):
    keywords = spark.createDataFrame(
        _KEYWORD_TABLE, "keyword string, make string, make_id bigint, priority int"
    )
    return makes.normalise_make_join(_parts(spark, folder), keywords)


@query(
    "unmapped_makes",
    f"""select distinct trim({_PART_MAKE}) as make_raw from part
    where {_MAKE_CASE.format("lower(p_name)")}='UNKNOWN'""",
)
def _(spark, folder):
    return makes.unmapped_makes(makes.normalise_make(_parts(spark, folder), B.FACT_KEYWORDS))


@query(
    "enforce_schema",
    DIRTY
    + """select id, trim(raw_text) as body,
      coalesce(cast(trunc(try_cast(raw_num as double)) as bigint),-1) as year,
      coalesce(try_cast(raw_num as double),0.0) as source_weight,
      coalesce(raw_bool='True',false) as crash_involved from d""",
)
def _(spark, folder):
    df = B.dirty(spark, folder).selectExpr(
        "id", "raw_text as body", "raw_num as year", "raw_num as source_weight",
        "raw_bool='True' as crash_involved",
    )
    return clean.enforce_schema(df, LOCAL)


def _with_empty_columns(spark: SparkSession, folder: str) -> DataFrame:
    empty = F.lit(None).cast("string")
    return B.dirty(spark, folder).withColumns(
        {"never": empty, "blank": F.when(F.col("k") > 3, F.lit(" \t")).otherwise(empty)}
    )


@query("drop_null_columns", DIRTY + "select * from d")
def _(spark, folder):
    return clean.drop_null_columns(_with_empty_columns(spark, folder))


@query(
    "null_fields_from_profile",
    """select unnest(['blank','never']) as field, count(*) as missing, count(*) as total
    from orders""",
)
def _(spark, folder):
    profile = quality.field_profile(_with_empty_columns(spark, folder))
    return quality.empty_fields(profile).select("field", "missing", "total")


@query("record_key_concat", DIRTY + """select id,
      concat('complaint_',coalesce(trim(raw_text),'')) as record_id from d""")
def _(spark, folder):
    key = C.record_key("complaint_", C.strip(F.col("raw_text")))
    return B.dirty(spark, folder).select("id", key.alias("record_id"))


# ---------------------------------------------------------------- duplicates


def _texts(spark: SparkSession, folder: str) -> DataFrame:
    return B.table(spark, folder, "documents").select("text", "lang")


@query("drop_exact_duplicates", "select distinct text, lang from documents")
def _(spark, folder):
    return dedupe.drop_exact_duplicates(_texts(spark, folder))


@query(
    "duplicate_rows",
    """select count(*) as total_rows,
      count(*)-(select count(*) from (select distinct text, lang from documents))
        as duplicate_rows from documents""",
)
def _(spark, folder):
    return dedupe.duplicate_rows(_texts(spark, folder))


@query(
    "duplicate_samples",
    """with t as (
      select text, lang, count(*) over (partition by text, lang) as copies,
        sha256(concat(length(text),':',text,length(lang),':',lang)) as digest from documents)
    select text, lang from t where copies>1 order by digest limit 10""",
)
def _(spark, folder):
    return dedupe.duplicate_samples(_texts(spark, folder))


@query(
    "dedupe_by_key",
    FACTS
    + """, ranked as (
      select *, row_number() over (partition by record_id, make, model, year
        order by units_affected desc nulls last, component, crash_involved, injuries, source)
        as place from f)
    select record_id, source, make, model, component, year, crash_involved, injuries,
      units_affected from ranked where place=1""",
)
def _(spark, folder):
    return dedupe.dedupe_by_key(B.facts(spark, folder), latest="units_affected")


# ---------------------------------------------------------------- quality


def _profile_sql(ctes: str, source: str, fields: list[str], kind: str = "string") -> str:
    rows = " union all ".join(
        f"""select '{name}' as field, count(*) as total,
          count(*) filter (where "{name}" is null) as nulls,
          count(*) filter (where trim("{name}", {_BLANKS})='') as blanks,
          count(*)-(select count(*) from (select distinct "{name}" from {source}))
            as duplicates from {source}"""
        for name in fields
    )
    return (
        ctes
        + f"""select field, total, nulls, blanks, nulls+blanks as missing, p as missing_pct,
      duplicates, '{kind}' as dtype,
      case when p>50 then 'HIGH' when p>10 then 'WARN' else '' end as severity
    from (select *, round_even((nulls+blanks)/total*100,1) as p from ({rows}))"""
    )


_DIRTY_TEXTS = ["raw_text", "raw_num", "raw_date", "raw_bool"]


@query("field_profile", _profile_sql(DIRTY, "d", _DIRTY_TEXTS))
def _(spark, folder):
    return quality.field_profile(B.dirty(spark, folder).select(_DIRTY_TEXTS))


@query("field_profile_texts", _profile_sql("", "documents", ["text", "lang", "source"]))
def _(spark, folder):
    return quality.field_profile(
        B.table(spark, folder, "documents").select("text", "lang", "source")
    )


@query(
    "value_counts",
    FACTS
    + """select 'source' as field, source as value, count(*) as record_count from f group by source
    union all select 'make', make, count(*) from f group by make""",
)
def _(spark, folder):
    return quality.value_counts(B.facts(spark, folder), "source", "make")


@query(
    "identity_check",
    DIRTY
    + """, r as (select case when k=4 then null
        else concat('complaint_',coalesce(trim(raw_text),'')) end as record_id from d)
    select count(*) filter (where record_id is null) as null_ids,
      count(*) filter (where record_id in ('complaint_','recall_')) as empty_ids from r""",
)
def _(spark, folder):
    key = C.record_key("complaint_", C.strip(F.col("raw_text")))
    df = B.dirty(spark, folder).select(F.when(F.col("k") != 4, key).alias("record_id"))
    return quality.identity_check(df)


def _completeness_sql(field: str, inside: str, expected: str, extra: str, extras: str) -> str:
    blank = f"trim({field}, {_BLANKS})=''"
    return f"""select '{field}' as field, '{expected}' as expected_in, total, nulls, blanks,
      nulls+blanks as missing, p as missing_pct, {extras}, p>10 as warn
    from (select *, round_even((nulls+blanks)/total*100,1) as p from (
      select count(*) filter (where {inside}) as total,
        count(*) filter (where {inside} and {field} is null) as nulls,
        count(*) filter (where {inside} and {blank}) as blanks,
        {extra.format(f"{inside} and {field} is not null and not {blank}")}
      from r))"""


_SOURCED = f"case when id%2=0 then '{COMPLAINTS}' else '{RECALLS}' end as source"
_DATED = ["raw_text as scraped_at", "raw_date as incident_date", "raw_num as recall_date"]


@query(
    "date_completeness",
    DIRTY
    + f", r as (select {_SOURCED}, {', '.join(_DATED)} from d) "
    + " union all ".join(
        _completeness_sql(
            field,
            "true" if expected == "all" else f"source='{expected}'",
            expected,
            f"min({field}) filter (where {{0}}) as sample",
            "sample",
        )
        for field, expected in quality.DATE_EXPECTED_IN.items()
    ),
)
def _(spark, folder):
    return quality.date_completeness(B.dirty(spark, folder).selectExpr(_SOURCED, *_DATED))


_PROSE = [
    f"case when lang='en' then '{RECALLS}' else '{COMPLAINTS}' end as source",
    "text as body",
    "case when n_chars<400 then null when n_chars<900 then ' ' else text end as consequence",
    "lower(lang) as remedy",
]


@query(
    "description_profile",
    f"with r as (select {', '.join(_PROSE)} from documents) "
    + " union all ".join(
        _completeness_sql(
            field,
            "true" if expected == "all" else f"source='{expected}'",
            expected,
            f"""cast(round_even(avg(length({field})) filter (where {{0}}),0) as bigint)
              as avg_length,
            min(length({field})) filter (where {{0}}) as min_length,
            max(length({field})) filter (where {{0}}) as max_length,
            min(substring({field},1,120)) filter (where {{0}}) as sample""",
            "avg_length, min_length, max_length, sample",
        )
        for field, expected in quality.PROSE_EXPECTED_IN.items()
    ),
)
def _(spark, folder):
    return quality.description_profile(
        B.table(spark, folder, "documents").selectExpr(*_PROSE)
    )


_NUMERIC = [
    "raw_num as injuries",
    "raw_num as deaths",
    "cast(id*1000 as string) as units_affected",
]
_BAD_NUMERIC = [
    "raw_num as injuries",
    "raw_text as deaths",
    "concat('u',cast(id as string)) as units_affected",
]


@query(
    "numeric_anomalies",
    DIRTY
    + f", r as (select {', '.join(_NUMERIC)} from d) "
    + " union all ".join(
        f"""select '{name}' as field, count(*) filter (where {name} is null) as nulls,
          count(*) filter (where {name} is not null and try_cast({name} as double) is null)
            as type_errors,
          count(*) filter (where try_cast({name} as double)<{low}) as negatives,
          count(*) filter (where try_cast({name} as double)>{high}) as outliers from r"""
        for name, (low, high) in quality.NUMERIC_BOUNDS.items()
    ),
)
def _(spark, folder):
    return quality.numeric_anomalies(B.dirty(spark, folder).selectExpr(*_NUMERIC))


@query(
    "bad_numeric_values",
    DIRTY
    + f", r as (select {', '.join(_BAD_NUMERIC)} from d), "
    + "bad as ("
    + " union ".join(
        f"""select '{name}' as field, {name} as value from r
        where {name} is not null
          and (try_cast({name} as double) is null or lower(trim({name}))='nan')"""
        for name in quality.NUMERIC_BOUNDS
    )
    + """) select field, place, value from (
      select *, row_number() over (partition by field order by value) as place from bad)
    where place<=5""",
)
def _(spark, folder):
    return quality.bad_numeric_values(B.dirty(spark, folder).selectExpr(*_BAD_NUMERIC))


@query("make_variants", FACTS + "select make, count(*) as record_count from f group by make")
def _(spark, folder):
    return quality.make_variants(B.facts(spark, folder))


@query("make_variant_total", "select count(distinct p_name) as variants from part")
def _(spark, folder):
    parts = B.table(spark, folder, "part")
    return quality.make_variant_total(parts.selectExpr("p_name as make"))


@query(
    "record_count_summary",
    FACTS + "select source, make, count(*) as record_count from f group by source, make",
)
def _(spark, folder):
    return quality.record_count_summary(B.facts(spark, folder))


# ---------------------------------------------------------------- sentiment


def _lexicon_sql(lexicon: Lexicon) -> str:
    rows = ", ".join(
        f"""('{token}', {to_micro(lexicon.valences.get(token, 0.0))},
        {to_micro(lexicon.boosters.get(token, 0.0))}, {str(token in lexicon.negators).lower()})"""
        for token in sorted(lexicon.tokens())
    )
    return f"lex(token, v, b, n) as (values {rows})"


_TOKENS = r"string_split_regex(lower({0}), '[^\p{{L}}\p{{N}}'']+')"


def _sums_sql(source: str, key: str, field: str) -> str:
    return f"""select {key}, cast(sum(v) as bigint) as s from (
        select {key}, unnest({_TOKENS.format(field)}) as token from {source})
      join lex using (token) group by {key}"""


def _raw_score(s: str) -> str:
    x = f"(coalesce({s},0)/{MICRO}.0e0)"
    return f"{x}/sqrt({x}*{x}+15.0e0)"


def _unscored(field: str) -> str:
    return f"({field} is null or trim({field}, {_BLANKS}) in ('','N/A'))"


def _label(field: str, score: str) -> str:
    return f"""case when {_unscored(field)} then 'N/A' when {score}< -0.5e0 then 'critical'
      when {score}< -0.2e0 then 'negative' when {score}<0.05e0 then 'neutral'
      else 'positive' end"""


def _label_id(label: str) -> str:
    return f"""cast(case {label} when 'positive' then 3 when 'neutral' then 2
      when 'negative' then 1 when 'critical' then 0 else -1 end as bigint)"""


def _scored_sql(source: str, key: str, fields: list[str], passed: list[str]) -> str:
    """Score, label and id of each field by exploded tokens joined to the lexicon."""
    joins, columns = [], [f"t.{name}" for name in passed]
    for field in fields:
        alias = f"s_{field}"
        joins.append(f"left join ({_sums_sql(source, key, field)}) {alias} using ({key})")
        score = _raw_score(f"{alias}.s")
        label = _label(f"t.{field}", score)
        columns += [
            f"case when {_unscored(f't.{field}')} then 0.0e0 else round_even({score},4) end"
            f" as {field}_sentiment_score",
            f"{label} as {field}_sentiment_label",
            f"{_label_id(f'({label})')} as {field}_sentiment_id",
        ]
    return f"select {', '.join(columns)} from {source} t {' '.join(joins)}"


_BODIES = f"with {_lexicon_sql(B.LEXICON)}, t as (select doc_id, text as body from documents) "


def _bodies(spark: SparkSession, folder: str) -> DataFrame:
    return B.table(spark, folder, "documents").selectExpr("doc_id", "text as body")


@query(
    "sentiment_score",
    _BODIES
    + f""", scored as ({_scored_sql("t", "doc_id", ["body"], ["doc_id"])})
    select doc_id, body_sentiment_score from scored""",
)
def _(spark, folder):
    scored = sentiment.score_columns(_bodies(spark, folder), B.LEXICON, ["body"])
    return scored.select("doc_id", "body_sentiment_score")


@query(
    "sentiment_label",
    _BODIES
    + f""", scored as ({_scored_sql("t", "doc_id", ["body"], ["doc_id"])})
    select doc_id, body_sentiment_label, body_sentiment_id from scored""",
)
def _(spark, folder):
    scored = sentiment.score_columns(_bodies(spark, folder), B.LEXICON, ["body"])
    return scored.select("doc_id", "body_sentiment_label", "body_sentiment_id")


_THREE_TEXTS = [
    "doc_id",
    "text as body",
    "case when lang='en' then 'N/A' when lang='fr' then ' ' else text end as consequence",
    "case when lang='de' then null else concat('new and ', source, ' of the old') end as remedy",
]
_THREE = ["body", "consequence", "remedy"]


@query(
    "sentiment_columns",
    f"with {_lexicon_sql(B.LEXICON)}, t as (select {', '.join(_THREE_TEXTS)} from documents) "
    + _scored_sql("t", "doc_id", _THREE, ["doc_id"]),
)
def _(spark, folder):
    df = B.table(spark, folder, "documents").selectExpr(*_THREE_TEXTS)
    return sentiment.score_columns(df, B.LEXICON).drop(*_THREE)


@query(
    "sentiment_distribution",
    _BODIES
    + f""", scored as ({_scored_sql("t", "doc_id", ["body"], ["doc_id"])})
    select 'body_sentiment_label' as field, body_sentiment_label as value,
      count(*) as record_count from scored group by all""",
)
def _(spark, folder):
    scored = sentiment.score_columns(_bodies(spark, folder), B.LEXICON, ["body"])
    return sentiment.label_distribution(scored)


@query(
    "sentiment_by_join",
    _BODIES + _scored_sql("t", "doc_id", ["body"], ["doc_id"]),
)
def _(spark, folder):
    valences = spark.createDataFrame(
        list(B.VALENCES.items()), "token string, valence double"
    )
    scored = sentiment.score_columns(_bodies(spark, folder), LexiconTable.of(valences), ["body"])
    return scored.drop("body")


# The words of the documents by their length, and some of them once more in upper case: over
# 20,000 entries from sf0.01 on.
_LARGE_LEXICON = r"""words as (
      select distinct token from (select unnest(string_split_regex(lower(text), '[^\p{L}\p{N}'']+')) as token
        from documents) where regexp_full_match(token, '[a-z]+')),
    entries as (select token, (length(token) % 7 - 3) * 1.0e0 as valence from words
      union all select upper(token), 0.5e0 from words where length(token) % 3 = 0),
    lex as (select lower(token) as token, cast(sum(cast(round(valence * 1000000) as bigint)) as bigint) as v
      from entries group by 1), """


@query(
    "sentiment_large_lexicon",
    f"with {_LARGE_LEXICON} t as (select doc_id, text as body from documents) "
    + _scored_sql("t", "doc_id", ["body"], ["doc_id"]),
)
def _(spark, folder):
    bodies = _bodies(spark, folder)
    words = bodies.select(F.explode(tokens(F.col("body"))).alias("token")).distinct()
    words = words.where(F.rlike("token", F.lit("^[a-z]+$")))
    size = F.length("token")
    plain = words.select("token", (size % 7 - 3).cast("double").alias("valence"))
    loud = words.where(size % 3 == 0).select(F.upper("token").alias("token"), F.lit(0.5).alias("valence"))
    lexicon = Lexicon.from_table(plain.unionByName(loud))
    return sentiment.score_columns(bodies, lexicon, ["body"]).drop("body")


def _lagged(column: str, distance: int, missing: str) -> str:
    return f"coalesce(lag({column},{distance}) over w,{missing})"


@query(
    "sentiment_modifiers",
    f"with {_lexicon_sql(B.MODIFIED_LEXICON)}, "
    + f"""words as (
      select doc_id, unnest(tokens) as token, unnest(range(1,len(tokens)+1)) as place
      from (select doc_id, {_TOKENS.format("text")} as tokens from documents)),
    known as (select doc_id, place, v, b, n from words left join lex using (token)),
    near as (
      select doc_id, coalesce(v,0) as v,
        0.0e0+{_lagged("b", 1, "0")}*1.0e0+{_lagged("b", 2, "0")}*0.95e0
          +{_lagged("b", 3, "0")}*0.9e0 as boost,
        {_lagged("n", 1, "false")} or {_lagged("n", 2, "false")}
          or {_lagged("n", 3, "false")} as negated
      from known window w as (partition by doc_id order by place)),
    sums as (
      select doc_id, cast(sum(cast(round((v+sign(v)*boost)
          *case when negated then -0.74e0 else 1.0e0 end) as bigint)) as bigint) as s
      from near where v!=0 group by doc_id)
    select doc_id,
      case when {_unscored("text")} then 0.0e0 else round_even({_raw_score("s")},4) end
        as body_sentiment_score
    from documents left join sums using (doc_id)""",
)
def _(spark, folder):
    scored = sentiment.score_columns(
        _bodies(spark, folder), B.MODIFIED_LEXICON, ["body"], modifiers=True
    )
    return scored.select("doc_id", "body_sentiment_score")


# ---------------------------------------------------------------- dimensions


@query(
    "dim_make",
    f"""with d(make_id, make, make_label) as (values (0,'TOYOTA','Toyota'), (1,'FORD','Ford'),
      (2,'TESLA','Tesla'), (-1,'UNKNOWN','Unknown')),
    n as (select {_MAKE_ID_CASE.format("lower(p_name)")} as make_id, count(*) as record_count
      from part group by 1)
    select cast(d.make_id as bigint) as make_id, make, make_label,
      coalesce(record_count,0) as record_count from d left join n using (make_id)""",
)
def _(spark, folder):
    mapped = makes.normalise_make(_parts(spark, folder), B.FACT_KEYWORDS)
    return dims.dim_usage(mapped, dims.dim_make(spark), "make_id")


@query(
    "dim_sentiment",
    _BODIES
    + f""", d(sentiment_id, sentiment_label, threshold) as (values (3,'positive','>= 0.05'),
      (2,'neutral','>= -0.2 and < 0.05'), (1,'negative','>= -0.5 and < -0.2'),
      (0,'critical','< -0.5'), (-1,'N/A','unscored')),
    scored as ({_scored_sql("t", "doc_id", ["body"], ["doc_id"])}),
    n as (select body_sentiment_id as sentiment_id, count(*) as record_count
      from scored group by 1)
    select cast(sentiment_id as bigint) as sentiment_id, sentiment_label, threshold,
      coalesce(record_count,0) as record_count from d left join n using (sentiment_id)""",
)
def _(spark, folder):
    scored = sentiment.score_columns(_bodies(spark, folder), B.LEXICON, ["body"])
    keyed = scored.withColumnRenamed("body_sentiment_id", "sentiment_id")
    return dims.dim_usage(keyed, dims.dim_sentiment(spark), "sentiment_id")


@query(
    "facts_with_dim_labels",
    FACTS
    + """, dim(make, make_id, make_label) as (values ('BOLT',0,'Bolt'), ('RING',1,'Ring'),
      ('WIDGET',2,'Widget'), ('UNKNOWN',-1,'Unknown'))
    select f.*, cast(make_id as bigint) as make_id, make_label from f left join dim using (make)""",
)
def _(spark, folder):
    rows = [("BOLT", 0, "Bolt"), ("RING", 1, "Ring"), ("WIDGET", 2, "Widget"),
            ("UNKNOWN", -1, "Unknown")]
    dim = spark.createDataFrame(rows, "make string, make_id bigint, make_label string")
    return dims.with_dim(B.facts(spark, folder), dim, "make")


# ---------------------------------------------------------------- sources and sinks

_EVENT_TEXTS = T.StructType(
    [T.StructField(name, T.StringType()) for name in ("event_id", "event_type", "value", "props")]
)


def _event_texts(spark: SparkSession, folder: str) -> DataFrame:
    columns = [F.col(name).cast("string").alias(name) for name in _EVENT_TEXTS.names]
    return B.table(spark, folder, "events").select("ts", *columns)


@query(
    "scan_json_records",
    """select event_id, event_type, value, cast(json_extract(props,'$.k') as int) as k
    from events""",
)
def _(spark, folder):
    events = _event_texts(spark, folder).drop("ts")
    path = writers.write_snapshot(events, fresh_path(spark, "snapshots"))
    records = snapshots.read_snapshot(spark, path, "lines", _EVENT_TEXTS)
    return records.select(
        F.col("event_id").cast("bigint"),
        "event_type",
        F.col("value").cast("double"),
        F.from_json("props", "k int")["k"].alias("k"),
    )


def _event_snapshots(spark: SparkSession, folder: str) -> str:
    """Two snapshots of raw records, the later one with the events after the 15th."""
    late = F.dayofmonth("ts") > 15
    events = _event_texts(spark, folder).withColumnsRenamed(
        {"event_id": "record_id", "event_type": "component"}
    )
    base = fresh_path(spark, "snapshots")
    for stem, rows in (("nhtsa_20240101_000000", ~late), ("nhtsa_20240116_000000", late)):
        writers.write_snapshot(
            events.where(rows).select("record_id", "component"), base, stem
        )
    return base


@query(
    "scan_union_snapshots",
    """select cast(event_id as varchar) as record_id, event_type as component,
      cast(2 as int) as snapshots from events""",
)
def _(spark, folder):
    records, names = snapshots.read_all_snapshots(spark, _event_snapshots(spark, folder), "lines")
    return records.select("record_id", "component", F.lit(len(names)).alias("snapshots"))


@query(
    "latest_snapshot_by_name",
    """select cast(event_id as varchar) as record_id, event_type as component
    from events where day(ts)>15""",
)
def _(spark, folder):
    latest = snapshots.latest_snapshot(spark, _event_snapshots(spark, folder))
    return snapshots.read_snapshot(spark, latest.path, "lines").select("record_id", "component")


_REQUEST = """event_type as make, cast(user_id%5 as varchar) as model, '2024' as year"""
_LOADED = "'2026-06-06T20:03:41+00:00' as scraped_at, '1' as week_added"
_COMPLAINTS_SQL = f"""
    select concat('complaint_',event_id) as record_id, 'nhtsa_complaints' as source,
      '1.0' as source_weight, {_REQUEST}, event_type as component,
      concat('user ',user_id) as body, '01/15/2020' as incident_date,
      case when event_type='error' then 'true' else 'false' end as crash_involved,
      'false' as fire_involved, cast(user_id%4 as varchar) as injuries, '0' as deaths,
      {_LOADED} from events
    union all
    select 'complaint_None', 'nhtsa_complaints', '1.0', {_REQUEST}, null, '', '', 'false',
      'false', null, '0', {_LOADED} from events"""
_RECALLS_SQL = f"""
    select concat('recall_V',event_id) as record_id, 'nhtsa_recalls' as source,
      '1.5' as source_weight, {_REQUEST}, event_type as component,
      concat('user ',user_id) as body, 'none' as consequence, '' as remedy,
      '2020-01-15' as recall_date, cast(user_id as varchar) as units_affected, {_LOADED}
    from events
    union all
    select 'recall_', 'nhtsa_recalls', '1.5', {_REQUEST}, '', '', '', null, '', '0', {_LOADED}
    from events"""


@query("flatten_payload_complaints", _COMPLAINTS_SQL)
def _(spark, folder):
    return payloads.flatten_complaints(B.payloads(spark, folder, B.COMPLAINT_PAYLOAD))


@query("flatten_payload_recalls", _RECALLS_SQL)
def _(spark, folder):
    landed = B.payloads(spark, folder, B.RECALL_PAYLOAD)
    return payloads.flatten_recalls(landed, LOCAL.recall_weight)


@query(
    "union_all_by_name",
    f"select * from ({_COMPLAINTS_SQL}) union all by name select * from ({_RECALLS_SQL})",
)
def _(spark, folder):
    return payloads.raw_records(
        B.payloads(spark, folder, B.COMPLAINT_PAYLOAD),
        B.payloads(spark, folder, B.RECALL_PAYLOAD),
        LOCAL.recall_weight,
    )


@query("roundtrip_partitioned_parquet", FACTS + "select * from f")
def _(spark, folder):
    path = writers.write_facts(B.facts(spark, folder), fresh_path(spark, "facts"), "run")
    return spark.read.parquet(path)


@query("scan_facts_view", FACTS + "select count(*) as record_count from f")
def _(spark, folder):
    base = fresh_path(spark, "facts")
    writers.write_facts(B.facts(spark, folder), base, "run")
    fact_source.register_view(fact_source.scan_facts(spark, base, LOCAL), "facts")
    return spark.sql("select count(*) as record_count from facts")


@query("roundtrip_csv", _scorecard_sql(FACTS, "N/A"))
def _(spark, folder):
    result = A.model_scorecard(B.facts(spark, folder))
    (path,) = writers.write_results({"scorecard": result}, fresh_path(spark, "results"))
    return writers.read_results(spark, path, result.schema)


@query("catalog_table", FACTS + "select make, count(*) as record_count from f group by make")
def _(spark, folder):
    name = f"facts_{uuid4().hex}"
    writers.save_facts_table(B.facts(spark, folder), name)
    counts = quality.group_counts(fact_source.scan_table(spark, name), "make")
    found = writers.write_profile(counts, fresh_path(spark, "counts"), "makes")
    spark.sql(f"drop table {name}")  # the answer is written, nothing stays behind
    return found


@query(
    "latest_snapshot_by_mtime",
    """select cast(event_id as varchar) as record_id, event_type as component
    from events where day(ts)>15""",
)
def _(spark, folder):
    # written last under the later name as well, so the answer is known
    latest = snapshots.latest_snapshot(spark, _event_snapshots(spark, folder), "mtime")
    return snapshots.read_snapshot(spark, latest.path, "lines").select("record_id", "component")


def _cloud_analysis(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A saved result of the cloud report, read back with the types of its question."""
    facts = B.facts(spark, folder, "Unknown")
    question = A.report_questions(CLOUD)[name]
    target = fresh_path(spark, "analysis")
    jobs.run_analysis(facts, target, 1996, 2000, CLOUD)
    return writers.read_results(spark, f"{target}/{name}.csv", question(facts).schema)


@query("analysis_cloud", ORACLES["component_recall_gap"])
def _(spark, folder):
    return _cloud_analysis(spark, folder, "q8_component_recall_gap")


@query("analysis_cloud_scorecard", ORACLES["model_scorecard_cloud"])
def _(spark, folder):
    return _cloud_analysis(spark, folder, "q3_model_scorecard")


_LOADS = """select record_id, source, make, model, component, cast(year as bigint) as year, injuries,
      timestamp '2024-01-01 00:00:00' as scraped_at from f
    union all select record_id, source, make, model, component, cast(year as bigint) as year,
      injuries + 100 as injuries, timestamp '2024-02-01 00:00:00' as scraped_at from f where year >= 2000 and injuries >= 0"""


@query(
    "incremental_merge",
    FACTS
    + f""", loads as ({_LOADS}),
    ranked as (select *, row_number() over (partition by record_id, make, model, year
      order by scraped_at desc, component, injuries, source) as place from loads)
    select record_id, make, model, year, component, injuries, source from ranked where place = 1""",
)
def _(spark, folder):
    B.facts(spark, folder).createOrReplaceTempView("f")
    first, _, later = _LOADS.partition("union all")
    base = fresh_path(spark, "facts")
    for load in (first, later):
        landing.merge_facts(spark.sql(load), base, "all", CLOUD)
    rows = fact_source.scan_facts(spark, base, CLOUD)
    return rows.select("record_id", "make", "model", "year", "component", "injuries", "source")


# ---------------------------------------------------------------- whole transform

_TEST_PROFILE = Profile(**{**vars(LOCAL), "make_keywords": B.FACT_KEYWORDS})


def _curated(spark: SparkSession, folder: str) -> DataFrame:
    """Raw records through a snapshot and the transform to written facts, read back."""
    parts, snapshot = B.raw_parts(spark, folder), fresh_path(spark, "snapshots")
    for k, part in enumerate(parts, 1):
        landed = writers.write_snapshot(part, snapshot, "nhtsa_1", packed=True, begun=k > 1, unfinished=k < len(parts))
    raw = snapshots.read_snapshot(spark, landed, "lines", schemas.RAW)
    base = fresh_path(spark, "facts")
    jobs.run_transform(raw, base, "run", _TEST_PROFILE, B.LEXICON)
    listing.remove(spark, landed)  # the facts hold all that is asked of them
    return fact_source.scan_facts(spark, base, _TEST_PROFILE)


def _nullish(field: str) -> str:
    return f"""case when {field} is null or trim({field}) in ('','None','nan','NaN','NULL','null')
      then 'N/A' else trim({field}) end"""


def _whole(field: str) -> str:
    return f"coalesce(cast(trunc(try_cast({field} as double)) as bigint),-1)"


def _true(field: str) -> str:
    return f"coalesce(lower(trim({field})) in ('true','yes','1'),false)"


_CURATED_PASSED = [
    "record_id", "source", "source_weight", "make_raw", "make_id", "model", "component", "body",
    "consequence", "incident_date", "incident_date_missing", "recall_date",
    "recall_date_missing", "crash_involved", "fire_involved", "injuries", "deaths",
    "units_affected", "scraped_at", "week_added", "make", "year",
]
_MAKE_TEXT = "rtrim(lower(trim(make)),'.')"
_CURATED_SQL = f"""with {_lexicon_sql(B.LEXICON)}, raw as ({B.raw_sql()}),
    d as (select distinct * from raw),
    t as (
      select row_number() over () as row_id, record_id, source,
        cast(source_weight as double) as source_weight, trim(make) as make_raw,
        cast({_MAKE_ID_CASE.format(_MAKE_TEXT)} as bigint) as make_id,
        {_nullish("model")} as model, {_nullish("component")} as component,
        {_nullish("body")} as body, {_nullish("consequence")} as consequence,
        cast(coalesce({_PARSED.format("incident_date")}, date '9999-12-31') as varchar)
          as incident_date,
        {_PARSED.format("incident_date")} is null as incident_date_missing,
        cast(coalesce(try_cast(recall_date as date), date '9999-12-31') as varchar)
          as recall_date,
        recall_date is null as recall_date_missing,
        {_true("crash_involved")} as crash_involved, {_true("fire_involved")} as fire_involved,
        {_whole("injuries")} as injuries, {_whole("deaths")} as deaths,
        {_whole("units_affected")} as units_affected,
        replace(substring(scraped_at,1,26),'T',' ') as scraped_at,
        cast(week_added as bigint) as week_added,
        {_MAKE_CASE.format(_MAKE_TEXT)} as make, {_whole("year")} as year
      from d),
    scored as ({_scored_sql("t", "row_id", ["body", "consequence"], _CURATED_PASSED)})
    """


@query("curated_facts", _CURATED_SQL + "select * from scored")
def _(spark, folder):
    facts = _curated(spark, folder)
    dropped = [name for name in facts.columns if name.startswith("remedy")]
    return facts.drop(*dropped).withColumns(
        {
            "incident_date": F.col("incident_date").cast("string"),
            "recall_date": F.col("recall_date").cast("string"),
            "scraped_at": F.date_format("scraped_at", "yyyy-MM-dd HH:mm:ss.SSSSSS"),
        }
    )


@query(
    "partition_point_lookup",
    _CURATED_SQL
    + """select make, year, body, body_sentiment_label from scored
    where make='RING' and year=1998 and body_sentiment_label='positive'""",
)
def _(spark, folder):
    return A.partition_point_lookup(_curated(spark, folder), "RING", 1998, "positive")


# Queries that load, report and stream; they build on the ones above.
from faultline.plans import registry_loads  # noqa: E402, F401
