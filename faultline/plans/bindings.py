"""Views that give star-schema tables the record shapes of the operators.

Each shape is one list of SQL expressions, used by Spark here and as text by the
comparison queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.functions.lexicon import Lexicon
from faultline.session import input_bytes

_IS_RECALL = "(l_returnflag='R' and l_quantity>=49)"

FACT_MAKES = ("BOLT", "RING", "WIDGET", "UNKNOWN")
FACT_KEYWORDS = (("bolt", "BOLT", 0), ("ring", "RING", 1), ("widget", "WIDGET", 2))

FACT_COLUMNS = [
    f"""concat(case when {_IS_RECALL} then 'recall_' else 'complaint_' end,
        cast(l_orderkey as string),'_',cast(l_linenumber as string)) as record_id""",
    f"case when {_IS_RECALL} then 'nhtsa_recalls' else 'nhtsa_complaints' end as source",
    """case when contains(lower(p_name),'bolt') then 'BOLT'
        when contains(lower(p_name),'ring') then 'RING'
        when contains(lower(p_name),'widget') then 'WIDGET' else 'UNKNOWN' end as make""",
    "p_brand as model",
    "case when p_size=50 then 'N/A' else concat('C',cast(p_size as string)) end as component",
    "cast(year(o_orderdate) as int) as year",
    "(l_linestatus='F' and l_quantity<=p_size/10.0e0) as crash_involved",
    """case when l_quantity=1 then cast(-1 as bigint)
        else cast(floor(l_quantity) as bigint)%3 end as injuries""",
    f"""case when {_IS_RECALL} then cast(floor(l_extendedprice) as bigint)
        else cast(-1 as bigint) end as units_affected""",
]

DIRTY_COLUMNS = [
    "o_orderkey as id",
    "o_orderkey%8 as k",
    """case o_orderkey%8 when 0 then '' when 1 then '  ' when 2 then 'nan' when 3 then 'NULL'
        when 4 then 'None' when 5 then concat('  ',o_orderpriority,' ')
        when 6 then 'Unknown' else null end as raw_text""",
    """case o_orderkey%8 when 0 then '' when 1 then ' 7 ' when 2 then 'abc' when 3 then '1e3'
        when 4 then '2.9' when 5 then '-5' when 6 then cast(o_custkey as string)
        else null end as raw_num""",
    """case o_orderkey%8 when 0 then '' when 1 then '13/45/2020' when 2 then 'n/a'
        when 7 then null
        else concat(lpad(cast(month(o_orderdate) as string),2,'0'),'/',
                    lpad(cast(day(o_orderdate) as string),2,'0'),'/',
                    cast(year(o_orderdate) as string)) end as raw_date""",
    """case o_orderkey%8 when 0 then 'YES' when 1 then ' true ' when 2 then '1' when 3 then 'no'
        when 4 then '0' when 5 then '' when 6 then 'True' else null end as raw_bool""",
]

_MONTH = "lpad(cast(month(o_orderdate) as string),2,'0')"
_DAY = "lpad(cast(day(o_orderdate) as string),2,'0')"
_YEAR = "cast(year(o_orderdate) as string)"

RAW_COLUMNS = [
    *FACT_COLUMNS[:2],
    f"case when {_IS_RECALL} then '1.5' else '1.0' end as source_weight",
    """case l_linenumber%3 when 0 then p_name when 1 then concat('  ',upper(p_name),'. ')
        else concat(p_name,'..') end as make""",
    "case when l_linenumber=7 then ' ' else p_brand end as model",
    f"case when l_quantity=13 then 'n/a' else {_YEAR} end as year",
    """case when p_size=50 then null when p_size=49 then ' NULL '
        else concat(' C',cast(p_size as string),' ') end as component""",
    """case when l_quantity=17 then '  '
        else concat('The ',p_name,' is ',lower(o_orderpriority),', with ',p_type) end as body""",
    f"case when {_IS_RECALL} then concat(p_name,'!') end as consequence",
    f"case when {_IS_RECALL} then '' end as remedy",
    f"""case when {_IS_RECALL} then null when l_quantity=19 then '13/45/2020'
        else concat({_MONTH},'/',{_DAY},'/',{_YEAR}) end as incident_date""",
    f"case when {_IS_RECALL} then concat({_YEAR},'-',{_MONTH},'-',{_DAY}) end as recall_date",
    f"""case when {_IS_RECALL} then null when l_linestatus='F' then 'YES'
        else 'false' end as crash_involved""",
    f"case when {_IS_RECALL} then null when l_tax=0 then '1' else 'no' end as fire_involved",
    f"""case when {_IS_RECALL} then null when l_quantity=23 then 'abc'
        else cast(cast(floor(l_quantity) as bigint)%3 as string) end as injuries""",
    f"case when {_IS_RECALL} then null else '0' end as deaths",
    f"""case when {_IS_RECALL} then cast(cast(floor(l_extendedprice) as bigint) as string)
        end as units_affected""",
    """concat('2026-06-06T20:',lpad(cast(l_linenumber as string),2,'0'),':41.123456+00:00')
        as scraped_at""",
    "'1' as week_added",
]
RAW_REPEATED = "l_quantity>=45"
#: Each part reads the tables anew, hence a bound.
BYTES_PER_PART, MOST_PARTS = 64 * 1024 * 1024, 16

# Requests answered with two results each: one complete, one with absent and null keys.
COMPLAINT_PAYLOAD = """concat('{"results":[{"odiNumber":',cast(event_id as string),
    ',"components":"',event_type,'","cdescription":"user ',cast(user_id as string),
    '","dateOfIncident":"01/15/2020","crash":',
    case when event_type='error' then 'true' else 'false' end,
    ',"fire":false,"numberOfInjuries":',cast(user_id%4 as string),',"numberOfDeaths":0},',
    '{"odiNumber":null,"components":null,"numberOfInjuries":null}]}')"""
RECALL_PAYLOAD = """concat('{"results":[{"NHTSACampaignNumber":"V',cast(event_id as string),
    '","Component":"',event_type,'","Summary":"user ',cast(user_id as string),
    '","Consequence":"none","ReportReceivedDate":"2020-01-15",',
    '"PotentialNumberOfUnitsAffected":',cast(user_id as string),'},{"Remedy":null}]}')"""
PAYLOAD_REQUEST = [
    "event_type as make",
    "cast(user_id%5 as string) as model",
    "2024 as year",
    "'2026-06-06T20:03:41+00:00' as fetched_at",
]

# Words of the test prose; the values are tenths, so sums are exact.
VALENCES = {
    "the": -0.3, "of": 0.2, "and": 0.4, "to": -0.2, "is": -0.5, "that": 0.3, "for": -0.4,
    "with": 0.6, "de": 0.1, "les": -0.2, "der": 0.2, "el": -0.1,
    "hot": -2.5, "cold": -1.2, "red": 0.5, "new": 2.0, "old": -1.5, "large": 1.0,
    "small": -0.4,
}
LEXICON = Lexicon(VALENCES)
MODIFIED_LEXICON = Lexicon(VALENCES, {"a": 0.293, "of": -0.293}, frozenset({"in", "that"}))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _order_lines(spark: SparkSession, folder: str, k: int = 0, of: int = 1) -> DataFrame:
    """Lines with their part and order; the sizes decide how each join runs.

    `k` of several parts has the lines of the orders that a hash deals it.
    """

    def dealt(name: str, key: str) -> DataFrame:
        rows = table(spark, folder, name)
        return rows if of == 1 else rows.where(F.pmod(F.xxhash64(key), F.lit(of)) == k)

    return dealt("lineitem", "l_orderkey").join(
        table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey")
    ).join(dealt("orders", "o_orderkey"), F.col("o_orderkey") == F.col("l_orderkey"))


def facts(spark: SparkSession, folder: str, placeholder: str = "N/A") -> DataFrame:
    columns = [text.replace("'N/A'", f"'{placeholder}'") for text in FACT_COLUMNS]
    return _order_lines(spark, folder).selectExpr(*columns)


def dirty(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").selectExpr(*DIRTY_COLUMNS)


def raw(spark: SparkSession, folder: str, k: int = 0, of: int = 1) -> DataFrame:
    copies = f"explode(sequence(1, case when {RAW_REPEATED} then 2 else 1 end))"
    lines = _order_lines(spark, folder, k, of).withColumn("copy", F.expr(copies))
    return lines.selectExpr(*RAW_COLUMNS)


def raw_parts(spark: SparkSession, folder: str) -> list[DataFrame]:
    """The raw records in parts, so that whoever takes them one by one has one part's joins on disk."""
    of = min(MOST_PARTS, -(-input_bytes(spark, f"{folder}/lineitem.parquet") // BYTES_PER_PART)) or 1
    return [raw(spark, folder, k, of) for k in range(of)]


def payloads(spark: SparkSession, folder: str, payload: str) -> DataFrame:
    return table(spark, folder, "events").selectExpr(*PAYLOAD_REQUEST, f"{payload} as payload")


_LINES_SQL = """from lineitem join part on l_partkey=p_partkey
    join orders on o_orderkey=l_orderkey"""


def facts_sql(placeholder: str = "N/A") -> str:
    columns = ", ".join(FACT_COLUMNS).replace("'N/A'", f"'{placeholder}'")
    return f"select {columns} {_LINES_SQL}"


def dirty_sql() -> str:
    return f"select {', '.join(DIRTY_COLUMNS)} from orders"


def raw_sql() -> str:
    columns = ", ".join(RAW_COLUMNS)
    return (
        f"select {columns} {_LINES_SQL} union all "
        f"select {columns} {_LINES_SQL} where {RAW_REPEATED}"
    )
