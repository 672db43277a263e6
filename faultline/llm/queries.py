"""Queries that apply the operators to their whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.llm import ann, automaton, licenses, maxent, packing, pii, prefixes, quality, rules, simhash, topk, toxicity, variants
from faultline.llm.common import in_fold, table, texts

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

#: A key for the registered queries; users give their own.
PSEUDONYM_KEY = b"registered queries"


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def with_prediction(scored: DataFrame, held_out, threshold: float) -> DataFrame:
    predicted = (F.col("score") >= F.lit(threshold)).cast("int").alias("predicted")
    return scored.select("doc_id", held_out.alias("held_out"), "score", predicted)


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


@query(
    "op8_exact_top_k",
    """with v as (select vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) as e
      from embeddings where embedding is not null and len(embedding) > 0
        and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
    s as (select q.vec_id as query_id, c.vec_id,
        cast(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])) as bigint) as score
      from v q join v c on q.vec_id <> c.vec_id and len(q.e) = len(c.e) where q.vec_id % 100 = 0),
    r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as n from s)
    select query_id, cast(n as integer) as rank, vec_id, score from r where n <= 10""",
)
def op8_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return topk.exact_top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0, 10)


@query("op6_bpe_automaton")
def op6_bpe_automaton(spark: SparkSession, folder: str) -> DataFrame:
    return automaton.encode_documents(table(spark, folder, "documents"), tokenizer_file("word_bpe_49k.json"), digest=True)


@query("op10_packing")
def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), tokenizer_file("byte_bpe_50k.json"), 1024)


@query("op2_simhash")
def op2_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"), words_each=4, radius=4, seed=42)
    return found.select("doc_id", simhash.as_hex("fp").alias("fingerprint"), "component_id")


@query("op4_quality")
def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs, held_out = table(spark, folder, "documents"), in_fold(4, 2)
    model = quality.fit(docs, table(spark, folder, "labels"), "quality", ~held_out)
    return with_prediction(quality.score(texts(docs), model), held_out, 0.7)


@query("op1_toxicity")
def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, held_out = table(spark, folder, "documents"), in_fold(5, 0)
    model = toxicity.fit(docs, table(spark, folder, "labels"), "toxic", ~held_out)
    return with_prediction(toxicity.score(texts(docs), model), held_out, 0.5)


@query("op9_pii")
def op9_pii(spark: SparkSession, folder: str) -> DataFrame:
    made = pii.pseudonymise(texts(table(spark, folder, "documents")), PSEUDONYM_KEY, "found")
    return made.select("doc_id", "text", F.size("found").alias("n_values"), "found")


@query("op5_licenses")
def op5_licenses(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    path = F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string"))
    return licenses.scan(docs.select("doc_id", path.alias("path"), "text"))


@query("op7_maxent_lm")
def op7_maxent_lm(spark: SparkSession, folder: str) -> DataFrame:
    return maxent.score(table(spark, folder, "documents"), in_fold(7, 2))


@query("op3_adaptive_scan")
def op3_adaptive_scan(spark: SparkSession, folder: str) -> DataFrame:
    return ann.search(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0, 20)


def _crc32(text: str) -> str:
    """DuckDB SQL for the CRC-32 of an ASCII text: eight steps of the reflected polynomial for each byte."""
    eight = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, (x & 1) * 3988292384))"
    read = f"list_transform(string_split({text}, ''), lambda s: cast(ascii(s) as bigint))"
    return f"xor(4294967295, list_reduce(list_concat([4294967295], {read}), lambda c, b: {eight}))"


@query(
    "op11_prefix_trie",
    f"""with t as (select conv_id, row_number() over (partition by conv_id order by turn nulls first) as p,
        {{'r': coalesce(role, ''), 't': coalesce(text, '')}} as u from conversations where conv_id is not null),
    c as (select distinct conv_id, {_crc32("cast(conv_id as varchar)")} % 4 as h from t),
    s as (select c.conv_id, 0 as part, b.p, b.u from c join t b on b.conv_id = c.conv_id - c.conv_id % 20 and b.p <= c.h
      union all select c.conv_id, 1, t.p, t.u from c join t on t.conv_id = c.conv_id and t.p > c.h),
    l as (select conv_id, list(u order by part, p) as path from s group by conv_id),
    f as (select c.conv_id, coalesce(l.path, []) as path from c left join l using (conv_id)),
    m as (select conv_id, len(path) as n, d, path[1:d] as node from f, unnest(range(0, len(path) + 1)) as x(d)),
    g as (select d, node, min(conv_id) as conv_id, count(*) as n_convs,
        coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (where n = d), '') as ids from m group by d, node),
    k as (select g.*, p.conv_id as parent_conv_id, (select count(*) from g y where y.d = g.d + 1 and y.node[1:g.d] = g.node) as n_children,
        case when g.d = 0 then 0 else (g.n_convs - 1) * len(regexp_extract_all(g.node[g.d].t, '[^\\x20\\x09-\\x0D]+')) end as saved
      from g left join g p on p.d = g.d - 1 and p.node = g.node[1:g.d - 1])
    select a.conv_id, cast(a.d as bigint) as depth, any_value(a.parent_conv_id) as parent_conv_id, any_value(a.n_convs) as n_convs, any_value(a.n_children) as n_children,
      count(*) filter (where b.n_children = 0) as n_leaves, cast(sum(b.saved) as bigint) as saved_tokens, sha256(any_value(a.ids)) as ends_sha256
    from k a join k b on b.d >= a.d and b.node[1:a.d] = a.node group by a.conv_id, a.d, a.node""",
)
def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefixes.trie(table(spark, folder, "conversations"))


@query(
    "op12_spelling_variants",
    f"""with r as (select doc_id, unnest(regexp_extract_all(text, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) as run from documents),
    w as (select coalesce(cast(doc_id as varchar), '') || ':' as id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run from r where length(run) >= 6),
    d as (select id, run, count(*) as n, {_crc32("id || run").replace("string_split(id || run, '')", "regexp_extract_all(hex(encode(id || run)), '..')").replace("cast(ascii(s) as bigint)", "cast('0x' || s as bigint)")} as h from w group by id, run),
    o as (select case when h % 199 = 0 then run[1:h % length(run)] || run[h % length(run) + 2:] else run end as word, n from d),
    v as (select word, cast(sum(n) as bigint) as n from o where length(word) >= 6 group by word having sum(n) >= 5),
    x as (select word, n, i, word[1:i - 1] as a, word[i + 1:] as b from v, unnest(range(1, length(word) + 1)) as y(i)),
    p as (select x.word, z.word as other, z.n as m from x join x z on x.i = z.i and x.a = z.a and x.b = z.b and x.word <> z.word
      union select x.word, v.word, v.n from x join v on v.word = x.a || x.b
      union select v.word, x.word, x.n from x join v on v.word = x.a || x.b),
    q as (select word, count(*) as n_near, max(m) as m from p group by word),
    best as (select q.word, q.n_near, q.m, min(p.other) as other from q join p on p.word = q.word and p.m = q.m group by q.word, q.n_near, q.m),
    f as (select v.word, v.n, coalesce(best.n_near, 0) as n_near, case when m >= 5 * v.n then other end as form, case when m >= 5 * v.n then m end as form_n
      from v left join best using (word)),
    c as (with recursive s(word, tip) as (select word, word from f union all select s.word, f.form from s join f on f.word = s.tip where f.form is not null)
      select s.word, s.tip as root from s join f on f.word = s.tip where f.form is null)
    select f.word, f.form, c.root, f.n, f.n_near, f.form_n from f join c using (word)""",
)
def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return variants.variants(variants.vocabulary(table(spark, folder, "documents"), noise=199))


@query("op13_quality_rules")
def op13_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return rules.judge(table(spark, folder, "documents"), table(spark, folder, "labels"), "quality", "lang")
