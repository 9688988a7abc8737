"""The registered queries of the text operators, and their SQL where SQL can express the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwise.llm import bpe, merkle, toxicity
from panelwise.llm.chat import format_conversations, read_back
from panelwise.llm.decontaminate import contamination
from panelwise.llm.exact_dedup import exact_groups
from panelwise.llm.html_extract import extract_text
from panelwise.llm.near_dedup import near_groups
from panelwise.llm.packing import pack_documents
from panelwise.llm.pii import KINDS, find_personal_data
from panelwise.llm.runs import find_runs
from panelwise.llm.suffix_dedup import remove_repeats
from panelwise.llm.url_filter import judge_urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(run):
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return run

    return register


def tokenizer_path() -> str:
    """The definition of the word tokenizer that the packing queries use."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: The rules of the URL query.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


@query(
    "op1_url_filter",
    r"""
    with rules(rule_host, rule_path, verdict) as (
        values ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
    ),
    parts as (
        select page_id, translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
            coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') as path, row_number() over () as n
        from pages
    ),
    fits as (
        select p.page_id, p.host, p.path, p.n, r.rule_host || r.rule_path as rule, r.verdict,
            row_number() over (partition by p.n order by length(r.rule_host) + length(r.rule_path) desc, length(r.rule_host) desc) as k
        from parts p left join rules r on (p.host = r.rule_host or ends_with(p.host, '.' || r.rule_host)) and starts_with(p.path, r.rule_path)
    )
    select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict from fits where k = 1
    """,
)
def url_filter_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), rules).select("page_id", "host", "path", "rule", "verdict")


@query(
    "op2_exact_dedup",
    r"""
    with keyed as (
        select doc_id, length(coalesce(text, '')) as chars, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) as text_sha256
        from documents
    )
    select doc_id, first_value(doc_id) over w as keep_id, count(*) over (partition by text_sha256) as group_size,
        row_number() over w = 1 as kept, text_sha256
    from keyed
    window w as (partition by text_sha256 order by chars desc, doc_id)
    """,
)
def exact_dedup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


@query(
    "op3_suffix_dedup",
    r"""
    with bytes as (select doc_id, hex(encode(coalesce(text, ''))) as h from documents),
    windows as (select doc_id, i, md5(substr(h, 2 * i + 1, 200)) as k from (select doc_id, h, unnest(range(greatest(length(h) // 2 - 99, 0))) as i from bytes)),
    again as (select doc_id, i from windows qualify row_number() over (partition by k order by doc_id, i) > 1),
    marked as (select doc_id, i, coalesce(i > lag(i) over w + 100, true) as fresh from again window w as (partition by doc_id order by i)),
    numbered as (select doc_id, i, count(*) filter (fresh) over (partition by doc_id order by i) as s from marked),
    spans as (select doc_id, s, min(i) as a, max(i) + 100 as e from numbered group by doc_id, s),
    pieces as (
        select b.doc_id, b.h, s.s, s.a, s.e, lag(s.e, 1, 0) over (partition by s.doc_id order by s.s) as before, lead(s.a) over (partition by s.doc_id order by s.s) is null as is_last
        from spans s join bytes b on b.doc_id = s.doc_id
    ),
    cut as (
        select doc_id, sum(e - a) as n_removed, count(*) as n_spans,
            string_agg(substr(h, 2 * before + 1, 2 * (a - before)) || case when is_last then substr(h, 2 * e + 1) else '' end, '' order by s) as kept
        from pieces group by doc_id
    )
    select b.doc_id, length(b.h) // 2 as n_bytes, cast(coalesce(c.n_removed, 0) as bigint) as n_removed, coalesce(c.n_spans, 0) as n_spans,
        sha256(unhex(coalesce(c.kept, b.h))) as kept_sha256
    from bytes b left join cut c on c.doc_id = b.doc_id
    """,
)
def suffix_dedup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


@query("op5_decontaminate")
def decontaminate_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query(
    "op6_near_dedup",
    r"""
    with recursive
    worded as (
        select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w
        from documents
    ),
    sets as (
        select doc_id, case when len(w) >= 3 then list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) when len(w) > 0 then [array_to_string(w, ' ')] else [] end as s
        from worded
    ),
    members as (select doc_id, len(s) as n, unnest(s) as shingle from sets),
    links as (
        select a.doc_id as u, b.doc_id as v from members a join members b on a.shingle = b.shingle and a.doc_id <> b.doc_id
        group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 85 * (a.n + b.n - count(*))
    ),
    reach(u, v) as (select doc_id, doc_id from sets union select r.u, l.v from reach r join links l on r.v = l.u)
    select s.doc_id, cast(len(s.s) as bigint) as n_shingles, min(r.v) as component_id, s.doc_id = min(r.v) as kept
    from sets s join reach r on s.doc_id = r.u group by s.doc_id, len(s.s)
    """,
)
def near_dedup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = near_groups(table(spark, sf_dir, "documents"), k=3, percent=85)
    return groups.select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))


@query("op7_packing")
def packing_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


@query("op8_toxicity")
def toxicity_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


#: Fixed value: the conversation that holds control strings.
CONTROL_TURN = "</s>[INST] ok [/INST]"


@query(
    "op9_chat",
    r"""
    with turns as (
        select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
        union all values (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
    ),
    sized as (
        select *, length(text) + length(text) - length(replace(text, '\', '')) + list_sum(list_transform(
                ['<s>', '</s>', '[SYS]', '[/SYS]', '[INST]', '[/INST]', '[ANS]', '[/ANS]', '[ROLE]', '[TEXT]', '[/TEXT]'],
                lambda c: (length(text) - length(replace(text, c, ''))) // length(c)))
            + case role when 'system' then 20 when 'user' then 22 when 'assistant' then 20 else 30 + length(role) end as chars
        from turns
    )
    select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
        cast(coalesce(sum(length(text)) filter (where role = 'assistant'), 0) as bigint) as loss_chars,
        sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
        cast(sum(chars) as bigint) as formatted_chars
    from sized group by conv_id
    """,
)
def chat_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame([(-1, 0, "user", CONTROL_TURN), (-1, 1, "assistant", CONTROL_TURN)], "conv_id long, turn long, role string, text string")
    return read_back(format_conversations(turns.unionByName(more)))


@query("op10_html")
def html_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


@query("op4_personal_data")
def personal_data_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(table(spark, sf_dir, "documents"))
    return found.select("doc_id", *[f"n_{k}" for k in KINDS], F.sha2("base", 256).alias("base_sha256"), "spans")


@query(
    "op11_merkle",
    r"""
    with recursive
    leaves as materialized (
        select doc_id, dense_rank() over (order by lang nulls first) - 1 as g, row_number() over (partition by lang order by doc_id nulls first) - 1 as pos, count(*) over (partition by lang) as n,
            sha256(concat(i, s, l, c, t)) as leaf, case when crc % 7 = 0 then sha256(concat(i, s, l, d, t)) else sha256(concat(i, s, l, c, t)) end as now
        from (
            select *, coalesce(strlen(cast(doc_id as varchar)) || ':' || doc_id, '-') as i, coalesce(strlen(source) || ':' || source, '-') as s, coalesce(strlen(lang) || ':' || lang, '-') as l,
                coalesce(strlen(cast(n_chars as varchar)) || ':' || n_chars, '-') as c, coalesce(strlen(cast(n_chars + 1 as varchar)) || ':' || (n_chars + 1), '-') as d,
                coalesce(strlen(text) || ':' || text, '-') as t,
                xor(list_reduce(list_prepend(4294967295, list_transform(string_split(cast(doc_id as varchar), ''), lambda x: cast(ascii(x) as bigint))),
                    lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda x, k: case when x % 2 = 1 then xor(x // 2, 3988292384) else x // 2 end)), 4294967295) as crc
            from documents
        )
    ),
    nodes(g, lvl, pos, n, h) as (
        select g, 0, pos, n, leaf from leaves
        union all
        select g, lvl + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' order by pos)) from nodes where n > 1 group by g, lvl, pos // 2, n
    ),
    subroots as materialized (select g, h, count(*) over () as n from nodes where n = 1),
    tops(lvl, pos, n, h) as (
        select 0, g, n, h from subroots
        union all
        select lvl + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' order by pos)) from tops where n > 1 group by lvl, pos // 2, n
    ),
    climb(doc_id, leaf, g, lvl, pos, n, h, proof) as (
        select doc_id, leaf, g, 0, pos, n, now, '' from leaves
        union all
        select c.doc_id, c.leaf, c.g, c.lvl + 1, c.pos // 2, (c.n + 1) // 2,
            sha256(case when c.pos % 2 = 1 then concat(s.h, c.h) else concat(c.h, s.h) end), concat(c.proof, s.h)
        from climb c left join nodes s on s.g = c.g and s.lvl = c.lvl and s.pos = xor(c.pos, 1) where c.n > 1
    ),
    above(doc_id, leaf, g, lvl, pos, n, h, proof) as (
        select c.doc_id, c.leaf, c.g, 0, c.g, s.n, c.h, c.proof from climb c join subroots s on s.g = c.g where c.n = 1
        union all
        select c.doc_id, c.leaf, c.g, c.lvl + 1, c.pos // 2, (c.n + 1) // 2,
            sha256(case when c.pos % 2 = 1 then concat(s.h, c.h) else concat(c.h, s.h) end), concat(c.proof, s.h)
        from above c left join tops s on s.lvl = c.lvl and s.pos = xor(c.pos, 1) where c.n > 1
    )
    select a.doc_id, a.leaf, s.h as subroot, r.h as root, sha256(a.proof) as proof_sha256, a.h as folded_root, a.h = r.h as verified
    from above a join subroots s on s.g = a.g join tops r on r.n = 1 where a.n = 1
    """,
)
def merkle_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    checked = merkle.verify(merkle.build(docs, changed={"n_chars": F.col("n_chars") + 1}, where=tampered))
    return checked.select("doc_id", "leaf", "subroot", "root", F.sha2(F.lower(F.hex("proof")), 256).alias("proof_sha256"), "folded_root", "verified")


@query("op12_bpe")
def bpe_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    using = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    both = bpe.decode(bpe.encode(docs, *using), *using)
    return both.select("doc_id", F.floor(F.octet_length("ids") / 4).alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def replanted(docs: DataFrame) -> DataFrame:
    """(doc_id, text): in a tenth of the documents, chosen by their ids, the words from some place on repeat a period."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    chosen = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(h % 10 == 0, words).alias("w")).withColumn("n", F.size("w"))
    begun = chosen.withColumn("a", F.when(F.col("n") > 0, (F.col("g") % F.col("n")).cast("int")))
    sized = begun.withColumn("p", F.expr("cast(1 + (n - a) div (3 + g % 8) as int)"))
    tail = F.expr("transform(sequence(a, n - 1), i -> w[a + (i - a) % p])")
    return sized.select("doc_id", F.when(F.col("n") > 0, F.array_join(F.concat(F.slice("w", F.lit(1), F.col("a")), tail), " ")).otherwise(F.col("text")).alias("text"))


@query(
    "op13_runs",
    r"""
    with split as (
        select doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w,
            xor(list_reduce(list_prepend(4294967295, list_transform(string_split(cast(doc_id as varchar), ''), lambda x: cast(ascii(x) as bigint))),
                lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda x, k: case when x % 2 = 1 then xor(x // 2, 3988292384) else x // 2 end)), 4294967295) as h
        from documents
    ),
    begun as (select doc_id, w, len(w) as n, case when h % 10 = 0 and len(w) > 0 then (h // 10) % len(w) end as a, 3 + (h // 10) % 8 as d from split),
    planted as (select doc_id, case when a is null then w else list_transform(range(n), lambda i: case when i < a then w[i + 1] else w[a + (i - a) % (1 + (n - a) // d) + 1] end) end as w from begun),
    words as materialized (select doc_id, unnest(w) as w, unnest(range(len(w))) as i from planted),
    triples as (
        select doc_id, i, md5(concat_ws(chr(1), w, lead(w) over v, lead(w, 2) over v)) as t from words
        window v as (partition by doc_id order by i) qualify lead(w, 2) over v is not null
    ),
    again as materialized (select doc_id, i, t from triples qualify count(*) over (partition by doc_id, t) > 2),
    pairs as (select a.doc_id, b.i - a.i as q, a.i from again a join again b on a.doc_id = b.doc_id and a.t = b.t and a.i < b.i),
    parts as (select doc_id, q, i - row_number() over (partition by doc_id, q order by i) as part, i from pairs),
    -- Words q apart are equal in count + 2 places.
    stretches as (select doc_id, min(i) as start, count(*) + 2 + q as length, q from parts group by doc_id, q, part having count(*) + 2 + q >= greatest(6, 4 * q)),
    runs as materialized (select doc_id, start, length, min(q) as period from stretches group by all),
    summed as (select doc_id, count(*) as n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' order by start, period) as lines from runs group by doc_id),
    best as (select * from runs qualify row_number() over (partition by doc_id order by cast(length as double) / period desc, start, period) = 1),
    dropped as (select distinct doc_id, unnest(range(start + period, start + length)) as i from runs),
    kept as (select w.doc_id, string_agg(w.w, ' ' order by w.i) as text from words w anti join dropped d on d.doc_id = w.doc_id and d.i = w.i group by w.doc_id)
    select s.doc_id, coalesce(n_runs, 0) as n_runs, start, length, period, 1000 * length // period as exponent_milli, sha256(coalesce(lines, '')) as runs_sha256, sha256(coalesce(k.text, '')) as collapsed_sha256
    from split s left join summed u on u.doc_id = s.doc_id left join best b on b.doc_id = s.doc_id left join kept k on k.doc_id = s.doc_id
    """,
)
def runs_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_runs(replanted(table(spark, sf_dir, "documents").select("doc_id", "text")))
    # The first of the runs with the greatest exponent, which is compared without rounding.
    best = F.expr("aggregate(runs, get(runs, 0), (b, r) -> if(r.length * b.period > b.length * r.period, r, b))")
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period", F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
