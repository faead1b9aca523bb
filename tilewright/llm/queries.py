"""The registered queries of this subpackage: thin applications of its operators
to whole tables, with production parameters. Where SQL can say the same, it
stands beside them in ORACLE_SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .ann import nearest_neighbours
from .clustering import cluster_vectors
from .exact_topk import exact_top_k
from .mixing import mix_sources
from .ngram_join import ngram_jaccard_join
from .packing import pack_documents
from .pii import KINDS, find_personal_data
from .sharding import shard_documents
from .shared import table
from .token_blocks import read_token_blocks, write_token_blocks
from .toxicity import score_toxicity
from .url_filter import filter_urls
from .vector_codes import compress_vectors
from .warc import round_trip


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard_join(table(spark, sf_dir, "documents"))


def op2_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = write_token_blocks(table(spark, sf_dir, "documents"))
    return read_token_blocks(spark, folder)


def op3_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return exact_top_k(vectors, vectors.where("vec_id % 50 = 0"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", "mix_epoch", "mix_tokens", F.round("mix_exponent", 9).alias("mix_exponent"), F.round("mix_weight", 9).alias("mix_weight"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "pages"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents")).withColumn("grown_shard", F.lit(None).cast("int"))


def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return nearest_neighbours(vectors, vectors.where("vec_id % 100 = 0"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress_vectors(table(spark, sf_dir, "embeddings"))


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(table(spark, sf_dir, "embeddings"))


def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])

    def told(spans) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, KINDS), F.sha2(told(base), 256).alias("base_sha256"), told("spans").alias("spans"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_ngram_jaccard_join,
        op2_token_blocks,
        op3_exact_topk,
        op4_toxicity,
        op5_mixing,
        op6_warc,
        op7_packing,
        op8_url_filter,
        op9_sharding,
        op10_nearest_neighbours,
        op11_vector_codes,
        op12_centroid_clustering,
        op13_personal_data,
    )
}

ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["op1_ngram_jaccard_join"] = r"""
with recursive words as (
    select doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') as w from documents
), classes as (
    select array_to_string(w, ' ') as words, any_value(w) as w, min(doc_id) as text_class, count(*) as n_copies
    from words where len(w) > 0 group by 1
), grams as materialized (
    select distinct text_class, unnest(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' '))) as gram from classes
), sizes as (
    select text_class, count(*) as n from grams group by 1
), links as materialized (
    select p.a, p.b from (
        select x.text_class as a, y.text_class as b, count(*) as both from grams x join grams y on x.gram = y.gram and x.text_class <> y.text_class group by 1, 2
    ) p join sizes s on s.text_class = p.a join sizes t on t.text_class = p.b
    where p.both * 1800000 >= 800000 * (s.n + t.n)
), reach(node, other) as (
    select a, b from links union select r.node, l.b from reach r join links l on l.a = r.other
), named as (
    select c.text_class, c.words, c.n_copies,
        least(c.text_class, coalesce((select min(other) from reach where node = c.text_class), c.text_class)) as class_id,
        (select count(*) from links where a = c.text_class) as n_links,
        coalesce((select sum(o.n_copies) from links join classes o on o.text_class = links.b where links.a = c.text_class), 0) as n_docs
    from classes c
)
select d.doc_id, coalesce(n.class_id, d.doc_id) as class_id, coalesce(n.text_class, d.doc_id) as text_class,
    coalesce(n.n_copies, 1)::bigint as n_copies, coalesce(n.n_links, 0)::bigint as n_links, (coalesce(n.n_docs, 0) + coalesce(n.n_copies, 1) - 1)::bigint as n_doc_links
from words d left join named n on len(d.w) > 0 and n.words = array_to_string(d.w, ' ')
"""

ORACLE_SQL["op3_exact_topk"] = """
with v as (
    select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as v from embeddings
    where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), s as (
    select q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v)::bigint as score
    from v q join v c on q.vec_id % 50 = 0 and c.vec_id <> q.vec_id
), r as (
    select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int as rank, vec_id, score from s
)
select * from r where rank <= 5
"""

ORACLE_SQL["op6_warc"] = """
with p as (
    select page_id, octet_length(encode(coalesce(html, '')))::bigint as payload_bytes, sha1(coalesce(html, '')) as payload_digest from pages
), f as (
    select *, max(page_id) over (partition by payload_digest) as shown from p
)
select page_id, payload_bytes, payload_digest,
    case when payload_bytes >= 1000 and page_id <> shown then 'revisit' else 'response' end as record_type,
    case when payload_bytes >= 1000 and page_id <> shown then shown end as refers_to
from f
"""

ORACLE_SQL["op8_url_filter"] = r"""
with u as (
    select page_id, case when contains(url, '://') then substr(url, instr(url, '://') + 3) else '' end as rest from pages
), h as (
    select page_id, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
        regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) as path from u
), rules(rule_host, rule_path, rule_verdict) as (
    values ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), fit as (
    select page_id, max({'n': length(rule_host || rule_path), 'h': length(rule_host), 'rule': rule_host || rule_path, 'verdict': rule_verdict}) as best
    from h join rules on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path) group by page_id
)
select h.page_id, host, path, best.rule as rule, coalesce(best.verdict, 'allow') as verdict from h left join fit on fit.page_id = h.page_id
"""

ORACLE_SQL["op10_nearest_neighbours"] = """
with v as (
    select vec_id, embedding::double[] as v from embeddings
    where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0
), s as (
    select q.vec_id as query_id, c.vec_id, list_distance(q.v, c.v) as score
    from v q join v c on q.vec_id % 100 = 0 and c.vec_id <> q.vec_id
), r as (
    select query_id, row_number() over (partition by query_id order by score, vec_id)::int as rank, vec_id, score from s
)
select * from r where rank <= 10
"""


def _mean(of: str, n: str) -> str:
    """Floor of a quotient of whole numbers."""
    return f"({of} - (({of} % {n}) + {n}) % {n}) // {n}"


def _lloyd(rounds: int, width: int) -> str:
    """CTEs of Lloyd's rounds from c0 (pos, e, v) over p (pos, v, ...), up to c{rounds},
    and the assignment to it, fin (the columns of p, e, d)."""

    def assigned(k: int) -> str:
        return f"select p.*, m.e, m.d from p join near{k} m on m.pos = p.pos and m.v = p.v"

    def near(k: int) -> str:
        return f"""near{k} as materialized (select pos, v, best.e as e, best.d as d from (
            select x.pos, x.v, min({{'d': list_sum(list_transform(range(1, {width + 1}), lambda i: (x.v[i] - c.v[i]) * (x.v[i] - c.v[i])))::bigint, 'e': c.e}}) as best
            from (select distinct pos, v from p) x join c{k} c on c.pos = x.pos group by x.pos, x.v))"""

    parts = []
    for k in range(rounds):
        parts.append(near(k))
        parts.append(f"""c{k + 1} as materialized (select c.pos, c.e, coalesce(m.v, c.v) as v from c{k} c left join (
            select pos, e, list({_mean("s", "n")} order by i) as v from (
                select pos, e, i, sum(v[i])::bigint as s, count(*)::bigint as n from (select *, unnest(range(1, {width + 1})) as i from ({assigned(k)})) group by pos, e, i
            ) group by pos, e) m on m.pos = c.pos and m.e = c.e)""")
    parts += [near(rounds), f"fin as materialized ({assigned(rounds)})"]
    return ", ".join(parts)


def _whole(scale: int, more: str = "") -> str:
    return f"""k as materialized (
    select vec_id, label, list_transform(embedding, lambda x: floor({scale} * x::double)::bigint) as v from embeddings
    where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0{more}
)"""


ORACLE_SQL["op11_vector_codes"] = f"""
with {_whole(1024)}, p as materialized (
    select vec_id, label, pos, v[pos * 16 + 1:pos * 16 + 16] as v from k, (select unnest(range(4)) as pos)
), c0 as materialized (
    select pos, row_number() over (partition by pos order by vec_id) - 1 as e, v from p qualify e < 256
), {_lloyd(4, 16)}, books as (
    select sha256(string_agg(array_to_string(v, ','), ',' order by pos, e)) as codebooks_sha256 from c4
), coded as (
    select vec_id, label, string_agg(lpad(lower(to_hex(e)), 2, '0'), '' order by pos) as code, sum(d)::bigint as error from fin group by 1, 2
)
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error, codebooks_sha256 from coded, books
"""

ORACLE_SQL["op12_centroid_clustering"] = f"""
with {_whole(64, " and len(embedding) = 64")}, p as materialized (
    select vec_id, 0 as pos, v from k
), c0 as materialized (
    select 0 as pos, row_number() over (order by sha256('1:' || vec_id)) - 1 as e, v from k qualify e < 16
), {_lloyd(3, 64)}
select fin.vec_id, fin.e::int as cluster, d as distance, (sum(d) over (partition by fin.e))::bigint as cluster_inertia, (sum(d) over ())::bigint as inertia,
    sha256(array_to_string(c3.v, ',')) as centroid_sha256
from fin join c3 on c3.e = fin.e
"""
