"""One registered query per operator, each over its whole table, with SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from flowlab.llm import (
    bpe, centroids, decontaminate, interpolation, licenses, nn_descent, pfor, quotation, regions, spelling, tensor_minhash,
    toxicity, warc,
)
from flowlab.llm.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None) -> Callable:
    def register(run: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[run.__name__] = run
        if oracle:
            ORACLES[run.__name__] = oracle
        return run

    return register


LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query(rf"""
with dw as (select doc_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
iw as (select cast(item_id as varchar) as item, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
windows as (select distinct item, w[p:p + least(10, len(w)) - 1] as g
 from (select item, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) as p from iw where len(w) > 0)),
sizes as (select distinct len(g) as n from windows),
places as (select doc_id, n, p, w[p:p + n - 1] as g
 from (select doc_id, n, w, unnest(range(1, len(w) - n + 2)) as p from dw, sizes where len(w) >= n)),
hits as (select doc_id, n, p, item from places join windows using (g)),
found as (select doc_id, count(distinct q) as n_hit from (select doc_id, unnest(range(p, p + n)) as q from hits) group by doc_id),
named as (select doc_id, list_sort(list(distinct item)) as items from hits group by doc_id)
select dw.doc_id, cast(coalesce(len(w), 0) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, cast(coalesce(len(items), 0) as bigint) as n_items,
 sha256(coalesce(array_to_string(items, ','), '')) as items_sha256, n_hit is not null as contaminated
from dw left join found using (doc_id) left join named using (doc_id)
""")
def op2_decontaminate(spark, sf_dir):
    found = decontaminate.contamination(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated",
    )


BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
END_ID = 2


@query()
def op10_pfor_tokens(spark, sf_dir):
    found = pfor.token_round_trip(read_table(spark, sf_dir, "documents"), BYTE_BPE, END_ID)
    return found.select(
        "doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )


@query("""
with p as (
 select page_id, encode(coalesce(html, '')) as body, sha256(coalesce(html, '')) as digest from pages
), g as (select digest, min(page_id) as original from p group by digest)
select p.page_id, octet_length(body) as payload_bytes, p.digest as payload_digest,
 case when octet_length(body) < 100 or p.page_id = original then 'response' else 'revisit' end as record_type,
 case when octet_length(body) < 100 or p.page_id = original then null else original end as refers_to
from p join g on p.digest = g.digest
""")
def op9_warc(spark, sf_dir):
    found = warc.warc_round_trip(read_table(spark, sf_dir, "pages"))
    return found.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", F.col("original").alias("refers_to")
    )


@query()
def op8_bpe_round_trip(spark, sf_dir):
    return bpe.round_trip_digests(read_table(spark, sf_dir, "documents"), BYTE_BPE)


@query()
def op6_main_text(spark, sf_dir):
    pages = read_table(spark, sf_dir, "pages")
    return regions.extracted(pages, regions.learned_weights(pages))


@query()
def op5_fair_toxicity(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    model = toxicity.fitted(docs, read_table(spark, sf_dir, "labels"))
    found = toxicity.scored(docs, model)
    return found.select(
        "doc_id", toxicity.held_out("doc_id").alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


@query(rf"""
with recursive dw as (select doc_id, coalesce(regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+'), []) as w from documents),
sh as (select distinct doc_id, md5(array_to_string(w[p:p + 3], ' ')) as s
 from (select doc_id, w, unnest(range(1, greatest(1, len(w) - 3) + 1)) as p from dw where len(w) > 0)),
size as (select doc_id, count(*) as n from sh group by doc_id),
common as (select a.doc_id as a, b.doc_id as b, count(*) as i from sh a join sh b on a.s = b.s and a.doc_id < b.doc_id group by 1, 2),
near as (select a, b from common join size x on x.doc_id = a join size y on y.doc_id = b where 100 * i >= 80 * (x.n + y.n - i)),
links as (select a, b from near union all select b, a from near),
reach as (select doc_id, doc_id as other from documents union select r.doc_id, l.b from reach r join links l on r.other = l.a),
named as (select doc_id, min(other) as component_id from reach group by doc_id)
select doc_id, coalesce(n, 0) as n_shingles, component_id, doc_id = component_id as kept from named left join size using (doc_id)
""")
def op4_tensor_minhash(spark, sf_dir):
    return tensor_minhash.near_duplicates(read_table(spark, sf_dir, "documents"))


@query()
def op7_deleted_interpolation(spark, sf_dir):
    return interpolation.scored(read_table(spark, sf_dir, "documents"))


@query("""
select conv_id, row_number() over (partition by conv_id order by turn) as position, turn, role, trim(text) as text,
 cast(0 as bigint) as n_quotes, cast(null as bigint) as reply_to, turn as thread, cast(0 as bigint) as depth
from conversations
""")
def op1_quotation_linking(spark, sf_dir):
    return quotation.linked_conversations(read_table(spark, sf_dir, "conversations"))


@query()
def op3_nn_descent(spark, sf_dir):
    vectors = read_table(spark, sf_dir, "embeddings")
    return nn_descent.nearest(vectors, vectors.filter("vec_id % 20 = 0"))


@query(rf"""
with recursive runs as (select distinct doc_id, w from (
 select doc_id, unnest(regexp_extract_all({LOWER}, '[a-zÀ-ÿ]+')) as w from documents)),
bits as (select doc_id, w, list_transform(range(8 * len(b)), lambda i: (b[i // 8 + 1] >> (i % 8)) & 1) as bits from (
 select doc_id, w, flatten(list_transform(string_split(concat(cast(doc_id as varchar), ':', w), ''),
  lambda c: case when unicode(c) < 128 then [unicode(c)::bigint] else [195::bigint, unicode(c)::bigint - 64] end)) as b from runs)),
sums as (select doc_id, w, xor(list_reduce([4294967295::bigint] || bits,
  lambda c, b: xor(c >> 1, (xor(c, b) & 1) * 3988292384)), 4294967295) as h from bits),
spelt as (select doc_id, w, case when h % 97 = 0
  then concat(left(w, cast(h % length(w) as int)), substr(w, cast(h % length(w) as int) + 2)) else w end as word from sums),
every as (select doc_id, unnest(regexp_extract_all({LOWER}, '[a-zÀ-ÿ]+')) as w from documents),
vocabulary as (select word, count(*) as n from every join spelt using (doc_id, w) where length(word) >= 5 group by word having count(*) >= 3),
places as (select word, n, unnest(range(length(word))) as p from vocabulary),
cut as (select word, n, concat(left(word, p), substr(word, p + 2)) as rest, concat(left(word, p), '*', substr(word, p + 2)) as pattern from places),
links as (select distinct a.word, b.word as other, b.n as other_n from cut a join cut b on a.pattern = b.pattern and a.word <> b.word
 union select distinct a.word, b.word, b.n from cut a join vocabulary b on a.rest = b.word
 union select distinct b.word, a.word, a.n from cut a join vocabulary b on a.rest = b.word),
best as (select word, count(*) as n_near, max(other_n) as most, arg_min(other, (-other_n, other)) as other from links group by word),
formed as (select v.word, v.n, coalesce(n_near, 0) as n_near, case when most >= 2 * v.n then other end as form,
 case when most >= 2 * v.n then most end as form_n from vocabulary v left join best using (word)),
walk as (select word, word as at, form as onward from formed
 union all select k.word, f.word, f.form from walk k join formed f on k.onward = f.word)
select formed.word, form, walk.at as root, n, n_near, form_n from formed join walk on walk.word = formed.word and walk.onward is null
""")
def op11_spelling_variants(spark, sf_dir):
    return spelling.spelling_variants(read_table(spark, sf_dir, "documents"), modulus=97)


def template_rows_sql() -> str:
    rows = [(i, text, label, exact) for i, (text, label, exact) in enumerate(
        [(t, l, True) for t, l in licenses.PHRASES.items()] + [(t, l, False) for t, l in licenses.NOTICES.items()]
    )]
    return ", ".join(f"({i}, '{text}', '{label}', {str(exact).lower()})" for i, text, label, exact in rows)


def words_sql(text: str) -> str:
    return rf"regexp_extract_all({text}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


GRAM, NOTICE_GRAM = licenses.PHRASE_GRAM, licenses.NOTICE_GRAM


@query(f"""
with t as (select id, label, exact, case when exact then {GRAM} else {NOTICE_GRAM} end as k, {words_sql(LOWER)} as w
 from (values {template_rows_sql()}) v(id, text, label, exact)),
marks as (select id, k, p, w[p + 1:p + k] as g from (select id, k, w, unnest(range(len(w) - k + 1)) as p from t)),
d as (select doc_id, coalesce({words_sql(LOWER)}, []) as w from documents),
places as (select doc_id, k, x, w[x + 1:x + k] as g from (
 select doc_id, k, w, unnest(range(len(w) - k + 1)) as x from d, (select distinct k from t) where len(w) >= k)),
hits as (select distinct doc_id, id, x, x - p as diagonal, p from places join marks using (k, g)),
steps as (select doc_id, id, diagonal, diagonal - lag(diagonal) over (partition by doc_id, id order by diagonal) as step
 from (select distinct doc_id, id, diagonal from hits)),
bands as (select doc_id, s.id, diagonal, sum(case when step <= case when exact then 0 else {licenses.NEIGHBOURS} end then 0 else 1 end)
 over (partition by doc_id, s.id order by diagonal) as band from steps s join t on s.id = t.id),
covered as (select doc_id, id, band, min(x) as start, list(p) as ps from hits join bands using (doc_id, id, diagonal) group by 1, 2, 3),
spans as (select doc_id, label, exact, start,
 len(list_distinct(flatten(list_transform(ps, lambda p: range(p, p + k)))))::double / len(w) as share from covered join t using (id)),
held as (select * from spans where share >= case when exact then 1.0 else {licenses.NEEDED} end),
found as (select doc_id, count(*) filter (where exact) as n_base, min(start) filter (where exact) as first_word,
 max(start) filter (where exact) as last_word, array_to_string(list_sort(list(distinct label) filter (where exact)), ',') as base_labels,
 array_to_string(list_sort(list(distinct label)), ',') as labels, max(share) as score from held group by doc_id)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_base, 0) as n_base, first_word, last_word,
 coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels, coalesce(score, 0.0::double) as score
from d left join found using (doc_id)
""")
def op12_license_scan(spark, sf_dir):
    return licenses.scanned(read_table(spark, sf_dir, "documents"), licenses.templates(spark))


def cluster_sql(rounds: int, clusters: int, seed: int) -> str:
    gap = "list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    steps = ["""v as (select vec_id, list_transform(embedding, lambda x: cast(floor(256 * x::double) as bigint)) as v from embeddings
 where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = 64)""", f"""
c0 as (select row_number() over (order by h) - 1 as cluster, v as c from (
 select v, sha256(concat('{seed}:', cast(vec_id as varchar))) as h from v order by h limit {clusters}))"""]
    for i in range(rounds + 1):
        steps.append(f"""
a{i} as materialized (select vec_id, arg_min(cluster, (gap, cluster)) as cluster, min(gap) as distance
 from (select vec_id, cluster, {gap} as gap from v, c{i}) group by vec_id)""")
        if i < rounds:
            steps.append(f"""
m{i} as (select cluster, d, sum(x) as s, count(*) as n from (
 select cluster, unnest(range(64)) as d, unnest(v) as x from a{i} join v using (vec_id)) group by cluster, d),
c{i + 1} as materialized (select cluster, coalesce(moved, c) as c from c{i} left join (
 select cluster, list((s - ((s % n) + n) % n) // n order by d) as moved from (
  select cluster, d, cast(s as bigint) as s, n from m{i}) group by cluster) using (cluster))""")
    return "with " + ",".join(steps) + f"""
select vec_id, cast(cluster as int) as cluster, cast(distance as bigint) as distance,
 cast(sum(distance) over (partition by cluster) as bigint) as cluster_inertia, cast(sum(distance) over () as bigint) as inertia,
 sha256(array_to_string(c, ',')) as centroid_sha256
from a{rounds} join c{rounds} using (cluster)"""


@query(cluster_sql(5, 40, 2))
def op13_walsh_clusters(spark, sf_dir):
    found = centroids.clustered(read_table(spark, sf_dir, "embeddings"), clusters=40, rounds=5, seed=2)
    return found.select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", centroids.digest().alias("centroid_sha256")
    )
