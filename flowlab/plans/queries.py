"""Registered queries: each operator over the driver's whole tables, with its SQL oracle."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from flowlab.functions import argmax_class, port_id, private_ip, softmax
from flowlab.operators import balance, clean, distinct, encode, evaluate, models, profile, scale, split, star
from flowlab.operators.approximate import knn_recall
from flowlab.operators.discriminant import (
    DiscriminantModel, class_means, lda_variance_ratio as variance_ratio, within_scatter,
)
from flowlab.operators.kinds import NUMBERS, merged_kinds
from flowlab.operators.neighbours import knn_classify as classify_neighbours
from flowlab.plans import layers
from flowlab.plans.settings import EtlSettings
from flowlab.plans.training import FlowPreparation, training_set as make_training_set
from flowlab.plans.views import (
    CAPTURES, CAPTURE_HEADERS, CAPTURE_NAMES, FLOWS, SCORED, SCORES, captures, flows, scored, sql, table,
    vectors, wide_vectors,
)
from flowlab.sources.captures import (
    capture_kinds, check_headers, header_groups, list_files, merge_by_name as merge_tables, read_flows,
)
from flowlab.sources.layers import load_mapping, read_layer, save_mapping, write_layer
from flowlab.storage import scratch_path


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    oracle: str | None


REGISTRY: dict[str, Query] = {}

FLOW_SQL = f"({sql(FLOWS)})"
CAPTURE_SQL = f"({sql(CAPTURES)})"
SCORED_SQL = f"({sql(SCORED)})"


def query(oracle: str | None = None, name: str | None = None) -> Callable:
    def register(run: Callable[[SparkSession, str], DataFrame]) -> Callable:
        REGISTRY[name or run.__name__] = Query(run, oracle)
        return run

    return register


def hash_order(key: str, seed: int = 2) -> str:
    return f"md5(concat_ws(':', cast({key} as varchar), '{seed}')), {key}"


# ---------------------------------------------------------------- sources and sinks


def written_captures(spark: SparkSession, sf_dir: str) -> str:
    """All captures as CSV files in one scratch directory, two periods of unlike column order."""
    directory = scratch_path(spark, "captures")
    df = captures(spark, sf_dir)
    late = F.coalesce(F.col("` Timestamp`") >= F.lit("1996-01-01").cast("timestamp_ntz"), F.lit(False))
    back = [f"`{c}`" for c in reversed(df.columns)]
    for part in (df.filter(~late), df.filter(late).select(*back)):
        # The writer would strip the blanks that lead the header names.
        part.write.mode("append").csv(directory, header=True, ignoreLeadingWhiteSpace=False)
    return directory


def capture_schema(spark: SparkSession, sf_dir: str) -> T.StructType:
    return captures(spark, sf_dir).schema


@query("""
select c_custkey as id, c_name as name, c_nationkey as nation, c_acctbal as balance from customer
union all select s_suppkey, s_name, s_nationkey, s_acctbal from supplier
union all select p_partkey, p_name, p_size, p_retailprice from part
""")
def merge_by_name(spark, sf_dir):
    """Three tables that list the same columns in different orders, one with a wider type."""
    customers = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey as id", "c_name as name", "c_nationkey as nation", "c_acctbal as balance"
    )
    suppliers = table(spark, sf_dir, "supplier").selectExpr(
        "s_acctbal as balance", "s_nationkey as nation", "s_name as name", "s_suppkey as id"
    )
    parts = table(spark, sf_dir, "part").selectExpr(
        "p_name as name", "p_retailprice as balance", "p_partkey as id", "cast(p_size as bigint) as nation"
    )
    return merge_tables([customers, suppliers, parts]).withColumn("nation", F.col("nation").cast("int"))


@query(f"select * replace (cast(flow_ts as varchar) as flow_ts) from {CAPTURE_SQL}")
def csv_merge(spark, sf_dir):
    df = read_flows(spark, written_captures(spark, sf_dir), capture_schema(spark, sf_dir))
    named = df.select(*[f"`{c}`" for c in CAPTURE_HEADERS]).toDF(*CAPTURE_NAMES)
    return named.withColumn("flow_ts", F.col("flow_ts").cast("string"))


@query(f"select * replace (cast(flow_ts as varchar) as flow_ts) from {CAPTURE_SQL}")
def csv_merge_inferred(spark, sf_dir):
    """The same captures without a schema: types come from the kinds of all values."""
    df = read_flows(spark, written_captures(spark, sf_dir)).select(*[f"`{c}`" for c in CAPTURE_HEADERS]).toDF(*CAPTURE_NAMES)
    return df.withColumns({"flow_ts": F.date_format("flow_ts", "yyyy-MM-dd HH:mm:ss"), "row_no": F.col("row_no").cast("long")})


@query(" union all ".join(
    f"""select '{header}' as column_name, cast(count({name}) as bigint) as filled,
 cast(count(*) - count({name}) as bigint) as missing, count(cast({name} as varchar)) > 0 and bool_and({name} is null or
 try_cast(cast({name} as varchar) as double) is not null) as is_number from {CAPTURE_SQL}"""
    for header, name in zip(CAPTURE_HEADERS, CAPTURE_NAMES)
))
def capture_types(spark, sf_dir):
    """What the files hold by column: filled and missing values, and whether the type that fits them all is a number."""
    files = list_files(spark, written_captures(spark, sf_dir))
    kinds = merged_kinds([capture_kinds(spark, {h: g}) for h, g in header_groups(spark, files).items()])
    filled = F.sum(F.when(F.col("kind") != "null", F.col("n")).otherwise(0)).alias("filled")
    missing = F.sum(F.when(F.col("kind") == "null", F.col("n")).otherwise(0)).alias("missing")
    number = F.bool_and(F.col("kind").isin("null", *NUMBERS)) & F.bool_or(F.col("kind").isin(*NUMBERS))
    return kinds.groupBy("column_name").agg(filled, missing, number.alias("is_number"))


@query(" union all ".join(
    f"select '{'|'.join(names)}' as header, true as found" for names in (CAPTURE_HEADERS, CAPTURE_HEADERS[::-1])
))
def header_check(spark, sf_dir):
    """The header lines of all files; how many files have each depends on the tasks that wrote them."""
    found = check_headers(spark, written_captures(spark, sf_dir))
    return found.select(F.concat_ws("|", "header").alias("header"), (F.col("files") > 0).alias("found"))


@query("select * replace (cast(o_orderdate as varchar) as o_orderdate) from orders")
def layer_round_trip(spark, sf_dir):
    path = write_layer(table(spark, sf_dir, "orders"), scratch_path(spark, "layer"), partition_by=["o_orderstatus"])
    return read_layer(spark, path).withColumn("o_orderdate", F.col("o_orderdate").cast("string"))


MAPPING_SQL = f"""
select label as value, cast(row_number() over (order by count(*) desc, label) - 1 as int) as "index"
from {FLOW_SQL} where label is not null group by label
"""


@query(MAPPING_SQL)
def mapping_round_trip(spark, sf_dir):
    mapping = encode.index_mappings(flows(spark, sf_dir), ["label"])["label"].table
    path = save_mapping(mapping, scratch_path(spark, "mapping"))
    return load_mapping(spark, path, mapping.schema)


# ---------------------------------------------------------------- projections and filters


@query(f"""
select row_no as "Unnamed:_0", flow_name as "Flow_ID", source_ip as "Source_IP", source_port as "Source_Port",
 destination_ip as "Destination_IP", destination_port as "Destination_Port", protocol as "Protocol",
 flow_ts as "Timestamp", flow_bytes_s as "Flow_Bytes/s", flow_packets_s as "Flow_Packets/s",
 const_col as "Bulk_Rate", similar_http as "SimilarHTTP", label as "Label"
from {CAPTURE_SQL}
""")
def clean_headers(spark, sf_dir):
    return clean.clean_headers(captures(spark, sf_dir))


@query(f"select flow_id, label, protocol, source_ip, source_port from {FLOW_SQL}")
def drop_columns(spark, sf_dir):
    return clean.drop_columns(flows(spark, sf_dir), ["flow_ts", "const_col", "flow_bytes_s", "no_such_column"])


@query(f"select flow_id, protocol, source_port from {FLOW_SQL} where protocol <> 0 and source_port <> 0")
def filter_nonzero(spark, sf_dir):
    kept = clean.filter_nonzero(flows(spark, sf_dir), ["protocol", "source_port"])
    return kept.select("flow_id", "protocol", "source_port")


@query(f"select flow_id, label from {FLOW_SQL} where label is not null and label not in ('5-LOW', '2-HIGH')")
def exclude_labels(spark, sf_dir):
    return clean.exclude_labels(flows(spark, sf_dir), "label", ["5-LOW", "2-HIGH"]).select("flow_id", "label")


PROFILED = ["flow_id", "flow_ts", "label", "protocol", "source_ip", "source_port", "flow_bytes_s", "const_col"]


@query(f"select flow_id, cast(flow_ts as varchar) as flow_ts, label, protocol, source_ip, source_port, flow_bytes_s from {FLOW_SQL}")
def drop_constant_columns(spark, sf_dir):
    left = clean.drop_constant_columns(flows(spark, sf_dir).select(*PROFILED))
    return left.withColumn("flow_ts", F.col("flow_ts").cast("string"))


@query(" union all ".join(
    f"select '{c}' as column_name, count(distinct {c}) = 1 as is_constant from {FLOW_SQL}" for c in PROFILED
))
def constant_profile(spark, sf_dir):
    return clean.constant_profile(flows(spark, sf_dir).select(*PROFILED))


# ---------------------------------------------------------------- scalar functions


@query(f"""
with f as {FLOW_SQL}, t as (select max(case when flow_bytes_s < cast('Infinity' as double) then flow_bytes_s end) as top from f)
select flow_id, case when flow_bytes_s is null or flow_bytes_s = cast('Infinity' as double) then top else flow_bytes_s end as flow_bytes_s
from f, t
""")
def fill_with_max(spark, sf_dir):
    df = flows(spark, sf_dir).select("flow_id", F.col("flow_bytes_s").cast("string"))
    return clean.fill_with_max(df, ["flow_bytes_s"])


@query(f"""
select max(case when flow_bytes_s < cast('Infinity' as double) then flow_bytes_s end) as flow_bytes_s,
 cast(max(source_port) as double) as source_port
from {FLOW_SQL}
""")
def max_finite(spark, sf_dir):
    return clean.max_finite(flows(spark, sf_dir), ["flow_bytes_s", "source_port"])


def ip_sql(column: str) -> str:
    first = f"try_cast(split_part({column}, '.', 1) as int)"
    second = f"try_cast(split_part({column}, '.', 2) as int)"
    return (
        f"case when {first} = 172 and {second} between 16 and 31 then 1 "
        f"when {first} = 192 and {second} = 168 then 1 else 0 end"
    )


def port_sql(column: str) -> str:
    return (
        f"case when {column} is null then null when {column} in (80, 443, 8080) then 1 "
        f"when {column} in (137, 138, 139, 445) then 2 when {column} = 22 then 3 when {column} = 21 then 4 "
        f"when {column} in (389, 3268) then 5 when {column} = 123 then 6 when {column} = 53 then 7 "
        f"when {column} = 88 then 8 when {column} = 465 then 9 when {column} = 135 then 10 "
        f"when {column} = 5353 then 11 else 0 end"
    )


@query(f"select flow_id, source_ip, {ip_sql('source_ip')} as is_private from {FLOW_SQL}")
def ip_class(spark, sf_dir):
    return flows(spark, sf_dir).select("flow_id", "source_ip", private_ip(F.col("source_ip")).alias("is_private"))


@query(f"select flow_id, source_port, {port_sql('source_port')} as port_id from {FLOW_SQL}", name="port_id")
def port_group(spark, sf_dir):
    return flows(spark, sf_dir).select("flow_id", "source_port", port_id(F.col("source_port")).alias("port_id"))



@query(f"""
select flow_id, cast(year(flow_ts) as int) as year, cast(month(flow_ts) as int) as month, cast(day(flow_ts) as int) as day
from {FLOW_SQL}
""")
def date_parts(spark, sf_dir):
    return star.date_parts(flows(spark, sf_dir).select("flow_id", "flow_ts"), "flow_ts").drop("flow_ts")


EXP_SUM = " + ".join(f"exp({s} - top)" for s in SCORES)


@query(f"""
with t as (select *, greatest({', '.join(SCORES)}) as top from {SCORED_SQL})
select row_id, {', '.join(f'round(exp({s} - top) / ({EXP_SUM}), 6) as p{i}' for i, s in enumerate(SCORES))} from t
""", name="softmax")
def scores_softmax(spark, sf_dir):
    df = scored(spark, sf_dir).select("row_id", softmax(F.array(*SCORES)).alias("p"))
    return df.select("row_id", *[F.round(F.get("p", F.lit(i)), 6).alias(f"p{i}") for i in range(len(SCORES))])



@query(f"""
with t as (select *, greatest({', '.join(SCORES)}) as top from {SCORED_SQL})
select row_id, case {' '.join(f'when {s} = top then {i}' for i, s in enumerate(SCORES))} end as best from t
""", name="argmax_class")
def scores_argmax(spark, sf_dir):
    return scored(spark, sf_dir).select("row_id", argmax_class(F.array(*SCORES)).alias("best"))



# ---------------------------------------------------------------- classes, balance, split


@query(f"select label, count(*) as n from {FLOW_SQL} group by label")
def class_counts(spark, sf_dir):
    return balance.class_counts(flows(spark, sf_dir), "label")


@query(f"select count(distinct label) as n_classes from {FLOW_SQL}")
def class_number(spark, sf_dir):
    return balance.class_number(flows(spark, sf_dir), "label")


@query(f"""
with f as (select * from {FLOW_SQL} where label is not null and label <> '5-LOW')
select label, min(n) as n_min from (select label, count(*) as n from f group by label)
group by label having min(n) = (select min(n) from (select count(*) as n from f group by label))
""")
def smallest_class(spark, sf_dir):
    counts = balance.class_counts(clean.exclude_labels(flows(spark, sf_dir), "label", ["5-LOW"]), "label")
    least = counts.agg(F.min("n")).scalar()
    return counts.filter(F.col("n") == least).select("label", F.col("n").alias("n_min"))


@query(f"""
with f as (select * from {FLOW_SQL} where label is not null and label <> '5-LOW'),
r as (select *, row_number() over (partition by label order by {hash_order('flow_id')}) as rn from f)
select flow_id, label, source_ip, flow_bytes_s from r
where rn <= (select min(n) from (select count(*) as n from f group by label))
""")
def balance_classes(spark, sf_dir):
    df = balance.balance_exact(flows(spark, sf_dir), "label", ["flow_id"], ["5-LOW"])
    return df.select("flow_id", "label", "source_ip", "flow_bytes_s")


@query(f"""
with f as (select * from {FLOW_SQL} where label is not null and label <> '5-LOW'),
c as (select label, count(*) as n from f group by label)
select flow_id, f.label from f join c on f.label = c.label
where cast(('0x' || substr(md5(concat_ws(':', cast(flow_id as varchar), '2')), 1, 13)) as bigint) / 4503599627370496.0::double
 < cast((select min(n) from c) as double) / n
""")
def balance_bernoulli(spark, sf_dir):
    df = balance.balance_bernoulli(flows(spark, sf_dir), "label", ["5-LOW"], key=["flow_id"])
    return df.select("flow_id", "label")


@query()
def balance_random(spark, sf_dir):
    return balance.balance_bernoulli(flows(spark, sf_dir), "label", ["5-LOW"]).select("flow_id", "label")


@query(f"select label, count(*) as n, true as expected from {FLOW_SQL} where label is not null and label <> '5-LOW' group by label")
def balance_random_sizes(spark, sf_dir):
    """Classes after a random balance without keys. ``expected``: the rows kept are within five standard deviations of
    the size of the smallest class."""
    df = flows(spark, sf_dir)
    kept = balance.balance_bernoulli(df, "label", ["5-LOW"]).groupBy("label").agg(F.count("*").alias("kept"))
    whole = df.filter("label <> '5-LOW'").groupBy("label").agg(F.count("*").alias("n"))
    least = F.min("n").over(Window.partitionBy())  # a row for each class
    both = whole.join(kept, "label", "left").withColumn("least", least)
    spread = F.sqrt(F.col("least") * (1 - F.col("least") / F.col("n")))
    near = F.abs(F.coalesce("kept", F.lit(0)) - F.col("least")) <= 5 * spread
    return both.select("label", "n", near.alias("expected"))


@query(f"""
select event_id, event_type,
 row_number() over (partition by event_type order by {hash_order('event_id')})
 <= round(count(*) over (partition by event_type) * cast(0.15 as double)) as is_test
from events
""")
def stratified_split(spark, sf_dir):
    df = table(spark, sf_dir, "events").select("event_id", "event_type")
    return split.stratified_split(df, "event_type", ["event_id"])


@query(f"""
select event_id, event_type,
 cast(ntile(5) over (partition by event_type order by {hash_order('event_id')}) - 1 as int) as fold
from events
""")
def stratified_kfold(spark, sf_dir):
    df = table(spark, sf_dir, "events").select("event_id", "event_type")
    return split.stratified_kfold(df, "event_type", ["event_id"], k=5)


# ---------------------------------------------------------------- indexes and star schema


@query(f"select distinct protocol from {FLOW_SQL}")
def distinct_values(spark, sf_dir):
    return encode.distinct_values(flows(spark, sf_dir), "protocol")


def index_sql(source: str, column: str) -> str:
    return (
        f"select {column} as value, cast(row_number() over (order by count(*) desc, cast({column} as varchar)) - 1 as int) as idx "
        f"from {source} where {column} is not null group by {column}"
    )


@query(f"""
with f as {FLOW_SQL}, l as ({index_sql('f', 'label')}), p as ({index_sql('f', 'protocol')})
select flow_id, l.idx as label_index, p.idx as protocol_index from f join l on f.label = l.value join p on f.protocol = p.value
""")
def string_index(spark, sf_dir):
    df = flows(spark, sf_dir).select("flow_id", "label", "protocol")
    return encode.string_index(df, [("label", "label_index"), ("protocol", "protocol_index")])[0]


@query(f"""
with f as {FLOW_SQL}, m as ({index_sql("(select * from f where source_port <> 80)", 'source_port')})
select flow_id, source_port, coalesce(m.idx, cast((select count(*) from m) as int)) as port_index
from f left join m on f.source_port = m.value
""")
def index_lookup(spark, sf_dir):
    df = flows(spark, sf_dir).select("flow_id", "source_port")
    seen = df.filter("source_port <> 80")
    mapping = encode.index_mappings(seen, ["source_port"])["source_port"]
    return encode.apply_index(df, "source_port", "port_index", mapping, invalid="keep", drop=False)


STAR = {
    "time": ["year", "month", "day"],
    "packet": ["flow_id", "flow_bytes_s"],
    "source": ["source_ip", "source_port"],
    "destination": ["destination_ip", "destination_port"],
}


def star_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = captures(spark, sf_dir).toDF(*CAPTURE_NAMES).withColumnRenamed("row_no", "flow_id")
    kept = df.select(
        "flow_id", "flow_ts", "flow_bytes_s", "source_ip", "source_port", "destination_ip", "destination_port",
        "protocol", "label",
    )
    return star.date_parts(kept, "flow_ts").drop("flow_ts")


@query(f"""
select distinct md5(concat(
  case when source_ip is null then '-' else concat(length(source_ip), ':', source_ip) end,
  case when source_port is null then '-' else concat(length(cast(source_port as varchar)), ':', source_port) end)) as source_id,
 source_ip, source_port
from {CAPTURE_SQL}
""")
def star_dimensions(spark, sf_dir):
    return star.star_dimensions(star_rows(spark, sf_dir), STAR)["source"]


@query(f"""
select row_no as flow_id, flow_bytes_s, source_ip, source_port, destination_ip, destination_port, protocol, label,
 cast(year(flow_ts) as int) as year, cast(month(flow_ts) as int) as month, cast(day(flow_ts) as int) as day
from {CAPTURE_SQL}
""")
def star_join(spark, sf_dir):
    df = star_rows(spark, sf_dir)
    stored = star.store_star(df, STAR)
    return star.star_join(stored.fact, stored.dimensions).drop(*[f"{name}_id" for name in STAR])


# ---------------------------------------------------------------- profiles


@query(f"""
select label, count(*) as n, round(count(*) * 100.0::double / (select count(*) from {FLOW_SQL} where label is not null), 6) as share
from {FLOW_SQL} where label is not null group by label
""")
def class_share(spark, sf_dir):
    return profile.class_share(flows(spark, sf_dir), "label").withColumn("share", F.round("share", 6))


@query(" union all ".join(
    f"select '{c}' as column_name, cast({c} as varchar) as value, count(*) as n from {FLOW_SQL} where {c} is not null group by {c}"
    for c in ["label", "source_ip", "flow_ts"]
))
def value_counts(spark, sf_dir):
    return profile.value_counts(flows(spark, sf_dir))


DISTINCT_SQL = " union all ".join(
    f"select '{c}' as column_name, count(distinct {c}) as n from {CAPTURE_SQL}" for c in CAPTURE_NAMES
)


@query(DISTINCT_SQL)
def distinct_counts(spark, sf_dir):
    return distinct.distinct_counts(captures(spark, sf_dir).toDF(*CAPTURE_NAMES))


@query(f"select column_name, n, (select count(*) from {CAPTURE_SQL}) as n_rows, true as close from ({DISTINCT_SQL})")
def distinct_sketches(spark, sf_dir):
    """Two snapshots are sketched and stored; the counts of both together come from the stored sketches alone.
    ``close``: the estimate is within 5 % of the exact count, four standard errors."""
    df = captures(spark, sf_dir).toDF(*CAPTURE_NAMES)
    folder = scratch_path(spark, "sketches")
    late = F.coalesce(F.col("flow_ts") >= F.lit("1996-01-01").cast("timestamp_ntz"), F.lit(False))
    for name, part in (("early", df.filter(~late)), ("late", df.filter(late))):
        distinct.record_snapshot(part, folder, name)
    found = distinct.counts_so_far(spark, folder).withColumnRenamed("n", "estimate")
    both = distinct.distinct_counts(df).join(found, "column_name")
    return both.select("column_name", "n", "n_rows", (F.abs(F.col("estimate") - F.col("n")) <= 0.05 * F.col("n")).alias("close"))


MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def histogram_sql(column: str) -> str:
    return f"""
select '{column}' as column_name, cast(b.bin as int) as bin, round(lo + (hi - lo) * b.bin / 30, 6) as lower,
 round(lo + (hi - lo) * (b.bin + 1) / 30, 6) as upper, count(x) as n
from (select min({column}) as lo, max({column}) as hi from lineitem) r
cross join (select unnest(range(30)) as bin) b
left join (select {column} as x, least(floor(({column} - (select min({column}) from lineitem))
 / ((select max({column}) from lineitem) - (select min({column}) from lineitem)) * 30), 29) as xb from lineitem) v on v.xb = b.bin
group by 1, 2, 3, 4"""


@query(" union all ".join(histogram_sql(c) for c in MEASURES))
def histogram(spark, sf_dir):
    df = profile.histogram(table(spark, sf_dir, "lineitem").select(*MEASURES))
    return df.withColumns({c: F.round(c, 6) for c in ("lower", "upper")})


@query(" union all ".join(
    f"select '{a}' as column_a, '{b}' as column_b, round(corr({a}, {b}), 6) as corr from lineitem"
    for a in MEASURES for b in MEASURES
))
def corr_matrix(spark, sf_dir):
    df = profile.corr_matrix(table(spark, sf_dir, "lineitem"), MEASURES)
    return df.withColumn("corr", F.round("corr", 6))


@query("""
with v as (select vec_id, unnest(range(64)) as i, unnest(embedding)::double as x from embeddings)
select 'e' || a.i as column_a, 'e' || b.i as column_b, round(corr(a.x, b.x), 6) as corr
from v a join v b on a.vec_id = b.vec_id group by 1, 2
""")
def corr_matrix_wide(spark, sf_dir):
    df = wide_vectors(spark, sf_dir).drop("vec_id", "label")
    return profile.corr_matrix(df).withColumn("corr", F.round("corr", 6))


# ---------------------------------------------------------------- features


@query(" union all ".join(
    f"select '{c}' as column_name, cast(min({c}) as double) as lower, cast(max({c}) as double) as upper from lineitem"
    for c in MEASURES
))
def column_ranges(spark, sf_dir):
    return scale.column_ranges(table(spark, sf_dir, "lineitem"), MEASURES)


@query(f"""
with r as (select {', '.join(f'min({c}) as lo_{c}, max({c}) as hi_{c}' for c in MEASURES)} from lineitem)
select l_orderkey, l_linenumber, {', '.join(f'round(({c} - lo_{c}) / (hi_{c} - lo_{c}), 6) as {c}' for c in MEASURES)}
from lineitem, r
""")
def minmax_scale(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *MEASURES)
    scaled = scale.minmax_scale(df, ["l_orderkey", "l_linenumber"])
    return scaled.withColumns({c: F.round(c, 6) for c in MEASURES})


@query("""
with v as (select label, unnest(range(64)) as dim, unnest(embedding)::double as x from embeddings)
select label, cast(dim as int) as dim, count(*) as n,
 round(count(*)::double / (select count(*) from embeddings), 6) as prior, round(avg(x), 6) as mean
from v group by label, dim
""")
def lda_class_means(spark, sf_dir):
    df = wide_vectors(spark, sf_dir)
    means = class_means(df, [c for c in df.columns if c.startswith("e")], "label")
    return means.select(
        "label", "n", F.round("prior", 6).alias("prior"), F.posexplode("means").alias("dim", "mean")
    ).withColumn("mean", F.round("mean", 6))


@query("""
with v as (select vec_id, label, unnest(range(len(embedding))) as d, unnest(embedding)::double as x from embeddings),
c as (select vec_id, d, x - avg(x) over (partition by label, d) as x from v)
select cast(a.d as int) as i, cast(b.d as int) as j, round(sum(a.x * b.x), 6) as v
from c a join c b on a.vec_id = b.vec_id and a.d <= b.d group by a.d, b.d
""")
def lda_scatter(spark, sf_dir):
    """Within-class scatter, cell by cell."""
    df = wide_vectors(spark, sf_dir).drop("vec_id")
    return within_scatter(df, [c for c in df.columns if c != "label"], "label").withColumn("v", F.round("v", 6))


@query()
def lda_variance_ratio(spark, sf_dir):
    return variance_ratio(wide_vectors(spark, sf_dir).drop("vec_id"), "label")


@query("select cast(k as int) as k, true as falls from (select unnest(range(1, count(distinct label))) as k from embeddings)")
def lda_variance_steps(spark, sf_dir):
    """One row a component. ``falls``: it adds no more than the one before, and all together explain everything."""
    rows = variance_ratio(wide_vectors(spark, sf_dir).drop("vec_id"), "label").orderBy("k").collect()  # a row a component
    steps = [b - a for a, b in zip([0.0, *(r.ratio for r in rows)], (r.ratio for r in rows))]
    whole = bool(rows) and abs(rows[-1].ratio - 1) < 1e-9
    found = [(r.k, whole and step >= 0 and (i == 0 or step <= steps[i - 1] + 1e-12)) for i, (r, step) in enumerate(zip(rows, steps))]
    return spark.createDataFrame(found, "k int, falls boolean")


def within_covariance(df: DataFrame, components: list[str], target: str) -> DataFrame:
    """``i, j, v``: pooled covariance of the components within the classes; a discriminant makes it the identity."""
    pairs = [(i, j) for i in range(len(components)) for j in range(i, len(components))]
    by_class = df.groupBy(target).agg(
        F.count("*").alias("n"), *[F.covar_pop(components[i], components[j]).alias(f"{i}-{j}") for i, j in pairs]
    )
    free = F.sum("n") - F.count("*")
    row = by_class.agg(*[(F.sum(F.col("n") * F.col(f"`{i}-{j}`")) / free).alias(f"{i}-{j}") for i, j in pairs])
    cells = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), (F.round(f"`{i}-{j}`", 6) + F.lit(0.0)).alias("v")) for i, j in pairs])
    return row.select(F.inline(cells))


def identity_sql(size: int) -> str:
    return (
        f"select cast(i as int) as i, cast(j as int) as j, case when i = j then 1.0::double else 0.0::double end as v "
        f"from (select unnest(range({size})) as i) a, (select unnest(range({size})) as j) b where i <= j"
    )


@query(identity_sql(6))
def lda_whitened(spark, sf_dir):
    """The reduced rows of the whole table have unit spread within their classes."""
    return within_covariance(lda_transform(spark, sf_dir), [f"c{i}" for i in range(6)], "label")


@query()
def lda_transform(spark, sf_dir):
    df = wide_vectors(spark, sf_dir)
    features = [c for c in df.columns if c.startswith("e")]
    return DiscriminantModel.fit(df, "label", features).transform(df, 6)


# ---------------------------------------------------------------- models


NEIGHBOUR_SQL = f"""
with m as (select vec_id, label, embedding::double[] as e,
  row_number() over (partition by label order by {hash_order('vec_id')}) as rn, count(*) over (partition by label) as n
 from embeddings),
q as (select * from m where rn <= round(n * cast(0.15 as double))),
t as (select * from m where rn > round(n * cast(0.15 as double))),
d as (select q.vec_id, t.label, row_number() over (partition by q.vec_id order by list_distance(q.e, t.e), t.vec_id) as place
 from q, t),
v as (select vec_id, label, count(*) as n from d where place <= 7 group by 1, 2)
select vec_id, label as prediction from v
qualify row_number() over (partition by vec_id order by n desc, label) = 1
"""


@query(NEIGHBOUR_SQL)
def knn_classify(spark, sf_dir):
    train, test = split.train_test(vectors(spark, sf_dir), "label", ["vec_id"])
    return classify_neighbours(train, test, "embedding", "label", "vec_id", k=7)


@query(NEIGHBOUR_SQL)
def knn_classify_cells(spark, sf_dir):
    train, test = split.train_test(vectors(spark, sf_dir), "label", ["vec_id"])
    return classify_neighbours(train, test, "embedding", "label", "vec_id", k=7, broadcast_bytes=0)


@query(f"""
with q as (select vec_id, row_number() over (partition by label order by {hash_order('vec_id')}) as rn, count(*) over (partition by label) as n
 from embeddings)
select vec_id, 7 as n_found, true as enough from q where rn <= round(n * cast(0.15 as double))
""")
def knn_approximate(spark, sf_dir):
    """Every query with the number of neighbours found; ``enough``: over all queries at least nine in ten of them are
    those that the exact search finds."""
    train, test = split.train_test(vectors(spark, sf_dir), "label", ["vec_id"])
    found = knn_recall(train, test, "embedding", "label", "vec_id", k=7)
    found = read_layer(spark, write_layer(found, scratch_path(spark, "recall")))
    share = found.agg(F.sum("n_right") / F.sum("n_exact")).first()[0]
    return found.select("vec_id", F.col("n_found").cast("int").alias("n_found"), F.lit(share >= 0.9).alias("enough"))


REDUCED = [f"c{i}" for i in range(6)]


def reduced_split(spark: SparkSession, sf_dir: str, df: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Six discriminant components of the vectors, fitted on the training side only.

    The reduced rows are written like any training set: trainers read them many times.
    """
    df = wide_vectors(spark, sf_dir) if df is None else df
    marked = split.stratified_split(df, "label", ["vec_id"])
    model = DiscriminantModel.fit(marked.filter("not is_test"), "label", [c for c in df.columns if c.startswith("e")])
    path = write_layer(model.transform(marked, 6), scratch_path(spark, "training"))
    reduced = read_layer(spark, path)
    return reduced.filter("not is_test"), reduced.filter("is_test")


SECTORS = 8


def sectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vectors with a label that can be learnt: which of their first components is the largest. (The labels of the
    table itself are drawn at random; no model can beat the majority class there.)"""
    first = F.array(*[f"e{i}" for i in range(SECTORS)])
    df = wide_vectors(spark, sf_dir)
    return df.withColumn("label", (F.array_position(first, F.array_max(first)) - 1).cast("int"))


HELD_OUT_SQL = f"""
with s as (select vec_id, cast(list_position(embedding[1:{SECTORS}], list_max(embedding[1:{SECTORS}])) - 1 as int) as label from embeddings),
m as (select *, row_number() over (partition by label order by {hash_order('vec_id')}) as rn, count(*) over (partition by label) as n from s),
t as (select * from m where rn <= round(n * cast(0.15 as double))),
c as (select max(k) as k, sum(k) as total from (select count(*) as k from t group by label))
select vec_id, label, round(k::double / total, 6) as majority, true as better from t, c
"""


def held_out_scores(model, test: DataFrame) -> DataFrame:
    """Every held-out row with the share of the most frequent class, and whether the model's accuracy is at least one
    and a half times as large."""
    found = models.score(model, test).select("vec_id", "label", "prediction")
    by_class = found.groupBy("label").agg(
        F.count("*").alias("n"), F.count_if(F.col("label") == F.col("prediction")).alias("right")
    ).collect()  # a row for each class
    total = sum(r.n for r in by_class)
    majority, accuracy = max(r.n for r in by_class) / total, sum(r.right for r in by_class) / total
    return found.select(
        "vec_id", "label", F.round(F.lit(majority), 6).alias("majority"), F.lit(accuracy >= 1.5 * majority).alias("better")
    )


@query(HELD_OUT_SQL)
def train_boosted(spark, sf_dir):
    """All default settings: 211 rounds, depth 8."""
    train, test = reduced_split(spark, sf_dir, sectors(spark, sf_dir))
    return held_out_scores(models.train_boosted(train, REDUCED, "label"), test)


def train_shape(shape: str, steps: int) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark, sf_dir):
        train, test = reduced_split(spark, sf_dir, sectors(spark, sf_dir))
        return held_out_scores(models.train_mlp(train, REDUCED, "label", shape, steps), test)

    return run


train_mlp = query(HELD_OUT_SQL, "train_mlp")(train_shape("NN_02", 100))
train_net_01 = query(HELD_OUT_SQL, "train_net_01")(train_shape("NN_01", 100))
train_net_03 = query(HELD_OUT_SQL, "train_net_03")(train_shape("NN_03", 100))
train_net_04 = query(HELD_OUT_SQL, "train_net_04")(train_shape("NN_04", 100))


@query()
def tune_boosted(spark, sf_dir):
    """The operator's own ranges, four settings; each fold fits its own reducer on its training rows."""
    df = sectors(spark, sf_dir)
    inputs = [c for c in df.columns if c.startswith("e")]
    path = write_layer(split.stratified_kfold(df, "label", ["vec_id"], k=3), scratch_path(spark, "training"))

    def prepare(train: DataFrame):
        reducer = DiscriminantModel.fit(train, "label", inputs)
        return lambda rows: reducer.transform(rows, 6)

    return models.tune_boosted(read_layer(spark, path), REDUCED, "label", "fold", k=3, trials=4, prepare=prepare)


# ---------------------------------------------------------------- evaluation


@query(f"select round(avg(case when label = pred then 100.0::double else 0 end), 6) as accuracy from {SCORED_SQL}")
def accuracy(spark, sf_dir):
    return evaluate.accuracy(scored(spark, sf_dir), "label", "pred").select(F.round("accuracy", 6).alias("accuracy"))


@query(f"""
with s as {SCORED_SQL}, c as (select label, pred, count(*) as n from s group by 1, 2),
k as (select distinct label as class from c union select distinct pred from c),
p as (select class, coalesce(sum(n) filter (where label = class), 0) as support, coalesce(sum(n) filter (where pred = class), 0) as predicted,
  coalesce(sum(n) filter (where label = class and pred = class), 0) as hits from k, c group by class),
r as (select *, case when predicted = 0 then 0 else hits::double / predicted end as precision, case when support = 0 then 0 else hits::double / support end as recall from p),
f as (select *, case when precision + recall = 0 then 0 else 2 * precision * recall / (precision + recall) end as f1 from r)
select cast(class as varchar) as name, round(precision, 6) as precision, round(recall, 6) as recall, round(f1, 6) as f1, cast(support as bigint) as support from f
union all select 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), cast(sum(support) as bigint) from f
union all select 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
 round(sum(f1 * support) / sum(support), 6), cast(sum(support) as bigint) from f
union all select 'accuracy', round(sum(hits)::double / sum(support), 6), round(sum(hits)::double / sum(support), 6),
 round(sum(hits)::double / sum(support), 6), cast(sum(support) as bigint) from f
""")
def classification_report(spark, sf_dir):
    df = evaluate.classification_report(scored(spark, sf_dir), "label", "pred")
    return df.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})


@query(f"""
with s as (select case when row_id % 41 = 0 then null else label end as label,
  case when row_id % 43 = 0 then null when row_id % 47 = 0 then 7 else pred end as pred from {SCORED_SQL})
select label, {', '.join(f'count(*) filter (where pred = {i}) as pred_{i}' for i in range(5))},
 count(*) filter (where pred is null or pred not between 0 and 4) as pred_other from s group by label
""")
def confusion_matrix(spark, sf_dir):
    """Some labels and predictions are unknown and some predictions are no class."""
    df = scored(spark, sf_dir).selectExpr(
        "case when row_id % 41 = 0 then null else label end as label",
        "case when row_id % 43 = 0 then null when row_id % 47 = 0 then 7 else pred end as pred",
    )
    return evaluate.confusion_matrix(df, "label", "pred", range(5))


@query(f"select label, pred, count(*) as n from {SCORED_SQL} group by label, pred")
def confusion_counts(spark, sf_dir):
    return evaluate.confusion_counts(scored(spark, sf_dir), "label", "pred")


@query(f"""
with t as (select *, greatest({', '.join(SCORES)}) as top from {SCORED_SQL})
select round(avg(top + ln({EXP_SUM}) - case label {' '.join(f'when {i} then {s}' for i, s in enumerate(SCORES))} end), 6) as log_loss from t
""")
def log_loss(spark, sf_dir):
    return evaluate.log_loss(scored(spark, sf_dir), "label", SCORES).select(F.round("log_loss", 6).alias("log_loss"))


CURVE_SQL = f"""
with u as ({' union all '.join(f'select {i} as class, {s} as threshold, case when label = {i} then 1 else 0 end as hit from {SCORED_SQL}' for i, s in enumerate(SCORES))}),
g as (select class, threshold, sum(hit) as pos, sum(1 - hit) as neg from u group by 1, 2),
c as (select class, threshold, sum(pos) over w as tp, sum(neg) over w as fp,
  sum(pos) over (partition by class) as p, sum(neg) over (partition by class) as n
 from g window w as (partition by class order by threshold desc rows unbounded preceding))
"""


@query(f"{CURVE_SQL} select class, threshold, round(tp::double / (tp + fp), 6) as precision, round(tp::double / p, 6) as recall from c")
def pr_curve(spark, sf_dir):
    df = evaluate.pr_curve(scored(spark, sf_dir), "label", SCORES)
    return df.withColumns({c: F.round(c, 6) for c in ("precision", "recall")})


@query(f"{CURVE_SQL} select class, threshold, round(fp::double / n, 6) as fpr, round(tp::double / p, 6) as tpr from c")
def roc_curve(spark, sf_dir):
    df = evaluate.roc_curve(scored(spark, sf_dir), "label", SCORES)
    return df.withColumns({c: F.round(c, 6) for c in ("fpr", "tpr")})


@query(f"""
with f as (select label, pred, ntile(5) over (partition by label order by {hash_order('row_id')}) as fold from {SCORED_SQL})
select round(avg(a), 6) as mean_accuracy from (select fold, avg(case when label = pred then 100.0::double else 0 end) as a from f group by fold)
""")
def mean_cv_score(spark, sf_dir):
    folds = split.stratified_kfold(scored(spark, sf_dir), "label", ["row_id"], k=5)
    df = evaluate.mean_cv_score(folds, "label", "pred", "fold")
    return df.select(F.round("mean_accuracy", 6).alias("mean_accuracy"))


# ---------------------------------------------------------------- layers


SETTINGS = EtlSettings(ignore_labels=("5-LOW",), balance_key=("Unnamed: 0",), components=3)

RAW_SQL = f"""
with f as (select * from {CAPTURE_SQL} where label is not null and label <> '5-LOW'),
r as (select *, row_number() over (partition by label order by {hash_order('row_no')}) as rn from f)
select row_no, flow_name, source_ip, source_port, destination_ip, destination_port, protocol, flow_ts, flow_bytes_s,
 flow_packets_s, const_col, label
from r where rn <= (select min(n) from (select count(*) as n from f group by label))
"""


def staged_sql(source: str) -> str:
    inf = "cast('Infinity' as double)"
    return f"""
with z as (select * from {source} where protocol <> 0),
t as (select max(case when flow_bytes_s < {inf} then flow_bytes_s end) as top_b,
 max(case when flow_packets_s < {inf} then flow_packets_s end) as top_p from z)
select source_ip, source_port, destination_ip, destination_port, protocol,
 case when flow_bytes_s is null or flow_bytes_s = {inf} then top_b else flow_bytes_s end as flow_bytes_s,
 case when flow_packets_s is null or flow_packets_s = {inf} then top_p else flow_packets_s end as flow_packets_s,
 const_col, label
from z, t"""


def business_sql(source: str) -> str:
    return f"""
with s as ({source}), l as ({index_sql('s', 'label')}), p as ({index_sql('s', 'protocol')})
select {ip_sql('source_ip')} as "Source_IP", {port_sql('source_port')} as "Source_Port",
 {ip_sql('destination_ip')} as "Destination_IP", {port_sql('destination_port')} as "Destination_Port",
 flow_bytes_s as "Flow_Bytes/s", flow_packets_s as "Flow_Packets/s", p.idx as "Protocal_Index", l.idx as "Label_Index"
from s join l on s.label = l.value join p on s.protocol = p.value"""


STAGED_NAMES = """source_ip as "Source_IP", source_port as "Source_Port", destination_ip as "Destination_IP",
 destination_port as "Destination_Port", protocol as "Protocol", flow_bytes_s as "Flow_Bytes/s",
 flow_packets_s as "Flow_Packets/s", label as "Label" """


def raw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The captures under clean headers, not balanced."""
    return layers.raw_layer(captures(spark, sf_dir), drop=SETTINGS.raw_drop)


def staged_rows(spark: SparkSession, sf_dir: str, drop_constants: bool = True) -> DataFrame:
    return layers.staging_layer(
        raw_rows(spark, sf_dir), SETTINGS.filter_columns, SETTINGS.staging_drop, SETTINGS.fill_max, drop_constants
    )


@query(f"""
select row_no as "Unnamed:_0", flow_name as "Flow_ID", source_ip as "Source_IP", source_port as "Source_Port",
 destination_ip as "Destination_IP", destination_port as "Destination_Port", protocol as "Protocol",
 flow_ts as "Timestamp", flow_bytes_s as "Flow_Bytes/s", flow_packets_s as "Flow_Packets/s",
 const_col as "Bulk_Rate", label as "Label"
from ({RAW_SQL})
""")
def raw_layer(spark, sf_dir):
    s = SETTINGS
    return layers.raw_layer(captures(spark, sf_dir), s.target, s.ignore_labels, s.raw_drop, s.balance_key, s.seed)


@query(f"select {STAGED_NAMES} from ({staged_sql(CAPTURE_SQL)})")
def staging_layer(spark, sf_dir):
    return staged_rows(spark, sf_dir)


@query(f"""select {STAGED_NAMES}, const_col as "Bulk_Rate" from ({staged_sql(CAPTURE_SQL)})""")
def cloud_staging_layer(spark, sf_dir):
    return staged_rows(spark, sf_dir, drop_constants=False)


@query(business_sql(staged_sql(CAPTURE_SQL)))
def business_layer(spark, sf_dir):
    s = SETTINGS
    df = staged_rows(spark, sf_dir)
    return layers.business_layer(df, s.ip_columns, s.index_columns, s.ports, s.port_columns)[0]


@query(f"""
with s as {CAPTURE_SQL}, l as ({index_sql('s', 'label')}),
k as (select * from s where protocol <> 0), p as ({index_sql('k', 'protocol')})
select k.row_no as "Unnamed:_0", {ip_sql('source_ip')} as "Source_IP", {port_sql('source_port')} as "Source_Port",
 {ip_sql('destination_ip')} as "Destination_IP", {port_sql('destination_port')} as "Destination_Port",
 p.idx as "Protocal_Index", l.idx as "Label_Index"
from k join l on k.label = l.value join p on k.protocol = p.value
""")
def cloud_business_layer(spark, sf_dir):
    df = raw_rows(spark, sf_dir).drop("Flow_ID", "Timestamp", "Flow_Bytes/s", "Flow_Packets/s", "Bulk_Rate")
    return layers.cloud_business_layer(df)


@query(business_sql(staged_sql(f"({RAW_SQL})")))
def run_etl(spark, sf_dir):
    settings = replace(SETTINGS, schema=capture_schema(spark, sf_dir))
    paths = layers.run_etl(spark, written_captures(spark, sf_dir), scratch_path(spark, "layers"), settings)
    return read_layer(spark, paths["business"])


@query()
def training_set(spark, sf_dir):
    s = SETTINGS
    business = layers.business_layer(
        staged_rows(spark, sf_dir), s.ip_columns, s.index_columns, s.ports, s.port_columns
    )[0]
    return make_training_set(business, s.label_index, s.categorical, s.components)[0]


@query(identity_sql(3))
def training_set_whitened(spark, sf_dir):
    """The components of the training set have unit spread within its classes."""
    df = training_set(spark, sf_dir)
    return within_covariance(df, [c for c in df.columns if c != SETTINGS.label_index], SETTINGS.label_index)


@query(f"select row_no as \"Unnamed:_0\", true as known, true as same from {CAPTURE_SQL}")
def predict_flows(spark, sf_dir):
    """Unlabelled captures scored by the default net, trained on the labelled ones, by one saved pipeline. ``known``: the
    prediction is one of the classes; ``same``: the models that were not written and read again predict it, too."""
    labelled = captures(spark, sf_dir)
    prepared, train = FlowPreparation.fit(layers.raw_layer(labelled, drop=SETTINGS.raw_drop), SETTINGS)
    path = scratch_path(spark, "prepared")
    train = read_layer(spark, write_layer(train, f"{path}/training"))
    model = models.train_mlp(train, prepared.features, SETTINGS.label_index)
    prepared.scorer(model, ["Unnamed:_0"]).write().save(f"{path}/scorer")
    flows_only = labelled.drop(" Label")
    scores = models.score(PipelineModel.load(f"{path}/scorer"), flows_only)
    before = prepared.predict(model, flows_only, keep=["Unnamed:_0"]).select("`Unnamed:_0`", F.col("prediction").alias("before"))
    classes = models.class_total(train, SETTINGS.label_index)
    both = scores.join(before, "Unnamed:_0")
    return both.select(
        "`Unnamed:_0`", F.col("prediction").between(0, classes - 1).alias("known"), (F.col("prediction") == F.col("before")).alias("same")
    )


# ---------------------------------------------------------------- flagship


@query(f"""
with f as (select * from {FLOW_SQL} where protocol <> 0), l as ({index_sql('f', 'label')})
select l.idx as label_index, {ip_sql('source_ip')} as is_private, {port_sql('source_port')} as port_id, count(*) as n
from f join l on f.label = l.value group by 1, 2, 3
""")
def flow_summary(spark, sf_dir):
    """Flows per label index, private flag and service."""
    df = clean.filter_nonzero(flows(spark, sf_dir), ["protocol"])
    indexed, _ = encode.string_index(df, [("label", "label_index")])
    return indexed.groupBy(
        "label_index",
        private_ip(F.col("source_ip")).alias("is_private"),
        port_id(F.col("source_port")).alias("port_id"),
    ).agg(F.count(F.lit(1)).alias("n"))
