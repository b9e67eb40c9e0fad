"""Raw, staging and business layers, and the run that writes all three."""

from __future__ import annotations

import json
from collections.abc import Collection, Mapping, Sequence
from dataclasses import replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession

from flowlab.functions.names import clean_name, quoted
from flowlab.functions.network import PORT_GROUPS, port_id, private_ip
from flowlab.operators.balance import balance_bernoulli, balance_exact
from flowlab.operators.clean import FillProfile, clean_headers, drop_columns, filter_nonzero, nonzero_test
from flowlab.operators.encode import IndexMapping, apply_index, index_mappings
from flowlab.plans.settings import EtlSettings
from flowlab.sources.captures import read_flows
from flowlab.sources.layers import read_layer, save_mapping, write_layer


def raw_layer(
    df: DataFrame,
    target: str | None = None,
    ignore: Sequence = (),
    drop: Sequence[str] = (),
    key: Sequence[str] | None = None,
    seed: int = 2,
) -> DataFrame:
    """Balance the classes if there is a target, clean the headers, drop columns (clean names)."""
    if target is not None:
        if key is None:
            df = balance_bernoulli(df, target, ignore, seed)
        else:
            df = balance_exact(df, target, key, ignore, seed)
    return drop_columns(clean_headers(df), drop)


def staging_rows(df: DataFrame, filter_columns: Sequence[str] = (), drop: Sequence[str] = ()) -> DataFrame:
    return drop_columns(filter_nonzero(df, filter_columns), drop)


def staging_layer(
    df: DataFrame,
    filter_columns: Sequence[str] = (),
    drop: Sequence[str] = (),
    fill_max: Sequence[str] = (),
    drop_constants: bool = True,
) -> DataFrame:
    """Non-zero rows, fewer columns, max-filled gaps, and no constant columns if so asked.

    One aggregate pass finds fill values and constants together. The cloud variant of this
    layer is the one with ``drop_constants=False``.
    """
    rows = staging_rows(df, filter_columns, drop)
    return FillProfile.fit(rows, fill_max, drop_constants).transform(rows)


def encode_network(
    df: DataFrame,
    ip_columns: Sequence[str] = (),
    port_columns: Sequence[str] = (),
    ports: Mapping[str, Sequence[int]] = PORT_GROUPS,
) -> DataFrame:
    """Addresses to private flags and ports to service numbers, in place."""
    values = {c: private_ip(quoted(c)) for c in ip_columns}
    values |= {c: port_id(quoted(c), ports) for c in port_columns}
    return df.withColumns(values) if values else df


def business_layer(
    df: DataFrame,
    ip_columns: Sequence[str] = (),
    index_columns: Sequence[tuple[str, str]] = (),
    ports: Mapping[str, Sequence[int]] = PORT_GROUPS,
    port_columns: Sequence[str] = (),
    mappings: Mapping[str, IndexMapping] | None = None,
    invalid: str = "error",
) -> tuple[DataFrame, Mapping[str, IndexMapping]]:
    """Private flags, indexes and service numbers; also the index mappings that were used."""
    if mappings is None:
        mappings = index_mappings(df, [c for c, _ in index_columns])
    result = encode_network(df, ip_columns, port_columns, ports)
    for column, output in index_columns:
        result = apply_index(result, column, output, mappings[column], invalid)
    return result, mappings


def cloud_business_layer(
    df: DataFrame,
    filter_columns: Sequence[str] = ("Protocol",),
    ip_columns: Sequence[str] = ("Source_IP", "Destination_IP"),
    label: tuple[str, str] = ("Label", "Label_Index"),
    protocol: tuple[str, str] = ("Protocol", "Protocal_Index"),
    port_columns: Sequence[str] = ("Source_Port", "Destination_Port"),
    ports: Mapping[str, Sequence[int]] = PORT_GROUPS,
) -> DataFrame:
    """Business layer of the cloud job: the label is indexed before a second non-zero filter,
    the protocol after it."""
    labelled, _ = business_layer(df, index_columns=[label])
    kept = filter_nonzero(labelled, filter_columns)
    return business_layer(kept, ip_columns, [protocol], ports, port_columns)[0]


def without_constants(settings: EtlSettings, constants: Collection[str]) -> EtlSettings:
    """The settings without roles for columns that the staging layer dropped as constant."""
    return replace(
        settings,
        ip_columns=[c for c in settings.ip_columns if c not in constants],
        port_columns=[c for c in settings.port_columns if c not in constants],
        index_columns=[p for p in settings.index_columns if p[0] not in constants],
    )


def layer_path(layers: str, name: str) -> str:
    return f"{layers.rstrip('/')}/{name}"


def run_raw(
    spark: SparkSession, captures: str, layers: str, settings: EtlSettings = EtlSettings()
) -> str:
    """Read a directory of CSV captures and write the raw layer; returns its path.

    The text is parsed once, into ``landing``: balancing reads the label and key columns several
    times, which costs little on Parquet and a full parse each time on CSV.
    """
    s = settings
    landed = clean_headers(read_flows(spark, captures, s.schema, s.extension))
    if s.target is None:
        return write_observed(drop_columns(landed, s.raw_drop), layer_path(layers, "raw"), s)
    write_layer(landed, layer_path(layers, "landing"))
    key = None if s.balance_key is None else [clean_name(c) for c in s.balance_key]
    raw = raw_layer(
        read_layer(spark, layer_path(layers, "landing")), clean_name(s.target), s.ignore_labels,
        s.raw_drop, key, s.seed,
    )
    return write_observed(raw, layer_path(layers, "raw"), s)


def write_observed(raw: DataFrame, path: str, settings: EtlSettings) -> str:
    """Write a raw layer, and next to it the profile that its staging layer needs, measured by the same tasks."""
    s = settings
    keep = nonzero_test(raw, s.filter_columns)
    measures = FillProfile.measures(raw, s.fill_max, s.drop_constants, keep, s.staging_drop)
    if not measures:
        return write_layer(raw, path)
    seen = Observation()
    write_layer(raw.observe(seen, *measures), path)
    state = {"settings": profile_settings(s), "found": seen.get}
    raw.sparkSession.createDataFrame([(json.dumps(state),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}_profile")
    return path


def profile_settings(s: EtlSettings) -> list:
    """What a profile depends on."""
    return [list(s.filter_columns), list(s.staging_drop), list(s.fill_max), s.drop_constants]


def observed_profile(spark: SparkSession, raw_path: str, settings: EtlSettings) -> FillProfile | None:
    """The profile written with a raw layer, if it was measured for these settings."""
    try:
        state = json.loads(spark.read.text(f"{raw_path}_profile").first()[0])
    except AnalysisException:
        return None
    return FillProfile.of(state["found"]) if state["settings"] == profile_settings(settings) else None


def run_staging(
    spark: SparkSession, raw_path: str, layers: str, settings: EtlSettings = EtlSettings(), profile: FillProfile | None = None
) -> str:
    """Write the staging layer of a raw layer; returns its path. With the ``profile`` of the raw layer its rows are read
    once; without one they are scanned for it first."""
    s = settings
    raw = read_layer(spark, raw_path)
    if profile is None:
        staging = staging_layer(raw, s.filter_columns, s.staging_drop, s.fill_max, s.drop_constants)
    else:
        staging = profile.transform(staging_rows(raw, s.filter_columns, s.staging_drop))
    return write_layer(staging, layer_path(layers, "staging"))


def run_business(
    spark: SparkSession, staging_path: str, layers: str, settings: EtlSettings = EtlSettings()
) -> str:
    """Write the business layer and the value mappings of a staging layer; returns its path."""
    s = settings
    business, mappings = business_layer(
        read_layer(spark, staging_path), s.ip_columns, s.index_columns, s.ports, s.port_columns
    )
    for column, mapping in mappings.items():
        save_mapping(mapping.table, layer_path(layers, f"mappings/{column}"))
    return write_layer(business, layer_path(layers, "business"))


def run_etl(
    spark: SparkSession, captures: str, layers: str, settings: EtlSettings = EtlSettings()
) -> dict[str, str]:
    """All layers from a directory of CSV captures; returns the paths by layer."""
    raw = run_raw(spark, captures, layers, settings)
    staging = run_staging(spark, raw, layers, settings, observed_profile(spark, raw, settings))
    lost = set(read_layer(spark, raw).columns) - set(read_layer(spark, staging).columns)
    business = run_business(spark, staging, layers, without_constants(settings, lost))
    return {
        "raw": raw, "staging": staging, "business": business, "mappings": layer_path(layers, "mappings")
    }


def run_cloud_etl(
    spark: SparkSession, raw_path: str, layers: str, settings: EtlSettings = EtlSettings()
) -> dict[str, str]:
    """The two cloud jobs: constants stay, and the business layer filters once more."""
    staging = run_staging(spark, raw_path, layers, replace(settings, drop_constants=False))
    business = cloud_business_layer(read_layer(spark, staging), settings.filter_columns, settings.ip_columns,
                                    port_columns=settings.port_columns, ports=settings.ports)
    return {"staging": staging, "business": write_layer(business, layer_path(layers, "business"))}


def unlabelled(settings: EtlSettings) -> EtlSettings:
    """The same settings for captures without a label column: nothing is balanced or labelled."""
    label = clean_name(settings.target) if settings.target is not None else None
    pairs = tuple(p for p in settings.index_columns if p[0] != label)
    return replace(settings, target=None, index_columns=pairs)
