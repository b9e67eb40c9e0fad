import random
import subprocess
import sys
from collections import Counter
from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from flowlab.operators.clean import FillProfile
from flowlab.operators.models import BoostedParams, score, train_boosted, train_mlp
from flowlab.plans.layers import (
    business_layer, cloud_business_layer, observed_profile, raw_layer, run_cloud_etl, run_etl, run_raw, run_staging,
    staging_layer, staging_rows, unlabelled, without_constants,
)
from flowlab.plans.settings import EtlSettings
from flowlab.plans.training import FlowPreparation, run_training_set, training_set
from flowlab.sources.captures import read_flows
from flowlab.sources.layers import load_mapping, read_layer
from tests.plans import assert_absent, plan_text

HEADER = ["Unnamed: 0", "Flow ID", " Source IP", " Source Port", " Destination IP", " Destination Port",
          " Protocol", " Timestamp", "Flow Bytes/s", " Flow Packets/s", " Flag", "SimilarHTTP", " Label"]


def flow_lines(n=600, seed=7):
    draw = random.Random(seed)
    for i in range(n):
        label = draw.choices(["BENIGN", "Syn", "UDP", "UDPLag"], [6, 3, 2, 1])[0]
        size = {"BENIGN": 10, "Syn": 200, "UDP": 900, "UDPLag": 5}[label] + draw.random()
        packets = {"BENIGN": 3, "Syn": 70, "UDP": 9, "UDPLag": 5}[label] + draw.random()
        yield [
            str(i), f"flow-{i}", draw.choice(["172.16.0.5", "8.8.8.8", "192.168.1.9"]), draw.choice(["80", "53", "50000"]),
            "192.168.50.1", draw.choice(["443", "445", "1234"]), draw.choice(["6", "17", "17", "0"]),
            "2018-11-03 09:18:16", draw.choice([f"{size}", "Infinity", "", f"{size}"]), f"{packets}", "0", "x", label,
        ]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("captures")
    lines = list(flow_lines())
    (path / "one.csv").write_text("\n".join(",".join(r) for r in [HEADER, *lines[:300]]) + "\n")
    (path / "two.csv").write_text("\n".join(",".join(reversed(r)) for r in [HEADER, *lines[300:]]) + "\n")
    return str(path)


@pytest.mark.parametrize("key", [("Unnamed: 0",), None])
def test_etl_writes_every_layer(spark, folder, tmp_path, key):
    paths = run_etl(spark, folder, str(tmp_path), EtlSettings(balance_key=key))
    raw, staging, business = (read_layer(spark, paths[n]) for n in ("raw", "staging", "business"))

    assert not [c for c in raw.columns if " " in c] and "SimilarHTTP" not in raw.columns
    sizes = Counter(r.Label for r in raw.collect())
    source = Counter(r[-1] for r in flow_lines())
    least = min(n for label, n in source.items() if label != "UDPLag")
    assert set(sizes) == {"BENIGN", "Syn", "UDP"}
    assert all(n == least if key else abs(n - least) < 60 for n in sizes.values())

    rows = staging.collect()
    # Flag is constant, so is the destination address; flows of protocol 0 are gone.
    assert set(staging.columns) == {
        "Source_IP", "Source_Port", "Destination_Port", "Protocol", "Flow_Bytes/s", "Flow_Packets/s", "Label"
    }
    assert {r.Protocol for r in rows} == {6, 17}
    top = max(r["Flow_Bytes/s"] for r in rows)
    assert top < 1000 and all(r["Flow_Bytes/s"] is not None for r in rows)

    assert set(business.columns) == (set(staging.columns) - {"Protocol", "Label"}) | {"Protocal_Index", "Label_Index"}
    assert business.count() == len(rows) and {r.Source_IP for r in business.collect()} == {0, 1}
    saved = {r.value: r["index"] for r in load_mapping(spark, f"{paths['mappings']}/Label", "value string, index int").collect()}
    counts = Counter(r.Label for r in rows)
    assert saved == {v: i for i, v in enumerate(sorted(counts, key=lambda v: (-counts[v], v)))}
    assert Counter(r.Label_Index for r in business.collect()) == {saved[v]: n for v, n in counts.items()}


def test_training_set_from_the_business_layer(spark, folder, tmp_path):
    settings = EtlSettings(balance_key=("Unnamed: 0",), components=2)
    paths = run_etl(spark, folder, str(tmp_path), settings)
    made = run_training_set(spark, paths["business"], str(tmp_path), settings)
    train = read_layer(spark, made["training_set"])
    assert train.columns == ["c0", "c1", "Label_Index"] and train.count() == read_layer(spark, paths["business"]).count()
    ratios = {r.k: r.ratio for r in load_mapping(spark, made["variance_ratio"], "k int, ratio double").collect()}
    assert list(ratios) == [1, 2] and ratios[2] == pytest.approx(1.0)

    cloud = run_cloud_etl(spark, paths["raw"], str(tmp_path / "cloud"), settings)
    business = read_layer(spark, cloud["business"])
    assert {"Destination_IP", "Flag", "Protocal_Index", "Label_Index"} <= set(business.columns)
    assert business.count() == train.count()


def test_unlabelled_run_balances_nothing(spark, folder, tmp_path):
    path = run_raw(spark, folder, str(tmp_path), unlabelled(EtlSettings()))
    assert read_layer(spark, path).count() == 600


def test_unlabelled_captures(spark, folder):
    labelled = read_flows(spark, folder)
    raw = raw_layer(labelled, drop=["SimilarHTTP"])
    assert raw.count() == 600
    prepared, train = FlowPreparation.fit(raw.filter("Label <> 'UDPLag'"), EtlSettings(components=2))
    assert train.columns == ["c0", "c1", "Label_Index"]
    model = train_mlp(train, prepared.features, "Label_Index", [4], max_iter=50)
    predicted = prepared.predict(model, labelled.drop(" Label"), keep=["Unnamed:_0"])
    assert predicted.count() == 600 and "Label_Index" not in predicted.columns
    index = {r.value: r["index"] for r in prepared.mappings["Label"].table.collect()}
    truth = {int(r[0]): index.get(r[-1]) for r in flow_lines() if r[6] != "0" and r[-1] != "UDPLag" and r[8] not in ("", "Infinity")}
    right = sum(truth[r["Unnamed:_0"]] == r.prediction for r in predicted.collect() if r["Unnamed:_0"] in truth)
    assert right > 0.9 * len(truth)
    assert unlabelled(EtlSettings()).index_columns == (("Protocol", "Protocal_Index"),)


def test_layers_keep_column_order_and_stay_in_the_jvm(spark, folder):
    df = raw_layer(read_flows(spark, folder), drop=["SimilarHTTP"])
    staged = staging_layer(df, ["Protocol"], ["Unnamed:_0", "Flow_ID", "Timestamp"], ["Flow_Bytes/s"], drop_constants=False)
    assert staged.columns == ["Source_IP", "Source_Port", "Destination_IP", "Destination_Port", "Protocol",
                              "Flow_Bytes/s", "Flow_Packets/s", "Flag", "Label"]
    business, _ = business_layer(
        staged, ["Source_IP", "Destination_IP"], [("Protocol", "Protocal_Index"), ("Label", "Label_Index")],
        port_columns=["Source_Port", "Destination_Port"],
    )
    assert business.columns == ["Source_IP", "Source_Port", "Destination_IP", "Destination_Port", "Flow_Bytes/s",
                                "Flow_Packets/s", "Flag", "Protocal_Index", "Label_Index"]
    assert_absent(business, "Python", "Arrow", "NestedLoop", "SortMergeJoin", "hashpartitioning")
    assert plan_text(business).count("Project") <= 6


def test_cloud_business_indexes_the_label_before_the_filter(spark):
    rows = [("a", 0), ("a", 0), ("a", 0), ("b", 6), ("b", 6), ("a", 17)]
    df = spark.createDataFrame(rows, "Label string, Protocol int")
    got = cloud_business_layer(df, ip_columns=[], port_columns=[])
    assert sorted(map(tuple, got.select("Label_Index", "Protocal_Index").collect())) == [(0, 1), (1, 0), (1, 0)]


def test_training_set_can_be_fitted_on_a_part(spark):
    df = spark.createDataFrame([(float(i), float(i * i % 7), i % 2) for i in range(40)], "a double, b double, y int")
    reduced, scaler, reducer = training_set(df, "y", ["y"], 1, fit_on=df.filter("a < 30"))
    assert scaler.ranges["a"] == (0.0, 29.0) and reduced.columns == ["c0", "y"] and reduced.count() == 40
    assert reducer.explained_variance() == [(1, pytest.approx(1.0))]


def test_roles_of_constant_columns_lapse():
    s = without_constants(EtlSettings(), ["Destination_IP", "Protocol"])
    assert s.ip_columns == ["Source_IP"] and s.index_columns == [("Label", "Label_Index")]


def test_staging_reads_what_was_observed_while_raw_was_written(spark, folder, tmp_path):
    settings = EtlSettings(balance_key=("Unnamed: 0",))
    raw = run_raw(spark, folder, str(tmp_path), settings)
    profile = observed_profile(spark, raw, settings)
    rows = staging_rows(read_layer(spark, raw), settings.filter_columns, settings.staging_drop)
    assert profile == FillProfile.fit(rows, settings.fill_max, settings.drop_constants)
    assert observed_profile(spark, raw, replace(settings, fill_max=("Flow_Bytes/s",))) is None
    assert observed_profile(spark, str(tmp_path / "nowhere"), settings) is None
    context = spark.sparkContext
    context.setJobGroup("observed", "")
    try:
        staged = run_staging(spark, raw, str(tmp_path / "observed"), settings, profile)
        jobs = context.statusTracker().getJobIdsForGroup("observed")
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    # Reading the footer of the layer for its schema, and the write.
    assert len(jobs) <= 2
    again = run_staging(spark, raw, str(tmp_path / "scanned"), settings)
    assert sorted(map(str, read_layer(spark, staged).collect())) == sorted(map(str, read_layer(spark, again).collect()))


ELSEWHERE = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession
from flowlab.operators.models import score
from flowlab.sources.captures import read_flows
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
captures = read_flows(spark, sys.argv[2]).drop(" Label")
score(PipelineModel.load(sys.argv[3]), captures).write.parquet(sys.argv[4])
"""


@pytest.mark.parametrize("kind", ["net", "trees"])
def test_one_saved_pipeline_scores_captures_in_another_session(spark, folder, tmp_path, kind):
    labelled = read_flows(spark, folder)
    prepared, train = FlowPreparation.fit(raw_layer(labelled, drop=["SimilarHTTP"]), EtlSettings(components=2))
    model = (
        train_mlp(train, prepared.features, "Label_Index", [4], max_iter=10) if kind == "net"
        else train_boosted(train, prepared.features, "Label_Index", BoostedParams(trees=3, depth=3))
    )
    scorer = prepared.scorer(model, ["Unnamed:_0"])
    scorer.write().save(str(tmp_path / "scorer"))
    subprocess.run(
        [sys.executable, "-c", ELSEWHERE, str(Path(__file__).parents[1]), folder, str(tmp_path / "scorer"), str(tmp_path / "scores")],
        check=True, capture_output=True, timeout=300,
    )
    there = {r["Unnamed:_0"]: r.prediction for r in spark.read.parquet(str(tmp_path / "scores")).collect()}
    here = {r["Unnamed:_0"]: r.prediction for r in score(scorer, labelled.drop(" Label")).collect()}
    assert len(there) == 600 and there == here
    # Values that training never saw share the next free index; the flow still gets a prediction.
    unseen = labelled.drop(" Label").withColumn(" Protocol", F.lit(99))
    assert score(scorer, unseen).filter("prediction is not null").count() == 600
