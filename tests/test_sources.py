import pytest
from pyspark.sql import types as T

from flowlab.errors import MissingInput
from flowlab.operators.kinds import fitting_types, merged_kinds
from flowlab.sources.captures import (
    capture_kinds, check_headers, first_lines, header_groups, headers, list_files, merge_by_name, merge_csv_files, read_flows,
    require_files, wider,
)
from flowlab.sources.layers import load_mapping, read_layer, save_mapping, write_layer
from flowlab.storage import scratch_path, scratch_root


@pytest.fixture
def folder(tmp_path):
    def write(**files):
        for name, text in files.items():
            (tmp_path / name.replace("_csv", ".csv")).write_text(text)
        return str(tmp_path)

    return write


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_files_of_one_folder_and_extension(spark, folder, tmp_path):
    path = folder(a_csv="x\n1\n", b_csv="x\n2\n", notes="x")
    (tmp_path / "deeper").mkdir()
    (tmp_path / "deeper" / "c.csv").write_text("x\n3\n")
    assert [p.rsplit("/", 1)[1] for p in list_files(spark, path)] == ["a.csv", "b.csv"]
    assert list_files(spark, path, "parquet") == []


def test_missing_input_is_reported(spark, folder, tmp_path):
    with pytest.raises(AssertionError):
        merge_csv_files(None, [])
    with pytest.raises(AssertionError):
        merge_by_name([])
    with pytest.raises(MissingInput):
        require_files(spark, folder(notes="x"))
    with pytest.raises(MissingInput):
        list_files(spark, str(tmp_path / "nowhere"))
    for layer in (None, spark):
        with pytest.raises(AssertionError):
            read_layer(layer, "NO_EXISTS")
    (tmp_path / "empty").mkdir()
    with pytest.raises(MissingInput):
        read_layer(spark, str(tmp_path / "empty"))


def test_headers_agree_or_not(spark, folder):
    path = folder(a_csv="x, y\n1,2\n", b_csv="x, y\n3,4\n")
    assert check_headers(spark, path).collect() == [(["x", " y"], 2)]
    path = folder(c_csv=" y,x\n1,2\n")
    assert check_headers(spark, path).count() == 2
    assert set(headers(spark, list_files(spark, path)).values()) == {("x", " y"), (" y", "x")}


def test_first_lines_of_many_files_take_one_job(spark, folder, tmp_path):
    path = folder(**{f"f{i}_csv": "\n\nx, y\n" + "1,2\n" * 30_000 for i in range(20)}, e_csv="", blank_csv="\n \n")
    (tmp_path / "a b%1.csv").write_text(" y,x\n1,2\n")
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    paths = list_files(spark, path)
    spark.sparkContext.setJobGroup("first lines", "")
    found = first_lines(spark, paths)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("first lines")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) == 1 and sorted(found) == paths and [spark.conf.get(n) for n in names] == before
    assert sorted(map(str, found.values())) == [" y,x", "None"] + ["x, y"] * 20  # an empty file is not listed
    names = headers(spark, paths)
    assert {p.rsplit("/", 1)[1]: h for p, h in names.items() if h != ("x", " y")} == {"blank.csv": (), "a b%1.csv": (" y", "x")}


def test_kinds_of_values_merge(spark, folder):
    one = folder(
        a_csv="i,l,d,r,t,s,b,n,m\n1,5000000000,123456789012345678901,1.5,2020-01-01,2020-01-01 10:00:00,true,,1\n",
        b_csv="m,n,b,s,t,r,d,l,i\nx,,False,2020-01-01T10:00:00.5,2020-02-30,-Infinity,-7,+6,\n",
    )
    df = read_flows(spark, one)
    assert dict(df.dtypes) == {
        "i": "int", "l": "bigint", "d": "decimal(21,0)", "r": "double", "t": "string", "s": "timestamp", "b": "boolean", "n": "string", "m": "string",
    }
    assert df.count() == 2 and {r.i for r in df.collect()} == {1, None}
    tables = [capture_kinds(spark, header_groups(spark, [p])) for p in list_files(spark, one)]
    both = capture_kinds(spark, header_groups(spark, list_files(spark, one)))
    assert rows(merged_kinds(tables)) == rows(both.select("column_name", "kind", "n", "width"))
    assert {c: t.simpleString() for c, t in fitting_types(merged_kinds(tables)).items()} == dict(df.dtypes)


def test_columns_are_matched_by_name(spark, folder):
    path = folder(a_csv="x, y\n1,a\n", b_csv=" y,x\nb,2\n", c_csv="x, y\n3,c\n")
    df = read_flows(spark, path)
    assert dict(df.dtypes) == {"x": "int", " y": "string"}
    assert rows(df.select("x", "` y`")) == [(1, "a"), (2, "b"), (3, "c")]


def test_types_are_widened_before_the_text_is_read(spark, folder):
    path = folder(
        a_csv="x,y,z\n1,007,5\n", b_csv="z,y,x\n5.5,abc,3000000000\n", c_csv="y,z,x\n8,Infinity,\n"
    )
    df = read_flows(spark, path)
    assert dict(df.dtypes) == {"x": "bigint", "y": "string", "z": "double"}
    assert rows(df.select("x", "y", "z")) == [
        (1, "007", 5.0), (3000000000, "abc", 5.5), (None, "8", float("inf"))
    ]


def test_given_schema(spark, folder):
    schema = T.StructType([T.StructField("y", T.DoubleType()), T.StructField("x", T.StringType())])
    path = folder(a_csv="x,y\n01,Infinity\n", b_csv="y,x\nNaN,2\n,3\n")
    df = read_flows(spark, path, schema)
    assert df.columns == ["y", "x"] and rows(df.select("x"))[0] == ("01",)
    with pytest.raises(Exception):
        read_flows(spark, folder(c_csv="x,y\n1,oops\n"), schema).collect()


def test_column_sets_must_agree(spark, folder):
    path = folder(a_csv="x,y\n1,2\n", b_csv="x,z\n1,2\n")
    with pytest.raises(ValueError, match="y.*z"):
        read_flows(spark, path)
    with pytest.raises(ValueError, match="columns"):
        merge_by_name([spark.range(1), spark.range(1).toDF("other")])
    with pytest.raises(ValueError, match="schema"):
        read_flows(spark, folder(b_csv="x,y\n1,2\n"), T.StructType([T.StructField("x", T.IntegerType())]))


def test_merge_tables(spark):
    a = spark.createDataFrame([(1, "a")], "x int, y string")
    b = spark.createDataFrame([("b", 2**40)], "y string, x long")
    c = spark.createDataFrame([(7, 1.5)], "y int, x double")
    df = merge_by_name([a, b, c])
    assert dict(df.dtypes) == {"x": "double", "y": "string"}
    assert rows(df) == [(1.0, "a"), (1.5, "7"), (float(2**40), "b")]


def test_wider():
    i, l, d, s = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType()
    assert wider(i, l) == l and wider(d, l) == d and wider(i, s) == s and wider(T.NullType(), i) == i
    assert wider(T.DecimalType(20, 0), i) == d and wider(T.TimestampType(), i) == s


def test_layer_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 0.5), (2, "b", None)], "`Flow_Bytes/s` int, ` Label` string, v double")
    path = write_layer(df.coalesce(1), str(tmp_path / "layer"), max_records=1)
    assert rows(read_layer(spark, path)) == rows(df) and len(list_files(spark, path, "snappy.parquet")) == 2
    path = write_layer(df, path, single_file=True)
    assert rows(read_layer(spark, path)) == rows(df) and len(list_files(spark, path, "parquet")) == 1
    path = write_layer(df, path, partition_by=[" Label"])
    assert set(read_layer(spark, path).columns) == set(df.columns)


def test_mapping_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("BENIGN", 0), ("Señal", 1)], "value string, index int")
    path = save_mapping(df, str(tmp_path / "m"))
    assert rows(load_mapping(spark, path, df.schema)) == rows(df)
    with pytest.raises(MissingInput):
        load_mapping(spark, str(tmp_path / "none"), df.schema)


def test_scratch_follows_the_session(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_no_local_scratch_on_a_cluster():
    class Away:
        class conf:
            get = staticmethod(lambda name, default=None: default)

        class sparkContext:
            master = "yarn"
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_root(Away)
