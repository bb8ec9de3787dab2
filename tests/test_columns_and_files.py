from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecast.operators.columns import (
    align_columns,
    canonicalize,
    known_covariate_names,
    stringify_columns,
    validate_known_covariates,
    validate_series,
    validate_tabular,
)
from tidecast.operators.proba import mirror_regression, predict_from_proba, split_pred_proba
from tidecast.sources.images import attach_image_bytes, content_name, find_image_column, mark_image, read_images, relativize_paths
from tidecast.sources.sinks import (
    default_predictions_path,
    read_leaderboard,
    render,
    resolve_output_path,
    warn_if_present,
    write_predictions,
)
from tidecast.sources.tables import convert_format, read_headerless, read_requests, read_table


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame([(1, "a,b", 0.5), (2, 'say "hi"', 1.5), (3, None, 2.5)], "k int, s string, v double")


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_alignment(frame):
    assert align_columns(frame, ["v", "k"]).columns == ["v", "k"]
    with pytest.raises(ValueError, match="lacks nope"):
        align_columns(frame, ["k", "nope"])
    assert stringify_columns(frame, [0, 1, 2]).columns == ["0", "1", "2"]


def test_canonical_names(spark):
    df = spark.sql("select 7 store, date'2024-01-01' d, 3 sales, 1 promo")
    out = canonicalize(df, "store", "d", "sales")
    assert dict(out.dtypes) == {"item_id": "string", "timestamp": "timestamp_ntz", "target": "double", "promo": "int"}
    with pytest.raises(ValueError, match="lacks shop"):
        canonicalize(df, "shop", "d", "sales")
    with pytest.raises(ValueError, match="collide"):
        canonicalize(df.withColumn("target", F.lit(1)), "store", "d", "sales")


@pytest.mark.parametrize(
    "test_columns, label, message",
    [(["x"], "y", None), (["x"], None, "label"), (["x"], "w", "train_data lacks w"), (["y"], "y", "test_data lacks x")],
)
def test_tabular_rules(spark, test_columns, label, message):
    train = spark.createDataFrame([(1, 2)], "x int, y int")
    test = train.select(*test_columns)
    if message is None:
        validate_tabular(train, test, label)
    else:
        with pytest.raises(ValueError, match=message):
            validate_tabular(train, test, label)


def test_series_rules(spark):
    train = spark.sql("select 'a' item_id, timestamp_ntz'2024-01-01' timestamp, 1.0D target, 1 promo")
    validate_series(train, train)
    with pytest.raises(ValueError, match="tuning_data.*target"):
        validate_series(train, train.drop("target"))
    known = train.drop("target")
    assert known_covariate_names(known) == ["promo"]
    assert validate_known_covariates(known, None, train) == ["promo"]
    with pytest.raises(ValueError, match="as a list"):
        validate_known_covariates(known, "promo", train)
    with pytest.raises(ValueError, match="known_covariates lacks price"):
        validate_known_covariates(known, ["price"], train)
    with pytest.raises(ValueError, match="train_data"):
        validate_known_covariates(known, ["promo"], train.drop("promo"))
    with pytest.warns(UserWarning, match="left out"):
        validate_known_covariates(known.withColumn("extra", F.lit(1)), ["promo"], train)


@pytest.mark.parametrize("source, target", [("csv", "csv"), ("csv", "parquet"), ("parquet", "csv"), ("parquet", "parquet")])
def test_conversion_keeps_the_table(frame, tmp_path, source, target):
    first = convert_format(frame, source, f"{tmp_path}/a.{source}")
    second = convert_format(first, target, f"{tmp_path}/b.{target}")
    assert (second == first) == (source == target)
    assert rows(read_table(second, frame.schema)) == rows(frame)


def test_reading_by_ending(frame, tmp_path):
    frame.write.csv(f"{tmp_path}/t.tsv", header=True, sep="\t", escape='"')
    assert rows(read_table(Path(f"{tmp_path}/t.tsv"), frame.schema)) == rows(frame)
    assert read_table(frame) is frame
    with pytest.raises(ValueError, match="not supported"):
        read_table("x.xlsx")
    with pytest.raises(ValueError, match="not supported"):
        read_requests("x", "application/xml")


@pytest.mark.parametrize("accept", ["application/x-parquet", "text/csv", "application/json"])
def test_answers_read_back(frame, tmp_path, accept):
    path = render(frame, accept, f"{tmp_path}/answer")
    assert rows(read_requests(path, accept if "json" not in accept else "application/jsonl", frame.schema)) == rows(frame)
    with pytest.raises(ValueError, match="not supported"):
        render(frame, "text/html", path)


def test_header_is_decided_from_the_first_line(spark, tmp_path):
    (tmp_path / "head.csv").write_text("b,a\n1,2\n3,4\n")
    (tmp_path / "bare.csv").write_text("1,2\n3,4\n")
    (tmp_path / "wide.csv").write_text("0,1,2\n")
    assert rows(read_headerless(f"{tmp_path}/head.csv", ["a", "b"])) == [(2, 1), (4, 3)]
    assert rows(read_headerless(f"{tmp_path}/bare.csv", ["a", "b"])) == [(1, 2), (3, 4)]
    with pytest.raises(ValueError, match="3 columns, but the model expects 2"):
        read_headerless(f"{tmp_path}/wide.csv", ["a", "b"])


def test_each_file_has_its_own_header(spark, tmp_path):
    folder = tmp_path / "mixed"
    folder.mkdir()
    (folder / "1.csv").write_text("a,b\n" + "".join(f"{i},x{i}\n" for i in range(50)))
    (folder / "2.csv").write_text("b,a\ny,100\n")
    (folder / "3.csv").write_text('200,"two\nlines, ""quoted"""\n201,\n')
    schema = T.StructType.fromDDL("a int, b string")
    want = [(i, f"x{i}") for i in range(50)] + [(100, "y"), (200, 'two\nlines, "quoted"'), (201, None)]
    assert sorted(map(tuple, read_headerless(str(folder), schema).collect()), key=repr) == sorted(want, key=repr)


def test_csv_goes_by_name(spark, tmp_path):
    folder = tmp_path / "t.csv"
    folder.mkdir()
    (folder / "1.csv").write_text("b,a,c\n1,2,3\n")
    assert rows(read_table(str(folder), "a int, b int")) == [(2, 1)]
    with pytest.raises(ValueError, match="no column z"):
        read_table(str(folder), "a int, z int")
    (folder / "2.csv").write_text("a,b,c\n1,2,3\n")
    with pytest.raises(Exception):
        read_table(str(folder), "a int, b int").collect()


def test_text_survives_csv(spark, tmp_path):
    texts = ['a\nb', ' led and trailed ', 'quo"te', "tab\t,", "back\\slash", "cr\r\nlf"]
    frame = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    assert rows(read_table(convert_format(frame, "csv", f"{tmp_path}/x.csv"), frame.schema)) == list(enumerate(texts))


def test_output_places(spark, frame, tmp_path):
    assert resolve_output_path("s3://bucket/prefix/") == "s3://bucket/prefix"
    assert resolve_output_path("s3://bucket").startswith("s3://bucket/run-")
    assert default_predictions_path("s3://b/p/", "job") == "s3://b/p/job/predictions.csv"
    for bad in ("predictions.csv", "s3://b/p.json"):
        with pytest.raises(ValueError, match="full URL"):
            write_predictions(frame, bad)
    assert not warn_if_present(spark, f"{tmp_path}/empty")
    write_predictions(frame, f"{tmp_path}/p.csv")
    with pytest.warns(UserWarning, match="overwritten"):
        assert warn_if_present(spark, f"{tmp_path}/p.csv")
    with pytest.raises(Exception):
        read_leaderboard(f"{tmp_path}/none").collect()


def test_prediction_frames(spark):
    frame = spark.createDataFrame([(0, "a", 0.7, 0.3), (1, "b", 0.3, 0.7)], "row int, class string, a_proba double, b_proba double")
    prediction, proba = split_pred_proba(frame, ["row"])
    assert prediction.columns == ["row", "class"] and proba.columns == ["row", "a", "b"]
    assert rows(predict_from_proba(frame, "class", ["a", "b"], ["row"])) == [(0, "a"), (1, "b")]
    tie = spark.createDataFrame([(0.5, 0.5)], "a_proba double, b_proba double")
    assert predict_from_proba(tie, "class", ["a", "b"]).first()[0] == "a"
    odd = spark.createDataFrame([("x_proba", 1.0)], "class string, x_proba_proba double")
    assert split_pred_proba(odd)[1].columns == ["x_proba"]
    regression = spark.createDataFrame([(1.5,), (2.5,)], "target double")
    assert split_pred_proba(regression)[1] is None
    left, right = mirror_regression(regression, "target")
    assert rows(left) == rows(right) == [(1.5,), (2.5,)]


def test_images(spark, tmp_path):
    folder = tmp_path / "set"
    folder.mkdir()
    for name, data in (("one.png", b"\x89PNG-one"), ("two.png", b"\x89PNG-two"), ("copy.png", b"\x89PNG-one")):
        (folder / name).write_bytes(data)
    images = read_images(str(folder))
    assert images.count() == 3 and read_images(str(folder / "one.png")).count() == 1
    table = spark.createDataFrame([(1, f"{folder}/one.png"), (2, f"{folder}/two.png")], "k int, image string")
    attached = attach_image_bytes(table, "image", images)
    assert {r.k: bytes(r.image) for r in attached.collect()} == {1: b"\x89PNG-one", 2: b"\x89PNG-two"}
    assert dict(table.dtypes)["image"] == "string"
    with pytest.raises(ValueError, match="valid image column"):
        attach_image_bytes(table, "nope", images)
    with pytest.raises(Exception, match="no image at"):
        attach_image_bytes(table.withColumn("image", F.lit("/gone.png")), "image", images).collect()
    names = images.select(content_name(F.col("content"))).distinct().count()
    assert names == 2
    assert find_image_column(table) is None
    assert find_image_column(mark_image(table, "image")) == "image"


@pytest.mark.parametrize(
    "paths, common, relative",
    [
        (["/d/a/x.png", "/d/a/y.png"], "/d/a", ["a/x.png", "a/y.png"]),
        (["/d/a/b", "/d/a/b-x", "/d/a/b/c"], "/d/a", ["a/b", "a/b-x", "a/b/c"]),
        (["/d/one.png"], "/d/one.png", ["one.png"]),
        (["/d/a/x", "/e/y"], "", ["d/a/x", "e/y"]),
    ],
)
def test_common_paths(spark, paths, common, relative):
    frame, found = relativize_paths(spark.createDataFrame([(p,) for p in paths], "p string"), "p")
    assert found == common
    assert [r[0] for r in frame.collect()] == relative


def test_csv_without_line_ends_is_split(spark, tmp_path):
    path = str(tmp_path / "big.csv")
    with open(path, "w") as out:
        out.write("b,a\n" + "".join(f'"x, {i}",{i}\n' for i in range(3000)))
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        whole, split = read_table(path, "a int, b string"), read_table(path, "a int, b string", line_ends=False)
        assert whole.rdd.getNumPartitions() == 1 and split.rdd.getNumPartitions() > 3
        assert split.columns == ["a", "b"] and split.exceptAll(whole).isEmpty() and split.count() == 3000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    with open(path, "a") as out:
        out.write('"two\nlines",1\n')
    assert read_table(path, "a int, b string").count() == 3001
    with pytest.raises(Exception, match="(?i)malformed"):
        read_table(path, "a int, b string", line_ends=False).collect()
