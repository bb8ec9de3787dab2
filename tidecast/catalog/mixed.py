"""Queries on text, vectors, image-like files, user scorers and streams."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from tidecast.catalog.common import DAILY_SQL, Z, daily_events, forecast_sql, rounded, table
from tidecast.catalog.learning import BANDS_SQL, KEYS, bands
from tidecast.catalog.series import _bodies as request_bodies
from tidecast.catalog.series import _ZERO_DAYS
from tidecast.functions.paths import base_name, common_path
from tidecast.operators.columns import ITEM, STAMP, TARGET, canonicalize
from tidecast.operators.scoring import recent_context, score_items, score_with
from tidecast.plans.multimodal import MultiModalEstimator
from tidecast.plans.tabular import TabularEstimator
from tidecast.session import scratch_path
from tidecast.sources.images import (
    attach_image_bytes,
    attach_named_files,
    content_name,
    name_images,
    read_images,
    relativize_paths,
    reroot_paths,
    write_files,
)
from tidecast.streaming.history import read_history, run_history
from tidecast.streaming.queries import RateLimits, read_stream, run_available
from tidecast.streaming.scoring import (
    forecast_stream,
    predict_proba_stream,
    predict_stream,
    read_forecasts,
    with_side_inputs,
)

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


# -- user scorers ----------------------------------------------------------------------------------


def _load_rate():
    return {"rate": 0.5}


@query(
    "udf_score_rows",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
              round(l_extendedprice * 0.5 + l_quantity, 4) AS net FROM lineitem""",
)
def udf_score_rows(spark, sf_dir):
    schema = "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, net double"
    columns = [*KEYS, "l_extendedprice", "l_quantity"]

    def net(model, rows: pd.DataFrame) -> pd.DataFrame:
        return rows[KEYS].assign(net=rows["l_extendedprice"] * model["rate"] + rows["l_quantity"])

    scored = score_with(table(spark, sf_dir, "lineitem"), _load_rate, net, schema, columns)
    return rounded(scored)


@query(
    "udf_score_items",
    f"""WITH s AS ({DAILY_SQL}), r AS (SELECT *, max(k) OVER (PARTITION BY item_id) AS k1 FROM s)
        SELECT item_id, max(ts) AS "timestamp", round(avg(y), 4) AS mean FROM r WHERE k > k1 - 14 GROUP BY 1""",
)
def udf_score_items(spark, sf_dir):
    """A scorer that needs each item's recent history at once: its mean over 14 days."""

    def mean_of(_, rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(
            {ITEM: [rows[ITEM].iloc[0]], STAMP: [rows[STAMP].iloc[-1]], "mean": [rows[TARGET].mean()]}
        )

    schema = f"{ITEM} string, {STAMP} timestamp_ntz, mean double"
    return rounded(score_items(daily_events(spark, sf_dir), dict, mean_of, schema, 14, "D"))


@query(
    "ts_recent_context",
    f"""WITH s AS ({DAILY_SQL}), r AS (SELECT *, max(k) OVER (PARTITION BY item_id) AS k1 FROM s)
        SELECT item_id, ts AS "timestamp", y AS target FROM r WHERE k > k1 - 14""",
)
def ts_recent_context(spark, sf_dir):
    return recent_context(daily_events(spark, sf_dir), 14, "D")


# -- text, vectors, mixed ------------------------------------------------------------------------------


def _labelled(spark, sf_dir):
    return table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")


@query("text_classify")
def text_classify(spark, sf_dir):
    """Quality of every document from its whole text, learnt from the labelled ones."""
    data = _labelled(spark, sf_dir).select("doc_id", "text", "quality")
    estimator = MultiModalEstimator(
        "quality", "acc", problem_type="classification", text_columns=["text"], ignore_columns=["doc_id"]
    )
    model = estimator.fit(data, hyperparameters={"linear": {"maxIter": 20, "regParam": 0.01}}, keys=["doc_id"])
    return rounded(model.score(table(spark, sf_dir, "documents"), keys=["doc_id"]))


@query("embedding_classify")
def embedding_classify(spark, sf_dir):
    """Ten classes from 64-dimensional vectors."""
    data = table(spark, sf_dir, "embeddings")
    estimator = MultiModalEstimator("label", problem_type="classification", vector_columns=["embedding"], ignore_columns=["vec_id"])
    model = estimator.fit(data, hyperparameters={"linear": {"maxIter": 20, "regParam": 0.01}}, keys=["vec_id"])
    return rounded(model.score(data, keys=["vec_id"]))


@query("mixed_classify")
def mixed_classify(spark, sf_dir):
    """Toxicity from text, language, source, length and the raw bytes as an image stand-in."""
    data = _labelled(spark, sf_dir).withColumn("bytes", F.encode("text", "UTF-8")).drop("quality")
    estimator = MultiModalEstimator(
        "toxic", "acc", image_column="bytes", problem_type="classification", text_columns=["text"], ignore_columns=["doc_id"]
    )
    model = estimator.fit(data, hyperparameters={"linear": {"maxIter": 20, "regParam": 0.01}}, keys=["doc_id"])
    every = table(spark, sf_dir, "documents").withColumn("bytes", F.encode("text", "UTF-8"))
    return rounded(model.score(every, keys=["doc_id"]))


# -- files and paths -------------------------------------------------------------------------------------

_PATHS = "SELECT page_id, '/images/' || regexp_replace(url, '^https?://', '') AS path FROM pages"


def _paths(spark, sf_dir):
    path = F.concat(F.lit("/images/"), F.regexp_replace("url", "^https?://", ""))
    return table(spark, sf_dir, "pages").select("page_id", path.alias("path"))


@query("img_relativize", f"SELECT page_id, substr(path, 2) AS path FROM ({_PATHS})")
def img_relativize(spark, sf_dir):
    return relativize_paths(_paths(spark, sf_dir), "path")[0]


@query("img_reroot", f"SELECT page_id, '/data/' || substr(path, 2) AS path FROM ({_PATHS})")
def img_reroot(spark, sf_dir):
    return reroot_paths(relativize_paths(_paths(spark, sf_dir), "path")[0], "path", "/data")


@query("img_common_path", "SELECT '/images' AS common_path")
def img_common_path(spark, sf_dir):
    return common_path(_paths(spark, sf_dir), "path")


@query("img_base_name", f"SELECT page_id, list_extract(string_split(path, '/'), -1) AS name FROM ({_PATHS})")
def img_base_name(spark, sf_dir):
    return _paths(spark, sf_dir).select("page_id", base_name(F.col("path")).alias("name"))


@query("img_content_name", "SELECT page_id, 'tabular_image_' || sha1(html) || '.png' AS name FROM pages")
def img_content_name(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", content_name(F.encode("html", "UTF-8")).alias("name"))


@query(
    "img_name_images",
    "SELECT 'tabular_image_' || sha1(text) || '.png' AS name, count(*) AS copies FROM documents GROUP BY 1",
)
def img_name_images(spark, sf_dir):
    return name_images(table(spark, sf_dir, "documents").select(F.encode("text", "UTF-8").alias("content")))


def _page_files(spark, sf_dir) -> str:
    """Byte files made of the pages (at most 100 pages each) in the shared folder."""
    path = scratch_path(spark, "pages")
    table(spark, sf_dir, "pages").select("html").write.option("maxRecordsPerFile", 100).text(path)
    return path


_PAGE_BYTES = "SELECT CAST(sum(octet_length(encode(html)) + 1) AS BIGINT) AS total_bytes FROM pages"


@query("img_read_images", _PAGE_BYTES)
def img_read_images(spark, sf_dir):
    return read_images(_page_files(spark, sf_dir), "*.txt").agg(F.sum("length").alias("total_bytes"))


@query("img_attach_bytes", _PAGE_BYTES)
def img_attach_bytes(spark, sf_dir):
    images = read_images(_page_files(spark, sf_dir), "*.txt")
    rows = images.select(F.col("path").alias("image"))
    attached = attach_image_bytes(rows, "image", images)
    return attached.agg(F.sum(F.octet_length("image").cast("bigint")).alias("total_bytes"))


@query(
    "img_named_files",
    """SELECT sha1(html || chr(10)) AS sha, count(*) AS n FROM pages
       WHERE octet_length(encode(html)) + 1 > 1000 GROUP BY 1""",
)
def img_named_files(spark, sf_dir):
    """One file per page; those of more than 1,000 bytes are named by rows, and no other is opened."""
    lines = table(spark, sf_dir, "pages").select(F.concat(F.coalesce("html", F.lit("")), F.lit("\n")).alias("content"))
    files = write_files(lines, "content", scratch_path(spark, "page-files"))
    rows = files.where("length > 1000").select(F.col("path").alias("image"))
    loaded = attach_named_files(rows, "image")
    return loaded.groupBy(F.sha1("image").alias("sha")).agg(F.count(F.lit(1)).alias("n"))


@query("img_predict_images")
def img_predict_images(spark, sf_dir):
    """Files scored with a model of page bytes; one row per file."""
    html = table(spark, sf_dir, "pages").select(
        F.encode("html", "UTF-8").alias("image"), F.when(F.length("html") > 2000, "long").otherwise("short").alias("size")
    )
    model = MultiModalEstimator("size", image_column="image").fit(html, hyperparameters={"tree": {"maxDepth": 3}})
    return rounded(model.predict_images(_page_files(spark, sf_dir), "*.txt").drop("path"))


# -- streams -------------------------------------------------------------------------------------------------


def _band_stream(spark, sf_dir, score):
    """Fit on the table, then score the same table as a stream of files."""
    data = bands(spark, sf_dir)
    model = TabularEstimator("band", ignore_columns=KEYS).fit(data, hyperparameters={"tree": {"maxDepth": 2}})
    source = f"{sf_dir}/lineitem.parquet"
    stream = read_stream(spark, source, spark.read.parquet(source).schema)
    size = F.when(F.col("l_quantity") > 25, "bulk").otherwise("small").alias("size")
    output, checkpoint = scratch_path(spark, "scored"), scratch_path(spark, "state")
    run_available(score(model, stream.select(*KEYS, size), KEYS), "scores", output, checkpoint)
    return rounded(spark.read.parquet(output))


@query("stream_predict", f"SELECT * EXCLUDE (cheap_proba, dear_proba) FROM ({BANDS_SQL})")
def stream_predict(spark, sf_dir):
    return _band_stream(spark, sf_dir, predict_stream)


@query("stream_predict_proba", BANDS_SQL)
def stream_predict_proba(spark, sf_dir):
    return _band_stream(spark, sf_dir, predict_proba_stream)


_Z9 = Z["0.9"]
_REQUEST_FC = forecast_sql("s2", 3, 7, "D", ["seasonal_naive"])


@query(
    "stream_forecast",
    f"""WITH {_ZERO_DAYS},
    s2 AS (SELECT request_id || '#' || item_id AS item_id, ts,
                  date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS k, y FROM z), {_REQUEST_FC}
    SELECT split_part(item_id, '#', 1) AS request_id, 0 AS pos, split_part(item_id, '#', 2) AS item_id, ts AS "timestamp",
           round(mean, 4) AS mean, round(mean - {_Z9} * coalesce(sigma, 0), 4) AS "0.1",
           round(mean + {_Z9} * coalesce(sigma, 0), 4) AS "0.9" FROM fc""",
)
def stream_forecast(spark, sf_dir):
    """Requests written as JSON lines, read back as a stream, forecast per micro-batch."""
    source, output, checkpoint = (scratch_path(spark, label) for label in ("requests", "forecasts", "state"))
    request_bodies(spark, sf_dir).write.json(source)
    stream = read_stream(spark, source, "request_id string, body string", "application/jsonl")
    forecast_stream(stream, "forecasts", output, checkpoint, levels=[0.1, 0.9], available_now=True).awaitTermination()
    return rounded(read_forecasts(spark, output))


@query(
    "stream_side_inputs",
    """SELECT CAST(o_custkey AS VARCHAR) AS item_id, o_orderdate AS "timestamp", o_totalprice AS target, c_mktsegment
       FROM orders LEFT JOIN customer ON c_custkey = o_custkey""",
)
def stream_side_inputs(spark, sf_dir):
    """A stream of orders with static customer features."""
    source = f"{sf_dir}/orders.parquet"
    stream = read_stream(spark, source, spark.read.parquet(source).schema).select(
        F.col("o_custkey").cast("string").alias(ITEM),
        F.col("o_orderdate").alias(STAMP),
        F.col("o_totalprice").alias(TARGET),
    )
    static = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias(ITEM), "c_mktsegment")
    output, checkpoint = scratch_path(spark, "joined"), scratch_path(spark, "state")
    run_available(with_side_inputs(stream, static), "side-inputs", output, checkpoint)
    return spark.read.parquet(output)


@query(
    "stream_current_history",
    """WITH one AS (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id, date_trunc('hour', ts) ORDER BY event_id DESC) = 1)
       SELECT CAST(user_id AS VARCHAR) AS item_id, date_trunc('hour', ts) AS "timestamp", value AS target FROM one
       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) <= 4""",
)
def stream_current_history(spark, sf_dir):
    """Each user's value in its four latest hours, from events in three micro-batches of any order; the highest id wins."""
    hour = F.to_date("ts").cast("timestamp_ntz") + F.hour("ts") * F.expr("INTERVAL '1' HOUR")
    events = table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias(ITEM), hour.alias(STAMP), F.col("value").alias(TARGET), "event_id")
    source, output, checkpoint = (scratch_path(spark, label) for label in ("events", "history", "state"))
    events.repartition(3, F.crc32(F.col("event_id").cast("string").cast("binary"))).write.parquet(source)
    stream = read_stream(spark, source, events.schema, limits=RateLimits(max_files=1))
    run_history(stream, 4, "current", output, checkpoint, order="event_id", buckets=8)
    return read_history(spark, output)


@query(
    "stream_rolling_history",
    """SELECT CAST(user_id AS VARCHAR) AS item_id, ts AS "timestamp", value AS target FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) <= 5""",
)
def stream_rolling_history(spark, sf_dir):
    """The five latest events of every user, kept in a stored table."""
    source = f"{sf_dir}/events.parquet"
    stream = read_stream(spark, source, spark.read.parquet(source).schema)
    rows = canonicalize(stream.select("user_id", "ts", "value"), "user_id", "ts", "value")
    output, checkpoint = scratch_path(spark, "history"), scratch_path(spark, "state")
    run_history(rows, 5, "history", output, checkpoint)
    return read_history(spark, output)
