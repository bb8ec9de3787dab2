"""Queries that go through files: formats, requests, predictions, leaderboards."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidecast.catalog.common import LEVELS, daily_events, rounded, table
from tidecast.catalog.forecasts import SQL as FORECASTS
from tidecast.catalog.learning import BANDS_SQL, KEYS, bands
from tidecast.operators.baseline import BASELINES
from tidecast.operators.leaderboard import best_model
from tidecast.plans.forecast import ForecastEstimator, ForecastModel, forecast
from tidecast.plans.tabular import TabularEstimator, TabularModel
from tidecast.session import scratch_path
from tidecast.sources.sinks import (
    read_leaderboard,
    read_predictions,
    render,
    render_records,
    write_leaderboard,
    write_predictions,
)
from tidecast.sources.tables import check_width, convert_format, read_headerless, read_requests, read_table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


PARTS = "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
_PARTS_SQL = "SELECT * FROM part"


@query("src_read_parquet", "SELECT * FROM lineitem")
def src_read_parquet(spark, sf_dir):
    return read_table(f"{sf_dir}/lineitem.parquet", spark=spark)


@query("src_read_csv", _PARTS_SQL)
def src_read_csv(spark, sf_dir):
    path = scratch_path(spark, "part") + ".csv"
    table(spark, sf_dir, "part").write.csv(path, header=True, escape='"')
    return read_table(path, PARTS, spark)


@query("src_read_tsv", _PARTS_SQL)
def src_read_tsv(spark, sf_dir):
    path = scratch_path(spark, "part") + ".tsv"
    table(spark, sf_dir, "part").write.csv(path, header=True, sep="\t", escape='"')
    return read_table(path, PARTS, spark)


@query("src_csv_documents", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def src_csv_documents(spark, sf_dir):
    """Texts with line ends and quotes, to CSV and back."""
    path, docs = scratch_path(spark, "documents") + ".csv", table(spark, sf_dir, "documents")
    convert_format(docs, "csv", path, spark)
    return read_table(path, docs.schema, spark)


@query("src_csv_other_order", _PARTS_SQL)
def src_csv_other_order(spark, sf_dir):
    """A file whose header is in another order than the schema."""
    path, part = scratch_path(spark, "part") + ".csv", table(spark, sf_dir, "part")
    convert_format(part.select(*reversed(part.columns)), "csv", path, spark)
    return read_table(path, PARTS, spark)


@query("src_headers_mixed", _PARTS_SQL)
def src_headers_mixed(spark, sf_dir):
    """One folder of files with a header, with one in another order, and with none."""
    path, part = scratch_path(spark, "part") + ".csv", table(spark, sf_dir, "part")
    other = part.select(*reversed(part.columns))
    for turn, (frame, header) in enumerate([(part, True), (other, True), (part, False)]):
        frame.where(F.col("p_partkey") % 3 == turn).write.mode("append").csv(path, header=header, escape='"')
    return read_headerless(path, part.schema, spark)


@query("src_convert_round_trip", _PARTS_SQL)
def src_convert_round_trip(spark, sf_dir):
    """Parquet to CSV and back."""
    there, back = scratch_path(spark, "part") + ".csv", scratch_path(spark, "part") + ".parquet"
    convert_format(f"{sf_dir}/part.parquet", "csv", there, spark)
    convert_format(read_table(there, PARTS, spark), "parquet", back, spark)
    return read_table(back, spark=spark)


def _requests(name: str, content_type: str, fmt: str, **options):
    def run(spark, sf_dir):
        path = scratch_path(spark, "requests")
        table(spark, sf_dir, "part").write.format(fmt).options(**options).save(path)
        return read_requests(path, content_type, PARTS if fmt != "parquet" else None, spark)

    query(name, _PARTS_SQL)(run)


_requests("src_requests_parquet", "application/x-parquet", "parquet")
_requests("src_requests_csv", "text/csv", "csv", header=True, escape='"')
_requests("src_requests_jsonl", "application/jsonl", "json")


@query("src_requests_json", _PARTS_SQL)
def src_requests_json(spark, sf_dir):
    """Request files holding one JSON array each, of about 500 records."""
    path = scratch_path(spark, "requests")
    part = table(spark, sf_dir, "part")
    bucket = F.pmod(F.xxhash64("p_partkey"), F.lit(max(1, part.count() // 500)))
    arrays = part.groupBy(bucket.alias("b")).agg(F.to_json(F.collect_list(F.struct(*part.columns))).alias("value"))
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(path)
    return read_requests(path, "application/json", PARTS, spark)


@query("src_headerless", _PARTS_SQL)
def src_headerless(spark, sf_dir):
    path = scratch_path(spark, "headerless")
    part = table(spark, sf_dir, "part")
    part.write.csv(path, header=False, escape='"')
    return read_headerless(path, part.schema, spark)


@query("src_header_any_order", "SELECT p_partkey, p_size FROM part")
def src_header_any_order(spark, sf_dir):
    path = scratch_path(spark, "headed")
    part = table(spark, sf_dir, "part").select("p_size", "p_partkey")
    part.write.csv(path, header=True)
    check_width(len(part.columns), 2)
    return read_headerless(path, part.select("p_partkey", "p_size").schema, spark)


# -- sinks ---------------------------------------------------------------------------------------


@query("snk_write_predictions", "SELECT c_custkey, c_acctbal FROM customer")
def snk_write_predictions(spark, sf_dir):
    path = scratch_path(spark, "predictions") + ".csv"
    write_predictions(table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal"), path)
    return read_predictions(path, "text/csv", "c_custkey bigint, c_acctbal double", spark)


def _render(name: str, accept: str):
    def run(spark, sf_dir):
        frame = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
        path = render(frame, accept, scratch_path(spark, "answer"))
        return read_predictions(path, accept, frame.schema, spark)

    query(name, "SELECT c_custkey, c_mktsegment FROM customer")(run)


_render("snk_render_parquet", "application/x-parquet")
_render("snk_render_csv", "text/csv")
_render("snk_render_json", "application/json")


@query(
    "snk_render_records",
    """SELECT '{"c_custkey":' || c_custkey || ',"c_mktsegment":"' || c_mktsegment || '"}' AS record FROM customer""",
)
def snk_render_records(spark, sf_dir):
    return render_records(table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"))


@query("snk_leaderboard", f"SELECT model, score_val FROM ({FORECASTS['fc_leaderboard']}) LIMIT 1")
def snk_leaderboard(spark, sf_dir):
    estimator = ForecastEstimator(prediction_length=7, freq="D", eval_metric="MAE", quantile_levels=LEVELS)
    board = estimator.fit(daily_events(spark, sf_dir), hyperparameters=list(BASELINES)).leaderboard(spark)
    path = write_leaderboard(board, scratch_path(spark, "leaderboard"))
    return best_model(read_leaderboard(path, spark)).select("model", F.round("score_val", 4).alias("score_val"))


# -- saved models -------------------------------------------------------------------------------------


@query("tab_save_load", BANDS_SQL)
def tab_save_load(spark, sf_dir):
    data, path = bands(spark, sf_dir), scratch_path(spark, "model")
    TabularEstimator("band", ignore_columns=KEYS).fit(data, hyperparameters={"tree": {"maxDepth": 2}}).save(spark, path)
    return rounded(TabularModel.load(spark, path).score(data, keys=KEYS))


@query("fc_save_load", FORECASTS["fc_lag_regression"])
def fc_save_load(spark, sf_dir):
    series, path = daily_events(spark, sf_dir), scratch_path(spark, "model")
    estimator = ForecastEstimator(prediction_length=7, freq="D", quantile_levels=LEVELS)
    options = {"lag_regression": {"lags": [7], "calendar": False}}
    estimator.fit(series, hyperparameters=options).save(spark, path)
    return rounded(ForecastModel.load(spark, path).predict(series), 3)


@query("fc_written", FORECASTS["fc_seasonal_naive"])
def fc_written(spark, sf_dir):
    """A forecast written by the call itself and read back."""
    path = scratch_path(spark, "forecast") + ".parquet"
    forecast(daily_events(spark, sf_dir), 7, quantile_levels=LEVELS, freq="D", predictions_path=path)
    return rounded(read_table(path, spark=spark))
