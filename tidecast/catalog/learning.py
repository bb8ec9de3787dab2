"""Tabular queries: schema rules, splits, closed-form and fitted models, leaderboards."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidecast.catalog.common import rounded, table
from tidecast.functions import metrics
from tidecast.operators.bayes import GaussianBayes, class_prior, group_mean
from tidecast.operators.columns import align_columns, feature_columns, stringify_columns
from tidecast.operators.proba import (
    best_class,
    average_models,
    concat_columns,
    distinct_classes,
    join_predictions,
    mirror_regression,
    predict_from_proba,
    split_pred_proba,
)
from tidecast.operators.splits import fold_of, holdout_rows, sample_n
from tidecast.plans.search import IntRange, RealRange
from tidecast.plans.tabular import TabularEstimator, problem_type

QUERIES: dict = {}
SQL: dict[str, str] = {}

KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def hash_sql(seed: int, *keys: str) -> str:
    text = " || '|' || ".join(f"CAST({k} AS VARCHAR)" for k in keys)
    return f"CAST('0x' || substr(md5('{seed}|' || {text}), 1, 15) AS BIGINT)"


# -- schema rules and prediction frames ----------------------------------------------------------


@query("tab_align", "SELECT l_quantity, l_discount, l_returnflag FROM lineitem")
def tab_align(spark, sf_dir):
    return align_columns(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_discount", "l_returnflag"])


@query("tab_feature_columns", "SELECT * EXCLUDE (c_mktsegment) FROM customer")
def tab_feature_columns(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    return customer.select(*feature_columns(customer, "c_mktsegment"))


@query("tab_stringify_columns", 'SELECT p_partkey AS "0", p_size AS "1", p_retailprice AS "2" FROM part')
def tab_stringify_columns(spark, sf_dir):
    return stringify_columns(table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice"), range(3))


@query("tab_problem_type", """SELECT 'l_returnflag' AS label, 'classification' AS problem UNION ALL
    SELECT 'l_linenumber', 'regression' UNION ALL SELECT 'l_extendedprice', 'regression' UNION ALL
    SELECT 'l_partkey', 'regression'""")
def tab_problem_type(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem")
    labels = ["l_returnflag", "l_linenumber", "l_extendedprice", "l_partkey"]
    return spark.createDataFrame([(c, problem_type(df, c)) for c in labels], "label string, problem string")


_SHARES = """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
           l_discount / (l_discount + l_tax + 0.05) AS pa, l_tax / (l_discount + l_tax + 0.05) AS pn,
           0.05 / (l_discount + l_tax + 0.05) AS pr FROM lineitem"""


def _prediction_frame(spark, sf_dir):
    """A prediction frame computed from the discount and tax of each line."""
    total = F.col("l_discount") + F.col("l_tax") + 0.05
    frame = table(spark, sf_dir, "lineitem").select(
        *KEYS,
        (F.col("l_discount") / total).alias("A_proba"),
        (F.col("l_tax") / total).alias("N_proba"),
        (F.lit(0.05) / total).alias("R_proba"),
    )
    predicted = predict_from_proba(frame, "flag", ["A", "N", "R"], KEYS + ["A_proba", "N_proba", "R_proba"])
    return predicted.select(*KEYS, "flag", "A_proba", "N_proba", "R_proba")


@query(
    "tab_argmax",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
        CASE WHEN pa >= pn AND pa >= pr THEN 'A' WHEN pn >= pr THEN 'N' ELSE 'R' END AS flag FROM ({_SHARES})""",
)
def tab_argmax(spark, sf_dir):
    return _prediction_frame(spark, sf_dir).select(*KEYS, "flag")


@query(
    "tab_split_proba",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(pa, 4) AS "A", round(pn, 4) AS "N",
        round(pr, 4) AS "R" FROM ({_SHARES})""",
)
def tab_split_proba(spark, sf_dir):
    return rounded(split_pred_proba(_prediction_frame(spark, sf_dir), KEYS)[1])


@query(
    "tab_concat_columns",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, count(*) AS n FROM (
            SELECT a.* FROM ({_SHARES}) a JOIN ({_SHARES}) b USING (l_orderkey, l_linenumber, l_partkey, l_suppkey))
        GROUP BY ALL""",
)
def tab_concat_columns(spark, sf_dir):
    """Prediction and probability frames put side by side again by key."""
    prediction, probabilities = split_pred_proba(_prediction_frame(spark, sf_dir), KEYS)
    return concat_columns(prediction, probabilities, KEYS).groupBy(*KEYS).agg(F.count("*").alias("n"))


@query("tab_reg_mirror", """SELECT p_partkey, round(p_retailprice * 1.1, 2) AS prediction,
    round(p_retailprice * 1.1, 2) AS mirrored FROM part""")
def tab_reg_mirror(spark, sf_dir):
    frame = table(spark, sf_dir, "part").select("p_partkey", F.round(F.col("p_retailprice") * 1.1, 2).alias("prediction"))
    prediction, probabilities = mirror_regression(frame, "prediction", ["p_partkey"])
    return prediction.join(probabilities.withColumnRenamed("prediction", "mirrored"), "p_partkey")


@query("tab_class_list", "SELECT DISTINCT c_mktsegment FROM customer")
def tab_class_list(spark, sf_dir):
    return distinct_classes(table(spark, sf_dir, "customer"), "c_mktsegment")


@query(
    "tab_join_predictions",
    """SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, CASE WHEN c_acctbal < 0 THEN 'low' ELSE 'high' END AS band
       FROM customer""",
)
def tab_join_predictions(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    band = F.when(F.col("c_acctbal") < 0, "low").otherwise("high")
    return join_predictions(customer, customer.select("c_custkey", band.alias("band")), ["c_custkey"])


# -- splits ------------------------------------------------------------------------------------------


@query("tab_holdout", f"SELECT c_custkey, {hash_sql(1, 'c_custkey')} % 100 < 10 AS held_out FROM customer")
def tab_holdout(spark, sf_dir):
    train, held = holdout_rows(table(spark, sf_dir, "customer").select("c_custkey"), ["c_custkey"], seed=1)
    return train.withColumn("held_out", F.lit(False)).unionByName(held.withColumn("held_out", F.lit(True)))


@query(
    "tab_folds",
    f"SELECT c_custkey, CAST({hash_sql(0, 'c_custkey')} % 5 AS INTEGER) AS fold FROM customer",
)
def tab_folds(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", fold_of(["c_custkey"], 5).alias("fold"))


@query("tab_sample_n", f"SELECT * FROM orders ORDER BY {hash_sql(7, 'o_orderkey')} LIMIT 1000")
def tab_sample_n(spark, sf_dir):
    return sample_n(table(spark, sf_dir, "orders"), 1000, ["o_orderkey"], seed=7)


@query(
    "tab_average_models",
    """WITH p AS (
        SELECT c_nationkey, c_acctbal / 1000 AS a FROM customer UNION ALL SELECT c_nationkey, c_acctbal / 2000 FROM customer)
       SELECT c_nationkey, round(avg(a), 4) AS a FROM p GROUP BY 1""",
)
def tab_average_models(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    parts = [customer.select("c_nationkey", (F.col("c_acctbal") / d).alias("a")) for d in (1000, 2000)]
    return rounded(average_models(parts[0].unionByName(parts[1]), ["c_nationkey"], ["a"]))


# -- closed forms ------------------------------------------------------------------------------------


@query(
    "tab_class_prior",
    """SELECT c_mktsegment, count(*) AS n, round(count(*) / (SELECT count(*) FROM customer), 6) AS prior
       FROM customer GROUP BY 1""",
)
def tab_class_prior(spark, sf_dir):
    return rounded(class_prior(table(spark, sf_dir, "customer"), "c_mktsegment"), 6)


@query(
    "tab_group_mean",
    """SELECT l_returnflag, l_linestatus, round(avg(l_extendedprice), 4) AS l_extendedprice, count(*) AS n
       FROM lineitem GROUP BY 1, 2""",
)
def tab_group_mean(spark, sf_dir):
    return rounded(group_mean(table(spark, sf_dir, "lineitem"), "l_extendedprice", ["l_returnflag", "l_linestatus"]))


_NB = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _nb_score(c: str) -> str:
    terms = [f"-0.5 * ln(2 * pi() * v_{f}_{c}) - ({f} - m_{f}_{c}) ** 2 / (2 * v_{f}_{c})" for f in _NB]
    return f"ln(p_{c}) + " + " + ".join(terms)


_NB_FIT = ", ".join(
    [f"avg(CASE WHEN l_returnflag = '{c}' THEN 1.0 ELSE 0 END) AS p_{c}" for c in "ANR"]
    + [f"avg({f}) FILTER (l_returnflag = '{c}') AS m_{f}_{c}" for f in _NB for c in "ANR"]
    + [f"var_pop({f}) FILTER (l_returnflag = '{c}') AS w_{f}_{c}" for f in _NB for c in "ANR"]
)
_NB_WIDEST = ", ".join(f"w_{f}_{c}" for f in _NB for c in "ANR")
_NB_VARIANCES = ", ".join(f"w_{f}_{c} + 1e-9 * greatest({_NB_WIDEST}) AS v_{f}_{c}" for f in _NB for c in "ANR")


@query(
    "tab_gnb",
    f"""
    WITH raw AS (SELECT {_NB_FIT} FROM lineitem), fit AS (SELECT *, {_NB_VARIANCES} FROM raw),
    s AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {_nb_score("A")} AS sa, {_nb_score("N")} AS sn,
                 {_nb_score("R")} AS sr FROM lineitem, fit),
    e AS (SELECT *, exp(sa - greatest(sa, sn, sr)) AS a, exp(sn - greatest(sa, sn, sr)) AS n,
                 exp(sr - greatest(sa, sn, sr)) AS r FROM s)
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(a / (a + n + r), 4) AS "A_proba",
           round(n / (a + n + r), 4) AS "N_proba", round(r / (a + n + r), 4) AS "R_proba" FROM e""",
)
def tab_gnb(spark, sf_dir):
    lineitem = table(spark, sf_dir, "lineitem")
    scored = GaussianBayes.fit(lineitem, "l_returnflag", _NB).predict_proba(lineitem, KEYS)
    return rounded(scored.drop("l_returnflag"))


# -- metrics -----------------------------------------------------------------------------------------


@query(
    "tab_accuracy",
    f"""SELECT round(avg(CASE WHEN l_returnflag = guess THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM (
        SELECT l_returnflag, CASE WHEN l_linestatus = 'O' THEN 'N' ELSE 'R' END AS guess FROM lineitem)""",
)
def tab_accuracy(spark, sf_dir):
    guess = F.when(F.col("l_linestatus") == "O", "N").otherwise("R")
    return rounded(
        table(spark, sf_dir, "lineitem").agg(metrics.accuracy(F.col("l_returnflag"), guess).alias("accuracy")), 6
    )


@query(
    "tab_roc_auc",
    """WITH r AS (SELECT l_linestatus = 'O' AS pos, l_extendedprice AS s FROM lineitem),
       k AS (SELECT pos, rank() OVER (ORDER BY s) AS lo, count(*) OVER (PARTITION BY s) AS ties FROM r)
       SELECT round((sum(CASE WHEN pos THEN lo + (ties - 1) / 2.0 END) - count(*) FILTER (pos) * (count(*) FILTER (pos) + 1) / 2.0)
              / (count(*) FILTER (pos) * count(*) FILTER (NOT pos)), 6) AS roc_auc FROM k""",
)
def tab_roc_auc(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem")
    area = metrics.roc_auc(df, F.col("l_linestatus"), "O", F.col("l_extendedprice"))
    return rounded(spark.createDataFrame([(area,)], "roc_auc double"), 6)


@query(
    "tab_log_loss",
    """WITH f AS (SELECT l_linestatus, l_returnflag, avg(CASE WHEN l_returnflag = 'A' THEN 1.0 ELSE 0 END) OVER w AS a,
                  avg(CASE WHEN l_returnflag = 'N' THEN 1.0 ELSE 0 END) OVER w AS n,
                  avg(CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0 END) OVER w AS r
                  FROM lineitem WINDOW w AS (PARTITION BY l_linestatus))
       SELECT round(-avg(ln(CASE l_returnflag WHEN 'A' THEN a WHEN 'N' THEN n ELSE r END)), 6) AS log_loss FROM f""",
)
def tab_log_loss(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").select("l_linestatus", "l_returnflag")
    shares = df.groupBy("l_linestatus").agg(
        *[F.avg((F.col("l_returnflag") == c).cast("double")).alias(c) for c in "ANR"]
    )
    loss = metrics.log_loss(F.col("l_returnflag"), list("ANR"), [F.col(c) for c in "ANR"])
    return rounded(df.join(shares, "l_linestatus").agg(loss.alias("log_loss")), 6)


# -- fitted models -----------------------------------------------------------------------------------


def bands(spark, sf_dir):
    """Price band of each line (the label) and its quantity band."""
    return table(spark, sf_dir, "lineitem").select(
        *KEYS,
        F.when(F.col("l_quantity") > 25, "bulk").otherwise("small").alias("size"),
        F.when(F.col("l_quantity") * 2000 + F.col("l_extendedprice") > 97000, "dear").otherwise("cheap").alias("band"),
    )


# A tree on one two-valued feature reproduces the class shares of each value.
BANDS_SQL = """
    WITH d AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
                      CASE WHEN l_quantity > 25 THEN 'bulk' ELSE 'small' END AS size,
                      CASE WHEN l_quantity * 2000 + l_extendedprice > 97000 THEN 'dear' ELSE 'cheap' END AS band FROM lineitem),
    f AS (SELECT size, avg(CASE WHEN band = 'cheap' THEN 1.0 ELSE 0 END) AS p FROM d GROUP BY 1)
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN p >= 0.5 THEN 'cheap' ELSE 'dear' END AS band,
           round(p, 4) AS cheap_proba, round(1 - p, 4) AS dear_proba FROM d JOIN f USING (size)"""


@query("tab_fit_predict_proba", BANDS_SQL)
def tab_fit_predict_proba(spark, sf_dir):
    data = bands(spark, sf_dir)
    estimator = TabularEstimator("band", ignore_columns=KEYS)
    proba = estimator.fit_predict_proba(
        data, data.drop("band"), include_predict=False, keys=KEYS, hyperparameters={"tree": {"maxDepth": 2}}
    )
    named = proba.withColumnsRenamed({"cheap": "cheap_proba", "dear": "dear_proba"})
    return rounded(named.withColumn("band", best_class([F.col("cheap_proba"), F.col("dear_proba")], ["cheap", "dear"])))


@query(
    "tab_bagged",
    f"""WITH d AS (SELECT c_custkey, c_nationkey % 2 AS side,
                   CASE WHEN c_acctbal + 4000 * (c_nationkey % 2) > 6000 THEN 1.0 ELSE 0 END AS rich,
                   {hash_sql(0, "c_custkey")} % 2 AS fold FROM customer),
        f AS (SELECT k.fold, d.side, avg(rich) AS p
              FROM d, (SELECT unnest([0, 1]) AS fold) k WHERE d.fold <> k.fold GROUP BY 1, 2)
        SELECT c_custkey, CASE WHEN avg(1 - p) >= avg(p) THEN 'no' ELSE 'yes' END AS rich,
               round(avg(1 - p), 4) AS no_proba, round(avg(p), 4) AS yes_proba
        FROM d JOIN f USING (side) GROUP BY c_custkey""",
)
def tab_bagged(spark, sf_dir):
    """Two folds: every customer gets the mean of two trees."""
    odd = F.col("c_nationkey") % 2
    data = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(odd == 0, "even").otherwise("odd").alias("side"),
        F.when(F.col("c_acctbal") + 4000 * odd > 6000, "yes").otherwise("no").alias("rich"),
    )
    estimator = TabularEstimator("rich", ignore_columns=["c_custkey"])
    model = estimator.fit(data, hyperparameters={"tree": {"maxDepth": 2}}, num_bag_folds=2, keys=["c_custkey"])
    return rounded(model.score(data, keys=["c_custkey"]))


@query(
    "tab_regression",
    """WITH line AS (SELECT regr_slope(l_extendedprice, l_quantity) AS w, regr_intercept(l_extendedprice, l_quantity) AS c
                     FROM lineitem)
       SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(w * l_quantity + c, 2) AS l_extendedprice
       FROM lineitem, line""",
)
def tab_regression(spark, sf_dir):
    data = table(spark, sf_dir, "lineitem").select(*KEYS, "l_quantity", "l_extendedprice")
    model = TabularEstimator("l_extendedprice", ignore_columns=KEYS).fit(data, hyperparameters=["linear"])
    return rounded(model.predict(data, keys=KEYS), 2)


@query("tab_linear_proba")
def tab_linear_proba(spark, sf_dir):
    """Logistic regression on all columns of the line."""
    data = table(spark, sf_dir, "lineitem")
    model = TabularEstimator("l_returnflag", ignore_columns=["l_orderkey", "l_partkey"]).fit(
        data, hyperparameters={"linear": {"maxIter": 20}}
    )
    return rounded(model.score(data, keys=KEYS))


@query("tab_leaderboard")
def tab_leaderboard(spark, sf_dir):
    """Best-quality preset on a binary label, scored by area under the ROC curve."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderdate", "o_orderpriority")
    data = orders.withColumn("big", F.when(F.col("o_totalprice") > 200000, "yes").otherwise("no")).drop("o_totalprice")
    estimator = TabularEstimator("big", eval_metric="roc_auc", ignore_columns=["o_orderkey"])
    model = estimator.fit(data, presets="best_quality", keys=["o_orderkey"])
    return rounded(model.leaderboard(spark).drop("fit_time"))


# Customers by side with a label that depends on it; a tenth is held out by key hash.
_SIDES = f"""d AS (SELECT c_custkey, c_nationkey % 2 AS side,
                   CASE WHEN c_acctbal + 4000 * (c_nationkey % 2) > 6000 THEN 1.0 ELSE 0 END AS rich,
                   {hash_sql(1, "c_custkey")} % 100 < 10 AS held FROM customer),
        f AS (SELECT side, avg(rich) AS p FROM d WHERE NOT held GROUP BY 1)"""


def _sides(spark, sf_dir):
    odd = F.col("c_nationkey") % 2
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(odd == 0, "even").otherwise("odd").alias("side"),
        F.when(F.col("c_acctbal") + 4000 * odd > 6000, "yes").otherwise("no").alias("rich"),
    )


@query(
    "tab_search",
    f"""WITH {_SIDES}, o AS (SELECT avg(rich) AS p FROM d WHERE NOT held),
        t AS (SELECT 'tree/1' AS model, rich, f.p FROM d JOIN f USING (side) WHERE held
              UNION ALL SELECT 'tree/2', rich, o.p FROM d, o WHERE held)
        SELECT model, round(avg(ln(CASE WHEN rich = 1 THEN p ELSE 1 - p END)), 4) AS score_val, 'log_loss' AS eval_metric
        FROM t GROUP BY model""",
)
def tab_search(spark, sf_dir):
    """Two of three trials over the smallest leaf; the second one cannot split at all."""
    model = TabularEstimator("rich", eval_metric="log_loss", ignore_columns=["c_custkey"]).fit(
        _sides(spark, sf_dir),
        hyperparameters={"tree": {"maxDepth": 2, "minInstancesPerNode": [1, 2**30, 5]}},
        hyperparameter_tune_kwargs={"num_trials": 2},
        keys=["c_custkey"],
    )
    return rounded(model.leaderboard(spark).drop("fit_time"))


@query(
    "tab_search_ranges",
    f"""WITH {_SIDES}, t AS (SELECT unnest(['tree/1', 'tree/2']) AS model, rich, p FROM d JOIN f USING (side) WHERE held)
        SELECT model, round(avg(ln(CASE WHEN rich = 1 THEN p ELSE 1 - p END)), 4) AS score_val, 'log_loss' AS eval_metric
        FROM t GROUP BY model""",
)
def tab_search_ranges(spark, sf_dir):
    """Two trials of a depth and a smallest leaf drawn from ranges; any of them gives the same tree."""
    model = TabularEstimator("rich", eval_metric="log_loss", ignore_columns=["c_custkey"]).fit(
        _sides(spark, sf_dir),
        hyperparameters={"tree": {"maxDepth": IntRange(1, 4), "minInfoGain": RealRange(1e-9, 1e-7, log=True)}},
        hyperparameter_tune_kwargs={"num_trials": 2, "seed": 5},
        keys=["c_custkey"],
    )
    return rounded(model.leaderboard(spark).drop("fit_time"))


@query(
    "tab_search_halving",
    f"""WITH {_SIDES}
        SELECT 'tree/1' AS model, round(avg(ln(CASE WHEN rich = 1 THEN p ELSE 1 - p END)), 4) AS score_val, 'log_loss' AS eval_metric
        FROM d JOIN f USING (side) WHERE held""",
)
def tab_search_halving(spark, sf_dir):
    """Four trials on a quarter of the rows, two on half, one on all; of equal trials the first goes on."""
    model = TabularEstimator("rich", eval_metric="log_loss", ignore_columns=["c_custkey"]).fit(
        _sides(spark, sf_dir),
        hyperparameters={"tree": {"maxDepth": 2, "minInstancesPerNode": [1, 2, 3, 4]}},
        hyperparameter_tune_kwargs={"scheduler": "halving", "eta": 2},
        keys=["c_custkey"],
    )
    return rounded(model.leaderboard(spark).drop("fit_time"))


@query(
    "tab_named_candidate",
    f"""WITH {_SIDES}
        SELECT c_custkey, CASE WHEN 1 - p >= p THEN 'no' ELSE 'yes' END AS rich, round(1 - p, 4) AS no_proba,
               round(p, 4) AS yes_proba FROM d JOIN f USING (side)""",
)
def tab_named_candidate(spark, sf_dir):
    """Score with a named candidate instead of the best one."""
    data = _sides(spark, sf_dir)
    model = TabularEstimator("rich", ignore_columns=["c_custkey"]).fit(
        data, hyperparameters={"linear": {"maxIter": 5}, "tree": {"maxDepth": 2}}, keys=["c_custkey"]
    )
    return rounded(model.score(data, keys=["c_custkey"], model="tree"))


@query(
    "tab_tuning_data",
    f"""WITH {_SIDES}, s AS (SELECT side, p >= 0.5 AS yes FROM f)
        SELECT 'tree' AS model, round(avg(CASE WHEN (rich = 1) = yes THEN 1.0 ELSE 0 END), 4) AS score_val,
               'accuracy' AS eval_metric FROM d JOIN s USING (side) WHERE held""",
)
def tab_tuning_data(spark, sf_dir):
    """The held-out tenth passed as explicit tuning data."""
    train, tuning = holdout_rows(_sides(spark, sf_dir), ["c_custkey"], seed=1)
    estimator = TabularEstimator("rich", ignore_columns=["c_custkey"])
    model = estimator.fit(train, tuning, hyperparameters={"tree": {"maxDepth": 2}})
    return rounded(model.leaderboard(spark).drop("fit_time"))
