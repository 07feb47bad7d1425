"""Metrics, calibration, preprocessing and models."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from ..ml import preprocessing as prep
from ..ml import training as ml
from ..ml.inference import imputation_report, impute, predict_volumes, prediction_counts
from ..ml.models import get_model
from ..operators import calibration as cal
from ..operators import metrics as met
from ..operators.additive import Additive, RatioOfSums
from ..operators.columns import rename
from ..operators.ranking import seeded_sample
from ..session import reuse
from ..sources.training_data import ENHANCED, TRAINING_TO_MODEL
from . import stand_ins as t
from .registry import query, rounded, table

SST = "sum((y_true - my) * (y_true - my))"
METRIC_SQL = """round(1 - sum((y_true - {p}) * (y_true - {p})) / sum((y_true - my) * (y_true - my)), 6) AS {x}r2,
   round(sqrt(avg((y_true - {p}) * (y_true - {p}))), 6) AS {x}rmse, round(avg(abs(y_true - {p})), 6) AS {x}mae,
   round(avg(abs(y_true - {p}) / greatest(abs(y_true), 2.220446049250313e-16::DOUBLE)), 6) AS {x}mape,
   round(max(abs(y_true - {p})), 6) AS {x}max_error,
   round(avg(1 / (1 + sqrt(({p} - y_true) * ({p} - y_true) / (10000 * greatest(y_true, 1e-10::DOUBLE))))), 6) AS {x}sqv"""


def _metric_sql(p: str = "y_pred", x: str = "") -> str:
    return METRIC_SQL.format(p=p, x=x)


@query(
    "metrics",
    t.sql(f"SELECT {_metric_sql()}, CAST(count(*) AS BIGINT) AS n_samples FROM (SELECT *, avg(y_true) OVER () AS my FROM scored)", "scored"),
)
def metrics(spark, sf):
    return rounded(met.regression_metrics(t.scored(spark, sf)))


@query(
    "metrics_by_status",
    t.sql(
        f"""SELECT o_orderstatus, {_metric_sql()}, CAST(count(*) AS BIGINT) AS n_samples
            FROM (SELECT *, avg(y_true) OVER (PARTITION BY o_orderstatus) AS my FROM scored) GROUP BY 1""",
        "scored",
    ),
)
def metrics_by_status(spark, sf):
    return rounded(met.regression_metrics(t.scored(spark, sf), by=["o_orderstatus"]))


@query(
    "sqv",
    t.sql("SELECT round(avg(1 / (1 + sqrt((y_pred - y_true) * (y_pred - y_true) / (1000 * greatest(y_true, 1e-10::DOUBLE))))), 8) AS sqv FROM scored", "scored"),
)
def sqv(spark, sf):
    return rounded(met.sqv(t.scored(spark, sf), scale=1000.0), 8)


REL = "abs(y_pred - y_true) / greatest(y_true, 1e-10::DOUBLE)"


@query(
    "accuracy_bands",
    t.sql("SELECT " + ", ".join(f"round(avg(CASE WHEN {REL} <= {b / 100}::DOUBLE THEN 1 ELSE 0 END), 6) AS within_{b}pct" for b in (10, 20, 30, 50)) + " FROM scored", "scored"),
)
def accuracy_bands(spark, sf):
    return rounded(met.accuracy_bands(t.scored(spark, sf)))


@query(
    "residuals",
    t.sql(
        """SELECT round(avg(r), 6) AS residual_mean, round(stddev_pop(r), 6) AS residual_std, round(min(r), 6) AS residual_min, round(max(r), 6) AS residual_max,
                  round(quantile_cont(r, 0.5), 6) AS residual_median FROM (SELECT y_true - y_pred AS r FROM scored)""",
        "scored",
    ),
)
def residuals(spark, sf):
    return rounded(met.residual_stats(t.scored(spark, sf)))


@query(
    "range_table",
    t.sql(
        """SELECT o_orderpriority AS model, min(y_pred) AS min_predicted, max(y_pred) AS max_predicted, round(avg(y_pred), 6) AS mean_predicted,
                  min(y_true) AS min_actual, max(y_true) AS max_actual FROM scored GROUP BY 1""",
        "scored",
    ),
)
def range_table(spark, sf):
    return rounded(met.range_table(t.scored(spark, sf).withColumnRenamed("o_orderpriority", "model")))


@query(
    "metrics_report",
    t.sql(
        f"""SELECT model, r2 AS "R2", -mape AS "neg_MAPE", -mae AS "neg_MAE", max_error, sqv AS "SQV", r2 AS "R2_no_CV"
            FROM (SELECT o_orderpriority AS model, {_metric_sql()} FROM (SELECT *, avg(y_true) OVER (PARTITION BY o_orderpriority) AS my FROM scored) GROUP BY 1)""",
        "scored",
    ),
)
def metrics_report(spark, sf):
    scores = met.regression_metrics(t.scored(spark, sf).withColumnRenamed("o_orderpriority", "model"), by=["model"])
    scores = rounded(scores).withColumns({"r2_cv": F.col("r2"), "r2_no_cv": F.col("r2")})
    return met.metrics_table(scores)


@query(
    "linear_fit",
    t.sql(
        """SELECT round(regr_slope(y_true, y_pred), 8) AS slope, round(regr_intercept(y_true, y_pred), 6) AS intercept,
                  round(corr(y_true, y_pred) * corr(y_true, y_pred), 10) AS r2 FROM scored""",
        "scored",
    ),
)
def linear_fit(spark, sf):
    fit = met.linear_fit(t.scored(spark, sf), "y_true", "y_pred")
    return fit.select(F.round("slope", 8).alias("slope"), F.round("intercept", 6).alias("intercept"), F.round("r2", 10).alias("r2"))


@query(
    "prediction_summary",
    t.sql(
        """SELECT CAST(count(*) AS BIGINT) AS n_valid, round(corr(y_true, y_pred), 8) AS correlation, min(y_pred) AS min, max(y_pred) AS max,
                  round(quantile_cont(y_pred, 0.5), 8) AS median FROM scored""",
        "scored",
    ),
)
def prediction_summary(spark, sf):
    return rounded(met.prediction_summary(t.scored(spark, sf), "y_true", "y_pred"), 8)


BIN = "CAST(least(floor(({c} - lo{s}) / (hi{s} - lo{s}) * {n}), {m}) AS INTEGER)"


@query(
    "histogram",
    "SELECT " + BIN.format(c="o_totalprice", s="", n=50, m=49) + """ AS bin, CAST(count(*) AS BIGINT) AS n
       FROM orders, (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders) GROUP BY 1""",
)
def histogram(spark, sf):
    return met.histogram(table(spark, sf, "orders"), "o_totalprice", 50)


@query(
    "density",
    t.sql(
        "SELECT " + BIN.format(c="y_pred", s="1", n=20, m=19) + " AS x_bin, " + BIN.format(c="y_true", s="2", n=20, m=19) + """ AS y_bin, CAST(count(*) AS BIGINT) AS n
           FROM scored, (SELECT min(y_pred) AS lo1, max(y_pred) AS hi1, min(y_true) AS lo2, max(y_true) AS hi2 FROM scored) GROUP BY 1, 2""",
        "scored",
    ),
)
def density(spark, sf):
    return met.density(t.scored(spark, sf), "y_pred", "y_true", 20)


@query(
    "content_hash",
    """SELECT CAST(count(*) AS BIGINT) AS n_rows, count(*) > 0 AS same_when_shuffled, count(*) FILTER (WHERE o_orderkey % 1000 = 7) = 0 AS same_when_edited,
              FALSE AS same_when_doubled FROM orders""",
)
def content_hash(spark, sf):
    orders = table(spark, sf, "orders")
    own = met.content_hash(orders)
    others = {
        "same_when_shuffled": orders.repartition(5, "o_totalprice"),
        "same_when_edited": orders.withColumn("o_totalprice", F.when(F.col("o_orderkey") % 1000 == 7, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))),
        "same_when_doubled": orders.unionAll(orders),
    }
    out = own
    for name, frame in others.items():
        other = met.content_hash(frame).select(F.struct("n_rows", "hash_xor", "hash_sum").alias(name))
        out = out.join(other)  # one row each
    mine = F.struct("n_rows", "hash_xor", "hash_sum")
    return out.select("n_rows", *[(mine == F.col(name)).alias(name) for name in others])


@query(
    "seeded_sample",
    t.sql("SELECT CAST(least(count(*), 10000) AS BIGINT) AS n, CAST(least(count(*), 10000) AS BIGINT) AS n_of_the_table, CAST(least(count(*), 10000) AS BIGINT) AS n_again FROM scored", "scored"),
)
def sample(spark, sf):
    rows = t.scored(spark, sf).select("id", "y_true", "y_pred")
    first = seeded_sample(rows, 10_000, 42, ["id"]).withColumn("_first", F.lit(True))
    again = seeded_sample(rows.repartition(3, "y_pred"), 10_000, 42, ["id"]).select("id").withColumn("_again", F.lit(True))
    known = rows.join(first.select("id", "_first"), "id", "left").join(again, "id", "left").where("_first or _again")
    return known.agg(F.count("_first").alias("n"), F.count_if("_first").alias("n_of_the_table"), F.count_if(F.col("_first") & F.col("_again")).alias("n_again"))


# --- calibration -----------------------------------------------------------------------------

# values in the ten thousands; the exponential carries the order of summation into their ninth digit
LOG_DIGITS = 2
VALID = "y_pred > 0 AND y_true >= 0"
FACTOR = f"coalesce(least(greatest(median(CASE WHEN {VALID} THEN y_true / y_pred END), 0.1::DOUBLE), 10), 1)"
LINE = "regr_sxy(ln(1 + y_true), ln(1 + y_pred)) / (regr_sxx(ln(1 + y_true), ln(1 + y_pred)) + 1)"


@query("calib_global", t.sql(f"SELECT id, round(y_pred * (SELECT {FACTOR} FROM station), 6) AS y_calibrated FROM station", "station"))
def calib_global(spark, sf):
    s = t.station(spark, sf)
    return rounded(cal.GlobalMultiplicative().fit(s).apply(s).select("id", "y_calibrated"))


@query(
    "calib_loglinear",
    t.sql(
        f"""SELECT id, round(greatest(exp(a * ln(1 + y_pred) + my - a * mx) - 1, 0), {LOG_DIGITS}) AS y_calibrated
            FROM station, (SELECT {LINE} AS a, avg(ln(1 + y_true)) AS my, avg(ln(1 + y_pred)) AS mx FROM station)""",
        "station",
    ),
)
def calib_loglinear(spark, sf):
    s = t.station(spark, sf)
    return rounded(cal.LogLinear().fit(s).apply(s).select("id", "y_calibrated"), LOG_DIGITS)


@query(
    "calib_stratified",
    t.sql(
        f"""SELECT id, round(y_pred * CASE WHEN f.n >= 200 THEN f.factor ELSE (SELECT {FACTOR} FROM station) END, 6) AS y_calibrated
            FROM station s LEFT JOIN (SELECT stratum, count(*) AS n, {FACTOR} AS factor FROM station GROUP BY 1) f ON s.stratum IS NOT DISTINCT FROM f.stratum""",
        "station",
    ),
)
def calib_stratified(spark, sf):
    s = t.station(spark, sf)
    fitted = cal.create_calibrator("stratified", ["stratum"], 200).fit(s)
    return rounded(fitted.apply(s).select("id", "y_calibrated"))


@query(
    "calib_strata",
    t.sql(f"SELECT stratum, CAST(count(*) AS BIGINT) AS n, round({FACTOR}, 8) AS factor FROM station GROUP BY 1 HAVING count(*) >= 3", "station"),
)
def calib_strata(spark, sf):
    return rounded(cal.Stratified(["stratum"]).fit(t.station(spark, sf)).strata(), 8)


@query(
    "calib_loocv",
    t.sql(
        f"""SELECT a.id, round(abs(a.y_pred * coalesce(least(greatest(median(CASE WHEN b.y_pred > 0 AND b.y_true >= 0 THEN b.y_true / b.y_pred END), 0.1::DOUBLE), 10), 1)
              - a.y_true), 6) AS abs_error FROM station a JOIN station b ON a.id <> b.id GROUP BY a.id, a.y_pred, a.y_true""",
        "station",
    ),
)
def calib_loocv(spark, sf):
    s = t.station(spark, sf)
    return rounded(cal.loocv_errors(cal.GlobalMultiplicative().fit(s), s).select("id", "abs_error"))


LOO_LINE = "regr_sxy(ln(1 + b.y_true), ln(1 + b.y_pred)) / (regr_sxx(ln(1 + b.y_true), ln(1 + b.y_pred)) + 1)"


@query(
    "calib_loocv_loglinear",
    t.sql(
        f"""SELECT id, round(abs(greatest(exp(s * ln(1 + y_pred) + my - s * mx) - 1, 0) - y_true), {LOG_DIGITS}) AS abs_error FROM
              (SELECT a.id, a.y_pred, a.y_true, {LOO_LINE} AS s, avg(ln(1 + b.y_true)) AS my, avg(ln(1 + b.y_pred)) AS mx
               FROM station a JOIN station b ON a.id <> b.id GROUP BY 1, 2, 3)""",
        "station",
    ),
)
def calib_loocv_loglinear(spark, sf):
    s = t.station(spark, sf)
    return rounded(cal.loocv_errors(cal.LogLinear().fit(s), s).select("id", "abs_error"), LOG_DIGITS)


@query(
    "calib_loocv_summary",
    t.sql(
        f"""SELECT round(avg(e), 3) AS mae_mean, round(stddev_pop(e), 3) AS mae_std, round(sqrt(avg(e * e)), 3) AS rmse_mean, round(stddev_pop(e), 3) AS rmse_std,
                   CAST(count(*) AS BIGINT) AS n_folds FROM (
              SELECT abs(greatest(exp(s * ln(1 + y_pred) + my - s * mx) - 1, 0) - y_true) AS e FROM
                (SELECT a.id, a.y_pred, a.y_true, {LOO_LINE} AS s, avg(ln(1 + b.y_true)) AS my, avg(ln(1 + b.y_pred)) AS mx
                 FROM station a JOIN station b ON a.id <> b.id GROUP BY 1, 2, 3))""",
        "station",
    ),
)
def calib_loocv_summary(spark, sf):
    s = t.station(spark, sf)
    return rounded(cal.loocv(cal.LogLinear().fit(s), s), 3)


@query(
    "calib_loocv_stratified",
    t.sql(
        f"""SELECT a.id, round(abs(a.y_pred * coalesce(least(greatest(CASE WHEN count(b.id) FILTER (WHERE b.stratum IS NOT DISTINCT FROM a.stratum) >= 200
              THEN median(CASE WHEN b.stratum IS NOT DISTINCT FROM a.stratum AND b.y_pred > 0 AND b.y_true >= 0 THEN b.y_true / b.y_pred END)
              ELSE median(CASE WHEN b.y_pred > 0 AND b.y_true >= 0 THEN b.y_true / b.y_pred END) END, 0.1::DOUBLE), 10), 1) - a.y_true), 6) AS abs_error
            FROM station a JOIN station b ON a.id <> b.id GROUP BY a.id, a.y_pred, a.y_true, a.stratum""",
        "station",
    ),
)
def calib_loocv_stratified(spark, sf):
    s = t.station(spark, sf)
    fitted = cal.Stratified(["stratum"], 200).fit(s)
    return rounded(cal.loocv_errors(fitted, s).select("id", "abs_error"))


@query(
    "calib_improvement",
    t.sql(
        f"""SELECT *, round((raw_mae - cal_mae) / raw_mae, 5) AS mae_reduction, round((raw_rmse - cal_rmse) / raw_rmse, 5) AS rmse_reduction FROM (
              SELECT {_metric_sql("y_pred", "raw_")}, {_metric_sql("y_cal", "cal_")}, CAST(count(*) AS BIGINT) AS n_stations
              FROM (SELECT *, y_pred * (SELECT {FACTOR} FROM station) AS y_cal, avg(y_true) OVER () AS my FROM station))""",
        "station",
    ),
)
def calib_improvement(spark, sf):
    _, row = cal.calibrate_and_evaluate(cal.GlobalMultiplicative(), t.station(spark, sf))
    kept = [f"{x}_{m}" for x in ("raw", "cal") for m in met.METRICS]
    out = rounded(row.select(*kept, "n_stations", "mae_reduction", "rmse_reduction"))
    return rounded(out, 5, "mae_reduction", "rmse_reduction")


@query(
    "calib_apply",
    t.sql(
        f"""SELECT id, y_pred AS predicted_dtv_uncalibrated, round(y_pred * (SELECT {FACTOR} FROM station), 6) AS predicted_dtv FROM scored""",
        "scored",
        "station",
    ),
)
def calib_apply(spark, sf):
    fitted = cal.GlobalMultiplicative().fit(t.station(spark, sf))
    edges = t.scored(spark, sf).select("id", F.col("y_pred").alias("predicted_dtv"))
    return rounded(cal.apply_to_edges(fitted, edges), 6, "predicted_dtv")


@query("calib_params", t.sql(f"SELECT 'global_multiplicative' AS calibrator_type, round({FACTOR}, 6) AS factor, CAST(count(*) AS BIGINT) AS n_stations FROM station", "station"))
def calib_params(spark, sf):
    fitted = cal.GlobalMultiplicative().fit(t.station(spark, sf))
    factor = F.round(F.get_json_object("params", "$.factor").cast("double"), 6)
    return cal.params_table(fitted, spark).select("calibrator_type", factor.alias("factor"), "n_stations")


SUMS = "coalesce(least(greatest(sum(CASE WHEN {v} THEN {t} END) / sum(CASE WHEN {v} THEN {p} END), 0.1::DOUBLE), 10), 1)"
SUM_FACTOR = SUMS.format(v=VALID, t="y_true", p="y_pred")
SUM_FACTOR_B = SUMS.format(v="b.y_pred > 0 AND b.y_true >= 0", t="b.y_true", p="b.y_pred")


def _halves(s):
    """Fits of the stations with an even and with an odd id, by stratum."""
    of = lambda k: Additive(RatioOfSums(), ("stratum",), 40).fit(s.where(F.pmod("id", F.lit(2)) == k))
    return of(0), of(1)


@query(
    "calib_merged",
    t.sql(
        f"""SELECT id, round(y_pred * CASE WHEN f.n >= 40 THEN f.factor ELSE (SELECT {SUM_FACTOR} FROM station) END, 6) AS y_calibrated
            FROM station s LEFT JOIN (SELECT stratum, count(*) AS n, {SUM_FACTOR} AS factor FROM station GROUP BY 1) f ON s.stratum IS NOT DISTINCT FROM f.stratum""",
        "station",
    ),
)
def calib_merged(spark, sf):
    """C4: states of two halves merged, equal to one fit of all stations."""
    s = t.station(spark, sf)
    even, odd = _halves(s)
    return rounded(even.merge(odd).apply(s).select("id", "y_calibrated"))


@query(
    "calib_withdrawn",
    t.sql(f"SELECT stratum, CAST(count(*) AS BIGINT) AS n, round({SUM_FACTOR}, 8) AS factor FROM station WHERE id % 2 = 0 GROUP BY 1 HAVING count(*) >= 40", "station"),
)
def calib_withdrawn(spark, sf):
    """C4: half of the stations subtracted from a fit of all."""
    s = t.station(spark, sf)
    everything, (_, odd) = Additive(RatioOfSums(), ("stratum",), 40).fit(s), _halves(s)
    return rounded(everything.subtract(odd).strata(), 8)


@query(
    "calib_loocv_merged",
    t.sql(
        f"""SELECT a.id, round(abs(a.y_pred * CASE WHEN count(b.id) FILTER (WHERE b.stratum IS NOT DISTINCT FROM a.stratum) >= 40
              THEN {SUM_FACTOR_B.replace(" END)", " END) FILTER (WHERE b.stratum IS NOT DISTINCT FROM a.stratum)")} ELSE {SUM_FACTOR_B} END - a.y_true), {LOG_DIGITS}) AS abs_error
            FROM station a JOIN station b ON a.id <> b.id GROUP BY a.id, a.y_pred, a.y_true, a.stratum""",
        "station",
    ),
)
def calib_loocv_merged(spark, sf):
    """Leave-one-out errors from merged sums less each station's share."""
    s = t.station(spark, sf)
    even, odd = _halves(s)
    return rounded(cal.loocv_errors(even.merge(odd), s).select("id", "abs_error"), LOG_DIGITS)


# --- preprocessing ---------------------------------------------------------------------------

GAPPY = """SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_acctbal END AS bal, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_mktsegment END AS seg,
                  CAST(NULL AS DOUBLE) AS nothing FROM customer"""


def _gappy(spark, sf):
    k = F.col("c_custkey")
    return table(spark, sf, "customer").select(
        "c_custkey",
        F.when(k % 7 != 0, F.col("c_acctbal")).alias("bal"),
        F.when(k % 5 != 0, F.col("c_mktsegment")).alias("seg"),
        F.lit(None).cast("double").alias("nothing"),
    )


@query(
    "impute",
    f"""WITH g AS ({GAPPY}) SELECT c_custkey, round(coalesce(bal, (SELECT median(bal) FROM g)), 6) AS bal,
          coalesce(seg, (SELECT seg FROM g WHERE seg IS NOT NULL GROUP BY seg ORDER BY count(*) DESC, seg LIMIT 1)) AS seg, coalesce(nothing, 0) AS nothing FROM g""",
)
def impute_query(spark, sf):
    return rounded(impute(_gappy(spark, sf), ["bal", "seg", "nothing"]))


@query(
    "imputation_report",
    f"""WITH g AS ({GAPPY}) SELECT 'seg' AS "column", CAST(count(*) FILTER (WHERE seg IS NULL) AS BIGINT) AS n_missing,
          (SELECT seg FROM g WHERE seg IS NOT NULL GROUP BY seg ORDER BY count(*) DESC, seg LIMIT 1) AS fill_value FROM g
        UNION ALL SELECT 'nothing', count(*) FILTER (WHERE nothing IS NULL), '0.0' FROM g""",
)
def imputation_report_query(spark, sf):
    return imputation_report(_gappy(spark, sf), ["seg", "nothing"])


@query(
    "standard_scale",
    "SELECT o_orderkey, round((o_totalprice - (SELECT avg(o_totalprice) FROM orders)) / (SELECT stddev_pop(o_totalprice) FROM orders), 6) AS z FROM orders",
)
def standard_scale(spark, sf):
    return rounded(prep.standard_scale(table(spark, sf, "orders"), "o_totalprice", "z").select("o_orderkey", "z"))


@query(
    "robust_scale",
    """SELECT o_orderkey, round((o_totalprice - m) / (b - a), 6) AS z FROM orders,
         (SELECT median(o_totalprice) AS m, quantile_cont(o_totalprice, 0.25) AS a, quantile_cont(o_totalprice, 0.75) AS b FROM orders)""",
)
def robust_scale(spark, sf):
    return rounded(prep.robust_scale(table(spark, sf, "orders"), "o_totalprice", "z").select("o_orderkey", "z"))


@query(
    "ordinal_encode",
    t.sql(
        """SELECT edge_id, CAST(CASE raw WHEN 'no' THEN 0 WHEN 'mixed_way' THEN 1 WHEN 'mit_road' THEN 2 WHEN 'bicycle_lane' THEN 3 WHEN 'bicycle_road' THEN 4
                  WHEN 'bicycle_way' THEN 5 ELSE -1 END AS DOUBLE) AS code FROM edge_class""",
        "edge_class",
    ),
)
def ordinal_encode(spark, sf):
    return t.edge_class(spark, sf).select("edge_id", prep.ordinal_code(F.col("raw")).alias("code"))


@query(
    "target_transform",
    """SELECT o_orderkey, round(ln(1 + o_totalprice), 8) AS label, round(least(greatest(exp(ln(1 + o_totalprice) * 1.07::DOUBLE) - 1, 0),
         2 * (SELECT max(o_totalprice) FROM orders)), 3) AS restored FROM orders""",
)
def target_transform(spark, sf):
    df = table(spark, sf, "orders")
    tt = prep.TargetTransform.fitted(df, "o_totalprice")
    label = tt.forward(F.col("o_totalprice"))
    return df.select("o_orderkey", F.round(label, 8).alias("label"), F.round(tt.inverse(label * 1.07), 3).alias("restored"))


@query(
    "train_test_split",
    """SELECT CAST(count(*) AS BIGINT) AS n_all, CAST(count(DISTINCT o_orderkey) AS BIGINT) AS n_distinct, count(*) > 100 AS near_fifth,
              CAST(0 AS BIGINT) AS n_moved FROM orders""",
)
def train_test_split(spark, sf):
    train, test = prep.train_test_split(table(spark, sf, "orders"), 0.2, 42, ["o_orderkey"])
    both = train.withColumn("part", F.lit(0)).unionByName(test.withColumn("part", F.lit(1)))
    # a row stays on its side however the table is partitioned
    _, again = prep.train_test_split(table(spark, sf, "orders").repartition(5, "o_totalprice"), 0.2, 42, ["o_orderkey"])
    both = both.join(again.select("o_orderkey", F.lit(1).alias("again")), "o_orderkey", "left")
    return both.agg(
        F.count("*").alias("n_all"),
        F.countDistinct("o_orderkey").alias("n_distinct"),
        F.avg("part").between(0.15, 0.25).alias("near_fifth"),
        F.count_if(F.col("part") != F.coalesce("again", F.lit(0))).alias("n_moved"),
    )


# --- models: solvers differ between engines, so only the rows are checked ----------------------


def _learning_table(spark, sf):
    df = rename(t.training(spark, sf), TRAINING_TO_MODEL)
    noisy = F.col("stadtradeln_volume") * (20 + F.col("regiostar7") % 5) + F.col("dtv") / 50
    # fits and scores read it several times, the join behind it should run once
    return reuse(df.where("dtv is not null and stadtradeln_volume > 0").withColumn("dtv", noisy))


FEATURES = list(ENHANCED)
SMALL_FOREST = {"numTrees": 16, "maxDepth": 6}
SMALL_BOOST = {"maxIter": 8}


def _fit_metrics(spark, sf, name, features=FEATURES, **params):
    df = _learning_table(spark, sf)
    trained = ml.fit_model(df, name, features, **params)
    return rounded(met.regression_metrics(trained.predict(df, "y_pred"), "dtv", "y_pred")).withColumn("model", F.lit(name))


@query("boxcox_lambda")
def boxcox_lambda(spark, sf):
    lam = prep.fit_power_lambda(table(spark, sf, "orders"), "o_totalprice")
    return table(spark, sf, "orders").agg(
        F.lit(lam).alias("lambda"), F.round(F.avg(prep.power_transform(F.col("o_totalprice"), lam)), 4).alias("mean_transformed")
    )


@query("train_linear")
def train_linear(spark, sf):
    return _fit_metrics(spark, sf, "Linear Regression")


@query("train_poisson")
def train_poisson(spark, sf):
    return _fit_metrics(spark, sf, "Poisson", regParam=0.1)


@query("train_lasso")
def train_lasso(spark, sf):
    return _fit_metrics(spark, sf, "Lasso Regression", regParam=0.01)


@query("train_elasticnet")
def train_elasticnet(spark, sf):
    return _fit_metrics(spark, sf, "ElasticNet Regression", regParam=0.01)


@query("train_forest")
def train_forest(spark, sf):
    return _fit_metrics(spark, sf, "Random Forest", **SMALL_FOREST)


@query("train_boosting")
def train_boosting(spark, sf):
    return _fit_metrics(spark, sf, "Gradient Boosting", **SMALL_BOOST)


SPLIT_FEATURES = ("l_quantity", "l_discount", "l_tax")


@query(
    "poisson_split",
    f"""WITH long AS (SELECT l_linenumber::DOUBLE AS y, unnest([0, 1, 2]) AS feature, unnest([l_quantity, l_discount, l_tax])::DOUBLE AS x FROM lineitem),
    whole AS (SELECT count(*) AS n, sum(l_linenumber)::DOUBLE AS s FROM lineitem),
    cut AS (SELECT feature, x, sum(count(*)) OVER o AS ln, sum(sum(y)) OVER o AS ls FROM long GROUP BY feature, x WINDOW o AS (PARTITION BY feature ORDER BY x)),
    gained AS (SELECT *, ls * ln(ls / ln) + (s - ls) * ln((s - ls) / (n - ln)) - s * ln(s / n) AS gain FROM cut, whole WHERE ln < n)
    SELECT feature::INTEGER AS feature, x AS threshold, round(ls / ln, 6) AS left_mean, round((s - ls) / (n - ln), 6) AS right_mean, round(gain, 4) AS gain
    FROM gained ORDER BY round(gain, 6) DESC, feature, x LIMIT 1""",
)
def poisson_split(spark, sf):
    """The first split of a tree that lowers the Poisson deviance of the line number most."""
    lines = table(spark, sf, "lineitem").select(F.col("l_linenumber").cast("double").alias("label"), *(F.col(c).cast("double").alias(c) for c in SPLIT_FEATURES))
    vectors = VectorAssembler(inputCols=list(SPLIT_FEATURES), outputCol="features").transform(lines)
    model = get_model("Random Forest", criterion="poisson", numTrees=1, bootstrap=False, maxDepth=1, maxBins=64).fit(vectors)
    tree = model.trees[0]
    rows = [(*tree.splits[n], tree.values.get(2 * n), tree.values.get(2 * n + 1), tree.gains[n]) for n in tree.splits]
    return rounded(rounded(spark.createDataFrame(rows, "feature int, threshold double, left_mean double, right_mean double, gain double"), 6, "left_mean", "right_mean"), 4, "gain")


@query("train_poisson_forest")
def train_poisson_forest(spark, sf):
    return _fit_metrics(spark, sf, "Random Forest", transform="none", criterion="poisson", numTrees=8, maxDepth=5)


@query("train_huber_boosting")
def train_huber_boosting(spark, sf):
    return _fit_metrics(spark, sf, "Gradient Boosting", lossType="huber", maxIter=4, stepSize=0.5)


@query("train_stopped_boosting")
def train_stopped_boosting(spark, sf):
    return _fit_metrics(spark, sf, "Gradient Boosting", nIterNoChange=2, maxIter=8, stepSize=0.5)


@query("train_ada_boost")
def train_ada_boost(spark, sf):
    return _fit_metrics(spark, sf, "AdaBoost Regression")


@query("grid_search")
def grid_search(spark, sf):
    df = _learning_table(spark, sf)
    trained = ml.fit_model(df, "Poisson", FEATURES, tune=True, grid={"regParam": [0.1, 1.0]}, folds=3)
    return rounded(met.regression_metrics(trained.predict(df, "y_pred"), "dtv", "y_pred")).withColumn(
        "reg_param", F.lit(float(trained.best_params["regParam"]))
    )


@query("cv_scores")
def cv_scores(spark, sf):
    scores = ml.cross_validate(_learning_table(spark, sf), "Linear Regression", ["stadtradeln_volume", "infra_category"], folds=3)
    return rounded(scores.drop("training_time_s"))


@query("predict_edges")
def predict_edges(spark, sf):
    df = _learning_table(spark, sf)
    trained = ml.fit_model(df, "Linear Regression", FEATURES)
    gappy = df.withColumn("infra_category", F.when(F.col("regiostar7") != 73, F.col("infra_category")))
    return rounded(predict_volumes(trained, gappy).select("id", "infra_category", "predicted_dtv"), 4)


@query(
    "predict_counts",
    t.sql("""SELECT CAST(count(*) AS BIGINT) AS n_edges, CAST(count(*) AS BIGINT) AS n_predictions, CAST(0 AS BIGINT) AS n_failures FROM training WHERE "DZS_mean_SR" IS NOT NULL AND "Erh_SR" > 0""", "training"),
)
def predict_counts(spark, sf):
    df = _learning_table(spark, sf)
    trained = ml.fit_model(df, "Linear Regression", FEATURES)
    return prediction_counts(predict_volumes(trained, df))


@query("importance")
def importance(spark, sf):
    trained = ml.fit_model(_learning_table(spark, sf), "Random Forest", FEATURES, **SMALL_FOREST)
    return rounded(ml.feature_importance(trained, spark))


@query("ensemble_voting")
def ensemble_voting(spark, sf):
    df = _learning_table(spark, sf)
    predict = ml.create_ensemble(df, ["Linear Regression", "Random Forest"], FEATURES, options={"Random Forest": SMALL_FOREST})
    return rounded(met.regression_metrics(predict(df), "dtv", "y_pred"))


@query("ensemble_stacking")
def ensemble_stacking(spark, sf):
    df = _learning_table(spark, sf)
    names, features = ["Linear Regression", "Random Forest"], ["infra_category", "regiostar7", "dist_to_center_m"]
    stack = ml.Stacking(names, features, options={"Random Forest": {"numTrees": 4, "maxDepth": 4}}).fit(df, folds=2)
    return rounded(met.regression_metrics(stack.predict(df), "dtv", "y_pred"))


@query("model_comparison")
def model_comparison(spark, sf):
    variants = {"baseline": ["stadtradeln_volume"], "enhanced": ["stadtradeln_volume", "regiostar7"]}
    table_ = ml.compare_models(_learning_table(spark, sf), ["Linear Regression"], variants, folds=2)
    return rounded(table_.select("variant", "model", "r2_cv", "rmse", "mae", "risk", "is_best"))


@query("temporal_stability")
def temporal_stability(spark, sf):
    return rounded(ml.temporal_stability(_learning_table(spark, sf), "Linear Regression", FEATURES, 1997, 1998))


@query("report_predictions")
def report_predictions(spark, sf):
    df = _learning_table(spark, sf)
    train, test = prep.train_test_split(df, 0.2, 42, ["id"])
    trained = ml.fit_model(train, "Linear Regression", FEATURES)
    return rounded(ml.report_predictions([trained], train, test), 4)
