"""Error metrics, the KPI table, and the promotion decision."""

from pyspark.sql import functions as F

from queries import fixtures as fx
from queries.registry import query, rounded, with_ctes
from slotcast.config import KPI_NAMES, MODEL_ADDITIVE, MODEL_GLOBAL, MODEL_LOCAL
from slotcast.operators import features as fe
from slotcast.operators import kpis as kp
from slotcast.operators import silver as si
from slotcast.session import materialize

S = fx.SETTINGS
TRAINED_AT = "2024-01-28T06:00:00+00:00"

# Four answer sets over the same test rows, standing in for the four models: the entity
# mean as it is, shifted, damped, and unanswered at one site. The factors have nine digits,
# so that no product lies half-way between two rounded values.
VARIANTS = {
    MODEL_ADDITIVE: ("mean_wait", "mean_wait * 0.913725681"),
    MODEL_GLOBAL: ("mean_wait", "mean_wait + 4"),
    MODEL_LOCAL: ("mean_wait", "CASE WHEN park_name <> 'error' THEN mean_wait * 0.951372419 END"),
    "baseline_ride_mean": ("mean_wait", "mean_wait"),
}

FOUR = fx.BASELINE + [
    "four AS (" + " UNION ALL ".join(
        f"""SELECT s.* EXCLUDE (yhat, lo, hi, model), {expr} AS yhat, ({expr}) - 5 AS lo,
        ({expr}) + 5 AS hi, '{name}' AS model
        FROM (SELECT *, yhat AS mean_wait FROM scored) s"""
        for name, (_, expr) in VARIANTS.items()
    ) + ")",
    f"kpis AS ({fx.kpi_select('four')})",
]
LONG = FOUR + [
    f"""kpi_table AS (
  SELECT model, kpi_name, kpi_value, model = '{MODEL_ADDITIVE}' AS is_serving,
         '{TRAINED_AT}' AS trained_at
  FROM (UNPIVOT kpis ON {', '.join(KPI_NAMES)} INTO NAME kpi_name VALUE kpi_value))""",
]


def four_models(spark, sf, silver=None):
    """Scored rows of the four stand-ins, written once."""
    split = fx.split(spark, sf) if silver is None else fe.chrono_split(silver, S)
    scored = fx.baseline_scored(*split).withColumn("mean_wait", F.col("yhat"))
    answers = F.array(
        *(
            F.struct(F.lit(name).alias("model"), F.expr(expr).cast("double").alias("yhat"))
            for name, (_, expr) in VARIANTS.items()
        )
    )
    rows = scored.withColumn("a", F.explode(answers)).withColumns(
        {
            "model": F.col("a.model"),
            "yhat": F.col("a.yhat"),
            "lo": F.col("a.yhat") - 5,
            "hi": F.col("a.yhat") + 5,
        }
    )
    return materialize(rows.drop("a", "mean_wait"), "scored")


def kpi_table(spark, sf, scored=None):
    kpis = kp.compute_kpis(four_models(spark, sf) if scored is None else scored, S)
    trained = {m: TRAINED_AT for m in S.model_order}
    return kp.build_kpi_table(kpis, MODEL_ADDITIVE, trained)


def _rounded_names(columns):
    return ", ".join(f"round({c}, 6) AS {c}" for c in columns)


def _single(kpi):
    def build(spark, sf):
        rows = kp.compute_kpis(four_models(spark, sf), S)
        return rounded(rows, kpi).select("model", kpi)

    return build


for _kpi in KPI_NAMES:
    query(f"kpi_{_kpi}", with_ctes(FOUR, f"SELECT model, round({_kpi}, 6) AS {_kpi} FROM kpis"))(
        _single(_kpi)
    )


@query("baseline_kpis", with_ctes(
    fx.BASELINE,
    f"SELECT model, {_rounded_names(KPI_NAMES)} FROM ({fx.kpi_select('scored')})"))
def baseline_kpis(spark, sf, settings=S):
    """Historical mean per entity, judged on the last fifth of the time range."""
    silver = materialize(si.build_silver(fx.bronze(spark, sf), settings), "silver")
    rows = kp.compute_kpis(fx.baseline_scored(*fe.chrono_split(silver, settings)), settings)
    return rounded(rows, *KPI_NAMES)


@query("kpi_all_models", with_ctes(FOUR, f"SELECT model, {_rounded_names(KPI_NAMES)} FROM kpis"))
def all_models(spark, sf):
    return rounded(kp.compute_kpis(four_models(spark, sf), S), *KPI_NAMES)


@query("kpi_long_table", with_ctes(LONG, """SELECT model, kpi_name, round(kpi_value, 6) AS kpi_value,
    is_serving, trained_at FROM kpi_table"""))
def long_table(spark, sf):
    return rounded(kpi_table(spark, sf), "kpi_value")


@query("promotion_best_candidate", with_ctes(FOUR, """SELECT model, round(mae, 6) AS mae,
    isfinite(mae) AND mae > 0 AS usable FROM kpis WHERE model <> 'baseline_ride_mean'
    ORDER BY mae, list_position(['prophet_fleet', 'xgb_global', 'xgb_local_fleet'], model)
    LIMIT 1"""))
def best_candidate(spark, sf):
    return rounded(kp.best_candidate(kp.compute_kpis(four_models(spark, sf), S), S), "mae")


@query("promotion_incumbent", with_ctes(LONG, """SELECT model AS model_name,
    round(kpi_value, 6) AS mae, 'r0' AS run_id FROM kpi_table WHERE is_serving AND kpi_name = 'mae'"""))
def incumbent(spark, sf):
    published = kpi_table(spark, sf).withColumn("run_id", F.lit("r0"))
    return rounded(kp.incumbent(published), "mae")


@query("promotion_decision", with_ctes(LONG, """, best AS (SELECT model, mae FROM kpis
    WHERE model <> 'baseline_ride_mean' ORDER BY mae LIMIT 1),
    cases AS (SELECT 'first' AS kind, NULL AS old
      UNION ALL SELECT 'same', kpi_value FROM kpi_table WHERE is_serving AND kpi_name = 'mae'
      UNION ALL SELECT 'worse', kpi_value * 2 FROM kpi_table WHERE is_serving AND kpi_name = 'mae')
    SELECT kind, model, round(mae, 6) AS new_mae, round(old, 6) AS old_mae,
    round(old * 0.99, 6) AS limit_mae, old IS NULL OR mae < old * 0.99 AS ship
    FROM best, cases""").replace("\n, best", ",\nbest"))
def decision(spark, sf):
    """Against no incumbent, the same models, and an incumbent twice as bad."""
    kpis = materialize(kp.compute_kpis(four_models(spark, sf), S), "kpis")
    table = kp.build_kpi_table(kpis, MODEL_ADDITIVE).withColumn("run_id", F.lit("r0"))
    best, old = kp.best_candidate(kpis, S), kp.incumbent(table)
    cases = {
        "first": old.where(F.col("mae") < 0),
        "same": old,
        "worse": old.withColumn("mae", F.col("mae") * 2),
    }
    out = None
    for kind, previous in cases.items():
        row = kp.decide_promotion(best, previous, S).select(
            F.lit(kind).alias("kind"), "model", "new_mae", "old_mae",
            F.col("limit").alias("limit_mae"), "ship",
        )
        out = row if out is None else out.unionByName(row)
    return rounded(out, "new_mae", "old_mae", "limit_mae")
