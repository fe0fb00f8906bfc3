"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the driver tables of ``sf_dir`` (through the bronze
fixture) so its work grows with them. Outputs go through ``portable`` so they
compare value by value with the SQL oracle.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import rules as R
from ..operators import analysis as AN
from ..operators import drift as DR
from ..operators import features as FE
from ..operators import gold as G
from ..operators import gold_state as GS
from ..operators import history as HI
from ..operators import ingest as IN
from ..operators import key_index as KI
from ..operators import kpis as KP
from ..operators import metrics as ME
from ..operators import model as MO
from ..operators import newton as NT
from ..operators import quality as QU
from ..operators import quantiles as QN
from ..operators import scoring as SC
from ..operators import silver as SV
from ..operators import warehouse as WH
from ..sources import fixtures as FX
from ..sources import landing as LA
from ..sources import tables as TB
from ..streaming import enrichment as EN
from ..streaming import gold_stream as GO
from ..streaming import streams as ST
from . import pipeline as PL
from .portable import portable

AS_OF = FX.AS_OF

Query = Callable[[SparkSession, str], DataFrame]


def _silver(spark, sf_dir, as_of=AS_OF):
    return SV.silver(FX.bronze(spark, sf_dir), as_of)


def _gold(spark, sf_dir, as_of=AS_OF):
    return G.gold(_silver(spark, sf_dir, as_of), as_of)


def silver_events(spark, sf_dir):
    return portable(_silver(spark, sf_dir))


def gold_features(spark, sf_dir):
    return portable(_gold(spark, sf_dir))


def _training(spark, sf_dir):
    return FE.training_frame(_gold(spark, sf_dir))


def _labelled(spark, sf_dir):
    """Training frame with the heuristic probability (unrounded) as score."""
    t = _training(spark, sf_dir)
    return t.select("subscriber_id", F.col("churned_30d").alias("label"),
                    SC.heuristic_probability().alias("probability"))


def _scoring_input(spark, sf_dir):
    return _gold(spark, sf_dir).select(*S.SCORING_INPUT_COLS)


def quality_report(spark, sf_dir):
    return portable(QU.quality_report(FX.bronze(spark, sf_dir), AS_OF))


def dbt_style_checks(spark, sf_dir):
    b = FX.bronze(spark, sf_dir)
    s = SV.silver(b, AS_OF)
    g = G.gold(s, AS_OF)
    out = (QU.run_column_tests(b, QU.BRONZE_TESTS)
           .unionByName(QU.run_column_tests(s, QU.SILVER_TESTS))
           .unionByName(QU.run_column_tests(g, QU.GOLD_TESTS)))
    return portable(out)


def layer_quality(spark, sf_dir):
    return portable(QU.layer_scores(dbt_style_checks(spark, sf_dir)))


def feature_vector(spark, sf_dir):
    return portable(FE.engineer_features(_training(spark, sf_dir)))


def scoring_validation(spark, sf_dir):
    v = SC.validate_input(_scoring_input(spark, sf_dir))
    return portable(v.select("subscriber_id", "plan_type", "country", "is_valid",
                             F.array_join("reasons", ";").alias("reasons")))


def heuristic_scores(spark, sf_dir):
    return portable(SC.score_heuristic(_scoring_input(spark, sf_dir), AS_OF))


def batch_summary(spark, sf_dir):
    return portable(SC.batch_summary(SC.score_heuristic(_scoring_input(spark, sf_dir), AS_OF)))


def feature_drift(spark, sf_dir):
    return portable(DR.feature_drift(_gold(spark, sf_dir)))


def prediction_drift(spark, sf_dir):
    return portable(DR.prediction_drift(SC.score_heuristic(_scoring_input(spark, sf_dir), AS_OF)))


def drift_report(spark, sf_dir):
    return portable(DR.drift_report_scored(SC.with_probability(_gold(spark, sf_dir)), AS_OF))


def confusion_metrics(spark, sf_dir):
    return portable(ME.confusion_metrics(_labelled(spark, sf_dir)))


def classification_report(spark, sf_dir):
    return portable(ME.classification_report(_labelled(spark, sf_dir)))


def auc_rank(spark, sf_dir):
    return portable(ME.auc(_labelled(spark, sf_dir)))


def roc_points(spark, sf_dir):
    return portable(ME.roc_points(_labelled(spark, sf_dir)))


def release_gate(spark, sf_dir):
    return portable(ME.release_gate(ME.auc(_labelled(spark, sf_dir))))


def performance_drift(spark, sf_dir):
    return portable(ME.performance_drift(ME.auc(_labelled(spark, sf_dir))))


def business_impact(spark, sf_dir):
    return portable(ME.business_impact(ME.confusion_metrics(_labelled(spark, sf_dir))))


def means_by_label(spark, sf_dir):
    return portable(AN.means_by_label(_training(spark, sf_dir)))


def class_share(spark, sf_dir):
    return portable(AN.class_share(_training(spark, sf_dir)))


def sessions_histogram(spark, sf_dir):
    return portable(AN.histogram(_training(spark, sf_dir)))


def risk_distribution(spark, sf_dir):
    return portable(G.risk_distribution(_gold(spark, sf_dir)))


def distinct_subscribers(spark, sf_dir):
    return portable(G.distinct_subscribers(_silver(spark, sf_dir)))


def distinct_subscribers_top(spark, sf_dir):
    return portable(G.distinct_subscribers(_silver(spark, sf_dir), limit=100))


def gold_stats(spark, sf_dir):
    act = G.subscriber_activity(_silver(spark, sf_dir), AS_OF)
    return portable(act.select(
        *G.GRAIN,
        R.round_half_up("completion_rate_stddev", 6).alias("completion_rate_stddev"),
        "last_watch_at"))


def gold_by_subscriber(spark, sf_dir):
    return portable(G.gold_by_subscriber(_silver(spark, sf_dir), AS_OF))


def silver_dag_variant(spark, sf_dir):
    return portable(SV.silver_dag_variant(FX.bronze(spark, sf_dir), AS_OF))


# --- ingest, incremental load, schema sync, upsert ----------------------------------------


def bronze_dedup_ingest(spark, sf_dir):
    """Second batch into a bronze that holds the first: insert-if-absent."""
    first, second = FX.bronze_batches(spark, sf_dir)
    res = IN.ingest_to_bronze(second, first, run_id="run-3", as_of=AS_OF, count=False)
    return portable(res.rows)


def ingest_indexed(spark, sf_dir):
    """The second batch into a stored bronze, through the Bloom filters of its ingest days."""
    root = TB.scratch_path(spark, "ingest-indexed")
    first, second = FX.bronze_batches(spark, sf_dir)
    first = first.withColumn("ingest_date", F.to_date("ingested_at"))
    KI.build(first).write.parquet(f"{root}/index")
    IN.append(first, f"{root}/bronze", partition_by=["ingest_date"])
    res = IN.ingest_to_bronze(second, spark.read.parquet(f"{root}/bronze"), run_id="run-3", as_of=AS_OF, count=False,
                              index=spark.read.parquet(f"{root}/index"))
    return portable(res.rows)


def silver_incremental(spark, sf_dir):
    """Silver after two incremental runs (batch one at the cut, then all)."""
    first, _ = FX.bronze_batches(spark, sf_dir)
    target = SV.silver(first, FX.BATCH_CUT)
    return portable(SV.silver_incremental(FX.bronze(spark, sf_dir), target, AS_OF))


def silver_schema_sync(spark, sf_dir):
    """Incremental run whose query gained ``is_mobile`` and lost ``app_version``."""
    first, _ = FX.bronze_batches(spark, sf_dir)
    target = SV.silver(first, FX.BATCH_CUT)
    mark = SV.high_water_mark(target)
    new = (SV.silver(SV.new_since(FX.bronze(spark, sf_dir), mark), AS_OF)
           .drop("app_version").withColumn("is_mobile", F.col("device_type") == "mobile"))
    return portable(SV.merge_by_key(SV.sync_columns(target, new), new))


DAG_UPDATE_COLS = ["total_sessions_30d", "total_watch_time_h", "avg_completion_rate",
                   "days_since_last_watch", "churn_risk_label"]
EARLIER = "2024-01-26 00:00:00"


def gold_upsert(spark, sf_dir):
    """Gold (one row per subscriber) of a week earlier, upserted with today's:
    matched rows take five columns and a new stamp, others stay (S10)."""
    silver = _silver(spark, sf_dir)
    # the table as a run a week earlier left it: events before that clock only
    before = silver.where(F.col("event_timestamp") < F.lit(EARLIER).cast("timestamp_ntz"))
    old = G.gold_by_subscriber(before, EARLIER)
    new = G.gold_by_subscriber(silver, AS_OF)
    return portable(G.upsert_columns(old, new, "subscriber_id", DAG_UPDATE_COLS,
                                     stamp_col="computed_at", as_of=AS_OF))


def completion_trend(spark, sf_dir):
    return portable(G.completion_trend(_silver(spark, sf_dir), AS_OF))


def pipeline_summary(spark, sf_dir):
    """Run summary (S18): rows ingested, quality score, silver and gold rows."""
    bronze = FX.bronze(spark, sf_dir)
    ingested = IN.ingest_to_bronze(bronze, None, "run-1", AS_OF, count=False).rows
    silver = SV.silver(bronze, AS_OF)
    gold = G.gold(silver, AS_OF)
    q = QU.quality_report(bronze, AS_OF)
    return portable(spark.range(1).select(
        ingested.select(F.count(F.lit(1))).scalar().alias("bronze_inserted"),
        q.select("quality_score").scalar().alias("quality_score"),
        silver.select(F.count(F.lit(1))).scalar().alias("silver_rows"),
        gold.select(F.count(F.lit(1))).scalar().alias("gold_rows")))


# --- star schema, KPIs, alerts, PSI, drift over time ----------------------------------------


TIMELINE_FIRST, TIMELINE_LAST = "2024-01-27", "2024-02-02"


def star_fact(spark, sf_dir):
    return portable(WH.fact_viewing_events(_silver(spark, sf_dir)))


def dim_subscriber(spark, sf_dir):
    return portable(WH.dim_subscriber(_silver(spark, sf_dir), FX.read_table(spark, sf_dir, "customer")))


def dim_content(spark, sf_dir):
    return portable(WH.dim_content(_silver(spark, sf_dir), FX.read_table(spark, sf_dir, "part")))


def dim_date(spark, sf_dir):
    return portable(WH.dim_date(_silver(spark, sf_dir)))


def dim_device(spark, sf_dir):
    return portable(WH.dim_device(_silver(spark, sf_dir)))


def favourite_genre(spark, sf_dir):
    silver = _silver(spark, sf_dir)
    subs = WH.dim_subscriber(silver, FX.read_table(spark, sf_dir, "customer"))
    content = WH.dim_content(silver, FX.read_table(spark, sf_dir, "part"))
    return portable(WH.favourite_genre(WH.enrich_events(silver, subs, content), AS_OF))


def dim_subscriber_scored(spark, sf_dir):
    silver = _silver(spark, sf_dir)
    dim = WH.dim_subscriber(silver, FX.read_table(spark, sf_dir, "customer"))
    scores = SC.score_heuristic(G.gold_by_subscriber(silver, AS_OF).select(*S.SCORING_INPUT_COLS), AS_OF)
    return portable(WH.write_scores(dim, scores))


def kpi_daily(spark, sf_dir):
    return portable(KP.daily_kpis(_silver(spark, sf_dir)))


def kpi_latency(spark, sf_dir):
    return portable(KP.latency_kpis(FX.bronze(spark, sf_dir)))


def kpi_latency_percentiles(spark, sf_dir):
    return portable(KP.latency_percentiles(FX.bronze(spark, sf_dir)))


def alerts(spark, sf_dir):
    bronze = FX.bronze(spark, sf_dir)
    scored = SC.with_probability(G.gold(SV.silver(bronze, AS_OF), AS_OF))
    return portable(KP.alerts(QU.quality_report(bronze, AS_OF), DR.drift_report_scored(scored, AS_OF),
                              KP.latency_kpis(bronze), AS_OF))


def psi(spark, sf_dir):
    silver = _silver(spark, sf_dir)
    before = silver.where(F.col("event_timestamp") < F.lit(EARLIER).cast("timestamp_ntz"))
    old, new = G.gold(before, EARLIER), G.gold(silver, AS_OF)
    return portable(DR.psi(old, new, bins=10))


def _scored_snapshots(spark, sf_dir):
    snaps = G.gold_snapshots(_silver(spark, sf_dir), TIMELINE_FIRST, TIMELINE_LAST)
    valid, _ = SC.split_valid(snaps)
    return valid.withColumn("churn_probability", R.round_half_up(SC.heuristic_probability(), 4))


def gold_snapshots(spark, sf_dir):
    return portable(G.gold_snapshots(_silver(spark, sf_dir), TIMELINE_FIRST, TIMELINE_LAST))


def drift_timeline(spark, sf_dir):
    return portable(DR.drift_timeline(_scored_snapshots(spark, sf_dir), as_of=AS_OF))


def alert_days(spark, sf_dir):
    return portable(DR.alert_days(DR.drift_timeline(_scored_snapshots(spark, sf_dir), as_of=AS_OF)))


# --- model and streams (no SQL oracle: rows are checked) -----------------------------------------


SMALL_GBT = {"maxIter": 10, "maxDepth": 4}


def stratified_split(spark, sf_dir):
    return portable(MO.stratified_split(_training(spark, sf_dir)).select(
        "subscriber_id", "plan_type", "country", "churned_30d", "split"))


def gbt_scores(spark, sf_dir):
    res = MO.train(_training(spark, sf_dir), SMALL_GBT)
    return portable(res.test_predictions)


def top_features(spark, sf_dir):
    res = MO.train(_training(spark, sf_dir), SMALL_GBT, early_stopping=False)
    return portable(AN.top_k(res.importance, "importance", 5, tie="feature"))


def stream_bronze(spark, sf_dir):
    root = TB.scratch_path(spark, "stream-bronze")
    src = ST.land_by_day(FX.bronze(spark, sf_dir), f"{root}/landing")
    q = ST.start_bronze_stream(ST.read_events_stream(spark, src), f"{root}/bronze",
                               f"{root}/_ckpt", run_id="stream-1")
    q.awaitTermination()
    return portable(spark.read.parquet(f"{root}/bronze").drop(ST.BATCH_COL))


def stream_silver(spark, sf_dir):
    root = TB.scratch_path(spark, "stream-silver")
    _bronze_stream(spark, sf_dir, root)
    s = ST.start_silver_stream(spark, f"{root}/bronze", f"{root}/silver", f"{root}/quarantine",
                               f"{root}/_ckpt_s", as_of=AS_OF, gate=False)
    s.awaitTermination()
    return portable(spark.read.parquet(f"{root}/silver"))


def stream_quarantine(spark, sf_dir):
    """T5: the gated silver stream over all of bronze, faults included: the batch
    fails the gate, goes to quarantine whole, and the query stops."""
    root = TB.scratch_path(spark, "stream-quarantine")
    _bronze_stream(spark, sf_dir, root)
    s = ST.start_silver_stream(spark, f"{root}/bronze", f"{root}/silver", f"{root}/quarantine",
                               f"{root}/_ckpt_s", as_of=AS_OF)
    try:
        s.awaitTermination()
    except StreamingQueryException as e:
        if "QualityGateStop" not in str(e):
            raise
    return portable(spark.read.parquet(f"{root}/quarantine").drop(ST.BATCH_COL))


def _bronze_stream(spark, sf_dir, root):
    src = ST.land_by_day(FX.bronze(spark, sf_dir), f"{root}/landing")
    b = ST.start_bronze_stream(ST.read_events_stream(spark, src), f"{root}/bronze",
                               f"{root}/_ckpt_b", run_id="stream-1")
    b.awaitTermination()


# --- remaining single operators --------------------------------------------------------------

def silver_empty(spark, sf_dir):
    """The silver schema with no rows."""
    return portable(SV.empty_like(_silver(spark, sf_dir)))


def landing_scan(spark, sf_dir):
    """Bronze landed as ingest-day folders, scanned back with partition
    discovery and schema merging."""
    root = TB.scratch_path(spark, "landing")
    TB.write_landing_by_day(FX.bronze(spark, sf_dir), root)
    return portable(TB.read_landing(spark, root))


def events_json_roundtrip(spark, sf_dir):
    """Bronze as JSON records with ISO times, parsed back."""
    return portable(IN.parse_events_json(IN.events_to_json(FX.bronze(spark, sf_dir))))


def bronze_sample(spark, sf_dir):
    """The first five bronze rows in event-id order."""
    return portable(IN.sample(FX.bronze(spark, sf_dir), 5, ["event_id", "ingested_at"]))


def retrain_decision(spark, sf_dir):
    """Drift decides whether to retrain."""
    rep = DR.drift_report_scored(SC.with_probability(_gold(spark, sf_dir)), AS_OF)
    return portable(DR.retrain_decision(rep))


def silver_enriched(spark, sf_dir):
    """Silver with subscriber and content attributes."""
    silver = _silver(spark, sf_dir)
    subs = WH.dim_subscriber(silver, FX.read_table(spark, sf_dir, "customer"))
    content = WH.dim_content(silver, FX.read_table(spark, sf_dir, "part"))
    out = WH.enrich_events(silver, subs, content)
    return portable(out.select("event_id", "subscriber_id", "content_id", "genre", "email",
                               "signup_date", "event_date"))


def gold_dag_table(spark, sf_dir):
    """Gold in the DAG's shape, with completion trend and the
    30-day session alias."""
    silver = _silver(spark, sf_dir)
    g = G.gold_dag_columns(G.gold(silver, AS_OF))
    out = g.join(G.completion_trend(silver, AS_OF), G.GRAIN, "left")
    return portable(out.select("subscriber_id", "plan_type", "country", "total_sessions_30d",
                               "sessions_last_30d", "sessions_last_7d", "completion_rate_trend",
                               "churn_risk_label"))


def sorted_codes(spark, sf_dir):
    """category codes learnt from the data in sorted order."""
    t = FE.label_sorted_codes(_training(spark, sf_dir))
    return portable(t.select("subscriber_id", "plan_type", "country", "favourite_device",
                             *[F.col(c + "_idx").cast("bigint").alias(c + "_idx")
                               for c in ("plan_type", "country", "favourite_device")]))


def stream_latency(spark, sf_dir):
    """X7 as a stream: windowed latency KPIs over landed bronze files."""
    root = TB.scratch_path(spark, "stream-latency")
    src = ST.land_by_day(FX.bronze(spark, sf_dir), f"{root}/landing")
    q = ST.start_latency_stream(ST.read_events_stream(spark, src), f"{root}/latency",
                                f"{root}/_ckpt")
    q.awaitTermination()
    return portable(ST.read_latency_sink(spark, f"{root}/latency"))


def stream_enriched(spark, sf_dir):
    """Silver files enriched as a stream. The first drop runs while no
    email and no genre are known; both dimensions change before the second."""
    root = TB.scratch_path(spark, "stream-enriched")
    dims = f"{root}/dims"
    first, second = FX.bronze_batches(spark, sf_dir)
    drop = SV.silver(first, FX.BATCH_CUT)
    drop.write.parquet(f"{root}/silver/drop=1")
    EN.write_dimensions(dims, WH.dim_subscriber(drop), WH.dim_content(drop))

    def run():
        EN.start_enrichment_stream(spark, f"{root}/silver/*", f"{root}/out", dims, f"{root}/_ckpt", drop.schema).awaitTermination()

    run()
    SV.silver(second, AS_OF).write.parquet(f"{root}/silver/drop=2")
    silver = _silver(spark, sf_dir)
    EN.write_dimensions(dims, WH.dim_subscriber(silver, FX.read_table(spark, sf_dir, "customer")),
                        WH.dim_content(silver, FX.read_table(spark, sf_dir, "part")))
    run()
    return portable(spark.read.parquet(EN.paths(f"{root}/out")["enriched"]).select(
        "event_id", "subscriber_id", "content_id", "genre", "email", "signup_date", "event_date"))


def _gold_stream(spark, sf_dir, root):
    """Bronze files of three spans of ingest days, the last span first, the middle one last."""
    b = FX.bronze(spark, sf_dir)
    day = F.to_date("ingested_at")
    old, new = day < F.lit("2024-01-11").cast("date"), day >= F.lit("2024-01-21").cast("date")
    for i, part in enumerate((new, old, ~old & ~new)):
        b.where(part).write.parquet(f"{root}/bronze/drop={i}")
        GO.start_gold_stream(spark, f"{root}/bronze/*", f"{root}/out", f"{root}/_ckpt", AS_OF).awaitTermination()
    return f"{root}/out"


def stream_gold(spark, sf_dir):
    """A4 / T4: sliding 30-day gold kept by a stream of files out of order, for every day of the timeline."""
    out = _gold_stream(spark, sf_dir, TB.scratch_path(spark, "stream-gold"))
    first = _dt.date.fromisoformat(TIMELINE_FIRST)
    days = (_dt.date.fromisoformat(TIMELINE_LAST) - first).days
    snaps = [GO.gold_of_day(spark, out, first + _dt.timedelta(days=i)) for i in range(days + 1)]
    return portable(reduce(DataFrame.unionByName, snaps))


# --- incremental gold and whole runs -----------------------------------------------------------

LATE_DAYS = ("2024-01-10", "2024-01-15")


def _late_batches(bronze):
    """(first, second) run: events of two days whose number ends in 3 come with
    the second one, weeks late, beside those after the cut."""
    late = (F.to_date("event_timestamp").isin(*[F.lit(d).cast("date") for d in LATE_DAYS])
            & F.coalesce(F.col("event_id").cast("bigint") % 10 == 3, F.lit(False)))
    late = F.coalesce(late, F.lit(False))
    early = F.col("ingested_at") <= F.lit(str(FX.BATCH_CUT)).cast("timestamp_ntz")
    return bronze.where(early & ~late), bronze.where(~early | late)


def gold_incremental(spark, sf_dir):
    """Two silver runs, the second with late rows; gold is merged from
    daily partials of which only the days that run touched are computed again."""
    root = TB.scratch_path(spark, "gold-incremental")
    first, second = _late_batches(FX.bronze(spark, sf_dir))
    silver, state = f"{root}/silver", f"{root}/state"
    TB.write_silver_incremental(spark, first, silver, FX.BATCH_CUT)
    GS.write_state(spark, spark.read.parquet(silver), state)
    done = TB.write_silver_incremental(spark, second, silver, AS_OF, mark=None)
    GS.write_state(spark, spark.read.parquet(silver), state, done["partitions"])
    return portable(GS.gold_from_state(spark.read.parquet(state), AS_OF))


def gold_state_stats(spark, sf_dir):
    """A4e / A4f from the daily partials: exact spread and last watch."""
    act = GS.activity_from_state(GS.daily_partials(_silver(spark, sf_dir)), AS_OF)
    return portable(act.select(*G.GRAIN,
                               R.round_half_up("completion_rate_stddev", 6).alias("completion_rate_stddev"),
                               "last_watch_at"))


def pipeline_run(spark, sf_dir):
    """Four whole runs over one table root, as the run history tells them:
    a load, an incremental load, a batch that fails the gate, the same rows again."""
    root = TB.scratch_path(spark, "pipeline-run")
    bronze, clean = FX.bronze(spark, sf_dir), FX.bronze_clean(spark, sf_dir)
    first, second = _late_batches(clean)
    PL.run_pipeline(spark, first, root, "run-a", FX.BATCH_CUT)
    PL.run_pipeline(spark, second, root, "run-b", AS_OF)
    try:
        PL.run_pipeline(spark, bronze, root, "run-c", AS_OF)
    except QU.QualityGateError:
        pass                                  # the history has it
    PL.run_pipeline(spark, second, root, "run-d", AS_OF)
    return portable(PL.run_history(spark, root).drop("finished_at"))


def kpi_latency_exact(spark, sf_dir):
    """Exact p50 and p99 latency per ingest window."""
    return portable(QN.latency_quantiles(FX.bronze(spark, sf_dir)))


# --- second-order trees and evaluation ---------------------------------------------------------

BINS = 32


def _features(spark, sf_dir):
    return FE.engineer_features(_training(spark, sf_dir))


def _root_gains(spark, sf_dir):
    """Every candidate split of the first tree's root, over all rows and features."""
    rows = _features(spark, sf_dir).withColumn("split", F.lit("train"))
    p = NT.Params(bins=BINS)
    cuts = NT.feature_cuts(rows, S.FEATURE_COLS, p.bins)
    d = NT._prepared(rows, "subscriber_id", "churned_30d", S.FEATURE_COLS, cuts)
    g, h = NT.gradients(F.col("y"), F.col("z"), p.positive_weight)
    table = NT.split_table(d.select(F.lit(0).alias("node"), "b", g.alias("g"), h.alias("h")),
                           list(range(len(S.FEATURE_COLS))), p.ridge)
    named = F.array(*[F.lit(f) for f in S.FEATURE_COLS])
    at = F.array(*[F.array(*[F.lit(c) for c in cs]).cast("array<bigint>") for cs in cuts])
    return (table.withColumn("cut", F.get(F.get(at, "f"), "bin")).where("cut is not null")
            .select(F.get(named, "f").alias("feature"), (F.col("cut") / F.lit(float(NT.SCALE))).alias("threshold"),
                    (F.col("gl") / F.lit(float(NT.UNIT))).alias("gradient_left"),
                    (F.col("hl") / F.lit(float(NT.UNIT))).alias("hessian_left"), R.round_half_up("gain", 6).alias("gain")))


def newton_root_gains(spark, sf_dir):
    """M3: gradient and Hessian left of every cut, and its gain."""
    return portable(_root_gains(spark, sf_dir))


def top_gain_features(spark, sf_dir):
    """L1-L3: the ten features whose best root split gains most, shown ascending."""
    best = _root_gains(spark, sf_dir).groupBy("feature").agg(F.max("gain").alias("gain"))
    return portable(AN.top_k(best, "gain", 10, ascending_display=True, tie="feature"))


def _split_features(spark, sf_dir):
    rows = MO.stratified_split(_features(spark, sf_dir), shares={"train": 0.7, "validation": 0.1, "test": 0.2})
    return rows.select("subscriber_id", "churned_30d", "split", *S.FEATURE_COLS)


def newton_stages(spark, sf_dir):
    """M5: validation AUC after every tree grown; patience 20 ends the training
    and the trees up to the best AUC are kept. Full steps, so that it ends soon."""
    model = NT.train(_split_features(spark, sf_dir), S.FEATURE_COLS, NT.Params(depth=2, rate=1.0, block=10))
    stages = R.literal_table(spark, [(i + 1, a, i < model.kept) for i, a in enumerate(model.stages)],
                             "trees bigint, auc double, kept boolean")
    return portable(stages)


def newton_scores(spark, sf_dir):
    """Trained trees are stored, read back and score the test part."""
    rows = _split_features(spark, sf_dir)
    model = NT.train(rows.where("split <> 'validation'"), S.FEATURE_COLS, NT.Params(trees=10, depth=3, rate=0.3))
    root = TB.scratch_path(spark, "newton")
    NT.save(spark, model, root)
    return portable(NT.score(rows.where("split = 'test'"), NT.load(spark, root))
                    .select("subscriber_id", F.col("churned_30d").alias("label"), "probability"))


def evaluation_record(spark, sf_dir):
    """M6: one metrics row, of the heuristic score."""
    return portable(ME.evaluation_record(_labelled(spark, sf_dir), trained_at=AS_OF))


def model_run_log(spark, sf_dir):
    """Two recorded runs with the metrics of the heuristic score."""
    root = TB.scratch_path(spark, "model-runs")
    m = ME.evaluation_record(_labelled(spark, sf_dir), trained_at=AS_OF).first().asDict()
    MO.log_run(spark, root, "first", {"depth": 6, "rate": 0.05}, m, None, "blocked")
    MO.log_run(spark, root, "second", {"depth": 4}, m, "models/2", "promoted")
    runs = spark.read.parquet(MO.runs_path(root))
    params = F.array_join(F.array_sort(F.transform(F.map_entries("params"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))), ";")
    return portable(runs.select("run_name", params.alias("params"), "auc_roc", "f1_score", "precision", "recall",
                                "test_size", "model_version", "model_path", "status"))


def roc_curve_min(spark, sf_dir):
    """The ROC curve of a score with many values, without collinear points."""
    t = _training(spark, sf_dir).where("avg_completion_rate is not null")
    return portable(ME.roc_curve_min(t.select(F.col("churned_30d").alias("label"),
                                              (F.lit(1.0) - F.col("avg_completion_rate")).alias("probability"))))


# --- single operators on inputs that exercise them ----------------------------------------------

FRESH_AS_OF = "2024-01-30 12:00:00"


def quality_fresh(spark, sf_dir):
    """The quality report with a clock inside the data, so that rows are fresh."""
    return portable(QU.quality_report(FX.bronze(spark, sf_dir), FRESH_AS_OF))


def feature_drift_partial(spark, sf_dir):
    """Drift of a table that lacks a monitored feature."""
    return portable(DR.feature_drift(_gold(spark, sf_dir).drop("avg_engagement_score")))


def completion_estimate(spark, sf_dir):
    """completion estimated from the time watched, beside the one reported, per device."""
    b = FX.bronze(spark, sf_dir)
    return portable(b.groupBy("device_type").agg(
        R.round_half_up(F.avg(R.completion_from_duration("watch_duration_s")), 6).alias("estimated"),
        R.round_half_up(F.avg("completion_pct"), 6).alias("reported"), F.count(F.lit(1)).alias("events")))


def scoring_rejects(spark, sf_dir):
    """The rows that scoring turns away, with reasons; a tighter session range makes some."""
    wide = _scoring_input(spark, sf_dir).withColumn(
        "avg_engagement_score", F.when(F.col("total_sessions_30d") > 8, F.lit(None)).otherwise(F.col("avg_engagement_score")))
    _, bad = SC.split_valid(wide)
    return portable(bad.select("subscriber_id", F.array_join("reasons", ";").alias("reasons")))


def silver_ctas_append(spark, sf_dir):
    """A table created empty from silver's schema, then filled by two appends."""
    path = TB.scratch_path(spark, "ctas") + "/silver"
    silver = _silver(spark, sf_dir)
    SV.empty_like(silver).write.parquet(path)
    old = F.col("event_date") < F.lit("2024-01-16").cast("date")
    IN.append(silver.where(old), path)
    IN.append(silver.where(~old), path)
    return portable(spark.read.parquet(path))


# --- history and schema history ------------------------------------------------------------------

def subscriber_history(spark, sf_dir):
    """Validity intervals of plan and country per subscriber."""
    return portable(HI.versions(_silver(spark, sf_dir)))


def fact_asof(spark, sf_dir):
    """Every silver event with the plan and country in force at its time,
    where plan and country are known from play events only."""
    silver = _silver(spark, sf_dir)
    history = HI.versions(silver.where("event_type = 'play'"))
    out = HI.as_of_join(silver.select("event_id", "subscriber_id", "event_timestamp"), history)
    return portable(out)


def landing_evolved(spark, sf_dir):
    """Bronze landed in three folders whose schemas differ: no app
    version and whole seconds, fractions of seconds, and a list of countries
    (in conflict). Good rows come in the joined schema, the others from quarantine."""
    root = TB.scratch_path(spark, "landing-evolved")
    b = FX.bronze(spark, sf_dir)
    day = F.to_date("ingested_at")
    old, new = day < F.lit("2024-01-11").cast("date"), day >= F.lit("2024-01-21").cast("date")
    b.where(old).drop("app_version").write.parquet(f"{root}/v1")
    (b.where(~old & ~new).withColumn("watch_duration_s", F.col("watch_duration_s").cast("double") / 2)
     .write.parquet(f"{root}/v2"))
    b.where(new).withColumn("country", F.array("country")).write.parquet(f"{root}/v3")
    rows, bad = LA.read_evolved(spark, root)
    good = rows.select("event_id", "watch_duration_s", "app_version", F.lit(None).cast("string").alias("folder"),
                       F.lit(None).cast("string").alias("reason"))
    return portable(good.unionByName(bad.select(
        F.get_json_object("record", "$.event_id").alias("event_id"),
        F.get_json_object("record", "$.watch_duration_s").cast("double").alias("watch_duration_s"),
        F.get_json_object("record", "$.app_version").alias("app_version"), "folder", "reason")))


QUERIES: dict[str, Query] = {
    "silver_events": silver_events,
    "gold_features": gold_features,
    "quality_report": quality_report,
    "dbt_style_checks": dbt_style_checks,
    "layer_quality": layer_quality,
    "feature_vector": feature_vector,
    "scoring_validation": scoring_validation,
    "heuristic_scores": heuristic_scores,
    "batch_summary": batch_summary,
    "feature_drift": feature_drift,
    "prediction_drift": prediction_drift,
    "drift_report": drift_report,
    "confusion_metrics": confusion_metrics,
    "classification_report": classification_report,
    "auc_rank": auc_rank,
    "roc_points": roc_points,
    "release_gate": release_gate,
    "performance_drift": performance_drift,
    "business_impact": business_impact,
    "means_by_label": means_by_label,
    "class_share": class_share,
    "sessions_histogram": sessions_histogram,
    "risk_distribution": risk_distribution,
    "distinct_subscribers": distinct_subscribers,
    "distinct_subscribers_top": distinct_subscribers_top,
    "gold_stats": gold_stats,
    "gold_by_subscriber": gold_by_subscriber,
    "silver_dag_variant": silver_dag_variant,
    "bronze_dedup_ingest": bronze_dedup_ingest,
    "silver_incremental": silver_incremental,
    "silver_schema_sync": silver_schema_sync,
    "gold_upsert": gold_upsert,
    "completion_trend": completion_trend,
    "pipeline_summary": pipeline_summary,
    "star_fact": star_fact,
    "dim_subscriber": dim_subscriber,
    "dim_content": dim_content,
    "dim_date": dim_date,
    "dim_device": dim_device,
    "favourite_genre": favourite_genre,
    "dim_subscriber_scored": dim_subscriber_scored,
    "kpi_daily": kpi_daily,
    "kpi_latency": kpi_latency,
    "kpi_latency_percentiles": kpi_latency_percentiles,
    "alerts": alerts,
    "psi": psi,
    "gold_snapshots": gold_snapshots,
    "drift_timeline": drift_timeline,
    "alert_days": alert_days,
    "stratified_split": stratified_split,
    "gbt_scores": gbt_scores,
    "top_features": top_features,
    "stream_bronze": stream_bronze,
    "stream_silver": stream_silver,
    "stream_latency": stream_latency,
    "silver_empty": silver_empty,
    "landing_scan": landing_scan,
    "events_json_roundtrip": events_json_roundtrip,
    "bronze_sample": bronze_sample,
    "retrain_decision": retrain_decision,
    "silver_enriched": silver_enriched,
    "gold_dag_table": gold_dag_table,
    "sorted_codes": sorted_codes,
    "gold_incremental": gold_incremental,
    "gold_state_stats": gold_state_stats,
    "pipeline_run": pipeline_run,
    "kpi_latency_exact": kpi_latency_exact,
    "stream_quarantine": stream_quarantine,
    "newton_root_gains": newton_root_gains,
    "top_gain_features": top_gain_features,
    "newton_stages": newton_stages,
    "newton_scores": newton_scores,
    "evaluation_record": evaluation_record,
    "model_run_log": model_run_log,
    "roc_curve_min": roc_curve_min,
    "quality_fresh": quality_fresh,
    "feature_drift_partial": feature_drift_partial,
    "completion_estimate": completion_estimate,
    "scoring_rejects": scoring_rejects,
    "silver_ctas_append": silver_ctas_append,
    "subscriber_history": subscriber_history,
    "fact_asof": fact_asof,
    "landing_evolved": landing_evolved,
    "stream_enriched": stream_enriched,
    "ingest_indexed": ingest_indexed,
    "stream_gold": stream_gold,
}
