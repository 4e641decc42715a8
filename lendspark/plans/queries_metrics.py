"""Metric, band and deviation queries (§2.9) on the scored frame."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import income as inc
from ..operators import metrics as mx
from ..operators import models as md
from ..operators import stats as st
from ..session import ensure_checkpoint_dir
from ..sources import io
from ..sources.io import stored_sorted
from .catalog import register, round_cols
from .oracle_sql import with_scored
from .scored import feature_matrix, scored

RANK_CTE = """
, f_rank as (select customer_id, lead_score, loan_converted,
                    row_number() over (order by lead_score desc, customer_id) as rn,
                    count(*) over () as n from f_scored)
"""
ST_CTE = """
, f_st as (select lead_score as s, cast(sum(loan_converted) as double) as pos,
                  cast(sum(1 - loan_converted) as double) as neg from f_scored group by 1)
, f_stc as (select *, sum(pos) over (order by s desc rows between unbounded preceding and current row) as cum_pos,
                   sum(neg) over (order by s desc rows between unbounded preceding and current row) as cum_neg,
                   sum(pos) over () as tp, sum(neg) over () as tn from f_st)
"""
CUTS = "(values (5), (10), (15), (20), (25), (30), (50)) c(p)"


@register("roc_auc", with_scored(ST_CTE + "select round(sum(pos * (tn - cum_neg + 0.5e0 * neg)) / (max(tp) * max(tn)), 6) "
                                          "as roc_auc from f_stc"))
def q_roc_auc(spark, sf):
    return round_cols(mx.roc_auc_and_ap(scored(spark, sf)).select("roc_auc"), ["roc_auc"])


@register("average_precision", with_scored(
    ST_CTE + "select round(sum((pos / tp) * (cum_pos / (cum_pos + cum_neg))), 6) as average_precision from f_stc"))
def q_average_precision(spark, sf):
    return round_cols(mx.roc_auc_and_ap(scored(spark, sf)).select("average_precision"), ["average_precision"])


@register("precision_at_top20", with_scored(
    RANK_CTE + "select round_even(avg(case when rn <= greatest(floor(n * 20 / 100), 1) then loan_converted end), 4) "
               "as precision_at_top20 from f_rank"))
def q_precision_top20(spark, sf):
    return mx.precision_at_top(scored(spark, sf), 20)


@register("conversion_at_cutoffs", with_scored(
    RANK_CTE + "select p as cutoff_pct, cast(greatest(floor(max(n) * p / 100), 1) as bigint) as n_selected, "
               "round_even(avg(case when rn <= greatest(floor(n * p / 100), 1) then loan_converted end) * 100, 1) "
               f"as conversion_rate from f_rank cross join {CUTS} group by p"))
def q_conversion_cutoffs(spark, sf):
    return mx.conversion_at_cutoffs(scored(spark, sf))


@register("top_pct_selection", with_scored(
    RANK_CTE + "select customer_id, rn as score_rank, cast(min(case when rn <= greatest(floor(n * p / 100), 1) then p end) "
               f"as integer) as top_pct from f_rank cross join {CUTS} group by customer_id, rn"))
def q_top_pct(spark, sf):
    return mx.top_pct_selection(scored(spark, sf))


@register("base_rate", with_scored("select round_even(avg(loan_converted) * 100, 1) as base_conversion_rate "
                                   "from f_scored"))
def q_base_rate(spark, sf):
    return mx.base_rate(scored(spark, sf))


@register("threshold_class", with_scored(
    "select customer_id, cast(lead_score / 100 >= 0.5 as integer) as y_pred from f_scored"))
def q_threshold(spark, sf):
    s = scored(spark, sf).withColumn("_p", F.col("lead_score") / 100)
    return mx.threshold_class(s, "_p").select("customer_id", "y_pred")


@register("class_weight", with_scored(
    "select round(sum(case when loan_converted = 0 then 1 else 0 end) / "
    "greatest(sum(case when loan_converted = 1 then 1 else 0 end), 1), 6) as scale_pos_weight from f_scored"))
def q_class_weight(spark, sf):
    return round_cols(mx.class_weight(scored(spark, sf)), ["scale_pos_weight"])


@register("training_profile", with_scored(
    "select count(*) as n_rows, count(case when loan_converted = 1 then 1 end) as n_positive, "
    "count(case when loan_converted = 0 then 1 end) as n_negative, round_even(avg(loan_converted) * 100, 1) as base_rate_pct, "
    "round(min(true_monthly_income), 6) as income_min, round(max(true_monthly_income), 6) as income_max, "
    "round(median(true_monthly_income), 6) as income_median from f_scored"))
def q_training_profile(spark, sf):
    return round_cols(mx.training_profile(scored(spark, sf)), ["income_min", "income_max", "income_median"])


@register("regression_metrics", with_scored(
    "select round_even(avg(abs(true_monthly_income - estimated_income)), 2) as mae, "
    "round_even(sqrt(avg((true_monthly_income - estimated_income) * (true_monthly_income - estimated_income))), 2) as rmse, "
    "round_even(1 - sum((true_monthly_income - estimated_income) * (true_monthly_income - estimated_income)) / "
    "sum((true_monthly_income - mu) * (true_monthly_income - mu)), 4) as r2_score "
    "from f_scored cross join (select avg(true_monthly_income) as mu from f_scored) m"))
def q_regression(spark, sf):
    return mx.regression_metrics(scored(spark, sf), "true_monthly_income", "estimated_income")


@register("mape_mdape", with_scored(
    "select round_even(avg(ape) * 100, 1) as mape_pct, round_even(median(ape) * 100, 1) as mdape_pct from "
    "(select abs(true_monthly_income - estimated_income) / true_monthly_income as ape from f_scored "
    "where true_monthly_income > 1000) t"))
def q_mape(spark, sf):
    return mx.percentage_errors(scored(spark, sf), "true_monthly_income", "estimated_income")


@register("income_ols_baseline", with_scored(
    "select coalesce(occupation, 'all') as fitted_on, n, round(slope, 6) as slope, round(intercept, 4) as intercept, "
    "round_even(mape, 1) as mape_pct, held_out from f_ols left join (select occupation as o, count(*) as held_out, "
    "avg(abs(true_monthly_income - estimated_income) / true_monthly_income) * 100 as mape from f_scored "
    "where true_monthly_income > 1000 and cast('0x' || substr(md5(cast(customer_id as varchar)), 1, 8) as bigint) % 5 = 0 "
    "group by rollup (occupation)) e on o is not distinct from occupation"))
def q_income_ols(spark, sf):
    """The regression lines behind estimated_income and their error on the customers they were not fitted on."""
    fit = inc.fit_income_ols(feature_matrix(spark, sf).filter(inc.ols_training_rows()))
    ape = F.abs(F.col("true_monthly_income") - F.col("estimated_income")) / F.col("true_monthly_income")
    errors = (scored(spark, sf).filter(~inc.ols_training_rows() & (F.col("true_monthly_income") > 1000)).rollup("occupation")
              .agg(F.count(F.lit(1)).alias("held_out"), F.bround(F.avg(ape) * 100, 1).alias("mape_pct"))
              .withColumnRenamed("occupation", "_o"))
    out = fit.join(errors, F.col("group").eqNullSafe(F.col("_o")), "left")
    return round_cols(out.select(F.coalesce("group", F.lit("all")).alias("fitted_on"), "n", "slope",
                                 F.round("intercept", 4).alias("intercept"), "mape_pct", "held_out"), ["slope"])


@register("scorecard_score", with_scored("select customer_id, lead_score from f_scored"))
def q_scorecard_score(spark, sf):
    return st.scorecard_score(feature_matrix(spark, sf)).select("customer_id", "lead_score")


@register("near_zero_exclusion", with_scored(
    "select count(*) filter (where true_monthly_income > 1000) as n_included, "
    "count(*) filter (where not (true_monthly_income > 1000)) as n_excluded from f_scored"))
def q_near_zero(spark, sf):
    s = scored(spark, sf)
    keep = F.col("true_monthly_income") > 1000
    return s.agg(F.count(F.when(keep, 1)).alias("n_included"), F.count(F.when(~keep, 1)).alias("n_excluded"))


@register("band_distribution", with_scored(
    "select income_confidence_band, count(*) as n_customers from f_scored group by 1"))
def q_band_distribution(spark, sf):
    return mx.band_metrics(scored(spark, sf), "true_monthly_income", "estimated_income") \
        .select("income_confidence_band", "n_customers")


@register("band_mape", with_scored(
    "select income_confidence_band, round_even(avg(abs(true_monthly_income - estimated_income) / "
    "greatest(true_monthly_income, 1)) * 100, 1) as band_mape from f_scored group by 1"))
def q_band_mape(spark, sf):
    return mx.band_metrics(scored(spark, sf), "true_monthly_income", "estimated_income") \
        .select("income_confidence_band", "band_mape")


@register("confidence_band_train", with_scored("select customer_id, income_confidence_band from f_scored"))
def q_band_train(spark, sf):
    return scored(spark, sf).select("customer_id", "income_confidence_band")


@register("confidence_band_infer", with_scored(
    "select customer_id, case when cashflow_cv > 0.40 then 'Low' "
    "when cashflow_cv < 0.10 and b0 = 'Medium' then 'High' else b0 end as income_confidence_band from "
    "(select customer_id, cashflow_cv, case occupation when 'salaried' then 'High' when 'gig_worker' then 'Low' "
    "else 'Medium' end as b0 from f_scored) t"))
def q_band_infer(spark, sf):
    s = scored(spark, sf).select("customer_id", "occupation", "cashflow_cv", "estimated_income")
    return inc.assign_confidence_band(s, true_col=None).select("customer_id", "income_confidence_band")


@register("income_deviation", with_scored(
    "select customer_id, income_deviation_pct, income_deviation_flag from f_scored"))
def q_income_deviation(spark, sf):
    return scored(spark, sf).select("customer_id", "income_deviation_pct", "income_deviation_flag")


@register("deviation_flag_rate", with_scored(
    "select count(case when abs(d) > 20 then 1 end) as n_flagged, "
    "round_even(count(case when abs(d) > 20 then 1 end) / count(*) * 100, 1) as pct_flagged from "
    "(select (declared_monthly_income - estimated_income) / greatest(estimated_income, 1) * 100 as d from f_scored) t"))
def q_deviation_rate(spark, sf):
    return mx.deviation_flag_rate(scored(spark, sf))


@register("mape", with_scored(
    "select round_even(avg(abs(true_monthly_income - estimated_income) / true_monthly_income) * 100, 1) as mape_pct "
    "from f_scored where true_monthly_income > 1000"))
def q_mape_only(spark, sf):
    return mx.mape(scored(spark, sf), "true_monthly_income", "estimated_income")


@register("mdape", with_scored(
    "select round_even(median(abs(true_monthly_income - estimated_income) / true_monthly_income) * 100, 1) as mdape_pct "
    "from f_scored where true_monthly_income > 1000"))
def q_mdape_only(spark, sf):
    return mx.mdape(scored(spark, sf), "true_monthly_income", "estimated_income")


# --- metric documents ---------------------------------------------------------------

_HASH = "cast('0x' || substr(md5('42:' || cast(customer_id as varchar)), 1, 15) as bigint)"
_FIELD = "select '{0}' as document, '{1}' as field, cast({2} as double) as value from {3}"
_LEAD_FIELDS = [
    ("roc_auc", "round_even(sum(pos * (tn - cum_neg + 0.5e0 * neg)) / (max(tp) * max(tn)), 4)", "stc"),
    ("average_precision", "round_even(sum((pos / tp) * (cum_pos / (cum_pos + cum_neg))), 4)", "stc"),
    ("precision_at_top20", "round_even(avg(case when rn <= greatest(floor(n * 20 / 100), 1) then loan_converted end), 4)", "r"),
    ("base_conversion_rate", "round_even(avg(loan_converted) * 100, 1)", "f_scored"),
    *[(f"conversion_rate_simulation.top_{p}pct",
       f"round_even(avg(case when rn <= greatest(floor(n * {p} / 100), 1) then loan_converted end) * 100, 1)", "r") for p in mx.CUTOFFS],
    ("n_train", "count(*)", "f_split where not lead_test"), ("n_test", "count(*)", "r"), ("n_features", "max(8)", "r")]
_ERR = "(true_monthly_income - estimated_income)"
_INCOME_FIELDS = [
    ("mae", f"round_even(avg(abs{_ERR}), 2)", "i"), ("rmse", f"round_even(sqrt(avg({_ERR} * {_ERR})), 2)", "i"),
    ("r2_score", f"round_even(1 - sum({_ERR} * {_ERR}) / sum((true_monthly_income - mu) * (true_monthly_income - mu)), 4)", "i"),
    ("mape_pct", f"round_even(avg(case when true_monthly_income > 1000 then abs{_ERR} / true_monthly_income end) * 100, 1)", "i"),
    ("mdape_pct", f"round_even(median(case when true_monthly_income > 1000 then abs{_ERR} / true_monthly_income end) * 100, 1)", "i"),
    *[(f"confidence_band_distribution.{b}", f"count(case when income_confidence_band = '{b}' then 1 end)", "i") for b in mx.BANDS],
    *[(f"confidence_band_mape.{b}", f"round_even(avg(case when income_confidence_band = '{b}' then abs{_ERR} / "
       "greatest(true_monthly_income, 1) end) * 100, 1)", "i") for b in mx.BANDS],
    ("income_deviation_flagged_n", "count(case when abs(d) > 20 then 1 end)", "i"),
    ("income_deviation_flagged_pct", "round_even(count(case when abs(d) > 20 then 1 end) / count(*) * 100, 1)", "i"),
    ("n_train", "count(*)", "f_split where not income_test"), ("n_test", "count(*)", "i")]


@register("json_metrics_scan", with_scored(
    f""", f_split as (
  select *, (declared_monthly_income - estimated_income) / greatest(estimated_income, 1) * 100 as d,
         row_number() over (partition by loan_converted order by h) <= floor(count(*) over (partition by loan_converted) * 0.2e0 + 0.5e0) as lead_test,
         row_number() over (order by h) <= ceil(count(*) over () * 0.2e0) as income_test
  from (select *, {_HASH} as h from f_scored) t)
, r as (select *, row_number() over (order by lead_score desc, customer_id) as rn, count(*) over () as n from f_split where lead_test)
, st as (select lead_score as s, cast(sum(loan_converted) as double) as pos, cast(sum(1 - loan_converted) as double) as neg from r group by 1)
, stc as (select *, sum(pos) over (order by s desc rows between unbounded preceding and current row) as cum_pos,
                 sum(neg) over (order by s desc rows between unbounded preceding and current row) as cum_neg,
                 sum(pos) over () as tp, sum(neg) over () as tn from st)
, i as (select *, avg(true_monthly_income) over () as mu from f_split where income_test)
""" + " union all ".join([_FIELD.format("lead_scoring", *f) for f in _LEAD_FIELDS]
                         + [_FIELD.format("income_estimation", *f) for f in _INCOME_FIELDS])))
def q_json_metrics_scan(spark, sf):
    """Both metric documents of the scorecard and the regression, over the test
    rows of the two splits: written as JSON of different shapes, read back as
    VARIANT and listed field by field."""
    s = scored(spark, sf)
    lead = md.stratified_split(s, "loan_converted").select("customer_id", "lead_score", "loan_converted", "is_test")
    income = md.random_split(s).select(*[c for c in s.columns if c in mx.INCOME_DOCUMENT_COLUMNS], "is_test")
    lead, income = stored_sorted(lead, "customer_id"), stored_sorted(income, "customer_id")
    train = lambda df: df.filter("not is_test").agg(F.count(F.lit(1)).alias("n_train"))
    documents = {"lead_scoring": mx.lead_metrics_document(lead.filter("is_test"), 0, len(st.SCORECARD_TERMS), base=lead)
                 .drop("n_train").crossJoin(train(lead)),
                 "income_estimation": mx.income_metrics_document(income.filter("is_test"), 0).drop("n_train").crossJoin(train(income))}
    docs = [d.select(F.lit(name).alias("document"), F.to_json(F.struct(*d.columns), {"ignoreNullFields": "false"}).alias("doc"))
            for name, d in documents.items()]
    path = f"{ensure_checkpoint_dir(spark)}/metrics-{uuid.uuid4().hex}"
    io.write_metric_documents(docs[0].unionByName(docs[1]), path)
    return io.metric_fields(io.read_metric_documents(spark, path)).select("document", "field", "value")
