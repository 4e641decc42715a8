"""Explanation queries (§2.11) over the linear-scorecard attributions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import explain as ex
from ..operators.stats import INTENT_BONUS, PROPENSITY_WEIGHTS
from .catalog import register, round_cols
from .oracle_sql import with_scored
from .queries_stats import NORM_CTE
from .scored import scored

TOP_N = 4


def _attr_terms():
    terms = [(f, w * (-1.0 if inv else 1.0), f"{f}_n") for f, w, inv in PROPENSITY_WEIGHTS]
    terms += [(f, w, f"cast({f} as double)") for f, w in INTENT_BONUS]
    return terms


def _attr_sql() -> str:
    terms = _attr_terms()
    x0 = ("select customer_id, loan_product_interest, "
          + ", ".join(f"{expr} as x{i}, cast({f} as double) as v{i}" for i, (f, _, expr) in enumerate(terms))
          + " from f_norm")
    means = "select " + ", ".join(f"avg(x{i}) as m{i}" for i in range(len(terms))) + " from f_att0"
    parts = [f"select customer_id, loan_product_interest, '{f}' as feature, {w!r}e0 * (x{i} - m{i}) as shap_value, "
             f"v{i} as feature_value, {i} as position from f_att0 cross join f_att_m"
             for i, (f, w, _) in enumerate(terms)]
    parts = [p.replace(f"{w!r}e0", f"cast({w!r} as double)") for p, (_, w, _) in zip(parts, terms)]
    return (NORM_CTE + f", f_att0 as ({x0})\n, f_att_m as ({means})\n, f_att as ("
            + " union all ".join(parts) + ")\n")


def _templates_sql() -> str:
    vals = ", ".join("(" + ", ".join("'" + x.replace("'", "''") + "'" for x in row) + ")" for row in ex.template_rows())
    return f", f_tpl as (select * from (values {vals}) t(feature, direction, template, kind))\n"


DETAILS_CTE = _attr_sql() + _templates_sql() + f"""
, f_top as (select *, case when shap_value > 0 then 'positive' else 'negative' end as direction,
                   row_number() over (partition by customer_id order by abs(shap_value) desc, position) as rnk
            from f_att)
, f_details as (
  select t.customer_id, t.loan_product_interest, cast(t.rnk as integer) as rank, t.feature, t.direction,
         coalesce(case when p.kind = 'none' then p.template
                       else replace(p.template, '{{value}}',
                            case p.kind when 'grouped0' then format('{{:,.0f}}', t.feature_value)
                                        when 'pct0' then format('{{:.0f}}', t.feature_value * 100) || '%'
                                        when 'pct1' then format('{{:.1f}}', t.feature_value * 100) || '%'
                                        when 'fixed2' then format('{{:.2f}}', t.feature_value)
                                        when 'fixed1' then format('{{:.1f}}', t.feature_value)
                                        when 'fixed0' then format('{{:.0f}}', t.feature_value) end) end,
                  list_aggr(list_transform(string_split(replace(t.feature, '_', ' '), ' '),
                            lambda w: upper(w[1]) || lower(w[2:])), 'string_agg', ' ')
                  || case when t.direction = 'positive' then ' contributes positively' else ' contributes negatively' end)
           as description,
         round_even(t.shap_value, 4) as shap_value, round_even(t.feature_value, 4) as feature_value
  from f_top t left join f_tpl p on t.feature = p.feature and t.direction = p.direction
  where t.rnk <= {TOP_N})
"""


_SUMMARY = """
, f_summary as (
select customer_id,
       case when coalesce(len(pos_texts), 0) > 0
            then array_to_string(list_slice(pos_texts, 1, 3), ' + ')
                 || case when p is not null and p <> '' then ' → strong ' || p || ' intent' else '' end
            else 'Mixed signals detected for ' || coalesce(nullif(p, ''), 'loan') || ' eligibility — review recommended'
       end as explanation_summary
from (select customer_id, any_value(loan_product_interest) as p,
             list(description order by rank) filter (where direction = 'positive') as pos_texts
      from f_details group by customer_id) s)
"""


def attributed(spark, sf):
    return ex.linear_attribution(scored(spark, sf))


def explained(spark, sf):
    return ex.batch_explanations(attributed(spark, sf), TOP_N)


@register("linear_attribution", with_scored(_attr_sql() + "select customer_id, feature, round(shap_value, 6) as shap_value "
                                                          "from f_att"))
def q_linear_attribution(spark, sf):
    a = attributed(spark, sf).select("customer_id", F.explode("attributions").alias("a"))
    return round_cols(a.select("customer_id", "a.feature", "a.shap_value"), ["shap_value"])


@register("topk_by_abs", with_scored(
    _attr_sql() + "select customer_id, feature, round(shap_value, 6) as shap_value, cast(rnk as integer) as rank from "
    "(select *, row_number() over (partition by customer_id order by abs(shap_value) desc, position) as rnk from f_att) t "
    f"where rnk <= {TOP_N}"))
def q_topk_abs(spark, sf):
    a = attributed(spark, sf)
    t = a.select("customer_id", F.posexplode(ex.top_by_abs(F.col("attributions"), TOP_N)).alias("pos", "t"))
    return round_cols(t.select("customer_id", "t.feature", "t.shap_value", (F.col("pos") + 1).alias("rank")),
                      ["shap_value"])


@register("explanation_details", with_scored(
    DETAILS_CTE + "select customer_id, rank, feature, direction, description, shap_value, feature_value from f_details"))
def q_details(spark, sf):
    return ex.explanation_rows(explained(spark, sf))


@register("explanation_summary", with_scored(
    DETAILS_CTE + _SUMMARY + "select * from f_summary"))
def q_summary(spark, sf):
    return explained(spark, sf).select("customer_id", "explanation_summary")


@register("template_lookup", with_scored(
    DETAILS_CTE + "select d.customer_id, d.rank, d.feature, d.direction, "
    "coalesce(p.template, 'generic') as template from f_details d left join f_tpl p "
    "on d.feature = p.feature and d.direction = p.direction"))
def q_template_lookup(spark, sf):
    rows = ex.explanation_rows(explained(spark, sf)).select("customer_id", "rank", "feature", "direction")
    tpl = ex.template_table(spark).select("feature", "direction", "template")
    j = rows.join(F.broadcast(tpl), ["feature", "direction"], "left")  # 66-row fixed table
    return j.select("customer_id", "rank", "feature", "direction",
                    F.coalesce(F.col("template"), F.lit("generic")).alias("template"))


@register("template_table", with_scored(
    DETAILS_CTE + "select p.feature, p.direction, p.kind, count(d.customer_id) as n_used from f_tpl p "
    "left join f_details d on d.feature = p.feature and d.direction = p.direction group by 1, 2, 3"))
def q_template_table(spark, sf):
    rows = ex.explanation_rows(explained(spark, sf)).groupBy("feature", "direction").agg(
        F.count(F.lit(1)).alias("_n"))
    tpl = ex.template_table(spark)
    return tpl.join(rows, ["feature", "direction"], "left").select(
        "feature", "direction", "kind", F.coalesce(F.col("_n"), F.lit(0)).alias("n_used"))


DRIVERS = 12


@register("attribution_map", with_scored(
    _attr_sql() + "select customer_id, feature, round_even(shap_value, 4) as shap_value from f_att"))
def q_attribution_map(spark, sf):
    """The map of every customer, listed entry by entry."""
    return explained(spark, sf).select("customer_id", F.explode("shap_values_dict").alias("feature", "shap_value"))


@register("batch_explanations", with_scored(
    DETAILS_CTE + _SUMMARY + "select customer_id, explanation_summary, rank, feature, direction, description, shap_value, feature_value, "
    "shap_value as shap_in_map, cast(" + str(len(_attr_terms())) + " as integer) as n_attributions from f_summary join f_details using (customer_id)"))
def q_batch(spark, sf):
    """The three explanation columns of every customer, one row for each listed factor."""
    each = explained(spark, sf).select("customer_id", "explanation_summary", "shap_values_dict",
                                       F.posexplode("explanation_details").alias("pos", "d"))
    return each.select("customer_id", "explanation_summary", (F.col("pos") + 1).alias("rank"), "d.feature", "d.direction", "d.description",
                       "d.shap_value", "d.feature_value", F.col("shap_values_dict")[F.col("d.feature")].alias("shap_in_map"),
                       F.size("shap_values_dict").alias("n_attributions"))


@register("top_drivers", with_scored(
    _attr_sql() + "select customer_id, cast(rnk as integer) as rank, list_aggr(list_transform(string_split(replace(feature, '_', ' '), ' '), "
    "lambda w: upper(w[1]) || lower(w[2:])), 'string_agg', ' ') as driver, v as shap_value from ("
    "select customer_id, feature, v, row_number() over (partition by customer_id order by abs(v) desc, feature) as rnk from "
    f"(select customer_id, feature, round_even(shap_value, 4) as v from f_att) r) t where rnk <= {DRIVERS}"))
def q_top_drivers(spark, sf):
    return ex.top_drivers(explained(spark, sf), DRIVERS)
