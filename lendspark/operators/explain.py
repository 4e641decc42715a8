"""Explanations: per-feature attributions → top factors → sentences.

The per-row work is a narrow projection: attributions form an array of
structs, the top-n are taken with ``sort_array`` + ``slice``, and templates
are looked up in literal maps (a fixed 33-feature table, so its size is
bounded by construction).  No explode, no shuffle, no Python row loop.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import title_from_snake
from .stats import INTENT_BONUS, PROPENSITY_WEIGHTS

# Business-language templates per feature and direction.
FEATURE_TEMPLATES = [
    ("monthly_credit_mean",
     "Strong average monthly inflows of ₹{value:,.0f}",
     "Low average monthly inflows of ₹{value:,.0f}"),
    ("estimated_salary",
     "Consistent salary credit pattern of ~₹{value:,.0f}/month",
     "Inconsistent or low salary pattern (~₹{value:,.0f}/month)"),
    ("salary_regularity_score",
     "Highly regular income credit pattern ({value:.0%} regularity)",
     "Irregular income credit pattern ({value:.0%} regularity)"),
    ("has_salary_credit",
     "Identifiable recurring salary credits detected",
     "No clear salary credit pattern found"),
    ("declared_monthly_income",
     "Declared income of ₹{value:,.0f}/month supports eligibility",
     "Low declared income of ₹{value:,.0f}/month"),
    ("cashflow_cv",
     "Stable cash-flow pattern (low variability of {value:.1%})",
     "Variable cash-flow pattern (CV of {value:.1%})"),
    ("monthly_credit_std",
     "Consistent monthly credit amounts",
     "Highly variable monthly credit amounts"),
    ("emi_to_income_ratio",
     "Low existing EMI burden ({value:.0%} of income)",
     "High existing EMI burden ({value:.0%} of income)"),
    ("avg_monthly_emi",
     "Manageable existing EMI of ₹{value:,.0f}/month",
     "Significant existing EMI of ₹{value:,.0f}/month"),
    ("digital_engagement_composite",
     "Active digital banking engagement (score: {value:.2f})",
     "Limited digital banking engagement (score: {value:.2f})"),
    ("avg_loan_page_visits",
     "Frequent loan product page visits ({value:.1f}/month) indicate interest",
     "Low loan product page exploration ({value:.1f}/month)"),
    ("avg_emi_calc_views",
     "Active use of EMI calculator ({value:.1f}/month) shows purchase intent",
     "Minimal EMI calculator usage ({value:.1f}/month)"),
    ("avg_app_logins",
     "Frequent app usage ({value:.1f} logins/month)",
     "Infrequent app usage ({value:.1f} logins/month)"),
    ("engagement_trend",
     "Increasing digital engagement trend (+{value:.0%})",
     "Declining digital engagement trend ({value:.0%})"),
    ("has_auto_spend",
     "Recent auto dealer/showroom transactions detected → Auto Loan intent signal",
     "No auto-related spend detected"),
    ("has_realestate_spend",
     "Real estate broker/property transactions detected → Home/Mortgage Loan intent",
     "No real estate spend detected"),
    ("has_wedding_spend",
     "Wedding/event-related spend detected → Personal Loan intent signal",
     "No wedding-related spend"),
    ("has_education_spend",
     "Education-related spending detected → Personal/Education Loan intent",
     "No education-related spend"),
    ("has_home_improvement_spend",
     "Home improvement spending detected → Mortgage/Home Loan intent",
     "No home improvement spend"),
    ("total_monthly_debit",
     "Healthy monthly spending of ₹{value:,.0f} indicates active lifestyle",
     "Low monthly spending of ₹{value:,.0f}"),
    ("spend_concentration_hhi",
     "Diversified spending across categories",
     "Concentrated spending pattern"),
    ("recency_score",
     "Recent banking activity (high recency)",
     "Low recent banking activity"),
    ("frequency_score",
     "Frequent transactions (active banking relationship)",
     "Infrequent transactions"),
    ("monetary_score",
     "High transaction volume (strong monetary relationship)",
     "Low transaction volume"),
    ("age",
     "Age profile ({value:.0f} yrs) aligns with loan product lifecycle",
     "Age profile ({value:.0f} yrs) is outside typical range for this product"),
    ("tenure_months",
     "Long banking relationship ({value:.0f} months) with the bank",
     "Relatively new banking relationship ({value:.0f} months)"),
    ("existing_products",
     "Multiple existing products ({value:.0f}) show relationship depth",
     "Limited existing product holdings ({value:.0f})"),
    ("occupation_encoded",
     "Stable employment category supports income reliability",
     "Employment category indicates variable income"),
    ("city_tier_encoded",
     "Metropolitan location supports higher income potential",
     "Non-metro location may limit income ceiling"),
    ("interest_personal_loan",
     "Personal Loan interest indicators detected",
     "No Personal Loan interest signals"),
    ("interest_home_loan",
     "Home Loan interest indicators detected",
     "No Home Loan interest signals"),
    ("interest_mortgage_loan",
     "Mortgage Loan interest indicators detected",
     "No Mortgage Loan interest signals"),
    ("interest_auto_loan",
     "Auto Loan interest indicators detected",
     "No Auto Loan interest signals"),
]

_SPEC = re.compile(r"\{value(?::([^}]*))?\}")
# Python format spec → our formatter kind
_KINDS = {",.0f": "grouped0", ".0%": "pct0", ".1%": "pct1", ".2f": "fixed2", ".1f": "fixed1", ".0f": "fixed0",
          None: "plain", "": "plain"}


def template_rows() -> list[tuple[str, str, str, str]]:
    """(feature, direction, template with ``{value}`` placeholder, kind)."""
    rows = []
    for feature, pos, neg in FEATURE_TEMPLATES:
        for direction, text in (("positive", pos), ("negative", neg)):
            m = _SPEC.search(text)
            kind = _KINDS[m.group(1)] if m else "none"
            rows.append((feature, direction, _SPEC.sub("{value}", text), kind))
    return rows


def template_table(spark) -> DataFrame:
    return spark.createDataFrame(template_rows(), "feature string, direction string, template string, kind string")


def _map_literal(pairs) -> Column:
    args = []
    for k, v in pairs:
        args += [F.lit(k), F.lit(v)]
    return F.create_map(*args)


def format_value(kind: Column, v: Column) -> Column:
    """Render a number the way the template's format spec would."""
    fixed = lambda d: F.replace(F.format_number(v, d), F.lit(","), F.lit(""))
    pct = lambda d: F.concat(F.replace(F.format_number(v * 100, d), F.lit(","), F.lit("")), F.lit("%"))
    return (F.when(kind == "grouped0", F.format_number(v, 0))
            .when(kind == "pct0", pct(0)).when(kind == "pct1", pct(1))
            .when(kind == "fixed2", fixed(2)).when(kind == "fixed1", fixed(1)).when(kind == "fixed0", fixed(0))
            .when(kind == "plain", v.cast("string")))


def describe(feature: Column, direction: Column, value: Column) -> Column:
    rows = template_rows()
    tmap = _map_literal([(f"{f}|{d}", t) for f, d, t, _ in rows])
    kmap = _map_literal([(f"{f}|{d}", k) for f, d, _, k in rows])
    key = F.concat(feature, F.lit("|"), direction)
    tpl = F.try_element_at(tmap, key)
    kind = F.try_element_at(kmap, key)
    rendered = F.when(kind == "none", tpl).otherwise(F.replace(tpl, F.lit("{value}"), format_value(kind, value)))
    fallback = F.concat(title_from_snake(feature),
                        F.when(direction == "positive", F.lit(" contributes positively"))
                        .otherwise(F.lit(" contributes negatively")))
    return F.coalesce(rendered, fallback)


# ---------------------------------------------------------------------------
# attributions
# ---------------------------------------------------------------------------

def linear_attribution(features: DataFrame) -> DataFrame:
    """Attributions of the linear propensity scorecard: wᵢ·(xᵢ − mean xᵢ) on
    the scaled features (sign flipped for features that enter as 1 − x).
    Adds ``attributions`` (array<struct<feature, shap_value, feature_value>>
    in feature order) and ``attribution_base`` (Σ wᵢ·mean xᵢ)."""
    terms = []  # (feature, weight, sign, scaled expr)
    present = [f for f, _, _ in PROPENSITY_WEIGHTS if f in features.columns]
    g = features.agg(*[F.min(f).alias(f"_lo_{f}") for f in present], *[F.max(f).alias(f"_hi_{f}") for f in present])
    j = features.crossJoin(F.broadcast(g))
    for f, w, inv in PROPENSITY_WEIGHTS:
        if f not in features.columns:
            continue
        lo, hi = F.col(f"_lo_{f}"), F.col(f"_hi_{f}")
        scaled = F.when(hi > lo, (F.col(f) - lo) / (hi - lo)).otherwise(F.lit(0.5))
        terms.append((f, w, -1.0 if inv else 1.0, scaled))
    for f, w in INTENT_BONUS:
        if f in features.columns:
            terms.append((f, w, 1.0, F.col(f).cast("double")))
    j = j.select(*features.columns, *[t[3].alias(f"_x{i}") for i, t in enumerate(terms)])
    means = j.agg(*[F.avg(f"_x{i}").alias(f"_m{i}") for i in range(len(terms))])
    k = j.crossJoin(F.broadcast(means))
    structs = [F.struct(F.lit(f).alias("feature"),
                        (F.lit(w * s) * (F.col(f"_x{i}") - F.col(f"_m{i}"))).alias("shap_value"),
                        F.col(f).cast("double").alias("feature_value"),
                        F.lit(i).alias("position"))
               for i, (f, w, s, _) in enumerate(terms)]
    base = F.lit(0.0)  # score at the mean: Σ w·mean(x), with 1 − mean for inverted features
    for i, (_, w, s, _) in enumerate(terms):
        mean_term = (F.lit(1.0) - F.col(f"_m{i}")) if s < 0 else F.col(f"_m{i}")
        base = base + F.lit(w) * mean_term
    return k.select(*features.columns, F.array(*structs).alias("attributions"), base.alias("attribution_base"))


def top_by_abs(attr: Column, n: int) -> Column:
    """Top-n attributions by |value| (ties: feature order), as structs."""
    keyed = F.transform(attr, lambda a: F.struct((-F.abs(a["shap_value"])).alias("k"), a["position"].alias("p"),
                                                 a["feature"].alias("feature"), a["shap_value"].alias("shap_value"),
                                                 a["feature_value"].alias("feature_value")))
    return F.slice(F.sort_array(keyed), 1, n)


def explanation_details_expr(attr: Column, n: int = 4) -> Column:
    top = top_by_abs(attr, n)
    return F.transform(top, lambda a: F.struct(
        a["feature"].alias("feature"),
        F.when(a["shap_value"] > 0, F.lit("positive")).otherwise(F.lit("negative")).alias("direction"),
        describe(a["feature"], F.when(a["shap_value"] > 0, F.lit("positive")).otherwise(F.lit("negative")),
                 a["feature_value"]).alias("description"),
        F.bround(a["shap_value"], 4).alias("shap_value"),
        F.bround(a["feature_value"], 4).alias("feature_value")))


def explanation_summary_expr(details: Column, product: Column) -> Column:
    positives = F.filter(details, lambda d: d["direction"] == "positive")
    texts = F.slice(F.transform(positives, lambda d: d["description"]), 1, 3)
    has_product = product.isNotNull() & (product != "")
    tail = F.when(has_product, F.concat(F.lit(" → strong "), product, F.lit(" intent"))).otherwise(F.lit(""))
    mixed = F.concat(F.lit("Mixed signals detected for "),
                     F.when(has_product, product).otherwise(F.lit("loan")),
                     F.lit(" eligibility — review recommended"))
    return F.when(F.size(texts) > 0, F.concat(F.array_join(texts, " + "), tail)).otherwise(mixed)


def attribution_map_expr(attr: Column) -> Column:
    return F.map_from_arrays(F.transform(attr, lambda a: a["feature"]),
                             F.transform(attr, lambda a: F.bround(a["shap_value"], 4)))


def batch_explanations(scored_with_attr: DataFrame, top_n: int = 4,
                       product_col: str = "loan_product_interest") -> DataFrame:
    """Adds explanation_details, explanation_summary, shap_values_dict."""
    d = scored_with_attr.withColumn("explanation_details", explanation_details_expr(F.col("attributions"), top_n))
    prod = F.col(product_col) if product_col in d.columns else F.lit("")
    return (d.withColumn("explanation_summary", explanation_summary_expr(F.col("explanation_details"), prod))
             .withColumn("shap_values_dict", attribution_map_expr(F.col("attributions"))))


def explanation_rows(df: DataFrame) -> DataFrame:
    """Flat view: one row per (customer, rank) of the details."""
    return df.select("customer_id", F.posexplode("explanation_details").alias("pos", "d")).select(
        "customer_id", (F.col("pos") + 1).alias("rank"), "d.feature", "d.direction", "d.description",
        "d.shap_value", "d.feature_value")


def top_drivers(df: DataFrame, n: int = 12) -> DataFrame:
    """Top-n entries of the attribution map, titled for display."""
    e = F.map_entries(F.col("shap_values_dict"))
    keyed = F.transform(e, lambda x: F.struct((-F.abs(x["value"])).alias("k"), x["key"].alias("feature"),
                                              x["value"].alias("value")))
    top = F.slice(F.sort_array(keyed), 1, n)
    return df.select("customer_id", F.posexplode(top).alias("pos", "t")).select(
        "customer_id", (F.col("pos") + 1).alias("rank"), title_from_snake(F.col("t.feature")).alias("driver"),
        F.col("t.value").alias("shap_value"))


def generate_explanation(spark, shap_values, feature_values: dict, feature_names: list[str],
                         loan_product: str = "", top_n: int = 4) -> dict:
    """Single-customer convenience API: runs the batch operator on a
    one-row frame and returns {summary, details, shap_dict}."""
    structs = [(f, float(s), float(feature_values.get(f, 0) or 0), i)
               for i, (f, s) in enumerate(zip(feature_names, shap_values))]
    df = spark.createDataFrame(
        [("_one", loan_product, structs)],
        "customer_id string, loan_product_interest string, "
        "attributions array<struct<feature:string, shap_value:double, feature_value:double, position:int>>")
    row = batch_explanations(df, top_n).collect()[0]
    return {"summary": row.explanation_summary,
            "details": [d.asDict() for d in row.explanation_details],
            "shap_dict": dict(row.shap_values_dict)}
