"""Budget vs actual: ledger actuals, monthly forecasts, variance.

Actuals and forecasts share one 26-column schema (:data:`LAYER_SCHEMA`) so
that the variance layer can join them directly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline import params as P
from ledgerline.functions._col import to_int64
from ledgerline.functions.dates import month_names, parse_period
from ledgerline.functions.money import numeric_pct, round_money
from ledgerline.functions.text import like_prefix
from ledgerline.operators.sorting import display_order
from ledgerline.operators.spines import expand_months

LAYER_SCHEMA = (
    ("jaar", "string"), ("maand", "string"), ("month_name_short", "string"),
    ("gl_code", "string"), ("gl_description", "string"), ("gl_code_description", "string"),
    ("gl_type", "string"), ("gl_type_label", "string"),
    ("revenue_category", "string"), ("cost_category", "string"), ("category", "string"),
    ("organization_group", "string"),
    ("beneficiary_key", "string"), ("beneficiary_id", "string"), ("beneficiary_label", "string"),
    ("revenue_amount", P.MONEY), ("cost_amount", P.MONEY), ("profit_amount", P.MONEY),
    ("data_type", "string"), ("transaction_count", "bigint"),
    ("date_date", "date"), ("date_year", "bigint"), ("date_month", "bigint"),
    ("date_quarter", "bigint"), ("date_week", "bigint"), ("date_day", "bigint"),
)
GL_KEYS = ("date_date", "date_year", "date_month", "gl_code", "gl_description",
           "gl_type", "gl_type_label", "organization_group")


# --------------------------------------------------------------------------
# Column bundles
# --------------------------------------------------------------------------

def _codes(codes) -> str:
    return ", ".join(str(c) for c in codes)


def reportable_gl(schemaid: str = "schemaid") -> Column:
    """The GL whitelist: reportable codes only, 9900 never (a plain IN, pushed to Parquet)."""
    return F.expr(f"`{schemaid}` <> {P.GL_EXCLUDED_CODE} AND `{schemaid}` IN ({_codes(P.GL_WHITELIST)})")


def business_unit(schemaid: str = "schemaid") -> Column:
    """GL code -> 'Agency Social' / 'Agency' / 'Other'."""
    return F.expr(f"CASE WHEN `{schemaid}` IN ({_codes(P.GL_SOCIAL_CODES)}) THEN '{P.UNIT_SOCIAL}' "
                  f"WHEN `{schemaid}` IN ({_codes(P.GL_AGENCY_CODES)}) THEN '{P.UNIT_AGENCY}' "
                  f"ELSE '{P.UNIT_OTHER}' END")


def category_columns(kind: Column, description: Column, fallback: str) -> dict[str, Column]:
    """revenue_category, cost_category and category from a revenue/cost kind ('O'/'K'/other)."""
    is_rev, is_cost = kind == P.TYPE_REVENUE, kind == P.TYPE_COST
    named = F.coalesce(description, F.lit(fallback))
    return {
        "revenue_category": F.when(is_rev, F.coalesce(description, F.lit(P.CATEGORY_REVENUE_FALLBACK))),
        "cost_category": F.when(is_cost, F.coalesce(description, F.lit(P.CATEGORY_COST_FALLBACK))),
        "category": (F.when(is_cost, F.concat(F.lit(P.LABEL_COST + " - "), named))
                     .when(is_rev, F.concat(F.lit(P.LABEL_REVENUE + " - "), named))
                     .otherwise(named)),
    }


def actual_gl_labels(schemaid: Column, description: Column, gl_type: Column,
                     unit_col: str = "schemaid") -> dict[str, Column]:
    """GL identity and labels of a ledger line (fallback text 'Onbekend'); ``unit_col`` names the GL code."""
    code = schemaid.cast("string")
    desc = F.coalesce(description, F.lit(P.UNKNOWN))
    return {
        "gl_code": code,
        "gl_description": desc,
        "gl_code_description": F.concat(code, F.lit(" - "), desc),
        "gl_type": gl_type,
        "gl_type_label": (F.when(gl_type == P.TYPE_REVENUE, F.lit(P.LABEL_REVENUE))
                          .when(gl_type == P.TYPE_COST, F.lit(P.LABEL_COST))
                          .otherwise(F.concat(F.lit(P.UNKNOWN_TYPE_PREFIX), F.coalesce(gl_type, F.lit(P.UNKNOWN))))),
        **category_columns(gl_type, description, P.ACTUALS_TEXT_FALLBACK),
        "organization_group": business_unit(unit_col),
    }


def forecast_gl_labels(schemaid: Column, description: Column, post_label: Column,
                       unit_col: str = "schemaid") -> dict[str, Column]:
    """GL identity and labels of a budget line (fallback text 'Forecast'); ``unit_col`` names the GL code."""
    kind = (F.when(post_label == P.LABEL_REVENUE, F.lit(P.TYPE_REVENUE))
            .when(post_label == P.LABEL_COST, F.lit(P.TYPE_COST)))
    code = F.coalesce(schemaid.cast("string"),
                      F.when(post_label == P.LABEL_REVENUE, F.lit(P.FORECAST_CODE_REVENUE))
                      .when(post_label == P.LABEL_COST, F.lit(P.FORECAST_CODE_COST))
                      .otherwise(F.lit(P.FORECAST_CODE_OTHER)))
    desc = F.coalesce(description, post_label, F.lit(P.UNKNOWN))
    is_rev = post_label == P.LABEL_REVENUE
    return {
        "gl_code": code,
        "gl_description": desc,
        "gl_code_description": F.concat(code, F.lit(" - "), desc),
        "gl_type": F.when(is_rev, F.lit(P.TYPE_REVENUE)).otherwise(F.lit(P.TYPE_COST)),
        "gl_type_label": F.when(is_rev, F.lit(P.LABEL_REVENUE)).otherwise(F.lit(P.LABEL_COST)),
        **category_columns(kind, description, P.FORECAST_TEXT_FALLBACK),
        "organization_group": business_unit(unit_col),
    }


def layer_signature(df: DataFrame) -> list[tuple[str, str]]:
    """(name, type) of every column; actuals and forecasts must have the same signature."""
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]


def _layer(df: DataFrame, cols: dict[str, Column]) -> DataFrame:
    return df.select(*[cols[name].cast(typ).alias(name) for name, typ in LAYER_SCHEMA])


# --------------------------------------------------------------------------
# Layer 1: actuals
# --------------------------------------------------------------------------

def ledger_periods(ledger: DataFrame) -> DataFrame:
    """Ledger lines with the parsed period: period_year, period_month, period_date."""
    year, month = parse_period(F.col("group_identifier"))
    return ledger.select("*", year.alias("period_year"), month.alias("period_month"),
                         F.make_date(year, month, F.lit(1)).alias("period_date"))


def reportable_ledger(ledger: DataFrame, min_year: int = P.MIN_ACTUALS_YEAR) -> DataFrame:
    """Lines with a period text, a revenue/cost type, a whitelisted GL and year >= ``min_year``."""
    return (ledger_periods(
        ledger.where(like_prefix("group_identifier", P.PERIOD_LIKE))
        .where(F.col("schemaid_type").isin(P.TYPE_REVENUE, P.TYPE_COST))
        .where(reportable_gl("schemaid")))
        .where(F.col("period_year") >= min_year))


def finance_actuals(ledger: DataFrame, min_year: int = P.MIN_ACTUALS_YEAR,
                    amount_mode: str = "collapse") -> DataFrame:
    """Layer 1: monthly GL actuals in :data:`LAYER_SCHEMA`.

    ``amount_mode="collapse"`` (default, the original grain) groups equal
    lines: the amount is counted once and ``transaction_count`` says how many
    lines there were. ``"sum"`` adds the amounts per month x GL x beneficiary.

    The grouping runs on the raw keys; every output label is a function of
    them and, for revenue/cost lines, distinct keys give distinct label rows,
    so this equals grouping by the labels — with a narrower shuffle.
    """
    lines = reportable_ledger(ledger, min_year)
    # period_date is a function of (period_year, period_month): derived after the shuffle
    keys = ["period_year", "period_month", "schemaid", "schemaid_description",
            "schemaid_type", "beneficiary_key", "beneficiary_id", "beneficiary_label"]
    signed = F.coalesce(F.col("result"), F.lit(0))
    if amount_mode == "collapse":
        grouped = lines.groupBy(*keys, "result").agg(F.count(F.lit(1)).alias("transaction_count"))
        amount = F.coalesce(F.col("result"), F.lit(0))
    elif amount_mode == "sum":
        grouped = lines.groupBy(*keys).agg(F.count(F.lit(1)).alias("transaction_count"),
                                           F.sum(signed).alias("_amount"))
        amount = F.col("_amount")
    else:
        raise ValueError(f"unknown amount_mode {amount_mode!r}")
    gl_type = F.col("schemaid_type")
    revenue = F.round(F.when(gl_type == P.TYPE_REVENUE, -amount).otherwise(F.lit(0)), 2)
    cost = F.round(F.when(gl_type == P.TYPE_COST, amount).otherwise(F.lit(0)), 2)
    period = F.make_date(F.col("period_year"), F.col("period_month"), F.lit(1))
    full, short = month_names(period)
    cols = {
        "jaar": F.col("period_year").cast("string"), "maand": full, "month_name_short": short,
        **actual_gl_labels(F.col("schemaid"), F.col("schemaid_description"), gl_type),
        "beneficiary_key": F.col("beneficiary_key"),
        "beneficiary_id": F.col("beneficiary_id").cast("string"),
        "beneficiary_label": F.col("beneficiary_label"),
        "revenue_amount": revenue, "cost_amount": cost, "profit_amount": F.round(revenue - cost, 2),
        "data_type": F.lit(P.DATA_TYPE_ACTUAL), "transaction_count": F.col("transaction_count"),
        "date_date": period, "date_year": F.col("period_year"), "date_month": F.col("period_month"),
        "date_quarter": F.quarter(period), "date_week": F.weekofyear(period), "date_day": F.lit(1),
    }
    return _layer(grouped, cols)


# --------------------------------------------------------------------------
# Layer 2: forecasts
# --------------------------------------------------------------------------

def budget_base(budget: DataFrame) -> DataFrame:
    """Prognosis budgets with a valid date range, bounds truncated to month starts."""
    start = F.col("client_budget_startdate").cast("date")
    end = F.col("client_budget_enddate").cast("date")
    return (budget.where((F.col("client_budget_type") == P.BUDGET_TYPE)
                         & (F.col("budgetid") != P.EXCLUDED_BUDGET_ID)
                         & start.isNotNull() & end.isNotNull() & (start <= end))
            .select("budgetid", "description", "companyid",
                    F.trunc(start, "MM").alias("period_start_month"),
                    F.trunc(end, "MM").alias("period_end_month")))


def budget_items_joined(budget: DataFrame, budget_item: DataFrame) -> DataFrame:
    """Budget lines on reportable GLs with a non-zero price and a positive quantity."""
    items = (budget_item
             .where(F.col("budgetpostid_label").isin(P.LABEL_REVENUE, P.LABEL_COST)
                    & (F.coalesce(F.col("price_amount"), F.lit(0)) != 0)
                    & reportable_gl("schemaid"))
             .select("budgetid", "budgetitemid", "schemaid", "schemaid_description", "budgetpostid_label",
                     "price_type",
                     to_int64(budget_item.schema["price_quantity"].dataType, F.col("price_quantity"))
                     .alias("price_quantity"),
                     F.col("price_amount").cast(P.PRICE).alias("price_amount"),
                     F.col("quantity").cast(P.QUANTITY).alias("quantity"))
             .where(F.col("price_quantity") > 0))
    return budget_base(budget).join(items, "budgetid", "inner")


def budget_months(budget: DataFrame, budget_item: DataFrame) -> DataFrame:
    """One row per budget line and month of its budget; the amount is price x quantity every month.

    Nine decimals times nine decimals fit the 38 digits of a decimal, so the exact
    product is rounded once.
    """
    lines = budget_items_joined(budget, budget_item)
    return expand_months(lines, "period_start_month", "period_end_month").select(
        "budgetid", "description", "companyid", "budgetitemid", "schemaid", "schemaid_description",
        "budgetpostid_label",
        F.round(F.col("price_amount") * F.col("quantity"), 2).cast(P.MONEY).alias("monthly_amount"),
        "period_date")


def finance_forecasts(budget: DataFrame, budget_item: DataFrame, order: bool = True) -> DataFrame:
    """Layer 2: budget months in :data:`LAYER_SCHEMA` (data_type 'forecast')."""
    months = budget_months(budget, budget_item)
    label = F.col("budgetpostid_label")
    amount = F.col("monthly_amount")
    period = F.col("period_date")
    full, short = month_names(period)
    revenue = F.round(F.when(label == P.LABEL_REVENUE, amount).otherwise(F.lit(0)), 2)
    cost = F.round(F.when(label == P.LABEL_COST, amount).otherwise(F.lit(0)), 2)
    profit = F.round(F.when(label == P.LABEL_REVENUE, amount)
                     .when(label == P.LABEL_COST, -amount).otherwise(F.lit(0)), 2)
    cols = {
        "jaar": F.date_format(period, "yyyy"), "maand": full, "month_name_short": short,
        **forecast_gl_labels(F.col("schemaid"), F.col("schemaid_description"), label),
        "beneficiary_key": F.col("budgetid").cast("string"),
        "beneficiary_id": F.col("budgetitemid").cast("string"),
        "beneficiary_label": label,
        "revenue_amount": revenue, "cost_amount": cost, "profit_amount": profit,
        "data_type": F.lit(P.DATA_TYPE_FORECAST), "transaction_count": F.lit(0),
        "date_date": period, "date_year": F.year(period), "date_month": F.month(period),
        "date_quarter": F.quarter(period), "date_week": F.weekofyear(period), "date_day": F.lit(1),
    }
    out = _layer(months, cols)
    if order:
        out = display_order(out, [F.desc_nulls_last("date_year"), F.desc_nulls_last("date_month"),
                                  F.asc_nulls_first("organization_group"), F.desc_nulls_last("revenue_amount"),
                                  F.desc_nulls_last("cost_amount")],
                            ties=["beneficiary_key", "beneficiary_id"], spread=["beneficiary_id"])
    return out


# --------------------------------------------------------------------------
# Layer 3: variance
# --------------------------------------------------------------------------

def gl_totals(layer: DataFrame, prefix: str) -> DataFrame:
    """Month x GL totals of a layer: {prefix}_revenue, {prefix}_costs, {prefix}_profit."""
    return (layer.groupBy(*GL_KEYS)
            .agg(F.sum("revenue_amount").cast(P.TOTAL).alias(f"{prefix}_revenue"),
                 F.sum("cost_amount").cast(P.TOTAL).alias(f"{prefix}_costs"),
                 F.sum("profit_amount").cast(P.TOTAL).alias(f"{prefix}_profit"))
            .select(*GL_KEYS[:-1], f"{prefix}_revenue", f"{prefix}_costs", f"{prefix}_profit",
                    "organization_group"))


def actuals_by_gl(actuals: DataFrame) -> DataFrame:
    return gl_totals(actuals, "actual")


def forecasts_by_gl(forecasts: DataFrame) -> DataFrame:
    return gl_totals(forecasts, "forecast")


def variance_columns(forecast: Column, actual: Column, measure: str) -> dict[str, Column]:
    """Variance bundle of one measure: forecast - actual, its % of forecast, actual as % of forecast.

    NULL forecasts or actuals count as 0; the percentages are NULL when the
    forecast is 0 (never a division error).
    """
    fc, ac = F.coalesce(forecast, F.lit(0)), F.coalesce(actual, F.lit(0))
    return {
        f"variance_{measure}": round_money(fc - ac),
        f"variance_{measure}_pct": numeric_pct(fc - ac, fc),
        f"achievement_{measure}_pct": numeric_pct(ac, fc),
    }


def finance_variance(actuals: DataFrame, forecasts: DataFrame, order: bool = True,
                     unit_from: str = "actual") -> DataFrame:
    """Layer 3: forecast vs actual per month x GL, with variance, % and flags.

    Full outer join on (year, month, GL code) so one-sided accounts stay.
    Ratios are NULL when the forecast is 0. ``organization_group`` comes from
    the actual side (NULL on forecast-only rows), as in the original;
    ``unit_from="both"`` falls back to the forecast side.
    """
    a = actuals_by_gl(actuals).alias("a")
    f = forecasts_by_gl(forecasts).alias("f")
    joined = a.join(f, (F.col("a.date_year") == F.col("f.date_year"))
                    & (F.col("a.date_month") == F.col("f.date_month"))
                    & (F.col("a.gl_code") == F.col("f.gl_code")), "full")

    def both(name: str) -> Column:
        return F.coalesce(F.col(f"a.{name}"), F.col(f"f.{name}"))

    out_cols = [both(c).alias(c) for c in ("gl_code", "gl_description", "gl_type", "gl_type_label")]
    fc, ac = {}, {}
    for m in ("revenue", "costs", "profit"):
        fc[m] = F.coalesce(F.col(f"f.forecast_{m}"), F.lit(0))
        ac[m] = F.coalesce(F.col(f"a.actual_{m}"), F.lit(0))
    out_cols += [round_money(fc[m]).alias(f"forecast_{m}") for m in fc]
    out_cols += [round_money(ac[m]).alias(f"actual_{m}") for m in ac]
    bundles = {m: variance_columns(fc[m], ac[m], m) for m in fc}
    for kind in ("variance_{}", "variance_{}_pct", "achievement_{}_pct"):
        out_cols += [bundles[m][kind.format(m)].alias(kind.format(m)) for m in fc]
    day = both("date_date")
    out_cols += [
        (F.col("a.actual_revenue").isNotNull() | F.col("a.actual_costs").isNotNull()).alias("has_actuals"),
        (F.col("f.forecast_revenue").isNotNull() | F.col("f.forecast_costs").isNotNull()).alias("has_forecast"),
        day.alias("date_date"),
        both("date_year").cast("bigint").alias("date_year"),
        both("date_month").cast("bigint").alias("date_month"),
        F.quarter(day).cast("bigint").alias("date_quarter"),
        F.weekofyear(day).cast("bigint").alias("date_week"),
        F.lit(1).cast("bigint").alias("date_day"),
        (both("organization_group") if unit_from == "both" else F.col("a.organization_group"))
        .alias("organization_group"),
    ]
    out = joined.select(*out_cols)
    if order:
        out = display_order(out, [F.desc_nulls_last("date_year"), F.desc_nulls_last("date_month"),
                                  F.asc_nulls_first("gl_type_label"), F.asc_nulls_first("gl_code")],
                            ties=[c for c in out.columns if c not in ("date_year", "date_month", "gl_type_label", "gl_code")],
                            spread=["gl_code", "date_year", "date_month"])
    return out
