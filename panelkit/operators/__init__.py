"""DataFrame operators; every one takes column names and returns a lazy DataFrame."""

from panelkit.operators.allocation import prorate_by_year, rejected_periods
from panelkit.operators.cleaning import (
    coalesce_columns,
    conform,
    date_parts,
    explode_years,
    fill_nulls,
    latest_by,
    latest_value,
    null_if_cast,
    one_per_key,
    require_not_null,
    tag,
    unparsed_periods,
)
from panelkit.operators.flows import flow_balance, route_matrix
from panelkit.operators.indicators import (
    any_flag,
    appeal_funding,
    at_max_level,
    category_features,
    minmax_score,
    needs_metrics,
    peak_by,
    response_gaps,
    risk_profile,
)
from panelkit.operators.panels import (
    averages_panel,
    densify,
    enrich,
    outer_panel,
    semi_filter,
    sum_with_labels,
    union_distinct,
)
from panelkit.operators.reports import (
    classification_report,
    confusion,
    coverage_report,
    distribution,
    macro_f1,
    quality_report,
    summarise,
    top,
)
from panelkit.operators.series import lag_value, lead_value, moving_avg, naive_projection, yoy_growth
from panelkit.operators.trend import backtest, fit_ols, fit_quality, long_form, trend_forecast

__all__ = [name for name in dir() if not name.startswith("_")]
