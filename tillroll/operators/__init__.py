from tillroll.operators.clean import classify_expr, clean_lines, product_lines, return_lines, type_mix  # noqa: F401
from tillroll.operators.customer import (  # noqa: F401
    cohort_table,
    customer_concentration,
    customer_id_coverage,
    customer_month_rank,
    customer_month_sales,
    customer_months,
    retention,
    retention_identified_calendar,
)
from tillroll.operators.kpi import (  # noqa: F401
    active_days,
    invoice_months,
    kpi_with_prev,
    mom_variance,
    month_facts,
    monthly_kpis,
    product_month_core,
    return_month,
    sku_concentration,
    sku_hhi,
    sku_month,
    sku_month_rank,
    topn_coverage,
)
from tillroll.operators.ranking import rank_all, rank_by_value, top_by_value, top_n  # noqa: F401
from tillroll.operators.report import (  # noqa: F401
    customer_health_monthly,
    dim_month,
    kpi_series_long,
    latest_full_month,
    latest_stable_retention,
    partial_month_notice,
    report_snapshot,
    return_watchlist,
)
from tillroll.operators.returns import return_sku_month, top_return_skus  # noqa: F401

# Names the original pandas job used, for code that calls them directly.
clean_data = clean_lines
build_customer_health_monthly = customer_health_monthly
build_dim_month = dim_month
