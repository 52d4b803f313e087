"""firmlens — company-register analytics on Spark.

Operators are ``DataFrame → DataFrame`` functions (column names are parameters), lazy unless
their documentation says that a job runs; pipelines compose them; sources and sinks read and write files, JSON pages, GeoJSON and
JDBC tables; ``streaming`` holds the incremental loads. The most used entry points:
"""

from .functions.geo import lambert93_defined, lambert93_to_wgs84
from .functions.scalars import (
    address_line,
    code_label,
    code_of,
    growth_pct,
    label_of,
    lenient_date,
    lenient_double,
    normalize_place,
    postal_or_null,
)
from .operators.aggregates import (
    count_distinct,
    count_distinct_by,
    distinct_keys,
    distinct_rows,
    log_histogram,
    mean_by,
    non_null_counts,
    pivot_wide,
    revenue_by_group,
    row_count,
    sum_by_keys,
    top_k_counts,
)
from .operators.filters import (
    drop_null_subset,
    filter_active,
    filter_in_list,
    filter_non_negative,
    filter_postal,
    filter_scope,
    incremental_filter,
)
from .operators.joins import (
    join_chain_left,
    join_inner_key,
    join_label_lookup,
    join_left_parent,
    labels_in_use,
    lookup_default,
    period_over_period,
    region_metric,
    semi_join_keys,
)
from .operators.project import json_flatten, project_fixed, project_present, project_reindex
from .operators.topk import history, preview, sorted_distinct, top_n
from .operators.windows import latest_per_key
from .plans.cleaning import (
    clean_establishments,
    clean_financials,
    clean_legal_units,
    monthly_staging,
    run_clean_pipeline,
)
from .plans.dashboard import (
    dashboard_mart,
    establishment_card,
    financial_history,
    sector_growth,
    sector_revenue_history,
    top_revenue_units,
    top_sectors,
)
from .plans.exploration import (
    active_by_region,
    mean_revenue_by_category,
    mean_revenue_top_labels,
    merge_ratio_records,
    region_table,
)
from .session import materialize, recommended_conf, shared_dir, working_folders
from .streaming.incremental import daily_incremental, incremental_batch, incremental_stream

__all__ = [name for name in dir() if not name.startswith("_")]
