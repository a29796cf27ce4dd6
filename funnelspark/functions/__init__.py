"""Expressions, as Spark SQL text.

Every function takes SQL expressions and returns one; use the result in `selectExpr`, `where`
or `F.expr`, or inside another. A funnel projection has well over a thousand operators. As text
it reaches the JVM in one call; as a chain of Column calls it costs several calls per operator,
which is seconds of driver time per job.
"""

from funnelspark.functions.chains import (
    ATTRIBUTION,
    INSTALL,
    LATEST_FIRST,
    ORIGIN_FIRST,
    REENGAGEMENT,
    first_chain,
    first_country,
)
from funnelspark.functions.numbers import (
    cap,
    clamp_or_zero,
    finite_or_null,
    ieee_div,
    is_special,
    micros,
    norm_likelihood,
    per_impression,
)
from funnelspark.functions.recode import (
    COUNTRIES,
    EXCHANGES,
    REVENUE_MODELS,
    ad_format,
    ad_format_group,
    country_group,
    exchange_group,
    is_revenue_model,
    keep_or_other,
    model_type,
    name_or_na,
    tracker_type,
    viewthrough_enabled,
    vio_enrolled,
)
from funnelspark.functions.text import quoted, quoted_list
from funnelspark.functions.times import (
    day_plus,
    day_range,
    hour_ms,
    hour_plus,
    hour_range,
    in_cohort,
    iso_day,
    iso_hour,
    iso_text,
)

__all__ = [
    "ATTRIBUTION",
    "COUNTRIES",
    "EXCHANGES",
    "INSTALL",
    "LATEST_FIRST",
    "ORIGIN_FIRST",
    "REENGAGEMENT",
    "REVENUE_MODELS",
    "ad_format",
    "ad_format_group",
    "cap",
    "clamp_or_zero",
    "country_group",
    "day_plus",
    "day_range",
    "exchange_group",
    "finite_or_null",
    "first_chain",
    "first_country",
    "hour_ms",
    "hour_plus",
    "hour_range",
    "ieee_div",
    "in_cohort",
    "is_revenue_model",
    "is_special",
    "iso_day",
    "iso_hour",
    "iso_text",
    "keep_or_other",
    "micros",
    "model_type",
    "name_or_na",
    "norm_likelihood",
    "per_impression",
    "quoted",
    "quoted_list",
    "tracker_type",
    "viewthrough_enabled",
    "vio_enrolled",
]
