from funnelspark.plans.bucket_tables import (
    daily_sketches_v1,
    daily_sketches_v2,
    prediction_bucket_v1,
    prediction_bucket_v2,
    stored_segments_v1,
    stored_segments_v2,
    train_segments_v1,
    train_segments_v2,
)
from funnelspark.plans.calibration import revenue_calibration
from funnelspark.plans.health import platform_health_v1, platform_health_v2
from funnelspark.plans.validation import bid_validation

__all__ = [
    "bid_validation",
    "daily_sketches_v1",
    "daily_sketches_v2",
    "platform_health_v1",
    "platform_health_v2",
    "prediction_bucket_v1",
    "prediction_bucket_v2",
    "revenue_calibration",
    "stored_segments_v1",
    "stored_segments_v2",
    "train_segments_v1",
    "train_segments_v2",
]
