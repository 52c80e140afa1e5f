"""Imports every group of checks."""

from auricle_checks import (  # noqa: F401
    aggregate_checks,
    filter_checks,
    plan_checks,
    quality_checks,
    scalar_checks,
    source_checks,
    stream_checks,
    queue_checks,
    sync_checks,
    view_checks,
)
