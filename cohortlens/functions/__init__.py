"""Column expressions (all JVM-side, codegen-friendly; no Python UDFs)."""

from cohortlens.functions.columns import (
    as_flag, rate, rounded, days_between, weekday, hour_of, epoch_seconds,
    hash_key, sms_status, overflow_label, decade_band,
)

__all__ = ["as_flag", "rate", "rounded", "days_between", "weekday", "hour_of",
           "epoch_seconds", "hash_key", "sms_status",
           "overflow_label", "decade_band"]
