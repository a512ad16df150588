"""Scalar column functions (all JVM-side built-ins)."""

from retail_pulse.functions.jsonparse import parse_json_column, parse_records, split_quarantine, to_json_messages
from retail_pulse.functions.mask import mask_phone
from retail_pulse.functions.text import analyze, bm25_idf, bm25_term, term_freq, tokens
from retail_pulse.functions.time import (create_date, create_hour, log_date, log_hour, minute_of,
                                         ms_to_timestamp, on_days, previous_day, to_millis,
                                         with_log_date_hour)

__all__ = [
    "parse_json_column", "parse_records", "split_quarantine", "to_json_messages", "mask_phone",
    "analyze", "bm25_idf", "bm25_term", "term_freq", "tokens", "create_date", "create_hour",
    "log_date", "log_hour", "minute_of", "ms_to_timestamp", "on_days", "previous_day", "to_millis",
    "with_log_date_hour",
]
