"""Scalar functions and tokenizer hooks."""

from tidewater.functions.scalars import (
    base_name,
    batch_file_name,
    default_start,
    format_handle,
    is_iso_time,
    iso_time,
    json_record,
    json_record_length,
    json_scalar,
    listing_line,
    message_from_json,
    message_to_json,
    parse_iso,
    parse_target_list,
    present_fields,
    run_name,
    run_stem,
    strip_text,
    token_count_chars,
    token_count_local,
)
from tidewater.functions.tokens import (
    CharTokenizer,
    LocalTokenizer,
    PandasTokenizer,
    Tokenizer,
    tokenizer_from_name,
)

__all__ = [
    "base_name",
    "batch_file_name",
    "default_start",
    "format_handle",
    "is_iso_time",
    "iso_time",
    "json_record",
    "json_record_length",
    "json_scalar",
    "listing_line",
    "message_from_json",
    "message_to_json",
    "parse_iso",
    "parse_target_list",
    "present_fields",
    "run_name",
    "run_stem",
    "strip_text",
    "token_count_chars",
    "token_count_local",
    "CharTokenizer",
    "LocalTokenizer",
    "PandasTokenizer",
    "Tokenizer",
    "tokenizer_from_name",
]
