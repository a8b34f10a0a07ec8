"""Column functions."""

from trunkline.functions.keys import (
    area_code,
    br_timestamp,
    cn_bucket,
    code_to_int,
    decode_missing,
    decode_missing_all,
    flag_to_int,
    parse_reference_date,
    query_keys,
    reference_date,
)
from trunkline.functions.normalize import (
    classify_call,
    clean_number,
    normalize_number,
    normalize_number_pair,
    strip_call_prefix,
)

__all__ = [
    "area_code",
    "br_timestamp",
    "classify_call",
    "clean_number",
    "cn_bucket",
    "code_to_int",
    "decode_missing",
    "decode_missing_all",
    "flag_to_int",
    "normalize_number",
    "normalize_number_pair",
    "parse_reference_date",
    "query_keys",
    "reference_date",
    "strip_call_prefix",
]
