"""Phone-number normalisation as native column expressions (no Python UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trunkline.functions.numbering_rules import (
    CALL_PREFIX_PATTERN,
    NOISE_PATTERN,
    SUBSCRIBER,
)

ColumnOrName = Column | str


def as_column(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def first_of_list(number: ColumnOrName) -> Column:
    """Text before the first ``;`` without the lower-case filler ``f``."""
    head = F.substring_index(as_column(number).cast("string"), ";", 1)
    return F.translate(head, "f", "")


def clean_number(text: ColumnOrName) -> Column:
    """Drop ASCII letters, punctuation and spaces."""
    return F.regexp_replace(as_column(text), NOISE_PATTERN, "")


def strip_call_prefix(digits: ColumnOrName) -> Column:
    """Drop one collect-call, international or national prefix."""
    return F.regexp_replace(as_column(digits), CALL_PREFIX_PATTERN, "")


def find_subscriber(cleaned: ColumnOrName) -> Column:
    """The number that the numbering rules see at the end of a cleaned text, else ``''``."""
    return F.regexp_replace(as_column(cleaned), SUBSCRIBER, "$1$2")


def _found(given: Column) -> Column:
    return F.coalesce(find_subscriber(clean_number(given)), F.lit(""))


def _code(national_destination_code: ColumnOrName) -> Column:
    """A plain string is the area code itself, a Column is read per row."""
    if isinstance(national_destination_code, str):
        return F.lit(national_destination_code)
    return F.coalesce(national_destination_code.cast("string"), F.lit(""))


def _valid(found: Column) -> Column:
    # Another test than in _number, so that the shared part is ``found`` itself and
    # code generation evaluates it once per row.
    return F.length(found) > 0


def _number(found: Column, given: Column, code: Column) -> Column:
    local = F.length(found).isin(8, 9)
    return F.when(found == "", given).otherwise(
        F.concat(F.when(local, code).otherwise(""), found)
    )


def _area_code_context(found: Column, code: Column) -> Column:
    """Area code that a calling number hands to the number it calls."""
    with_area = F.length(found).isin(10, 11)
    return F.when(
        with_area, F.when(code != "", code).otherwise(F.substring(found, 1, 2))
    ).otherwise("")


def normalize_number(
    subscriber_number: ColumnOrName, national_destination_code: ColumnOrName = ""
) -> Column:
    """``struct<number: string, valid: boolean>`` for one dialled number.

    ``national_destination_code`` is an area code (a plain string is taken as the
    code itself, a Column is read per row) put before local numbers of 8 or 9
    digits. An invalid number comes back as its first ``;``-part without fillers.
    A NULL number gives ``(NULL, false)``.
    """
    given = first_of_list(subscriber_number)
    found = _found(given)
    number = _number(found, given, _code(national_destination_code))
    return F.struct(number.alias("number"), _valid(found).alias("valid"))


def normalize_number_pair(
    number_a: ColumnOrName,
    number_b: ColumnOrName,
    national_destination_code: ColumnOrName = "",
) -> Column:
    """``struct<number_a, valid_a, number_b, valid_b>``: A's area code completes B.

    A given area code replaces that of A, but only if A is valid and has one.
    """
    given_a, given_b = first_of_list(number_a), first_of_list(number_b)
    found_a, found_b = _found(given_a), _found(given_b)
    context = _area_code_context(found_a, _code(national_destination_code))
    return F.struct(
        _number(found_a, given_a, F.lit("")).alias("number_a"),
        _valid(found_a).alias("valid_a"),
        _number(found_b, given_b, context).alias("number_b"),
        _valid(found_b).alias("valid_b"),
    )


def classify_call(
    number_a: ColumnOrName,
    valid_a: ColumnOrName,
    number_b: ColumnOrName,
    valid_b: ColumnOrName,
    long_distance: str = "INTERURBANA",
    undefined: str = "INDEFINIDO",
) -> Column:
    """Local or long-distance call, from a normalised pair.

    The second usual set of labels is ``long_distance="DDD", undefined="OUTROS"``.
    """
    a, b = as_column(number_a), as_column(number_b)
    both = as_column(valid_a) & as_column(valid_b)
    with_area = (F.length(a) >= 10) & (F.length(b) >= 10)
    same_area = F.substring(a, 1, 2) == F.substring(b, 1, 2)
    return (
        F.when(~F.coalesce(both, F.lit(False)), "INVALIDO")
        .when(with_area & same_area, "LOCAL")
        .when(with_area, long_distance)
        .otherwise(undefined)
    )
