"""Typing and key expressions shared by the loaders and the carrier queries."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trunkline.functions.normalize import ColumnOrName, as_column

# The text marks that a delimited file uses for "no value".
MISSING_MARKS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# Accepted spellings of a reference date.
REFERENCE_DATE_FORMATS = ["%Y-%m-%d", "%d/%m/%Y", "%Y%m%d"]

# Area-code ranges that partition the portability history.
AREA_CODE_RANGES = [(11, 11), (12, 20), (21, 40), (41, 70), (71, 99)]

# Code and name of a carrier that a file does not identify.
UNKNOWN_CARRIER = -1
UNKNOWN_CARRIER_NAME = "NÃO IDENTIFICADO"


def decode_missing(c: ColumnOrName) -> Column:
    """NULL for the text marks of a missing value."""
    c = as_column(c)
    return F.when(~c.isin(MISSING_MARKS), c)


def decode_missing_all(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: decode_missing(c) for c in columns})


def flag_to_int(c: ColumnOrName) -> Column:
    """``Sim`` → 1, ``Nao`` → 0, anything else NULL."""
    c = as_column(c)
    return F.when(c == "Sim", 1).when(c == "Nao", 0)


def code_to_int(c: ColumnOrName) -> Column:
    """Carrier code text to integer; NULL where the text is not a number."""
    return as_column(c).try_cast("int")


def br_timestamp(c: ColumnOrName) -> Column:
    """``dd/MM/yyyy HH:mm:ss`` text to a timestamp without time zone, else NULL."""
    c = as_column(c)
    # Any other text becomes separators only, which no cast accepts.
    pattern = r"(?s)^(?:(\d{1,2})/(\d{1,2})/(\d{4}) (\d{1,2}):(\d{1,2}):(\d{1,2})\z|.*)"
    iso = F.regexp_replace(c, pattern, "$3-$2-$1 $4:$5:$6")
    return iso.try_cast("timestamp_ntz")


def area_code(number: ColumnOrName) -> Column:
    """First two digits of a number."""
    return F.substring(as_column(number).cast("string"), 1, 2).try_cast("int")


def cn_bucket(cn: ColumnOrName) -> Column:
    """Name of the history partition that holds an area code."""
    cn = as_column(cn)
    names = [
        F.when(
            cn.between(low, high),
            f"cn_{low}" if low == high else f"cn_{low}_{high}",
        )
        for low, high in AREA_CODE_RANGES
    ]
    return F.coalesce(*names, F.lit("cn_default"))


def query_keys(number: ColumnOrName, whole: bool = False) -> tuple[Column, Column, Column]:
    """``(nu_terminal, cn, prefixo)`` of a number to look up.

    Numbers of 10 and 11 digits as written have an area code, the first two, and a
    prefix, the next four or five. Any other length has the keys -1. ``whole`` says
    that the column is a whole number, not text, so that its size decides.
    """
    if whole:
        nu = as_column(number).cast("bigint")
        ten = nu.between(10**9, 10**10 - 1)
        eleven = nu.between(10**10, 10**11 - 1)
    else:
        text = as_column(number).cast("string")
        nu = text.try_cast("bigint")
        ten, eleven = F.length(text) == 10, F.length(text) == 11
    block = nu / 10_000
    cn = F.when(ten, nu / 10**8).when(eleven, nu / 10**9).otherwise(-1)
    prefix = F.when(ten, block % 10**4).when(eleven, block % 10**5).otherwise(-1)
    return (
        nu.alias("nu_terminal"),
        cn.cast("int").alias("cn"),
        prefix.cast("int").alias("prefixo"),
    )


def parse_reference_date(value: date | str | None = None) -> date:
    """A reference date given as a date, as text in a known format, or as today."""
    if value is None:
        return date.today()
    if isinstance(value, datetime):
        return value.date()
    if isinstance(value, date):
        return value
    if not isinstance(value, str):
        raise TypeError("reference date must be a date or a string")
    for fmt in REFERENCE_DATE_FORMATS:
        try:
            return datetime.strptime(value, fmt).date()
        except ValueError:
            pass
    raise ValueError(f"invalid date format: {value}")


def reference_date(c: ColumnOrName) -> Column:
    """The same date formats for a text column; NULL where none fits."""
    c = as_column(c)
    day = r"(3[01]|[12]\d|0[1-9]|[1-9])"
    month = r"(1[0-2]|0[1-9]|[1-9])"
    iso = F.when(c.rlike(rf"^\d{{4}}-{month}-{day}$"), c)
    brazilian = rf"^{day}/{month}/(\d{{4}})$"
    compact = rf"^(\d{{4}}){month}{day}$"
    return F.coalesce(
        iso,
        F.when(c.rlike(brazilian), F.regexp_replace(c, brazilian, "$3-$2-$1")),
        F.when(c.rlike(compact), F.regexp_replace(c, compact, "$1-$2-$3")),
    ).try_cast("date")
