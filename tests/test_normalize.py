"""Number normalisation: cases by reading the rules, and a brute-force search."""

import random
import re
import string

import pytest
from pyspark.sql import functions as F

from trunkline.functions import numbering_rules as rules
from trunkline.functions.normalize import (
    classify_call,
    clean_number,
    normalize_number,
    normalize_number_pair,
    strip_call_prefix,
)

#: One mobile number of another area, as people write it.
_AREA, _LEAD, _REST = "47", "98415", "2063"
SPELLINGS = [
    f"{before}{_AREA}{after}{_LEAD}{dash}{_REST}"
    for before, after in (("", ""), ("(", ")"), ("0", ""), ("(0", ") "), ("+55", ""), ("+55 ", " "))
    for dash in ("", "-")
]

CASES = [(s, "", _AREA + _LEAD + _REST, True) for s in SPELLINGS] + [
    ("0800-123-4567", "", "8001234567", True),
    ("99999-9999", "11", "11999999999", True),
    ("3333-4444", "11", "1133334444", True),
    ("3333-4444", "", "33334444", True),
    ("99999999", "11", "99999999", False),
    ("190", "", "190", True),
    ("190", "11", "190", True),
    ("99999190", "", "190", True),
    ("9011999999999", "", "11999999999", True),
    ("909011999999999", "", "11999999999", True),
    ("015 11 99999-9999", "", "11999999999", True),
    ("11999999999;123", "", "11999999999", True),
    ("foo;bar", "", "oo", False),
    ("invalid", "", "invalid", False),
    ("55999998888", "", "55999998888", True),
    ("", "", "", False),
    (None, "11", None, False),
    ("901234567", "11", "901234567", False),
    ("7812-3456", "11", "1178123456", True),
    ("1178123456", "", "1178123456", True),
    ("2378123456", "", "2378123456", False),
    ("10312", "", "10312", True),
    ("1061", "", "1061", True),
    ("10614", "", "10614", False),
    ("55111358", "", "1358", True),
    ("911", "", "911", True),
    ("11999999999\n", "", "11999999999", True),
    ("11999999999\n\n", "", "11999999999\n\n", False),
    ("11999999999é", "", "11999999999é", False),
    ("\t11999999999", "", "11999999999", True),
]


def test_cases(spark):
    rows = [(i, n, c) for i, (n, c, _, _) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "i int, n string, c string")
    got = {
        r.i: (r.x.number, r.x.valid)
        for r in df.select("i", normalize_number("n", F.col("c")).alias("x")).collect()
    }
    for i, (n, c, number, valid) in enumerate(CASES):
        assert got[i] == (number, valid), (n, c)


def test_plain_string_is_the_area_code(spark):
    df = spark.createDataFrame([("3333-4444",), ("190",)], "n string")
    got = df.select(normalize_number("n", "85").alias("x")).select("x.*").collect()
    assert [tuple(r) for r in got] == [("8533334444", True), ("190", True)]


def test_whole_numbers(spark):
    df = spark.createDataFrame([(5511999999999,)], "n bigint")
    row = df.select(normalize_number("n").alias("x")).first().x
    assert (row.number, row.valid) == ("11999999999", True)


PAIRS = [
    ("1133334444", "22225555", "", ("1133334444", True, "1122225555", True)),
    ("11999999999", "88888888", "", ("11999999999", True, "88888888", False)),
    ("invalid", "33334444", "11", ("invalid", False, "33334444", True)),
    ("1133334444", "33334444", "21", ("1133334444", True, "2133334444", True)),
    ("33334444", "33335555", "21", ("33334444", True, "33335555", True)),
    ("0800 123 4567", "33334444", "", ("8001234567", True, "8033334444", True)),
    (None, "33334444", "11", (None, False, "33334444", True)),
    ("11999999999", None, None, ("11999999999", True, None, False)),
]


def test_pairs(spark):
    df = spark.createDataFrame(
        [(i, a, b, c) for i, (a, b, c, _) in enumerate(PAIRS)],
        "i int, a string, b string, c string",
    )
    pair = normalize_number_pair("a", "b", F.col("c")).alias("p")
    got = {r.i: tuple(r.p) for r in df.select("i", pair).collect()}
    for i, (a, b, c, expected) in enumerate(PAIRS):
        assert got[i] == expected, (a, b, c)


def test_classify(spark):
    rows = [
        ("11999999999", True, "1133334444", True, "LOCAL", "LOCAL"),
        ("11999999999", True, "21988888888", True, "INTERURBANA", "DDD"),
        ("11999999999", True, "190", True, "INDEFINIDO", "OUTROS"),
        ("11999999999", True, "x", False, "INVALIDO", "INVALIDO"),
        (None, False, None, False, "INVALIDO", "INVALIDO"),
    ]
    df = spark.createDataFrame(
        rows, "a string, va boolean, b string, vb boolean, k1 string, k2 string"
    )
    got = df.select(
        "k1",
        "k2",
        classify_call("a", "va", "b", "vb").alias("g1"),
        classify_call("a", "va", "b", "vb", "DDD", "OUTROS").alias("g2"),
    ).collect()
    assert all(r.k1 == r.g1 and r.k2 == r.g2 for r in got)


def test_clean_and_prefix(spark):
    kept = "0123456789\t\né١"
    df = spark.createDataFrame([(string.printable + kept,)], "t string")
    removed = set(string.ascii_letters + string.punctuation + " ")
    expected = "".join(ch for ch in string.printable + kept if ch not in removed)
    assert df.select(clean_number("t")).first()[0] == expected
    prefixes = {
        "9012": "12", "909012": "12", "90901290": "1290", "0012": "12", "012": "12",
        "00012": "012", "912": "912", "": "",
    }
    df = spark.createDataFrame(list(prefixes.items()), "t string, e string")
    assert all(r[0] == r[1] for r in df.select(strip_call_prefix("t"), "e").collect())


# --- brute force --------------------------------------------------------------------


def _is_full(text):
    if not re.fullmatch("[0-9]+", text):
        return False
    area, rest = text[:2], text[2:]
    if area in rules.AREA_CODES and len(rest) == 9 and rest[0] in rules.MOBILE_LEADS:
        return True
    if area in rules.AREA_CODES and len(rest) == 8 and rest[0] in rules.FIXED_LEADS:
        return True
    if len(text) == 10 and text[:3] in rules.NON_GEOGRAPHIC_CODES:
        return True
    return any(
        len(rest) == 8 and area in areas.split() and rest[:2] in leads.split()
        for areas, leads in rules.TRUNKED_LEADS_BY_AREA
    )


def _is_local(text):
    if not re.fullmatch("[0-9]+", text):
        return False
    return (
        text in rules.PUBLIC_UTILITY_CODES
        or (len(text) == 9 and text[0] in rules.MOBILE_LEADS)
        or (len(text) == 8 and text[0] in rules.FIXED_LEADS)
        or (len(text) == 8 and text[:2] in rules.LOCAL_TRUNKED_LEADS)
    )


def _brute(text):
    """Try every start in order, and the optional codes from most to least."""
    given = text.split(";")[0].replace("f", "")
    noise = string.ascii_letters + string.punctuation + " "
    clean = "".join(ch for ch in given if ch not in noise)
    for prefix in ("9090", "90", "00", "0"):
        if clean.startswith(prefix):
            clean = clean[len(prefix) :]
            break
    long = len(clean) >= rules.FULL_NUMBER_LENGTH
    codes = rules.CARRIER_SELECTION_CODES if long else rules.AREA_CODES
    fits = _is_full if long else _is_local
    body = clean[:-1] if clean.endswith("\n") else clean
    for start in range(len(body)):
        rest = body[start:]
        options = []
        if rest.startswith(rules.COUNTRY_CODE):
            if rest[2:4] in codes:
                options.append(rest[4:])
            options.append(rest[2:])
        if rest[:2] in codes:
            options.append(rest[2:])
        options.append(rest)
        for option in options:
            if fits(option):
                return option, True
    return given, False


def _random_texts(n, seed):
    rng = random.Random(seed)
    texts = []
    for _ in range(n):
        kind = rng.random()
        digits = "".join(rng.choice(string.digits) for _ in range(rng.randint(0, 17)))
        if kind < 0.35:
            parts = [
                rng.choice(["", "0", "00", "90", "9090", "x"]),
                rng.choice(["", "55"]),
                rng.choice(["", rng.choice(rules.CARRIER_SELECTION_CODES)]),
                rng.choice(["", rng.choice(rules.AREA_CODES)]),
                rng.choice(["9", "3", "78", "800", "300", ""]),
                digits[:8],
            ]
            text = "".join(parts)
        elif kind < 0.6:
            text = (
                rng.choice(["", "55", "9", "90", "0"])
                + rng.choice(["", rng.choice(rules.AREA_CODES)])
                + rng.choice(rules.PUBLIC_UTILITY_CODES)
            )
        else:
            text = digits
        if rng.random() < 0.3:
            at = rng.randint(0, len(text))
            text = text[:at] + rng.choice(" -()+f;\n\té٣\U0001f600A") + text[at:]
        texts.append(text)
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_brute_force(spark, seed):
    texts = _random_texts(6000, seed)
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select("t", normalize_number("t").alias("x")).collect()
    wrong = [(r.t, tuple(r.x), _brute(r.t)) for r in got if tuple(r.x) != _brute(r.t)]
    assert not wrong, wrong[:5]
    assert sum(r.x.valid for r in got) > 1000


def test_whole_long_text_is_searched(spark):
    text = "1" * 20000 + "11999999999"
    df = spark.createDataFrame([(text,)], "t string")
    row = df.select(normalize_number("t").alias("x")).first().x
    assert (row.number, row.valid) == ("11999999999", True)
