"""Brazilian numbering rules as data, and the search patterns built from them.

The patterns are Java regular expressions for Spark's ``regexp_replace``, which
runs inside whole-stage code generation.
"""

from __future__ import annotations

from collections.abc import Iterable

# ---------------------------------------------------------------------------
# Fixed values (national numbering plan)
# ---------------------------------------------------------------------------

COUNTRY_CODE = "55"

#: Area codes in service.
AREA_CODES = """
11 12 13 14 15 16 17 18 19
21 22 24 27 28
31 32 33 34 35 37 38
41 42 43 44 45 46 47 48 49
51 53 54 55
61 62 63 64 65 66 67 68 69
71 73 74 75 77 79
81 82 83 84 85 86 87 88 89
91 92 93 94 95 96 97 98 99
""".split()

#: Codes a caller dials to select a long-distance carrier.
CARRIER_SELECTION_CODES = """
12 13 14 15 16 17 18
21 22 24 26 29
31 36 37 38 39
41 42 43 45 46 47 49
53 55 56 58
61 62 63 65
71 72 74 75 76
81 85 87
91 98
""".split()

#: First digits of non-geographic numbers (toll-free, shared cost), before 7 digits.
NON_GEOGRAPHIC_CODES = "300 303 500 800 900".split()

#: First digit of a mobile subscriber number, before 8 digits.
MOBILE_LEADS = ["9"]

#: First digits of a fixed subscriber number, before 7 digits.
FIXED_LEADS = ["2", "3", "4", "5"]

#: Trunked-radio subscriber numbers: area codes, then their leads before 6 digits.
TRUNKED_LEADS_BY_AREA = [
    ("11 12 13 14 15 16 17 18 19", "70 77 78 79"),
    ("21 22 24", "70 77 78"),
    ("27", "78"),
    ("31 34 37", "77 78"),
    ("41 42 43 44 47 48", "78"),
    ("51 54", "78"),
    ("61 62 65", "78"),
    ("71 73 75", "78"),
    ("81 85", "78"),
]

#: Trunked-radio leads dialled without an area code.
LOCAL_TRUNKED_LEADS = "70 77 78 79".split()

#: Public-utility codes.
PUBLIC_UTILITY_CODES = """
100 102 104 10312 10313 10314 10315 10317 10319 10321 10323 10324 10325 10326
10327 10328 10329 10331 10332 10334 10335 10336 10337 10338 10339 10341 10342
10343 10345 10347 10348 10351 10352 10353 10354 10356 10358 10361 10363 10369
10381 10384 10389 10391 10396 10398 1050 1051 1052 1053 1055 1056 1057 1058 1059
1060 1061 1062 1064 1066 1067 10610 10611 10612 10613 10615 10616 10617 10618
10620 10621 10624 10625 10630 10631 10633 10637 10644 10647 10648 10649 10650
10651 10652 10653 10655 10660 10661 10666 10671 10673 10677 10685 10686 10687
10688 10691 10693 10695 10699 111 112 115 116 117 118 121 123 125 127 128 129
130 132 134 135 136 138 1331 1332 1358 142 145 146 147 148 150 151 152 153 154
155 156 157 158 159 160 161 162 163 164 165 166 167 168 180 181 185 188 1746 190
191 192 193 194 195 196 197 198 199 911
""".split()

#: Call prefixes stripped once from the front: collect call, international, national.
CALL_PREFIX_PATTERN = "^(?:90(?:90)?|00|0)"

#: ASCII letters, punctuation and the space; every other character stays.
NOISE_PATTERN = "[ -/:-~]"

#: A number of this many characters or more is searched as a full number.
FULL_NUMBER_LENGTH = 10


# ---------------------------------------------------------------------------
# Patterns
# ---------------------------------------------------------------------------


def any_of(codes: Iterable[str]) -> str:
    """Pattern for any of the codes, common leading digits written once."""
    tails: dict[str, list[str]] = {}
    for code in codes:
        tails.setdefault(code[0], []).append(code[1:])
    single = [digit for digit, rest in tails.items() if rest == [""]]
    parts = [single[0] if len(single) == 1 else f"[{''.join(single)}]"] if single else []
    for digit, rest in tails.items():
        if rest != [""]:
            longer = any_of(r for r in rest if r)
            parts.append(digit + (f"(?:{longer})?" if "" in rest else longer))
    return parts[0] if len(parts) == 1 else f"(?:{'|'.join(parts)})"


def _digits(n: int) -> str:
    return f"[0-9]{{{n}}}"


def full_number_rules() -> str:
    """Full numbers: area code and subscriber, or a non-geographic number."""
    subscriber = [
        any_of(MOBILE_LEADS) + _digits(8),
        any_of(FIXED_LEADS) + _digits(7),
    ]
    services = [
        f"{any_of(AREA_CODES)}(?:{'|'.join(subscriber)})",
        any_of(NON_GEOGRAPHIC_CODES) + _digits(7),
    ]
    services += [
        any_of(areas.split()) + any_of(leads.split()) + _digits(6)
        for areas, leads in TRUNKED_LEADS_BY_AREA
    ]
    return "|".join(services)


def local_number_rules() -> str:
    """Numbers without an area code: local subscribers and public-utility codes."""
    services = [
        any_of(MOBILE_LEADS) + _digits(8),
        any_of(FIXED_LEADS) + _digits(7),
        any_of(LOCAL_TRUNKED_LEADS) + _digits(6),
        any_of(PUBLIC_UTILITY_CODES),
    ]
    return "|".join(services)


# A text ends here; one trailing line feed is tolerated and dropped.
_END = r"\n?\z"


def _search(optional: list[str], rules: str, sizes: str) -> str:
    """Earliest start of the optional codes and a number that ends the text.

    The look-ahead on the remaining size comes first, so the rules are tried at the
    two or three places only where a number can begin.
    """
    codes = "".join(f"{c}?" for c in optional)
    return f".*?{codes}(?=(?:{sizes}){_END})({rules}){_END}"


def subscriber_pattern() -> str:
    """One pattern for a whole cleaned text; its groups hold the number it ends with.

    After the call prefix, a long rest is searched for a full number (group 1) behind
    an optional country code and carrier-selection code, a short rest for a local
    number (group 2) behind an optional country code and area code. A text without a
    number matches too, with both groups empty, so that a replacement by the groups
    is the whole answer.
    """
    country = f"(?:{COUNTRY_CODE})"
    full = _search(
        [country, any_of(CARRIER_SELECTION_CODES)], full_number_rules(), "[0-9]{10,11}"
    )
    local = _search(
        [country, any_of(AREA_CODES)], local_number_rules(), "[0-9]{3,5}|[0-9]{8,9}"
    )
    long_rest = f".{{{FULL_NUMBER_LENGTH}}}"
    return (
        f"(?s){CALL_PREFIX_PATTERN}?+"
        f"(?:(?={long_rest}){full}|(?!{long_rest}){local})|^.*"
    )


SUBSCRIBER = subscriber_pattern()
