"""Licence recognition by sentences and rules, in native functions.

A text is cut into normalised fragments at line feeds and sentence ends. A run of fragments
that makes a known licence sentence gives its identifier, so notices may be wrapped and stand
in comments. The identifiers of a document, in order, are then matched against rules:
ordered lists of sentences that together state a licence. Other sentences may stand between.
Sentences and rules are small fixed tables and travel inside the plan, so the scan needs no
join and no shuffle, and a document's size is its only bound.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trunkline.llm.common import table

# Sentences of public licence notices, normalised, by identifier.
SENTENCES = {
    "apache-2.0-ref": "licensed under the apache license version 2 0",
    "apache-2.0-head": "licensed under the apache license version 2 0 the license",
    "apache-2.0-use": "you may not use this file except in compliance with the license",
    "apache-2.0-copy": "you may obtain a copy of the license at http www apache org licenses license 2 0",
    "apache-2.0-law": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "apache-2.0-see": "see the license for the specific language governing permissions and limitations under the license",
    "mit-ref": "released under the mit license",
    "mit-ref-2": "licensed under the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit-notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mit-as-is": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "gpl-3.0-ref": "this work is licensed under the gnu general public license version 3",
    "gpl-2.0-ref": "this work is licensed under the gnu general public license version 2",
    "gpl-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl-free-2": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "gpl-hope": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "gpl-details": "see the gnu general public license for more details",
    "cc-by-nc-4.0-ref": "licensed under cc by nc 4 0",
    "cc-by-4.0-ref": "licensed under cc by 4 0",
    "cc-by-sa-4.0-ref": "licensed under cc by sa 4 0",
    "cc-by-4.0-work": "this work is licensed under a creative commons attribution 4 0 international license",
    "cc-by-nc-4.0-work": "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
    "cc-by-sa-4.0-work": "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    "bsd-redistribution": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd-names": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "mpl-2.0-form": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "unlicense-free": "this is free and unencumbered software released into the public domain",
    "rights-reserved": "all rights reserved",
}

# Rules as (licence, identifiers in order).
RULES = [
    ("Apache-2.0", ["apache-2.0-ref"]),
    ("Apache-2.0", ["apache-2.0-head", "apache-2.0-use", "apache-2.0-copy", "apache-2.0-law", "apache-2.0-see"]),
    ("BSD-2-Clause", ["bsd-redistribution", "bsd-source", "bsd-binary"]),
    ("BSD-3-Clause", ["bsd-redistribution", "bsd-source", "bsd-binary", "bsd-names"]),
    ("CC-BY-4.0", ["cc-by-4.0-ref"]),
    ("CC-BY-4.0", ["cc-by-4.0-work"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-4.0-ref"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-4.0-work"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-4.0-ref"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-4.0-work"]),
    ("GPL-2.0", ["gpl-2.0-ref"]),
    ("GPL-2.0-or-later", ["gpl-free-2", "gpl-hope", "gpl-details"]),
    ("GPL-3.0", ["gpl-3.0-ref"]),
    ("GPL-3.0-or-later", ["gpl-free", "gpl-hope", "gpl-details"]),
    ("ISC", ["isc-grant"]),
    ("MIT", ["mit-grant", "mit-notice", "mit-as-is"]),
    ("MIT", ["mit-ref"]),
    ("MIT", ["mit-ref-2"]),
    ("MPL-2.0", ["mpl-2.0-form"]),
    ("Proprietary", ["rights-reserved"]),
    ("Unlicense", ["unlicense-free"]),
]


#: Known sentences over line feeds too, the longer ones first; a look-ahead, so hits may overlap.
_KNOWN = "\n(?=({})\n)".format(
    "|".join(s.replace(" ", "[ \n]") for s in sorted(SENTENCES.values(), key=len, reverse=True))
)


def fragments(text: Column) -> Column:
    """The text in lower case, letters and digits, single spaces, a line feed at each cut.

    A cut is a line feed, or ``. ! ? : ;`` before white space or the end; runs of cuts are
    one, and the text starts and ends with one. Words that lead comment lines are left out;
    other comment leaders hold no letter or digit.
    """
    lower = F.lower(F.coalesce(text, F.lit("")))
    bare = F.regexp_replace(lower, r"(?m)^(c|[^a-z0-9\n]*(dnl|rem))(?=[ \t])", " ")
    cut = F.regexp_replace(bare, r"[.!?:;]+(\s+|$)", "\n")
    plain = F.regexp_replace(cut, r"[^a-z0-9\n]+", " ")
    return F.regexp_replace(F.concat(F.lit("\n"), plain, F.lit("\n")), r" ?\n[ \n]*", "\n")


def known_sentences(text: Column) -> Column:
    """Identifiers of the known sentences, in order of their starts, the shorter one first.

    A known sentence starts after a cut and ends before one. Cuts inside do not count, so
    hard-wrapped lines are one sentence, as are the parts around a ``;``, an abbreviation
    or an address on a line of its own.
    """
    pairs = [F.lit(x) for name, sentence in SENTENCES.items() for x in (sentence, name)]
    known = F.create_map(*pairs)
    hits = F.regexp_extract_all(fragments(text), F.lit(_KNOWN), F.lit(1))

    def names(hit: Column) -> Column:
        """The hit and the known sentences that it starts with."""
        parts = F.split(hit, "\n")
        return F.transform(
            F.sequence(F.lit(1), F.size(parts)),
            lambda n: known[F.array_join(F.slice(parts, F.lit(1), n), " ")],
        )

    return F.filter(F.flatten(F.transform(hits, names)), lambda name: name.isNotNull())


def _matched(found: Column, rule: list[str]) -> Column:
    """Whether the rule's identifiers stand in order among the found ones."""
    steps = F.array(*map(F.lit, rule))
    done = F.aggregate(
        found,
        F.lit(0),
        lambda n, name: F.when(F.get(steps, n) == name, n + 1).otherwise(n),
    )
    return done == len(rule)


def license_scan(documents: DataFrame) -> DataFrame:
    """Licences that the texts of ``doc_id, text`` state.

    Returns doc_id, sentence_ids and licenses (arrays; sentences in order with repeats,
    licences sorted, each once), one row for each row given. Null and empty texts and texts
    without a known sentence have empty arrays. An empty table gives no rows; other columns
    are not read.
    """
    found = documents.select("doc_id", known_sentences(F.col("text")).alias("sentence_ids"))
    names = F.array(
        *[F.when(_matched(F.col("sentence_ids"), rule), F.lit(name)) for name, rule in RULES]
    )
    some = F.size("sentence_ids") > 0
    listed = F.when(some, F.array_sort(F.array_distinct(F.array_compact(names))))
    return found.select("doc_id", "sentence_ids", F.coalesce(listed, F.expr("cast(array() as array<string>)")).alias("licenses"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents")).select(
        "doc_id",
        F.size("sentence_ids").cast("bigint").alias("n_sentences"),
        F.array_join("sentence_ids", ",").alias("sentence_ids"),
        F.array_join("licenses", ",").alias("licenses"),
    )


def _sql() -> str:
    values = ",\n    ".join(f"('{s}', '{name}')" for name, s in SENTENCES.items())
    rules = ",\n    ".join(
        f"({i}, '{name}', ',{',(.*,)?'.join(x.replace('.', '[.]') for x in rule)},')"
        for i, (name, rule) in enumerate(RULES)
    )
    return rf"""
with known(sentence, name) as (values
    {values}),
rules(rule, license, pattern) as (values
    {rules}),
parts as (
  select doc_id, unnest(string_split(regexp_replace(regexp_replace(
           lower(coalesce(text, '')), '[.!?:;]+(\s+|$)', chr(10), 'g'),
           '[^a-z0-9\n]+', ' ', 'g'), chr(10))) as sentence,
         generate_subscripts(string_split(regexp_replace(regexp_replace(
           lower(coalesce(text, '')), '[.!?:;]+(\s+|$)', chr(10), 'g'),
           '[^a-z0-9\n]+', ' ', 'g'), chr(10)), 1) as place
  from documents),
hits as (
  select doc_id, count(*) as n_sentences, string_agg(name, ',' order by place) as sentence_ids
  from parts join known on trim(parts.sentence) = known.sentence group by doc_id),
stated as (
  select doc_id, string_agg(distinct license, ',' order by license) as licenses
  from hits, rules where regexp_matches(',' || sentence_ids || ',', pattern) group by doc_id)
select doc_id, coalesce(n_sentences, 0)::bigint as n_sentences,
       coalesce(sentence_ids, '') as sentence_ids, coalesce(licenses, '') as licenses
from documents left join hits using (doc_id) left join stated using (doc_id)
"""


#: Takes each fragment alone, so it agrees on texts whose known sentences hold no cut.
OP2_SQL = _sql()
