"""Pages, licences, benchmark items and toxicity."""

import math
import re

import brute
import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from trunkline.llm import decontamination, html_text, licenses, toxicity
from trunkline.llm import text as tx

PAGES = {
    "plain": ("<html><head><title>T</title></head><body><p>First block.</p><p>Second &amp; last.</p></body></html>",
              "First block. Second & last."),
    "article": (
        "<body><nav><a href='/'>Home</a></nav><header>Site name</header><article><h1>Title</h1>"
        "<p>Some text that goes on for a while, with a <b>bold</b> word.</p><p>The.</p></article>"
        "<aside>Related stories</aside><footer>&copy; 2020</footer></body>",
        "Title Some text that goes on for a while, with a bold word. The.",
    ),
    "named": (
        "<div id='sidebar'><p>Popular posts of this week are listed here.</p></div>"
        "<div class='content'><p>The article's own paragraph, which is long enough.</p></div>"
        "<div class='cookie-notice'>We use cookies on this site to serve you better.</div>"
        "<section id=comments><p>Great article, I have read it twice already.</p></section>"
        "<form><label>Name</label><input><button>Send</button></form>",
        "The article's own paragraph, which is long enough.",
    ),
    "scripts": ("<script>var a = '<p>no</p>';</script><style>p{}</style><!-- <p>no</p> --><article><p>Yes,\n\n really.</p>",
                "Yes, really."),
    "broken": ("<article><p>Open <b>bold<br>next<p>Second</article", "Open bold next Second"),
    "advert in article": ("<article><p>One is the first.</p><div class='ad'>Buy now.</div><p>Two is the second.</p></article>",
                          "One is the first. Two is the second."),
    "empty": ("", ""),
    "only markup": ("<html><body></body></html>", ""),
    "null": (None, ""),
    "bare less-than": ("<article><p>1 < 2 and 3 > 2 here.</p></article>", "1 < 2 and 3 > 2 here."),
}


def test_pages(spark):
    data = [(i, n, html, None, None) for i, (n, (html, _)) in enumerate(PAGES.items())]
    data.append((None, None, PAGES["plain"][0], None, None))
    data += data[:1]
    df = spark.createDataFrame(data, "page_id bigint, url string, html string, text string, n_kept string")
    found = html_text.extract_text(df).collect()
    assert len(found) == len(data)
    got = {r.url: r.text for r in found}
    assert {n: got[n] for n in PAGES} == {n: text for n, (_, text) in PAGES.items()}
    assert html_text.extract_text(df.limit(0)).count() == 0


STORY = (
    "<h1>Title</h1><p>The first paragraph of the story is a sentence.</p>{}"
    "<p>The last paragraph of the story is a sentence too.</p>"
)
STORY_TEXT = "Title The first paragraph of the story is a sentence.{} The last paragraph of the story is a sentence too."


@pytest.mark.parametrize(
    "wrapper",
    [
        "<div class='content-sidebar-wrap'>", "<div class='has-sidebar'>", "<div class='no-sidebar'>",
        "<div class='page layout-no-sidebar menu-open'>", "<form id='aspnetForm' method=post>",
        "<form><div class='nav-wrapper'>", "<div id='header'>", "<div class=sidebar>",
        "<div id='social'><div class='search'>", "<div id='comments-wrap'>", "<div class='widget-area'><fieldset>", "<header>",
    ],
)
@pytest.mark.parametrize("inner", ["article", "main", "div"])
def test_wrappers_keep_the_article(wrapper, inner):
    if "comments" in wrapper and inner == "div":
        return
    page = (
        "<body><nav><a href='/'>Home</a></nav>{}<{}>{}</{}><div class='ad'>Buy now.</div>"
        "<aside>Other stories</aside><footer>Imprint</footer></body>"
    )
    assert html_text.main_text(page.format(wrapper, inner, STORY.format(""), inner))[0] == STORY_TEXT.format("")


@pytest.mark.parametrize(
    "slug",
    "discussion related-work privacy legal notice search social print comments cookies-and-law".split(),
)
def test_slugs_in_an_article_keep_their_text(slug):
    for part in (
        f"<section id='{slug}'><h2>Heading</h2><p>Short text.</p></section>",
        f"<h2 id='{slug}'>Heading</h2><p>Short text.</p>",
        f"<div class='section' id='{slug}'><h2 id='{slug}'>Heading</h2><p>Short text.</p></div>",
    ):
        page = f"<article>{STORY.format(part)}</article>"
        assert html_text.main_text(page)[0] == STORY_TEXT.format(" Heading Short text.")


def test_short_page_without_an_article():
    page = "<body><nav><a href='/'>Home</a></nav>{}<footer>Imprint</footer></body>"
    blocks = "<div>A short text.</div><div>And one more</div>"
    assert html_text.main_text(page.format(blocks))[0] == "A short text. And one more"
    assert html_text.main_text(page.format(""))[0] == ""
    assert html_text.main_text(page.format("<div class=cookies>We use cookies.</div>"))[0] == ""


@pytest.mark.parametrize("name", ["site-notice-v2", "cookie-bar-2024", "cookie-notice-v10", "adSlot-300x250"])
def test_names_with_versions(name):
    notice = f"<div class='{name}'>We use cookies on this site to serve you better.</div>"
    page = f"<body>{notice}<article>{STORY.format('')}</article></body>"
    assert html_text.main_text(page)[0] == STORY_TEXT.format("")


def test_parts_of_an_article():
    text = "Words of others that go on for quite a while, so that they look like prose of the page."
    for part in (
        f"<div class='comments'><p>{text}</p><p>{text}</p></div>", f"<div class='ad-slot'><p>{text}</p></div>",
        f"<section class='related-posts'><p>{text}</p></section>", f"<div class=share-buttons>{text}</div>",
        f"<div id='comments'><article><p>{text}</p></article></div>", f"<aside><article><p>{text}</p></article></aside>",
        f"<div hidden><article><p>{text}</p></article></div>", "<div class=sidebar><article><p>Teaser.</p></article></div>",
    ):
        assert html_text.main_text(f"<article>{STORY.format(part)}</article>")[0] == STORY_TEXT.format("")
    for part in (f"<div class=privacy><p>{text}</p></div>", f"<div id=legal>{text}</div>"):
        assert html_text.main_text(f"<article>{STORY.format(part)}</article>")[0] == STORY_TEXT.format(" " + text)
    head = "<header class='entry-header'><h2>Heading</h2></header>"
    assert html_text.main_text(f"<article>{head}{STORY.format('')}</article>")[0] == "Heading " + STORY_TEXT.format("")


def test_long_page():
    source = "<article>" + "<p>Word after word.</p>" * 20_000 + "</article>" + "<" * 5_000
    text, kept, blocks = html_text.main_text(source)
    assert kept >= 20_000 and text.startswith("Word after word. Word")


def test_minimum_cut_is_minimal():
    import itertools
    import random

    rng = random.Random(4)
    for _ in range(200):
        n = rng.randint(1, 7)
        costs = [rng.uniform(-2, 2) for _ in range(n)]
        edges = [{} for _ in range(n)]
        for i, j in itertools.combinations(range(n), 2):
            if rng.random() < 0.5:
                edges[i][j] = edges[j][i] = rng.uniform(0, 2)

        def value(side, costs=costs, edges=edges, n=n):
            cut = sum(edges[i][j] for i in range(n) for j in edges[i] if i < j and side[i] != side[j])
            return cut + sum(c for c, s in zip(costs, side, strict=True) if c > 0 and not s) - sum(
                c for c, s in zip(costs, side, strict=True) if c < 0 and s
            )

        best = min(value(s) for s in itertools.product([True, False], repeat=n))
        assert value(html_text.minimum_cut(costs, edges)) == pytest.approx(best)


def test_given_pages_keep_their_article(spark, sf_dir):
    import html
    import re

    df = spark.read.parquet(f"{sf_dir}/pages.parquet")
    sources = {r.page_id: r.html for r in df.collect()}
    for row in html_text.extract_text(df).collect():
        body = re.search(r"<article>(.*?)(?:</article>|<footer>|$)", sources[row.page_id], re.S)[1]
        blocks = re.split(r"</?(?:p|h1)>|<br>", re.sub(r"</?b>", "", body))
        expected = " ".join(x for x in (" ".join(html.unescape(b).split()) for b in blocks) if x)
        assert row.text == expected


GPL = licenses.SENTENCES
NOTICES = [
    ("Released under the MIT License.", "mit-ref", "MIT"),
    ("x. LICENSED under the Apache License,   Version 2.0!", "apache-2.0-ref", "Apache-2.0"),
    ("\n".join(GPL[s] for s in ("gpl-free", "gpl-hope", "gpl-details")), "gpl-free,gpl-hope,gpl-details", "GPL-3.0-or-later"),
    ("\n".join(GPL[s] for s in ("gpl-hope", "gpl-free", "gpl-details")), "gpl-hope,gpl-free,gpl-details", ""),
    ("\n\n".join(GPL[s] + ".\nother words" for s in ("bsd-redistribution", "bsd-source", "bsd-binary", "bsd-names")),
     "bsd-redistribution,bsd-source,bsd-binary,bsd-names", "BSD-2-Clause,BSD-3-Clause"),
    ("Not released under the MIT License.", "", ""),
    ("", "", ""),
    (None, "", ""),
]


def test_licenses(spark, edge, empty):
    data = [(i, t, None) for i, (t, _, _) in enumerate(NOTICES)] + [(None, NOTICES[0][0], None)] * 2
    df = spark.createDataFrame(data, "doc_id bigint, text string, licenses string")
    found = licenses.license_scan(df)
    got = {r.doc_id: (",".join(r.sentence_ids), ",".join(r.licenses)) for r in found.collect()}
    assert got == {i: (s, n) for i, (_, s, n) in enumerate(NOTICES)} | {None: NOTICES[0][1:]}
    assert found.count() == len(data)
    assert licenses.license_scan(edge).count() == edge.count()
    assert licenses.license_scan(empty).count() == 0
    plan = found._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "Python" not in plan


APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""
GPL_WRAPPED = """This program is free software{} you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation{} either version {} of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details."""
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM."""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies."""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/."""
PUBLISHED = [
    (APACHE, "Apache-2.0"),
    (GPL_WRAPPED.format(":", ",", 3), "GPL-3.0-or-later"),
    (GPL_WRAPPED.format(";", ";", 2), "GPL-2.0-or-later"),
    (MIT, "MIT"),
    (BSD, "BSD-2-Clause,BSD-3-Clause"),
    (ISC, "ISC"),
    (MPL, "MPL-2.0"),
]
LEADERS = ["", " * ", "# ", "// ", "-- ", ";; ", "dnl ", "REM ", "C     ", "  "]


def test_published_licenses(spark):
    data = [
        (leader + text.replace("\n", end + leader), name)
        for text, name in PUBLISHED for leader in LEADERS for end in ("\n", "\r\n")
    ]
    data.append(("Licensed under the Apache License, Version 2.0\n(the \"License\");", "Apache-2.0"))
    # A sentence of other words around a known one is none.
    data.append((APACHE.replace("You may obtain", "Perhaps you may obtain"), ""))
    data.append((MPL.replace("This Source", "Not this Source"), ""))
    rows = [(i, text) for i, (text, _) in enumerate(data)]
    found = licenses.license_scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r.doc_id: ",".join(r.licenses) for r in found} == {i: name for i, (_, name) in enumerate(data)}


def test_license_statement_on_notices(spark):
    con = duckdb.connect()
    con.execute("create table documents(doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", [(i, t) for i, (t, _, _) in enumerate(NOTICES)])
    got = {r[0]: (r[2], r[3]) for r in con.execute(licenses.OP2_SQL).fetchall()}
    assert got == {i: (s, n) for i, (_, s, n) in enumerate(NOTICES)}


def hit_rows(found):
    ids = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    n_hit = decontamination.span_words()
    return [
        tuple(r)
        for r in found.select(
            "doc_id", "n_words", n_hit, F.size("items"), F.sha2(ids, 256), n_hit > 0
        ).collect()
    ]


@pytest.fixture(scope="module")
def items(edge_rows):
    texts = dict((d, t) for d, t in edge_rows if d is not None)
    words = texts[3].split()
    return [
        (1, " ".join(words[20:45])),
        (2, " ".join(words[30:40]) + " other words that no document has in this order"),
        (3, "one two three"),
        (4, "ONE"),
        (5, None),
        (6, " ,.- "),
        (7, texts[15].replace("\n", " ")[200:500]),
        (10, " ".join(words[20:45])),
        (10, "three four"),
        (None, " ".join(words[50:62])),
        (11, "a" * 3000),
    ]


@pytest.mark.parametrize("words", [10**6, 60])
def test_contamination(spark, edge, edge_rows, items, words):
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    found = decontamination.contamination(edge, benchmark, automaton_words=words)
    assert brute.same_rows(hit_rows(found), brute.contamination_rows(edge_rows, items))


def test_contamination_of_empty_tables(spark, edge, edge_rows, empty, items):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert brute.same_rows(hit_rows(decontamination.contamination(edge, none)), brute.contamination_rows(edge_rows, []))
    some = spark.createDataFrame(items, "item_id bigint, text string")
    assert decontamination.contamination(empty, some).count() == 0


def clean_words(text, items, window=10):
    """The words that stay when windows are cut until none is left, and how many go."""
    left = brute.ALNUM_WORD.findall(brute.lower(text))
    windows = set()
    for _, item in items:
        w = brute.ALNUM_WORD.findall(brute.lower(item))
        size = min(window, len(w))
        windows |= {tuple(w[i : i + size]) for i in range(len(w) - size + 1) if w}
    total = len(left)
    while True:
        hit = set()
        for size in {len(w) for w in windows}:
            for i in range(len(left) - size + 1):
                if tuple(left[i : i + size]) in windows:
                    hit.update(range(i, i + size))
        if not hit:
            return left, total - len(left), total
        left = [w for i, w in enumerate(left) if i not in hit]


@pytest.mark.parametrize("words", [10**6, 60])
@pytest.mark.parametrize("coverage", [0.04, 0.5])
def test_cut_contamination(spark, words, coverage):
    item = " ".join(f"q{i}" for i in range(15))
    items = [(1, item), (2, "short item"), (3, None), (4, " ".join(f"z{i}" for i in range(200)))]
    clean = [f"Wörd{i}," for i in range(1000)]
    q = item.split()
    texts = [
        (1, " ".join(clean[:500] + q + clean[500:]) + ".\n"),
        (1, " ".join(clean)),
        (2, " ".join(clean[:10] + q)),
        (None, " ".join(clean[:10] + q)),
        (None, "Other text, " + " ".join(clean[:200]) + "; Short\nITEM. End"),
        (3, "short item"),
        (4, None),
        (5, ""),
        # Cutting the inner item makes an outer one.
        (6, " ".join(clean[:500] + q[:7] + ["short", "item"] + q[7:] + clean[500:])),
        (7, " ".join(q[:9] + clean[:100] + q[9:])),
        (8, " ".join(clean[:300] + [f"z{i}" for i in range(150, 165)] + clean[300:])),
    ]
    texts += texts[:1] + texts[2:3]
    df = spark.createDataFrame([(d, t, "x") for d, t in texts], "doc_id bigint, text string, spans string")
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    found = decontamination.cut_contamination(df, benchmark, coverage=coverage, automaton_words=words)
    assert found.columns == df.columns
    expected = []
    for doc, text in texts:
        left, n_cut, total = clean_words(text, items)
        if n_cut <= coverage * total:
            expected.append((doc, " ".join(left)))
    rows = [(r.doc_id, r.text) for r in found.collect()]
    got = [(d, " ".join(brute.ALNUM_WORD.findall(brute.lower(t)))) for d, t in rows]
    assert brute.same_rows(got, expected)
    assert {(1, " ".join(clean) + ".\n"), (1, " ".join(clean)), (4, None), (5, ""), (8, " ".join(clean))} <= set(rows)
    assert any(d == 6 for d, _ in rows)


def test_cut_contamination_of_empty_tables(spark, edge, empty, items):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert decontamination.cut_contamination(edge, none).count() == edge.count()
    some = spark.createDataFrame(items, "item_id bigint, text string")
    assert decontamination.cut_contamination(empty, some).count() == 0


def test_contamination_sample(spark, sample, sf_dir):
    df, docs = sample
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    items = [(r.item_id, r.text) for r in benchmark.collect()]
    rows = hit_rows(decontamination.contamination(df, benchmark))
    assert brute.same_rows(rows, brute.contamination_rows(docs, items))
    assert any(r[-1] for r in rows)


def made(spark, n):
    """Documents of five sentences; one bad word makes one toxic."""
    import random

    rng = random.Random(5)
    rows = []
    for i in range(n):
        words = [f"w{rng.randint(0, 300)}" for _ in range(40)]
        toxic = i % 4 == 0
        if toxic:
            words[rng.randrange(40)] = rng.choice(["zork", "grunk"])
        text = ". ".join(" ".join(words[k : k + 8]) for k in range(0, 40, 8))
        rows.append((i, text, int(toxic)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int").repartition(3)
    return df, rows


def test_toxicity_learns_sentences_from_documents(spark):
    df, rows = made(spark, 1500)
    found = {r.doc_id: r for r in toxicity.toxicity(df, df.select("doc_id", "toxic")).collect()}
    held = [r for r in rows if found[r[0]].held_out]
    assert 0.1 < len(held) / len(rows) < 0.3
    right = sum(found[d].predicted == t for d, _, t in held)
    assert right / len(held) > 0.95
    for d, text, t in held:
        if t and found[d].predicted:
            worst = text.split(". ")[found[d].worst_sentence]
            assert "zork" in worst or "grunk" in worst


def test_toxicity_labels_and_edges(spark, edge, empty, edge_rows):
    labels = spark.createDataFrame(
        [(1, 0), (1, 1), (2, None), (None, 1), (3, 0), (999, 1)], "doc_id bigint, toxic int"
    )
    found = toxicity.toxicity(edge, labels).collect()
    assert len(found) == len(edge_rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in found)
    none = labels.limit(0)
    scores = {r.score for r in toxicity.toxicity(edge, none).where("doc_id in (7, 8, 9)").collect()}
    assert all(s == pytest.approx(0.5) for s in scores)
    assert toxicity.toxicity(empty, labels).count() == 0
    import zlib

    assert all(
        r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found
    )


def test_toxicity_ignores_held_out_labels(spark):
    df, rows = made(spark, 300)
    labels = df.select("doc_id", "toxic")
    flipped = labels.withColumn(
        "toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic"))
    )
    a = {r.doc_id: r.score for r in toxicity.toxicity(df, labels).collect()}
    b = {r.doc_id: r.score for r in toxicity.toxicity(df, flipped).collect()}
    assert a == b


def plain_score(model, text):
    """Score and worst sentence of one text, word by word."""
    def features(word):
        data = np.frombuffer(word, np.uint8)
        sums = tx.byte_sums(data)
        def h(n):
            return tx.byte_hash(sums, np.array([0]), np.array([n]))
        out = [h(len(data))[0]]
        for size in toxicity._BEGINNINGS:
            out.append(tx.mix(h(min(size, len(data))) + np.uint64(size))[0])
        return [int(x) >> (64 - toxicity.FEATURE_BITS) for x in out]

    sentences = [brute.ALNUM_WORD.findall(s) for s in re.split(r"[\n!.?]", brute.lower(text))]
    sentences = [s for s in sentences if s] or [[]]
    weight = model.weight.astype(np.float32)
    z = [
        model.bias + sum(float(weight[f]) for w in s for f in features(w.encode())) for s in sentences
    ]
    score = 1 - math.prod(1 / (1 + math.exp(x)) for x in z)
    return score, z


def test_toxicity_scores_against_brute_force(spark, edge, edge_rows):
    df, _ = made(spark, 600)
    model = toxicity.fit_toxicity(df, df.select("doc_id", "toxic"))
    assert model.weight.any()
    some = [r for r in edge_rows if r[0] is not None and len(r[1] or "") < 5000]
    some += [(5000, "Bad zork here. Fine!\nfine? grunk zork"), (5001, "...!?"), (5002, "ok\n\nok")]
    named = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(some)], "doc_id bigint, text string")
    for r in toxicity.score_toxicity(named, model).collect():
        score, z = plain_score(model, some[r.doc_id][1])
        assert abs(r.score - score) < 1e-4
        assert z[r.worst_sentence] >= max(z) - 1e-4
        assert abs(r.worst_score - 1 / (1 + math.exp(-max(z)))) < 1e-4


@pytest.mark.parametrize("words", [10**6, 6000])
def test_toxicity_sample_does_not_depend_on_the_order(spark, words):
    df, rows = made(spark, 400)
    labels = df.select("doc_id", "toxic")
    orders = [df.repartition(7), df.coalesce(1).orderBy(F.desc("doc_id")), df.repartition(2, "text")]
    models = [toxicity.fit_toxicity(d, labels, words=words) for d in orders]
    assert models[0].weight.any()
    for m in models[1:]:
        assert (m.weight == models[0].weight).all() and m.bias == models[0].bias
    # Repeated ids do not get past the bound of rows.
    copies = df.unionByName(df.withColumn("text", F.concat("text", F.lit(" again"))))
    toxicity.fit_toxicity(copies, labels, rows=50)


def test_toxic_rows_go_whatever_their_ids(spark, tmp_path):
    df, rows = made(spark, 600)
    df.select("doc_id", "toxic").write.parquet(str(tmp_path / "labels.parquet"))
    bad = next(t for _, t, x in rows if x)
    good = next(t for _, t, x in rows if not x)
    extra = spark.createDataFrame([(None, bad), (9000, bad), (9000, good)], "doc_id bigint, text string")
    docs = df.select("doc_id", "text").unionByName(extra)
    left = toxicity.toxicity_stage(spark, docs, str(tmp_path))
    found = [(r.doc_id, r.text) for r in left.where("doc_id is null or doc_id = 9000").collect()]
    assert found == [(9000, good)]
    spark.createDataFrame([], "doc_id bigint, toxic int").write.parquet(str(tmp_path / "n" / "labels.parquet"))
    assert toxicity.toxicity_stage(spark, docs, str(tmp_path / "n")).count() == docs.count()


@pytest.mark.parametrize("words", [5, 10**6])
def test_rows_that_share_an_id_are_judged_apart(spark, words):
    """Repeated and null ids, and an item whose id is -1, in one automaton and in several."""
    texts = {k: " ".join(f"{k}{i}" for i in range(15)) for k in "abc"}
    docs = [(1, texts["a"]), (1, texts["c"]), (None, texts["a"]), (None, texts["c"]), (2, texts["b"]),
            (2, texts["b"]), (3, None), (3, "")]
    items = [(-1, " ".join(texts["a"].split()[:12])), (None, texts["b"]), (7, texts["b"])]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    found = decontamination.contamination(df, benchmark, automaton_words=words).collect()
    got = sorted(
        ((r.doc_id, r.n_words, [tuple(s) for s in r.spans], list(r.items)) for r in found), key=str
    )
    expected = sorted(
        [(1, 15, [(0, 12)], [-1]), (1, 15, [], []), (None, 15, [(0, 12)], [-1]), (None, 15, [], []),
         (2, 15, [(0, 15)], [7]), (2, 15, [(0, 15)], [7]), (3, 0, [], []), (3, 0, [], [])],
        key=str,
    )
    assert got == expected
    kept = decontamination.cut_contamination(df, benchmark, automaton_words=words).collect()
    assert sorted(((r.doc_id, r.text) for r in kept), key=str) == sorted(
        [(1, texts["c"]), (None, texts["c"]), (3, None), (3, "")], key=str
    )


@pytest.mark.parametrize("once", [True, False])
def test_toxicity_fetches_only_what_can_have_a_weight(spark, monkeypatch, once):
    df, _ = made(spark, 1200)
    df = df if once else df.unionByName(df.withColumn("text", F.concat("text", F.lit(" more words"))))
    labels = df.select("doc_id", "toxic")
    fetched, fit = [], toxicity.NoisyOr.fit

    def noted(self, documents, y, *args):
        fetched.append(sum(len(features) for features, _ in documents))
        return fit(self, documents, y, *args)

    monkeypatch.setattr(toxicity.NoisyOr, "fit", noted)
    some = toxicity.fit_toxicity(df, labels)
    all_features = np.arange(1 << toxicity.FEATURE_BITS, dtype=np.int32)
    monkeypatch.setattr(toxicity, "_weighted_features", lambda chosen: all_features)
    whole = toxicity.fit_toxicity(df, labels)
    assert fetched[0] < fetched[1] / 3
    assert some.weight.any() and np.array_equal(some.weight, whole.weight) and some.bias == whole.bias
