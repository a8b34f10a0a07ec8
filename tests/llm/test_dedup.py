"""Exact, near and passage duplicates against brute force."""

import random
import re

import brute
import pytest
from pyspark.sql import functions as F

from trunkline.llm import common, exact_dedup, jaccard_join, repeats, substring_dedup, suffix_dedup


def rows(df, *columns):
    return [tuple(r) for r in df.selectExpr(*columns).collect()]


EXACT = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def test_exact_edge(edge, edge_rows):
    assert brute.same_rows(rows(exact_dedup.exact_groups(edge), *EXACT), brute.exact_rows(edge_rows))


def test_exact_collisions_are_told_apart_by_bytes(edge, edge_rows):
    found = exact_dedup.exact_groups(edge, key=lambda t: F.pmod(F.xxhash64(t), F.lit(3)))
    assert brute.same_rows(rows(found, *EXACT), brute.exact_rows(edge_rows))


def test_exact_shuffled_joins(edge, edge_rows, monkeypatch):
    monkeypatch.setattr(exact_dedup, "sized", lambda df, n: df)
    found = rows(exact_dedup.exact_groups(edge), *EXACT)
    assert brute.same_rows(found, brute.exact_rows(edge_rows))


def test_directory_doubles_until_no_bucket_is_overfull(spark):
    keys = spark.range(2000).select(F.xxhash64("id").alias("key"))
    pointers, deepest = exact_dedup.directory(keys, bucket_keys=100)
    found = pointers.collect()
    assert sum(r.n_keys for r in found) == 2000
    buckets = {}
    for r in found:
        name = (r.depth, r.prefix >> (deepest - r.depth))
        buckets[name] = buckets.get(name, 0) + r.n_keys
    assert max(buckets.values()) <= 100
    # Two thousand even keys ask for a depth of five at least; random ones for more in places.
    assert min(d for d, _ in buckets) >= 5


def test_exact_index_files_hold_ranges_of_keys(edge):
    _, index, _ = exact_dedup.build_index(edge)
    spans = (
        index.groupBy(F.input_file_name().alias("file"))
        .agg(F.min(F.struct("prefix", "key")).alias("lo"), F.max(F.struct("prefix", "key")).alias("hi"))
        .orderBy("lo").collect()
    )
    assert all(tuple(a.hi) < tuple(b.lo) for a, b in zip(spans, spans[1:], strict=False))


def test_exact_buckets_have_one_owner_each(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", "cast(id % 2500 as string) as text")
    _, index, pointers = exact_dedup.build_index(docs, bucket_keys=50)
    of_bucket = index.withColumn("file", F.input_file_name()).groupBy("bucket").agg(
        F.countDistinct("file").alias("files"), F.count("*").alias("n_keys"),
        F.countDistinct("depth").alias("depths"),
    ).collect()
    assert len(of_bucket) >= 50
    assert all((r.files, r.depths) == (1, 1) and r.n_keys <= 50 for r in of_bucket)
    assert sum(r.n_keys for r in of_bucket) == pointers.agg(F.sum("n_keys")).first()[0] == 2500
    found = exact_dedup.exact_groups(docs, bucket_keys=50)
    assert found.where("kept").count() == 2500
    assert found.where("group_size = 2").count() == 1000


def test_exact_chains_hold_each_text_once(spark):
    texts = spark.createDataFrame(
        [(0, 7, "a", 1, i) for i in range(500)] + [(0, 7, "b", 2, 900), (0, 8, "c", 1, 901), (0, 8, "c", 3, 902)],
        "bucket bigint, key bigint, norm string, n_chars bigint, doc_id bigint",
    )
    chain = exact_dedup.chains(texts)
    found = rows(chain.orderBy("key", "norm"), "key", "norm", "group_size", "keep_id", "n_texts")
    assert found == [(7, "a", 500, 0, 2), (7, "b", 1, 900, 2), (8, "c", 2, 902, 1)]
    plan = chain._jdf.queryExecution().executedPlan().toString()
    # Copies are combined before the first exchange; the owner's exchange is by bucket.
    assert plan.index("rangepartitioning(bucket") < plan.index("hashpartitioning(bucket")
    assert plan.count("Exchange") == 2 and plan.rindex("partial_count") > plan.index("hashpartitioning(bucket")


def test_exact_is_native(edge):
    plan = exact_dedup.exact_groups(edge)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def numbered(rows):
    """Rows with ids that say which row it is."""
    return [(i, t) for i, (_, t) in enumerate(rows)]


def components(spark, docs):
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    return {r[0]: (r[1], r[2]) for r in rows(jaccard_join.near_duplicates(df), "doc_id", "n_shingles", "component_id")}


def test_near_edge(spark, edge_rows):
    docs = numbered(edge_rows)
    assert components(spark, docs) == brute.near_duplicates(docs)


@pytest.mark.parametrize("boundary", [0, 20, 64])
def test_near_any_boundary(spark, edge_rows, monkeypatch, boundary):
    monkeypatch.setattr(jaccard_join, "boundary_by_cost", lambda *_: boundary)
    docs = numbered(edge_rows)[10:]
    assert components(spark, docs) == brute.near_duplicates(docs)


def test_near_any_order_and_shuffled_joins(spark, edge_rows, monkeypatch):
    monkeypatch.setattr(jaccard_join, "FREQUENT", 2)
    monkeypatch.setattr(jaccard_join, "REPORTED", 1)
    monkeypatch.setattr(jaccard_join, "MOST_FREQUENT", 50)
    monkeypatch.setattr(jaccard_join, "sized", lambda df, n: df)
    docs = numbered(edge_rows)[10:]
    assert components(spark, docs) == brute.near_duplicates(docs)


def test_near_sample(spark, sample):
    df, docs = sample
    found = {r[0]: (r[1], r[2]) for r in rows(jaccard_join.near_duplicates(df), "doc_id", "n_shingles", "component_id")}
    assert found == brute.near_duplicates(docs)


def edited_copies(n, words=60, seed=5):
    """Texts that differ from one base in nought to six words of their own."""
    draw = random.Random(seed)
    base = [f"w{i}" for i in range(words)]
    texts = []
    for i in range(n):
        text = list(base)
        for at in draw.sample(range(words), i % 7):
            text[at] = f"own{i}x{at}"
        texts.append((i, " ".join(text)))
    return texts


@pytest.mark.parametrize("boundary", [0, 64])
def test_near_many_edited_copies(spark, monkeypatch, boundary):
    """Equal to brute force, and the sets of a long list are not paired."""
    docs, met = edited_copies(140), []
    placed = jaccard_join._placed_pairs
    monkeypatch.setattr(jaccard_join, "boundary_by_cost", lambda *_: boundary)
    monkeypatch.setattr(jaccard_join, "_placed_pairs", lambda rows: met.append(placed(rows)) or met[-1])
    assert components(spark, docs) == brute.near_duplicates(docs)
    assert met[0].count() < len(docs) * 10


def long_texts(seed=3):
    """Long texts of own words in groups that share a passage, and texts cut short and edited."""
    draw = random.Random(seed)
    texts = []
    for i in range(120):
        passage = [f"p{i % 6}x{k}" for k in range(40)]
        texts.append([f"own{i}x{k}" for k in range(100)] + passage + [f"own{i}y{k}" for k in range(draw.randrange(40, 90))])
    for i in range(0, 60, 2):
        text = list(texts[i])
        for at in draw.sample(range(len(text)), draw.randrange(1, 7)):
            text[at] = f"edit{i}x{at}"
        texts.append(text[: len(text) - draw.randrange(60)])
        texts.append(texts[i][: draw.choice([-(-3 * (len(texts[i]) - 4) // 4) + 4, 3 * (len(texts[i]) - 4) // 4 + 3])])
    return [(i, " ".join(t)) for i, t in enumerate(texts)]


def test_near_long_sets_with_few_keys_in_common_are_not_paired(spark):
    """The pairs of lists alone hold every link, few others, and each different list once."""
    docs = long_texts()
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    frequent = jaccard_join.frequent_shingles(df)
    keys = df.mapInArrow(jaccard_join._key_task(frequent, 0), jaccard_join._KEYS).distinct()
    shared = keys.groupBy("key").count().where("count > 1").select("key")
    lists = common.stored(keys.join(shared, "key"), "lists")
    weights = lists.groupBy("set_id").agg(F.count("*").alias("weight"))
    none = spark.createDataFrame([], "set_id bigint, root bigint")
    mixed = jaccard_join._mixed(lists.join(weights, "set_id"), none)
    of = {}
    for key, set_id in rows(mixed, "key", "set_id"):
        of.setdefault(key, []).append(set_id)
    assert len(of) == len({tuple(sorted(s)) for s in of.values()}) < shared.count()
    described = df.mapInArrow(jaccard_join._describe, "doc_id bigint, n_shingles bigint, set_id bigint")
    ids = dict(rows(described, "doc_id", "set_id"))
    sets = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} for i, w in ((i, t.split()) for i, t in docs)}
    links = {
        frozenset((ids[i], ids[j])) for i in sets for j in sets
        if i < j and ids[i] != ids[j] and 4 * len(sets[i] & sets[j]) >= 3 * len(sets[i] | sets[j])
    }
    pairs = {frozenset(p) for p in rows(jaccard_join._placed_pairs(mixed), "a", "b")}
    assert len(links) > 40 and links <= pairs
    assert len(pairs) < 5 * len(links)
    assert components(spark, docs) == brute.near_duplicates(docs)


def test_near_sets_meet_once_for_many_keys(spark):
    """Every pair that has a key at fit places in common meets, hardly any of them again."""
    draw = random.Random(8)
    sets = {}
    for i in range(60):
        n = draw.randrange(90, 110)
        keys = sorted(draw.sample(range(60), draw.randrange(40, 60)))
        places = sorted(draw.sample(range(n), len(keys)))
        sets[i] = (n, dict(zip(keys, places, strict=True)))
    listed = [(k, i, n, p, i, 100) for i, (n, keys) in sets.items() for k, p in keys.items()]
    schema = "key bigint, set_id bigint, n int, place int, root bigint, weight bigint"
    expected = set()
    for i, (na, of_a) in sets.items():
        for j, (nb, of_b) in sets.items():
            shared = -(-3 * (na + nb) // 7)
            if (na, i) < (nb, j) and shared <= na and any(
                of_a[k] <= na - shared and of_b[k] <= nb - shared for k in of_a.keys() & of_b.keys()
            ):
                expected.add((i, j))
    met = rows(jaccard_join._meetings(spark.createDataFrame(listed, schema).repartition(4)), "a", "b")
    assert expected and set(met) == expected
    assert len(met) < 1.2 * len(expected)


def test_near_null_ids_and_clashing_columns(edge, edge_rows):
    found = jaccard_join.near_duplicates(edge).collect()
    assert len(found) == len(edge_rows)
    by_null = [r for r in found if r.doc_id is None]
    assert sorted((r.n_shingles, r.component_id or 0) for r in by_null)[0] == (0, 0)
    assert max(by_null, key=lambda r: r.n_shingles).component_id == 3


def test_components_of_a_long_path(spark):
    links = spark.range(1, 200).select(F.col("id").alias("a"), (F.col("id") - 1).alias("b"))
    found = {r.set_id: r.root for r in jaccard_join.components(links).collect()}
    assert found == {i: 0 for i in range(1, 200)}


SUBSTRING = ("doc_id", "n_words", "n_removed", "sha2(cast(kept as binary), 256)")
SUFFIX = ("doc_id", "n_bytes", "n_removed", "n_spans", "sha2(kept, 256)")


def test_substring_edge(edge, edge_rows):
    found = rows(substring_dedup.remove_repeats(edge), *SUBSTRING)
    assert brute.same_rows(found, brute.substring_rows(edge_rows))


@pytest.mark.parametrize("words", [1, 3, 9])
def test_substring_short_factors(edge, edge_rows, words):
    found = rows(substring_dedup.remove_repeats(edge, words), *SUBSTRING)
    assert brute.same_rows(found, brute.substring_rows(edge_rows, words))


def test_substring_sample_full_bitmap(sample, monkeypatch):
    monkeypatch.setattr(common, "BITMAP_WORDS", 1)
    df, docs = sample
    assert brute.same_rows(rows(substring_dedup.remove_repeats(df), *SUBSTRING), brute.substring_rows(docs))


def test_factors_copy_their_sources(sample, edge):
    for docs, size in ((edge, 5), (sample[0], 35)):
        given = [tuple(r) for r in docs.select("doc_id", "text").collect()]
        words = {}
        for doc, text in given:
            words.setdefault(doc, []).append([w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w])
        found = substring_dedup.factors(docs, size).collect()
        assert found
        for f in found:
            assert f.length >= size
            copies = [w[f.start : f.start + f.length] for w in words[f.doc_id]]
            sources = [w[f.source_start : f.source_start + f.length] for w in words[f.source_doc_id]]
            assert any(c == s and len(c) == f.length for c in copies for s in sources)


def test_factors_follow_their_source(spark):
    rng = random.Random(3)
    a, b, c = ([f"w{rng.randrange(10**6)}" for _ in range(n)] for n in (300, 200, 90))
    texts = [a, b, a[50:180] + b[20:120], c, c, b[100:134]]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id bigint, text string")
    found = {}
    for f in substring_dedup.factors(docs).collect():
        found.setdefault(f.doc_id, []).append((f.start, f.length, f.source_doc_id, f.source_start))
    assert sorted(found[2]) == [(0, 130, 0, 50), (130, 100, 1, 20)]
    assert found[0] == [(50, 130, 2, 0)] and found[1] == [(20, 100, 2, 130)]
    assert found[3] == [(0, 90, 4, 0)] and found[4] == [(0, 90, 3, 0)]
    assert 5 not in found


def test_substring_of_one_row_many_times(spark):
    text = " ".join(f"v{i}" for i in range(60))
    docs = spark.range(300).selectExpr("cast(null as bigint) as doc_id", f"'{text}' as text")
    assert substring_dedup.factors(docs).count() == 1
    assert rows(substring_dedup.remove_repeats(docs).distinct(), "n_words", "n_removed", "n_spans", "kept") == [(60, 60, 1, "")]


def test_suffix_edge(edge, edge_rows):
    found = rows(suffix_dedup.remove_matches(edge), *SUFFIX)
    assert brute.same_rows(found, brute.suffix_rows(edge_rows))


@pytest.mark.parametrize("batches", [1, 3, 5])
def test_suffix_batches_of_any_number(sample, batches):
    df, docs = sample
    found = rows(suffix_dedup.remove_matches(df, 60, batches), *SUFFIX)
    assert brute.same_rows(found, brute.suffix_rows(docs, 60))


def test_family_holds_powers_of_two(edge):
    windows = repeats.Windows("byte", 400, 100)
    family = suffix_dedup.Family()
    entries = repeats.keyed(edge).mapInArrow(repeats.cell_scan(windows, windows.grams, False), repeats.CELLS)
    levels = []
    for _ in range(5):
        family.add(entries)
        levels.append(sorted(family.levels))
    assert levels == [[0], [1], [0, 1], [2], [0, 2]]


def test_least_without_packing(monkeypatch):
    import numpy as np

    h = np.random.default_rng(1).integers(0, 6, 500, dtype=np.uint64) << np.uint64(30)
    packed = [repeats.least(h, m) for m in (1, 2, 7, 64, 500)]
    monkeypatch.setattr(repeats, "_LOW", (1 << 24) - 1)
    plain = [[i + int(np.argmin(h[i : i + m])) for i in range(len(h) - m + 1)] for m in (1, 2, 7, 64, 500)]
    assert [p.tolist() for p in packed] == plain


def test_bitmap_lists_every_key(spark):
    keys = spark.range(0, 3000, 3).withColumnRenamed("id", "key")
    found = common.in_bitmap(spark.range(3000).withColumnRenamed("id", "key"), "key", keys)
    listed = {r.key for r in found.where("listed").collect()}
    assert set(range(0, 3000, 3)) <= listed and len(listed) < 1100


def test_empty_tables(empty):
    for operator in (
        exact_dedup.exact_groups, jaccard_join.near_duplicates,
        substring_dedup.remove_repeats, suffix_dedup.remove_matches,
    ):
        assert operator(empty).count() == 0


def test_broadcast_only_under_the_limit(spark):
    small = common.stored(spark.range(100), "ids")
    assert "Broadcast" in spark.range(10).join(common.sized(small, 8), "id")._jdf.queryExecution().toString()
    hinted = common.sized(small, 8, limit=10)._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in hinted
