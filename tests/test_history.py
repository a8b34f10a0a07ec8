"""Deduplication, upsert and the partitioned history table."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from trunkline.functions.keys import cn_bucket
from trunkline.operators import (
    asof_per_call,
    carrier_changes,
    carriers_from_numbering,
    carriers_from_portability,
    consolidate_plan,
    dedup_portability,
    numbers_to_query,
    plan_segments,
    ported_carrier,
    rejected_ranges,
    upsert_carriers,
    upsert_history,
)
from trunkline.operators import validity
from trunkline.operators.segments import segments_of
from trunkline.plans import inputs
from trunkline.schemas import STAGED_PORTABILITY
from trunkline.sources import history_store, tables
from trunkline.sources.history_store import (
    compact_history,
    merge_history,
    read_history,
    read_manifest,
)


def _staged_rows(seed, files, n=2000):
    """A third of the rows has one number on one day."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        hot = i % 3 == 0
        tn = 11900000001 if hot else rng.choice([11, 21, 85, 10]) * 10**9 + rng.randint(0, 200)
        day = datetime(2010, 1, 1) + timedelta(
            days=0 if hot else 12 * rng.randint(0, 5), hours=rng.randint(0, 23)
        )
        rows.append(
            (1, rng.randint(1, 50), tn, rng.choice([None, 101, 102]), "R",
             rng.choice([None, 201]), "D", day, rng.randint(1, 3), "Ativo",
             rng.randint(0, 1), rng.choice(files))
        )
    return rows


def _frame(spark, rows):
    return spark.createDataFrame(rows, STAGED_PORTABILITY)


def _low(v):
    return (v is not None, v if v is not None else 0)


def _brute_dedup(rows):
    best = {}
    for r in rows:
        key = (r[2], r[7].date())
        rank = (r[11], r[7], r[1], _low(r[3]), _low(r[5]), r[8], r[10])
        if key not in best or rank > best[key][0]:
            best[key] = (rank, r)
    return {
        k: (r[1], -1 if r[3] is None else r[3], -1 if r[5] is None else r[5], r[8], r[10],
            int(str(r[2])[:2]), r[11])
        for k, (_, r) in best.items()
    }


def _as_dict(df):
    rows = df.collect()
    out = {
        (r.tn_inicial, r.data_agendamento): (
            r.numero_bp, r.cod_receptora, r.cod_doadora, r.cod_status,
            r.ind_portar_origem, r.cn, r.nome_arquivo,
        )
        for r in rows
    }
    assert len(out) == len(rows)
    return out


def test_dedup_against_brute_force(spark):
    rows = _staged_rows(1, ["a.csv.gz", "b.csv.gz"])
    assert _as_dict(dedup_portability(_frame(spark, rows))) == _brute_dedup(rows)


def test_dedup_reduces_before_the_shuffle(spark):
    rows = _staged_rows(1, ["a.csv.gz"], 30)
    df = dedup_portability(_frame(spark, rows))
    text = df._jdf.queryExecution().executedPlan().toString()
    assert text.index("partial_max") > text.index("Exchange hashpartitioning")
    assert "Window" not in text


def test_upsert_later_batch_wins_and_is_idempotent(spark):
    old, new = _staged_rows(1, ["b.csv.gz"]), _staged_rows(2, ["a.csv.gz"])
    h0, h1 = (dedup_portability(_frame(spark, r)) for r in (old, new))
    merged = upsert_history(h0, h1)
    expected = {**_brute_dedup(old), **_brute_dedup(new)}
    assert _as_dict(merged) == expected
    assert _as_dict(upsert_history(merged, h1)) == expected


def _with_ends(expected):
    """The expected rows with the day of each number's next porting."""
    days = {}
    for number, day in expected:
        days.setdefault(number, []).append(day)
    ends = {}
    for number, found in days.items():
        found.sort()
        ends |= {(number, d): e for d, e in zip(found, [*found[1:], None], strict=True)}
    return ends


def _check(spark, path, expected):
    df = read_history(spark, path)
    assert _as_dict(df) == expected
    ends = {(r.tn_inicial, r.data_agendamento): r.valido_ate for r in df.collect()}
    assert ends == _with_ends(expected)
    wrong = df.where(~F.col("cn_bucket").eqNullSafe(cn_bucket("cn")))
    assert wrong.isEmpty()


def _files(path):
    return {str(f): f.stat().st_mtime_ns for f in path.rglob("part-*")}


def test_history_table(spark, tmp_path):
    path = str(tmp_path / "history")
    assert read_history(spark, path).count() == 0
    old, new = _staged_rows(1, ["b.csv.gz"]), _staged_rows(2, ["a.csv.gz"])
    for rows in (old, new, new):
        merge_history(spark, dedup_portability(_frame(spark, rows)), path)
    expected = {**_brute_dedup(old), **_brute_dedup(new)}
    _check(spark, path, expected)
    found = {r.cn_bucket for r in read_history(spark, path).collect()}
    assert found == {"cn_11", "cn_21_40", "cn_71_99", "cn_default"}
    merge_history(spark, dedup_portability(_frame(spark, old)), path, rebuild=True)
    _check(spark, path, _brute_dedup(old))
    # The state before stays for readers that have opened it; older ones are gone.
    assert len(list((tmp_path / "history").glob("versao=*"))) == 2


def test_small_batches_add_small_versions(spark, tmp_path):
    path = str(tmp_path / "history")
    rows = _staged_rows(1, ["a.csv.gz"])
    merge_history(spark, dedup_portability(_frame(spark, rows)), path)
    base = read_manifest(spark, path)
    before = _files(tmp_path / "history")
    batch = _staged_rows(2, ["b.csv.gz"])[:40]
    merge_history(spark, dedup_portability(_frame(spark, batch)), path)
    added = read_manifest(spark, path)
    assert added.versions[:-1] == base.versions and added.buckets == base.buckets
    # The batch's rows and the rows before them, whose intervals end now.
    assert 0 < added.rows[added.versions[-1]] <= 2 * len(_brute_dedup(batch))
    now = _files(tmp_path / "history")
    assert before.items() <= now.items()
    assert len(now) - len(before) <= len(batch) * 2
    expected = {**_brute_dedup(rows), **_brute_dedup(batch)}
    _check(spark, path, expected)
    for again in (batch, []):  # nothing new: nothing added
        merge_history(spark, dedup_portability(_frame(spark, again)), path)
        assert read_manifest(spark, path) == added


def test_versions_are_compacted(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(history_store, "MOST_VERSIONS", 3)
    monkeypatch.setattr(history_store, "ROWS_PER_BUCKET", 50)
    path = str(tmp_path / "history")
    expected, versions = {}, []
    for i in range(5):
        rows = _staged_rows(i, [f"{i}.csv.gz"])[: None if i == 0 else 15]
        merge_history(spark, dedup_portability(_frame(spark, rows)), path)
        expected |= _brute_dedup(rows)
        _check(spark, path, expected)
        versions.append(len(read_manifest(spark, path).rows))
    assert versions == [1, 2, 3, 1, 2]
    opened = read_history(spark, path)
    compact_history(spark, path)
    manifest = read_manifest(spark, path)
    assert list(manifest.rows.values()) == [len(expected)] and len(manifest.replaced) == 2
    assert _as_dict(opened) == expected  # a reader of the state before goes on
    _check(spark, path, expected)


def test_the_history_is_not_shuffled(spark, tmp_path, conf):
    """Lookups, as-of joins and changes read the buckets as they lie, one version or two."""
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__shuffle__partitions="5",
    )
    path = str(tmp_path / "history")
    merge_history(spark, dedup_portability(_frame(spark, _staged_rows(1, ["a.csv.gz"]))), path)
    calls = spark.range(500).select(
        "id", (F.col("id") % 90 + 11900000000).alias("n"), F.lit(date(2012, 1, 1)).alias("d")
    )
    for _ in range(2):
        rows = read_history(spark, path)
        numbers = numbers_to_query(calls, "n")
        day = {"c": date(2012, 1, 1)}
        both = day | {"e": date(2010, 1, 1)}
        for df in (
            ported_carrier(numbers, rows, day),
            ported_carrier(numbers, rows, both),
            asof_per_call(calls, rows, "n", "d"),
            carrier_changes(rows, date(2000, 1, 1), date(2020, 1, 1)),
        ):
            df.collect()
            text = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
            for line in _below_exchanges(text):
                assert "historico_" not in line and "tn_inicial" not in line, text
        asof = asof_per_call(calls, rows, "n", "d")._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in asof and "Union" not in asof
        batch = _staged_rows(2, ["b.csv.gz"])[:10]
        merge_history(spark, dedup_portability(_frame(spark, batch)), path)


def _below_exchanges(text):
    """Lines of scans whose rows are exchanged before they are joined."""
    lines, out = text.splitlines(), []
    for i, line in enumerate(lines):
        if "FileScan parquet" not in line:
            continue
        depth = len(line) - len(line.lstrip(" :+-*|"))
        for above in reversed(lines[:i]):
            own = len(above) - len(above.lstrip(" :+-*|"))
            if own < depth:
                depth = own
                if "Join" in above:
                    break
                if "Exchange hashpartitioning" in above:
                    out.append(line)
                    break
    return out


def test_carrier_changes(spark, tmp_path):
    """Over the whole stored history, and of newly merged numbers only."""
    path = str(tmp_path / "history")
    rows = _staged_rows(1, ["a.csv.gz"])
    merge_history(spark, dedup_portability(_frame(spark, rows)), path)
    batch = _staged_rows(2, ["b.csv.gz"])[:60]
    merge_history(spark, dedup_portability(_frame(spark, batch)), path)
    merged = {**_brute_dedup(rows), **_brute_dedup(batch)}
    days = sorted(d for _, d in merged)
    first, last = days[len(days) // 4], days[len(days) // 2]
    expected, before = set(), {}
    for (number, day), row in sorted(merged.items()):
        earlier = before.get(number, (row[2],))[0]
        before[number] = (row[1],)
        if first <= day <= last and earlier != row[1]:
            expected.add((number, day, earlier, row[1]))
    history = read_history(spark, path)
    got = {tuple(r) for r in carrier_changes(history, first, last).collect()}
    assert got == expected and expected
    arrived = dedup_portability(_frame(spark, batch))
    some = {tuple(r) for r in carrier_changes(history, first, last, arrived).collect()}
    assert some == {r for r in expected if r[0] in {n for n, _ in _brute_dedup(batch)}}
    assert carrier_changes(history.limit(0), first, last).isEmpty()


def test_a_failed_write_leaves_the_old_tables(spark, tmp_path, monkeypatch):
    history, names = str(tmp_path / "history"), str(tmp_path / "names")
    rows = _staged_rows(1, ["a.csv.gz"])
    merge_history(spark, dedup_portability(_frame(spark, rows)), history)
    tables.replace_table(spark.range(3), names)

    def fail(*_):
        raise OSError("no space")

    monkeypatch.setattr(tables, "switch_current", fail)
    monkeypatch.setattr(history_store, "switch_current", fail)
    batch = dedup_portability(_frame(spark, _staged_rows(2, ["b.csv.gz"])))
    with pytest.raises(OSError):
        merge_history(spark, batch, history)
    with pytest.raises(OSError):
        tables.replace_table(tables.read_versioned(spark, names).where("id > 0"), names)
    broken = spark.range(3).select(F.raise_error(F.lit("x")).cast("bigint").alias("id"))
    with pytest.raises(Exception):
        tables.replace_table(broken, names)
    assert _as_dict(read_history(spark, history)) == _brute_dedup(rows)
    assert tables.read_versioned(spark, names).count() == 3


def test_carrier_names(spark):
    schema = "cod_receptora int, nome_receptora string, cod_doadora int, nome_doadora string"
    ported = spark.createDataFrame(
        [(1, "A", 2, "B"), (1, "a", None, "X"), (None, None, 3, None), (2, "C", 3, None)],
        schema,
    )
    got = dict(carriers_from_portability(ported).collect())
    assert got == {1: "a", 2: "C", 3: None, -1: "NÃO IDENTIFICADO"}
    empty = carriers_from_portability(ported.limit(0))
    assert dict(empty.collect()) == {-1: "NÃO IDENTIFICADO"}

    numbering = spark.createDataFrame(
        [("01", "N1"), ("01", "N2"), (None, "Y"), ("40432544000147", None)],
        "cnpj_prestadora string, nome_prestadora string",
    )
    got = dict(carriers_from_numbering(numbering).collect())
    assert got == {1: "N2", 40432544000147: None, -1: "NÃO IDENTIFICADO"}

    old = spark.createDataFrame(
        [(1, "old"), (7, "kept"), (3, "gone")], "cod_prestadora bigint, nome_prestadora string"
    )
    merged = upsert_carriers(
        old, [carriers_from_portability(ported), carriers_from_numbering(numbering)]
    )
    assert dict(merged.collect()) == {
        1: "N2", 2: "C", 3: None, 7: "kept", 40432544000147: None, -1: "NÃO IDENTIFICADO",
    }


def test_carrier_names_of_a_hot_code_shrink_before_the_shuffle(spark):
    ported = spark.range(0, 200_000, 1, 4).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise((F.col("id") % 50).cast("int")).alias(
            "cod_receptora"
        ),
        F.lit("R").alias("nome_receptora"),
        F.lit(9).alias("cod_doadora"),
        F.lit("D").alias("nome_doadora"),
    )
    df = carriers_from_portability(ported)
    assert df.count() == 51
    text = df._jdf.queryExecution().executedPlan().toString()
    assert text.count("Range (0, 200000") <= 2  # one scan, printed in both plan versions


def test_plan_consolidation(spark):
    stfc = spark.createDataFrame(
        [
            ("11", "5201", "0000", "0999", "11000", "31063800000185"),
            ("11", "91932", "0000", "9999", None, "45061943000162"),
            ("11", "7801", "0010", "0999", None, "x"),
            (None, "7801", "0000", "0999", None, "1"),
        ],
        "cn string, prefixo string, faixa_inicial string, faixa_final string, "
        "codigo_cnl string, cnpj_prestadora string",
    )
    cng = spark.createDataFrame(
        [("8000387204", "02777002000117"), ("800", "1")],
        "codigo_nao_geografico string, cnpj_prestadora string",
    )
    got = {tuple(r) for r in consolidate_plan(stfc, cng).collect()}
    assert got == {
        (11, 5201, 1152010000, 1152010999, 11000, 31063800000185),
        (11, 91932, 11919320000, 11919329999, -1, 45061943000162),
        (80, 38, 8000387204, 8000387204, -1, 2777002000117),
        (80, 0, 800, 800, -1, 1),
    }
    assert rejected_ranges(stfc, cng).count() == 2


@pytest.mark.parametrize("seed", range(4))
def test_segments_against_brute_force(spark, seed):
    """Every number of a prefix lies in the segment of the range that counts for it."""
    rng = random.Random(seed)
    plan = []
    for cn, prefix in ((11, 9000), (11, 9001), (21, 9000), (80, 1)):
        for _ in range(rng.randint(1, 40)):
            a, b = rng.randint(0, 120), rng.randint(0, 120)
            if rng.random() < 0.3:
                b = a
            elif rng.random() < 0.9:  # the others end before they start
                a, b = min(a, b), max(a, b)
            plan.append((cn, prefix, a, b, -1, rng.randint(1, 4)))
    plan += plan[:5]
    df = spark.createDataFrame(
        plan,
        "cn int, prefixo int, faixa_inicial bigint, faixa_final bigint, codigo_cnl int, "
        "cod_prestadora bigint",
    ).repartition(3)
    found = {}
    rows = plan_segments(df).collect()
    for r in rows:
        for x in range(r.faixa_inicial, r.faixa_final + 1):
            assert (r.cn, r.prefixo, x) not in found
            found[r.cn, r.prefixo, x] = r.cod_prestadora
    expected = {}
    for cn, prefix, a, b, _, code in plan:
        for x in range(a, b + 1):
            rank = (-a, b, code)
            key = (cn, prefix, x)
            expected[key] = min(expected.get(key, rank), rank)
    assert found == {k: v[2] for k, v in expected.items()}
    assert plan_segments(df.limit(0)).isEmpty()
    segments = plan_segments(df)
    assert segments_of(segments) is segments


@pytest.mark.parametrize("seed", range(3))
def test_tie_order_is_total(spark, seed):
    """The same rows in any order and partitioning give the same winner."""
    rows = _staged_rows(9, ["a.csv.gz"], 400)
    random.Random(seed).shuffle(rows)
    df = _frame(spark, rows).repartition(1 + seed * 3)
    assert _as_dict(dedup_portability(df)) == _brute_dedup(rows)


def test_intervals_and_buckets_share_one_shuffle(spark, tmp_path, monkeypatch):
    made = []

    def noted(rows):
        made.append(validity.with_validity(rows))
        return made[-1]

    monkeypatch.setattr(history_store, "with_validity", noted)
    merge_history(spark, dedup_portability(_frame(spark, _staged_rows(1, ["a.csv.gz"]))), str(tmp_path / "h"))
    plan = made[-1]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "REPARTITION_BY_NUM" in plan


def test_landed_inputs_are_dealt_out_only_while_they_are_small(spark, tmp_path):
    small, large = str(tmp_path / "small"), str(tmp_path / "large")
    spark.range(1000).repartition(1).write.parquet(small)
    spark.range(1000).repartition(8).write.parquet(large)
    landed = []
    for path in (small, large):
        found = inputs.land(spark, path, "ids", lambda s, d: inputs._spread(s.read.parquet(d)))
        assert sorted(r.id for r in found.collect()) == list(range(1000))
        plan = inputs._spread(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
        landed.append("Exchange" in plan)
    assert landed == [True, False]
