"""Carrier queries against brute force, with hot numbers and with every join strategy."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from trunkline.functions.keys import (
    br_timestamp,
    cn_bucket,
    parse_reference_date,
    query_keys,
    reference_date,
)
from trunkline.operators import (
    asof_per_call,
    carrier_change,
    dedup_portability,
    enrich_calls,
    numbers_to_query,
    plan_segments,
    resolve_carriers,
)
from trunkline.operators.sizing import broadcast_if_small, measured_bytes
from trunkline.sources import merge_history, read_history

START = date(2010, 1, 1)
REF = date(2010, 6, 30)


def _number(rng):
    kind = rng.random()
    area = rng.choice(["11", "21", "85"])
    if kind < 0.6:
        return area + "9000" + str(rng.randint(0, 3)) + f"{rng.randint(0, 40):04d}"
    if kind < 0.8:
        return area + "300" + str(rng.randint(0, 2)) + f"{rng.randint(0, 40):04d}"
    return rng.choice(["190", "33334444", "5511900000001", "8001234567", "0"])


@pytest.fixture(scope="module")
def world():
    """A third of the calls and of the history belongs to one number."""
    rng = random.Random(7)
    hot = "11900000001"
    history = {}
    for i in range(3000):
        n = hot if i % 3 == 0 else _number(rng)
        day = START + timedelta(days=rng.randint(0, 400))
        history[(n, day)] = rng.choice([-1, 101, 102, 103])
    plan = []
    for area in ("11", "21"):
        for prefix, size in (("90000", 11), ("90001", 11), ("3000", 10)):
            for _ in range(6):
                a, b = sorted(rng.sample(range(0, 60), 2))
                base = area + prefix
                plan.append(
                    (int(area), int(prefix), int(f"{base}{a:04d}"), int(f"{base}{b:04d}"),
                     -1, rng.choice([9001, 9002, 9003]))
                )
    plan += plan[:8] * 50
    plan.append((80, 123, 0, 1, -1, 9009))
    plan.append((80, 123, 8001234567, 8001234567, -1, 9004))
    names = {-1: "NÃO IDENTIFICADO", 101: "A", 102: "B", 103: None, 9001: "P", 9002: "Q",
             9004: "T"}
    calls = []
    for i in range(4000):
        origin = hot if i % 3 == 0 else _number(rng)
        if i % 97 == 0:
            origin = None
        calls.append((i, origin, _number(rng), START + timedelta(days=rng.randint(0, 420))))
    return {"history": history, "plan": plan, "names": names, "calls": calls, "hot": hot}


@pytest.fixture(scope="module")
def frames(spark, world):
    history = spark.createDataFrame(
        [(int(n), d, c, int(n[:2])) for (n, d), c in world["history"].items()],
        "tn_inicial bigint, data_agendamento date, cod_receptora int, cn int",
    )
    plan = spark.createDataFrame(
        world["plan"],
        "cn int, prefixo int, faixa_inicial bigint, faixa_final bigint, "
        "codigo_cnl int, cod_prestadora bigint",
    )
    names = spark.createDataFrame(
        list(world["names"].items()), "cod_prestadora bigint, nome_prestadora string"
    )
    calls = spark.createDataFrame(
        world["calls"], "id int, origem string, destino string, dia date"
    )
    return calls, history, plan, names


def brute_assigned(world, n):
    if len(n) not in (10, 11):
        return None
    cn, prefix = int(n[:2]), int(n[2:6] if len(n) == 10 else n[2:7])
    hits = [
        (-start, end, code)
        for (c, p, start, end, _, code) in world["plan"]
        if c == cn and p == prefix and start <= int(n) <= end
    ]
    return min(hits)[2] if hits else None


def brute_ported(world, n, day):
    if len(n) not in (10, 11):
        return None
    past = [(d, c) for (m, d), c in world["history"].items() if m == n and d <= day]
    return max(past)[1] if past else None


def brute_resolved(world, n, day):
    assigned, ported = brute_assigned(world, n), brute_ported(world, n, day)
    code = ported if ported is not None else assigned
    return (world["names"].get(code), int(ported is not None), int(assigned is not None))


NO_BROADCAST = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
}


def _final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("broadcast", [True, False])
def test_resolve_and_enrich(spark, world, frames, conf, broadcast):
    if not broadcast:
        conf(**NO_BROADCAST)
    limit = {} if broadcast else {"broadcast_limit": 0}
    calls, history, plan, names = frames
    resolved = resolve_carriers(calls, history, plan, names, REF, ("origem", "destino"), **limit)
    got = {r[0]: tuple(r[1:]) for r in resolved.collect()}
    numbers = {n for _, o, d, _ in world["calls"] for n in (o, d) if n is not None}
    assert got == {int(n): brute_resolved(world, n, REF) for n in numbers}
    assert resolved.count() == len(numbers)

    enriched = enrich_calls(calls, history, plan, names, "origem", "destino", REF, **limit)
    rows = {r.id: (r.operadora_origem, r.operadora_destino) for r in enriched.collect()}
    assert enriched.columns == [*calls.columns, "operadora_origem", "operadora_destino"]
    assert len(rows) == len(world["calls"]) == enriched.count()
    for i, o, d, _ in world["calls"]:
        expected = (
            brute_resolved(world, o, REF)[0] if o is not None else None,
            brute_resolved(world, d, REF)[0],
        )
        assert rows[i] == expected
    text = _final_plan(enriched)
    assert "NestedLoop" not in text and "Cartesian" not in text


@pytest.mark.parametrize("broadcast", [True, False])
def test_asof_per_call(spark, world, frames, conf, broadcast):
    if not broadcast:
        conf(**NO_BROADCAST)
    calls, history, _, _ = frames
    got = asof_per_call(calls, history, "origem", "dia")
    assert got.columns == [*calls.columns, "cod_receptora"]
    rows = {r.id: r.cod_receptora for r in got.collect()}
    assert len(rows) == len(world["calls"]) == got.count()
    for i, o, _, day in world["calls"]:
        past = [(d, c) for (m, d), c in world["history"].items() if m == o and d <= day]
        assert rows[i] == (max(past)[1] if past else None)


def test_carrier_change(spark, world, frames):
    calls, history, plan, names = frames
    before, after = date(2010, 2, 1), date(2010, 12, 1)
    numbers = calls.select(F.col("origem").alias("nu_terminal"))
    got = {r[0]: tuple(r[1:]) for r in carrier_change(
        numbers, history, plan, names, before, after).collect()}
    expected = {}
    for n in {o for _, o, _, _ in world["calls"] if o is not None}:
        a, b = (brute_resolved(world, n, d)[0] for d in (before, after))
        if a != b:
            expected[int(n)] = (a, b)
    assert got == expected and expected


def test_null_receiver_in_last_row_is_not_ported(spark):
    history = spark.createDataFrame(
        [(11900000001, date(2010, 1, 1), 101, 11), (11900000001, date(2010, 2, 1), None, 11)],
        "tn_inicial bigint, data_agendamento date, cod_receptora int, cn int",
    )
    calls = spark.createDataFrame([(1, 11900000001, date(2010, 3, 1))], "id int, n bigint, d date")
    assert asof_per_call(calls, history, "n", "d").first().cod_receptora is None


def test_leading_zeros_have_no_keys(spark, frames):
    _, history, plan, names = frames
    numbers = spark.createDataFrame(
        [("011900000001",), ("abc",), (None,), ("11900000001",)], "nu_terminal string"
    )
    rows = resolve_carriers(numbers, history, plan, names, REF).collect()
    assert [r.nu_terminal for r in rows] == [11900000001] and rows[0].ind_portado == 1
    alone = numbers.limit(1)
    row = resolve_carriers(alone, history, plan, names, REF).first()
    assert tuple(row) == (11900000001, None, 0, 0)


def test_text_and_whole_numbers_agree(spark, frames):
    calls, history, plan, names = frames
    whole = calls.select(*[F.col(c).cast("bigint").alias(c) for c in ("origem", "destino")])
    assert numbers_to_query(whole, "origem", "destino").columns == ["nu_terminal", "cn", "prefixo"]
    got, expected = (
        {tuple(r) for r in resolve_carriers(
            df, history, plan, names, REF, ("origem", "destino")).collect()}
        for df in (whole, calls)
    )
    assert got == expected and len(got) > 100


def test_query_keys(spark):
    texts = {
        "11987654321": (11987654321, 11, 98765), "1133334444": (1133334444, 11, 3333),
        "0987654321": (987654321, 9, 8765), "987654321": (987654321, -1, -1),
        "551198765432": (551198765432, -1, -1), "01100001234": (1100001234, 1, 10000),
        "x": (None, -1, -1), "190": (190, -1, -1),
    }
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", *query_keys("t")).collect():
        assert tuple(r)[1:] == texts[r.t]
    whole = df.where("t not like '0%' and t <> 'x'").select(F.col("t").cast("bigint"))
    for r in whole.select("t", *query_keys("t", whole=True)).collect():
        assert tuple(r)[1:] == texts[str(r.t)]


def test_hot_number_is_split_by_the_adaptive_join(spark, conf):
    """A third of the calls has one number, on one day; several tasks join them."""
    conf(
        **NO_BROADCAST,
        spark__sql__shuffle__partitions="16",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="200kb",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="200kb",
    )
    calls = spark.range(0, 600_000, 1, 8).select(
        "id",
        F.when(F.col("id") % 3 == 0, 11900000001)
        .otherwise(11900000000 + F.pmod(F.xxhash64("id"), F.lit(9_000_000)))
        .alias("origem"),
        (11900000000 + F.pmod(F.xxhash64("id", F.lit(1)), F.lit(90_000))).alias("destino"),
        F.date_add(
            F.lit(START),
            F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 2).cast("int"),
        ).alias("dia"),
    )
    history = spark.range(0, 90_000, 1, 4).select(
        (F.col("id") + 11900000000).alias("tn_inicial"),
        F.lit(START).alias("data_agendamento"),
        F.lit(101).alias("cod_receptora"),
        F.lit(11).alias("cn"),
    )
    plan = spark.createDataFrame(
        [(11, 90000, 11900000000, 11900009999, -1, 9001)],
        "cn int, prefixo int, faixa_inicial bigint, faixa_final bigint, "
        "codigo_cnl int, cod_prestadora bigint",
    )
    names = spark.createDataFrame(
        [(101, "A"), (9001, "P")], "cod_prestadora bigint, nome_prestadora string"
    )
    one_day = calls.withColumn("dia", F.lit(START))
    for df in (
        enrich_calls(calls, history, plan, names, "origem", "destino", REF),
        asof_per_call(calls, history, "origem", "dia"),
        asof_per_call(one_day, history, "origem", "dia"),
    ):
        assert df.count() == 600_000
        executed = _final_plan(df)
        assert "skew=true" in executed, executed[:3000]


def test_hash_aggregates_carry_the_lookup(spark, frames, tmp_path):
    """No sort-based aggregation and no window stands in the carrier query, and nothing is
    aggregated after the join with the plan's segments."""
    calls, history, plan, names = frames
    plan_segments(plan).write.parquet(str(tmp_path / "s"))
    segments = spark.read.parquet(str(tmp_path / "s"))
    df = resolve_carriers(calls, history, segments, names, REF, ("origem", "destino"))
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in text and "Window" not in text
    assert text.count("Exchange hashpartitioning") == 2  # numbers, history
    assert text.count("HashAggregate") == 4  # two each
    assert text.count("BroadcastHashJoin") >= 3


def test_ranges_and_segments_give_the_same(spark, frames):
    calls, history, plan, names = frames
    given = [
        {tuple(r) for r in resolve_carriers(
            calls, history, p, names, REF, ("origem", "destino")).collect()}
        for p in (plan, plan_segments(plan))
    ]
    assert given[0] == given[1] and given[0]


def test_few_numbers_read_their_ranges_only(spark, frames, tmp_path):
    """Dynamic partition pruning on the area-code range, without a job beforehand."""
    _, history, plan, names = frames
    rows = dedup_portability(
        history.where("cod_receptora > 0").select(
            F.lit(1).alias("numero_bp"), "tn_inicial", "cod_receptora",
            F.lit(None).cast("int").alias("cod_doadora"), F.lit(1).alias("cod_status"),
            F.lit(0).alias("ind_portar_origem"), F.lit("f").alias("nome_arquivo"),
            F.col("data_agendamento").cast("timestamp_ntz").alias("data_agendamento"),
        )
    )
    merge_history(spark, rows, str(tmp_path / "h"))
    stored = read_history(spark, str(tmp_path / "h"))
    given = spark.createDataFrame([(11900000001,), (11900010002,)], "nu_terminal bigint")
    given.write.parquet(str(tmp_path / "n"))
    numbers = spark.read.parquet(str(tmp_path / "n"))  # a table has a size that Spark knows
    df = resolve_carriers(numbers, stored, plan, names, REF)
    assert "dynamicpruning" in _final_plan(df)
    listed = resolve_carriers(given, stored, plan, names, REF, few_numbers=True)
    assert "dynamicpruning" in _final_plan(listed)
    assert "LeftSemi" not in _final_plan(resolve_carriers(given, stored, plan, names, REF))
    plain = resolve_carriers(numbers, history.where("cod_receptora > 0"), plan, names, REF)
    assert {tuple(r) for r in df.collect()} == {tuple(r) for r in plain.collect()}


def test_numbers_are_resolved_once_for_both_sides(spark, frames, conf):
    conf(**NO_BROADCAST)
    calls, history, plan, names = frames
    df = enrich_calls(calls, history, plan, names, "origem", "destino", REF)
    assert "ReusedExchange" in _final_plan(df)


def test_date_filter_and_columns_reach_the_scan(spark, frames, tmp_path):
    calls, history, plan, names = frames
    history.withColumn("numero_bp", F.lit(1)).write.parquet(str(tmp_path / "h"))
    stored = spark.read.parquet(str(tmp_path / "h"))
    df = resolve_carriers(calls, stored, plan, names, REF, ("origem",))
    leaves = df._jdf.queryExecution().executedPlan().toString().split("FileScan parquet")
    assert len(leaves) == 2
    assert "LessThanOrEqual(data_agendamento,2010-06-30)" in leaves[1]
    assert "struct<tn_inicial:bigint,data_agendamento:date,cod_receptora:int>" in leaves[1]


def test_measured_bytes_decides(spark):
    df = spark.createDataFrame([(1, "abc"), (2, None)], "a bigint, b string")
    assert measured_bytes(df) == 2 * 8 * 3 + 3
    plan = broadcast_if_small(df)._jdf.queryExecution().logical().toString()
    assert "broadcast" in plan
    plan = broadcast_if_small(df, 10)._jdf.queryExecution().logical().toString()
    assert "broadcast" not in plan


def test_reference_dates(spark):
    assert parse_reference_date("2024-12-15") == date(2024, 12, 15)
    assert parse_reference_date("15/12/2024") == date(2024, 12, 15)
    assert parse_reference_date("20241215") == date(2024, 12, 15)
    assert parse_reference_date(date(2024, 1, 2)) == date(2024, 1, 2)
    assert parse_reference_date(datetime(2024, 1, 2, 3)) == date(2024, 1, 2)
    assert parse_reference_date() == date.today()
    with pytest.raises(ValueError):
        parse_reference_date("12-15-2024")
    with pytest.raises(TypeError):
        parse_reference_date(20241215)
    texts = ["2024-12-15", "15/12/2024", "20241215", "1/2/2024", "2024-1-2", "2024125",
             "12-15-2024", "2024-02-30", "", "x", "2024-13-01", "31/04/2024", "202415"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", reference_date("t").alias("d")).collect():
        try:
            expected = parse_reference_date(r.t)
        except ValueError:
            expected = None
        assert r.d == expected, r.t


def test_timestamps_and_buckets(spark):
    texts = {
        "11/06/2010 00:00:00": datetime(2010, 6, 11),
        "1/6/2010 1:02:03": datetime(2010, 6, 1, 1, 2, 3),
        "31/02/2010 00:00:00": None,
        "2010-06-11 00:00:00": None,
        "11/06/2010": None,
        "": None,
        "11/06/2010 24:00:00": None,
    }
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", br_timestamp("t").alias("x")).collect():
        assert r.x == texts[r.t], r.t
    cns = {11: "cn_11", 12: "cn_12_20", 20: "cn_12_20", 21: "cn_21_40", 40: "cn_21_40",
           41: "cn_41_70", 70: "cn_41_70", 71: "cn_71_99", 99: "cn_71_99",
           10: "cn_default", 100: "cn_default", -1: "cn_default"}
    df = spark.createDataFrame([(c,) for c in cns], "c int")
    assert all(cns[r[0]] == r[1] for r in df.select("c", cn_bucket("c")).collect())
