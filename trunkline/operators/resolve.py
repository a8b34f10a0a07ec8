"""Which carrier served a number on a date."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trunkline.functions.keys import cn_bucket, parse_reference_date, query_keys
from trunkline.operators.segments import segments_of
from trunkline.operators.sizing import (
    BROADCAST_LIMIT,
    broadcast_if_small,
    measured_bytes,
)
from trunkline.operators.validity import VALID_TO, in_force, with_validity

RefDate = date | str | None

# One long holds both lookup keys of a number, so that the best keys of several
# spellings are a plain maximum (hash aggregation, reduced before the shuffle).
_PREFIX_SPAN = 1_000_000

_SPREAD = 1_000_000


def numbers_to_query(numbers: DataFrame, *columns: str) -> DataFrame:
    """Distinct ``(nu_terminal, cn, prefixo)`` of one or more columns of numbers.

    All columns are read in one scan. Text that is no number names no terminal and
    is left out.
    """
    columns = columns or ("nu_terminal",)
    types = {numbers.select(c).schema[0].dataType for c in columns}
    whole = all(isinstance(t, T.IntegralType) for t in types)
    values = [F.col(c).cast("bigint" if whole else "string") for c in columns]
    value = F.explode(F.array(*values)) if len(values) > 1 else values[0]
    given = numbers.select(value.alias("n"))
    if whole:
        # The keys follow from the number, so they are computed once per number.
        distinct = given.where(F.col("n").isNotNull()).distinct()
        return distinct.select(*query_keys("n", whole=True))
    nu, cn, prefix = query_keys("n")
    packed = cn * F.lit(_PREFIX_SPAN).cast("bigint") + prefix
    distinct = (
        given.select(nu, packed.alias("chave"))
        .where(F.col("nu_terminal").isNotNull())
        .groupBy("nu_terminal")
        .agg(F.max("chave").alias("chave"))
    )
    known = F.col("chave") >= 0
    return distinct.select(
        "nu_terminal",
        F.when(known, F.floor(F.col("chave") / _PREFIX_SPAN))
        .otherwise(-1)
        .cast("int")
        .alias("cn"),
        F.when(known, F.col("chave") % _PREFIX_SPAN)
        .otherwise(-1)
        .cast("int")
        .alias("prefixo"),
    )


def unknown_numbers(numbers: DataFrame, column: str) -> DataFrame:
    """Distinct values of a column that name no terminal, NULL among them."""
    nu, _, _ = query_keys(column)
    return numbers.where(nu.isNull()).select(F.col(column).cast("string").alias("texto")).distinct()


def assigned_carrier(
    numbers: DataFrame, plan: DataFrame, broadcast_limit: int = BROADCAST_LIMIT
) -> DataFrame:
    """Distinct ``numbers`` with ``cod_prestadora`` of the numbering plan, or NULL.

    ``plan`` holds ranges, or the segments that ``plan_segments`` makes of them; a number
    lies in one segment at most, so nothing is aggregated after the join. Segments of one
    number, as all non-geographic codes are, meet the numbers in an equi-join on the number
    itself. For wider ones, equal area code and prefix make a hash join with a residual range
    test. Segments of checked size are broadcast, and the numbers keep their partitioning. A
    larger plan is shuffled on the prefix, of which each has at most ten thousand distinct
    numbers; numbers without a prefix match nothing and are spread over many keys.
    """
    segments = segments_of(plan)
    # Cutting n ranges at their ends gives fewer than 2 n segments.
    times = 1 if segments is plan else 2
    points = segments.where("faixa_inicial = faixa_final").select(
        "cn",
        "prefixo",
        F.col("faixa_inicial").alias("nu_terminal"),
        F.col("cod_prestadora").alias("_ponto"),
    )
    wide = segments.where("faixa_inicial < faixa_final")
    if times * measured_bytes(plan) <= broadcast_limit:
        points, wide = F.broadcast(points), F.broadcast(wide)
    n = (
        numbers.join(points, ["cn", "prefixo", "nu_terminal"], "left")
        .withColumn(
            "chave_prefixo",
            F.when(F.col("cn") >= 0, F.col("prefixo")).otherwise(
                (-1 - F.pmod("nu_terminal", F.lit(_SPREAD))).cast("int")
            ),
        )
        .alias("n")
    )
    p = wide.alias("p")
    inside = (
        (F.col("n.cn") == F.col("p.cn"))
        & (F.col("n.chave_prefixo") == F.col("p.prefixo"))
        & (F.col("p.faixa_inicial") <= F.col("n.nu_terminal"))
        & (F.col("p.faixa_final") >= F.col("n.nu_terminal"))
    )
    return n.join(p, inside, "left").select(
        "n.nu_terminal",
        "n.cn",
        "n.prefixo",
        F.coalesce("n._ponto", "p.cod_prestadora").alias("cod_prestadora"),
    )


def history_of(
    history: DataFrame, numbers: DataFrame, few_numbers: bool | None = None
) -> DataFrame:
    """A stored history without most rows that few numbers cannot need.

    A semi join on area-code range and number cuts the history down, and dynamic partition
    pruning keeps the other ranges from being read. ``few_numbers`` says that the numbers may
    be broadcast, as a caller knows who has them in a list; otherwise Spark decides, and where
    it estimates them above its own limit for broadcasts, the history stays as it is.
    """
    if "cn_bucket" not in history.columns or few_numbers is False:
        return history
    if few_numbers is None:
        spark = history.sparkSession
        limit = spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
        estimate = numbers._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
        if int(str(estimate)) > limit:
            return history
    # Numbers without an area code have no history. Pruning wants a plain comparison.
    wanted = numbers.where((F.col("nu_terminal") > 0) & (F.col("cn") >= 0)).select(
        F.col("nu_terminal").alias("tn_inicial"), cn_bucket("cn").alias("cn_bucket")
    )
    wanted = F.broadcast(wanted) if few_numbers else wanted
    return history.join(wanted, ["cn_bucket", "tn_inicial"], "left_semi")


def last_ported(history: DataFrame, dates: Mapping[str, date]) -> DataFrame:
    """Receiving carrier of every number at each date: one row per number.

    A history with intervals has one row of a number at a date, found by a filter; several
    dates share one pass. Without them the latest row up to the date is an aggregate, and
    each task keeps one row per number before the shuffle.
    """
    day = F.col("data_agendamento")
    if VALID_TO in history.columns:
        counts = {name: in_force(F.lit(d)) for name, d in dates.items()}
        some = reduce(Column.__or__, counts.values())
        rows = history.where((day <= F.lit(max(dates.values()))) & some)
        if len(dates) == 1:
            return rows.select("tn_inicial", F.col("cod_receptora").alias(*counts))
        return rows.groupBy("tn_inicial").agg(
            *[F.max(F.when(c, F.col("cod_receptora"))).alias(name) for name, c in counts.items()]
        )
    return (
        history.where(day <= F.lit(max(dates.values())))
        .groupBy("tn_inicial")
        .agg(
            *[
                F.max_by(
                    F.when(day <= F.lit(d), F.col("cod_receptora")),
                    F.when(day <= F.lit(d), day),
                ).alias(name)
                for name, d in dates.items()
            ]
        )
    )


def ported_carrier(
    numbers: DataFrame, history: DataFrame, dates: Mapping[str, date]
) -> DataFrame:
    """Distinct ``numbers`` with the receiving carrier at each date, or NULL.

    Both sides are unique and hash-partitioned on the number, so the join adds no
    shuffle. A number whose area code is not its first two digits has no history.
    """
    ported = last_ported(history, dates)
    joined = numbers.join(
        ported, numbers["nu_terminal"] == ported["tn_inicial"], "left"
    )
    _, own_area, _ = query_keys("nu_terminal", whole=True)
    eligible = (F.col("cn") >= 0) & (F.col("cn") == own_area)
    return joined.select(
        *numbers.columns, *[F.when(eligible, F.col(c)).alias(c) for c in dates]
    )


def _carrier_name(
    df: DataFrame, code: Column, carriers: DataFrame, name: str
) -> DataFrame:
    names = carriers.select(
        F.col("cod_prestadora").alias("_codigo"), F.col("nome_prestadora").alias(name)
    )
    return df.join(names, code.cast("bigint") == names["_codigo"], "left").drop(
        "_codigo"
    )


def resolve_carriers_at(
    numbers: DataFrame,
    history: DataFrame,
    plan: DataFrame,
    carriers: DataFrame,
    dates: Mapping[str, RefDate],
    columns: tuple[str, ...] = ("nu_terminal",),
    broadcast_limit: int = BROADCAST_LIMIT,
    few_numbers: bool | None = None,
) -> DataFrame:
    """Carrier of every distinct number at several named dates.

    ``dates`` maps a column suffix to a reference date. For each suffix the result
    has ``nome_prestadora<suffix>`` and ``ind_portado<suffix>``, next to
    ``nu_terminal`` and ``ind_designado``.
    """
    at = {f"_p{s}": parse_reference_date(d) for s, d in dates.items()}
    keyed = numbers_to_query(numbers, *columns)
    history = history_of(history, keyed, few_numbers)
    assigned = assigned_carrier(keyed, plan, broadcast_limit)
    result = ported_carrier(assigned, history, at)
    names = broadcast_if_small(carriers, broadcast_limit)
    for suffix in dates:
        code = F.coalesce(f"_p{suffix}", "cod_prestadora")
        result = _carrier_name(result, code, names, f"nome_prestadora{suffix}")
    out: list[Column] = [F.col("nu_terminal")]
    for suffix in dates:
        out.append(F.col(f"nome_prestadora{suffix}"))
        out.append(
            F.col(f"_p{suffix}").isNotNull().cast("int").alias(f"ind_portado{suffix}")
        )
    out.append(F.col("cod_prestadora").isNotNull().cast("int").alias("ind_designado"))
    return result.select(*out)


def resolve_carriers(
    numbers: DataFrame,
    history: DataFrame,
    plan: DataFrame,
    carriers: DataFrame,
    reference_date: RefDate = None,
    columns: tuple[str, ...] = ("nu_terminal",),
    broadcast_limit: int = BROADCAST_LIMIT,
    few_numbers: bool | None = None,
) -> DataFrame:
    """Carrier of every distinct number at one date (today by default).

    The receiving carrier of the last porting up to the date counts, else the
    carrier of the numbering plan. Columns: ``nu_terminal``, ``nome_prestadora``,
    ``ind_portado`` and ``ind_designado`` (0/1). ``few_numbers``: see ``history_of``.
    """
    return resolve_carriers_at(
        numbers, history, plan, carriers, {"": reference_date}, columns, broadcast_limit, few_numbers
    )


def carrier_change(
    numbers: DataFrame,
    history: DataFrame,
    plan: DataFrame,
    carriers: DataFrame,
    before: RefDate,
    after: RefDate,
) -> DataFrame:
    """Numbers whose carrier differs between two dates, from one pass over the history."""
    both = resolve_carriers_at(
        numbers, history, plan, carriers, {"_antes": before, "_depois": after}
    )
    changed = ~F.col("nome_prestadora_antes").eqNullSafe(F.col("nome_prestadora_depois"))
    return both.where(changed).select(
        "nu_terminal", "nome_prestadora_antes", "nome_prestadora_depois"
    )


def enrich_calls(
    calls: DataFrame,
    history: DataFrame,
    plan: DataFrame,
    carriers: DataFrame,
    origin: str,
    destination: str,
    reference_date: RefDate = None,
    broadcast_limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """Calls with ``operadora_origem`` and ``operadora_destino`` at one date.

    Every distinct number is resolved once and joined back to both sides.
    """
    resolved = resolve_carriers(
        calls,
        history,
        plan,
        carriers,
        reference_date,
        (origin, destination),
        broadcast_limit,
    ).select("nu_terminal", "nome_prestadora")
    result = calls
    for side, name in ((origin, "operadora_origem"), (destination, "operadora_destino")):
        keyed = result.withColumn("_nu", F.col(side).try_cast("bigint"))
        names = resolved.select(
            F.col("nu_terminal").alias("_nu"), F.col("nome_prestadora").alias(name)
        )
        result = _join_answers(keyed, names, ["_nu"])
    return result


def _join_answers(calls: DataFrame, answers: DataFrame, keys: list[str]) -> DataFrame:
    """Left join of calls with answers that are unique on ``keys``, number ``_nu`` first.

    A remainder of the number joins the key for the physical plan only: the answers are
    partitioned by number alone, so the longer key gives both sides an exchange of
    their own, and with that the adaptive skew join can split the calls of a hot number
    over many tasks. Calls without a number match nothing; a running number spreads them.
    """
    rest = F.col("_nu") % 97
    spread = F.coalesce(rest, F.monotonically_increasing_id() % 9973)
    joined = calls.withColumn("_resto", spread).join(
        answers.withColumn("_resto", rest), [*keys, "_resto"], "left"
    )
    return joined.drop(*keys, "_resto")


def asof_per_call(
    calls: DataFrame, history: DataFrame, number: str, day: str
) -> DataFrame:
    """Calls with ``cod_receptora`` of their number on their own day, or NULL.

    The calls are first reduced to distinct (number, day) pairs, so that a hot number
    weighs at most one row per calendar day. Pairs meet the intervals of their number in an
    equi-join; one of them at most holds the day. The answer joins back on number and day.
    """
    keyed = calls.withColumns(
        {"_nu": F.col(number).try_cast("bigint"), "_dia": F.col(day).cast("date")}
    )
    pairs = (
        keyed.select("_nu", "_dia")
        .where(F.col("_nu").isNotNull() & F.col("_dia").isNotNull())
        .distinct()
    )
    intervals = with_validity(history).select(
        "tn_inicial", "data_agendamento", VALID_TO, "cod_receptora"
    )
    of_number = F.col("_nu") == F.col("tn_inicial")
    answered = pairs.join(intervals, of_number & in_force(F.col("_dia"))).select(
        "_nu", "_dia", "cod_receptora"
    )
    return _join_answers(keyed, answered, ["_nu", "_dia"])
