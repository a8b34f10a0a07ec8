"""How long each porting counts: the history as intervals of days."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

VALID_FROM = "data_agendamento"
#: The first day on which a porting no longer counts; NULL while it is the last one.
VALID_TO = "valido_ate"
_NO_END = date(9999, 12, 31)


def with_validity(history: DataFrame) -> DataFrame:
    """``history`` with ``valido_ate``, the day of the number's next porting.

    A history that has the column, as the stored one does, is given back as it is.
    """
    if VALID_TO in history.columns:
        return history
    following = Window.partitionBy("tn_inicial").orderBy(VALID_FROM)
    return history.withColumn(VALID_TO, F.lead(VALID_FROM).over(following))


def in_force(day: Column) -> Column:
    """Whether a porting counts on a day. One row of a number at most does."""
    return (F.col(VALID_FROM) <= day) & (day < F.coalesce(VALID_TO, F.lit(_NO_END)))


def carrier_changes(
    history: DataFrame, first: date, last: date, arrived: DataFrame | None = None
) -> DataFrame:
    """Portings between two days, both included, with the receiving carrier before them.

    One row for each number and day on which the number moved to another carrier, over the
    whole history: ``tn_inicial, data_agendamento, cod_anterior, cod_receptora``. Of a number's
    first porting the carrier before is the donor, where one is known; -1 stands for an
    unknown one. A row that names the same carrier again is no change.

    ``arrived``: the numbers (``tn_inicial``) of newly merged batches, to ask for changes of
    these alone.
    """
    rows = with_validity(history)
    if arrived is not None:
        rows = rows.join(arrived.select("tn_inicial").distinct(), "tn_inicial", "left_semi")
    # The row before a change ends on the day of it, so both lie in the window's rows.
    near = rows.where(
        (F.col(VALID_FROM) <= F.lit(last)) & (F.coalesce(VALID_TO, F.lit(_NO_END)) >= F.lit(first))
    )
    in_order = Window.partitionBy("tn_inicial").orderBy(VALID_FROM)
    before = F.lag(F.struct("cod_receptora")).over(in_order)
    earlier = F.when(F.col("_antes").isNull(), F.col("cod_doadora")).otherwise(
        F.col("_antes.cod_receptora")
    )
    return (
        near.withColumn("_antes", before)
        .where(F.col(VALID_FROM) >= F.lit(first))
        .withColumn("cod_anterior", earlier)
        .where(~F.col("cod_anterior").eqNullSafe(F.col("cod_receptora")))
        .select("tn_inicial", VALID_FROM, "cod_anterior", "cod_receptora")
    )
