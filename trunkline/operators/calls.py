"""Call records: normalising both numbers of every call."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trunkline.functions.normalize import ColumnOrName, normalize_number_pair


def normalize_calls(
    calls: DataFrame,
    number_a: str,
    number_b: str,
    national_destination_code: ColumnOrName = "",
) -> DataFrame:
    """Calls with ``<a>_norm``, ``<a>_valid``, ``<b>_norm``, ``<b>_valid`` and ``ambos_validos``."""
    pair = normalize_number_pair(number_a, number_b, national_destination_code)
    return (
        calls.withColumn("_par", pair)
        .withColumns(
            {
                f"{number_a}_norm": F.col("_par.number_a"),
                f"{number_a}_valid": F.col("_par.valid_a"),
                f"{number_b}_norm": F.col("_par.number_b"),
                f"{number_b}_valid": F.col("_par.valid_b"),
                "ambos_validos": F.col("_par.valid_a") & F.col("_par.valid_b"),
            }
        )
        .drop("_par")
    )
