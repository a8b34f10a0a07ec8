"""The stored portability history: bucketed versions, their manifest, and the merge.

A version is a folder of files partitioned by area-code range and bucketed and sorted by
number. The first version holds all rows. A merge adds a small version with the rows that it
changes and rewrites no older file; after some merges all versions are compacted into one. A
manifest names the versions that count. It is replaced by one rename, so a failure at any
point leaves the table as it was, or as it was to become.

Rows carry the interval of days in which they count, so a lookup at a date is a filter. The
buckets let lookups and merges join on the number without a shuffle of the history.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trunkline.functions.keys import cn_bucket
from trunkline.operators.history import upsert_history
from trunkline.operators.validity import VALID_FROM, VALID_TO, with_validity
from trunkline.schemas import HISTORY
from trunkline.sources.tables import (
    drop_table,
    materialized,
    read_current,
    switch_current,
    table_exists,
)

#: Rows for which one bucket is kept, and the least number of buckets.
ROWS_PER_BUCKET, LEAST_BUCKETS = 2_000_000, 8
#: Versions up to which merges only add one; the next merge compacts them.
MOST_VERSIONS = 8
_COLUMNS = [*HISTORY.fieldNames(), VALID_TO]
_KEY = ["tn_inicial", VALID_FROM]


@dataclass(frozen=True)
class Manifest:
    """Versions in order, later ones above earlier ones, and those of the state before."""

    buckets: int
    rows: dict[str, int]
    replaced: list[str] = field(default_factory=list)

    @property
    def versions(self) -> list[str]:
        return list(self.rows)


def read_manifest(spark: SparkSession, path: str) -> Manifest | None:
    text = read_current(spark, path)
    return Manifest(**json.loads(text)) if text else None


def _replace_manifest(spark: SparkSession, path: str, old: Manifest | None, new: Manifest) -> None:
    """Make ``new`` the table. Folders that left it one state ago stay for running readers."""
    switch_current(spark, path, json.dumps(asdict(new)))
    if old:
        used = {*new.versions, *new.replaced}
        for version in {*old.versions, *old.replaced} - used:
            drop_table(spark, f"{path}/versao={version}")


def _new_version(old: Manifest | None) -> str:
    """A name that sorts after all that are in use."""
    last = max((int(v.split("-")[0]) for v in old.versions + old.replaced), default=0) if old else 0
    return f"{last + 1:08d}-{uuid.uuid4().hex[:12]}"


def _write_version(rows: DataFrame, path: str, version: str, buckets: int) -> int:
    """Write rows as a version: one task a bucket, one file a bucket and area-code range.

    Rows without intervals get them. Buckets hold whole numbers, so one shuffle serves both.
    """
    spark = rows.sparkSession
    folder, name = f"{path}/versao={version}", f"gravacao_{uuid.uuid4().hex}"
    (
        with_validity(rows.repartition(buckets, "tn_inicial"))
        .select(*_COLUMNS, cn_bucket("cn").alias("cn_bucket"))
        .write.format("parquet")
        .partitionBy("cn_bucket")
        .bucketBy(buckets, "tn_inicial")
        .sortBy(*_KEY)
        .option("path", folder)
        .saveAsTable(name)
    )
    spark.sql(f"drop table {name}")  # its files stay
    return spark.read.schema(HISTORY).parquet(folder).count()  # no file if there is no row


def _empty(spark: SparkSession) -> DataFrame:
    rows = spark.createDataFrame([], HISTORY)
    return with_validity(rows).withColumn("cn_bucket", cn_bucket("cn"))


def _open(spark: SparkSession, path: str, manifest: Manifest) -> DataFrame:
    """All rows of the versions that count.

    Only a catalog entry tells Spark of buckets in a folder. Its name stands for the state of
    the table, so a session has one entry a state, and lists the files once.
    """
    state = json.dumps([path, asdict(manifest)])
    name = f"historico_{hashlib.md5(state.encode()).hexdigest()}"
    types = {f.name: f.dataType.simpleString() for f in HISTORY.fields} | {VALID_TO: "date"}
    columns = ", ".join(f"{c} {types[c]}" for c in _COLUMNS)
    location = path.replace("\\", "\\\\").replace("'", "\\'")
    if spark.catalog.tableExists(name):
        return spark.table(name).where(F.col("versao").isin(manifest.versions))
    spark.sql(
        f"create table {name} ({columns}, versao string, cn_bucket string) "
        f"using parquet partitioned by (versao, cn_bucket) clustered by (tn_inicial) "
        f"sorted by ({', '.join(_KEY)}) into {manifest.buckets} buckets location '{location}'"
    )
    spark.sql(f"msck repair table {name}")  # finds the folders of the partitions
    return spark.table(name).where(F.col("versao").isin(manifest.versions))


def _read(spark: SparkSession, path: str, manifest: Manifest | None) -> DataFrame:
    if manifest is None:
        return _empty(spark).select(*_COLUMNS, "cn_bucket")
    rows = _open(spark, path, manifest)
    if len(manifest.rows) > 1:
        # Of equal keys the latest version counts. Buckets hold whole numbers, so the
        # aggregate needs no shuffle, and columns that nobody asks for are not read.
        order = F.split("versao", "-")[0].cast("int")
        others = [c for c in _COLUMNS if c not in _KEY]
        rows = rows.groupBy(*_KEY, "cn_bucket").agg(
            *[F.max_by(c, order).alias(c) for c in others]
        )
    return rows.select(*_COLUMNS, "cn_bucket")


def is_complete(spark: SparkSession, path: str, manifest: Manifest) -> bool:
    """Whether all versions of an earlier state are still there."""
    return all(table_exists(spark, f"{path}/versao={v}") for v in manifest.versions)


def read_history(
    spark: SparkSession, path: str, manifest: Manifest | None = None
) -> DataFrame:
    """The history with ``valido_ate`` and its partition column ``cn_bucket``.

    ``manifest``: an earlier state of the table instead of the current one.
    """
    return _read(spark, path, manifest or read_manifest(spark, path))


def compact_history(spark: SparkSession, path: str) -> None:
    """Rewrite all versions as one, with as many buckets as its rows want."""
    old = read_manifest(spark, path)
    if old is not None and len(old.rows) > 1:
        _write_base(spark, path, old, _read(spark, path, old), sum(old.rows.values()))


def _write_base(
    spark: SparkSession, path: str, old: Manifest | None, rows: DataFrame, expected: int
) -> None:
    version = _new_version(old)
    buckets = max(LEAST_BUCKETS, -(-expected // ROWS_PER_BUCKET))
    n = _write_version(rows, path, version, buckets)
    _replace_manifest(
        spark, path, old, Manifest(buckets, {version: n}, old.versions if old else [])
    )


def merge_history(
    spark: SparkSession, batch: DataFrame, path: str, rebuild: bool = False
) -> None:
    """Upsert a deduplicated batch into the history table, or replace the table by it.

    The batch, and the stored rows of its numbers, are written once to the shared folder, as
    several steps use them. What the merge adds are rows that are new or changed, those
    among them whose interval now ends at a new porting. A batch that changes nothing adds
    nothing, so a replay is harmless. A batch of half the table or more makes a new base
    instead, and so does the merge after ``MOST_VERSIONS``. One merge runs at a time.
    """
    old = read_manifest(spark, path)
    with materialized(batch.select(HISTORY.fieldNames()), "batch") as fresh:
        n = fresh.count()
        if not n and not rebuild:
            return
        stored = sum(old.rows.values()) if old else 0
        if rebuild or 2 * n >= stored:
            rows = fresh
            if old and not rebuild:
                rows = upsert_history(_read(spark, path, old), fresh)
            _write_base(spark, path, old, rows, n if rebuild else n + stored)
            return
        numbers = fresh.select("tn_inicial").distinct()
        mine = _read(spark, path, old).join(numbers, "tn_inicial", "left_semi")
        with materialized(mine.select(_COLUMNS), "touched") as before:
            after = with_validity(upsert_history(before, fresh)).alias("a")
            same = F.lit(True)
            for c in _COLUMNS:
                same = same & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
            changed = after.join(before.alias("b"), same, "left_anti")
            version = _new_version(old)
            added = _write_version(changed, path, version, old.buckets)
        new = Manifest(old.buckets, {**old.rows, version: added}, old.versions)
        if not added:
            drop_table(spark, f"{path}/versao={version}")
            return
        _replace_manifest(spark, path, old, new)
    if len(new.rows) > MOST_VERSIONS:
        compact_history(spark, path)
