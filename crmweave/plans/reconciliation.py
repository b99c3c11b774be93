"""Reconciliation of all object types: match, stage, log, count."""

from __future__ import annotations

import logging
import time
from collections.abc import Mapping
from datetime import datetime

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from crmweave.crm.staging import default_update_columns, staging_key
from crmweave.crm.target import OBJECT_ORDER, object_map, object_type_of
from crmweave.functions.keys import canonical_key
from crmweave.operators.crosswalk import LINK, crosswalk_of, unresolved_links
from crmweave.operators.reconcile import reconcile, rejected, run_stats, to_staging
from crmweave.sources.tables import touched_buckets, upsert_table
from crmweave.sources.writers import append_run_log
from crmweave.specs import ObjectMap

log = logging.getLogger(__name__)


def staging_path(staging_dir: str, object_type: str) -> str:
    return f"{staging_dir}/{object_type_of(object_type)}_reconciliation"


def reconcile_object(
    spark: SparkSession,
    legacy: DataFrame,
    target: DataFrame,
    mapping: ObjectMap,
    staging_dir: str,
    as_of: datetime | str,
    limit: int | None = None,
    mark_conflicts: bool = True,
    target_name: str = "target",
    crosswalks: Mapping[str, DataFrame] | None = None,
) -> dict[str, object]:
    """Reconcile one object type, upsert its staging table, log the run, return counts.

    The rows are counted while they are staged: one job reads, joins and writes. Only the buckets of the staging table
    that these ids fall into are rewritten. Links without a translation are stored beside the table.
    """
    kind = mapping.object_type
    started = time.monotonic()
    stats: dict[str, object] = {"object_type": kind}
    error = None
    try:
        if limit is not None:
            legacy = legacy.orderBy(mapping.legacy_id).limit(limit)
        rows = reconcile(legacy, target, mapping, mark_conflicts, crosswalks=crosswalks)
        links = [f for f in mapping.links if LINK + f.target in rows.columns]
        lost = [F.col(LINK + f.target).isNull() & canonical_key(f"leg_{f.legacy}").isNotNull() for f in links]
        seen = Observation()
        status = F.col("reconciliation_status")
        counted = rows.observe(
            seen,
            F.count(F.lit(1)).alias("total"),
            *(
                F.count(F.when(status == value, 1)).alias(name)
                for name, value in (
                    ("matched", "matched"), ("unmatched", "new"),
                    ("conflicts", "conflict"), ("errors", "error"),
                )
            ),
            *([F.coalesce(F.sum(sum(x.cast("long") for x in lost)), F.lit(0)).alias("unresolved_links")] if lost else []),
        )
        staged = to_staging(counted, kind, as_of, target=target_name)
        key = staging_key(kind)
        # Bronze rows have no order of arrival: of equal legacy ids one row is staged whole.
        ids = legacy.select(canonical_key(mapping.legacy_id).try_cast("bigint").alias(key))
        upsert_table(
            spark, staging_path(staging_dir, kind), staged, [key], default_update_columns(kind, target_name),
            touched=touched_buckets(ids, [key]),
        )
        if seen.get["errors"]:
            rejected(rows).write.mode("overwrite").parquet(f"{staging_path(staging_dir, kind)}_rejected")
        if links:
            unresolved_links(rows, mapping).write.mode("overwrite").parquet(f"{staging_path(staging_dir, kind)}_unresolved")
        stats |= seen.get
    except (PySparkException, ValueError) as failure:
        log.warning("reconciliation of %s failed: %s", kind, failure)
        error = str(failure).splitlines()[0]
        stats |= {"status": "failed", "error": error}
    elapsed = int((time.monotonic() - started) * 1000)
    when = as_of if isinstance(as_of, datetime) else datetime.fromisoformat(as_of)
    append_run_log(
        spark, f"{staging_dir}/reconciliation_log",
        [("reconcile", kind, None, None, "failed" if error else "success", error, elapsed, when)],
    )
    return stats


def reconcile_all(
    spark: SparkSession,
    legacy: Mapping[str, DataFrame],
    target: Mapping[str, DataFrame],
    staging_dir: str,
    as_of: datetime | str,
    limit_per_object: int | None = None,
    mappings: Mapping[str, ObjectMap] | None = None,
    **options: object,
) -> dict[str, dict[str, object]]:
    """Every object type in dependency order.  ``legacy`` and ``target`` are keyed by type.

    The crosswalk of each type is stored under ``crosswalk/`` and translates the links of the types after it. Links to a
    type whose crosswalk cannot be made are all unresolved, so no legacy id is written as one of the target.
    """
    results: dict[str, dict[str, object]] = {}
    crosswalks: dict[str, DataFrame] = {}
    for kind in OBJECT_ORDER:
        mapping = (mappings or {}).get(kind) or object_map(kind)
        if kind in legacy and kind in target:
            results[kind] = reconcile_object(
                spark, legacy[kind], target[kind], mapping, staging_dir, as_of, limit_per_object,
                crosswalks=dict(crosswalks), **options,
            )
        if kind in target:
            path = f"{staging_dir}/crosswalk/{kind}"
            try:
                crosswalk_of(target[kind], mapping).write.mode("overwrite").parquet(path)
                crosswalks[kind] = spark.read.parquet(path)
            except PySparkException as failure:
                log.warning("%s have no crosswalk: %s", kind, failure)
                crosswalks[kind] = spark.createDataFrame([], "legacy_key string, target_id long")
    return results


def all_run_stats(
    legacy: Mapping[str, DataFrame],
    target: Mapping[str, DataFrame],
    mappings: Mapping[str, ObjectMap] | None = None,
    mark_conflicts: bool = True,
) -> DataFrame:
    """The counts of all object types as one frame; nothing is staged."""
    result = None
    for kind in OBJECT_ORDER:
        if kind in legacy and kind in target:
            mapping = (mappings or {}).get(kind) or object_map(kind)
            row = run_stats(reconcile(legacy[kind], target[kind], mapping, mark_conflicts), kind)
            result = row if result is None else result.unionByName(row)
    return result
