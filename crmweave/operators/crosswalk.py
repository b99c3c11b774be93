"""Translation of foreign ids between the systems by the crosswalk ids that target rows carry.

A legacy row points at other objects by their legacy ids, a target row by target ids. The crosswalk of an object type
says which target id a legacy id has; a link is compared and written only after it has been translated.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crmweave.functions.keys import canonical_key
from crmweave.operators.lookup import left_lookup
from crmweave.specs import ObjectMap

LINK = "lnk_"


def crosswalk_of(target: DataFrame, mapping: ObjectMap) -> DataFrame:
    """legacy_key (canonical, once each) and target_id; of several rows with one id the lowest counts, as in ``reconcile``."""
    keyed = target.select(canonical_key(mapping.crosswalk).alias("legacy_key"), F.col(mapping.target_id).alias("target_id"))
    return keyed.where(F.col("legacy_key").isNotNull()).groupBy("legacy_key").agg(F.min("target_id").alias("target_id"))


def link_names(columns: list[str], mapping: ObjectMap, crosswalks: Mapping[str, DataFrame]) -> dict[str, str]:
    """Target property -> legacy column (with its prefix) of the links that can be translated."""
    return {
        f.target: f"leg_{f.legacy}" for f in mapping.links if f.refers in crosswalks and f"leg_{f.legacy}" in columns
    }


def translate_links(legacy: DataFrame, mapping: ObjectMap, crosswalks: Mapping[str, DataFrame]) -> DataFrame:
    """Add ``lnk_<property>``, the target id that each link stands for; NULL where the crosswalk has none.

    ``legacy`` has the mapped columns prefixed ``leg_``. The crosswalk has a row per id, so rows are neither lost nor
    repeated; an id that very many rows link to is split by adaptive execution.
    """
    refers = {f.target: f.refers for f in mapping.links}
    for name, column in link_names(legacy.columns, mapping, crosswalks).items():
        keyed = legacy.withColumn("__link", canonical_key(column))
        legacy = left_lookup(keyed, crosswalks[refers[name]], [("__link", "legacy_key")], {LINK + name: "target_id"}).drop("__link")
    return legacy


def link_report(reconciled: DataFrame, mapping: ObjectMap) -> DataFrame:
    """One row per reconciled row and translated link: what it links to in either system, and whether they agree.

    ``state`` is empty (no legacy link), unresolved (no target row carries that id), new (the row itself is not in the
    target), same or differs.
    """
    entries = []
    for f in mapping.links:
        if LINK + f.target not in reconciled.columns:
            continue
        here = f"tgt_{f.target}"
        present = F.col(here).try_cast("bigint") if here in reconciled.columns else F.lit(None).cast("bigint")
        link, translated = canonical_key(f"leg_{f.legacy}"), F.col(LINK + f.target)
        state = (
            F.when(link.isNull(), "empty").when(translated.isNull(), "unresolved").when(F.col("target_id").isNull(), "new")
            .when(translated.eqNullSafe(present), "same").otherwise("differs")
        )
        entries.append(
            F.struct(
                F.lit(f.target).alias("property"), link.alias("legacy_link"), translated.alias("translated"),
                present.alias("present"), state.alias("state"),
            )
        )
    if not entries:
        raise ValueError(f"{mapping.object_type} has no translated links")
    return reconciled.select(
        F.lit(mapping.object_type).alias("object_type"), "legacy_id", "legacy_key", "target_id", F.inline(F.array(*entries))
    )


def unresolved_links(reconciled: DataFrame, mapping: ObjectMap) -> DataFrame:
    """Links of legacy rows to objects that the target does not have, or has without their id."""
    return link_report(reconciled, mapping).where("state = 'unresolved'").select("object_type", "legacy_key", "property", "legacy_link")
