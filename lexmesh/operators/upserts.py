"""Upserts, get-or-create and merges as set operations that return the new snapshot of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.names import resolve_alias, stable_id
from ..sources import sinks

EVIDENCE = 2000


def upsert_documents(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """One row per file_path: a known path keeps its id and other columns and takes the new raw_text."""
    new = incoming.withColumn("id", stable_id(F.lit("document"), F.col("file_path")))
    old = existing.select(*(F.col(c).alias(f"old_{c}") for c in existing.columns))
    rows = old.join(new, F.col("old_file_path") == F.col("file_path"), "full_outer")
    known = F.col("old_file_path").isNotNull()
    column = lambda c: (F.coalesce(F.col(c), F.col(f"old_{c}")) if c == "raw_text" else F.when(known, F.col(f"old_{c}")).otherwise(F.col(c))).alias(c)
    return rows.select(*(column(c) for c in existing.columns))


def get_or_create(existing: DataFrame, mentions: DataFrame) -> DataFrame:
    """existing (id, label, name) with the (label, name) pairs of mentions that it lacks."""
    fresh = mentions.select("label", "name").distinct().join(existing.select("label", "name"), ["label", "name"], "left_anti")
    return existing.select("id", "label", "name").unionByName(fresh.select(stable_id(F.lit("entity"), F.col("label"), F.col("name")).alias("id"), "label", "name"))


def link_relations(relations: DataFrame, entities: DataFrame) -> DataFrame:
    """relations (agent, agent_label, patient, patient_label, ...) with the ids of both ends, evidence cut."""
    end = lambda side: entities.select(F.col("id").alias(f"{side}_id"), F.col("label").alias(f"{side}_label"), F.col("name").alias(side))
    return relations.join(end("agent"), ["agent", "agent_label"]).join(end("patient"), ["patient", "patient_label"]).withColumn("evidence_text", F.substring("evidence_text", 1, EVIDENCE))


def merge_map(entities: DataFrame) -> DataFrame:
    """(id, label, name, resolved, target, action): entities whose alias resolves to another name.

    The target is the entity of that label and name, or else the first of the variants, which is renamed.
    """
    firsts = entities.groupBy("label", "name").agg(F.min("id").alias("first"))
    # a name that another resolves to resolves to itself, so it stands among its variants
    same = Window.partitionBy("label", "resolved")
    least = lambda which: F.min(F.when(which, F.col("first"))).over(same)
    target = F.coalesce(least(F.col("name") == F.col("resolved")), least(F.col("name") != F.col("resolved")))
    named = firsts.withColumn("resolved", resolve_alias(F.col("name"))).withColumn("target", target)
    # as many as there are fillers and aliases of canonical names, for each label; a filter on nulls would be pushed down to every entity
    other = F.coalesce(F.col("resolved") != F.col("name"), F.lit(False))
    targets = F.broadcast(named.filter(other).select("label", "name", "resolved", "target"))
    moved = entities.join(targets, ["label", "name"])
    return moved.select("id", "label", "name", "resolved", "target", F.when(F.col("target") == F.col("id"), "rename").otherwise("merge").alias("action"))


def merge_entities(entities: DataFrame, merges: DataFrame) -> DataFrame:
    """The entities that stay, renamed where they stand for their variants."""
    rows = entities.join(merges.select("id", "resolved", "action"), "id", "left").filter("action is null or action = 'rename'")
    return rows.select("id", "label", F.coalesce("resolved", "name").alias("name"))


def repoint(relations: DataFrame, merges: DataFrame, *columns: str) -> DataFrame:
    """relations whose end columns name merged entities point to the targets."""
    to = merges.filter("action = 'merge'").select(F.col("id").alias("_from"), F.col("target").alias("_to"))
    for c in columns:
        relations = relations.join(to, F.col(c) == F.col("_from"), "left").withColumn(c, F.coalesce("_to", c)).drop("_from", "_to")
    return relations


def merge_report(merges: DataFrame, relations: DataFrame, *columns: str) -> DataFrame:
    """(action, n): entities renamed and merged, and the ends of relations that are repointed."""
    path = sinks.shared_folder(merges.sparkSession)
    sinks.snapshot(merges.select("id", "action"), path)  # found once, not again for each count
    merges = merges.sparkSession.read.parquet(path)
    moved = merges.filter("action = 'merge'").select("id")
    ends = relations.select(F.explode(F.array(*(F.col(c) for c in columns))).alias("id")).join(moved, "id", "left_semi")
    return merges.groupBy("action").agg(F.count("*").alias("n")).unionByName(ends.agg(F.count("*").alias("n")).select(F.lit("repointed").alias("action"), "n"))


def upsert_nodes(existing: DataFrame, incoming: DataFrame, order: str | None = None) -> DataFrame:
    """One row per id: columns of the incoming row where it has a value; of several rows of an id the last in order that has one."""
    columns = [c for c in existing.columns if c != "id"]
    if order:
        last = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c)
        incoming = incoming.groupBy("id").agg(*map(last, columns))
    old = existing.select("id", *(F.col(c).alias(f"old_{c}") for c in columns))
    rows = old.join(incoming, "id", "full_outer")
    return rows.select("id", *(F.coalesce(F.col(c), F.col(f"old_{c}")).alias(c) for c in columns))


def merge_edges(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Edges by id: known ones stay as they are, parallel ones too."""
    fresh = incoming.join(existing.select("id"), "id", "left_anti")
    return existing.unionByName(fresh.dropDuplicates(["id"]))
