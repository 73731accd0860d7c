"""Building the stores: statutes to units, clauses, relations, entities, vertices, edges and vector documents."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import names as N
from ..operators import clauses, routing, structure, upserts, vectors


@dataclass
class Stores:
    documents: DataFrame
    entities: DataFrame
    relations: DataFrame
    vertices: DataFrame
    edges: DataFrame
    entity_docs: DataFrame
    relation_docs: DataFrame
    counters: DataFrame


#: A label's own column for the subtype.
SUBTYPES = ("category", "role_hint", "doc_type", "concept_type")


def build(documents: DataFrame, tokenize: Callable[[DataFrame], DataFrame], root_map: DataFrame, buckets: DataFrame, classifier: routing.Classifier = routing.silent, typer: routing.Typer = routing.unknown) -> Stores:
    """documents (file_path, source_law, raw_text) to all stores. tokenize adds `tokens` to rows with unit_text."""
    documents = documents.withColumn("id", N.stable_id(F.lit("document"), F.col("file_path")))
    units = structure.units(structure.paragraphs(structure.articles(documents.select("id", "file_path", "source_law", "raw_text")))).drop("raw_text", "article_body", "paragraph_text")
    units = tokenize(units).withColumn("place", F.struct("paragraph_ord", "unit_ord"))
    article = ["id", "article_ord"]
    facts = units.select("id", "article_ord", "place", "source_law", "article_no", "article_sub_no", "paragraph_no", F.trim("unit_text").alias("evidence_text"))
    raw = clauses.relations(clauses.extract(units.select(*article, "place", "tokens"), article, "place")).join(facts, [*article, "place"])
    resolved = routing.resolve(routing.route(raw, root_map, buckets), classifier)
    routed = resolved.filter("edge_type is not null").withColumnRenamed("id", "document_id")
    rows = routed.withColumns({"agent": N.resolve_alias(F.col("agent")), "patient": N.resolve_alias(F.col("patient"))})
    mentions = routing.type_mentions(rows.select(F.explode(F.array("agent", "patient")).alias("name")).distinct(), typer=typer)
    for end in ("agent", "patient"):
        if typer is routing.unknown:  # the rules alone: no need to join what they say
            rows = rows.withColumn(f"{end}_label", F.coalesce(N.entity_type(F.col(end)), N.default_type())["label"])
        else:  # each distinct mention is asked about once
            rows = rows.join(mentions.select(F.col("name").alias(end), F.col("label").alias(f"{end}_label")), end)
    entities = mentions.withColumn("id", N.stable_id(F.lit("entity"), F.col("label"), F.col("name")))
    linked = upserts.link_relations(rows, entities.select("id", "label", "name"))
    ident = N.stable_id(F.col("document_id"), F.col("article_ord"), F.to_json("place"), F.col("pos"))
    relations = linked.select(ident.alias("id"), "edge_type", F.col("agent_id").alias("src"), F.col("patient_id").alias("dst"), "document_id", "source_law", "article_no", "article_sub_no", "paragraph_no", "modality", "voice", "evidence_text", "extraction_method", "agent", "patient")
    c = F.col
    text = N.relation_description(c("source_law"), c("article_no"), c("paragraph_no"), c("agent"), c("edge_type"), c("patient"), c("modality"), c("voice"))
    entity_docs = vectors.embed(entities.withColumn("description", N.entity_description(c("name"), c("label"), c("subtype"))), "description")
    relation_docs = vectors.embed(relations.select("id", c("src").alias("source_entity_id"), c("dst").alias("target_entity_id"), text.alias("description")), "description")
    edges = relations.drop("evidence_text", "extraction_method", "agent", "patient", "document_id")
    counters = routing.build_counters(raw, resolved, entities)
    return Stores(documents, entities, relations, entities.select("id", "label", "name", "subtype"), edges, entity_docs, relation_docs, counters)


def reload(entities: DataFrame, relations: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Vertices, edges and both kinds of vector documents from the stored tables alone, without a build.

    entities (id, label, name, category, role_hint, doc_type, concept_type, ...) and relations (id, edge_type,
    source_entity_id, target_entity_id, source_law, article_no array, paragraph_no, modality, voice, ...). A
    relation without one of its entities is left out.
    """
    c = F.col
    named = entities.select("id", "label", "name", N.subtype(*(c(k) for k in SUBTYPES)).alias("subtype"))
    end = lambda side, to: named.select(c("id").alias(f"{side}_entity_id"), c("name").alias(to))
    rows = relations.join(end("source", "agent"), "source_entity_id").join(end("target", "patient"), "target_entity_id").withColumn("article_no", F.get("article_no", F.lit(0)))
    edges = rows.select("id", "edge_type", c("source_entity_id").alias("src"), c("target_entity_id").alias("dst"), "source_law", "article_no", "paragraph_no", "modality", "voice")
    text = N.relation_description(c("source_law"), c("article_no"), c("paragraph_no"), c("agent"), c("edge_type"), c("patient"), c("modality"), c("voice"))
    entity_docs = vectors.embed(named.withColumn("description", N.entity_description(c("name"), c("label"), c("subtype"))), "description")
    relation_docs = vectors.embed(rows.select("id", "source_entity_id", "target_entity_id", text.alias("description")), "description")
    return named, edges, entity_docs, relation_docs
