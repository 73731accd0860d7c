"""Edge types for questions and relations, and entity types for mentions.

What a model would answer is a pluggable classifier: a function on a batch of texts, run per worker over the
rows that the rules left open, and only over those. The default one never answers. A classifier that raises has
failed for its batch, whose rows then have no answer; NONE is an answer of its own, that there is no relation.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import clause_text, default_type, entity_type, resolve_alias, unused
from ..functions.vocab import EDGE_CATEGORIES, EDGE_TYPES, KEYWORDS, NODE_LABELS

Classifier = Callable[[list[str], list[list[str]]], list[str | None]]
#: From names to (label, subtype), None where it doesn't know.
Typer = Callable[[list[str]], list[tuple[str, str | None] | None]]
BATCH = 50
NONE = "NONE"


def silent(texts: list[str], candidates: list[list[str]]) -> list[str | None]:
    return [None] * len(texts)


def unknown(names: list[str]) -> list[tuple[str, str | None] | None]:
    return [None] * len(names)


def keyword_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(k, t) for k, types in KEYWORDS.items() for t in types], "keyword string, edge_type string")


def category_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(k, t) for k, types in EDGE_CATEGORIES.items() for t in types], "category string, edge_type string")


def hinted_types(question: Column) -> Column:
    """Sorted distinct edge types of all keywords that the question contains, or null."""
    hits = F.array(*(F.when(F.contains(question, F.lit(k)), F.array(*map(F.lit, types))) for k, types in KEYWORDS.items()))
    return _sorted_types(hits)


def _sorted_types(groups: Column) -> Column:
    """Sorted distinct members of an array of arrays, null if there is none; computed once."""
    every = F.array_sort(F.array_distinct(F.flatten(F.array_compact(groups))))
    return F.get(F.filter(F.array(every), lambda x: F.size(x) > 0), F.lit(0))


def category_types(categories: Column) -> Column:
    """Sorted member types of the chosen categories; unknown ones count for nothing, none gives null."""
    table = F.create_map(*(x for k, types in EDGE_CATEGORIES.items() for x in (F.lit(k), F.array(*map(F.lit, types)))))
    return _sorted_types(F.transform(categories, lambda c: F.try_element_at(table, c)))


def refined(candidates: Column, answer: Column) -> Column:
    """The answer's types that are candidates, in its order; the candidates if that leaves none or there is no answer."""
    kept = F.array_intersect(answer, candidates)
    return F.when(F.size(kept) > 0, kept).otherwise(candidates)


def _in_batches(ask_batch: Callable[[int, int], list], n: int) -> list:
    """Answers in batches of BATCH; a batch that raises, or answers another number of rows, has none."""
    out: list = []
    for i in range(0, n, BATCH):
        size = min(BATCH, n - i)
        try:
            got = list(ask_batch(i, i + size))
        except Exception:  # noqa: BLE001 - whatever a model raises is a failure of its batch
            got = []
        out += got if len(got) == size else [None] * size
    return out


def ask(rows: DataFrame, text: str, candidates: str, to: str, classifier: Classifier = silent) -> DataFrame:
    """Adds the classifier's answer, null where it gives none, one that isn't a candidate, or fails."""

    @F.pandas_udf("string")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, options in batches:
            every = [list(o) for o in options]
            answers = _in_batches(lambda i, j: classifier(texts[i:j].tolist(), every[i:j]), len(texts))  # noqa: B023
            yield pd.Series([a if a in o else None for a, o in zip(answers, every, strict=True)], dtype=object)

    return rows.withColumn(to, run(text, candidates))


def route(relations: DataFrame, root_map: DataFrame, buckets: DataFrame) -> DataFrame:
    """relations with the mapped type and a route: mapped, needs_context, ambiguous, non_action or unmapped.

    root_map (verb_root, mapped, alternatives, needs_context) and buckets (verb_root, bucket) are dimensions,
    joined as the planner sees fit. What may be answered is the mapped type and its alternatives where the context
    decides, and any type or NONE else.
    """
    rows = relations.join(root_map, "verb_root", "left").join(buckets, "verb_root", "left")
    way = (
        F.when(F.col("mapped").isNotNull() & ~F.coalesce("needs_context", F.lit(False)), "mapped")
        .when(F.col("mapped").isNotNull(), "needs_context")
        .when(F.col("bucket") == "AMBIGUOUS", "ambiguous")
        .when(F.col("bucket").isin("REF", "DEF", "STATIVE"), "non_action")
        .otherwise("unmapped")
    )
    every = F.array(*map(F.lit, [*EDGE_TYPES, NONE]))
    options = F.when(way == "needs_context", F.array_distinct(F.concat(F.array("mapped"), F.coalesce("alternatives", F.array().cast("array<string>"))))).otherwise(every)
    return rows.withColumns({"route": way, "candidates": options})


def question_text(routed: DataFrame) -> Column:
    """What a classifier is asked about a relation: its clause as text."""
    has = lambda c: F.col(c) if c in routed.columns else F.lit(None).cast("string")
    return clause_text(has("agent"), F.coalesce(has("verb_lemma"), F.concat("verb_root", F.lit("다"))), has("patient"), has("evidence_text"))


def resolve(routed: DataFrame, classifier: Classifier = silent, text: str | None = None, asking: Callable[..., DataFrame] = ask) -> DataFrame:
    """routed with edge_type, extraction_method and counters; rows that are dropped have a null edge_type.

    The classifier is asked with the clause's text, or with the column `text`; asking is how, such as `answers.Answers.ask`.
    A row counts in every one of its
    counters: a mapped type that stands in for a missing answer is a rule and a fallback.
    """
    asked = F.col(text) if text else question_text(routed)
    ruled = routed.filter(F.col("route").isin("mapped", "non_action")).withColumn("answer", F.lit(None).cast("string"))
    open_ = asking(routed.filter(~F.col("route").isin("mapped", "non_action")).withColumn("_asked", asked), "_asked", "candidates", "answer", classifier).drop("_asked")
    rows = ruled.unionByName(open_)
    way, answer = F.col("route"), F.col("answer")
    fallback = (way == "needs_context") & answer.isNull()
    given = answer.isNotNull() & (answer != NONE)
    return rows.withColumns({
        "edge_type": F.when((way == "mapped") | fallback, F.col("mapped")).when((way != "non_action") & given, answer),
        "extraction_method": F.when((way == "mapped") | fallback, "rule").when((way != "non_action") & given, "llm_disambiguation"),
        "counters": F.when(way == "mapped", F.array(F.lit("rule"))).when(way == "non_action", F.array(F.lit("skipped_non_action_root"))).when(fallback, F.array(F.lit("rule"), F.lit("llm_disambiguation_fallback"))).when(answer.isNull(), F.array(F.lit("skipped_llm_disambiguation_failed"))).when(answer == NONE, F.array(F.lit("skipped_llm_none"))).when(way == "unmapped", F.array(F.lit("llm_disambiguation_unmapped_root"))).otherwise(F.array(F.lit("llm_disambiguation"))),
    })


def build_counters(raw: DataFrame, resolved: DataFrame, entities: DataFrame) -> DataFrame:
    """(counter, n) of a build: raw relations, those that stay, entities, and how each was resolved."""
    total = lambda rows, name: rows.agg(F.count("*").alias("n")).select(F.lit(name).alias("counter"), "n")
    each = resolved.select(F.explode("counters").alias("counter")).groupBy("counter").agg(F.count("*").alias("n"))
    return total(raw, "raw_svo_records_with_both_endpoints").unionByName(total(resolved.filter("edge_type is not null"), "relations_total")).unionByName(total(entities, "entities_total")).unionByName(each)


def type_mentions(mentions: DataFrame, name: str = "name", typer: Typer = unknown) -> DataFrame:
    """mentions with label, subtype and method: the rules on the resolved name, then the typer on the name itself, or the default.

    The typer sees each distinct name that the rules leave open once; a label of its that isn't one of the closed set
    is no answer. Columns of mentions that have the names of the new ones are replaced.
    """

    @F.pandas_udf("struct<label: string, subtype: string, method: string>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for names in batches:
            wanted = names.tolist()
            out: list = [(None, None, None)] * len(wanted)
            for k, got in enumerate(_in_batches(lambda i, j: typer(wanted[i:j]), len(wanted))):  # noqa: B023
                if got is not None and got[0] in NODE_LABELS:
                    out[k] = (got[0], got[1], "llm")
            yield pd.DataFrame(out, columns=["label", "subtype", "method"])

    kept = [c for c in mentions.columns if c not in ("label", "subtype", "method")]
    resolved, kind, answer = unused(mentions.columns, "resolved", "kind", "answer")
    # a column of its own, so that the name is resolved once a row however often the rules look at it
    ruled = mentions.withColumn(resolved, resolve_alias(F.col(name))).withColumn(kind, entity_type(F.col(resolved))).drop(resolved)
    if typer is not unknown:
        asked = ruled.filter(F.col(kind).isNull() & F.col(name).isNotNull()).select(name).distinct()
        answers = asked.withColumn(answer, run(F.col(name))).filter(F.col(answer)["label"].isNotNull())
        ruled = ruled.join(answers, name, "left").withColumn(kind, F.coalesce(kind, answer))
    return ruled.withColumn(kind, F.coalesce(kind, default_type())).select(*kept, f"{kind}.label", f"{kind}.subtype", f"{kind}.method")
