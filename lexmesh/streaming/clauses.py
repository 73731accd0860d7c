"""Clauses of a stream of units: the subject that an article hands on is state between batches."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.names import extract_root
from ..operators.clauses import assigned, hands, records

_FOUND = "array<array<struct<pos: int, verb_lemma: string, voice: string, modality: string, subj: string, topic: string, obj: string, by_agent: string>>>"


def extract(units: DataFrame, article: Sequence[str], unit: str = "unit_ord") -> DataFrame:
    """As operators.clauses.extract, of a stream whose units of an article arrive in order, in whatever batches.

    The state of an article is the agent it hands on, if it has one: a row each, whatever the number of its units.
    Verb phrases are found before and agents assigned behind the state, in built-in functions.
    """
    keys = [*article, unit]
    found = records(F.col("tokens"))
    rows = units.select(*keys, found.alias("found")).select(*keys, F.to_json("found").alias("found"), hands(F.col("found")).isNotNull().alias("hands"), hands(F.col("found"))["agent"].alias("handed"))
    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keys).schema)

    def carry(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        inherited = state.get[0] if state.exists else None
        every = pd.concat(list(batches)).sort_values(unit, kind="stable")
        taken = []
        for gives, agent in zip(every["hands"], every["handed"], strict=True):
            taken.append(inherited)
            inherited = agent if gives else inherited
        state.update((inherited,))
        yield every.assign(inherited=pd.Series(taken, index=every.index, dtype=object))[[*keys, "found", "inherited"]]

    carried = rows.groupBy(*article).applyInPandasWithState(carry, f"{kind}, found string, inherited string", "agent string", "append", GroupStateTimeout.NoTimeout)
    each = carried.select(*keys, F.explode(assigned(F.from_json("found", _FOUND), F.col("inherited"))).alias("r")).select(*keys, "r.*")
    return each.withColumn("verb_root", extract_root(F.col("verb_lemma")))
