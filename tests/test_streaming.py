import random
import time

import pytest

from lexmesh.operators import clauses
from lexmesh.plans import standins
from lexmesh.streaming import clauses as stream_clauses
from lexmesh.streaming import ingest


def test_documents_arrive_once(spark, tmp_path):
    rows = spark.createDataFrame([("a", "x"), ("b", "y")], "file_path string, raw_text string")
    rows.write.parquet(str(tmp_path / "in"))
    stream = ingest.documents(spark, str(tmp_path / "in"), "file_path string, raw_text string")
    for _ in range(2):
        ingest.into(stream, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


@pytest.mark.parametrize("cuts", [[], [7], [1, 2, 3, 9, 14]])
def test_clauses_of_any_batches(spark, tmp_path, cuts):
    """The subject of an article is carried from batch to batch as from unit to unit."""
    rng = random.Random(len(cuts))
    tokens = [(f, t) for f, t in standins.TOKENS]
    rows = [(i % 3, i // 3, rng.choices(tokens, k=rng.randint(0, 60))) for i in range(18)]
    schema = "article long, unit_ord int, tokens array<struct<form: string, tag: string>>"
    folder = tmp_path / "units"
    for a, b in zip([0, *cuts], [*cuts, len(rows)], strict=True):
        spark.createDataFrame(rows[a:b], schema).coalesce(1).write.mode("append").parquet(str(folder))
        time.sleep(0.05)  # files are taken in the order of their times
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(folder))
    name = f"clauses{len(cuts)}"
    run = stream_clauses.extract(stream, ["article"]).writeStream.format("memory").queryName(name).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    run.awaitTermination(120)
    batch = clauses.extract(spark.createDataFrame(rows, schema), ["article"])
    got, want = (sorted(map(str, d.select(*sorted(batch.columns)).collect())) for d in (spark.table(name), batch))
    assert got == want and len(want) > 20 and any("INHERITED" in r for r in want)
