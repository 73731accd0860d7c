"""Keyed tables: merges touch the buckets of new keys alone, and a failed merge leaves the version before."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lexmesh.operators import upserts
from lexmesh.sources import keyed


def files(table):
    """Data files with what tells whether they were rewritten."""
    return {str(p): (p.stat().st_size, p.stat().st_mtime_ns) for p in Path(table.path, "data").rglob("*.parquet")}


@pytest.fixture
def nodes(spark, tmp_path):
    rows = spark.range(2000).select(F.col("id").cast("string").alias("id"), F.lit("Concept").alias("label"), F.concat(F.lit("n"), "id").alias("name"))
    return keyed.create(rows, str(tmp_path / "t"), "id", buckets=32)


def test_a_merge_leaves_other_buckets(spark, nodes):
    before = files(nodes)
    new = spark.createDataFrame([("7", None, "seven"), ("new", "Person", "x")], "id string, label string, name string")
    after = nodes.merge(new, upserts.upsert_nodes)
    touched = {r[0] for r in new.select(nodes.place()).collect()}
    assert {p: x for p, x in files(after).items() if p in before} == before
    added = set(files(after)) - set(before)
    assert {int(p.split("bucket=")[1].split("/")[0]) for p in added} == touched and len(touched) <= 2
    got = {r.id: (r.label, r.name) for r in after.read().collect()}
    assert len(got) == 2001 and got["7"] == ("Concept", "seven") and got["new"] == ("Person", "x") and got["8"] == ("Concept", "n8")
    assert after.version == 1 and {b for b, v in after.held_by.items() if v == 1} == touched
    again = keyed.open_table(spark, nodes.path)
    assert again == after and keyed.open_table(spark, nodes.path, 0).read().count() == 2000


def test_a_failed_merge_leaves_the_version_before(spark, nodes):
    new = spark.createDataFrame([("7", None, "seven")], "id string, label string, name string")
    broken = lambda old, incoming: upserts.upsert_nodes(old, incoming).withColumn("name", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        nodes.merge(new, broken)
    with pytest.raises(ValueError, match="other keys"):
        nodes.merge(new, lambda old, incoming: nodes.read())
    assert keyed.open_table(spark, nodes.path) == nodes
    assert {r.id: r.name for r in nodes.read().collect()}["7"] == "n7"
    assert {r.id: r.name for r in nodes.merge(new, upserts.upsert_nodes).read().collect()}["7"] == "seven"  # what was left behind is overwritten


def test_emptied_buckets_and_empty_tables(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    table = keyed.create(rows, str(tmp_path / "t"), "k", buckets=4)
    gone = table.merge(rows.filter("k = 'a'"), lambda old, new: old.join(new, "k", "left_anti"))
    assert [tuple(r) for r in gone.read().collect()] == [("b", 2)]
    none = keyed.create(rows.filter("1 = 0"), str(tmp_path / "e"), "k")
    assert none.read().count() == 0 and none.merge(rows, lambda old, new: new).read().count() == 2
    assert none.merge(rows.filter("1 = 0"), lambda old, new: new) == none
    with pytest.raises(ValueError, match="bucket"):
        keyed.create(rows.withColumn("Bucket", F.lit(1)), str(tmp_path / "b"), "k")


@pytest.mark.parametrize("at_once", [5_000_000, 600])
def test_added_rows_lie_beside_what_is_there(spark, nodes, at_once, monkeypatch):
    """As upserts.merge_edges gives it, in one round or three, but no row is written again, and a second time nothing is."""
    monkeypatch.setattr(keyed, "ROUND_ROWS", at_once)
    new = spark.createDataFrame([("7", "Person", "seven"), ("new", "Person", "x"), ("new", "Person", "x"), ("2001", None, "y")], "id string, label string, name string")
    before = files(nodes)
    once = nodes.add(new)
    want = sorted(map(str, upserts.merge_edges(nodes.read(), new).collect()))
    assert sorted(map(str, once.read().collect())) == want and len(want) == 2002
    assert {p: x for p, x in files(once).items() if p in before} == before
    added = spark.read.parquet(*(set(files(once)) - set(before)))
    assert sorted(r.id for r in added.collect()) == ["2001", "new"]
    assert once.version == 1 and once.held_by == nodes.held_by and sum(map(len, once.added.values())) in (1, 2)
    assert once.add(new) == once and keyed.open_table(spark, nodes.path) == once
    assert keyed.open_table(spark, nodes.path, 0).read().count() == 2000
    later = once.merge(new.filter("id = 'new'"), lambda old, incoming: old.withColumn("name", F.upper("name")))  # of all versions of its bucket
    got = {r.id: r.name for r in later.read().collect()}
    assert len(got) == 2002 and got["new"] == "X" and got["2001"] in ("y", "Y")
    assert not set(later.added) & {b for b, v in later.held_by.items() if v == 2}
    assert keyed.open_table(spark, nodes.path) == later and keyed.open_table(spark, nodes.path, 1) == once
    empty = keyed.create(nodes.read().filter("1 = 0"), f"{nodes.path}-empty", "id").add(new)
    assert empty.read().count() == 3 and not empty.added


def test_last_row_of_an_id_wins(spark):
    old = spark.createDataFrame([("1", "A", "x"), ("2", "B", "y")], "id string, label string, name string")
    new = spark.createDataFrame([("1", None, "first", 1), ("1", "C", None, 2), ("1", None, "last", 3), ("3", "D", "z", 1)], "id string, label string, name string, at int")
    got = {r.id: (r.label, r.name) for r in upserts.upsert_nodes(old, new, "at").collect()}
    assert got == {"1": ("C", "last"), "2": ("B", "y"), "3": ("D", "z")}
