"""Helpers shared by the operators: checkpoints, vectorised words, gapless numbering."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: The word classes of the contracts, as Java patterns of what separates words.
NOT_ALNUM = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SPACES = r"[\x20\x09-\x0D]+"
NOT_LETTER = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir. Where that is unset a temporary one, in local mode alone: on a cluster no other machine would see it."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="spark-"))
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Writes df to the shared checkpoint folder and goes on from there: computed once, survives lost executors."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def tidy(spark: SparkSession) -> None:
    """Has the driver collect its garbage, upon which Spark removes shuffle files and checkpoints that no DataFrame refers to any more.

    A driver with little to do collects seldom, and until then these files stay on all machines' disks and their records in its heap.
    """
    spark.sparkContext._jvm.System.gc()


#: A bitmap over hashes, of 16 MB whatever it stands for: it is built in BUCKETS segments and broadcast.
BITS, BUCKET_BITS = 27, 10
#: Hashes that a task holds before it passes them on.
DEALT = 1 << 20


def _bitmap(values: DataFrame, twice: bool) -> np.ndarray:
    """From one column of longs or arrays of longs: the bitmap of those that stand at all, or maybe twice.

    Only 42 bits of a hash travel, four bytes each: a bucket's come sorted in one value. Longs that share
    them are taken for the same, so the bitmap may hold more than it should, never less. Segments come to the
    driver compressed: most are nearly empty, and its memory is then spared their full size.
    """

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def out() -> pa.RecordBatch:
            h = np.sort(np.concatenate(held))
            bucket = (h >> np.uint64(64 - BUCKET_BITS)).astype(np.int32)
            low = (h >> np.uint64(32 - BUCKET_BITS)).astype(np.uint32)
            at = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
            ends = (np.r_[at, len(low)] * 4).astype(np.int32)
            return pa.RecordBatch.from_arrays([pa.array(bucket[at]), pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(ends), pa.py_buffer(low)])], ["bucket", "low"])

        for b in batches:
            column = b.column(0)
            flat = column.flatten() if pa.types.is_list(column.type) else column
            if len(flat):
                held.append(mix64(flat.to_numpy(zero_copy_only=False).view(np.uint64)))
                size += len(flat)
            if size >= DEALT:
                yield out()
                held, size = [], 0
        if size:
            yield out()

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        now = None

        def out() -> pa.RecordBatch:
            low = np.sort(np.concatenate(held))
            if twice:
                low = low[1:][low[1:] == low[:-1]]
            bits = np.zeros(1 << (BITS - BUCKET_BITS), np.uint8)
            bits[low >> np.uint32(32 - BITS + BUCKET_BITS)] = 1
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([zlib.compress(np.packbits(bits), 1)], pa.binary())], ["bucket", "bits"])

        for b in batches:
            for bucket, low in zip(b.column("bucket").to_pylist(), b.column("low"), strict=True):
                if bucket != now and held:
                    yield out()
                    held = []
                now = bucket
                held.append(np.frombuffer(low.as_buffer(), np.uint32))
        if held:
            yield out()

    dealt = values.mapInArrow(deal, "bucket int, low binary").repartition("bucket").sortWithinPartitions("bucket")
    bitmap = np.zeros((1 << BUCKET_BITS, 1 << (BITS - BUCKET_BITS - 3)), np.uint8)
    for bucket, bits in dealt.mapInArrow(find, "bucket int, bits binary").toArrow().to_pandas().itertuples(index=False):
        bitmap[bucket] = np.frombuffer(zlib.decompress(bits), np.uint8)
    return bitmap.ravel()


def held_once(values: DataFrame) -> np.ndarray:
    """A bitmap of 2 ** BITS bits of the longs in the one column of values, for in_bitmap."""
    return _bitmap(values, False)


def held_twice(values: DataFrame) -> np.ndarray:
    """The same of longs that stand twice or more, in the arrays of the one column of values."""
    return _bitmap(values, True)


def in_bitmap(bitmap: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Whether the bitmap may hold each of the longs; it does where it was built of them."""
    at = mix64(values.view(np.uint64)) >> np.uint64(64 - BITS)
    return (bitmap[at >> np.uint64(3)] >> (np.uint8(7) - (at & np.uint64(7)).astype(np.uint8))) & 1 > 0


def unused(columns: list[str], *names: str) -> list[str]:
    """The names, with underscores before them where columns, in any case, has them."""
    taken = {c.lower() for c in columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n = f"_{n}"
        taken.add(n.lower())
        out.append(n)
    return out


def ascii_lower(c: Column) -> Column:
    """Lower-cases A-Z only; pure ASCII texts take the fast built-in."""
    return F.when(F.length(c) == F.octet_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, UPPER.lower()))


def split_words(c: Column, separators: str) -> Column:
    """Words between separators; null and wordless texts give an empty array."""
    return F.filter(F.split(F.coalesce(c, F.lit("")), separators), lambda w: w != "")


def let(value: Column, body) -> Column:
    """body(value) with value computed once a row, however often body names it, inside lambdas too."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def byte_table(separators: str, lower: bool) -> np.ndarray:
    """256 entries: separators map to 0, other bytes to themselves, A-Z lower-cased if asked."""
    t = np.arange(256, dtype=np.uint8)
    if lower:
        t[65:91] += 32
    t[[b for b in range(128) if _separates(b, separators)]] = 0
    return t


def _separates(b: int, separators: str) -> bool:
    if separators == SPACES:
        return b == 0x20 or 9 <= b <= 13
    if separators == NOT_LETTER and 0x30 <= b <= 0x39:
        return True
    return b <= 0x2F or 0x3A <= b <= 0x40 or 0x5B <= b <= 0x60 or 0x7B <= b


_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_MIX_PLACE = np.uint64(0xD1342543DE82EF95)
#: Of the eight bytes from a place on, those of a word with so many bytes left.
_LEFT = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def _word_hashes(low: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the words low[start:end], which hold no zero byte, from eight bytes at a time; a word's come from its bytes alone."""
    eights = np.zeros(len(low) // 8 + 2, "<u8")
    eights.view(np.uint8)[: len(low)] = low

    def mixed(at: np.ndarray, left: np.ndarray, place: np.ndarray | None) -> np.ndarray:
        """Of the eight bytes at `at`, those that are left of the word, scrambled by their place in it."""
        i, shift = at >> 3, (at & 7).astype(np.uint64) << np.uint64(3)
        # two shifts, as one by 64 bits isn't defined
        x = (eights[i] >> shift | eights[i + 1] << np.uint64(1) << (np.uint64(63) - shift)) & _LEFT[np.minimum(left, 8)]
        return mix64(x if place is None else x + place.astype(np.uint64) * _MIX_PLACE)

    size = end - start
    out = mixed(start, size, None)
    long = np.flatnonzero(size > 8)
    if len(long):
        n = (size[long] - 1) >> 3
        first = np.cumsum(n) - n
        place = np.arange(1, n.sum() + 1) - np.repeat(first, n)
        out[long] += np.add.reduceat(mixed(np.repeat(start[long], n) + 8 * place, np.repeat(size[long], n) - 8 * place, place), first)
    return out


@dataclass
class Words:
    """Words of the texts lo..hi of a batch: 64-bit hashes, byte places, and the text of each word."""

    lo: int
    hi: int
    data: np.ndarray  # mapped bytes of the texts
    bounds: np.ndarray  # where each text starts and the last ends
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray  # first word of each text, and the number of all


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; nulls are empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), offsets


#: What an operator keeps in a worker from task to task. Another operator's pass in that worker lets go of it.
KEPT: dict = {}


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """Shorter batches, so that a worker holds few texts at a time; what the last ones took is given back."""
    KEPT.clear()
    for b in batches:
        for lo in range(0, b.num_rows, rows):
            yield b.slice(lo, rows)
    pa.default_memory_pool().release_unused()
    # what NumPy has freed goes back too, where the C library can do that: workers live from task to task
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def iter_words(column: pa.Array, table: np.ndarray, at_once: int = 1 << 18) -> Iterator[Words]:
    """Hashes of all words, in runs of whole texts of about at_once bytes."""
    data, offsets = text_bytes(column)
    lo, n = 0, len(column)
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + at_once, "right")) - 1)
        bounds = offsets[lo : hi + 1] - offsets[lo]
        low = np.frombuffer(data[offsets[lo] : offsets[hi]].tobytes().translate(table.tobytes()), np.uint8)
        word = np.zeros(len(low) + 2, bool)
        word[1:-1] = low != 0
        turns = np.flatnonzero(word[1:] != word[:-1])
        start, end = turns[::2], turns[1::2]
        # words that a text ends with and the next one begins with
        split = np.unique(bounds[1:-1])
        split = split[word[split] & word[split + 1]]
        if len(split):
            start, end = np.sort(np.r_[start, split]), np.sort(np.r_[end, split])
        hashed = _word_hashes(low, start, end)
        yield Words(lo, hi, low, bounds, start, end, hashed, np.searchsorted(start, bounds))
        lo = hi


def numbered(df: DataFrame, keys: list[str], out: str) -> DataFrame:
    """Adds a gapless number from 0 within each key, without gathering a key in one task.

    Each task numbers its own rows; the counts of (task, key) give the offsets. The rows are
    checkpointed in between, so that the numbers hold if a task runs again.
    """
    schema = df.schema
    names = df.columns

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple, int] = {}
        part = TaskContext.get().partitionId()
        for b in batches:
            mine = np.empty(b.num_rows, np.int64)
            for i, k in enumerate(zip(*(b.column(c).to_pylist() for c in keys), strict=True)):
                mine[i] = seen[k] = seen.get(k, -1) + 1
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(b.num_rows, part, np.int32)), pa.array(mine)], [*names, "_part", "_mine"])

    rows = cut(df.mapInArrow(local, _ddl(schema, "_part int, _mine long")))
    counts = rows.groupBy("_part", *keys).agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    return rows.join(offsets, ["_part", *keys]).withColumn(out, F.col("_before") + F.col("_mine")).select(*names, out)


def _ddl(schema, more: str) -> str:
    return ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in schema), more])
