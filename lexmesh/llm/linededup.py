"""Fuzzy line dedup by SimHash.

Lines are normalised to lower-case words. Equal normalised lines are one line with several occurrences. Two
different lines of MIN_WORDS words or more are linked if their SimHashes share a block and their edit
similarity, 1 - edits / words of the longer, is SIMILAR or more. Of each connected group the occurrence first in
the order of (doc_id, line) stays; others go. Shorter lines are only compared for equality.

A SimHash of all words of a line changes in many bits with each changed word, so few lines that are SIMILAR by
edits share a block of it. Here a SimHash has blocks of 64 bits, and each block is the majority of the hashes of few
words, those that come first in an order of the block's own: SHORT_BLOCKS of two words, or from LONG words on BLOCKS of
three. A changed word so leaves most blocks as they are. Common words, whose slot of a table of SLOTS counters over
all documents holds a share of COMMON or more, come last in every order
(but in every other one of lines of less than eight words), so a block tells lines apart. Lines of
LONG words and up to a quarter more have both kinds of blocks, as their partners may have either. Blocks are the
pigeonholes: lines whose SimHashes don't differ in all of them share one.

Rows are told apart by doc_id and text. Nulls: a null text has no lines; rows without a doc_id come behind all
others. Rows with the same doc_id and text tie: they lose the same lines. Wordless lines stay. Empty tables give no
rows. Other columns are kept.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .cells import grouped, shared
from .common import NOT_ALNUM, Words, byte_table, cut, held_once, in_bitmap, iter_words, mix64, sliced, text_bytes, tidy, unused
from .components import connected

MIN_WORDS, LONG, SHORT_BLOCKS, BLOCKS, SIMILAR = 5, 16, 6, 10, 0.8
SLOTS, COMMON = 1 << 14, 2.0**-12

_TABLE = byte_table(NOT_ALNUM, lower=True)
_SALT = mix64(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)
_LAST = np.uint64(2**64 - 1)


def _row(docs: DataFrame) -> Column:
    """Names a row by its doc_id and text."""
    return F.xxhash64(docs["doc_id"].cast("long"), docs["text"].cast("string"))


def _slot(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - SLOTS.bit_length() + 1)).astype(np.int64)


def common_slots(docs: DataFrame) -> np.ndarray:
    """Which slots of word hashes hold a share of COMMON or more of all words of docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SLOTS, np.int64)
        for b in sliced(batches):
            for w in iter_words(b.column("text"), _TABLE):
                total += np.bincount(_slot(w.hash), minlength=SLOTS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["slot", "n"])

    counts = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    got = counts.toArrow()
    n = np.zeros(SLOTS, np.int64)
    n[got.column("slot").to_numpy()] = got.column("n").to_numpy()
    return (n >= COMMON * n.sum()) & (n > 0)


def _firsts(hashes: np.ndarray, n: np.ndarray, late: np.ndarray, blocks: range, many: int) -> np.ndarray:
    """[line, block, i]: the i-th of the `many` different words of each line that come first in each block's order; _LAST where a line has no more.

    late: a row of flags of words that come behind the others, for blocks with even and one for those with odd numbers.
    """
    first = np.cumsum(n) - n
    out = np.empty((len(n), len(blocks), many), np.uint64)
    for k in blocks if len(n) else ():
        order = hashes * _SALT[k] >> np.uint64(1) | late[k % 2]
        for i in range(many):
            if i:
                order[order == np.repeat(least, n)] = _LAST
            out[:, k - blocks[0], i] = least = np.minimum.reduceat(order, first)
    return out


def _picked(hashes: np.ndarray, n: np.ndarray, common: np.ndarray, blocks: range, many: int) -> np.ndarray:
    """_firsts with all common words behind the others. Where a line has enough others, only those are looked at."""
    late = common[_slot(hashes)]
    # lines of less than eight words may have no two uncommon ones: every other block of theirs takes words as they come
    short = n < 8
    first = np.cumsum(n) - n
    rich = ~short & (np.add.reduceat(~late, first, dtype=np.int64) >= many) if len(n) else short
    out = np.empty((len(n), len(blocks), many), np.uint64)
    at = np.flatnonzero(rich)
    some = ~late & np.repeat(rich, n)
    out[at] = _firsts(hashes[some], np.add.reduceat(some, first, dtype=np.int64)[at] if len(n) else n, np.zeros((2, 1), np.uint64), blocks, many)
    # few words may stand often in a line
    rest = np.flatnonzero(~rich)
    rest = np.r_[rest, at[(out[at] == _LAST).any((1, 2))]]
    rest.sort()
    words = np.repeat(np.isin(np.arange(len(n)), rest), n)
    behind = late[words].astype(np.uint64) << np.uint64(63)
    out[rest] = _firsts(hashes[words], n[rest], np.stack([behind, np.where(np.repeat(short[rest], n[rest]), np.uint64(0), behind)]), blocks, many)
    return out


def block_keys(hashes: np.ndarray, first: np.ndarray, n: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(keys, how many of each line) of lines that begin at `first` and have n words each, line by line."""
    found = np.zeros((len(first), SHORT_BLOCKS + BLOCKS), np.uint64)
    short, long = (n >= MIN_WORDS) & (n < LONG + LONG // 4), n >= LONG
    for which, blocks, many in ((short & ~long, range(SHORT_BLOCKS), 2), (long, range(BLOCKS), 3)):
        least = mix64(_picked(hashes[np.repeat(which, n)], n[which], common, blocks, many))
        for k in blocks:
            x, y, *z = (least[:, k, i] for i in range(many))
            if k < SHORT_BLOCKS:
                found[which, k] = mix64((x & y | _SALT[32] & (x | y)) + np.uint64(2 * k))
            if z:
                found[which, SHORT_BLOCKS + k] = mix64((x & y | z[0] & (x | y)) + np.uint64(2 * k + 1))
    has = np.concatenate([np.repeat(short[:, None], SHORT_BLOCKS, 1), np.repeat(long[:, None], BLOCKS, 1)], 1)
    return found[has], has.sum(1)


def _lines_of(w: Words, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of the lines with a word in a run of texts: text, number in it, first word, words and hash."""
    breaks = np.flatnonzero(data[offsets[w.lo] : offsets[w.hi]] == 10)
    doc = np.repeat(np.arange(w.hi - w.lo), np.diff(w.first))
    line = np.searchsorted(breaks, w.start)
    first = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (line[1:] != line[:-1])])
    n = np.diff(np.r_[first, len(doc)])
    place = (np.arange(len(doc)) - np.repeat(first, n)).astype(np.uint64)
    hashed = np.add.reduceat(mix64(w.hash + place * np.uint64(0xD1342543DE82EF95)), first)
    of = doc[first]
    return of, line[first] - np.searchsorted(breaks, w.bounds[:-1])[of], first, n, hashed


def lines(docs: DataFrame, common: np.ndarray) -> DataFrame:
    """(row, doc_id, line, hash, size, spare, signature, keys) of every line with a word; equal hashes are equal normalised lines.

    size counts its words, signature has a bit for each word, by its hash, spare is what size has beyond those bits.
    """
    names = ["row", "doc_id", "line", "hash", "size", "spare", "signature", "keys"]
    held = docs.sparkSession.sparkContext.broadcast(common)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            column, rows, ids = b.column("text"), b.column("row"), b.column("doc_id")
            data, offsets = text_bytes(column)
            for w in iter_words(column, _TABLE):
                if not len(w.hash):
                    continue
                of, number, first, n, hashed = _lines_of(w, data, offsets)
                bits = np.bitwise_or.reduceat(np.uint64(1) << (w.hash >> np.uint64(58)), first)
                keys, many = block_keys(w.hash, first, n, held.value)
                at = pa.array(w.lo + of)
                lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(many)].astype(np.int32)), pa.array(keys.view(np.int64)))
                spare = (n - np.bitwise_count(bits)).astype(np.int32)
                columns = [rows.take(at), ids.take(at), number.astype(np.int32), hashed.view(np.int64), n.astype(np.int32), spare, bits.view(np.int64), lists]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names)

    slim = docs.select(_row(docs).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(run, "row long, doc_id long, line int, hash long, size int, spare int, signature long, keys array<long>")


def enough(similar: float):
    """Whether lines of a and b words with `most` in common can reach the edit similarity: each word more or lacking is an edit."""
    return lambda most, a, b: most >= similar * np.maximum(a, b) - 1e-9


def edits(a: list, b: list) -> int:
    """Edit distance of two lists, bit-parallel over the first, after their common ends are cut."""
    lo, na, nb = 0, len(a), len(b)
    while lo < min(na, nb) and a[lo] == b[lo]:
        lo += 1
    while na > lo and nb > lo and a[na - 1] == b[nb - 1]:
        na, nb = na - 1, nb - 1
    a, b = a[lo:na], b[lo:nb]
    if not a or not b:
        return len(a) + len(b)
    at: dict = {}
    for i, x in enumerate(a):
        at[x] = at.get(x, 0) | 1 << i
    full, high = (1 << len(a)) - 1, 1 << (len(a) - 1)
    up, down, score = full, 0, len(a)
    for x in b:
        eq = at.get(x, 0)
        zero = (((eq & up) + up) ^ up) | eq | down
        rise, fall = down | (full & ~(zero | up)), up & zero
        score += bool(rise & high) - bool(fall & high)
        rise, fall = (rise << 1 | 1) & full, (fall << 1) & full
        up, down = fall | (full & ~(zero | rise)), rise & zero
    return score


def near_edits(a: list, b: list, most: int) -> int | None:
    """The edit distance of two lists if it is at most `most`, else None: furthest reaching diagonals, edit by edit."""
    na, nb = len(a), len(b)
    if abs(na - nb) > most:
        return None
    reach: dict[int, int] = {}
    for d in range(most + 1):
        now = {}
        for k in range(-d, d + 1):
            # the furthest place in a on diagonal k (place in b less place in a) after d edits
            i = max(reach.get(k, -2) + 1, reach.get(k - 1, -2), reach.get(k + 1, -2) + 1) if d else 0
            if not 0 <= i <= na or not 0 <= i + k <= nb:
                i = min(i, na, nb - k)
                if i < 0 or i + k < 0:
                    continue
            while i < na and i + k < nb and a[i] == b[i + k]:
                i += 1
            if i == na and i + k == nb:
                return d
            now[k] = i
        reach = now
    return None


#: Edits up to which the diagonals, whose work grows with the square, come first.
FEW = 10


def alike(a: list, b: list, similar: float) -> bool:
    """Whether the edit similarity reaches `similar`."""
    most = int((1 - similar) * max(len(a), len(b)) + 1e-9)
    if max(len(a), len(b)) - (Counter(a) & Counter(b)).total() > most:
        return False
    few = near_edits(a, b, min(most, FEW))
    return few is not None or most > FEW and edits(a, b) <= most


def _hashed(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, and the number of words of each."""
    runs = list(iter_words(column, _TABLE))
    return np.concatenate([w.hash for w in runs]), np.concatenate([np.diff(w.first) for w in runs])


def _one_gap(a: np.ndarray, na: np.ndarray, b: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Edits that turn each line of a into that of b: words replaced, and at one place words dropped or added. Never less than the edit distance."""
    n = np.minimum(na, nb)
    first = np.cumsum(n) - n
    place = np.arange(n.sum()) - np.repeat(first, n)
    starts, ends = (np.repeat(np.cumsum(k) - k, n) + place for k in (na, nb)), (np.repeat(np.cumsum(k) - n, n) + place for k in (na, nb))
    # words that differ if lines are laid together at their starts, and at their ends; before the gap the former count, behind it the latter
    x, y = (np.r_[0, np.cumsum(a[i] != b[j])] for i, j in (starts, ends))
    saved = np.minimum(np.minimum.reduceat((x - y)[1:], first) - (x - y)[first], 0)
    return y[first + n] - y[first] + saved + np.abs(na - nb)


def alike_pairs(left: pa.Array, right: pa.Array, similar: float) -> np.ndarray:
    """alike of each pair of lines, which have words. What one gap settles is settled for all pairs at once."""
    if not len(left):
        return np.zeros(0, bool)
    (a, na), (b, nb) = _hashed(left), _hashed(right)
    out = _one_gap(a, na, b, nb) <= ((1 - similar) * np.maximum(na, nb) + 1e-9).astype(np.int64)
    i, j = np.cumsum(na), np.cumsum(nb)
    for k in np.flatnonzero(~out):
        out[k] = alike(a[i[k] - na[k] : i[k]].tolist(), b[j[k] - nb[k] : j[k]].tolist(), similar)
    return out


#: A place orders lines by document, then by number, then by row, in one decimal.
_LINES = 1 << 31


def _place(doc_id: Column, line: Column, row: Column) -> Column:
    """Rows without an id come last. Rows that share an id are told apart by 31 bits of their names."""
    step = F.lit(_LINES).cast("decimal(10,0)")
    of = F.coalesce(doc_id, F.lit((1 << 63) - 1)).cast("decimal(20,0)") * step + line.cast("decimal(10,0)")
    return (of.cast("decimal(29,0)") * step + row.bitwiseAND(F.lit(_LINES - 1)).cast("decimal(10,0)")).cast("decimal(38,0)")


def _line_texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(id, text) of the lines whose hash is an id of wanted (id, row), from that row.

    Bitmaps of the rows and of the ids go to the texts, so that these needn't be shuffled; what they let through is joined.
    """
    sc = docs.sparkSession.sparkContext
    held = sc.broadcast((held_once(wanted.select("row")), held_once(wanted.select("id"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, ids = held.value
        for b in sliced(batches):
            b = b.filter(pa.array(in_bitmap(rows, b.column("row").to_numpy())))
            column = b.column("text")
            data, offsets = text_bytes(column)
            for w in iter_words(column, _TABLE):
                if not len(w.hash):
                    continue
                *_, first, n, hashed = _lines_of(w, data, offsets)
                some = np.flatnonzero(in_bitmap(ids, hashed.view(np.int64)))
                raw, start, end = data[offsets[w.lo] : offsets[w.hi]], w.start[first[some]], w.end[first[some] + n[some] - 1]
                yield pa.RecordBatch.from_arrays([pa.array(hashed[some].view(np.int64)), pa.array([raw[i:j].tobytes() for i, j in zip(start, end, strict=True)], pa.binary())], ["id", "text"])

    texts = docs.select(_row(docs).alias("row"), F.col("text").cast("string").alias("text"))
    found = texts.mapInArrow(run, "id long, text binary")
    return found.join(wanted.select("id"), "id", "left_semi").dropDuplicates(["id"])


def _occurrences(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(row, doc_id, line, hash) of the lines whose hash is in ids, and of few others that ids' bitmap lets through."""
    names = ["row", "doc_id", "line", "hash"]
    held = docs.sparkSession.sparkContext.broadcast(held_once(ids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            data, offsets = text_bytes(b.column("text"))
            for w in iter_words(b.column("text"), _TABLE):
                if len(w.hash):
                    of, number, *_, hashed = _lines_of(w, data, offsets)
                    some = np.flatnonzero(in_bitmap(held.value, hashed.view(np.int64)))
                    at = pa.array(w.lo + of[some])
                    yield pa.RecordBatch.from_arrays([b.column("row").take(at), b.column("doc_id").take(at), pa.array(number[some].astype(np.int32)), pa.array(hashed[some].view(np.int64))], names)

    slim = docs.select(_row(docs).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(run, "row long, doc_id long, line int, hash long")


def duplicates(docs: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """(row, gone): numbers of the lines of a row that go."""
    place = _place(F.col("doc_id"), F.col("line"), F.col("row"))
    every = lines(docs, common_slots(docs))
    kept = [F.first(c).alias(c) for c in ("size", "spare", "signature", "keys")]
    different = cut(every.withColumn("at", F.struct(place.alias("place"), "row")).groupBy(F.col("hash").alias("id")).agg(*kept, F.min("at").alias("at"), F.count("*").alias("n")))
    cells = cut(shared(different.select("id", "keys")))
    tidy(docs.sparkSession)
    inside = different.join(cells.select("id").distinct(), "id", "left_semi")
    about = cut(inside.select("id", F.unhex(F.lpad(F.hex("signature"), 16, "0")).alias("signature"), "size", "spare", F.col("at.row").alias("row")))

    texts = cut(_line_texts(docs, about.select("id", "row")))
    tidy(docs.sparkSession)

    def verify(pairs: DataFrame) -> DataFrame:
        left, right = (texts.select(F.col("id").alias(k), F.col("text").alias(f"t{k}")) for k in "ab")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in sliced(batches):
                yield b.filter(pa.array(alike_pairs(b.column("ta"), b.column("tb"), similar))).select(["a", "b"])

        return pairs.join(left, "a").join(right, "b").select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long")

    found = grouped(cells, about.drop("row"), enough(similar), verify, connected)
    # lines that stand once and are linked with none are left out: they stay
    lot = different.join(found, "id", "left").filter("n > 1 or component is not null").select("id", F.col("at.place").alias("place"), F.coalesce("component", "id").alias("component"))
    first = lot.groupBy("component").agg(F.min("place").alias("stays"))
    stays = cut(lot.join(first, "component").select(F.col("id").alias("hash"), "stays"))
    tidy(docs.sparkSession)
    gone = _occurrences(docs, stays.select("hash")).join(stays, "hash").filter(place != F.col("stays"))
    return gone.groupBy("row").agg(F.collect_set("line").alias("gone"))


def _dedup(docs: DataFrame, more: list[str], similar: float = SIMILAR) -> DataFrame:
    """docs with the text left and the columns `more`: n_lines, n_gone and worded."""
    keep = docs.columns
    key, gone = unused(keep, "line_row", "lines_gone")
    lost = duplicates(docs, similar).select(F.col("row").alias(key), F.col("gone").alias(gone))
    joined = docs.withColumn(key, _row(docs)).join(lost.hint("shuffle_hash"), key, "left").select(*keep, gone)
    word = re.compile("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            texts, n_lines, n_gone, worded = [], [], [], []
            for text, numbers in zip(b.column("text").to_pylist(), b.column(gone).to_pylist(), strict=True):
                out = set(numbers or ())
                left = text if not out else "\n".join(x for i, x in enumerate(text.split("\n")) if i not in out)
                texts.append(left)
                n_lines.append(0 if text is None else text.count("\n") + 1)
                n_gone.append(len(out))
                worded.append(word.search(left or "") is not None)
            columns = [b.column(c) if c != "text" else pa.array(texts, pa.string()) for c in keep]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(n_lines, pa.int64()), pa.array(n_gone, pa.int64()), pa.array(worded, pa.bool_())], [*keep, *more])

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema]
    out = joined.mapInArrow(run, ", ".join([*kinds, *(f"`{c}` {t}" for c, t in zip(more, ("long", "long", "boolean"), strict=True))]))
    if "n_chars" in keep:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out


def dedup(docs: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """docs with the text left, n_chars of it if docs has that column, and n_lines, n_gone and worded of the lines.

    worded says whether a word is left. Columns of docs by these three names give way.
    """
    more = ["n_lines", "n_gone", "worded"]
    return _dedup(docs.drop(*more), more, similar)


def report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_lines, n_gone, n_bytes and text_crc32 of what is left."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return dedup(docs.select("doc_id", F.col("text").cast("string").alias("text"))).select("doc_id", "n_lines", "n_gone", F.octet_length(text).cast("long").alias("n_bytes"), F.crc32(text).alias("text_crc32"))


def clean(docs: DataFrame) -> DataFrame:
    """The documents with the lines left; those that lost lines and have no word left go. Their columns are those of docs."""
    more = unused(docs.columns, "n_lines", "n_gone", "worded")
    return _dedup(docs, more).filter(F.col(more[2]) | (F.col(more[1]) == 0)).select(*docs.columns)
