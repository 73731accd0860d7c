"""Each operator against brute force on small tables, with nulls, empties, ties, repeats, long texts and odd columns."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter
from io import BytesIO
from math import lgamma, log

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lexmesh.llm import cells, components, ctw, decontaminate, jaccard, licenses, linededup, packing, quality_pu, quality_rules, sharding, warc

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ALNUM, PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), re.compile(r"[^\x20\x09-\x0D]+")
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
#: Names that operators use inside, as extra columns.
ODD = ["n", "key", "id", "component", "_id", "gone", "score", "h", "token", "bytes"]


def words(text, kind=PLAIN):
    return kind.findall((text or "").translate(LOW))


def corpus(seed=1, n=60):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)] + ["été", "ß", "CC", "BY"]
    texts = [None, "", " \n\t", "one", "Two words", "é" * 50, "a. " * 3000]
    for _ in range(n):
        lines = [" ".join(rng.choices(vocabulary, k=rng.randint(3, 25))) for _ in range(rng.randint(1, 6))]
        texts.append("\n".join(lines))
    for _ in range(n // 2):
        base = rng.choice(texts[7:]).split(" ")
        for _ in range(rng.randint(0, 2)):
            base[rng.randrange(len(base))] = rng.choice(vocabulary)
        texts.append(" ".join(base))
    texts += [texts[10]] * 5
    return texts


@pytest.fixture(scope="module")
def texts():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return rows.withColumns({c: F.lit(7) for c in ODD}).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string")


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


def test_components(spark):
    rng = random.Random(3)
    links = [(rng.randrange(80), rng.randrange(80)) for _ in range(60)] + [(i, i + 1) for i in range(100, 160)] + [(5, 5)]
    parent = {}

    def top(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((top(a), top(b)))
        parent[b] = a
    got = {r.node: r.component for r in components.connected(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: top(x) for x in {y for a, b in links if a != b for y in (a, b)}}
    assert components.connected(spark.createDataFrame([], "a long, b long")).count() == 0


def test_decontaminate(spark, docs, texts, empty):
    items = [(1, texts[12]), (1, texts[12]), (2, "Two, WORDS!"), (3, None), (4, ".."), (None, "one"), (11, texts[20])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    windows = {}
    for i, t in items:
        w = words(t, ALNUM)
        for k in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[k : k + 10]), set()).update([i] if i is not None else [])
    for block in (decontaminate.BLOCK_BYTES, 200):
        got = by_id(decontaminate.scan(docs, bench, block_bytes=block))
        for d, t in enumerate(texts):
            w, hit, found = words(t, ALNUM), set(), set()
            for x, ids in windows.items():
                for k in range(len(w) - len(x) + 1):
                    if tuple(w[k : k + len(x)]) == x:
                        hit.update(range(k, k + len(x)))
                        found |= ids
            assert got[d].n_words == len(w) and got[d]["items"] == sorted(map(str, found))
            assert {k for h in got[d].hits for k in range(h.first, h.last + 1)} == hit
            for h in got[d].hits:
                assert words(t[h.start : h.end], ALNUM) == w[h.first : h.last + 1]
    r = by_id(decontaminate.report(docs, bench))[3]
    assert r.items_sha256 == hashlib.sha256(b"").hexdigest() and r.n_hit == 1 and r.contaminated and r.n_items == 0
    assert decontaminate.report(empty, bench).count() == 0
    assert decontaminate.report(docs, bench.limit(0)).filter("contaminated").count() == 0
    kept = decontaminate.clean(docs, bench)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {d for d in got if not got[d].hits}


def test_decontaminate_keeps_rows_apart(spark, texts):
    """Rows without an id or with the same one stay rows of their own, however many blocks there are."""
    rows = [(None, texts[12]), (None, texts[20]), (None, None), (1, texts[12]), (1, "one two"), (1, "one two"), (2, texts[30])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    bench = spark.createDataFrame([(1, texts[12]), (2, texts[20]), (3, "two")], "item_id long, text string")
    few, many = (sorted(map(repr, decontaminate.scan(docs, bench, block_bytes=b).collect())) for b in (decontaminate.BLOCK_BYTES, 200))
    assert len(few) == len(rows) and few == many


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_edits():
    rng = random.Random(5)
    for _ in range(300):
        a, b = ([rng.choice("abc") for _ in range(rng.randint(0, 12))] for _ in range(2))
        d = distance(a, b)
        assert linededup.edits(a, b) == d
        for most in range(13):
            assert linededup.near_edits(a, b, most) == (d if d <= most else None)
        for similar in (0.5, 0.8, 0.9):
            assert linededup.alike(a, b, similar) == (d <= (1 - similar) * max(len(a), len(b)) + 1e-9)
    for share in (0.1, 0.18, 0.22, 0.3):
        a = [str(rng.randrange(50)) for _ in range(300)]
        b = [x if rng.random() > share else "x" for x in a]
        assert linededup.alike(a, b, 0.8) == (distance(a, b) <= 60)


def test_leaders():
    """The same as one row after another, run by run."""
    rng = np.random.default_rng(9)
    bits = rng.integers(0, 4, (200, 2)).astype(np.uint64)
    sizes, run = np.bitwise_count(bits).sum(1).astype(np.int64), np.sort(rng.integers(0, 9, 200))
    enough = jaccard.enough(60)
    want, lead = [], {}
    for k in range(200):
        for x in lead.setdefault(run[k], []):
            over = min(sizes[k] - np.bitwise_count(bits[k] & ~bits[x]).sum(), sizes[x] - np.bitwise_count(bits[x] & ~bits[k]).sum())
            if enough(int(over), int(sizes[k]), int(sizes[x])):
                want.append((x, k))
                break
        else:
            lead[run[k]].append(k)
    i, j = cells.leaders(bits, sizes, run, enough)
    assert want and sorted(zip(i.tolist(), j.tolist(), strict=True)) == sorted(want)


def test_line_dedup(docs, texts, empty):
    got = by_id(linededup.dedup(docs))
    common = linededup.common_slots(docs)
    rows = linededup.lines(docs, common).collect()
    texts_of = {(d, k): words(x, ALNUM) for d, t in enumerate(texts) if t is not None for k, x in enumerate(t.split("\n")) if words(x, ALNUM)}
    assert {(r.doc_id, r.line) for r in rows} == set(texts_of)
    place = {(r.doc_id, r.line): r.hash for r in rows}
    assert len({tuple(texts_of[p]) for p in place}) == len(set(place.values()))
    keys = {r.hash: set(r["keys"]) for r in rows}
    assert {len(texts_of[p]) < 5 for p, h in place.items() if not keys[h]} <= {True}
    first = {}
    for p in sorted(place):
        first.setdefault(place[p], p)
    group = {h: h for h in first}

    def top(x):
        while group[x] != x:
            x = group[x]
        return x

    ids = sorted(first)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if keys[a] & keys[b]:
                x, y = texts_of[first[a]], texts_of[first[b]]
                if distance(x, y) <= 0.2 * max(len(x), len(y)) + 1e-9:
                    group[top(a)] = top(b)
    stays = {}
    for p in sorted(place):
        stays.setdefault(top(place[p]), p)
    gone = {p for p in place if stays[top(place[p])] != p}
    assert gone and any(stays[top(place[p])] != first[place[p]] for p in gone)
    for d, t in enumerate(texts):
        want = t if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if (d, k) not in gone)
        assert got[d].text == want, d
    assert linededup.report(empty).count() == 0
    assert linededup.clean(docs).columns == docs.columns


def test_line_dedup_tells_rows_apart(spark):
    """Rows that share an id or have none keep their own lines; repeated rows tie."""
    plate, once = "same boiler plate line for all of the pages", "wholly different text that stands only once today"
    rows = [(1, once), (1, plate), (0, plate), (None, plate + "\n" + once[::-1]), (None, "yes"), (2, "yes"), (3, "alone stands this last line of all\nYes!"), (3, "alone stands this last line of all\nYes!")]
    got = Counter((r.doc_id, r.text) for r in linededup.dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect())
    assert got == Counter([(1, once), (1, ""), (0, plate), (None, once[::-1]), (None, ""), (2, "yes"), (3, "alone stands this last line of all"), (3, "alone stands this last line of all")])


@pytest.mark.parametrize("share", [0.1, 0.2])
def test_line_dedup_recall(spark, share):
    """Of lines with a share of their words replaced, dropped or added, 0.9 or more share a block."""
    rng = random.Random(5)
    vocabulary, usual = [f"w{i}" for i in range(30_000)], ["the", "of", "and", "in", "to", "a", "is", "that"]
    some = lambda: rng.choice(usual if rng.random() < 0.4 else vocabulary)
    lines = []
    for k in range(3000):
        line = [some() for _ in range(rng.choice([6, 8, 10, 15, 20, 30, 40, 60, 100]))]
        other = list(line)
        for at in rng.sample(range(len(line)), int(share * len(line))):
            other[at] = some() if rng.random() < 0.7 else f"{some()} {other[at]}" if rng.random() < 0.3 else other[at] if rng.random() < 0.5 else ""
        lines += [(2 * k, " ".join(line)), (2 * k + 1, " ".join(other))]
    table = spark.createDataFrame(lines, "doc_id long, text string")
    keys = {r.doc_id: set(r["keys"]) for r in linededup.lines(table, linededup.common_slots(table)).collect()}
    near = [k for k in range(3000) if distance(words(lines[2 * k][1]), words(lines[2 * k + 1][1])) <= 0.2 * max(len(words(x[1])) for x in lines[2 * k : 2 * k + 2]) + 1e-9]
    found = sum(bool(keys[2 * k] & keys[2 * k + 1]) for k in near)
    assert len(near) > 2000 and found >= 0.9 * len(near), found / len(near)


def test_licenses(spark, docs, texts, empty):
    extra = {1000: "x Licensed under CC BY-NC 4.0.", 1001: "This work is licensed under the new GNU General Public License, version 3!", 1002: "all rights\nreserved. ALL RIGHTS RESERVED", 1003: "released under the MIT License"}
    rows = docs.select("doc_id", "text").union(spark.createDataFrame([*extra.items(), (None, "cc by"), (1002, extra[1002])], "doc_id long, text string"))
    every = rows.collect()
    got = licenses.scan(rows).collect()
    assert len(got) == len(every)
    phrases = {tuple(p.split()): label for p, label in licenses.PHRASES.items()}
    text_of = {r.doc_id: r.text for r in every}
    for r in got:
        w = words(text_of[r.doc_id], ALNUM)
        at = [(k, label) for p, label in phrases.items() for k in range(len(w) - len(p) + 1) if tuple(w[k : k + len(p)]) == p]
        assert (r.n_words, r.n_base, r.base_labels) == (len(w), len(at), ",".join(sorted({x for _, x in at})))
        assert (r.first_word, r.last_word) == ((min(at)[0], max(at)[0]) if at else (None, None))
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
    one = {r.doc_id: r for r in got}
    assert one[1000].labels == "cc-by,cc-by-nc-4.0" and one[1001].labels == "gpl,gpl-3.0" and one[1003].labels == "mit" and one[1003].score == 1
    assert licenses.scan(empty).count() == 0


def brute_spans(text, notices, k=4):
    """Diagonals, their neighbours merged, and the check of the span, place by place."""
    w, out = words(text, ALNUM), set()
    for label, notice in notices:
        t = words(notice, ALNUM)
        votes = {}
        for p in range(len(w) - k + 1):
            for q in range(len(t) - k + 1):
                if w[p : p + k] == t[q : q + k]:
                    votes.setdefault(p - q, []).append((p, q))
        runs = []
        for d in sorted(votes):
            if runs and d - runs[-1][-1] <= licenses.SLACK:
                runs[-1].append(d)
            else:
                runs.append([d])
        for run in runs:
            at = [x for d in run for x in votes[d]]
            covered = len({q + j for _, q in at for j in range(k)}) / len(t)
            first, last = min(p for p, _ in at), max(p for p, _ in at) + k - 1
            if covered >= licenses.COVERAGE and last - first + 1 <= licenses.STRETCH * len(t):
                out.add((label, first, last, round(covered, 9)))
    return out


@pytest.mark.parametrize("own", [False, True])
def test_license_spans(spark, own):
    """Notices with words inserted, dropped and changed, twice in a text, cut off, and among others."""
    notices = [("own", "one two three four five six seven eight nine ten"), ("twice", "so so so so so so")] if own else licenses.TEMPLATES
    rng = random.Random(12)
    rows = [(0, None), (1, ""), (2, "a b c"), (None, notices[0][1])]
    for i in range(150):
        w = []
        for _, notice in rng.choices(notices, k=rng.randint(1, 2)):
            some = notice.split()
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                at = rng.randrange(len(some))
                some[at : at + rng.randint(0, 1)] = rng.choice([[], ["zap"], ["zap", "zip", "zup", "zop"]])
                some = some or ["zap"]
            w += [*rng.choices(["so", "it", "goes", "one", "two"], k=rng.randint(0, 30)), *some[: rng.choice([len(some)] * 3 + [len(some) // 2])]]
        rows.append((10 + i, " ".join(w)))
    found = licenses.spans(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), notices=notices).collect()
    got = {}
    for r in found:
        got.setdefault(r.doc_id, set()).add((r.label, r.first_word, r.last_word, round(r.coverage, 9)))
    want = {d: brute_spans(t, notices) for d, t in rows}
    assert got == {d: x for d, x in want.items() if x} and len(got) > 50


def test_warc(spark, texts, tmp_path):
    pages = [(i, f"http://x/{i} y", t) for i, t in enumerate(texts)] + [(900, None, "z" * 900_000), (901, "u", "z" * 900_000), (901, "u", "z" * 900_000), (None, "v", "alone"), (None, "v", "one")]
    table = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    best = {}
    for i, _, h in pages:
        if i is not None:
            best[h or ""] = max(best.get(h or "", -1), i)
    got = Counter(tuple(r) for r in warc.round_trip(table).collect())
    want = Counter()
    for i, _, h in pages:
        b = (h or "").encode()
        top = best.get(h or "")
        again = top is not None and top != i
        want[i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if again else "response", top if again else None] += 1
    assert got == want
    folder = str(tmp_path)
    manifest = warc.write(warc.records(table, 1000), f"file://{folder}")
    back = warc.read(manifest, f"file://{folder}").collect()
    whole = {}
    for r in sorted(back, key=lambda r: (r.page_id or -1, r.record_type, r.chunk_no)):
        if r.page_id == 901 and r.record_type == "response":
            whole.setdefault(r.chunk_no, r.data)
    assert b"".join(whole.values()) == b"z" * 900_000 and len(whole) > 2
    assert warc.round_trip(table.limit(0)).count() == 0
    with pytest.raises(ValueError, match="ends within"):
        raw = open(manifest.first().path, "rb").read()
        list(warc.parse(BytesIO(raw[: len(raw) // 2])))


class Reads(BytesIO):
    """A file that gives at most `most` bytes a read."""

    def __init__(self, raw, most):
        super().__init__(raw)
        self.most = most

    def read(self, n=-1):
        return super().read(self.most if n < 0 else min(n, self.most))


def archive(payloads):
    out = b""
    for k, p in enumerate(payloads):
        row = {"page_id": k, "url": "u", "record_type": "response", "refers_to": None, "payload_bytes": len(p), "sha1": hashlib.sha1(p).hexdigest()}
        member = zlib.compressobj(1, wbits=31)
        out += member.compress(warc._head(row) + p + b"\r\n\r\n") + member.flush()
    return out


def test_warc_reads_exactly():
    """Records end wherever the pieces of a read fall."""
    head = len(warc._head({"page_id": 0, "url": "u", "record_type": "response", "refers_to": None, "payload_bytes": 65_000, "sha1": "0" * 40}))
    rng = random.Random(3)
    sizes = [65_535 - head + k for k in range(-8, 9)]
    payloads = [rng.randbytes(n) for n in sizes] + [b"x" * n for n in sizes] + [b"a\r", b"a\n", b"a\r\n", b"\r\n\r\n", b"", b"a\r\n\r\n"]
    raw = archive(payloads)
    short = archive(payloads[-6:])
    for file, of in [(Reads(raw, most), payloads) for most in (1 << 20, 65_535, 4096, 7)] + [(Reads(short, most), payloads[-6:]) for most in (1, 2, 3, 4, 5)]:
        got = {}
        for row in warc.parse(file, 1000):
            got[row["page_id"]] = got.get(row["page_id"], b"") + row["data"]
        assert got == dict(enumerate(of))


@pytest.mark.parametrize(("shingle", "percent"), [(3, 90), (5, 80), (1, 60)])
def test_jaccard(spark, docs, texts, empty, shingle, percent):
    near = [" ".join(f"t{k}" if k % 97 != i else "x" for k in range(200)) for i in range(40)]
    texts = [*texts, *near]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    sets = []
    for t in texts:
        w = words(t)
        sets.append({tuple(w[k : k + shingle]) for k in range(len(w) - shingle + 1)} if len(w) >= shingle else {tuple(w)} if w else set())
    group = list(range(len(texts)))

    def top(x):
        while group[x] != x:
            x = group[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                x, y = sorted((top(i), top(j)))
                group[y] = x
    got = by_id(jaccard.join(rows, shingle, percent))
    assert {d: (r.n_shingles, r.component_id) for d, r in got.items()} == {d: (len(s), top(d)) for d, s in enumerate(sets)}
    if shingle == 3:
        odd = rows.union(spark.createDataFrame([(None, texts[20]), (20, texts[20])], rows.schema))
        assert jaccard.join(odd).count() == len(texts) + 2 and jaccard.join(empty).count() == 0
        kept = {r.doc_id for r in jaccard.keep_one(rows, shingle, percent).collect()}
        assert kept == {top(d) for d in range(len(texts))}


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5])
def test_short_document_alone(n):
    """A run of texts may hold fewer words than a shingle, one set all the same."""
    text = " ".join(f"w{i}" for i in range(n))
    (row, alone), = jaccard._sets(pa.array([text]), 5)
    beside = dict(jaccard._sets(pa.array(["x " * 9, text]), 5))[1]
    assert row == 0 and len(alone) == 1 and alone.tolist() == beside.tolist()


def test_signature_trees_lose_nothing():
    """Every pair that links within a tree, or between two, is left by the traversal, and none within a component."""
    rng = np.random.default_rng(2)
    base = rng.integers(0, 2**63, 60).astype(np.uint64)
    sets = [np.unique(np.r_[base[rng.random(60) > 0.05], rng.integers(0, 2**63, rng.integers(0, 6)).astype(np.uint64)]) for _ in range(90)]
    sets += [rng.integers(0, 2**63, 60).astype(np.uint64) for _ in range(90)]
    bits = np.stack([np.frombuffer(jaccard._signature(s).tobytes(), np.uint64) for s in sets])
    sizes = np.array([len(s) for s in sets])
    spare = sizes - np.bitwise_count(bits).sum(1)
    want = {(i, j) for i in range(180) for j in range(i + 1, 180) if 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))}
    tree = np.r_[np.zeros(40), np.ones(50), np.full(1, 2), np.full(89, 3)].astype(np.int64)
    forest = cells.Forest(bits, sizes, spare, np.arange(180), tree, jaccard.enough(80))
    roots = np.arange(4)
    pairs = lambda i, j: sorted(tuple(sorted(p)) for p in zip(i.tolist(), j.tolist(), strict=True))
    got = pairs(*forest.traverse(roots, roots))
    assert len(got) == len(set(got)) and {p for p in want if tree[p[0]] == tree[p[1]]} <= set(got) and len(got) < 2 * len(want)
    got = pairs(*forest.traverse(roots[:1], roots[1:2]))
    assert len(got) == len(set(got)) and {p for p in want if p[0] < 40 <= p[1] < 90} <= set(got)
    component = np.arange(180) % 2
    forest = cells.Forest(bits, sizes, spare, component, np.zeros(180, np.int64), jaccard.enough(80))
    assert {p for p in want if component[p[0]] != component[p[1]]} <= set(pairs(*forest.traverse(roots[:1], roots[:1])))


@pytest.mark.parametrize(("small", "block"), [(8, 1024), (2, 16), (0, 4)])
def test_large_cells(spark, monkeypatch, small, block):
    """Cells of any size: all links that share a key are found through the trees, with no pair of blocks sent on that can't link."""
    monkeypatch.setattr(cells, "SMALL", small)
    monkeypatch.setattr(cells, "BLOCK", block)
    rng = random.Random(4)
    base = [[rng.getrandbits(40) for _ in range(50)] for _ in range(12)]
    sets = []
    for k in range(300):
        s = list(base[min(k % 17, 11)])
        for _ in range(rng.randint(0, 5)):
            s[rng.randrange(50)] = rng.getrandbits(40)
        sets.append(set(s))
    about, keyed = [], []
    for k, s in enumerate(sets):
        t = jaccard.mix64(np.array(sorted(s), np.uint64))
        b = jaccard._signature(t)
        about.append((k, bytearray(b.tobytes()), len(s), len(s) - int(np.bitwise_count(b).sum())))
        keyed.append((k, [7, 100 + k % 3, 200 + k]))
    dealt = cells.shared(spark.createDataFrame(keyed, "id long, keys array<long>"))
    assert Counter(r.n for r in dealt.collect()) == {300: 300, 100: 300}
    enough = jaccard.enough(80)

    def verify(pairs):
        got = [(r.a, r.b) for r in pairs.collect() if enough(len(sets[r.a] & sets[r.b]), len(sets[r.a]), len(sets[r.b]))]
        return spark.createDataFrame(got, "a long, b long")

    found = cells.grouped(dealt, spark.createDataFrame(about, "id long, signature binary, size int, spare int"), enough, verify, components.connected)
    group = list(range(300))

    def top(x):
        while group[x] != x:
            x = group[x]
        return x

    for i in range(300):
        for j in range(i):
            if enough(len(sets[i] & sets[j]), len(sets[i]), len(sets[j])):
                x, y = sorted((top(i), top(j)))
                group[y] = x
    assert {r.id: r.component for r in found.collect()} == {k: top(k) for k in range(300) if sum(top(j) == top(k) for j in range(300)) > 1}


def test_keep_one_row(spark):
    """One row of a group stays, also where rows share an id, have none or are repeated."""
    near = " ".join(f"w{k}" for k in range(100))
    rows = [(1, near), (1, near), (1, near + " x"), (None, near), (None, near), (0, near + " y"), (2, "one two three"), (2, "one two three"), (2, "four"), (None, "six seven"), (None, "six seven"), (3, None), (3, None), (4, ""), (5, "!")]
    table = spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, text string, jaccard_row int").repartition(4)
    kept = jaccard.keep_one(table, 5, 80)
    assert kept.columns == table.columns
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter([(0, near + " y"), (2, "one two three"), (2, "four"), (None, "six seven"), (3, None), (3, None), (4, ""), (5, "!")])


def test_context_tree(spark, docs, texts, empty):
    got = by_id(ctw.score(docs))
    train = [d for d in got if zlib.crc32(str(d).encode()) % 5 != 1]
    c = Counter(x for d in train for x in [*words(texts[d]), None])
    total = sum(c.values())
    for d, t in enumerate(texts):
        w = [*words(t), None]
        want = sum(np.log10((c[x] + 0.5) / (total + 0.5 * (len(c) + 1))) for x in w)
        r = got[d]
        assert abs(r.base_score - want) < 1e-6 * max(1, -want) and (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (len(w), sum(c[x] > 0 for x in w), total, d not in train)
        assert r.score < 0
    assert ctw.score(empty).count() == 0


def test_context_tree_is_a_distribution():
    """Over the next byte at a leaf, and as good as the mixture by its definition for depth 0."""
    rng = np.random.default_rng(1)
    text = rng.integers(97, 101, 400)
    rows = {}
    for i in range(4, 400):
        for d in range(3):
            c = sum(int(text[i - k - 1]) << 8 * k for k in range(d))
            rows[d, c, int(text[i])] = rows.get((d, c, int(text[i])), 0) + 1
    d, c, s, n = map(np.array, zip(*((*k, v) for k, v in rows.items()), strict=True))
    tree = ctw.Tree(d, c, s, n)
    leaves = [k for k in range(len(tree.child)) if (tree.child[k] == k).all()]
    assert np.allclose((10.0 ** tree.log10[leaves].astype(float)).sum(1), 1, atol=1e-4)
    assert np.allclose(ctw.log_gamma(np.array([0.5, 1.0, 5.0])), [np.log(np.pi) / 2, 0, np.log(24)])


def brute_tree(train, depth):
    """log10 of a text by the whole context tree, from its definition."""
    pad = lambda t: [ctw.START] * depth + list((t or "").encode()) + [ctw.END]
    counts = {}

    def steps(p, i):
        """(context, decision, bit), deepest context last, of the byte at i."""
        return [(tuple(p[i - d : i]), (1 << k) + (p[i] >> (8 - k)), p[i] >> (7 - k) & 1, d) for k in range(8) for d in range(depth + 1)]

    for t in train:
        p = pad(t)
        for i in range(depth, len(p)):
            for c, k, bit, _ in steps(p, i):
                counts.setdefault((c, k), [0, 0])[bit] += 1
    own = {x: lgamma(a + 0.5) + lgamma(b + 0.5) - 2 * lgamma(0.5) - lgamma(a + b + 1) for x, (a, b) in counts.items()}
    weighted, below = {}, Counter()
    for c, k in sorted(counts, key=lambda x: -len(x[0])):
        weighted[c, k] = own[c, k] if len(c) == depth else np.logaddexp(own[c, k], below[c, k]) - log(2)
        if c:
            below[c[1:], k] += weighted[c, k]

    def score(t):
        p, out, odds, left = pad(t), 0.0, 0.0, 1.0
        for i in range(depth, len(p)):
            for c, k, bit, d in steps(p, i):
                n = counts.get((c, k), [0, 0])
                share = 1 if d == depth else np.exp(own.get((c, k), 0) - weighted.get((c, k), 0)) / 2
                odds, left = odds + left * share * (n[bit] + 0.5) / (sum(n) + 1), left * (1 - share)
                if d == depth:
                    out, odds, left = out + np.log10(odds), 0.0, 1.0
        return out

    return score


@pytest.mark.parametrize("looked_up", [1 << 21, 300, 0])
def test_context_tree_is_whole(spark, monkeypatch, looked_up):
    """However the grams are looked up, no context is dropped; held-out grams change nothing."""
    monkeypatch.setattr(ctw, "LOOKED_UP", looked_up)
    texts = [t[:120] if t else t for t in corpus(seed=3, n=12)] + ["\x00é ", "held out only: ~{}|"]
    rows = [*enumerate(texts), (len(texts) - 1, texts[-1]), (9, texts[9]), (None, texts[9])]
    got = ctw.score(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    want = brute_tree([t for d, t in rows if d is not None and zlib.crc32(str(d).encode()) % 5 != 1], ctw.DEPTH)
    assert len(got) == len(rows) and any(r.held_out for r in got)
    for r in got:
        text = texts[9 if r.doc_id is None else r.doc_id]
        assert abs(r.score - want(text)) < 1e-6 * max(1, -r.score)
        assert abs(r.bits_per_byte + r.score * np.log2(10) / (len((text or "").encode()) + 1)) < 1e-9


def test_quality_pu(spark, docs, texts, empty):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(400):
        bad = i % 6 == 0
        w = [rng.choice(["the", "of", "house", "tree", "water"]) + str(rng.randrange(40)) for _ in range(80)]
        rows.append((i, " ".join(x + "$$$" if bad else x for x in w)))
        labels.append((i, int(not bad)))
    table = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([*labels, (None, 1), (3, None), (99999, 1)], "doc_id long, quality int")
    got = quality_pu.classify(table, marks).collect()
    truth = dict(labels)
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    none = quality_pu.classify(docs, marks.limit(0)).collect()
    assert len(none) == len(texts) and {round(r.score, 6) for r in none} == {0.85}
    assert quality_pu.classify(empty, marks).count() == 0
    assert quality_pu.keep_good(docs, marks).columns == docs.columns
    # a label 0 is never read: without them nothing changes
    hidden = quality_pu.classify(table, marks.filter("quality = 1")).collect()
    assert {(r.doc_id, r.score) for r in hidden} == {(r.doc_id, r.score) for r in got}
    odd = table.union(spark.createDataFrame([(None, None), (0, rows[0][1]), (0, rows[0][1]), (1, "")], table.schema)).withColumn("Score", F.lit(5))
    again = quality_pu.score(odd, quality_pu.train(odd, marks))
    assert again.columns == ["doc_id", "text", "Score", "_score", "predicted"] and again.count() == 404
    assert again.filter("doc_id = 0").select("_score").distinct().count() == 1 and quality_pu.keep_good(odd, marks).columns == odd.columns


def test_quality_risk():
    """The risk by its definition, row by row, and its slope by small steps, on both sides of the bound at zero."""
    rng = np.random.default_rng(3)
    p, u = rng.integers(0, 4, (30, 3)) + np.arange(3) * 4, rng.integers(0, 4, (50, 3)) + np.arange(3) * 4
    p[:] = p[0]
    sides = set()
    for prior, shift in ((0.3, 0.0), (0.99, 6.0), (0.9, -1.0), (0.999, 9.0)):
        rng = np.random.default_rng(int(1000 * prior))
        theta = rng.normal(size=13)
        theta[p[0]] += shift / 3
        theta[-1] += min(shift, 0)
        f = lambda rows, x: [sum(x[k] for k in r) + x[-1] for r in rows]
        mean = lambda v: sum(v) / len(v)
        below = lambda x: mean([1 / (1 + np.exp(-v)) for v in f(u, x)]) - prior * mean([1 / (1 + np.exp(-v)) for v in f(p, x)])
        above = lambda x: prior * mean([1 / (1 + np.exp(v)) for v in f(p, x)])
        got, g = quality_pu.risk(theta, p, u, prior)
        assert abs(got - (above(theta) + max(0, below(theta)))) < 1e-9
        sides.add(below(theta) >= 0)
        descended = (lambda x: above(x) + below(x)) if below(theta) >= 0 else (lambda x: -below(x))
        for k in range(13):
            step = np.eye(13)[k] * 1e-5
            assert abs((descended(theta + step) - descended(theta - step)) / 2e-5 - g[k]) < 1e-5
    assert sides == {True, False}


@pytest.mark.parametrize("share", [0.3, 0.6, 0.85])
def test_quality_prior(share):
    rng = np.random.default_rng(7)
    good, bad = lambda n: rng.normal(1.5, 1, n), lambda n: rng.normal(-1.5, 1, n)
    got = quality_pu.prior_of(good(6000), np.r_[good(int(6000 * share)), bad(6000 - int(6000 * share))])
    assert abs(got - share) < 0.06


def test_pack(docs, texts, empty):
    t = Tokenizer.from_file(TOKENIZER)
    want = {}
    for d, text in enumerate(texts):
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 0]
        for k in range(0, len(ids), 2048):
            want[d, k // 2048] = (k, len(ids[k : k + 2048]), zlib.crc32(np.array(ids[k : k + 2048], "<u4").tobytes()))
    rows = packing.pack(docs, TOKENIZER).collect()
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == want and len(rows) == len(want)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for s in sequences.values():
        end = 0
        for offset, length in sorted(s):
            assert offset == end
            end += length
        assert end <= 2048
    assert len(sequences) <= sum(r.length for r in rows) / 2048 + 2
    assert packing.pack(empty, TOKENIZER).count() == 0


def test_word_ids_equal_the_tokenizer():
    t, w = Tokenizer.from_file(TOKENIZER), packing.WordIds(TOKENIZER)
    odd = ["don't I'LL O'Neil's", "Ünïcödé ΣΑΣ ας ĳ İstanbul ẞ", "a1b2 3.14 ½ x²", "tab\tline\r\nend nbsp x", "é café.", "!!?? ...", "<|endoftext|> a<|startoftext|>b", "中文 한국어 ไทย", "\x1c x\x85y", "naïve,", "", " "]
    assert w.ids(odd) == [np.array(t.encode(x, add_special_tokens=False).ids, "<u4").tobytes() for x in odd]


def test_plan_uses_every_piece():
    rng = np.random.default_rng(0)
    for size, n in ((64, 5000), (64, 3), (64, 0), (16, 100)):
        counts = np.bincount(rng.integers(1, size + 1, n), minlength=size + 1)
        used = np.zeros_like(counts)
        total = 0
        for k, filling in packing.plan(counts, 4):
            assert sum(a * c for a, c in filling) <= size
            total += k
            for a, c in filling:
                used[a] += k * c
        assert (used == counts).all() and total >= -(-(counts * np.arange(size + 1)).sum() // size)


def test_quality_rules(docs, texts, empty):
    got = by_id(quality_rules.judge(docs))
    for d, t in enumerate(texts):
        w = PLAIN.findall(t or "")
        grams = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
        c = Counter(grams)
        repeats = len({k + j for k, g in enumerate(grams) if c[g] > 1 for j in range(3)})
        lines = [x for x in (t or "").split("\n") if PLAIN.search(x)]
        r = got[d]
        want = (len(w), sum(map(len, w)), sum((t or "").count(x) for x in "#*$%&|<>"), len(lines) - len(set(lines)), repeats)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (len(w) < 50 or 100 * repeats > 50 * len(w)) and not (r.kept and r.base_failed)
    assert quality_rules.judge(empty).count() == 0


def em_on_rows(votes, rounds):
    """The estimate row by row, with the pseudo-documents written out."""
    n, k = votes.shape
    shown = [min(max((votes[:, r] < 2).mean(), 0.01), 0.99) for r in range(k)]
    bad = quality_rules.BAD_VOTE
    start = np.array([[[bad[c] * s, (1 - bad[c]) * s, 1 - s] for s in shown] for c in (0, 1)])
    rates, prior = start, quality_rules.PRIOR_GOOD
    for _ in range(rounds):
        like = [np.prod([rates[c, r, votes[:, r]] for r in range(k)], axis=0) for c in (0, 1)]
        q = prior * like[1] / (prior * like[1] + (1 - prior) * like[0])
        prior = (q.sum() + quality_rules.WEIGHT * quality_rules.PRIOR_GOOD) / (n + quality_rules.WEIGHT)
        held = np.stack([1 - q, q])
        sums = np.array([[[(held[c] * (votes[:, r] == v)).sum() for v in range(3)] for r in range(k)] for c in (0, 1)]) + quality_rules.WEIGHT * start
        rates = np.maximum(sums / sums.sum(2, keepdims=True), quality_rules.LEAST)
        rates = rates / rates.sum(2, keepdims=True)
    return prior, rates


def test_quality_rules_estimate():
    """As the same EM over rows, and near the accuracies that the votes were drawn by."""
    rng = np.random.default_rng(6)
    true = np.array([[[0.5, 0.3, 0.2], [0.6, 0.3, 0.1], [0.4, 0.4, 0.2], [0.7, 0.2, 0.1]], [[0.02, 0.88, 0.1], [0.01, 0.79, 0.2], [0.05, 0.85, 0.1], [0.03, 0.9, 0.07]]])
    good = (rng.random(6000) < 0.8).astype(int)
    votes = np.stack([[rng.choice(3, p=true[c, r]) for r in range(4)] for c in good])
    counts = sorted(Counter(map(tuple, votes.tolist())).items())
    prior, p = quality_rules.estimate(counts, 4, 40)
    want_prior, want = em_on_rows(votes, 40)
    got = np.array([[p[r][c] for r in range(4)] for c in (0, 1)])
    assert abs(prior - want_prior) < 1e-9 and np.allclose(got, want, atol=1e-9)
    assert abs(prior - 0.8) < 0.03 and np.abs(got - true).max() < 0.06


def test_quality_rules_reject_by_posterior(spark):
    """Junk that passes the base rule goes, by the votes of several rules; a document that breaks one rule stays."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=rng.randint(3, 8)))
    clean = lambda: "\n".join(" ".join([*(word() for _ in range(12)), word() + "."]) for _ in range(8))
    rows = [(i, clean()) for i in range(400)]
    rows += [(1000 + i, " | ".join(clean().split(" "))) for i in range(20)] + [(2000 + i, "$$$ ".join(clean().split(" ")) + "###") for i in range(20)]
    rows += [(3000, "\n".join(x.rstrip(".") for x in clean().split("\n"))), (3001, clean() + " # *"), (None, clean())]
    got = quality_rules.judge(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert len(got) == len(rows) and not any(r.base_failed for r in got)
    assert {r.doc_id for r in got if not r.kept} == {*range(1000, 1020), *range(2000, 2020)}


def test_shards(spark, docs, texts, empty):
    for at_once in (sharding.AT_ONCE, 20):
        rows = sharding.shard(docs, at_once=at_once, units=6).collect()
        assert len(rows) == len(texts)
        groups, slots = {}, {}
        for r in rows:
            b = (texts[r.doc_id] or "").encode()
            assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(b) + 8, zlib.crc32(b), "bytes", None)
            groups.setdefault(b, set()).add(r.shard)
            slots.setdefault(r.shard, []).append(r.slot)
        assert all(len(x) == 1 for x in groups.values())
        assert all(sorted(x) == list(range(len(x))) for x in slots.values()) and set(slots) <= set(range(24))
    assert sharding.shard(empty).count() == 0


def test_differencing():
    rng = np.random.default_rng(0)
    sizes = np.r_[rng.integers(1, 1000, 2000), 100_000]
    parts = np.bincount(sharding.difference(sizes, 8), weights=sizes, minlength=8)
    small = np.sort(parts)[:7]
    assert parts.max() <= max(100_000, sizes.sum() / 8 * 1.01) + 1000 and small.max() - small.min() <= 10
    assert len(sharding.difference(np.zeros(0, np.int64), 8)) == 0


def test_queries_equal_sql(spark, sf):
    from oracle import differences, views

    from lexmesh.llm import oracles, queries

    con = views(sf)
    for name, sql in oracles.oracle_sql().items():
        assert differences(spark, con, queries.queries()[name], sql, sf) == "", name


def test_pipeline(spark, sf):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, n = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf).cache()
        assert docs.columns == columns, name
        assert 0.6 * n < docs.count() <= n, name
        n = docs.count()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert packed.select("doc_id").distinct().count() == n


def test_rows_without_ids_and_repeated_rows(spark):
    """Packing, rules and shards take them as rows of their own."""
    text = "Some words of a text that is whole. " * 20
    rows = [(None, text), (None, text), (None, None), (3, text), (3, text), (3, "other words"), (4, ""), (4, "")]
    table = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, length int, Shard int").repartition(3)
    ids = Counter(d for d, _ in rows)
    packed = packing.pack(table, TOKENIZER).collect()
    assert Counter(r.doc_id for r in packed) == ids and all(r.piece == 0 for r in packed)
    places = sorted((r.sequence_id, r.offset, r.length) for r in packed)
    assert all(a[0] != b[0] or a[1] + a[2] == b[1] for a, b in zip(places, places[1:], strict=False))
    judged = quality_rules.judge(table).collect()
    assert Counter(r.doc_id for r in judged) == ids and len({r.kept for r in judged if r.n_words > 50}) == 1
    dealt = sharding.shard(table).collect()
    assert Counter(r.doc_id for r in dealt) == ids
    slots = {}
    for r in dealt:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    by_text = {}
    for r in dealt:
        by_text.setdefault((r.text_crc32, r.size), set()).add(r.shard)
    assert all(len(x) == 1 for x in by_text.values())


@pytest.mark.parametrize("empty_table", [False, True])
def test_pipeline_on_odd_tables(spark, sf, tmp_path, empty_table):
    """Nulls, empty texts, repeated rows, ids of several texts and columns that clash."""
    import corpus_pipeline

    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{sf}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    rng = random.Random(2)
    good = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").filter("length(text) between 500 and 3000").orderBy("doc_id").limit(12).collect()]
    rows = [(i, t) for i, t in enumerate(good)] + [(0, good[1]), (1, good[1]), (None, good[2]), (None, good[2]), (None, None), (50, None), (51, ""), (51, ""), (52, "\n\n"), (53, good[3] + "\n" + good[4])]
    rng.shuffle(rows)
    schema = "doc_id long, text string, lang string, source string, n_chars int, Score double, predicted int, line_row long, lines_gone int, n_lines int, worded int, jaccard_row int"
    table = spark.createDataFrame([(*r, None, "s", 1, 0.5, 1, 2, 3, 4, 5, 6) for r in rows], schema).repartition(3)
    docs = table.limit(0) if empty_table else table
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path)).cache()
        assert docs.columns == table.columns and dict(docs.dtypes) == dict(table.dtypes), name
        docs.count()
    kept = [(r.doc_id, r.text) for r in docs.collect()]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
    assert Counter(r.doc_id for r in packed if r.piece == 0) == Counter(d for d, _ in kept)
    worded = [t for _, t in kept if words(t, ALNUM)]
    assert len(worded) == len(set(worded)) and (empty_table or worded)
