"""Line dedup, sharding, sketches and decontamination against brute force and odd input."""

import hashlib
import math
import re
import struct
import zlib
from collections import Counter, defaultdict

import xxhash
from pyspark.sql import functions as F

from stationlake.llm import decontaminate, fingerprint, line_dedup, queries, sharding

ODD = [(1, None), (2, ""), (3, "   \n\n\n  "), (None, "a b\nc d\ne f"), (None, None), (5, "x" * 60_000), (6, "one\ntwo\nthree"), (6, "one\ntwo\nthree")]
CLASH = ["id", "th", "m", "d", "w", "h", "rid", "pos", "shard", "n_lines"]


def plans_without_python(df):
    plan = df._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_line_dedup_brute_force(make):
    a = "l1\nl2\nl3\nl4\nl5"
    rows = line_dedup.dedup_lines(make([(1, a), (2, "x\nl2\nl3\nl4\ny"), (3, a), (4, "l1\nl2"), (9, None), (10, "")])).collect()
    out = {r.doc_id: r for r in rows}
    assert out[1].text == a and out[1].n_removed == 0
    assert out[2].text == "x\ny" and out[2].n_removed == 3
    assert out[3].text == "" and out[3].n_removed == 5
    assert out[4].text == "l1\nl2" and out[9].text is None and out[9].n_lines == 0 and out[10].text == ""


def test_line_dedup_short_texts(make):
    """A text of one or two lines is one window, if asked for."""
    docs = make([(1, "a b"), (2, "a b"), (3, "c\nd"), (4, "c\nd"), (4, "c\nd"), (5, "c\nd\ne"), (6, "a b\nx"), (7, " "), (8, " "), (9, None), (10, ""), (11, "")])
    out = {(r.doc_id, r.text, r.n_removed) for r in line_dedup.dedup_lines(docs, short=True).collect()}
    assert out == {(1, "a b", 0), (2, "", 1), (3, "c\nd", 0), (4, "", 2), (5, "c\nd\ne", 0), (6, "a b\nx", 0), (7, " ", 0), (8, " ", 0), (9, None, 0), (10, "", 0), (11, "", 0)}
    assert all(r.n_removed == 0 for r in line_dedup.dedup_lines(docs).collect())


def test_line_dedup_odd_rows_and_clashing_columns(make):
    docs = make(ODD)
    for c in CLASH:
        docs = docs.withColumn(c, F.lit(1))
    out = line_dedup.dedup_lines(docs)
    assert set(CLASH) <= set(out.columns)
    rows = out.collect()
    assert len(rows) == len(ODD)
    # A row repeated with its doc_id is one document: nothing is removed from it.
    assert [r.text for r in rows if r.doc_id == 6] == ["one\ntwo\nthree"] * 2
    assert line_dedup.dedup_lines(make([])).count() == 0


def test_sharding_law(make, sf, spark):
    rows = queries.op3_sharding(spark, sf).collect()
    for r in rows:
        assert r.grown_shard in (r.shard, 8)
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(8))
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert r.size == len(raw) + 1 and r.text_crc32 == zlib.crc32(raw)
    odd = sharding.assign_shards(make(ODD)).collect()
    assert len(odd) == len(ODD) and sharding.assign_shards(make([])).count() == 0


def test_sharding_weights(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    n = Counter(r.shard for r in sharding.assign_shards(docs, 2, [1.0, 3.0]).collect())
    assert abs(n[1] / 20_000 - 0.75) < 0.02


def test_sharding_brute_force(spark):
    """Every record's shard by its scores, computed one by one, and the slots by sorting; clashing columns."""
    weights = [1.0, 2.5, 0.5, 1.0]
    docs = [(i * 7919 % 1000, f"t{i % 9}" if i % 5 else None) for i in range(600)] + [(None, "x"), (None, None), (5, "same"), (5, "same")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    for c in ("shard", "slot", "rank", "size", "_pid", "_idx", "law", "neg", "score"):
        df = df.withColumn(c, F.lit("1"))

    def shard(key, weights):
        scores = []
        for s, w in enumerate(weights):
            seed = 42 if key is None else xxhash.xxh64_intdigest(struct.pack("<q", key), 42)
            u = ((xxhash.xxh64_intdigest(struct.pack("<i", s), seed) >> 11) + 0.5) / (1 << 53)
            scores.append((-w / math.log(u), -s))
        return -max(scores)[1]

    want = defaultdict(list)
    for i, t in docs:
        raw = (t or "").encode()
        want[shard(i, weights)].append((i is not None, i or 0, zlib.crc32(raw), len(raw) + 1, shard(i, [*weights, 1.0])))
    got = defaultdict(list)
    for r in sharding.assign_shards(df, 4, weights).orderBy("shard", "slot").collect():
        assert r.slot == len(got[r.shard])
        got[r.shard].append((r.doc_id is not None, r.doc_id or 0, r.text_crc32, r["size"], r.grown_shard))
    assert got == {s: sorted(rows) for s, rows in want.items()}


def test_fingerprints_with_clashing_columns(make):
    docs = make([(1, "a b c d e f g"), (2, "a b c d e f h"), (3, None)])
    plain = sorted(map(tuple, fingerprint.edited_fingerprints(docs).collect()))
    for c in ("sketch", "head", "th", "rank", "prev_id", "edited", "n", "_sketch_w"):
        docs = docs.withColumn(c, F.lit("1"))
    assert sorted(map(tuple, fingerprint.edited_fingerprints(docs).collect())) == plain


def edited(texts):
    out = []
    for i, t in enumerate(texts):
        q = len(t) // 4
        out.append(t[: len(t) - q] + texts[(i + 1) % len(texts)][:q])
    return out


def test_fingerprints_brute_force(spark, sf):
    docs = sorted((r.doc_id, r.text or "") for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    want = dict(zip([i for i, _ in docs], edited([t for _, t in docs])))
    got = {r.doc_id: r for r in queries.op7_scaled_sketch(spark, sf).collect()}
    assert len(got) == len(docs)

    def shingles(t):
        w = t.lower().split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    texts, off = dict(docs), []
    for i, t in want.items():
        assert got[i].edited_sha256 == hashlib.sha256(t.encode()).hexdigest()
        a, b = shingles(texts[i]), shingles(t)
        if len(a) > 400:
            off.append(abs(len(a & b) / len(a | b) - got[i].near_edited))
    assert sum(off) / len(off) < 0.06
    same = defaultdict(set)
    for i, t in docs:
        same[t].add(got[i].fingerprint)
    assert all(len(v) == 1 for v in same.values())


def test_fingerprint_odd_rows(make):
    out = fingerprint.edited_fingerprints(make(ODD)).collect()
    assert len(out) == len(ODD)
    assert {r.fingerprint for r in out if r.n_chars == 0} == {""}
    assert fingerprint.edited_fingerprints(make([])).count() == 0
    alone = fingerprint.edited_fingerprints(make([(1, "a b c d e f g h")])).first()
    assert alone.edited_sha256 == hashlib.sha256(edited(["a b c d e f g h"])[0].encode()).hexdigest()


def test_sketch_merge(spark):
    df = spark.createDataFrame([(" ".join(f"w{i}" for i in range(400)), " ".join(f"w{i}" for i in range(200, 600)))], "a string, b string")
    df = fingerprint.with_sketch(fingerprint.with_sketch(df, F.col("a"), "sa"), F.col("b"), "sb")
    r = df.select(fingerprint.merge(F.col("sa"), F.col("sb")).alias("m"), "sa", "sb").first()
    assert r.m == sorted(set(r.sa) | set(r.sb))


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute_hits(text, items):
    w, hit, found = words(text), set(), set()
    for item, t in items:
        b = words(t)
        k = min(13, len(b))
        grams = {tuple(b[i : i + k]) for i in range(len(b) - k + 1)} if b else set()
        for p in range(len(w) - k + 1):
            if tuple(w[p : p + k]) in grams:
                hit |= set(range(p, p + k))
                found.add(str(item))
    return len(w), len(hit), sorted(found)


def test_decontamination_short_items_and_odd_rows(make, spark):
    long = " ".join(f"t{i}" for i in range(30))
    items = [(1, long), (2, "short one"), (3, ""), (4, None), (10, "É Maße 7"), (11, long.upper())]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = [(21, "zz " + long + " yy"), (22, "Short, ONE! and more"), (3, "é maße 7"), (4, "É MAßE 7"), *ODD, (8, " ".join(["pad"] * 500) + " short one")]
    frame = make(docs)
    for c in CLASH:
        frame = frame.withColumn(c, F.lit(1))
    got = decontaminate.scan(frame, bench).collect()
    assert len(got) == len(docs)
    want = Counter((i, *map(str, brute_hits(t, items))) for i, t in docs)
    assert Counter((r.doc.doc_id, str(r.n_words), str(r.n_hit), str(r["items"])) for r in got) == want
    kept = decontaminate.drop_contaminated(frame, bench)
    ids = {r.doc_id for r in kept.collect()}
    assert kept.columns == frame.columns and ids >= {8, 5, 6} and not {21, 22} & ids
    cut = {r.doc_id: r.text for r in decontaminate.remove_spans(frame, bench).collect()}
    assert cut[22] == ", ! and more" and cut[21] == "zz " + " " * 30 + "yy" and cut[8] == docs[-1][1]
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.drop_contaminated(frame, none).count() == len(docs)
    assert decontaminate.scan(make([]), bench).count() == 0


def test_decontamination_without_broadcast(make, spark, monkeypatch):
    bench = spark.createDataFrame([(1, " ".join(f"t{i}" for i in range(20)))], "item_id long, text string")
    docs = make([(1, "a " + " ".join(f"t{i}" for i in range(15))), (2, "clean")])
    pick = lambda df: sorted((r.doc.doc_id, r.n_hit) for r in df.collect())
    one = pick(decontaminate.scan(docs, bench))
    monkeypatch.setattr(decontaminate, "MAX_BROADCAST_WINDOWS", 0)
    assert pick(decontaminate.scan(docs, bench)) == one == [(1, 15), (2, 0)]


def test_native_plans(spark, sf):
    for name in ("op1_line_dedup", "op3_sharding", "op7_scaled_sketch", "op8_decontamination", "op2_pii"):
        plans_without_python(queries.QUERIES[name](spark, sf))
