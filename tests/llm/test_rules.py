"""Filter audit, token alignment and line rules against brute force and odd input."""

import hashlib
import itertools
import re
from collections import Counter, defaultdict
from itertools import accumulate, permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from stationlake.llm import alignment, filter_audit, line_rules, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- op11 -------------------------------------------------------------------


def failures(docs):
    """Failed letters per row (doc_id, text, lang), by definition."""
    smallest = {}
    for i, t, _ in docs:
        if i is not None:
            smallest[t or ""] = min(i, smallest.get(t or "", i))
    out = []
    for i, t, _ in docs:
        t = t or ""
        w = WORD.findall(t)
        f = "A" * (len(w) < 100) + "B" * (100 * len(set(w)) < 80 * len(w))
        f += "C" * (100 * len(re.findall("[A-Z]", t)) > 10 * len(t)) + "D" * bool(re.search("[#$%&*|]", t))
        out.append(f + "E" * (i is not None and i > smallest[t]))
    return out


def brute_audit(docs, good, toxic):
    """Every order replayed document by document."""
    fails, rows = failures(docs), {}
    for part in {x or "" for _, _, x in docs}:
        mine = [(i, f) for (i, _, x), f in zip(docs, fails) if (x or "") == part]
        shapley = Counter()
        for order in permutations("ABCDE"):
            left = mine
            for step, k in enumerate(order, 1):
                gone = [d for d in left if k in d[1]]
                left = [d for d in left if k not in d[1]]
                shapley[k] += len(gone)
                failing = [f for _, f in mine if k in f]
                lost = [sum(i in s for i, _ in gone) for s in (good, toxic)]
                rows[part, "".join(order), step] = [len(left), len(gone), len(failing) - len(gone), failing.count(k), *lost, k]
        for key in rows:
            if key[0] == part:
                rows[key][-1] = shapley[rows[key][-1]]
    return rows


COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def audited(df):
    return {(r["part"], r.filter_order, r.step): [r[c] for c in COUNTS] for r in df.collect()}


def test_audit_brute_force(spark, sf):
    docs = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    labels = spark.read.parquet(f"{sf}/labels.parquet").collect()
    good, toxic = ({r.doc_id for r in labels if r[c] == 1} for c in ("quality", "toxic"))
    got = audited(queries.op11_filter_audit(spark, sf))
    want = brute_audit(docs, good, toxic)
    assert len(want) == 600 * len({x for _, _, x in docs}) and got == want


@pytest.mark.parametrize("broadcast", [True, False])
def test_audit_odd_rows(spark, monkeypatch, broadcast):
    """NULLs anywhere, copies in another language, repeated rows and labels, clashing names."""
    monkeypatch.setattr(filter_audit, "MAX_BROADCAST_COPIES", 1000 if broadcast else 0)
    long = " ".join(f"w{i}" for i in range(120))
    docs = [(1, None, None), (2, "", ""), (3, long, "en"), (3, long, "en"), (4, long, "de"), (None, long, "en"), (None, None, "de")]
    docs += [(5, long + " #", "en"), (6, "AB " * 150, "en"), (7, "x" * 50_000, "de"), (8, "x" * 50_000, "de"), (9, long, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    for c in ("part", "mask", "A", "E", "digest", "first", "good", "w0", "quality"):
        df = df.withColumn(c, F.lit("1"))
    labels = spark.createDataFrame([(3, 1, 0), (3, 0, None), (4, None, 1), (None, 1, 1), (99, 1, 1)], "doc_id long, quality int, toxic int")
    got = audited(filter_audit.audit_documents(df, labels))
    assert got == brute_audit(docs, {3}, {4})
    assert filter_audit.audit_documents(df.limit(0), labels).count() == 0
    assert filter_audit.audit_documents(df, labels.limit(0)).where("good_lost + toxic_lost > 0").count() == 0


def test_min_plus_steps():
    """The removal step of every mask and order is the first failing filter's place."""
    steps = filter_audit.positions(4)
    masks = np.arange(16)
    got = filter_audit.removal_steps(masks, steps)
    for o, order in enumerate(permutations(range(4))):
        for m in masks:
            places = [p for p, f in enumerate(order, 1) if m >> f & 1]
            assert got[m, o] == min(places, default=5)


# --- op12 -------------------------------------------------------------------

A, B = (queries.public_vocabulary(*x) for x in (("byte_bpe_50k.json", "STATIONLAKE_BYTE_BPE"), ("piece_bpe_32k.model", "STATIONLAKE_PIECE_BPE")))


@pytest.fixture(scope="module")
def tokenizers():
    """Both libraries, and the bytes of every token, by other means than the operator's."""
    import sentencepiece
    from tokenizers import Tokenizer, decoders

    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    # The standard table of the byte-level alphabet, from the library's own pre-tokenizer.
    from tokenizers import pre_tokenizers

    split = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    table = {}
    for cp in [*range(0x80), *range(0x80, 0x800, 0x40), *range(0x80, 0xC0), *range(0x800, 0x10000, 0x1000), *range(0x10000, 0x110000, 0x40000)]:
        if not 0xD800 <= cp < 0xE000:
            table |= dict(zip(split.pre_tokenize_str(chr(cp))[0][0], chr(cp).encode()))
    b = sentencepiece.SentencePieceProcessor(model_file=B)

    def bytes_a(i):
        token = a.id_to_token(i)
        return bytes(table[c] for c in token)

    def bytes_b(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:-1], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode()

    return a, b, bytes_a, bytes_b


def brute_alignment(docs, tokenizers):
    """Per document the contract's numbers, from byte ranges compared pair by pair."""
    a, b, bytes_a, bytes_b = tokenizers
    held, per = Counter(), []
    for text in docs:
        ta = a.encode(" " + text, add_special_tokens=False).ids if text else []
        tb = b.encode(text) if text else []
        raw = (" " + (text or "")).encode()
        if not text or b"".join(map(bytes_a, ta)) != raw or b"".join(map(bytes_b, tb)) != raw:
            ta = tb = []
        ranges = []
        for ids, of in ((ta, bytes_a), (tb, bytes_b)):
            ends = list(accumulate(len(of(i)) for i in ids))
            ranges.append(list(zip(ids, [0, *ends], ends)))
        ra, rb = ranges
        links, start = [], 0
        for x, s, e in ra:  # ranges are in order, so b's that end before s can be passed over
            while start < len(rb) and rb[start][2] <= s:
                start += 1
            for y, s2, e2 in itertools.takewhile(lambda r: r[1] < e, rb[start:]):
                links.append((x, y))
        cuts = sorted({e for *_, e in ra} & {e for *_, e in rb})
        groups, last = [], 0
        for c in cuts:
            side = [",".join(str(x) for x, s, e in r if last <= s and e <= c) for r in ranges] if len(cuts) < 400 else None
            groups.append("|".join(side) if side else None)
            last = c
        held.update(set(links))
        per.append((len(ta), len(tb), len(cuts), links, groups))
    top = defaultdict(int)
    for (x, _), n in held.items():
        top[x] = max(top[x], n)
    out = []
    for na, nb, n, links, groups in per:
        best = sum(held[p] == top[p[0]] for p in links)
        text = ";".join(groups) if None not in groups else None
        digest = hashlib.sha256(text.encode()).hexdigest() if text else "" if text == "" else None
        out.append((na, nb, n, len(links), best, sum(held[p] for p in links), digest))
    return out


def scored(df):
    return [(r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.orderBy("doc_id").collect()]


def same(got, want):
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:6] == w[:6] and (w[6] is None or g[6] == w[6])


def test_alignment_brute_force(spark, sf, tokenizers):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    same(scored(queries.op12_alignment(spark, sf)), brute_alignment([t for _, t in docs], tokenizers))


ODD_TEXTS = [None, "", " ", "\n", "<|endoftext|> <s>x</s> <unk> <0x0A>", "  two  spaces ", "▁under▁", "é ﬁ ½ 　", "\U0001f600\U0001f468‍\U0001f469", "a\x00b", "Donaudampfschifffahrt", "ab " * 20_000, "z" * 30_000, "same", "same"]


@pytest.mark.parametrize("broadcast", [True, False])
def test_alignment_odd_rows(spark, tokenizers, monkeypatch, broadcast):
    """Odd texts, clashing columns and both ways to look the counts up."""
    if not broadcast:
        monkeypatch.setattr(alignment, "MAX_BROADCAST_PAIRS", 0)
    df = spark.createDataFrame(list(enumerate(ODD_TEXTS)), "doc_id long, text string").repartition(3)
    for c in ("doc", "e", "links", "pair", "n", "_row", "_s", "times", "n_a", "best"):
        df = df.withColumn(c, F.lit(7))
    out = alignment.align_documents(df, A, B)
    same(scored(out), brute_alignment(ODD_TEXTS, tokenizers))
    rows = out.collect()
    assert {r["doc"] for r in rows} == {7} and {r["_row"] for r in rows} == {7} and "text" not in out.columns
    assert all(hashlib.sha256(r.groups.encode()).hexdigest() == r.groups_sha256 if r.groups else r.groups_sha256 == "" for r in rows)
    assert alignment.align_documents(df.limit(0), A, B).count() == 0
    assert alignment.align_documents(df.select("text"), A, B).count() == len(ODD_TEXTS)


SPACES = [" ", "  ", "\n", " \n", "\t ", "\u00a0", " \u2003", "\x1c", "\u3000 ", "\r\n"]


def test_words_are_tokenized_alone(tokenizers):
    """Piece by piece, with a cache too small for them, gives what the libraries give for whole texts."""
    a, b, *_ = tokenizers
    r = np.random.default_rng(3)
    words = ["foo", "Bar's", "x1y2", "…!?", "don't", "ÄÖ", "12345", "日本語", "_", "'s", "e\u0301", "<s>", "▁", "a▁b", "\U0001f600", "²½"]
    texts = ["".join(str(r.choice(words)) + str(r.choice(SPACES, p=[0.8, *[0.2 / 9] * 9])) for _ in range(int(r.integers(1, 25)))) for _ in range(400)]
    texts += [t.strip() for t in texts] + [" ".join(t.split()) for t in texts]
    alone = alignment.Aligner(alignment.Tokenizers(open(A, encoding="utf-8").read(), open(B, "rb").read()))
    assert alone.both.by_word
    found = []
    for k in range(0, len(texts), 50):
        found += alone.align(texts[k : k + 50])
    for text, pieces in zip(texts, found):
        ids = next(alone.both.encode([" " + text]))
        if not text or ids is None:  # the stand-in of a space is no byte of the text
            assert pieces == [] and (not text or "▁" in text)
            continue
        assert ids == (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text))
        whole = alignment.align(*ids, alone.both.size_a, alone.both.size_b)[0]
        assert sum(p.tokens for p in pieces) == len(ids[0]) << 32 | len(ids[1])
        assert ";".join(p.groups for p in pieces) == whole.groups and b"".join(p.links for p in pieces) == whole.links


def test_links_round_trip():
    links = [(5, 9), (70_000, 2**31), (5, 9), (5, 1)]
    pairs, times = alignment.unpack(alignment.pack(np.array([x << 32 | y for x, y in links]).tobytes()))
    assert {(int(p) >> 32, int(p) & 0xFFFFFFFF): int(n) for p, n in zip(pairs, times)} == Counter(links)
    assert [len(x) for x in alignment.unpack(alignment.pack(b""))] == [0, 0]


# --- op13 -------------------------------------------------------------------


def brute_rules(docs, min_docs, share, lost):
    """(doc_id, text, host) -> the judged columns."""

    def norm(line):
        return " ".join(WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), line)))

    held, hosts = defaultdict(set), defaultdict(set)
    for _, t, h in docs:
        hosts[h or ""].add(t or "")
        for line in (t or "").split("\n"):
            if norm(line):
                held[h or "", norm(line)].add(t)
    out = []
    for i, t, h in docs:
        t, h = t or "", h or ""
        w = WORD.findall(t)
        windows = defaultdict(list)
        for p in range(len(w) - 7):
            windows[tuple(w[p : p + 8])].append(p)
        again = {q for ps in windows.values() if len(ps) > 1 for p in ps for q in range(p, p + 8)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        removed = [
            k for k, x in enumerate(t.split("\n"), 1)
            if norm(x) and len(held[h, norm(x)]) > min_docs and len(held[h, norm(x)]) * 100 > len(hosts[h]) * share
        ]
        gone = sum(len(WORD.findall(t.split("\n")[k - 1])) for k in removed)
        failed = len(w) < 20 or 100 * len(again) > 30 * len(w)
        out.append((i, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(again), failed, removed, gone, not failed and gone * 100 <= len(w) * lost))
    return out


def judged(df):
    return [(r.doc.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.removed, r.n_lost, r.kept) for r in df.collect()]


def ordered(rows):
    return sorted(rows, key=repr)


RULE_DOCS = [(1, None, "h"), (2, "", None), (3, " \n\t\n ", "h"), (None, "a b\n" * 30, "h"), (None, None, None), (5, "x" * 60_000, "h")]


@pytest.mark.parametrize("broadcast", [True, False])
def test_line_rules_brute_force(spark, monkeypatch, broadcast):
    """Boilerplate of hosts of different sizes, copies, repeated passages, NULLs and clashing names."""
    if not broadcast:
        monkeypatch.setattr(line_rules, "MAX_BROADCAST_LINES", 0)
    r = np.random.default_rng(5)

    def text():
        return " ".join(f"w{i}" for i in r.integers(0, 3000, int(r.integers(15, 60))))

    docs, foot = list(RULE_DOCS), "Follow us   on\tthe Network * today and every other day of the week"
    passage = text()
    for i in range(150):
        own, host = text(), f"h{i % 3}" if i % 7 else None
        lines = [own]
        if i % 3 == 0:
            lines += [foot.upper() if i % 2 else " " + foot] * (1 + i % 4)
        if i % 5 == 0:
            lines.insert(0, f"{passage}\n{passage} {i}")
        docs.append((10 + i, "\n".join(lines), host))
        if i % 10 == 0:
            docs += [docs[-1]] * 3 + [(1000 + i + k, docs[-1][1], host) for k in range(20)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(5)
    for c in ("doc", "host", "rid", "k1", "n_words", "_t", "_w", "pos", "gone", "th", "kept"):
        df = df.withColumn(c, F.lit("1"))
    want = brute_rules(docs, 8, 3, 40)
    got = judged(line_rules.judge(df, min_docs=8, share_percent=3, max_lost_percent=40))
    assert ordered(got) == ordered(want)
    assert len({x[-1] for x in want}) == 2 and any(x[7] for x in want) and any(x[5] for x in want)


def test_line_rules_cut_text(spark):
    """The kept texts lose their frequent lines and nothing else."""
    body = [" ".join(f"d{i}x{j}" for j in range(40)) for i in range(10)]
    docs = [(i, f"menu of the site\n{b}\n\n Menu of  the SITE", "s", i) for i, b in enumerate(body)]
    docs += [(99, "menu of the site\n" * 20 + "few words left", "s", 1), (98, None, "s", 2)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string, removed int")
    out = line_rules.keep_good(df, min_docs=3)
    assert out.columns == df.columns
    assert ordered(map(tuple, out.collect())) == ordered((i, f"{b}\n", "s", i) for i, b in enumerate(body))
    plain = line_rules.keep_good(df)  # no line is above the limits: texts stay as they are
    assert {r.doc_id: r.text for r in plain.collect()} == {i: t for i, t, *_ in docs if i < 98}
    assert line_rules.judge(df.limit(0)).count() == 0 and line_rules.keep_good(df.limit(0)).count() == 0


def test_line_rules_are_native(spark, sf, monkeypatch):
    """No plan of the query, those of written tables included, has Python in it."""
    plans = []

    for fn in ("materialize", "materialize_counted"):
        write = getattr(line_rules, fn)
        monkeypatch.setattr(line_rules, fn, lambda df, name, write=write, **c: (plans.append(df._jdf.queryExecution().toString()), write(df, name, **c))[1])
    plans.append(queries.op13_line_rules(spark, sf)._jdf.queryExecution().toString())
    assert len(plans) == 3 and not any(re.search("Python|Pandas|Arrow", p) for p in plans)


def test_brute_force_tests_exist():
    """Every query without SQL names a test that is there."""
    import os

    here = os.path.dirname(__file__)
    for name, test in queries.BRUTE_FORCE.items():
        file, function = test.split("::")
        assert name in queries.QUERIES and f"def {function}(" in open(os.path.join(here, file)).read()
    assert set(queries.QUERIES) == set(queries.BRUTE_FORCE) | set(queries.ORACLE)
