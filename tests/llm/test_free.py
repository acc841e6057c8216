"""Join, BPE, archives, page text, quality, PII and the pipeline against brute force and odd input."""

import hashlib
import html
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from stationlake.llm import bpe, html_diff, ngram_join, pii, quality, queries, warc

ODD = [(1, None), (2, ""), (3, " \n "), (None, "a b c d"), (None, None), (5, "x " * 30_000), (6, "p q r s t"), (6, "p q r s t"), (7, "one two")]


def sets(text, n):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()


def brute_components(docs, n, percent):
    s = {i: sets(t, n) for i, t in docs}
    root = {i: i for i in s}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(s)
    for a in ids:
        for b in ids:
            if a < b and s[a] and s[b]:
                both = len(s[a] & s[b])
                if 100 * both >= percent * (len(s[a]) + len(s[b]) - both):
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    return {i: (len(s[i]), find(i)) for i in ids}


@pytest.mark.parametrize("n, percent", [(3, 90), (5, 80)])
def test_join_brute_force(spark, make, n, percent):
    r = np.random.default_rng(2)
    base = [f"w{i}" for i in r.integers(0, 5000, 160)]
    docs = []
    for i in range(140):  # a crowd of edited copies on both sides of the threshold, copies of copies among them
        w = list(base) if i % 3 else docs[-1][1].split() if docs else list(base)
        for at in r.integers(0, len(w), int(r.integers(0, 9))):
            w[at] = f"e{r.integers(0, 40)}"
        docs.append((i, " ".join(w)))
    docs += [(500, None), (501, "")]
    docs += [(200 + i, " ".join(base[:k])) for i, k in enumerate((1, 2, 3, 8, 9, 10, 11, 19, 20, 21, 150, 155))]
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in ngram_join.jaccard_components(make(docs), n, percent).collect()}
    assert got == brute_components(docs, n, percent)


def test_join_odd_rows(spark, make):
    got = ngram_join.jaccard_components(make([*ODD, (8, "P q R s T"), (9, "other text here now"), (9, "p q r s t")])).collect()
    by = defaultdict(list)
    for r in got:
        by[r.doc_id].append((r.n_shingles, r.component_id))
    assert by[1] == by[2][:1] == [(0, 1)] or by[1] == [(0, 1)] and by[2] == [(0, 2)]
    assert by[6] == [(3, 6)] * 2 and by[8] == [(3, 6)] and sorted(by[9]) == [(2, 9), (3, 6)] and by[7] == [(1, 7)]
    assert {c for _, c in by[None]} == {None} and len(by[None]) == 2
    assert ngram_join.jaccard_components(make([])).count() == 0
    kept = ngram_join.keep_one(make(ODD).withColumn("node", F.lit(1)))
    assert kept.columns == ["doc_id", "text", "node"] and kept.count() == len(ODD) - 1


def test_bpe_is_the_library(spark, sf):
    tokenizers = pytest.importorskip("tokenizers")
    tk = tokenizers.Tokenizer.from_file(queries.word_vocabulary())
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    odd = ["", " \n", "<|endoftext|>x<|startoftext|> <|endoftext|", "ΑΣ ΟΔΟΣ. İI'LL don't 12345", "a" * 30_000, "!" * 999, "hé\x1c\x85　w​﻿ \U0001f600"]
    texts |= {-1 - i: t for i, t in enumerate(odd)}
    rows = [*texts.items(), (-100, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in bpe.encode(docs.withColumn("e", F.lit(1)), queries.word_vocabulary(), size=500).collect()}
    for i, t in rows:
        ids = tk.encode(t or "", add_special_tokens=False).ids
        assert got[i].ids == ids and got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(tk.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert bpe.encode(docs.limit(0), queries.word_vocabulary()).count() == 0


def test_pieces_decode_as_the_whole(spark, monkeypatch):
    """Texts decoded run by run, with a small memory, are the decoded ids."""
    vocab = bpe.Vocabulary(bpe.load_vocabulary(queries.word_vocabulary()))
    coder = bpe.Encoder(vocab, bpe.Lexicon(bpe.Lexicon.build({w: vocab.merge(w) for w in ("the", "cat")})))
    monkeypatch.setattr(bpe, "WORD_CACHE", 3)
    decoder = bpe.Decoder(coder)
    for text in ("", "The cat, the cat's hat. <|endoftext|>the é\x1c\x85 \ufeff x", "a b c d e f a b", "<|endoftext|>"):
        pieces = coder.pieces(text)
        assert b"".join(pieces) == coder.encode(text) and decoder.text(pieces) == coder.decode(coder.encode(text))


def test_lexicon_is_minimal_and_exact():
    words = {a + b + c: [i, j, k] for i, a in enumerate(("un", "re", "")) for j, b in enumerate(("do", "tie", "é")) for k, c in enumerate(("", "s", "ing"))}
    lex = bpe.Lexicon.mapped(bpe.Lexicon.build(words))
    for w, ids in words.items():
        assert np.frombuffer(lex.get(w), "<u4").tolist() == ids
    assert lex.get("und") is None and lex.get("x") is None and lex.get("") is None
    # Equal endings are one set of states: far fewer than the letters of all words.
    assert len(lex.final) <= 16
    assert bpe.Lexicon.mapped(bpe.Lexicon.build({})).get("a") is None


PAGES = "page_id long, url string, html string"


def test_archives(spark):
    big, small = "<p>" + "é" * 60 + "</p>", "<p>x</p>"
    rows = [(3, "u3", big), (1, "u1", big), (2, None, big), (4, "u4", small), (5, "u5", small), (6, "u6", None), (7, "u7", "a\r\n\r\nWARC/1.1\r\n\r\nb" * 9), (7, "u7", "a\r\n\r\nWARC/1.1\r\n\r\nb" * 9), (None, "n", big), (8, "u8", big), (8, "u8", big)]
    got = warc.archive_pages(spark.createDataFrame(rows, PAGES).withColumn("first", F.lit(1)), payloads=True).collect()
    assert len(got) == len(rows)
    seen = sorted((r.metadata.page_id if r.metadata.page_id is not None else -1, r.response.type, r.original.page_id if r.original else None) for r in got)
    assert seen == sorted([(3, "revisit", 1), (1, "response", None), (2, "revisit", 1), (4, "response", None), (5, "response", None), (6, "response", None), (7, "response", None), (7, "response", None), (-1, "revisit", 1), (8, "revisit", 1), (8, "revisit", 1)])
    for r in got:
        if r.metadata.page_id == 7:
            assert bytes(r.response.payload) == rows[6][2].encode()
        assert r.request.concurrent_to == r.response.id == r.metadata.concurrent_to
    assert warc.archive_pages(spark.createDataFrame([], PAGES)).count() == 0


def test_page_text_of_articles(spark, sf):
    got = {r.page_id: r for r in queries.op5_page_diff(spark, sf).collect()}
    rows = spark.read.parquet(f"{sf}/pages.parquet").collect()
    assert len(got) == len(rows)
    for r in rows:
        body = r.html[r.html.index("<article>") + 9 :].split("</article>")[0]
        blocks = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>", "", re.sub("<br>", " ", body)))
        want = [" ".join(html.unescape(b).split()) for b in blocks]
        assert got[r.page_id].text == "\n".join(b for b in want if b)
        assert got[r.page_id].n_chars == len(got[r.page_id].text)


def test_page_differencing(spark):
    def page(own):
        return f"<html><head><title>t</title></head><body><div>Site name</div><div class='sidebar-box'>ad</div><div>{own}</div><form>q</form><div>All rights</div><script>var a='<p>no</p>'</script></body></html>"

    rows = [(i, f"http://h.example/a/{i}?x={i}", page(f"Text &amp; more &#233; {i}")) for i in range(5)]
    rows += [(10, "http://other.example/a", page("Alone")), (11, None, None), (12, "", ""), (13, "http://h.example/a/9", "no markup < at all &am"), (14, "x", "<p>" * 2000 + "deep" + "<article>kept<p>cut of"), (15, "http://h.example/a/8", "<div>broken <a href='x")]
    got = {r.page_id: r.text for r in html_diff.extract(spark.createDataFrame(rows, PAGES).withColumn("row", F.lit(1))).collect()}
    assert [got[i] for i in range(5)] == [f"Text & more é {i}" for i in range(5)]
    assert got[10] == "Site name\nAlone\nAll rights" and got[11] == got[12] == "" and got[13] == "no markup < at all &am"
    assert got[14] == "deep\nkept\ncut of" and got[15] == "broken"
    assert html_diff.extract(spark.createDataFrame([], PAGES)).count() == 0


@pytest.mark.parametrize("wrap", ["form runat=server", "div class='has-sidebar'", "div class=no-sidebar", "div id=page class='site header-fixed'", "div class=nav-open"])
@pytest.mark.parametrize("part", ["article", "main"])
def test_main_part_inside_noise(wrap, part):
    page = f"<body><{wrap}><p>Menu</p><{part}><header>Title</header><p>Own text<nav>pages</nav><form>q</form><p>more</{part}><p>Below</p></{wrap.split()[0]}><p>Open</p></body>"
    main, out, free = html_diff.MAIN_LINE, html_diff.DROP_LINE, html_diff.OPEN_LINE
    want = [(out, "Menu"), (main, "Title"), (main, "Own text"), (out, "pages"), (out, "q"), (main, "more"), (out, "Below"), (free, "Open")]
    assert html_diff.page_lines(page) == want


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_page_differencing_by_neighbours(spark, threshold, request):
    """Against the neighbours of a sorted list, with few different lines, copies and NULL ids; broadcast and shuffled."""
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    request.addfinalizer(lambda: spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    r = np.random.default_rng(2)
    rows = []
    for i in range(120):
        body = "".join(f"<div>line {x}</div>" for x in r.integers(0, 12, r.integers(0, 9)))
        rows.append((i, f"http://host{i % 3}.example/p{r.integers(0, 40):02d}?n={i}", f"<body>{body}<article>own {i}</article></body>"))
    pages = [(host, path, html) for _, url, html in rows for host, path in [(url[7:20], url[20:].split("?")[0])]]
    keys = [hashlib.md5(f"{url}\n{html}".encode()).digest() for _, url, html in rows]
    order = sorted(range(len(rows)), key=lambda i: (*pages[i][:2], keys[i]))
    lines = [html_diff.page_lines(html) for _, _, html in rows]
    want = {}
    for at, i in enumerate(order):
        own, gone = np.array([hash(t) for _, t in lines[i]]), set()
        free = np.array([k for k, (p, _) in enumerate(lines[i]) if p != html_diff.MAIN_LINE], int)
        for j in order[max(at - 1, 0) : at] + order[at + 1 : at + 2]:
            if pages[i][0] == pages[j][0]:
                gone |= set(free[html_diff.common_lines(own[free], np.array([hash(t) for _, t in lines[j]]))].tolist())
        want[i] = "\n".join(t for k, (_, t) in enumerate(lines[i]) if k not in gone)
    copies = rows + rows[:30] + [(None, *rows[7][1:])]
    got = html_diff.extract(spark.createDataFrame(copies, PAGES).repartition(5).withColumn("key", F.lit("x"))).collect()
    assert len(got) == len(copies)
    assert all(x.text == want[7 if x.page_id is None else x.page_id] for x in got)


def test_common_lines_is_longest():
    r = np.random.default_rng(1)
    for _ in range(60):
        a, b = r.integers(0, 6, r.integers(0, 14)), r.integers(0, 6, r.integers(0, 14))
        t = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1, j + 1] = t[i, j] + 1 if x == y else max(t[i, j + 1], t[i + 1, j])
        assert html_diff.common_lines(a, b).sum() == t[-1, -1]


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op4_quality(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.quality for r in got) >= 0.95 * len(got)
    assert all(0 <= r.score <= 1 for r in got)


def test_quality_odd_rows(spark, make):
    docs = make(ODD).withColumn("score", F.lit("x")).withColumn("y", F.lit(1))
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = quality.score(docs, none)
    assert {r.score for r in out.collect()} == {0.5} and out.count() == len(ODD)
    one = spark.createDataFrame([(i, 1) for i in range(30)] + [(None, 0), (4, None)], "doc_id long, quality int")
    assert {r.predicted for r in quality.score(docs, one).collect()} == {1}
    both = spark.createDataFrame([(i, i % 2) for i in range(30)], "doc_id long, quality int")
    assert quality.score(docs, both).count() == len(ODD)
    assert quality.score(make([]), both).count() == 0


BASE = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def base_spans(text):
    out = []
    for k, (kind, pattern) in enumerate(BASE):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            double = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
            ok = {
                "email": True,
                "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")),
                "card": 14 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in double) % 10 == 0,
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if ok:
                out.append((m.start(), k, f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(s for _, _, s in sorted(out))


def test_pii_base_spans(spark, make):
    texts = [None, "", "é😀 a@b.co_x@c.org. a@b a@b..c x@y.z@w.v", "1.2.3.4.5.6.7.8 256.1.1.1 0001.02.3.255 1.2.3", "4111 1111-1111 1111 4111111111111112", "+1 (988) 555-2485 +12 +1.2.3.4.5.6.7.8.9.0 +1 2", "9" * 3000 + " a" * 500 + "@", "1.1.1.1 " * 40 + "a@b.cd " * 40]
    docs = make([(i, t) for i, t in enumerate(texts)] + [(1, "")]).withColumn("rid", F.lit(1)).withColumn("gen", F.lit("x"))
    got = pii.find(docs).select("doc_id", pii.as_string(F.filter("spans", lambda s: s["base"])).alias("s")).collect()
    assert sorted((r.doc_id, r.s) for r in got) == sorted([(i, base_spans(t)) for i, t in enumerate(texts)] + [(1, "")])
    assert pii.find(make([])).count() == 0


def test_pii_added_spans(spark):
    docs = [(i, f"ab cd password=b7db{i:04x}aa5fcc783{i % 7} xy v{i} word{i % 90 + 10} 77{i:07d} é") for i in range(300)]
    docs += [(900 + i, f"the key AKIAMD62HKU6VBLC{chr(65 + i)}CCE here") for i in range(20)] + [(950, "plain words and 2.0 or covid19 only")]
    found = pii.find(spark.createDataFrame(docs, "doc_id long, text string"))
    got = {r.doc_id: r.s for r in found.select("doc_id", pii.as_string(F.col("spans")).alias("s")).collect()}
    assert sum(got[i] == f"secret:15:{docs[i][1].index(' xy')}" for i in range(300)) == 300
    assert sum(got[900 + i] == "secret:8:28" for i in range(20)) == 20 and got[950] == ""
    text = spark.createDataFrame(docs[:1], "doc_id long, text string").join(found.select("doc_id", "spans"), "doc_id")
    assert "password=[secret] xy" in text.select(pii.redact(F.col("text"), F.col("spans")).alias("t")).first().t


def test_pii_rare_credentials(spark, monkeypatch):
    """Credentials that are rare among the clear spans, and tables with clear spans of one sort."""
    monkeypatch.setattr(pii, "MAX_LABELLED", 400)
    numbers = [(i, " ".join(f"{j}77{i:07d}" for j in range(100))) for i in range(100)]
    keys = [(1000 + i, f"ab cd password=b7db{i:04x}aa5fcc783{i % 7} xy") for i in range(8)]
    for docs in (numbers + keys, keys, keys[:1] + numbers[:1]):
        found = pii.find(spark.createDataFrame(docs, "doc_id long, text string").repartition(3))
        got = {r.doc_id: r.s for r in found.select("doc_id", pii.as_string(F.col("spans")).alias("s")).collect()}
        assert {i: s for i, s in got.items() if "secret" in s} == {i: f"secret:15:{t.index(' xy')}" for i, t in docs if i >= 1000}


def test_pii_fits_all_clear_cases(spark, monkeypatch):
    """However many clear cases there are, all of them are fitted or calibrate."""
    monkeypatch.setattr(pii, "MAX_LABELLED", 40)
    seen, fit = [], pii.GBTClassifier.fit

    def counted(self, data, *args):
        seen.append({r.label: r["count"] for r in data.groupBy("label").count().collect()})
        return fit(self, data, *args)

    monkeypatch.setattr(pii.GBTClassifier, "fit", counted)
    docs = [(i, f"ab cd password=b7db{i:04x}aa5fcc783{i % 7} xy 77{i:07d} é") for i in range(400)]
    found = pii.find(spark.createDataFrame(docs, "doc_id long, text string"))
    assert found.where(pii.as_string(F.col("spans")).contains("secret:15:")).count() == 400
    assert seen and seen[-1][1.0] > 500 and seen[-1][0.0] > 250


def test_pii_credentials_around_base_spans(spark):
    """A credential that contains an email or a card number is found and redacted whole."""
    docs = [(i, f"ab cd password=b7db{i:04x}aa5fcc783{i % 7} xy user{i}abc1@mail{i}.org 77{i:07d}") for i in range(300)]
    values = ["x@host.org#Zx81kQ99", "b7d4111111111111111aaf5e", "b7db00aa4111111111111111aa5fcc783b00c1fe"]
    docs += [(1000 + i, f"ab cd password={v} xy") for i, v in enumerate(values)]
    found = pii.find(spark.createDataFrame(docs, "doc_id long, text string")).select("doc_id", "spans")
    got = {r.doc_id: r for r in found.select("doc_id", pii.as_string(F.col("spans")).alias("s"), F.size("spans").alias("n")).collect()}
    assert all(f"secret:15:{15 + len(v)}" in got[1000 + i].s.split(",") and got[1000 + i].n == 2 for i, v in enumerate(values))
    assert all(got[i].s.count("secret") == 1 and got[i].n == 2 for i in range(300))
    text = spark.createDataFrame(docs[300:], "doc_id long, text string").join(found, "doc_id")
    left = [r.t for r in text.select(pii.redact(F.col("text"), F.col("spans")).alias("t")).collect()]
    assert not any(p in t for t in left for p in ("host.org", "Zx81", "b7d", "aaf5e", "c1fe"))


def test_pii_wide_kinds(spark):
    """Forms that the fixed patterns do not accept, and near misses of them."""
    docs = [(i, f"ab cd password=b7db{i:04x}aa5fcc783{i % 7} xy 4111 1111 1111 1111, 4111111111111{i + 200:03d}1x +1 (988) 555-{1000 + i}") for i in range(60)]
    want = {
        1000: ("ring (988) 555-2485 now", "phone:5:19"),
        1001: ("tel: 0171 234 5678.", "phone:5:18"),
        1002: ("call 988.555.2485", "phone:5:17"),
        1003: ("visa card 4222222222222 ok", "card:10:23"),
        1004: ("from 2001:db8:85a3::8a2e:370:7334 on", "ip:5:33"),
        1005: ("from 2001:0db8:85a3:0000:0000:8a2e:0370:7334", "ip:5:44"),
        1006: ("host fe80::1 up", "ip:5:12"),
        1007: ("to john.doe [at] example [dot] com today", "email:3:34"),
        1008: ("to john (at) example.org today", "email:3:24"),
        1009: ("to john at example dot com today", "email:3:26"),
        1011: ("Des +1 (826) 555-4081 190.137.223.204 du", "phone:4:21,ip:22:37"),
        1010: ("on 2024-01-15 at 12:34:56, look at it. The MAC 00:1b:44:11:3a:b7 and 1.2.3 std::vector 300.1.1.1", ""),
    }
    rows = docs + [(i, t) for i, (t, _) in want.items()] + [(2000, "password: Winter2024 xy")]
    found = pii.find(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    got = {r.doc_id: r.s for r in found.select("doc_id", pii.as_string(F.col("spans")).alias("s")).collect()}
    assert {i: got[i] for i in want} == {i: s for i, (_, s) in want.items()}
    harmless = spark.createDataFrame([(1, "password: Winter2024 xy", "Winter2024", "keyed", "ab password: ", "", False, False, "secret")], "doc_id long, text string, value string, gen string, before string, after string, inside boolean, accepted boolean, kind string")
    assert pii._weak_label(harmless).first().label is None


def test_pipeline_stages(spark, sf):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, texts = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == columns
        before, after = [{r.doc_id: r.text for r in d.collect()} for d in (docs, out)]
        assert set(after) <= set(before)
        if name == "quality":
            labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
            wrong = [i for i in labels if i in before and (i in after) != bool(labels[i])]
            assert len(wrong) <= 0.1 * len(labels)
        if name == "line_dedup":
            assert set(after) == set(before)
        if name == "near_copies":
            want = brute_components(list(before.items()), 5, 80)
            assert set(after) == {i for i, (_, c) in want.items() if c == i}
        texts = after
        docs = spark.createDataFrame(out.collect(), out.schema)
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
    assert {r.doc_id for r in last} == set(texts)
    whole = {(r.doc_id, r.ids_sha256) for r in corpus_pipeline.run(spark, sf).collect()}
    assert whole == {(r.doc_id, r.ids_sha256) for r in last}
