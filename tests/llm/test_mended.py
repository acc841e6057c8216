"""Cases that earlier versions of the corpus operators got wrong."""

import gzip

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from stationlake.llm import bpe, decontaminate, html_diff, ngram_join, quality, queries, warc
from stationlake.llm._common import portions


# --- near copies ------------------------------------------------------------


def families(n):
    """2n and n edited copies of two texts that are just under the threshold."""
    r = np.random.default_rng(7)
    one = [f"w{i}" for i in range(200)]
    two = [f"v{i}" if i % 12 == 0 else w for i, w in enumerate(one)]
    docs = []
    for i in range(3 * n):
        w = list(one if i % 3 else two)
        w[int(r.integers(0, 200))] = f"e{i}"
        docs.append((i, " ".join(w)))
    return docs


@pytest.mark.parametrize("rounds", [3, 0])
def test_two_families_are_found(spark, make, monkeypatch, rounds):
    monkeypatch.setattr(ngram_join, "FAMILY_ROWS", 4)
    monkeypatch.setattr(ngram_join, "FAMILY_ROUNDS", rounds)
    docs = families(30)
    got = {r.doc_id: r.component_id for r in ngram_join.jaccard_components(make(docs), 3, 80).collect()}
    assert got == {i: 1 if i % 3 else 0 for i, _ in docs}


def test_families_are_not_compared_pairwise(spark, make, monkeypatch):
    """Twice the documents, twice the pairs that are compared, once a family is large."""
    monkeypatch.setattr(ngram_join, "FAMILY_ROWS", 16)
    compared = []

    def counted(pairs, segs, overlaps=ngram_join._overlaps):
        compared.append(pairs.count())
        return overlaps(pairs, segs)

    monkeypatch.setattr(ngram_join, "_overlaps", counted)
    seen = []
    for n in (60, 120):
        compared.clear()
        got = ngram_join.jaccard_components(make(families(n)), 3, 80)
        assert got.select("component_id").distinct().count() == 2
        seen.append(sum(compared))
    assert seen[1] < 2.6 * seen[0]


def test_keep_one_of_a_repeated_id(spark):
    a = " ".join(f"w{i}" for i in range(60))
    near, other = a + " x", " ".join(f"u{i}" for i in range(60))
    rows = [(1, a, 1), (2, near, 2), (2, other, 3), (2, other, 3), (2, other, 4), (3, other, 5), (None, a, 6), (None, a, 6), (4, None, 7), (4, None, 7), (5, "", 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, th int")
    got = sorted(map(tuple, ngram_join.keep_one(docs, 5, 80).collect()), key=str)
    # The near copy goes, the other text of its id stays; rows equal in all columns are one.
    assert got == sorted([(1, a, 1), (2, other, 3), (2, other, 4), (None, a, 6), (4, None, 7), (5, "", 8)], key=str)
    both = spark.createDataFrame([(5, a, 1), (5, near, 2)], "doc_id long, text string, n int")
    assert ngram_join.keep_one(both, 5, 80).count() == 1


def test_lone_fragments_are_dropped(spark):
    """The prefilter keeps every row whose key repeats, over any number of partitions."""
    r = np.random.default_rng(1)
    rows = [(int(i), int(k), 0) for i, k in enumerate(r.integers(0, 3000, 4000))] + [(10_000 + i, -5, 0) for i in range(700)]
    df = spark.createDataFrame(rows, "node long, key long, p long")
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    got = [(x.node, x.key) for x in ngram_join._repeated(df).collect()]
    for k, v in old.items():
        spark.conf.set(k, v)
    times = {}
    for _, k, _ in rows:
        times[k] = times.get(k, 0) + 1
    want = {(i, k) for i, k, _ in rows if times[k] > 1}
    assert len(got) == len(set(got)) and want <= set(got) and len(set(got) - want) <= 18
    assert ngram_join._repeated(df.limit(0)).count() == 0


def test_contaminated_texts_go_and_columns_stay(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumn("k1", F.lit(1)).withColumn("doc", F.lit(2))
    bench = spark.read.parquet(f"{sf}/benchmark.parquet")
    bad = {r.doc_id for r in queries.op8_decontamination(spark, sf).where("contaminated").collect()}
    left = decontaminate.drop_contaminated(docs.union(docs), bench)
    ids = [r.doc_id for r in left.collect()]
    assert left.columns == docs.columns and bad and set(ids).isdisjoint(bad)
    assert sorted(ids) == sorted(2 * [r.doc_id for r in docs.collect() if r.doc_id not in bad])


# --- archives ---------------------------------------------------------------

PAGES = "page_id long, url string, html string"


def test_odd_urls_and_large_pages(spark):
    urls = ["http://a/\r\n\r\nx", "http://a/\nb", "http://a/ä b\t\x00c", "http://a/\U0001f600 z", None, ""]
    rows = [(i, u, "p" * 300 + str(i)) for i, u in enumerate(urls)] + [(90 + i, "http://big/", chr(97 + i) * 70_000) for i in range(3)]
    got = {r.metadata.page_id: r for r in warc.archive_pages(spark.createDataFrame(rows, PAGES), payloads=True).collect()}
    assert {i: got[i].response.payload.decode() for i in got} == {i: h for i, _, h in rows}
    assert [got[i].uri for i in range(4)] == ["http://a/%0D%0A%0D%0Ax", "http://a/%0Ab", "http://a/ä%20b%09%00c", "http://a/\U0001f600%C2%A0z"]


def test_damaged_archives_raise(spark, tmp_path):
    warc.write_archives(spark.createDataFrame([(i, "u", f"{i}" * 3000) for i in range(3)], PAGES).coalesce(1), str(tmp_path / "w"))
    file = next((tmp_path / "w").glob("*.gz"))
    raw = file.read_bytes()
    whole = gzip.decompress(raw)
    assert len(list(warc.parse_archive(raw))) == 9
    assert len(list(warc.parse_archive(b"".join(gzip.compress(whole[i : i + 500]) for i in range(0, len(whole), 500))))) == 9
    for bad in (raw[: len(raw) * 9 // 10], gzip.compress(whole[: len(whole) * 9 // 10]), gzip.compress(whole[:-2]), gzip.compress(whole[:40])):
        with pytest.raises(ValueError):
            list(warc.parse_archive(bad))
    (tmp_path / "x").mkdir()
    (tmp_path / "x" / "a.gz").write_bytes(gzip.compress(whole.replace(b"1" * 50, b"1" * 49 + b"7", 1)))
    with pytest.raises(Exception, match="not the one that was written"):
        warc.read_records(spark, str(tmp_path / "x")).collect()


# --- pages ------------------------------------------------------------------


def text(page):
    return [t for p, t in html_diff.page_lines(page) if p == html_diff.MAIN_LINE]


def dropped(page):
    return [t for p, t in html_diff.page_lines(page) if p == html_diff.DROP_LINE]


@pytest.mark.parametrize(
    "noise",
    [
        "<section class=comments><article class=comment><p>No</p></article></section>",
        "<section class=comments><article><p>No</p></article></section>",
        "<div id=respond><article><p>No</p></article></div>",
        "<aside><article><p>No</p></article></aside>",
        "<footer><article><p>No</p></article></footer>",
        "<article class=advert><p>No</p></article>",
        "<article class='teaser wide'><p>No</p></article>",
        "<div class=related-posts><article><p>No</p></article></div>",
        "<div class=widget><article><p>No</p></article></div>",
    ],
)
def test_articles_in_noise_are_no_main_part(noise):
    assert text(f"<body><article><p>Yes</p></article>{noise}</body>") == ["Yes"]
    page = f"<body><main><p>Yes</p>{noise}</main></body>"
    assert text(page) == ["Yes"] and dropped(page) == ["No"]


@pytest.mark.parametrize("wrap", ["form", "div class=has-sidebar", "div class=header-fixed", "div class=nav-open", "div id=social"])
def test_wrappers_may_hold_the_main_part(wrap):
    assert text(f"<body><{wrap}><article><h1>A</h1><p>B</p></article></{wrap.split()[0]}></body>") == ["A", "B"]


def test_related_work_is_text():
    assert dropped("<body><div class=related-work><p>Yes</p></div><div class=related-links><p>No</p></div></body>") == ["No"]


def test_long_pages_are_aligned_in_little_memory():
    import tracemalloc

    r = np.random.default_rng(2)
    a, b = (r.integers(0, 50, 3000) for _ in "ab")
    tracemalloc.start()
    found = html_diff.common_lines(a, b)
    assert tracemalloc.get_traced_memory()[1] < 3_000_000
    tracemalloc.stop()
    row = html_diff._suffix_row(a, b)
    assert found.sum() == row[0]
    same = np.arange(20_000)
    assert html_diff.common_lines(same, same).all()


# --- quality, BPE, settings -------------------------------------------------


def test_keep_good_leaves_columns_alone(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumns({"score": F.lit("mine"), "predicted": F.lit("my own"), "y": F.lit(1)})
    kept = quality.keep_good(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    assert kept.columns == docs.columns and kept.select("score", "predicted").distinct().collect() == [("mine", "my own")]


def test_line_stage_leaves_columns_alone(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumns({"n_lines": F.lit("a"), "n_removed": F.lit("b"), "doc": F.lit(3)})
    out = corpus_pipeline.line_stage(spark, docs, sf)
    assert out.columns == docs.columns and out.select("n_lines", "n_removed", "doc").distinct().collect() == [("a", "b", 3)]
    assert out.count() == docs.count()


def test_word_vectors_brute_force(spark, make):
    """Vectors of all buckets: every word's neighbours within reach, added one by one."""
    texts = ["a b c a d", "Xy! xy 12 a", None, "", "b b b"]
    docs = make([(i, t) for i, t in enumerate(texts)]).repartition(3)
    got = quality.word_vectors(docs)
    place, sign = quality.index_vectors()
    want = np.zeros((quality.BUCKETS, quality.DIMS))
    for t in texts:
        c = quality.tokens(t, quality._Codes())
        for i, me in enumerate(c):
            for j in range(max(0, i - 2 * quality.NEAR), min(len(c), i + 2 * quality.NEAR + 1)):
                if i != j:
                    for k in range(quality.NONZERO):
                        want[me, place[c[j], k]] += sign[c[j], k]
    want /= np.maximum(np.linalg.norm(want, axis=1, keepdims=True), 1e-9)
    for bucket in range(quality.BUCKETS):
        for k in range(quality.NONZERO):
            want[bucket, place[bucket, k]] += sign[bucket, k]
    assert np.allclose(got, want, atol=1e-5)


def test_pooling_and_temperature():
    vectors = np.random.default_rng(0).normal(size=(quality.BUCKETS, quality.DIMS)).astype(np.float32)
    codes = quality._Codes()
    import pandas as pd

    rows = quality.pooled(pd.Series(["one two two", "", None]), vectors, codes)
    assert np.allclose(rows[0], np.mean([vectors[t] for t in quality.tokens("one two two", codes)], axis=0), atol=1e-5)
    assert not rows[1:].any()
    r = np.random.default_rng(1)
    x = r.normal(size=(400, quality.DIMS))
    y = (x[:, 0] + r.normal(size=400) > 0).astype(float)
    held = np.arange(400) % 5 == 0
    net = quality.Network(x, y, held)
    logit = net.logits(x[held])

    def loss(t):
        return np.mean([np.log1p(np.exp(-abs(z))) + max(-z, 0) for z in np.where(y[held] == 1, logit, -logit) / t])

    assert loss(net.temperature) <= min(loss(t) for t in np.geomspace(0.25, 8, 61)) + 1e-9
    assert np.allclose(net.scores(x[held]), 1 / (1 + np.exp(-logit / net.temperature)))


def test_frequent_words_stay_under_the_bound(spark):
    counts = spark.createDataFrame([(f"w{i}", 1 + i // 3) for i in range(30)], "word string, n long")
    for size in (0, 1, 2, 3, 4, 7, 29, 30, 100):
        words = bpe.frequent_words(counts, size)
        assert len(words) <= size and len(words) == size - size % 3 if size < 30 else len(words) == 30
        assert set(words) == {f"w{i}" for i in range(30 - len(words), 30)}


def test_words_merged_side_by_side(monkeypatch):
    """Many words at a time get the ids that each gets by itself, through full memories too."""
    vocab = bpe.Vocabulary(bpe.load_vocabulary(queries.word_vocabulary()))
    r = np.random.default_rng(3)
    words = ["".join(r.choice(list("aetnhis'é\u4e2d0"), int(r.integers(1, 40)))) for _ in range(600)] + ["x" * 48, "y" * 49, "z"]
    monkeypatch.setattr(bpe, "ROWS", 64)
    assert [np.frombuffer(b, "<u4").tolist() for b in vocab.merge_all(words)] == [vocab.merge(w) for w in words]
    assert vocab.merge_all([]) == []
    lexicon = bpe.Lexicon.mapped(bpe.Lexicon.build({w: vocab.merge(w) for w in words[::2]}))
    assert lexicon.get_all(words) == [lexicon.get(w) for w in words]
    assert lexicon.get_all([words[0][:-1] + "q", "", words[0] + "a"]) == [None, None, None]
    assert bpe.Lexicon.mapped(bpe.Lexicon.build({})).get_all(["a"]) == [None]

    monkeypatch.setattr(bpe, "WORD_CACHE", 50)
    monkeypatch.setattr(bpe, "PORTION_CHARS", 200)
    texts = [" ".join(r.choice(words, 30)) + ",<|endoftext|>The. \u039f\u0394\u039f\u03a3" for _ in range(40)] + [None, "", " "]
    coder, single = bpe.Encoder(vocab, lexicon), bpe.Encoder(vocab, lexicon)
    for text, row in zip(texts, bpe._digests(coder, bpe.Decoder(coder), texts, True), strict=True):
        assert row[0].astype("<u4").tobytes() == single.encode(text or "")


def test_no_operator_changes_the_session(spark, sf):
    """Queries are built one after another; none leaves a setting behind."""
    before = dict(spark.sparkContext.getConf().getAll()) | {"b": spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")}
    for fn in queries.QUERIES.values():
        fn(spark, sf)
    after = dict(spark.sparkContext.getConf().getAll()) | {"b": spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")}
    assert before == after


def test_portions():
    import pandas as pd

    parts = list(portions(pd.DataFrame({"a": range(7)}), 3))
    assert [len(p) for p in parts] == [3, 3, 1] and list(portions(pd.DataFrame({"a": []}))) == []
