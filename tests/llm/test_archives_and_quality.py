"""WARC archives by round trip, quality by held-out accuracy, the pipeline by brute force."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
from llm_data import SF_CHECK, SF_SMALL, docs, empty, rows  # noqa: F401
from pyspark.sql import functions as F

import corpus_pipeline
from riskloom.llm import quality, warc
from riskloom.llm.queries import QUERIES
from riskloom.session import scratch_path
from riskloom.sources.tables import read_table


def test_loser_tree():
    rng = random.Random(2)
    for k in range(9):
        runs = [sorted((rng.randrange(50), i, j) for j in range(rng.randrange(12))) for i in range(k)]
        assert list(warc.LoserTree(runs)) == sorted(x for r in runs for x in r)


def pages():
    long = "<p>" + "same " * 40
    rows = [(k, f"http://www.h{k % 3}.example.org/p{k % 4}?q={k}", f"<p>page {k} " + "x" * (k * 7 % 300)) for k in range(60)]
    rows += [(100 + k, "https://hot.example.com/", long) for k in range(30)]
    rows += [(200, None, long), (201, "not a url\r\nWARC-Type: x", None), (202, "", ""), (203, "", ""), (204, "http://%0A", "short"),
             (205, "http://x", "short"), (99, "http://first", long), (99, "http://again", long), (None, "http://n", long),
             (None, None, None), (300, "http://über.de/ä", "ä" * 99 + "\r\n\r\n")]
    return rows


def test_warc_round_trip(spark):
    rows = pages()
    df = spark.createDataFrame([(*r, "x", 9) for r in rows], "page_id long, url string, html string, digest string, ts long")
    folder = scratch_path(spark, "test-warc")
    runs = warc.write_archives(df.repartition(4), folder, ts=F.coalesce(F.col("page_id"), F.lit(0)) % 7)
    index = warc.merge_index(runs)
    entries = [tuple(r) for r in index.orderBy("shard", "position").collect()]
    assert [e[:5] for e in entries] == sorted(e[:5] for e in entries) and len(entries) == len(rows)
    first = {}
    for i, _, h in rows:
        if i is not None and len((h or "").encode()) >= 100:
            first[h] = min(first.get(h, i), i)
    want = Counter()
    for i, u, h in rows:
        body = (h or "").encode()
        again = i is not None and len(body) >= 100 and first[h] < i
        want[(i, len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response", first[h] if again else None, u)] += 1
    back = warc.read_archives(index).collect()
    assert Counter(tuple(r)[:6] for r in back) == want
    assert all(r.path.startswith(folder) for r in runs.select("path").distinct().collect())
    history = [(r.url_key, r.ts) for r in sorted(back, key=lambda r: r.ordinal)]
    assert history == sorted(history) and sorted(r.ordinal for r in back) == list(range(len(rows)))


def test_manifests_keep_the_scheme(spark):
    folder = "file://" + scratch_path(spark, "test-warc-uri").removeprefix("file:")
    df = spark.createDataFrame(pages(), "page_id long, url string, html string").repartition(3)
    runs = warc.write_archives(df, folder)
    assert all(r.path.startswith("file:///") for r in runs.select("path").distinct().collect())
    assert warc.read_archives(warc.merge_index(runs)).count() == len(pages())


@pytest.mark.parametrize("page_id", [10**12, 2**63 - 1, -(2**63), -5])
def test_any_page_id(spark, monkeypatch, tmp_path, page_id):
    spark.createDataFrame([(page_id, "http://x.org/a", "long " * 40), (3, "http://x.org/b", "long " * 40)],
                          "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    got = {r.page_id: (r.record_type, r.refers_to) for r in QUERIES["op5_warc"](spark, str(tmp_path)).collect()}
    least = min(page_id, 3)
    assert got == {least: ("response", None), max(page_id, 3): ("revisit", least)}


def test_a_capture_time_that_no_record_can_state(spark):
    df = spark.createDataFrame([(7, "http://x", "a")], "page_id long, url string, html string")
    with pytest.raises(Exception, match="capture time of page 7"):
        warc.write_archives(df, scratch_path(spark, "test-warc-late"), ts=F.lit(10**15)).collect()


def test_shared_files_of_another_scheme(monkeypatch, tmp_path):
    """A store that only its own scheme reaches: the bare path would not be found."""
    from pyarrow import fs as pafs

    from riskloom.llm import common
    store = pafs.SubTreeFileSystem(str(tmp_path), pafs.LocalFileSystem())
    real = common.shared_fs
    monkeypatch.setattr(common, "shared_fs", lambda uri: (store, uri.removeprefix("made://")) if uri.startswith("made://") else real(uri))
    f = common.SharedFile("made://bucket/a/b.bin")
    f.write(b"0123")
    f.close()
    assert f.uri == "made://bucket/a/b.bin"
    with common.open_shared(f.uri) as back:
        assert back.read() == b"0123"
    with pytest.raises(FileNotFoundError):
        common.open_shared(f.path)


def test_damaged_record_is_an_error():
    data = warc.record_bytes(1, "http://x", 0, b"payload", "0" * 64, None)
    with pytest.raises(ValueError, match="damaged"):
        warc.parse_record(data)


def test_warc_of_an_empty_table(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.write_and_read(none, F.lit(0)).count() == 0


def test_pair_loss_is_the_sum_over_all_pairs():
    rng = np.random.default_rng(4)
    good, bad = rng.normal(size=(7, 5)), rng.normal(size=(9, 5))
    w, ridge = rng.normal(size=5), np.array([0.1, 0.2, 0.0, 0.3, 0.1])

    def direct(w):
        pairs = [math.log1p(math.exp(-float((g - b) @ w))) for g in good for b in bad]
        return sum(pairs) / len(pairs) + float((ridge * w * w).sum()) / 2

    loss, slope, bend = quality.pair_loss(w, good, bad, ridge)
    assert loss == pytest.approx(direct(w))
    for k in range(5):
        step = np.eye(5)[k] * 1e-5
        assert slope[k] == pytest.approx((direct(w + step) - direct(w - step)) / 2e-5, abs=1e-6)
        ahead, behind = (quality.pair_loss(w + x, good, bad, ridge)[1] for x in (step, -step))
        assert bend[k] == pytest.approx((ahead - behind) / 2e-5, abs=1e-6)


def test_fit_reaches_the_least_loss():
    rng = np.random.default_rng(5)
    good = rng.random(80) < 0.6
    x = rng.normal(size=(80, quality.SHAPES + 12)) + good[:, None] * rng.normal(size=quality.SHAPES + 12)
    model = quality.fit_ranking(x, good)
    z = model.expand(x)
    loss, slope, _ = quality.pair_loss(model.weights, z[good], z[~good], quality.penalties(x.shape[1]))
    assert np.abs(slope).max() < 1e-6
    for _ in range(20):
        other = model.weights + rng.normal(size=len(slope)) * 0.05
        assert quality.pair_loss(other, z[good], z[~good], quality.penalties(x.shape[1]))[0] >= loss


def test_word_classes_of_strange_texts():
    hashes = quality.WordHashes()
    for text in ("", " ", "one", "a b", "é É\x00", "w " * 5000):
        x = quality.word_classes(text, hashes)
        n = len(text.split())
        assert x.shape == (quality.CLASSES,) and np.isfinite(x).all()
        assert (x * x).sum() == pytest.approx((2 * n - 1) / n if n else 0)


def test_quality_on_held_out_rows(spark):
    scores = QUERIES["op6_quality"](spark, SF_CHECK)
    rows = scores.join(read_table(spark, SF_CHECK, "labels"), "doc_id").where("held_out").collect()
    assert len(rows) > 60
    good, bad = [r.score for r in rows if r.quality == 1], [r.score for r in rows if r.quality == 0]
    right = sum((a > b) + (a == b) / 2 for a in good for b in bad) / (len(good) * len(bad))
    assert right > 0.97
    assert sum((r.score >= 0.7) == (r.quality == 1) for r in rows) / len(rows) > 0.93
    assert scores.count() == read_table(spark, SF_CHECK, "documents").count()


def test_quality_edge_cases(spark, docs, rows, empty):
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (None, 1), (5, 7)], "doc_id long, quality int")
    got = quality.quality_scores(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    none = labels.limit(0)
    assert all(r.predicted == 1 for r in quality.quality_scores(docs, none).collect())
    assert quality.quality_scores(empty, labels).count() == 0
    kept = quality.accepted(docs, none)
    assert kept.columns == docs.columns and kept.count() == len(rows)


def test_labels_of_held_out_rows_are_never_used(spark):
    docs, labels = read_table(spark, SF_SMALL, "documents"), read_table(spark, SF_SMALL, "labels")
    flipped = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (quality.quality_scores(docs, x).orderBy("doc_id").collect() for x in (labels, flipped))
    assert a == b


def test_pipeline_stages(spark):
    docs, kept = read_table(spark, SF_SMALL, "documents"), []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_SMALL)
        assert docs.columns == read_table(spark, SF_SMALL, "documents").columns
        kept.append({r.doc_id: r.text for r in docs.collect()})
    scores = {r.doc_id: r.predicted for r in QUERIES["op6_quality"](spark, SF_SMALL).collect()}
    assert set(kept[0]) == {i for i, p in scores.items() if p}
    first = {}
    for i, t in sorted(kept[0].items()):
        first.setdefault(" ".join(t.split()), i)
    assert set(kept[1]) == set(first.values())
    sets = {i: set(zip(*(t.lower().split()[k:] for k in range(5)))) for i, t in kept[1].items()}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    assert set(kept[2]) == {find(i) for i in ids}
    packed = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert {r.doc_id for r in packed} == set(kept[2])


def strange_folder(spark, tmp_path, rows):
    """documents with nulls, ties, repeated rows and clashing columns, and labels for some."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, cid long, `key` string, h int, kept boolean"
    spark.createDataFrame([(*r, "en", None, 1, 2, "k", 3, True) for r in rows], schema).write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(i, i % 2, 0) for i, _ in rows if i is not None and i % 3 == 0] + [(None, 1, 1), (3, None, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    return str(tmp_path)


def test_pipeline_on_strange_rows(spark, tmp_path, rows):
    data = rows + [rows[6], rows[7], (None, "w " * 300), (None, "w " * 300), (4, None), (4, "")]
    folder = strange_folder(spark, tmp_path, data)
    docs = read_table(spark, folder, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = str(tmp_path / name.replace(" ", "-"))
        stage(spark, docs, folder).write.parquet(path)
        after = spark.read.parquet(path)
        assert after.columns == docs.columns and after.count() <= docs.count(), name
        assert after.exceptAll(docs).count() == 0, name
        if name == "exact dedup":
            kept = Counter(" ".join((r.text or "").split(" ")) for r in after.collect())
            assert max(kept.values()) == 1
        docs = after
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in docs.select("doc_id").collect()}


def test_pipeline_of_an_empty_table(spark, tmp_path):
    folder = strange_folder(spark, tmp_path, [])
    out = corpus_pipeline.run(spark, folder)
    assert out.count() == 0 and "sequence_id" in out.columns


def labelled_words(n=700):
    """Texts of good and bad words, more or less mixed, and their labels."""
    rng = random.Random(8)
    good, bad = [["w%d%s" % (k, end) for k in range(60)] for end in ("ing", "ed")]
    rows = []
    for i in range(n):
        share = rng.random()
        words = [rng.choice(good if rng.random() < share else bad) for _ in range(rng.randint(1, 60))]
        rows.append((i, " ".join(words) + ("!" if rng.random() < 0.2 else ""), int(share + rng.gauss(0, 0.2) > 0.35)))
    return rows


def test_the_fit_is_that_of_all_pairs_in_memory(spark):
    rows = labelled_words()
    df = spark.createDataFrame(rows, "doc_id long, text string, quality int").repartition(5)
    kept, _ = quality.kept_features(df.select("doc_id", "text"), "doc_id", "text")
    model = quality.train(kept, df.select("doc_id", "quality"))
    used = {r.doc_id for r in df.where(~quality.held_out()).collect()}
    x = quality._feature_rows([t for i, t, _ in rows if i in used])
    good = np.array([q == 1 for i, _, q in rows if i in used])
    want = quality.fit_ranking(x, good)
    assert np.abs(model.mean - want.mean).max() < 1e-9 and np.abs(model.scale - want.scale).max() < 1e-6
    assert np.abs(model.score(x) - want.score(x)).max() < 0.01
    z, ridge = want.expand(x), quality.penalties(x.shape[1])
    loss = [quality.pair_loss(m.weights, z[good], z[~good], ridge)[0] for m in (model, want)]
    assert loss[1] <= loss[0] < loss[1] + 1e-6
    assert (model.score(x) < 0.7).sum() == (~good).sum()


def test_one_curvature_comes_to_the_driver_from_all_tasks(spark, monkeypatch):
    """A step's long sums are added where the rows are: in all, what comes back is one vector in small pieces."""
    df = spark.createDataFrame(labelled_words(), "doc_id long, text string, quality int")
    kept, _ = quality.kept_features(df.select("doc_id", "text"), "doc_id", "text")
    rows = kept.join(df.select(F.col("doc_id").alias("id"), F.col("quality").cast("long").alias("good"),
                               (1 - F.col("quality")).cast("long").alias("bad")), "id").repartition(3, "id")
    labelled = quality.Labelled(rows)
    assert labelled.rows.rdd.getNumPartitions() > 1
    width = 2 * quality.SHAPES + quality.CLASSES
    _, mean, squares = labelled.moments()
    model = quality.Ranking(mean, np.sqrt(squares / rows.count()) + 1e-9, np.zeros(width))
    weights, ridge = np.random.default_rng(4).normal(0, 0.05, width), quality.penalties(width - quality.SHAPES)
    _, bends = labelled.evaluate(model, weights, ridge)
    sizes, kind = [], type(df)
    real = kind.collect

    def heard(self):
        out = real(self)
        cells = [c for r in out for c in r]
        sizes.extend(len(v) for c in cells for v in (c if isinstance(c, list) else [c]) if isinstance(v, bytes | bytearray))
        return out

    monkeypatch.setattr(kind, "collect", heard)
    slope, bend = bends()
    numbers = width + width * (width + 1) // 2
    assert max(sizes) <= 131_072 and 8 * numbers < sum(sizes) <= 8 * (numbers + 2 * quality.GROUPS * width)
    got = rows.toArrow().combine_chunks()
    x = quality.unpacked(got["shape"].combine_chunks(), got["classes"].combine_chunks())
    good = np.array(got["good"]) == 1
    z = model.expand(x)
    _, want_slope, want_bend = quality.pair_loss(weights, z[good], z[~good], ridge)
    assert np.abs(slope - want_slope).max() < 1e-3 and np.abs(bend - want_bend).max() < 0.03 * np.abs(want_bend).max()


def test_the_fit_reads_every_labelled_row(spark):
    """Each row's label counts, however many there are, and once per label of its id."""
    n = 12_000
    df = spark.range(n).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, "fine words").otherwise("bad !! words").alias("text"),
                               (F.col("id") % 3 > 0).cast("int").alias("quality"))
    labels = df.select("doc_id", "quality").unionByName(df.where("doc_id < 90").select("doc_id", "quality"))
    kept, _ = quality.kept_features(df.select("doc_id", "text"), "doc_id", "text")
    ids = df.where(~quality.held_out())
    seen = []
    real = quality.cut_and_spread
    quality.cut_and_spread = lambda scores, n, bad: seen.append((n, bad, scores.agg(F.sum("w")).first()[0])) or real(scores, n, bad)
    try:
        quality.train(kept, labels)
    finally:
        quality.cut_and_spread = real
    bad = ids.where("quality = 0").count() + ids.where("quality = 0 and doc_id < 90").count()
    whole = ids.count() + ids.where("doc_id < 90").count()
    assert whole > 9_000 > 8_000 and seen == [(whole, bad, whole)]


def test_kept_features_are_those_of_the_text(spark):
    texts = ["", None, " ", "one", "w " * 5000, "a b " * 300 + "é\x00", "It's 5!! | http://x.org"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got = quality.kept_features(df, "doc_id", "text")[0].orderBy("id").toArrow().combine_chunks().to_batches()[0]
    assert (quality.unpacked(got.column(1), got.column(2)) == quality._feature_rows(texts)).all()


def test_cut_keeps_equal_scores_together(spark):
    def cut(values, bad):
        rows = [(int(v * quality.UNITS), 1) for v in values]
        return quality.cut_and_spread(spark.createDataFrame(rows, "v long, w long"), len(values), bad)

    assert cut([-3, 1, 2, 5, 9.5], 2) == (1.5, 3.5 / 4)
    assert cut([1, 2, 2, 2, 9], 2)[0] == 1.5 and cut([1, 2, 2, 2, 9], 3)[0] == 5.5
    assert cut([4, 4, 4], 1)[0] < 4 and cut([-7, 7], 1)[0] == 0
