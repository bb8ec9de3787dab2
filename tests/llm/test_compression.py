import zlib

from tidecast.llm.compression import QualityModel, features, fit_quality, keep_good, score_quality
from tidecast.llm.queries import op4_compression_quality

SCHEMA = "doc_id long, text string, score double"


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    got = op4_compression_quality(spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = got.where("held_out").join(labels, "doc_id").collect()
    right = sum(r.predicted == r.quality for r in rows) / len(rows)
    assert right >= 0.97
    sizes = [sum(r.quality == v for r in rows) for v in (0, 1)]
    kept = sum(r.predicted for r in rows if r.quality == 1) / sizes[1]
    assert kept >= 0.98, kept


def small(spark):
    good = "The river ran past {} quiet houses and the children of the {} village sang."
    docs = [(i, good.format(i, i * 7) if i % 3 else f"WIN!! {i} CASH!! NOW!! {i * i} ###", 1.0) for i in range(300)]
    docs += [(900, None, None), (901, "", 0.0), (902, "word " * 50_000, 0.5), (None, "no key", 1.0), (1, docs[1][1], 1.0)]
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(300)] + [(None, 1, 0), (5, None, 0)],
                                   "doc_id long, quality int, toxic int")
    return spark.createDataFrame(docs, SCHEMA).repartition(3), labels, docs


def test_same_as_brute_force(spark):
    docs, labels, rows = small(spark)
    model = fit_quality(docs, labels)
    got = sorted((r.doc_id is not None, r.doc_id or 0, round(r.score, 9)) for r in score_quality(docs, model).collect())
    want = sorted((k is not None, k or 0, round(model.score_texts([(t or "").encode()])[0], 9)) for k, t, _ in rows)
    assert got == want
    assert all(0 <= s <= 1 for *_, s in got)
    kept = keep_good(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} >= {i for i in range(300) if i % 3}


def test_held_out_rows_and_labels_do_not_matter(spark):
    docs, labels, _ = small(spark)
    held = [i for i in range(300) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert fit_quality(docs, labels) == fit_quality(docs.where(~docs.doc_id.isin(held)), labels)


def test_one_label_or_none(spark):
    docs, labels, _ = small(spark)
    for some in (labels.where("quality = 1"), labels.limit(0)):
        model = fit_quality(docs, some)
        assert isinstance(model, QualityModel) and not model.weights
        assert score_quality(docs, model).count() == docs.count()
    assert score_quality(docs.limit(0), model).count() == 0


def test_features_of_empty_text_are_finite():
    assert abs(features([b""], b"good text " * 50, b"BAD!! " * 50)).max() < 10
