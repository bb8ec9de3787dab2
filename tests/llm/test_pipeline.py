import zlib
from collections import Counter

import numpy as np

import corpus_pipeline
from llm_brute import contaminated, link_classes, mixed_copies


def test_every_stage_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    frames = [docs]
    for _, stage in corpus_pipeline.STAGES:
        frames.append(stage(spark, frames[-1], sf_dir).cache())
    rows = [[(r.doc_id, r.text, r.source) for r in f.collect()] for f in frames[:-1]]
    assert all(f.columns == docs.columns for f in frames[:-1])
    whole, good, single, clean, mix = rows
    assert set(good) <= set(whole) and len(good) >= 0.7 * len(whole)
    assert sorted(k for k, _, _ in single) == sorted(set(link_classes([(k, t) for k, t, _ in good]).values()))
    leaks = contaminated([(k, t) for k, t, _ in single], items)
    assert sorted(clean) == sorted(r for r in single if r[0] not in leaks)
    assert Counter(k for k, _, _ in mix) == mixed_copies(clean)
    expect_ids(frames[-1], mix)


def expect_ids(frame, rows):
    from tokenizers import Tokenizer

    from tidecast.llm.token_output import tokenizer_path

    tok, start, want = Tokenizer.from_file(tokenizer_path()), 0, []
    for k, text, _ in sorted(rows):
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, 1]
        want.append((k, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(tuple(r) for r in frame.collect()) == sorted(want)


def test_run_gives_the_last_stage(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert out.count() > 0
