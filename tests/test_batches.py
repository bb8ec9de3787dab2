import numpy as np
import pandas as pd
import pytest

from tidecast.llm.compression import QualityModel, keep_good
from tidecast.llm.jaccard import similar_components
from tidecast.llm.token_output import token_rows
from tidecast.plans import multimodal
from tidecast.plans.multimodal import MultiModalModel, byte_profile
from tidecast.session import bounded_batches

NAME = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.fixture
def unset(spark):
    before = spark.conf.get(NAME, None)
    spark.conf.unset(NAME)
    yield spark
    spark.conf.unset(NAME) if before is None else spark.conf.set(NAME, before)


def largest(df):
    def sizes(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["n"])

    return df.mapInArrow(sizes, "n long").agg({"n": "max"}).first()[0]


def operators(spark, docs):
    yield lambda: keep_good(docs, QualityModel(b"", b"", (), (), (), 1.0))
    yield lambda: similar_components(docs)
    yield lambda: token_rows(spark, docs)
    yield lambda: MultiModalModel(None, "text", byte_profile)._with_vectors(docs, None)


def test_batches_of_texts_are_bounded(unset):
    docs = unset.range(200).selectExpr("id AS doc_id", "repeat(concat('w', id, ' '), 20000) AS text").coalesce(1)
    assert largest(docs) > 10 << 20
    for operator in operators(unset, docs):
        unset.conf.unset(NAME)
        operator()
        assert largest(docs) < 5 << 20


def test_a_limit_of_the_session_holds(unset):
    unset.conf.set(NAME, "1m")
    bounded_batches(unset)
    assert unset.conf.get(NAME) == "1m"


def test_profile_of_long_bytes(monkeypatch):
    monkeypatch.setattr(multimodal, "PART", 7)
    data = bytes(range(256)) * 3
    got = byte_profile.func(pd.Series([data, b"", None]))
    assert np.allclose(got[0], [np.log1p(768), *[1 / 16] * 16]) and not any(got[1]) and not any(got[2])
