"""What a Python worker keeps from task to task."""

import weakref

from tidecast.llm import common
from tidecast.llm.common import held, release
from tidecast.llm.decontamination import index_of
from tidecast.llm.jaccard import costly_shingles
from tidecast.llm.token_output import _encoder, tokenizer_path


def test_a_worker_keeps_the_state_of_one_operator():
    items = ((1, b"one two three four five six seven eight nine ten"),)
    index = held(index_of, items)
    assert held(index_of, tuple(items)) is index
    gone = weakref.ref(index)
    del index
    words = held(_encoder, tokenizer_path())
    assert gone() is None  # the index went when the tokenizer came
    assert held(_encoder, tokenizer_path()) is words
    gone = weakref.ref(words)
    del words
    release()
    assert gone() is None and common._held[0] is None


def test_tasks_of_the_join_give_back_what_others_kept(spark):
    rows = spark.createDataFrame([(1, "a few words of some text " * 20)], "doc_id long, text string").coalesce(1)
    seen = []

    class Docs:
        """Hands the operator's task over, to be run here."""

        def select(self, *columns):
            return self

        def mapInArrow(self, task, schema):
            held(_encoder, tokenizer_path())
            seen.append(list(task(iter(rows.select("text").toArrow().to_batches()))))
            assert common._held[0] is None
            return spark.createDataFrame([], schema)

    costly_shingles(Docs())
    assert seen
