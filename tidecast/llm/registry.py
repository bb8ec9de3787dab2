"""All queries of this folder and of the pipeline beside the package."""

from __future__ import annotations

import corpus_pipeline
from tidecast.llm.oracles import SQL
from tidecast.llm.queries import QUERIES


def all_llm_queries() -> dict:
    return QUERIES | {"pipeline": corpus_pipeline.run}


def all_llm_sql() -> dict[str, str]:
    return dict(SQL)
