import re

import __spark_entry__
from gristmill.llm import queries

import corpus_pipeline


def test_one_query_for_each_operator():
    names = [n for n in __spark_entry__.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names) == list(range(1, 14))
    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run
    assert set(queries.oracle_sql()) <= set(names)


def test_stages_call_operators():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "near_duplicates", "decontamination", "secrets", "bpe"
    ]
