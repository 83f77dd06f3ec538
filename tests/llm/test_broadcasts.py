from __future__ import annotations

import pytest

from quire.llm import common, line_dedup, ngram_join, pii

RUNS = {
    "near_duplicates": (ngram_join, ngram_join.near_duplicates),
    "drop_near_duplicates": (ngram_join, ngram_join.drop_near_duplicates),
    "line_dedup": (line_dedup, line_dedup.line_dedup),
    "replace_pii": (pii, lambda docs: pii.replace_pii(docs, "k")),
}


@pytest.mark.parametrize("name", RUNS)
def test_only_what_was_counted_is_broadcast(spark, monkeypatch, name):
    """No join is made a broadcast by Spark's guess of a size, though these tables lie below its threshold."""
    module, run = RUNS[name]
    plans = []

    def planned(df):
        made = df._jdf.queryExecution()
        plans.append((made.sparkPlan().toString().count("BroadcastHashJoin"), made.optimizedPlan().toString().count("strategy=broadcast")))
        return df

    for m in (common, module):
        monkeypatch.setattr(m, "saved", lambda df, tag, save=common.saved: save(planned(df), tag))
    passage = "\n".join(f"word{i} of a passage that stands in several documents and goes" for i in range(9))
    rows = [(i, f"mail a{i}@mail.org, Mr. John Smith{'' if i % 3 else ' and Smith'}\n{passage}\nend of {i}") for i in range(12)] + [(5, "twice")]
    planned(run(spark.createDataFrame(rows, "doc_id bigint, text string"))).count()
    assert sum(asked for _, asked in plans) and all(made <= asked for made, asked in plans), plans
