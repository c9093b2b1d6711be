"""What an index keeps of its batches: every anchor once, and nothing that a step made for itself."""

import os

from millrace import scratch
from millrace.llm import spans
from tests.llm.test_spans import corpus, expected, frame


def kept(spark):
    root = scratch.folder(spark).removeprefix("file:")
    return {name.partition("-")[0] for name in os.listdir(root)}


def test_steps_leave_nothing_but_runs_and_results(spark, monkeypatch):
    for most in (spans.GROUP, 3):
        monkeypatch.setattr(spans, "GROUP", most)
        with scratch.scope(spark):
            df = frame(spark, corpus(5))
            index = spans.SpanIndex(spark, span=50, gram=16)
            index.add(df)
            assert kept(spark) == {"run", "rest"}
            index.found(df)
            assert kept(spark) == {"run", "rest", "found"}
            index.compact()


def test_places_outlast_the_runs_that_are_merged(spark):
    rows = corpus(7)
    index, found = spans.SpanIndex(spark, span=50, gram=16), []
    for k in range(4):
        n = index.add(frame(spark, rows[k::4]))
        found.append(index.found(frame(spark, [x for p in range(k + 1) for x in rows[p::4]]), since=n))
        index.tidy()
    every = found[0].unionByName(found[1]).unionByName(found[2]).unionByName(found[3]).distinct()
    located = index.located(every)
    index.compact()
    assert len(index.runs) == 1 and {tuple(r) for r in located.collect()} == {tuple(r) for r in index.located(every).collect()} == expected(rows, 50)
