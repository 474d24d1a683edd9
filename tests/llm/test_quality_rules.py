"""Counts and verdicts against plain Python, row by row."""

import re

from conftest import SCHEMA, awkward_rows, prose

from rivertally.llm.quality_rules import STOP_WORDS, Rule, keep_good, quality_rules

WORD = re.compile("[^\x20\x09-\x0d]+")


def expected(text):
    text = text or ""
    words, lines = WORD.findall(text), [x for x in text.split("\n") if WORD.search(x)]
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    again = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)} if len(grams) < 2000 else None
    n = len(words)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), None if again is None else len(again)


def test_counts(awkward):
    got = sorted(quality_rules(awkward).collect(), key=str)
    assert len(got) == len(awkward_rows())
    counted = sorted((str(r.doc_id), *(str(x) for x in (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines))) for r in got)
    assert counted == sorted((str(i), *map(str, expected(t)[:4])) for i, t, *_ in awkward_rows())
    by_words = {(r.doc_id, r.n_words): r for r in got}
    for i, t, *_ in awkward_rows():
        n, *_, again = expected(t)
        row = by_words[i, n]
        if again is not None:
            assert row.n_repeat_words == again
            assert row.base_failed == (n < 50 or 100 * again > 50 * n)
        assert not (row.base_failed and row.kept)


def test_windows_that_overlap_and_ties(spark):
    texts = ["a a a a a", "a b c x a b c", "a b", "a b c a b", "", None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    assert [r.n_repeat_words for r in quality_rules(rows).orderBy("doc_id").collect()] == [5, 6, 0, 0, 0, 0]


def test_table_of_rules(spark):
    good = " ".join(["the", *prose(1, 9).split()] * 1 + prose(2, 90).split() + list(STOP_WORDS[:20]))
    shouted, marked = good.upper().replace(" ", "!! "), good.replace(" ", "*** ")
    rows = spark.createDataFrame([(1, good), (2, shouted), (3, marked)], "doc_id long, text string")
    assert {r.doc_id: (r.kept, r.broken) for r in quality_rules(rows).collect()} == {
        1: (True, ""),
        2: (False, "stop_words"),
        3: (False, "symbols,stop_words"),
    }
    loose = (Rule("symbols", "symbols_per_word", None, 10.0),)
    assert all(r.kept for r in quality_rules(rows, loose).collect())


def test_no_python_and_no_shuffle(awkward):
    plan = quality_rules(awkward)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_keep_good_keeps_columns(awkward, empty):
    kept = keep_good(awkward)
    assert kept.columns == awkward.columns
    passed = sorted(str(r.doc_id) for r in quality_rules(awkward).where("kept").collect())
    assert sorted(str(r.doc_id) for r in kept.collect()) == passed
    assert quality_rules(empty).count() == 0 and keep_good(empty).count() == 0
    assert keep_good(empty).schema.simpleString() == f"struct<{SCHEMA.replace(', ', ',').replace(' long', ':bigint').replace(' string', ':string')}>"
