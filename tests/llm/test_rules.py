import re
from collections import Counter

from brookmart.llm import rules


def counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    seen = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(covered))


def test_counts_against_brute_force(docs, odd):
    for frame in (docs, odd):
        texts = sorted((counts(r.text), r.text) for r in frame.select("text").collect() if r.text is not None)
        got = rules.judge(frame, keep=("text",)).collect()
        assert sorted(((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words), r.in_0)
                      for r in got if r.in_0 is not None) == texts
        for r in got:
            assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
            assert not (r.kept and r.base_failed)


def test_lines_that_fail_go(spark):
    text = "A sentence of prose that is long enough. It goes on for a while, quietly.\n" * 1
    kept = "Another line of it is here, with some more words in it."
    junk = ["Home | News | Sports | Weather | About", "All rights reserved.", "BUY!! NOW!! CHEAP!! PILLS!! HERE!!"]
    frame = spark.createDataFrame([(1, text + "\n".join([junk[0], kept, *junk[1:]]), 3),
                                   (2, "\n".join(junk * 3) + "\n" + kept, 3)], "doc_id long, text string, n_chars long")
    got = {r.doc_id: r for r in rules.judge(frame).collect()}
    assert got[1].kept and not got[2].kept
    assert (got[1].n_navigation, got[1].n_boilerplate, got[1].n_punctuation) == (1, 1, 1)
    (row,) = rules.clean(frame).collect()
    assert row.text == text + kept and row.n_chars == len(row.text)


def test_clean_documents_stay_and_bad_ones_go(spark, docs):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    got = rules.judge(docs).join(labels, "doc_id").collect()
    good = [r for r in got if r.quality == 1 and not r.base_failed]
    assert sum(r.kept for r in good) >= 0.95 * len(good)
    assert sum(r.kept for r in got if r.quality == 0) <= 0.1 * sum(r.quality == 0 for r in got)


def test_clean_keeps_columns_and_nothing_of_nothing(odd, none):
    assert rules.clean(odd).columns == odd.columns
    assert rules.clean(none).count() == rules.judge(none).count() == 0


def test_no_python_in_the_plan(docs):
    plan = rules.judge(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
