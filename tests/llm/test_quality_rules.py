from __future__ import annotations

import re
from collections import Counter

from meterline.llm import quality_rules as q


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[k:k + 3]) for k in range(len(words) - 2)]
    counts = Counter(windows)
    covered = {k + i for k, w in enumerate(windows) if counts[w] > 1 for i in range(3)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
            len(lines), text.count("!"))


def test_measurements_match_brute_force(edge_docs, edge_rows, rows):
    got = rows(q.measure(edge_docs), "doc_id", *q.MEASUREMENTS)
    assert got == sorted(((r[0], *brute(r[1])) for r in edge_rows), key=repr)


def test_bits_policies_and_base(edge_docs, edge_rows):
    found = {(r["doc_id"], r["n_words"], r["n_symbols"]): r for r in q.ledger(edge_docs).collect()}
    for doc_id, text, *_ in edge_rows:
        n, chars, symbols, dup, repeat, lines, bangs = brute(text)
        bits = found[doc_id, n, symbols]["failed_bits"]
        assert bool(bits & 1) == (n < 50)
        assert bool(bits & 2) == (100 * repeat > 50 * n)
        assert bool(bits & 4) == (10 * symbols > 3 * n)
        assert bool(bits & 8) == (lines > 3 and 100 * dup > 40 * lines)
        assert bool(bits & 32) == (10 * bangs > 3 * n)
    assert q.mask_of(q.POLICIES["base"]) == 3


def test_ablation_counts_from_patterns(spark, rows):
    ledger = spark.createDataFrame([(0,), (0,), (1,), (2,), (3,), (4,), (6,)], "failed_bits long")
    got = rows(q.ablation(ledger, ("few_words", "repeated_windows")), "rule", "n_failed", "n_failed_alone", "n_kept", "n_kept_without")
    assert got == [("few_words", 2, 1, 3, 4), ("repeated_windows", 3, 2, 3, 5)]


def test_native_and_empty(edge_docs, no_docs):
    plan = q.ledger(edge_docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan.split("Exchange RoundRobin")[0]
    assert q.ledger(no_docs).count() == 0
    assert q.ablation(q.ledger(no_docs), q.BASE_RULES).count() == 0
