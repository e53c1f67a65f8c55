from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from meterline.llm import ranked_search
from meterline.llm.common import plain_strings

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {k: k + 32 for k in range(0x41, 0x5B)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute_force(docs, items, k=20):
    counts = [(doc_id, Counter(terms(text))) for doc_id, text in docs]
    total = sum(sum(c.values()) for _, c in counts)
    n_docs = sum(bool(c) for _, c in counts)
    df = Counter(term for _, c in counts for term in c)
    rows = []
    for item_id, text in items:
        found = []
        for doc_id, c in counts:
            n, score = sum(c.values()), 0
            for term in terms(text):
                if c[term]:
                    weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                    score += weight * (1_000_000_000 * c[term] // (1000 * c[term] + 12 * (75 + 25 * n * n_docs // total)))
            if score > 0:
                found.append((-score, doc_id is None, doc_id or 0))
        rows += [(item_id, rank, None if null else doc_id, -score) for rank, (score, null, doc_id) in enumerate(sorted(found)[:k], 1)]
    return sorted(rows, key=repr)


def run(spark, docs, items, k=20, partitions=3):
    got = ranked_search.rank_documents(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(partitions), spark.createDataFrame(items, "item_id long, text string"), k)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, got.collect()), key=repr)


def corpus(n, seed):
    rnd = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(60)]
    weights = [1 / (k + 1) for k in range(60)]
    return [(k, " ".join(rnd.choices(vocabulary, weights, k=rnd.randrange(1, 60)))) for k in range(n)]


@pytest.mark.parametrize("segment", [400, 1 << 20])
def test_brute_force(spark, monkeypatch, segment):
    monkeypatch.setattr(ranked_search, "SEGMENT", segment)
    monkeypatch.setattr(ranked_search, "FIRST_BLOCK", 2)
    docs = corpus(500, 5)
    items = [(k, text) for k, (_, text) in enumerate(corpus(25, 6))] + [(100, "w1 w1 w1 w2"), (101, docs[7][1]), (102, "none of these"), (7, "w59")]
    assert run(spark, docs, items) == brute_force(docs, items)
    assert run(spark, docs, items, k=3) == brute_force(docs, items, 3)


def test_edge_rows(spark, edge_rows):
    docs = [(row[0], row[1]) for row in edge_rows]
    items = [(1, "The HARBOUR lay quiet"), (1, "the harbour lay quiet"), (None, "中文 é x　y"), (2, None), (3, ""), (4, "word1 of 0 KELVIN K x")]
    assert run(spark, docs, items) == brute_force(docs, items)


def test_equal_scores_and_repeated_rows(spark):
    docs = [(k % 40, "same text here") for k in range(120)] + [(None, "same text here"), (900, "other")]
    items = [(1, "text"), (2, "same here other")]
    assert run(spark, docs, items) == brute_force(docs, items)


def test_blocks_of_items(spark, monkeypatch):
    monkeypatch.setattr(ranked_search, "BLOCK_TERMS", 5)
    docs = corpus(80, 9)
    items = [(k, text) for k, (_, text) in enumerate(corpus(9, 10))]
    assert run(spark, docs, items) == brute_force(docs, items)


def test_a_row_group_holds_one_segment(spark, tmp_path):
    """Readers hold a row group at once; a task's segments add up to whatever its part of the corpus has."""
    docs, path = corpus(200, 11), str(tmp_path / "index")
    items = [(k, text) for k, (_, text) in enumerate(corpus(5, 12))]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        ranked_search.build_index(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1), path)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    [file] = (tmp_path / "index").glob("*.parquet")
    stated = pq.ParquetFile(file).metadata
    assert stated.num_row_groups == 20 and all(stated.row_group(k).num_rows == 1 for k in range(20))
    found = ranked_search.search(spark, path, spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(map(tuple, found.collect()), key=repr) == brute_force(docs, items)


@pytest.mark.parametrize("numbers", [[], [0], [7, 0, 300, (1 << 31) - 1]])
def test_packed_numbers(numbers):
    packed = ranked_search._packed(np.array(numbers, np.int64))[0].as_buffer()
    assert ranked_search._unpacked(packed, len(numbers)).tolist() == numbers


def test_terms_of_touching_texts():
    texts = ["", "ab AB", "cd", None, "é-Z9", "..", "x", ""]
    found, counts = ranked_search.terms_of(plain_strings(pa.array(texts)))
    assert found.to_pylist() == [term for text in texts for term in terms(text)] and counts.tolist() == [len(terms(text)) for text in texts]


def test_empty_tables_and_clashing_columns(spark, edge_docs, no_docs):
    items = spark.createDataFrame([(1, "one", 2, 3)], "item_id long, text string, terms int, lengths int")
    assert ranked_search.rank_documents(no_docs, items).count() == 0
    assert ranked_search.rank_documents(edge_docs, items.limit(0)).count() == 0
    assert ranked_search.rank_documents(edge_docs.withColumn("terms", edge_docs.key), items).count() > 0


def test_reads_end_early():
    """Lists with a few high impacts are not read to the end once the members are resolved."""
    rnd = np.random.default_rng(1)
    n = 20_000
    lists = ranked_search.Lists.__new__(ranked_search.Lists)
    first = np.sort(rnd.integers(1, 50, n))[::-1].copy()
    first[:30] += 1000
    lists.n, lists.docs, lists.values = n, np.arange(n, dtype=np.int32), first
    lists.first, lists.size = np.array([0]), np.array([n])
    docs, scores, read = ranked_search.nra(lists, np.array([0]), np.array([2]), 20, 0)
    assert read < 1000 and set(range(20)) <= set(docs.tolist())
    assert scores.tolist() == (2 * first[docs]).tolist()
    assert ranked_search.nra(lists, np.array([0]), np.array([1]), 20, 5000)[2] <= ranked_search.FIRST_BLOCK
