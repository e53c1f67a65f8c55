from __future__ import annotations

import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import sentencepiece

import corpus_pipeline as pipeline
from __spark_entry__ import queries
from meterline.llm import pii, quality_bayes
from meterline.llm.queries import PIECE_BPE
from tests.llm import test_mixing, test_pii, test_simhash

SF = "/root/testdata/sf0.001"


def test_stages_and_columns(spark):
    assert [name for name, _ in pipeline.STAGES] == ["quality", "near_duplicates", "private_data", "mixture", "pieces"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for k, (_, stage) in enumerate(pipeline.STAGES):
        docs = stage(spark, docs, SF)
        if k < 4:
            assert docs.columns == columns
        counts.append(docs.count())
        if k == 2:
            assert not any(pii.candidates(r["text"], loose=False) for r in docs.collect())
    assert counts[0] > counts[1] > counts[2] == counts[3] and counts[4] == counts[5]


def test_run_is_the_stages_in_order(spark):
    got = queries()["pipeline"](spark, SF)
    assert got.columns == ["doc_id", "source", "n_tokens", "ids", "decoded"]
    rows = got.collect()
    assert rows and all(r["n_tokens"] == len(r["ids"]) for r in rows)
    assert all(re.search(r"\S", r["decoded"]) for r in rows)
    assert sorted(map(tuple, pipeline.run(spark, SF).collect())) == sorted(map(tuple, rows))


def test_every_case(spark, edge_docs, no_docs):
    for docs in (edge_docs, no_docs):
        for _, stage in pipeline.STAGES:
            docs = stage(spark, docs, SF)
        assert docs.count() >= 0


def test_every_operator_has_a_query():
    names = [name for name in queries() if re.match(r"op\d+_", name)]
    assert sorted(int(re.match(r"op(\d+)_", name)[1]) for name in names) == list(range(1, 11))


def kept_by_brute_force(docs, labels):
    """Document evidence and shrunk site rates, in one process."""
    x = quality_bayes.features(pa.array([d[1] for d in docs], pa.large_string()))
    at = {d[0]: k for k, d in enumerate(docs)}
    known = sorted((doc_id, quality) for doc_id, quality in labels if doc_id in at)
    model = quality_bayes.logistic(x[[at[i] for i, _ in known]], np.array([q for _, q in known], float))
    logit = np.clip(model[0] + x @ model[1:], -20, 20)
    p = 1 / (1 + np.exp(-logit))
    sites, hosts = {}, {}
    for d, probability in zip(docs, p):
        for table, key in ((sites, (d[3], d[2])), (hosts, d[3])):
            n, s = table.get(key, (0, 0.0))
            table[key] = n + 1, s + probability
    total, mean = len(docs), p.mean()

    def strength(between, chance):
        return np.clip(mean * (1 - mean) / max(between - chance, quality_bayes.EDGE) - 1, *quality_bayes.STRENGTH)

    k = strength(sum(n * (s / n - mean) ** 2 for n, s in hosts.values()) / total, mean * (1 - mean) * len(hosts) / total)
    rate = {h: (s + k * mean) / (n + k) for h, (n, s) in hosts.items()}
    k = strength(sum(n * (s / n - rate[h]) ** 2 for (h, _), (n, s) in sites.items()) / total,
                 sum(rate[h] * (1 - rate[h]) for h, _ in sites) / total)
    odds = lambda r: np.log(r / (1 - r))
    site = {key: np.clip(odds((s + k * rate[key[0]]) / (n + k)) - odds(mean), -quality_bayes.MAX_SITE, quality_bayes.MAX_SITE)
            for key, (n, s) in sites.items()}
    return [d for d, evidence in zip(docs, logit) if evidence + site[d[3], d[2]] >= 0]


def first_of_each_group(docs):
    roots = test_simhash.brute_roots({test_simhash.signed(test_simhash.brute_fingerprint(d[1])) for d in docs})
    first = {}
    for d in sorted(docs):
        first.setdefault(roots[test_simhash.signed(test_simhash.brute_fingerprint(d[1]))], d)
    return list(first.values())


def redacted(text):
    """Base spans alone: the expected text where the model adds none."""
    spans = sorted((int(b), int(e), kind.upper()) for found in test_pii.brute(text) for kind, b, e in (x.split(":") for x in found))
    for begin, end, kind in reversed(spans):
        text = f"{text[:begin]}<{kind}>{text[end:]}"
    return text


def test_pipeline_matches_brute_force(spark):
    docs = duckdb.sql(f"SELECT doc_id, text, lang, source FROM '{SF}/documents.parquet'").fetchall()
    labels = duckdb.sql(f"SELECT doc_id, quality FROM '{SF}/labels.parquet'").fetchall()
    kept = first_of_each_group(kept_by_brute_force(docs, labels))
    model = pii.fit(spark.createDataFrame([(d[1],) for d in kept], "text string"))
    clean = [(d[0], pii.redact_text(d[1], model), d[2], d[3]) for d in kept]
    unchanged = [(a, b) for a, b in zip(kept, clean) if len(pii.spans(a[1], model)) == sum(map(len, test_pii.brute(a[1])))]
    assert all(redacted(a[1]) == b[1] for a, b in unchanged) and len(unchanged) > 0.9 * len(kept)
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)
    texts = {d[0]: d[1] for d in clean}
    expected = Counter()
    for doc_id, size, _, _, taken in test_mixing.brute(clean):
        ids = library.encode(texts[doc_id])
        expected[doc_id, tuple(ids), library.decode(ids)] += taken // size if size else 0
    got = Counter((r["doc_id"], tuple(r["ids"]), r["decoded"]) for r in pipeline.run(spark, SF).collect())
    assert got == +expected
