from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from meterline.llm import quality_bayes as q
from tests.llm.conftest import CLEAN, TEXTS

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality")
    train, held = labels.filter("doc_id % 4 <> 0"), labels.filter("doc_id % 4 = 0")
    got = q.classify(docs, train).join(held, "doc_id").groupBy("quality", "kept").count().collect()
    counts = {(r["quality"], r["kept"]): r["count"] for r in got}
    wrong = counts.get((0, True), 0) + counts.get((1, False), 0)
    assert wrong <= 0.03 * sum(counts.values()) and counts.get((0, False), 0) > 5
    assert counts.get((1, False), 0) == 0


def test_features_are_counts_of_the_text():
    row = dict(zip(q.FEATURES, q.features(pa.array([TEXTS[6], "", "A! 1.\nA! 1.\n"], pa.large_string())).tolist()[2]))
    assert row["log_words"] == np.log1p(4) and row["bangs"] == 0.5 and row["capitals"] == 2 / 12 and row["digits"] == 2 / 12
    assert row["repeated_lines"] == 0.5 and row["punctuation"] == 0.5
    assert not q.features(pa.array(["", ""], pa.large_string())).any()


def test_sparse_sites_are_shrunk(spark):
    def site(host, path, n, p):
        return [(host, path, float(np.log(p / (1 - p))))] * n
    rows = sum((site(f"good{k}", "a", 400, 0.97) for k in range(6)), []) + sum((site(f"bad{k}", "a", 400, 0.3) for k in range(3)), [])
    rows += site("bad0", "rare", 1, 0.97) + site("tiny", "a", 1, 0.01) + site(None, None, 3, 0.9)
    got = {(r["host"], r["path"]): r for r in q.site_table(spark.createDataFrame(rows, "host string, path string, logit double")).collect()}
    overall = np.mean([1 / (1 + np.exp(-r[2])) for r in rows])
    assert abs(got["good1", "a"]["path_rate"] - 0.97) < 0.02 and got["good1", "a"]["site_logit"] > 0 > got["bad1", "a"]["site_logit"]
    # One document moves its path from the host, and a host from all, only part of the way.
    assert 0.3 < got["bad0", "rare"]["path_rate"] < 0.9 and got["bad0", "rare"]["site_logit"] < 0
    assert 0.1 < got["tiny", "a"]["path_rate"] < overall
    assert all(abs(r["site_logit"]) <= q.MAX_SITE for r in got.values()) and (None, None) in got


def test_every_case(spark, edge_docs, edge_rows, no_docs):
    labels = spark.createDataFrame([(6, 1), (7, 1), (8, 1), (9, 1), (13, 0), (16, 0), (16, 0), (16, None), (None, 1), (999, 0)], "doc_id long, quality int")
    got = q.classify(edge_docs, labels)
    assert got.count() == len(edge_rows)
    assert got.filter(F.col("kept").isNull() | F.isnan("probability")).count() == 0
    kept = q.filter_quality(edge_docs, labels)
    assert kept.columns == edge_docs.columns and kept.dtypes == edge_docs.dtypes
    assert kept.count() == got.filter("kept").count()
    texts = {r["text"] for r in kept.collect()}
    assert CLEAN in texts and TEXTS[16] not in texts
    for none in (labels.filter("false"), labels.filter("quality = 1")):
        assert q.classify(edge_docs, none).filter("kept").count() == len(edge_rows)
    assert q.classify(no_docs, labels).count() == 0 and q.filter_quality(no_docs, labels).count() == 0


def test_hosts_and_paths_of_addresses(spark):
    urls = spark.createDataFrame([("https://M.Example.net:80/en/25#top",), ("http://a.org",), ("http://a.org?x=/y",), ("nonsense",), (None,)], "url string")
    got = [tuple(r) for r in urls.select(q.url_host(F.col("url")), q.url_path(F.col("url"))).collect()]
    assert got == [("m.example.net", "en"), ("a.org", ""), ("a.org", ""), ("", ""), (None, None)]


def test_logistic_recovers_weights():
    random = np.random.default_rng(0)
    x = random.normal(size=(20_000, 2)) * [1, 5] + [0, 3]
    y = random.random(20_000) < 1 / (1 + np.exp(-(0.5 + x @ [1.5, -0.4])))
    assert np.allclose(q.logistic(x, y.astype(float)), [0.5, 1.5, -0.4], atol=0.1)


def shrunk_sites(rows):
    """(host, path) -> site log odds by plain loops over (host, path, logit)."""
    def clipped(x):
        return min(max(x, q.EDGE), 1 - q.EDGE)

    def strength(mean, between, chance):
        return max(q.STRENGTH[0], min(q.STRENGTH[1], mean * (1 - mean) / max(between - chance, q.EDGE) - 1))

    paths, hosts = {}, {}
    for host, path, logit in rows:
        for table, key in ((paths, (host, path)), (hosts, host)):
            n, s = table.get(key, (0, 0.0))
            table[key] = n + 1, s + 1 / (1 + np.exp(-logit))
    total = len(rows)
    mean = clipped(sum(s for _, s in hosts.values()) / total)
    k = strength(mean, sum(n * (s / n - mean) ** 2 for n, s in hosts.values()) / total, mean * (1 - mean) * len(hosts) / total)
    rate = {host: (s + k * mean) / (n + k) for host, (n, s) in hosts.items()}
    between = sum(n * (s / n - rate[key[0]]) ** 2 for key, (n, s) in paths.items()) / total
    k = strength(mean, between, sum(n * rate[key[0]] * (1 - rate[key[0]]) for key, (n, _) in paths.items()) / total)
    sites = {}
    for key, (n, s) in paths.items():
        own = clipped((s + k * rate[key[0]]) / (n + k))
        sites[key] = max(-q.MAX_SITE, min(q.MAX_SITE, np.log(own / (1 - own)) - np.log(mean / (1 - mean))))
    return sites


def test_pages_by_brute_force(spark):
    """Real hosts and paths, most of them with a few pages; and the documents themselves."""
    import re

    from meterline.llm.queries import op10_quality_bayes, quality_of_pages

    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    model = q.fit(docs, labels)
    pages = spark.read.parquet(f"{SF}/pages.parquet").orderBy("page_id").collect()
    texts = [re.sub("<[^>]*>", " ", re.sub(r"(?is)<(script|style)\b[^>]*>.*?</\1\s*>", " ", r["html"] or "")) for r in pages]
    split = [re.match(r"[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)[^/?#]*(?:/([^/?#]*))?", r["url"] or "") for r in pages]
    own = [(m[1].lower() if m else "", (m[2] or "") if m else "") for m in split]
    logits = q.document_logits(model, q.features(pa.array(texts, pa.large_string())))
    sites = shrunk_sites([(*site, logit) for site, logit in zip(own, logits)])
    got = {r["page_id"]: r for r in quality_of_pages(spark, SF).collect()}
    assert len(got) == len(pages) and sum(list(own).count(site) < 4 for site in sites) > 20
    for r, site, logit in zip(pages, own, logits):
        row = got[r["page_id"]]
        assert (row["host"], row["path"]) == site and abs(row["doc_logit"] - logit) < 1e-9 and abs(row["site_logit"] - sites[site]) < 1e-6
        assert row["kept"] == (row["probability"] >= 0.5) and abs(row["probability"] - 1 / (1 + np.exp(-(logit + sites[site])))) < 1e-6
    rows = docs.select("doc_id", "source", "lang", "text").collect()
    logits = dict(zip((r["doc_id"] for r in rows), q.document_logits(model, q.features(pa.array([r["text"] or "" for r in rows], pa.large_string())))))
    sites = shrunk_sites([(r["source"], r["lang"], logits[r["doc_id"]]) for r in rows])
    judged = {r["doc_id"]: r for r in op10_quality_bayes(spark, SF).collect()}
    assert len(judged) == len(rows)
    assert all(abs(judged[r["doc_id"]]["site_logit"] - sites[r["source"], r["lang"]]) < 1e-6 for r in rows)
    assert all(judged[r["doc_id"]]["kept"] == (logits[r["doc_id"]] + sites[r["source"], r["lang"]] >= 0) for r in rows)
