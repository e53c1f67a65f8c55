"""The named queries of this package with their check SQL, where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.llm import (
    byte_pairs, collocations, mixing, pii, quality_bayes, quality_rules, ranked_search, sentencepieces, simhash, token_blocks, token_counts,
    tool_calls, topk,
)
from meterline.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Places of the public vocabulary files; the same on every machine.
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


@query("op1_quality_rules", sql=r"""
WITH split AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l,
    row_number() OVER () AS r
  FROM documents
), windows AS (
  SELECT r, i, [w[i], w[i + 1], w[i + 2]] AS v FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM split)
), repeated AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, v) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT r, count(DISTINCT i + k) AS n FROM repeated, range(3) AS s(k) GROUP BY r
), measured AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
    (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
    len(l)::BIGINT AS n_lines, length(regexp_replace(t, '[^!]+', '', 'g'))::BIGINT AS n_bangs
  FROM split LEFT JOIN covered USING (r)
), flagged AS (
  SELECT *, ((n_words < 50)::BIGINT + 2 * (100 * n_repeat_words > 50 * n_words)::BIGINT + 4 * (10 * n_symbols > 3 * n_words)::BIGINT
    + 8 * (n_lines > 3 AND 100 * n_dup_lines > 40 * n_lines)::BIGINT
    + 16 * (word_chars < 2 * n_words OR word_chars > 15 * n_words)::BIGINT + 32 * (10 * n_bangs > 3 * n_words)::BIGINT)::BIGINT AS failed_bits
  FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_bangs, failed_bits,
  failed_bits & 3 <> 0 AS base_failed, failed_bits & 63 = 0 AS kept
FROM flagged
""")
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger of every document with the base verdict and that of the newest policy."""
    ledger = quality_rules.ledger(table(spark, sf_dir, "documents"))
    return ledger.select(
        "*", (~quality_rules.passes(quality_rules.BASE_RULES)).alias("base_failed"),
        quality_rules.passes(quality_rules.POLICIES["v2"]).alias("kept"),
    )


_RULE_ROWS = ", ".join(f"('{rule.name}', {1 << rule.bit})" for rule in quality_rules.RULES)


@query("quality_rule_ablation", sql=ORACLES["op1_quality_rules"].rpartition("SELECT doc_id,")[0].rstrip() + f""", rules(rule, mask) AS (VALUES {_RULE_ROWS})
SELECT rule, count_if(failed_bits & mask <> 0)::BIGINT AS n_failed, count_if(failed_bits = mask)::BIGINT AS n_failed_alone,
  count_if(failed_bits = 0)::BIGINT AS n_kept, count_if(failed_bits = 0 OR failed_bits = mask)::BIGINT AS n_kept_without
FROM flagged, rules GROUP BY rule
""")
def quality_rule_ablation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule of the newest policy decides, alone and beside the others."""
    return quality_rules.ablation(quality_rules.ledger(table(spark, sf_dir, "documents")), quality_rules.POLICIES["v2"])


@query("op2_token_blocks")
def op2_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write every document's ids as packed blocks and read them back."""
    return token_blocks.round_trip(table(spark, sf_dir, "documents"), BYTE_BPE)


@query("op7_sentencepieces")
def op7_sentencepieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every document and their decoding, as digests."""
    return sentencepieces.digests(sentencepieces.encode(table(spark, sf_dir, "documents"), PIECE_BPE))


@query("op9_simhash_groups")
def op9_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash.groups(table(spark, sf_dir, "documents"))


@query("op6_source_mix", sql=r"""
WITH sized AS (
  SELECT doc_id, source, len(w)::BIGINT AS size, md5(t) AS h, t,
    greatest(0.05::DOUBLE, 1::DOUBLE - length(regexp_replace(t, '[^#*$%&|<>!]+', '', 'g'))::DOUBLE / greatest(len(w), 1)) AS quality
  FROM (SELECT doc_id, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents)
), keyed AS (
  SELECT *, -ln((('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || h), 1, 13))::BIGINT + 1)::DOUBLE / 4503599627370496) / quality AS key
  FROM sized
), totals AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM keyed GROUP BY source
), weighted AS (
  SELECT *, CASE (rank - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, 2 * source_size AS lim FROM totals
), levels AS (
  SELECT *, lim::DOUBLE / weight AS ratio,
    (1.5::DOUBLE * (SELECT sum(source_size) FROM weighted) - (sum(lim) OVER filling - lim))
    / ((SELECT sum(weight) FROM weighted) - (sum(weight) OVER filling - weight)) AS level
  FROM weighted WINDOW filling AS (ORDER BY lim::DOUBLE / weight, rank ROWS UNBOUNDED PRECEDING)
), aims AS (
  SELECT source, source_size, least(lim::DOUBLE, weight * (SELECT arg_min(level, (ratio, rank)) FROM levels WHERE level <= ratio)) AS target
  FROM levels
), ordered AS (
  SELECT k.*, source_size, target, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs,
    coalesce(sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id, h ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
  FROM keyed k JOIN aims a ON k.source IS NOT DISTINCT FROM a.source
)
SELECT doc_id, size, source_size, round(target, 6) AS target,
  (size * (epochs + CASE WHEN 2 * ahead + size <= 2 * (target - epochs * source_size) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM ordered
""")
def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    return mixing.mix(table(spark, sf_dir, "documents")).withColumn("target", F.round("target", 6))


@query("op10_quality_bayes")
def op10_quality_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document, site and posterior evidence of every document, and the decision."""
    return quality_bayes.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("quality_of_pages")
def quality_of_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web pages judged by the classifier of the documents and by their sites: host of the address, first step of its path."""
    model = quality_bayes.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    body = F.regexp_replace(F.regexp_replace("html", r"(?is)<(script|style)\b[^>]*>.*?</\1\s*>", " "), "<[^>]*>", " ")
    pages = table(spark, sf_dir, "pages").select("page_id", "url", body.alias("text"))
    return quality_bayes.judge(pages, model, quality_bayes.url_host(F.col("url")), quality_bayes.url_path(F.col("url")), id_column="page_id")


@query("op3_pii_spans")
def op3_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and added spans of personal data in every document."""
    docs = table(spark, sf_dir, "documents")
    return pii.digests(pii.find(docs, pii.fit(docs)))


@query("op4_section_tokens")
def op4_section_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line of every document; boundary-crossing tokens go to the larger part."""
    return token_counts.section_counts(table(spark, sf_dir, "documents"), BYTE_BPE)


@query("op5_tool_links", sql=r"""
WITH RECURSIVE texts AS (
  SELECT conv_id, turn, role, text, coalesce(text, '') AS t, length(coalesce(text, '')) AS l,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM conversations
), log AS (
  SELECT conv_id, turn, text,
    CASE WHEN role = 'assistant' THEN 'call' WHEN role = 'user' AND turn > 0 THEN 'result' ELSE 'message' END AS kind,
    CASE WHEN role = 'assistant' THEN 'call-' || conv_id || '-' || turn WHEN role = 'user' AND turn > 0 THEN 'call-' || conv_id || '-' || (turn - 1) END AS call_id,
    CASE WHEN role = 'assistant' AND l % 2 = 0 AND turn >= 3 THEN 'call-' || conv_id || '-' || (turn - 2) END AS after,
    CASE WHEN role = 'assistant' THEN ['search', 'convert', 'lookup'][(l % 3 + 1)::INTEGER] END AS name, l,
    CASE WHEN role <> 'assistant' THEN NULL
      WHEN l % 3 = 0 THEN '{"limit":' || (len(w) % 7) || ',"query":' || to_json(coalesce(w[1], ''))::VARCHAR || '}'
      WHEN l % 3 = 1 THEN '{"unit":"char","value":' || l || '}'
      ELSE '{' || CASE WHEN l % 5 = 0 THEN '' ELSE '"key":"turn-' || turn || '",' END
        || '"strict":' || CASE WHEN l % 2 = 0 THEN 'true' ELSE 'false' END || '}' END AS canonical,
    CASE WHEN l % 3 = 0 AND len(w) % 7 = 0 THEN ['limit: below 1'] WHEN l % 3 = 2 AND l % 5 = 0 THEN ['key: missing'] ELSE [] END AS argument_errors
  FROM texts
), calls AS (SELECT * FROM log WHERE kind = 'call'
), chain(conv_id, call_id, turn, level) AS (
  SELECT conv_id, call_id, turn, 0::BIGINT FROM calls c WHERE after IS NULL OR NOT EXISTS (FROM calls p WHERE p.conv_id = c.conv_id AND p.call_id = c.after)
  UNION ALL
  SELECT c.conv_id, c.call_id, c.turn, chain.level + 1 FROM calls c JOIN chain ON c.conv_id = chain.conv_id AND c.after = chain.call_id
)
SELECT c.conv_id, c.turn AS place, 2 * level AS level, c.turn, kind, c.call_id,
  CASE WHEN EXISTS (FROM log r WHERE r.kind = 'result' AND r.conv_id = c.conv_id AND r.call_id = c.call_id) THEN 'answered' ELSE 'unanswered' END AS status,
  array_to_string(e, '; ') AS errors, len(e) = 0 AS valid,
  '{' || CASE WHEN after IS NULL THEN '' ELSE '"after":"' || after || '",' END || '"arguments":' || canonical || ',"call_id":"' || c.call_id || '"'
    || CASE WHEN text IS NULL THEN '' ELSE ',"content":' || to_json(text)::VARCHAR END || ',"name":"' || name || '","role":"call"}' AS json
FROM (SELECT *, argument_errors || CASE WHEN after IS NOT NULL AND NOT EXISTS (FROM calls p WHERE p.conv_id = calls.conv_id AND p.call_id = calls.after)
  THEN ['after: unknown call'] ELSE [] END AS e FROM calls) c JOIN chain USING (conv_id, call_id)
UNION ALL
SELECT r.conv_id, r.turn, CASE WHEN chain.level IS NULL THEN 0 ELSE 2 * chain.level + 1 END, r.turn, kind, r.call_id,
  CASE WHEN chain.level IS NULL THEN 'orphan' ELSE 'linked' END, '', true,
  '{"call_id":"' || r.call_id || '"' || CASE WHEN text IS NULL THEN '' ELSE ',"content":' || to_json(text)::VARCHAR END || ',"role":"result"}'
FROM log r LEFT JOIN chain USING (conv_id, call_id) WHERE kind = 'result'
UNION ALL
SELECT conv_id, turn, -1, turn, kind, NULL, 'plain', '', true,
  CASE WHEN text IS NULL THEN '{"role":"message"}' ELSE '{"content":' || to_json(text)::VARCHAR || ',"role":"message"}' END
FROM log WHERE kind = 'message'
""")
def op5_tool_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tool log read from every conversation, linked, ordered, checked and serialised."""
    linked = tool_calls.link(tool_calls.derive(table(spark, sf_dir, "conversations")))
    return linked.withColumn("errors", F.array_join("errors", "; "))


@query("op8_segment_topk", sql=r"""
WITH usable AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 256)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), scored AS (
  SELECT q.vec_id AS query_id, q.v AS qv, x.vec_id, x.v, list_dot_product(q.v::DOUBLE[], x.v::DOUBLE[])::BIGINT AS score
  FROM usable q JOIN usable x ON x.vec_id <> q.vec_id AND len(x.v) = len(q.v) WHERE q.vec_id % 50 = 0
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id, qv ORDER BY score DESC, vec_id, v) AS rank FROM scored) WHERE rank <= 5
""")
def op8_segment_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best rows for every fiftieth id."""
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.filter("vec_id % 50 = 0"))


@query("op11_byte_pairs")
def op11_byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-pair ids of every document and the bytes they decode to, as digests."""
    encoded = byte_pairs.encode(table(spark, sf_dir, "documents"), BYTE_RANKS, public_tokenizers.PATTERN)
    return byte_pairs.digests(encoded, BYTE_RANKS)


@query("op12_ranked_search", sql=r"""
WITH words AS (
  SELECT d, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9A-Za-z\x{80}-\x{10FFFF}]+')) AS term
  FROM (SELECT row_number() OVER () AS d, doc_id, text FROM documents)
), held AS (SELECT d, doc_id, term, count(*) AS tf FROM words GROUP BY ALL
), lengths AS (SELECT d, sum(tf)::BIGINT AS n FROM held GROUP BY d
), totals AS (SELECT count(*) AS nn, sum(n)::BIGINT AS l FROM lengths
), weights AS (SELECT term, floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM held, totals GROUP BY term, nn
), asked AS (
  SELECT i, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9A-Za-z\x{80}-\x{10FFFF}]+')) AS term
  FROM (SELECT row_number() OVER () AS i, item_id, text FROM benchmark)
), scored AS (
  SELECT i, item_id, d, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * nn) // l))))::BIGINT AS score
  FROM asked JOIN held USING (term) JOIN weights USING (term) JOIN lengths USING (d), totals GROUP BY ALL
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0) WHERE rank <= 20
""")
def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents for every benchmark item."""
    return ranked_search.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op13_collocations", sql=r"""
WITH pieces AS (
  SELECT lang, p, regexp_extract_all(t, '[^\x20\x09]+') AS w FROM (
    SELECT lang, row_number() OVER () AS p, t FROM (
      SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS t FROM documents))
), totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang
), grams AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, w[i:i + k - 1] AS v
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM pieces, range(1, 5) AS s(k) WHERE len(w) >= k)
), counted AS (SELECT lang, k, phrase, any_value(v) AS v, count(*) AS f FROM grams GROUP BY lang, k, phrase HAVING count(*) >= 30
), candidates AS (SELECT lang, k, phrase, v, f AS a FROM counted WHERE k > 1
), cuts AS (
  SELECT lang, phrase, a, c, array_to_string(v[1:c], ' ') AS p, array_to_string(v[c + 1:k], ' ') AS q
  FROM (SELECT *, unnest(range(1, k)) AS c FROM candidates)
), scored AS (
  SELECT cuts.lang, cuts.phrase, a, c, x.f AS l, y.f AS r, (2000000::HUGEINT * a) // (x.f::HUGEINT + y.f) AS score
  FROM cuts JOIN counted x ON x.lang = cuts.lang AND x.phrase = p JOIN counted y ON y.lang = cuts.lang AND y.phrase = q
), lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1
), within AS (
  SELECT lang, array_to_string(v[b:b + z - 1], ' ') AS phrase, max(a) AS inside
  FROM (SELECT *, unnest(range(1, k - z + 2)) AS b FROM (SELECT *, unnest(range(2, k)) AS z FROM candidates)) GROUP BY ALL
)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score
FROM (SELECT lowest.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
      FROM lowest LEFT JOIN within USING (lang, phrase) WHERE inside IS NULL OR 100 * inside < 80 * a) JOIN totals USING (lang)
WHERE rank <= 2000
""")
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 best phrases of each language."""
    return collocations.collocations(table(spark, sf_dir, "documents"))
