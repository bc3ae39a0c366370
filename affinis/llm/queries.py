"""Registered queries of the subpackage and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from affinis.llm import (ann, conversations, jaccard_join, language_id, lexical_search, license_scan, mixing, near_dup, packing, pii, quality_rules, sharding,
                         url_filters)
from affinis.llm.common import table


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.verdicts(table(spark, sf_dir, "documents"))


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge_pages(table(spark, sf_dir, "pages"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_spans(table(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op7_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_documents(table(spark, sf_dir, "documents"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_digest(table(spark, sf_dir, "documents"))


def op10_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest_embeddings(table(spark, sf_dir, "embeddings"))


def op11_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))


def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair_report(table(spark, sf_dir, "conversations"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {f.__name__: f for f in (
    op1_sharding, op2_language_id, op3_quality_rules, op4_url_filters, op5_pii, op6_packing, op7_near_dup,
    op8_license_scan, op9_mixing, op10_ann, op11_jaccard_join, op12_conversations,
    op13_lexical_search)}

# op9: the same line of documents, as one window per source.
_OP9 = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5('42:' || coalesce(doc_id::VARCHAR, '') || ':' || coalesce(md5(text), '')) AS h FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, ([5, 2, 1])[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3) + 1] AS w, 2 * source_size AS cap FROM s),
f AS (
  SELECT *, cap / w <= (total - before) / left_w AS is_full FROM (
    SELECT *, sum(source_size) OVER () * 1.5::DOUBLE AS total,
           coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
           sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS left_w
    FROM w WINDOW o AS (ORDER BY cap / w, source NULLS LAST))),
t AS (
  SELECT source, source_size, cap, CASE WHEN is_full THEN cap::DOUBLE ELSE
    (total - sum(CASE WHEN is_full THEN cap ELSE 0 END) OVER ()) / sum(CASE WHEN is_full THEN 0 ELSE w END) OVER () * w END AS target
  FROM f),
q AS (SELECT *, least(floor(target + 0.5), cap)::BIGINT AS quota FROM t),
p AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY h, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS place FROM d)
SELECT p.doc_id, p.size, q.source_size, q.target,
       (greatest(0, least(quota - place, size)) + greatest(0, least(quota - place - source_size, size)))::BIGINT AS taken,
       ((size > 0 AND quota > place)::INTEGER + (size > 0 AND quota - source_size > place)::INTEGER)::INTEGER AS copies
FROM p JOIN q ON p.source IS NOT DISTINCT FROM q.source
"""

# op4: the rules tried one by one, longest first.
_OP4 = r"""
WITH u AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)', 1, 's'),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)', 2, 's') AS path FROM pages),
r AS (
  SELECT *, CASE
    WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/' END AS rule
  FROM u),
l AS (
  SELECT DISTINCT host AS listed FROM u WHERE host <> '' AND substr(md5('42:' || host), 1, 1) IN ('0', '1', '2', '3')
  UNION SELECT 'spam-farm.example.org'),
b AS (SELECT DISTINCT h.host FROM (SELECT DISTINCT host FROM u) h JOIN l ON h.host = listed OR ends_with(h.host, '.' || listed))
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
  WHEN host IN (SELECT host FROM b) THEN 'block' ELSE 'allow' END AS verdict
FROM r
"""

# op10: every query against every row.
_OP10 = """
WITH v AS (
  SELECT DISTINCT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""


def _op12() -> str:
    """op12: the edits' automaton run row by row, the best way to each state as nine digits of cost and the audit."""
    def plus(way: str, cost: int, edits: str) -> str:
        return f"(printf('%09d', substr({way}, 1, 9)::INT + {cost}) || substr({way}, 10) || '{edits}')"

    def least(*ways: str) -> str:
        return f"least({', '.join(ways)})"

    def inserts(s: list[str]) -> list[str]:
        return [s[0], s[1], least(s[2], *(plus(s[i], 5, "I") for i in (0, 1, 3))),
                least(s[3], plus(s[2], 5, "I"), *(plus(s[i], 10, "II") for i in (0, 1)))]

    def keep(way: str, symbol: str) -> str:
        return f"CASE WHEN NOT gone AND initial = '{symbol}' THEN {_late(way, 0, 'K')} END"

    def _late(way: str, cost: int, edit: str) -> str:
        return f"CASE WHEN cut THEN {plus(way, cost + 5, edit)} ELSE {plus(way, cost, edit)} END"

    def rerole(way: str) -> str:
        return f"CASE WHEN NOT gone THEN {_late(way, 1, 'R')} END"

    i = ["i0", "i1", "i2", "i3"]
    gone = [plus(w, 2, "D") for w in i]
    step = [gone[0], least(gone[1], keep("i0", "s")),
            least(gone[2], *(f(w) for w in ("i0", "i1", "i3") for f in (lambda w: keep(w, "u"), rerole))),
            least(gone[3], keep("i2", "a"), rerole("i2"))]
    ways = [f"s{k}" for k in range(4)]
    return rf"""
WITH RECURSIVE t AS (
  SELECT list(v ORDER BY n) AS tbl FROM (SELECT n, list_reduce([n] || [0::BIGINT, 0, 0, 0, 0, 0, 0, 0],
      lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END) AS v
    FROM (SELECT unnest(range(256))::BIGINT AS n))),
k AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
        lambda c: ord(c)::BIGINT), lambda a, b: xor(a >> 8, tbl[(xor(a, b) & 255) + 1])), 4294967295::BIGINT) % 20 AS kind
  FROM conversations, t),
d AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM k, (SELECT unnest([1, 2]) AS copy) WHERE kind <> 0 AND (copy = 1 OR kind = 3)),
o AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, h, id) AS n,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, id) AS seen, substr(role, 1, 1) AS initial,
    rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS ended
  FROM (SELECT *, sha256(length(role)::VARCHAR || ':' || role || text) AS h, row_number() OVER () AS id FROM d)),
f AS (
  SELECT *, ended = '' AS blank, ended <> '' AND seen > 1 AS again, ended <> '' AND seen = 1 AND right(ended, 1) NOT IN ('.', '!', '?') AS cut,
    ended = '' OR seen > 1 AS gone, lag(initial) OVER (PARTITION BY conv_id ORDER BY n) || initial AS pair FROM o),
g AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
    count(*) FILTER (again) AS duplicate, count(*) FILTER (cut) AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n FROM f GROUP BY conv_id),
w AS (
  SELECT conv_id, 0::BIGINT AS n, '000000000' AS s0, NULL::VARCHAR AS s1, NULL::VARCHAR AS s2, NULL::VARCHAR AS s3 FROM g
  UNION ALL
  SELECT conv_id, n, {", ".join(step)} FROM (
    SELECT w.conv_id, f.n, f.initial, f.gone, f.cut, {", ".join(f"{c} AS i{j}" for j, c in enumerate(inserts(ways)))}
    FROM w JOIN f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.n = w.n + 1)),
e AS (
  SELECT conv_id, n, least(s0, {inserts(ways)[3]}) AS way FROM w),
a AS (
  SELECT g.*, substr(e.way, 1, 9)::BIGINT AS cost, substr(e.way, 10) AS audit
  FROM g JOIN e ON e.conv_id IS NOT DISTINCT FROM g.conv_id AND e.n = g.n),
c AS (SELECT conv_id, p, substr(audit, p, 1) AS edit FROM (SELECT conv_id, audit, unnest(range(1, length(audit) + 1)) AS p FROM a)),
q AS (
  SELECT *, sum((edit <> 'I')::INT) OVER (PARTITION BY conv_id ORDER BY p) AS n,
    sum((edit <> 'D')::INT) OVER (PARTITION BY conv_id ORDER BY p) AS place FROM c),
r AS (
  SELECT q.*, f.role, f.text, max((place = 1 AND edit = 'K' AND f.initial = 's')::INT) OVER (PARTITION BY q.conv_id) AS lead
  FROM q LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM q.conv_id AND f.n = q.n),
z AS (
  SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN (place - lead) % 2 = 1 THEN 'user' ELSE 'assistant' END
                             || ':' || CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY p) AS body
  FROM r WHERE edit <> 'D' GROUP BY conv_id)
SELECT i.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost,
  coalesce(audit, '') AS audit, sha256(coalesce(body, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) i LEFT JOIN a ON a.conv_id IS NOT DISTINCT FROM i.conv_id
LEFT JOIN z ON z.conv_id IS NOT DISTINCT FROM i.conv_id
"""


# op13: every document of each item's terms.
_OP13 = r"""
WITH t AS (
  SELECT row_number() OVER () AS doc, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
n AS (SELECT doc, any_value(doc_id) AS doc_id, count(*) AS n FROM t GROUP BY doc),
c AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM n),
m AS (SELECT doc, doc_id, 75 + (25 * n * docs) // terms AS m FROM n, c),
f AS (SELECT doc, term, count(*) AS tf FROM t GROUP BY doc, term),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w FROM (SELECT term, count(*) AS df FROM f GROUP BY term), c),
i AS (
  SELECT item_id, term, count(*) AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM (SELECT DISTINCT item_id, text FROM benchmark))
  GROUP BY item_id, term),
s AS (
  SELECT item_id, m.doc, m.doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
  FROM i JOIN w USING (term) JOIN f USING (term) JOIN m ON m.doc = f.doc GROUP BY item_id, m.doc, m.doc_id)
SELECT * FROM (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST, doc)::INTEGER AS rank, doc_id, score
  FROM s WHERE score > 0) WHERE rank <= 20
"""

ORACLE_SQL = {"op4_url_filters": _OP4, "op9_mixing": _OP9, "op10_ann": _OP10, "op12_conversations": _op12(),
              "op13_lexical_search": _OP13}
