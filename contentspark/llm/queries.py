"""The registered queries of the operators, and their oracle SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contentspark.llm import bitslice_simhash, block_topk, exact_dedup, geometric_search, kneser_ney, license_scan, merkle_manifest, mixing, ngram_join, pii, sentencepiece_unigram, url_reputation, warc_archive
from contentspark.llm.common import load

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    def register(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql.strip()
        return fn

    return register


@query("op1_sentencepiece")
def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's piece ids, their number, and whether they decode to the text."""
    return sentencepiece_unigram.encode(load(spark, sf_dir, "documents"))


@query("op2_block_topk", """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS query_id, b.vec_id, list_dot_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id)
SELECT query_id, rank::INT AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= 10
""")
def op2_block_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best other vectors of every vector whose vec_id is divisible by 100."""
    return block_topk.top_k(load(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@query("op3_warc", r"""
SELECT page_id, strlen(html) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (
         (('0x' || substr(code, 1 + 5 * (i // 4)::INT, 5))::INT >> (15 - 5 * (i % 4))::INT) & 31), 1)), '') AS payload_digest,
       CASE WHEN last IS NOT DISTINCT FROM page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN last IS DISTINCT FROM page_id THEN last END AS refers_to, true AS verified
FROM (SELECT page_id, html, sha1(html) AS code, max(page_id) OVER (PARTITION BY html) AS last
      FROM (SELECT page_id, coalesce(html, '') AS html FROM pages))
""")
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the archive of all pages, reads it back: every record's type, payload length and digest, and reference."""
    return warc_archive.read_records(warc_archive.write_archive(load(spark, sf_dir, "pages")))


def _url_sql() -> str:
    u = url_reputation
    rules = ", ".join(f"('{v}', '{r}', '{r.partition('/')[0]}', '/{r.partition('/')[2]}')" for v, r in u.RULES)
    two = ", ".join(f"'{x}'" for x in u.TWO_LABEL_SUFFIXES)
    strength = rf"""
  SELECT CASE WHEN count(*) < 2 OR sum(n * mean * (1 - mean)) <= 0 THEN 1.0
              WHEN sum(n * (bad / n - mean) ** 2) <= sum(mean * (1 - mean)) THEN {u.MOST_STRENGTH}
              ELSE least({u.MOST_STRENGTH}, greatest(1.0, sum(n * mean * (1 - mean)) / sum(n)
                   / ((sum(n * (bad / n - mean) ** 2) - sum(mean * (1 - mean))) / sum(n)) - 1)) END AS s
  FROM (SELECT n, bad, m AS mean FROM %s) WHERE n > 0"""
    post = "(s * m + bad) / (s + n)"
    return rf"""
WITH parts AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
cut AS (
  SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), '{u.UPPER}', '{u.LOWER}') AS host,
         regexp_extract(substr(coalesce(rest, ''), length(regexp_extract(coalesce(rest, ''), '^[^/?#]*')) + 1), '^[^?#]*') AS path
  FROM parts),
outcomes AS (SELECT doc_id AS page_id, max((quality = 0)::INT) AS bad FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
counts AS (
  SELECT host, count(bad) AS n, coalesce(sum(bad), 0) AS bad,
         regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') AS bare
  FROM cut LEFT JOIN outcomes USING (page_id) GROUP BY host),
named AS (
  SELECT *, regexp_matches(bare, '^[0-9.]+$|^\[|^[^.]*$') AS own, string_split(bare, '.') AS l,
         array_to_string(string_split(bare, '.')[-2:], '.') IN ({two}) AS two FROM counts),
hosts AS (
  SELECT host, n, bad, CASE WHEN own THEN bare ELSE array_to_string(l[(CASE WHEN two THEN -3 ELSE -2 END):], '.') END AS domain,
         CASE WHEN own THEN bare ELSE array_to_string(l[(CASE WHEN two THEN -2 ELSE -1 END):], '.') END AS suffix
  FROM named),
l1 AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad, (sum(sum(bad)) OVER () + 1) / (sum(sum(n)) OVER () + 2) AS m FROM hosts GROUP BY suffix),
s1 AS ({strength % "l1"}),
l2 AS (SELECT domain, suffix, sum(h.n) AS n, sum(h.bad) AS bad, any_value((s * l1.m + l1.bad) / (s + l1.n)) AS m
       FROM hosts h JOIN l1 USING (suffix), s1 GROUP BY domain, suffix),
s2 AS ({strength % "l2"}),
l3 AS (SELECT host, h.n, h.bad, (s * l2.m + l2.bad) / (s + l2.n) AS m FROM hosts h JOIN l2 USING (domain, suffix), s2),
s3 AS ({strength % "l3"}),
known AS (SELECT host, n, {post} AS mean, s + n + 1 AS width FROM l3, s3),
rated AS (SELECT host, n, round(mean, 6) AS bad_rate, round(mean - {u.Z} * sqrt(mean * (1 - mean) / width), 6) AS bad_bound FROM known),
rules(verdict, rule, rule_host, rule_path) AS (VALUES {rules}),
fits AS (
  SELECT host, path, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM (SELECT DISTINCT host, path FROM cut) JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY host, path)
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN bad_bound > {u.LIMIT} THEN 'block' ELSE 'allow' END) AS verdict,
       n AS host_labels, bad_rate, bad_bound
FROM cut JOIN rated USING (host) LEFT JOIN fits USING (host, path)
"""


@query("op4_url_reputation", _url_sql())
def op4_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's host, path, rule and verdict; labels of the documents with the page's id are its outcomes."""
    return url_reputation.judge(load(spark, sf_dir, "pages"), load(spark, sf_dir, "labels"))


@query("op5_pii")
def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's personal data: counts and digest of the base spans, all spans with scores."""
    return pii.personal_data(load(spark, sf_dir, "documents"))


def _license_sql() -> str:
    templates = ",\n         ".join(
        f"({n}, '{label}', {phrase}, {2 if phrase else 4}, '{text}')"
        for n, (text, label, phrase) in enumerate([(t, l, True) for t, l in license_scan.PHRASES]
                                                  + [(t, l, False) for t, l in license_scan.LICENSE_TEXTS]))
    return rf"""
WITH t(template, label, phrase, k, text) AS (
  VALUES {templates}),
grams AS (
  SELECT template, label, phrase, k, i AS tpos, len(words) - k + 1 AS grams, array_to_string(words[i + 1:i + k], ' ') AS gram
  FROM (SELECT *, unnest(range(len(words) - k + 1)) AS i FROM (SELECT *, string_split(text, ' ') AS words FROM t))),
d AS MATERIALIZED (
  SELECT row_number() OVER () AS row, doc_id, list_transform(
           regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'),
           lambda w: translate(w, '{license_scan.UPPER}', '{license_scan.LOWER}')) AS w
  FROM documents),
words AS (SELECT row, pos, w, len(w) AS n FROM (SELECT row, w, unnest(range(len(w))) AS pos FROM d)),
hits AS (
  SELECT row, template, label, phrase, grams, pos, tpos FROM grams JOIN (
    SELECT row, pos, array_to_string(w[pos + 1:pos + 4], ' ') AS gram, 4 AS k FROM words WHERE pos + 4 <= n
    UNION ALL SELECT row, pos, array_to_string(w[pos + 1:pos + 2], ' '), 2 FROM words WHERE pos + 2 <= n) USING (k, gram)),
votes AS (
  SELECT row, template, label, phrase, grams, pos - tpos AS diagonal, count(*) AS votes, min(pos) AS lo, max(pos) AS hi
  FROM hits GROUP BY ALL),
marked AS (
  SELECT *, coalesce(phrase OR abs(diagonal - lag(diagonal) OVER line) > {license_scan.SHIFT}
                     OR lo > max(hi) OVER (line ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + {license_scan.GAP},
                     true)::INT AS new
  FROM votes WINDOW line AS (PARTITION BY row, template ORDER BY lo, diagonal)),
merged AS (
  SELECT row, template, label, phrase, span, min(lo) AS first, least(sum(votes), any_value(grams)) / any_value(grams) AS score
  FROM (SELECT *, sum(new) OVER (PARTITION BY row, template ORDER BY lo, diagonal) AS span FROM marked) GROUP BY ALL),
spans AS (SELECT * FROM merged WHERE score >= CASE WHEN phrase THEN 1 ELSE {license_scan.COVER} END)
SELECT doc_id, len(any_value(w)) AS n_words, count(first) FILTER (phrase) AS n_base, min(first) FILTER (phrase) AS first_word,
       max(first) FILTER (phrase) AS last_word,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (phrase), '') AS base_labels,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS labels, round(coalesce(max(score), 0), 6) AS score
FROM d LEFT JOIN spans USING (row) GROUP BY row, doc_id
"""


@query("op6_license_scan", _license_sql())
def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's license phrases, and the labels and score of license texts found in it."""
    return license_scan.scan(load(spark, sf_dir, "documents"))


@query("op7_kneser_ney")
def op7_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its perplexity, its language's threshold and whether it is kept."""
    return kneser_ney.judge(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


@query("op8_mixing", r"""
WITH sized AS (
  SELECT doc_id, source, CASE WHEN source IS NULL THEN '-' ELSE '+' || source END AS key,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5('mix-1:' || coalesce(doc_id::VARCHAR, 'null') || ':' || coalesce(md5(text), 'null')) AS h
  FROM documents),
src AS (
  SELECT source, key, sum(size)::BIGINT AS source_size, ceil(count(*) / 8192.0)::BIGINT AS shards,
         row_number() OVER (ORDER BY source NULLS LAST) AS rank
  FROM sized GROUP BY source, key),
weighed AS (
  SELECT *, [3, 1, 2][((rank - 1) % 3 + 1)::INT] AS weight,
         greatest(1, least(128, floor(sum(source_size) OVER () / (count(*) OVER () * 256))))::BIGINT AS block
  FROM src),
levels AS (
  SELECT *, (1.5 * sum(source_size) OVER () - coalesce(sum(2 * source_size) OVER poorer, 0))::DOUBLE
            / (sum(weight) OVER () - coalesce(sum(weight) OVER poorer, 0)) AS level
  FROM weighed
  WINDOW poorer AS (ORDER BY 2 * source_size / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
goals AS (
  SELECT *, least((2 * source_size)::DOUBLE, weight * max(level) OVER ()) AS target
  FROM levels),
dealt AS (
  SELECT doc_id, key, size, source_size, target, block, h, ('0x' || substr(h, 1, 7))::BIGINT % shards AS shard
  FROM sized JOIN goals USING (key)),
lines AS (
  SELECT *, row_number() OVER line AS pos, (sum(size) OVER line)::BIGINT AS e, (sum(size) OVER line)::BIGINT - size AS s
  FROM dealt WINDOW line AS (PARTITION BY key, shard ORDER BY h, doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING)),
shards AS (
  SELECT key, shard, max(e) AS words, greatest(1, round(max(e) / max(block)))::BIGINT AS n
  FROM lines GROUP BY key, shard HAVING max(e) > 0),
wanted AS (
  SELECT key, rank, target * sum(n) / source_size AS w, (2 * sum(n))::BIGINT AS most
  FROM goals JOIN shards USING (key) GROUP BY key, rank, target, source_size),
source_quotients AS (
  SELECT key, row_number() OVER (ORDER BY w / (2 * k + 1) DESC, rank, k) AS place,
         (SELECT round(round(sum(w), 6))::BIGINT FROM wanted) AS total
  FROM (SELECT *, unnest(generate_series(0, most - 1)) AS k FROM wanted)),
source_seats AS (SELECT key, count(*) AS total FROM source_quotients WHERE place <= total GROUP BY key),
shard_quotients AS (
  SELECT key, shard, row_number() OVER (PARTITION BY key ORDER BY n / (2 * k + 1) DESC, shard, k) AS place
  FROM (SELECT *, unnest(generate_series(0, 2 * n - 1)) AS k FROM shards)),
seats AS (
  SELECT key, shard, count(*) AS seats FROM shard_quotients JOIN source_seats USING (key)
  WHERE place <= total GROUP BY key, shard),
quotas AS (SELECT *, seats // n AS whole, seats % n AS extra FROM shards JOIN seats USING (key, shard)),
picked AS (
  SELECT * FROM (
    SELECT key, shard, j * words // n AS lo, (j + 1) * words // n AS hi, extra,
           row_number() OVER (PARTITION BY key, shard ORDER BY md5('mix-1:' || key || ':' || shard || ':' || j), j) AS lot
    FROM (SELECT *, unnest(generate_series(0, n - 1)) AS j FROM quotas WHERE extra > 0))
  WHERE lot <= extra),
more AS (
  SELECT key, shard, pos, sum(least(e, hi) - greatest(s, lo)) AS words
  FROM lines JOIN picked USING (key, shard) WHERE s < hi AND lo < e GROUP BY key, shard, pos)
SELECT doc_id, size, source_size, target,
       (coalesce(whole, 0) * size + coalesce(more.words, 0))::BIGINT AS taken
FROM lines LEFT JOIN quotas USING (key, shard) LEFT JOIN more USING (key, shard, pos)
""")
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its size, its source's size and target, and the words of it that the mix takes."""
    return mixing.mix(load(spark, sf_dir, "documents")).drop("text_hash")


@query("op9_ngram_join")
def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its near-duplicate class and its number of links to other n-gram sets."""
    return ngram_join.near_classes(load(spark, sf_dir, "documents"))


@query("op10_exact_dedup", r"""
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM min(doc_id) OVER same AS kept, sha256(norm) AS text_sha256
FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
WINDOW same AS (PARTITION BY norm)
""")
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the copy that stays, its group's size and its normalised text's digest."""
    return exact_dedup.exact_groups(load(spark, sf_dir, "documents")).drop("text_hash")


def _ranked_sql() -> str:
    terms = (rf"regexp_extract_all(translate(coalesce(text, ''), '{merkle_manifest.UPPER}', '{merkle_manifest.LOWER}'), "
             r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")
    return rf"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, {terms} AS w FROM documents),
q AS (SELECT row_number() OVER () AS query, item_id, {terms} AS w FROM benchmark),
asked AS (SELECT query, item_id, word, count(*) AS times FROM (SELECT query, item_id, unnest(w) AS word FROM q) GROUP BY ALL),
totals AS (SELECT count(*)::BIGINT AS n_docs, sum(len(w))::BIGINT AS length FROM d WHERE len(w) > 0),
tfs AS (
  SELECT row, doc_id, n, word, count(*) AS tf
  FROM (SELECT row, doc_id, len(w) AS n, unnest(w) AS word FROM d) WHERE word IN (SELECT word FROM asked) GROUP BY ALL),
weights AS (
  SELECT word, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS weight
  FROM (SELECT word, count(*) AS df FROM tfs GROUP BY word), totals),
scores AS (
  SELECT query, item_id, row, doc_id,
         sum(times * weight * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // length))))::BIGINT AS score
  FROM asked JOIN tfs USING (word) JOIN weights USING (word), totals GROUP BY ALL)
SELECT item_id, rank::INT AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scores WHERE score > 0)
WHERE rank <= 20
"""


@query("op11_geometric_search", _ranked_sql())
def op11_geometric_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty best documents of every benchmark item."""
    return geometric_search.search(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


@query("op12_bitslice_simhash")
def op12_bitslice_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's SimHash fingerprint and the component that chains of near fingerprints put it in."""
    return bitslice_simhash.near_components(load(spark, sf_dir, "documents"))


def _manifest_sql() -> str:
    field = lambda c: f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')"
    leaf = lambda text: "sha256(" + " || ".join(
        field(text if c == "text" else c) for c in merkle_manifest.FIELDS) + ")"
    lower = f"translate(text, '{merkle_manifest.UPPER}', '{merkle_manifest.LOWER}')"

    def tree(name: str, nodes: str) -> str:
        """All levels of the trees of ``nodes`` (g, i, node), their roots and every node's siblings."""
        return rf"""
{name}_up AS (
  SELECT g, i, 0 AS lvl, node, count(*) OVER (PARTITION BY g) AS n FROM {nodes}
  UNION ALL
  SELECT g, i // 8, lvl + 1, sha256(string_agg(node, '' ORDER BY i)), (n + 7) // 8
  FROM {name}_up WHERE n > 1 GROUP BY g, i // 8, lvl, n),
{name}_root AS (SELECT g, node AS root FROM {name}_up WHERE n = 1),
{name}_path AS (
  SELECT a.g, a.i, a.lvl, coalesce(string_agg(b.node, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS l,
         coalesce(string_agg(b.node, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS r
  FROM {name}_up a JOIN {name}_up b ON a.g = b.g AND a.lvl = b.lvl AND a.i // 8 = b.i // 8 WHERE a.n > 1 GROUP BY a.g, a.i, a.lvl)"""

    return rf"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, lang, {leaf("text")} AS leaf, {leaf(lower)} AS altered,
         xor(list_reduce(
           list_transform(range(8 * strlen(doc_id::VARCHAR)), lambda k:
             CASE WHEN k % 8 = 0 THEN ascii(substr(doc_id::VARCHAR, (k // 8 + 1)::INT, 1))::BIGINT ELSE 0 END),
           lambda crc, b: xor(xor(crc, b) // 2, CASE WHEN xor(crc, b) % 2 = 1 THEN 3988292384 ELSE 0 END),
           4294967295::BIGINT), 4294967295) % 3 = 0 AS chosen
  FROM documents),
line AS (
  SELECT *, coalesce(':' || lang, '-') AS g, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i
  FROM leaves),
nodes AS (SELECT g, i, leaf AS node FROM line),{tree("doc", "nodes")},
tops AS (SELECT 'all' AS g, g AS name, row_number() OVER (ORDER BY g) - 1 AS i, root AS node FROM doc_root),{tree("top", "tops")},
way AS (
  SELECT line.g, line.i, lvl AS step, l, r FROM line JOIN doc_path p ON line.g = p.g AND line.i // (8 ** lvl)::BIGINT = p.i
  UNION ALL
  SELECT line.g, line.i, 1000 + lvl, l, r FROM line JOIN tops ON line.g = tops.name JOIN top_path p ON tops.i // (8 ** lvl)::BIGINT = p.i),
ways AS (
  SELECT g, i, sha256(string_agg(l || r, '' ORDER BY step)) AS proof_sha256, list(l ORDER BY step) AS ls, list(r ORDER BY step) AS rs
  FROM way GROUP BY g, i),
folds AS (
  SELECT line.g, line.i, 0 AS step, CASE WHEN chosen THEN altered ELSE leaf END AS node, coalesce(ls, []) AS ls, coalesce(rs, []) AS rs
  FROM line LEFT JOIN ways USING (g, i)
  UNION ALL
  SELECT g, i, step + 1, sha256(ls[step + 1] || node || rs[step + 1]), ls, rs FROM folds WHERE step < len(ls))
SELECT line.doc_id, line.leaf, doc_root.root AS subroot, top_root.root AS root, coalesce(proof_sha256, sha256('')) AS proof_sha256,
       folds.node AS folded_root, folds.node = top_root.root AS verified
FROM line JOIN doc_root ON line.g = doc_root.g JOIN folds ON line.g = folds.g AND line.i = folds.i AND folds.step = len(folds.ls)
     LEFT JOIN ways ON line.g = ways.g AND line.i = ways.i, top_root
"""


@query("op13_merkle_manifest", _manifest_sql())
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf, proof and folded root in the manifest of all documents."""
    return merkle_manifest.manifest(load(spark, sf_dir, "documents"))
