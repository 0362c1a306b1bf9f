"""DuckDB oracle SQL for BM25 best-fields matching over arbitrary field rows.

``bm25_sql(fields_sql, queries_sql, weights)`` returns CTEs ending in
``fs(query_id, doc_id, field, s, m)`` (per-field score and matched terms),
``qn(query_id, n_terms)`` and ``w(field, weight)``. ``fields_sql`` must select
``(doc_id, field, txt)``; ``queries_sql`` must select ``(query_id, query)``.
"""

from contentspark.plans.sqlviews import tokens


# DuckDB's levenshtein counts bytes: terms are re-encoded with one byte per distinct character.
FUZZY = """
voc AS (SELECT DISTINCT term FROM post),
chars AS (SELECT ch, row_number() OVER (ORDER BY ch) AS r FROM (
  SELECT DISTINCT unnest(string_split(term, '')) AS ch FROM (SELECT term FROM voc UNION SELECT term FROM qt))),
cm AS (SELECT map_from_entries(list(struct_pack(k := ch, v := chr((32 + r)::INTEGER)))) AS m FROM chars),
qe AS (SELECT query_id, term, array_to_string(list_transform(string_split(term, ''),
         lambda c: map_extract_value(cm.m, c)), '') AS e FROM qt, cm),
ve AS (SELECT term, array_to_string(list_transform(string_split(term, ''),
         lambda c: map_extract_value(cm.m, c)), '') AS e FROM voc, cm),
qx AS (SELECT qe.query_id, qe.term, v.term AS vterm FROM qe JOIN ve v
       ON abs(length(qe.e) - length(v.e)) <= {k} AND levenshtein(qe.e, v.e) <= {k}),
"""


def bm25_sql(fields_sql: str, queries_sql: str, weights: dict[str, float], fuzzy: int = 0) -> str:
    """CTEs up to ``fs``, ``xs`` and ``w``; ``fuzzy``: terms match within so many edits, best expansion counts."""
    expand = FUZZY.format(k=fuzzy) if fuzzy else "qx AS (SELECT query_id, term, term AS vterm FROM qt),"
    wv = ", ".join(f"('{f}', {float(v)})" for f, v in weights.items())
    return f"""
WITH qsrc AS ({queries_sql}),
q AS (SELECT query_id, {tokens('query')} AS toks FROM qsrc),
qt AS (SELECT DISTINCT query_id, unnest(toks) AS term FROM q),
qn AS (SELECT query_id, count(*) AS n_terms FROM qt GROUP BY query_id),
fr AS ({fields_sql}),
ft AS (SELECT doc_id, field, {tokens('txt')} AS toks FROM fr WHERE txt IS NOT NULL),
lens AS (SELECT doc_id, field, len(toks) AS len FROM ft),
st AS (SELECT field, count(*) AS n_docs, avg(len) AS avg_len FROM lens WHERE len > 0 GROUP BY field),
post AS (SELECT doc_id, field, unnest(toks) AS term FROM ft),
{expand}
tf AS (SELECT doc_id, field, term, count(*) AS tf FROM post WHERE term IN (SELECT vterm FROM qx) GROUP BY ALL),
df AS (SELECT field, term, count(*) AS df FROM tf GROUP BY ALL),
bdf AS (SELECT term, max(df) AS bdf FROM df GROUP BY term),
ts AS (
  SELECT qx.query_id, tf.doc_id, tf.field, qx.term,
         max(ln(1.0 + (st.n_docs - df.df + 0.5) / (df.df + 0.5)) * tf.tf * 2.2
           / (tf.tf + 1.2 * (0.25 + 0.75 * l.len / st.avg_len))) AS s,
         max(ln(1.0 + (st.n_docs - b.bdf + 0.5) / (b.bdf + 0.5)) * tf.tf * 2.2
           / (tf.tf + 1.2 * (0.25 + 0.75 * l.len / st.avg_len))) AS blended
  FROM qx JOIN tf ON tf.term = qx.vterm JOIN bdf b ON b.term = tf.term JOIN df ON df.field = tf.field AND df.term = tf.term
  JOIN lens l ON l.doc_id = tf.doc_id AND l.field = tf.field JOIN st ON st.field = tf.field
  GROUP BY ALL
),
xs AS (SELECT query_id, doc_id, sum(s) AS s, count(*) AS m FROM (
         SELECT query_id, doc_id, term, max(blended) + 0.5 * (sum(blended) - max(blended)) AS s FROM ts GROUP BY ALL)
       GROUP BY ALL),
fs AS (SELECT query_id, doc_id, field, sum(s) AS s, count(*) AS m FROM ts GROUP BY ALL),
w AS (SELECT * FROM (VALUES {wv}) t(field, weight))
"""


def best_fields(operator: str = "or") -> str:
    cond = "JOIN qn ON qn.query_id = fs.query_id WHERE fs.m = qn.n_terms" if operator == "and" else ""
    return f"""SELECT fs.query_id, fs.doc_id, max(fs.s * w.weight) AS s
FROM fs JOIN w ON w.field = fs.field {cond} GROUP BY ALL"""
