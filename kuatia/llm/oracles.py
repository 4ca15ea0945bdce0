"""SQL of the training-data queries that SQL can express on whole tables.

The characters' rules are the same fixed expressions as the operator's; lines,
nodes, shingles and pairs are found without graphs, signatures or hashes.
"""

from __future__ import annotations

from kuatia.llm.charforms import _latin_words, _spelled, mixed_sql


def _clean(table: str, column: str) -> str:
    """A query over ``table`` with ``z``, its column in the consistent form."""
    visible = f"SELECT *, {_spelled(column)[0]} AS x FROM {table}"
    spelled = f"SELECT *, {_spelled('x')[1]} AS y FROM ({visible})"
    return f"SELECT * EXCLUDE (x, y), {_latin_words('y')} AS z FROM ({spelled})"


_ONE = "one AS (SELECT article_id, any_value(source) AS source, any_value(body) AS body FROM event_context_articles GROUP BY 1)"
_KEY = r"regexp_replace(regexp_replace(lower(line), '\p{Nd}[\p{Nd}.,]*', '0', 'g'), '[\t\r\f\v\x{85}\p{Z}]+', '', 'g')"
_LINES = f"""form AS ({_clean('one', 'body')}), line AS (SELECT article_id, source, unnest(string_split(z, chr(10))) AS line, generate_subscripts(string_split(z, chr(10)), 1) AS line_no FROM form),
keyed AS (SELECT *, {_KEY} AS k FROM line), total AS (SELECT source, count(*) AS n FROM one GROUP BY 1),
often AS (SELECT source, k FROM keyed JOIN total USING (source) WHERE k <> '' GROUP BY source, k, n HAVING count(DISTINCT article_id) >= 5 AND count(DISTINCT article_id) >= 0.05 * n)"""

_FIELDS = " UNION ".join(
    f"SELECT DISTINCT article_id, '{f}' AS field FROM ({_clean('event_context_articles', f)}) WHERE z IS DISTINCT FROM {f} OR coalesce({mixed_sql(f)}, false)" for f in ("title", "body")
)

SQL = {
    "p1_found": f"WITH {_ONE}, {_LINES} SELECT article_id, line_no::INT AS line_no FROM keyed SEMI JOIN often USING (source, k)",
    "p4_found": _FIELDS,
    "p6_found": f"""WITH {_ONE}, {_LINES}, kept AS (SELECT article_id, string_agg(line, chr(10) ORDER BY line_no) AS body FROM keyed ANTI JOIN often USING (source, k) GROUP BY 1),
words AS (SELECT article_id, regexp_extract_all(lower(body), '[\\p{{L}}\\p{{Nd}}]+') AS w FROM kept), sets AS (SELECT DISTINCT article_id, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS s FROM words WHERE len(w) >= 3),
size AS (SELECT article_id, count(*) AS n FROM sets GROUP BY 1), common AS (SELECT x.article_id AS a, y.article_id AS b, count(*) AS c FROM sets x JOIN sets y ON x.s = y.s AND x.article_id < y.article_id GROUP BY 1, 2)
SELECT a AS article_id_a, b AS article_id_b FROM common JOIN size p ON p.article_id = a JOIN size q ON q.article_id = b WHERE c >= 0.5 * (p.n + q.n - c)""",
    "p7_round_trip": "SELECT doc_id, true AS same FROM documents",
}
