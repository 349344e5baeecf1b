"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

# The base patterns as the contract states them.
_PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"[A-Z]{2}[0-9]{2}(?:(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?|[A-Z0-9]{11,30})",
    "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
}
_DIGITS = "regexp_replace(x.v, '[^0-9]', '', 'g')"
_LONE = "NOT regexp_matches(substr(t, x.s, 1), '[A-Za-z0-9-]') AND NOT regexp_matches(substr(t, x.e + 1, 1), '[A-Za-z0-9-]')"
_LUHN = f"""list_sum(list_transform(generate_series(1, length({_DIGITS})), lambda i:
    CASE WHEN (length({_DIGITS}) - i) % 2 = 0 THEN substr({_DIGITS}, i, 1)::INT
         WHEN substr({_DIGITS}, i, 1)::INT > 4 THEN 2 * substr({_DIGITS}, i, 1)::INT - 9 ELSE 2 * substr({_DIGITS}, i, 1)::INT END)) % 10 = 0"""
_CODE = "replace(x.v, ' ', '')"
_MOD97 = f"""list_reduce(list_concat([0], list_transform(string_split(substr({_CODE}, 5) || substr({_CODE}, 1, 4), ''), lambda c: ascii(c)::BIGINT)),
    lambda r, c: CASE WHEN c < 65 THEN (10 * r + c - 48) % 97 ELSE (100 * r + c - 55) % 97 END) = 1"""
_PII_KEEP = {
    "email": "true",
    "ip": "len(list_filter(string_split(x.v, '.'), lambda q: length(ltrim(q, '0')) > 3 OR coalesce(try_cast(ltrim(q, '0') AS INT), 0) > 255)) = 0",
    "card": f"length({_DIGITS}) BETWEEN 13 AND 19 AND {_LUHN}",
    "phone": f"length({_DIGITS}) BETWEEN 9 AND 15",
    "iban": f"length({_CODE}) BETWEEN 15 AND 34 AND {_LONE} AND {_MOD97}",
    "ssn": f"""{_LONE} AND substr(x.v, 1, 3) NOT IN ('000', '666') AND substr(x.v, 1, 1) <> '9' AND substr(x.v, 5, 2) <> '00' AND substr(x.v, 8) <> '0000'
        AND regexp_matches(lower(substr(t, greatest(x.s - 50, 0) + 1, x.e - x.s + least(x.s, 50) + 50)), 'ssn|social security|tax id')""",
}


def _pii() -> str:
    cut, spans, texts = [], [], []
    for kind, pattern in _PII.items():
        cut.append(f"regexp_extract_all(t, '{pattern}') AS m_{kind}, string_split_regex(t, '{pattern}') AS p_{kind}")
        spans.append(
            f"""list_filter(list_transform(generate_series(1, len(m_{kind})), lambda k: {{'v': m_{kind}[k],
            's': (coalesce(list_sum(list_transform(p_{kind}[1:k], lambda q: length(q))), 0) + coalesce(list_sum(list_transform(m_{kind}[1:k-1], lambda q: length(q))), 0))::BIGINT,
            'e': (coalesce(list_sum(list_transform(p_{kind}[1:k], lambda q: length(q))), 0) + coalesce(list_sum(list_transform(m_{kind}[1:k], lambda q: length(q))), 0))::BIGINT}}),
            lambda x: {_PII_KEEP[kind]}) AS x_{kind}"""
        )
        texts.append(f"list_transform(x_{kind}, lambda x: '{kind}:' || x.s || ':' || x.e)")
    base, extra = texts[:4], texts[4:]
    both = lambda parts: "array_to_string(flatten([" + ", ".join(parts) + "]), ',')"
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
c AS (SELECT doc_id, t, {', '.join(cut)} FROM d),
s AS (SELECT doc_id, {', '.join(spans)} FROM c)
SELECT doc_id, {', '.join(f'len(x_{k})::BIGINT AS n_{k}' for k in list(_PII)[:4])},
    sha256({both(base)}) AS base_sha256, {both(base + extra)} AS spans FROM s"""


_EXACT = """SELECT doc_id, max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id, count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
    row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC) = 1 AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents"""

_WARC = """WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
d AS (SELECT page_id, strlen(t) AS payload_bytes, sha1(t) AS h, max(page_id) OVER (PARTITION BY t) AS keeper, row_number() OVER (PARTITION BY t ORDER BY page_id DESC) AS rn FROM p)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
    array_to_string(list_transform(generate_series(0, 31), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        1 + ((('0x' || substr(h, (k // 4)::INT * 5 + 1, 5))::INT >> (15 - 5 * (k % 4))::INT) & 31), 1)), '') AS payload_digest,
    CASE WHEN rn = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN rn > 1 THEN keeper END AS refers_to
FROM d"""

_TOP = """WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(generate_series(1, least(len(q.v), len(c.v))), lambda i: q.v[i] * c.v[i]))::BIGINT AS score
    FROM e q JOIN e c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""

_NEAR = r"""WITH RECURSIVE d AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) < 2 THEN w ELSE list_distinct(list_transform(generate_series(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM d),
e AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS c FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
l AS MATERIALIZED (SELECT a, b FROM p WHERE 100 * c >= 80 * (na + nb - c)),
both_ways AS MATERIALIZED (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS node, doc_id AS reached FROM s UNION SELECT r.node, both_ways.b FROM r JOIN both_ways ON r.reached = both_ways.a)
SELECT s.doc_id, len(any_value(s))::BIGINT AS n_shingles, min(reached) AS component_id, s.doc_id = min(reached) AS kept FROM s JOIN r ON s.doc_id = r.node GROUP BY s.doc_id"""

ORACLE_SQL = {"op1_near_duplicates": _NEAR, "op7_top_k": _TOP, "op8_warc": _WARC, "op5_exact_duplicates": _EXACT, "op6_personal_data": _pii()}
