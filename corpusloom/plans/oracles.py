"""DuckDB SQL for the queries of the catalog that SQL can express."""

from __future__ import annotations

from corpusloom.functions.answers import CHOICES
from corpusloom.functions.metrics import TEMPLATE_PHRASES
from corpusloom.functions.templates import TEMPLATES, TOPICS
from corpusloom.functions.text import TOPIC_STOPWORDS


def _q(text: str) -> str:
    """A string literal; line ends and carriage returns by code."""
    return "('" + text.replace("'", "''").replace("\n", "' || chr(10) || '").replace("\r", "' || chr(13) || '") + "')"


def _strip(x: str) -> str:
    return rf"regexp_replace(regexp_replace({x}, '^\s+', ''), '\s+$', '')"


_DUP_CLASS = r"[。．，,、;；:：!?！？（）()\[\]【】<>《》\-—_" + '"' + "''" + "]+"


def _norm(x: str) -> str:
    return rf"regexp_replace(regexp_replace(lower({_strip(x)}), '\s+', ' ', 'g'), '{_DUP_CLASS}', '', 'g')"


def _grams(x: str, n: int) -> str:
    return f"CASE WHEN {x} = '' THEN []::VARCHAR[] WHEN length({x}) <= {n} THEN [{x}] ELSE list_transform(generate_series(1, length({x}) - {n - 1}), lambda i: substr({x}, i, {n})) END"


_TOKENS = r"regexp_extract_all(lower({}), '[\x{{4e00}}-\x{{9fff}}]|[a-zA-Z0-9_]+')"
_SENTENCES = r"list_filter(list_transform(string_split_regex({}, '[。！？；;\n]+'), lambda s: regexp_replace(regexp_replace(s, '^\s+', ''), '\s+$', '')), lambda s: s <> '')"
_TALK = "talk AS (SELECT conv_id, list({'f': CASE role WHEN 'user' THEN 'human' WHEN 'assistant' THEN 'gpt' ELSE role END, 'v': text} ORDER BY turn) AS c FROM conversations GROUP BY conv_id)"


def _first(role: str) -> str:
    return f"coalesce(list_filter(c, lambda m: m.f = '{role}')[1].v, '')"


def _repeated(items: str) -> str:
    return f"CASE WHEN len({items}) = 0 THEN 0.0::DOUBLE ELSE (len({items}) - len(list_distinct({items})))::DOUBLE / len({items}) END"


def _rep(n: int) -> str:
    grams = "list_transform(generate_series(1, len(k) - {}), lambda i: {})".format(n - 1, " || ' ' || ".join(f"k[i + {j}]" for j in range(n)))
    return f"CASE WHEN len(k) < {n} THEN 0.0::DOUBLE ELSE (len(k) - {n - 1} - len(list_distinct({grams})))::DOUBLE / (len(k) - {n - 1}) END"


_DENSITY = "CASE WHEN text = '' THEN 0.0::DOUBLE ELSE (" + " + ".join(f"(length(text) - length(replace(text, '{p}', ''))) // {len(p)}" for p in TEMPLATE_PHRASES) + ")::DOUBLE / greatest(length(text), 1) * 100.0::DOUBLE END"
_BLOCK = "(length({0}) >= 90 AND len(list_filter(generate_series(0, least(length({0}) - 30, 500) - 1, 10), lambda o: (length({0}) - length(replace({0}, substr({0}, o + 1, 30), ''))) // 30 > 2)) > 0)"
_METRICS = f"""WITH d AS (SELECT *, {_TOKENS.format('text')} AS k, {_SENTENCES.format('text')} AS s FROM documents),
m AS (SELECT doc_id, {_rep(2)} AS rep2, {_rep(3)} AS rep3, CASE WHEN len(s) <= 1 THEN 0.0::DOUBLE ELSE {_repeated('s')} END AS sent_rep, {_DENSITY} AS empty_score,
    CASE WHEN contains(lower(text), source) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS kw_cov, len(k)::BIGINT AS length,
    CASE WHEN len(k) = 0 THEN 0.0::DOUBLE ELSE len(list_distinct(k))::DOUBLE / len(k) END AS uniq_ratio, n_chars, text FROM d)"""

_DUP = """SELECT sum(n)::BIGINT AS total, count(*) AS "unique", (sum(n) - count(*))::BIGINT AS dup_instances, (sum(n) - count(*))::DOUBLE / sum(n) AS dup_rate,
    count(*) FILTER (WHERE n >= 2) AS clusters, max(n) AS max_dup, '{by}' AS "by" FROM (SELECT count(*) AS n FROM h GROUP BY {col})"""

_TRAIN = """train AS (SELECT doc_id AS id, text FROM documents UNION ALL SELECT item_id + 10000000, '  ' || translate(text, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ') || '!?' FROM benchmark
    UNION ALL SELECT item_id + 20000000, text || ' etc' FROM benchmark)"""
_EXACT = f"exact AS (SELECT id FROM train WHERE sha1({_norm('text')}) IN (SELECT sha1({_norm('text')}) FROM benchmark))"
_JACCARD = f"""tg AS (SELECT DISTINCT id, unnest({_grams('n', 5)}) AS g FROM (SELECT id, {_norm('text')} AS n FROM train)),
bg AS (SELECT DISTINCT item_id, unnest({_grams('n', 5)}) AS g FROM (SELECT item_id, {_norm('text')} AS n FROM benchmark)),
ts AS (SELECT id, count(*) AS a FROM tg GROUP BY id), bs AS (SELECT item_id, count(*) AS b FROM bg GROUP BY item_id),
near AS (SELECT DISTINCT id FROM (SELECT id, item_id, count(*) AS c FROM tg JOIN bg USING (g) GROUP BY id, item_id) JOIN ts USING (id) JOIN bs USING (item_id) WHERE c::DOUBLE / (a + b - c) >= 0.7)"""

_SHOWN = "['1,200', '2.5万亿', '增长5%，达到3万', '-5', '.7', '72万元', 'no digits', '**1,200**#'][doc_id % 8 + 1]"
_ANSWERS = f"""a AS (SELECT doc_id, {_SHOWN} AS shown, CASE doc_id % 5 WHEN 0 THEN '<think>' || text || '</think> ' || {_SHOWN} WHEN 1 THEN '<think>' || text
    WHEN 2 THEN '<think>short</think>' WHEN 3 THEN '<answer>' || {_SHOWN} || '</answer>' ELSE text END AS said FROM documents)"""
_NUMBER = r"[-+]?[0-9]*\.?[0-9]+"


def _value(x: str) -> str:
    tail = f"regexp_extract({x}, '(?s){_NUMBER}(.*)', 1)"
    return f"try_cast(nullif(regexp_extract({x}, '{_NUMBER}'), '') AS DOUBLE) * CASE WHEN contains({tail}, '万亿') THEN 1e12 WHEN contains({tail}, '亿') THEN 1e8 WHEN contains({tail}, '万') THEN 1e4 ELSE 1.0 END"


_COMMAS = r"regexp_replace({}, '[,，\s]', '', 'g')"
_AFTER = f"CASE WHEN contains({{0}}, '</think>') THEN {_strip('string_split({0}, ' + repr('</think>') + ')[-1]')} ELSE {_strip('{0}')} END"
_FORMAT = f"CASE WHEN said = '' THEN 0.0::DOUBLE WHEN contains(said, '<think>') AND contains(said, '</think>') THEN CASE WHEN ({_AFTER.format('said')}) <> '' THEN 1.0 ELSE 0.3 END WHEN contains(said, '<think>') THEN 0.0 ELSE 0.2 END"
_LENGTH = f"""CASE WHEN regexp_matches(said, '(?s)<think>(.*?)</think>') THEN CASE WHEN length(regexp_extract(said, '(?s)<think>(.*?)</think>', 1)) < 20 THEN 0.2 WHEN length(regexp_extract(said, '(?s)<think>(.*?)</think>', 1)) > 2000 THEN 0.3 ELSE 1.0 END
    WHEN length({_strip('said')}) < 20 THEN 0.0 WHEN length({_strip('said')}) > 50 THEN 0.3 ELSE 0.1 END"""
_BARE = "lower(regexp_replace({}, '" + r"[，。、；：！？\s,.:;!?\-()（）" + '"' + "''" + "]', '', 'g'))"
_ACCURACY = f"""CASE WHEN shown = '' OR part = '' THEN 0.0::DOUBLE WHEN v IS NOT NULL THEN
    CASE WHEN len(list_filter(regexp_extract_all(regexp_replace(part, '[,，]', '', 'g'), '{_NUMBER}'), lambda n: abs(n::DOUBLE - v) < 0.5 OR (v <> 0 AND abs(n::DOUBLE - v) / abs(v) < 0.05))) > 0 THEN 1.0 ELSE 0.0 END
    WHEN contains({_BARE.format('part')}, {_BARE.format('shown')}) THEN 1.0 ELSE 0.0 END"""
_REWARDS = f"""WITH {_ANSWERS}, b AS (SELECT *, {_AFTER.format('said')} AS part, {_value(_COMMAS.format('shown'))} AS v FROM a),
r AS (SELECT doc_id, doc_id % 8 AS prompt, ({_FORMAT})::DOUBLE AS format_reward, ({_ACCURACY})::DOUBLE AS accuracy_reward, ({_LENGTH})::DOUBLE AS length_reward FROM b)"""


def _templates() -> str:
    rows = []
    for name, t in TEMPLATES.items():
        before, _, after = t.prompt.partition("{query}")
        rows.append(f"({_q(name)}, {_q(before)}, {_q(after)}, {_q(t.sep)}, {_q(t.system)})")
    return f"""WITH t(template, before, after, sep, sys) AS (VALUES {', '.join(rows)}), d AS (SELECT DISTINCT lang, source FROM documents)
SELECT lang, source, template, CASE WHEN sys <> '' THEN sys || sep ELSE '' END || before || lang || '?' || after || source || sep || before || source || after AS prompt FROM d, t"""


def _code(seed: object) -> str:
    return f"('0x' || substr(md5('{seed}|' || doc_id), 1, 8))::BIGINT"


_CLUSTERED = "e AS (SELECT vec_id, embedding, CASE WHEN vec_id % 11 = 0 THEN -1 ELSE label END AS cluster FROM embeddings)"
_TALK_FIELDS = f"WITH {_TALK}, f AS (SELECT conv_id, c, {_first('human')} AS asked, {_first('gpt')} AS told FROM talk)"
_GLOBAL = """CASE WHEN len(c) < 2 THEN 'too_few_turns' WHEN length({a}) < 5 THEN 'human_too_short' WHEN length({t}) < 5 THEN 'gpt_too_short' WHEN {b} THEN 'gpt_repetition'
    WHEN contains(told, '<think>') OR contains(told, '</think>') THEN 'thinking_tags' WHEN {w} THEN 'not_chinese'
    WHEN length(told) > 50 AND NOT regexp_matches(right(told, 1), '[。！？）」】"''\\n\\pL\\pN]') THEN 'truncated' END"""


def _reasons(wanted: str) -> str:
    return _GLOBAL.format(a=_strip("asked"), t=_strip("told"), b=_BLOCK.format("told"), w=f"NOT ({wanted})")


_MESSY = "' ' || chr(13) || chr(10) || replace(text, '. ', '. ' || chr(9) || chr(13) || chr(10) || chr(13) || chr(10) || chr(10)) || chr(10) || ' ' || chr(10)"
_NEWLINES = r"regexp_replace(regexp_replace(regexp_replace(" + _MESSY + r", '\r\n?', chr(10), 'g'), '[ \t]+\n', chr(10), 'g'), '\n{3,}', chr(10) || chr(10), 'g')"

_SLIDING = r"""WITH n AS (SELECT conv_id, turn, role, regexp_replace(regexp_replace(text, '^\s+', ''), '\s+$', '') AS text FROM conversations WHERE role IN ('user', 'assistant')),
w AS (SELECT *, array_to_string(list(CASE role WHEN 'user' THEN '用户：' ELSE '助手：' END || text) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING), chr(10)) AS h,
    lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS nr, lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS output FROM n WHERE text <> ''),
p AS (SELECT conv_id, text AS instruction, coalesce(h, '') AS h, output, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS turn_index FROM w WHERE role = 'user' AND nr = 'assistant')
SELECT conv_id, instruction, CASE WHEN length(h) > 400 THEN regexp_replace(right(h, 400), '^\s+', '') ELSE h END AS "input", output, turn_index FROM p WHERE length(output) >= 30"""

_PREFIXES = """p AS (SELECT conv_id, turn, role, text, CASE WHEN role = 'user' AND lead(role) OVER w = 'assistant' THEN {'q': text, 'a': lead(text) OVER w} END AS pair
    FROM conversations WHERE role IN ('user', 'assistant') WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
h AS (SELECT conv_id, turn, role, text, list(pair) FILTER (WHERE pair IS NOT NULL) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS history FROM p)"""

_REPAIR = f"""WITH {_TALK}, b1 AS (SELECT conv_id, c, CASE WHEN c[1].f = 'system' THEN c[2:] ELSE c END AS b FROM talk),
b2 AS (SELECT conv_id, c, CASE WHEN b[1].f IS DISTINCT FROM 'human' THEN b[2:] ELSE b END AS b FROM b1),
b3 AS (SELECT conv_id, c, b, list_position(list_transform(b, lambda m: m.f IN ('human', 'gpt')), false) AS stop FROM b2),
k AS (SELECT conv_id, c, b, list_filter(CASE WHEN stop > 0 THEN b[1:stop - 1] ELSE b END, lambda m, j: m.f = CASE WHEN j % 2 = 1 THEN 'human' ELSE 'gpt' END) AS kept FROM b3)
SELECT conv_id, (len(kept) // 2)::BIGINT AS n_pairs, md5(array_to_string(list_transform(generate_series(1, len(kept) // 2), lambda i: kept[2 * i - 1].v || chr(30) || kept[2 * i].v), chr(31))) AS hash
FROM k WHERE len(c) >= 2 AND len(b) >= 2 AND len(kept) % 2 = 0 AND len(kept) >= 2"""

_OVERLAP = f"""WITH {_PREFIXES},
q AS (SELECT conv_id, turn, regexp_replace(history[-1].a, '\\s+', '', 'g') AS a, regexp_replace(history[-1].q, '\\s+', '', 'g') AS s FROM h WHERE role = 'user' AND len(history) > 0),
ga AS (SELECT conv_id, turn, g, count(*) AS n FROM (SELECT conv_id, turn, unnest({_grams('a', 3)}) AS g FROM q) GROUP BY ALL),
gs AS (SELECT conv_id, turn, g, count(*) AS n FROM (SELECT conv_id, turn, unnest({_grams('s', 3)}) AS g FROM q) GROUP BY ALL)
SELECT conv_id, turn, coalesce(sum(least(ga.n, coalesce(gs.n, 0))), 0)::DOUBLE / sum(ga.n) AS overlap FROM ga LEFT JOIN gs USING (conv_id, turn, g) GROUP BY conv_id, turn"""

_SCORED = """s AS (SELECT d.*, quality * 6.0 AS deita, 1.0 - 2.0 * toxic AS rw FROM documents d LEFT JOIN labels USING (doc_id))"""
_CONTENT = f"length(substr(text, 41)) < 20 OR length({_strip('substr(text, 1, 40)')}) < 5"

_PREFERENCES = """WITH d AS (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 1 ELSE 2 END AS pairs, doc_id % 2 = 0 AS chosen, doc_id % 3 = 0 AS rejected FROM documents)
SELECT doc_id AS row_id, 'ppo' AS shape, (2 * pairs + 1)::BIGINT AS turns FROM d UNION ALL SELECT doc_id, 'sft', (2 * pairs + 2)::BIGINT FROM d WHERE chosen
UNION ALL SELECT doc_id, 'rm', pairs::BIGINT FROM d WHERE chosen AND rejected UNION ALL SELECT doc_id, 'dpo', CASE WHEN pairs = 1 THEN 0 ELSE 2 END::BIGINT FROM d WHERE chosen AND rejected"""

_MEANS = """c AS (SELECT cluster, i, avg(x::DOUBLE) AS m FROM (SELECT cluster, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM e WHERE cluster <> -1) GROUP BY cluster, i),
g AS (SELECT vec_id, cluster, sqrt(sum((x::DOUBLE - m) * (x::DOUBLE - m))) AS dist FROM (SELECT vec_id, cluster, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM e WHERE cluster <> -1) JOIN c USING (cluster, i) GROUP BY vec_id, cluster)"""

_KEYWORDS = f"""WITH w AS (SELECT lang, lower(unnest(regexp_extract_all(text, '[A-Za-z]+'))) AS term FROM documents),
t AS (SELECT lang, term, count(*) AS tf FROM w GROUP BY ALL), f AS (SELECT term, count(*) AS df FROM t GROUP BY term),
s AS (SELECT lang, term, row_number() OVER (PARTITION BY lang ORDER BY tf * (ln((1.0 + (SELECT count(DISTINCT lang) FROM documents)) / (1.0 + df)) + 1.0) DESC, term DESC) AS rn FROM t JOIN f USING (term))
SELECT lang, string_agg(term, ' / ' ORDER BY rn) AS label FROM s WHERE rn <= 5 GROUP BY lang -- no CJK in the table, so {len(TOPIC_STOPWORDS)} stopwords do not matter"""


ORACLE_SQL = {
    "exact_dup_stats": f"WITH h AS (SELECT sha1({_norm('text')}) AS a, sha1({_norm('text || chr(10) || lang')}) AS b FROM documents) " + _DUP.format(by="question", col="a") + " UNION ALL " + _DUP.format(by="qa", col="b"),
    "exact_dedup_keep_first": r"SELECT doc_id, source, n_chars FROM documents QUALIFY row_number() OVER (PARTITION BY regexp_replace(lower(text), '\s+', '', 'g') ORDER BY doc_id) = 1",
    "keep_first_prompt": f"SELECT doc_id FROM documents QUALIFY row_number() OVER (PARTITION BY {_strip('text')} ORDER BY doc_id) = 1",
    "dup_clusters_topk": f"""WITH h AS (SELECT sha1({_norm('text')}) AS hash, doc_id FROM documents), t AS (SELECT hash, count(*) AS size, min(doc_id) AS first FROM h GROUP BY hash HAVING count(*) >= 2 ORDER BY size DESC, first LIMIT 50)
        SELECT hash, size, first, row_number() OVER (PARTITION BY hash ORDER BY doc_id)::INT AS member, doc_id FROM h JOIN t USING (hash) QUALIFY member <= 5""",
    "decontam_exact": f"WITH {_TRAIN}, {_EXACT} SELECT id FROM exact",
    "near_dup_pairs": f"""WITH d AS MATERIALIZED (SELECT doc_id, {_norm('text')} AS t FROM documents), r AS (SELECT t, min(doc_id) AS a FROM d WHERE t <> '' GROUP BY t),
        s AS MATERIALIZED (SELECT a, g, len(g) AS n FROM (SELECT a, list_distinct({_grams('t', 5)}) AS g FROM r)), e AS MATERIALIZED (SELECT a, n, unnest(g) AS gram FROM s),
        f AS (SELECT gram, count(*) AS df FROM e GROUP BY gram), k AS MATERIALIZED (SELECT a, n, gram FROM e JOIN f USING (gram) QUALIFY row_number() OVER (PARTITION BY a ORDER BY df, gram) <= n - ceil(0.9 * n - 1e-9) + 1),
        c AS (SELECT DISTINCT x.a AS a, y.a AS b FROM k x JOIN k y ON x.gram = y.gram AND x.a < y.a AND least(x.n, y.n) >= 0.9 * greatest(x.n, y.n) - 1e-6),
        p AS (SELECT c.a, c.b, count(*) AS common, any_value(x.n + y.n) AS n FROM c JOIN e x ON x.a = c.a JOIN e y ON y.a = c.b AND y.gram = x.gram GROUP BY c.a, c.b)
        SELECT a, b, common::DOUBLE / (n - common) AS similarity FROM p WHERE common::DOUBLE / (n - common) >= 0.9::DOUBLE UNION ALL SELECT a, doc_id, 1.0::DOUBLE FROM d JOIN r USING (t) WHERE a < doc_id""",
    "decontam_jaccard": f"WITH {_TRAIN}, {_JACCARD} SELECT id FROM near",
    "decontam_report": f"""WITH {_TRAIN}, {_EXACT}, {_JACCARD}, n AS (SELECT (SELECT count(*) FROM train) AS total, (SELECT count(*) FROM exact) AS exact, (SELECT count(*) FROM near WHERE id NOT IN (SELECT id FROM exact)) AS approx)
        SELECT total, exact, approx, exact + approx AS contaminated, total - exact - approx AS clean, (exact + approx)::DOUBLE / total AS rate FROM n""",
    "decontam_containment": f"""WITH tg AS (SELECT DISTINCT doc_id, unnest({_grams('n', 5)}) AS g FROM (SELECT doc_id, {_norm('text')} AS n FROM documents)),
        bg AS (SELECT DISTINCT item_id, unnest({_grams('n', 5)}) AS g FROM (SELECT item_id, {_norm('text')} AS n FROM benchmark)), bs AS (SELECT item_id, count(*) AS b FROM bg GROUP BY item_id)
        SELECT doc_id, max(c::DOUBLE / b) AS containment FROM (SELECT doc_id, item_id, count(*) AS c FROM tg JOIN bg USING (g) GROUP BY doc_id, item_id) JOIN bs USING (item_id) GROUP BY doc_id HAVING max(c::DOUBLE / b) >= 0.7""",
    "components_of_copies": "SELECT doc_id AS node, min(doc_id) OVER (PARTITION BY text) AS component FROM documents QUALIFY count(*) OVER (PARTITION BY text) > 1",
    "score_filter": f"""WITH {_SCORED} SELECT CASE WHEN coalesce(deita, 0) < 5 OR coalesce(rw, 0) < 0 THEN 'score' WHEN lang IS DISTINCT FROM 'en' THEN 'lang' WHEN {_CONTENT} THEN 'content' END AS reason, count(*) AS n FROM s GROUP BY 1""",
    "score_filter_report": f"""WITH {_SCORED}, r AS (SELECT coalesce(deita, 0) < 5 OR coalesce(rw, 0) < 0 OR {_CONTENT} AS bad FROM s)
        SELECT count(*) AS total, count(*) FILTER (WHERE NOT bad) AS kept, count(*) FILTER (WHERE bad) AS dropped, (count(*) FILTER (WHERE NOT bad))::DOUBLE / count(*) AS ratio FROM r""",
    "global_quality_filter": f"{_TALK_FIELDS} SELECT conv_id, {_reasons('len(regexp_extract_all(asked || told, ' + chr(39) + '[a-z]' + chr(39) + ')) > length(asked || told) * 0.5')} AS reason FROM f",
    "reason_histogram": f"{_TALK_FIELDS}, r AS (SELECT {_reasons('len(regexp_extract_all(asked || told, ' + chr(39) + '[一-鿿]' + chr(39) + ')) > length(asked || told) * 0.15')} AS reason FROM f) SELECT reason, count(*) AS n FROM r WHERE reason IS NOT NULL GROUP BY reason",
    "length_filter_quantiles": f"WITH n AS (SELECT list_sort(list(n)) AS v FROM (SELECT len({_TOKENS.format('text')})::BIGINT AS n FROM conversations) WHERE n BETWEEN 10 AND 2048) SELECT "
    + ", ".join(f"v[floor(len(v) * {p}::DOUBLE)::INT + 1] AS p{round(p * 100)}" for p in (0.5, 0.9, 0.95, 0.99)) + " FROM n",
    "answer_metrics": f"{_METRICS} SELECT doc_id, rep2, rep3, sent_rep, empty_score, kw_cov, length, uniq_ratio FROM m",
    "metric_distribution": _METRICS + " " + " UNION ALL ".join(f"SELECT '{c}' AS metric, count({c}) AS count, avg({c}::DOUBLE) AS mean, " + ", ".join(f"quantile_cont({c}::DOUBLE, {p}) AS p{round(p * 100)}" for p in (0.5, 0.75, 0.9, 0.95)) + f", max({c}::DOUBLE) AS max FROM m" for c in ("rep3", "uniq_ratio", "n_chars")),
    "repetition_flags": f"{_METRICS} SELECT doc_id, {_BLOCK.format('text')} AS block_repeated, rep3 >= 0.1 OR sent_rep >= 0.15 AS high_rep, empty_score >= 0.08 AS high_empty FROM m",
    "source_overlap": _OVERLAP,
    "sentences": f"WITH s AS (SELECT doc_id, {_SENTENCES.format('text')} AS s FROM documents) SELECT doc_id, len(s)::BIGINT AS n_sentences, coalesce(s[1], '') AS first_sentence FROM s",
    "newline_normalised": f"SELECT doc_id, md5({_strip(_NEWLINES)}) AS hash FROM documents",
    "sliding_sft": _SLIDING,
    "ppo_prefixes": f"WITH {_PREFIXES} SELECT conv_id, turn, coalesce(len(history), 0)::BIGINT AS n_history, coalesce(history[1].q, '') AS first_q, text AS question FROM h WHERE role = 'user'",
    "sft_dialog_repair": _REPAIR,
    "last_answer": f"""WITH c AS (SELECT conv_id, turn, role, {_strip('text')} AS text FROM conversations WHERE {_strip('text')} <> ''), l AS (SELECT conv_id, max(turn) AS last_turn FROM c WHERE role = 'assistant' GROUP BY conv_id)
        SELECT conv_id, coalesce(string_agg(text, chr(10) ORDER BY turn) FILTER (WHERE role = 'user' AND turn < last_turn), '') AS prompt, max(text) FILTER (WHERE turn = last_turn) AS answer FROM c JOIN l USING (conv_id) GROUP BY conv_id""",
    "render_templates": _templates(),
    "instruction_prompts": f"""SELECT doc_id, md5('### Instruction:' || chr(10) || {_strip('text')} || chr(10) || chr(10) || '### Input:' || chr(10) || lang || chr(10) || chr(10) || '### Response:' || chr(10)) AS plain,
        md5('<|im_start|>system' || chr(10) || lang || '<|im_end|>' || chr(10) || '<|im_start|>user' || chr(10) || source || chr(10) || chr(10) || {_strip('text')} || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10)) AS chat FROM documents""",
    "alpaca_conversations": f"SELECT doc_id, lang || CASE WHEN doc_id % 2 = 0 THEN chr(10) || source ELSE '' END AS human, md5({_strip('text')}) AS gpt_hash FROM documents WHERE doc_id % 3 <> 0 AND {_strip('text')} <> ''",
    "preference_shapes": _PREFERENCES,
    "mixture_sample": "SELECT doc_id, lang FROM documents WHERE lang IN ('en', 'fr', 'de') QUALIFY row_number() OVER (PARTITION BY lang ORDER BY md5('42|' || doc_id), doc_id) <= CASE lang WHEN 'en' THEN 120 ELSE 90 END",
    "exact_split": "SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY md5('42|' || doc_id), doc_id) <= floor(count(*) OVER () * 0.05::DOUBLE) THEN 'valid' ELSE 'train' END AS split FROM documents",
    "head_split": "SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY doc_id) <= round_even(count(*) OVER () * 10 / 100, 0) THEN 'valid' ELSE 'train' END AS split FROM documents",
    "random_and_hard": """WITH r AS (SELECT doc_id, n_chars, row_number() OVER (ORDER BY md5('7|' || doc_id), doc_id) AS rn FROM documents)
        SELECT doc_id, 'random' AS pick FROM r WHERE rn <= 20 UNION ALL (SELECT doc_id, 'hard' FROM r WHERE rn > 20 AND rn <= 220 ORDER BY n_chars DESC, doc_id LIMIT 20)""",
    "topic_pick": f"SELECT doc_id, [{', '.join(map(_q, TOPICS))}][{_code(3)} % {len(TOPICS)} + 1] AS topic FROM documents",
    "number_extract": f"WITH {_ANSWERS} SELECT doc_id, {_value(_COMMAS.format('shown'))} AS value, {_value(r'regexp_replace(shown, ' + chr(39) + r'[*#\s，。]' + chr(39) + ', ' + chr(39) * 2 + ', ' + chr(39) + 'g' + chr(39) + ')')} AS generated FROM a",
    "reward_scores": f"WITH {_ANSWERS} SELECT doc_id, ({_FORMAT})::DOUBLE AS format_reward, ({_LENGTH})::DOUBLE AS length_reward FROM a",
    "reward_totals": f"{_REWARDS} SELECT doc_id, prompt, format_reward, accuracy_reward, length_reward, 0.0::DOUBLE + format_reward * 1.0 + accuracy_reward * 2.0 + length_reward * 0.5 AS reward FROM r",
    "mcq_extract": f"""WITH d AS (SELECT lang, [{', '.join(map(_q, CHOICES))}][doc_id % 4 + 1] AS predicted, CASE WHEN doc_id % 7 <> 0 THEN ['A', 'B', 'C', 'D'][doc_id % 4 + 1] ELSE 'A' END AS answer FROM documents)
        SELECT lang, count(*) FILTER (WHERE predicted = answer) AS correct, count(*) AS total, (count(*) FILTER (WHERE predicted = answer))::DOUBLE / count(*) AS accuracy FROM d GROUP BY ROLLUP (lang)""",
    "pass_at_k": """WITH g AS (SELECT doc_id % 50 AS prompt, bool_or(n_chars % 17 = 0) AS passed, count(*) FILTER (WHERE n_chars % 17 = 0) AS c, bool_or(doc_id // 50 < 3 AND n_chars % 5 = 0) AS f FROM documents GROUP BY 1),
        o AS (SELECT count(*) AS prompts, avg(passed::INT::DOUBLE) AS pass_rate, avg(c::DOUBLE) AS mean_correct, avg(f::INT::DOUBLE) AS format_rate FROM g)
        SELECT *, CASE WHEN pass_rate < 0.1 THEN 'COLD_START_FAILURE' WHEN pass_rate > 0.8 THEN 'TASKS_TOO_EASY' ELSE 'READY_FOR_GRPO' END AS decision FROM o""",
    "pairwise_accuracy": """WITH m AS (SELECT (n_chars % 1000 - doc_id % 997)::DOUBLE AS m FROM documents), l AS (SELECT list_sort(list(m)) AS v FROM m)
        SELECT count(*) AS pairs, avg((m > 0)::INT::DOUBLE) AS accuracy, avg(m) AS mean_margin, max(v[floor(len(v) * 0.5)::INT + 1]) AS p50, max(v[floor(len(v) * 0.9::DOUBLE)::INT + 1]) AS p90 FROM m, l""",
    "calc_accuracy": f"""WITH {_ANSWERS}, b AS (SELECT *, string_split(said, '</think>')[-1] AS part, {_value(_COMMAS.format('shown'))} AS v FROM a),
        c AS (SELECT CASE WHEN v IS NOT NULL THEN len(list_filter(regexp_extract_all(regexp_replace(part, '[,，]', '', 'g'), '{_NUMBER}'), lambda n: abs(n::DOUBLE - v) < 0.5 OR (v <> 0 AND abs(n::DOUBLE - v) / abs(v) < 0.05))) > 0
            ELSE contains(regexp_replace(lower(said), '[，。\\s]', '', 'g'), regexp_replace(lower(shown), '[，。\\s]', '', 'g')) END AS correct FROM b)
        SELECT count(*) FILTER (WHERE correct) AS correct, count(*) AS total, (count(*) FILTER (WHERE correct))::DOUBLE / count(*) AS accuracy FROM c""",
    "reward_advantages": f"""{_REWARDS}, w AS (SELECT doc_id, prompt, format_reward + accuracy_reward * 2.0 + length_reward * 0.5 AS reward FROM r), g AS (SELECT prompt, avg(reward) AS m, stddev_pop(reward) AS s FROM w GROUP BY prompt)
        SELECT doc_id, round(CASE WHEN s = 0 THEN 0.0 ELSE (reward - m) / s END, 6)::DOUBLE AS advantage FROM w JOIN g USING (prompt)""",
    "perplexity": "WITH s AS (SELECT sum(n_chars % 13)::DOUBLE AS n, sum(n_chars % 7 + 1)::BIGINT AS tokens FROM documents) SELECT tokens, n / tokens AS loss, round(exp(n / tokens), 9) AS perplexity FROM s",
    "reward_errors": "WITH d AS (SELECT n_chars % 100 / 100.0::DOUBLE AS p, doc_id % 97 / 97.0::DOUBLE AS t FROM documents) SELECT round(avg((p - t) * (p - t)), 9) AS mse, round(avg(abs(p - t)), 9) AS mae, round(avg(ln(1 + exp(t - p))), 9) AS loss FROM d",
    "cluster_balance": f"""WITH {_CLUSTERED}, n AS (SELECT cluster, count(*) AS n FROM e GROUP BY cluster), o AS (SELECT n, row_number() OVER (ORDER BY n, cluster) AS i, row_number() OVER (ORDER BY n DESC, cluster) AS top FROM n WHERE cluster <> -1),
        s AS (SELECT (SELECT sum(n) FROM n)::BIGINT AS total_samples, count(*) AS n_clusters, coalesce((SELECT sum(n) FROM n WHERE cluster = -1), 0)::BIGINT AS noise_samples, max(n) AS max_cluster_size, min(n) AS min_cluster_size,
            (2 * sum(i * n) - (count(*) + 1) * sum(n))::DOUBLE / (count(*) * sum(n)) AS gini_coefficient, (sum(n) FILTER (WHERE top <= 3))::BIGINT AS t3 FROM o)
        SELECT total_samples, n_clusters, noise_samples, noise_samples * 100.0::DOUBLE / total_samples AS noise_pct, max_cluster_size, min_cluster_size, max_cluster_size * 100.0::DOUBLE / total_samples AS max_cluster_pct,
            max_cluster_size::DOUBLE / min_cluster_size AS max_min_ratio, gini_coefficient, t3 * 100.0::DOUBLE / total_samples AS top3_pct, CASE WHEN gini_coefficient < 0.3 THEN '均衡' WHEN gini_coefficient < 0.5 THEN '中等' ELSE '失衡' END AS balance_verdict FROM s""",
    "cluster_sizes": f"WITH {_CLUSTERED} SELECT cluster, n AS size, n * 100.0::DOUBLE / (SELECT count(*) FROM e) AS percentage FROM (SELECT cluster, count(*) AS n FROM e GROUP BY cluster) WHERE cluster <> -1",
    "cluster_representatives": f"WITH {_CLUSTERED}, {_MEANS} SELECT cluster, row_number() OVER (PARTITION BY cluster ORDER BY dist, vec_id)::INT AS rank, vec_id FROM g QUALIFY rank <= 5",
    "cluster_keywords": _KEYWORDS,
    "language_routes": """WITH m AS (SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN repeat('中文内容', (length(text) // 8)::INT + 1) || text WHEN 1 THEN repeat('中文内容', (length(text) // 16)::INT + 1) || text ELSE text END AS m FROM documents), s AS (SELECT doc_id, len(regexp_extract_all(m, '[一-鿿]')) AS c, length(m) AS n FROM m)
        SELECT doc_id, CASE WHEN c > n * 0.3 THEN 'pass' ELSE 'translate' END AS route, c > n * 0.15 AS over FROM s""",
    "contaminated_shapes": f"""{_TALK_FIELDS}, g AS (SELECT conv_id, c, CASE WHEN len(c) >= 2 THEN asked ELSE '' END AS a2, CASE WHEN len(c) >= 2 THEN told ELSE '' END AS t2, asked, told FROM f)
        SELECT conv_id, md5({_strip("array_to_string(list_filter(list_transform(list_filter(c, lambda m: m.f = 'human'), lambda m: m.v), lambda v: v <> ''), ' ')")}) AS asked_all, md5(a2) AS asked, md5(t2) AS told,
            md5(CASE WHEN asked <> '' AND told <> '' THEN {_strip('asked')} || '|' || {_strip('told')} ELSE '-|-' END) AS qa FROM g""",
    "clean_turn_counts": f"WITH {_TALK} SELECT conv_id, len(list_filter(c, lambda m: m.f IN ('human', 'gpt') AND {_strip('m.v')} <> ''))::BIGINT AS n_turns FROM talk",
}
