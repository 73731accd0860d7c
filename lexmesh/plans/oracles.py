"""DuckDB SQL for the registered queries, over the same tables."""

from __future__ import annotations

from ..functions import vocab as V
from . import standins as S


def _list(values) -> str:
    return "[" + ", ".join("'" + str(v).replace("'", "''") + "'" for v in values) + "]"


def _pick(values, by: str) -> str:
    return f"({_list(values)})[1 + CAST(({by}) % {len(values)} AS INT)]"


def _map(pairs: dict) -> str:
    return f"MAP({_list(pairs)}, {_list(pairs.values())})"


VERTICES = """v AS (
  SELECT 'c' || c_custkey AS id, 'Person' AS label, c_name AS name FROM customer
  UNION ALL SELECT 's' || s_suppkey, 'Organization', s_name FROM supplier
  UNION ALL SELECT 'p' || p_partkey, 'Concept', p_name FROM part
  UNION ALL SELECT 'n' || n_nationkey, 'Organization', n_name FROM nation
  UNION ALL SELECT 'r' || r_regionkey, 'Organization', r_name FROM region
  UNION ALL SELECT 'o' || o_orderkey, 'LegalDocument', 'Order#' || o_orderkey FROM orders)"""

EDGES = f"""l AS (SELECT *, concat_ws('_', l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(round(l_extendedprice * 100) AS BIGINT), date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE))) AS line FROM lineitem),
e0 AS (
  SELECT 'in_c' || c_custkey AS id, 'IN_NATION' AS edge_type, 'c' || c_custkey AS src, 'n' || c_nationkey AS dst, CAST(c_custkey AS BIGINT) AS n FROM customer
  UNION ALL SELECT 'in_s' || s_suppkey, 'IN_NATION', 's' || s_suppkey, 'n' || s_nationkey, s_suppkey FROM supplier
  UNION ALL SELECT 'in_n' || n_nationkey, 'IN_REGION', 'n' || n_nationkey, 'r' || n_regionkey, n_nationkey FROM nation
  UNION ALL SELECT 'by_o' || o_orderkey, 'PLACED_BY', 'o' || o_orderkey, 'c' || o_custkey, o_orderkey FROM orders
  UNION ALL SELECT 'co_' || line, 'CONTAINS', 'o' || l_orderkey, 'p' || l_partkey, l_partkey FROM l
  UNION ALL SELECT 'su_' || line, 'SUPPLIED_BY', 'p' || l_partkey, 's' || l_suppkey, l_suppkey FROM l),
e AS (SELECT id, edge_type, src, dst, {_pick(S.LAWS, "n")} AS source_law, CAST(1 + n % 50 AS INT) AS article_no, CASE WHEN n % 4 <> 0 THEN CAST(n % 4 AS INT) END AS paragraph_no, {_pick(S.MODALITIES, "n")} AS modality, {_pick(S.VOICES, "n")} AS voice FROM e0)"""

ADJ = """adj AS (SELECT src AS a, dst AS b, id AS edge_id, edge_type FROM e UNION ALL SELECT dst, src, id, edge_type FROM e WHERE src <> dst)"""


def _near(k: int, by: str = "id", where: str = "TRUE") -> str:
    return f"""near AS (SELECT vec_id AS id, label, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), (SELECT CAST(embedding AS DOUBLE[]) FROM embeddings WHERE {where} ORDER BY {by} LIMIT 1)), 6) AS cosine
  FROM embeddings WHERE {where} ORDER BY cosine DESC, id LIMIT {k})"""


def _seeds(k: int = 5) -> str:
    return _near(k, "vec_id") + """,
seeds AS (SELECT id, arg_min(score, ord) AS score, min(ord) AS ord FROM (
  SELECT 'p' || (id % (SELECT count(*) FROM part)) AS id, (1 + cosine) / 2 AS score, CAST(row_number() OVER (ORDER BY cosine DESC, id) AS INT) AS ord FROM near) GROUP BY 1)"""


def _paths(depth: int, k: int = 5, where: str = "TRUE", adj: str = ADJ, one_type: bool = False, start: str = "seeds", bound: str = "TRUE") -> str:
    same = "AND x.edge_type = p.types[1]" if one_type else ""
    ctes = f"""paths1 AS (SELECT s.id AS seed, [x.edge_id] AS path, [x.edge_type] AS types, x.b AS last FROM {start} s JOIN adj x ON x.a = s.id WHERE {where})"""
    for h in range(2, depth + 1):
        ctes += f""",
paths{h} AS (SELECT p.seed, list_append(p.path, x.edge_id) AS path, list_append(p.types, x.edge_type) AS types, x.b AS last FROM paths{h - 1} p JOIN adj x ON x.a = p.last WHERE NOT list_contains(p.path, x.edge_id) AND {where} {same} AND {bound})"""
    union = " UNION ALL ".join(f"SELECT *, {h} AS hops FROM paths{h}" for h in range(1, depth + 1))
    return f"{EDGES}, {_seeds(k)}, {adj}, {ctes}, paths AS ({union})"


COUNTED = "SELECT seed, hops, array_to_string(types, '>') AS types, count(*) AS n, count(DISTINCT last) AS n_last FROM paths GROUP BY ALL"
_HUBS = "hubs AS (SELECT a AS id FROM adj WHERE a IN (SELECT id FROM v WHERE label = '{label}') GROUP BY 1 ORDER BY count(*) {order}, a LIMIT 24)"
OUT = "adj AS (SELECT src AS a, dst AS b, id AS edge_id, edge_type FROM e)"
IN = "adj AS (SELECT dst AS a, src AS b, id AS edge_id, edge_type FROM e)"

PLACE = "source_law || ' 제' || article_no || '조' || CASE WHEN coalesce(paragraph_no, 0) <> 0 THEN ' 제' || paragraph_no || '항' ELSE '' END"
PATH_EDGES = f"""pe AS (SELECT p.*, vs.name AS seed_name, vs.label AS seed_label, vl.name AS last_name, vl.label AS last_label, u.place, e.id AS edge_id, e.edge_type, e.src AS edge_src, e.dst AS edge_dst, e.source_law, e.article_no, e.paragraph_no, e.modality, e.voice
  FROM paths p JOIN v vs ON vs.id = p.seed JOIN v vl ON vl.id = p.last, (SELECT unnest(range(0, 3)) AS place) u JOIN e ON e.id = p.path[u.place + 1] WHERE u.place < len(p.path)),
lines AS (SELECT '[' || {PLACE} || '] ' || seed_name || ' -[' || edge_type || ']-> ' || last_name || ' (modality=' || modality || ', voice=' || voice || ')' AS line, seed, types[1] AS t, hops, array_to_string(path, ',') AS path_text, last, place FROM pe),
ranked AS (SELECT *, row_number() OVER (PARTITION BY line ORDER BY seed, t, hops, path_text, last, place) AS rn FROM lines),
ctx AS (SELECT line FROM ranked WHERE rn = 1 ORDER BY seed, t, hops, path_text, last, place, line LIMIT 300)"""

WORDS = """words AS (SELECT doc_id, source, lang, list_filter(string_split(regexp_replace(coalesce(text, ''), '[^A-Za-z]+', ' ', 'g'), ' '), lambda x: x <> '') AS w FROM documents)"""
NAMES = f"""{WORDS}, mention AS (SELECT doc_id, i - 1 AS pos, w[i] AS w, length(w[i]) + 7 * unicode(w[i]) AS n FROM words, unnest(range(1, len(w) + 1)) r(i)),
names AS (SELECT doc_id * {S.MENTIONS} + pos AS id, {_pick(S.FILLERS, "pos")} || {_pick(S.STEMS, "n")} || CASE WHEN n % 3 = 0 THEN lower(w) ELSE '' END || {_pick(S.ENDINGS, "unicode(w) + pos")} AS name FROM mention)"""
GLUED = {p + t: t for p in V.JUNK_PREFIXES for t in V.CANONICAL}
RESOLVED = f"""junk AS (SELECT unnest({_list(V.JUNK_PREFIXES)}) AS prefix), canonical AS (SELECT unnest({_list(V.CANONICAL)}) AS target),
bare AS (SELECT n.id, n.name, coalesce((SELECT max(c.target) FROM junk j, canonical c WHERE j.prefix || c.target = n.name), n.name) AS bare FROM names n),
resolved AS (SELECT id, name, bare, coalesce({_map(V.ALIASES)}[bare], bare) AS resolved FROM bare)"""
IS_LAW = f"(name NOT IN (SELECT unnest({_list(V.NOT_LAWS)})) AND EXISTS (SELECT 1 FROM (SELECT unnest({_list(V.LAW_SUFFIXES)}) AS s) WHERE name LIKE '%' || s AND length(name) > length(s)))"
_RULES = [("Person", V.PERSON_SUFFIXES), ("Organization", V.ORG_SUFFIXES), ("Concept", V.CONCEPT_SUFFIXES)]
RULES = "rules AS (SELECT * FROM (VALUES " + ", ".join(f"({i}, '{label}', '{s}')" for i, (label, s) in enumerate((label, s) for label, group in _RULES for s in group)) + ") t(rank, label, suffix))"
TYPED = f"""{RESOLVED}, {RULES},
typed AS (SELECT id, original AS name, CASE WHEN law THEN 'LegalDocument' ELSE coalesce(r.label, 'Concept') END AS label, CASE WHEN law THEN '법령' ELSE r.suffix END AS subtype, CASE WHEN law OR r.rank IS NOT NULL THEN 'dict' ELSE 'llm_fallback_default' END AS method
  FROM (SELECT n.*, {IS_LAW} AS law, (SELECT min(rank) FROM rules WHERE n.name LIKE '%' || suffix) AS rank FROM (SELECT id, name AS original, resolved AS name FROM resolved) n) m LEFT JOIN rules r ON r.rank = m.rank)"""
QUESTIONS = f"""questions AS (SELECT conv_id, turn, {_pick(S.WORDS, "conv_id")} || ' ' || {_pick(S.WORDS, "conv_id + 3 * turn")} || ' ' || coalesce(text, '') AS question FROM conversations)"""
KEYWORDS = "kw AS (SELECT * FROM (VALUES " + ", ".join(f"('{k}', '{t}')" for k, types in V.KEYWORDS.items() for t in types) + ") t(keyword, edge_type))"
CATEGORIES = "cat AS (SELECT * FROM (VALUES " + ", ".join(f"('{k}', '{t}')" for k, types in V.EDGE_CATEGORIES.items() for t in types) + ") t(category, edge_type))"

_FORMS, _TAGS = [f for f, _ in S.TOKENS], [t for _, t in S.TOKENS]
_NP = ", ".join(f"'{t}'" for t in V.NP_TAGS)
_MODAL = ", ".join(f"'{t}'" for t in V.MODAL_STEMS)
U = "PARTITION BY article, unit_ord"
_AT = "7 * length(w[i]) + unicode(w[i]) + 3 * unicode(right(w[i], 1))"
TOKENS = f"""{WORDS}, tok0 AS MATERIALIZED (SELECT doc_id // 4 AS article, CAST(doc_id % 4 AS INT) AS unit_ord, CAST(i - 1 AS INT) AS pos, {_pick(_FORMS, _AT)} AS form, {_pick(_TAGS, _AT)} AS tag FROM words, unnest(range(1, len(w) + 1)) r(i)),
tok1 AS (SELECT *, coalesce(sum(CASE WHEN tag IN ('EF', 'SF') THEN 1 ELSE 0 END) OVER ({U} ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS sentence, (tag IN ({_NP}) OR (tag = 'NNB' AND form = '등')) AS np,
  lead(tag) OVER w AS next_tag, lead(form) OVER w AS next_form, lag(tag) OVER w AS prev_tag, lag(form) OVER w AS prev_form FROM tok0 WINDOW w AS ({U} ORDER BY pos)),
tok2 AS (SELECT *, sum(CASE WHEN np THEN 0 ELSE 1 END) OVER ({U} ORDER BY pos) AS island FROM tok1),
tok3 AS (SELECT *, string_agg(CASE WHEN np THEN form END, '') OVER (PARTITION BY article, unit_ord, island ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM tok2),
tok AS (SELECT *, CASE WHEN lag(np) OVER w THEN lag(run) OVER w END AS np_text, CASE WHEN tag IN ({_NP}) AND next_tag IN ('XSV', 'XSA') THEN 2 WHEN tag IN ('VV', 'VA') AND form NOT IN ({_MODAL}) THEN 1 END AS verb_len FROM tok3 WINDOW w AS ({U} ORDER BY pos))"""

_SENT = "PARTITION BY article, unit_ord, sentence ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
_REG = lambda cond, what="np_text": f"last_value(CASE WHEN {cond} AND np_text IS NOT NULL THEN {what} END IGNORE NULLS) OVER ({_SENT})"
_ROOT = f"regexp_replace(lemma, '^(.+?)({'|'.join(V.ROOT_SUFFIXES)})$', '\\1')"
CLAUSES = f"""{TOKENS},
by0 AS (SELECT *, CASE WHEN tag = 'VV' AND form = '의하' AND prev_tag = 'JKB' AND prev_form = '에' THEN coalesce(lag(np_text) OVER ({U} ORDER BY pos), '') END AS by_np FROM tok),
reg AS (SELECT *, {_REG("tag = 'JKS'")} AS subj, {_REG("tag = 'JKS'", "pos")} AS subj_at, {_REG("tag = 'JX' AND form IN ('은', '는')")} AS topic, {_REG("tag = 'JKO'")} AS obj0, {_REG("tag = 'JKO'", "pos")} AS obj_at,
  nullif(last_value(by_np IGNORE NULLS) OVER ({_SENT}), '') AS by_agent FROM by0),
verbs AS (SELECT *, form || CASE WHEN verb_len = 2 THEN next_form ELSE '' END || '다' AS lemma, CASE WHEN verb_len = 2 AND next_form IN ('되', '받') THEN '피동' ELSE '능동' END AS voice, CASE WHEN subj_at IS NULL OR obj_at > subj_at THEN obj0 END AS obj,
  (SELECT coalesce(min(t.pos), 1073741824) FROM tok t WHERE t.article = reg.article AND t.unit_ord = reg.unit_ord AND t.pos >= reg.pos + reg.verb_len AND (t.verb_len IS NOT NULL OR t.tag IN ('EF', 'SF'))) AS stop FROM reg WHERE verb_len IS NOT NULL),
moods AS (SELECT b.article, b.unit_ord, b.pos, max(CASE WHEN t.form = '수' AND t.tag = 'NNB' AND t.next_form = '있' AND t.next_tag = 'VA' THEN 3 WHEN t.form = '지' AND t.tag = 'EC' AND t.next_form IN ('아니하', '못하') AND t.next_tag = 'VX' THEN 2
  WHEN t.form = '어야' AND t.tag = 'EC' AND t.next_form = '하' AND t.next_tag = 'VX' THEN 1 ELSE 0 END) AS m FROM verbs b LEFT JOIN tok t ON t.article = b.article AND t.unit_ord = b.unit_ord AND t.pos >= b.pos + b.verb_len AND t.pos + 1 < b.stop GROUP BY ALL),
rec AS (SELECT b.*, ['없음', '의무', '금지', '재량'][1 + coalesce(m.m, 0)] AS modality FROM verbs b JOIN moods m USING (article, unit_ord, pos))"""


def _assign(source: str, name: str) -> str:
    return f"""{name}0 AS (SELECT *, CASE WHEN subj IS NOT NULL THEN subj WHEN topic IS NOT NULL THEN topic WHEN inherited IS NOT NULL AND sentence = 0 THEN inherited END AS active,
  CASE WHEN subj IS NOT NULL THEN 'JKS' WHEN topic IS NOT NULL THEN 'TOPIC' WHEN inherited IS NOT NULL AND sentence = 0 THEN 'INHERITED' ELSE 'NONE' END AS src0 FROM {source}),
{name}1 AS (SELECT *, CASE WHEN voice = '피동' THEN by_agent ELSE active END AS agent0, CASE WHEN voice = '피동' THEN active WHEN subj IS NOT NULL AND obj IS NULL THEN topic ELSE obj END AS patient, CASE WHEN voice = '피동' AND by_agent IS NOT NULL THEN 'JKB(의하여)' ELSE src0 END AS src1 FROM {name}0),
{name}2 AS (SELECT *, (SELECT min(pos) FROM {name}1 q WHERE q.article = p.article AND q.unit_ord = p.unit_ord AND q.sentence = p.sentence AND q.pos > p.pos AND q.src1 = 'JKS') AS later FROM {name}1 p),
{name} AS (SELECT p.*, CASE WHEN p.agent0 IS NULL AND p.src1 = 'NONE' AND p.later IS NOT NULL THEN q.agent0 ELSE p.agent0 END AS agent, CASE WHEN p.agent0 IS NULL AND p.src1 = 'NONE' AND p.later IS NOT NULL THEN 'JKS(순방향유추)' ELSE p.src1 END AS agent_source
  FROM {name}2 p LEFT JOIN {name}1 q ON q.article = p.article AND q.unit_ord = p.unit_ord AND q.pos = p.later)"""


FOUND = f"""{CLAUSES}, bare_rec AS (SELECT *, CAST(NULL AS VARCHAR) AS inherited FROM rec), {_assign("bare_rec", "own")},
hands AS (SELECT article, unit_ord, arg_max({{'agent': agent}}, pos) AS h FROM own WHERE agent_source IN ('JKS', 'TOPIC') GROUP BY ALL),
carry AS (SELECT article, unit_ord, last_value(h IGNORE NULLS) OVER (PARTITION BY article ORDER BY unit_ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS h FROM (SELECT DISTINCT article, unit_ord FROM tok0) LEFT JOIN hands USING (article, unit_ord)),
with_carry AS (SELECT rec.*, carry.h.agent AS inherited FROM rec JOIN carry USING (article, unit_ord)), {_assign("with_carry", "found")}"""

PHRASES = """phr AS (SELECT article, unit_ord, pos, CASE WHEN tag IN ('NNG', 'NNP', 'XR') AND next_tag IN ('XSV', 'XSA') THEN form || next_form || '다' ELSE form || '다' END AS lemma, NOT coalesce(tag IN ('NNG', 'NNP', 'XR') AND next_tag IN ('XSV', 'XSA'), FALSE) AND form IN (""" + _MODAL + """) AS modal
  FROM tok1 WHERE coalesce(tag IN ('NNG', 'NNP', 'XR') AND next_tag IN ('XSV', 'XSA'), FALSE) OR tag IN ('VV', 'VA'))"""
RUNS = """runs AS (SELECT article, unit_ord, min(pos) AS start, string_agg(form, '' ORDER BY pos) AS noun, count(*) AS n, arg_min(tag, pos) AS head_tag FROM (SELECT *, pos - row_number() OVER (PARTITION BY article, unit_ord ORDER BY pos) AS island FROM tok0 WHERE tag IN ('NNG', 'NNP')) GROUP BY article, unit_ord, island)"""

_PART = lambda k: f"array_to_string(w[len(w) * {k} // {S.PARTS} + 1:len(w) * {k + 1} // {S.PARTS}], ' ')"
W = f"{WORDS}, parts AS (SELECT doc_id, source, lang, {', '.join(f'{_PART(k)} AS w{k}' for k in range(S.PARTS))} FROM words)"
GROUPS = f"""grp AS (SELECT p_type AS root, count(*) AS total, {_pick(["REF", "DEF", "STATIVE", "AMBIGUOUS", "ACTION"], "length(p_type)")} AS bucket, CASE WHEN length(p_type) % 3 <> 0 THEN {_pick(V.EDGE_TYPES, "length(p_type)")} END AS edge_type FROM part GROUP BY p_type)"""
MERGES = f"""ent AS (SELECT id, 'Organization' AS label, r.name, resolved FROM resolved r), moved AS (SELECT id, name, resolved, coalesce((SELECT min(id) FROM ent k WHERE k.name = ent.resolved), (SELECT min(id) FROM ent k WHERE k.resolved = ent.resolved AND k.name <> k.resolved)) AS target FROM ent WHERE resolved <> name),
merges AS (SELECT *, CASE WHEN target = id THEN 'rename' ELSE 'merge' END AS action FROM moved)"""
K05 = "d AS (SELECT source || '/' || doc_id AS file_path, lang, coalesce(text, '') AS raw_text FROM documents)"


_TEXT = "'주어=' || {agent} || ' / 동사=' || lemma || ' / 목적어=' || patient || ' / 원문: ' || substring({evidence}, 1, 200)"
_TYPES = _list(V.EDGE_TYPES)
RESOLVED_RELATIONS = f"""{FOUND}, raw AS (SELECT *, {_ROOT} AS verb_root FROM found WHERE coalesce(agent, '') <> '' AND coalesce(patient, '') <> ''),
asked AS (SELECT *, length(verb_root) + unicode(verb_root) AS n, length({_TEXT.format(agent="agent", evidence="agent || ' ' || patient")}) AS len FROM raw),
ways AS (SELECT *, CASE WHEN n % 3 <> 0 AND n % 2 <> 0 THEN 'mapped' WHEN n % 3 <> 0 THEN 'needs_context' WHEN unicode(verb_root) % 3 = 1 THEN 'ambiguous' WHEN unicode(verb_root) % 3 = 0 THEN 'non_action' ELSE 'unmapped' END AS route, {_pick(V.EDGE_TYPES, "n")} AS m, {_pick(V.EDGE_TYPES, "n + 1")} AS alt FROM asked),
answers AS (SELECT *, CASE WHEN route IN ('mapped', 'non_action') OR len % 5 IN (0, 1) THEN NULL WHEN route = 'needs_context' THEN CASE WHEN len % 5 = 2 THEN NULL ELSE [m, alt][1 + len % 2] END WHEN len % 5 = 2 THEN 'NONE' ELSE list_append({_TYPES}, 'NONE')[1 + len % 65] END AS answer FROM ways),
res AS (SELECT *, CASE WHEN route = 'mapped' OR route = 'needs_context' AND answer IS NULL THEN m WHEN answer <> 'NONE' THEN answer END AS edge_type, CASE WHEN route = 'mapped' OR route = 'needs_context' AND answer IS NULL THEN 'rule' WHEN answer <> 'NONE' THEN 'llm_disambiguation' END AS extraction_method,
  CASE WHEN route = 'mapped' THEN 'rule' WHEN route = 'non_action' THEN 'skipped_non_action_root' WHEN route = 'needs_context' AND answer IS NULL THEN 'rule,llm_disambiguation_fallback' WHEN answer IS NULL THEN 'skipped_llm_disambiguation_failed' WHEN answer = 'NONE' THEN 'skipped_llm_none' WHEN route = 'unmapped' THEN 'llm_disambiguation_unmapped_root' ELSE 'llm_disambiguation' END AS counters FROM answers)"""
_STEPS = "pt AS (SELECT p.*, s.ord, p.types[1] AS t, array_to_string(path, ',') AS path_text FROM paths p JOIN seeds s ON s.id = p.seed)"
NODES_FOUND = f"""{_STEPS}, cand AS (SELECT id, 0 AS later, ord, '' AS t, 0 AS hops, '' AS path_text, '' AS last FROM seeds UNION ALL SELECT last, 1, ord, t, hops, path_text, last FROM pt),
firsts AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY later, ord, t, hops, path_text, last) AS rn FROM cand),
nodes AS (SELECT v.*, CAST(row_number() OVER (ORDER BY later, ord, t, hops, path_text, last) AS INT) AS place FROM firsts JOIN v USING (id) WHERE rn = 1)"""
EDGES_FOUND = f"""{_STEPS}, met AS (SELECT pt.path[u.place + 1] AS id, seed, last, row_number() OVER (ORDER BY ord, t, hops, path_text, last, u.place) AS met_at FROM pt, (SELECT unnest(range(0, 2)) AS place) u WHERE u.place < len(path)),
firsts AS (SELECT id, min(met_at) AS first, arg_max(seed, met_at) AS source, arg_max(last, met_at) AS target FROM met GROUP BY 1)"""
LAWS_MATCHED = """m0 AS (SELECT c_custkey AS no, CASE WHEN c_custkey = 4 THEN '첫 째 ' ELSE replace(c_name, '#', ' · ') END AS name, CASE WHEN c_custkey = 4 THEN 1 ELSE c_custkey END AS k FROM customer),
m AS (SELECT no, name, k, CASE WHEN k % 3 <> 0 THEN replace(c_name, '#', 'ㆍ') END AS directory, k = 1 AND k % 3 <> 0 AS alias_applied FROM m0 JOIN customer ON c_custkey = k)"""
LINE_GROUPS = "g AS (SELECT 'r' || l_partkey AS root, count(*) AS c FROM lineitem GROUP BY 1)"


def oracle_sql() -> dict[str, str]:
    return {
        "s12_vertex_lookup": f"WITH {VERTICES}, {_seeds()} SELECT v.* FROM v WHERE id IN (SELECT id FROM seeds)",
        "s10_props_json": "SELECT event_type, count(CAST(json_extract(props, '$.k') AS BIGINT)) AS n, CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS total FROM events GROUP BY 1",
        "s03_front_matter": "SELECT doc_id, source AS title, lang, CAST(doc_id AS VARCHAR) AS no, CAST(NULL AS VARCHAR) AS none, 'a, b|' || doc_id AS \"of\", 'x|it''s' AS \"by\" FROM documents",
        "s01_law_list": "SELECT n_nationkey AS no, n_name AS name FROM nation",
        "s04_manifest": "SELECT CAST(o_custkey AS INT) AS no, 'law' || o_custkey AS source_law, o_orderstatus AS doc_type, CAST(o_orderkey AS VARCHAR) AS law_mst, strftime(o_orderdate, '%Y-%m-%d') AS promulgation_date, array_to_string(string_split(o_orderpriority, '-'), ', ') AS competent_ministry, 'd' || o_custkey || '/o' || o_orderkey || '.md' AS file_path FROM orders",
        "s10_pairs": "SELECT key, CAST(sum(n) AS BIGINT) AS n FROM (SELECT max(p_type) AS key, count(*) AS n FROM part GROUP BY p_brand) GROUP BY 1",
        "a09_degree": f"WITH {EDGES}, {ADJ} SELECT a AS id, count(*) AS degree FROM adj GROUP BY 1",
        "g02_degree_of_seeds": f"WITH {EDGES}, {ADJ}, {_seeds()} SELECT s.id, count(x.a) AS degree, CASE WHEN count(x.a) > 300 THEN 1 ELSE 2 END AS depth FROM seeds s LEFT JOIN adj x ON x.a = s.id GROUP BY 1",
        "g03_hub_cap": f"WITH {VERTICES}, {EDGES}, {ADJ} SELECT s.id, count(x.a) AS degree, CASE WHEN count(x.a) > 300 THEN 1 ELSE 3 END AS depth FROM v s LEFT JOIN adj x ON x.a = s.id WHERE label = 'Organization' GROUP BY 1",
        "j08_one_hop": f"WITH {VERTICES}, {EDGES}, {ADJ} SELECT a AS seed, 1 AS hops, edge_type AS types, count(*) AS n, count(DISTINCT b) AS n_last FROM adj WHERE a IN (SELECT id FROM v) GROUP BY ALL",
        "j09_paths_depth2": f"WITH {_paths(2)} {COUNTED}",
        "j09_paths_depth3": f"WITH {_paths(3, bound='(SELECT count(*) FROM adj d WHERE d.a = p.seed) <= 300')} {COUNTED}",
        "g01_hub_paths": f"WITH {VERTICES}, {_paths(2, start='hubs').replace('paths1 AS', _HUBS.format(label='Organization', order='DESC') + ', paths1 AS', 1)} {COUNTED}",
        "g01_low_degree_paths": f"WITH {VERTICES}, {_paths(2, start='hubs').replace('paths1 AS', _HUBS.format(label='Person', order='ASC') + ', paths1 AS', 1)} {COUNTED}",
        "p04_typed_paths": f"WITH {_paths(2, where="x.edge_type = 'SUPPLIED_BY'")} {COUNTED}",
        "p05_direction_out": f"WITH {_paths(3, adj=OUT)} {COUNTED}",
        "p05_direction_in": f"WITH {_paths(3, adj=IN)} {COUNTED}",
        "u01_homogeneous_paths": f"WITH {_paths(2, where="x.edge_type IN ('SUPPLIED_BY', 'CONTAINS')", one_type=True)} {COUNTED}",
        "u01_any_type_paths": f"WITH {_paths(2, where="x.edge_type IN ('SUPPLIED_BY', 'CONTAINS')")} {COUNTED}",
        "g04_capped_seeds": f"WITH {_paths(2, bound='(SELECT count(*) FROM adj d WHERE d.a = p.seed) <= 50')} {COUNTED}",
        "g05_retry": f"WITH {_paths(1)} SELECT *, FALSE AS filtered FROM ({COUNTED})",
        "p07_find_by_name": f"WITH {VERTICES} SELECT * FROM v WHERE name = (SELECT max(name) FROM v) ORDER BY list_position(['Organization', 'Person', 'LegalDocument', 'Concept'], label), id LIMIT 1",
        "g06_context_lines": f"WITH {VERTICES}, {_paths(1)}, {PATH_EDGES} SELECT line FROM ctx",
        "t06_capped_context": f"WITH {VERTICES}, {_paths(2)}, {PATH_EDGES} SELECT line FROM ctx",
        "g08_plain_context": f"WITH {VERTICES}, {_paths(2)}, {PATH_EDGES} SELECT DISTINCT '(' || seed_label || ') ' || seed_name || ' -[' || edge_type || ']-> (' || last_label || ') ' || last_name AS line FROM pe",
        "p11_path_edges": f"WITH {VERTICES}, {_paths(2)}, {PATH_EDGES} SELECT DISTINCT edge_id AS id, seed AS source, last AS target, edge_src, edge_dst, edge_type, source_law, article_no, paragraph_no FROM pe",
        "g09_answer_nodes": f"WITH {VERTICES}, {_paths(2)}, {NODES_FOUND} SELECT * FROM nodes WHERE place <= 1000",
        "g09_answer_edges": f"WITH {VERTICES}, {_paths(2)}, {EDGES_FOUND}, k AS (SELECT *, CAST(row_number() OVER (ORDER BY first) AS INT) AS place FROM firsts) SELECT e.id, source, target, edge_type, source_law, article_no, paragraph_no, modality, voice, place FROM k JOIN e USING (id) WHERE place <= 1500",
        "a11_dedup_first": "SELECT o_orderpriority || '|' || o_custkey AS line, min(o_orderkey) AS ord FROM orders GROUP BY 1",
        "a12_last_wins": "SELECT o_custkey, arg_max(o_orderstatus, o_orderkey) AS o_orderstatus, arg_max(o_totalprice, o_orderkey) AS o_totalprice, min(o_orderkey) AS first_seen FROM orders GROUP BY 1",
        "a13_first_wins": "SELECT o_custkey, min(o_orderkey) AS o_orderkey, arg_min(o_orderstatus, o_orderkey) AS o_orderstatus, arg_min(o_totalprice, o_orderkey) AS o_totalprice FROM orders GROUP BY 1",
        "j10_seed_union": f"WITH {EDGES}, {_seeds()} SELECT id, min(ord) AS ord FROM (SELECT id, ord FROM seeds UNION ALL SELECT unnest([src, dst]), ord + 1000 FROM e JOIN seeds ON e.src = seeds.id WHERE edge_type = 'SUPPLIED_BY') GROUP BY 1",
        "j04_relation_names": f"WITH {VERTICES}, {EDGES} SELECT a.label AS src_label, edge_type, b.label AS dst_label, count(*) AS n FROM e JOIN v a ON a.id = src JOIN v b ON b.id = dst GROUP BY ALL",
        "j07_dangling": f"WITH {VERTICES} SELECT 'p' || vec_id IN (SELECT id FROM v) AND 'p' || vec_id * 7 IN (SELECT id FROM v) AS kept, count(*) AS n FROM embeddings GROUP BY 1",
        "k11_collapse_parallel": f"WITH {EDGES} SELECT src, edge_type, dst, max(id) AS id, count(*) AS n FROM e GROUP BY ALL",
        "k10_merge_edges": f"WITH {EDGES} SELECT edge_type, count(*) AS n, count(DISTINCT id) AS n_ids FROM (SELECT * FROM e WHERE edge_type <> 'SUPPLIED_BY' UNION ALL SELECT DISTINCT ON (id) * FROM e WHERE edge_type = 'SUPPLIED_BY') GROUP BY 1",
        "k09_upsert_nodes": f"WITH {VERTICES} SELECT id, label, CASE WHEN label <> 'Concept' THEN upper(name) ELSE name END AS name FROM v",
        "t01_knn_entities": f"WITH {_near(5, 'vec_id')} SELECT id, label, cosine, round((1 + cosine) / 2, 6) AS score FROM near",
        "k13_vector_index": f"WITH {_near(5, 'vec_id')} SELECT id, label, cosine, round((1 + cosine) / 2, 6) AS score FROM near",
        "t02_knn_relations": f"WITH {_near(20, 'vec_id DESC', 'label IS NOT NULL')} SELECT id, 'p' || id AS source, 's' || label AS target, cosine FROM near",
        "c21_cosine": "SELECT vec_id AS id, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), (SELECT CAST(embedding AS DOUBLE[]) FROM embeddings ORDER BY vec_id LIMIT 1)), 5) AS cosine FROM embeddings",
        "t09_seeds_by_score": f"WITH {_seeds(20)} SELECT id, round(score, 6) AS score, ord FROM seeds",
        "c01_normalize": f"WITH {NAMES} SELECT id, translate(replace(trim(name), ' ', ''), '·,', 'ㆍㆍ') AS name FROM names",
        "c08_extract_root": f"WITH {NAMES}, l AS (SELECT id, {_pick(S.WORDS, 'id')} || {_pick(V.ROOT_SUFFIXES, 'length(name)')} AS lemma FROM names) SELECT id, {_ROOT} AS root FROM l",
        "c09_resolve_alias": f"WITH {NAMES}, {RESOLVED} SELECT id, bare, resolved FROM resolved",
        "c10_is_law": f"WITH {NAMES} SELECT id, {IS_LAW} AS is_law FROM names",
        "j12_entity_type": f"WITH {NAMES}, {TYPED} SELECT * FROM typed",
        "a10_distinct_mentions": f"WITH {NAMES}, {RESOLVED} SELECT DISTINCT resolved AS name FROM resolved",
        "c11_entity_description": f"WITH {NAMES}, {TYPED} SELECT id, name || ' (' || label || CASE WHEN coalesce(subtype, '') <> '' THEN ': ' || subtype ELSE '' END || ')' AS description FROM typed",
        "c12_relation_description": f"WITH {EDGES}, d AS (SELECT {PLACE} || ': ' || src || ' -[' || edge_type || ']-> ' || dst || ' (modality=' || modality || ', voice=' || voice || ')' AS description FROM e) SELECT substring(description, 1, 24) AS place, count(*) AS n, min(description) AS first FROM d GROUP BY 1",
        "c16_article_label": "SELECT doc_id, 0 AS article_ord, '제' || (1 + doc_id % 9) || '조' AS label FROM documents UNION ALL SELECT doc_id, 1, '제' || (2 + doc_id % 9) || '조의' || (2 + doc_id % 3) FROM documents",
        "r01_keyword_route": f"WITH {QUESTIONS}, {KEYWORDS} SELECT conv_id, turn, string_agg(DISTINCT edge_type, ',' ORDER BY edge_type) AS types FROM questions LEFT JOIN kw ON contains(question, keyword) GROUP BY 1, 2",
        "j11_keyword_join": f"WITH {QUESTIONS}, {KEYWORDS} SELECT edge_type, count(*) AS n FROM questions JOIN kw ON contains(question, keyword) GROUP BY 1",
        "j14_category_types": f"WITH {QUESTIONS}, {CATEGORIES} SELECT conv_id, turn, string_agg(DISTINCT edge_type, ',' ORDER BY edge_type) AS types FROM questions JOIN cat ON category IN ({_pick(V.EDGE_CATEGORIES, 'conv_id')}, {_pick(V.EDGE_CATEGORIES, 'turn')}) GROUP BY 1, 2",
        "u04_refine": f"WITH {QUESTIONS}, a AS (SELECT conv_id, turn, {_pick(V.EDGE_TYPES, 'turn')} AS x, {_pick(V.EDGE_TYPES, 'conv_id')} AS y, {_list(V.EDGE_TYPES[:20])} AS c FROM questions), k AS (SELECT *, list_filter(CASE WHEN x = y THEN [x] ELSE [x, y] END, lambda t: list_contains(c, t)) AS kept FROM a) SELECT conv_id, turn, array_to_string(CASE WHEN len(kept) > 0 THEN kept ELSE c END, ',') AS types FROM k",
        "n07_clauses": f"WITH {FOUND} SELECT article, unit_ord, pos, lemma AS verb_lemma, {_ROOT} AS verb_root, voice, modality, agent, patient, agent_source FROM found",
        "n07_clauses_fold": f"WITH {FOUND} SELECT article, unit_ord, pos, lemma AS verb_lemma, agent, patient, voice, modality, agent_source FROM found",
        "n08_relations": f"WITH {FOUND} SELECT agent, {_ROOT} AS verb_root, patient, modality, voice, count(*) AS n FROM found WHERE coalesce(agent, '') <> '' AND coalesce(patient, '') <> '' GROUP BY ALL",
        "n02_verb_phrases": f"WITH {TOKENS}, {PHRASES} SELECT lemma, modal, count(*) AS n FROM phr GROUP BY ALL",
        "a02_noun_frequency": f"WITH {TOKENS}, {RUNS} SELECT noun, n > 1 AS compound, head_tag, count(*) AS n_runs FROM runs GROUP BY ALL",
        "w05_noun_runs": f"WITH {TOKENS}, {RUNS} SELECT * FROM runs",
        "w04_sentences": f"WITH {TOKENS} SELECT article, unit_ord, CAST(sentence AS BIGINT) AS sentence, count(*) AS n FROM tok GROUP BY ALL",
        "a03_root_groups": f"WITH {TOKENS}, {PHRASES}, c AS (SELECT lemma, {_ROOT} AS root, count(*) AS n FROM phr WHERE NOT modal GROUP BY ALL) SELECT root, CAST(sum(n) AS BIGINT) AS total, count(*) AS n_members, arg_min(lemma, (-n, lemma)) AS first FROM c GROUP BY root",
        "a05_bucket_share": f"WITH {GROUPS}, b AS (SELECT bucket, count(*) AS n_groups, CAST(sum(total) AS BIGINT) AS n_total FROM grp GROUP BY 1) SELECT *, round(100.0 * n_groups / sum(n_groups) OVER (), 4) AS pct_groups, round(100.0 * n_total / sum(n_total) OVER (), 4) AS pct_total FROM b",
        "a06_type_coverage": f"WITH {GROUPS} SELECT edge_type, count(*) AS n_groups, CAST(sum(total) AS BIGINT) AS n_total FROM grp GROUP BY 1",
        "a04_group_sizes": "WITH g AS (SELECT p_brand, count(*) AS n FROM part GROUP BY 1) SELECT count(*) FILTER (n > 1) AS multi, count(*) FILTER (n = 1) AS single FROM g",
        "a14_assigned_twice": "SELECT p_brand AS root, count(DISTINCT p_type) AS n FROM part GROUP BY 1 HAVING count(DISTINCT p_type) > 1",
        "a16_totals": "SELECT count(DISTINCT l_shipdate) AS n_keys, count(*) AS total FROM lineitem",
        "t03_most_common": "SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1",
        "t04_top_30": "SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, l_partkey LIMIT 30",
        "t07_first_documents": "SELECT doc_id, source FROM documents ORDER BY source, doc_id LIMIT 10",
        "u02_union_distinct": "SELECT l_partkey AS k FROM lineitem UNION SELECT l_suppkey FROM lineitem",
        "u03_except": "SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'",
        "w01_carry_forward": "SELECT conv_id, turn, last_value(CASE WHEN role = 'user' THEN turn END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS carried FROM conversations",
        "w02_backfill": "SELECT conv_id, turn, first_value(CASE WHEN role = 'assistant' THEN turn END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS later FROM conversations",
        "w08_index_in_root": "WITH r AS (SELECT o_custkey, o_orderkey, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS INT) AS idx FROM orders) SELECT *, CAST(idx // 5 AS BIGINT) AS batch FROM r",
        "c02_clean_markdown": f"WITH {W} SELECT doc_id, '제1장' || chr(10) || '제' || (1 + doc_id % 9) || '조 (목적)' || chr(10) || w0 || ' 정한다. <개정 2009.1.30>' || chr(10) || '제2절' || chr(10) || '제' || (2 + doc_id % 9) || '조의' || (2 + doc_id % 3) || ' (정의)' || chr(10) || '① 가 ' || w1 || chr(10) || '  1. 나 ' || w2 || chr(10) || '    가. 다 ' || w3 || chr(10) || '㉑ 라 ' || w4 || chr(10) || '부칙 끝' || chr(10) || '제1조 (시행일)' || chr(10) || '마' || chr(10) AS text FROM parts",
        "c05_articles": "SELECT doc_id, 0 AS article_ord, CAST(1 + doc_id % 9 AS INT) AS article_no, CAST(NULL AS INT) AS article_sub_no, '목적' AS title FROM documents UNION ALL SELECT doc_id, 1, CAST(2 + doc_id % 9 AS INT), CAST(2 + doc_id % 3 AS INT), '정의' FROM documents",
        "c05_split_articles": "WITH a AS (SELECT source, CAST(1 + doc_id % 9 AS INT) AS article_no, CAST(NULL AS INT) AS article_sub_no, '목적' AS title FROM documents UNION ALL SELECT source, CAST(2 + doc_id % 9 AS INT), CAST(2 + doc_id % 3 AS INT), '정의' FROM documents) SELECT *, count(*) AS n, count(*) AS n_ords FROM a GROUP BY ALL",
        "c06_paragraphs": f"WITH {W} SELECT doc_id, 0 AS article_ord, 0 AS paragraph_ord, CAST(NULL AS INT) AS paragraph_no, trim(w0 || ' 정한다.') AS head FROM parts UNION ALL SELECT doc_id, 1, 0, 1, trim('가 ' || w1) FROM parts UNION ALL SELECT doc_id, 1, 1, 21, trim('라 ' || w4) FROM parts",
        "c07_items": f"WITH {W} SELECT doc_id, 1 AS article_ord, 0 AS paragraph_ord, '1' AS label, trim('나 ' || w2) AS body, 0 AS depth FROM parts UNION ALL SELECT doc_id, 1, 0, '가', trim('다 ' || w3), 1 FROM parts",
        "p03_units": f"WITH {W} SELECT doc_id, 0 AS article_ord, CAST(NULL AS INT) AS paragraph_no, 0 AS unit_ord, trim(w0 || ' 정한다.') AS unit_text FROM parts UNION ALL SELECT doc_id, 1, 1, 0, trim('가 ' || w1) FROM parts UNION ALL SELECT doc_id, 1, 1, 1, trim('나 ' || w2) FROM parts UNION ALL SELECT doc_id, 1, 1, 2, trim('다 ' || w3) FROM parts UNION ALL SELECT doc_id, 1, 21, 0, trim('라 ' || w4) FROM parts",
        "k05_upsert_documents": f"WITH {K05} SELECT file_path, CASE WHEN lang = 'fr' THEN 'new' ELSE lang END AS lang, CASE WHEN lang <> 'en' THEN 'new: ' || raw_text ELSE raw_text END AS raw_text, lang <> 'fr' AS known FROM d",
        "k06_get_or_create": f"WITH {NAMES}, {TYPED} SELECT label, name, bool_or(known) AS known FROM (SELECT 'Concept' AS label, name, TRUE AS known FROM names WHERE name LIKE '금융%' UNION ALL SELECT label, name, FALSE FROM typed) GROUP BY 1, 2",
        "j05_link_relations": f"WITH {NAMES}, {TYPED} SELECT name AS agent, '이름' AS patient, count(*) AS n, max(least(length(name) * CASE WHEN id % 100 = 0 THEN 400 ELSE 1 END, 2000)) AS evidence, CAST(1 AS BIGINT) AS ids FROM typed WHERE EXISTS (SELECT 1 FROM typed WHERE name = '이름' AND label = 'Concept') GROUP BY 1",
        "g10_merge_entities": f"WITH {NAMES}, {RESOLVED}, {MERGES} SELECT coalesce(m.resolved, ent.name) AS name, count(*) AS n, min(ent.id) AS first FROM ent LEFT JOIN merges m USING (id) WHERE m.action IS NULL OR m.action = 'rename' GROUP BY 1",
        "j17_repoint": f"WITH {NAMES}, {RESOLVED}, {MERGES}, t AS (SELECT id, target FROM merges WHERE action = 'merge') SELECT ent.id AS rid, coalesce(a.target, ent.id) AS source, coalesce(b.target, k) AS target FROM (SELECT *, id // 1000000 * 1000000 + id * 3 % 50 AS k FROM ent) ent LEFT JOIN t a ON a.id = ent.id LEFT JOIN t b ON b.id = ent.k",
        "a17_merge_report": f"WITH {NAMES}, {RESOLVED}, {MERGES}, t AS (SELECT id FROM merges WHERE action = 'merge'), ends AS (SELECT id FROM ent UNION ALL SELECT id // 1000000 * 1000000 + id * 3 % 50 FROM ent) SELECT action, count(*) AS n FROM merges GROUP BY 1 UNION ALL SELECT 'repointed', (SELECT count(*) FROM ends WHERE id IN (SELECT id FROM t))",
        "r04_routes": f"WITH {GROUPS}, r AS (SELECT p_type, bucket, length(p_type) % 4 <> 0 AS has_map, length(p_type) % 3 = 0 AS ctx, {_pick(V.EDGE_TYPES, 'length(p_type)')} AS m FROM part JOIN grp ON p_type = root), w AS (SELECT CASE WHEN has_map AND NOT ctx THEN 'mapped' WHEN has_map THEN 'needs_context' WHEN bucket = 'AMBIGUOUS' THEN 'ambiguous' WHEN bucket IN ('REF', 'DEF', 'STATIVE') THEN 'non_action' ELSE 'unmapped' END AS route, CASE WHEN has_map THEN m END AS edge_type FROM r) SELECT route, CASE route WHEN 'mapped' THEN 'rule' WHEN 'needs_context' THEN 'rule,llm_disambiguation_fallback' WHEN 'non_action' THEN 'skipped_non_action_root' ELSE 'skipped_llm_disambiguation_failed' END AS counters, edge_type, count(*) AS n FROM w GROUP BY ALL",
        "r04_answered_routes": f"WITH {RESOLVED_RELATIONS} SELECT route, counters, edge_type, extraction_method, count(*) AS n FROM res GROUP BY ALL",
        "m03_stored_answers": f"WITH {RESOLVED_RELATIONS}, q AS (SELECT {_TEXT.format(agent="agent", evidence="agent || ' ' || patient")} AS text, CASE WHEN route = 'needs_context' THEN CASE WHEN m = alt THEN m ELSE m || ',' || alt END ELSE '*' END AS candidates, any_value(answer) AS answer FROM res WHERE route NOT IN ('mapped', 'non_action') GROUP BY 1, 2), n AS (SELECT count(*) AS n, count(answer) AS good FROM q) SELECT 1 AS run, n AS asked, good AS answered, n - good AS failed FROM n UNION ALL SELECT 2, n - good, good, n - good FROM n",
        "a08_counters": f"WITH {RESOLVED_RELATIONS}, names AS (SELECT DISTINCT 0 AS id, name FROM (SELECT unnest([agent, patient]) AS name FROM res WHERE edge_type IS NOT NULL)), {RESOLVED} SELECT 'raw_svo_records_with_both_endpoints' AS counter, count(*) AS n FROM raw UNION ALL SELECT 'relations_total', count(edge_type) FROM res UNION ALL SELECT 'entities_total', count(DISTINCT resolved) FROM resolved UNION ALL SELECT counter, count(*) FROM (SELECT unnest(string_split(counters, ',')) AS counter FROM res) GROUP BY 1",
        "c15_clause_text": f"WITH {FOUND}, c AS (SELECT agent, lemma, patient, count(*) AS n FROM found WHERE coalesce(agent, '') <> '' AND coalesce(patient, '') <> '' GROUP BY ALL) SELECT '[' || n || '] ' || {_TEXT.format(agent="CASE WHEN agent = '회사' THEN '(생략)' ELSE agent END", evidence="repeat(agent, 90)")} AS text FROM c",
        "m04_typed_by_model": f"WITH {NAMES}, {TYPED}, d AS (SELECT DISTINCT name, label, subtype, method, CASE WHEN method = 'dict' THEN 0 ELSE length(name) % 4 END AS k FROM typed), m AS (SELECT name, CASE WHEN k >= 2 THEN 'llm' ELSE method END AS method, CASE k WHEN 2 THEN 'Person' WHEN 3 THEN 'Organization' ELSE label END AS label, CASE k WHEN 2 THEN '임원' WHEN 3 THEN NULL ELSE subtype END AS subtype FROM d) SELECT method, label, subtype, count(*) AS n, min(name) AS first FROM m GROUP BY ALL",
        "c20_date_text": "SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 AND o_orderkey % 3 = 2 THEN 'x' || strftime(o_orderdate, '%Y-%m-%d') || 'x' WHEN o_orderkey % 4 = 1 THEN CASE WHEN o_orderkey % 3 = 2 THEN 'x' END ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day FROM orders",
        "k16_reload_vertices": f"WITH {VERTICES} SELECT id, label, name, CASE WHEN length(name) % 3 <> 0 THEN right(name, 2) END AS subtype FROM v",
        "k16_reload_edges": f"WITH {VERTICES}, {EDGES} SELECT edge_type, source_law, CASE WHEN article_no % 5 <> 0 THEN article_no END AS article_no, paragraph_no, count(*) AS n, count(DISTINCT src) AS n_src, min(dst) AS first FROM e WHERE src IN (SELECT id FROM v) AND dst IN (SELECT id FROM v) GROUP BY ALL",
        "s06_root_map": f"SELECT 'r' || o_orderkey AS verb_root, {_pick(V.EDGE_TYPES, 'o_orderkey')} AS mapped, CASE WHEN o_orderkey % 2 = 0 THEN {_pick(V.EDGE_TYPES, 'o_orderkey + 1')} ELSE '' END AS alternatives, o_orderkey % 3 = 1 AS needs_context FROM orders",
        "s07_ambiguous_roots": f"WITH {LINE_GROUPS} SELECT root FROM g",
        "s08_non_action_roots": "SELECT 'r' || l_partkey AS root FROM lineitem UNION SELECT 'r' || l_suppkey FROM lineitem UNION SELECT 'r' || o_custkey FROM orders",
        "s09_dictionary": "SELECT p_name || ' ' || p_partkey AS form, p_brand AS tag FROM part WHERE p_partkey % 5 <> 0",
        "j01_law_directories": f"WITH {LAWS_MATCHED} SELECT no, name, directory, alias_applied FROM m",
        "k01_manifest": f"WITH {LAWS_MATCHED} SELECT CAST(no AS INT) AS no, name AS source_law, '법률' AS doc_type, CAST(k AS VARCHAR) AS law_mst, '2020-01-31' AS promulgation_date, k || ', a, b' AS competent_ministry, directory || '/' || f || '.md' AS file_path FROM m, (SELECT unnest(['a', 'b']) AS f) WHERE directory IS NOT NULL",
        "s02_sorted_copy": f"WITH {LAWS_MATCHED}, d AS (SELECT DISTINCT directory, k FROM m WHERE directory IS NOT NULL) SELECT directory, f || '.md' AS file, CASE WHEN f = 'b' THEN 'a.md' END AS before, CAST(length('---\n법령구분: ''법률'' # kind\n법령MST: 0\n법령MST: \n공포일자: 2020-01-31\n소관부처: [, \"a, b\"]\n---\n') + 2 * length(CAST(k AS VARCHAR)) + length(c_mktsegment) AS INT) AS n FROM d JOIN customer ON c_custkey = k, (SELECT unnest(['a', 'b']) AS f)",
        "k02_bucketed_roots": f"WITH {LINE_GROUPS} SELECT {_pick(['REF', 'DEF', 'ACTION'], 'c')} AS bucket, count(*) AS n, CAST(sum(c) AS BIGINT) AS total FROM g GROUP BY 1",
        "k03_mapped_split": f"WITH {LINE_GROUPS} SELECT CASE WHEN c % 3 <> 0 THEN 'mapped' ELSE 'unmapped' END AS kind, CASE WHEN c % 3 <> 0 THEN {_pick(V.EDGE_TYPES, 'c')} END AS edge_type, count(*) AS n, CAST(sum(c) AS BIGINT) AS total FROM g GROUP BY ALL",
        "k04_frequency_file": "SELECT 'part ' || l_partkey AS key, count(*) AS n FROM lineitem GROUP BY 1",
        "k07_append_relations": f"WITH {EDGES} SELECT edge_type, count(*) AS n, count(DISTINCT id) AS n_ids FROM e WHERE edge_type IN ('PLACED_BY', 'IN_NATION') GROUP BY 1",
        "k08_truncate": f"WITH {EDGES} SELECT id, edge_type, src, dst FROM e WHERE edge_type = 'IN_REGION'",
        "a07_by_method": f"WITH {NAMES}, {TYPED} SELECT method, label, count(*) AS n FROM typed GROUP BY ALL",
        "c17_tagged_values": "SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'numeric' WHEN 1 THEN NULL ELSE 'path' END AS tag, CASE WHEN p_partkey % 5 = 1 THEN '{' || p_partkey END AS raw, CASE WHEN p_partkey % 5 = 0 THEN CAST(p_partkey AS VARCHAR) END AS scalar, CASE WHEN p_partkey % 5 > 1 THEN p_brand || '::vertex' END AS label, CASE WHEN p_partkey % 5 > 1 THEN 'vertex,edge,edge' END AS kinds FROM part",
        "c19_stable_ids": "WITH i AS (SELECT sha256('document' || chr(31) || source || chr(31) || doc_id) AS id FROM documents) SELECT count(*) AS n, count(DISTINCT id) AS n_ids, min(id) AS first FROM i",
        "flagship": f"WITH {VERTICES}, {_paths(2, bound='(SELECT count(*) FROM adj d WHERE d.a = p.seed) <= 300')}, {PATH_EDGES} SELECT line FROM ctx",
    }
