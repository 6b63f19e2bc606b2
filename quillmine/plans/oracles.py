"""DuckDB SQL with the results of the registered queries."""

from __future__ import annotations

from ..functions import vocabulary
from . import shapes

ORACLES: dict[str, str] = {}

_LEX = ", ".join(f"('{c}', '{t}', {i}, {j})" for i, (c, terms) in enumerate(shapes.LEXICON.items()) for j, t in enumerate(terms))
_SENTENCES = r"""
flat AS (SELECT doc_id, source, lang, trim(regexp_replace(coalesce(text, ''), '\s+', ' ', 'g')) AS t FROM documents),
cut AS (SELECT doc_id, t, list_filter(string_split(regexp_replace(t, '([.!?]) ([A-Z("''])', '\1' || chr(1) || '\2', 'g'), chr(1)), lambda x: trim(x) <> '') AS s FROM flat),
snt AS (SELECT doc_id, generate_subscripts(s, 1) - 1 AS pos, unnest(s) AS sentence FROM cut)"""
_TAGS = f"""{_SENTENCES},
lex(category, term, c, i) AS (VALUES {_LEX}),
tags AS (
  SELECT doc_id, pos, sentence, lower(trim(sentence)) AS k, category, c, string_agg(term, '|' ORDER BY i) AS terms
  FROM snt JOIN lex ON contains(lower(sentence), lower(term)) GROUP BY ALL),
firsts AS (SELECT * FROM tags QUALIFY row_number() OVER (PARTITION BY doc_id, category, k ORDER BY pos) = 1),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY doc_id, category ORDER BY pos) AS INTEGER) AS rank FROM firsts)"""
_NORM = r"trim(regexp_replace(regexp_replace(lower({}), '<[^>]+>', ' ', 'g'), '[^a-z0-9]+', ' ', 'g'))"
_PAPERS = """
papers AS (SELECT doc_id, source, lang, regexp_extract(coalesce(text, ''), '^[^\\n]*') AS title, coalesce(text, '') AS abstract,
  CASE WHEN doc_id % 3 = 0 THEN '' ELSE '10.5555/' || left(md5(coalesce(text, '')), 10) END AS doi, (doc_id % 40 + 1985)::VARCHAR AS year FROM documents)"""
_ATTEMPTS = """
attempts AS (SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS attempt_id, l_orderkey AS paper_id, l_partkey::VARCHAR AS strain, p_brand AS species,
  p_type AS technique, CASE l_returnflag WHEN 'R' THEN 'failure' WHEN 'A' THEN 'success' ELSE 'unclear' END AS outcome FROM lineitem JOIN part ON l_partkey = p_partkey)"""
_PASSAGES = """
passages AS (SELECT doc_id, generate_subscripts(s, 1) - 1 AS pos, unnest(s) AS text FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS s FROM documents)),
bucketed AS (SELECT *, ['METHODS', 'RESULTS', 'SUPPLEMENT', 'OTHER'][pos % 4 + 1] AS bucket, pos + 1 AS paragraph FROM passages)"""
_LINKS = """
pairs AS (SELECT DISTINCT o_custkey * 2 AS c, l_partkey * 2 + 1 AS p FROM orders JOIN lineitem ON o_orderkey = l_orderkey),
edges AS (SELECT c AS src, p AS dst, 'reference' AS label FROM pairs UNION ALL SELECT p, c, 'cited_by' FROM pairs),
seeds AS (SELECT c_custkey * 2 AS node FROM customer WHERE c_acctbal > 9900)"""
_TRIAGE = """
triage AS (SELECT d.doc_id, CASE quality WHEN 1 THEN 'yes' WHEN 0 THEN 'no' ELSE 'maybe' END AS decision, quality IS NOT NULL AS abstract_available
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


def _any(col: str, terms: list[str]) -> str:
    return "(" + " OR ".join(f"contains(lower({col}), '{t}')" for t in terms) + ")"


def _points(condition: str, n: int) -> str:
    return f"CASE WHEN {condition} THEN {n} ELSE 0 END"


def _hits(col: str, terms: list[str]) -> str:
    return f"list_filter({terms!r}, lambda x: contains(lower({col}), x))"


_P = shapes.PHRASES
_PASSAGE_POINTS = f"CASE WHEN bucket = 'OTHER' THEN 0 ELSE CASE WHEN {_any('text', _P.technique)} THEN CASE bucket WHEN 'SUPPLEMENT' THEN 3 ELSE 5 END ELSE 0 END + {_points(_any('text', _P.failure), 6)} + {_points(_any('text', _P.success), 4)} END"

ORACLES["sentence_split"] = f"WITH {_SENTENCES} SELECT doc_id, pos::INTEGER AS pos, sentence FROM snt"
ORACLES["keyword_spans"] = f"WITH {_TAGS} SELECT doc_id, category, rank, pos::INTEGER AS pos, sentence, terms FROM ranked WHERE rank <= 12"
_TERMS = ", ".join("('{}', '{}', {})".format(c, t.replace("'", "''"), i) for i, (c, t) in enumerate((c, t) for c, terms in vocabulary.SENTENCE_LEXICON.items() for t in terms))
ORACLES["lexicon_tags"] = f"""WITH {_SENTENCES}, lex(category, term, i) AS (VALUES {_TERMS})
SELECT doc_id, pos::INTEGER AS pos, category, string_agg(term, '|' ORDER BY i) AS terms FROM snt JOIN lex ON contains(lower(sentence), rtrim(lower(term), '*')) GROUP BY doc_id, pos, category"""
ORACLES["span_index"] = rf"""WITH {_TAGS},
per AS (SELECT doc_id, count(DISTINCT pos) AS tagged FROM tags GROUP BY 1),
cat AS (SELECT doc_id, {", ".join(f"least(12, count(*) FILTER (category = '{c}')) AS n_{c}" for c in shapes.LEXICON)} FROM firsts GROUP BY 1)
SELECT doc_id, len(s)::INTEGER AS n_sentences_total, coalesce(tagged, 0)::INTEGER AS n_tagged_sentences,
  {", ".join(f"coalesce(n_{c}, 0)::INTEGER AS n_{c}" for c in shapes.LEXICON)},
  len(list_distinct(regexp_extract_all(t, '{shapes.PATTERNS["email"]}')))::INTEGER AS n_accessions,
  coalesce(n_manipulation > 0 AND (n_success > 0 OR n_failure > 0 OR n_strain > 0), false) AS has_signal
FROM cut LEFT JOIN per USING (doc_id) LEFT JOIN cat USING (doc_id)"""
ORACLES["accession_extract"] = " UNION ALL ".join(f"SELECT doc_id, '{k}' AS kind, unnest(list_distinct(regexp_extract_all(text, '{rx}'))) AS value FROM documents" for k, rx in shapes.PATTERNS.items())
ORACLES["title_normalize"] = f"SELECT doc_id, {_NORM.format('coalesce(text, $$$$)')} AS title_norm FROM documents"
ORACLES["paper_id"] = f"""WITH {_PAPERS} SELECT doc_id, doi AS doi_norm, CASE WHEN doi <> '' THEN 'P' || substr(sha1('doi:' || doi), 1, 12)
  WHEN {_NORM.format('title')} <> '' THEN 'P' || substr(sha1('title:' || {_NORM.format('title')}), 1, 12) ELSE 'P' || substr(sha1('title:' || title), 1, 12) END AS id_v1,
  'PV2' || substr(sha1('pmid:' || doc_id), 1, 12) AS id_v2, doc_id || '-OBS' || lpad((doc_id % 30 + 1)::VARCHAR, 2, '0') AS obs_id FROM papers"""
ORACLES["html_title_clean"] = r"""SELECT page_id, regexp_replace(replace(replace(replace(replace(replace(
  regexp_extract(html, '(?s)<title>(.*?)</title>', 1), '&quot;', '"'), '&copy;', '©'), '&middot;', '·'), '&lt;', '<'), '&amp;', '&'), '<[^>]+>', '', 'g') AS title FROM pages"""
ORACLES["technique_category"] = f"SELECT doc_id, CASE WHEN {_any('text', ['license'])} THEN 'b' WHEN {_any('text', ['the ', 'der '])} THEN 'a' WHEN {_any('text', ['que '])} THEN 'c' ELSE 'other' END AS category FROM documents"
ORACLES["shortlist_topk"] = f"""WITH {_PAPERS} SELECT doc_id, year, ({_points(_any('title', ['the ', 'la ']), 2)} + {_points(_any('title', ['tion', 'der ']), 3)} + {_points(_any('title', ['no ']), 2)}
  + {_points('doc_id % 7 = 0', 3)} + {_points('doc_id % 11 = 0', 2)} - {_points(_any('title', ['license', 'as ']), 3)})::INTEGER AS score FROM papers ORDER BY score DESC, year, doc_id LIMIT 60"""
_WHOLE = "(title || ' ' || abstract)"
ORACLES["abstract_score"] = f"""WITH {_PAPERS} SELECT doc_id, (3 * least(2, len({_hits(_WHOLE, _P.technique)})) + {_points(_any(_WHOLE, _P.failure), 6)} + {_points(_any(_WHOLE, _P.success), 4)}
  + {_points(_any('title', _P.title_tools), 3)} + {_points(_any(_WHOLE, _P.generic), 2)})::BIGINT AS score FROM papers"""
ORACLES["passage_score"] = rf"""WITH {_PASSAGES}, {_PAPERS},
sums AS (SELECT doc_id, sum({_PASSAGE_POINTS}) AS p, regexp_matches(string_agg(text, ' ' ORDER BY pos) FILTER (pos < 60), '(?i)\b(\d+|two|three|four|five|six|seven|eight|nine|ten)\s+strains?\b') AS b FROM bucketed GROUP BY 1)
SELECT doc_id, (p + CASE WHEN b THEN 3 ELSE 0 END + {_points(_any('title', _P.title_tools), 3)} + {_points(_any('title', _P.title_methods), 2)})::BIGINT AS score FROM papers JOIN sums USING (doc_id)"""
ORACLES["passage_context"] = f"""WITH {_PASSAGES},
near AS (SELECT *, concat_ws(' ', lag(text) OVER w, text, lead(text) OVER w) AS context FROM bucketed WHERE bucket <> 'OTHER' WINDOW w AS (PARTITION BY doc_id, bucket ORDER BY paragraph)),
found AS (SELECT *, {_hits('text', _P.technique)} AS a, {_hits('text', _P.failure)} AS b, {_hits('text', _P.success)} AS c FROM near)
SELECT doc_id, lower(bucket) || '_' || paragraph AS chunk_id, ({_PASSAGE_POINTS})::INTEGER AS points, array_to_string(a, '|') AS matched_technique, array_to_string(b, '|') AS matched_failure,
  array_to_string(c, '|') AS matched_success, context FROM found WHERE len(a) + len(b) + len(c) > 0"""
ORACLES["attempts_by_outcome"] = f"WITH {_ATTEMPTS} SELECT outcome, count(*) AS n FROM attempts GROUP BY 1"
ORACLES["attempts_by_technique"] = f"WITH {_ATTEMPTS} SELECT technique, count(*) AS n FROM attempts WHERE technique <> '' GROUP BY 1"
ORACLES["technique_groups"] = f"""WITH {_ATTEMPTS} SELECT CASE WHEN {_any('technique', ['stan', 'brush'])} THEN 'metal' WHEN {_any('technique', ['econ'])} THEN 'eco' WHEN {_any('technique', ['promo', 'large'])} THEN 'rest' ELSE 'other' END AS category,
  count(*) AS n FROM attempts GROUP BY 1"""
ORACLES["species_strain_counts"] = f"""WITH {_ATTEMPTS} SELECT count(*) AS n_attempts, count(DISTINCT paper_id) AS n_papers, count(DISTINCT species) FILTER (species <> '') AS n_species,
  count(DISTINCT species || '|' || strain) FILTER (strain <> '') AS n_strains FROM attempts"""
ORACLES["multi_strain_papers"] = f"WITH {_ATTEMPTS} SELECT paper_id, count(DISTINCT strain) AS n_strains FROM attempts WHERE strain <> '' GROUP BY 1 HAVING count(DISTINCT strain) > 1"
ORACLES["source_tally"] = "SELECT event_type AS value, count(DISTINCT user_id) AS n FROM events WHERE user_id IS NOT NULL GROUP BY 1"
ORACLES["attempt_report"] = f"WITH {_ATTEMPTS} SELECT a.*, o_custkey AS pmid, o_orderstatus AS doi, o_orderpriority AS paper_title FROM attempts a JOIN orders ON paper_id = o_orderkey WHERE outcome = 'failure'"
ORACLES["pending_anti"] = "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) ORDER BY doc_id LIMIT 100"
ORACLES["cache_readiness"] = """WITH r AS (SELECT doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) AS f, coalesce(text, '') <> '' AS a FROM documents)
SELECT count(*) FILTER (f) AS n_full, count(*) FILTER (NOT f AND a) AS n_abstract_only, count(*) FILTER (NOT f AND NOT a) AS n_neither FROM r"""
ORACLES["triage_summary"] = f"""WITH {_TRIAGE} SELECT count(*) AS n_triaged, count(*) FILTER (decision = 'yes') AS n_yes, count(*) FILTER (decision = 'no') AS n_no, count(*) FILTER (decision = 'maybe') AS n_maybe,
  count(*) FILTER (NOT abstract_available) AS n_forced, count(*) FILTER (decision = 'maybe' AND abstract_available) AS n_genuine_maybe FROM triage"""
ORACLES["stage_backlog"] = f"""WITH {_TRIAGE}, c AS (SELECT count(*) AS n_papers, count(*) FILTER (abstract_available) AS n_triaged, count(*) FILTER (decision = 'yes') AS n_extracted FROM triage),
b AS (SELECT *, greatest(0, n_papers - n_triaged) AS backlog_triaged, greatest(0, n_triaged - n_extracted) AS backlog_extracted FROM c) SELECT *, greatest(backlog_triaged, backlog_extracted) AS largest_backlog FROM b"""
ORACLES["status_domain_counts"] = """WITH d(value) AS (VALUES ('not_checked'), ('no_genome_found'), ('exact_strain_match'), ('multiple_possible_matches'), ('species_only_match')),
c AS (SELECT CASE l_returnflag WHEN 'R' THEN 'exact_strain_match' WHEN 'A' THEN 'odd_value' ELSE 'not_checked' END AS value, count(*) AS n FROM lineitem GROUP BY 1)
SELECT value, coalesce(n, 0)::BIGINT AS n FROM d FULL JOIN c USING (value)"""
ORACLES["dedup_components"] = f"""WITH RECURSIVE {_PAPERS},
keyed AS (SELECT doc_id AS n, unnest(list_filter([CASE WHEN doi <> '' THEN 'doi:' || doi END, CASE WHEN {_NORM.format('title')} <> '' THEN 'title:' || {_NORM.format('title')} END], lambda x: x IS NOT NULL)) AS key FROM papers),
linked AS (SELECT DISTINCT a.n AS a, b.n AS b FROM keyed a JOIN keyed b USING (key) WHERE a.n <> b.n),
reach(a, b) AS (SELECT doc_id, doc_id FROM papers UNION SELECT r.a, l.b FROM reach r JOIN linked l ON r.b = l.a),
comp AS (SELECT a AS doc_id, min(b) AS component FROM reach GROUP BY 1),
best AS (SELECT component, count(*) AS n_records, coalesce(arg_min(title, doc_id) FILTER (title <> ''), '') AS title, coalesce(arg_min(doi, doc_id) FILTER (doi <> ''), '') AS doi FROM comp JOIN papers USING (doc_id) GROUP BY 1)
SELECT component, n_records, title, doi, 'P' || substr(sha1(CASE WHEN doi <> '' THEN 'doi:' || doi WHEN {_NORM.format('title')} <> '' THEN 'title:' || {_NORM.format('title')} ELSE 'title:' || title END), 1, 12) AS paper_id FROM best"""
ORACLES["paper_upsert"] = """WITH e AS (SELECT *, event_id % 2 AS half, CASE WHEN event_id % 3 = 0 THEN '' ELSE json_extract_string(props, '$.k') END AS title,
  CASE event_type WHEN 'error' THEN 1 WHEN 'signup' THEN 6 ELSE 2 END AS r, strftime(ts, '%Y-%m-%d %H:%M:%S') AS t FROM events),
halves AS (SELECT user_id, half, arg_max(title, event_id) FILTER (title <> '') AS title, arg_max(r, event_id) AS r, arg_min(t, event_id) AS t FROM e GROUP BY 1, 2),
a AS (SELECT * FROM halves WHERE half = 0), b AS (SELECT * FROM halves WHERE half = 1),
sets AS (SELECT user_id, string_agg(DISTINCT event_type, '|' ORDER BY event_type) AS s FROM events GROUP BY 1)
SELECT user_id AS paper_id, coalesce(b.title, a.title) AS title, s AS discovery_sources,
  ['discovered', 'metadata_fetched', '', '', '', 'extraction_complete'][greatest(coalesce(a.r, 0), coalesce(b.r, 0))] AS processing_status, coalesce(a.t, b.t) AS first_seen_at
FROM a FULL JOIN b USING (user_id) JOIN sets USING (user_id)"""
ORACLES["status_update"] = """SELECT d.doc_id AS paper_id, CASE WHEN quality = 1 THEN 'extracted' WHEN toxic = 1 THEN 'manual_review_required' ELSE 'discovered' END AS processing_status
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""
ORACLES["locked_merge"] = "SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'updated' ELSE source END AS source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 0)"
ORACLES["heal_placeholders"] = f"WITH {_TRIAGE} SELECT t.doc_id AS paper_id, decision, abstract_available FROM triage t JOIN documents d ON t.doc_id = d.doc_id WHERE NOT (NOT abstract_available AND coalesce(lang = 'en', false) AND coalesce(text, '') <> '')"
ORACLES["work_queue"] = "SELECT o_orderkey AS paper_id, o_orderstatus AS processing_status, o_totalprice AS candidate_score FROM orders WHERE o_orderstatus IN ('F', 'P') ORDER BY o_totalprice DESC, o_orderdate, o_orderkey LIMIT 250"
ORACLES["seed_union"] = "SELECT doc_id::VARCHAR AS node FROM documents WHERE doc_id % 5 = 0 UNION SELECT doc_id::VARCHAR FROM labels WHERE quality = 1 AND doc_id IN (SELECT doc_id FROM documents)"
ORACLES["pass_overlap"] = "SELECT doc_id FROM labels WHERE quality = 1 INTERSECT SELECT doc_id FROM labels WHERE toxic = 1"
ORACLES["pool_difference"] = "SELECT doc_id FROM labels WHERE quality = 1 EXCEPT ALL SELECT doc_id FROM labels WHERE toxic = 1"
ORACLES["evidence_verify"] = rf"""WITH {_SENTENCES},
q AS (SELECT doc_id, list_transform(s, lambda x: lower(x)) AS f, CASE doc_id % 4 WHEN 0 THEN 'not said: ' || source WHEN 1 THEN '' ELSE lower(coalesce(s[doc_id % 5 + 1], '')) END AS x FROM cut JOIN flat USING (doc_id)),
v AS (SELECT doc_id, x = '' AS e, len(list_filter(f, lambda h: contains(h, x) OR contains(x, h))) > 0 AS there FROM q)
SELECT doc_id, CASE WHEN e THEN false ELSE there END AS verified_v1, CASE WHEN e THEN true ELSE there END AS verified_v2 FROM v"""
_OK = "technique IN ('ECONOMY', 'STANDARD', 'SMALL')"
ORACLES["vocab_coerce"] = f"""WITH {_ATTEMPTS} SELECT attempt_id, CASE WHEN {_OK} THEN technique ELSE 'other' END AS technique, CASE WHEN {_OK} THEN '' ELSE technique END AS detail,
  CASE WHEN outcome = 'success' THEN outcome ELSE 'unclear' END AS outcome, concat_ws(' ', CASE WHEN NOT {_OK} THEN 'technique_uncertain' END, CASE WHEN outcome <> 'success' THEN 'outcome_uncertain' END) AS qc_flags FROM attempts"""
ORACLES["quota_batch"] = """WITH p AS (SELECT doc_id, CASE lang WHEN 'de' THEN 'negative' WHEN 'fr' THEN 'table' ELSE 'other' END AS pool, CASE WHEN coalesce(lang, '') NOT IN ('de', 'fr', 'es') THEN 1 ELSE 0 END AS first FROM documents),
r AS (SELECT *, row_number() OVER (PARTITION BY pool ORDER BY first, doc_id) AS k FROM p),
o AS (SELECT *, k > CASE pool WHEN 'negative' THEN 31 WHEN 'table' THEN 40 ELSE 0 END AS late, CASE pool WHEN 'negative' THEN 0 WHEN 'table' THEN 1 ELSE 2 END AS w FROM r)
SELECT CAST(row_number() OVER (ORDER BY late, w, k) AS INTEGER) AS place, doc_id, pool FROM o QUALIFY place <= 90"""
ORACLES["stratified_head"] = f"""WITH {_ATTEMPTS} SELECT attempt_id, outcome, CAST(row_number() OVER (PARTITION BY outcome ORDER BY attempt_id) AS INTEGER) AS place FROM attempts
QUALIFY place <= CASE outcome WHEN 'failure' THEN 3 WHEN 'success' THEN 4 ELSE 2 END"""
ORACLES["catalog_match"] = """WITH obs AS (SELECT p_partkey AS observation_id, CASE WHEN p_partkey % 9 = 0 THEN p_brand WHEN p_partkey % 8 = 0 THEN 'No such' ELSE p_brand || ' ' || p_type END AS binomial,
    CASE WHEN p_partkey % 7 = 0 THEN 'unknown' ELSE lower(p_name || ' ' || p_size) END AS token, p_partkey % 7 <> 0 AS ok FROM part),
cat AS (SELECT p_partkey AS rank, 'GCF_' || p_partkey AS accession, p_brand || ' ' || p_type AS b, lower(concat_ws(' ', p_brand, p_type, p_name, p_size)) AS m FROM part),
j AS (SELECT observation_id, binomial, token, count(accession) AS n, count(*) FILTER (ok AND contains(m, token)) AS h, arg_min(accession, rank) AS f, arg_min(accession, rank) FILTER (ok AND contains(m, token)) AS fh
  FROM obs LEFT JOIN cat ON b = binomial GROUP BY 1, 2, 3)
SELECT observation_id, binomial, token AS strain_token, CASE WHEN NOT contains(binomial, ' ') THEN 'not_checked' WHEN n = 0 THEN 'no_genome_found' WHEN h = 1 THEN 'exact_strain_match'
  WHEN h > 1 THEN 'multiple_possible_matches' ELSE 'species_only_match' END AS genome_match_status, CASE WHEN contains(binomial, ' ') THEN coalesce(fh, f, '') ELSE '' END AS accession, h AS n_strain_hits FROM j"""
ORACLES["triage_stub"] = """SELECT doc_id AS paper_id, CASE WHEN doc_id % 6 = 0 OR coalesce(text, '') = '' THEN 'maybe' WHEN contains(lower(source || left(text, 2500)), 'stre') THEN 'maybe'
  WHEN contains(lower(left(text, 2500)), 'license') THEN 'yes' ELSE 'no' END AS decision, NOT (doc_id % 6 = 0 OR coalesce(text, '') = '') AS abstract_available FROM documents"""
ORACLES["incremental_ingest"] = """SELECT user_id AS paper_id, string_agg(DISTINCT event_type, '|' ORDER BY event_type) AS discovery_sources, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first_seen_at FROM events GROUP BY 1"""
ORACLES["concurrent_merge"] = """SELECT d.doc_id, concat_ws('|', CASE WHEN lang = 'de' THEN 'german' END, CASE WHEN d.doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) THEN 'good' END,
  CASE WHEN d.doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) THEN 'toxic' END) AS marks, source || '/' || d.doc_id AS place FROM documents d WHERE NOT coalesce(n_chars < 400, false)"""
ORACLES["greedy_quota"] = """WITH RECURSIVE t(topic, no) AS (VALUES ('view', 0), ('click', 1), ('signup', 2), ('error', 3), ('purchase', 4)),
f AS (SELECT no, topic, CAST(event_id % 2 AS INTEGER) AS pass, event_id AS rank, user_id AS paper_id FROM events JOIN t ON topic = event_type QUALIFY row_number() OVER (PARTITION BY no, user_id ORDER BY event_id % 2, event_id) = 1),
steps(no, taken) AS (
  SELECT -1, CAST([] AS STRUCT(topic VARCHAR, pass INTEGER, rank BIGINT, paper_id BIGINT)[])
  UNION ALL
  SELECT s.no + 1, list_concat(s.taken, coalesce((
    SELECT list(x) FROM (SELECT {'topic': topic, 'pass': pass, 'rank': rank, 'paper_id': paper_id} AS x FROM f
      WHERE f.no = s.no + 1 AND NOT list_contains(list_transform(s.taken, lambda y: y.paper_id), f.paper_id) ORDER BY pass, rank LIMIT 25)), []))
  FROM steps s WHERE s.no < 4)
SELECT x.topic, x.pass, x.rank, x.paper_id FROM (SELECT unnest(taken) AS x FROM steps WHERE no = 4)"""
ORACLES["review_table"] = """WITH last AS (SELECT l_orderkey, l_returnflag, l_partkey FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_returnflag DESC) = 1)
SELECT o_orderkey AS observation_id, o_custkey AS paper_id, o_orderpriority AS outcome, coalesce(l_returnflag, 'not_yet_matched') AS genome_match_status,
  coalesce('GCF_' || l_partkey, '') AS genome_accession, coalesce(c_name, '') AS title, coalesce(c_mktsegment, '') AS doi
FROM orders LEFT JOIN last ON o_orderkey = l_orderkey LEFT JOIN customer ON o_custkey = c_custkey WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')"""
ORACLES["packet_orphans"] = "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)"
ORACLES["store_append"] = "SELECT doc_id, CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN source ELSE 'new' END AS source, lang FROM documents"
ORACLES["attempts_replaced"] = """WITH new AS (SELECT l_orderkey, l_linenumber + 100 AS l_linenumber, l_partkey, l_returnflag FROM lineitem WHERE l_returnflag = 'R')
SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag FROM lineitem WHERE l_orderkey NOT IN (SELECT l_orderkey FROM new) UNION ALL SELECT * FROM new"""
ORACLES["citation_reach"] = f"""WITH RECURSIVE {_LINKS}, walk(node, hop) AS (SELECT node, 0 FROM seeds UNION SELECT dst, hop + 1 FROM walk JOIN edges ON src = node WHERE hop < 3)
SELECT node, min(hop)::INTEGER AS hop FROM walk GROUP BY 1"""
ORACLES["citation_tags"] = f"""WITH {_LINKS} SELECT dst AS node, string_agg(DISTINCT src::VARCHAR, '|' ORDER BY src::VARCHAR) AS seeds, string_agg(DISTINCT label, '|' ORDER BY label) AS labels
FROM edges JOIN seeds ON src = node GROUP BY 1"""
for _name, _n in (("search", 260), ("reference", 600), ("id", 500)):
    ORACLES[f"{_name}_crawl"] = f"""SELECT source, (n - 1)::INTEGER AS place, doc_id::VARCHAR AS id
FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS n FROM documents WHERE source IS NOT NULL) WHERE n <= {_n}"""
ORACLES["id_pages"] = """SELECT page::BIGINT AS page, count(*)::INTEGER AS n, min(doc_id) AS first, md5(string_agg(doc_id::VARCHAR, ',' ORDER BY doc_id)) AS ids_md5
FROM (SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 200 AS page FROM documents) GROUP BY page"""
ORACLES["catalogue_summary"] = "SELECT p_partkey::VARCHAR AS uid, 'GCF_' || p_partkey AS accession, p_type AS organism, p_type || ' ' || p_name AS match_text FROM part"
ORACLES["organism_list"] = """WITH o AS (SELECT regexp_replace(concat_ws('  ', p_brand, p_type, p_name), '\\s+', ' ', 'g') AS x FROM part UNION ALL SELECT n_name FROM nation)
SELECT x AS organism FROM o WHERE len(string_split(x, ' ')) <= 4 UNION SELECT p_brand FROM part JOIN lineitem ON p_partkey = l_partkey"""
ORACLES["processable_triage"] = f"""WITH {_TRIAGE} SELECT t.doc_id, decision, abstract_available, source, lang FROM triage t LEFT JOIN documents d ON t.doc_id = d.doc_id AND lang IS NOT NULL
WHERE decision IN ('yes', 'maybe') AND abstract_available AND t.doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)"""
ORACLES["signal_pending"] = f"SELECT doc_id, n_tagged_sentences FROM ({ORACLES['span_index']}) WHERE has_signal AND doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 0)"
ORACLES["organism_pools"] = """SELECT d.doc_id, CASE WHEN d.doc_id % 7 = 0 THEN 'negative' WHEN toxic = 0 THEN 'table' ELSE 'other' END AS pool FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
WHERE coalesce(lang <> 'fr', true) AND d.doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 0)"""
ORACLES["open_reviews"] = "SELECT doc_id, 'PMC' || doc_id AS pmcid, 'review_seed' AS processing_status FROM documents WHERE lang = 'de' AND n_chars > 500 AND source IS NOT NULL"
ORACLES["verified_ratio"] = f"WITH {_ATTEMPTS} SELECT count(*) AS n_total, count(*) FILTER (outcome = 'unclear') AS n_unverified, count(*) FILTER (outcome <> 'unclear') AS n_verified FROM attempts"
ORACLES["run_tally"] = """WITH f AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'error' AND user_id IS NOT NULL), k AS (SELECT DISTINCT user_id FROM events WHERE event_type <> 'error' AND user_id IS NOT NULL)
SELECT count(*) AS n_papers, count(*) FILTER (user_id NOT IN (SELECT user_id FROM k)) AS n_new, count(*) FILTER (user_id IN (SELECT user_id FROM k)) AS n_enriched FROM f"""
ORACLES["packet_index"] = f"""WITH {_TAGS}, cat AS (SELECT doc_id, {", ".join(f"least(12, count(*) FILTER (category = '{c}'))::INTEGER AS n_{c}" for c in shapes.LEXICON)} FROM firsts GROUP BY 1)
SELECT doc_id, 7 AS n_sentences_total, 0 AS n_tagged_sentences, n_manipulation, n_success, n_failure, n_strain, 0 AS n_accessions, 1 AS n_strains,
  n_manipulation > 0 AND (n_success > 0 OR n_failure > 0 OR n_strain > 0) AS has_signal FROM cat"""
ORACLES["route_split"] = "SELECT o_orderkey AS n, 0 AS place, o_orderstatus AS discovery_route FROM orders UNION ALL SELECT o_orderkey, 1, o_orderpriority FROM orders WHERE o_orderstatus <> 'F'"
ORACLES["set_text"] = """SELECT user_id, '[' || string_agg(DISTINCT '"' || event_type || '"', ',' ORDER BY '"' || event_type || '"') || ']' AS sets, count(DISTINCT event_type)::INTEGER AS n FROM events GROUP BY 1"""
ORACLES["repeated_keys"] = "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) > 1"
ORACLES["stable_sample"] = "SELECT doc_id, source FROM documents ORDER BY md5('42:' || doc_id), doc_id LIMIT 50"
ORACLES["table_refs"] = """SELECT doc_id, 1 AS row_index, 'T1' AS table_label, '' AS table_caption, 'Genus sp x | see 12' AS row_text, 'Genus sp' AS organism_guess,
  CASE k WHEN 1 THEN '10.5555/' || doc_id ELSE '' END AS cited_doi, '' AS cited_pmid, CASE k WHEN 1 THEN 'First' ELSE 'Book' END AS cited_title,
  CASE k WHEN 1 THEN '1999' ELSE '' END AS cited_year, CASE k WHEN 1 THEN '' ELSE 'Book' END AS cited_source FROM documents, (VALUES (1), (2)) AS t(k) WHERE doc_id % 10 < 9"""
ORACLES["jats_sections"] = rf"""WITH lines AS (SELECT doc_id, generate_subscripts(l, 1) - 1 AS i, unnest(l) AS line FROM (
    SELECT doc_id, string_split(regexp_replace(coalesce(text, ''), '[<>&]|[^\t\n\r\x20-\x{{D7FF}}\x{{E000}}-\x{{FFFD}}\x{{10000}}-\x{{10FFFF}}]', ' ', 'g'), chr(10)) AS l FROM documents WHERE doc_id % 10 < 9)),
flat AS (SELECT doc_id, i, trim(regexp_replace(line, '\s+', ' ', 'g')) AS t FROM lines),
paras AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS paragraph FROM flat WHERE t <> ''),
cut AS (SELECT doc_id, i, paragraph, list_filter(string_split(regexp_replace(t, '([.!?]) ([A-Z("''])', '\1' || chr(1) || '\2', 'g'), chr(1)), lambda x: trim(x) <> '') AS s FROM paras),
snt AS (SELECT doc_id, i, paragraph, generate_subscripts(s, 1) AS k, unnest(s) AS sentence FROM cut)
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY paragraph, k) - 1 AS INTEGER) AS pos, CASE WHEN i % 2 = 0 THEN 'Methods' ELSE 'Results' END AS section,
  paragraph::INTEGER AS paragraph, sentence FROM snt"""
_REPLY = """
r AS (SELECT conv_id, turn, text, role, (turn + conv_id) % 6 AS kind,
  concat_ws(', ', '"organism_name": ' || to_json(role), '"evidence_text": ' || to_json(text), '"outcome": "Success"') AS o FROM conversations)"""
ORACLES["json_salvage"] = f"""WITH {_REPLY}
SELECT conv_id, turn, CASE WHEN kind < 2 THEN '[' WHEN kind < 5 THEN '{{' END AS kind, (CASE WHEN kind < 3 THEN 2 WHEN kind = 4 THEN 1 ELSE 0 END)::INTEGER AS n_objects,
  sha256(CASE WHEN kind < 3 THEN '{{' || o || '}}' || chr(10) || '{{' || o || '}}' WHEN kind = 4 THEN '{{' || o || '}}' ELSE '' END) AS objects_sha256 FROM r"""
ORACLES["extract_stub"] = f"""WITH {_REPLY},
each AS (SELECT conv_id || '-' || turn AS paper_id, role, trim(coalesce(text, ''), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS t, unnest([1, 2]) AS i FROM r WHERE kind < 2 AND coalesce(role, '') <> '')
SELECT paper_id || '-OBS0' || i AS observation_id, paper_id, role AS organism_name, '' AS strain_name, 'bacteria' AS organism_domain, 'unclear' AS wild_type_status, '' AS wild_type_evidence,
  'other' AS manipulation_category, '' AS manipulation_detail, 'unclear' AS outcome, '' AS failure_reason, t AS evidence_text, 'abstract' AS section_name, '' AS genome_accession,
  'not_checked' AS genome_match_status, 'unknown' AS marine_status, 'unknown' AS isolation_source, 'unknown' AS environment,
  CASE WHEN t = '' THEN 'evidence_unverified ' ELSE '' END || 'manipulation_category_uncertain outcome_uncertain wild_type_uncertain' AS qc_flags, '' AS notes, 'automated' AS extraction_method, '' AS llm_model FROM each"""
_BLANKS = ", ".join(f"'' AS {c}" for c in ("genus", "species", "strain", "technique_raw", "technique_normalized", "vector_or_construct", "plasmid_name", "delivery_method", "selection_method", "attempt_conditions_summary",
  "outcome_detail", "failure_reason", "failure_reason_raw", "quantitative_efficiency", "quantitative_efficiency_unit", "evidence_method", "evidence_result"))
ORACLES["attempts_stub"] = f"""WITH {_REPLY},
each AS (SELECT conv_id || '-' || turn AS paper_id, role, unnest(range(1, CASE WHEN kind < 3 THEN 3 WHEN kind = 4 THEN 2 ELSE 1 END)) AS i FROM r WHERE coalesce(role, '') <> '')
SELECT paper_id || '-ATT0' || i AS attempt_id, paper_id, role AS organism_name_raw, {_BLANKS}, 'unclear' AS wild_type_status, 'unclear' AS outcome, false AS needs_review FROM each"""
ORACLES["dedup_batches"] = f"SELECT component, n_records FROM ({ORACLES['dedup_components']})"
ORACLES["link_edges"] = "SELECT DISTINCT l_orderkey AS src, l_partkey::VARCHAR AS dst, 'reference' AS label FROM lineitem"
ORACLES["cache_warmer"] = """WITH l AS (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id)
SELECT d.doc_id AS paper_id, l.doc_id IS NOT NULL AND coalesce(text, '') <> '' AS has_abstract,
  CASE WHEN l.doc_id IS NULL THEN 'no_record' WHEN quality = 1 AND toxic = 0 THEN 'article' WHEN d.doc_id % 2 = 0 THEN 'pdf' ELSE 'abstract' END AS outcome
FROM documents d LEFT JOIN l ON d.doc_id = l.doc_id"""
ORACLES["last_events"] = "SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type FROM events WHERE user_id IS NOT NULL GROUP BY user_id"
ORACLES["observation_summary"] = "SELECT count(*) AS n_observations, count(DISTINCT p_brand) AS n_organisms, count(DISTINCT p_brand || '|' || p_type) AS n_strains FROM part"
ORACLES["titled_attempts"] = f"""WITH {_ATTEMPTS} SELECT attempt_id, paper_id, left(coalesce(o_orderpriority || ' ' || o_orderstatus, ''), 6) AS paper_title
FROM attempts LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus <> 'P') ON paper_id = o_orderkey"""
ORACLES["reference_requests"] = "SELECT doc_id AS paper_id, 'MED' AS source, 'MED/' || doc_id AS query FROM documents WHERE lang IS DISTINCT FROM 'de' AND doc_id IS NOT NULL"
