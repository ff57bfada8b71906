"""DuckDB SQL for every registered plan, written by hand from the operator
definitions (views: documents, benchmark, pages, events, ...)."""

from __future__ import annotations

# Fixed values, stated here on their own: nothing below is taken from the code under test.
TOP_K = 10
_TOK = r"[\p{L}\p{N}_]+"
# The English stop-word list of the NLTK corpus; entries with an apostrophe are left
# out, as no token can equal them.
_STOP = """
a about above after again against ain all am an and any are aren as at be because been before being below between both
but by can couldn d did didn do does doesn doing don down during each few for from further had hadn has hasn have haven
having he her here hers herself him himself his how i if in into is isn it its itself just ll m ma me mightn more most
mustn my myself needn no nor not now o of off on once only or other our ours ourselves out over own re s same shan she
should shouldn so some such t than that the their theirs them themselves then there these they this those through to
too under until up ve very was wasn we were weren what when where which while who whom why will with won wouldn y you
your yours yourself yourselves
""".split()
STOP_LIST = ", ".join("'" + w + "'" for w in _STOP)


def cte_index(src: str = "documents", p: str = "") -> str:
    """tok_all, tok, post, dl, stats, lex over table ``src`` (doc_id, text); names prefixed by ``p``."""
    return f"""
{p}tok_all AS (
  SELECT doc_id, unnest(regexp_extract_all(lower(' ' || coalesce(text, '')), '{_TOK}')) AS term FROM {src}),
{p}tok AS (SELECT doc_id, term FROM {p}tok_all WHERE term NOT IN ({STOP_LIST})),
{p}post AS (SELECT term, doc_id, count(*) AS tf FROM {p}tok GROUP BY term, doc_id),
{p}dl AS (
  SELECT d.doc_id, count(t.term) AS dl FROM {src} d LEFT JOIN {p}tok t ON t.doc_id = d.doc_id GROUP BY d.doc_id),
{p}stats AS (SELECT count(*) AS n, avg(dl::DOUBLE) AS avgdl FROM {p}dl),
{p}lex AS (SELECT term, count(*) AS df FROM {p}post GROUP BY term)"""


BENCH_Q = f"q AS (SELECT item_id AS qid, text AS query FROM benchmark)"
_EXTRA = "(-1, 'the of and'), (-2, 'zzyzxq'), (-3, 'der der der'), (-4, '')"
ALL_Q = (f"q AS (SELECT item_id AS qid, text AS query FROM benchmark "
         f"UNION ALL SELECT * FROM (VALUES {_EXTRA}) v(qid, query))")


def cte_qterms(src: str = "q") -> str:
    return f"""
qt AS (
  SELECT qid, term, count(*) AS qtf FROM (
    SELECT qid, unnest(regexp_extract_all(lower(query || ' '), '{_TOK}')) AS term FROM {src})
  WHERE term NOT IN ({STOP_LIST}) GROUP BY qid, term)"""


def bm25_expr(k1: float = 1.5, b: float = 0.75) -> str:
    return (f"ln((s.n - l.df + 0.5::DOUBLE) / (l.df + 0.5::DOUBLE) + 1.0::DOUBLE) * "
            f"(p.tf * {k1 + 1.0}::DOUBLE) / (p.tf + {k1}::DOUBLE * ({1.0 - b}::DOUBLE + {b}::DOUBLE * d.dl / s.avgdl))")


TFIDF_EXPR = "(1.0::DOUBLE + ln(p.tf::DOUBLE)) * ln(s.n::DOUBLE / l.df)"


def cte_scored(expr: str, p: str = "") -> str:
    return f"""
contrib AS (
  SELECT qt.qid, qt.term, qt.qtf, p.doc_id, {expr} AS s, qt.qtf * ({expr}) AS c
  FROM qt JOIN {p}lex l ON l.term = qt.term JOIN {p}post p ON p.term = qt.term
  JOIN {p}dl d ON d.doc_id = p.doc_id CROSS JOIN {p}stats s),
scored AS (
  SELECT qid, doc_id, sum(c) AS score, count(*) AS matched FROM contrib GROUP BY qid, doc_id HAVING sum(c) > 0)"""


def ranked_sql(src: str = "scored", k: int = TOP_K) -> str:
    return f"""(
  SELECT * FROM (
    SELECT qid, doc_id, score,
           row_number() OVER (PARTITION BY qid ORDER BY round(score, 9) DESC, doc_id DESC) AS rank
    FROM {src}) WHERE rank <= {k})"""


def topk_select(src: str = "scored", k: int = TOP_K) -> str:
    return f"SELECT qid, rank, doc_id, round(score, 4) AS score FROM {ranked_sql(src, k)}"


def cte_floor(k: int = TOP_K) -> str:
    """The reference's score floor, stated directly: documents scoring more
    than the first scored document's score, plus that document, cut at the k-th
    such score; ties at the cut admitted in doc-id order up to k."""
    return f"""
fs AS (SELECT qid, doc_id, score, round(score, 9) AS rs FROM scored),
f0 AS (SELECT qid, arg_min(rs, doc_id) AS s0, min(doc_id) AS d0 FROM fs GROUP BY qid),
fc AS (SELECT fs.* FROM fs JOIN f0 ON f0.qid = fs.qid WHERE fs.doc_id = f0.d0 OR fs.rs > f0.s0),
ft AS (
  SELECT qid, min(rs) AS t FROM (
    SELECT qid, rs, row_number() OVER (PARTITION BY qid ORDER BY rs DESC, doc_id DESC) AS r FROM fc)
  WHERE r <= {k} GROUP BY qid),
fe AS (
  SELECT fc.*, ft.t, row_number() OVER (PARTITION BY fc.qid ORDER BY fc.doc_id) AS pos
  FROM fc JOIN ft ON ft.qid = fc.qid WHERE fc.rs >= ft.t),
kept AS (SELECT qid, doc_id, score FROM fe WHERE rs > t OR pos <= {k})"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"


IDX = cte_index()
SQL: dict[str, str] = {}

# ---------------------------------------------------------------- index build
SQL["tokens"] = with_(IDX) + "SELECT doc_id, term FROM tok_all"
SQL["tokens_stop_filtered"] = with_(IDX) + "SELECT doc_id, term FROM tok"
SQL["postings"] = with_(IDX) + "SELECT term, doc_id, tf FROM post"
SQL["doc_lengths"] = with_(IDX) + "SELECT doc_id, dl FROM dl"
SQL["lexicon"] = with_(IDX) + "SELECT term, df FROM lex"
SQL["collection_stats"] = with_(IDX) + "SELECT n, round(avgdl, 6) AS avgdl FROM stats"

# ---------------------------------------------------------------- ranking
_BM25 = with_(IDX, BENCH_Q, cte_qterms(), cte_scored(bm25_expr()))
_TFIDF = with_(IDX, BENCH_Q, cte_qterms(), cte_scored(TFIDF_EXPR))
SQL["bm25_scores"] = _BM25 + "SELECT qid, term, doc_id, round(s, 6) AS s FROM contrib"
SQL["tfidf_scores"] = _TFIDF + "SELECT qid, term, doc_id, round(s, 6) AS s FROM contrib"
SQL["bm25_topk"] = _BM25 + topk_select()
SQL["bm25_topk_pruned"] = _BM25 + topk_select()
SQL["tfidf_topk"] = _TFIDF + topk_select()
SQL["bm25_topk_floor"] = with_(IDX, BENCH_Q, cte_qterms(), cte_scored(bm25_expr()), cte_floor()) + topk_select("kept")
SQL["tfidf_topk_floor"] = with_(IDX, BENCH_Q, cte_qterms(), cte_scored(TFIDF_EXPR), cte_floor()) + topk_select("kept")
SQL["bm25_topk_all_terms"] = _BM25.rstrip() + """,
need AS (SELECT qid, count(*) AS need FROM qt GROUP BY qid),
allm AS (SELECT s.qid, s.doc_id, s.score FROM scored s JOIN need n ON n.qid = s.qid WHERE s.matched = n.need)
""" + topk_select("allm")
SQL["bm25_all_terms_short"] = with_(
    IDX,
    "q AS (SELECT item_id * 10 + n AS qid, array_to_string(string_split(text, ' ')[1:n], ' ') AS query "
    "FROM benchmark, (VALUES (2), (4)) AS v(n))",
    cte_qterms(), cte_scored(bm25_expr())).rstrip() + """,
need AS (SELECT qid, count(*) AS need FROM qt GROUP BY qid),
allm AS (SELECT s.qid, s.doc_id, s.score FROM scored s JOIN need n ON n.qid = s.qid WHERE s.matched = n.need)
""" + topk_select("allm")
SQL["custom_ranker"] = with_(IDX, BENCH_Q, cte_qterms(), cte_scored(bm25_expr(1.2, 0.5))) + topk_select()
SQL["tfidf_zero_idf"] = with_(
    IDX,
    "top1 AS (SELECT term FROM lex ORDER BY df DESC, term LIMIT 1)",
    "sub AS (SELECT doc_id, text FROM documents WHERE doc_id IN "
    "(SELECT doc_id FROM post WHERE term = (SELECT term FROM top1)))",
    cte_index("sub", "z_"),
    f"q AS (SELECT item_id AS qid, text AS query FROM benchmark "
    "UNION ALL SELECT -1 AS qid, term AS query FROM top1)",
    cte_qterms(), cte_scored(TFIDF_EXPR, "z_")) + topk_select()
SQL["term_upper_bounds"] = _BM25 + "SELECT qid, term, qtf, round(max(s), 4) AS ub FROM contrib GROUP BY qid, term, qtf"
SQL["query_term_weights"] = with_(BENCH_Q, cte_qterms()) + "SELECT qid, term, qtf FROM qt"
SQL["query_known_terms"] = with_(IDX, BENCH_Q, cte_qterms()) + (
    "SELECT qt.qid, qt.term, qt.qtf, l.df FROM qt JOIN lex l ON l.term = qt.term")
SQL["postings_lookup"] = with_(IDX, BENCH_Q, cte_qterms()) + (
    "SELECT term, doc_id, tf FROM post WHERE term IN (SELECT term FROM qt)")
SQL["results_formatted"] = _BM25 + (
    f'SELECT qid, rank, printf(\'%07d\', doc_id) AS "ID", round(score, 4) AS "Score" FROM {ranked_sql()}')
_ALLQ = with_(IDX, ALL_Q, cte_qterms(), cte_scored(bm25_expr()))
SQL["results_json"] = _ALLQ + f"""
SELECT q.qid, q.query,
       coalesce(string_agg(printf('%07d', r.doc_id), ',' ORDER BY r.rank), '') AS ids,
       coalesce(string_agg(printf('%.4f', round(r.score, 4)), ',' ORDER BY r.rank), '') AS scores
FROM q LEFT JOIN {ranked_sql()} r ON r.qid = q.qid GROUP BY q.qid, q.query"""
SQL["queries_without_hits"] = _ALLQ + f"""
SELECT q.qid, count(r.doc_id) AS n_results FROM q LEFT JOIN {ranked_sql()} r ON r.qid = q.qid GROUP BY q.qid"""

# ---------------------------------------------------------------- sources and sinks
SQL["read_corpus_jsonl"] = "SELECT doc_id, '' AS title, md5(text) AS text_md5 FROM documents"
SQL["corpus_defaults"] = """
SELECT CASE WHEN lang = 'de' THEN -1 ELSE doc_id END AS doc_id,
       CASE WHEN lang = 'es' THEN '' ELSE coalesce(source, '') END AS title,
       md5(CASE WHEN lang = 'fr' THEN '' ELSE coalesce(text, '') END) AS text_md5
FROM documents"""
_WS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
SQL["queries_from_text"] = f"""
WITH items AS (SELECT item_id, string_split('  ' || text || ' ' || chr(9) || chr(10) || '   ', chr(10)) AS lines FROM benchmark),
numbered AS (SELECT item_id, unnest(lines) AS line, unnest(range(0, len(lines))) AS n FROM items)
SELECT qid, query FROM (
  SELECT row_number() OVER (ORDER BY item_id, n) - 1 AS qid, trim(line, {_WS}) AS query FROM numbered)
WHERE query <> ''"""
SQL["seeds_from_text"] = f"SELECT trim(url, {_WS}) AS url FROM pages WHERE trim(url, {_WS}) <> ''"
SQL["corpus_sample"] = "SELECT doc_id, text FROM documents ORDER BY doc_id LIMIT 3"
SQL["index_nested"] = with_(IDX) + """
SELECT term, doc_id // 1048576 AS block, string_agg(doc_id || ':' || tf, ',' ORDER BY doc_id) AS postings
FROM post GROUP BY term, doc_id // 1048576"""


def whole_index(p: str = "") -> str:
    return f"""
SELECT 'postings' AS part, x.term, x.doc_id, x.tf AS v, d.dl::DOUBLE AS w FROM {p}post x JOIN {p}dl d ON d.doc_id = x.doc_id
UNION ALL SELECT 'lexicon', term, -1, df, 0.0 FROM {p}lex
UNION ALL SELECT 'doc_lengths', '', doc_id, dl, 0.0 FROM {p}dl
UNION ALL SELECT 'stats', '', -1, n, round(avgdl, 6) FROM {p}stats"""


SQL["index_roundtrip"] = with_(IDX) + whole_index()
SQL["index_overwrite"] = with_("german AS (SELECT doc_id, text FROM documents WHERE lang = 'de')", cte_index("german", "g_")) + whole_index("g_")
SQL["index_repeated_ids"] = with_(
    "folded AS (SELECT doc_id % 97 AS doc_id, arg_max(text, doc_id) AS text FROM documents GROUP BY doc_id % 97)",
    cte_index("folded", "f_")) + whole_index("f_")
SQL["index_dir_size"] = "SELECT true AS same"
SQL["page_store_rotation"] = "SELECT true AS within, count(*) AS records, count(*) AS answered FROM pages"
_MERGE_STOP = STOP_LIST + ", 'de', 'der', 'la', 'die', 'und', 'que', 'le', 'et', 'en', 'des'"
SQL["merge_partials"] = with_(
    "b AS (SELECT max(doc_id) / 3 AS lo, max(doc_id) * 2 / 3 AS hi FROM documents)",
    f"""p0 AS (
  SELECT term, doc_id, count(*) AS tf, 0 AS part FROM (
    SELECT doc_id, unnest(regexp_extract_all(lower(' ' || coalesce(text, '')), '{_TOK}')) AS term
    FROM documents, b WHERE doc_id <= b.hi)
  WHERE term NOT IN ({STOP_LIST}) GROUP BY term, doc_id)""",
    f"""p1 AS (
  SELECT term, doc_id, count(*) AS tf, 1 AS part FROM (
    SELECT doc_id, unnest(regexp_extract_all(lower(' ' || concat_ws(' ', text, text)), '{_TOK}')) AS term
    FROM documents, b WHERE doc_id >= b.lo)
  WHERE term NOT IN ({_MERGE_STOP}) GROUP BY term, doc_id)""") + """
, both_parts AS (SELECT * FROM p0 UNION ALL SELECT * FROM p1),
lens AS (SELECT d.doc_id, CASE WHEN d.doc_id >= b.lo THEN coalesce(l1.dl, 0) ELSE coalesce(l0.dl, 0) END AS dl
  FROM documents d CROSS JOIN b
  LEFT JOIN (SELECT doc_id, sum(tf)::BIGINT AS dl FROM p0 GROUP BY doc_id) l0 ON l0.doc_id = d.doc_id
  LEFT JOIN (SELECT doc_id, sum(tf)::BIGINT AS dl FROM p1 GROUP BY doc_id) l1 ON l1.doc_id = d.doc_id),
last AS (SELECT term, doc_id, arg_max(tf, part) AS tf FROM both_parts GROUP BY term, doc_id)
SELECT last.term, last.doc_id, last.tf, lens.dl FROM last JOIN lens ON lens.doc_id = last.doc_id"""
SQL["corpus_last_wins"] = """
SELECT doc_id % 97 AS id, max(doc_id) AS seq, arg_max(source, doc_id) AS source,
       arg_max(n_chars, doc_id) AS n_chars, md5(arg_max(text, doc_id)) AS text_md5
FROM documents GROUP BY doc_id % 97"""
SQL["index_stats"] = with_(IDX) + """
SELECT count(*) AS num_lists, coalesce(sum(df), 0)::BIGINT AS total_postings,
       coalesce(round(sum(df) / count(*), 2), 0.0) AS avg_list_size FROM lex"""
SQL["lexicon_profile"] = with_(IDX) + """
SELECT count(*) AS terms, min(df) AS min_df, max(df) AS max_df, round(avg(df), 4) AS avg_df,
       count_if(df = 1)::BIGINT AS df_one, count_if(df > 100)::BIGINT AS df_over_100 FROM lex"""
SQL["corpus_profile"] = "SELECT count(*) AS documents, coalesce(sum(strlen(text)), 0)::BIGINT AS bytes FROM documents"

# ---------------------------------------------------------------- reports
_BOTH = with_(IDX, BENCH_Q, cte_qterms(),
              f"""bm AS (
  SELECT qt.qid, p.doc_id, sum(qt.qtf * ({bm25_expr()})) AS score
  FROM qt JOIN lex l ON l.term = qt.term JOIN post p ON p.term = qt.term
  JOIN dl d ON d.doc_id = p.doc_id CROSS JOIN stats s GROUP BY qt.qid, p.doc_id HAVING sum(qt.qtf * ({bm25_expr()})) > 0)""",
              f"""tf AS (
  SELECT qt.qid, p.doc_id, sum(qt.qtf * ({TFIDF_EXPR})) AS score
  FROM qt JOIN lex l ON l.term = qt.term JOIN post p ON p.term = qt.term
  JOIN dl d ON d.doc_id = p.doc_id CROSS JOIN stats s GROUP BY qt.qid, p.doc_id HAVING sum(qt.qtf * ({TFIDF_EXPR})) > 0)""",
              f"""res AS (
  SELECT 'bm25' AS ranker, qid, rank, doc_id, round(score, 4) AS score FROM {ranked_sql('bm')}
  UNION ALL
  SELECT 'tfidf' AS ranker, qid, rank, doc_id, round(score, 4) AS score FROM {ranked_sql('tf')})""")
SQL["run_report"] = _BOTH + """
SELECT r.ranker, count(*) AS queries, coalesce(sum(CASE WHEN n.n > 0 THEN 1 ELSE 0 END), 0)::BIGINT AS with_results, coalesce(sum(n.n), 0)::BIGINT AS total_results,
       round(coalesce(sum(n.n), 0) / count(*), 4) AS results_per_query,
       any_value(sc.min_score) AS min_score, any_value(sc.max_score) AS max_score, any_value(sc.avg_score) AS avg_score
FROM q CROSS JOIN (VALUES ('bm25'), ('tfidf'), ('none')) r(ranker)
LEFT JOIN (SELECT ranker, qid, count(*) AS n FROM res GROUP BY ranker, qid) n ON n.qid = q.qid AND n.ranker = r.ranker
LEFT JOIN (SELECT ranker, min(score) AS min_score, max(score) AS max_score, round(avg(score), 4) AS avg_score
           FROM res GROUP BY ranker) sc ON sc.ranker = r.ranker
GROUP BY r.ranker"""
SQL["ranker_comparison"] = _BOTH + """
SELECT round(avg(score) FILTER (WHERE ranker = 'bm25'), 4) AS bm25_avg_score,
       round(avg(score) FILTER (WHERE ranker = 'tfidf'), 4) AS tfidf_avg_score FROM res"""
SQL["ranker_overlap"] = _BOTH + """
SELECT q.qid, count(s.doc_id) AS shared FROM q LEFT JOIN (
  SELECT a.qid, a.doc_id FROM res a JOIN res b ON a.qid = b.qid AND a.doc_id = b.doc_id
  WHERE a.ranker = 'bm25' AND b.ranker = 'tfidf') s ON s.qid = q.qid GROUP BY q.qid"""
SQL["ranker_shared_docs"] = _BOTH + """
SELECT a.qid, string_agg(printf('%07d', a.doc_id), ',' ORDER BY a.doc_id) AS shared_ids
FROM res a JOIN res b ON a.qid = b.qid AND a.doc_id = b.doc_id
WHERE a.ranker = 'bm25' AND b.ranker = 'tfidf' GROUP BY a.qid"""
SQL["ranker_best"] = _BOTH + """
SELECT ranker, qid, doc_id, score FROM (
  SELECT *, rank() OVER (PARTITION BY ranker, qid ORDER BY score DESC) AS r FROM res) WHERE r = 1"""

# ---------------------------------------------------------------- pages and links
_WSC = r"[ \t\n\r\f\v\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
# Entities that the test pages use, "&amp;" last so that "&amp;lt;" gives "&lt;".
_ENTITIES = (("&quot;", '"'), ("&#34;", '"'), ("&apos;", "''"), ("&#39;", "''"), ("&lt;", "<"), ("&gt;", ">"),
             ("&copy;", "©"), ("&middot;", "·"), ("&nbsp;", "\u00a0"), ("&amp;", "&"))


def sql_decode(x: str) -> str:
    for ent, ch in _ENTITIES:
        x = f"replace({x}, '{ent}', '{ch}')"
    return x


def sql_strip(x: str) -> str:
    return f"regexp_replace({x}, '^{_WSC}+|{_WSC}+$', '', 'g')"


def sql_without_invisible(h: str = "html") -> str:
    x = f"coalesce({h}, '')"
    for tag in ("script", "style", "noscript"):
        x = f"regexp_replace({x}, '(?is)<{tag}\\b[^>]*>.*?</{tag}\\s*>', chr(1), 'g')"
    return f"regexp_replace({x}, '(?s)<!--.*?-->', chr(1), 'g')"


def sql_visible(h: str = "html") -> str:
    nodes = f"string_split(regexp_replace({sql_without_invisible(h)}, '<[^>]*>', chr(1), 'g'), chr(1))"
    return (f"array_to_string(list_filter(list_transform({nodes}, lambda n: {sql_strip(sql_decode('n'))}), "
            f"lambda n: n <> ''), ' ')")


def sql_title(h: str = "html") -> str:
    return sql_strip(sql_decode(f"regexp_extract({sql_without_invisible(h)}, '(?is)<title\\b[^>]*>(.*?)</title\\s*>', 1)"))


def sql_hrefs(h: str = "html") -> str:
    found = (f"regexp_extract_all({sql_without_invisible(h)}, "
             """'(?is)<a\\s(?:[^>]*?\\s)??href\\s*=\\s*("[^">]*"|''[^''>]*''|[^\\s"''>]+)', 1)""")
    bare = f"list_transform({found}, lambda l: CASE WHEN l[1] IN (chr(34), chr(39)) THEN l[2:len(l) - 1] ELSE l END)"
    return f"list_distinct(list_transform({bare}, lambda l: {sql_decode('l')}))"


_SCH = "[a-zA-Z][a-zA-Z0-9+.-]*"


def sql_resolve(link: str, base: str) -> str:
    origin = f"regexp_extract({base}, '^({_SCH}://[^/?#]*)', 1)"
    scheme = f"regexp_extract({base}, '^({_SCH}):', 1)"
    basedir = f"regexp_extract({base}, '^({_SCH}://[^?#]*/)', 1)"
    return f"""CASE WHEN starts_with({link}, 'http') THEN {link}
     WHEN starts_with({link}, '//') THEN {scheme} || ':' || {link}
     WHEN starts_with({link}, '/') THEN {origin} || {link}
     WHEN starts_with({link}, '?') THEN regexp_extract({base}, '^([^?#]*)', 1) || {link}
     WHEN starts_with({link}, '#') OR regexp_matches({link}, '^{_SCH}:') OR {link} = '' THEN NULL
     ELSE CASE WHEN {basedir} = '' THEN {origin} || '/' ELSE {basedir} END || {link} END"""


def sql_first_words(t: str, chars: int = 1000, words: int = 20) -> str:
    parts = f"list_filter(string_split_regex(substr({t}, 1, {chars}), '{_WSC}+'), lambda w: w <> '')"
    return f"array_to_string({parts}[1:{words}], ' ')"


SQL["page_domain"] = ("SELECT page_id, url, split_part(url, '/', 3) AS domain FROM pages "
                      "WHERE len(string_split(url, '/')) >= 3")
SQL["page_text"] = f"SELECT page_id, {sql_visible()} AS text FROM pages"
SQL["page_title"] = f"SELECT page_id, {sql_title()} AS title FROM pages"
SQL["page_links"] = f"SELECT page_id, unnest({sql_hrefs()}) AS href FROM pages"
CTE_EDGES = f"""
raw_links AS (SELECT page_id, url, unnest({sql_hrefs()}) AS href FROM pages),
edges AS (
  SELECT DISTINCT page_id, url AS src_url, dst_url FROM (
    SELECT page_id, url, {sql_resolve('href', 'url')} AS dst_url FROM raw_links)
  WHERE dst_url IS NOT NULL AND starts_with(dst_url, 'http'))"""
SQL["link_edges"] = with_(CTE_EDGES) + "SELECT page_id, dst_url FROM edges"
SQL["page_summary"] = (f"SELECT page_id, {sql_title()} AS title, url, {sql_first_words(sql_visible())} AS text "
                       "FROM pages")
SQL["pages_bm25_topk"] = with_(
    f"pdocs AS (SELECT page_id AS doc_id, {sql_title()} || ' ' || {sql_visible()} AS text FROM pages)",
    cte_index("pdocs"), BENCH_Q, cte_qterms(), cte_scored(bm25_expr())) + topk_select()

# ---------------------------------------------------------------- crawl planning
_ORIGIN = f"regexp_extract(url, '^({_SCH}://[^/?#]*)', 1)"
CTE_CAND = CTE_EDGES + f""",
seeds AS (SELECT {_ORIGIN} || '/' AS url FROM pages),
cand AS ((SELECT url FROM seeds UNION SELECT dst_url FROM edges) EXCEPT SELECT url FROM pages)"""
CTE_RULES = """
rules_t(bucket, agent, seq, allow, prefix, delay) AS (VALUES
  (1, '*', 1, false, '', 0.0::DOUBLE), (2, '*', 1, true, '/en/1', 2.0), (2, NULL, 2, false, '/en', 2.0), (2, 'otherbot', 1, false, '/', 9.0),
  (3, '*', 1, false, '/', 7.0), (3, 'TrawlBot', 1, false, '/fr', 0.5), (3, 'trawlbot', 2, false, '/es', 0.5)),
doms AS (SELECT DISTINCT split_part(url, '/', 3) AS domain FROM pages WHERE len(string_split(url, '/')) >= 3),
lines AS (SELECT d.domain, lower(coalesce(t.agent, '*')) AS agent, t.seq, t.allow, t.prefix, t.delay
          FROM doms d JOIN rules_t t ON t.bucket = length(d.domain) % 4),
chosen AS (SELECT domain, CASE WHEN bool_or(agent = 'trawlbot') THEN 'trawlbot' ELSE '*' END AS agent FROM lines GROUP BY domain),
rules AS (SELECT l.* FROM lines l JOIN chosen c ON c.domain = l.domain AND c.agent = l.agent)"""


def cte_robots(src: str) -> str:
    path = f"regexp_extract(u.url, '^{_SCH}://[^/?#]*([^#]*)', 1)"
    return f"""
ru AS (
  SELECT u.*, split_part(u.url, '/', 3) AS domain,
         CASE WHEN {path} = '' THEN '/' ELSE {path} END AS path FROM {src} u),
rj AS (
  SELECT ru.url, ru.domain, r.seq, r.allow, r.delay,
         coalesce(r.prefix <> '' AND starts_with(ru.path, r.prefix), false) AS hit
  FROM ru JOIN chosen c ON c.domain = ru.domain LEFT JOIN rules r ON r.domain = ru.domain),
allowed AS (
  SELECT url, domain, max(delay) AS delay FROM rj GROUP BY url, domain
  HAVING coalesce(arg_min(allow, seq) FILTER (WHERE hit), true))"""


SQL["frontier_unvisited"] = with_(CTE_CAND) + "SELECT url FROM cand"
SQL["frontier_topn"] = with_(CTE_CAND) + "SELECT url, md5(url) AS prio FROM cand ORDER BY prio, url LIMIT 1000"
SQL["robots_filter"] = with_(CTE_CAND, CTE_RULES, cte_robots("cand")) + "SELECT url, domain, delay FROM allowed"
SQL["politeness_plan"] = with_(
    CTE_CAND, CTE_RULES,
    "top AS (SELECT url, md5(url) AS prio FROM cand ORDER BY prio, url LIMIT 1000)",
    cte_robots("top")) + """
SELECT domain, url, pos, round(CASE WHEN length(domain) % 3 > 0 THEN greatest(0.0, wait - length(domain) % 3) ELSE 0.0 END
                               + (pos - 1) * wait, 6) AS start_s FROM (
  SELECT a.domain, a.url, coalesce(CASE WHEN a.delay > 0 THEN a.delay END, 0.1) AS wait,
         row_number() OVER (PARTITION BY a.domain ORDER BY t.prio, a.url) AS pos
  FROM allowed a JOIN top t ON t.url = a.url)"""
SQL["politeness_violations"] = """
WITH log AS (SELECT CASE WHEN event_type <> 'error' THEN user_id END AS domain, event_id, ts FROM events)
SELECT coalesce(domain, -1) AS domain, event_id, gap_s FROM (
  SELECT domain, event_id,
         round((epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY domain ORDER BY ts, event_id))) / 1e6, 6) AS gap_s
  FROM log) WHERE gap_s < CASE WHEN domain % 10 = 0 THEN 1200.0 ELSE 600.0 END"""
SQL["events_success_only"] = "SELECT event_id, user_id, event_type FROM events WHERE event_type <> 'error'"
SQL["crawl_budget"] = ("SELECT event_id, user_id, ts FROM events WHERE event_type <> 'error' "
                       "ORDER BY ts, event_id LIMIT 1000")
SQL["visited_dedup"] = with_(CTE_EDGES) + (
    "SELECT dst_url AS url, min(page_id) AS first_page, count(*) AS copies FROM edges GROUP BY dst_url")
SQL["crawl_progress"] = """
WITH f AS (SELECT ts, row_number() OVER (ORDER BY ts, event_id) AS pages FROM events WHERE event_type <> 'error'),
t0 AS (SELECT min(ts) AS t0 FROM f)
SELECT pages, round((epoch_us(ts) - epoch_us(t0)) / 1e6, 3) AS elapsed_s,
       round(pages / nullif((epoch_us(ts) - epoch_us(t0)) / 1e6, 0), 4) AS pages_per_s
FROM f, t0 WHERE pages % 50 = 0"""
SQL["pages_per_domain"] = ("SELECT split_part(url, '/', 3) AS domain, count(*) AS pages FROM pages "
                           "WHERE len(string_split(url, '/')) >= 3 GROUP BY 1")

# ---------------------------------------------------------------- streaming
SQL["stream_visited_dedup"] = with_(CTE_EDGES) + "SELECT DISTINCT dst_url AS url FROM edges"
SQL["stream_first_seen"] = with_(CTE_EDGES) + (
    "SELECT dst_url AS url, CAST(min(page_id * 3 // (SELECT max(page_id) + 1 FROM pages)) AS INTEGER) AS run FROM edges GROUP BY dst_url")
SQL["stream_politeness_rounds"] = with_(CTE_CAND, CTE_RULES, cte_robots("cand")).rstrip() + """,
placed AS (
  SELECT domain, url, coalesce(CASE WHEN delay > 0 THEN delay END, 0.1) AS wait, md5(url) AS prio,
         CASE WHEN md5(url) < '5' THEN 0 WHEN md5(url) < 'a' THEN 1 ELSE 2 END AS nth FROM allowed),
numbered AS (SELECT *, row_number() OVER (PARTITION BY domain, nth ORDER BY prio, url) AS pos FROM placed),
first AS (SELECT domain, url, pos, round((pos - 1) * wait, 6) AS at_s FROM numbered WHERE nth = 0),
last1 AS (SELECT domain, max(at_s) AS t FROM first GROUP BY domain),
second AS (
  SELECT n.domain, url, pos, round(6 + greatest(0.0, coalesce(wait - (6 - t), 0.0)) + (pos - 1) * wait, 6) AS at_s
  FROM numbered n LEFT JOIN last1 l ON l.domain = n.domain WHERE nth = 1),
last2 AS (SELECT domain, max(at_s) AS t FROM (SELECT * FROM first UNION ALL SELECT * FROM second) GROUP BY domain),
third AS (
  SELECT n.domain, url, pos, round(12 + greatest(0.0, coalesce(wait - (12 - t), 0.0)) + (pos - 1) * wait, 6) AS at_s
  FROM numbered n LEFT JOIN last2 l ON l.domain = n.domain WHERE nth = 2)
SELECT * FROM first UNION ALL SELECT * FROM second UNION ALL SELECT * FROM third"""
SQL["frontier_rounds"] = SQL["frontier_topn"]
SQL["stream_progress_closed"] = """
WITH ok AS (SELECT ts, event_id, date_trunc('hour', ts) + INTERVAL 1 HOUR AS w_end FROM events WHERE event_type <> 'error'),
timed AS (SELECT *, floor((epoch(ts)::BIGINT - epoch((SELECT min(ts) FROM ok))::BIGINT) / 3600)::BIGINT + event_id % 10 AS hour FROM ok),
placed AS (SELECT *, hour * 4 // ((SELECT max(hour) FROM timed) + 1) AS run FROM timed),
latest AS (SELECT run, max(ts) AS t FROM placed GROUP BY run),
marked AS (SELECT p.*, (SELECT max(t) FROM latest l WHERE l.run < p.run) - INTERVAL 4 HOUR AS mark FROM placed p),
judged AS (SELECT *, coalesce(w_end <= mark, false) AS late FROM marked),
windows AS (SELECT w_end, count(*) FILTER (WHERE NOT late) AS fetches, count(*) FILTER (WHERE late) AS late FROM judged GROUP BY w_end)
SELECT w_end - INTERVAL 1 HOUR AS window_start, w_end AS window_end, fetches, late
FROM windows WHERE w_end <= (SELECT max(t) FROM latest) - INTERVAL 4 HOUR"""
SQL["stream_segments"] = SQL["postings"]
SQL["segments_profile"] = with_(IDX) + (
    "SELECT count(*) AS documents, CAST(sum(dl) AS BIGINT) AS tokens, true AS terms_close, true AS median_close FROM dl")
SQL["index_versions"] = with_(
    "v AS (SELECT doc_id, CASE WHEN doc_id % 147 = 0 THEN text WHEN doc_id % 3 = 0 THEN translate(text, 'e', ' ') ELSE text END AS text "
    "FROM documents WHERE doc_id % 7 <> 0 OR doc_id % 147 = 0)",
    cte_index("v")) + "SELECT p.term, p.doc_id, p.tf, d.dl FROM post p JOIN dl d ON d.doc_id = p.doc_id"
SQL["stream_incremental_index"] = SQL["postings"]
SQL["stream_index_bm25_topk"] = SQL["bm25_topk"]
SQL["stream_progress"] = """
SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, count(*) AS fetches
FROM events WHERE event_type <> 'error' GROUP BY 1, 2"""

# ---------------------------------------------------------------- stemming
# The Snowball English rules over the distinct words, a step per table: s is the word so
# far, r1 and r2 the lengths before its regions, f whether it is finished.
_STEP2 = {"ational": "ate", "ization": "ize", "fulness": "ful", "ousness": "ous", "iveness": "ive", "tional": "tion", "biliti": "ble",
          "lessli": "less", "entli": "ent", "ation": "ate", "alism": "al", "aliti": "al", "ousli": "ous", "iviti": "ive", "fulli": "ful",
          "enci": "ence", "anci": "ance", "abli": "able", "izer": "ize", "ator": "ate", "alli": "al", "bli": "ble", "ogi": "og", "li": ""}
_STEP3 = {"ational": "ate", "tional": "tion", "alize": "al", "icate": "ic", "iciti": "ic", "ative": "", "ical": "ic", "ness": "", "ful": ""}
_STEP4 = "ement ance ence able ible ment ant ent ism ate iti ous ive ize ion al er ic".split()
_ODD = {"skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "idly": "idl", "gently": "gentl", "ugly": "ugli",
        "early": "earli", "only": "onli", "singly": "singl", "sky": "sky", "news": "news", "howe": "howe", "atlas": "atlas",
        "cosmos": "cosmos", "bias": "bias", "andes": "andes"}


def _suffix_case(table: dict[str, str], ok: dict[str, str], region: str) -> str:
    arms = " ".join(
        f"WHEN ends_with(s, '{x}') THEN CASE WHEN length(s) - {len(x)} >= {region} AND {ok.get(x, 'true')} "
        f"THEN s[:length(s) - {len(x)}] || '{y}' ELSE s END" for x, y in sorted(table.items(), key=lambda kv: -len(kv[0])))
    return f"CASE WHEN f THEN s {arms} ELSE s END"


_ODD_SQL = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in _ODD.items())
_ODD_IN = ", ".join(f"'{a}'" for a in _ODD)
CTE_STEM = f"""
st0 AS (SELECT word, word IN ({_ODD_IN}) OR length(word) <= 2 AS f,
          CASE word {_ODD_SQL} ELSE CASE WHEN length(word) <= 2 THEN word ELSE
            regexp_replace(regexp_replace(word, '^y', 'Y'), '([aeiouy])y', '\\1Y', 'g') END END AS s FROM vocab),
st1 AS (SELECT *, CASE WHEN starts_with(s, 'gener') OR starts_with(s, 'arsen') THEN 5 WHEN starts_with(s, 'commun') THEN 6
          ELSE coalesce(nullif(length(regexp_extract(s, '^.*?[aeiouy][^aeiouy]')), 0), length(s)) END AS r1 FROM st0),
st2 AS (SELECT *, r1 + coalesce(nullif(length(regexp_extract(s[r1 + 1:], '^.*?[aeiouy][^aeiouy]')), 0), length(s) - r1) AS r2 FROM st1),
st3 AS (SELECT word, r1, r2, f, CASE WHEN f THEN s WHEN ends_with(s, 'sses') THEN s[:length(s) - 2]
          WHEN ends_with(s, 'ied') OR ends_with(s, 'ies') THEN s[:length(s) - CASE WHEN length(s) > 4 THEN 2 ELSE 1 END]
          WHEN ends_with(s, 'us') OR ends_with(s, 'ss') THEN s
          WHEN ends_with(s, 's') AND regexp_matches(s[:length(s) - 2], '[aeiouy]') THEN s[:length(s) - 1] ELSE s END AS s FROM st2),
st4 AS (SELECT word, r1, r2, s,
          f OR s IN ('inning', 'outing', 'canning', 'herring', 'earring', 'proceed', 'exceed', 'succeed') AS f FROM st3),
st5 AS (SELECT *, CASE WHEN f THEN 0 WHEN ends_with(s, 'eedly') THEN -5 WHEN ends_with(s, 'ingly') THEN 5 WHEN ends_with(s, 'edly') THEN 4
          WHEN ends_with(s, 'eed') THEN -3 WHEN ends_with(s, 'ing') THEN 3 WHEN ends_with(s, 'ed') THEN 2 ELSE 0 END AS n FROM st4),
st6 AS (SELECT word, r1, r2, f, n > 0 AND regexp_matches(s[:length(s) - n], '[aeiouy]') AS cut,
          CASE WHEN n < 0 AND length(s) + n >= r1 THEN s[:length(s) + n] || 'ee'
               WHEN n > 0 AND regexp_matches(s[:length(s) - n], '[aeiouy]') THEN s[:length(s) - n] ELSE s END AS s FROM st5),
st7 AS (SELECT word, r1, r2, f, CASE WHEN NOT cut THEN s WHEN regexp_matches(s, '(at|bl|iz)$') THEN s || 'e'
          WHEN regexp_matches(s, '(bb|dd|ff|gg|mm|nn|pp|rr|tt)$') THEN s[:length(s) - 1]
          WHEN r1 >= length(s) AND regexp_matches(s, '^[aeiouy][^aeiouy]$|[^aeiouy][aeiouy][^aeiouywxY]$') THEN s || 'e' ELSE s END AS s FROM st6),
st8 AS (SELECT word, r1, r2, f, CASE WHEN NOT f AND regexp_matches(s, '^.+[^aeiouy][yY]$') THEN s[:length(s) - 1] || 'i' ELSE s END AS s FROM st7),
st9 AS (SELECT word, r1, r2, f, {_suffix_case(_STEP2, {"ogi": "ends_with(s, 'logi')", "li": "regexp_matches(s, '[cdeghkmnrt]li$')"}, "r1")} AS s FROM st8),
st10 AS (SELECT word, r1, r2, f, {_suffix_case(_STEP3, {"ative": "length(s) - 5 >= r2"}, "r1")} AS s FROM st9),
st11 AS (SELECT word, r1, r2, f, {_suffix_case(dict.fromkeys(_STEP4, ""), {"ion": "regexp_matches(s, '[st]ion$')"}, "r2")} AS s FROM st10),
stems AS (SELECT word, replace(CASE WHEN f THEN s WHEN ends_with(s, 'll') AND length(s) - 1 >= r2 THEN s[:length(s) - 1]
          WHEN ends_with(s, 'e') AND (length(s) - 1 >= r2 OR length(s) - 1 >= r1
            AND NOT regexp_matches(s[:length(s) - 1], '^[aeiouy][^aeiouy]$|[^aeiouy][aeiouy][^aeiouywxY]$')) THEN s[:length(s) - 1]
          ELSE s END, 'Y', 'y') AS stem FROM st11)"""
_STEM_INDEX = f"""
raw_all AS (SELECT doc_id, unnest(regexp_extract_all(lower(' ' || coalesce(text, '')), '{_TOK}')) AS word FROM documents),
raw_q AS (SELECT item_id AS qid, unnest(regexp_extract_all(lower(text || ' '), '{_TOK}')) AS word FROM benchmark),
vocab AS (SELECT DISTINCT word FROM (SELECT word FROM raw_all UNION ALL SELECT word FROM raw_q) WHERE word NOT IN ({STOP_LIST})),
{CTE_STEM.strip()},
tok AS (SELECT r.doc_id, st.stem AS term FROM raw_all r JOIN stems st ON st.word = r.word),
post AS (SELECT term, doc_id, count(*) AS tf FROM tok GROUP BY term, doc_id),
dl AS (SELECT d.doc_id, count(t.term) AS dl FROM documents d LEFT JOIN tok t ON t.doc_id = d.doc_id GROUP BY d.doc_id),
stats AS (SELECT count(*) AS n, avg(dl::DOUBLE) AS avgdl FROM dl),
lex AS (SELECT term, count(*) AS df FROM post GROUP BY term),
qt AS (SELECT r.qid, st.stem AS term, count(*) AS qtf FROM raw_q r JOIN stems st ON st.word = r.word GROUP BY r.qid, st.stem)"""
SQL["stemmed_postings"] = with_(_STEM_INDEX) + "SELECT term, doc_id, tf FROM post"
SQL["stemmed_bm25_topk"] = with_(_STEM_INDEX, cte_scored(bm25_expr())) + topk_select()
