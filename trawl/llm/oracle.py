"""DuckDB SQL of the queries that SQL can express, written out on its own."""

_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _words(text: str) -> str:
    return rf"regexp_extract_all(translate(coalesce({text}, ''), {_AZ}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


SQL: dict[str, str] = {}

SQL["op2_positional_index"] = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_words('text')} AS w FROM documents),
items AS (SELECT DISTINCT item_id, {_words('text')} AS w FROM benchmark),
full_items AS (SELECT * FROM items WHERE len(w) > 0),
starts AS (SELECT item_id, w, unnest(range(0, greatest(len(w) - 10, 0) + 1)) AS s FROM full_items),
phrases AS (SELECT DISTINCT item_id, array_to_string(w[s + 1:s + 10], ' ') AS phrase, len(w[s + 1:s + 10]) AS n FROM starts),
sizes AS (SELECT DISTINCT n FROM phrases),
doc_starts AS (SELECT rid, w, n, unnest(range(0, len(w) - n + 1)) AS s FROM d, sizes WHERE len(w) >= n),
doc_windows AS (SELECT rid, s, n, array_to_string(w[s + 1:s + n], ' ') AS phrase FROM doc_starts),
found AS (SELECT x.rid, x.s, x.n, p.item_id FROM doc_windows x JOIN phrases p ON x.phrase = p.phrase AND x.n = p.n),
marked AS (SELECT DISTINCT rid, s, n FROM found),
positions AS (SELECT rid, unnest(range(s, s + n)) AS pos FROM marked),
hit AS (SELECT rid, count(DISTINCT pos) AS n_hit FROM positions GROUP BY rid),
named AS (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS item FROM found WHERE item_id IS NOT NULL),
listed AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM named GROUP BY rid),
tokens AS (SELECT rid, unnest(w) AS term, unnest(range(0, len(w))) AS pos FROM d),
freq AS (SELECT term, count(*) AS n FROM tokens GROUP BY term),
texts AS (SELECT DISTINCT array_to_string(w, ' ') AS item, w FROM full_items),
item_terms AS (SELECT DISTINCT item, unnest(w) AS term FROM texts),
seen AS (SELECT item, i.term, f.n FROM item_terms i JOIN freq f ON i.term = f.term),
shares AS (SELECT i.item FROM item_terms i LEFT JOIN seen s ON i.item = s.item AND i.term = s.term
           GROUP BY i.item HAVING count(s.term) >= 0.6 * count(*)),
counted AS (SELECT s.item, s.term, row_number() OVER (PARTITION BY s.item ORDER BY s.n, s.term) AS r
            FROM seen s JOIN shares h ON s.item = h.item),
rare AS (SELECT item, term FROM counted WHERE r <= 3),
n_rare AS (SELECT item, count(*) AS k FROM rare GROUP BY item),
near_hits AS (SELECT rid, pos, r.item, r.term FROM tokens t JOIN rare r ON t.term = r.term),
spans AS (SELECT a.rid, a.item, a.pos, count(DISTINCT b.term) AS k
          FROM near_hits a JOIN near_hits b ON a.rid = b.rid AND a.item = b.item AND b.pos BETWEEN a.pos AND a.pos + 19
          GROUP BY a.rid, a.item, a.pos),
near_items AS (SELECT DISTINCT s.rid, s.item FROM spans s JOIN n_rare n ON s.item = n.item AND s.k = n.k),
near AS (SELECT rid, count(*) AS n_near FROM near_items GROUP BY rid)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated, CAST(coalesce(n_near, 0) AS BIGINT) AS n_near
FROM d LEFT JOIN hit ON d.rid = hit.rid LEFT JOIN listed ON d.rid = listed.rid LEFT JOIN near ON d.rid = near.rid
"""

SQL["op4_pfair_mix"] = """
WITH RECURSIVE weights AS (
  SELECT * FROM (VALUES ('src0', 12), ('src1', 8), ('src2', 8), ('src3', 6), ('src4', 6), ('src5', 5), ('src6', 5),
    ('src7', 5), ('src8', 5), ('src9', 5), ('src10', 4), ('src11', 4), ('src12', 4), ('src13', 4), ('src14', 4),
    ('src15', 3), ('src16', 3), ('src17', 3), ('src18', 3), ('src19', 2), (NULL, 1)) AS v(name, q)),
classes AS (SELECT name, q, row_number() OVER (ORDER BY name NULLS LAST) AS g FROM weights),
total AS (SELECT sum(q) AS q FROM weights),
lists AS (SELECT list(q ORDER BY g) AS qs FROM classes),
run AS (
  SELECT 0 AS t, [0 FOR x IN qs] AS done, 0 AS pick FROM lists
  UNION ALL
  SELECT t + 1,
         [done[i] + CASE WHEN i = pick_next THEN 1 ELSE 0 END FOR i IN range(1, len(done) + 1)],
         pick_next
  FROM (SELECT t, done,
          list_min([CASE WHEN floor(done[i] * n / qs[i]) <= t
                         THEN ceil((done[i] + 1) * n / qs[i]) * 1000 + i END FOR i IN range(1, len(done) + 1)])::BIGINT % 1000
            AS pick_next
        FROM run, lists, (SELECT q::DOUBLE AS n FROM total)) s
  WHERE t < (SELECT q FROM total)),
sched AS (SELECT t - 1 AS t, pick AS g, done[pick] - 1 AS k FROM run WHERE t > 0),
ranked AS (
  SELECT d.doc_id, d.source, coalesce(c.g, (SELECT max(g) FROM classes)) AS g,
         row_number() OVER (PARTITION BY coalesce(c.g, (SELECT max(g) FROM classes))
                            ORDER BY md5(coalesce(CAST(d.doc_id AS VARCHAR), '')), d.doc_id, d.source) - 1 AS rank
  FROM documents d LEFT JOIN classes c ON d.source = c.name),
slots AS (
  SELECT r.doc_id, r.source, r.rank, r.rank // 32 AS block,
         ((r.rank // 32) // c.q) * (SELECT q FROM total) + s.t AS slot
  FROM ranked r JOIN classes c ON r.g = c.g JOIN sched s ON s.g = r.g AND s.k = (r.rank // 32) % c.q)
SELECT doc_id, source, CAST(block AS BIGINT) AS block, CAST(slot AS BIGINT) AS slot,
       row_number() OVER (ORDER BY slot, rank) - 1 AS position
FROM slots
"""

_SUFFIXES2 = ("('co.uk','org.uk','ac.uk','gov.uk','com.au','net.au','org.au','co.nz','co.jp','ne.jp','or.jp','com.br',"
              "'com.cn','com.mx','co.in','co.kr','co.za','com.tr','com.ar','com.tw')")


def _weight(children: str) -> str:
    """Weight of a level's prior: moments of its children (bad, n) around m."""
    return f"""(SELECT CASE WHEN coalesce(sum(n * (bad / n - m) * (bad / n - m) - m * (1 - m)), 0) <= 1e-12 THEN 1000.0
        ELSE greatest(2.0, least(1000.0, sum(m * (1 - m) * (n - 1))
             / sum(n * (bad / n - m) * (bad / n - m) - m * (1 - m)) - 1)) END AS w FROM {children} WHERE n > 0)"""


SQL["op5_host_reputation"] = rf"""
WITH p AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), ''), {_AZ}) AS host,
         coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
known AS (SELECT doc_id AS page_id, max(CASE WHEN toxic = 1 OR quality = 0 THEN 1 ELSE 0 END) AS bad
          FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
h0 AS (SELECT host, count(bad)::DOUBLE AS n, coalesce(sum(bad), 0)::DOUBLE AS bad, string_split(host, '.') AS parts
       FROM p LEFT JOIN known k ON p.page_id = k.page_id GROUP BY host),
h1 AS (SELECT host, n, bad, parts, array_to_string(parts[-2:], '.') AS two FROM h0),
hosts AS (SELECT host, n, bad,
            CASE WHEN two IN {_SUFFIXES2} THEN array_to_string(parts[-3:], '.') ELSE two END AS domain,
            CASE WHEN two IN {_SUFFIXES2} THEN two ELSE parts[-1] END AS suffix FROM h1),
domains AS (SELECT suffix, domain, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY suffix, domain),
suffixes AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM domains GROUP BY suffix),
top AS (SELECT (coalesce(sum(bad), 0) + 1.0) / (coalesce(sum(n), 0) + 2.0) AS m FROM suffixes),
s1 AS (SELECT s.*, m FROM suffixes s, top),
s2 AS (SELECT suffix, (w * m + bad) / (w + n) AS m FROM s1, {_weight('s1')}),
d1 AS (SELECT d.*, m FROM domains d JOIN s2 ON d.suffix = s2.suffix),
d2 AS (SELECT suffix, domain, (w * m + bad) / (w + n) AS m FROM d1, {_weight('d1')}),
h2 AS (SELECT h.host, h.n, h.bad, m FROM hosts h JOIN d2 ON h.suffix = d2.suffix AND h.domain = d2.domain),
h3 AS (SELECT host, n, bad, (w * m + bad) / (w + n) AS m, w + n AS size FROM h2, {_weight('h2')}),
h4 AS (SELECT host, n, bad, m, greatest(0.0, m - 1.645 * sqrt(m * (1 - m) / (size + 1))) AS low FROM h3),
fits AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM p)
SELECT f.page_id, f.host, f.path, f.rule,
       CASE WHEN f.rule IN ('net/', 'example.com/de/') THEN 'block' WHEN f.rule IS NOT NULL THEN 'allow'
            WHEN round(h.low, 6) > 0.5 THEN 'block' ELSE 'allow' END AS verdict,
       CAST(h.n AS BIGINT) AS n_labelled, CAST(h.bad AS BIGINT) AS n_bad,
       round(h.m, 6) AS bad_mean, round(h.low, 6) AS bad_low
FROM fits f JOIN h4 h ON f.host = h.host
"""

SQL["op8_countmin_windows"] = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
starts AS (SELECT rid, doc_id, w, unnest(range(0, len(w) - 12)) AS s FROM d WHERE len(w) >= 13),
win AS (SELECT rid, doc_id, s, array_to_string(w[s + 1:s + 13], ' ') AS k FROM starts),
firsts AS (SELECT k, min(doc_id) AS m FROM win GROUP BY k HAVING count(*) > 1),
bad AS (SELECT DISTINCT rid, unnest(range(s, s + 13)) AS pos FROM win JOIN firsts ON win.k = firsts.k WHERE m < doc_id),
words AS (SELECT rid, unnest(w) AS word, unnest(range(0, len(w))) AS pos FROM d),
kept AS (SELECT words.rid, string_agg(word, ' ' ORDER BY words.pos) AS t, count(*) AS n
         FROM words LEFT JOIN bad ON words.rid = bad.rid AND words.pos = bad.pos WHERE bad.rid IS NULL GROUP BY words.rid)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept ON d.rid = kept.rid
"""

_RECORD = r"""concat('WARC/1.0', chr(13), chr(10), 'WARC-Type: response', chr(13), chr(10), 'WARC-Record-ID: <urn:page:', page_id,
  '>', chr(13), chr(10), 'WARC-Target-URI: ', url, chr(13), chr(10), 'Content-Length: ', strlen(coalesce(html, '')),
  chr(13), chr(10), chr(13), chr(10), html, chr(13), chr(10), chr(13), chr(10))"""


def _replica(pages: str) -> str:
    return f"""SELECT file, page_id, length, digest,
         coalesce(sum(length) OVER (PARTITION BY file ORDER BY page_id, digest
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS off
  FROM (SELECT printf('pages-%08d.warc', coalesce(floor(page_id / 500)::BIGINT, -1)) AS file, page_id,
               strlen({_RECORD}) AS length, sha256({_RECORD}) AS digest FROM {pages}) r"""


SQL["op10_merkle_fixity"] = f"""
WITH hashed AS (SELECT page_id, url, html, coalesce(('0x' || substring(md5(CAST(page_id AS VARCHAR)), 1, 4))::INT, 0) AS h FROM pages),
damaged AS (
  SELECT page_id, url, CASE WHEN h % 8 = 1 THEN concat('#', substring(html, 2)) WHEN h % 32 = 2 THEN substring(html, 3) ELSE html END AS html
  FROM hashed WHERE h % 32 <> 3
  UNION ALL SELECT page_id, coalesce(url, '') || '#copy', html FROM hashed WHERE h % 64 = 4),
a AS ({_replica('pages')}), b AS ({_replica('damaged')}),
na AS (SELECT *, row_number() OVER (PARTITION BY file, page_id, digest ORDER BY off) AS copy FROM a),
nb AS (SELECT *, row_number() OVER (PARTITION BY file, page_id, digest ORDER BY off) AS copy FROM b),
matched AS (
  SELECT coalesce(na.file, nb.file) AS file, coalesce(na.page_id, nb.page_id) AS page_id, na.off AS o1, nb.off AS o2
  FROM na FULL JOIN nb ON na.file = nb.file AND na.page_id IS NOT DISTINCT FROM nb.page_id AND na.digest = nb.digest AND na.copy = nb.copy),
keyed AS (SELECT *, ('0x' || substring(md5(coalesce(CAST(page_id AS VARCHAR), '')), 1, 8))::BIGINT AS k FROM matched),
lone1 AS (SELECT *, row_number() OVER (PARTITION BY file, page_id ORDER BY o1) AS copy FROM keyed WHERE o2 IS NULL),
lone2 AS (SELECT *, row_number() OVER (PARTITION BY file, page_id ORDER BY o2) AS copy FROM keyed WHERE o1 IS NULL)
SELECT file, 'moved' AS status, min(o1) AS "offset", max(o1) AS last_offset, o2 - o1 AS shift, count(*) AS n_records,
       '' AS record_id, CAST(sum(k) AS BIGINT) AS ids_sum
FROM keyed WHERE o1 <> o2 GROUP BY file, o2 - o1
UNION ALL
SELECT coalesce(x.file, y.file), CASE WHEN y.file IS NULL THEN 'missing' WHEN x.file IS NULL THEN 'extra' ELSE 'changed' END,
       coalesce(x.o1, y.o2), coalesce(x.o1, y.o2), coalesce(y.o2 - x.o1, 0), 1, coalesce(CAST(coalesce(x.page_id, y.page_id) AS VARCHAR), ''), coalesce(x.k, y.k)
FROM lone1 x FULL JOIN lone2 y ON x.file = y.file AND x.page_id IS NOT DISTINCT FROM y.page_id AND x.copy = y.copy
"""


def _leaf(n_chars: str) -> str:
    fields = ["doc_id", "source", "lang", n_chars, "text"]
    return "sha256(" + " || ".join(
        f"CASE WHEN {f} IS NULL THEN '-' ELSE strlen(CAST({f} AS VARCHAR)) || ':' || CAST({f} AS VARCHAR) END" for f in fields) + ")"


SQL["op12_merkle_manifest"] = f"""
WITH RECURSIVE crc_steps AS (
  SELECT range AS byte, 0 AS k, range::UBIGINT AS c FROM range(256)
  UNION ALL
  SELECT byte, k + 1, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END FROM crc_steps WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY byte) AS t FROM crc_steps WHERE k = 8),
numbered AS (
  SELECT row_number() OVER () AS rid, doc_id, source, lang, n_chars, text,
         list_prepend(4294967295::UBIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: ascii(x)::UBIGINT)) AS b
  FROM documents),
crcs AS (
  SELECT n.*, xor(list_reduce(b, lambda a, x: xor(a >> 8, t[(xor(a, x) % 256)::BIGINT + 1])), 4294967295::UBIGINT) AS crc FROM numbered n, crc_table),
leaves AS (
  SELECT rid, doc_id, lang, {_leaf('n_chars')} AS leaf,
         CASE WHEN crc % 7 = 0 THEN {_leaf('(n_chars + 1)')} ELSE {_leaf('n_chars')} END AS start FROM crcs),
placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM leaves),
levels AS (
  SELECT lang, 0 AS l, list(leaf ORDER BY place) AS nodes FROM placed GROUP BY lang
  UNION ALL
  SELECT lang, l + 1, [sha256(nodes[2 * i + 1] || coalesce(nodes[2 * i + 2], '')) FOR i IN range(0, (len(nodes) + 1) // 2)]
  FROM levels WHERE len(nodes) > 1),
subroots AS (SELECT lang, nodes[1] AS subroot, l AS depth FROM levels WHERE len(nodes) = 1),
langs AS (SELECT *, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place FROM subroots),
upper AS (
  SELECT 0 AS l, list(subroot ORDER BY place) AS nodes FROM langs
  UNION ALL
  SELECT l + 1, [sha256(nodes[2 * i + 1] || coalesce(nodes[2 * i + 2], '')) FOR i IN range(0, (len(nodes) + 1) // 2)]
  FROM upper WHERE len(nodes) > 1),
root AS (SELECT nodes[1] AS root FROM upper WHERE len(nodes) = 1),
steps AS (
  SELECT p.rid, v.l, nodes[xor(p.place >> v.l, 1) + 1] AS sibling, (p.place >> v.l) % 2 = 0 AS is_left
  FROM placed p JOIN levels v ON p.lang IS NOT DISTINCT FROM v.lang WHERE len(v.nodes) > 1
  UNION ALL
  SELECT p.rid, g.depth + v.l, nodes[xor(g.place >> v.l, 1) + 1], (g.place >> v.l) % 2 = 0
  FROM placed p JOIN langs g ON p.lang IS NOT DISTINCT FROM g.lang, upper v WHERE len(v.nodes) > 1),
folds AS (
  SELECT rid, 0 AS l, start AS node FROM placed
  UNION ALL
  SELECT f.rid, f.l + 1, CASE WHEN sibling IS NULL THEN sha256(node) WHEN is_left THEN sha256(node || sibling) ELSE sha256(sibling || node) END
  FROM folds f JOIN steps s ON f.rid = s.rid AND f.l = s.l),
ends AS (SELECT rid, arg_max(node, l) AS folded_root FROM folds GROUP BY rid),
proofs AS (SELECT rid, sha256(coalesce(string_agg(sibling, '' ORDER BY l), '')) AS proof_sha256 FROM steps GROUP BY rid)
SELECT p.doc_id, p.leaf, g.subroot, root.root, coalesce(f.proof_sha256, sha256('')) AS proof_sha256, e.folded_root,
       e.folded_root = root.root AS verified
FROM placed p JOIN langs g ON p.lang IS NOT DISTINCT FROM g.lang JOIN ends e ON e.rid = p.rid
  LEFT JOIN proofs f ON f.rid = p.rid, root
"""

SQL["op13_rtree_negatives"] = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, list_inner_product(a.q, r.q)::BIGINT AS score
  FROM v a JOIN v r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
negatives AS (
  SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS rank
  FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT s.same
  WHERE 80 * positive_score <= 100 * s.score AND s.score <= positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= 5
"""
