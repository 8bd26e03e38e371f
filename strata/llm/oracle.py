"""SQL by which DuckDB checks the queries that SQL can express."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from strata.llm.mixing import BLOCK_ROWS, BLOCK_TOKENS, ROUNDS, STEPS, Goal
from strata.llm.sharding import _AXIS, _ENTRY, _RANK, BITS

_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _lower(text: str) -> str:
    return f"translate({text}, '{ascii_uppercase}', '{ascii_lowercase}')"


def _marked(value: str) -> str:
    return f"coalesce(length({value}::VARCHAR)::VARCHAR || ':' || {value}::VARCHAR, '-')"


def line_dedup(min_docs: int = 10) -> str:
    return f"""
WITH cut AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
lines AS (SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS place FROM cut),
keyed AS (SELECT *, {_lower(f"trim(line, {_SPACES})")} AS key FROM lines),
frequent AS (SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= {min_docs}),
judged AS (SELECT keyed.*, frequent.key IS NOT NULL AS gone FROM keyed LEFT JOIN frequent USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id"""


def near_dups(size: int = 3, percent: int = 85) -> str:
    return f"""
WITH RECURSIVE split AS (
  SELECT doc_id, list_filter(regexp_split_to_array({_lower("coalesce(text, '')")}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {size} THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - {size} + 2), lambda i: array_to_string(w[i : i + {size} - 1], ' ')) END) AS s FROM split),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= {percent} * (x.n + y.n - c)),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other)
SELECT r.doc_id, any_value(coalesce(n, 0)) AS n_shingles, min(other) AS component_id, min(other) = r.doc_id AS kept
FROM reach r LEFT JOIN sizes s ON s.doc_id = r.doc_id GROUP BY r.doc_id"""


def mixing(goal: Goal = Goal()) -> str:
    return f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, source, {_marked("source")} AS key, md5({_marked("doc_id")} || {_marked("text")} || {_marked("source")}) AS doc,
         len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')) AS own FROM documents),
units AS (SELECT doc, doc_id, source, key, sum(own)::BIGINT AS tokens FROM docs GROUP BY ALL),
sums AS (SELECT key, sum(tokens)::BIGINT AS t, count(*) AS n FROM units GROUP BY key),
logs AS (SELECT ln(t / (SELECT sum(t)::DOUBLE FROM sums)) AS l FROM sums WHERE t > 0),
shape AS (SELECT list(l) AS ls, {goal.entropy} * ln(count(*)) AS target, max(l) - min(l) AS spread FROM logs),
ends AS (SELECT *, {goal.passes} AS passes FROM shape),
search(step, low, high) AS (
  SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE
  UNION ALL
  SELECT step + 1, CASE WHEN ok THEN low ELSE mid END, CASE WHEN ok THEN mid ELSE high END FROM (
    SELECT step, low, high, (low + high) / 2 AS mid, (low + high) / 2 AS a,
      ln(list_sum(list_transform(ls, lambda x: exp((low + high) / 2 * x)))) - (low + high) / 2 * list_sum(list_transform(ls, lambda x: exp((low + high) / 2 * x) * x)) / list_sum(list_transform(ls, lambda x: exp((low + high) / 2 * x))) <= target + 1e-9
      AND (1 - (low + high) / 2) * spread <= ln(passes) + 1e-12 AS ok FROM search, ends WHERE step < {STEPS * ROUNDS})),
power AS (
  SELECT CASE WHEN ln(len(ls)) <= target + 1e-9 AND spread <= ln(passes) + 1e-12 THEN 0.0
    WHEN NOT (-list_sum(list_transform(ls, lambda x: exp(x) * x)) <= target + 1e-9) THEN 1.0
    ELSE (SELECT high FROM search WHERE step = {STEPS * ROUNDS}) END AS a FROM ends),
raised AS (SELECT key, t, n, CASE WHEN t > 0 THEN exp(a * ln(t / (SELECT sum(t)::DOUBLE FROM sums))) ELSE 0 END AS r FROM sums, power),
weights AS (
  SELECT key, t, r / (SELECT sum(r) FROM raised) AS weight,
    CASE WHEN t > 0 THEN round(r / t / (SELECT min(r / t) FROM raised WHERE t > 0), 9) ELSE 1 END AS passes, greatest(ceil(greatest(t, 1) / {BLOCK_TOKENS}), ceil(n / {BLOCK_ROWS}))::BIGINT AS blocks FROM raised),
dealt AS (SELECT units.*, weight, passes, t, ((('0x' || substr(doc, 1, 8))::BIGINT * blocks) >> 32)::INT AS block FROM units JOIN weights USING (key)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY key, block ORDER BY doc) - 1 AS place,
    coalesce(sum(tokens) OVER (PARTITION BY key ORDER BY md5(block::VARCHAR), block, doc ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM dealt)
SELECT doc_id, source, tokens, round(weight, 6) AS weight, round(passes, 6) AS passes, block, place::INT AS place,
  (floor(passes) + CASE WHEN before < (passes - floor(passes)) * t THEN 1 ELSE 0 END)::INT AS copies FROM placed"""


def contamination(window: int = 13) -> str:
    cut = f"regexp_extract_all({_lower('text')}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    return f"""
WITH d AS (SELECT doc_id, coalesce({cut}, []) AS w FROM documents),
b AS (SELECT item_id, {cut} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {window} THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - {window} + 2), lambda i: array_to_string(w[i : i + {window} - 1], ' ')) END) AS s, least(len(w), {window}) AS size FROM b),
starts AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, w FROM d),
occurs AS (
  SELECT doc_id, i, size, item_id FROM (SELECT doc_id, i, size, array_to_string(w[i : i + size - 1], ' ') AS s FROM starts, (SELECT DISTINCT size FROM windows) WHERE i + size - 1 <= len(w))
  JOIN windows USING (s, size)),
words AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS place FROM occurs) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM occurs) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)"""


def sharding(shards: int = 24) -> str:
    bin_ = lambda value: f"(('0x' || substr(md5({_marked(value)}), 1, 2))::INT % {1 << BITS})"
    turn = lambda value, by: f"((({value}) >> ({by})) | (({value}) << (3 - ({by})))) & 7"
    corner = "((d0 >> bit) & 1) | (((d1 >> bit) & 1) << 1) | (((d2 >> bit) & 1) << 2)"
    return f"""
WITH RECURSIVE rows_ AS (
  SELECT doc_id, coalesce(text, '') AS text, md5({_marked("doc_id")} || {_marked("coalesce(text, '')")}) AS doc, strlen(coalesce(text, '')) + 8 AS size,
    {bin_("source")} AS d0, {bin_("lang")} AS d1, least(floor(log2(strlen(coalesce(text, '')) + 8)), {(1 << BITS) - 1})::INT AS d2 FROM documents),
curve(d0, d1, d2, bit, place, entry, axis) AS (
  SELECT DISTINCT d0, d1, d2, {BITS - 1}, 0, 0, 0 FROM rows_
  UNION ALL
  SELECT d0, d1, d2, bit - 1, place * 8 + r, xor(entry, {turn(f"list_extract({_ENTRY}, r + 1)", "(3 - (axis + 1) % 3) % 3")}), (axis + list_extract({_AXIS}, r + 1) + 1) % 3
  FROM (SELECT *, list_extract({_RANK}, ({turn(f"xor({corner}, entry)", "(axis + 1) % 3")}) + 1) AS r FROM curve WHERE bit >= 0)),
table_(i, k, v) AS (
  SELECT range, 0, range FROM range(256) UNION ALL SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM table_ WHERE k < 8),
lookup AS (SELECT list(v ORDER BY i) AS t FROM table_ WHERE k = 8),
numbered AS (SELECT rows_.*, place AS curve, row_number() OVER (ORDER BY place, doc) - 1 AS n, count(*) OVER () AS total FROM rows_ JOIN curve USING (d0, d1, d2) WHERE bit = -1),
cut AS (SELECT *, total % {shards} AS large, total // {shards} AS small FROM numbered),
dealt AS (SELECT *, CASE WHEN n < large * (small + 1) THEN n // (small + 1) ELSE large + (n - large * (small + 1)) // greatest(small, 1) END AS shard FROM cut),
sums AS (
  SELECT doc_id, doc, xor(list_reduce(list_prepend(4294967295, list_transform(range(strlen(text)), lambda j: ('0x' || substr(h, 2 * j + 1, 2))::BIGINT)),
    lambda c, x: xor(c >> 8, list_extract(t, (xor(c, x) & 255) + 1))), 4294967295) AS crc
  FROM (SELECT doc_id, doc, text, hex(encode(text)) AS h FROM rows_), lookup)
SELECT dealt.doc_id, size, crc AS text_crc32, 'rows' AS law, shard::INT AS shard, n - (shard * small + least(shard, large)) AS slot, NULL::INT AS grown_shard, curve
FROM dealt JOIN sums USING (doc)"""


def chat() -> str:
    clean = lambda x: f"replace(replace(coalesce({x}, ''), '<|im_start|>', '< | im_start | >'), '<|im_end|>', '< | im_end | >')"
    return f"""
WITH t AS (
  SELECT *, md5(string_agg({_marked("turn")} || {_marked("role")} || {_marked("text")}, '') OVER so_far) AS p, count(*) OVER so_far AS n, count(*) OVER (PARTITION BY conv_id) AS whole
  FROM conversations WINDOW so_far AS (PARTITION BY conv_id ORDER BY turn, role, text)),
last AS (SELECT DISTINCT conv_id, p, n FROM t WHERE n = whole),
kept AS (
  SELECT min(conv_id) AS conv_id, n AS n_turns, count(*) AS copies FROM last ANTI JOIN (SELECT DISTINCT p, n FROM t WHERE n < whole) USING (p, n) GROUP BY p, n)
SELECT conv_id, n_turns, copies, (dense_rank() OVER (PARTITION BY conv_id ORDER BY b) - 1)::INT AS part, rendered FROM (
  SELECT conv_id, n_turns, copies, turn // 64 AS b,
    string_agg('<|im_start|>' || {clean("role")} || chr(10) || {clean("text")} || '<|im_end|>' || chr(10), '' ORDER BY turn, role, text) AS rendered
  FROM kept JOIN t USING (conv_id) GROUP BY ALL)"""


def warc() -> str:
    return """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
m AS (SELECT page_id, body, strlen(body) AS n, max(page_id) OVER (PARTITION BY body) AS leader FROM p)
SELECT page_id, n AS payload_bytes, sha1(body) AS payload_digest,
  CASE WHEN n >= 1000 AND page_id IS DISTINCT FROM leader THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 1000 AND page_id IS DISTINCT FROM leader THEN leader END AS refers_to FROM m"""


#: The table of CRC-32, and the checksum of a text by it; ``lookup`` has to be joined.
_CRC_TABLE = """crc_table(i, k, v) AS (
  SELECT range, 0, range FROM range(256) UNION ALL SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM crc_table WHERE k < 8),
lookup AS (SELECT list(v ORDER BY i) AS t FROM crc_table WHERE k = 8)"""


def _crc(text: str) -> str:
    codes = f"list_transform(range(strlen({text})), lambda j: ('0x' || substr(hex(encode({text})), 2 * j + 1, 2))::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295, {codes}), lambda c, x: xor(c >> 8, list_extract(t, (xor(c, x) & 255) + 1))), 4294967295)"


def _tie(role: str, text: str) -> str:
    return f"substr({role}, 1, 64), substr({text}, 1, 64), md5(length({role})::VARCHAR || ':' || {role} || {text})"


def prefix_trie() -> str:
    return f"""
WITH RECURSIVE {_CRC_TABLE},
t AS (
  SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, {_tie("role", "text")}) AS n
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)),
c AS (SELECT conv_id, count(*) AS own, {_crc("conv_id::VARCHAR")} % 4 AS h FROM t, lookup GROUP BY conv_id, lookup.t),
m AS (SELECT c.conv_id, c.h, c.conv_id - c.conv_id % 20 AS base, least(c.h, coalesce(b.own, 0)) AS taken FROM c LEFT JOIN c AS b ON b.conv_id = c.conv_id - c.conv_id % 20),
r AS (
  SELECT m.conv_id, t.n AS depth, role, text FROM m JOIN t ON t.conv_id = m.base AND t.n <= m.taken
  UNION ALL SELECT m.conv_id, t.n - m.h + m.taken, role, text FROM m JOIN t ON t.conv_id = m.conv_id AND t.n > m.h),
p AS (
  SELECT conv_id, 0 AS depth, '' AS path, '' AS above, 0 AS words FROM m
  UNION ALL SELECT conv_id, depth, string_agg(turn, '') OVER so_far, coalesce(string_agg(turn, '') OVER earlier, ''), words FROM (
    SELECT conv_id, depth, md5({_marked("role")} || {_marked("text")}) AS turn, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words FROM r)
  WINDOW so_far AS (PARTITION BY conv_id ORDER BY depth), earlier AS (PARTITION BY conv_id ORDER BY depth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
nodes AS (SELECT depth, path, min(above) AS above, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * min(words) AS saved FROM p GROUP BY depth, path),
children AS (SELECT above AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY above),
pairs AS (SELECT DISTINCT a.path AS top, b.path FROM p AS a JOIN p AS b USING (conv_id) WHERE a.depth <= b.depth),
sums AS (SELECT top, count(*) FILTER (WHERE n_children IS NULL) AS n_leaves, sum(saved) AS saved FROM pairs JOIN nodes USING (path) LEFT JOIN children USING (path) GROUP BY top),
ends AS (
  SELECT path, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids
  FROM (SELECT conv_id, path, depth = max(depth) OVER (PARTITION BY conv_id) AS last FROM p) WHERE last GROUP BY path)
SELECT nodes.conv_id, nodes.depth::BIGINT AS depth, up.conv_id AS parent_conv_id, nodes.n_convs, coalesce(n_children, 0) AS n_children, n_leaves, sums.saved::BIGINT AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM nodes LEFT JOIN nodes AS up ON up.path = nodes.above AND up.depth = nodes.depth - 1
LEFT JOIN children ON children.path = nodes.path JOIN sums ON top = nodes.path LEFT JOIN ends ON ends.path = nodes.path"""


def _repair_steps() -> str:
    """Rows (symbol, state, next state, cost, letters, inserted text) of a turn with insertions before it."""
    follows, names = (2, 2, 3, 2), {2: "user", 3: "assistant"}
    out = []
    for role in "sua?":
        for fault in ("delete", "truncated", "none"):
            for start in range(4):
                state, text = start, ""
                for inserted in range(3):
                    base, letters = 5 * inserted, "I" * inserted
                    extra, to = (5 if fault == "truncated" else 0), follows[state]
                    out.append((role, fault, start, state, base + 2, letters + "D", text, ""))
                    if fault != "delete":
                        out.append((role, fault, start, to, base + 1 + extra, letters + "R", text, names[to]))
                        if (role == "s" and state == 0) or role == {2: "u", 3: "a"}[to]:
                            out.append((role, fault, start, 1 if role == "s" else to, base + extra, letters + "K", text, ""))
                    state = to
                    text += f"\n{names[to]}:"
    cell = lambda value: str(value) if isinstance(value, int) else f"'{value}'"
    return ", ".join(f"({', '.join(map(cell, row))})" for row in out)


def structure_repair() -> str:
    return f"""
WITH RECURSIVE {_CRC_TABLE},
src AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_crc("key")} % 20 AS d
  FROM (SELECT *, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations), lookup),
hurt AS (
  SELECT conv_id, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN d = 1 THEN '' WHEN d = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE WHEN d = 3 THEN 2 ELSE 1 END)) AS again
  FROM src WHERE d <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, {_tie("role", "text")}) AS i FROM hurt),
faults AS (
  SELECT *, left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before,
    CASE WHEN trim(text, {_SPACES}) = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
      WHEN right(rtrim(text, {_SPACES}), 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'none' END AS fault FROM placed),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank,
    count(*) FILTER (WHERE fault = 'duplicate') AS duplicate, count(*) FILTER (WHERE fault = 'truncated') AS truncated,
    count(*) FILTER (WHERE i > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n FROM faults GROUP BY conv_id),
steps(role, fault, x, y, cost, letters, inserted, renamed) AS (VALUES {_repair_steps()}),
typed AS (
  SELECT conv_id, i, role, text, CASE WHEN initial IN ('s', 'u', 'a') THEN initial ELSE '?' END AS class,
    CASE WHEN fault IN ('blank', 'duplicate') THEN 'delete' ELSE fault END AS kind FROM faults),
ways(conv_id, i, x, best) AS (
  SELECT conv_id, 0::BIGINT, 0, {{'cost': 0, 'audit': '', 'out': ''}} FROM counts
  UNION ALL
  SELECT w.conv_id, w.i + 1, s.y, min({{'cost': w.best.cost + s.cost, 'audit': w.best.audit || s.letters, 'out': w.best.out || s.inserted ||
      CASE right(s.letters, 1) WHEN 'D' THEN '' WHEN 'R' THEN chr(10) || s.renamed || ':' || t.text ELSE chr(10) || t.role || ':' || t.text END}})
  FROM ways AS w JOIN typed AS t ON t.conv_id IS NOT DISTINCT FROM w.conv_id AND t.i = w.i + 1 JOIN steps AS s ON s.role = t.class AND s.fault = t.kind AND s.x = w.x
  GROUP BY w.conv_id, w.i, s.y),
ended AS (
  SELECT w.conv_id, min({{'cost': best.cost + e.cost, 'audit': best.audit || e.letters, 'out': best.out || e.inserted}}) AS best
  FROM ways AS w JOIN counts AS c ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND c.n = w.i
  JOIN (VALUES (0, 0, '', ''), (3, 0, '', ''), (2, 5, 'I', chr(10) || 'assistant:'), (1, 10, 'II', chr(10) || 'user:' || chr(10) || 'assistant:')) AS e(x, cost, letters, inserted) ON e.x = w.x
  GROUP BY w.conv_id)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(best.cost, 0)::BIGINT AS cost, coalesce(best.audit, '') AS audit, sha256(coalesce(substr(best.out, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS o LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN ended ON ended.conv_id IS NOT DISTINCT FROM o.conv_id"""


SQL = {
    "op1_line_dedup": line_dedup(),
    "op3_near_dups": near_dups(),
    "op4_mixing": mixing(),
    "op5_contamination": contamination(),
    "op7_sharding": sharding(),
    "op10_chat": chat(),
    "op11_warc": warc(),
    "op12_prefix_trie": prefix_trie(),
    "op13_structure_repair": structure_repair(),
}
