"""DuckDB SQL of the registered queries that SQL can express."""

from __future__ import annotations

# crc32 of the decimal digits of a column, four bits at a time; of numbers of up to 19 digits and a sign
_NIBBLES = [0, 0x1DB71064, 0x3B6E20C8, 0x26D930AC, 0x76DC4190, 0x6B6B51F4, 0x4DB26158, 0x5005713C]
_NIBBLES += [x ^ 0xEDB88320 for x in _NIBBLES]


def crc32(column: str) -> str:
    """The unsigned crc32 of a whole number as text; null for null."""
    table = "[" + ", ".join(f"{x}::ubigint" for x in _NIBBLES) + "]"
    digits = f"list_transform(string_split({column}::varchar, ''), lambda c: ascii(c)::ubigint)"

    def half(crc: str) -> str:
        return f"xor({crc} >> 4, {table}[(({crc} & 15) + 1)::bigint])"

    step = half(half("xor(crc, byte)"))
    return f"CASE WHEN {column} IS NOT NULL THEN xor(list_reduce(list_prepend(4294967295::ubigint, {digits}), lambda crc, byte: {step}), 4294967295::ubigint) END"


def _overlap_join(width: int = 3, percent: int = 90) -> str:
    shingle = " || ' ' || ".join(f"w[i + {k}]" for k in range(width))
    return f"""
WITH RECURSIVE lowered AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN []::varchar[] WHEN len(w) < {width} THEN [array_to_string(w, ' ')]
    ELSE list_sort(list_distinct(list_transform(range(1, len(w) - {width - 2}), lambda i: {shingle}))) END AS s
  FROM lowered),
classes AS (SELECT min(doc_id) AS doc_id, s, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY s),
postings AS MATERIALIZED (SELECT doc_id, n, unnest(s) AS x FROM classes),
links AS MATERIALIZED (
  SELECT a.doc_id AS u, b.doc_id AS v FROM postings a JOIN postings b
    ON a.x = b.x AND a.doc_id <> b.doc_id AND least(a.n, b.n) * 100 >= greatest(a.n, b.n) * {percent}
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= {percent} * (a.n + b.n - count(*))),
reached AS (SELECT doc_id AS u, doc_id AS v FROM classes UNION SELECT r.u, l.v FROM reached r JOIN links l ON r.v = l.u),
least AS (SELECT u, min(v) AS component_id FROM reached GROUP BY u)
SELECT t.doc_id, len(t.s)::bigint AS n_shingles, coalesce(m.component_id, t.doc_id) AS component_id
FROM sets t LEFT JOIN classes c ON t.s = c.s LEFT JOIN least m ON m.u = c.doc_id
"""


def _merkle_manifest(levels: int = 9, top_levels: int = 3) -> str:
    """Trees of up to 8 ** levels rows, 8 ** top_levels languages."""

    def value(x: str) -> str:
        return f"coalesce(strlen({x}::varchar) || ':' || {x}::varchar, '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join([*map(value, ("doc_id", "source", "lang", "n_chars")), value(text)]) + ")"

    def levels_of(name: str, tree: str, count: int) -> str:
        """The nodes of each level of the trees named by `tree`, with the digests left and right of them."""
        parts = [f"{name}0 AS (SELECT *, count(*) OVER (PARTITION BY {tree}) AS total FROM {name})"]
        for k in range(count):
            parts.append(
                f"""{name}{k + 1} AS (SELECT {tree}, place // 8 AS place, sha256(string_agg(digest, '' ORDER BY place)) AS digest,
  count(*) OVER (PARTITION BY {tree}) AS total FROM {name}{k} WHERE total > 1 GROUP BY {tree}, place // 8)"""
            )
        return ",\n".join(parts)

    def steps(name: str, tree: str, count: int) -> str:
        """(tree, level, place, run of digests) of every level that is not a root's."""
        one = " UNION ALL ".join(
            f"SELECT {tree}, {k} AS level, place // 8 AS run, list(digest ORDER BY place) AS run_digests FROM {name}{k} WHERE total > 1 GROUP BY {tree}, place // 8"
            for k in range(count)
        )
        return f"{name}_runs AS MATERIALIZED ({one})"

    def roots(name: str, tree: str, count: int) -> str:
        return " UNION ALL ".join(f"SELECT {tree}, digest FROM {name}{k} WHERE total = 1" for k in range(count + 1))

    return f"""
WITH RECURSIVE leaves AS MATERIALIZED (
  SELECT doc_id, lang, {leaf("text")} AS digest,
    CASE WHEN {crc32("doc_id")} % 3 = 0 THEN {leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS altered
  FROM documents),
rows AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, digest) - 1 AS place FROM leaves),
low AS (SELECT lang, place, digest FROM rows),
{levels_of("low", "lang", levels)},
{steps("low", "lang", levels)},
subroots AS MATERIALIZED ({roots("low", "lang", levels)}),
langs AS MATERIALIZED (SELECT 0 AS t, lang, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place, digest FROM subroots),
top AS (SELECT t, place, digest FROM langs),
{levels_of("top", "t", top_levels)},
{steps("top", "t", top_levels)},
root AS ({roots("top", "t", top_levels)}),
steps AS (
  SELECT r.lang, r.place, s.level, s.run_digests, (r.place // pow(8, s.level)::bigint) % 8 + 1 AS spot
  FROM rows r JOIN low_runs s ON r.lang IS NOT DISTINCT FROM s.lang AND s.run = r.place // pow(8, s.level + 1)::bigint
  UNION ALL
  SELECT r.lang, r.place, 100 + s.level, s.run_digests, (l.place // pow(8, s.level)::bigint) % 8 + 1
  FROM rows r JOIN langs l ON r.lang IS NOT DISTINCT FROM l.lang JOIN top_runs s ON s.run = l.place // pow(8, s.level + 1)::bigint),
paths AS (
  SELECT lang, place, list({{'l': array_to_string(list_slice(run_digests, 1, spot - 1), ''), 'r': array_to_string(list_slice(run_digests, spot + 1, 8), '')}} ORDER BY level) AS path
  FROM steps GROUP BY lang, place),
folds AS (
  SELECT r.doc_id, r.lang, r.digest, coalesce(r.altered, r.digest) AS seen, coalesce(p.path, []) AS path
  FROM rows r LEFT JOIN paths p ON r.lang IS NOT DISTINCT FROM p.lang AND r.place = p.place),
found AS (
  SELECT *, list_reduce(list_prepend({{'l': seen, 'r': ''}}, path), lambda a, s: {{'l': sha256(s.l || a.l || s.r), 'r': ''}}).l AS folded_root FROM folds)
SELECT f.doc_id, f.digest AS leaf, s.digest AS subroot, root.digest AS root,
  sha256(array_to_string(list_transform(f.path, lambda s: s.l || s.r), '')) AS proof_sha256, f.folded_root, f.folded_root = root.digest AS verified
FROM found f JOIN subroots s ON f.lang IS NOT DISTINCT FROM s.lang, root
"""


def _quotation_linking(sentence_words: int = 3) -> str:
    marks = r"^[ \t]*((?:>[ \t]?)+)"

    def normal(text: str) -> str:
        return rf"trim(regexp_replace(lower({text}), '[^\p{{L}}\p{{N}}]+', ' ', 'g'))"

    def sources(units: str) -> str:
        return f"""
  SELECT q.r, q.c, q.t, q.level, q.run, q.normal, max(o.t) AS source
  FROM {units} q JOIN {units} o ON o.c = q.c AND o.normal = q.normal AND o.level = 0 AND o.t < q.t
  WHERE q.level > 0 GROUP BY ALL"""

    return rf"""
WITH RECURSIVE messages AS (
  SELECT row_number() OVER () AS r, conv_id AS c, turn::integer AS t, role, coalesce(text, '') AS text FROM conversations),
split AS (
  SELECT r, c, t, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS i FROM messages),
lines AS (
  SELECT r, c, t, i, line, length(regexp_replace(regexp_extract(line, '{marks}', 1), '[^>]', '', 'g')) AS level,
    regexp_replace(line, '{marks}', '') AS body
  FROM split),
announced AS (
  SELECT *, regexp_matches(body, '^On .*wrote:[ \t]*$') AND coalesce(lead(level) OVER line_order, 0) > level AS announces
  FROM lines WINDOW line_order AS (PARTITION BY r ORDER BY i)),
blanks AS (SELECT *, announces OR {normal("body")} = '' AS blank FROM announced),
begun AS (
  SELECT *, coalesce(lag(blank) OVER line_order OR lag(level) OVER line_order <> level, true) AS begins
  FROM blanks WINDOW line_order AS (PARTITION BY r ORDER BY i)),
runs AS (SELECT *, sum(begins::integer) OVER (PARTITION BY r ORDER BY i) AS run FROM begun),
passages AS (
  SELECT r, c, t, level, run, string_agg(body, ' ' ORDER BY i) AS text
  FROM runs WHERE NOT blank AND c IS NOT NULL AND t IS NOT NULL GROUP BY r, c, t, level, run),
wholes AS (SELECT r, c, t, level, run, {normal("text")} AS normal FROM passages),
whole_sources AS ({sources("wholes")}),
parts AS (
  SELECT r, c, t, level, run, {normal("part")} AS normal
  FROM (SELECT p.*, unnest(string_split_regex(p.text, '[.!?]+(\s+|$)')) AS part FROM passages p)
  WHERE len(string_split({normal("part")}, ' ')) >= {sentence_words}
    AND (level = 0 OR (r, run) NOT IN (SELECT (r, run) FROM whole_sources))),
-- a sentence said twice in a passage counts twice
part_counts AS (SELECT r, run, normal, count(*) AS n FROM parts WHERE level > 0 GROUP BY ALL),
part_sources AS (
  SELECT s.*, n FROM ({sources("(SELECT DISTINCT * FROM parts)")}) s JOIN part_counts USING (r, run, normal)),
linked AS (
  SELECT c, t, level, source, sum(n) AS n, sum(n * len(string_split(normal, ' '))) AS n_words
  FROM (SELECT *, 1 AS n FROM whole_sources UNION ALL SELECT * FROM part_sources) GROUP BY ALL),
outermost AS (SELECT c, t, min(level) AS level, sum(n) AS n_linked FROM linked GROUP BY ALL),
replies AS (
  SELECT l.c, l.t, o.n_linked, arg_max(l.source, {{'w': l.n_words, 's': l.source}}) AS reply_turn
  FROM linked l JOIN outermost o USING (c, t, level) GROUP BY ALL),
threads AS (
  SELECT r.c, r.t, r.reply_turn AS thread_turn FROM replies r
  WHERE NOT EXISTS (SELECT 1 FROM replies above WHERE above.c = r.c AND above.t = r.reply_turn)
  UNION ALL
  SELECT r.c, r.t, threads.thread_turn FROM replies r JOIN threads ON threads.c = r.c AND threads.t = r.reply_turn),
own AS (SELECT r, string_agg(line, chr(10) ORDER BY i) AS text FROM announced WHERE level = 0 AND NOT announces GROUP BY r),
placed AS (
  SELECT m.c AS conv_id, m.t AS turn, m.role, p.reply_turn, coalesce(th.thread_turn, m.t) AS thread_turn, coalesce(p.n_linked, 0)::bigint AS n_linked,
    coalesce(own.text, '') AS text, m.r
  FROM messages m LEFT JOIN replies p USING (c, t) LEFT JOIN threads th USING (c, t) LEFT JOIN own ON own.r = m.r)
SELECT conv_id, turn, role, reply_turn, thread_turn, n_linked,
  CASE WHEN conv_id IS NOT NULL AND turn IS NOT NULL THEN row_number() OVER (PARTITION BY conv_id, turn IS NULL ORDER BY thread_turn, turn, r) END AS position, text
FROM placed
"""


ORACLES: dict[str, str] = {
    "op3_quotation_linking": _quotation_linking(),
    "op11_overlap_join": _overlap_join(),
    "op13_merkle_manifest": _merkle_manifest(),
}
