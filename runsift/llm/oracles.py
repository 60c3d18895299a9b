"""DuckDB SQL that must agree with the queries, where SQL can say it.

The others (packing, fingerprints, token files, classifier, SimHash, decontamination, quality rules) need a tokenizer, XXH64
or a model; tests compare them with brute-force versions.
"""

from __future__ import annotations

from runsift.llm.common import LOWER, UPPER
from runsift.llm.licenses import RULES, SENTENCES, known_sentences
from runsift.llm.line_dedup import MIN_CHARS
from runsift.llm.phrases import MIN_COUNT, NESTED_PERCENT, SCORE_SCALE, TOP
from runsift.llm.registered import AWKWARD_CONVERSATION, AWKWARD_TEXT, URL_RULES


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _values(rows: list[tuple[str, ...]]) -> str:
    return ", ".join("(" + ", ".join(map(_text, row)) + ")" for row in rows)


OP1 = f"""
WITH rules(action, rule_host, rule_path) AS (VALUES {_values(URL_RULES)}),
cut AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
),
parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut
),
fit AS (
  SELECT page_id, rule_host || rule_path AS rule, action,
         row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host || rule_path) DESC) AS n
  FROM parts JOIN rules
    ON (host = rule_host OR suffix(host, '.' || rule_host)) AND starts_with(path, rule_path)
)
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.action, 'allow') AS verdict
FROM parts p LEFT JOIN fit f ON f.page_id = p.page_id AND f.n = 1
"""

_ESCAPED = "replace(replace(replace({0}, '\\', '\\\\'), '</', '<\\/'), '##', '#\\#')"
OP2 = f"""
WITH given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES ({AWKWARD_CONVERSATION}, 0, 'user', {_text(AWKWARD_TEXT)}),
                   ({AWKWARD_CONVERSATION}, 1, 'assistant', {_text(AWKWARD_TEXT)})
),
turns AS (
  SELECT *, 4 + length(replace({_ESCAPED.format("role")}, chr(10), '\\n')) + 1
            + length({_ESCAPED.format("text")}) + 8 AS chars,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS n,
         count(*) OVER (PARTITION BY conv_id) AS n_turns
  FROM given
),
running AS (SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY n) AS so_far FROM turns)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (role = 'assistant'), '')) AS loss_sha256,
       (sum(so_far) FILTER (role = 'assistant' OR n = n_turns))::BIGINT AS formatted_chars
FROM running GROUP BY conv_id
"""

OP6 = f"""
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
placed AS (
  SELECT doc_id, u.i AS line_no, lines[u.i] AS line, row_number() OVER (ORDER BY doc_id, u.i) AS pos
  FROM split, unnest(range(1, len(lines) + 1)) AS u(i)
),
texts AS (SELECT line, length(line) AS size, min(pos) AS pos FROM placed
  WHERE trim(line, ' ' || chr(9) || chr(13)) <> '' GROUP BY line),
halves AS (
  SELECT *, c, s.side, CASE s.side WHEN 0 THEN left(line, c // 2) ELSE right(line, c - c // 2) END AS half
  FROM (SELECT *, unnest([size, size - 1]) AS c FROM texts WHERE size >= {MIN_CHARS}), (VALUES (0), (1)) AS s(side)
),
pairs AS (
  SELECT DISTINCT a.line AS late, b.line AS early,
         list_max(list_filter(range(0, least(a.size, b.size) + 1), lambda i: left(a.line, i) = left(b.line, i))) AS same
  FROM halves a JOIN halves b ON a.c = b.c AND a.side = b.side AND a.half = b.half AND a.pos > b.pos
),
near AS (
  SELECT DISTINCT late FROM pairs
  WHERE CASE length(late) - length(early)
          WHEN 0 THEN substr(late, same + 2) = substr(early, same + 2)
          WHEN 1 THEN substr(late, same + 2) = substr(early, same + 1)
          WHEN -1 THEN substr(late, same + 1) = substr(early, same + 2)
          ELSE false END
),
judged AS (
  SELECT p.*, t.line IS NOT NULL AND (t.pos < p.pos OR n.late IS NOT NULL) AS gone
  FROM placed p LEFT JOIN texts t ON t.line = p.line LEFT JOIN near n ON n.late = p.line
)
SELECT doc_id, count(*) FILTER (NOT gone) AS lines_kept, count(*) FILTER (gone) AS lines_dropped,
       coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (NOT gone), '') AS text
FROM judged GROUP BY doc_id
"""


def _license_sql() -> str:
    known = known_sentences(SENTENCES)
    cases = " ".join(f"WHEN {_text(sentence)} THEN {_text(name)}" for sentence, name in known.items())
    found = "sentence_ids"
    for steps, license_id in RULES:
        found = f"replace({found}, {_text(''.join(f'<{s}>' for s in steps))}, {_text('{' + license_id + '}')})"
    space = "[ \\t\\r\\n\\f]"
    return f"""
WITH marked AS (
  SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(coalesce(text, ''),
    '([.!?;:]["'')]?){space}+', '\\1' || chr(1), 'g'), '\\n[ \\t\\r\\f]*\\n', chr(1), 'g'),
    '\\n([ \\t/*#;-]*[A-Z][a-z ])', chr(1) || '\\1', 'g') AS t
  FROM documents
),
cut AS (
  SELECT doc_id, list_filter(list_transform(string_split(t, chr(1)), lambda s:
    trim(regexp_replace(translate(s, '{UPPER}', '{LOWER}'), '[^a-z0-9]+', ' ', 'g'))), lambda s: length(s) > 2) AS parts
  FROM marked
),
named AS (
  SELECT doc_id, regexp_replace(array_to_string(list_transform(parts, lambda s:
    '<' || CASE s {cases} ELSE '?' END || '>'), ''), '(<\\?>)+', '<?>', 'g') AS sentence_ids
  FROM cut
),
ruled AS (SELECT *, regexp_extract_all({found}, '\\{{([^}}]*)\\}}', 1) AS names FROM named)
SELECT doc_id, sentence_ids,
       array_to_string(list_filter(names, lambda x, i: list_position(names, x) = i), ',') AS licenses
FROM ruled
"""


# Levels of the manifest's trees that the SQL builds: up to 8^7 rows of a language, 8^3 languages.
_LEVELS, _TOP_LEVELS = 7, 3


def _encoded(column: str) -> str:
    return f"CASE WHEN {column} IS NULL THEN '-' ELSE strlen({column}::VARCHAR) || ':' || {column} END"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(map(_encoded, ("doc_id", "source", "lang", "n_chars", text))) + ")"


# crc32 of the id's digits, bit by bit.
_CRC = """xor(4294967295, list_reduce(
  list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
  lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
                                lambda x, step: xor(x >> 1, (x & 1) * 3988292384))))"""


def _tree(prefix: str, levels: int) -> str:
    """Level tables {prefix}1.. over {prefix}0 (grp, n, r, h) and, per node, its siblings left and right.

    A group with one node keeps it on every further level.
    """
    parts = []
    for k in range(levels):
        run = "PARTITION BY grp, r // 8 ORDER BY r ROWS BETWEEN"
        parts.append(
            f"{prefix}{k}s AS (SELECT *, n > {8**k} AS more,"
            f" coalesce(string_agg(h, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS lft,"
            f" coalesce(string_agg(h, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS rgt FROM {prefix}{k})"
        )
        parts.append(
            f"{prefix}{k + 1} AS (SELECT grp, n, r // 8 AS r, CASE WHEN n > {8**k} THEN sha256(string_agg(h, '' ORDER BY r))"
            f" ELSE min(h) END AS h FROM {prefix}{k} GROUP BY grp, n, r // 8)"
        )
    return ",\n".join(parts)


def _way(start: str, prefix: str, levels: int, out: str) -> str:
    """Carry (grp, r, fold, beside) of {start} up through the levels."""
    parts, last = [], start
    for k in range(levels):
        parts.append(
            f"{out}{k} AS (SELECT w.* REPLACE (CASE WHEN s.more THEN sha256(s.lft || w.fold || s.rgt) ELSE w.fold END AS fold,"
            f" w.beside || CASE WHEN s.more THEN s.lft || s.rgt ELSE '' END AS beside, w.r // 8 AS r)"
            f" FROM {last} w JOIN {prefix}{k}s s ON s.grp = w.grp AND s.r = w.r)"
        )
        last = f"{out}{k}"
    return ",\n".join(parts)


OP11 = f"""
WITH leaves AS (
  SELECT doc_id, coalesce('+' || lang, '') AS grp, {_leaf("text")} AS leaf,
         CASE WHEN {_CRC} % 3 = 0 THEN {_leaf(f"translate(text, '{UPPER}', '{LOWER}')")} ELSE {_leaf("text")} END AS seen
  FROM documents
),
d AS (
  SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r,
         count(*) OVER (PARTITION BY grp) AS n
  FROM leaves
),
a0 AS (SELECT grp, n, r, leaf AS h FROM d),
{_tree("a", _LEVELS)},
subroots AS (SELECT grp AS name, h AS subroot, row_number() OVER (ORDER BY grp) - 1 AS place FROM a{_LEVELS}),
b0 AS (SELECT '' AS grp, (SELECT count(*) FROM subroots) AS n, place AS r, subroot AS h FROM subroots),
{_tree("b", _TOP_LEVELS)},
start AS (SELECT doc_id, leaf, grp, r, seen AS fold, '' AS beside FROM d),
{_way("start", "a", _LEVELS, "u")},
middle AS (
  SELECT u.doc_id, u.leaf, s.subroot, '' AS grp, s.place AS r, u.fold, u.beside
  FROM u{_LEVELS - 1} u JOIN subroots s ON s.name = u.grp
),
{_way("middle", "b", _TOP_LEVELS, "v")}
SELECT v.doc_id, v.leaf, v.subroot, t.h AS root, sha256(v.beside) AS proof_sha256, v.fold AS folded_root,
       v.fold = t.h AS verified
FROM v{_TOP_LEVELS - 1} v CROSS JOIN b{_TOP_LEVELS} t
"""

OP13 = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(text, '{UPPER}', '{LOWER}'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents
),
cut AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM cut GROUP BY lang),
spans AS (
  SELECT lang, k.k AS k, array_to_string(list_slice(w, i.i, i.i + k.k - 1), ' ') AS phrase
  FROM cut, (SELECT unnest(range(1, 5)) AS k) k, unnest(range(1, len(w) - k.k + 2)) AS i(i)
),
f AS (SELECT lang, k, phrase, count(*)::HUGEINT AS f FROM spans GROUP BY ALL HAVING count(*) >= {MIN_COUNT}),
cand AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k >= 2),
cuts AS (
  SELECT c.lang, c.phrase, c.a, x.f AS l, y.f AS r, {SCORE_SCALE} * c.a // (x.f + y.f) AS score,
         row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY {SCORE_SCALE} * c.a // (x.f + y.f), j.j) AS place
  FROM cand c, unnest(range(1, c.k)) AS j(j)
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(list_slice(c.w, 1, j.j), ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(list_slice(c.w, j.j + 1, c.k), ' ')
),
held AS (
  SELECT c.lang, array_to_string(list_slice(c.w, i.i, i.i + s.s - 1), ' ') AS phrase, max(c.a) AS most
  FROM cand c, unnest(range(2, c.k)) AS s(s), unnest(range(1, c.k - s.s + 2)) AS i(i)
  GROUP BY ALL
),
ranked AS (
  SELECT c.*, row_number() OVER (PARTITION BY c.lang ORDER BY c.score DESC, c.a DESC, c.phrase) AS rank
  FROM cuts c LEFT JOIN held h ON h.lang = c.lang AND h.phrase = c.phrase
  WHERE c.place = 1 AND (h.most IS NULL OR 100 * h.most < {NESTED_PERCENT} * c.a)
)
SELECT r.lang, r.rank::BIGINT AS rank, r.phrase, r.a::BIGINT AS a, r.l::BIGINT AS l, r.r::BIGINT AS r, t.n,
       r.score::BIGINT AS score
FROM ranked r JOIN totals t ON t.lang = r.lang WHERE r.rank <= {TOP}
"""

ORACLES: dict[str, str] = {
    "op1_url_filter": OP1,
    "op2_chat_format": OP2,
    "op6_line_dedup": OP6,
    "op10_license_scan": _license_sql(),
    "op11_merkle_manifest": OP11,
    "op13_phrase_mining": OP13,
}
