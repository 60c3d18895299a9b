"""SQL over the given tables that each registered query must agree with.

Written from the definition of each operator, apart from the Spark code: no shared plan pieces.
"""

from __future__ import annotations

from runsift.schemas import LETTER_JOINS, NUMBER_JOINS, QUERY_PIECE, SPECIAL_CHARS, WORD_CHARS
from runsift.sources.adapters import SHAPES


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


# Tokens without looking around: a sign is put behind each mark that joins letters or digits (twice, as two joins may
# share a letter), a token may hold marks with the sign only, and the sign is taken out again.
_SIGN = chr(0xE000)
_JOINED = f"[{WORD_CHARS}]+(?:[{LETTER_JOINS}{NUMBER_JOINS}]{_SIGN}[{WORD_CHARS}]+)*"


def _signed(text: str) -> str:
    for before, joins, after in (
        (r"[\p{L}\p{M}]", LETTER_JOINS, r"\p{L}"),
        (r"\p{N}", NUMBER_JOINS, r"\p{N}"),
    ) * 2:
        found = _quoted(f"({before})([{joins}])({after})")
        text = rf"regexp_replace({text}, {found}, '\1\2{_SIGN}\3', 'g')"
    return text


def _parts(text: str, pattern: str = _JOINED) -> str:
    found = f"regexp_extract_all({_signed(text)}, {_quoted(pattern)})"
    return f"list_transform({found}, lambda w: replace(w, '{_SIGN}', ''))"


_FIRST_WORD = r"regexp_extract(trim(q), '^\S+', 0)"
_SPECIAL = _quoted(f"[{SPECIAL_CHARS}]")


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


# -- documents and postings ---------------------------------------------------------------------

_DOCS = """docs AS (
  SELECT source AS project, doc_id AS number, source AS j, CAST(doc_id AS VARCHAR) AS n,
         '#' || doc_id AS d, lang || ' ' AS p, text AS c FROM documents)"""

_TOKS = f"""toks AS (
  SELECT project, number, field, unnest(t) AS term FROM (
    SELECT project, number, 'j' AS field, {_parts('j')} AS t FROM docs
    UNION ALL SELECT project, number, 'n', [n] FROM docs
    UNION ALL SELECT project, number, 'd', {_parts('d')} FROM docs
    UNION ALL SELECT project, number, 'p', {_parts('p')} FROM docs
    UNION ALL SELECT project, number, 'c', {_parts('c')} FROM docs))"""

_POST = """post AS (
  SELECT project, number, field, term, count(*) AS tf FROM toks GROUP BY ALL),
dlen AS (SELECT project, number, field, sum(tf) AS dl FROM post GROUP BY ALL),
fstat AS (SELECT field, count(*) AS n_docs, avg(dl) AS avg_len FROM dlen GROUP BY field),
tstat AS (SELECT field, term, count(*) AS df FROM post GROUP BY ALL)"""


def _digests(tokens: str) -> str:
    return f"""SELECT doc_id, len(t) AS n_tokens, len(list_distinct(t)) AS n_distinct,
      coalesce(list_max(list_transform(t, lambda x: length(x))), 0) AS longest,
      md5(array_to_string(t, '|')) AS tokens_md5
    FROM (SELECT doc_id, {tokens} AS t FROM documents)"""


# -- queries --------------------------------------------------------------------------------------


def _q(shapes: tuple[str, ...], extra: str = "") -> str:
    def fill(shape: str) -> str:
        text = _quoted(shape)
        for w in ("w3", "w4", "w5"):
            text = f"replace({text}, '{{{w}}}', {w})"
        for name, value in (("{all}", "line"), ("{any}", "array_to_string(t, ' OR ')")):
            text = f"replace({text}, '{name}', {value})" if name in shape else text
        return text

    union = " UNION ALL ".join(
        f"SELECT item_id * 100 + {i} AS qid, {fill(s)} AS q FROM bench" for i, s in enumerate(shapes)
    )
    return f"""bench AS (
  SELECT item_id, coalesce(t[3], 'none') AS w3, coalesce(t[4], 'none') AS w4,
         coalesce(t[5], 'none') AS w5, t, replace(replace(text, chr(10), ' '), '"', '') AS line
  FROM (SELECT item_id, text, {_parts('text')} AS t FROM benchmark)),
q AS ({union}{extra})"""


_PIECE = _quoted(QUERY_PIECE)

# kind 'f' is the full query, 'r' the query without its first word.
_CLAUSES = rf"""tries AS (
  SELECT qid, 'f' AS kind, q FROM q
  UNION ALL
  SELECT qid, 'r', regexp_extract(trim(q), '^\S+\s+((?s:.*))$', 1) FROM q
  WHERE regexp_matches(trim(q), '^\S+\s+\S')),
pc AS (
  SELECT qid, kind, unnest(range(1, len(x) + 1)) AS i, unnest(a) AS f, unnest(x) AS t
  FROM (SELECT qid, kind, regexp_extract_all(q, {_PIECE}, 1) AS a,
               regexp_extract_all(q, {_PIECE}, 2) AS x FROM tries)),
wd AS (
  SELECT qid, kind, i, k, CASE WHEN k = 1 AND coalesce(f, '') <> '' THEN f END AS f, w
  FROM (SELECT qid, kind, i, f, unnest(range(1, len(ws) + 1)) AS k, unnest(ws) AS w
        FROM (SELECT qid, kind, i, f,
                     list_filter(regexp_split_to_array(t, '\s+'), lambda x: x <> '') AS ws FROM pc))),
wn AS (
  SELECT qid, kind, row_number() OVER (PARTITION BY qid, kind ORDER BY i, k) AS pos, f, w,
         CASE WHEN f IS NULL AND w IN ('AND', 'OR', 'NOT') THEN w END AS op FROM wd),
wl AS (
  SELECT *, lag(op, 1) OVER v AS p1, lag(op, 2) OVER v AS p2,
         pos = max(pos) OVER (PARTITION BY qid, kind) AS is_last
  FROM wn WINDOW v AS (PARTITION BY qid, kind ORDER BY pos)),
valid AS (
  SELECT qid, kind, NOT bool_or(coalesce(
      (f IS NOT NULL AND (w IN ('AND', 'OR', 'NOT')
         OR regexp_matches(f, '^[+\-!]?:$')
         OR regexp_matches(regexp_replace(left(f, len(f) - 1), '^[+\-!]', ''), {_SPECIAL})
         OR (p1 = 'NOT' AND regexp_matches(f, '^[+\-!]'))))
      OR (op IN ('AND', 'OR') AND (pos = 1 OR p1 IS NOT NULL))
      OR (op = 'NOT' AND p1 = 'NOT')
      OR (op IS NOT NULL AND is_last), false)) AS ok
  FROM wl GROUP BY qid, kind),
cw AS (
  SELECT qid, kind, pos,
         coalesce(p1 = 'NOT', false) OR coalesce(regexp_matches(f, '^[\-!]'), false) AS neg,
         CASE WHEN p1 = 'NOT' THEN p2 ELSE p1 END AS conj,
         CASE WHEN f IS NOT NULL THEN regexp_replace(left(f, len(f) - 1), '^[+\-!]', '') END AS field,
         {_parts('w')} AS terms
  FROM wl WHERE op IS NULL),
cn AS (
  SELECT *, row_number() OVER v - 1 AS clause_no, lead(conj) OVER v AS next_conj
  FROM cw WHERE len(terms) > 0 WINDOW v AS (PARTITION BY qid, kind ORDER BY pos)),
cl AS (
  SELECT cn.qid, cn.kind, clause_no, field, terms,
         CASE WHEN neg THEN 'must_not' WHEN next_conj = 'OR' THEN 'should'
              WHEN next_conj = 'AND' THEN 'must' WHEN conj = 'OR' THEN 'should' ELSE 'must' END AS occur
  FROM cn JOIN valid v ON v.qid = cn.qid AND v.kind = cn.kind AND v.ok)"""

_MODE = rf"""jobword AS (
  SELECT q.qid, {_parts(_FIRST_WORD)} AS jt
  FROM q JOIN valid f ON f.qid = q.qid AND f.kind = 'f' AND f.ok
         JOIN valid r ON r.qid = q.qid AND r.kind = 'r' AND r.ok
  WHERE regexp_extract(trim(q), '^\S+', 0) NOT IN ('AND', 'OR', 'NOT')),
jobtok AS (SELECT DISTINCT source AS project, unnest({_parts('source')}) AS term
           FROM documents),
jm AS (
  SELECT DISTINCT w.qid FROM
    (SELECT DISTINCT qid, unnest(jt) AS term, len(list_distinct(jt)) AS n FROM jobword) w
    JOIN jobtok USING (term) GROUP BY w.qid, project, n HAVING count(*) = n),
mode AS (SELECT q.qid, jm.qid IS NOT NULL AS job_mode FROM q LEFT JOIN jm ON jm.qid = q.qid),
force AS (
  SELECT c.qid, clause_no, occur, field, terms FROM cl c JOIN mode m ON m.qid = c.qid
  WHERE c.kind = CASE WHEN m.job_mode THEN 'r' ELSE 'f' END)"""

_SCORED = """want AS (
  SELECT DISTINCT qid, clause_no, occur, unnest(fields) AS field, term, n FROM (
    SELECT qid, clause_no, occur,
           CASE WHEN field IS NULL THEN ['j', 'd', 'p', 'c'] ELSE [field] END AS fields,
           unnest(terms) AS term, len(list_distinct(terms)) AS n FROM force)
  UNION ALL
  SELECT DISTINCT jm.qid, -1, 'job', 'j', unnest(jt), len(list_distinct(jt))
  FROM jobword JOIN jm ON jm.qid = jobword.qid),
found AS (
  SELECT w.qid, w.clause_no, w.occur, w.n, w.term, p.project, p.number,
         ln(1 + (f.n_docs - t.df + 0.5) / (t.df + 0.5))
           * p.tf / (p.tf + 1.2 * (0.25 + 0.75 * l.dl / f.avg_len)) AS weight
  FROM want w JOIN post p ON p.field = w.field AND p.term = w.term
       JOIN tstat t ON t.field = w.field AND t.term = w.term
       JOIN fstat f ON f.field = w.field
       JOIN dlen l ON l.project = p.project AND l.number = p.number AND l.field = p.field),
sat AS (
  SELECT qid, clause_no, occur, project, number, sum(weight) AS weight
  FROM found GROUP BY qid, clause_no, occur, n, project, number HAVING count(DISTINCT term) = n),
needs AS (SELECT qid, count(*) FILTER (occur = 'must') AS n_must FROM force GROUP BY qid),
scored AS (
  SELECT s.qid, s.project, s.number,
         round(sum(weight) FILTER (occur <> 'must_not'), 4) AS score
  FROM sat s JOIN needs ON needs.qid = s.qid JOIN mode m ON m.qid = s.qid
  GROUP BY s.qid, s.project, s.number, n_must, job_mode
  HAVING count(*) FILTER (occur = 'must_not') = 0
     AND count(*) FILTER (occur = 'must') = n_must
     AND (n_must > 0 OR count(*) FILTER (occur = 'should') > 0)
     AND (NOT job_mode OR count(*) FILTER (occur = 'job') = 1)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, project, number) AS rank
  FROM scored)"""


def _search(shapes: tuple[str, ...], extra: str = "") -> str:
    return _with(_DOCS, _TOKS, _POST, _q(shapes, extra), _CLAUSES, _MODE, _SCORED)


def _matches(*shapes: str) -> str:
    return _search(shapes) + "SELECT qid, project, number FROM scored"


_RANKED = ("{w3} {w4} {w5}", "{w3} OR {w4}", "src1 {w3}")
_PAGED = ("{w3} OR {w4} OR {w5}",)
_EVEN = "CAST(regexp_extract(project, '(\\d+)$', 1) AS INTEGER) % 2 = 0"

_JOBS = """jobs AS (
  SELECT DISTINCT source AS full_name, source AS name, 'root' AS parent_name FROM documents
  UNION ALL
  SELECT DISTINCT 'idle/' || source, 'idle-' || source, 'idle' FROM documents)"""


def _paged(name: str) -> str:
    return f"""paged AS (
  SELECT r.*, CAST(ceil(rank / 100.0) AS BIGINT) AS page, {name} AS search_name
  FROM ranked r),
kept AS (
  SELECT * FROM paged
  QUALIFY row_number() OVER (PARTITION BY qid, page, search_name ORDER BY rank DESC) = 1)"""


_FIRST_PAGE = """page1 AS (
  SELECT qid, project || '#' || number AS search_name, project, number FROM ranked WHERE rank <= 100)"""

# -- fragments --------------------------------------------------------------------------------------

_FRAGMENTS = rf"""hits AS (SELECT qid, project, number FROM ranked WHERE rank <= 100),
marks AS (SELECT qid, list_distinct(flatten(list(terms))) AS terms FROM force
          WHERE occur <> 'must_not' GROUP BY qid),
cut AS (
  SELECT project, number, unnest(range(1, len(x) + 1)) AS i, unnest(x) AS piece
  FROM (SELECT project, number,
               {_parts('c', _JOINED + '|[^' + WORD_CHARS + ']+')} AS x
        FROM docs WHERE (project, number) IN (SELECT (project, number) FROM hits))),
placed AS (
  SELECT *, sum(length(piece)) OVER (PARTITION BY project, number ORDER BY i) // 100 AS frag
  FROM cut),
lists AS (SELECT project, number, frag, list(piece ORDER BY i) AS parts FROM placed GROUP BY ALL),
fs AS (
  SELECT h.qid, l.project, l.number, l.frag, l.parts, m.terms,
         len(list_intersect(list_distinct(l.parts), m.terms)) AS score
  FROM hits h JOIN marks m ON m.qid = h.qid
       JOIN lists l ON l.project = h.project AND l.number = h.number),
top AS (
  SELECT *, row_number() OVER (PARTITION BY qid, project, number ORDER BY score DESC, frag) AS place
  FROM fs WHERE score > 0 QUALIFY place <= 5),
txt AS (
  SELECT qid, project, number, frag, place,
         array_to_string(list_transform(parts, lambda x: CASE WHEN list_contains(terms, x)
           THEN '<B>' || x || '</B>' ELSE x END), '') AS text,
         frag - row_number() OVER (PARTITION BY qid, project, number ORDER BY frag) AS island
  FROM top),
isl AS (
  SELECT qid, project, number, island, min(place) AS place, string_agg(text, '' ORDER BY frag) AS text
  FROM txt GROUP BY ALL)"""

_FRAGMENT_SHAPES = ("{w3} {w4} {w5}", "{w3} NOT {w4}", "p:fr {w3}")

# -- maintenance --------------------------------------------------------------------------------

_STATE = "SELECT project, number, p, md5(c) AS c_md5 FROM "
_OLD = "old AS (SELECT project, number, 'old ' AS p, c FROM docs WHERE number % 3 <> 0)"

_EVENTS = """ev AS (
  SELECT event_id AS seq,
         CASE event_type WHEN 'error' THEN 'run_deleted' WHEN 'purchase' THEN 'job_deleted'
              WHEN 'signup' THEN 'changed' ELSE 'completed' END AS op,
         'u' || user_id AS project, CAST(props ->> '$.k' AS BIGINT) AS number,
         event_type || ' ' AS p, 'value ' || CAST(value AS VARCHAR) AS c
  FROM events),
gone AS (SELECT project, max(seq) AS deleted_seq FROM ev WHERE op = 'job_deleted' GROUP BY project),
lastop AS (
  SELECT * FROM ev WHERE op <> 'job_deleted'
  QUALIFY row_number() OVER (PARTITION BY project, number ORDER BY seq DESC) = 1)"""

_LATEST = (
    _with(_EVENTS)
    + """SELECT l.project, number, seq, '#' || number AS d, p, c
  FROM lastop l LEFT JOIN gone g ON g.project = l.project
  WHERE op IN ('completed', 'changed') AND (deleted_seq IS NULL OR seq > deleted_seq)"""
)

_ERRORS = """errors AS (
  SELECT d.source AS project, d.doc_id AS number,
         CASE WHEN toxic = 1 THEN 'toxic log' ELSE 'poor log' END AS reason
  FROM documents d JOIN labels l ON l.doc_id = d.doc_id WHERE toxic = 1 OR quality = 0)"""

_REPORT = """report AS (
  SELECT j.full_name,
         CASE WHEN lower(parent_name) <> 'root' THEN parent_name || ' >> ' || name ELSE name END AS name,
         CASE WHEN e.n IS NULL THEN 'COMPLETE' ELSE 'COMPLETE_WITH_ERROR' END AS state,
         coalesce(r.n, 0) AS current, coalesce(r.n, 0) AS max, coalesce(e.reason, '') AS reason
  FROM jobs j
  LEFT JOIN (SELECT source, count(*) AS n FROM documents GROUP BY source) r ON r.source = j.full_name
  LEFT JOIN (SELECT project, count(*) AS n, arg_max(reason, number) AS reason
             FROM errors GROUP BY project) e ON e.project = j.full_name)"""

_TESTS = """texts AS (
  SELECT d.source AS project, d.doc_id AS number, coalesce(t.text, '') AS u, coalesce(a.text, '') AS a
  FROM documents d
  LEFT JOIN (SELECT conv_id, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn) AS text
             FROM conversations GROUP BY conv_id) t ON t.conv_id = d.doc_id
  LEFT JOIN (SELECT page_id, string_agg(url || ' ' || html || ' ', '' ORDER BY url) AS text
             FROM pages GROUP BY page_id) a ON a.page_id = d.doc_id)"""

_WILD_SHAPES = ("{w3}", "{w4}", "{w5}", "{w4}")


def _piece_terms(which: str) -> str:
    """Postings and tokens per term of the failed tests of some runs."""
    return (
        _with(_TESTS)
        + f"""SELECT 'unittest' AS field, term, count(*) AS n_postings, CAST(sum(tf) AS BIGINT) AS n_tokens,
        count(*) AS df FROM (
        SELECT number, term, count(*) AS tf FROM (
          SELECT number, unnest({_parts('u')}) AS term FROM texts WHERE {which})
        GROUP BY number, term) GROUP BY term"""
    )


ORACLES: dict[str, str] = {
    "extract_fields": _with(_DOCS) + "SELECT project, number, j, n, d, p, md5(c) AS c_md5 FROM docs",
    "parameter_text": """SELECT doc_id AS number,
        CASE WHEN doc_id % 5 <> 0 THEN lang || ' null ' || n_chars || ' ' END AS p FROM documents""",
    "tokenize": _digests(f"{_parts('text')}"),
    "tokenize_custom": _digests(
        r"""flatten(list_transform(regexp_extract_all(text, '[^\s,.]+'),
            lambda x: regexp_extract_all(x, '(?s).{1,255}')))"""
    ),
    "tokenize_max_len": _digests(
        r"regexp_extract_all(regexp_replace(text, '[^\p{L}\p{M}\p{N}_]+', '', 'g'), '.{1,255}')"
    ),
    "stopword_filter": _with(_DOCS, _TOKS)
    + f"""SELECT project, number, count(*) AS n_left, count(DISTINCT term) AS n_distinct FROM toks
      WHERE field = 'c' AND term NOT IN (
        SELECT unnest({_parts('text')}) FROM benchmark)
      GROUP BY project, number""",
    "postings": _with(_DOCS, _TOKS, _POST)
    + """SELECT project, number, field, count(*) AS n_terms, CAST(sum(tf) AS BIGINT) AS n_tokens,
        CAST(sum(tf) AS BIGINT) AS dl, CAST(sum(tf * tf) AS BIGINT) AS sum_sq,
        min(term) AS first_term, max(term) AS last_term
      FROM post GROUP BY ALL""",
    "positions": _with(_DOCS)
    + f"""SELECT field, term, count(*) AS n, CAST(sum(pos) AS BIGINT) AS sum_pos, max(pos) AS max_pos
      FROM (SELECT field, unnest(t) AS term, unnest(range(len(t))) AS pos FROM (
        SELECT f.field, {_parts("CASE f.field WHEN 'j' THEN j WHEN 'd' THEN d WHEN 'p' THEN p ELSE c END")} AS t
        FROM docs, (VALUES ('j'), ('d'), ('p'), ('c')) f(field)))
      GROUP BY field, term""",
    "term_stats": _with(_DOCS, _TOKS, _POST) + "SELECT field, term, df FROM tstat",
    "field_stats": _with(_DOCS, _TOKS, _POST)
    + "SELECT field, n_docs, round(avg_len, 6) AS avg_len FROM fstat",
    "doc_lengths": _with(_DOCS, _TOKS, _POST)
    + "SELECT project, number, field, CAST(dl AS BIGINT) AS dl FROM dlen",
    "index_update": _search(_RANKED)
    + "SELECT qid, project, number, score, rank FROM ranked WHERE rank <= 100",
    "update_with_stop_words": _with(_DOCS, _TOKS)
    + f"""SELECT field, term, count(DISTINCT (project, number)) AS df FROM toks
      WHERE term NOT IN (SELECT unnest({_parts('text')}) FROM benchmark) GROUP BY field, term""",
    "update_with_pieces": _piece_terms("true"),
    "update_keeps_pieces": _piece_terms("number % 3 <> 0"),
    "index_pieces": _with(_TESTS)
    + f"""SELECT project, number, field, count(*) AS n_terms, CAST(sum(tf) AS BIGINT) AS n_tokens,
        CAST(sum(tf) AS BIGINT) AS dl FROM (
        SELECT project, number, field, term, count(*) AS tf FROM (
          SELECT project, number, 'unittest' AS field, unnest({_parts('u')}) AS term
          FROM texts
          UNION ALL
          SELECT project, number, 'artifact', unnest({_parts('a')}) FROM texts)
        GROUP BY ALL) GROUP BY project, number, field""",
    "query_pieces": _with(_q(SHAPES), _CLAUSES)
    + "SELECT qid, i - 1 AS i, coalesce(f, '') AS field, t AS text FROM pc WHERE kind = 'f'",
    "query_escape": _with(_q(SHAPES), _CLAUSES)
    + f"""SELECT qid, trim(string_agg(coalesce(f, '')
        || regexp_replace(t, {_quoted(f"([{SPECIAL_CHARS}])")}, '\\\\\\1', 'g'), ' ' ORDER BY i)) AS escaped
      FROM pc WHERE kind = 'f' GROUP BY qid""",
    "query_occur": _with(_q(SHAPES), _CLAUSES)
    + """SELECT qid, clause_no, occur, coalesce(field, '') AS field,
        array_to_string(list_filter(terms, lambda x, i: list_position(terms, x) = i), ' ') AS terms
      FROM cl WHERE kind = 'f'""",
    "query_validity": _with(_q(SHAPES), _CLAUSES)
    + "SELECT qid, ok AS valid FROM valid WHERE kind = 'f'",
    "query_job_mode": _with(_q(SHAPES), _CLAUSES, _MODE)
    + """SELECT m.qid, job_mode, CASE WHEN job_mode THEN array_to_string(jt, ' ') ELSE '' END AS job_terms
      FROM mode m LEFT JOIN jobword w ON w.qid = m.qid""",
    "query_show_console": _with(_q(SHAPES), _CLAUSES, _MODE)
    + """SELECT m.qid, coalesce(bool_or(f.qid IS NOT NULL AND (field IS NULL OR field = 'c')), false)
        AS show_console FROM mode m LEFT JOIN force f ON f.qid = m.qid GROUP BY m.qid""",
    "match_term": _matches("{w3}"),
    "match_all": _matches("{w3} {w4} {w5}", "{w3} AND {w5}"),
    "match_whole_items": _matches("{all}", "{any}"),
    "match_any": _matches("{w3} OR {w4} OR {w5}", "{w3} AND {w4} OR {w5}"),
    "match_not": _matches("{w3} NOT {w4}", "NOT {w3}", "-c:{w3} {w4}", "{w3} OR NOT {w5}"),
    "match_field": _matches("c:{w3} j:src1", "p:fr c:{w4}", "n:7", "d:12", "+c:{w3} !p:en"),
    "match_unknown_field": _matches("zz:{w3} {w4}", "zz:{w3} OR {w4}", "NOT zz:{w3} {w4}"),
    "match_multi_token": _matches("c:{w3}/{w4}", "{w3}-{w5}", "j:src1/src1 {w3}", 'c:"{w3} {w4}"'),
    "match_job_mode": _matches("src1 {w3}", "src1 {w3} OR {w4}", "src2 NOT {w3}", "src1 AND {w3}"),
    "match_every_shape": _matches(*SHAPES),
    "bm25_topk": _search(_RANKED)
    + "SELECT qid, project, number, score, rank FROM ranked WHERE rank <= 100",
    "first_hit": _search(_RANKED) + "SELECT qid, project, number, score FROM ranked WHERE rank = 1",
    "page_2_keyset": _search(_PAGED)
    + """SELECT qid, project, number, score, rank - 100 AS rank FROM ranked
      WHERE rank > 100 AND rank <= 200""",
    "rank_every_hit": _search(_PAGED)
    + "SELECT qid, project, number, rank, CAST(ceil(rank / 100.0) AS BIGINT) AS page FROM ranked",
    "page_navigation": _search(_PAGED)
    + """SELECT qid, count(*) AS n_hits, CAST(ceil(count(*) / 100.0) AS BIGINT) AS last_page
      FROM scored GROUP BY qid""",
    "page_dedupe": _search(_PAGED).rstrip()
    + ",\n" + _paged("project || '#' || number % 7") + "\n"
    + "SELECT qid, page, search_name, project, number, rank FROM kept",
    "page_order": _search(_PAGED).rstrip()
    + ",\n" + _paged("project || '#' || number") + "\n"
    + """SELECT qid, page, row_number() OVER (PARTITION BY qid, page ORDER BY search_name DESC)
        AS pos_in_page, search_name FROM kept""",
    "page_labels": _search(_PAGED).rstrip()
    + ",\n" + _paged("''") + "\n"
    + """SELECT qid, page, count(*) AS n_hits,
        count(*) || CASE WHEN count(*) >= 100 THEN '+' ELSE '' END AS label
      FROM paged GROUP BY qid, page""",
    "suggestions": _search(("{w3} {w4}", "src1", "src", "idle")).rstrip()
    + f",\n{_JOBS},\n{_FIRST_PAGE}\n"
    + """SELECT qid, full_name AS search_name, false AS has_more FROM q JOIN jobs
        ON starts_with(name, trim(q))
      UNION ALL SELECT qid, search_name, false FROM page1""",
    "name_and_text_union": _search(
        ("{w3} {w4}", "src1", "src"),
        extra="""
  UNION ALL SELECT -1 - row_number() OVER (ORDER BY name), name FROM (
    SELECT DISTINCT source AS name FROM documents
    UNION ALL SELECT DISTINCT 'idle-' || source FROM documents)""",
    ).rstrip()
    + f",\n{_JOBS},\n{_FIRST_PAGE}\n"
    + """SELECT search_name, src, show_console, count(*) AS n FROM (
        SELECT full_name AS search_name, 0 AS src, false AS show_console FROM q JOIN jobs
          ON trim(q) = name OR trim(q) = full_name
        UNION ALL SELECT search_name, 1, true FROM page1)
      GROUP BY ALL""",
    "hit_url": """SELECT source AS project, doc_id AS number,
        'http://ci.example/job/' || source || '/' || doc_id || '/' AS url FROM documents""",
    "orphan_docs": """SELECT d.source AS project, d.doc_id AS number FROM documents d
        JOIN labels l ON l.doc_id = d.doc_id WHERE toxic = 1""",
    "visible_hits": _search(_RANKED)
    + f"SELECT qid, project, number, rank FROM ranked WHERE rank <= 100 AND {_EVEN}",
    "visible_first": _search(_RANKED)
    + f"""SELECT qid, project, number,
        row_number() OVER (PARTITION BY qid ORDER BY score DESC, project, number) AS rank
      FROM scored WHERE {_EVEN} QUALIFY rank <= 100""",
    "fragments": _search(_FRAGMENT_SHAPES).rstrip()
    + f",\n{_FRAGMENTS}\n"
    + """SELECT qid, project, number, string_agg(text, ' ... ' ORDER BY place) AS fragments
      FROM isl GROUP BY ALL""",
    "fragments_br": _search(_FRAGMENT_SHAPES).rstrip()
    + f",\n{_FRAGMENTS}\n"
    + r"""SELECT qid, project, number, count(*) AS n_fragments,
        md5(string_agg(regexp_replace(text, '\r\n|\n|\r', '<br/>', 'g'), '|' ORDER BY place)) AS shown_md5
      FROM isl GROUP BY qid, project, number""",
    "search_pages": _search(_RANKED).rstrip()
    + f",\n{_FRAGMENTS},\n"
    + f"""flags AS (SELECT qid, bool_or(field IS NULL OR field = 'c') AS show_console
                  FROM force GROUP BY qid),
      cnt AS (SELECT qid, project, number, count(*) AS n FROM isl GROUP BY ALL),
      placed_hits AS (
        SELECT r.qid, r.project, r.number, score, project || '#' || number AS search_name,
               row_number() OVER (PARTITION BY qid ORDER BY project || '#' || number DESC) AS pos_in_page
        FROM ranked r WHERE rank <= 100)
      SELECT p.qid, CAST(1 AS BIGINT) AS page, pos_in_page, search_name,
        'http://ci.example/job/' || p.project || '/' || p.number || '/' AS url, score, show_console,
        CASE WHEN show_console THEN coalesce(n, 0) ELSE 0 END AS n_fragments
      FROM placed_hits p JOIN flags f ON f.qid = p.qid
        LEFT JOIN cnt c ON c.qid = p.qid AND c.project = p.project AND c.number = p.number
      WHERE {_EVEN.replace("project", "p.project")}""",
    "rebuild_overwrite": _with(_DOCS) + _STATE + "docs",
    "rebuild_preserve": _with(_DOCS, _OLD)
    + _STATE + "old UNION ALL " + _STATE + "docs WHERE number % 3 = 0",
    "rebuild_subset": _with(_DOCS, _OLD)
    + _STATE + f"docs WHERE {_EVEN} UNION ALL " + _STATE + f"old WHERE NOT ({_EVEN})",
    "validate_jobs": """SELECT 'nosuchjob' AS name FROM documents GROUP BY 1""",
    "empty_jobs": _with(_JOBS)
    + """SELECT full_name, name, parent_name FROM jobs
      WHERE full_name NOT IN (SELECT source FROM documents)""",
    "job_labels": _with(_JOBS)
    + """SELECT full_name, CASE WHEN parent_name = 'root' THEN name
        ELSE parent_name || ' >> ' || name END AS label FROM jobs""",
    "remove_run": _with(_DOCS)
    + _STATE + "docs WHERE number NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)",
    "upsert_run": _with(_DOCS, _OLD)
    + _STATE + "old WHERE number NOT IN (SELECT doc_id FROM labels WHERE quality = 1) UNION ALL "
    + """SELECT project, number, 'new ', md5(c) FROM docs
      WHERE number IN (SELECT doc_id FROM labels WHERE quality = 1)""",
    "delete_job": _with(_DOCS) + _STATE + f"docs WHERE NOT ({_EVEN})",
    "clean_all": """SELECT 'clean all' AS name, 'COMPLETE' AS state, count(*) AS current FROM documents""",
    "run_lookup": _with(_DOCS)
    + "SELECT project, number, n, d FROM docs WHERE number IN (SELECT doc_id FROM labels)",
    "append_documents": _with(_DOCS, _OLD)
    + _STATE + "old UNION ALL " + _STATE + "docs WHERE number % 3 = 0",
    "split_bad_runs": _with(_ERRORS) + "SELECT project, number, reason FROM errors",
    "rebuild_report": _with(_JOBS, _ERRORS, _REPORT) + "SELECT * FROM report",
    "rebuild_status": _with(_JOBS, _ERRORS, _REPORT)
    + """SELECT CAST(CASE WHEN bool_or(state <> 'COMPLETE') THEN 2 ELSE 0 END AS BIGINT) AS code,
        CASE WHEN bool_or(state <> 'COMPLETE')
             THEN arg_max(reason, full_name) FILTER (state <> 'COMPLETE')
             ELSE 'Completed without errors' END AS message,
        false AS running, false AS never_started, count(*) AS n_jobs,
        CAST(sum(max) AS BIGINT) AS processed_items FROM report""",
    "status_json": _with(_JOBS, _ERRORS, _REPORT)
    + """SELECT '{"full_name":"' || full_name || '","name":"' || name || '","state":"' || state
        || '","current":' || current || ',"max":' || max || ',"reason":"' || reason || '"}' AS json
      FROM report""",
    "ext_failed_tests": _with(_TESTS)
    + "SELECT project, number, length(u) AS n_chars, md5(u) AS unittest_md5 FROM texts",
    "ext_artifacts": _with(_TESTS)
    + "SELECT project, number, length(a) AS n_chars, md5(a) AS artifact_md5 FROM texts",
    "ext_not_stored": _with(_TESTS)
    + f"""SELECT field, count(*) AS n_postings, CAST(sum(tf) AS BIGINT) AS n_tokens,
        CAST(0 AS BIGINT) AS artifact_stored FROM (
        SELECT field, number, term, count(*) AS tf FROM (
          SELECT 'unittest' AS field, number, unnest({_parts('u')}) AS term FROM texts
          UNION ALL SELECT 'artifact', number, unnest({_parts('a')}) FROM texts)
        GROUP BY ALL) GROUP BY field""",
    "ext_failing_rows": _with(_DOCS)
    + """SELECT project, number, p, CASE WHEN length(c) % 3 <> 0 THEN md5(replace(c, ' ', '_')) END AS some_md5,
        CASE WHEN length(c) % 3 = 0 THEN 'ValueError' END AS some_error, NULL AS broken,
        true AS broken_has_error FROM docs""",
    "ext_failing_report": _with(_DOCS)
    + """SELECT 'some' AS keyword, count_if(length(c) % 3 <> 0)::BIGINT AS n_texts,
        count_if(length(c) % 3 = 0)::BIGINT AS n_failed, false AS failed FROM docs
      UNION ALL SELECT 'broken', 0, 0, true""",
    "artifact_patterns": r"""SELECT page_id, path FROM (
        SELECT page_id, regexp_replace(url, '^https?://', '') AS path FROM pages)
      WHERE (regexp_matches(path, '^([^/]+/)*en/[^/]*$') OR regexp_matches(path, '^[^/]*\.example\.org(/.*)?$'))
        AND NOT (regexp_matches(path, '^th[^/]*(/.*)?$') OR regexp_matches(path, '^([^/]+/)*[^/]5$'))""",
    "phrase_match": _with(_DOCS, _TOKS, _q(("{w3} {w4} {w5}", "{w3} {w4}", "{all}")))
    + """SELECT DISTINCT qid, project, number
      FROM (SELECT project, number, field, string_agg(term, ' ' ORDER BY ord) AS line FROM (
              SELECT project, number, field, unnest(range(len(t))) AS ord, unnest(t) AS term FROM (
                SELECT project, number, f AS field, """
    + _parts("x")
    + """ AS t FROM (SELECT project, number, unnest(['j', 'd', 'p', 'c']) AS f,
                         unnest([j, d, p, c]) AS x FROM docs)))
            GROUP BY project, number, field), q
      WHERE contains(' ' || line || ' ', ' ' || array_to_string("""
    + _parts("q")
    + """, ' ') || ' ')""",
    "wildcard_match": _with(_DOCS, _TOKS, _POST, _q(_WILD_SHAPES))
    + """, pat AS (
        SELECT qid, CASE qid % 100 WHEN 0 THEN left(q, 3) || '%' WHEN 1 THEN '%' || right(q, 3)
          WHEN 2 THEN '%' || substr(q, 2, 3) || '%' ELSE '_' || substr(q, 2) END AS pattern
        FROM q),
      exp AS (SELECT qid, term, df FROM pat JOIN tstat ON term LIKE pattern WHERE field = 'c')
      SELECT qid, p.project, p.number, round(sum(ln(1 + (f.n_docs - e.df + 0.5) / (e.df + 0.5))
          * p.tf / (p.tf + 1.2 * (0.25 + 0.75 * l.dl / f.avg_len))), 4) AS score
      FROM exp e JOIN post p ON p.term = e.term AND p.field = 'c' JOIN fstat f ON f.field = p.field
        JOIN dlen l ON l.project = p.project AND l.number = p.number AND l.field = p.field
      GROUP BY qid, p.project, p.number""",
    "number_range": """SELECT source AS project, doc_id AS number FROM documents
      WHERE doc_id <= 90 OR doc_id BETWEEN 150 AND 4000""",
    "events_latest_state": _LATEST,
    "stream_replay": _LATEST,
    "feed_with_extension": f"SELECT project, number, seq, 'case ' || p || c AS unittest FROM ({_LATEST})",
    "events_job_deleted": _with(_EVENTS) + "SELECT project, deleted_seq FROM gone",
    "events_compacted": _with(_EVENTS)
    + """SELECT project, number, seq, op FROM lastop
      UNION ALL SELECT project, NULL, deleted_seq, 'job_deleted' FROM gone""",
}
# The documents of the time decide, whatever the index held before.
ORACLES["phrase_after_update"] = ORACLES["phrase_match"]
ORACLES["wildcard_after_update"] = ORACLES["wildcard_match"]
ORACLES["index_many_updates"] = ORACLES["index_update"]
# Where documents or hits are stored makes no difference.
ORACLES["search_stored_parts"] = ORACLES["search_pages"]
ORACLES["hits_round_trip"] = ORACLES["bm25_topk"]
