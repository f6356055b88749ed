"""The same results in SQL for the second engine, where SQL can express them.

Toxicity, token files and decontamination use dictionaries, a vocabulary file and hashes that SQL lacks; near-duplicate
documents and vectors need a search and a recursion over pairs, runs of words one join for every period, that take too long on whole
tables. Their tests compare with brute force.
"""

from __future__ import annotations

from tarmac.llm.licenses import COPYRIGHT_LINE, EQUIVALENT, KNOWN, NO_WORD
from tarmac.llm.mixing import MOST_EPOCHS, SEED, WEIGHTS, WORD
from tarmac.llm.token_counts import PATTERNS


def _text(value: str) -> str:
    """An SQL text literal."""
    return "'" + value.replace("'", "''") + "'"


def _counts(text: str) -> str:
    return " UNION ALL ".join(
        f"SELECT doc_id, source, lang, '{v}' AS version, coalesce(len(regexp_extract_all({text}, '{p}')), 0) AS n_tokens FROM state"
        for v, p in PATTERNS.items()
    )


# the state after all batches, counted at once
TOKEN_COUNTS = f"""
WITH state AS (
  SELECT doc_id, source, lang, regexp_replace(text, '[0-9]+', ' ', 'g') AS text
  FROM documents
  QUALIFY row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id) = 1
), counted AS ({_counts("text")})
SELECT source, lang, version, count(*) AS n_docs, CAST(sum(n_tokens) AS BIGINT) AS n_tokens
FROM counted GROUP BY ALL
"""

_CONTROL = r"([<\[])(\\*)(\||/?s>|/?INST\]|</?SYS>>)"

CHAT = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
)
SELECT conv_id,
  count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(24 + length(regexp_replace(replace(replace(role, '\\', '\\\\'), chr(10), '\\n'), '{_CONTROL}', '\\1\\\\\\2\\3', 'g'))
    + length(regexp_replace(text, '{_CONTROL}', '\\1\\\\\\2\\3', 'g'))) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""

# one running sum per source; the weights and keys follow the operator's definition
MIXING = f"""
WITH words AS (
  SELECT doc_id, source, text, coalesce(regexp_extract_all(text, '{WORD}'), []) AS w FROM documents
), docs AS (
  SELECT doc_id, source, CAST(len(w) AS BIGINT) AS size,
    0.1 + CASE WHEN len(w) > 0 THEN len(list_distinct(w)) / CAST(len(w) AS DOUBLE) ELSE 0 END AS quality,
    CAST('0x' || substr(md5('{SEED}|' || coalesce(CAST(doc_id AS VARCHAR), md5(coalesce(text, '')))), 1, 13) AS BIGINT) AS number
  FROM words
), keyed AS (
  SELECT *, -ln((number + 0.5) / {float(1 << 52)}) / quality AS key FROM docs
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM docs GROUP BY source
), weighed AS (
  SELECT *, list_extract([{", ".join(map(str, WEIGHTS))}], CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} + 1 AS INT)) AS w,
    {MOST_EPOCHS} * source_size AS cap FROM sources
), capped AS (
  -- a source stops at its cap where dealing out the rest without the sources that stop before it gives it more
  SELECT a.source, a.source_size, a.w, a.cap,
    a.cap * ((SELECT sum(w) FROM weighed) - coalesce(sum(b.w), 0))
      < a.w * ((SELECT sum(source_size) FROM weighed) - coalesce(sum(b.cap), 0)) AS stops
  FROM weighed a LEFT JOIN weighed b ON b.cap / b.w < a.cap / a.w
  GROUP BY a.source, a.source_size, a.w, a.cap
), targets AS (
  SELECT source, source_size, CASE WHEN stops THEN CAST(cap AS DOUBLE) ELSE
    CAST(w * ((SELECT sum(source_size) FROM weighed) - coalesce((SELECT sum(cap) FROM capped WHERE stops), 0)) AS DOUBLE)
    / CAST((SELECT sum(w) FROM capped WHERE NOT stops) AS DOUBLE) END AS target
  FROM capped
), ordered AS (
  SELECT k.doc_id, k.size, t.source_size, t.target, CAST(round(t.target) AS BIGINT) AS goal,
    CAST(sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id, k.size ROWS UNBOUNDED PRECEDING) - k.size AS BIGINT) AS before
  FROM keyed k JOIN targets t ON k.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
  CASE WHEN source_size = 0 THEN 0 ELSE
    size * (goal // source_size) + greatest(0, least(size, goal % source_size - before)) END AS taken
FROM ordered
"""

_KNOWN = ", ".join(f"({_text(name)}, {_text(text)})" for name, text in KNOWN)


def _digest(text: str) -> str:
    """Digest of the canonical form of an SQL expression, NULL for an empty one."""
    form = f"' ' || trim(regexp_replace(regexp_replace(lower({text}), {_text(COPYRIGHT_LINE)}, chr(10), 'g'), {_text(NO_WORD)}, ' ', 'g')) || ' '"
    for other, one in EQUIVALENT.items():
        form = f"replace({form}, ' {other} ', ' {one} ')"
    return f"CASE WHEN trim({form}) <> '' THEN md5(trim({form})) END"


LICENSES = f"""
WITH known AS (
  SELECT {_digest("text")} AS known_digest, min(name) AS license FROM (VALUES {_KNOWN}) t(name, text) GROUP BY 1
), lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents
), named AS (
  SELECT doc_id, string_agg(DISTINCT license, '|' ORDER BY license) AS line_licenses, count(*) AS n_license_lines
  FROM (SELECT doc_id, {_digest("line")} AS known_digest FROM lines) JOIN known USING (known_digest) GROUP BY doc_id
), whole AS (SELECT doc_id, {_digest("text")} AS whole_digest FROM documents)
SELECT w.doc_id, whole_digest, k.license AS whole_license, coalesce(line_licenses, '') AS line_licenses,
  coalesce(n_license_lines, 0) AS n_license_lines
FROM whole w LEFT JOIN known k ON whole_digest = known_digest LEFT JOIN named n ON w.doc_id IS NOT DISTINCT FROM n.doc_id
"""

LINE_DEDUP = r"""
WITH split AS (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents),
lines AS (
  SELECT doc_id, unnest(l) AS line, CAST(unnest(range(len(l))) AS INT) AS pos FROM split
), runs AS (
  SELECT doc_id, pos, line || chr(10) || lead(line, 1) OVER w || chr(10) || lead(line, 2) OVER w AS run
  FROM lines WINDOW w AS (PARTITION BY doc_id ORDER BY pos)
), later AS (
  SELECT doc_id, pos FROM runs WHERE trim(translate(run, chr(10) || chr(9) || chr(13), '   ')) <> ''
  WINDOW own AS (PARTITION BY run ORDER BY doc_id, pos)
  QUALIFY row_number() OVER own > 1 AND NOT (doc_id = first_value(doc_id) OVER own AND pos < first_value(pos) OVER own + 3)
), kept AS (
  SELECT doc_id, pos, line FROM lines n
  WHERE NOT EXISTS (SELECT 1 FROM later r WHERE r.doc_id = n.doc_id AND r.pos = n.pos)
    AND NOT EXISTS (SELECT 1 FROM later r WHERE r.doc_id = n.doc_id AND r.pos = n.pos - 1)
    AND NOT EXISTS (SELECT 1 FROM later r WHERE r.doc_id = n.doc_id AND r.pos = n.pos - 2)
), texts AS (
  SELECT doc_id, count(*) AS n, string_agg(line, chr(10) ORDER BY pos) AS text FROM kept GROUP BY doc_id
), spots AS (
  SELECT doc_id, string_agg(CAST(pos AS VARCHAR), '|' ORDER BY pos) AS spots FROM later GROUP BY doc_id
)
SELECT s.doc_id, CAST(coalesce(len(s.l), 0) AS BIGINT) AS n_lines,
  CAST(coalesce(len(s.l), 0) - coalesce(t.n, 0) AS BIGINT) AS n_removed,
  coalesce(p.spots, '') AS spots,
  CASE WHEN s.text IS NOT NULL THEN md5(coalesce(t.text, '')) END AS text_md5
FROM split s LEFT JOIN texts t USING (doc_id) LEFT JOIN spots p USING (doc_id)
"""

# nodes by a digest of the digests so far; a node's subtree through the paths of one conversation of each node below
TRIE = """
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), members AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base,
    (4294967295 - list_reduce(
      list_concat([4294967295::BIGINT], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
      lambda crc, b: list_reduce(list_concat([xor(crc, b)], range(8)), lambda x, _: xor(x >> 1, 3988292384 * (x & 1)))
    )) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM turns)
), rebuilt AS (
  SELECT m.conv_id, t.pos, t.role, t.text FROM members m JOIN turns t ON t.conv_id = m.base AND t.pos <= m.h
  UNION ALL
  SELECT m.conv_id, t.pos, t.role, t.text FROM members m JOIN turns t ON t.conv_id = m.conv_id AND t.pos > m.h
), placed AS (
  SELECT conv_id, row_number() OVER own AS depth, text,
    md5(string_agg(md5(role || ':' || md5(text)), ' ') OVER own) AS prefix
  FROM rebuilt WINDOW own AS (PARTITION BY conv_id ORDER BY pos)
), paths AS (
  SELECT conv_id, depth, prefix, len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS words,
    lag(prefix, 1, '') OVER (PARTITION BY conv_id ORDER BY depth) AS above,
    depth = max(depth) OVER (PARTITION BY conv_id) AS ends
  FROM placed
  UNION ALL
  SELECT conv_id, 0, '', 0, NULL, conv_id NOT IN (SELECT conv_id FROM placed) FROM members
), nodes AS (
  SELECT prefix, min(conv_id) AS conv_id, any_value(depth) AS depth, any_value(above) AS above, count(*) AS n_convs, any_value(words) AS words,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
  FROM paths GROUP BY prefix
), family AS (
  SELECT n.*, count(c.prefix) AS n_children FROM nodes n LEFT JOIN nodes c ON c.above = n.prefix GROUP BY ALL
), below AS (
  -- every node with all nodes on the way up from it: those of one of its conversations
  SELECT a.prefix AS top, f.n_children, f.n_convs, f.words
  FROM family f JOIN paths p ON p.prefix = f.prefix AND p.conv_id = f.conv_id
  JOIN paths a ON a.conv_id = p.conv_id AND a.depth <= p.depth
)
SELECT f.conv_id, CAST(f.depth AS BIGINT) AS depth, up.conv_id AS parent_conv_id, f.n_convs, f.n_children,
  CAST(count(*) FILTER (WHERE b.n_children = 0) AS BIGINT) AS n_leaves,
  CAST(sum((b.n_convs - 1) * b.words) AS BIGINT) AS saved_tokens, f.ends_sha256
FROM family f JOIN below b ON b.top = f.prefix LEFT JOIN nodes up ON up.prefix = f.above
GROUP BY f.prefix, f.conv_id, f.depth, up.conv_id, f.n_convs, f.n_children, f.ends_sha256
"""

# every window of 100 bytes, as hexadecimal digits; spans are islands of windows that came before
SUFFIXES = """
WITH docs AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, octet_length(encode(coalesce(text, ''))) AS n FROM documents
), windows AS (
  SELECT doc_id, pos, md5(substr(x, 2 * pos + 1, 200)) AS h FROM docs, unnest(range(greatest(n - 99, 0))) t(pos)
), later AS (
  SELECT doc_id, pos FROM windows QUALIFY row_number() OVER (PARTITION BY h ORDER BY doc_id, pos) > 1
), islands AS (
  SELECT doc_id, pos, sum(CASE WHEN gap <= 100 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY pos) AS island
  FROM (SELECT *, pos - lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) AS gap FROM later)
), spans AS (
  SELECT doc_id, min(pos) AS a, max(pos) + 100 AS z FROM islands GROUP BY doc_id, island
), pieces AS (
  SELECT doc_id, z, a, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM spans
), cut AS (
  SELECT p.doc_id, string_agg(substr(x, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) || substr(any_value(x), 2 * max(z) + 1) AS kept,
    sum(z - a) AS n_removed, count(*) AS n_spans
  FROM pieces p JOIN docs USING (doc_id) GROUP BY p.doc_id
)
SELECT d.doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(kept, x))) AS kept_sha256
FROM docs d LEFT JOIN cut USING (doc_id)
"""

ORACLE = {
    "op1_token_counts": TOKEN_COUNTS,
    "op2_chat_formatting": CHAT,
    "op3_source_mixing": MIXING,
    "op9_license_scan": LICENSES,
    "op10_line_dedup": LINE_DEDUP,
    "op12_conversation_trie": TRIE,
    "op13_suffix_dedup": SUFFIXES,
}
