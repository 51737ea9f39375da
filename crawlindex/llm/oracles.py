"""SQL, as DuckDB runs it, for the operators that SQL can express."""

from __future__ import annotations

# The CRC-32 polynomial and the alphabet of base32.
_POLYNOMIAL = 0xEDB88320
_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_ALL_ONES = 0xFFFFFFFF


def _crc32(text: str) -> str:
    """Unsigned CRC-32 of an ASCII text, bit by bit."""
    data = f"list_transform(string_split({text}, ''), lambda c: ascii(c)::BIGINT)"
    step = f"lambda x, i: xor(x >> 1, (x & 1) * {_POLYNOMIAL})"
    byte = f"list_reduce(list_prepend(xor(crc, byte), range(8)), {step})"
    crc = f"list_reduce(list_prepend({_ALL_ONES}::BIGINT, {data}), lambda crc, byte: {byte})"
    return f"xor({crc}, {_ALL_ONES})"


def _base32(digest: str) -> str:
    """Base32 of a SHA-1 digest in hexadecimal: four letters for five digits."""
    digits = f"('0x' || substr({digest}, 5 * (i // 4)::INTEGER + 1, 5))::BIGINT"
    letter = f"substr('{_ALPHABET}', (({digits} >> (15 - 5 * (i % 4))) & 31)::INTEGER + 1, 1)"
    return f"array_to_string(list_transform(range(32), lambda i: {letter}), '')"


TOP_K = """
WITH v AS (
    SELECT row_number() OVER () AS row, vec_id,
        list_transform(embedding::DOUBLE[], lambda x: floor(1024 * x)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
    SELECT q.row, q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
    FROM v q JOIN v c ON q.row <> c.row WHERE q.vec_id % 100 = 0),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id) AS rank FROM scores)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 10"""

WARC = f"""
WITH payloads AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS digest
    FROM pages),
first AS (SELECT *, min(page_id) OVER (PARTITION BY digest) AS first_id FROM payloads)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, {_base32('digest')} AS payload_digest,
    CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM first"""

_WORDS = (
    "regexp_extract_all(translate(coalesce({}, ''), '{}', '{}'),"
    " '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
).format("text", _LETTERS, _LETTERS.lower())

DECONTAMINATION = f"""
WITH items AS (SELECT DISTINCT item_id, {_WORDS} AS w FROM benchmark),
docs AS (SELECT row_number() OVER () AS row, doc_id, {_WORDS} AS w FROM documents),
windows AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS words
    FROM (SELECT *, unnest(range(1, greatest(len(w) - 8, 2))) AS i FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM windows),
places AS (
    SELECT row, n, unnest(range(1, len(w) - n + 2)) AS i, w FROM docs JOIN sizes ON len(w) >= n),
found AS (
    SELECT row, i, p.n, item_id
    FROM (SELECT row, n, i, array_to_string(w[i:i + n - 1], ' ') AS words FROM places) p
    JOIN windows x ON p.n = x.n AND p.words = x.words),
hit AS (
    SELECT row, count(DISTINCT word) AS n_hit
    FROM (SELECT DISTINCT row, unnest(range(i, i + n)) AS word FROM found) GROUP BY row),
named AS (
    SELECT row, count(DISTINCT item_id) AS n_items,
        string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS names
    FROM found GROUP BY row)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (row) LEFT JOIN named USING (row)"""


def _field(value: str) -> str:
    text = f"{value}::VARCHAR"
    return f"coalesce(strlen({text}) || ':' || {text}, '-')"


def _leaf(text: str) -> str:
    fields = ["doc_id", "source", "lang", "n_chars", text]
    return f"sha256({' || '.join(map(_field, fields))})"


def _tree(name: str, leaves: str) -> str:
    """Nodes (grp, level, pos, n, digest) of the trees over (grp, pos, n, digest)."""
    run = "(pos // 3)"
    return f"""
{name}(grp, level, pos, n, digest) AS (
    SELECT grp, 0, pos, n, digest FROM {leaves}
    UNION ALL
    SELECT grp, any_value(level) + 1, {run}, any_value((n + 2) // 3),
        sha256(string_agg(digest, '' ORDER BY pos))
    FROM {name} WHERE n > 1 GROUP BY grp, {run})"""


def _steps(name: str, tree: str) -> str:
    """(grp, pos, steps): of each leaf the siblings before and after its path."""
    return f"""
{name} AS (
    SELECT leaf.grp, leaf.pos, list({{'b': coalesce(b, ''), 'a': coalesce(a, '')}} ORDER BY level) AS steps
    FROM (SELECT grp, pos FROM {tree} WHERE level = 0) leaf
    JOIN (
        SELECT grp, level, pos,
            string_agg(digest, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b,
            string_agg(digest, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS a
        FROM {tree} WHERE n > 1
        WINDOW run AS (PARTITION BY grp, level, pos // 3 ORDER BY pos)) node
    ON leaf.grp IS NOT DISTINCT FROM node.grp
        AND node.pos = leaf.pos // (3 ** node.level)::BIGINT
    GROUP BY leaf.grp, leaf.pos)"""


_TAMPERED = f"""CASE WHEN {_crc32('doc_id::VARCHAR')} % 2 = 0
    THEN replace(text, chr(10), '') ELSE text END"""

MERKLE = f"""
WITH RECURSIVE leaves AS (
    SELECT doc_id, source AS grp, {_leaf('text')} AS digest, {_leaf(_TAMPERED)} AS now,
        count(*) OVER (PARTITION BY source) AS n,
        row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, {_leaf('text')}) - 1 AS pos
    FROM documents),
{_tree('tree', 'leaves')},
subroots AS (
    SELECT grp AS of, '' AS grp, digest, count(*) OVER () AS n,
        row_number() OVER (ORDER BY grp NULLS FIRST) - 1 AS pos
    FROM tree WHERE n = 1),
{_tree('top', 'subroots')},
{_steps('below', 'tree')},
{_steps('above', 'top')},
whole AS (
    SELECT l.doc_id, l.digest AS leaf, l.now, s.digest AS subroot,
        (SELECT digest FROM top WHERE n = 1) AS root,
        list_concat(coalesce(b.steps, []), coalesce(t.steps, [])) AS steps
    FROM leaves l
    JOIN subroots s ON s.of IS NOT DISTINCT FROM l.grp
    LEFT JOIN below b ON b.grp IS NOT DISTINCT FROM l.grp AND b.pos = l.pos
    LEFT JOIN above t ON t.pos = s.pos),
folded AS (
    SELECT *, list_reduce(list_prepend({{'b': now, 'a': ''}}, steps),
        lambda node, step: {{'b': sha256(step.b || node.b || step.a), 'a': ''}}).b AS folded_root
    FROM whole)
SELECT doc_id, leaf, subroot, root,
    sha256(array_to_string(list_transform(steps, lambda s: s.b || s.a), '')) AS proof_sha256,
    folded_root, folded_root = root AS verified
FROM folded"""

_WHITE = "chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '"
_STATE = "STRUCT(c BIGINT, a VARCHAR, r VARCHAR, m VARCHAR)"


def _edited(state: str, cost: str, edit: str, role: str = "", text: str = "''") -> str:
    """A state's best edits and one more, null where the state is out of reach."""
    made = f"{role} || ':' || {text}"
    after = f"concat_ws(chr(10), {state}.m, {made})" if role else f"{state}.m"
    initials = f"{state}.r || left({role}, 1)" if role else f"{state}.r"
    return f"""CASE WHEN {state} IS NOT NULL THEN {{'c': {state}.c + {cost},
        'a': {state}.a || '{edit}', 'r': {initials}, 'm': {after}}} END"""


def _turn(state: str, role: str, new: str) -> list[str]:
    """Keep a turn whose role has the initial, or give it the new role."""
    keep = _edited(state, "late", "K", "role", "text")
    rerole = _edited(state, "3 + late", "R", f"'{new}'", "text")
    return [
        f"CASE WHEN NOT bad AND left(role, 1) = '{role}' THEN {keep} END",
        f"CASE WHEN NOT bad THEN {rerole} END",
    ]


def _least(*options: str) -> str:
    return f"list_min([{', '.join(options)}])"


def _insert(state: str, role: str) -> str:
    return _edited(state, "3", "I", f"'{role}'")


_KEPT_SYSTEM = _turn("s0", "s", "user")[0]
_TURNS = f"""
{_edited('s0', '4', 'D')} AS t0,
{_least(_edited('s1', '4', 'D'), _KEPT_SYSTEM)} AS t1,
{_least(_edited('s2', '4', 'D'), *(x for s in ('s0', 's1', 's3') for x in _turn(s, 'u', 'user')))} AS t2,
{_least(_edited('s3', '4', 'D'), *_turn('s2', 'a', 'assistant'))} AS t3"""
_AFTER_USER = _least("t2", *(_insert(t, "user") for t in ("t0", "t1", "t3")))

CONVERSATIONS = f"""
WITH RECURSIVE given AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        {_crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS kind
    FROM conversations),
damaged AS (
    SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
        CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g')
            ELSE text END AS text
    FROM (SELECT *, unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) FROM given WHERE kind <> 0)),
marked AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) AS copy,
        rtrim(text, {_WHITE}) AS core
    FROM damaged),
turns AS (
    SELECT *, row_number() OVER turns AS i, coalesce(lag(left(role, 1)) OVER turns
            || left(role, 1) NOT IN ('su', 'ua', 'au'), false) AS illegal,
        core = '' AS blank, core <> '' AND copy > 1 AS duplicate, core = '' OR copy > 1 AS bad,
        core <> '' AND copy = 1 AND right(core, 1) NOT IN ('.', '!', '?') AS truncated
    FROM marked WINDOW turns AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)),
steps(conv_id, i, s0, s1, s2, s3) AS (
    SELECT DISTINCT conv_id, 0::BIGINT,
        {{'c': 0, 'a': '', 'r': '', 'm': NULL}}::{_STATE}, NULL::{_STATE},
        {{'c': 3, 'a': 'I', 'r': 'u', 'm': 'user:'}}::{_STATE},
        {{'c': 6, 'a': 'II', 'r': 'ua', 'm': 'user:' || chr(10) || 'assistant:'}}::{_STATE}
    FROM conversations
    UNION ALL
    SELECT conv_id, i, t0, t1, u2, {_least('t3', _insert('u2', 'assistant'))}
    FROM (
        SELECT *, {_AFTER_USER} AS u2
        FROM (
            SELECT s.conv_id, t.i, {_TURNS}
            FROM steps s JOIN (SELECT *, CASE WHEN truncated THEN 3 ELSE 0 END AS late FROM turns) t
            ON s.conv_id IS NOT DISTINCT FROM t.conv_id AND t.i = s.i + 1))),
best AS (
    SELECT conv_id, {_least('s0', 's3')} AS b
    FROM (SELECT *, max(i) OVER (PARTITION BY conv_id) AS last FROM steps) WHERE i = last),
counts AS (
    SELECT conv_id, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps,
        count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate,
        count(*) FILTER (truncated) AS truncated, count(*) FILTER (illegal) AS illegal
    FROM turns GROUP BY conv_id)
SELECT b.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank,
    coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
    coalesce(illegal, 0) AS illegal, b.b.c AS cost, b.b.a AS audit, b.b.r AS roles,
    sha256(coalesce(b.b.m, '')) AS repaired_sha256
FROM best b LEFT JOIN counts c ON b.conv_id IS NOT DISTINCT FROM c.conv_id"""

ORACLES = {
    "op2_exact_top_k": TOP_K,
    "op9_warc": WARC,
    "op11_decontamination": DECONTAMINATION,
    "op12_conversation_repair": CONVERSATIONS,
    "op13_merkle_manifest": MERKLE,
}
