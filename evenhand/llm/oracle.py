"""DuckDB SQL for the queries that it can express."""

BLANKS = r"[\x20\x09-\x0D]+"

#: Levels of nodes that the SQL of the manifest spells out: up to 3 ** 12 documents of a source.
LEVELS = 12


def _field(value: str) -> str:
    return f"coalesce(octet_length(encode(CAST({value} AS VARCHAR))) || ':' || {value}, '-')"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join(map(_field, ('doc_id', 'source', 'lang', 'n_chars', text)))})"


def _crc32(digits: str) -> str:
    """The checksum of a short text in ASCII, bit by bit."""
    bits = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))"
    codes = f"list_transform(string_split({digits}, ''), lambda d: CAST(ascii(d) AS BIGINT))"
    whole = f"list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {codes}), lambda c, b: {bits})"
    return f"CASE WHEN {digits} = '' THEN 0 ELSE xor({whole}, 4294967295) END"


def _tree(name: str, key: str, leaves: str, order: str) -> str:
    """Nodes of all levels (k, level, pos, h, n) over leaves (k, h): runs of three, as long as a key has several."""
    out = f"""{name}0 AS (SELECT {key} AS k, row_number() OVER (PARTITION BY {key} ORDER BY {order}) - 1 AS pos, h,
  count(*) OVER (PARTITION BY {key}) AS n FROM {leaves})"""
    for i in range(LEVELS):
        out += f""",
{name}{i + 1} AS (SELECT k, pos // 3 AS pos, sha256(string_agg(h, '' ORDER BY pos)) AS h, (max(n) + 2) // 3 AS n
  FROM {name}{i} WHERE n > 1 GROUP BY k, pos // 3)"""
    every = " UNION ALL ".join(f"SELECT {i} AS level, * FROM {name}{i}" for i in range(LEVELS + 1))
    return out + f",\n{name} AS ({every})"


def _folds(first: str, name: str, keep: str) -> str:
    """From rows (k, pos, led, proof): the hash that a leaf leads to and all siblings, level by level."""
    out, before = "", first
    for i in range(LEVELS):
        led = "sha256(coalesce(a.h, '') || coalesce(b.h, '') || led || coalesce(c.h, '') || coalesce(d.h, ''))"
        joins = " ".join(
            f"LEFT JOIN {name}{i} {x} ON {x}.k IS NOT DISTINCT FROM f.k AND {x}.pos = f.pos {o} AND {x}.pos // 3 = f.pos // 3"
            for x, o in (("a", "- 2"), ("b", "- 1"), ("c", "+ 1"), ("d", "+ 2"))
        )
        out += f""",
{first}_{i} AS (SELECT {keep}, f.k, f.pos // 3 AS pos, CASE WHEN o.n > 1 THEN {led} ELSE led END AS led,
  CASE WHEN o.n > 1 THEN proof || coalesce(a.h, '') || coalesce(b.h, '') || coalesce(c.h, '') || coalesce(d.h, '') ELSE proof END AS proof
  FROM {before} f LEFT JOIN {name}{i} o ON o.k IS NOT DISTINCT FROM f.k AND o.pos = f.pos {joins})"""
        before = f"{first}_{i}"
    return out


MANIFEST = rf"""
WITH given AS (SELECT *, CASE WHEN ({_crc32("coalesce(CAST(doc_id AS VARCHAR), '')")}) % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS other FROM documents),
leaves AS (SELECT row_number() OVER () AS r, doc_id, coalesce('=' || source, '-') AS source, {_leaf('text')} AS h, {_leaf('other')} AS led FROM given),
placed AS (SELECT r, doc_id, led, h AS leaf, source AS k, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, h, r) - 1 AS pos, '' AS proof FROM leaves),
{_tree('s', 'source', 'leaves', 'doc_id NULLS FIRST, h, r')},
subroots AS (SELECT k AS source, h FROM s WHERE n = 1),
{_tree('t', "''", "(SELECT source, h FROM subroots)", 'encode(source)')},
tops AS (SELECT source, row_number() OVER (ORDER BY encode(source)) - 1 AS pos FROM subroots){_folds('placed', 's', 'f.r, f.doc_id, f.leaf')},
up AS (SELECT p.r, p.doc_id, p.leaf, p.k AS source, led, proof, '' AS k, tops.pos FROM placed_{LEVELS - 1} p JOIN tops ON tops.source = p.k){_folds('up', 't', 'f.r, f.doc_id, f.leaf, f.source')}
SELECT doc_id, leaf, subroots.h AS subroot, t.h AS root, sha256(proof) AS proof_sha256, led AS folded_root, led = t.h AS verified
FROM up_{LEVELS - 1} u JOIN subroots USING (source) JOIN t ON t.n = 1"""

ORACLE = {
    "op2_rule_ledger": r"""
WITH t AS (SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM t),
g AS (SELECT r, i, words[i:i + 2] AS gram FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS n FROM g) WHERE n > 1),
rep AS (SELECT r, count(DISTINCT i + k) AS n_repeat_words FROM twice, (SELECT unnest([0, 1, 2]) AS k) GROUP BY r),
m AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
    CAST(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(length(regexp_replace(text, '\P{Lu}', '', 'g')) AS BIGINT) AS n_capitals,
    CAST(len(lines) AS BIGINT) AS n_lines,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN rep USING (r)),
b AS (
  SELECT *, CAST(n_words < 50 AS INTEGER) + 2 * CAST(100 * n_repeat_words > 50 * n_words AS INTEGER)
    + 4 * CAST(10 * n_symbols > n_words AS INTEGER) + 8 * CAST(2 * n_dup_lines > n_lines AS INTEGER)
    + 16 * CAST(word_chars < 2 * n_words AS INTEGER) + 32 * CAST(word_chars > 12 * n_words AS INTEGER)
    + 64 * CAST(100 * n_capitals > 40 * word_chars AS INTEGER) AS failures FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  failures & 3 <> 0 AS base_failed, failures = 0 AS kept, failures FROM b""",
    "op9_chat_events": r"""
WITH c AS (
  SELECT conv_id, CAST(turn AS BIGINT) AS turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT *, regexp_replace(text, '([<\[])(\\*)(/?(s>|INST\]))', '\1\\\2\3', 'g') AS body,
    regexp_replace(role, '([<\[])(\\*)(/?(s>|INST\]))', '\1\\\2\3', 'g') AS head FROM c),
j AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
    coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '') AS learned,
    CAST(sum(length('<s>[INST]' || head || '[/INST]' || body || '</s>')) AS BIGINT) AS formatted_chars
  FROM e GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, CAST(length(learned) AS BIGINT) AS loss_chars,
  sha256(learned) AS loss_sha256, formatted_chars FROM j""",
    "op10_digest_runs": r"""
WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS s FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY s) AS keep_id, count(*) OVER (PARTITION BY s) AS group_size,
  row_number() OVER (PARTITION BY s ORDER BY doc_id) = 1 AS kept, sha256(s) AS text_sha256 FROM t""",
    "op11_coordinate_pruning": """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, a.label AS own, b.vec_id, b.label, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM e a, e b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT anchor_id, own, vec_id AS positive_id, score AS positive_score FROM s WHERE label = own
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id AS negative_id, positive_score,
  score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE s.label <> p.own AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 10""",
    "op13_merkle_witnesses": MANIFEST,
}
