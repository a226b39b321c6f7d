"""SQL fragments that state the same roles and tokenizers for the checking engine, written independently."""

from __future__ import annotations

from textloom.functions import constants as C

WS = C.WHITESPACE


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def listed(values: list[str]) -> str:
    return ", ".join(quoted(v) for v in values)


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '^[{WS}]+|[{WS}]+\z', '', 'g')"


def split_any(x: str) -> str:
    return rf"list_filter(string_split_regex({x}, '[{WS}]+'), lambda w: w <> '')"


def tok_ws(x: str) -> str:
    blank = f"regexp_replace(lower({x}), '[{C.CJK_MARKS}{C.LATIN_MARKS}]', ' ', 'g')"
    undigit = rf"regexp_replace({blank}, '\p{{Nd}}+', '', 'g')"
    return f"list_filter(list_transform(string_split({undigit}, ' '), lambda w: {strip('w')}), lambda w: w <> '')"


def tok_ws_keep(x: str) -> str:
    spaced = rf"regexp_replace(lower({x}), '([{C.CJK_MARKS}{C.LATIN_MARKS}])', ' \1 ', 'g')"
    return f"list_filter(list_transform(string_split({spaced}, ' '), lambda w: {strip('w')}), lambda w: w <> '')"


def pretokens(x: str) -> str:
    return rf"regexp_extract_all({x}, '[{C.WORD_CHARS}]+|[^{C.WORD_CHARS}{WS}]+')"


def bert_tokens(x: str) -> str:
    return rf"regexp_extract_all({x}, '[^{WS}{C.BERT_PUNCT}]+|[{C.BERT_PUNCT}]')"


def chars(x: str) -> str:
    return f"CASE WHEN {x} = '' THEN []::VARCHAR[] ELSE string_split({x}, '') END"


def ngrams(tokens: str, n: int) -> str:
    return f"[array_to_string(list_slice({tokens}, i, i + {n - 1}), ' ') FOR i IN range(1, len({tokens}) - {n - 2})]"


# Roles of the tables, as common table expressions.
TURNS = """turns AS (
  SELECT a.conv_id * 4294967296 + a.turn AS id, a.conv_id, a.turn, a.role, a.text, b.role AS next_role, b.text AS next_text
  FROM conversations a LEFT JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1)"""
PAIRS = TURNS + """, pairs AS (
  SELECT id AS pair_id, text AS src, next_text AS tgt FROM turns WHERE role = 'user' AND next_role = 'assistant')"""
LEVELLED = TURNS + """, rated AS (
  SELECT id, text AS pred, next_text AS gold, ['easy', 'medium', 'hard'][CAST(conv_id % 3 AS INT) + 1] AS source
  FROM turns WHERE next_text IS NOT NULL)"""
RULES = f"""rule_s AS (SELECT item_id AS rule_id, string_split_regex(text, '[.][ \n]+') AS s FROM benchmark),
rules AS (SELECT rule_id, s[1] AS grammar_description, list_filter(s[2:], lambda x: x <> '') AS ex FROM rule_s),
examples AS (SELECT rule_id, pos, ex[pos] AS za FROM (SELECT rule_id, ex, unnest(range(1, len(ex) + 1)) AS pos FROM rules)),
rule_words AS (SELECT DISTINCT rule_id, pos, w FROM (
  SELECT rule_id, pos, unnest({tok_ws('za')}) AS w FROM examples) WHERE length(w) > 6)"""
ITEMS = TURNS + f""", items AS (SELECT id AS query_id, text AS za FROM turns WHERE role = 'user'),
item_words AS (SELECT DISTINCT query_id, w FROM (SELECT query_id, unnest({tok_ws('za')}) AS w FROM items) WHERE length(w) > 6)"""
KEYWORDS = f"""{ITEMS}, {RULES},
query_words AS (SELECT DISTINCT query_id, 'w' AS kind, w FROM (
    SELECT query_id, unnest({split_any("replace(replace(lower(za), '.', ''), ',', '')")}) AS w FROM items)
  UNION ALL SELECT query_id, 'k', w FROM item_words),
rule_terms AS (
  SELECT DISTINCT rule_id, -1 AS pos, 'w' AS kind, w, 2 AS weight FROM (
    SELECT rule_id, unnest({split_any('lower(grammar_description)')}) AS w FROM rules)
  UNION ALL SELECT DISTINCT rule_id, pos, 'w', w, 1 FROM (
    SELECT rule_id, pos, unnest({split_any('lower(za)')}) AS w FROM examples)
  UNION ALL SELECT rule_id, pos, 'k', w, 3 FROM rule_words),
kw AS (SELECT query_id, rule_id, CAST(sum(weight) AS BIGINT) AS kw FROM query_words JOIN rule_terms USING (kind, w)
  GROUP BY ALL)"""
VECS = "vecs AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS vec FROM embeddings)"


def assigned(name: str, source: str, id_col: str, factor: int, offset: int) -> str:
    return f"""{name} AS (SELECT s.{id_col}, v.vec FROM {source} s JOIN vecs v
  ON v.vec_id = (s.{id_col} * {factor} + {offset}) % (SELECT count(*) FROM vecs))"""


HYBRID = f"""{KEYWORDS}, {VECS}, {assigned('qvec', 'items', 'query_id', 31, 0)}, {assigned('rvec', 'rules', 'rule_id', 1, 0)},
fused AS (SELECT q.query_id, r.rule_id, coalesce(k.kw, 0) AS kw, list_cosine_similarity(q.vec, r.vec) AS cos,
    max(coalesce(k.kw, 0)) OVER (PARTITION BY q.query_id) AS top_kw
  FROM qvec q CROSS JOIN rvec r LEFT JOIN kw k ON k.query_id = q.query_id AND k.rule_id = r.rule_id)"""


def best_rules(alpha: str, k: int, name: str = "best") -> str:
    return f"""{name} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, rule_id DESC) AS rank
  FROM (SELECT query_id, rule_id, kw, cos, CAST({alpha} AS DOUBLE) * kw / (top_kw + CAST(1e-9 AS DOUBLE))
    + (1 - CAST({alpha} AS DOUBLE)) * (cos + 1) / 2 AS score FROM fused)) WHERE rank <= {k})"""


ENTRIES = f"""brands AS (SELECT left(p_name, 1) AS letter, list_slice(list_sort(list_distinct(list(p_brand))), 1, 3) AS brands
  FROM part GROUP BY 1),
uses AS (SELECT doc_id, source, toks[pos] AS word, struct_pack(doc_id := doc_id, pos := pos - 1) AS entry_rank FROM (
  SELECT doc_id, source, toks, unnest(range(1, len(toks) + 1)) AS pos FROM (
    SELECT doc_id, source, {tok_ws('text')} AS toks FROM documents))),
entries AS (SELECT word, coalesce(brands, [word]) AS meanings, source, entry_rank
  FROM uses LEFT JOIN brands ON left(word, 1) = letter)"""
DICTIONARY = f"""{ENTRIES},
dict AS (SELECT word, arg_max(meanings, entry_rank) AS meanings, arg_max(source, entry_rank) AS source, min(entry_rank) AS entry_rank
  FROM entries GROUP BY word)"""
WORDS = f"words AS (SELECT DISTINCT w AS word FROM (SELECT unnest({tok_ws('text')}) AS w FROM benchmark))"


def word_counts(name: str, table: str, id_col: str, where: str = "TRUE") -> str:
    return f"""{name} AS (SELECT word, count(*) AS freq, min(struct_pack(doc := {id_col}, pos := pos - 1)) AS first_seen FROM (
  SELECT {id_col}, toks[pos] AS word, pos FROM (SELECT {id_col}, toks, unnest(range(1, len(toks) + 1)) AS pos FROM (
    SELECT {id_col}, {bert_tokens('lower(text)')} AS toks FROM {table} WHERE {where}))) GROUP BY word)"""


UNITS = "[CASE WHEN i = 1 THEN c ELSE '##' || c END FOR c, i IN string_split(word, '')]"
BASE_VOCAB = f"""{word_counts('base_words', 'benchmark', 'item_id')},
pieces AS (SELECT DISTINCT word, freq, piece FROM (
  SELECT word, freq, unnest({UNITS}) AS piece FROM base_words
  UNION ALL SELECT word, freq, word FROM base_words WHERE length(word) <= 4
  UNION ALL SELECT word, freq, '##' || right(word, 2) FROM base_words WHERE length(word) > 4
  UNION ALL SELECT word, freq, '##' || right(word, 3) FROM base_words WHERE length(word) > 4)),
kept AS (SELECT piece AS token FROM pieces GROUP BY piece ORDER BY sum(freq) DESC, piece LIMIT 30000),
base AS (
  SELECT unnest([{listed(C.SPECIALS_LIKELIHOOD)}]) AS token, CAST(unnest([0, 1, 2, 3, 4]) AS BIGINT) AS token_id
  UNION ALL SELECT token, 4 + row_number() OVER (ORDER BY token) FROM kept)"""
TRAINED = f"""{word_counts('trained_words', 'documents', 'doc_id')},
trained AS (SELECT word AS token FROM trained_words WHERE freq >= 2 ORDER BY freq DESC, word LIMIT 30000)"""
DOMAIN = "(" + " OR ".join(
    [rf"regexp_matches(lower(token), {quoted('^(?:' + p + ')')})" for p in C.DOMAIN_PATTERNS]
    + [f"contains(lower(token), {quoted(k)})" for k in C.DOMAIN_KEYWORDS]
) + rf") AND token NOT IN ({listed(C.SPECIALS_FREQUENCY)}) AND length(token) > 1 AND NOT regexp_matches(token, '^(\p{{Nd}}+|[^\p{{L}}\p{{N}}_]+)$')"


def selected(n: int) -> str:
    return f"""fresh AS (SELECT token, CASE WHEN {DOMAIN} THEN 1 ELSE 2 END AS tier FROM trained
  WHERE token NOT IN (SELECT token FROM base)),
chosen AS (SELECT *, row_number() OVER (ORDER BY tier, length(token) DESC, token) AS pos FROM fresh
  WHERE tier = 1 OR (length(token) >= 3 AND token[1:2] <> '##') QUALIFY pos <= {n})"""


def walk(words: str, vocab: str, prefix: str = "") -> str:
    """Greedy encoding by recursion over start positions; table ``{prefix}enc(word, tokens)``."""
    p = prefix
    return f"""{p}spans AS (SELECT word, s, max(e) AS e FROM (
  SELECT word, s, unnest(range(s, length(word) + 1)) AS e FROM (
    SELECT word, unnest(range(1, length(word) + 1)) AS s FROM {words}))
  JOIN {vocab} ON token = CASE WHEN s = 1 THEN '' ELSE '##' END || substring(word, s, e - s + 1) GROUP BY word, s),
{p}steps AS (
  SELECT word, CAST(1 AS BIGINT) AS at, []::VARCHAR[] AS tokens FROM {words}
  UNION ALL
  SELECT t.word, x.e + 1, list_append(t.tokens, CASE WHEN t.at = 1 THEN '' ELSE '##' END || substring(t.word, t.at, x.e - t.at + 1))
  FROM {p}steps t JOIN {p}spans x ON x.word = t.word AND x.s = t.at),
{p}enc AS (SELECT w.word, coalesce(s.tokens, ['[UNK]']) AS tokens FROM (SELECT DISTINCT word FROM {words}) w
  LEFT JOIN {p}steps s ON s.word = w.word AND s.at = length(w.word) + 1)"""
