"""Queries on prompt tables and translation metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions import constants as C
from textloom.functions import text as T
from textloom.operators import lexical, lookup, prompts, translation_metrics as M, vector
from textloom.plans import inputs as I
from textloom.plans import queries_retrieval as R
from textloom.plans import sql as S
from textloom.plans.registry import query
from textloom.session import written

# The chosen rule of an item is the best hybrid one.
_CHOSEN = f"{S.HYBRID}, {S.best_rules('0.5', 5)}, chosen AS (SELECT query_id, rule_id FROM best WHERE rank = 1)"
_MERGED = f"""item_first AS (SELECT query_id, toks[pos] AS w, min(pos) AS pos FROM (
  SELECT query_id, toks, unnest(range(1, len(toks) + 1)) AS pos FROM (SELECT query_id, {S.tok_ws('za')} AS toks FROM items))
  WHERE length(toks[pos]) > 6 GROUP BY ALL),
rule_first AS (SELECT rule_id, ex, toks[pos] AS w, min(pos) AS pos FROM (
  SELECT rule_id, ex, toks, unnest(range(1, len(toks) + 1)) AS pos FROM (
    SELECT rule_id, pos AS ex, {S.tok_ws('za')} AS toks FROM examples)) WHERE length(toks[pos]) > 6 GROUP BY ALL),
named AS (SELECT query_id, w AS word, substring(w, 1, 2) AS meaning, 0 AS ex, pos FROM item_first
  UNION ALL SELECT query_id, w, substring(w, 1, 3), ex, pos FROM chosen JOIN rule_first USING (rule_id)),
merged AS (SELECT query_id, word, arg_max(meaning, ex * 1000000 + pos) AS meaning, min(ex * 1000000 + pos) AS place FROM named GROUP BY ALL)"""


def chosen_rules(spark: SparkSession, sf: str) -> DataFrame:
    return R.hybrid(spark, sf).where("rank = 1").select("query_id", "rule_id")


@query(
    "merge_vocab",
    f"WITH {_CHOSEN}, {_MERGED} SELECT query_id, word, meaning, row_number() OVER (PARTITION BY query_id ORDER BY place) AS place FROM merged",
)
def merge_vocab(spark: SparkSession, sf: str) -> DataFrame:
    merged = prompts.merge_vocab(I.items(spark, sf), I.rules(spark, sf), chosen_rules(spark, sf))
    # The words of one sentence and one rule are numbered in their order.
    pieces = merged.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("rank", "word", "meaning"))).alias("ws"))
    flat = pieces.select("query_id", F.posexplode("ws").alias("place", "w"))
    return flat.select("query_id", "w.word", "w.meaning", (F.col("place") + 1).cast("long").alias("place"))


_EXAMPLE_ID = 2**32


def few_shot(spark: SparkSession, sf: str, items: DataFrame, k: int = 3) -> DataFrame:
    """``(query_id, rank, za, zh)``: nearest examples of all rules."""
    pool = prompts_pool(spark, sf)
    vecs = I.assigned_vectors(spark, sf, pool.select("id"), 13, 5)
    near = vector.cosine_topk(R.item_vectors(spark, sf, items), vecs, k, high_id_first=True)
    return near.select("query_id", "rank", F.col("item_id").alias("id")).join(pool, "id").select("query_id", "rank", "za", "zh")


def prompts_pool(spark: SparkSession, sf: str) -> DataFrame:
    """``(id, za, zh)``: all examples of all rules; the id keeps rule and position."""
    rules = I.rules(spark, sf)
    flat = rules.select("rule_id", F.posexplode("examples").alias("pos", "e"))
    return flat.select((F.col("rule_id") * _EXAMPLE_ID + F.col("pos") + 1).alias("id"), "e.za", "e.zh")


_SHOTS = f"""pool AS (SELECT rule_id * {_EXAMPLE_ID} + pos AS id, za FROM examples), {S.assigned('pv', 'pool', 'id', 13, 5)},
shots AS (SELECT query_id, id, rank FROM (SELECT q.query_id, p.id, row_number() OVER (PARTITION BY q.query_id
  ORDER BY round(list_cosine_similarity(q.vec, p.vec), 9) DESC, p.id DESC) AS rank FROM qvec q CROSS JOIN pv p) WHERE rank <= 3)"""
_PROMPT = f"""{_CHOSEN}, {_MERGED}, {_SHOTS},
word_text AS (SELECT query_id, string_agg('  ' || word || ': ' || meaning || chr(10), '' ORDER BY place) AS t FROM merged GROUP BY 1),
shot_text AS (SELECT query_id, string_agg('  Zhuang: ' || za || chr(10) || '  Chinese: zh ' || za || chr(10), '' ORDER BY rank) AS t
  FROM shots JOIN pool USING (id) GROUP BY 1),
prompted AS (SELECT i.query_id, i.za, {S.quoted(C.PROMPT_ROLE)}
  || CASE WHEN w.t IS NULL THEN '' ELSE {S.quoted(C.PROMPT_VOCABULARY)} || w.t || chr(10) END
  || CASE WHEN s.t IS NULL THEN '' ELSE {S.quoted(C.PROMPT_EXAMPLES)} || s.t || chr(10) END
  || CASE WHEN r.rule_id IS NULL THEN '' ELSE {S.quoted(C.PROMPT_RULE)} || r.grammar_description || {S.quoted(C.PROMPT_RULE_END)} END AS head
  FROM items i LEFT JOIN word_text w USING (query_id) LEFT JOIN shot_text s USING (query_id)
  LEFT JOIN chosen c USING (query_id) LEFT JOIN rules r ON r.rule_id = c.rule_id)"""


def hybrid_prompts(spark: SparkSession, sf: str, chain_of_thought: bool = True) -> DataFrame:
    items, rules, chosen = I.items(spark, sf), I.rules(spark, sf), chosen_rules(spark, sf).persist()
    words = prompts.merge_vocab(items, rules, chosen)
    described = chosen.join(rules, "rule_id").select("query_id", "grammar_description")
    return prompts.build_prompt(items, words, few_shot(spark, sf, items), described, chain_of_thought)


def _prompt_sql(task: str) -> str:
    return f"""head || {S.quoted(C.PROMPT_TASK + task + C.PROMPT_SENTENCE)} || za || '"'"""


@query("build_prompt", f"WITH {_PROMPT} SELECT query_id, {_prompt_sql(C.PROMPT_TASK_STEPS)} AS prompt FROM prompted")
def build_prompt(spark: SparkSession, sf: str) -> DataFrame:
    return hybrid_prompts(spark, sf)


@query("build_prompt_plain", f"WITH {_PROMPT} SELECT query_id, {_prompt_sql(C.PROMPT_TASK_PLAIN)} AS prompt FROM prompted")
def build_prompt_plain(spark: SparkSession, sf: str) -> DataFrame:
    return hybrid_prompts(spark, sf, chain_of_thought=False)


@query(
    "build_review_prompt",
    f"""WITH {_PROMPT} SELECT query_id, {S.quoted(C.REVIEW_HEAD)} || za || '"' || chr(10) || head || {S.quoted(C.REVIEW_ANSWER)}
      || 'answer ' || query_id || {S.quoted(C.REVIEW_TASK)} AS prompt FROM prompted""",
)
def build_review_prompt(spark: SparkSession, sf: str) -> DataFrame:
    rows = I.items(spark, sf).select("query_id", "za").join(hybrid_prompts(spark, sf), "query_id")
    answer = F.concat(F.lit("answer "), F.col("query_id"))
    return rows.select("query_id", prompts.build_review_prompt(F.col("za"), F.col("prompt"), answer).alias("prompt"))


_WORD = tuple(S.quoted(x) for x in C.DICT_PROMPT_WORD)
_DICT_PROMPT = f"""{S.PAIRS}, {R._bm25_sql('pairs', 'pair_id', 'src', 'benchmark', 'item_id', 'text', 3)},
{S.RULES}, {S.VECS}, {R.semantic_sql('benchmark', 'item_id')}, {S.DICTIONARY},
sentences AS (SELECT 'q' || item_id AS key, text AS sentence FROM benchmark
  UNION ALL SELECT 'p' || pair_id, src FROM pairs WHERE pair_id IN (SELECT pair_id FROM bm25)),
used AS (SELECT key, pos, toks[pos] AS word FROM (SELECT key, toks, unnest(range(1, len(toks) + 1)) AS pos FROM (
  SELECT key, {S.tok_ws('sentence')} AS toks FROM sentences))),
words AS (SELECT DISTINCT word FROM used),
missing AS (SELECT word FROM words WHERE word NOT IN (SELECT word FROM dict)),
pool AS (SELECT word AS match, entry_rank FROM dict WHERE length(word) >= 3),
{R.LOOKUP_SQL.replace('asked_fuzzy AS (SELECT word FROM missing)', 'asked_fuzzy AS (SELECT word FROM missing WHERE word NOT IN (SELECT word FROM prefix JOIN suffix USING (word)))')},
lines AS (SELECT f.word, string_agg({_WORD[0]} || f.match || {_WORD[1]} || array_to_string(list_slice(meanings, 1, 2), '') || {_WORD[2]}, '' ORDER BY n) AS line
  FROM found f JOIN dict d ON d.word = f.match GROUP BY f.word),
ask AS (SELECT s.key, {S.quoted(C.DICT_PROMPT_ASK)} || any_value(s.sentence) || chr(10) || {S.quoted(C.DICT_PROMPT_WORDS)}
  || coalesce(string_agg(line, '' ORDER BY pos), '') AS t FROM sentences s LEFT JOIN used u ON u.key = s.key LEFT JOIN lines l ON l.word = u.word GROUP BY s.key),
shot_text AS (SELECT query_id, string_agg(t || {S.quoted(C.DICT_PROMPT_ANSWER + ' ')} || tgt || chr(10) || chr(10), '' ORDER BY rank DESC) AS t
  FROM bm25 JOIN pairs USING (pair_id) JOIN ask ON key = 'p' || pair_id GROUP BY 1),
rule_text AS (SELECT query_id, string_agg(rule_text || chr(10), '' ORDER BY rank) AS t FROM near_text GROUP BY 1)"""


@query(
    "build_prompt_dict",
    f"""WITH {_DICT_PROMPT} SELECT item_id AS query_id, {S.quoted(C.DICT_PROMPT_HEAD)} || coalesce(s.t, '') || a.t
      || CASE WHEN r.t IS NULL THEN '' ELSE {S.quoted(C.DICT_PROMPT_RULES)} || r.t END || {S.quoted(C.DICT_PROMPT_ANSWER)} AS prompt
    FROM benchmark b JOIN ask a ON a.key = 'q' || b.item_id LEFT JOIN shot_text s ON s.query_id = b.item_id
    LEFT JOIN rule_text r ON r.query_id = b.item_id""",
)
def build_prompt_dict(spark: SparkSession, sf: str) -> DataFrame:
    """Three ranked turn pairs per passage, dictionary lines for every sentence, nearest rules."""
    queries, pairs = I.passages(spark, sf), I.parallel_pairs(spark, sf)
    docs = pairs.select("pair_id", "src")
    best = lexical.bm25_topk(queries, docs, T.tokenize_ws(F.col("text")), T.tokenize_ws(F.col("src")), k=3)
    ranked = written(best.select("query_id", "pair_id", "rank"), "ranked")
    dictionary = written(I.dictionary(spark, sf), "dictionary")
    rules = prompts.semantic_rules(R.item_vectors(spark, sf, queries), I.rules(spark, sf), R.rule_vectors(spark, sf))
    return prompts.build_prompt_dict(
        queries, pairs, ranked, lambda words: lookup.dict_lookup(words, dictionary, min_chars=3), rules
    )


@query(
    "result_table",
    f"""WITH {S.LEVELLED} SELECT id, pred AS query, CASE WHEN id % 2 = 0 THEN gold END AS pred, gold,
      CASE WHEN id % 3 = 0 THEN 'prompt ' || id END AS prompt, CASE WHEN id % 5 = 0 THEN 'unknown' ELSE source END AS source FROM rated""",
)
def result_table(spark: SparkSession, sf: str) -> DataFrame:
    rows = I.translations(spark, sf)
    source = F.when(F.col("id") % 5 != 0, F.col("source")).alias("source")
    items = rows.select("id", F.col("pred").alias("za"), F.col("gold").alias("zh"), source)
    predictions = rows.where("id % 2 = 0").select("id", F.col("gold").alias("pred"))
    asked = rows.where("id % 3 = 0").select("id", F.concat(F.lit("prompt "), F.col("id")).alias("prompt"))
    return prompts.result_table(items, predictions, asked)


# The standard tokenizer, as replacements in order.
_T13A = [
    (r"([\{-~\[-` -&\(-\+:-@/])", r" \1 "),
    (r"([^0-9])([.,])", r"\1 \2 "),
    (r"([.,])([^0-9])", r" \1 \2"),
    (r"([0-9])(-)", r"\1 \2 "),
]


def _sql_13a(x: str) -> str:
    out = f"replace(replace(replace(lower({x}), '<skipped>', ''), '-' || chr(10), ''), chr(10), ' ')"
    for found, put in (("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")):
        out = f"replace({out}, '{found}', '{put}')"
    return _sql_marks(out)


def _sql_zh(x: str) -> str:
    cjk = f"([{C.CJK_CHARS}\\x{{3000}}-\\x{{303f}}\\x{{ff00}}-\\x{{ffef}}])"
    return _sql_marks(rf"regexp_replace({S.strip(f'lower({x})')}, '{cjk}', ' \1 ', 'g')")


def _sql_marks(x: str) -> str:
    out = f"' ' || {x} || ' '"
    for found, put in _T13A:
        out = f"regexp_replace({out}, {S.quoted(found)}, {S.quoted(put)}, 'g')"
    return S.split_any(out)


def _sql_chars(x: str) -> str:
    bare = f"regexp_replace(lower({x}), '[{S.WS}]+', '', 'g')"
    return S.chars(bare)


def _sql_words(x: str) -> str:
    marks = r"[!-/:-@\[-`{-~]"
    return f"""flatten([CASE WHEN length(w) = 1 THEN [w] WHEN regexp_matches(w, {S.quoted(marks + '$')}) THEN [left(w, length(w) - 1), right(w, 1)]
      WHEN regexp_matches(w, {S.quoted('^' + marks)}) THEN [left(w, 1), substring(w, 2)] ELSE [w] END FOR w IN {S.split_any(f'lower({x})')}])"""


def _gram_sql(name: str, tokenizer, orders: int, first: int) -> str:
    """Counts per row, order and n-gram on both sides; clipped matches by a join."""
    sides = " UNION ALL ".join(
        f"""SELECT id, source, {n} AS n, '{side}' AS side, unnest([array_to_string(list_slice(t, i, i + {n - 1}), chr(1))
          FOR i IN range(1, len(t) - {n - 2})]) AS g FROM (SELECT id, source, {tokenizer(side)} AS t FROM rated)"""
        for n in range(1, orders + 1)
        for side in ("pred", "gold")
    )
    return f"""{name}_g AS ({sides}),
{name}_c AS (SELECT id, source, n, g, count(*) FILTER (side = 'pred') AS p, count(*) FILTER (side = 'gold') AS r FROM {name}_g GROUP BY ALL),
{name}_r AS (SELECT id, source, n + {first} AS n, sum(least(p, r)) AS m, sum(p) AS p, sum(r) AS r FROM {name}_c GROUP BY ALL)"""


_LEVELS = "(SELECT id, source, n, m, p, r, source AS level FROM {t} UNION ALL SELECT id, source, n, m, p, r, 'overall' FROM {t})"


def _bleu_sql(name: str) -> str:
    rows = _LEVELS.format(t=f"{name}_r")
    return f"""{name}_s AS (SELECT level, n, CAST(sum(m) AS DOUBLE) AS m, CAST(sum(p) AS DOUBLE) AS p, CAST(sum(r) AS DOUBLE) AS r
  FROM {rows} GROUP BY level, n),
{name}_z AS (SELECT *, sum(CASE WHEN m = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY level ORDER BY n) AS zeros FROM {name}_s),
{name} AS (SELECT level, round_even(CASE WHEN min(p) > 0 AND max(m) > 0 AND count(*) = 4 THEN
    100 * least(1, exp(1 - max(r) FILTER (n = 1) / max(p) FILTER (n = 1)))
    * exp(sum(CASE WHEN m > 0 THEN ln(m / p) ELSE -ln(pow(2, zeros) * greatest(p, 1)) END) / 4) ELSE 0 END, 4) AS score FROM {name}_z GROUP BY level)"""


def _chrf_sql(name: str, sources: list[str]) -> str:
    union = " UNION ALL ".join(f"SELECT id, source, n, m, CASE WHEN r > 0 THEN p ELSE 0 END AS p, r FROM {s}_r" for s in sources)
    return f"""{name}_u AS ({union}),
{name}_s AS (SELECT level, n, CAST(sum(m) AS DOUBLE) AS m, CAST(sum(p) AS DOUBLE) AS p, CAST(sum(r) AS DOUBLE) AS r
  FROM {_LEVELS.format(t=f'{name}_u')} GROUP BY level, n),
{name}_a AS (SELECT level, avg(m / p) AS p, avg(m / r) AS r FROM {name}_s WHERE p > 0 AND r > 0 GROUP BY level),
{name} AS (SELECT level, round_even(CASE WHEN p + r > 0 THEN 100 * 5 * p * r / (4 * p + r) ELSE 0 END, 4) AS score FROM {name}_a)"""


_BLEU = f"{S.LEVELLED}, {_gram_sql('b', _sql_13a, 4, 0)}, {_bleu_sql('b')}"
_CHRF = f"{_gram_sql('c', _sql_chars, 6, 0)}, {_chrf_sql('chrf', ['c'])}"
_CHRFPP = f"{_gram_sql('c', _sql_chars, 6, 0)}, {_gram_sql('w', _sql_words, 2, 6)}, {_chrf_sql('pp', ['c', 'w'])}"


@query("corpus_bleu", f"WITH {_BLEU} SELECT score FROM b WHERE level = 'overall'")
def corpus_bleu(spark: SparkSession, sf: str) -> DataFrame:
    return M.corpus_bleu(I.translations(spark, sf))


@query("corpus_bleu_zh", f"WITH {S.LEVELLED}, {_gram_sql('b', _sql_zh, 4, 0)}, {_bleu_sql('b')} SELECT score FROM b WHERE level = 'overall'")
def corpus_bleu_zh(spark: SparkSession, sf: str) -> DataFrame:
    return M.corpus_bleu(I.translations(spark, sf), M.tokenize_zh)


@query("char_bleu", f"WITH {S.LEVELLED}, {_gram_sql('b', _sql_chars, 4, 0)}, {_bleu_sql('b')} SELECT score FROM b WHERE level = 'overall'")
def char_bleu(spark: SparkSession, sf: str) -> DataFrame:
    return M.char_bleu(I.translations(spark, sf))


@query("chrf", f"WITH {S.LEVELLED}, {_CHRF} SELECT score FROM chrf WHERE level = 'overall'")
def chrf(spark: SparkSession, sf: str) -> DataFrame:
    return M.chrf(I.translations(spark, sf))


@query("chrfpp", f"WITH {S.LEVELLED}, {_CHRFPP} SELECT score FROM pp WHERE level = 'overall'")
def chrfpp(spark: SparkSession, sf: str) -> DataFrame:
    return M.chrf(I.translations(spark, sf), word_order=2)


@query(
    "metrics_by_level",
    f"""WITH {_BLEU}, {_CHRFPP}, {_chrf_sql('chrf', ['c'])}
    SELECT level, b.score AS bleu, pp.score AS chrfpp, chrf.score AS chrf FROM b JOIN pp USING (level) JOIN chrf USING (level)""",
)
def metrics_by_level(spark: SparkSession, sf: str) -> DataFrame:
    return M.metrics_by_level(I.translations(spark, sf))
