"""Prompt tables: merged vocabularies, retrieval prompts, review prompts, result assembly."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions import constants as C
from textloom.functions import text as T
from textloom.operators.vector import cosine_topk
from textloom.session import written


def merge_vocab(items: DataFrame, rules: DataFrame | None, chosen: DataFrame | None) -> DataFrame:
    """``(query_id, word, meaning, rank)``: item words overlaid by the example words of the chosen rule.

    A word keeps its first place and gets its last meaning. ``chosen`` is ``(query_id, rule_id)``.
    """
    own = items.select("query_id", F.posexplode_outer(F.map_entries("related_words")).alias("pos", "e")).where("e is not null")
    words = own.select("query_id", F.lit(-1).alias("example"), "pos", "e.key", "e.value")
    if rules is not None and chosen is not None:
        examples = rules.select("rule_id", F.posexplode("examples").alias("example", "ex"))
        ruled = examples.select(
            "rule_id", "example", F.posexplode_outer(F.map_entries("ex.related_words")).alias("pos", "e")
        ).where("e is not null")
        ruled = chosen.select("query_id", "rule_id").join(ruled, "rule_id")
        words = words.unionByName(ruled.select("query_id", "example", "pos", "e.key", "e.value"))
    rank = F.col("example").cast("long") * F.lit(2**32) + F.col("pos")
    return words.groupBy("query_id", F.col("key").alias("word")).agg(
        F.max_by("value", rank).alias("meaning"), F.min(rank).alias("rank")
    )


def _joined(rows: DataFrame, order: Column, text: Column, name: str) -> DataFrame:
    """Text pieces of each query in order, as one string."""
    pieces = F.array_sort(F.collect_list(F.struct(order.alias("o"), text.alias("t"))))
    return rows.groupBy("query_id").agg(F.array_join(F.transform(pieces, lambda p: p["t"]), "").alias(name))


def _section(head: str, column: str, tail: str) -> Column:
    return F.when(F.col(column).isNotNull(), F.concat(F.lit(head), F.col(column), F.lit(tail))).otherwise("")


def build_prompt(
    items: DataFrame, vocabulary: DataFrame, examples: DataFrame, rules: DataFrame, chain_of_thought: bool = True
) -> DataFrame:
    """``(query_id, prompt)``; sections without content are left out.

    ``items`` is ``(query_id, za)``, ``examples`` ``(query_id, rank, za, zh)``, ``rules``
    ``(query_id, grammar_description)`` with at most one row per query.
    """
    words = _joined(vocabulary, F.col("rank"), F.concat(F.lit("  "), "word", F.lit(": "), "meaning", F.lit("\n")), "words")
    shot = F.concat(F.lit("  Zhuang: "), F.coalesce("za", F.lit("")), F.lit("\n  Chinese: "), F.coalesce("zh", F.lit("")), F.lit("\n"))
    shots = _joined(examples, F.col("rank"), shot, "shots")
    rule = rules.select("query_id", F.coalesce("grammar_description", F.lit("None")).alias("rule"))
    parts = items.select("query_id", "za").join(words, "query_id", "left").join(shots, "query_id", "left").join(rule, "query_id", "left")
    task = C.PROMPT_TASK_STEPS if chain_of_thought else C.PROMPT_TASK_PLAIN
    prompt = F.concat(
        F.lit(C.PROMPT_ROLE),
        _section(C.PROMPT_VOCABULARY, "words", "\n"),
        _section(C.PROMPT_EXAMPLES, "shots", "\n"),
        _section(C.PROMPT_RULE, "rule", C.PROMPT_RULE_END),
        F.lit(C.PROMPT_TASK + task + C.PROMPT_SENTENCE),
        F.col("za"),
        F.lit('"'),
    )
    return parts.select("query_id", prompt.alias("prompt"))


def build_review_prompt(sentence: Column, prompt: Column, answer: Column) -> Column:
    """Second prompt: sentence, the background part of the first prompt, and the first answer."""
    background = F.substring_index(prompt, C.PROMPT_TASK, 1)
    return F.concat(
        F.lit(C.REVIEW_HEAD), sentence, F.lit('"\n'), background, F.lit(C.REVIEW_ANSWER), answer, F.lit(C.REVIEW_TASK)
    )


def semantic_rules(query_vecs: DataFrame, rules: DataFrame, rule_vecs: DataFrame, k: int = 2, floor: float = 0.5) -> DataFrame:
    """``(query_id, rank, score, rule_id, rule_text)``: nearest described rules with cosine above ``floor``."""
    described = rules.where(F.coalesce("grammar_description", F.lit("")) != "")
    near = cosine_topk(query_vecs, rule_vecs.join(described.select(F.col("rule_id").alias("id")), "id", "left_semi"), k)
    first = F.get("examples", 0)
    head, middle, tail = C.RULE_EXAMPLE
    example = F.concat(
        F.lit(C.RULE_EXAMPLES + head), F.coalesce(first["za"], F.lit("")), F.lit(middle), F.coalesce(first["zh"], F.lit("")), F.lit(tail)
    )
    text = F.concat(
        F.lit(C.RULE_DESCRIPTION), "grammar_description", F.lit("\n"), F.when(F.size("examples") > 0, example).otherwise("")
    )
    kept = near.where(F.col("score") > floor).withColumnRenamed("item_id", "rule_id")
    return kept.join(described.select("rule_id", text.alias("rule_text")), "rule_id").select(
        "query_id", "rank", "score", "rule_id", "rule_text"
    )


def word_lines(found: DataFrame) -> DataFrame:
    """``(word, line)``: the prompt lines of each looked-up word; meanings are joined without separator."""
    a, b, c = C.DICT_PROMPT_WORD
    line = F.concat(F.lit(a), "match", F.lit(b), F.array_join("meanings", ""), F.lit(c))
    ordered = F.array_sort(F.collect_list(F.struct(F.col("n").alias("o"), line.alias("t"))))
    return found.groupBy("word").agg(F.array_join(F.transform(ordered, lambda p: p["t"]), "").alias("line"))


def sentence_words(sentences: DataFrame, key: str, tokens: Column) -> DataFrame:
    """``(key, pos, word)`` in sentence order, repeats included."""
    return sentences.select(key, F.posexplode_outer(tokens).alias("pos", "word")).where(F.col("word").isNotNull())


def explain_words(sentences: DataFrame, key: str, tokens: Column, lines: DataFrame) -> DataFrame:
    """``(key, words)``: the word lines of each sentence."""
    uses = sentence_words(sentences, key, tokens).join(lines, "word")
    ordered = F.array_sort(F.collect_list(F.struct(F.col("pos").alias("o"), F.col("line").alias("t"))))
    text = uses.groupBy(key).agg(F.array_join(F.transform(ordered, lambda p: p["t"]), "").alias("t"))
    joined = sentences.select(key).join(text, key, "left")
    return joined.select(key, F.concat(F.lit(C.DICT_PROMPT_WORDS), F.coalesce("t", F.lit(""))).alias("words"))


def build_prompt_dict(
    queries: DataFrame,
    pairs: DataFrame,
    ranked: DataFrame,
    lookup: Callable[[DataFrame], DataFrame],
    rules: DataFrame,
    tokens: Callable[[Column], Column] = T.tokenize_ws,
) -> DataFrame:
    """``(query_id, prompt)``: ranked examples (best last) with word lines, the sentence with its own, then rules.

    ``lookup`` maps ``(word)`` to dictionary matches and runs once over the distinct words of all sentences. The ranked
    pairs and the explained sentences, a few rows a query, are written, so that no plan holds theirs more than once.
    """
    used = written(pairs.join(ranked.select("pair_id").distinct(), "pair_id", "left_semi").select("pair_id", "src", "tgt"), "pairs")
    sentences = queries.select(F.concat(F.lit("q"), "query_id").alias("key"), F.col("text").alias("sentence")).unionByName(
        used.select(F.concat(F.lit("p"), "pair_id").alias("key"), F.col("src").alias("sentence"))
    )
    words = sentence_words(sentences, "key", tokens(F.col("sentence"))).select("word").distinct()
    explained = explain_words(sentences, "key", tokens(F.col("sentence")), word_lines(lookup(words)))
    asked = sentences.join(explained, "key").select("key", F.concat(F.lit(C.DICT_PROMPT_ASK), "sentence", F.lit("\n"), "words").alias("ask"))
    asked = written(asked, "asked")
    shots = ranked.join(used.select("pair_id", "tgt"), "pair_id").withColumn("key", F.concat(F.lit("p"), "pair_id"))
    shot = F.concat("ask", F.lit(C.DICT_PROMPT_ANSWER + " "), "tgt", F.lit("\n\n"))
    example_text = _joined(shots.join(asked, "key"), -F.col("rank"), shot, "shots")
    rule_text = _joined(rules, F.col("rank"), F.concat("rule_text", F.lit("\n")), "rules")
    parts = queries.withColumn("key", F.concat(F.lit("q"), "query_id")).join(asked, "key")
    parts = parts.join(example_text, "query_id", "left").join(rule_text, "query_id", "left")
    prompt = F.concat(
        F.lit(C.DICT_PROMPT_HEAD),
        F.coalesce("shots", F.lit("")),
        F.col("ask"),
        _section(C.DICT_PROMPT_RULES, "rules", ""),
        F.lit(C.DICT_PROMPT_ANSWER),
    )
    return parts.select("query_id", prompt.alias("prompt"))


PROMPT_BUILDERS: dict[str, Callable[..., DataFrame]] = {"hybrid": build_prompt, "dictionary": build_prompt_dict}


def result_table(items: DataFrame, predictions: DataFrame, prompts: DataFrame) -> DataFrame:
    """``(id, query, pred, gold, prompt, source)``; the source defaults to ``unknown``."""
    return (
        items.join(predictions.select("id", "pred"), "id", "left")
        .join(prompts.select("id", "prompt"), "id", "left")
        .select("id", F.col("za").alias("query"), "pred", F.col("zh").alias("gold"), "prompt", F.coalesce("source", F.lit("unknown")).alias("source"))
    )
