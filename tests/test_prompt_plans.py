"""Prompts with dictionary lines: their text, and the size of their plan."""

from textloom.functions import constants as C
from textloom.operators import lookup, prompts

DICTIONARY = [("red", ["hong"], 0), ("foxes", ["huli", "many"], 1), ("barn", ["cang"], 2), ("owl", [], 3), ("owls", ["x"], 4)]


def tables(spark):
    words = [(w, m, "s", (1, i)) for w, m, i in DICTIONARY]
    return (
        spark.createDataFrame([(1, "red foxy"), (2, "owl"), (3, None)], "query_id long, text string"),
        spark.createDataFrame([(10, "Barnred owl", "T10"), (11, "red red", "T11"), (11, "owl", "again"), (12, "owl", "T12"), (None, "red", "none")], "pair_id long, src string, tgt string"),
        spark.createDataFrame([(1, 10, 1), (1, 11, 2), (2, None, 1)], "query_id long, pair_id long, rank int"),
        spark.createDataFrame(words, "word string, meanings array<string>, source string, entry_rank struct<doc_id:bigint,pos:int>"),
        spark.createDataFrame([(2, 1, "R1"), (2, 2, "R2")], "query_id long, rank int, rule_text string"),
    )


def built(spark):
    queries, pairs, ranked, dictionary, rules = tables(spark)
    return prompts.build_prompt_dict(queries, pairs, ranked, lambda words: lookup.dict_lookup(words, dictionary, min_chars=3), rules)


def lines(*found):
    a, b, c = C.DICT_PROMPT_WORD
    return "".join(f"{a}{match}{b}{meaning}{c}" for match, meaning in found)


def ask(sentence, *found):
    return C.DICT_PROMPT_ASK + sentence + "\n" + C.DICT_PROMPT_WORDS + lines(*found)


def answered(answer):
    return f"{C.DICT_PROMPT_ANSWER} {answer}\n\n"


def test_prompts_and_no_plan_holds_that_of_an_earlier_stage_more_than_once(spark):
    found = built(spark)
    plan = found._jdf.queryExecution().executedPlan().toString()
    # 14,641 exchanges while the tables between the stages were persisted.
    assert plan.count("Exchange ") < 20
    rows = {r.query_id: r.prompt for r in found.collect()}
    red, owl = ("red", "hong"), ("owl", "")
    # The words of both rows of a repeated pair come under each, and each sentence meets each answer, once a row.
    shots = [ask(s, owl, red, red) + answered(t) for s in ("owl", "red red") for t in ("T11", "T11", "again", "again")]
    shots.append(ask("Barnred owl", ("barn", "cang"), red, owl) + answered("T10"))
    assert rows == {
        1: C.DICT_PROMPT_HEAD + "".join(shots) + ask("red foxy", red, ("foxes", "hulimany"), owl) + C.DICT_PROMPT_ANSWER,
        2: C.DICT_PROMPT_HEAD + ask("owl", owl) + C.DICT_PROMPT_RULES + "R1\nR2\n" + C.DICT_PROMPT_ANSWER,
        3: None,
    }
