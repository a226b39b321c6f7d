"""Contract of a nested response set, checked on the raw JSON of each item."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RULES = [
    "item_is_object",
    "id_is_integer",
    "question_is_string",
    "reference_answer_is_string",
    "model_responses_is_list",
    "response_is_object",
    "model_is_string",
    "output_is_string",
    "remark_is_string",
    "at_least_two_items",
]


def _kind(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value), F.lit("VOID"))


def _field(value: Column, name: str) -> Column:
    return F.try_variant_get(value, f"$.{name}", "variant")


def _broken(cond: Column, rule: str) -> Column:
    return F.when(cond, F.lit(rule))


def item_violations(items: DataFrame, column: str = "item") -> DataFrame:
    """``(item_id, rule)`` for each broken rule; ``items`` is ``(item_id, item VARIANT)``."""
    value = F.col(column)
    is_object = _kind(value).startswith("OBJECT")
    number = _field(value, "id")
    # Integers beyond 64 bits are parsed as decimals.
    wide = _kind(number).startswith("DECIMAL") & F.try_variant_get(number, "$", "string").rlike("^-?[0-9]{19,}$")
    is_integer = (_kind(number) == "BIGINT") | F.coalesce(wide, F.lit(False))
    item_rules = F.array(
        _broken(~is_object, "item_is_object"),
        _broken(is_object & ~is_integer, "id_is_integer"),
        *[
            _broken(is_object & (_kind(_field(value, name)) != "STRING"), f"{name}_is_string")
            for name in ("question", "reference_answer")
        ],
        _broken(is_object & ~_kind(_field(value, "model_responses")).startswith("ARRAY"), "model_responses_is_list"),
    )
    responses = F.try_variant_get(value, "$.model_responses", "array<variant>")

    def response_rules(r: Column) -> Column:
        is_map = _kind(r).startswith("OBJECT")
        return F.array(
            _broken(~is_map, "response_is_object"),
            *[
                _broken(is_map & (_kind(_field(r, name)) != "STRING"), f"{name}_is_string")
                for name in ("model", "output", "remark")
            ],
        )

    nested = F.flatten(F.transform(responses, response_rules))
    broken = F.array_compact(F.concat(item_rules, F.coalesce(nested, F.array().cast("array<string>"))))
    return items.select("item_id", F.explode_outer(broken).alias("rule")).where(F.col("rule").isNotNull())


def validate_responses(items: DataFrame, column: str = "item", strict: bool = False) -> DataFrame:
    """``(rule, violations, first_bad_item)`` for every rule of the contract; ``strict`` raises instead.

    JSON ``true`` is not accepted as an integer id.
    """
    found = item_violations(items, column).groupBy("rule").agg(
        F.count("*").alias("violations"), F.min("item_id").alias("first_bad_item")
    )
    few = items.agg(F.count("*").alias("n")).select(
        F.lit("at_least_two_items").alias("rule"),
        F.when(F.col("n") < 2, 1).otherwise(0).cast("long").alias("violations"),
        F.lit(None).cast("long").alias("first_bad_item"),
    )
    rules = items.sparkSession.createDataFrame([(r,) for r in RULES], "rule string")
    report = rules.join(F.broadcast(found.unionByName(few)), "rule", "left").select(
        "rule", F.coalesce("violations", F.lit(0)).alias("violations"), "first_bad_item"
    )
    if strict:
        first = report.where(F.col("violations") > 0).orderBy("first_bad_item").first()
        if first is not None:
            raise ValueError(f"contract broken: {first['rule']} (item {first['first_bad_item']})")
    return report


def explode_responses(responses: DataFrame) -> DataFrame:
    """One row per item and response; items without responses keep one row."""
    return responses.select("id", F.posexplode_outer("model_responses").alias("pos", "response")).select(
        "id", "pos", "response.model", "response.output", "response.remark"
    )
