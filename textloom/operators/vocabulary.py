"""Subword vocabulary learning: word table, alphabet, pair statistics and the two merge trainers."""

from __future__ import annotations

from decimal import Decimal

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegralType

from textloom.functions import constants as C
from textloom.functions import text as T
from textloom.operators import training
from textloom.session import cut_lineage

VOCAB_SCHEMA = "token string, token_id bigint"


_POSITIONS = 2**32
_NO_ID = -(2**63) - 1


def word_freq(docs: DataFrame, words: Column, id_col: str = "doc_id") -> DataFrame:
    """``(word, freq, first_seen)`` with ``first_seen`` as document and position, a null document before all others.

    One aggregate with map-side combine is all that sees the corpus. Whole-number ids make one decimal number with
    the position, which a hash aggregate can keep; it has room for every 64-bit id.
    """
    used = docs.select(F.col(id_col).alias("doc"), F.posexplode_outer(words).alias("pos", "word")).where(F.col("word").isNotNull())
    kind = used.schema["doc"].dataType
    if not isinstance(kind, IntegralType):
        return used.groupBy("word").agg(F.count("*").alias("freq"), F.min(F.struct("doc", "pos")).alias("first_seen"))
    counted = used.groupBy("word").agg(F.count("*").alias("freq"), F.min(place_number(F.col("doc"), F.col("pos"))).alias("place"))
    doc, pos = number_place(F.col("place"), kind)
    return counted.select("word", "freq", F.struct(doc.alias("doc"), pos.alias("pos")).alias("first_seen"))


def place_number(doc: Column, pos: Column) -> Column:
    """One decimal number for a document (a whole number, or null, which comes first) and a position in it, in their order."""
    place = F.coalesce(doc.cast("decimal(20,0)"), F.lit(Decimal(_NO_ID)).cast("decimal(20,0)")) * F.lit(_POSITIONS).cast("decimal(10,0)") + pos
    return place.cast("decimal(38,0)")


def number_place(place: Column, kind: DataType) -> tuple[Column, Column]:
    """Document, of type ``kind``, and position of a ``place_number``."""
    pos = F.pmod(place, F.lit(_POSITIONS).cast("decimal(38,0)"))
    doc = ((place - pos) / F.lit(_POSITIONS).cast("decimal(10,0)")).cast("decimal(20,0)")
    return F.when(doc != F.lit(Decimal(_NO_ID)).cast("decimal(20,0)"), doc.cast(kind)), pos.cast("int")


def initial_units(word: Column) -> Column:
    """First character as it is, the others with the continuation prefix."""
    return F.transform(T.characters(word), lambda c, i: F.when(i == 0, c).otherwise(F.concat(F.lit("##"), c)))


def alphabet(words: DataFrame) -> DataFrame:
    """Sorted distinct initial units."""
    units = F.explode_outer(F.array_distinct(initial_units(F.col("word"))))
    return words.select(units.alias("unit")).where(F.col("unit").isNotNull()).distinct().orderBy("unit")


def alphabet_top(words: DataFrame, limit: int = 1000) -> DataFrame:
    """The most frequent characters; equal counts in character order."""
    chars = words.select("freq", F.explode_outer(T.characters(F.col("word"))).alias("char")).where(F.col("char").isNotNull())
    counted = chars.groupBy("char").agg(F.sum("freq").alias("freq"))
    return counted.orderBy(F.desc("freq"), "char").limit(limit)


def adjacent_pairs(state: DataFrame, units: Column) -> DataFrame:
    """``(lhs, rhs, freq, first_seen)`` of neighbouring units.

    ``state`` is ``(word_rank, freq, ...)``. The first unit of a word also stands right of a null and the last one
    left of a null, so unit counts are sums over this small table.
    """
    edge = F.array(F.lit(None).cast("string"))
    pairs = F.arrays_zip(F.concat(edge, units).alias("lhs"), F.concat(units, edge).alias("rhs"))
    rows = state.select("word_rank", "freq", F.posexplode_outer(pairs).alias("pos", "pair"))
    return rows.groupBy(F.col("pair.lhs").alias("lhs"), F.col("pair.rhs").alias("rhs")).agg(
        F.sum("freq").alias("freq"), F.min(F.struct("word_rank", "pos")).alias("first_seen")
    )


def score_pairs(pairs: DataFrame) -> DataFrame:
    """Adds ``lhs_freq``, ``rhs_freq`` and the likelihood ``score``; as many rows as there are distinct pairs."""
    left = F.sum("freq").over(Window.partitionBy("lhs"))
    right = F.sum("freq").over(Window.partitionBy("rhs"))
    counted = pairs.withColumn("lhs_freq", left).withColumn("rhs_freq", right)
    likelihood = F.col("freq").cast("double") / (F.col("lhs_freq").cast("double") * F.col("rhs_freq"))
    return counted.where("lhs is not null and rhs is not null").withColumn("score", likelihood)


def pair_stats(words: DataFrame) -> DataFrame:
    """Frequency-weighted counts of adjacent unit pairs and of the two units, before any merge."""
    state = words.select(F.lit(0).cast("long").alias("word_rank"), "freq", "word")
    pairs = score_pairs(adjacent_pairs(state, initial_units(F.col("word"))))
    return pairs.select("lhs", "rhs", "freq", "lhs_freq", "rhs_freq", "score")


def merged_token(lhs: str, rhs: str) -> str:
    return lhs + rhs.removeprefix("##")


def train_merges(
    words: DataFrame,
    vocab_size: int,
    score: str = "likelihood",
    specials: list[str] | None = None,
    min_frequency: int = 1,
    limit_alphabet: int | None = None,
    batch: int = 512,
    checkpoint_every: int = 25,
) -> DataFrame:
    """Vocabulary ``(token, token_id)`` learned from ``(word, freq, first_seen)``.

    The result is that of one merge at a time, where equal scores go to the pair first seen in the corpus; rounds of
    up to ``batch`` merges give it with fewer passes (see ``training``). A merged token counts toward the size even if
    it repeats an entry.
    """
    specials = specials or C.SPECIALS_LIKELIHOOD
    units = T.characters(F.col("word"))
    if limit_alphabet is not None:
        kept = alphabet_top(words, limit_alphabet).agg(F.collect_set("char")).scalar()
        words = words.withColumn("_kept", kept)
        units = F.filter(units, lambda c: F.array_contains("_kept", c))
    marked = F.transform(units, lambda c, i: F.concat(F.when(i > 0, "##").otherwise(""), c))
    ranked = words.where(F.col("word") != "").orderBy("first_seen").withColumn("word_rank", F.monotonically_increasing_id())
    ordered = cut_lineage(ranked.select("word_rank", "freq", marked.alias("units")))
    # At most two units per character there is.
    letters = ordered.select(F.explode(F.array_distinct("units")).alias("u")).distinct().orderBy("u").toArrow()["u"].to_pylist()
    vocab = specials + letters
    size = max(vocab_size - len(vocab), 0)
    vocab += training.merges(ordered, letters, size, merged_token, score == "likelihood", min_frequency, batch, checkpoint_every)
    tokens = pa.table({"token": pa.array(vocab, pa.string()), "token_id": pa.array(range(len(vocab)), pa.int64())})
    return words.sparkSession.createDataFrame(tokens, VOCAB_SCHEMA)


def train_wordpiece(words: DataFrame, vocab_size: int) -> DataFrame:
    """Likelihood-scored training."""
    return train_merges(words, vocab_size, "likelihood", C.SPECIALS_LIKELIHOOD)


def train_wordpiece_freq(
    words: DataFrame, vocab_size: int = 30000, min_frequency: int = 2, limit_alphabet: int = 1000
) -> DataFrame:
    """Frequency-scored training with a limited alphabet and a minimum pair frequency."""
    return train_merges(words, vocab_size, "frequency", C.SPECIALS_FREQUENCY, min_frequency, limit_alphabet)


def first_ids(vocab: DataFrame) -> DataFrame:
    """One row per token with its first id, for lookups."""
    return vocab.groupBy("token").agg(F.min("token_id").alias("token_id"))


def is_domain_term(
    token: Column, patterns: list[str] | None = None, keywords: list[str] | None = None
) -> Column:
    """True for tokens of the domain; special tokens, single characters, digits and pure marks are not."""
    lowered = F.lower(token)
    shaped = F.lit(False)
    for pattern in patterns or C.DOMAIN_PATTERNS:
        shaped = shaped | lowered.rlike(f"^(?:{pattern})")
    for keyword in keywords or C.DOMAIN_KEYWORDS:
        shaped = shaped | lowered.contains(keyword)
    plain = token.isin(C.SPECIALS_FREQUENCY) | (F.length(token) <= 1) | token.rlike(r"^\p{Nd}+$") | token.rlike(r"^[^\p{L}\p{N}_]+$")
    return ~plain & shaped


def select_new_tokens(trained: DataFrame, base: DataFrame, n: int = 5000, **domain: list[str]) -> DataFrame:
    """``(token, tier, pos)``: up to ``n`` trained tokens missing from the base, domain terms first.

    Longer tokens come first within a tier; only the fill tier drops short tokens and continuation pieces.
    """
    new = trained.select("token").distinct().join(base.select("token"), "token", "left_anti")
    tiered = new.withColumn("tier", F.when(is_domain_term(F.col("token"), **domain), 1).otherwise(2))
    fill_ok = (F.length("token") >= 3) & ~F.col("token").startswith("##")
    usable = tiered.where((F.col("tier") == 1) | fill_ok)
    best = usable.orderBy("tier", F.length("token").desc(), "token").limit(n)
    return number_rows(best, ["tier", F.length("token").desc(), "token"], "pos")


def number_rows(bounded: DataFrame, order: list, name: str) -> DataFrame:
    """Dense numbers from 1 over a table that was already cut to a fixed number of rows."""
    return bounded.withColumn(name, F.row_number().over(Window.orderBy(*order)).cast("long"))


def extend_vocab(base: DataFrame, selected: DataFrame) -> DataFrame:
    """Base vocabulary plus the selected tokens that it lacks, numbered on after the last id; ``added`` marks them."""
    last = base.agg(F.max("token_id")).scalar()
    fresh = selected.join(base.select("token"), "token", "left_anti")
    numbered = number_rows(fresh, ["pos"], "n").select("token", (last + F.col("n")).alias("token_id"), F.lit(True).alias("added"))
    return base.select("token", "token_id", F.lit(False).alias("added")).unionByName(numbered)


def vocab_report(base: DataFrame, extended: DataFrame, dim: int = 768) -> DataFrame:
    """Sizes, growth and added embedding parameters of two vocabularies."""
    sizes = extended.agg(F.count("*").alias("extended_size")).withColumn("base_size", base.agg(F.count("*")).scalar())
    grown = F.col("extended_size") - F.col("base_size")
    return sizes.select(
        "base_size",
        "extended_size",
        grown.alias("added_tokens"),
        (grown * dim).alias("added_parameters"),
        (grown / F.col("base_size") * 100).alias("growth_percent"),
    )
