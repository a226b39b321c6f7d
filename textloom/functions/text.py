"""Column functions on text and token arrays. All are built-in expressions, none is a Python UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from textloom.functions import constants as C

EMPTY_TOKENS = "array<string>"


def no_tokens() -> Column:
    return F.array().cast(EMPTY_TOKENS)


def strip(text: Column) -> Column:
    """Remove white space of any kind from both ends."""
    return F.regexp_replace(text, rf"^[{C.WHITESPACE}]+|[{C.WHITESPACE}]+\z", "")


def split_blank(text: Column, any_whitespace: bool = False) -> Column:
    """Split at the space character, strip the pieces, drop empty ones.

    White space next to a space is folded into it first, which strips every piece in one pass over the text.
    """
    ws, no_space = C.WHITESPACE, C.WHITESPACE.replace(" ", "")
    gap = rf"[{ws}]+" if any_whitespace else rf" [{ws}]+|[{no_space}]+ [{ws}]*"
    padded = F.concat(F.lit(" "), text, F.lit(" "))
    return F.array_remove(F.split(F.regexp_replace(padded, gap, " "), " "), "")


def fold_apostrophes(text: Column) -> Column:
    """Map typographic single quotes to the ASCII apostrophe."""
    return F.translate(text, "‘’", "''")


def tokenize_ws(text: Column, any_whitespace: bool = False) -> Column:
    """Lower, blank out the marks, delete digit runs, split at spaces."""
    marks = C.CJK_MARKS + C.LATIN_MARKS
    blanked = F.translate(F.lower(text), marks, " " * len(marks))
    return split_blank(F.regexp_replace(blanked, r"\p{Nd}+", ""), any_whitespace)


def tokenize_ws_keep(text: Column, any_whitespace: bool = False) -> Column:
    """Lower, space the marks out as tokens of their own, keep digits, split at spaces."""
    spaced = F.regexp_replace(F.lower(text), f"([{C.CJK_MARKS}{C.LATIN_MARKS}])", " $1 ")
    return split_blank(spaced, any_whitespace)


def clean_unspaced(text: Column) -> Column:
    """Text ready for lexicon segmentation: lowered, CJK marks and digits deleted."""
    return F.regexp_replace(F.translate(F.lower(text), C.CJK_MARKS, ""), r"\p{Nd}+", "")


def word_ngrams(tokens: Column, n: int) -> Column:
    """Contiguous n-grams joined by a space; empty when there are fewer than n tokens."""
    starts = F.sequence(F.lit(1), F.size(tokens) - (n - 1))
    grams = F.transform(starts, lambda i: F.array_join(F.slice(tokens, i, n), " "))
    return F.when(F.size(tokens) >= n, grams).otherwise(no_tokens())


def char_ngrams(text: Column, n: int) -> Column:
    """Contiguous character n-grams; empty when the text is shorter than n."""
    grams = F.transform(F.sequence(F.lit(1), F.length(text) - (n - 1)), lambda i: F.substring(text, i, F.lit(n)))
    return F.when(F.length(text) >= n, grams).otherwise(no_tokens())


def characters(text: Column) -> Column:
    return F.when(text == "", no_tokens()).otherwise(F.split(text, ""))


def pretokenize(text: Column, single_marks: bool = False) -> Column:
    """Runs of word characters or runs of other marks; ``single_marks`` gives each mark its own token."""
    if single_marks:
        pattern = rf"[^{C.WHITESPACE}{C.BERT_PUNCT}]+|[{C.BERT_PUNCT}]"
    else:
        pattern = rf"[{C.WORD_CHARS}]+|[^{C.WORD_CHARS}{C.WHITESPACE}]+"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def normalize_text(text: Column) -> Column:
    """Drop control characters, turn white space into spaces, put spaces around CJK characters."""
    blanked = F.regexp_replace(text, r"[\t\n\r\p{Zs}\x{2028}\x{2029}]", " ")
    cleaned = F.regexp_replace(blanked, r"[\p{Cc}\p{Cf}\p{Co}\x{fffd}]", "")
    return F.regexp_replace(cleaned, f"([{C.CJK_CHARS}])", " $1 ")


def word_set(text: Column, drop_marks: bool = True) -> Column:
    """Distinct lowered words split at any white space."""
    lowered = F.lower(text)
    if drop_marks:
        lowered = F.translate(lowered, ".,", "")
    return F.array_distinct(split_blank(lowered, any_whitespace=True))


def count_runs(ordered: Column) -> Column:
    """Sorted tokens to ``array<struct<token, tf>>``: one entry per distinct token, no shuffle.

    ``ordered`` must be a materialized column holding ``sort_array(tokens)``.
    """
    size = F.size(ordered)
    starts = F.filter(
        F.sequence(F.lit(1), size), lambda i: (i == 1) | (F.get(ordered, i - 1) != F.get(ordered, i - 2))
    )
    ends = F.concat(F.slice(starts, 2, size), F.array(size + 1))
    runs = F.zip_with(starts, ends, lambda s, e: F.struct(F.get(ordered, s - 1).alias("token"), (e - s).alias("tf")))
    return F.when(size > 0, runs).otherwise(F.array().cast("array<struct<token:string,tf:int>>"))


def number_repeats(runs: Column) -> Column:
    """Expand counted tokens to unique strings ``token#occurrence``, so set operations honour multiplicity."""
    return F.flatten(
        F.transform(
            runs,
            lambda r: F.transform(F.sequence(F.lit(1), r["tf"]), lambda k: F.concat(r["token"], F.lit("\x00"), k)),
        )
    )
