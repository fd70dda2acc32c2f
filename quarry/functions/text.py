"""Column expressions for tokenising and pairing words (inventory I1-I10, I15).

Each tokeniser mirrors one splitting convention exactly; all of them are plain
JVM expressions, so they run inside whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Delimiter classes of the tokenisers.
# Whitespace tokeniser: space, tab, newline, carriage return, form feed.
WHITESPACE_CLASS = r"[ \t\n\r\f]+"
# Script tokeniser: space, double quote, comma, left and right parenthesis, star
# (newline added because it is the line boundary of the input).
SCRIPT_TOKEN_CLASS = r"[ \",()*\n]+"
# Characters kept by the bigram cleaner: lower-case ASCII letters, digits, space.
CLEAN_KEEP_CLASS = r"[^a-z0-9 ]"


def computed_once(expr: Column) -> Column:
    """Generator output for ``expr`` (use inside ``select``): a later filter on the
    column cannot be pushed below it and re-evaluate ``expr``, which is what
    happens to an ordinary alias."""
    return F.explode(F.array(expr))


def _drop_empty(arr: Column) -> Column:
    # array_remove is a code-generated expression; a lambda filter is not
    return F.array_remove(arr, "")


def whitespace_tokens(text: Column) -> Column:
    """Tokens between runs of space/tab/newline/CR/FF; never empty tokens."""
    return _drop_empty(F.split(text, WHITESPACE_CLASS))


def script_tokens(text: Column) -> Column:
    """Tokens between runs of space, ``"``, ``,``, ``(``, ``)``, ``*``."""
    return _drop_empty(F.split(text, SCRIPT_TOKEN_CLASS))


def java_whitespace_split(line: Column, java_compat: bool = True) -> Column:
    """Split on ``\\s+`` keeping a leading empty token and dropping trailing ones.

    ``''`` -> ``['']``; all-blank -> ``[]``; ``' a b '`` -> ``['', 'a', 'b']``.
    ``java_compat=False`` drops every empty token instead.
    """
    if not java_compat:
        return _drop_empty(F.split(line, r"\s+"))
    return (F.when(line == "", F.array(F.lit("")))
            .when(line.rlike(r"^\s+$"), F.array().cast("array<string>"))
            .otherwise(F.split(F.regexp_replace(line, r"\s+$", ""), r"\s+")))


def nonword_tokens(text: Column) -> Column:
    """Tokens between runs of ASCII non-word characters (``\\W+``), empties dropped."""
    return _drop_empty(F.split(text, r"\W+"))


def sentences(text: Column, extra: str = "") -> Column:
    """Split into sentences at ``.``, ``!``, ``?`` (``extra`` adds delimiter chars)."""
    return F.split(text, f"[.!?{extra}]")


def cleaned_words(line: Column) -> Column:
    """Lower-case, strip everything but ``[a-z0-9 ]``, split on spaces."""
    cleaned = F.regexp_replace(F.lower(line), CLEAN_KEEP_CLASS, "")
    return _drop_empty(F.split(cleaned, " +"))


def adjacent_pairs(words: Column, sep: str = " ") -> Column:
    """``[w1, w2, w3]`` -> ``['w1 w2', 'w2 w3']``; fewer than two words -> ``[]``.

    ``words`` is referenced three times: pass a column reference (or a lambda
    variable), not a tokenising expression, or the tokeniser runs three times.
    """
    n = F.greatest(F.size(words) - 1, F.lit(0))
    return F.zip_with(F.slice(words, 1, n), F.slice(words, 2, n),
                      lambda a, b: F.concat(a, F.lit(sep), b))


def sentence_words(text: Column) -> Column:
    """Lower-cased ``\\W+`` words of each sentence (sentences end at ``.!?`` or a line end)."""
    return F.transform(sentences(F.lower(text), extra="\n"), nonword_tokens)


def sentence_bigrams_of_words(sentence_words_col: Column) -> Column:
    """In-sentence bigrams from the output of ``sentence_words``."""
    return F.flatten(F.transform(sentence_words_col, lambda w: adjacent_pairs(w)))


def full_match(s: Column, pattern: str) -> Column:
    """True when the whole string matches ``pattern`` (not just a substring)."""
    return s.rlike(rf"\A(?:{pattern})\z")


def quoted(s: Column) -> Column:
    """A JSON string value rendered with its quotes (``"tag"``)."""
    return F.regexp_extract(F.to_json(F.struct(s.alias("v"))), r'^\{"v":(.*)\}$', 1)


def digit_tokens(text: Column) -> Column:
    """Tokens of ``\\W+`` that are all digits (a minus sign is a separator)."""
    return F.filter(F.split(text, r"\W+"), lambda x: x.rlike(r"\A[0-9]+\z"))


LIMB_DIGITS = 18     # digits of one limb: 10^20 limbs still sum within decimal(38,0)


def digit_limbs(token: Column) -> Column:
    """An all-digit token of any length as ``array<struct<pos, limb>>``: 18 digits each, from the right."""
    n = F.length(token)
    last = F.floor((n - 1) / LIMB_DIGITS).cast("int")

    def limb(i: Column) -> Column:
        end = n - i * LIMB_DIGITS
        start = F.greatest(end - LIMB_DIGITS, F.lit(0))
        return F.struct(i.alias("pos"), F.substring(token, start + 1, end - start).cast("decimal(38,0)").alias("limb"))

    return F.transform(F.sequence(F.lit(0), last), limb)


def carried_total(sums: Column) -> Column:
    """The decimal text of the number whose limb sums are ``array<struct<pos, limb>>`` (any order, gaps allowed).

    One carry runs from the lowest limb up, in one row as long as the longest token.
    """
    big = "decimal(38,0)"
    base = F.lit(10 ** LIMB_DIGITS).cast(big)
    by_pos = F.map_from_entries(sums)
    top = F.array_max(F.map_keys(by_pos))
    zero = F.lit(0).cast(big)

    def step(acc: Column, i: Column) -> Column:
        total = (acc["carry"] + F.coalesce(F.try_element_at(by_pos, i), zero)).cast(big)
        low = (total % base).cast(big)
        return F.struct(((total - low) / base).cast(big).alias("carry"),
                        F.concat(F.lpad(low.cast("string"), LIMB_DIGITS, "0"), acc["digits"]).alias("digits"))

    start = F.struct(zero.alias("carry"), F.lit("").alias("digits"))
    folded = F.aggregate(F.sequence(F.lit(0), top), start, step,
                         lambda a: F.concat(a["carry"].cast("string"), a["digits"]))
    trimmed = F.regexp_replace(folded, r"\A0+(?=[0-9])", "")
    return F.when(F.size(sums) > 0, trimmed).otherwise(F.lit("0"))
