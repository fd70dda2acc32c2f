"""Word and bigram counting (inventory E1-E4, E8, E12, E14, F6, I1-I10).

Counts use ``groupBy().count()``: a partial aggregate before the shuffle and a
final one after, so a word that makes up a third of the corpus only ships one
partial count per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.operators.ordering import bucketed_lead


def count_tokens(df: DataFrame, tokens: Column, out: str = "word", n: str = "n") -> DataFrame:
    """Explode a token array and count each distinct token."""
    return (df.select(F.explode(tokens).alias(out))
            .groupBy(out).agg(F.count(F.lit(1)).alias(n)))


def word_count(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Whitespace tokens, case and punctuation kept."""
    return count_tokens(docs, T.whitespace_tokens(F.col(text_col)))


def script_word_count(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Script-style tokens that fully match ``\\w+``, most frequent first."""
    counts = (docs.select(F.explode(T.script_tokens(F.col(text_col))).alias("word"))
              .where(T.full_match(F.col("word"), r"\w+"))
              .groupBy("word").agg(F.count("word").alias("n")))
    return counts.orderBy(F.desc("n"), "word")


def java_split_word_count(lines: DataFrame, line_col: str = "line", java_compat: bool = True) -> DataFrame:
    """Per-line ``\\s+`` split with Java's empty-token rules (or, without
    ``java_compat``, no empty tokens), least frequent first."""
    tokens = T.java_whitespace_split(F.col(line_col), java_compat)
    return count_tokens(lines, tokens).orderBy("n", "word")


def lower_word_top(docs: DataFrame, k: int = 10, text_col: str = "text") -> DataFrame:
    """Lower-cased ``\\W+`` words; the ``k`` most frequent (ties by word)."""
    counts = count_tokens(docs, T.nonword_tokens(F.lower(F.col(text_col))))
    return counts.orderBy(F.desc("n"), "word").limit(k)


def token_total(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Total number of whitespace tokens: per-row sizes summed, no shuffle of tokens."""
    return docs.agg(F.coalesce(F.sum(F.size(T.whitespace_tokens(F.col(text_col)))).cast("long"),
                               F.lit(0).cast("long")).alias("total"))


def total_of_counts(counts: DataFrame, n: str = "n") -> DataFrame:
    """Second round of a two-round count: the sum of all partial counts."""
    return counts.agg(F.coalesce(F.sum(n), F.lit(0)).cast("long").alias("total"))


def line_bigram_count(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """Cleaned in-line bigrams ``'w1 w2'`` and their counts."""
    words = lines.select(T.cleaned_words(F.col(line_col)).alias("_w"))
    return count_tokens(words, T.adjacent_pairs(F.col("_w")), out="bigram")


def reaggregate(counts: DataFrame, key: str, n: str = "n") -> DataFrame:
    """Merge partial counts of the same key (a second counting round)."""
    return counts.groupBy(key).agg(F.sum(n).cast("long").alias(n))


def representative_per_count(counts: DataFrame, key: str = "bigram", n: str = "n") -> DataFrame:
    """One key per distinct count (the smallest), ascending by count."""
    return counts.groupBy(n).agg(F.min(key).alias(key)).orderBy(n)


def sentence_bigram_count(docs: DataFrame, text_col: str = "text") -> DataFrame:
    words = docs.select(T.sentence_words(F.col(text_col)).alias("_sw"))
    return count_tokens(words, T.sentence_bigrams_of_words(F.col("_sw")), out="bigram")


def cross_line_bigram_count(lines: DataFrame, bucket_width: int = 4096) -> DataFrame:
    """Bigrams made of the last word of a line and the first word of the next line
    that has words, in the same document (lines carry ``doc_id, line_no, line``).

    The next non-empty line's first word is a bucketed lead over line numbers
    within the document: one shuffle by (document, line bucket), so a very long
    document is spread over many tasks, and no self-join.
    """
    words = T.computed_once(T.cleaned_words(F.col("line")))
    edges = (lines.select("doc_id", "line_no", words.alias("_w"))
             .where(F.size("_w") > 0)
             .select("doc_id", "line_no",
                     F.element_at("_w", 1).alias("first"), F.element_at("_w", -1).alias("last")))
    paired = bucketed_lead(edges, "line_no", "first", "next_first", partition_by=["doc_id"],
                           bucket_width=bucket_width)
    return (paired.where(F.col("next_first").isNotNull())
            .select(F.concat("last", F.lit(" "), "next_first").alias("bigram"))
            .groupBy("bigram").agg(F.count(F.lit(1)).alias("n")))


def cross_line_bigram_count_per_document(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The cross-line bigrams when each document is one row: the lines of a
    document are paired inside its row, so the only shuffle is the final count."""
    per_line = F.transform(F.split(F.col(text_col), "\n"), T.cleaned_words)
    ne = docs.select(F.filter(per_line, lambda w: F.size(w) > 0).alias("_ne"))
    m = F.greatest(F.size("_ne") - 1, F.lit(0))
    pairs = F.zip_with(F.slice("_ne", 1, m), F.slice("_ne", 2, m),
                       lambda a, b: F.concat(F.element_at(a, -1), F.lit(" "), F.element_at(b, 1)))
    return count_tokens(ne, pairs, out="bigram")


def json_path_count(df: DataFrame, json_col: str, path: str, out: str = "tag",
                    descending: bool = False) -> DataFrame:
    """Count the string value at a JSON path (``$.a.b``); malformed or missing -> skipped."""
    v = T.computed_once(F.get_json_object(F.col(json_col), path))
    counts = (df.select(v.alias(out)).where(F.col(out).isNotNull())
              .groupBy(out).agg(F.count(F.lit(1)).alias("n")))
    order = F.desc("n") if descending else F.col("n")
    return counts.orderBy(order, out)


def limb_sums(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``(pos, limb)``: the sums of the 18-digit limbs of all all-digit ``\\W+`` tokens, by position.

    As many rows as the longest token has limbs; counted partially per task.
    """
    limbs = F.flatten(F.transform(T.digit_tokens(F.col(text_col)), T.digit_limbs))
    return (docs.select(F.explode(limbs).alias("_l")).groupBy(F.col("_l.pos").alias("pos"))
            .agg(F.sum("_l.limb").cast("decimal(38,0)").alias("limb")))


def total_of_limbs(sums: DataFrame) -> DataFrame:
    """The exact total of ``limb_sums`` as a string, ``0`` without rows."""
    return sums.agg(F.collect_list(F.struct("pos", "limb")).alias("_s")).select(T.carried_total(F.col("_s")).alias("total"))


def integer_total(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Sum of all-digit ``\\W+`` tokens as a string: exact for tokens of any length."""
    return total_of_limbs(limb_sums(docs, text_col))
