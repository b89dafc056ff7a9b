"""Quality rules [native]: distribution divergence against language references.

``references`` builds one row per value of ``lang`` over all documents: the
shares of seven character classes and of the language's most common words.
``quality`` measures every document and compares its own histograms with its
language's reference by Jensen-Shannon divergence (base 2, 0 to 1).  Documents
or references that are too short for a stable histogram are not judged by it.

Cases: null text counts as empty (``base_failed``: fewer than 10 words); null
``lang`` is a language of its own, and so is an empty one; repeated rows are judged
row by row; an empty table gives an empty result; texts may have any length; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geoframe.llm.common import materialise, put_back, query, set_aside, table

SYMBOLS = "#*$%&|<>"
COMMON_WORDS = 32         # per language
COMMON_CHARS = 5          # only words up to this length can be common words
MIN_WORDS = 50            # shorter documents are not judged by their words
MIN_CHARS = 200           # shorter documents are not judged by their characters
MIN_REFERENCE_WORDS = 2000
MAX_WORD_DIVERGENCE = 0.17
MAX_CLASS_DIVERGENCE = 0.10
#: Character classes; the first two are lower-case letters and white space.
#: The others are taken, one after the other, out of what these leave.
RUNS = "[a-z ]+"
CLASSES = [("blank", r"[\x09-\x0D]+"), ("upper", "[A-Z]+"), ("digit", "[0-9]+"),
           ("point", r"""[.,;:!?'"()\-]+"""), ("wide", r"[^\x00-\x7F]+")]
N_CLASSES = len(CLASSES) + 2


def _strip(text: Column, pattern: str) -> Column:
    return F.regexp_replace(text, F.lit(pattern), F.lit(""))


def _words(text: Column) -> Column:
    return F.filter(F.split(F.regexp_replace(text, r"[\x09-\x0D]", " "), " "), lambda w: w != "")


def _with_words(df: DataFrame, text: str) -> DataFrame:
    """Adds ``_q_words``, ``_q_chars`` (code points), ``_q_wordchars``,
    ``_q_left`` (what no class has) and ``_q_class`` (code points by class)."""
    df = (df.withColumn("_q_words", _words(F.col(text)))
          .withColumn("_q_chars", F.length(text).cast("double"))
          .withColumn("_q_wordchars", F.length(F.array_join("_q_words", "")).cast("double"))
          .withColumn("_q_left", _strip(F.col(text), RUNS))
          .withColumn("_q_runs", F.col("_q_chars") - F.length("_q_left")))
    counts = []
    for name, pattern in CLASSES:
        df = df.withColumn("_q_next", _strip(F.col("_q_left"), pattern))
        df = df.withColumn(f"_q_c_{name}", (F.length("_q_left") - F.length("_q_next")).cast("double"))
        df = df.withColumn("_q_left", F.col("_q_next"))
        counts.append(F.col(f"_q_c_{name}"))
    space = F.col("_q_chars") - F.col("_q_wordchars")
    lower = F.col("_q_runs") - (space - counts[0])
    df = df.withColumn("_q_class", F.array(lower, space, *counts[1:], F.length("_q_left").cast("double")))
    return df.drop("_q_next", "_q_runs", *[f"_q_c_{n}" for n, _ in CLASSES])


def references(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """One row per language: ``lang``, ``words`` (its most common words),
    ``word_share`` (theirs of all words), ``class_share``, ``ref_words``."""
    base = docs.select(F.col(lang).alias("lang"),
                       F.coalesce(F.col(text), F.lit("")).alias("_q_text"))
    base = _with_words(base, "_q_text")
    short = F.filter("_q_words", lambda w: F.length(w) <= COMMON_CHARS)
    counted = (base.select("lang", F.explode(short).alias("w"))
               .groupBy("lang", "w").agg(F.count(F.lit(1)).alias("n")))
    # the limit on the rank is applied before the shuffle as well
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "w"))
    top = (counted.withColumn("r", rank).where(F.col("r") <= COMMON_WORDS)
           .groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("r", "w", "n"))).alias("top")))
    k = N_CLASSES
    classes = (base.select("lang", F.size("_q_words").alias("n"),
                           *[F.col("_q_class")[i].alias(f"c{i}") for i in range(k)])
               .groupBy("lang").agg(F.sum("n").alias("ref_words"),
                                    *[F.sum(f"c{i}").alias(f"c{i}") for i in range(k)]))
    chars = sum((F.col(f"c{i}") for i in range(1, k)), F.col("c0"))
    top = top.withColumnRenamed("lang", "top_lang")
    return (classes.join(top, F.col("lang").eqNullSafe(F.col("top_lang")), "left")
            .select("lang", F.col("top.w").alias("words"),
                    F.transform("top", lambda t: t["n"] / F.col("ref_words")).alias("word_share"),
                    F.array(*[F.when(chars > 0, F.col(f"c{i}") / chars).otherwise(0.0)
                              for i in range(k)]).alias("class_share"),
                    F.coalesce("ref_words", F.lit(0)).alias("ref_words")))


def _half(p: Column, q: Column) -> Column:
    """One side's term of the Jensen-Shannon divergence."""
    return F.when(p > 0, 0.5 * p * F.log2(2 * p / (p + q))).otherwise(F.lit(0.0))


def _divergence(p: Column, q: Column) -> Column:
    """Jensen-Shannon divergence of two arrays of shares (base 2)."""
    both = F.zip_with(p, q, lambda a, b: _half(a, b) + _half(b, a))
    return F.aggregate(both, F.lit(0.0), lambda s, x: s + x)


def measure(docs: DataFrame, refs: DataFrame | None = None, text: str = "text",
            lang: str = "lang") -> DataFrame:
    """``docs`` with the measured columns added, all prefixed ``q_``
    (given columns of these names give way): n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed, class_divergence,
    word_divergence (null where a guard holds) and kept."""
    # one row per language: written first, so that Spark knows its size and
    # sends it to the documents where that is small, instead of dealing the
    # documents out by language
    refs = materialise(references(docs, text, lang), "language-references") if refs is None else refs
    refs = refs.select(F.col("lang").alias("_q_lang"), F.col("words").alias("_q_top"),
                       F.col("word_share").alias("_q_wshare"),
                       F.col("class_share").alias("_q_cshare"), F.col("ref_words").alias("_q_refwords"))
    docs, names = set_aside(docs, "_q_", "q_")
    text, lang = names.get(text, text), names.get(lang, lang)
    own = [f"`{c}`" for c in docs.columns]
    df = docs.withColumn("_q_text", F.coalesce(F.col(text), F.lit("")))
    df = df.join(refs, F.col(lang).eqNullSafe(F.col("_q_lang")), "left")
    df = _with_words(df, "_q_text").withColumn("q_n_words", F.size("_q_words").cast("long"))
    lines = F.filter(F.split("_q_text", "\\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df = df.withColumn("_q_lines", lines)

    # 5-word windows by their hashes; where some hash repeats, the windows with
    # their places are sorted, and neighbours that are equal name the places
    df = df.withColumn("_q_hash", F.transform("_q_words", lambda w: F.xxhash64(w)))
    window = lambda i: F.xxhash64(*[F.get("_q_hash", i + j) for j in range(5)])
    places = F.sequence(F.lit(0), F.greatest(F.lit(0), F.size("_q_words") - 5))
    df = df.withColumn("_q_windows", F.transform(places, window))
    some = F.size(F.array_distinct("_q_windows")) < F.size("_q_windows")
    df = df.withColumn("_q_win", F.when(some, F.sort_array(F.transform(
        "_q_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    m = F.size("_q_win")
    pairs = F.zip_with(F.slice("_q_win", 1, m - 1), F.slice("_q_win", 2, m - 1),
                       lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])))
    df = df.withColumn("_q_at", F.sort_array(F.array_distinct(F.flatten(
        F.filter(pairs, lambda x: x.isNotNull())))))
    k = F.size("_q_at")
    steps = F.zip_with(F.slice("_q_at", 1, k - 1), F.slice("_q_at", 2, k - 1),
                       lambda a, b: F.least(F.lit(5), b - a))
    repeated = F.when(k > 0, F.lit(5) + F.aggregate(steps, F.lit(0), lambda s, x: s + x)).otherwise(0)

    # common words of the document: sorted, counted by the places of the runs
    df = df.withColumn("_q_common", F.sort_array(F.filter(
        F.filter("_q_words", lambda w: F.length(w) <= COMMON_CHARS),
        lambda w: F.array_contains("_q_top", w))))
    df = df.withColumn("_q_runs", F.array_distinct("_q_common"))
    df = df.withColumn("_q_starts", F.concat(
        F.transform("_q_runs", lambda w: F.array_position("_q_common", w)),
        F.array((F.size("_q_common") + 1).cast("long"))))
    shares = F.zip_with(F.slice("_q_starts", 1, F.size("_q_runs")),
                        F.slice("_q_starts", 2, F.size("_q_runs")),
                        lambda a, b: (b - a) / F.col("q_n_words"))
    df = df.withColumn("_q_shares", shares)
    # (a column that a lambda uses is named twice: one named once is inlined
    # into the lambda and computed again for every element)
    found = F.transform("_q_top", lambda w: F.coalesce(
        F.get("_q_shares", F.array_position("_q_runs", w).cast("int") - 1), F.lit(0.0)))
    df = df.withColumn("_q_wshares", F.when(F.size("_q_shares") >= 0, found))
    rest = lambda shares: F.greatest(  # noqa: E731  what is no common word
        F.lit(0.0), F.lit(1.0) - F.aggregate(shares, F.lit(0.0), lambda s, x: s + x))
    word_div = _divergence(F.concat("_q_wshares", F.array(rest(F.col("_q_wshares")))),
                           F.concat("_q_wshare", F.array(rest(F.col("_q_wshare")))))
    class_div = _divergence(F.transform("_q_class", lambda c: c / F.col("_q_chars")), F.col("_q_cshare"))
    judged = F.col("_q_refwords") >= MIN_REFERENCE_WORDS
    df = (df.withColumn("q_word_chars", F.col("_q_wordchars").cast("long"))
          # every symbol is in what the classes leave
          .withColumn("q_n_symbols", (F.length("_q_left") - F.length(F.translate("_q_left", SYMBOLS, "")))
                      .cast("long"))
          .withColumn("q_n_dup_lines", (F.size("_q_lines") - F.size(F.array_distinct("_q_lines")))
                      .cast("long"))
          .withColumn("q_n_repeat_words", repeated.cast("long"))
          .withColumn("q_base_failed", (F.col("q_n_words") < 10)
                      | (100 * F.col("q_n_repeat_words") > 20 * F.col("q_n_words")))
          .withColumn("q_class_divergence", F.when(judged & (F.col("_q_chars") >= MIN_CHARS), class_div))
          .withColumn("q_word_divergence", F.when(judged & (F.col("q_n_words") >= MIN_WORDS), word_div))
          .withColumn("q_kept", ~F.col("q_base_failed")
                      & (F.coalesce("q_class_divergence", F.lit(0.0)) <= MAX_CLASS_DIVERGENCE)
                      & (F.coalesce("q_word_divergence", F.lit(0.0)) <= MAX_WORD_DIVERGENCE)))
    # the measures come out of a generator of one row: a filter on them would
    # otherwise be pushed below every step above, and each column replaced by
    # its expression over and over
    one = F.explode(F.array(F.struct(*MEASURES))).alias("_q_one")
    return put_back(df.select(*own, one).select(*own, *[F.col(f"_q_one.{c}") for c in MEASURES]), names, *MEASURES)


MEASURES = ["q_n_words", "q_word_chars", "q_n_symbols", "q_n_dup_lines", "q_n_repeat_words",
            "q_base_failed", "q_class_divergence", "q_word_divergence", "q_kept"]


def keep_good(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """The documents that pass, with their own columns only."""
    docs, names = set_aside(docs, "_q_", "q_")
    kept = measure(docs, None, names.get(text, text), names.get(lang, lang)).where("q_kept")
    return put_back(kept, names)


@query("op10_quality_divergence")
def op10(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return measure(docs).select("doc_id", *[F.col(c).alias(c[2:]) for c in MEASURES])
