"""Phrases: sequences of words that stand together more often than apart.

Texts are lower-cased (A-Z), cut into pieces at ``[.,;:!?\\x0A-\\x0D]`` and pieces
into words at blanks and tabs; everything is counted per language.  A task keeps
its texts until they have ``SHARD`` bytes, numbers their words in order and builds
a bidirectional FM-index (``fm_index.py``) of each language.  Intervals of n-grams
grow by one word to the left or right; what shards count is summed by Spark.

Most n-grams are rare, so there are two passes over the texts:

1. Words and pairs go out as 64-bit hashes with counts.  Those that are met
   ``least`` times become a bit filter, whose size follows from their number.
2. Pairs that pass are grown to both sides, as long as the pairs inside pass, and
   come out as strings with counts; so do all words that pass.  Sums by string
   are exact: a clash of hashes or bits lets a rare phrase through to this sum, no
   more.

Then each phrase asks for the counts of its parts by a join that splits hot
words (``spread_join``), and scores are taken in 38-digit decimals.

Cases: null text is empty; null language is ``und``; empty texts, and texts
without words, have no part; repeated rows count each; ties of a score go by
count, then by the phrase's UTF-8 bytes; a text of any length is in one shard (it
is one row already); an empty table gives an empty result; other columns, whatever
their names, are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from geoframe.llm.bit_filter import BitFilter, bit_filter
from geoframe.llm.common import materialise, query, table
from geoframe.llm.fm_index import Bidirectional
from geoframe.llm.hashing import BYTE, Rolling, mix
from geoframe.llm.joins import spread_join

SHARD = 6 << 20           # bytes of text in an index
LEAST = 10                # occurrences of a phrase
WORDS = 3                 # of the longest phrase
ROWS = 50_000             # in a batch that leaves a task
UNKNOWN = "und"
END = b"."
#: A-Z in lower case, tabs as blanks, all that ends a piece as END.
TABLE = bytes.maketrans(bytes(range(0x41, 0x5B)) + b"\t" + b".,;:!?\n\x0b\x0c\r",
                        bytes(range(0x61, 0x7B)) + b" " + END * 10)


def numbered(texts: list[str]) -> tuple[pa.Array, np.ndarray]:
    """The distinct words in byte order, END first, and the sequence of their numbers
    with END after each piece and text."""
    data = b"\n".join([t.encode("utf-8", "surrogatepass") for t in texts] + [b""])
    data = data.translate(TABLE).replace(END, b" . ")
    whole = pa.LargeStringArray.from_buffers(1, pa.py_buffer(np.array([0, len(data)], "<i8")), pa.py_buffer(data))
    found = pc.ascii_split_whitespace(whole).flatten().dictionary_encode()
    words, codes = found.dictionary, found.indices.to_numpy()
    order = pc.array_sort_indices(words).to_numpy()
    ends, none = (pc.equal(words, x).to_numpy(zero_copy_only=False) for x in (END.decode(), ""))
    order = order[~(ends | none)[order]]
    rank = np.full(len(words), -1, "int32")
    rank[order] = np.arange(1, len(order) + 1, dtype="int32")
    rank[ends] = 0
    seq = rank[codes]
    return pa.concat_arrays([words.filter(pa.array(ends)), words.take(pa.array(order))]), seq[seq >= 0]


def _shards(batches):
    """(language, texts) whose index is built next; a task holds ``SHARD`` bytes
    and the text that passes them."""
    held: dict[str, list[str]] = {}
    size = 0
    for batch in batches:
        for lang, text in zip(batch.column(0), batch.column(1)):
            value = text.as_py()
            if not value:
                continue
            held.setdefault(lang.as_py(), []).append(value)
            size += len(value)
            if size >= SHARD:
                yield from held.items()
                held, size = {}, 0
    yield from held.items()


def word_hashes(lang: str, names: pa.Array) -> np.ndarray:
    """64-bit hashes of the words of a language."""
    own = np.frombuffer(lang.encode("utf-8", "surrogatepass"), "u1")
    seed = Rolling(BYTE[own])(np.array([0]), np.array([len(own)]))
    _, ends, data = names.buffers()
    ends = np.frombuffer(ends, "<i8")[:len(names) + 1]
    return mix(Rolling(BYTE[np.frombuffer(data, "u1")])(ends[:-1], ends[1:]) + seed)


def pattern_hashes(words: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Hashes of patterns (rows of word numbers) from those of their words."""
    out = of[words[:, 0]]
    for k in range(1, words.shape[1]):
        out = mix(out * np.uint64(3) + of[words[:, k]])
    return out


def _hashed(batches):
    """mapInArrow: hashes of words and pairs with their counts in a shard."""
    for lang, texts in _shards(batches):
        names, seq = numbered(texts)
        if len(names) == 1:
            continue
        of = word_hashes(lang, names)
        index = Bidirectional(seq, 2, one_way=True)
        p = index.single()
        for _ in range(2):
            h, n = pattern_hashes(p.words, of).view("int64"), p.counts
            for at in range(0, len(h), ROWS):
                yield pa.RecordBatch.from_arrays([pa.array(h[at:at + ROWS]), pa.array(n[at:at + ROWS])],
                                                 names=["h", "n"])
            if p.words.shape[1] == 1:
                p = index.left(p)


def _pair_keys(words: np.ndarray) -> np.ndarray:
    """The first two words of each pattern as one number."""
    return words[:, 0].astype("int64") << 32 | words[:, 1]


def _counted(longest: int, shared):
    """mapInArrow: (lang, phrase, words, n, before, after) of the words and
    phrases of a shard that may be frequent, and the number of all words."""
    def out(lang, names, p, index):
        before = index.forward.extended(p.low, p.high)
        after = index.reverse.extended(p.low_r, p.high_r)
        k = p.words.shape[1]
        for at in range(0, len(p.words), ROWS):
            part = slice(at, at + ROWS)
            columns = [names.take(pa.array(p.words[part, i])) for i in range(k)]
            phrases = pc.binary_join_element_wise(*columns, pa.scalar(" ", names.type)) if k > 1 else columns[0]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(phrases), pa.string()), phrases.cast(pa.string()),
                 pa.array(np.full(len(phrases), k, "int32")), pa.array(p.counts[part]),
                 pa.array(before[part]), pa.array(after[part])],
                names=["lang", "phrase", "words", "n", "before", "after"])

    def run(batches):
        may: BitFilter = shared.value
        for lang, texts in _shards(batches):
            names, seq = numbered(texts)
            if len(names) == 1:
                continue
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang], pa.string()), pa.array([""], pa.string()), pa.array([0], pa.int32()),
                 *[pa.array([int((seq != 0).sum())], pa.int64())] * 3],
                names=["lang", "phrase", "words", "n", "before", "after"])
            of = word_hashes(lang, names)
            index = Bidirectional(seq, longest)
            p = index.single()
            p = p.kept(may(pattern_hashes(p.words, of)))
            yield from out(lang, names, p, index)
            # pairs grow to the right of their first word, longer ones to the left
            p = index.right(p)
            p = p.kept(may(pattern_hashes(p.words, of)))
            passed = _pair_keys(p.words)
            yield from out(lang, names, p, index)
            for _ in range(longest - 2):
                p = index.left(p)
                p = p.kept(np.isin(_pair_keys(p.words), passed))
                yield from out(lang, names, p, index)
    return run


def phrase_counts(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST,
                  longest: int = WORDS) -> DataFrame:
    """(lang, phrase, words, n, before, after) of all phrases of 2 to ``longest``
    words that are met ``least`` times, of all words met so often and, with 0
    words, of the number of all words.  ``before`` and ``after``: at how many of its
    places a phrase has a word of its piece on that side."""
    if longest < 2 or least < 1:
        raise ValueError("phrases have 2 words at least and are met once at least")
    spark = docs.sparkSession
    base = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"),
                       F.col(text).alias("text"))
    keys = materialise(base.mapInArrow(_hashed, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
                       .where(F.col("n") >= least).select("h"), "phrase-keys")
    shared = spark.sparkContext.broadcast(bit_filter(keys, "h"))
    rows = base.mapInArrow(_counted(longest, shared),
                           "lang string, phrase string, words int, n long, before long, after long")
    sums = rows.groupBy("lang", "phrase", "words").agg(*[F.sum(c).alias(c) for c in ("n", "before", "after")])
    return materialise(sums.where((F.col("n") >= least) | (F.col("words") == 0)), "phrase-counts")


def _scored(counts: DataFrame) -> DataFrame:
    """Every phrase with its lowest-scoring cut: k, l, r and score."""
    phrases = counts.where("words > 1").select(
        "lang", "phrase", "words", F.col("n").alias("a"), F.split("phrase", " ").alias("w"))
    asked = (phrases.select("lang", "phrase", "words", "w", F.explode(F.expr("sequence(1, words - 1)")).alias("k"))
             .select("lang", "phrase", F.explode(F.array(
                 F.struct(F.col("k"), F.lit(0).alias("side"),
                          F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("part")),
                 F.struct(F.col("k"), F.lit(1).alias("side"),
                          F.array_join(F.slice("w", F.col("k") + 1, F.col("words") - F.col("k")), " ").alias("part"))))
                 .alias("q")).select("lang", "phrase", "q.*"))
    parts = counts.where("words > 0").select("lang", F.col("phrase").alias("part"), "n")
    got = spread_join(asked, parts, ["lang", "part"], ["n"])
    cuts = got.groupBy("lang", "phrase", "k").agg(F.max(F.when(F.col("side") == 0, F.col("n"))).alias("l"),
                                                  F.max(F.when(F.col("side") == 1, F.col("n"))).alias("r"))
    cuts = cuts.join(phrases.select("lang", "phrase", "words", "a"), ["lang", "phrase"])
    score = F.expr("CAST(1000000 AS DECIMAL(7,0)) * CAST(a AS DECIMAL(15,0)) * CAST(a AS DECIMAL(15,0))"
                   " DIV (CAST(l AS DECIMAL(18,0)) * CAST(r AS DECIMAL(18,0)))")
    cuts = cuts.withColumn("score", score)
    return cuts.groupBy("lang", "phrase", "words", "a").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("c")).select("lang", "phrase", "words", "a", "c.*")


def collocations(counts: DataFrame, longest: int = WORDS, percent: int = 50) -> DataFrame:
    """(lang, phrase, words, a, k, l, r, n, score) of the phrases in ``counts``
    (see ``phrase_counts``).  Phrases inside a longer one that is met in
    ``percent`` of their places are left out."""
    scored = _scored(counts)
    longer = counts.where("words > 2").select("lang", F.split("phrase", " ").alias("w"), "words",
                                              F.col("n").alias("met"))
    inner = F.expr("""flatten(transform(sequence(2, words - 1), m ->
        transform(sequence(1, words - m + 1), i -> array_join(slice(w, i, m), ' '))))""")
    inner = longer.select("lang", "met", F.explode(inner).alias("phrase")) \
        .groupBy("lang", "phrase").agg(F.max("met").alias("met"))
    out = scored.join(inner, ["lang", "phrase"], "left").where(
        F.col("met").isNull() | (100 * F.col("met") < percent * F.col("a"))).drop("met")
    total = counts.where("words = 0").select("lang", "n")
    return out.join(total, "lang")


def top_phrases(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST,
                longest: int = WORDS, percent: int = 50, top: int = 2000) -> DataFrame:
    """The ``top`` phrases of each language, by score, count and phrase."""
    found = collocations(phrase_counts(docs, text, lang, least, longest), longest, percent)
    by = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= top)


_SQL = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents
), split AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[ \\t]+'), lambda x: x <> '') AS w FROM pieces
), grams AS (
  SELECT lang, 1 AS words, unnest(w) AS phrase FROM split
  UNION ALL
  SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM split
  UNION ALL
  SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))
  FROM split
), f AS (SELECT lang, words, phrase, count(*) AS a FROM grams GROUP BY ALL),
total AS (SELECT lang, sum(a) AS n FROM f WHERE words = 1 GROUP BY lang),
named AS MATERIALIZED (SELECT lang || chr(10) || phrase AS name, a FROM f),
c AS MATERIALIZED (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE words > 1 AND a >= 10),
cuts AS (
  SELECT lang, phrase, words, a, 1 AS k, w[1:1] AS x, w[2:] AS y FROM c
  UNION ALL SELECT lang, phrase, words, a, 2, w[1:2], w[3:] FROM c WHERE words = 3
), heads AS MATERIALIZED (
  SELECT cuts.*, named.a AS l FROM cuts JOIN named ON name = lang || chr(10) || array_to_string(x, ' ')
), scored AS (
  SELECT lang, phrase, words, heads.a, k, l, named.a AS r,
         CAST(1000000 AS HUGEINT) * heads.a * heads.a // (CAST(l AS HUGEINT) * named.a) AS score
  FROM heads JOIN named ON name = lang || chr(10) || array_to_string(y, ' ')
), best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inside AS (
  SELECT lang, phrase, max(met) AS met FROM (
    SELECT lang, w[1] || ' ' || w[2] AS phrase, a AS met FROM c WHERE words = 3
    UNION ALL SELECT lang, w[2] || ' ' || w[3], a FROM c WHERE words = 3) GROUP BY ALL
)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
       CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM (
  SELECT best.*, n, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM best JOIN total USING (lang) LEFT JOIN inside USING (lang, phrase)
  WHERE met IS NULL OR 100 * met < 50 * a)
WHERE rank <= 2000
"""


@query("op13_phrase_index", _SQL)
def op13(spark, sf_dir):
    found = top_phrases(table(spark, sf_dir, "documents"))
    return found.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
