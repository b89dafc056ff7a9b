"""Suffix-array dedup: bytes of repeated stretches go.

A byte goes if a stretch of ``LENGTH`` bytes that covers it also starts anywhere
else, in the same text or another.  Sorting every suffix would move every text
many times over, so only suffixes that matter are exchanged:

* Each start p is served by the smallest 16-byte hash among the next ``WINDOW``
  places (half the stretch if that is less), its anchor, which depends on the stretch at p alone.  Starts with the
  same anchor form a chunk; all their stretches share the anchor's core.
* Cores that are met once (a count by 64-bit fingerprint) hold no repeat.  Of
  the others, chunks whose whole context is met again (core and context: 128
  bits of fingerprint) repeat from end to end.
* What is left are the chunks at the ends of repeats.  The suffixes at their
  first and last repeated start are sorted: every task sorts and front-codes
  its own run, the runs are exchanged by range, and a loser tree merges them
  without comparing known prefixes again.  Neighbours that agree in ``LENGTH``
  bytes are repeats, decided byte by byte.

A hot passage is one row per task and core after partial aggregation, and
copies of a context are one item.

With ``passage``, passages of that many whole words (what lies between ASCII white
space) that start anywhere else are found in the same passes: their stretches run from
the start of a word to the end of the last, whatever their bytes, and have places,
windows and grams counted in words.  Hashes tell the two kinds by their lowest bit.

Cases: a ``length`` below ``SHORTEST`` raises; null text is empty; texts shorter than ``LENGTH`` lose nothing; rows with
equal id and text are occurrences of their own and come out each; an empty table
gives an empty result; a ``passage`` of 1 to 3 words raises; other columns are kept, whatever their names, but for one that
is called like an added column, which gives way.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoframe.llm.common import materialise, put_back, query, set_aside, table
from geoframe.llm.hashing import BYTE, Rolling, batches_of, mix
from geoframe.llm.linking import multiple
from geoframe.llm.merge_sort import front_code, front_decode, merge

LENGTH = 400
PASSAGE = 51              # words of the passages that op2 counts beside
SPACE = b" \t\n\r\x0b\x0c"
WINDOW = 128
GRAM = 16
SHORTEST = 2 * GRAM       # stretch that holds a window and the gram at its end
GRAM_WORDS = 2            # a passage's anchor
FEWEST = 4                # words of a passage
SPREAD = np.uint64(0xBF58476D1CE4E5B9)
SEGMENT = 1 << 17         # bytes of a text, or of several, hashed in one go; the arrays stay in the cache
CELL_BITS = 22            # of the filter of keys that is sent to all tasks
RUN = 50_000              # suffixes in a sorted run
HEAD = 16                 # bytes by which runs are exchanged
BYTES, WORDS = 1, 2       # kinds of stretches


def _window(length: int) -> int:
    """Places among which a start has its anchor; the anchor's gram and core lie
    within the stretch."""
    if length < SHORTEST:
        raise ValueError(f"stretches have {SHORTEST} bytes at least, not {length}")
    return min(WINDOW, length // 2)


def _marked(hashes: np.ndarray, words: bool) -> np.ndarray:
    """Hashes whose lowest bit tells passages of words from stretches of bytes."""
    return (hashes & np.uint64(0xFFFFFFFFFFFFFFFE)) | np.uint64(words)


def _anchors(hashes: np.ndarray, window: int) -> np.ndarray:
    """Place of the smallest hash among ``window`` ones, from each place on; of the
    hashes only the upper halves count; the array is overwritten."""
    hashes &= np.uint64(0xFFFFFFFF00000000)
    hashes |= np.arange(len(hashes), dtype="uint64")
    span = 1
    while span < window:
        step = min(span, window - span)
        hashes = np.minimum(hashes[:-step], hashes[step:])
        span += step
    return hashes.astype("u4")


def _runs_of(anchor: np.ndarray, valid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last places of the runs of valid starts with one anchor."""
    change = anchor[1:] != anchor[:-1]
    change |= valid[1:] != valid[:-1]
    first, last = valid.copy(), valid.copy()
    first[1:] &= change
    last[:-1] &= change
    return np.nonzero(first)[0], np.nonzero(last)[0]


def _words(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of texts that lie one after the other (none is
    empty) and end at ``ends``."""
    word = ~((data == 0x20) | ((data >= 0x09) & (data <= 0x0D)))
    opens, closes = word.copy(), word.copy()
    opens[1:] &= ~word[:-1]
    closes[:-1] &= ~word[1:]
    opens[ends[:-1]] = word[ends[:-1]]
    closes[ends - 1] = word[ends - 1]
    return np.nonzero(opens)[0], np.nonzero(closes)[0] + 1


def _passages(data: np.ndarray, ends: np.ndarray, passage: int):
    """Starts and ends of the words, each one's text, and whether a passage starts
    at a word (of the words that have so many behind them)."""
    opens, closes = _words(data, ends)
    of = np.repeat(np.arange(len(ends)), np.diff(np.searchsorted(opens, ends), prepend=0))
    return opens, closes, of, of[:max(0, len(of) - passage + 1)] == of[passage - 1:]


def _byte_chunks(data, roll, ends, allowed, length: int):
    """Per chunk: text, first start, last start, end of the last stretch, key, context."""
    window = _window(length)
    if len(data) < length:
        return None
    grams = roll.sums[GRAM:] - roll.sums[:-GRAM]
    grams *= roll.down[:len(grams)]
    grams ^= grams >> np.uint64(29)
    grams *= SPREAD
    anchor = _anchors(grams, window)[:len(data) - length + 1]
    valid = np.ones(len(anchor), bool)
    for begin, end, kind in zip([0, *ends[:-1].tolist()], ends.tolist(), allowed.tolist()):
        valid[max(begin, end - length + 1) if kind else begin:end] = False
    lo, hi = _runs_of(anchor, valid)
    if not len(lo):
        return None
    a, of = anchor[lo].astype("int64"), np.searchsorted(ends, lo, side="right")
    key = roll(a, a + length + 1 - window)
    context = mix(roll(lo, hi + length) * np.uint64(3) + ((a - lo) * 4096 + (hi - lo)).astype("uint64"))
    return of, lo, hi, hi + length, _marked(key, False), _marked(context, False)


def _word_chunks(data, roll, ends, allowed, passage: int):
    """The same of passages; the starts are those of words."""
    opens, closes, of, valid = _passages(data, ends, passage)
    valid &= allowed[of[:len(valid)]]
    window = passage // 2
    if not valid.any():
        return None
    grams = roll(opens[:len(opens) - GRAM_WORDS + 1], closes[GRAM_WORDS - 1:])
    anchor = _anchors(grams, window)[:len(valid)]
    lo, hi = _runs_of(anchor, valid)
    a, of = anchor[lo].astype("int64"), of[lo]
    stop = closes[hi + passage - 1]
    key = roll(opens[a], closes[a + passage - window])
    context = mix(roll(opens[lo], stop) * np.uint64(5) + ((a - lo) * 4096 + (hi - lo)).astype("uint64"))
    return of, opens[lo], opens[hi], stop, _marked(key, True), _marked(context, True)


def _chunks(rows: list, length: int, passage: int):
    """``rows``: (row, offset, bytes, begin, stop, kinds) segments.  Per chunk: index into
    rows, first start, last start, end of the last stretch (all within the text), key, context."""
    data = np.frombuffer(b"".join(r[2] for r in rows), dtype="u1")
    sizes = np.array([len(r[2]) for r in rows], dtype="int64")
    kinds = np.array([r[5] for r in rows])
    ends = np.cumsum(sizes)
    roll = Rolling(BYTE[data])
    found = [_byte_chunks(data, roll, ends, (kinds & BYTES) > 0, length)]
    if passage:
        found.append(_word_chunks(data, roll, ends, (kinds & WORDS) > 0, passage))
    found = [f for f in found if f is not None]
    if not found:
        return [np.zeros(0, t) for t in ("int64",) * 4 + ("uint64",) * 2]
    of, lo, hi, stop, key, context = (np.concatenate(c) for c in zip(*found))
    shift = np.array([r[1] for r in rows], dtype="int64")[of] - (ends - sizes)[of]
    return of, lo + shift, hi + shift, stop + shift, key, context


def _least(length: int, passage: int) -> int:
    """Bytes of the shortest text with a stretch."""
    return min(length, 2 * passage - 1) if passage else length


def _segments(batches, length: int, passage: int):
    """Lists of (row, offset, bytes, begin, stop, kinds); long texts are cut so that a
    segment sees every chunk whose first start lies in [begin, stop) whole, and
    of a chunk that begins earlier some start before ``begin``.  For passages they
    are cut between words."""
    step, overlap, least = SEGMENT, length + WINDOW + GRAM, _least(length, passage)
    every = BYTES | WORDS if passage else BYTES

    def at_words(row, data):
        values = np.frombuffer(data, dtype="u1")
        opens, closes = _words(values, np.array([len(values)]))
        n = len(opens)
        cuts = np.unique(np.searchsorted(opens, np.arange(0, len(data), step))).tolist()
        for i, j in zip(cuts, [*cuts[1:], n]):
            if i < j:
                seen = int(opens[max(0, i - 1)])
                yield (row, seen, data[seen:int(closes[min(n, j + 2 * passage) - 1])], int(opens[i]),
                       int(opens[j]) if j < n else len(data), WORDS)

    def cut():
        for batch in batches:
            for row, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = (value.as_py() or "").encode("utf-8", "surrogatepass")
                if len(data) <= step + overlap:
                    yield row, 0, data, 0, len(data), every
                else:
                    for s in range(0, len(data), step):
                        seen = max(0, s - WINDOW)
                        yield row, seen, data[seen:s + step + overlap], s, s + step, BYTES
                    if passage:
                        yield from at_words(row, data)
    held, size = [], 0
    for item in cut():
        if len(item[2]) < least:
            continue
        held.append(item)
        size += len(item[2])
        if size >= step:
            yield held
            held, size = [], 0
    if held:
        yield held


def _found(batches, length: int, passage: int = 0):
    """Per batch of segments: rows and chunks; a chunk that two segments of a
    text see belongs, with all its starts, to the one in which it begins."""
    for held in _segments(batches, length, passage):
        of, lo, hi, end, key, context = _chunks(held, length, passage)
        begin = np.array([h[3] for h in held], dtype="int64")
        stop = np.array([h[4] for h in held], dtype="int64")
        own = (lo >= begin[of]) & (lo < stop[of]) if len(of) else np.zeros(0, bool)
        rows = np.array([h[0] for h in held], dtype="int64")
        yield (rows[of[own]], lo[own], hi[own], end[own], key[own].view("int64"), context[own].view("int64"))


def _keys(length: int, passage: int):
    def run(batches):
        for _, _, _, _, key, context in _found(batches, length, passage):
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(context)], names=["key", "context"])
    return run


def _cells(column) -> "F.Column":
    return F.shiftrightunsigned(column, 64 - CELL_BITS).cast("int")


def _filter_of(keys: DataFrame, column: str) -> np.ndarray:
    """A bit per cell: the cells that some key falls in.  At most 2**CELL_BITS
    numbers reach the driver, whatever the input."""
    used = keys.select(_cells(F.col(column)).alias("cell")).distinct().toArrow()
    out = np.zeros(1 << CELL_BITS, bool)
    out[used.column(0).to_numpy()] = True
    return np.packbits(out)


def _hits(packed: np.ndarray, keys: np.ndarray) -> np.ndarray:
    cell = keys.view("uint64") >> np.uint64(64 - CELL_BITS)
    return (packed[(cell >> np.uint64(3)).astype("int64")] >> (np.uint64(7) - (cell & np.uint64(7))).astype("u1")) & 1 == 1


def _places(length: int, passage: int, shared):
    def run(batches):
        for row, lo, _, stop, key, context in _found(batches, length, passage):
            keep = _hits(shared.value, key)
            yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (row, lo, stop, key, context)],
                                             names=["row", "lo", "stop", "key", "context"])
    return run


def _texts(shared):
    def run(batches):
        for batch in batches:
            keep = _hits(shared.value, np.asarray(batch.column(0)))
            yield batch.filter(pa.array(keep))
    return run


def _windows(length: int, passage: int):
    """Fingerprints of all stretches of the contexts."""
    def stretches(data, ends, words):
        roll = Rolling(BYTE[data])
        if words:
            opens, closes, of, valid = _passages(data, ends, passage)
            first = np.nonzero(valid)[0]
            at, to, of = opens[first], closes[first + passage - 1], of[first]
        else:
            n = np.diff(ends, prepend=0) - length + 1
            of = np.repeat(np.arange(len(n)), n)
            at = np.arange(n.sum()) + of * (length - 1)
            to = at + length
        return _marked(roll(at, to), words), of, at - np.concatenate([[0], ends])[of], to - at

    def run(batches):
        for batch in batches:
            data = batch.column(1).to_pylist()
            ids, part = np.asarray(batch.column(0)), batch.column(2).to_numpy(zero_copy_only=False)
            for words in (False, True):
                own = np.nonzero((ids & 1) == words)[0]
                for held in batches_of([data[i] for i in own.tolist()], SEGMENT):
                    where = own[[i for i, _ in held]]
                    key, of, off, size = stretches(np.frombuffer(b"".join(d for _, d in held), dtype="u1"),
                                                   np.cumsum([len(d) for _, d in held]), words)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key.view("int64")), pa.array(ids[where][of]), pa.array(off.astype("int32")),
                         pa.array(size.astype("int32")), pa.array(part[where][of])],
                        names=["key", "rid", "off", "size", "part"])
    return run


def _runs(batches):
    """mapInArrow over (context, text, stretches): sorted, front-coded runs.  A byte
    before each stretch keeps the kinds apart."""
    made = TaskContext.get().partitionId() << 24

    def flush(held):
        nonlocal made
        made += 1
        held.sort()
        coded = list(front_code((h[0] for h in held), HEAD))
        return pa.RecordBatch.from_arrays([
            pa.array([h[0][:HEAD] for h in held], pa.binary()), pa.array([made] * len(held), pa.int64()),
            pa.array(np.arange(len(held))), pa.array([c[0] for c in coded], pa.int32()),
            pa.array([c[1] for c in coded], pa.binary()), pa.array([h[1] for h in held], pa.int64()),
            pa.array([h[2] for h in held], pa.int32())],
            names=["head", "run", "seq", "lcp", "rest", "context", "off"])

    held = []
    for batch in batches:
        for c, text, found in zip(*[x.to_pylist() for x in batch.columns]):
            kind = b"w" if c & 1 else b"b"
            held.extend((kind + text[f["off"]:f["off"] + f["size"]], c, f["off"]) for f in found)
            if len(held) >= RUN:
                yield flush(held)
                held = []
    if held:
        yield flush(held)


def _merged(batches):
    """mapInArrow over one range of all runs, sorted by (run, seq): the stretches
    that agree with a neighbour from end to end."""
    runs: dict[int, list] = {}
    for batch in batches:
        cols = [c.to_pylist() for c in batch.columns]
        for r, lcp, rest, c, off in zip(cols[1], cols[3], cols[4], cols[5], cols[6]):
            runs.setdefault(r, []).append((lcp, rest, (c, off)))

    def decoded(rows):
        for (known, s), row in zip(front_decode((r[0], r[1]) for r in rows), rows):
            yield known, s, row[2]

    group, out, size = [], [], 0
    for lcp, s, (c, off) in merge([decoded(rows) for rows in runs.values()]):
        if lcp < size or lcp < len(s):
            out.extend(group if len(group) > 1 else [])
            group = []
        size = len(s)
        group.append((c, off, size - 1))
    out.extend(group if len(group) > 1 else [])
    yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()),
                                      pa.array([o[1] for o in out], pa.int32()),
                                      pa.array([o[2] for o in out], pa.int32())], names=["context", "off", "size"])


def repeated_spans(docs: DataFrame, row: str, text: str, length: int = LENGTH, passage: int = 0) -> DataFrame:
    """(row, spans, passages): arrays of longs, start << 32 | size, of the bytes to remove and
    of those in passages of ``passage`` words (0: none are looked for); ``row`` is
    a long column that names a row (equal for equal rows)."""
    _window(length)                        # raises here, not in a task
    if passage and passage < FEWEST:
        raise ValueError(f"passages have {FEWEST} words at least, not {passage}")
    spark = docs.sparkSession
    base = docs.select(F.col(row).alias("row"), F.col(text).alias("text"))
    keys = base.mapInArrow(_keys(length, passage), "key long, context long")
    keys = materialise(keys.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("context").alias("c0"),
                                               F.max("context").alias("c1"))
                       .where("n > 1").select("key", (F.col("c0") == F.col("c1")).alias("same")), "suffix-keys")
    cells = spark.sparkContext.broadcast(_filter_of(keys, "key"))
    places = materialise(base.mapInArrow(
        _places(length, passage, cells), "row long, lo long, stop long, key long, context long")
        .join(keys, "key"), "suffix-places")

    # chunks whose core has several contexts: one of each, and how often it is met
    several = materialise(places.where("NOT same").groupBy("key", "context").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("row", "lo", "stop")).alias("at")), "suffix-contexts")
    cells = spark.sparkContext.broadcast(_filter_of(several, "at.row"))
    texts = base.where(F.octet_length("text") >= _least(length, passage)).mapInArrow(_texts(cells), "row long, text string")
    wanted = several.select("key", "context", (F.col("n") == 1).alias("part"), "at.row", "at.lo", "at.stop")
    # one text per row, should rows repeat
    texts = texts.join(wanted.select("row").distinct(), "row", "left_semi").dropDuplicates(["row"])
    whole = F.col("text").cast("binary")
    held = materialise(
        wanted.join(texts, "row").select(
            "key", "context", "part",
            F.substring(whole, (F.col("lo") + 1).cast("int"), (F.col("stop") - F.col("lo")).cast("int"))
            .alias("ctx")).repartition("key"), "suffix-held").select("context", "ctx", "part")

    # stretches that two contexts share; of a chunk met once the first and last
    again = materialise(held.mapInArrow(_windows(length, passage), "key long, rid long, off int, size int, part boolean")
                        .repartition("key").sortWithinPartitions("key", "rid")
                        .mapInArrow(multiple, "key long, rid long, off int, size int, part boolean"), "suffix-windows")
    ends = again.where("part").groupBy("rid").agg(F.min(F.struct("off", "size", "key")).alias("a"),
                                                  F.max(F.struct("off", "size", "key")).alias("b"))
    ends = ends.select("rid", F.explode(F.array("a", "b")).alias("e")).select("rid", "e.off", "e.size", "e.key")
    # one other holder of each proves it, whatever their number
    other = again.join(ends.select("key").distinct(), "key", "left_semi").groupBy("key").agg(
        F.min(F.struct("rid", "off", "size")).alias("a"), F.max(F.struct("rid", "off", "size")).alias("b"))
    other = other.select(F.explode(F.array("a", "b")).alias("h")).select("h.rid", "h.off", "h.size")
    offs = ends.select("rid", "off", "size").unionAll(other).groupBy("rid").agg(
        F.sort_array(F.collect_set(F.struct("off", "size"))).alias("offs"))
    runs = (held.join(offs.withColumnRenamed("rid", "context"), "context").select("context", "ctx", "offs")
            .mapInArrow(_runs, "head binary, run long, seq long, lcp int, rest binary, context long, off int"))
    same = materialise(runs.repartitionByRange("head").sortWithinPartitions("run", "seq")
                       .mapInArrow(_merged, "context long, off int, size int"), "suffix-same")
    edge = same.groupBy("context").agg(F.min("off").alias("first"), F.max(F.col("off") + F.col("size")).alias("until"))

    found = (places.join(several.select("key", "context", "n"), ["key", "context"], "left")
             .join(edge, "context", "left")
             .withColumn("all", F.col("same") | (F.col("n") > 1)).where("all OR first IS NOT NULL"))
    start = F.col("lo") + F.when(F.col("all"), 0).otherwise(F.col("first"))
    stop = F.when(F.col("all"), F.col("stop")).otherwise(F.col("lo") + F.col("until"))
    # start and size, not both ends: a set of longs takes the halves' exclusive or as hash
    span, words = F.shiftleft(start, 32).bitwiseOR(stop - start), F.col("key").bitwiseAND(F.lit(1)) == 1
    return found.groupBy("row").agg(F.collect_set(F.when(~words, span)).alias("spans"),
                                    F.collect_set(F.when(words, span)).alias("passages"))


def whole_words(data: bytes, start: int, stop: int) -> int:
    """Words (what lies between ASCII white space) with both ends in
    ``data[start:stop]``."""
    n = len(data[start:stop].split())
    for at in (start, stop):
        if 0 < at < len(data) and not any(c in SPACE for c in data[at - 1:at + 1]):
            n -= 1
    return n


def stays(data: bytes, spans, words: int = 0, length: int = LENGTH) -> tuple[list[bytes], int]:
    """The pieces that stay, and the number of maximal runs that went.  ``spans``
    are stretches of ``length`` bytes and more.  With ``words``, stretches that
    start at consecutive bytes are one repeat, and a repeat of fewer whole words
    stays if it is below ``LENGTH`` bytes; short repeats that only touch or overlap
    are judged one by one."""
    spans = sorted(spans)
    if words:
        repeats: list[list[int]] = []
        for s, e in spans:
            if repeats and s <= repeats[-1][1] - length + 1:
                repeats[-1][1] = max(repeats[-1][1], e)
            else:
                repeats.append([s, e])
        spans = [(s, e) for s, e in repeats if e - s >= LENGTH or whole_words(data, s, e) >= words]
    runs: list[list[int]] = []
    for s, e in spans:
        if runs and s <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], e)
        else:
            runs.append([s, e])
    kept, at = [], 0
    for s, e in runs:
        kept.append(data[at:s])
        at = e
    kept.append(data[at:])
    return kept, len(runs)


def dedup_stretches(docs: DataFrame, id_col: str = "doc_id", text: str = "text",
                    length: int = LENGTH, words: int = 0, passage: int = 0) -> DataFrame:
    """``docs`` with all columns and ``_s_bytes`` (of the text), ``_s_spans``
    (maximal runs that went), ``_s_kept`` (binary) and ``_s_text`` (what stays, without
    the half characters at the ends of a cut; null text stays null).  ``length``: bytes of a
    stretch, ``SHORTEST`` at least.  ``words``: runs of fewer whole words stay if
    they are below ``LENGTH`` bytes; with a ``length`` of ``2 * words - 1``, the
    least that so many words take, no passage of ``words`` words is missed.  ``passage``
    words (``FEWEST`` at least, 0: none): ``_s_passages`` (maximal runs) and ``_s_covered``
    (bytes) lie in passages of so many whole words that start anywhere else too, byte for
    byte; they stay unless they are removed as stretches."""
    docs, names = set_aside(docs, "_s_")
    id_col, text = names.get(id_col, id_col), names.get(text, text)
    named = docs.withColumn("_s_row", F.xxhash64(F.col(id_col), F.col(text)))
    spans = repeated_spans(named, "_s_row", text, length, passage).withColumnRenamed("row", "_s_row") \
        .withColumnRenamed("spans", "_s_found").withColumnRenamed("passages", "_s_met")
    joined = named.join(spans, "_s_row", "left").drop("_s_row")
    own = docs.schema
    at = docs.columns.index(text)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.fields)

    def pairs(packed):
        return [(x >> 32, (x >> 32) + (x & 0xFFFFFFFF)) for x in packed or ()]

    def run(batches):
        for batch in batches:
            kept, n, sizes, texts, runs, covered = [], [], [], [], [], []
            for value, spans, met in zip(batch.column(at), *(c.to_pylist() for c in batch.columns[-2:])):
                data = (value.as_py() or "").encode("utf-8", "surrogatepass")
                pieces, k = stays(data, pairs(spans), words, length)
                kept.append(b"".join(pieces))
                n.append(k)
                sizes.append(len(data))
                texts.append("".join([x.decode("utf-8", "ignore") for x in pieces]) if k else value.as_py())
                rest, k = stays(data, pairs(met))
                runs.append(k)
                covered.append(len(data) - sum(map(len, rest)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-2], pa.array(sizes, pa.int64()), pa.array(n, pa.int64()),
                 pa.array(kept, pa.binary()), pa.array(texts, pa.string()), pa.array(runs, pa.int64()),
                 pa.array(covered, pa.int64())], names=[*batch.schema.names[:-2], *added])

    added = ["_s_bytes", "_s_spans", "_s_kept", "_s_text", "_s_passages", "_s_covered"]
    done = joined.mapInArrow(run, schema + ", _s_bytes long, _s_spans long, _s_kept binary, _s_text string, "
                                           "_s_passages long, _s_covered long")
    return put_back(done, names, *(added if passage else added[:4]))


@query("op2_suffix_merge")
def op2(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = dedup_stretches(docs, passage=PASSAGE)
    return done.select("doc_id", F.col("_s_bytes").alias("n_bytes"),
                       (F.col("_s_bytes") - F.octet_length("_s_kept")).cast("long").alias("n_removed"),
                       F.col("_s_spans").alias("n_spans"), F.sha2("_s_kept", 256).alias("kept_sha256"),
                       F.col("_s_passages").alias("n_passages"), F.col("_s_covered").alias("n_passage_bytes"))
