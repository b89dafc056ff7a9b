"""Token ids in binary files, compressed by Re-Pair.

Every shard holds consecutive documents and a grammar of its own.  All adjacent
pairs of the shard are counted once, by a sort.  A round of Re-Pair gives the most
frequent ones a nonterminal each, replaces them from left to right and counts anew
only the pairs at the replaced places; rounds go on until no pair is met
``MIN_COUNT`` times.  Pairs never cross a document's end.

A shard file: the magic, the header's length (4 bytes), a JSON header (names,
dtypes and sizes), then little-endian arrays - document ids and which are null, ends
of the documents in symbols and in ids, the terminals (the shard's different ids),
the rules (two symbols each), the length every rule expands to, the symbols' low 16 bits, and their higher bits, as
many as the shard needs, plane by plane.
Symbol i below the number of terminals is the i-th of them; the ones above are the
rules, which only name earlier symbols.  The stored lengths let
``Shard.ids(doc, a, b)`` skip symbols without expanding them.

Cases: null text is empty (its end id alone); repeated rows are documents of
their own; null ids come first; an empty table writes no shard and reads back
as no rows; other columns are ignored.  Files appear under their final name
only when complete, and a task that runs again writes the same bytes.
"""

from __future__ import annotations

import json
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoframe.llm.common import materialise, query, scratch, table
from geoframe.llm.tokens import WordEncoder, encoded_blocks, encoder, gather
from geoframe.sources.layout import filesystem

MAGIC = b"RPTK"
SHARD_IDS = 3_000_000
RULES_PER_ROUND = 4_096   # pairs replaced at once
MIN_COUNT = 8             # a rule takes 12 bytes and saves 2 a place: below, it is not worth it
_SHIFT, _LOW, _SPREAD = np.uint64(32), np.uint64(0xFFFFFFFF), np.uint64(0x9E3779B97F4A7C15)


def _keys(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A pair as one number."""
    return (left.astype("uint64") << _SHIFT) | right


def _count(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different keys, ascending, and how often each is met (``keys`` get sorted)."""
    keys.sort()
    starts = np.nonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))[0][:len(keys)]
    return keys[starts], np.diff(np.append(starts, len(keys)))


def _which(keys: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Places in ``chosen`` (ascending, different) of those keys that are there; any
    place for the others.  A table by hash has nearly all, a search the rest."""
    free = np.uint64(64 - len(chosen).bit_length() - 5)
    place = chosen * _SPREAD >> free
    slots = np.zeros(1 << (64 - int(free)), "int32")
    slots[place] = np.arange(len(chosen))
    at = keys * _SPREAD >> free
    which = slots[at]
    lost = place[slots[place] != np.arange(len(chosen))]
    if len(lost):
        shared = np.zeros(len(slots), bool)
        shared[lost] = True
        again = np.nonzero(shared[at])[0]
        which[again] = np.minimum(np.searchsorted(chosen, keys[again]), len(chosen) - 1)
    return which


def _places(seq: np.ndarray, last: np.ndarray, chosen: np.ndarray, top: int):
    """Where the chosen pairs (ascending) are replaced, and which is at each place;
    of matches that overlap, in every run of neighbours each second one stays."""
    role = np.zeros(top, "u1")                      # 1: left of a pair, 2: right
    role[chosen >> _SHIFT] = 1
    role[chosen & _LOW] |= 2
    role = role[seq]
    at = np.nonzero((role[:-1] & (role[1:] >> 1)).view(bool) > last[:-1])[0]
    own = _keys(seq[at], seq[1:][at])
    which = _which(own, chosen)
    hit = chosen[which] == own
    at, which = at[hit], which[hit]
    run_start = np.concatenate([[True], np.diff(at) != 1])[:len(at)]
    first = np.maximum.accumulate(np.where(run_start, np.arange(len(at)), 0))
    keep = (np.arange(len(at)) - first) % 2 == 0
    return at[keep], which[keep]


def _pairs_at(seq: np.ndarray, last: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``_count`` of the pairs that start at some places."""
    at = at[(at >= 0) & (at < len(seq) - 1)]
    at = at[~last[at]]
    return _count(_keys(seq[at], seq[1:][at]))


def repair(ids: np.ndarray, doc_ends: np.ndarray, n_terminals: int):
    """``(rules, symbols, doc_ends in symbols)`` for uint32 ids below ``n_terminals``."""
    seq, last = ids.copy(), np.zeros(len(ids), bool)
    last[doc_ends - 1] = True
    rules: list[np.ndarray] = []
    top = n_terminals
    inside = ~last[:-1]
    if top <= 1 << 16:                  # 32 bits sort faster
        pairs, counts = _count((seq[:-1][inside] << np.uint32(16)) | seq[1:][inside])
        pairs = _keys(pairs >> np.uint32(16), pairs & np.uint32(0xFFFF))
    else:
        pairs, counts = _count(_keys(seq[:-1][inside], seq[1:][inside]))
    often = counts >= MIN_COUNT
    pairs, counts = pairs[often], counts[often]
    while len(pairs):
        # the most frequent; ties by the pair itself
        for most in (RULES_PER_ROUND, len(pairs)):
            chosen = np.sort(pairs[np.lexsort((pairs, -counts))[:most]])
            at, which = _places(seq, last, chosen, top)
            # pairs that overlap with others so often wait for the next round
            good = np.bincount(which, minlength=len(chosen)) >= MIN_COUNT
            if good.any():
                break
        else:
            break                       # pairs that only overlap with themselves
        at, which = at[good[which]], (np.cumsum(good) - 1)[which[good[which]]]
        chosen = chosen[good]
        # pairs that go with the replaced ones, then those that come
        apart = np.diff(at, prepend=-3) > 2             # from the place before
        gone, n = _pairs_at(seq, last, np.concatenate([at, at + 1, at[apart] - 1]))
        where = np.minimum(np.searchsorted(pairs, gone), len(pairs) - 1)
        hit = pairs[where] == gone
        counts[where[hit]] -= n[hit]
        seq[at] = (which + top).astype("uint32")
        last[at] = last[at + 1]
        stay = np.ones(len(seq), bool)
        stay[at + 1] = False
        seq, last = seq[stay], last[stay]
        at = at - np.arange(len(at))
        come, n = _pairs_at(seq, last, np.concatenate([at, at[np.diff(at, prepend=-3) > 1] - 1]))
        often = counts >= MIN_COUNT
        pairs = np.concatenate([pairs[often], come[n >= MIN_COUNT]])
        counts = np.concatenate([counts[often], n[n >= MIN_COUNT]])
        order = np.argsort(pairs)
        pairs, counts = pairs[order], counts[order]
        rules.append(np.stack([chosen >> _SHIFT, chosen & _LOW], axis=1))
        top += len(chosen)
    table_ = np.concatenate(rules) if rules else np.zeros((0, 2), "int64")
    return table_.astype("<u4"), seq, np.nonzero(last)[0] + 1


def rule_lengths(rules: np.ndarray, n_terminals: int) -> np.ndarray:
    out = [1] * n_terminals
    for a, b in rules.tolist():
        out.append(out[a] + out[b])
    return np.array(out[n_terminals:], "<u4")


def shard_bytes(doc_ids: list, ids: np.ndarray, doc_ends: np.ndarray) -> bytes:
    """A shard file's content."""
    used = np.zeros(int(ids.max()) + 1, bool)
    used[ids] = True
    terminals, n_terminals = np.nonzero(used)[0], int(used.sum())
    rules, symbols, symbol_ends = repair((np.cumsum(used) - 1).astype("uint32")[ids], doc_ends, n_terminals)
    planes = max(0, (n_terminals + len(rules) - 1).bit_length() - 16)
    high = [np.packbits(((symbols >> np.uint32(16 + k)) & np.uint32(1)).astype("u1")) for k in range(planes)]
    arrays = {"doc_ids": np.array([0 if d is None else d for d in doc_ids], "<i8"),
              "doc_null": np.array([d is None for d in doc_ids], "<u1"),
              "symbol_ends": symbol_ends.astype("<u8"), "id_ends": doc_ends.astype("<u8"),
              "terminals": terminals.astype("<u4"), "rules": rules.ravel(),
              "lengths": rule_lengths(rules, n_terminals),
              "symbols": (symbols & np.uint32(0xFFFF)).astype("<u2"),
              "high": np.concatenate(high) if high else np.zeros(0, "<u1")}
    head = json.dumps({"arrays": [[k, v.dtype.str, len(v)] for k, v in arrays.items()]}).encode()
    return b"".join([MAGIC, len(head).to_bytes(4, "little"), head, *(v.tobytes() for v in arrays.values())])


class Shard:
    """A shard file's content, opened."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a token shard")
        at = 8 + int.from_bytes(data[4:8], "little")
        head = json.loads(data[8:at])
        for name, dtype, n in head["arrays"]:
            value = np.frombuffer(data, dtype, n, at)
            setattr(self, name, value)
            at += value.nbytes
        if at != len(data):
            raise ValueError("token shard is cut short")
        n = len(self.symbols)
        for k, plane in enumerate(self.high.reshape(-1, -(-n // 8)) if len(self.high) else ()):
            self.symbols = self.symbols.astype("<u4") | (np.unpackbits(plane)[:n].astype("<u4") << np.uint32(16 + k))
        self.n_terminals = len(self.terminals)
        self.rules = self.rules.reshape(-1, 2)
        self.spans = np.concatenate([np.ones(self.n_terminals, "int64"), self.lengths.astype("int64")])

    def doc_id(self, i: int):
        return None if self.doc_null[i] else int(self.doc_ids[i])

    def _expand(self, symbols: np.ndarray) -> np.ndarray:
        """The ids of some symbols: rules are opened, all at once, until none is left."""
        while (rule := symbols >= self.n_terminals).any():
            at = np.cumsum(1 + rule) - 1 - rule
            opened = np.empty(len(symbols) + int(rule.sum()), "int64")
            opened[at] = symbols
            pair = self.rules[symbols[rule] - self.n_terminals]
            opened[at[rule]], opened[at[rule] + 1] = pair[:, 0], pair[:, 1]
            symbols = opened
        return self.terminals[symbols]

    def ids(self, doc: int, start: int = 0, stop: int | None = None) -> np.ndarray:
        """Ids ``start`` to ``stop`` of a document; only the symbols that hold
        them are expanded."""
        a = int(self.symbol_ends[doc - 1]) if doc else 0
        symbols = self.symbols[a:int(self.symbol_ends[doc])].astype("int64")
        ends = np.cumsum(self.spans[symbols])
        stop = int(ends[-1]) if stop is None else min(stop, int(ends[-1]))
        if start >= stop:
            return np.zeros(0, "<u4")
        i, j = np.searchsorted(ends, start, side="right"), np.searchsorted(ends, stop, side="left")
        before = int(ends[i - 1]) if i else 0
        return self._expand(symbols[i:j + 1])[start - before:stop - before]

    def all_ids(self) -> np.ndarray:
        """All documents end to end.  Every rule is opened once, whatever its length."""
        of = [self.terminals[k:k + 1].tobytes() for k in range(self.n_terminals)]
        for a, b in self.rules.tolist():
            of.append(of[a] + of[b])
        values = np.frombuffer(b"".join(of), "<u4")
        return gather(values, (np.cumsum(self.spans) - self.spans)[self.symbols], self.spans[self.symbols])


def write_tokens(docs: DataFrame, path: str, folder: str, id_col: str = "doc_id", text: str = "text",
                 end_id: int = 2, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Writes the shards in ascending order of the id and returns the manifest:
    file, n_docs, n_ids, bytes, first_id (ids of all shards before it)."""
    def run(batches):
        enc = encoder(WordEncoder, path)
        part, made = TaskContext.get().partitionId(), 0
        files, base = filesystem(folder)
        files.create_dir(base, recursive=True)

        for keys, ids, doc_ends in encoded_blocks(batches, enc, end_id, shard_ids):
            data = shard_bytes(keys, ids, doc_ends)
            name = f"shard-{part:06d}-{made:05d}.rptk"
            made += 1
            temp = f"{base}/_{name}.{uuid.uuid4().hex}"
            with files.open_output_stream(temp) as out:
                out.write(data)
            files.move(temp, f"{base}/{name}")
            yield pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([part], pa.int32()), pa.array([made - 1], pa.int32()),
                 pa.array([len(keys)]), pa.array([len(ids)]), pa.array([len(data)])],
                names=["file", "part", "k", "n_docs", "n_ids", "bytes"])

    ordered = (docs.select(F.col(id_col).cast("long").alias("id"), text).repartitionByRange("id")
               .sortWithinPartitions("id", text))
    done = materialise(ordered.mapInArrow(
        run, "file string, part int, k int, n_docs long, n_ids long, bytes long"), "token-manifest")
    # one number per partition goes to the driver
    sums = sorted((r["part"], r["n"]) for r in done.groupBy("part").agg(F.sum("n_ids").alias("n")).collect())
    bases, total = [], 0
    for part, n in sums:
        bases.append((part, total))
        total += n
    spark = docs.sparkSession
    based = done.join(spark.createDataFrame(bases, "part int, base long"), "part")
    before = F.expr("coalesce(sum(n_ids) OVER (PARTITION BY part ORDER BY k "
                    "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0L)")
    return based.withColumn("first_id", F.col("base") + before).select(
        "file", "n_docs", "n_ids", "bytes", "first_id")


def read_tokens(manifest: DataFrame, folder: str, id_col: str = "doc_id") -> DataFrame:
    """Per document of the shards: id, ``start`` (ids of all documents before
    it) and ``ids`` (binary, little-endian unsigned 32 bit)."""
    def run(batches):
        files, base = filesystem(folder)
        for batch in batches:
            for name, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with files.open_input_file(f"{base}/{name}") as f:
                    shard = Shard(f.read())
                data = shard.all_ids().tobytes()
                ends = shard.id_ends.astype("int64")
                starts = np.concatenate([[0], ends[:-1]])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard.doc_id(i) for i in range(len(ends))], pa.int64()),
                     pa.array(starts + first),
                     pa.array([data[4 * a:4 * b] for a, b in zip(starts.tolist(), ends.tolist())], pa.binary())],
                    names=[id_col, "start", "ids"])

    # a shard is a row: they are dealt out evenly, not read by one task
    n = max(1, manifest.sparkSession.sparkContext.defaultParallelism)
    shards = manifest.select("file", "first_id").repartition(max(n, manifest.count()))
    return shards.mapInArrow(run, f"`{id_col}` long, start long, ids binary")


@query("op7_repair_token_files")
def op7(spark, sf_dir):
    import public_tokenizers
    folder = scratch(spark, "token-shards")
    manifest = materialise(write_tokens(table(spark, sf_dir, "documents"),
                                        public_tokenizers.path("word_bpe_49k.json"), folder), "token-starts")
    return read_tokens(manifest, folder).select(
        "doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"))
