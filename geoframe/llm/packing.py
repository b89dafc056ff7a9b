"""Packing by order-preserving dynamic programming.

Documents are taken in the order of their ids, their tokens laid end to end,
and the stream cut into windows of at most ``max_len`` tokens.  A cut may fall
at a document's end (free), at a sentence's end, or, where a sentence is very
long, inside it; the last two cost a truncation penalty, and every window costs
its padding.  With ``cost[j] = min over i of cost[i] + max_len - (pos[j] -
pos[i]) + penalty[j]`` the best ``i`` minimises ``cost[i] + pos[i]`` over the
boundaries at most ``max_len`` tokens back: a monotone queue gives it in
constant time, so a stream of n boundaries takes O(n).

The order is kept by a range partitioning on the id; each partition cuts its
own stream in blocks of whole documents, so memory holds one block.  A block
ends its last window, which costs at most one window's padding per block.

Cases: null text is empty (the end token alone); rows that repeat are packed
each; a null id sorts first; an empty table gives no pieces; other columns are
ignored; a document longer than a block is a block of its own.
"""

from __future__ import annotations

from collections import deque

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from geoframe.llm.common import query, table
from geoframe.llm.tokens import ByteLevelEncoder, encoded_blocks, encoder

MAX_LEN = 2048
BLOCK_TOKENS = 1_000_000
SENTENCE_PENALTY = 16      # in tokens of padding
INSIDE_PENALTY = 64
INSIDE_EVERY = 128         # cuts inside a sentence are offered this far apart


def best_cuts(pos, penalty, max_len: int) -> list[int]:
    """Indices into ``pos`` (ascending boundaries, the first is the start, gaps
    at most ``max_len``) where the cheapest windows end."""
    n = len(pos)
    total, back = [0] * n, [0] * n
    queue = deque([(pos[0], 0)])            # (cost + pos, index), both ascending
    for j in range(1, n):
        here = pos[j]
        oldest = here - max_len
        while pos[queue[0][1]] < oldest:
            queue.popleft()
        key, i = queue[0]
        back[j] = i
        total[j] = key - here + max_len + penalty[j]
        key = total[j] + here
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, j))
    cuts, j = [], n - 1
    while j:
        cuts.append(j)
        j = back[j]
    return cuts[::-1]


def boundaries(doc_ends: np.ndarray, sentence_ends: np.ndarray, max_len: int):
    """Sorted cut candidates with their penalties; the start comes first."""
    pos = np.union1d(np.concatenate([[0], doc_ends]), sentence_ends)
    penalty = np.where(np.isin(pos, doc_ends), 0, SENTENCE_PENALTY)
    step = min(INSIDE_EVERY, max_len)
    gaps = np.diff(pos)
    wide = np.nonzero(gaps > step)[0]
    if len(wide):
        extra = np.concatenate([np.arange(pos[i] + step, pos[i + 1], step) for i in wide])
        at = np.searchsorted(pos, extra)
        pos, penalty = np.insert(pos, at, extra), np.insert(penalty, at, INSIDE_PENALTY)
    return pos, penalty


def _sentence_flags(tokenizer) -> tuple[np.ndarray, np.ndarray]:
    """By token id: ends a sentence; starts with white space."""
    n = tokenizer.get_vocab_size()
    ends, blank = np.zeros(n + 1, bool), np.zeros(n + 1, bool)
    for i in range(n):
        s = tokenizer.decode([i], skip_special_tokens=False)
        ends[i] = s.rstrip("\"')]")[-1:] in (".", "!", "?", "\n")
        blank[i] = s[:1].isspace()
    return ends, blank


_FLAGS: dict = {}


def pack(docs: DataFrame, path: str, id_col: str = "doc_id", text: str = "text",
         max_len: int = MAX_LEN, end_id: int = 1) -> DataFrame:
    """Pieces: id, start, length, ids (binary, little-endian unsigned 32 bit),
    doc_tokens, sequence_id, offset, sequence_tokens."""
    kind = docs.schema[id_col].dataType.simpleString()
    key_type = to_arrow_type(docs.schema[id_col].dataType)

    def run(batches):
        enc = encoder(ByteLevelEncoder, path)
        if path not in _FLAGS:
            _FLAGS[path] = _sentence_flags(enc.tokenizer)
        ends, blank = _FLAGS[path]
        base = TaskContext.get().partitionId() << 32
        made = 0
        for keys, ids, doc_ends in encoded_blocks(batches, enc, end_id, BLOCK_TOKENS):
            data = ids.astype("<u4").tobytes()
            doc_starts = np.concatenate([[0], doc_ends[:-1]])
            stops = np.nonzero(ends[ids[:-1]] & blank[ids[1:]])[0] + 1
            pos, penalty = boundaries(doc_ends, stops, max_len)
            cuts = pos[best_cuts(pos.tolist(), penalty.tolist(), max_len)]
            seq_starts = np.concatenate([[0], cuts[:-1]])
            at = np.union1d(doc_ends, cuts)
            first = np.concatenate([[0], at[:-1]])
            doc = np.searchsorted(doc_ends, first, side="right")
            seq = np.searchsorted(cuts, first, side="right")
            yield pa.RecordBatch.from_arrays([
                pa.array([keys[d] for d in doc.tolist()], key_type),
                pa.array(first - doc_starts[doc]), pa.array(at - first),
                pa.array([data[4 * a:4 * b] for a, b in zip(first.tolist(), at.tolist())], pa.binary()),
                pa.array((doc_ends - doc_starts)[doc]), pa.array(seq + (base + made)),
                pa.array(first - seq_starts[seq]), pa.array((cuts - seq_starts)[seq])],
                names=[id_col, "start", "length", "ids", "doc_tokens", "sequence_id", "offset",
                       "sequence_tokens"])
            made += len(cuts)

    ordered = (docs.select(id_col, text).repartitionByRange(F.col(id_col))
               .sortWithinPartitions(id_col, text))
    return ordered.mapInArrow(run, f"`{id_col}` {kind}, start long, length long, ids binary, "
                              "doc_tokens long, sequence_id long, offset long, sequence_tokens long")


@query("op1_packing_dp")
def op1(spark, sf_dir):
    import public_tokenizers
    pieces = pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset", "sequence_tokens")
