"""BPE encoding and decoding by a contiguous rank array per word.

A word's parts and the ranks of its adjacent pairs lie in two short lists.
The smallest rank is looked for by scanning, the boundary behind it deleted
and the two ranks beside it refreshed, until no pair has a rank.  Words are
short, so the scan beats a heap; words above ``LONG_WORD`` symbols keep their
candidate pairs in a heap, so that a long run of letters stays near-linear.
Ids are those of the tokenizers library for the same file (byte-level symbols,
an end-of-word suffix, white space dropped).

Cases: null text is empty (no ids, empty decoded text); a special token's
string in a text is that token, as in the library; repeated rows come out
each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoframe.llm.common import query, table
from geoframe.llm.tokens import ChunkCache, byte_level, load, word_and_tail

LONG_WORD = 100
OUT_IDS = 500_000       # ids in an output batch
NO_RANK = 1 << 60


class RankArrayBPE:
    """Encoder and decoder for one tokenizers file of the word kind."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        tokenizer = load(path)
        self.normalizer, self.splitter = tokenizer.normalizer, tokenizer.pre_tokenizer
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model["end_of_word_suffix"] or ""
        self.special = {t.content: i for i, t in tokenizer.get_added_tokens_decoder().items()}
        self.cut_special = re.compile("(" + "|".join(map(re.escape, sorted(
            self.special, key=len, reverse=True))) + ")")
        self.names: dict[int, str] = {i: s for s, i in self.vocab.items()}
        self.names.update({i: s for s, i in self.special.items()})
        self.pairs: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            ids = (self.vocab[a], self.vocab[b])
            self.pairs.setdefault(ids, (rank, self.vocab[a + b]))
        self.plain = re.compile(r"[a-z]+|[0-9]|[^a-z0-9]+")
        self.words = ChunkCache(self.word)
        self.chunks = ChunkCache(self._chunk)

    def word(self, word: str) -> tuple[int, ...]:
        """Ids of one word, given in byte-level characters."""
        if not word:
            return ()
        parts = [self.vocab[c] for c in word[:-1]]
        parts.append(self.vocab[word[-1] + self.suffix])
        if len(parts) > LONG_WORD:
            return tuple(self._long(parts))
        known, none = self.pairs, (NO_RANK, 0)
        ranks = [known.get(p, none)[0] for p in zip(parts, parts[1:])]
        while ranks:
            low = min(ranks)
            if low == NO_RANK:
                break
            i = ranks.index(low)
            parts[i] = known[parts[i], parts[i + 1]][1]
            del parts[i + 1], ranks[i]
            if i:
                ranks[i - 1] = known.get((parts[i - 1], parts[i]), none)[0]
            if i < len(ranks):
                ranks[i] = known.get((parts[i], parts[i + 1]), none)[0]
        return tuple(parts)

    def _long(self, parts: list[int]) -> list[int]:
        """The same order of merges from a heap of (rank, place)."""
        n, known = len(parts), self.pairs
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(known[p][0], i, p) for i, p in enumerate(zip(parts, parts[1:])) if p in known]
        heapq.heapify(heap)
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = after[i]
            if parts[i] < 0 or j >= n or (parts[i], parts[j]) != pair:
                continue
            parts[i], parts[j] = known[pair][1], -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for a in (before[i], i):
                if a >= 0 and after[a] < n and (p := (parts[a], parts[after[a]])) in known:
                    heapq.heappush(heap, (known[p][0], a, p))
        return [p for p in parts if p >= 0]

    def _chunk(self, chunk: str) -> bytes:
        """Ids of what lies between two blanks."""
        if plain := word_and_tail(chunk):
            words = [byte_level(plain[0].lower()), plain[1]]
        elif chunk.isascii() and chunk.isprintable() and "'" not in chunk:
            words = self.plain.findall(chunk.lower())
        else:
            words = [w for w, _ in self.splitter.pre_tokenize_str(self.normalizer.normalize_str(chunk))]
        return np.array([i for w in words for i in self.words[w]], dtype="<u4").tobytes()

    def _ordinary(self, text: str) -> bytes:
        return b"".join(map(self.chunks.__getitem__, text.replace("\n", " ").split(" ")))

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text."""
        if "<|" in text and len(pieces := self.cut_special.split(text)) > 1:
            data = b"".join(self._ordinary(p) if p not in self.special else
                            np.array([self.special[p]], dtype="<u4").tobytes() for p in pieces)
        else:
            data = self._ordinary(text)
        return np.frombuffer(data, dtype="<u4")

    def decode(self, ids) -> str:
        """The ids' tokens; the file names no decoder, so with blanks between."""
        return " ".join(map(self.names.__getitem__, ids.tolist()))


_MODELS: dict[str, RankArrayBPE] = {}


def model(path: str) -> RankArrayBPE:
    if path not in _MODELS:
        _MODELS[path] = RankArrayBPE(path)
    return _MODELS[path]


def encode_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: its id, ``ids`` (array<int>) and ``decoded``."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        bpe = model(path)

        def out(keys, ids, decoded, kind):
            ends = np.cumsum([0, *map(len, ids)]).astype("int32")
            flat = pa.array(np.concatenate(ids).astype("int32"))
            return pa.RecordBatch.from_arrays(
                [pa.array(keys, kind), pa.ListArray.from_arrays(pa.array(ends), flat),
                 pa.array(decoded, pa.string())], names=[id_col, "ids", "decoded"])

        for batch in batches:
            keys, ids, decoded, held = [], [], [], 0
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                got = bpe.encode(value.as_py() or "")
                keys.append(key)
                ids.append(got)
                decoded.append(bpe.decode(got))
                held += len(got)
                if held >= OUT_IDS:
                    yield out(keys, ids, decoded, batch.schema.field(0).type)
                    keys, ids, decoded, held = [], [], [], 0
            if keys:
                yield out(keys, ids, decoded, batch.schema.field(0).type)

    return docs.select(id_col, text).mapInArrow(run, f"`{id_col}` {kind}, ids array<int>, decoded string")


@query("op3_bpe_rank_array")
def op3(spark, sf_dir):
    import public_tokenizers
    docs = table(spark, sf_dir, "documents")
    coded = encode_decode(docs, public_tokenizers.path("word_bpe_49k.json"))
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))
