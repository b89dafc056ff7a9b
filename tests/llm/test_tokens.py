"""Encoders, packing and token files."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from geoframe.llm import bpe, packing, token_files, tokens

ODD = ["", " ", "  a  b\n c \t d", "<|endoftext|> x", "a <|startoftext|>b  ", "\n\n x", "a\x1cb \x1cc  \x85 z q",
       "I'll 's 'S it's  123 45", "Σίσυφος ΣΑΣ İ ß", "é" * 300, "x" * 5000 + " " + "ab" * 300, "don't I'LL",
       "wörd, Ünd! É.", "a." * 50, " wide　space"]


def fuzz(n):
    rng = random.Random(3)
    letters = "ab'sS .\n\t<|>\x1cé́İ  12٣\U0001f600　ß,"
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(n)]


def library(path):
    return tokens.load(path)


def test_fast_encoders_equal_the_library(byte_path, word_path, documents):
    texts = [t for _, t in documents[:60]] + ODD + fuzz(800)
    for kind, path in ((tokens.ByteLevelEncoder, byte_path), (tokens.WordEncoder, word_path)):
        fast, slow = kind(path), library(path)
        for text in texts:
            assert fast(text) == tokens.ids_to_bytes(slow.encode(text, add_special_tokens=False).ids), text[:80]


def test_rank_array_equals_the_library(word_path, documents):
    own, slow = bpe.RankArrayBPE(word_path), library(word_path)
    for text in [t for _, t in documents[:60]] + ODD + fuzz(800):
        ids = slow.encode(text, add_special_tokens=False).ids
        assert own.encode(text).tolist() == ids, text[:80]
        assert own.decode(own.encode(text)) == slow.decode(ids, skip_special_tokens=False)


def test_long_word_by_heap_equals_scan(word_path):
    own = bpe.RankArrayBPE(word_path)
    rng = random.Random(5)
    for _ in range(30):
        word = "".join(rng.choice("abcdeth") for _ in range(60))
        parts = [own.vocab[c] for c in word[:-1]] + [own.vocab[word[-1] + own.suffix]]
        assert tuple(own._long(parts)) == own.word(word)


def test_chunk_cache_is_bounded(monkeypatch):
    monkeypatch.setattr(tokens, "MAX_BYTES", 700)
    cache = tokens.ChunkCache(str.encode)
    assert [cache[str(i) * 2] for i in range(10)] == [b"%d%d" % (i, i) for i in range(10)] and len(cache) <= 4
    cache["x" * 1000]
    assert "x" * 1000 not in cache


@pytest.mark.parametrize("slice_bytes, piece_bytes", [(1 << 22, 1 << 22), (200, 2000), (1, 1)])
def test_arrays_of_texts_equal_the_library(byte_path, word_path, documents, monkeypatch, slice_bytes, piece_bytes):
    monkeypatch.setattr(tokens, "SLICE_BYTES", slice_bytes)
    monkeypatch.setattr(tokens, "PIECE_BYTES", piece_bytes)
    texts = [t for _, t in documents[:40 if slice_bytes > 1000 else 2]] + [None] + ODD + fuzz(300) + [None, "a b." * 500]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["k", "t"])
    for kind, path in ((tokens.ByteLevelEncoder, byte_path), (tokens.WordEncoder, word_path)):
        slow = library(path)
        want = [[*slow.encode(t or "", add_special_tokens=False).ids, 7] for t in texts]
        enc, got, keys = kind(path), [], []
        for names, ids, ends in tokens.encoded_blocks([batch.slice(0, 10), batch.slice(10)], enc, 7, 900):
            assert ends[-1] == len(ids) and (len(ends) == 1 or ends[-2] < 900)
            keys += names
            got += [x.tolist() for x in np.split(ids, ends[:-1])]
        assert keys == list(range(len(texts))) and got == want
        # a worker keeps what it has room for
        assert enc.pieces.texts.nbytes + enc.pieces.ids.values.nbytes <= max(piece_bytes, 4)
        assert len(enc.pieces.texts) == len(enc.pieces.ids.lengths)
    assert len(kind(path).encode(pa.array([], pa.string())).lengths) == 0


def test_words_with_any_punctuation_are_made_of_pieces(byte_path, word_path):
    text = "one*** two$$$ three,### four.%%% (five) [six] se_ven# eight*\nnine~ ten`^+=| don't x's 7-7"
    for kind, path in ((tokens.ByteLevelEncoder, byte_path), (tokens.WordEncoder, word_path)):
        enc, asked = kind(path), []
        wholes = enc._wholes
        enc._wholes = lambda texts, wholes=wholes, asked=asked: (asked.extend(t.strip() for t in texts), wholes(texts))[1]
        assert enc(text) == tokens.ids_to_bytes(library(path).encode(text, add_special_tokens=False).ids)
        plain = {"two$$$", "three,###", "four.%%%", "eight*\nnine~", "ten`^+=|"}
        assert not plain & set(asked) and {"(five)", "don't", "x's", "7-7"} <= set(asked)


def test_pieces_of_equal_keys(monkeypatch):
    made = []
    pieces = tokens.Pieces(lambda t: made.append(t) or [len(t), ord(t[0])])
    monkeypatch.setattr(tokens, "text_keys", lambda texts: np.zeros(len(texts), "uint64"))
    for _ in range(3):
        found = pieces(pa.array(["ab", "cde", "ab", "f"]))
        assert found.lengths.tolist() == [2] * 4 and found.values.tolist() == [2, 97, 3, 99, 2, 97, 1, 102]
    monkeypatch.undo()
    keys = tokens.text_keys(pa.array(["", "a", "b", "ab", "x" * 70, "a", ""])[1:])
    assert keys[0] == keys[4] and len(set(keys.tolist())) == 5


def test_places_of_pairs_in_full_tables():
    rng = np.random.default_rng(5)
    for n in (1, 2, 1000, 20_000):
        chosen = np.unique(rng.integers(0, 1 << 40, n).astype("uint64"))
        keys = np.concatenate([chosen, rng.integers(0, 1 << 40, 500).astype("uint64")])
        which = token_files._which(keys, chosen)
        assert (which[:len(chosen)] == np.arange(len(chosen))).all() and which.min() >= 0 and which.max() < len(chosen)


def test_encode_decode_frame(frame, word_path):
    df = frame(["a b", None, "", "a b"]).withColumn("ids", F.lit(1))      # a clashing column
    got = {r["doc_id"]: (r["ids"], r["decoded"]) for r in bpe.encode_decode(df, word_path).collect()}
    assert got[1] == got[2] == ([], "") and got[0] == got[3] and got[0][1] == "a</w> b</w>"
    assert bpe.encode_decode(frame([]), word_path).count() == 0


def best_cost(pos, penalty, most):
    cost = [0] + [None] * (len(pos) - 1)
    for j in range(1, len(pos)):
        cost[j] = min(cost[i] + most - (pos[j] - pos[i]) + penalty[j]
                      for i in range(j) if pos[j] - pos[i] <= most)
    return cost[-1]


@pytest.mark.parametrize("seed", range(20))
def test_cuts_are_optimal(seed):
    rng = random.Random(seed)
    pos, penalty = [0], [0]
    for _ in range(60):
        pos.append(pos[-1] + rng.randint(1, 10))
        penalty.append(rng.choice([0, 2, 7]))
    cuts = packing.best_cuts(pos, penalty, 20)
    total, at = 0, 0
    for c in cuts:
        assert 0 < pos[c] - pos[at] <= 20
        total, at = total + 20 - (pos[c] - pos[at]) + penalty[c], c
    assert at == len(pos) - 1 and total == best_cost(pos, penalty, 20)


def test_pack(frame, byte_path, documents):
    given = documents[:80] + [(900, None), (901, ""), (902, "word " * 9000), (902, "word " * 9000), (None, "no id")]
    rows = packing.pack(frame(given).withColumn("ids", F.lit(1)), byte_path).collect()
    slow = library(byte_path)
    want = sorted(tokens.ids_to_bytes([*slow.encode(t or "", add_special_tokens=False).ids, 1]) for _, t in given)
    by_doc, by_seq = {}, {}
    for r in rows:
        assert len(r["ids"]) == 4 * r["length"] > 0
        by_doc.setdefault((r["doc_id"], r["doc_tokens"]), []).append(r)
        by_seq.setdefault(r["sequence_id"], []).append(r)
    for parts in by_seq.values():
        at = 0
        for r in sorted(parts, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at == parts[0]["sequence_tokens"] <= 2048
        # order-preserving: ids ascend within a sequence
        ids = [r["doc_id"] if r["doc_id"] is not None else -1 for r in sorted(parts, key=lambda r: r["offset"])]
        assert ids == sorted(ids)
    got = []
    for (doc, n), parts in by_doc.items():
        copies = 2 if doc == 902 else 1
        parts.sort(key=lambda r: (r["start"], r["sequence_id"]))
        if copies == 1:
            assert [r["start"] for r in parts] == list(np.cumsum([0] + [r["length"] for r in parts[:-1]]))
            got.append(b"".join(r["ids"] for r in parts))
        else:
            assert sum(r["length"] for r in parts) == 2 * n
            got += [want[max(range(len(want)), key=lambda i: len(want[i]))]] * 2
    assert sorted(got) == want
    total = sum(r["length"] for r in rows)
    assert 1 - total / (2048 * len(by_seq)) < 0.1
    assert packing.pack(frame([]), byte_path).count() == 0


@pytest.mark.parametrize("terminals", [50, 70_000])
def test_repair_round_trip(terminals):
    rng = np.random.default_rng(1)
    ids = (rng.zipf(1.3, 20_000) % terminals).astype("uint32")
    ids[3000:5000] = 7                                        # a run of one id
    ends = np.unique(np.concatenate([rng.integers(1, 20_000, 300), [20_000]]))
    shard = token_files.Shard(token_files.shard_bytes([None, *range(1, len(ends))], ids, ends))
    assert (shard.all_ids() == ids).all() and len(shard.rules) and len(shard.symbols) < len(ids)
    assert shard.doc_id(0) is None and shard.doc_id(5) == 5
    for doc in rng.integers(0, len(ends), 100).tolist():
        own = ids[ends[doc - 1] if doc else 0:ends[doc]]
        a = int(rng.integers(0, len(own)))
        b = int(rng.integers(a, len(own) + 1))
        assert (shard.ids(doc, a, b) == own[a:b]).all()
    with pytest.raises(ValueError):
        token_files.Shard(token_files.shard_bytes([1], ids[:10], np.array([10]))[:-1])


def test_repair_leaves_no_frequent_pair():
    rng = np.random.default_rng(3)
    words = [rng.integers(0, 300, 40).astype("uint32") for _ in range(60)]
    ids = np.concatenate([words[k] for k in rng.integers(0, 60, 3_000)])
    ends = np.arange(400, len(ids) + 1, 400)
    rules, symbols, symbol_ends = token_files.repair(ids, ends, 300)
    inside = np.ones(len(symbols), bool)
    inside[symbol_ends - 1] = False
    pairs = (symbols[:-1].astype("uint64") << np.uint64(32) | symbols[1:])[inside[:-1]]
    assert np.unique(pairs, return_counts=True)[1].max() < 2 * token_files.MIN_COUNT
    data = token_files.shard_bytes(list(range(len(ends))), ids, ends)
    shard = token_files.Shard(data)
    assert (shard.all_ids() == ids).all() and shard.lengths.max() >= 40 and len(data) < len(ids)


def test_symbols_of_more_than_16_bits():
    ids = np.concatenate([np.arange(140_000), np.tile(np.arange(139_000, 140_000), 20)]).astype("uint32")
    ends = np.array([1, 70_001, len(ids)])
    shard = token_files.Shard(token_files.shard_bytes([3, 4, 5], ids, ends))
    assert len(shard.high) and shard.n_terminals == 140_000 and len(shard.rules)
    assert (shard.all_ids() == ids).all() and (shard.ids(2, 68_000, 75_000) == ids[138_001:145_001]).all()


def test_token_files(spark, frame, word_path, documents):
    from geoframe.llm.common import scratch
    given = documents[:70] + [(900, None), (901, "")]
    folder = scratch(spark, "test-tokens")
    manifest = token_files.write_tokens(frame(given), word_path, folder, shard_ids=5_000)
    rows = sorted(token_files.read_tokens(manifest, folder).collect(), key=lambda r: r["doc_id"])
    assert manifest.count() > 3
    slow, at = library(word_path), 0
    for r, (i, text) in zip(rows, given, strict=True):
        want = tokens.ids_to_bytes([*slow.encode(text or "", add_special_tokens=False).ids, 2])
        assert (r["doc_id"], r["start"], bytes(r["ids"])) == (i, at, want)
        at += len(want) // 4
    empty = scratch(spark, "test-tokens")
    assert token_files.read_tokens(token_files.write_tokens(frame([]), word_path, empty), empty).count() == 0


def test_crc_is_unsigned_little_endian(frame, byte_path):
    r = packing.pack(frame(["hello"]), byte_path).select(F.crc32("ids").alias("c"), "ids").first()
    assert r["c"] == zlib.crc32(r["ids"])
