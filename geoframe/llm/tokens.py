"""Encoding whole texts with a tokenizers file, fast.

Both vocabularies' pre-tokenizers cut texts at white space, so the ids of a
text are those of its blank-separated chunks, one after the other, and most
chunks are one word of plain letters with punctuation behind it.  Texts go
through Arrow in slices of some megabytes: chunks are cut and made distinct
there, words and punctuation (the pieces) are looked up in what the worker has
met before, and the tokenizers library is asked for new pieces and for chunks
of any other form only.  Texts that hold a special token's string go to the
library whole.
"""

from __future__ import annotations

import os
import re
import struct
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MAX_BYTES = 64 << 20          # of a dictionary of chunks; half of it stays
ENTRY_BYTES = 200             # that an entry of it takes besides
PIECE_BYTES = 32 << 20        # of pieces and their ids that a worker keeps, as arrays
MAX_CHUNK_CHARS = 64          # longer ones are encoded every time
SLICE_BYTES = 4 << 20         # of text that are encoded at once
_FNV = np.uint64(0x100000001B3)


def load(path: str):
    """The file's tokenizer without truncation and padding, on one thread."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


def ids_to_bytes(ids) -> bytes:
    """Little-endian unsigned 32-bit integers."""
    return struct.pack(f"<{len(ids)}I", *ids)


#: ASCII that is neither letter, digit nor white space, but the apostrophe: "'s" is a piece
TAIL = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: The byte-level form of a byte: itself if printable, else a letter from 256 on.
_SHOWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_HIDDEN = [b for b in range(256) if b not in set(_SHOWN)]
BYTE_LEVEL = {b: b for b in _SHOWN} | {b: 256 + i for i, b in enumerate(_HIDDEN)}
BLANK = chr(BYTE_LEVEL[0x20])
LETTERS = "".join(filter(str.isalpha, map(chr, range(256))))


def byte_level(text: str) -> str:
    """The text's bytes as the byte-level pre-tokenizer shows them."""
    return text.encode("utf-8").decode("latin-1").translate(BYTE_LEVEL)


def word_and_tail(chunk: str) -> tuple[str, str] | None:
    """A chunk that is one word of plain letters and the punctuation after it:
    by either vocabulary's pattern these are two pieces.  Else None."""
    word = chunk.rstrip(TAIL)
    if word.isalpha() and (word.isascii() or max(word) < "\u0100"):
        return word, chunk[len(word):]
    return None


def words_and_tails(chunks: pa.Array) -> tuple[np.ndarray, pa.Array, pa.Array]:
    """``word_and_tail`` of an array: which chunks have that form, and both parts of all."""
    words = pc.utf8_rtrim(chunks, TAIL)
    return (pc.match_substring_regex(words, f"^[{LETTERS}]+$").to_numpy(zero_copy_only=False),
            words, pc.utf8_ltrim(chunks, LETTERS))


class ChunkCache(dict):
    """chunk -> what ``make(chunk)`` gives, made when first asked for.  What has not
    been asked for since the half before last was filled is forgotten."""

    def __init__(self, make):
        super().__init__()
        self.make, self.size, self.older = make, 0, {}

    def __missing__(self, chunk):
        if chunk in self.older:
            value = self.older.pop(chunk)
        else:
            value = self.make(chunk)
        if len(chunk) <= MAX_CHUNK_CHARS:
            if self.size >= MAX_BYTES // 2:
                self.older = dict(self)
                self.clear()
                self.size = 0
            self.size += ENTRY_BYTES + len(chunk) + len(value or b"")
            self[chunk] = value
        return value


def gather(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``values[s:s + n]`` for all pairs of a start and a length, end to end."""
    shift = starts - (np.cumsum(lengths) - lengths)
    return values[np.repeat(shift, lengths) + np.arange(int(lengths.sum()))]


class Ids:
    """Lists of ids, end to end."""

    def __init__(self, values: np.ndarray, lengths: np.ndarray):
        self.values, self.lengths = values, lengths
        self.starts = np.cumsum(lengths) - lengths

    @classmethod
    def of(cls, lists: list):
        lengths = np.fromiter(map(len, lists), "int64", len(lists))
        return cls(np.fromiter(chain.from_iterable(lists), "uint32", int(lengths.sum())), lengths)

    def take(self, which: np.ndarray) -> Ids:
        return Ids(gather(self.values, self.starts[which], self.lengths[which]), self.lengths[which])

    @classmethod
    def joined(cls, parts: list) -> Ids:
        return cls(np.concatenate([p.values for p in parts]), np.concatenate([p.lengths for p in parts]))

    def __add__(self, other: Ids) -> Ids:
        return Ids.joined([self, other])

    def grouped(self, group: np.ndarray, n: int) -> Ids:
        """Neighbours of the same group (ascending, below ``n``) become one list."""
        return Ids(self.values, np.bincount(group, self.lengths, n).astype("int64"))


def text_keys(texts: pa.Array) -> np.ndarray:
    """A number per text (FNV-1a of the length and the first ``MAX_CHUNK_CHARS`` bytes)."""
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, "int32")[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(data or b"", "u1")
    left = np.diff(at).astype("int64")
    keys, live = left.astype("uint64"), np.arange(len(texts))
    at = at[:-1].astype("int64")
    for j in range(MAX_CHUNK_CHARS):
        more = left > j
        live, at, left = live[more], at[more], left[more]
        if not len(live):
            break
        keys[live] = (keys[live] ^ data[at + j]) * _FNV
    return keys


class Pieces:
    """What a worker keeps: pieces met and their ids, the oldest forgotten first.  They
    are found by their keys, in ascending order with the place of each, and compared."""

    def __init__(self, make):
        self.make, self.texts, self.ids = make, pa.array([], pa.string()), Ids.of([])
        self.keys, self.places = np.zeros(0, "uint64"), np.zeros(0, "int64")

    def _find(self, texts: pa.Array, keys: np.ndarray) -> np.ndarray:
        """The place of every text, -1 where it is not known."""
        if not len(self.texts):
            return np.full(len(texts), -1)
        at = self.places[np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)]
        same = pc.equal(texts, self.texts.take(pa.array(at))).to_numpy(zero_copy_only=False)
        return np.where(same, at, -1)

    def _add(self, texts: pa.Array, ids: Ids) -> None:
        keys = text_keys(texts)
        order = np.argsort(keys)
        at = np.searchsorted(self.keys, keys[order])
        self.keys = np.insert(self.keys, at, keys[order])
        self.places = np.insert(self.places, at, order + len(self.texts))
        self.texts, self.ids = pa.concat_arrays([self.texts, texts]), self.ids + ids
        while len(self.texts) and self.texts.nbytes + self.ids.values.nbytes + 32 * len(self.texts) > PIECE_BYTES:
            n = (len(self.texts) + 1) // 2
            self.ids = self.ids.take(np.arange(n, len(self.texts)))
            self.texts = pa.concat_arrays([self.texts[n:]])
            stay = self.places >= n
            self.keys, self.places = self.keys[stay], self.places[stay] - n

    def __call__(self, texts: pa.Array) -> Ids:
        which = self._find(texts, text_keys(texts))
        missed = np.nonzero(which < 0)[0]
        if not len(missed):
            return self.ids.take(which)
        unknown = texts.take(pa.array(missed)).dictionary_encode()
        new, known = unknown.dictionary, len(self.texts)
        made = Ids.of([self.make(t) for t in new.to_pylist()])
        which[missed] = known + unknown.indices.to_numpy()
        found = (self.ids + made).take(which)
        short = np.nonzero(pc.less_equal(pc.utf8_length(new), MAX_CHUNK_CHARS).to_numpy(zero_copy_only=False))[0]
        self._add(new.take(pa.array(short)), made.take(short))
        return found


class Encoder:
    """Texts to ids as the library has them (add_special_tokens=False)."""

    def __init__(self, path: str):
        self.tokenizer = load(path)
        self.special = tuple(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        self.pieces = Pieces(self._piece)

    def _whole(self, text: str) -> list:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _wholes(self, texts: list) -> list:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _piece(self, piece: str) -> list:
        """Ids of a word of plain letters, with or without a blank before it, of
        punctuation (``TAIL``) or of a line end."""
        if not piece.isascii() or piece == "\n":
            piece = byte_level(piece)
        elif piece[0] == " ":
            piece = BLANK + piece[1:]
        return [t.id for t in self.tokenizer.model.tokenize(piece)]

    def __call__(self, text: str) -> bytes:
        """The ids of a whole text as bytes."""
        return self.encode(pa.array([text], pa.string())).values.astype("<u4").tobytes()

    def encode(self, texts: pa.Array, end: list | tuple = ()) -> Ids:
        """The ids of every text (null: empty) with ``end`` behind them.  Texts above
        a slice are cut where a chunk starts."""
        texts = texts.cast(pa.string()).fill_null("")
        whole = np.zeros(len(texts), bool)
        for s in self.special:
            whole |= pc.match_substring(texts, s).to_numpy(zero_copy_only=False)
        large = pc.binary_length(texts).to_numpy(zero_copy_only=False) > SLICE_BYTES
        if not (whole | large).any():
            return self._slice(texts, end)
        out, start = [], 0
        for i in [*np.nonzero(whole | large)[0].tolist(), len(texts)]:
            out.append(self._slice(texts[start:i], end))
            if i < len(texts):
                text = texts[i].as_py()
                parts = Ids.joined([Ids.of([self._whole(text)])] if whole[i] else
                                   [self._slice(pa.array([p], pa.string()), ()) for p in self._parts(text)])
                values = np.concatenate([parts.values, np.array(end, "uint32")])
                out.append(Ids(values, np.array([len(values)])))
            start = i + 1
        return Ids.joined(out)

    def _parts(self, text: str):
        at, step = 0, max(1, SLICE_BYTES // 4)
        while at < len(text):
            cut = self.CUT.search(text, at + step) if at + step < len(text) else None
            stop = cut.start() if cut else len(text)
            yield text[at:stop]
            at = stop

    def _slice(self, texts: pa.Array, end) -> Ids:
        n = len(texts)
        if not n:
            return Ids.of([])
        chunks, counts, heads = self._chunks(texts)
        coded = chunks.dictionary_encode()
        # the lists: distinct chunks, heads of the texts, the end
        lists = self._ids_of_chunks(coded.dictionary) + Ids.of([*self._wholes(heads), list(end)])
        m = len(coded.dictionary)
        owner = np.repeat(np.arange(n), counts)
        at = np.arange(len(chunks)) + 2 * owner + 1
        code = np.full(len(chunks) + 2 * n, m + len(heads), "int64")
        code[at] = coded.indices.to_numpy(zero_copy_only=False)
        first = np.cumsum(counts + 2) - counts - 2
        code[first] = m + np.arange(n)
        group = np.repeat(np.arange(n), counts + 2)
        return lists.take(code).grouped(group, n)

    def _ids_of_chunks(self, chunks: pa.Array) -> Ids:
        """The ids of distinct chunks.  Each is cut at line ends; if all its parts have
        the plain form, it is made of pieces, else the library has it."""
        lines = pc.split_pattern(chunks, "\n")
        parts, counts = lines.flatten(), np.diff(lines.offsets.to_numpy())
        n, owner = len(chunks), np.repeat(np.arange(len(chunks)), counts)
        plain, words, tails = words_and_tails(parts)
        good = np.bincount(owner, ~plain, n) == 0
        keep = good[owner]
        last = np.cumsum(counts) - 1
        is_first, is_last = np.zeros(len(parts), bool), np.zeros(len(parts), bool)
        is_first[last - counts + 1], is_last[last] = True, True
        mask = pa.array(keep)
        # word, punctuation, line end; what is empty is not looked up
        words, tails = self._keys(words.filter(mask), is_first[keep]), tails.filter(mask)
        k = len(words)
        tailed = np.nonzero(pc.binary_length(tails).to_numpy(zero_copy_only=False))[0]
        broken = np.nonzero(~is_last[keep])[0] if self.BREAK else np.zeros(0, "int64")
        found = self.pieces(pa.concat_arrays([words, tails.take(pa.array(tailed)),
                                              pa.array([self.BREAK] * len(broken), pa.string())]))
        order = np.argsort(np.concatenate([3 * np.arange(k), 3 * tailed + 1, 3 * broken + 2]))
        part = np.concatenate([np.arange(k), tailed, broken])[order]
        made = found.take(order).grouped(owner[keep][part], n)
        odd = np.nonzero(~good)[0]
        other = Ids.of(self._wholes([self.LEAD + c for c in chunks.take(pa.array(odd)).to_pylist()]))
        which = np.arange(n)
        which[odd] = n + np.arange(len(odd))
        return (made + other).take(which)


class ByteLevelEncoder(Encoder):
    """``byte_bpe``: a chunk is a blank and what follows up to the next blank
    that is followed by something else than white space; the pattern always
    starts a new word at such a blank.  A text's head has no blank before it."""

    CUT, LEAD, BREAK = re.compile(r" (?=\S)"), " ", "\n"

    def _keys(self, words, is_first):
        return pc.binary_join_element_wise(pc.if_else(pa.array(is_first), " ", ""), words, "")

    def _chunks(self, texts):
        cut = pc.split_pattern(texts, " ")
        flat, counts = cut.flatten(), np.diff(cut.offsets.to_numpy())
        # a chunk that starts with white space, or none: its text is cut by the pattern
        start = pc.utf8_slice_codeunits(flat, 0, 1).dictionary_encode()
        bad = np.array([not c or c.isspace() for c in start.dictionary.to_pylist()], bool)
        first = np.cumsum(counts) - counts
        odd = bad[start.indices.to_numpy(zero_copy_only=False)]
        odd[first] = False
        owner = np.repeat(np.arange(len(texts)), counts)
        odd = np.bincount(owner[odd], minlength=len(texts)) > 0
        heads = flat.take(pa.array(first)).to_pylist()
        inner = np.ones(len(flat), bool)
        inner[first] = False
        if not odd.any():
            return flat.filter(pa.array(inner)), counts - 1, heads
        rest = {i: self.CUT.split(texts[i].as_py()) for i in np.nonzero(odd)[0].tolist()}
        kept, done, counts = [], 0, counts - 1
        for i, (head, *own) in rest.items():
            stop = int(first[i])
            kept += [flat[done:stop].filter(pa.array(inner[done:stop])), pa.array(own, pa.string())]
            done = int(first[i] + counts[i]) + 1
            heads[i], counts[i] = head, len(own)
        kept.append(flat[done:].filter(pa.array(inner[done:])))
        return pa.concat_arrays(kept), counts, heads


class WordEncoder(Encoder):
    """``word_bpe``: white space is dropped, so chunks are what lies between
    blanks, and line ends leave nothing."""

    CUT, LEAD, BREAK = re.compile(r" (?=\S)"), "", ""

    def _keys(self, words, is_first):
        return pc.utf8_lower(words)

    def _chunks(self, texts):
        cut = pc.split_pattern(texts, " ")
        return cut.flatten(), np.diff(cut.offsets.to_numpy()), [""] * len(texts)


_ENCODERS: dict = {}


def encoder(kind, path: str):
    """The worker's encoder of this kind and file (kept between tasks)."""
    key = (kind, path)
    if key not in _ENCODERS:
        _ENCODERS[key] = kind(path)
    return _ENCODERS[key]


def encoded_blocks(batches, enc: Encoder, end_id: int, most: int):
    """``(keys, ids, ends of the documents in ids)`` of runs of whole documents, each
    closed by the document with which it holds ``most`` ids; batches are of a key and
    a text, and every document ends with ``end_id``."""
    keys, parts, counts, held = [], [], [], 0
    for batch in batches:
        names, texts = batch.column(0).to_pylist(), batch.column(1)
        sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype("int64"))
        a = 0
        while a < len(names):
            before = int(sizes[a - 1]) if a else 0
            b = max(a + 1, int(np.searchsorted(sizes, before + SLICE_BYTES, side="right")))
            ids = enc.encode(texts[a:b], [end_id])
            done, at = 0, 0
            while done < b - a:
                ends = np.cumsum(ids.lengths[done:])
                stop = int(np.searchsorted(ends, most - held))
                take = min(stop + 1, len(ends))
                keys += names[a + done:a + done + take]
                parts.append(ids.values[at:at + int(ends[take - 1])])
                counts.append(ids.lengths[done:done + take])
                held, at, done = held + int(ends[take - 1]), at + int(ends[take - 1]), done + take
                if held >= most:
                    yield keys, np.concatenate(parts), np.cumsum(np.concatenate(counts))
                    keys, parts, counts, held = [], [], [], 0
            a = b
    if keys:
        yield keys, np.concatenate(parts), np.cumsum(np.concatenate(counts))
