"""Token ids of the tokenizers library, word by word with a memory."""

from __future__ import annotations

import gc
import json
import os
import re
from array import array
from functools import cache
from itertools import chain, repeat
from string import punctuation

import numpy as np
import pyarrow as pa
import regex

# --- Fixed values ---------------------------------------------------------
# What the library's ByteLevel step cuts by; a file can only switch it off.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# --- End of fixed values --------------------------------------------------

#: Encoded words a Python worker remembers. It forgets none and learns no more when full.
REMEMBERED = 900_000
#: Text that is encoded at once: words that are not remembered are learnt once in it.
TEXT_BYTES = 4 << 20
#: New words that the library gets at once.
LEARNT_WORDS = 1 << 14
#: Pieces that are one text for the library's model, and what parts them: the sign for the byte FF.
JOINED, PARTING = 1 << 7, "\xff"
#: Bytes of a word that is remembered; a longer one hardly comes again.
LONGEST = 64
#: Pieces of words with other signs in them that are remembered beside the words.
PIECES = 1 << 16

#: What a byte is: white space, a place for a cut among that, an ASCII letter or sign.
SPACE, BREAK, LETTER, SIGN = 1, 2, 4, 8
KINDS = np.array([SPACE * c.isspace() | BREAK * (c in " \n") | LETTER * c.isalpha() | SIGN * (c in punctuation) for c in map(chr, range(0x80))] + [0] * 0x80, dtype=np.uint8)
#: The UTF-8 of the other white space, as numbers.
WIDE_SPACES = np.array([int.from_bytes(chr(i).encode(), "big") for i in range(0x80, 0x10000) if chr(i).isspace()])


class WordTokenizer:
    """Encodes as ``Tokenizer.encode(text, add_special_tokens=False)`` does.

    For a file of byte-level BPE, texts are cut at single spaces and line ends, where its pattern cuts too; different
    words are found by Arrow and remembered. New words are cut by the pattern, and the library's model gets many pieces at a time. Other files are left to the library as a whole. Texts are cut
    at the contents of added tokens first, special ones included, as the library does. Ids are
    little-endian unsigned integers of ``dtype``, two bytes if all ids fit.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        vocabulary = self.library.get_vocab()
        self.size = max(vocabulary.values()) + 1
        self.dtype = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        added = parts.get("added_tokens") or []
        self.by_word = _plain_byte_level(parts) and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or re.search(r"\s|^$", t["content"]) for t in added)
        self.added = {t["content"]: self._raw([t["id"]]) for t in added}
        longest_first = sorted(self.added, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")").split if added else None
        self.split = regex.compile(BYTE_LEVEL).findall
        # byte-level files write each byte as a visible character: itself, or one from 256 on
        seen = {*range(33, 127), *range(161, 173), *range(174, 256)}
        hidden = iter(range(256, 512))
        self.visible = np.array([b if b in seen else next(hidden) for b in range(256)], dtype="<u2")
        self.parting = vocabulary.get(PARTING, -1)
        self.by_word &= self.parting >= 0 and not any(PARTING in token for token in vocabulary if token != PARTING)
        # words by number: word i has ids[edges[i] : edges[i + 1]]
        self.known: dict[bytes, int] = {}
        self.ids, self.edges = np.zeros(1, dtype=self.dtype), np.zeros(1, dtype=np.int64)
        self.pieces: dict[bytes, bytes] = {}

    def _raw(self, ids: list[int]) -> bytes:
        return array(self.code, ids).tobytes()

    def encode_all(self, many: list[str]) -> list[bytes]:
        """The ids of each text."""
        if not self.by_word:
            return [np.array(e.ids, dtype=self.dtype).tobytes() for e in self.library.encode_batch_fast(many, add_special_tokens=False)]
        parted = {i: self.cut(text) for i, text in enumerate(many) if self.cut and any(c in text for c in self.added)}
        if not parted:
            return self._encode_plain(many)
        plain = [text for i, text in enumerate(many) if i not in parted] + [part for own in parted.values() for part in own[::2]]
        ids = self._encode_plain(plain)
        whole, parts = iter(ids), iter(ids[len(many) - len(parted) :])
        return [b"".join(self.added[p] if k % 2 else next(parts) for k, p in enumerate(parted[i])) if i in parted else next(whole) for i in range(len(many))]

    def _encode_plain(self, many: list[str]) -> list[bytes]:
        """The ids of texts without added tokens: their words are numbered, and the ids gathered by number."""
        column = pa.array(many, pa.large_string())
        _, edges, raw = column.buffers()
        edges = np.frombuffer(edges, dtype=np.int64, count=len(many) + 1)
        if not edges[-1]:
            return [b""] * len(many)
        cuts = _word_starts(np.frombuffer(raw, dtype=np.uint8, count=edges[-1]), edges)
        words = pa.Array.from_buffers(pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(cuts), raw]).dictionary_encode()
        starts, sizes = self._places(words.dictionary.to_numpy(zero_copy_only=False).tolist())
        codes = words.indices.to_numpy()
        sizes = sizes[codes]
        ends = np.cumsum(sizes)
        kind = np.int32 if max(len(self.ids), int(ends[-1])) < 1 << 31 else np.int64
        at = np.repeat((starts[codes] - (ends - sizes)).astype(kind), sizes)
        at += np.arange(len(at), dtype=kind)
        ids = self.ids[at].tobytes()
        edges = (self.dtype.itemsize * np.append(0, ends)[np.searchsorted(cuts, edges)]).tolist()
        return list(map(ids.__getitem__, map(slice, edges, edges[1:])))

    def _places(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Where in ``ids`` those of each word begin, and how many they are; good until the next call."""
        known = self.known
        numbers = np.fromiter(map(known.get, words, repeat(-1)), dtype=np.int64, count=len(words))
        new = np.flatnonzero(numbers < 0)
        if len(new):
            # words that are not remembered come last, and their numbers are given again
            long = np.fromiter(map(len, map(words.__getitem__, new.tolist())), dtype=np.int64, count=len(new)) > LONGEST
            new = new[np.argsort(long, kind="stable")]
            first, kept = len(known), 0 if len(known) + len(new) > REMEMBERED else len(new) - int(long.sum())
            fresh = list(map(words.__getitem__, new.tolist()))
            collecting = gc.isenabled()
            gc.disable()  # no cycles here, and the collector would go through all lists of words again and again
            try:
                for start in range(0, len(fresh), LEARNT_WORDS):
                    self._append(first + start, self._learn(fresh[start : start + LEARNT_WORDS]))
            finally:
                if collecting:
                    gc.enable()
            numbers[new] = np.arange(first, first + len(new))
            known.update(zip(fresh[:kept], range(first, first + kept), strict=True))
        starts = self.edges[numbers]
        return starts, self.edges[numbers + 1] - starts

    def _append(self, number: int, own: list[bytes]) -> None:
        """The ids of the words from ``number`` on."""
        ids = np.frombuffer(b"".join(own), dtype=self.dtype)
        ends = self.edges[number] + np.cumsum(np.fromiter(map(len, own), dtype=np.int64, count=len(own))) // self.dtype.itemsize
        self.edges = _room(self.edges, number + len(own) + 1)
        self.edges[number + 1 : number + 1 + len(own)] = ends
        self.ids = _room(self.ids, int(ends[-1]))
        self.ids[ends[-1] - len(ids) : ends[-1]] = ids

    def _learn(self, words: list[bytes]) -> list[bytes]:
        """The ids of words: cut by the pattern, which leaves letters behind a space whole, and encoded piece by piece."""
        pieces, known = self.pieces, self.known
        found = dict.fromkeys(filter(_spaced_letters, words))
        own = {word: [piece.encode() for piece in self.split(word.decode())] for word in words if word not in found}
        fresh = set(chain.from_iterable(own.values())).difference(found, pieces)
        old = [piece for piece in fresh if piece in known]
        pieces.update([(piece, self._known(piece)) for piece in old])
        found = list(found)
        found = dict(zip(found + (fresh := list(fresh.difference(old))), self._apart(found + fresh), strict=True))
        pieces.update([(piece, found[piece]) for piece in fresh])
        out = [b"".join([pieces[p] if p in pieces else found[p] for p in own[word]]) if word in own else found[word] for word in words]
        if len(pieces) > PIECES:
            pieces.clear()
        return out

    def _known(self, word: bytes) -> bytes:
        number = self.known[word]
        return self.ids[self.edges[number] : self.edges[number + 1]].tobytes()

    def _apart(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each piece of the pattern.

        The library's model gets many at a time, parted by bytes FF, which UTF-8 never holds: their token is part
        of no other, so the model merges nothing over it.
        """
        if not pieces:
            return []
        joined = [self._spelled(b"\xff".join(pieces[i : i + JOINED])) for i in range(0, len(pieces), JOINED)]
        tokenize, parting = self.library.model.tokenize, self.parting
        ids = np.array([i for text in joined for i in [*[t.id for t in tokenize(text)], parting]], dtype=self.dtype)
        ends = np.flatnonzero(ids == self.parting)
        starts = np.append(0, ends[:-1] + 1)
        raw, size = ids.tobytes(), self.dtype.itemsize
        return list(map(raw.__getitem__, map(slice, (starts * size).tolist(), (ends * size).tolist())))

    def _spelled(self, raw: bytes) -> str:
        return self.visible[np.frombuffer(raw, dtype=np.uint8)].tobytes().decode("utf-16-le")


def _spaced_letters(word: bytes) -> bool:
    """A space and letters, which are one piece."""
    letters = word[1:]
    return word[:1] == b" " and (letters.isalpha() or (not letters.isascii() and letters.decode().isalpha()))


def _room(values: np.ndarray, n: int) -> np.ndarray:
    """The array, or a copy that holds n values and more to come."""
    if n <= len(values):
        return values
    out = np.zeros(2 * n, dtype=values.dtype)
    out[: len(values)] = values
    return out


def _word_starts(raw: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Where words begin in the UTF-8 of texts that follow each other with these edges, and where the last one ends.

    A word begins with each text, and at a space or a line end behind a character that is no white space. A match
    of the pattern that takes white space along starts at the first white space of its run, so each of these
    places starts a match. A longer run of white space stays whole with what follows. A word begins also at a sign
    behind a letter, as no match goes on from a letter to what is none.
    """
    kinds = KINDS[raw]
    at = np.flatnonzero(kinds & BREAK)
    at = at[at > 0]
    before = raw[at - 1]
    good = (kinds[at - 1] & SPACE) == 0
    high = np.flatnonzero(before >= 0x80)
    if len(high):
        one, two, three = (raw[at[high] - i].astype(np.int32) for i in (1, 2, 3))
        good[high] = ~(np.isin(two << 8 | one, WIDE_SPACES) | np.isin(three << 16 | two << 8 | one, WIDE_SPACES))
    mark = np.zeros(len(raw) + 1, dtype=bool)
    mark[at[good]] = True
    mark[1:-1] |= (kinds[:-1] & LETTER).astype(bool) & (kinds[1:] & SIGN).astype(bool)
    mark[edges] = True
    return np.flatnonzero(mark)


#: Settings by which a model's ids depend on more than the pairs of a piece.
WHOLE = ("dropout", "ignore_merges", "continuing_subword_prefix", "end_of_word_suffix")


def _plain_byte_level(parts: dict) -> bool:
    """A file whose only steps are the ByteLevel cut and a model: nothing else changes a text or its ids."""
    before, after = parts.get("pre_tokenizer") or {}, parts.get("post_processor") or {"type": "ByteLevel"}
    cuts = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
    others = [parts.get(step) for step in ("normalizer", "truncation", "padding")]
    model = parts.get("model") or {}
    return cuts and after.get("type") == "ByteLevel" and not any(others) and model.get("type", "BPE") == "BPE" and not any(model.get(k) for k in WHOLE)


@cache
def word_tokenizer(path: str) -> WordTokenizer:
    """One for each Python worker."""
    return WordTokenizer(path)


def forget_tokenizers() -> None:
    """Give the worker's memory back before work that does not tokenise."""
    word_tokenizer.cache_clear()
