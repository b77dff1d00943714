"""Byte-level BPE ids of whole texts, through the tokenizers library with a memory of pieces.

A blank between two other characters always begins a new pre-token, so a text
may be cut there and its pieces encoded apart. Pieces repeat, so each worker
remembers the ids of up to `REMEMBERED` pieces and asks the library for new
ones only, many at a time; a full memory becomes the old one, from which pieces
in use return. The ids equal those of the whole text. Pieces are cut, looked up
and joined as Arrow arrays, of lots of texts that `lots` bounds.

A piece is remembered without the blank it begins with; a NUL in front says
that the rest stands as it is. A word that itself begins with NUL keeps its
blank behind that mark.
"""

import os
import re
import sys
import types
from codecs import charmap_decode
from collections.abc import Iterator
from itertools import chain
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

REMEMBERED = 300_000
JOINED = 50
LOT_CHARS = 1 << 23
TEXT = pa.large_string()
_CUT = re.compile(r"(?<=\S)(?= \S)")
_SPACE = re.compile(r"[\s\x00\x1c-\x1f\x85]|<\|")
# Patterns of Arrow's regexes. A text is odd that holds white space other than single blanks and newlines between other
# characters, a NUL, or what may be a special token.
_ODD = (r"[\x00\t\x0b-\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
        r"|  |\n\n| \n|\n |<\||^[ \n]|[ \n]\z")
_LETTERS = r"^[A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{24f}]+[.,;:!?]*\z"


def lots(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Stretches of texts, from and to, of `LOT_CHARS` characters and one more text at most."""
    first, size = 0, 0
    for k, text in enumerate(texts):
        size += len(text)
        if size >= LOT_CHARS:
            yield first, k + 1
            first, size = k + 1, 0
    if first < len(texts):
        yield first, len(texts)


def byte_letters() -> str:
    """For each byte the letter that stands for it in a byte-level vocabulary: printable ones themselves, the rest from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in plain]
    return "".join(chr(b) if b in plain else chr(256 + rest.index(b)) for b in range(256))


def _spread(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places first, first + 1, ... of each stretch, one after another."""
    ends = np.cumsum(size)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(first - (ends - size), size)


class Encoder:
    """Encodes texts with the vocabulary file at `path`."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        os.environ["RAYON_NUM_THREADS"] = "1"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        form = str(self.tokenizer.pre_tokenizer)
        self.byte_level = (form.startswith("ByteLevel(add_prefix_space=False") and "use_regex=True" in form
                           and self.tokenizer.normalizer is None)
        self.newline = self.tokenizer.token_to_id("\u010a")
        self.byte_level = self.byte_level and self.newline is not None
        known = self.tokenizer.get_vocab(with_added_tokens=True)
        self.blank_first = np.zeros(max(known.values()) + 1, bool)
        self.blank_first[[k for token, k in known.items() if token[0] == "\u0120"]] = True
        self.letters, self.tokenize = byte_letters(), self.tokenizer.model.tokenize
        # Whether the model alone keeps words and marks apart: of the bytes that `_LETTERS` lets through, no id holds
        # a blank after, or a mark beside, something else.
        word = re.escape("".join(self.letters[b] for b in (*range(0x80, 0xC0), *range(0xC3, 0xCA)))) + "A-Za-z"
        across = re.compile(rf"[{word}.,;:!?\u0120]*(?:[{word}.,;:!?\u0120]\u0120|[{word}][.,;:!?]|[.,;:!?][{word}])[{word}.,;:!?\u0120]*")
        self.separate = self.byte_level and not any(map(across.fullmatch, known))
        self._begin()
        self._begin()

    def _begin(self) -> None:
        """Set the memory aside as the old one and begin a new one."""
        if hasattr(self, "pieces"):
            self.old = (self.pieces, self.ids[:self.used].copy(), self.starts[:len(self.pieces) + 1].copy())
        self.pieces = pa.array([], TEXT)
        self.ids = np.empty(1 << 16, np.uint32)
        self.starts = np.zeros(1 << 14, np.int64)
        self.used = 0

    def _plain(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _joined(self, words: pa.Array, gap: str, plain: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
        """The words' ids, and where each word's begin and how many they are, from long texts with the gap before each word.

        A pre-token begins at each gap: a blank becomes the first letter of the
        word's first id, a newline an id of its own. None if that did not hold.
        Plain words need no more than the library's model, since no merge spans
        two pre-tokens of theirs.
        """
        bounds = np.append(np.arange(0, len(words), JOINED), len(words))
        rows = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(bounds, pa.int64()), words), pa.scalar(gap, TEXT))
        texts = [gap + row for row in rows.to_pylist()]
        if plain:
            letters = (charmap_decode(text.encode(), "strict", self.letters)[0] for text in texts)
            ids = np.fromiter(map(attrgetter("id"), chain.from_iterable(map(self.tokenize, letters))), np.uint32)
        else:
            ids = np.fromiter(chain.from_iterable(self._plain(texts)), np.uint32)
        starts = np.flatnonzero(self.blank_first[ids] if gap == " " else ids == self.newline)
        if len(starts) != len(words):
            return None
        ends = np.append(starts[1:], len(ids))
        first = starts if gap == " " else starts + 1
        return ids, first, ends - first

    def _ask(self, new: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and for each of the pieces where its own begin and how many they are.

        Pieces without white space inside are joined to long texts, which cost
        less than one text each; the others are asked for apart.
        """
        kinds = np.full(len(new), 3, np.int8)
        if self.byte_level:
            letters = pc.match_substring_regex(new, _LETTERS).to_numpy(zero_copy_only=False)
            kinds[letters] = 0 if self.separate else 1
            others = np.flatnonzero(~letters)
            kinds[others] = [3 if _SPACE.search(piece, 1) or piece == "\x00" else 2 if piece[0] == "\x00" else 1
                             for piece in new.take(pa.array(others)).to_pylist()]
        found, first, size, used = [], np.zeros(len(new), np.int64), np.zeros(len(new), np.int64), 0
        for kind, gap in enumerate((" ", " ", "\n", "")):
            places = np.flatnonzero(kinds == kind)
            if not len(places):
                continue
            words = new.take(pa.array(places))
            bare = pc.utf8_slice_codeunits(words, 1) if kind == 2 else words
            answer = self._joined(bare, gap, kind == 0) if gap else None
            if answer is None:
                lists = self._plain([(word[1:] if word[0] == "\x00" else " " + word) for word in words.to_pylist()])
                sizes = np.fromiter(map(len, lists), np.int64, len(lists))
                answer = np.fromiter(chain.from_iterable(lists), np.uint32), np.cumsum(sizes) - sizes, sizes
            ids, starts, sizes = answer
            first[places], size[places] = starts + used, sizes
            found.append(ids)
            used += len(ids)
        return np.concatenate([np.empty(0, np.uint32), *found]), first, size

    def _learn(self, new: pa.Array) -> None:
        """Take the new pieces from the old memory or from the library."""
        pieces, ids, starts = self.old
        before = pc.index_in(new, value_set=pieces).fill_null(-1).to_numpy()
        unknown = before < 0
        asked, asked_first, asked_sizes = self._ask(new.filter(pa.array(unknown)))
        first, sizes = np.empty(len(new), np.int64), np.empty(len(new), np.int64)
        first[unknown], sizes[unknown] = len(ids) + asked_first, asked_sizes
        first[~unknown] = starts[before[~unknown]]
        sizes[~unknown] = starts[before[~unknown] + 1] - first[~unknown]
        flat = np.concatenate([ids, asked])[_spread(first, sizes)]
        ends, known = self.used + np.cumsum(sizes), len(self.pieces)
        while self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
        while known + len(new) + 1 > len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
        self.ids[self.used:self.used + len(flat)] = flat
        self.starts[known + 1:known + len(new) + 1] = ends
        self.used += len(flat)
        self.pieces = pa.concat_arrays([self.pieces, new])

    def _cut(self, texts: list[str]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """Pieces, and for each text where its own begin and how many they are."""
        whole = pa.array(texts, TEXT)
        odd = pc.match_substring_regex(whole, _ODD)
        empty = pa.scalar("", TEXT)
        marked = pc.replace_substring(pc.if_else(odd, empty, whole), "\n", " \x00\n \x00")
        rows = pc.split_pattern(pc.binary_join_element_wise(empty, marked, pa.scalar("\x00", TEXT)), " ")
        pieces, ends = rows.flatten(), np.cumsum(pc.list_value_length(rows).to_numpy(), dtype=np.int64)
        first = np.concatenate([np.zeros(1, np.int64), ends])[:-1]
        size = ends - first
        places = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
        if len(places):
            cut = [self._cut_odd(texts[k]) for k in places]
            size[places] = [len(part) for part in cut]
            first[places] = len(pieces) + np.cumsum(size[places]) - size[places]
            pieces = pa.concat_arrays([pieces, pa.array(list(chain.from_iterable(cut)), TEXT)])
        return pieces, first, size

    def _cut_odd(self, text: str) -> list[str]:
        if "<|" in text:
            return ["\x00" + text]
        return [p[1:] if k and p[0] == " " and p[1] != "\x00" else "\x00" + p for k, p in enumerate(_CUT.split(text))]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and the number of ids of each text."""
        pieces, begin, count = self._cut(texts)
        found = pc.index_in(pieces, value_set=self.pieces)
        missing = found.is_null()
        numbers, unknown = found.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), missing.to_numpy(zero_copy_only=False)
        if found.null_count:
            new = pieces.filter(missing).dictionary_encode()
            numbers[unknown] = len(self.pieces) + new.indices.to_numpy()
            self._learn(new.dictionary)
        numbers = numbers[_spread(begin, count)]
        first = self.starts[numbers]
        size = self.starts[numbers + 1] - first
        flat = self.ids[_spread(first, size)]
        bounds = np.concatenate([[0], np.cumsum(size)])[np.cumsum([0, *count])]
        if len(self.pieces) > REMEMBERED:
            self._begin()
        return flat, np.diff(bounds)


def worker_encoder(path: str) -> Encoder:
    """This worker's encoder. It outlives a task, since Spark gives a worker one task after another."""
    memory = sys.modules.setdefault("granary_worker_memory", types.ModuleType("granary_worker_memory"))
    encoders = memory.__dict__.setdefault("encoders", {})
    if path not in encoders:
        encoders[path] = Encoder(path)
    return encoders[path]
