"""Token ids of whole texts by a public tokenizer, with the ids of repeated pieces remembered.

A byte-pair encoder never joins characters across the start of white space, so a text can be cut before every blank or
line end that follows a non-blank, and each piece encoded by itself. Natural text repeats its pieces; the tokenizer sees
each distinct one once per Python worker (while it is remembered), the rest is look-ups on Arrow arrays. The ids are
those of encoding the whole text (tested on hostile texts).

An added token (such as ``<|endoftext|>``) is recognised where the raw text holds it, as the tokenizer file says; such a
text is encoded whole. Pieces are encoded without added tokens: no piece of the other texts has one but by lower-casing.

Texts are cut on their bytes, before blanks and line ends and between a letter or digit and the punctuation behind it. New
words of letters alone are encoded many in a row: each ends in its one closing token or, where white space is kept, begins
with the one token that holds the blank or line end before it.
"""

from __future__ import annotations

import os
import re
import sys
import types
from collections.abc import Callable, Iterator
from itertools import chain, count, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tidegauge.llm.common import slices

#: Distinct pieces remembered at once; beyond it the memory starts afresh.
REMEMBERED = 700_000
#: Bytes of text that are cut and looked up at once: what a worker holds for them is some thirty times as much.
SLICE_BYTES = 1 << 20
#: Punctuation that is encoded apart from the word before it; an apostrophe may begin a token with letters.
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: A blank or line end behind white space (of any kind): there a piece must not begin.
ODD = r"[\t-\r\x1c-\x20\x{85}\p{Z}][ \n]"
#: Pieces that are one word of letters behind a blank or line end, and how many of them are encoded in a row.
LETTERS, IN_A_ROW = r"^[ \n]\p{L}+$", 256
#: Rows, or as many pieces as they hold, that the tokenizer gets at once.
ROWS_AT_ONCE = 16
#: A blank and a line end as byte-level tokens write them.
OPENING = ("\u0120", "\u010a")
#: By byte: is it one of ``MARKS``.
IS_MARK = np.isin(np.arange(256), list(MARKS.encode()))


def _stem_ends() -> np.ndarray:
    """By two bytes: do they end in a letter or digit below U+0250 that is one character in lower case too."""
    ends = np.zeros((256, 256), bool)
    for c in map(chr, range(0x250)):
        if c.isascii():
            ends[:, ord(c)] = c.isalnum()
        elif c.isalpha() and len(c.lower()) == 1:
            ends[tuple(c.encode())] = True
    return ends


STEM_ENDS = _stem_ends()


def strings(column: pa.Array) -> list[str]:
    """The strings of a column, several times faster than ``to_pylist``."""
    return column.to_numpy(zero_copy_only=False).tolist()


class PieceEncoder:
    """Encode texts with the tokenizer file ``path``.

    ``spaces_vanish`` says that the tokenizer drops white space and lower-cases, so words are the pieces; else white
    space belongs to the piece that follows it.
    """

    def __init__(self, path: str, spaces_vanish: bool):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.own_setting = self.tokenizer.encode_special_tokens
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.tokenizer.encode_special_tokens = True
        self.spaces_vanish = spaces_vanish
        self.cut = re.compile(r"(?<=\S)(?=[ \n])")
        vocab, suffix = self.tokenizer.get_vocab(), getattr(self.tokenizer.model, "end_of_word_suffix", None)
        borders = (t for t in vocab if (suffix and t.endswith(suffix) if spaces_vanish else t.startswith(OPENING)))
        self.border = np.zeros(max(vocab.values(), default=0) + 1, bool)
        self.border[[vocab[t] for t in borders]] = True
        self.forget()

    def forget(self) -> None:
        self.places: dict[str, int] = {}
        self.pool = np.zeros(0, np.uint32)
        self.ends = np.zeros(1, np.int64)

    def places_of(self, pieces: list[str], learn: Callable[[list[str]], None]) -> np.ndarray:
        """Where the ids of pieces stand; unknown ones are encoded first, by ``learn``."""
        at = np.fromiter(map(self.places.get, pieces, repeat(-1)), np.int64, len(pieces))
        unknown = np.flatnonzero(at < 0)
        if len(unknown):
            learn(list(dict.fromkeys(pieces[i] for i in unknown)))
            at[unknown] = [self.places[pieces[i]] for i in unknown]
        return at

    def learn(self, missing: list[str]) -> None:
        """Encode new pieces. A letter or digit and the punctuation behind it are never one token, so a word is encoded
        without its trailing marks, and only once whatever follows it. The letter is looked at in lower case, as a
        tokenizer may see it: there a capital dotted I ends in a combining mark, which goes with what follows."""
        whole, joined = [], []
        for piece in missing:
            stem = piece.rstrip(MARKS)
            if len(stem) == len(piece) or not stem or stem[-1] > "\u024f" or not stem[-1].lower()[-1].isalnum():
                whole.append(piece)
            else:
                joined.append((piece, stem, piece[len(stem) :]))
        parts = dict.fromkeys(whole) | dict.fromkeys(x for _, *two in joined for x in two)
        new = [p for p in parts if p not in self.places]
        self.hold(new, *self.encode_each(new))
        if joined:
            two = np.array([(self.places[stem], self.places[tail]) for _, stem, tail in joined])
            self.hold([piece for piece, *_ in joined], *self.gather(two.ravel(), 2))

    def encoded(self, texts: list[str], at_once: int) -> Iterator[list[int]]:
        """The ids of each text. What the tokenizer returns is many times as large as its ids, so it is held for a few
        texts only."""
        for i in range(0, len(texts), at_once):
            for got in self.tokenizer.encode_batch_fast(texts[i : i + at_once], add_special_tokens=False):
                yield got.ids

    def encode_each(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces in a row, and the number of each."""
        got = list(self.encoded(pieces, ROWS_AT_ONCE * IN_A_ROW))
        lengths = np.fromiter(map(len, got), np.int64, len(got))
        return np.fromiter(chain.from_iterable(got), np.uint32, int(lengths.sum())), lengths

    def learn_words(self, missing: list[str]) -> None:
        """Encode new pieces of :meth:`_by_bytes`. Words of letters alone are encoded in rows. Each gives one border token
        at least; where a row has more of them than words, its words are encoded one by one."""
        column = pa.array(missing, pa.string())
        in_rows = pc.match_substring_regex(column, LETTERS)
        words, others = strings(column.filter(in_rows)), strings(column.filter(pc.invert(in_rows)))
        rows = [words[i : i + IN_A_ROW] for i in range(0, len(words), IN_A_ROW)]
        new, flat, lengths = [], [], []
        for row, got in zip(rows, self.encoded(list(map("".join, rows)), ROWS_AT_ONCE)):
            ids = np.array(got, np.uint32)
            border = np.flatnonzero(self.border[ids])
            ends = border + 1 if self.spaces_vanish else np.append(border[1:], len(ids))
            if len(border) == len(row) and ends[-1] == len(ids):
                new += row
                flat.append(ids)
                lengths.append(np.diff(ends, prepend=0))
            else:
                others += row
        each = self.encode_each(others)
        self.hold(new + others, *(np.concatenate([*x, y]) for x, y in zip((flat, lengths), each)))

    def hold(self, pieces: list[str], flat: np.ndarray, lengths: np.ndarray) -> None:
        self.places.update(zip(pieces, count(len(self.places))))
        self.pool = np.concatenate([self.pool, flat])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(lengths)])

    def gather(self, at: np.ndarray, every: int = 1) -> tuple[np.ndarray, np.ndarray]:
        """The ids at the places ``at`` in a row, and how many belong to each ``every`` places."""
        starts, lengths = self.ends[at], self.ends[at + 1] - self.ends[at]
        after = np.cumsum(lengths)
        total = int(after[-1]) if len(after) else 0
        ids = self.pool[np.arange(total) + np.repeat(starts - (after - lengths), lengths)]
        return ids, lengths.reshape(-1, every).sum(axis=1)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and the number of ids of each text. NULL counts as empty."""
        texts = texts.fill_null("")
        marked = np.zeros(len(texts), bool)
        for token in self.added:
            marked |= np.asarray(pc.match_substring(texts, token))
        if not len(texts):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        if not marked.any():
            return self._by_pieces(texts)
        ids, counts = self._by_pieces(pc.if_else(pa.array(marked), "", texts))
        per_text = np.split(ids, np.cumsum(counts)[:-1])
        self.tokenizer.encode_special_tokens = self.own_setting
        for i in np.flatnonzero(marked):
            whole = self.tokenizer.encode(texts[int(i)].as_py(), add_special_tokens=False).ids
            per_text[i] = np.array(whole, np.uint32)
        self.tokenizer.encode_special_tokens = True
        return np.concatenate(per_text), np.fromiter(map(len, per_text), np.int64, len(per_text))

    def _by_pieces(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids and numbers of ids of texts without an added token."""
        if len(self.places) > REMEMBERED:
            self.forget()
        odd = np.zeros(len(texts), bool)
        if self.spaces_vanish:
            # such a tokenizer also lower-cases; for A-Z that can be done first
            plain = pc.binary_join_element_wise("", texts, " ")
            plain = pc.ascii_lower(pc.replace_substring(plain, "\n", " "))
        else:
            odd = np.asarray(pc.match_substring_regex(texts, ODD))
            plain = pc.if_else(pa.array(odd), "", texts) if odd.any() else texts
        at, pieces = self._by_bytes(plain.cast(pa.string()))
        if odd.any():
            at, pieces = self._with_odd(texts, odd, at, pieces)
        ids, lengths = self.gather(at)
        bounds = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], np.cumsum(pieces)])]
        return ids, np.diff(bounds)

    def _by_bytes(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The places of all pieces in a row, and the number of pieces of each text. A piece begins at a blank or line end,
        at marks behind a stem, and with the text."""
        ends, raw = texts.buffers()[1:]
        bounds = np.frombuffer(ends, np.int32)[texts.offset : texts.offset + len(texts) + 1]
        if bounds[0] == bounds[-1]:
            return np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
        held = np.frombuffer(raw, np.uint8)[bounds[0] : bounds[-1]]
        bounds = bounds - bounds[0]
        begins = (held == ord(" ")) | (held == ord("\n"))
        marks = np.flatnonzero(IS_MARK[held])
        begins[marks] = STEM_ENDS[held[np.maximum(marks - 2, 0)], held[marks - 1]]
        begins[bounds[:-1][np.diff(bounds) > 0]] = True
        cuts = np.append(np.flatnonzero(begins), len(held))
        buffers = [None, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(held)]
        coded = pa.Array.from_buffers(pa.string(), len(cuts) - 1, buffers).dictionary_encode()
        at = self.places_of(strings(coded.dictionary), self.learn_words)
        return at[np.asarray(coded.indices)], np.diff(np.searchsorted(cuts, bounds))

    def _with_odd(self, texts, odd, at, counts) -> tuple[np.ndarray, np.ndarray]:
        """The places with those of the texts marked ``odd``, which are cut by the rule itself."""
        per_text = np.split(at, np.cumsum(counts)[:-1])
        for i in np.flatnonzero(odd):
            per_text[i] = self.places_of(self.cut.split(texts[int(i)].as_py()), self.learn)
        return np.concatenate(per_text), np.fromiter(map(len, per_text), np.int64, len(per_text))


def worker_encoder(path: str, spaces_vanish: bool) -> PieceEncoder:
    """The encoder of this Python worker: it outlives the task, so later tasks find its pieces."""
    shelf = sys.modules.setdefault("tidegauge_llm_worker_shelf", types.ModuleType("tidegauge_llm_worker_shelf"))
    key = f"{path}|{spaces_vanish}"
    if key not in vars(shelf):
        vars(shelf)[key] = PieceEncoder(path, spaces_vanish)
    return vars(shelf)[key]


def blobs(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """``values`` (of a little-endian type) cut at ``ends``, as a binary array of their bytes."""
    cuts = np.concatenate([[0], ends]).astype(np.int32) * values.dtype.itemsize
    raw = np.ascontiguousarray(values)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(cuts), pa.py_buffer(raw)])


def encode_batches(
    batches: Iterator[pa.RecordBatch], path: str, spaces_vanish: bool
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches with their ``text`` encoded: the slice, all ids in a row, the count of each text."""
    encoder = worker_encoder(path, spaces_vanish)
    for batch in slices(batches, "text", SLICE_BYTES):
        yield batch, *encoder.encode(batch.column("text"))
    pa.default_memory_pool().release_unused()  # the worker waits for later tasks, of other stages too
