"""New words are encoded many in a row: how few calls that takes, and words for which it must not be done."""

from __future__ import annotations

from itertools import product

import pyarrow as pa
import public_tokenizers
from tokenizers import Tokenizer

from tidegauge.llm.tokens import IN_A_ROW, ROWS_AT_ONCE, PieceEncoder, encode_batches

BYTE, WORD = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))


class Counting:
    """A tokenizer that counts the strings it is given."""

    def __init__(self, tokenizer):
        self.tokenizer, self.given, self.most = tokenizer, 0, 0

    def encode_batch_fast(self, texts, **options):
        self.given += len(texts)
        self.most = max(self.most, sum(map(len, texts)))
        return self.tokenizer.encode_batch_fast(texts, **options)


def encoded(texts, path=WORD):
    encoder = PieceEncoder(path, spaces_vanish=path == WORD)
    encoder.tokenizer = Counting(encoder.tokenizer)
    ids, counts = encoder.encode(pa.array(texts, pa.string()))
    want = [e.ids for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    assert ids.tolist() == [i for each in want for i in each] and counts.tolist() == list(map(len, want))
    return encoder.tokenizer.given


def test_a_word_costs_no_call_of_its_own_whatever_marks_follow_it():
    words = ["".join(x) for x in product("abdeknorstuéßñ", repeat=3)]
    marked = [w + m for w, m in zip(words, [".", ",", "!?", ".x", ""] * len(words), strict=False)]
    assert encoded([" ".join(words), "\n".join(marked), " ".join(words[::-1])]) <= len(words) // IN_A_ROW + 1 + 4


def test_letters_that_are_no_word_in_a_row_of_words():
    words = ["".join(x) for x in product("aeknorst", repeat=3)]
    for odd in ("İ", "xİ", "xİ.", "Éİé", "क़", "a'sz", "´x", "x1y", "ǅ", "é.Σ Σ.é"):
        encoded([" ".join([*words[:300], odd, *words[300:]]), odd, f"{odd} {odd}.", ""])


def test_no_texts_and_empty_texts():
    assert encoded(["", " ", "\n", ""]) <= 1
    ids, counts = PieceEncoder(WORD, spaces_vanish=True).encode(pa.array([], pa.string()))
    assert len(ids) == len(counts) == 0


def test_rows_of_words_where_white_space_is_kept():
    words = ["".join(x) for x in product("abdeknorstuéßñ", repeat=3)]
    marked = [w + m for w, m in zip(words, [".", ",", "!?", ".x", ""] * len(words), strict=False)]
    given = encoded([" ".join(words), "\n".join(marked), " ".join(words[::-1])], BYTE)
    assert given <= 2 * len(words) // IN_A_ROW + 1 + 3 + 4  # behind blanks and line ends; first words; marks
    for odd in ("İ", "xİ.", "क़", "a'sz", "x1y", "é.Σ Σ.é", "\n\n", "  x", "x\t", "Ġ", "aĊb", "x \n y", "É.\nÉ", "\u00a0"):
        encoded([" ".join([*words[:300], odd, *words[300:]]), odd, f"{odd} {odd}.", "", f"\n{odd}\n{odd}"], BYTE)
    assert encoded(["", ""], BYTE) == 0


def test_the_tokenizer_gets_few_texts_at_once():
    words = ["".join(x) for x in product("abdeknorstuéßñ", repeat=4)]
    for path in (BYTE, WORD):
        encoder = PieceEncoder(path, spaces_vanish=path == WORD)
        encoder.tokenizer = counting = Counting(encoder.tokenizer)
        ids, counts = encoder.encode(pa.array([" ".join(words), " ".join(f"{w}7" for w in words)]))
        assert counting.most <= ROWS_AT_ONCE * IN_A_ROW * 6
        assert counts.sum() == len(ids) > 2 * len(words)


def test_slices_of_a_batch_are_small():
    text = "some words, again and again. " * 2_000
    batch = pa.RecordBatch.from_pydict({"text": [text, None, *[text] * 100, "", text * 50]})
    got = list(encode_batches(iter([batch]), BYTE, spaces_vanish=False))
    assert [t for b, *_ in got for t in b.column("text").to_pylist()] == batch.column("text").to_pylist()
    # rows of more than a slice alone; ten tokens and more to a row
    assert all(b.num_rows == 1 or b.column("text").nbytes < 1.2 * (1 << 20) for b, *_ in got) and len(got) > 5
    want = {t: len(Tokenizer.from_file(BYTE).encode(t or "", add_special_tokens=False).ids) for t in {text, None, "", text * 50}}
    assert [int(n) for *_, counts in got for n in counts] == [want[t] for t in batch.column("text").to_pylist()]
