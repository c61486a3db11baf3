"""Operators 1 and 7 against the tokenizer libraries on whole texts."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from helpers import LONG, ODD, frame, sentences
from shelfwise.llm import packing, token_counts

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")
TRICKY = [
    "a", " a", "a ", "  a  b  ", "a\nb", "\n", "\n\n a", "a \n b", "tab\tand  two", "<s>x</s>", "x\u0000y",
    "it's THE end., !! don't.", "<|endoftext|> in a text<|startoftext|>", "<|ENDOFTEXT|>", "ﬁne ünïcödé 日本語 😀",
    "é e ́", "1234 56.78", ".,", "a.,b", "ÉA., É.,", "x" * 3000, ("lineend\n" * 4000), "▁ ▁▁ a▁b",
]


def texts():
    return [(i, t) for i, t in enumerate(TRICKY + sentences(1, 60))]


@pytest.mark.parametrize("path", [PIECES, WORDS])
def test_counts_are_the_librarys(spark, path):
    rows = texts() + [(1000, LONG[1])]
    got = {r.doc_id: r for r in token_counts.token_counts(frame(spark, rows, extra=True), path).collect()}
    if path == PIECES:
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        count = lambda t: len(sp.encode(t))
    else:
        tk = Tokenizer.from_file(path)
        count = lambda t: len(tk.encode(t, add_special_tokens=False).ids)
    for i, t in rows:
        r = got[i]
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(t.encode()), count(t), count(t) > 4096), repr(t[:50])


def test_counts_of_odd_rows(spark):
    got = token_counts.token_counts(frame(spark, ODD), PIECES).collect()
    assert len(got) == len(ODD)
    assert sorted((r.n_bytes, r.n_tokens) for r in got if r.doc_id in (3, 4)) == [(0, 0), (0, 0)]
    assert token_counts.token_counts(frame(spark, []), PIECES).count() == 0


def check_packing(rows, texts_by_id, sequence):
    tk = Tokenizer.from_file(WORDS)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_doc) == set(texts_by_id)
    for i, own in by_doc.items():
        ids = tk.encode(texts_by_id[i] or "", add_special_tokens=False).ids + [2]
        at = 0
        for r in sorted(own, key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(np.asarray(ids[at:at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= sequence
    assert set(by_sequence) == set(range(len(by_sequence)))
    return sum(r.length for r in rows) / (len(by_sequence) * sequence)


def test_packing_keeps_every_id_once(spark):
    rows = texts() + [(1000, LONG[1])]
    full = check_packing(packing.pack(frame(spark, rows, extra=True), WORDS).collect(), dict(rows), packing.SEQUENCE)
    assert full > 0.9


def test_packing_pads_little(spark):
    rows = [(i, t) for i, t in enumerate(sentences(2, 400, most=90))]
    got = packing.pack(frame(spark, rows), WORDS, sequence=256).collect()
    assert check_packing(got, dict(rows), 256) > 0.97


def test_packing_of_odd_rows(spark):
    got = packing.pack(frame(spark, ODD), WORDS).collect()
    assert len(got) == len(ODD) and {r.sequence_id for r in got} == {0}
    assert packing.pack(frame(spark, []), WORDS).count() == 0


def test_histogram_packs_are_counts():
    histogram = {4096: 10**9, 3000: 10**6, 1000: 10**6 + 1, 96: 5, 1: 10**7}
    runs = packing.pack_histogram(histogram)
    placed = defaultdict(int)
    for length, rank, n, first, offset in runs:
        assert rank == placed[length] and offset + length <= 4096
        placed[length] += n
    assert dict(placed) == histogram and len(runs) < 5000


def test_words_encoded_together_have_the_ids_they_have_alone():
    """Letters of all kinds, some of which the tokenizer takes apart, invalid
    bytes, words of signs and digits; with a cache that starts over."""
    from tokenizers import Tokenizer

    import public_tokenizers
    from shelfwise.llm import packing

    path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, "rb") as f:
        encoder = packing._WordIds(f.read())
    assert encoder.ends.any() and encoder.by_word
    plain = Tokenizer.from_file(path)
    rng = random.Random(3)
    letters = "abcXYZéßÀİŉǅﬁДж日本क́­１²٣0.,'-_!  \n\t"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(400)]
    texts += ["a" * 3000, ",,..", "<|endoftext|> word", "İstanbul İ", "ét́e", "", " \n"]
    for part in (texts[:200], texts[200:], texts[:50]):
        want = [plain.encode(t, add_special_tokens=False).ids for t in part]
        got = [np.frombuffer(b, "<u4").tolist() for b in encoder.ids([t.encode() for t in part])]
        assert got == want
