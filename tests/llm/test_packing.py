import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lettermill.llm.packing import ChunkIds, sum_of_squares

PATH = pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")
MEMO = ChunkIds(PATH, bound=50)


def whole(text):
    return MEMO.tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=40), st.text(alphabet="aB's.,!é́Σσ İK1_ \t\n\x1c\xa0<|endoftx>ß한ᄒ", max_size=40)))
def test_chunks_encode_like_the_whole_text(text):
    assert np.frombuffer(MEMO.of(text), "<u4").tolist() == whole(text)


def test_real_words():
    for text in ("Thouea$$$ heed*** don't “quoted” Éàü, l'été <|endoftext|> x<|endoftext|>y 4111 1111, a.b@c.d ΟΔΟΣ ﬁne Å K", "", "   "):
        assert np.frombuffer(MEMO.of(text), "<u4").tolist() == whole(text)


@given(st.lists(st.integers(1, 50), max_size=200))
def test_bins_hold_every_length_without_overlap(lengths):
    lengths = np.array(lengths, np.int64)
    bins, offsets = sum_of_squares(lengths, 50)
    for b in set(bins.tolist()):
        inside = sorted(zip(offsets[bins == b].tolist(), lengths[bins == b].tolist(), strict=True))
        end = 0
        for offset, length in inside:
            assert offset == end
            end += length
        assert end <= 50


def test_perfect_fit_is_found():
    lengths = np.array([30] * 100 + [20] * 100)
    assert sum_of_squares(lengths, 50)[0].max() + 1 == 100
