"""Words and hashes of Arrow batches against plain Python."""

import random

import numpy as np
import pyarrow as pa

from ledgerline.llm import text_arrays as ta

TEXTS = [None, "", " a  bc\td\n", "x", "ünï  çé \x0b y\x1cz", "a a a", " nbsp", "end "]


def test_words_are_those_of_a_split_on_ascii_space():
    raw, offsets = ta.texts(pa.array(TEXTS))
    starts, stops, doc = ta.word_spans(raw, offsets)
    data = raw.tobytes()
    found = [[data[a:b] for a, b, d in zip(starts, stops, doc) if d == i] for i in range(len(TEXTS))]
    assert found == [(t or "").encode().split() for t in TEXTS]


def test_sliced_and_chunked_columns():
    column = pa.chunked_array([pa.array(TEXTS[:4]), pa.array(TEXTS[4:])]).slice(2, 4)
    raw, offsets = ta.texts(column)
    assert [raw.tobytes()[a:b].decode() for a, b in zip(offsets[:-1], offsets[1:])] == TEXTS[2:6]


def test_equal_spans_have_equal_hashes_and_others_differ():
    rnd = random.Random(1)
    data = bytes(rnd.choice(b"ab") for _ in range(400))
    raw = np.frombuffer(data, np.uint8)
    starts = np.array([rnd.randrange(390) for _ in range(3000)])
    stops = starts + np.array([rnd.randrange(10) for _ in range(3000)])
    for which in (0, 1):
        seen = {}
        for a, b, h in zip(starts, stops, ta.byte_hashes(raw, starts, stops, which).tolist()):
            assert seen.setdefault(data[a:b], h) == h
        assert len(set(seen.values())) == len(seen)


def test_chunks_cover_all_texts_in_order():
    offsets = np.array([0, 5, 5, 30, 31, 60])
    assert list(ta.chunks(offsets, 10)) == [(0, 2), (2, 3), (3, 4), (4, 5)]
    assert list(ta.chunks(np.zeros(1, np.int64), 10)) == []
