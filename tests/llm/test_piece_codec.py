"""SentencePiece encoding and decoding against the library."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from ledgerline.llm import piece_codec

public_tokenizers = pytest.importorskip("public_tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")
PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def encoded(texts, codec=None):
    codec = codec or piece_codec.codec(PATH)
    return [i[a:b].tolist() for i, e in codec.encode(pa.array(texts, pa.string())) for a, b in zip(e[:-1], e[1:])]


TRICKY = [
    None, "", " ", "  ", "   a", "a  b   c    d", " " * 100, "\n", "\n\n a", "a\tb", "\x00a\x00", "▁x▁▁y", "<s> </s> <unk> <0x41>",
    "漢字かな", "😀😀 ünï", "é é", "x" * 5000, "ab" * 3000, " \n \n ", " x y", "﻿a", "a\r\nb", "�", "1234 5.6,7",
    "don't, (really) #1", " " * 40 + "end ", "ÀÖØöø ×÷", "à́b",
]


def test_tricky_texts(library):
    assert encoded(TRICKY) == [library.encode(t or "") for t in TRICKY]


@pytest.mark.parametrize("seed", range(4))
def test_random_texts(library, seed):
    rnd = random.Random(seed)
    pieces = [p for p in piece_codec.codec(PATH).id_of if len(p) < 6]
    short = "aeiouthns   .,\n▁漢é😀the1<>"
    texts = ["".join(rnd.choice(short) for _ in range(rnd.randrange(60))) for _ in range(400)]
    texts += ["".join(rnd.choice(pieces) for _ in range(rnd.randrange(9))) for _ in range(400)]
    assert encoded(texts) == [library.encode(t) for t in texts]


def test_a_long_text_without_blanks_and_one_at_a_time(library):
    rnd = random.Random(9)
    text = "".join(rnd.choice("abcdefgh") for _ in range(100_000))
    assert encoded([text, "x" * 70_000]) == [library.encode(text), library.encode("x" * 70_000)]


def test_small_tables_change_nothing(library, monkeypatch):
    """Tables of pairs and parts that overflow all the time, and chunks of a few texts."""
    for name, value in {"KEPT_PARTS": 5, "KEPT_PAIRS": 7, "CHUNK": 200}.items():
        monkeypatch.setattr(piece_codec, name, value)
    rnd = random.Random(3)
    texts = [" ".join("".join(rnd.choice("theanrin") for _ in range(7)) for _ in range(9)) for _ in range(60)]
    assert encoded(texts, piece_codec.Codec(PATH)) == [library.encode(t) for t in texts]


def test_decoding_any_ids(library):
    """Bytes that are no UTF-8, begin and end anywhere, and a blank that only leads a piece."""
    rnd, codec = random.Random(5), piece_codec.codec(PATH)
    for _ in range(3000):
        ids = [rnd.randrange(400) for _ in range(rnd.randrange(12))]
        assert codec.decode(np.array(ids, int)) == library.decode(ids)


def test_backtracking_where_the_longest_piece_is_wrong(library):
    """The greedy pieces differ from the merged ones in some of these words, and the way back is taken."""
    codec = piece_codec.codec(PATH)
    words = ["▁heationthe", "▁ththenth", "▁inghaea", "▁ofanwhenre", "▁esmenterrque"]
    greedy = []
    for word in words:
        longest, place, taken = codec._longest(word), 0, []
        while place < len(word):
            taken.append(int(longest[place]))
            place += len(codec.pieces[taken[-1]])
        greedy.append(taken)
    found = [codec.backtracked(w) for w in words]
    assert found == [library.encode(w[1:]) for w in words]
    assert found != greedy


def test_query_rows(spark, hard, library, tmp_path):
    hard.write.parquet(f"{tmp_path}/documents.parquet")
    found = sorted((tuple(r) for r in piece_codec.op12_sentencepiece(spark, str(tmp_path)).collect()), key=repr)
    wanted = []
    for row in hard.collect():
        ids = [1, *library.encode(row.text or ""), 2]
        packed, text = np.array(ids, "<u4").tobytes(), library.decode(ids)
        digests = [hashlib.sha256(x).hexdigest() for x in (packed, text.encode())]
        wanted.append((row.doc_id, len(ids), *digests))
    assert found == sorted(wanted, key=repr)


def test_an_empty_table(empty):
    assert piece_codec.round_trip(empty, PATH).collect() == []


def test_other_models_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2 as pb

    model = pb.ModelProto()
    with open(PATH, "rb") as f:
        model.ParseFromString(f.read())
    model.normalizer_spec.remove_extra_whitespaces = True
    (tmp_path / "m.model").write_bytes(model.SerializeToString())
    with pytest.raises(ValueError, match="as it is"):
        piece_codec.Codec(str(tmp_path / "m.model"))
