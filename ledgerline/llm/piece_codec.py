"""SentencePiece encoding by backtracking, and decoding.

The library merges neighbouring pieces, best score first and leftmost among equals, until no two join. Such
an encoding is the only sequence of pieces in which each two neighbours, put together and merged anew, come
apart as the same two. So it can be found from the left: an Aho-Corasick automaton gives the longest piece
at every place; a piece is taken if it is compatible with the one before it, else the next shorter one is
tried; where none fits, the place is marked in a bit field as one from which there is no way on, and the
piece before it is made shorter. The pieces up to a place are determined by the place, so no place is marked
twice and the work is linear in the text.

Texts are parted where no piece can reach across: before a run of blanks and, where no piece of the model
mixes letters with marks, between these. The parts met before are looked up in a table of bounded size; all new ones of a chunk of texts go through the search side
by side, one step for all of them at a time, by NumPy. Documents are encoded where they are read; nothing is
shuffled and a lost task is simply run again.

Defined results: a null or empty text has no pieces but the begin and end ids, and decodes to the empty
text; characters without a piece become their UTF-8 bytes; repeated rows are encoded row by row; an empty
table gives an empty result; other columns of the input are left out, so they cannot clash; texts of any
length are encoded whole, and a single part of any length too.
"""

from __future__ import annotations

import codecs
import sys
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import table
from ledgerline.llm.text_arrays import chunks, texts

#: What stands for a blank.
BLANK = "▁"
#: Parts of texts, and pairs of pieces, whose result a task keeps.
KEPT_PARTS = 400_000
KEPT_PAIRS = 500_000
#: Slots of the first, direct table of pairs, a power of two.
SLOTS = 1 << 20
#: Longer parts are searched one at a time and not kept.
SIDE_BY_SIDE = 64
#: Bytes of texts taken at a time.
CHUNK = 1 << 21

#: ASCII letters and the bytes of all characters beyond ASCII.
_WORDLIKE = np.zeros(256, bool)
_WORDLIKE[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


def _replace_one_byte(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�", error.start + 1


codecs.register_error("ledgerline-one-byte", _replace_one_byte)


class Codec:
    """Pieces of a model file with byte fallback, an unchanging normaliser and a blank put in front."""

    def __init__(self, path: str):
        import ahocorasick
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        kind = pb.ModelProto.SentencePiece
        rules, training = model.normalizer_spec, model.trainer_spec
        plain = rules.add_dummy_prefix and rules.escape_whitespaces and not rules.remove_extra_whitespaces
        if not plain or rules.precompiled_charsmap or not training.byte_fallback or training.treat_whitespace_as_suffix:
            raise ValueError(f"{path}: only models that leave the text as it is and fall back to bytes")
        if any(p.type in (kind.USER_DEFINED, kind.UNUSED) for p in model.pieces):
            raise ValueError(f"{path}: user-defined and unused pieces are not supported")
        self.id_of = {p.piece: i for i, p in enumerate(model.pieces) if p.type == kind.NORMAL}
        self.score = {p.piece: p.score for p in model.pieces if p.type == kind.NORMAL}
        self.begin = next(i for i, p in enumerate(model.pieces) if p.piece == "<s>")
        self.end = next(i for i, p in enumerate(model.pieces) if p.piece == "</s>")
        byte_ids = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == kind.BYTE}
        self.byte_id = [byte_ids[b] for b in range(256)]
        self.bytes_of = [b""] * len(model.pieces)
        for piece, i in self.id_of.items():
            self.bytes_of[i] = piece.replace(BLANK, " ").encode()
        for b, i in byte_ids.items():
            self.bytes_of[i] = bytes([b])
        self.control = np.array([p.type == kind.CONTROL for p in model.pieces])
        unknown = next((p.piece for p in model.pieces if p.type == kind.UNKNOWN), None)
        if unknown is not None:
            self.bytes_of[[p.piece for p in model.pieces].index(unknown)] = training.unk_surface.encode()
        held = {c for piece in self.id_of for c in piece}
        if held - self.id_of.keys():
            raise ValueError(f"{path}: characters of pieces that are no pieces")
        if any(BLANK in piece.lstrip(BLANK) for piece in self.id_of):
            raise ValueError(f"{path}: pieces with a blank inside")
        self.pieces = [p.piece for p in model.pieces]
        self.length = np.array([len(p) for p in self.pieces], np.int64)
        self.shorter = np.full(len(self.pieces), -1, np.int64)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        self.single = np.full(sys.maxunicode + 1, -2, np.int32)
        for piece, i in self.id_of.items():
            heads = (piece[:n] for n in range(len(piece) - 1, 0, -1))
            self.shorter[i] = next((self.id_of[h] for h in heads if h in self.id_of), -1)
            if len(piece) > 1:
                self.automaton.add_word(piece, i)
            else:
                self.single[ord(piece)] = i
        self.automaton.make_automaton()
        self.stop = next(c for c in "\n\r\0\x01" if c not in held)
        held_pairs = {p.encode()[i : i + 2] for p in self.id_of for i in range(len(p.encode()) - 1)}
        #: No piece has ASCII letters or bytes beyond ASCII next to other ASCII characters.
        self.parted = not any(_WORDLIKE[a] != _WORDLIKE[b] for a, b in held_pairs)
        self._pairs: dict[int, bool] = {}
        self._slot_key = np.full(SLOTS, -1, np.int64)
        self._slot_fits = np.zeros(SLOTS, bool)
        self._encoded: dict[bytes, bytes] = {}

    def merged(self, text: str) -> list[str]:
        """The pieces of a short text by merging, best score first and leftmost among equals."""
        parts, score = list(text), self.score
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                here = score.get(parts[i] + parts[i + 1])
                if here is not None and (best is None or here > best):
                    best, at = here, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def fits(self, left: int, right: int) -> bool:
        """Whether two pieces stay as they are side by side.

        A negative number on the left is a border or a character without a piece: it joins with nothing, and
        the question is whether merging gives the piece itself. Such a character on the right always fits.
        """
        if right < 0:
            return True
        left = max(left, -1)
        key = (left + 1) * len(self.pieces) + right
        known = self._pairs.get(key)
        if known is None:
            if len(self._pairs) >= KEPT_PAIRS:
                self._pairs.clear()
            both = self.pieces[right] if left < 0 else self.pieces[left] + self.pieces[right]
            wanted = 1 if left < 0 else 2
            merged = self.merged(both)
            known = len(merged) == wanted and merged[-1] == self.pieces[right]
            self._pairs[key] = known
        return known

    def _all_fit(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """:meth:`fits` for arrays."""
        key = (np.maximum(left, -1) + 1) * len(self.pieces) + right
        slot = (key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(44)).astype(np.int64) & (SLOTS - 1)
        out = self._slot_fits[slot]
        odd = (self._slot_key[slot] != key) & (right >= 0)
        if odd.any():
            at = np.flatnonzero(odd)
            _, first, inverse = np.unique(key[at], return_index=True, return_inverse=True)
            some = at[first]
            found = np.array([self.fits(a, b) for a, b in zip(left[some].tolist(), right[some].tolist())], bool)
            self._slot_key[slot[some]], self._slot_fits[slot[some]] = key[some], found
            out[at] = found[inverse]
        return out | (right < 0)

    def _longest(self, text: str) -> np.ndarray:
        """The longest piece at every place of a text, -2 where there is none."""
        longest = self.single[np.frombuffer((text + self.stop).encode("utf-32-le"), "<u4")].astype(np.int64)
        found = np.fromiter(chain.from_iterable(self.automaton.iter(text)), np.int64).reshape(-1, 2)
        # Ends come in order, so of the pieces that begin at a place the longest is written last.
        longest[found[:, 0] + 1 - self.length[found[:, 1]]] = found[:, 1]
        return longest

    def backtracked(self, text: str) -> list[int]:
        """The pieces of one text; -2 for a character without a piece."""
        n = len(text)
        longest = self._longest(text).tolist()
        length, shorter = self.length, self.shorter
        failed = bytearray((n >> 3) + 1)
        taken: list[int] = []
        place, candidate = 0, longest[0]
        while place < n:
            before = taken[-1] if taken else -1
            while candidate != -1:
                end = place + (int(length[candidate]) if candidate >= 0 else 1)
                if not failed[end >> 3] >> (end & 7) & 1 and self.fits(before, candidate):
                    break
                candidate = int(shorter[candidate]) if candidate >= 0 else -1
            if candidate == -1:
                failed[place >> 3] |= 1 << (place & 7)
                taken.pop()
                place -= int(length[before]) if before >= 0 else 1
                candidate = int(shorter[before]) if before >= 0 else -1
            else:
                taken.append(candidate)
                place = end
                candidate = longest[place]
        return taken

    def _side_by_side(self, parts: list[str]) -> list[bytes]:
        """The ids of many short parts, as :meth:`backtracked` finds them, searched at once.


        All parts lie in one text, each followed by a character that no piece holds. ``ending`` has the piece
        that ends at a place on the way to it, which is the same whenever the place is reached.
        """
        text = self.stop.join(parts) + self.stop
        longest = self._longest(text)
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        stops = np.cumsum(sizes + 1) - 1
        starts = stops - sizes
        length = np.append(self.length, [1, 1])  # -2 and -1 count from the end
        shorter = np.append(self.shorter, [-1, -1])
        failed = np.zeros(len(text) + 1, bool)
        ending = np.full(len(text) + 1, -1, np.int64)
        place, last = starts[sizes > 0], stops[sizes > 0]
        before, candidate = np.full(len(place), -1, np.int64), longest[place]
        while len(place):
            dead = candidate == -1
            if dead.any():
                failed[place[dead]] = True
                gone = before[dead]
                back = place[dead] - length[gone]
                place[dead], before[dead], candidate[dead] = back, ending[back], shorter[gone]
            end = place + length[candidate]
            good = (candidate != -1) & ~failed[end]
            good[good] = self._all_fit(before[good], candidate[good])
            taken = candidate[good]
            ending[end[good]] = taken
            place[good], before[good] = end[good], taken
            candidate = np.where(good, longest[place], np.where(candidate == -1, -1, shorter[candidate]))
            going = place < last
            if not going.all():
                place, last, before, candidate = place[going], last[going], before[going], candidate[going]
        begins = np.full(len(text), -1, np.int64)
        place, first = stops[sizes > 0], starts[sizes > 0]
        while len(place):
            piece = ending[place]
            place = place - length[piece]
            begins[place] = piece
            going = place > first
            place, first = place[going], first[going]
        at = np.flatnonzero(begins != -1)
        edges = np.searchsorted(at, np.append(starts, len(text)))
        flat = begins[at]
        data, ends = flat.astype("<u4").tobytes(), (4 * edges).tolist()
        out = [data[a:b] for a, b in zip(ends[:-1], ends[1:])]
        for i in np.unique(np.searchsorted(edges, np.flatnonzero(flat < 0), "right") - 1).tolist():
            out[i] = self.ids(parts[i], flat[edges[i] : edges[i + 1]].tolist())
        return out

    def ids(self, part: str, taken: list[int]) -> bytes:
        """The packed ids of a part, with bytes for characters without a piece."""
        if -2 in taken:
            ids, place = [], 0
            for piece in taken:
                ids += [piece] if piece >= 0 else [self.byte_id[b] for b in part[place].encode()]
                place += len(self.pieces[piece]) if piece >= 0 else 1
            taken = ids
        return array("I", taken).tobytes()

    def _ids_of(self, parts: list[bytes]) -> list[bytes]:
        """The packed ids of distinct parts, from the table where they are in it."""
        known = self._encoded
        new = [p for p in parts if p not in known]
        texts = [p.decode().replace(" ", BLANK) for p in new]
        short = [(p, t) for p, t in zip(new, texts) if len(t) <= SIDE_BY_SIDE]
        long = {p: self.ids(t, self.backtracked(t)) for p, t in zip(new, texts) if len(t) > SIDE_BY_SIDE}
        if len(known) + len(short) > KEPT_PARTS:
            known = self._encoded = {p: known[p] for p in parts if p in known}
        known.update(zip((p for p, _ in short), self._side_by_side([t for _, t in short])))
        return [known[p] if p in known else long[p] for p in parts]

    def _part_starts(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where parts begin: at texts, at runs of blanks, and between word-like and other characters."""
        begins = np.zeros(len(raw) + 1, bool)
        blank = raw == 32
        begins[1:-1] = blank[1:] & ~blank[:-1]
        if self.parted:
            kind = _WORDLIKE[raw]
            begins[1:-1] |= (kind[1:] != kind[:-1]) & ~blank[:-1] & ~blank[1:]
        begins[offsets] = True
        return np.flatnonzero(begins)

    def encode(self, column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The ids of texts, without begin and end, a chunk of texts at a time: all ids, and where each text's begin."""
        blank = pa.scalar(" ", column.type)
        column = pc.replace_substring(pc.fill_null(column, ""), BLANK, " ")
        fronted = pc.binary_join_element_wise(blank, column, pa.scalar("", column.type))
        raw, offsets = texts(pc.if_else(pc.equal(pc.binary_length(column), 0), column, fronted))
        for first, last in chunks(offsets, CHUNK):
            part = raw[offsets[first] : offsets[last]]
            own = offsets[first : last + 1] - offsets[first]
            starts = self._part_starts(part, own)
            bounds = pa.py_buffer(starts.astype(np.int64))
            parts = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts) - 1, [None, bounds, pa.py_buffer(part)])
            if not len(parts):
                yield np.zeros(0, np.uint32), np.zeros(last - first + 1, np.int64)
                continue
            coded = parts.dictionary_encode()
            packed = self._ids_of(coded.dictionary.to_pylist())
            number = coded.indices.to_numpy()
            sizes = np.fromiter(map(len, packed), np.int64, len(packed)) // 4
            at = np.cumsum(sizes) - sizes
            count = sizes[number]
            ends = np.cumsum(count)
            flat = np.frombuffer(b"".join(packed), "<u4")
            ids = flat[np.repeat(at[number] - (ends - count), count) + np.arange(ends[-1])]
            yield ids, np.append(0, ends)[np.searchsorted(starts, own)]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; begin and end have none, and a byte that is not UTF-8 becomes a replacement character."""
        runs = [ids]
        if self.control[ids].any():  # a run of bytes does not reach across a control id
            ids = ids[: len(ids) - int(self.control[ids[-1]])]
            ids = ids[int(len(ids) > 0 and self.control[ids[0]]) :]
            runs = np.split(ids, np.flatnonzero(self.control[ids])) if self.control[ids].any() else [ids]
        texts, first = [], True
        for run in runs:
            parts = list(map(self.bytes_of.__getitem__, run.tolist()))
            at = next((i for i, p in enumerate(parts) if p), None)
            if first and at is not None:
                first = False
                if self.pieces[run[at]].startswith(BLANK):
                    parts[at] = parts[at][1:]
            texts.append(b"".join(parts).decode("utf-8", "ledgerline-one-byte"))
        return "".join(texts)


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def round_trip(docs: DataFrame, path: str, begin: bool = True, end: bool = True) -> DataFrame:
    """``doc_id``, ``ids`` (binary, little-endian unsigned 32-bit) and the ``decoded`` text of every document.

    ``path`` names the model file on every executor.
    """
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids binary, decoded string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        it = codec(path)
        head = np.array([it.begin] if begin else [], np.uint32)
        tail = np.array([it.end] if end else [], np.uint32)
        for batch in batches:
            row = 0
            for ids, edges in it.encode(batch.column("text")):
                own = [np.concatenate([head, ids[a:b], tail]) for a, b in zip(edges[:-1], edges[1:])]
                packed = pa.array([i.astype("<u4").tobytes() for i in own], pa.binary())
                back = pa.array(map(it.decode, own), pa.string())
                columns = [batch.column("doc_id").slice(row, len(own)), packed, back]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "decoded"])
                row += len(own)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def op12_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    out = round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return out.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
