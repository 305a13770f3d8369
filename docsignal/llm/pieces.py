"""SentencePiece encoding and decoding: a Viterbi search driven by an Aho-Corasick automaton.

The automaton over all pieces reads a text once.  At each character it reports the pieces that end
there, longest first (its output links), and each relaxes the best score of that position.  Ties go
to the longer last piece.  A character that no single piece covers may also be an unknown, which a
model with byte pieces writes as its UTF-8 bytes.

No piece crosses the start of a run of blanks in the usual models; then the words between are
independent; new words of a portion are searched in one run, known ones come from a memo of bounded
size that a worker process keeps between tasks.  A model
whose pieces do cross is searched over whole texts.

Scores are the model's own for unigram models.  A BPE model has merge ranks instead; there a piece
of rank r scores ``-log(r + 2)`` (the Zipf law), rounded to 1/1024 so that sums are exact.
"""

from __future__ import annotations

import math
import re
import sys
import types
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from docsignal.llm.common import list_array, map_batches

BLANK = "▁"  # fixed value: how pieces write a space
UNKNOWN_PENALTY = 10.0  # fixed value: an unknown scores this much below the worst piece
MEMO_WORDS = 200_000
SEPARATOR = "\n"
ENCODED = "doc_id long, text string, ids array<int>"
DECODED = ", decoded string, ids_crc32 long, n_byte_ids long"


class PieceModel:
    """Pieces, scores and the automaton of a ``.model`` file."""

    def __init__(self, path: str) -> None:
        import ahocorasick
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            proto.ParseFromString(file.read())
        if proto.normalizer_spec.precompiled_charsmap:
            raise ValueError("only models that leave characters as they are can be used")
        if proto.normalizer_spec.remove_extra_whitespaces:
            raise ValueError("only models that keep all blanks can be used")
        kinds = sentencepiece_model_pb2.ModelProto.SentencePiece
        ranked = proto.trainer_spec.model_type == sentencepiece_model_pb2.TrainerSpec.BPE
        self.prefix = proto.normalizer_spec.add_dummy_prefix
        self.unknown = 0
        self.byte_ids: dict[int, int] = {}
        self.bytes: list[bytes] = []
        normal = []
        for i, piece in enumerate(proto.pieces):
            text = piece.piece
            if piece.type == kinds.BYTE:
                self.byte_ids[int(text[3:5], 16)] = i
                self.bytes.append(bytes([int(text[3:5], 16)]))
                continue
            if piece.type == kinds.UNKNOWN:
                self.unknown = i
                self.bytes.append(" ⁇ ".encode())
                continue
            self.bytes.append(text.replace(BLANK, " ").encode() if piece.type != kinds.CONTROL else b"")
            if piece.type in (kinds.NORMAL, kinds.USER_DEFINED):
                normal.append((text, i, piece.score))
        if ranked:
            order = sorted(normal, key=lambda p: (-p[2], p[1]))
            normal = [(t, i, zipf_score(r)) for r, (t, i, _) in enumerate(order)]
        self.scores = {i: s for _, i, s in normal}
        self.unknown_score = min((s for _, _, s in normal), default=0.0) - UNKNOWN_PENALTY
        self.single = {t for t, _, _ in normal if len(t) == 1}
        self.by_word = all(re.fullmatch(f"{BLANK}*|{BLANK}?[^{BLANK}]+", t) for t, _, _ in normal)
        self.automaton = ahocorasick.Automaton()
        for text, i, score in normal:
            self.automaton.add_word(text, (len(text), score, i))
        if normal:
            self.automaton.make_automaton()
        self.memo: dict[str, bytes] = {}  # ids of words met lately
        self.older: dict[str, bytes] = {}  # and of those before

    @classmethod
    def of_process(cls, path: str) -> PieceModel:
        """The model of ``path``, read once in a worker process and kept with its memo for later tasks.

        Code comes with each task, so what is kept hangs on a module of the process itself.
        """
        kept = sys.modules.setdefault("_docsignal_kept", types.ModuleType("_docsignal_kept")).__dict__
        if ("pieces", path) not in kept:
            kept["pieces", path] = cls(path)
        return kept["pieces", path]

    def search(self, chunk: str) -> list[int]:
        """The best ids of ``chunk`` (blanks already written as ``BLANK``)."""
        n = len(chunk)
        best = [0.0] + [-math.inf] * n
        back: list[tuple[int, int]] = [(0, 0)] * (n + 1)
        done = 0  # positions up to here are final

        def unknowns(upto: int) -> None:
            nonlocal done
            for at in range(done, upto):
                if chunk[at] not in self.single:
                    score = best[at] + self.unknown_score
                    if score > best[at + 1]:
                        best[at + 1], back[at + 1] = score, (1, self.unknown)
            done = upto

        matches = self.automaton.iter(chunk) if self.scores else ()
        for end, (length, score, piece) in matches:
            if end > done:
                unknowns(end)
            score += best[end + 1 - length]
            if score > best[end + 1]:
                best[end + 1], back[end + 1] = score, (length, piece)
        unknowns(n)
        return self._walk(chunk, back)

    def search_words(self, words: list[str]) -> list[bytes]:
        """The best ids of many words at once, as 32-bit numbers, in one run of the automaton.

        Words stand one after the other with a character between that no piece contains, so no match
        reaches over it.  Only for words whose characters are all pieces: there nothing is unknown.
        """
        text = SEPARATOR.join(words)
        best = [-math.inf] * (len(text) + 1)
        back = [(0, 0.0, 0)] * (len(text) + 1)
        starts, at = [], 0
        for word in words:
            starts.append(at)
            best[at] = 0.0
            at += len(word) + 1
        for end, match in self.automaton.iter(text):
            end += 1
            score = best[end - match[0]] + match[1]
            if score > best[end]:
                best[end], back[end] = score, match
        out = []
        for start, word in zip(starts, words):
            at, ids = start + len(word), array("i")
            while at > start:
                length, _, piece = back[at]
                ids.append(piece)
                at -= length
            ids.reverse()
            out.append(ids.tobytes())
        return out

    def learn(self, words: set[str]) -> None:
        """See to it that the memo holds ``words``.  It keeps those of the last two rounds of MEMO_WORDS."""
        if len(self.memo) > MEMO_WORDS:
            self.memo, self.older = {}, self.memo
        new = words.difference(self.memo)
        known = [w for w in new if w in self.older]
        self.memo.update(zip(known, map(self.older.__getitem__, known)))
        new.difference_update(known)
        plain = [w for w in new if self.single.issuperset(w) and SEPARATOR not in w]
        self.memo.update(zip(plain, self.search_words(plain)))
        for word in new.difference(plain):
            self.memo[word] = array("i", self.search(word)).tobytes()

    def _walk(self, chunk: str, back: list[tuple[int, int]]) -> list[int]:
        at, ids = len(chunk), []
        while at:
            length, piece = back[at]
            if piece != self.unknown:
                ids.append(piece)
            elif self.byte_ids:
                ids += [self.byte_ids[b] for b in reversed(chunk[at - 1].encode("utf-8"))]
            elif not ids or ids[-1] != piece:
                ids.append(piece)
            at -= length
        return ids[::-1]

    def encode(self, text: str) -> np.ndarray:
        """Ids of one text."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of every text."""
        written = [t.replace(" ", BLANK) if t else "" for t in texts]
        if self.prefix:
            written = [BLANK + t if t else "" for t in written]
        if not self.by_word:
            return [np.array(self.search(t) if t else [], np.int32) for t in written]
        words = list(map(WORD.findall, written))
        self.learn(set().union(*words))
        ids = self.memo.__getitem__
        return [np.frombuffer(b"".join(map(ids, own)), np.int32) for own in words]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; bytes that form no character become U+FFFD."""
        text = b"".join(map(self.bytes.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return text[1:] if self.prefix and text.startswith(" ") else text


WORD = re.compile(f"{BLANK}+[^{BLANK}]*|[^{BLANK}]+")


def zipf_score(rank: int) -> float:
    return -round(math.log(rank + 2) * 1024) / 1024


def encode(
    docs: DataFrame, model_path: str, key: str = "doc_id", text: str = "text", back: bool = False
) -> DataFrame:
    """``doc_id, text, ids`` of every row; with ``back`` also what ``decode`` adds, in one pass.

    NULL and empty texts have no ids.  NULL keys and repeated rows are kept as they come; other
    columns are ignored; an empty table gives no rows.  Texts are searched whole.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = PieceModel.of_process(model_path)
        for batch in batches:
            for rows in _portions(batch):
                ids = model.encode_all(rows.column(1).to_pylist())
                flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
                sizes = np.array([len(x) for x in ids], np.int64)
                columns = [rows.column(0).cast(pa.int64()), rows.column(1), list_array(flat, sizes)]
                if back:
                    columns += _decoded(model, ids)
                yield pa.RecordBatch.from_arrays(columns, names=NAMES[: len(columns)])

    schema = ENCODED + DECODED if back else ENCODED
    return map_batches(docs.select(F.col(key).cast("long"), text), run, schema)


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """``encoded`` with ``decoded``, the text of its ids, ``ids_crc32`` and ``n_byte_ids``.

    The checksum is of the ids as little-endian unsigned 32-bit numbers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = PieceModel.of_process(model_path)
        for batch in batches:
            for rows in _portions(batch):
                column = rows.column(2)
                flat, ends = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
                ids = [flat[a:b] for a, b in zip(ends[:-1], ends[1:])]
                yield pa.RecordBatch.from_arrays([*rows.columns, *_decoded(model, ids)], names=NAMES)

    return map_batches(encoded.select("doc_id", "text", "ids"), run, ENCODED + DECODED)


NAMES = ["doc_id", "text", "ids", "decoded", "ids_crc32", "n_byte_ids"]


def _decoded(model: PieceModel, ids: list[np.ndarray]) -> list[pa.Array]:
    is_byte = np.zeros(len(model.bytes), bool)
    is_byte[list(model.byte_ids.values())] = True
    return [
        pa.array([model.decode(x) for x in ids], pa.string()),
        pa.array([zlib.crc32(np.ascontiguousarray(x, "<u4").tobytes()) for x in ids], pa.int64()),
        pa.array([int(is_byte[x].sum()) for x in ids], pa.int64()),
    ]


def restored(text: str = "text", decoded: str = "decoded") -> Column:
    """Whether a text came back; the one character that stands for blanks comes back as a blank."""
    return F.replace(F.coalesce(text, F.lit("")), F.lit(BLANK), F.lit(" ")) == F.col(decoded)


def _portions(batch: pa.RecordBatch, rows: int = 500) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)
