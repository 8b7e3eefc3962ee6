"""SentencePiece encoding and decoding: an Aho-Corasick automaton drives a one-pass Viterbi.

The automaton holds all pieces. It reads a text once; at each position it reports the pieces that end
there, longest first, by following its output links, and each relaxes the best score of that position
from the position where it begins. A character that is no piece may be taken as its UTF-8 bytes, at a
cost below every piece. The result is the segmentation with the highest sum of piece scores, the
longer last piece on ties. For a model made by merging, the scores are the merge ranks, so this is the
best segmentation under these scores and need not equal the one that replays the merges.

Texts are normalised as such models do: a blank in front, and every blank written as a marker. No
piece has a marker behind another character, so a text is encoded word by word and words met before
are looked up; if a vocabulary has such a piece, texts are encoded whole. A line feed that is in no
piece ends a word too.

Edge cases: null counts as empty, and an empty text has no pieces. Decoding turns the marker
character into a blank even where the text itself had one; `normal_text` says what a text decodes to.
Tables without rows give none; ids, repeated or null, are passed through.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

MARK = "▁"
#: Words kept with their pieces by a Python worker; beyond that the store starts anew.
KEPT_WORDS = 1 << 18
#: What an unknown character costs more than the worst piece.
UNKNOWN = 10.0


@dataclass(frozen=True)
class Vocabulary:
    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    #: Ids that may be found in texts.
    plain: tuple[int, ...]
    #: Id of each byte value, in order.
    bytes_: tuple[int, ...]


def load_vocabulary(path: str) -> Vocabulary:
    """Read a model file, on the driver; tasks get the vocabulary itself."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    pieces = tuple(model.id_to_piece(i) for i in range(n))
    special = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(n)]
    in_order = {int(pieces[i][3:5], 16): i for i in range(n) if model.is_byte(i)}
    if len(in_order) != 256:
        raise ValueError("the vocabulary needs a piece for every byte")
    return Vocabulary(
        pieces,
        tuple(float(model.get_score(i)) for i in range(n)),
        tuple(i for i in range(n) if not special[i] and not model.is_byte(i)),
        tuple(in_order[b] for b in range(256)),
    )


def normal_text(text: str) -> str:
    return text.replace(MARK, " ")


@dataclass
class Codec:
    vocabulary: Vocabulary
    #: Words met before, with a marker before them and without.
    kept: dict[str, bytes] = field(default_factory=dict)
    bare: dict[str, bytes] = field(default_factory=dict)

    def __post_init__(self) -> None:
        v = self.vocabulary
        self.automaton = ahocorasick.Automaton()
        for i in v.plain:
            self.automaton.add_word(v.pieces[i], (i, len(v.pieces[i]), v.scores[i]))
        self.automaton.make_automaton()
        self.unknown = min((v.scores[i] for i in v.plain), default=0.0) - UNKNOWN
        self.by_word = not any(re.search(f"[^{MARK}]{MARK}", v.pieces[i]) for i in v.plain)
        self.letters = {v.pieces[i] for i in v.plain if len(v.pieces[i]) == 1}
        # A line feed that is in no piece is always one byte by itself.
        self.by_line = not any("\n" in v.pieces[i] for i in v.plain)
        self.line_end = array("i", [v.bytes_[10]]).tobytes()
        table = [p.replace(MARK, " ").encode() for p in v.pieces]
        for b, i in enumerate(v.bytes_):
            table[i] = bytes([b])
        self.table = table
        self.is_byte = np.zeros(len(v.pieces), bool)
        self.is_byte[list(v.bytes_)] = True

    def best(self, marked: str) -> tuple[list[int], float]:
        """Ids and score of the best segmentation of a text with markers."""
        n = len(marked)
        score, came = [0.0] + [-np.inf] * n, [None] * (n + 1)
        if self.letters.issuperset(marked):
            # Every character is a piece, so no position is reached better through bytes.
            for last, found in self.automaton.iter(marked):
                total = score[last + 1 - found[1]] + found[2]
                if total > score[last + 1]:
                    score[last + 1], came[last + 1] = total, found
        else:
            self._relax_with_bytes(marked, score, came)
        ids, end = [], n
        while end:
            found = came[end]
            if found is None:
                spelled = marked[end - 1].encode()
                ids += [self.vocabulary.bytes_[b] for b in reversed(spelled)]
                end -= 1
            else:
                ids.append(found[0])
                end -= found[1]
        return ids[::-1], score[n]

    def _relax_with_bytes(self, marked: str, score: list, came: list) -> None:
        """The same pass where a character may also be taken as bytes."""
        at = 0

        def close(end: int) -> None:
            if score[end - 1] + self.unknown > score[end]:
                score[end], came[end] = score[end - 1] + self.unknown, None

        for last, found in self.automaton.iter(marked):
            while at < last:
                at += 1
                close(at)
            total = score[last + 1 - found[1]] + found[2]
            if total > score[last + 1]:
                score[last + 1], came[last + 1] = total, found
        while at < len(marked):
            at += 1
            close(at)

    def _packed(self, word: str, kept: dict[str, bytes], mark: str) -> bytes:
        """Ids of a word, with a marker before it or none, as four-byte numbers."""
        ids = array("i", self.best(mark + word)[0]).tobytes()
        if len(word) <= 64:
            if len(kept) >= KEPT_WORDS:
                kept.clear()
            kept[word] = ids
        return ids

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, np.int32)
        if not self.by_word:
            return np.array(self.best(MARK + text.replace(" ", MARK))[0], np.int32)
        out, get, make, kept = [], self.kept.get, self._packed, self.kept
        lines = text.split("\n") if self.by_line else [text]
        for k, line in enumerate(lines):
            if MARK in line or "  " in line or line[-1:] == " " or (not k and line[:1] == " "):
                marked = (MARK if not k else "") + line.replace(" ", MARK)
                words = [x[1:] for x in re.findall(f"{MARK}+[^{MARK}]*", marked)]
                bare = re.match(f"[^{MARK}]*", marked)[0]
            else:
                words = line.split(" ")
                bare = words.pop(0) if k else ""
            if k:
                out.append(self.line_end)
                if bare:
                    out.append(self.bare.get(bare) or make(bare, self.bare, ""))
            out += [get(x) or make(x, kept, MARK) for x in words]
        return np.frombuffer(b"".join(out), np.int32)

    def decode(self, ids: np.ndarray) -> str:
        table = self.table
        spelled = b"".join([table[i] for i in ids.tolist()])
        return spelled[1:].decode("utf-8", "replace") if spelled[:1] == b" " else spelled.decode("utf-8", "replace")


_codecs: dict[Vocabulary, Codec] = {}


def codec(vocabulary: Vocabulary) -> Codec:
    """One automaton per Python worker and vocabulary."""
    if vocabulary not in _codecs:
        _codecs.clear()
        _codecs[vocabulary] = Codec(vocabulary)
    return _codecs[vocabulary]


def _lists(parts: list[np.ndarray]) -> pa.Array:
    ends = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) for p in parts], out=ends[1:])
    flat = np.concatenate(parts) if parts else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int32()))


def _runs(batch: pa.RecordBatch, most: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Rows of a batch in runs of about so many bytes."""
    per_row = max(1, batch.nbytes // max(1, batch.num_rows))
    step = max(1, most // per_row)
    for k in range(0, batch.num_rows, step):
        yield batch.slice(k, step)


def encode(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """`id, pieces, n_bytes`: the ids of each text and how many of them are single bytes."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(shared.value)
        for batch in batches:
            for run in _runs(batch):
                ids = [own.encode(t) for t in run.column(1).to_pylist()]
                spelled = [int(own.is_byte[x].sum()) for x in ids]
                yield pa.RecordBatch.from_arrays(
                    [run.column(0), _lists(ids), pa.array(spelled, pa.int64())], ["id", "pieces", "n_bytes"]
                )

    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInArrow(scan, f"id {dict(rows.dtypes)['id']}, pieces array<int>, n_bytes bigint")


def decode(encoded: DataFrame, vocabulary: Vocabulary, id_col: str = "id", pieces: str = "pieces") -> DataFrame:
    """`id, text` from the ids of each text; null counts as none."""
    shared = encoded.sparkSession.sparkContext.broadcast(vocabulary)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(shared.value)
        for batch in batches:
            for run in _runs(batch):
                texts = [own.decode(np.array(x, np.int64)) for x in run.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([run.column(0), pa.array(texts, pa.string())], ["id", "text"])

    none = F.array().cast("array<int>")
    rows = encoded.select(F.col(id_col).alias("id"), F.coalesce(F.col(pieces), none).alias("pieces"))
    return rows.mapInArrow(scan, f"id {dict(rows.dtypes)['id']}, text string")


def round_trip(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """`encode` with `same`: whether decoding the ids gives the normalised text back."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(shared.value)
        for batch in batches:
            for run in _runs(batch):
                texts = run.column(1).to_pylist()
                ids = [own.encode(t) for t in texts]
                same = [own.decode(x) == normal_text(t) for x, t in zip(ids, texts, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        run.column(0),
                        _lists(ids),
                        pa.array([int(own.is_byte[x].sum()) for x in ids], pa.int64()),
                        pa.array(same, pa.bool_()),
                    ],
                    ["id", "pieces", "n_bytes", "same"],
                )

    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInArrow(
        scan, f"id {dict(rows.dtypes)['id']}, pieces array<int>, n_bytes bigint, same boolean"
    )
