"""SentencePiece encoding by streaming Viterbi, and decoding.

Pieces come from an existing model file (nothing is trained).  The file gives each piece a rank,
best first; a unigram model needs log probabilities, so the rank is turned into one by the
Zipf-Mandelbrot law.  The best segmentation maximises the sum of piece scores.
Characters are read one at a time.  Only the last ``longest`` positions (the longest piece)
can still be extended; as soon as the backpointer paths of all of them meet at one boundary,
the ids before it are committed and forgotten, so memory stays bounded for texts of any
length."""

from __future__ import annotations

import re
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memo, slices

SPACE = "▁"             # how pieces write a space
LITERAL = "\ud800"           # stands for a "▁" of the text itself; cannot occur in valid text
UNKNOWN_PENALTY = 10.0
ZIPF_SHIFT = 2.7
NEVER = float("-inf")
SHORT = 64               # a text of so few characters is one window
SPACED = re.compile(r" +[^ ]*")


class PieceModel:
    """Vocabulary of a SentencePiece model file with byte fallback; ``score``: log probability of a piece."""

    def __init__(self, path: str):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size = sp.get_piece_size()
        usable = [i for i in range(size) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        scores = -np.log(np.arange(1, len(usable) + 1) + ZIPF_SHIFT)       # ids stand in rank order
        scores -= np.log(np.exp(scores).sum())
        self.score = dict(zip(map(sp.id_to_piece, usable), scores.tolist()))
        self.id = {sp.id_to_piece(i): i for i in usable}
        self.bytes = {int(sp.id_to_piece(i)[3:5], 16): i for i in range(size) if sp.is_byte(i)}
        self.text = {i: p.replace(SPACE, " ").encode() for p, i in self.id.items()} | {i: bytes([b]) for b, i in self.bytes.items()}
        self.longest = max(map(len, self.score))
        self.starts = {p[:k] for p in self.score for k in range(1, len(p))}      # proper prefixes of pieces
        self.trie = self.with_prefixes(self.score, NEVER)
        self.unknown = min(self.score.values()) - UNKNOWN_PENALTY
        # no piece goes on after a space run ended: a boundary stands before each run of spaces
        self.space_bound = not any(SPACE in p.lstrip(SPACE) for p in self.score)

    def with_prefixes(self, weights: dict, none: float) -> dict:
        """``weights`` by piece, and ``none`` for strings that only begin a piece: one look-up tells both
        whether a string is a piece and whether a longer one can be."""
        return dict.fromkeys(self.starts, none) | weights

    def fallback(self, char: str) -> list[int]:
        return [self.bytes[b] for b in (SPACE if char == LITERAL else char).encode()]

    def emit(self, piece: str) -> list[int]:
        found = self.id.get(piece)
        return [found] if found is not None else self.fallback(piece)


def viterbi(model: PieceModel, text: str, on_window=None) -> list[int]:
    """Ids of the best segmentation of ``text`` (spaces already written as ``▁``).  Of equal sums the
    one found from the earliest start of the last piece wins.  ``on_window`` is told how many
    positions are held (tests)."""
    if len(text) <= SHORT:
        best, back = [0.0] + [NEVER] * len(text), [0] * (len(text) + 1)
        _lay(model, text, 0, len(text), best, back)
        return _path(model, text, back, 0, len(text))
    ids, base, longest, n = [], 0, model.longest, len(text)      # base: last committed boundary
    best, back = [0.0], [0]              # by boundary position, from ``base`` on
    at = 0                               # pieces are laid from every position before this one
    while at < n:
        stop = min(at + longest, n)
        size = min(stop + longest, n) - base + 1
        best += [NEVER] * (size - len(best))
        back += [0] * (size - len(back))
        part = text[base:base + size - 1]
        _lay(model, part, at - base, stop - base, best, back)
        at = stop
        if on_window:
            on_window(size)
        if at == n:
            break
        # only boundaries that pieces laid so far reach can be extended; where do their paths meet?
        alive = {p for p in range(at - base, size) if best[p] > NEVER}
        while len(alive) > 1:            # follow the furthest path back
            furthest = max(alive)
            alive.remove(furthest)
            alive.add(back[furthest])
        meet = alive.pop()
        if meet:
            ids += _path(model, part, back, 0, meet)
            best, back, base = best[meet:], [b - meet for b in back[meet:]], base + meet
    return ids + _path(model, text[base:], back, 0, n - base)


def _lay(model: PieceModel, text: str, start: int, stop: int, best: list, back: list):
    """Try every piece that begins at a position from ``start`` to before ``stop``."""
    get, n, unknown = model.trie.get, len(text), model.unknown
    for begin in range(start, stop):
        here, end = best[begin], begin + 1
        value = get(text[begin])
        if value is None or value == NEVER:
            if here + unknown > best[end]:
                best[end], back[end] = here + unknown, begin
        while value is not None:
            if here + value > best[end]:
                best[end], back[end] = here + value, begin
            end += 1
            if end > n:
                break
            value = get(text[begin:end])


def _path(model, text, back, start, end):
    """Ids of the pieces on the best path from ``start`` to ``end``."""
    out = []
    while end > start:
        out.append(text[back[end]:end])
        end = back[end]
    out.reverse()
    try:
        return [model.id[p] for p in out]
    except KeyError:                     # a character outside the vocabulary
        return [i for p in out for i in model.emit(p)]


class PieceEncoder:
    """Whole texts to ids.  A boundary certain beforehand (before a run of spaces) cuts the text into
    words, whose ids are remembered; a text without spaces streams as one word."""

    def __init__(self, path: str):
        self.model = PieceModel(path)
        self.memo = Memo(self.word)

    def word(self, word: str) -> bytes:
        escaped = SPACE + word.replace(SPACE, LITERAL).replace(" ", SPACE)
        return array("i", viterbi(self.model, escaped)).tobytes()

    def __call__(self, text: str) -> np.ndarray:
        if not text:
            return np.empty(0, np.int32)
        if not self.model.space_bound:
            return np.frombuffer(self.word(text), np.int32)
        if "  " in text or text[0] == " ":
            words = [w[1:] for w in SPACED.findall(" " + text)]
        else:
            words = text.split(" ")
        return np.frombuffer(b"".join(map(self.memo.__getitem__, words)), np.int32)


def decode(model: PieceModel, ids) -> str:
    """Text of ``ids``: pieces joined, ``▁`` as spaces, byte pieces as UTF-8, the leading space removed."""
    raw = b"".join(map(model.text.__getitem__, ids))
    return raw.decode("utf-8", "replace")[1:]


def encode_documents(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id, ids, n_ids, n_chars, round_trip`` (decoding gives the text back).

    Null texts count as empty and have no ids.  No shuffle; repeated rows, null ids and other columns
    don't matter.  An empty table gives no rows."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        encoder = PieceEncoder(model_path)
        for batch in slices(batches):
            texts = batch.column(1).to_pylist()
            ids = [encoder(t) for t in texts]
            same = [decode(encoder.model, i.tolist()) == t for i, t in zip(ids, texts)]
            sizes = np.array([len(i) for i in ids], np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), pa.array(np.concatenate(ids)))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists, pa.array(sizes), pa.array([len(t) for t in texts], pa.int64()),
                                              pa.array(same, pa.bool_())], names=[id_col, "ids", "n_ids", "n_chars", "round_trip"])

    rows = docs.select(F.col(id_col), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
    return rows.mapInArrow(run, f"{id_col} {id_type}, ids array<int>, n_ids long, n_chars long, round_trip boolean")


def decode_documents(encoded: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id, text`` from lists of ids (null list: empty text)."""
    id_type = encoded.schema[id_col].dataType.simpleString()

    def run(batches):
        model = PieceModel(model_path)
        for batch in slices(batches):
            texts = [decode(model, i or []) for i in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[id_col, "text"])

    return encoded.select(id_col, ids_col).mapInArrow(run, f"{id_col} {id_type}, text string")
