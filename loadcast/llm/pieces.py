"""Exact SentencePiece BPE by backtracking, and its decoding.

A merge-type (BPE) segmentation is the only one in which every two neighbouring
pieces, taken alone as a text, merge back into just those two pieces. So a text
is encoded from left to right: an Aho-Corasick automaton gives the longest piece
at every position; a piece is taken when it is compatible with the one before
(tested by re-merging their joined text from the steps in which each is merged, and
remembered); otherwise the next shorter prefix piece is tried, and when none is left the position is marked as
failed in a bitfield and the piece before is taken back. A failed position is
never entered again, so the work is linear in practice.

A text is first cut into units that no piece can span: before a space mark that
follows another character, and around line feeds, if the vocabulary allows it.
Each distinct unit is encoded once while a task remembers it, as packed 32-bit ids;
the ids of a document are these joined, and documents are decoded many at a time.

Rows: null is the empty text. Texts are encoded whole, of any length.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
MODEL = "piece_bpe_32k.model"
#: Characters of units, and pairs, a task remembers; emptied when full.
REMEMBERED_CHARS = 8_000_000
REMEMBERED_PAIRS = 500_000
#: Ids decoded at once.
DECODED_IDS = 500_000
_BEFORE_ALL = float("-inf")


class _Remembered(dict):
    """Packed ids by unit, made when first asked for."""

    def __init__(self, make: Callable[[str], bytes]):
        self.make, self.held = make, 0

    def __missing__(self, unit: str) -> bytes:
        ids = self[unit] = self.make(unit)
        self.held += len(unit)
        return ids

    def clear(self) -> None:
        super().clear()
        self.held = 0


class PieceModel:
    """Vocabulary of a SentencePiece BPE model, with encode and decode.

    The library only reads the model file; merging, byte fallback and decoding
    are done here. Supported: models without text normalisation, with a space
    put in front and byte fallback.
    """

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bos, self.eos, self.unk = sp.bos_id(), sp.eos_id(), sp.unk_id()
        self.ids: dict[str, int] = {}
        self.scores: dict[str, float] = {}
        self.byte_ids: dict[int, int] = {}
        self.surface: list[bytes] = []
        self.silent: set[int] = set()
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                value = int(piece[1:-1], 16)
                self.byte_ids[value] = i
                self.surface.append(bytes([value]))
            elif sp.is_control(i):
                self.silent.add(i)
                self.surface.append(b"")
            elif sp.is_unknown(i):
                self.surface.append(" ⁇ ".encode())
            else:
                self.ids[piece] = i
                self.scores[piece] = sp.get_score(i)
                self.surface.append(piece.replace(MARK, " ").encode())
        self.byte_set = set(self.byte_ids.values())
        self._surfaces = pa.array(self.surface, pa.large_binary())
        self._quiet = np.isin(np.arange(len(self.surface)), list(self.silent))
        self.automaton = ahocorasick.Automaton()
        for piece in self.ids:
            self.automaton.add_word(piece, len(piece))
        self.automaton.make_automaton()
        # The longest piece that is a proper prefix of a piece, 0 for none.
        self.shorter: dict[str, int] = {
            p: next((n for n in range(len(p) - 1, 0, -1) if p[:n] in self.ids), 0) for p in self.ids}
        self._pairs: dict[tuple[str | None, str], bool] = {}
        self._steps: dict[str, list[tuple[float, str, str]] | None] = {}
        self._units = _Remembered(lambda unit: (ids := self.encode_unit(unit)) and struct.pack(f"<{len(ids)}I", *ids) or b"")
        inner = [p for p in self.ids if MARK in p.lstrip(MARK)]
        feed = "" if any("\n" in p for p in self.ids) else "\n"
        self._cut = re.compile(
            f"{MARK}*[^{MARK}{feed}]+|{MARK}+" + (f"|{feed}" if feed else "") if not inner else "(?s:.+)")

    # --- merging ----------------------------------------------------------

    def merge(self, text: str, steps: list | None = None) -> list[str]:
        """Plain BPE: the best-scored neighbours merge first, the left ones of
        equal score. Used on the short texts of one piece. ``steps`` takes, before
        each merge and at the end, its score, the first part and the last one."""
        parts = list(text)
        while True:
            best, at = _BEFORE_ALL, -1
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1])
                if score is not None and (at < 0 or score > best):
                    best, at = score, i
            if steps is not None:
                steps.append((best, parts[0], parts[-1]))
            if at < 0:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def steps(self, piece: str) -> list[tuple[float, str, str]] | None:
        """The steps in which a piece is merged from its characters; None if they do
        not give the piece."""
        if piece not in self._steps:
            steps: list[tuple[float, str, str]] = []
            self._steps[piece] = steps if self.merge(piece, steps) == [piece] else None
        return self._steps[piece]

    def compatible(self, left: str | None, right: str) -> bool:
        """Whether the pieces come out again when their joined text is merged.

        Until something merges over the border, each side takes the steps it takes
        alone, the better-scored first and the left one of equal score; so these are
        gone through, looking for a merge over the border that would come first."""
        if len(self._pairs) >= REMEMBERED_PAIRS:
            self._pairs.clear()
        fits = self._pairs[left, right] = self._fits(self.steps(left) if left else None, self.steps(right), bool(left))
        return fits

    def _fits(self, ours: list | None, theirs: list | None, two: bool) -> bool:
        if theirs is None or two and ours is None:
            return False
        if not two:
            return True
        scores, i, j = self.scores, 0, 0
        while True:
            ahead, _, last = ours[i]
            behind, first, _ = theirs[j]
            over = scores.get(last + first)
            if over is not None and over > ahead and over >= behind:
                return False
            if ahead >= behind:
                i += 1
                if i == len(ours):
                    return True
            else:
                j += 1

    # --- encoding ---------------------------------------------------------

    def _segment(self, text: str, longest: list[int], begin: int, end: int) -> list[str]:
        """Pieces of ``text[begin:end]``, in which every position starts one."""
        failed = bytearray(((end - begin) >> 3) + 1)
        pairs, shorter, compatible = self._pairs, self.shorter, self.compatible
        taken: list[str] = []
        last, at = None, begin
        piece = text[at:at + longest[at]]
        while True:
            stop = at + len(piece) - begin
            if not failed[stop >> 3] & (1 << (stop & 7)):
                fits = pairs.get((last, piece))
                if compatible(last, piece) if fits is None else fits:
                    taken.append(piece)
                    at = begin + stop
                    if at == end:
                        return taken
                    last = piece
                    piece = text[at:at + longest[at]]
                    continue
            size = shorter[piece]
            if size:
                piece = piece[:size]
                continue
            if last is None:
                raise ValueError("no segmentation: the vocabulary lacks single characters")
            here = at - begin
            failed[here >> 3] |= 1 << (here & 7)
            piece = taken.pop()
            at -= len(piece)
            last = taken[-1] if taken else None

    def encode_unit(self, word: str) -> tuple[int, ...]:
        """Ids of one unit of a marked text."""
        longest = [0] * (len(word) + 1)  # the last one ends every segment
        for stop, n in self.automaton.iter(word):
            longest[stop - n + 1] = n  # matches come by their ends: the last is the longest
        out: list[int] = []
        at, n = 0, len(word)
        while at < n:
            if not longest[at]:  # a character in no piece: its bytes; nothing merges over it
                for b in word[at].encode():
                    out.append(self.byte_ids.get(b, self.unk))
                at += 1
                continue
            stop = longest.index(0, at)
            out.extend(map(self.ids.__getitem__, self._segment(word, longest, at, stop)))
            at = stop
        return tuple(out)

    def packed(self, text: str | None, bos: bool = True, eos: bool = True) -> bytes:
        """Ids of a whole text, 32 bits each; ``None`` is the empty text."""
        if self._units.held > REMEMBERED_CHARS:
            self._units.clear()
        ids = b"".join(map(self._units.__getitem__, self._cut.findall(MARK + text.replace(" ", MARK)))) if text else b""
        if bos:
            ids = struct.pack("<I", self.bos) + ids
        return ids + struct.pack("<I", self.eos) if eos else ids

    def encode(self, text: str | None, bos: bool = True, eos: bool = True) -> list[int]:
        """Ids of a whole text; ``None`` is the empty text."""
        return np.frombuffer(self.packed(text, bos, eos), "<u4").tolist()

    # --- decoding ---------------------------------------------------------

    def decode(self, ids) -> str:
        """Text of the ids: bytes joined, the space put in front taken off,
        invalid bytes each one U+FFFD."""
        ids = list(ids)
        begin = next((k for k, i in enumerate(ids) if i not in self.silent), len(ids))
        end = next((k for k in range(len(ids), begin, -1) if ids[k - 1] not in self.silent), begin)
        ids = ids[begin:end]
        # Bytes on both sides of a control id make no character together.
        runs, start = [], 0
        if not self.silent.isdisjoint(ids):
            for k, i in enumerate(ids):
                if i in self.silent:
                    runs.append(ids[start:k])
                    start = k + 1
        runs.append(ids[start:])
        text = "".join(self._joined(run) for run in runs)
        spaced = bool(ids) and ids[0] not in self.byte_set and ids[0] != self.unk
        return text[1:] if spaced and text[:1] == " " else text

    def decode_all(self, texts: list[bytes]) -> list[bytes]:
        """What ``decode`` makes of the packed ids of each text, in UTF-8. The bytes of
        all are joined in one pass; texts with control ids inside and invalid bytes go
        through ``decode``."""
        ids = np.frombuffer(b"".join(texts), "<u4")
        ends = np.cumsum([0, *[len(t) >> 2 for t in texts]])
        joined = self._surfaces.take(pa.array(ids))
        at = np.frombuffer(joined.buffers()[1], "<i8", len(ids) + 1)[ends].tolist()
        every = memoryview(joined.buffers()[2] or b"")
        quiet = self._quiet[ids]
        inside = quiet.copy()
        inside[ends[:-1][ends[:-1] < ends[1:]]] = False
        inside[ends[1:][ends[:-1] < ends[1:]] - 1] = False
        odd = np.append(0, np.cumsum(inside))[ends]
        out = []
        for k, (lo, hi) in enumerate(zip(ends.tolist(), ends[1:].tolist())):
            raw = bytes(every[at[k]:at[k + 1]])
            plain = odd[k] == odd[k + 1]
            if plain:
                try:
                    raw.decode()
                except UnicodeDecodeError:
                    plain = False
            if not plain:
                raw = self.decode(ids[lo:hi].tolist()).encode()
            elif raw[:1] == b" ":
                begin = lo + int(quiet[lo])
                if begin < hi and int(ids[begin]) not in self.byte_set and int(ids[begin]) != self.unk:
                    raw = raw[1:]
            out.append(raw)
        return out

    def _joined(self, ids: list[int]) -> str:
        joined = b"".join(map(self.surface.__getitem__, ids))
        try:
            return joined.decode()
        except UnicodeDecodeError:
            return joined.decode(errors="each_byte")


def _each_byte(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�", error.start + 1


def _register() -> None:
    import codecs

    codecs.register_error("each_byte", _each_byte)


_register()

_LOADED: dict[str, PieceModel] = {}


def load(path: str) -> PieceModel:
    """The model of a file, read once per Python worker."""
    if path not in _LOADED:
        _LOADED[path] = PieceModel(path)
    return _LOADED[path]


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path(MODEL)


def encode_documents(docs: DataFrame, model: str | None = None, with_ids: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row, and ``ids``
    (array of int) on request. One pass, no shuffle.

    ``model``: path of the model file on every executor; without one, the public
    file is looked up where the task runs.
    """
    rows = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema += ", ids array<int>" if with_ids else ""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = load(model or default_model())
        for batch in batches:
            counts, digests, decoded, lists = [], [], [], []
            held: list[bytes] = []
            n = 0

            def digest() -> None:
                decoded.extend(hashlib.sha256(raw).hexdigest() for raw in m.decode_all(held))
                held.clear()

            for text in batch.column("text"):
                ids = m.packed(text.as_py())
                counts.append(len(ids) >> 2)
                digests.append(hashlib.sha256(ids).hexdigest())
                held.append(ids)
                n += counts[-1]
                if n >= DECODED_IDS:
                    digest()
                    n = 0
                if with_ids:
                    lists.append(ids)
            digest()
            columns = [batch.column("doc_id"), pa.array(counts, pa.int64()),
                       pa.array(digests, pa.string()), pa.array(decoded, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                ends = pa.array(np.cumsum([0, *counts]), pa.int32())
                columns.append(pa.ListArray.from_arrays(ends, pa.array(np.frombuffer(b"".join(lists), "<i4"))))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    return rows.mapInArrow(task, schema)
