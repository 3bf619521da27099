"""Exact SentencePiece BPE ids and their decoding, by a prefix table instead of merging.

Every prefix of a text has exactly one encoding, so it has one last token.  The table of last tokens is filled
from left to right: an automaton lists the tokens that end at a position, and a token is the last one there if the
last token of the prefix before it may stand left of it, i.e. if merging the two tokens' characters alone gives just
these two back.  Going back through the table from the end of the text gives the ids.

No token holds two neighbouring characters that no piece holds, so texts are cut there first; the parts are
encoded once and kept in a bounded memory of each task.
"""

from __future__ import annotations

import re
import struct
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codesieve.llm.common import hand_back

#: Fixed values of the model format.
SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6

KEPT_PARTS = 100_000
KEPT_PAIRS = 1_000_000
STEP = 1 << 20
ROWS = 256


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """Field numbers and values of a serialised message; nested messages stay bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(kind) or varint()
            yield key >> 3, data[at:at + size]
            at += size


def read_model(path: str) -> list[tuple[str, float, int]]:
    """Pieces of a model file in the order of their ids: text, score, type."""
    with open(path, "rb") as file:
        data = file.read()
    pieces = []
    for number, value in _fields(data):
        if number == 1:
            text, score, kind = "", 0.0, NORMAL
            for inner, entry in _fields(value):
                if inner == 1:
                    text = entry.decode()
                elif inner == 2:
                    score = struct.unpack("<f", entry)[0]
                elif inner == 3:
                    kind = entry
            pieces.append((text, score, kind))
    return pieces


def _merged(text: str, scores: dict[str, float], border: int = -1) -> list[str] | None:
    """Plain merging, best score first and leftmost among equals; None once a merge crosses ``border``."""
    symbols = list(text)
    while len(symbols) > 1:
        best, at = None, 0
        for i, (left, right) in enumerate(pairwise(symbols)):
            score = scores.get(left + right)
            if score is not None and (best is None or score > best):
                best, at = score, i
        if best is None:
            break
        if border >= 0:
            start = sum(map(len, symbols[:at]))
            if start < border < start + len(symbols[at]) + len(symbols[at + 1]):
                return None
        symbols[at:at + 2] = [symbols[at] + symbols[at + 1]]
    return symbols


def usable(pieces: list[tuple[str, float, int]]) -> list[tuple[str, float, int, bool]]:
    """Pieces with a mark: whether merging the piece's own characters gives the piece (else no text contains it)."""
    scores = {text: score for text, score, kind in pieces if kind == NORMAL}
    return [(text, score, kind, kind == NORMAL and _merged(text, scores) == [text]) for text, score, kind in pieces]


class _Lockstep:
    """The prefix table of many short parts at once: automaton states and pair tests as array look-ups.

    Covers parts of the ``LETTERS`` characters that most pieces hold.  Pair tests are kept in a direct-mapped
    table; a pair that is not there is tested and put there.
    """

    LETTERS, LONGEST, SLOTS = 127, 32, 1 << 20

    def __init__(self, table: PieceTable, tokens: list[tuple[str, int]]):
        self.table = table
        held = Counter(c for text, _ in tokens for c in text)
        letters = [c for c, _ in held.most_common() if c in table.ids][:self.LETTERS]
        self.code = {ord(c): i + 1 for i, c in enumerate(letters)}
        self.table_of_codes = np.zeros(1 << 16, dtype=np.uint8)
        for point, i in self.code.items():
            if point < 1 << 16:
                self.table_of_codes[point] = i
        children: list[dict[int, int]] = [{}]
        ends = {}
        for text, token in tokens:
            codes = [int(self.table_of_codes[ord(c)]) if ord(c) < 1 << 16 else 0 for c in text]
            if 0 in codes:
                continue
            state = 0
            for code in codes:
                if code not in children[state]:
                    children[state][code] = len(children)
                    children.append({})
                state = children[state][code]
            ends[state] = (token, len(text))
        self._link(children, ends)
        self.keys = np.full(self.SLOTS, -1, dtype=np.int64)
        self.fits = np.zeros(self.SLOTS, dtype=bool)

    def _link(self, children, ends) -> None:
        """Automaton: next state by letter; per state the tokens that end there, longest first."""
        self.next = np.zeros((len(children), self.LETTERS + 1), dtype=np.int32)
        found = [()] * len(children)
        level = [(child, 0) for child in children[0].values()]
        for code, child in children[0].items():
            self.next[0, code] = child
        while level:
            below = []
            for state, fall in level:
                found[state] = ((ends[state],) if state in ends else ()) + found[fall]
                self.next[state] = self.next[fall]
                for code, child in children[state].items():
                    below.append((child, int(self.next[fall, code])))
                    self.next[state, code] = child
            level = below
        width = max(map(len, found))
        self.tokens = np.full((len(found), width + 1), -1, dtype=np.int32)
        self.sizes = np.zeros((len(found), width + 1), dtype=np.int8)
        for state, several in enumerate(found):
            for j, (token, size) in enumerate(several):
                self.tokens[state, j], self.sizes[state, j] = token, size

    def _compatible(self, keys: np.ndarray) -> np.ndarray:
        slots = (keys * np.int64(-7046029254386353131) >> 20) & (self.SLOTS - 1)
        fits = self.fits[slots]
        unknown = np.flatnonzero(self.keys[slots] != keys)
        if len(unknown):
            new, where = np.unique(keys[unknown], return_inverse=True)
            tested = np.array([self.table.compatible(int(k) >> 32, int(k) & 0xFFFFFFFF) for k in new], dtype=bool)
            fits[unknown] = tested[where]
            self.keys[slots[unknown]], self.fits[slots[unknown]] = keys[unknown], fits[unknown]
        return fits

    def encode(self, parts: list[str]) -> dict[str, bytes]:
        """Ids of those parts that it covers."""
        parts = sorted((p for p in parts if len(p) <= self.LONGEST), key=len, reverse=True)
        if not parts:
            return {}
        lengths = np.array([len(p) for p in parts])
        points = np.frombuffer("".join(parts).encode("utf-32-le"), dtype=np.uint32)
        flat = np.where(points < 1 << 16, self.table_of_codes[np.minimum(points, 0xFFFF)], 0)
        whole = np.minimum.reduceat(flat, np.cumsum(lengths) - lengths) > 0
        width = int(lengths[0])
        codes = np.zeros((len(parts), width), dtype=np.uint8)
        codes[np.arange(width) < lengths[:, None]] = flat
        rows = np.flatnonzero(whole)
        if not len(rows):
            return {}
        codes, lengths, parts = codes[rows], lengths[rows], [parts[i] for i in rows]
        last = np.full((len(parts), width + 1), -1, dtype=np.int64)
        taken = np.zeros((len(parts), width + 1), dtype=np.int8)
        state = np.zeros(len(parts), dtype=np.int32)
        for end in range(1, width + 1):
            alive = int(np.searchsorted(-lengths, -end, side="right"))
            state = self.next[state[:alive], codes[:alive, end - 1]]
            open_ = np.arange(alive)
            for j in range(self.tokens.shape[1]):
                token, size = self.tokens[state[open_], j].astype(np.int64), self.sizes[state[open_], j]
                if (some := token >= 0).sum() < len(open_):
                    open_, token, size = open_[some], token[some], size[some]
                if not len(open_):
                    break
                before = last[open_, end - size]
                fits = size == end
                test = np.flatnonzero(before >= 0)
                fits[test] = self._compatible(before[test] << 32 | token[test])
                done = open_[fits]
                last[done, end], taken[done, end] = token[fits], size[fits]
                open_ = open_[~fits]
        return self._back(parts, lengths, last, taken)

    @staticmethod
    def _back(parts, lengths, last, taken) -> dict[str, bytes]:
        """Recover the ids from the end of every part."""
        at, steps = lengths.copy(), []
        every = np.arange(len(parts))
        while at.any():
            if (last[every, at][at > 0] < 0).any():
                raise ValueError("a part has no encoding")
            steps.append(np.where(at > 0, last[every, at], -1))
            at = at - taken[every, at]
        ids = np.stack(steps[::-1], axis=1).astype(np.int32)
        kept = ids >= 0
        flat, ends = ids[kept].tobytes(), np.cumsum(kept.sum(axis=1)) * 4
        return {part: flat[start:end] for part, start, end in zip(parts, [0, *ends[:-1].tolist()], ends.tolist(),
                                                                   strict=True)}


class PieceTable:
    """Encoder and decoder of one vocabulary (as ``usable`` gives it)."""

    def __init__(self, pieces: list[tuple[str, float, int, bool]]):
        import ahocorasick

        self.ids = {text: i for i, (text, _, kind, _) in enumerate(pieces) if kind == NORMAL}
        self.scores = {text: score for text, score, kind, _ in pieces if kind == NORMAL}
        self.texts = [text for text, *_ in pieces]
        self.unknown = next(i for i, piece in enumerate(pieces) if piece[2] == UNKNOWN)
        self.byte_ids = {int(text[3:5], 16): i for i, (text, _, kind, _) in enumerate(pieces) if kind == BYTE}
        self.together = {pair for text in self.ids for pair in pairwise(text)}
        if any(right == SPACE != left for left, right in self.together):
            raise ValueError("a piece goes on after a space; texts can't be cut at spaces")
        held = {c for text in self.ids if len(text) > 1 for c in text}
        # Control characters that no longer piece holds are cut off with the same pass that cuts at spaces.
        alone = "".join(re.escape(c) for c in "\t\n\r" if c not in held)
        self.cut = re.compile(f"{SPACE}+[^{SPACE}{alone}]*|[^{SPACE}{alone}]+|[{alone}]" if alone
                              else f"{SPACE}+[^{SPACE}]*")
        tokens = [(text, i) for i, (text, _, kind, whole) in enumerate(pieces)
                  if kind == NORMAL and (whole or len(text) == 1)]
        self.automaton = ahocorasick.Automaton()
        for text, i in tokens:
            self.automaton.add_word(text, (i, len(text)))
        self.automaton.make_automaton()
        self.parts: dict[str, bytes] = {}
        self.pairs: dict[int, bool] = {}
        self.lockstep = _Lockstep(self, tokens)
        shown = [self._shown(text, kind) for text, _, kind, _ in pieces]
        self.blob = np.frombuffer(b"".join(shown), dtype=np.uint8)
        self.sizes = np.array([len(x) for x in shown], dtype=np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    @staticmethod
    def _shown(text: str, kind: int) -> bytes:
        if kind == BYTE:
            return bytes([int(text[3:5], 16)])
        if kind == CONTROL:
            return b""
        return (" ⁇ " if kind == UNKNOWN else text.replace(SPACE, " ")).encode()

    def compatible(self, left: int, right: int) -> bool:
        """Whether ``right`` may follow ``left``: their characters alone merge to just these two tokens."""
        key = left << 32 | right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= KEPT_PAIRS:
                self.pairs.clear()
            a, b = self.texts[left], self.texts[right]
            known = self.pairs[key] = ((a[-1], b[0]) not in self.together
                                       or _merged(a + b, self.scores, len(a)) == [a, b])
        return known

    def _encode_part(self, part: str) -> list[int]:
        """Ids of a part whose neighbouring characters all occur together in pieces."""
        if part not in self.ids and len(part) == 1:
            return [self.byte_ids.get(b, self.unknown) for b in part.encode()] if self.byte_ids else [self.unknown]
        last, sizes = [-1] * (len(part) + 1), [0] * (len(part) + 1)
        pairs = self.pairs
        for end, (token, size) in self.automaton.iter(part):
            end += 1
            if last[end] < 0:
                start = end - size
                if start:
                    before = last[start]
                    if before < 0:
                        continue
                    fits = pairs.get(before << 32 | token)
                    if not (self.compatible(before, token) if fits is None else fits):
                        continue
                last[end], sizes[end] = token, size
        ids, at = [], len(part)
        while at:
            if last[at] < 0:
                raise ValueError(f"no encoding of {part[:at]!r}")
            ids.append(last[at])
            at -= sizes[at]
        return ids[::-1]

    def _encode_cut(self, part: str) -> bytes:
        """Ids (as int32 bytes) of a part, which is cut again wherever two neighbours never share a piece."""
        together = self.together
        borders = [i + 1 for i, pair in enumerate(pairwise(part)) if pair not in together]
        ids = array("i")
        for start, end in pairwise([0, *borders, len(part)]):
            ids.extend(self._encode_part(part[start:end]))
        return ids.tobytes()

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text, as the library gives them without begin and end ids."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of several texts; parts that are not known yet are encoded together."""
        cut = [self.cut.findall(SPACE + text.replace(" ", SPACE)) if text else [] for text in texts]
        missing = set().union(*cut).difference(self.parts)
        found = self.lockstep.encode(list(missing))
        for part in missing:
            if part not in found:
                found[part] = self._encode_cut(part)
        parts = self.parts
        out = []
        for text in cut:
            joined = b"".join([parts.get(p) or found[p] for p in text])
            out.append(np.frombuffer(joined, dtype=np.int32))
        if len(parts) + len(found) > KEPT_PARTS:
            parts.clear()
        parts.update((p, ids) for p, ids in found.items() if len(p) <= _Lockstep.LONGEST)
        return out

    def decode(self, ids: Iterable[int]) -> str:
        """Text of ids: pieces side by side, byte pieces as UTF-8, without the space put before the text."""
        ids = np.asarray(ids, dtype=np.int64)
        out = []
        for at in range(0, len(ids), STEP):
            some = ids[at:at + STEP]
            sizes = self.sizes[some]
            ends = np.cumsum(sizes)
            total = int(ends[-1])
            source = np.repeat(self.starts[some] - (ends - sizes), sizes) + np.arange(total)
            out.append(self.blob[source].tobytes())
        data = b"".join(out)
        first = next((i for i in ids if self.sizes[i]), None)  # control pieces show nothing
        if first is not None and self.texts[first].startswith(SPACE):
            data = data[1:]
        try:
            return data.decode()
        except UnicodeDecodeError:
            return _decode_loose(data)


def _decode_loose(data: bytes) -> str:
    """UTF-8 where every byte that starts no whole character becomes a replacement character."""
    out, at = [], 0
    while at < len(data):
        for size in (1, 2, 3, 4):
            try:
                out.append(data[at:at + size].decode())
                at += size
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


_TABLES: dict[int, PieceTable] = {}


def _table(pieces: list[tuple[str, float, int, bool]]) -> PieceTable:
    """Table of a vocabulary, made once for a worker process."""
    key = hash(tuple(pieces))
    if key not in _TABLES:
        _TABLES.clear()
        _TABLES[key] = PieceTable(pieces)
    return _TABLES[key]


def _offsets(sizes: list[int]) -> pa.Array:
    return pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))


def encode_and_decode(df: DataFrame, model_path: str, id_column: str = "doc_id",
                      text_column: str = "text") -> DataFrame:
    """One row per row of ``df``: the id, ids (array of int), decoded (text that the ids give back).

    ``model_path`` is read on the driver; the vocabulary (some hundred kB) goes to the tasks with their code.
    Null texts count as empty and give an empty array.  Whole texts are encoded, however long.  Ids may be null or
    repeated; other columns are not read; an empty table gives an empty result.
    """
    pieces = usable(read_model(model_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(pieces)
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                ids = table.encode_all([text.as_py() or "" for text in part.column(1)])
                decoded = [table.decode(some) for some in ids]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.ListArray.from_arrays(_offsets([len(x) for x in ids]),
                                                              pa.array(np.concatenate(ids))),
                     pa.array(decoded, type=pa.string())], names=["id", "ids", "decoded"])
        table.parts.clear()
        table.pairs.clear()
        hand_back()

    rows = df.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, ids array<int>, decoded string").withColumnRenamed("id", id_column)


def digests(encoded: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Number of ids, and SHA-256 of the ids in decimal and of the decoded text."""
    return encoded.select(
        F.col(id_column), F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
