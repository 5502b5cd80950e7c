"""SentencePiece encoding and decoding by a batched numpy Viterbi.

The pieces and scores come from a model file; the best segmentation of a text is the one
whose scores have the largest sum. Spaces become the model's mark and one is put in front.
No piece goes on after a mark that follows another character, so a text falls into words
that are solved apart. A batch's distinct words of equal length advance together: hashes of
all substrings that end at a position probe the sorted keys of the pieces, and the maximum
over them stores the backpointer. A character that no piece holds costs the lowest score
less ten and is spelled in byte pieces, as is a mark that the text itself contains, so that
decoding gives back every text exactly.

Equal sums go to the longest last piece. Words longer than ``_LONGEST`` characters are solved
one at a time by the same rules. Defined cases: a null or empty text has no pieces and decodes
to the empty text. Repeated rows are encoded each. Texts are encoded whole. Other input
columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from txnflow.llm.text import document_runs, mix, powers, text_buffers

MARK = "▁"
# Stands for a mark in the text itself; no text can hold a lone surrogate.
_OWN_MARK = "\udfff"
_LONGEST = 64
_BASE = np.uint64(0xA24BAED4963EE407)
_BASE_INVERSE = np.uint64(pow(0xA24BAED4963EE407, -1, 1 << 64))
_FILTER_BITS = 20
_UNKNOWN_PENALTY = 10.0


def _points(words: list[str]) -> np.ndarray:
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)


class PieceTable:
    """Pieces of a model, their hash keys in order, and what each id decodes to."""

    def __init__(self, pieces: list[str], scores: list[float], ids: list[int], bytes_at: list[int], n_ids: int) -> None:
        if any(MARK in p.lstrip(MARK) for p in pieces):
            raise ValueError("a piece continues after a mark, so words cannot be solved apart")
        self.known = {p: (s, i) for p, s, i in zip(pieces, scores, ids, strict=True)}
        self.lowest = min(scores) - _UNKNOWN_PENALTY
        self.longest = max(map(len, pieces))
        self.bytes_at = np.array(bytes_at, np.int32)
        keys = np.empty(len(pieces), np.uint64)
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        for size in np.unique(lengths):
            at = np.flatnonzero(lengths == size)
            sums = self._prefix(_points([pieces[i] for i in at]).reshape(len(at), size))
            keys[at] = self._key(sums[:, size], sums[:, 0], 0, int(size))
        order = np.argsort(keys)
        self.keys, self.scores = keys[order], np.array(scores, np.float64)[order]
        self.ids = np.array(ids, np.int32)[order]
        if (self.keys[1:] == self.keys[:-1]).any():
            raise ValueError("two pieces have the same hash key")
        self.maybe = np.zeros(1 << _FILTER_BITS, bool)
        self.maybe[self.keys >> np.uint64(64 - _FILTER_BITS)] = True
        self.newline_alone = not any("\n" in p for p in pieces)
        self.words = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n" if self.newline_alone else f"{MARK}*[^{MARK}]+|{MARK}+")
        self.shown: list[bytes] = [b""] * n_ids
        for p, i in zip(pieces, ids, strict=True):
            self.shown[i] = p.replace(MARK, " ").encode()
        for value, i in enumerate(bytes_at):
            self.shown[i] = bytes([value])

    @staticmethod
    def _prefix(points: np.ndarray) -> np.ndarray:
        n, size = points.shape
        sums = np.zeros((n, size + 1), np.uint64)
        letters = mix(points.astype(np.uint64) + np.uint64(0x51ED270B))
        np.cumsum(letters * powers(_BASE, size), axis=1, out=sums[:, 1:])
        return sums

    @staticmethod
    def _key(high: np.ndarray, low: np.ndarray, start: int, size: int) -> np.ndarray:
        return mix((high - low) * powers(_BASE_INVERSE, start + 1)[start] + np.uint64(size * 0x9E3779B1))

    def _probe(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions among ``keys`` that are pieces, and which piece each is."""
        here = np.flatnonzero(self.maybe[keys >> np.uint64(64 - _FILTER_BITS)])
        at = np.minimum(np.searchsorted(self.keys, keys[here]), len(self.keys) - 1)
        same = self.keys[at] == keys[here]
        return here[same], at[same]

    def _equal_length(self, points: np.ndarray) -> np.ndarray:
        """Tokens of words of one length, a row each: padded with -1 in front, unknown characters as -2 - code."""
        n, size = points.shape
        sums = self._prefix(points)
        best = np.full((n, size + 1), -np.inf)
        best[:, 0] = 0
        step = np.zeros((n, size + 1), np.int32)
        token = np.zeros((n, size + 1), np.int32)
        for end in range(1, size + 1):
            reach = min(self.longest, end)
            scores = np.full((reach, n), -np.inf)
            pieces = np.zeros((reach, n), np.int32)
            for size_back in range(1, reach + 1):
                start, row = end - size_back, reach - size_back
                here, at = self._probe(self._key(sums[:, end], sums[:, start], start, size_back))
                scores[row, here] = best[here, start] + self.scores[at]
                pieces[row, here] = self.ids[at]
            unknown = np.isneginf(scores[-1])
            scores[-1, unknown] = best[unknown, end - 1] + self.lowest
            pieces[-1, unknown] = -2 - points[unknown, end - 1].astype(np.int32)
            # Rows run from the longest piece to the shortest, so the first maximum is the longest.
            top = scores.argmax(axis=0)
            rows = np.arange(n)
            best[:, end] = scores[top, rows]
            step[:, end] = reach - top
            token[:, end] = pieces[top, rows]
        out = np.full((n, size), -1, np.int32)
        at, rows, column = np.full(n, size), np.arange(n), size
        while len(rows):
            column -= 1
            out[rows, column] = token[rows, at[rows]]
            at[rows] -= step[rows, at[rows]]
            rows = rows[at[rows] > 0]
        return out

    def _one(self, word: str) -> list[int]:
        best, back = [0.0], [(0, 0)]
        for end in range(1, len(word) + 1):
            top, kept = -np.inf, (0, 0)
            for start in range(max(0, end - self.longest), end):
                found = self.known.get(word[start:end])
                if found is None and start == end - 1:
                    found = (self.lowest, -2 - ord(word[start]))
                if found is not None and best[start] + found[0] > top:
                    top, kept = best[start] + found[0], (start, found[1])
            best.append(top)
            back.append(kept)
        tokens, end = [], len(word)
        while end:
            end, token = back[end]
            tokens.append(token)
        return tokens[::-1]

    def _spell(self, tokens: np.ndarray) -> np.ndarray:
        """Byte pieces in place of unknown characters."""
        out: list[int] = []
        for token in tokens.tolist():
            if token >= 0:
                out.append(token)
            else:
                character = chr(-2 - token)
                out.extend(self.bytes_at[list((MARK if character == _OWN_MARK else character).encode())].tolist())
        return np.array(out, np.int32)

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in a row, and where each word's ids begin."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        order, counts, flat = [], [], []
        for size in np.unique(lengths).tolist():
            at = np.flatnonzero(lengths == size)
            if size > _LONGEST:
                rows = [np.array(self._one(words[i]), np.int32) for i in at]
                n, tokens = np.array([len(r) for r in rows]), np.concatenate(rows)
            else:
                table = self._equal_length(_points([words[i] for i in at]).reshape(len(at), size))
                held = table != -1
                n, tokens = held.sum(axis=1), table[held]
            order.append(at)
            counts.append(n)
            flat.append(tokens)
        where, counts, flat = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (order, counts, flat))
        if (flat < 0).any():
            owner = np.repeat(np.arange(len(counts)), counts)
            rare = np.unique(owner[flat < 0])
            parts = np.split(flat, np.cumsum(counts)[:-1])
            for i in rare.tolist():
                parts[i] = self._spell(parts[i])
                counts[i] = len(parts[i])
            flat = np.concatenate(parts)
        begin = np.zeros(len(words), np.int64)
        begin[where] = np.cumsum(counts) - counts
        size = np.zeros(len(words), np.int64)
        size[where] = counts
        return flat.astype(np.int32), np.stack((begin, size))

    def split(self, text: str) -> list[str]:
        if not text:
            return []
        return self.words.findall(MARK + text.replace(MARK, _OWN_MARK).replace(" ", MARK))

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.shown.__getitem__, ids)).decode("utf-8", "replace")[1:]

    def encode_texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and each text's number of ids."""
        return WordBook(self).encode_texts(texts)


class WordBook:
    """Words solved so far, so that a task solves a word once while the book has room."""

    def __init__(self, table: PieceTable, room: int = 400_000) -> None:
        self.table, self.room = table, room
        self._clear()

    def _clear(self) -> None:
        self.number: dict[str, int] = {}
        self.flat, self.spans = np.zeros(0, np.int32), np.zeros((2, 0), np.int64)

    def encode_texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.number) > self.room:
            self._clear()
        number, known = self.number, len(self.number)
        held, used = [], [0]
        for text in texts:
            held.extend([number.setdefault(w, len(number)) for w in self.table.split(text)])
            used.append(len(held))
        flat, spans = self.table.encode_words(list(islice(number, known, None)))
        spans[0] += len(self.flat)
        self.flat, self.spans = np.concatenate((self.flat, flat)), np.concatenate((self.spans, spans), axis=1)
        begin, size = self.spans[:, np.array(held, np.int64)]
        stops = np.concatenate(([0], np.cumsum(size)))
        index = np.arange(stops[-1]) + np.repeat(begin - stops[:-1], size)
        return self.flat[index], np.diff(stops[used])


def load_pieces(model_file: str) -> PieceTable:
    """The normal and byte pieces of a model file with byte fallback; read on the driver, shipped to tasks."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    n = model.get_piece_size()
    normal = [
        i for i in range(n)
        if not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i))
    ]
    return PieceTable(
        [model.id_to_piece(i) for i in normal],
        [model.get_score(i) for i in normal],
        normal,
        [model.piece_to_id(f"<0x{value:02X}>") for value in range(256)],
        n,
    )


def encode_documents(docs: DataFrame, table: PieceTable) -> DataFrame:
    """doc_id, ids, n_tokens, n_byte_tokens and round_trip (decoding gave back the text) of every row."""
    is_byte = np.zeros(len(table.shown), bool)
    is_byte[table.bytes_at] = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = WordBook(table)
        for batch in batches:
            _, bounds = text_buffers(batch.column("text"))
            for first, last in document_runs(bounds, 4 << 20):
                part = batch.slice(first, last - first)
                texts = [t or "" for t in part.column("text").to_pylist()]
                ids, counts = book.encode_texts(texts)
                stops = np.concatenate(([0], np.cumsum(counts)))
                byte_sums = np.concatenate(([0], np.cumsum(is_byte[ids])))[stops]
                same = [
                    table.decode(ids[a:b].tolist()) == text
                    for text, a, b in zip(texts, stops[:-1], stops[1:], strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.ListArray.from_arrays(pa.array(stops, pa.int32()), pa.array(ids)),
                        pa.array(counts, pa.int64()),
                        pa.array(np.diff(byte_sums), pa.int64()),
                        pa.array(same),
                    ],
                    ["doc_id", "ids", "n_tokens", "n_byte_tokens", "round_trip"],
                )

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, ids array<int>, n_tokens long, n_byte_tokens long, round_trip boolean"
    )


def decode_documents(encoded: DataFrame, table: PieceTable) -> DataFrame:
    """doc_id and text of every row of ``encoded`` (doc_id, ids); null ids decode to the empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [table.decode(ids or []) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
