"""SentencePiece encoding and decoding by a shared-prefix search.

Texts fall into marked words: a run of marks (spaces) and what follows it, as no piece of the model reaches from a letter
into a mark. The distinct words of a step are sorted, which walks their trie depth first: a word keeps the forward scores
of the prefix it shares with the one before and computes the rest. Characters without a piece fall back to byte pieces.
White space stays as it is, so decoding gives the text back, byte for byte.

In a unigram model a word's best path has the greatest sum of piece scores; of equal paths the one with the longer last
piece, and so on to the front. In a BPE model the scores are the order of merges, and their sum says nothing: there the
search takes only cuts that the merges reach, of which each prefix of a word has one.
"""

from __future__ import annotations

import array
import os
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.texts import steps

MARK = "▁"
#: What an unknown character costs below the worst piece.
UNKNOWN_COST = 10.0
#: Words whose ids a worker keeps at hand; when there are more, the half that was used most stays.
CACHE_WORDS = 500_000
#: Pairs of symbols of which a task remembers whether the merges leave them apart.
CACHE_PAIRS = 200_000


class Vocabulary:
    """Pieces as bytes, with the mark written as a space."""

    def __init__(self, pieces: dict[bytes, tuple[int, float]], byte_ids: list[int], merges: bool = False):
        self.pieces, self.byte_ids, self.merges = pieces, byte_ids, merges
        self.unknown = min((s for _, s in pieces.values()), default=0.0) - UNKNOWN_COST
        if any(b" " in p.lstrip(b" ") for p in pieces):
            raise ValueError("a piece reaches from a letter into a mark")
        lengths: dict[bytes, set[int]] = defaultdict(set)
        for p in pieces:
            lengths[p[-2:]].add(len(p))
        #: Lengths of the pieces that end in two given bytes (or are the one byte), longest first.
        self.lengths = {end: sorted(x, reverse=True) for end, x in lengths.items()}
        #: No piece holds a line break, so words may end there too.
        self.breaks = not any(b"\n" in p for p in pieces)
        size = max([*(i for i, _ in pieces.values()), *byte_ids, 0]) + 1
        raw = [b""] * size
        for p, (i, _) in pieces.items():
            raw[i] = p
        for value, i in enumerate(byte_ids):
            raw[i] = bytes([value])
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        self.raw_at = np.cumsum([0, *map(len, raw)])

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        import sentencepiece
        from sentencepiece.sentencepiece_model_pb2 import ModelProto, TrainerSpec

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces, byte_ids = {}, [0] * 256
        for i in range(model.get_piece_size()):
            if model.is_byte(i):
                byte_ids[int(model.id_to_piece(i)[3:5], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                pieces.setdefault(model.id_to_piece(i).replace(MARK, " ").encode(), (i, model.get_score(i)))
        kind = ModelProto.FromString(model.serialized_model_proto()).trainer_spec.model_type
        return cls(pieces, byte_ids, kind == TrainerSpec.BPE)


class PrefixViterbi:
    """Best paths of words that come in sorted order."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.word = b""
        self.best, self.back = [0.0], [0]
        self.reused = self.computed = 0

    def _shared(self, word: bytes) -> int:
        n, old = min(len(word), len(self.word)), self.word
        if word[:n] == old[:n]:
            return n
        lo, hi = 0, n
        while hi - lo > 1:
            mid = (lo + hi) // 2
            lo, hi = (mid, hi) if word[:mid] == old[:mid] else (lo, mid)
        return lo

    def _forward(self, word: bytes) -> None:
        keep = self._shared(word)
        best, back = self.best, self.back
        del best[keep + 1 :], back[keep + 1 :]
        self.reused += keep
        self.computed += len(word) - keep
        pieces, lengths, none = self.v.pieces, self.v.lengths, float("-inf")
        for end in range(keep + 1, len(word) + 1):
            score, start = none, -1
            if end == 1:
                candidates = lengths.get(word[:1], ())
            else:
                candidates = lengths.get(word[end - 2 : end], ())
                if word[end - 1] < 0x80:
                    candidates = [*candidates, *lengths.get(word[end - 1 : end], ())]
            for n in candidates:
                if n <= end and best[end - n] > none and (found := pieces.get(word[end - n : end])) is not None and best[end - n] + found[1] > score:
                    score, start = best[end - n] + found[1], end - n
            if end == len(word) or word[end] & 0xC0 != 0x80:  # a character ends here
                first = end - 1
                while first and word[first] & 0xC0 == 0x80:
                    first -= 1
                if word[first:end] not in pieces and best[first] + self.v.unknown > score:
                    score, start = best[first] + self.v.unknown, first
            best.append(score)
            back.append(start)
        self.word = word

    def encode(self, word: bytes) -> list[int]:
        """Ids of one word."""
        self._forward(word)
        out: list[int] = []
        end = len(word)
        while end:
            start = self.back[end]
            found = self.v.pieces.get(word[start:end])
            out += [found[0]] if found else [self.v.byte_ids[b] for b in reversed(word[start:end])]
            end = start
        return out[::-1]


_CHARACTER = re.compile(rb"[^\x80-\xBF][\x80-\xBF]*|[\x80-\xBF]+")


class PrefixMerges(PrefixViterbi):
    """Cuts by a BPE model's merges, of words that come in sorted order.

    The merges cut a prefix into the cut of a shorter prefix and one last symbol. That symbol is the only one that the
    merges build by itself and leave apart from the last symbol of the shorter prefix. Whether they leave two symbols
    apart is asked once for each pair, by taking the two apart again, the later merge first: at every stage the two
    neighbours at the border must not make a piece that is merged before either of them goes on. Symbols whose parts are
    merged out of the order of scores are merged anew instead.
    """

    def __init__(self, vocabulary: Vocabulary):
        super().__init__(vocabulary)
        self.apart: dict[tuple[bytes, bytes], bool] = {}
        self.made: dict[bytes, tuple[float, bytes, bytes, bool] | None] = {}
        self.last = [b""]

    def merged(self, word: bytes, left: int = 1) -> list[bytes]:
        """The symbols left when, from single characters on, the neighbours of the best piece, leftmost first, are joined until none make a piece (or `left` are left)."""
        pieces = self.v.pieces
        symbols = _CHARACTER.findall(word)
        while len(symbols) > left:
            best, at = None, -1
            for k in range(len(symbols) - 1):
                found = pieces.get(symbols[k] + symbols[k + 1])
                if found is not None and (best is None or found[1] > best):
                    best, at = found[1], k
            if best is None:
                break
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        return symbols

    def _made(self, symbol: bytes) -> tuple[float, bytes, bytes, bool] | None:
        """When a symbol is merged (less is earlier), from which two, and whether all its parts come in the order of scores; None where the merges don't build it."""
        if symbol in self.made:
            return self.made[symbol]
        halves = self.merged(symbol, 2)
        if len(halves) == 1:
            out = float("-inf"), b"", b"", True
        elif len(halves) > 2 or symbol not in self.v.pieces:
            out = None
        else:
            a, b = (self._made(h) for h in halves)
            time = -self.v.pieces[symbol][1]
            out = (time, *halves, a[3] and b[3] and a[0] < time and b[0] < time)
        self.made[symbol] = out
        return out

    def _stays(self, before: bytes, symbol: bytes) -> bool:
        if len(self.apart) >= CACHE_PAIRS:
            self.apart.clear()
        out = self.apart[before, symbol] = self._left_apart(before, symbol)
        return out

    def _left_apart(self, before: bytes, symbol: bytes) -> bool:
        right = self._made(symbol)
        if right is None or not before:
            return right is not None
        left = self._made(before)
        if not (left and left[3] and right[3]):
            return self.merged(before + symbol) == [before, symbol]
        pieces, limit, tie = self.v.pieces, float("inf"), False
        while True:
            joined = pieces.get(before + symbol)
            if joined is not None and (-joined[1] < limit or tie and -joined[1] == limit):
                return False
            if left[0] > right[0]:  # the left symbol was merged later; of equal merges the left one comes first
                limit, tie, before = left[0], False, left[2]
                left = self._made(before)
            elif right[1]:
                limit, tie, symbol = right[0], True, right[1]
                right = self._made(symbol)
            else:
                return True

    def _forward(self, word: bytes) -> None:
        keep = self._shared(word)
        while keep and keep < len(word) and word[keep] & 0xC0 == 0x80:  # not inside a character
            keep -= 1
        last = self.last
        del last[keep + 1 :]
        self.reused += keep
        self.computed += len(word) - keep
        pieces, lengths, apart = self.v.pieces, self.v.lengths, self.apart
        for end in range(keep + 1, len(word) + 1):
            if end < len(word) and word[end] & 0xC0 == 0x80:
                last.append(b"")
                continue
            for n in lengths.get(word[end - 2 : end], ()):  # pieces of several bytes; none of them ends a word of one
                if n <= end and (symbol := word[end - n : end]) in pieces:
                    before = last[end - n]
                    if (known := apart.get((before, symbol))) or known is None and self._stays(before, symbol):
                        last.append(symbol)
                        break
            else:
                first = end - 1
                while first and word[first] & 0xC0 == 0x80:
                    first -= 1
                last.append(word[first:end])
        self.word = word

    def encode(self, word: bytes) -> list[int]:
        """Ids of one word."""
        self._forward(word)
        out: list[int] = []
        end = len(word)
        while end:
            symbol = self.last[end]
            found = self.v.pieces.get(symbol)
            out += [found[0]] if found else [self.v.byte_ids[b] for b in reversed(symbol)]
            end -= len(symbol)
        return out[::-1]


class Encoder:
    """Ids of whole texts."""

    def __init__(self, vocabulary: Vocabulary, search: type[PrefixViterbi] = PrefixViterbi):
        self.v, self.search = vocabulary, search(vocabulary)
        #: Of each word kept its number; the ids of word k are flat[ends[k] : ends[k + 1]].
        self.code: dict[bytes, int] = {}
        self.flat, self.ends = array.array("i"), array.array("q", [0])
        self.uses = np.zeros(0, np.int64)

    def _learn(self, words: list[bytes]) -> None:
        for w in sorted(words):
            self.flat.extend(self.search.encode(w))
            self.code[w] = len(self.ends) - 1
            self.ends.append(len(self.flat))

    def _forget(self) -> None:
        """Keep the half of the words that was used most."""
        kept = np.sort(np.argsort(-self.uses, kind="stable")[: len(self.uses) // 2])
        words, ends, flat = list(self.code), np.array(self.ends), np.array(self.flat)
        size = ends[kept + 1] - ends[kept]
        total = np.cumsum(size)
        self.flat = array.array("i", flat[np.arange(int(total[-1])) + np.repeat(ends[kept] - (total - size), size)].astype("i").tobytes())
        self.ends = array.array("q", np.concatenate([[0], total]).astype("q").tobytes())
        self.code = {words[k]: n for n, k in enumerate(kept.tolist())}
        self.uses = self.uses[kept] // 2

    @classmethod
    def load(cls, path: str) -> Encoder:
        """With the search that gives the model's own ids."""
        vocabulary = Vocabulary.load(path)
        return cls(vocabulary, PrefixMerges if vocabulary.merges else PrefixViterbi)

    def encode(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the rows, and how many each has. A text gets one mark in front; an empty one has no ids."""
        sizes = np.diff(at)
        full = sizes > 0
        if not full.any():
            return np.zeros(0, np.int32), np.zeros(len(sizes), np.int64)
        marked = np.ascontiguousarray(np.insert(data, at[:-1][full], 0x20))
        begins = at[:-1] + np.cumsum(full) - full
        space = marked == 0x20
        edge = np.zeros(len(marked), bool)
        edge[1:] = space[1:] & ~space[:-1]
        if self.v.breaks:
            line = marked == 0x0A
            edge |= line
            edge[1:] |= line[:-1]
        edge[begins[full]] = True
        starts = np.flatnonzero(edge)
        cut = pa.BinaryArray.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(np.append(starts, len(marked)).astype(np.int32)), pa.py_buffer(marked)]).dictionary_encode()
        words = cut.dictionary.to_pylist()
        if len(self.code) > CACHE_WORDS:
            self._forget()
        self._learn([w for w in words if w not in self.code])
        known = np.fromiter(map(self.code.__getitem__, words), np.int64, len(words))
        codes = known[cut.indices.to_numpy(zero_copy_only=False)]
        self.uses = np.concatenate([self.uses, np.zeros(len(self.code) - len(self.uses), np.int64)])
        self.uses += np.bincount(codes, minlength=len(self.uses))
        ends, flat = np.frombuffer(self.ends, np.int64), np.frombuffer(self.flat, np.int32)
        begin, many = ends[codes], ends[codes + 1] - ends[codes]
        total = np.cumsum(many)
        ids = flat[np.arange(int(total[-1])) + np.repeat(begin - (total - many), many)]
        del ends, flat  # arrays that are looked at cannot grow
        row = np.flatnonzero(full)[np.searchsorted(begins[full], starts, "right") - 1]
        return ids, np.bincount(row, weights=many, minlength=len(sizes)).astype(np.int64)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all rows and their n + 1 offsets; a mark in front of a row goes. Rows of cut lists may begin or end inside a character."""
        size = (self.v.raw_at[1:] - self.v.raw_at[:-1])[ids]
        ends = np.cumsum(size)
        data = self.v.raw[np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(self.v.raw_at[ids] - (ends - size), size)]
        at = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
        marked = np.diff(at) > 0
        marked[marked] = data[at[:-1][marked]] == 0x20
        data = np.delete(data, at[:-1][marked])
        return data, at - np.concatenate([[0], np.cumsum(marked)])


@lru_cache(maxsize=1)
def _loaded(path: str, changed: float) -> Encoder:
    return Encoder.load(path)


def worker_encoder(path: str) -> Encoder:
    """The encoder of this worker process, which keeps model and words from task to task."""
    return _loaded(path, os.path.getmtime(path))


def _encoder(model: str, names: list[str], digest: bool):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = worker_encoder(model)
        byte_ids = np.array(coder.v.byte_ids, np.int32)
        for rows, data, at in steps(batches, "text"):
            ids, counts = coder.encode(data, at)
            ends = np.concatenate([[0], np.cumsum(counts)])
            if digest:
                back, back_at = coder.decode(ids, counts)
                if np.array_equal(back_at, at) and np.array_equal(back, data):
                    same = np.ones(rows.num_rows, bool)
                else:
                    same = [back[a:b].tobytes() == data[c:d].tobytes() for a, b, c, d in zip(back_at, back_at[1:], at, at[1:])]
                raw, cuts = memoryview(ids.astype("<u4")).cast("B"), (4 * ends).tolist()
                crc = [zlib.crc32(raw[a:b]) for a, b in zip(cuts, cuts[1:])]
                fell = np.concatenate([[0], np.cumsum(np.isin(ids, byte_ids))])
                out = {"n_tokens": pa.array(counts), "n_byte_tokens": pa.array(fell[ends[1:]] - fell[ends[:-1]], pa.int64()), "ids_crc32": pa.array(crc, pa.int64()), "round_trip": pa.array(same)}
            else:
                out = {"ids": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32())), "n_tokens": pa.array(counts)}
            yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in names), *out.values()], [*names, *out])

    return encode


def _decoder(model: str, names: list[str]):
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = worker_encoder(model)
        for batch in batches:
            texts = []
            for ids in batch.column("ids"):
                raw = np.array(ids.as_py() or [], np.int64)
                texts.append(coder.decode(raw, np.array([len(raw)]))[0].tobytes().decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(texts, pa.string())], [*names, "text"])

    return decode


def _kept(df: DataFrame, *drop: str) -> tuple[DataFrame, list[str], str]:
    kept = df.drop(*drop)
    return kept, kept.columns, "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept.schema)


def encode(docs: DataFrame, model: str) -> DataFrame:
    """The documents with `ids` and `n_tokens` (columns of these names are replaced). Null or empty text: no ids."""
    kept, names, schema = _kept(docs, "ids", "n_tokens")
    return kept.mapInArrow(_encoder(model, names, False), schema + "ids array<int>, n_tokens bigint")


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """The rows with `text` from their `ids`; null or no ids: the empty text.

    The first mark goes, if there is one. Lists that begin or end inside a character give U+FFFD for what is left of it;
    ids outside the model raise IndexError.
    """
    kept, names, schema = _kept(encoded, "text")
    return kept.mapInArrow(_decoder(model, names), schema + "text string")


def report(docs: DataFrame, model: str) -> DataFrame:
    """A row per document: tokens, byte tokens and checksum of its ids, and whether decoding them gives the text again."""
    return docs.select("doc_id", "text").mapInArrow(
        _encoder(model, ["doc_id"], True), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens bigint, n_byte_tokens bigint, ids_crc32 bigint, round_trip boolean")
