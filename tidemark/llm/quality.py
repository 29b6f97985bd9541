"""Quality classifier from weak labels.

Heuristic labellers look at surface signs of a text and vote good, bad or nothing. Expectation-maximisation over the counts
of all vote patterns estimates each labeller's votes under either class, and with them a posterior for every pattern.
The posteriors are the soft labels of a linear scorer over hashed token shapes, which judges every document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.texts import LOWER, row_counts, runs_of, span_hashes, steps, words

NOTHING, BAD, GOOD = 0, 1, 2
LABELLERS = ("capitals", "signs", "shouting", "repeats", "copied_runs", "short_words", "word_length", "sentences", "separators")

#: Slots of the hashed scorer.
SLOTS = 1 << 12
#: The scorer learns from about so many documents, chosen by a hash of the text, in so many parts whose weights are averaged.
TRAIN_TEXTS, TRAIN_PARTS = 16_000, 8
#: Documents that score below are rejected.
LEAST_SCORE = 0.8

_SOLID = np.ones(256, bool)
_SOLID[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True
_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = _LETTER[0x80:] = True
_NAMED = _LETTER.copy()
_NAMED[0x30:0x3A] = True
_SIGN = ~(_LETTER | ~_SOLID)
_SIGN[0x30:0x3A] = False
_SIGN[[*b".,;:!?'\"()-"]] = False
_STOP = np.zeros(256, bool)
_STOP[[*b".?!"]] = True
# Shapes: capitals, other letters (all bytes outside ASCII too) and digits stand for their kind, signs for themselves.
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[_LETTER] = ord("a")
_SHAPE[_UPPER] = ord("A")
_SHAPE[0x30:0x3A] = ord("9")


def _tokens(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    starts, ends, rows = words(data, at, _SOLID)
    return span_hashes(LOWER[data], starts, ends), starts, ends, rows


def _sums(mask: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(mask)])
    return total[at[1:]] - total[at[:-1]]


def _vote(share: np.ndarray, good: tuple[float, float], bad: tuple[float, float], enough: np.ndarray) -> np.ndarray:
    """Good and bad where the share lies in [lo, hi)."""
    out = np.zeros(len(share), np.int8)
    out[(share >= good[0]) & (share < good[1])] = GOOD
    out[(share >= bad[0]) & (share < bad[1])] = BAD
    out[~enough] = NOTHING
    return out


def votes(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A row of votes per text, in the order of LABELLERS. Texts too short for a sign get no vote from it."""
    n = len(at) - 1
    hashes, starts, ends, rows = _tokens(data, at)
    count = row_counts(rows, n)
    size = np.maximum(np.diff(at), 1)
    letters = _sums(_LETTER[data], at)
    per_word = lambda x: x / np.maximum(count, 1)
    big = float("inf")

    again = np.zeros(len(hashes), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (rows[1:] == rows[:-1])
    runs = runs_of(hashes, 4)
    own = np.flatnonzero(rows[: len(runs)] == rows[3:]) if len(runs) else np.zeros(0, np.int64)
    keyed = runs[own] + rows[own].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    _, first = np.unique(keyed, return_index=True)
    many, distinct = row_counts(rows[own], n), row_counts(rows[own][first], n)
    short = row_counts(rows[ends - starts <= 3], n)
    named = np.concatenate([[0], np.cumsum(_NAMED[data])])
    bare = row_counts(rows[named[ends] == named[starts]], n)
    doubled = np.zeros(len(data), bool)
    doubled[1:] = (data[1:] == 0x21) & (data[:-1] == 0x21)
    return np.stack([
        _vote(_sums(_UPPER[data], at) / np.maximum(letters, 1), (0, 0.2), (0.4, big), letters >= 20),
        _vote(_sums(_SIGN[data], at) / size, (0, 0.02), (0.06, big), size >= 20),
        _vote(per_word(_sums(doubled, at)), (0, 0.02), (0.2, big), count >= 5),
        _vote(per_word(row_counts(rows[again], n)), (0, 0.08), (0.25, big), count >= 8),
        _vote(1 - distinct / np.maximum(many, 1), (0, 0.1), (0.4, big), many >= 10),
        _vote(per_word(short), (0.15, 0.6), (0, 0.04), count >= 20),
        _vote(per_word(_sums(_SOLID[data], at)), (3, 9), (13, big), count >= 8),
        _vote(per_word(_sums(_STOP[data], at)), (0.02, 0.35), (0, 0.004), count >= 30),
        _vote(per_word(bare), (0, 0.05), (0.15, big), count >= 8),
    ], axis=1)


@dataclass
class LabelModel:
    """Share of good documents, and each labeller's chances of a bad and a good vote, when it votes, under bad and good texts."""

    prior: float
    chances: np.ndarray  # class, labeller, vote

    @classmethod
    def fit(cls, patterns: np.ndarray, counts: np.ndarray, rounds: int = 100, tolerance: float = 1e-9) -> LabelModel:
        """Expectation-maximisation over vote patterns and how many documents show each.

        It starts with every document that any labeller objects to as bad. A labeller that does not vote says nothing.
        """
        good = np.where((patterns == BAD).any(1), 0.1, 0.95)
        total = counts.sum()
        model = cls(0.5, np.full((2, patterns.shape[1], 3), 0.5))
        last = -np.inf
        for _ in range(rounds):
            for c, w in enumerate((counts * (1 - good), counts * good)):
                for v in (BAD, GOOD):
                    model.chances[c, :, v] = ((patterns == v) * w[:, None]).sum(0) + 0.5
                model.chances[c, :, NOTHING] = 0
                model.chances[c] /= model.chances[c].sum(1, keepdims=True)
                model.chances[c, :, NOTHING] = 1
            model.prior = float(((counts * good).sum() + 0.5) / (total + 1))
            good, likelihood = model._posterior(patterns)
            now = float((counts * likelihood).sum())
            if now - last < tolerance * max(1.0, abs(now)):
                break
            last = now
        return model

    def _posterior(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        each = np.arange(patterns.shape[1])
        bad, good = (np.log(self.chances[c][each, patterns]).sum(1) + np.log(p) for c, p in enumerate((1 - self.prior, self.prior)))
        both = np.logaddexp(bad, good)
        return np.exp(good - both), both

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """Chance of being good."""
        return self._posterior(patterns)[0]

    def accuracies(self) -> np.ndarray:
        """Chance that a labeller is right when it votes."""
        share = np.array([1 - self.prior, self.prior])
        right = share[0] * self.chances[0, :, BAD] + share[1] * self.chances[1, :, GOOD]
        return right / (right + share[0] * self.chances[0, :, GOOD] + share[1] * self.chances[1, :, BAD])


def slots(data: np.ndarray, at: np.ndarray, size: int = SLOTS) -> tuple[np.ndarray, np.ndarray]:
    """The hashed feature of each token, and its row: the token's shape, and whether it repeats one of the two before."""
    hashes, starts, ends, rows = _tokens(data, at)
    if not len(hashes):
        return np.zeros(0, np.int64), rows
    again = np.zeros(len(hashes), np.uint64)
    again[1:] += ((hashes[1:] == hashes[:-1]) & (rows[1:] == rows[:-1])).astype(np.uint64)
    again[2:] += np.uint64(2) * ((hashes[2:] == hashes[:-2]) & (rows[2:] == rows[:-2])).astype(np.uint64)
    shape = _SHAPE[data]
    fresh = np.ones(len(data), bool)
    fresh[1:] = shape[1:] != shape[:-1]
    fresh[starts] = True
    place = np.concatenate([[0], np.cumsum(fresh)])
    short = shape[fresh]
    keys = span_hashes(short, place[starts], place[ends])
    return ((keys + again * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(size)).astype(np.int64), rows


@dataclass
class Scorer:
    """Chance of being good from the mean weight of a text's token features."""

    weights: np.ndarray
    bias: float

    @classmethod
    def fit(cls, features: list[np.ndarray], labels: np.ndarray, rounds: int = 150, rate: float = 1.0, decay: float = 1e-5) -> Scorer:
        """Logistic regression on soft labels; both classes weigh the same."""
        size = np.array([len(f) for f in features], np.int64)
        rows, cols = np.repeat(np.arange(len(features)), size), np.concatenate([*features, np.zeros(0, np.int64)]).astype(np.int64)
        pairs, counts = np.unique(rows * SLOTS + cols, return_counts=True)
        rows, cols = pairs // SLOTS, pairs % SLOTS
        value = counts / size[rows]
        both = np.array([(1 - labels).sum(), labels.sum()]) + 1e-9
        weigh = (labels / both[1] + (1 - labels) / both[0]) / 2
        w, b = np.zeros(SLOTS), 0.0
        speed_w, speed_b = np.zeros(SLOTS), 0.0
        for _ in range(rounds):
            score = np.bincount(rows, value * w[cols], len(features)) + b
            slope = weigh * (1 / (1 + np.exp(-np.clip(score, -50, 50))) - labels)
            grad = np.bincount(cols, value * slope[rows], SLOTS) + decay * w
            speed_w, speed_b = 0.9 * speed_w - 20 * rate * grad, 0.9 * speed_b - rate * slope.sum()
            w, b = w + speed_w, b + speed_b
        return cls(w, b)

    def score(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Texts without a token score 0."""
        where, rows = slots(data, at, len(self.weights))
        n = len(at) - 1
        count = row_counts(rows, n)
        total = np.bincount(rows, self.weights[where], n) / np.maximum(count, 1) + self.bias
        return np.where(count > 0, 1 / (1 + np.exp(-np.clip(total, -50, 50))), 0.0)


def _pattern(table: np.ndarray) -> np.ndarray:
    return (table.astype(np.int64) * 3 ** np.arange(table.shape[1])).sum(1)


def _unpacked(codes: np.ndarray) -> np.ndarray:
    return codes[:, None] // 3 ** np.arange(len(LABELLERS)) % 3


def _count_patterns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen = np.zeros(3 ** len(LABELLERS), np.int64)
    for _, data, at in steps(batches, "text"):
        seen += np.bincount(_pattern(votes(data, at)), minlength=len(seen))
    on = np.flatnonzero(seen)
    yield pa.RecordBatch.from_arrays([pa.array(on), pa.array(seen[on])], ["pattern", "n"])


def fit_labels(docs: DataFrame) -> LabelModel:
    """The label model of all documents; the driver receives the counts of at most 3 ** 9 vote patterns."""
    found = docs.select("text").mapInArrow(_count_patterns, "pattern bigint, n bigint").groupBy("pattern").agg(F.sum("n").alias("n")).orderBy("pattern").collect()
    return LabelModel.fit(_unpacked(np.array([r.pattern for r in found], np.int64)), np.array([r.n for r in found], np.float64)) if found else LabelModel(0.5, np.full((2, len(LABELLERS), 3), 0.5))


def _features(model: LabelModel):
    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, at in steps(batches, "text"):
            label = model.posterior(votes(data, at).astype(np.int64))
            where, row = slots(data, at)
            ends = np.concatenate([[0], np.cumsum(row_counts(row, rows.num_rows))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [rows.column("part"), rows.column("h"), pa.array(label), pa.ListArray.from_arrays(pa.array(ends), pa.array(where.astype(np.int16)))], ["part", "h", "label", "slots"])

    return extract


def _fit_part(table: pa.Table) -> pa.Table:
    table = table.sort_by("h")
    column = table.column("slots").combine_chunks()
    at, flat = column.offsets.to_numpy(), column.flatten().to_numpy()
    kept = [k for k in range(len(column)) if at[k + 1] > at[k]]
    labels = table.column("label").to_numpy()[kept]
    kind = pa.schema([("weights", pa.list_(pa.float64())), ("bias", pa.float64())])
    if not ((labels >= 0.5).any() and (labels < 0.5).any()):
        return kind.empty_table()
    model = Scorer.fit([flat[at[k] - at[0] : at[k + 1] - at[0]] for k in kept], labels)
    return pa.table([pa.array([model.weights], pa.list_(pa.float64())), pa.array([model.bias])], schema=kind)


def fit_scorer(docs: DataFrame, labels: LabelModel, train_texts: int = TRAIN_TEXTS, parts: int = TRAIN_PARTS) -> Scorer | None:
    """A scorer trained on the posterior labels of a bounded sample of the different texts.

    Equal texts count once, in the rate of the sample too: where there are no more than `train_texts` different ones, all
    are taken. Each part of the sample is fitted in a task of its own, and the weights are averaged. A part whose texts
    are all good or all bad teaches nothing; without any other part there is no scorer.
    """
    texts = docs.where("text is not null").select("text")
    n = texts.agg(F.approx_count_distinct(F.xxhash64("text"), 0.02)).first()[0]
    rate = min(1.0, train_texts / n) if n > train_texts / 2 else 1.0
    place = F.pmod(F.xxhash64("text"), F.lit(1 << 30))
    sample = texts.withColumn("h", F.xxhash64("text", F.lit(1))).where(place < F.lit(int((1 << 30) * rate)))
    sample = sample.dropDuplicates(["h"]).withColumn("part", F.pmod("h", F.lit(parts)).cast("int"))
    found = sample.select("part", "h", "text").mapInArrow(_features(labels), "part int, h bigint, label double, slots array<smallint>")
    fitted = found.groupBy("part").applyInArrow(_fit_part, "weights array<double>, bias double").collect()
    if not fitted:
        return None
    return Scorer(np.mean([r.weights for r in fitted], axis=0), float(np.mean([r.bias for r in fitted])))


def classify(docs: DataFrame, least: float = LEAST_SCORE) -> DataFrame:
    """The documents with `quality` (chance of being good) and `keep` (it reaches `least`).

    Null, empty and blank texts score 0 and are not kept. Equal texts score the same. Where the different texts are too
    few or too alike to train on (all of them good or all bad in every part), the score is the label model's posterior.
    Columns of these names are replaced.
    """
    labels = fit_labels(docs)
    scorer = fit_scorer(docs, labels)
    kept = docs.drop("quality", "keep")
    names = kept.columns

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, at in steps(batches, "text"):
            if scorer is not None:
                value = scorer.score(data, at)
            else:
                value = np.where(_sums(_SOLID[data], at) > 0, labels.posterior(votes(data, at).astype(np.int64)), 0.0)
            yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in names), pa.array(value), pa.array(value >= least)], [*names, "quality", "keep"])

    return kept.mapInArrow(score, "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept.schema) + "quality double, keep boolean")


def good(docs: DataFrame, least: float = LEAST_SCORE) -> DataFrame:
    """The documents that are kept, with their columns."""
    return classify(docs, least).where("keep").select(*docs.columns)


def report(docs: DataFrame) -> DataFrame:
    """doc_id, quality and keep of every document."""
    return classify(docs.select("doc_id", "text")).select("doc_id", "quality", "keep")
