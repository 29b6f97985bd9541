"""Language identification by compression.

Each language has a zstandard raw-content dictionary cut from a bounded sample of its texts. A text is compressed block by
block with every dictionary; the language whose dictionary leaves the fewest bytes is chosen, and rejected when the
runner-up is too close.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNDECIDED = "und"
#: Bytes of one language's dictionary, and of all dictionaries together.
DICTIONARY_BYTES, ALL_BYTES = 64 << 10, 4 << 20
#: Texts that one dictionary is cut from, about.
SAMPLE_TEXTS = 256
#: Texts are compressed in blocks of so many bytes, so that the dictionary counts in all of a long text.
BLOCK_BYTES = 4096
#: Least share by which the runner-up must be larger.
LEAST_MARGIN = 0.005
LEVEL = 3


def fit(docs: DataFrame, dictionary_bytes: int = DICTIONARY_BYTES, sample_texts: int = SAMPLE_TEXTS) -> dict[str, bytes]:
    """A dictionary per language, from `text` and `lang` alone.

    The sample is bounded: about `sample_texts` different texts of each language, but at least one, chosen by a hash of the
    text, each giving at most four times its share of the dictionary, from its middle. Copies count once. Rows whose text is null or empty, or whose lang is null, teach nothing.
    """
    known = docs.where("lang is not null and length(text) > 0").select("lang", "text")
    h = F.xxhash64("text")
    place = F.pmod(F.col("h"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    found = known.groupBy("lang", h.alias("h")).agg(F.lit(1)).groupBy("lang").agg(F.count("*").alias("n"), F.min(place).alias("least")).collect()
    if not found:
        return {}
    size = min(dictionary_bytes, ALL_BYTES // len(found))
    by_lang = lambda value: F.element_at(F.create_map(*(F.lit(x) for r in found for x in (r.lang, value(r)))), F.col("lang"))
    chars = by_lang(lambda r: 4 * max(1, size // min(sample_texts, r.n)))
    piece = F.substring("text", F.greatest(F.lit(1), ((F.length("text") - chars) / 2).cast("int")), chars)
    chosen = (place < by_lang(lambda r: min(1.0, sample_texts / r.n))) | (place == by_lang(lambda r: r.least))
    sample = known.withColumn("h", h).where(chosen).groupBy("lang", "h").agg(F.min(piece).alias("piece"))
    pieces: dict[str, list[bytes]] = {}
    for r in sample.orderBy("h").collect():
        pieces.setdefault(r.lang, []).append(r.piece.encode())
    return {lang: _cut(found, size) for lang, found in sorted(pieces.items())}


def _cut(pieces: list[bytes], size: int) -> bytes:
    """`size` bytes, evenly from all pieces; the rest of the size comes from the longer ones."""
    each = max(1, size // len(pieces))
    while each < size and sum(min(len(p), each) for p in pieces) < size and any(len(p) > each for p in pieces):
        each *= 2
    return b"\n".join(p[:each] for p in pieces)[:size]


class Compressors:
    """Compressed sizes of a text under each language's dictionary."""

    def __init__(self, dictionaries: dict[str, bytes], block: int = BLOCK_BYTES, level: int = LEVEL):
        import zstandard

        self.block, self.langs = block, list(dictionaries)
        self.makers = []
        params = zstandard.ZstdCompressionParameters.from_level(level, write_content_size=False, write_checksum=False, write_dict_id=False)
        for raw in dictionaries.values():
            held = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            held.precompute_compress(compression_params=params)
            self.makers.append(zstandard.ZstdCompressor(dict_data=held, compression_params=params))

    def sizes(self, text: bytes) -> list[int]:
        blocks = [text[k : k + self.block] for k in range(0, len(text), self.block)]
        return [sum(len(m.compress(b)) for b in blocks) for m in self.makers]

    def predict(self, text: str | None, least: float = LEAST_MARGIN) -> tuple[str, float, bool]:
        """Language, score and whether the margin is wide enough. The score is 1 - best / runner-up, stretched to 0..1.

        Ties go to the language first in alphabetical order. Undecided texts (null, or without a letter) score 0; with a single language it scores 1.
        """
        if not text or not self.langs or not (_ASCII_LETTER.search(text) or any(map(str.isalpha, text))):
            return UNDECIDED, 0.0, False
        ranked = sorted(zip(self.sizes(text.encode()), self.langs))
        if len(ranked) == 1:
            return ranked[0][1], 1.0, True
        margin = 1.0 - ranked[0][0] / ranked[1][0]
        return ranked[0][1], min(1.0, 4.0 * margin), margin >= least


_ASCII_LETTER = re.compile("[A-Za-z]")


def predict(docs: DataFrame, dictionaries: dict[str, bytes], least: float = LEAST_MARGIN) -> DataFrame:
    """The documents with `lang_pred` (the choice, or `und`), `score` and `lang_sure` (false where the margin is narrow).

    Only the text is read. Columns of these names are replaced. Every row gives one row.
    """
    kept = docs.drop("lang_pred", "score", "lang_sure")
    names = kept.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Compressors(dictionaries)
        for batch in batches:
            out = [model.predict(t.as_py(), least) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.float64()), pa.array([x[2] for x in out], pa.bool_())],
                [*names, "lang_pred", "score", "lang_sure"])

    return kept.mapInArrow(run, "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept.schema) + "lang_pred string, score double, lang_sure boolean")


def report(docs: DataFrame) -> DataFrame:
    """Held-out prediction: documents whose crc32(doc_id) mod 5 is not 0 teach (a null id counts as held out); all are predicted."""
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(True))
    model = fit(docs.where(~held_out).select("text", "lang"))
    return predict(docs.select("doc_id", "text"), model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "lang_sure")
