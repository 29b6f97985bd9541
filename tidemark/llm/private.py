"""Personal data: fixed patterns, and an information-theoretic search for terms that give protected values away.

The values that the patterns find (e-mail and IP addresses, card and phone numbers) are the protected entities. A term that
stands near an entity discloses it by their pointwise mutual information over the corpus: with n documents, n_e of them
holding the entity, n_t the term and n_et both within reach, it is log(n_et n / (n_e n_t)), at most the entity's own
information log(n / n_e). A term whose share of that information reaches a threshold tells (nearly) all of the entity to
whoever knows the corpus, so it is generalised to its class (a capitalised word of 5 to 8 letters, a number of 4 digits)
where the class stays below the threshold, else removed.

Counts are over all documents, copies included; chance is kept out by asking for a number of different surroundings of the
entity in which the term meets it, which copies and near copies don't add to. Everything is counted by 64-bit hashes in Spark; nothing of the corpus passes through the driver.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.files import settled
from tidemark.llm.texts import LOWER, WORD_BYTES, mixed, span_hashes, steps, words

# The patterns and the limits of the base kinds.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
CARD_DIGITS, PHONE_DIGITS, IP_MOST = (16, 19), (8, 15), 255

#: Kinds of spans in their order; the last two are the method's.
KINDS = ("email", "ip", "card", "phone", "generalise", "remove")

#: Words on either side of an entity that may disclose it.
REACH = 25
#: Least share of the entity's information that a term must give to be touched.
LEAST_SHARE = 0.9
#: Least number of different surroundings of the entity in which the term meets it, and the words on either side that tell surroundings apart.
LEAST_PLACES = 3
PLACE_WORDS = 4
#: Terms of which a task sums the documents before it hands them on.
TASK_TERMS = 1 << 20
#: Groups that an entity's, term's or text's rows are dealt into where they meet its figures.
SALTS = 16

_DIGIT = np.zeros(256, bool)
_DIGIT[0x30:0x3A] = True
_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True
_ASIDE = re.compile(r"[^0-9]+")
#: A run of characters that may stand before the `@`, from its first one on: no search begins inside a run, so long runs cost their length.
_RUN = re.compile(r"(?<![A-Za-z0-9._%+-])" + EMAIL.pattern)


def luhn(digits: str) -> bool:
    """Whether the check digit is right: every second digit from the right doubled, digit sums added, a multiple of ten."""
    doubled = sum(d * 2 - 9 * (d > 4) for d in map(int, digits[-2::-2]))
    return (doubled + sum(map(int, digits[::-2]))) % 10 == 0


def _emails(text: str) -> Iterator[re.Match]:
    """Leftmost matches; only the first character after a match may begin inside a run."""
    at = 0
    while m := EMAIL.match(text, at) or _RUN.search(text, at):
        yield m
        at = m.end()


def base_spans(text: str) -> list[tuple[int, int, str, str]]:
    """Spans of the base kinds: start and end in code points, kind, and the value in one spelling; by kind, then start."""
    out = []
    if "@" in text:
        out += [(*m.span(), "email", m[0].lower()) for m in _emails(text)]
    if "." in text:
        out += [(*m.span(), "ip", m[0]) for m in IP.finditer(text) if all(len(x) < 4 and int(x or 0) <= IP_MOST for x in (g.lstrip("0") for g in m.groups()))]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= CARD_DIGITS[0]:
            digits = _ASIDE.sub("", m[0])
            if CARD_DIGITS[0] <= len(digits) <= CARD_DIGITS[1] and luhn(digits):
                out.append((*m.span(), "card", digits))
    if "+" in text:
        for m in PHONE.finditer(text):
            digits = _ASIDE.sub("", m[0])
            if PHONE_DIGITS[0] <= len(digits) <= PHONE_DIGITS[1]:
                out.append((*m.span(), "phone", digits))
    return out


class Terms:
    """The words of one step's rows outside the spans, with the spans found in them."""

    def __init__(self, data: np.ndarray, at: np.ndarray):
        self.data, self.at = data, at
        self.n = len(at) - 1
        #: Characters of each row that begin before a byte.
        self.before = np.concatenate([[0], np.cumsum(data & 0xC0 != 0x80)])
        digit, mark = np.concatenate([[0], np.cumsum(_DIGIT[data])]), np.concatenate([[0], np.cumsum(data == 0x40)])
        may = (digit[at[1:]] - digit[at[:-1]] >= 4) | (mark[at[1:]] > mark[at[:-1]])
        self.spans: list[list[tuple[int, int, str, str]]] = [[] for _ in range(self.n)]
        for r in np.flatnonzero(may):
            self.spans[r] = base_spans(data[at[r] : at[r + 1]].tobytes().decode("utf-8", "replace"))
        starts, ends, rows = words(data, at, WORD_BYTES)
        first = self.before[starts] - self.before[at[rows]]
        last = self.before[ends] - self.before[at[rows]]
        free = np.ones(len(starts), bool)
        for r in np.flatnonzero([bool(s) for s in self.spans]):
            lo, hi = np.searchsorted(rows, [r, r + 1])
            for a, b, *_ in self.spans[r]:
                free[lo + np.searchsorted(last[lo:hi], a, "right") : lo + np.searchsorted(first[lo:hi], b, "left")] = False
        self.starts, self.ends, self.rows, self.first, self.last = starts[free], ends[free], rows[free], first[free], last[free]
        self.hashes = span_hashes(LOWER[data], self.starts, self.ends)
        self.classes = self._classes()

    def _classes(self) -> np.ndarray:
        """The class of each word: number of so many digits, or word by its first letter's case and length."""
        size = self.last - self.first
        digits = np.concatenate([[0], np.cumsum(_DIGIT[self.data])])
        number = digits[self.ends] - digits[self.starts] == self.ends - self.starts
        head = self.data[self.starts] if len(self.starts) else np.zeros(0, np.uint8)
        case = np.where(_UPPER[head], 1, np.where(head >= 0x80, 2, np.where(_DIGIT[head], 3, 0)))
        kind = np.where(number, 64 + np.minimum(size, 9), case * 8 + np.searchsorted([3, 5, 9, 13], size, "right"))
        return mixed(kind.astype(np.uint64) + np.uint64(0xC1A55))


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64), pa.int64())


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, n): documents of the task that hold each term or class."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0

    def merged():
        terms, counts = (np.concatenate(x) for x in zip(*held))
        unique, which = np.unique(terms, return_inverse=True)
        return unique, np.bincount(which, weights=counts, minlength=len(unique)).astype(np.int64)

    for _, data, at in steps(batches, "text"):
        found = Terms(data, at)
        if not len(found.rows):
            continue
        terms, rows = np.concatenate([found.hashes, found.classes]), np.concatenate([found.rows, found.rows])
        order = np.lexsort((rows, terms))
        terms, rows = terms[order], rows[order]
        new = np.ones(len(terms), bool)
        new[1:] = (terms[1:] != terms[:-1]) | (rows[1:] != rows[:-1])
        held.append(np.unique(terms[new], return_counts=True))
        size += len(held[-1][0])
        if size > TASK_TERMS:
            held = [merged()]
            size = len(held[0][0])
            if size > TASK_TERMS // 2:
                yield pa.RecordBatch.from_arrays([_signed(held[0][0]), pa.array(held[0][1])], ["term", "n"])
                held, size = [], 0
    if held:
        terms, counts = merged()
        yield pa.RecordBatch.from_arrays([_signed(terms), pa.array(counts)], ["term", "n"])


_SPANS = "array<struct<start:bigint,end:bigint,kind:string>>"
_SPAN_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))


def _finder(names: list[str], reach: int):
    """Base spans of each row, the hash of its text where it has any, and the (entity, term, class) within reach,
    each with the surroundings of the entity's first place in the text."""
    pair = pa.list_(pa.struct([("entity", pa.int64()), ("term", pa.int64()), ("class", pa.int64()), ("place", pa.int64())]))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, at in steps(batches, "text"):
            found = Terms(data, at)
            spans, texts, near = [], [], []
            for r, mine in enumerate(found.spans):
                spans.append([{"start": a, "end": b, "kind": kind} for a, b, kind, _ in mine])
                if not mine:
                    texts.append(None), near.append(None)
                    continue
                texts.append(xxhash.xxh3_64_intdigest(data[at[r] : at[r + 1]].tobytes()) - (1 << 63))
                lo, hi = np.searchsorted(found.rows, [r, r + 1])
                parts, places = [], {}
                for a, b, kind, value in mine:
                    entity = np.uint64(xxhash.xxh3_64_intdigest(f"{kind}:{value}"))
                    left = lo + np.searchsorted(found.last[lo:hi], a, "right")
                    right = lo + np.searchsorted(found.first[lo:hi], b, "left")
                    around = np.r_[max(lo, left - reach) : left, right : min(hi, right + reach)]
                    close = np.r_[max(lo, left - PLACE_WORDS) : left, right : min(hi, right + PLACE_WORDS)]
                    place = places.setdefault(entity, np.uint64(xxhash.xxh3_64_intdigest(found.hashes[close].tobytes())))
                    parts.append(np.stack([
                        np.full(len(around) + 1, entity), np.append(found.hashes[around], np.uint64(0)), np.append(found.classes[around], np.uint64(0)), np.full(len(around) + 1, place)], axis=1))
                near.append(np.unique(np.concatenate(parts), axis=0).view(np.int64))
            size = np.array([0 if x is None else len(x) for x in near])
            flat = np.concatenate([x for x in near if x is not None] or [np.zeros((0, 4), np.int64)])
            ends = pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32(), mask=np.append([x is None for x in near], False))
            pairs = pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(flat[:, k])) for k in range(4)], ["entity", "term", "class", "place"]))
            yield pa.RecordBatch.from_arrays(
                [*(rows.column(c) for c in names), pa.array(spans, _SPAN_TYPE), pa.array(texts, pa.int64()), pairs.cast(pair)], [*names, "base_spans", "_hash", "_near"])

    return find


def _marker(names: list[str]):
    """Adds to the base spans those of the terms in `_general` and `_removed`, wherever they stand outside base spans."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, at in steps(batches, "text"):
            found = Terms(data, at)
            out = []
            for r in range(rows.num_rows):
                mine = [{"start": a, "end": b, "kind": kind} for a, b, kind, _ in found.spans[r]]
                lo, hi = np.searchsorted(found.rows, [r, r + 1])
                gone = np.array(rows.column("_removed")[r].as_py() or [], np.int64)
                for kind, terms in (("generalise", np.setdiff1d(np.array(rows.column("_general")[r].as_py() or [], np.int64), gone)), ("remove", gone)):
                    for k in lo + np.flatnonzero(np.isin(found.hashes[lo:hi].view(np.int64), terms)):
                        mine.append({"start": int(found.first[k]), "end": int(found.last[k]), "kind": kind})
                out.append(mine)
            yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in names), pa.array(out, _SPAN_TYPE)], [*names, "private_spans"])

    return mark


def _schema(df: DataFrame) -> str:
    return "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in df.schema)


def _salted(df: DataFrame) -> DataFrame:
    """Every row once for each salt."""
    return df.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def _salt(*columns: str) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(SALTS)).cast("int").alias("_salt")


def disclosures(docs: DataFrame, meetings: DataFrame, least_share: float = LEAST_SHARE, least_places: int = LEAST_PLACES) -> DataFrame:
    """(entity, term, share): terms and classes that give at least `least_share` of an entity's information.

    `meetings` has a row (entity, term, place, n) for the documents in which they are within reach and the entity has these
    surroundings; term 0 stands for the entity itself. An entity in every document has no information and no terms.
    """
    pairs = meetings.groupBy("entity", "term", "place").agg(F.sum("n").alias("n"))
    pairs = pairs.groupBy("entity", "term").agg(F.sum("n").alias("n_et"), F.count(F.lit(1)).alias("places"))
    entities = pairs.where("term = 0").select("entity", F.col("n_et").alias("n_e"))
    pairs = pairs.where((F.col("term") != 0) & (F.col("places") >= least_places)).select("entity", "term", "n_et")
    counts = docs.select("text").mapInArrow(_counter, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n_t"))
    counts = counts.join(pairs.select("term").distinct(), "term", "left_semi")
    pairs = pairs.withColumn("_salt", _salt("entity")).join(_salted(counts), ["term", "_salt"]).drop("_salt")
    pairs = pairs.withColumn("_salt", _salt("term")).join(_salted(entities), ["entity", "_salt"]).drop("_salt")
    n = F.lit(float(docs.count()))
    share = F.log2(F.col("n_et") * n / (F.col("n_e") * F.col("n_t"))) / F.log2(n / F.col("n_e"))
    return pairs.where(F.col("n_e") < n).select("entity", "term", share.alias("share")).where(F.col("share") >= least_share)


def find_private(docs: DataFrame, reach: int = REACH, least_share: float = LEAST_SHARE, least_places: int = LEAST_PLACES, with_text: bool = True) -> DataFrame:
    """The documents (`doc_id`, `text`, any others) with `base_spans` and `private_spans` (base spans, then terms to generalise and to remove), by kind and start.

    Columns so named are replaced; `with_text=False` leaves `text` out. A null text is empty; every row gives one row,
    repeated rows as well. Without a disclosing term the spans are the base spans.
    """
    kept = docs.drop("base_spans", "private_spans", "_hash", "_near", "_general", "_removed", "_salt")
    names = kept.columns
    found = kept.mapInArrow(_finder(names, reach), _schema(kept) + f"base_spans {_SPANS}, _hash bigint, _near array<struct<entity:bigint,term:bigint,class:bigint,place:bigint>>")
    if not with_text:
        found = found.withColumn("text", F.when(F.col("_hash").isNotNull(), F.col("text")))
    found = settled(found, "private")
    near = found.where(F.col("_hash").isNotNull()).select(F.col("_hash").alias("text"), F.explode("_near").alias("x")).select("text", "x.*")
    near = near.groupBy("entity", "term", "class", "place", "text").agg(F.count(F.lit(1)).alias("n"))
    # A class meets an entity in a text as often as the text occurs, through however many terms.
    both = near.select("entity", F.explode(F.array_distinct(F.array("term", "class"))).alias("term"), "place", "text", "n")
    meetings = both.groupBy("entity", "term", "place", "text").agg(F.max("n").alias("n"))
    told = settled(disclosures(kept, meetings, least_share, least_places), "disclosures")
    told = told.select("entity", "term")
    hit = near.where("term <> 0").join(told, ["entity", "term"], "left_semi")
    classes = _salted(told.select("entity", F.col("term").alias("class"), F.lit(True).alias("_wide")))
    wide = hit.withColumn("_salt", _salt("text")).join(classes, ["entity", "class", "_salt"], "left")
    terms = wide.groupBy("text").agg(F.collect_set(F.when(F.col("_wide").isNull(), F.col("term"))).alias("_general"), F.collect_set(F.when(F.col("_wide"), F.col("term"))).alias("_removed"))
    terms = _salted(terms.withColumnRenamed("text", "_hash"))
    told_of = found.where(F.col("_hash").isNotNull()).withColumn("_salt", _salt("doc_id")).join(terms, ["_hash", "_salt"], "left")
    out = [c for c in names if with_text or c != "text"]
    columns = [F.col(f"`{c}`") for c in out]
    marked = told_of.select(*dict.fromkeys([*out, "text", "base_spans", "_general", "_removed"]))
    marked = marked.mapInArrow(_marker([*out, "base_spans"]), _schema(marked.select(*out, "base_spans")) + f"private_spans {_SPANS}")
    clean = found.where(F.col("_hash").isNull()).select(*columns, "base_spans", F.col("base_spans").alias("private_spans"))
    return clean.unionByName(marked)


def _listed(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame, **options) -> DataFrame:
    """A row per document: counts of the base kinds, the digest of the base spans, the list of all spans, and the method's counts."""
    found = find_private(docs.select("doc_id", "text"), with_text=False, **options)
    count = lambda kind, spans="base_spans": F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return found.select(
        "doc_id", *(count(k) for k in KINDS[:4]), F.sha2(_listed("base_spans").cast("binary"), 256).alias("base_sha256"),
        _listed("private_spans").alias("spans"), *(count(k, "private_spans") for k in KINDS[4:]))


def _sanitised(text: str, spans: list[dict]) -> str:
    """The text with every base span as its kind, generalised terms as their class, removed ones gone; overlaps become one."""
    out, at, order = [], 0, {k: n for n, k in enumerate(KINDS)}
    for s in sorted(spans, key=lambda s: (s["start"], order[s["kind"]], -s["end"])):
        if s["end"] <= at:
            continue
        if s["start"] >= at:
            out.append(text[at : s["start"]])
            value = text[s["start"] : s["end"]]
            if s["kind"] == "generalise":
                out.append("#" * len(value) if value.isdigit() else "[NAME]" if value[0].isupper() else "[WORD]")
            elif s["kind"] != "remove":
                out.append(f"[{s['kind'].upper()}]")
        at = max(at, s["end"])
    return "".join(out) + text[at:]


def sanitise(docs: DataFrame, **options) -> DataFrame:
    """The documents with personal data masked and disclosing terms generalised or removed; the columns stay (but for any named like the spans), `n_chars` is set anew. Null stays null."""
    found = find_private(docs, **options)
    names = found.columns[:-2]

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = batch.column("private_spans").to_pylist()
            texts = [t if not s else _sanitised(t, s) for t, s in zip(batch.column("text").to_pylist(), spans)]
            columns = [pa.array(texts, pa.string()) if c == "text" else batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([bool(s) for s in spans])], [*names, "_changed"])

    done = found.mapInArrow(rewrite, _schema(found.select(*(F.col(f"`{c}`") for c in names))) + "_changed boolean")
    if "n_chars" in docs.columns:
        length = F.when(F.col("_changed"), F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
        done = done.withColumn("n_chars", length)
    return done.select(*(F.col(f"`{c}`") for c in docs.columns if c in names))
