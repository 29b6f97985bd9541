"""Secret scans: fixed patterns, and a guess-cost model for values in credential contexts.

A value that follows a credential word is cut into dictionary words, dates, repeats, alphabet sequences, keyboard walks and
brute-force characters so that the product of their guesses is least (dynamic programming over the value, in log10). Values whose
cheapest cut still costs enough guesses are reported as kind `guess`; human words and placeholders are not.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The patterns and least lengths of the base kinds.
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_LEAST, ACCESS_LEAST = 12, 18

KINDS = ("assign", "access", "hex", "guess")

#: Credential words and the value that follows them; the value ends at white space, quotes or brackets.
CONTEXT = re.compile(
    r"""(?i:passphrase|password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|credential|bearer)s?["']?\x20*[:=]\x20*["']?([^\s"'<>(){}\[\],;]+)""",
    re.ASCII)
_HINTS = ("pass", "pwd", "secret", "token", "key", "credential", "bearer")

# Words that people build passwords and placeholders from, commonest first. A vocabulary's words rank after them.
WORDS = (
    "password pass admin user login welcome test example changeme secret token key letmein master root default guest "
    "hello sample dummy placeholder your none null true false value string here insert todo my the and for with this "
    "that love dragon monkey sunshine princess football baseball shadow summer winter spring autumn company server "
    "database data local host prod dev demo qwerty abc api access auth private public service system account email name "
    "iloveyou rockyou nicole daniel babygirl lovely jessica michael ashley michelle chocolate soccer anthony friends butterfly "
    "purple angel jordan liverpool justin loveme andrea carlos jennifer joshua superman hannah amanda pretty basketball andrew "
    "flower charlie samantha chelsea jasmine brandon matthew robert thomas batman starwars computer internet freedom whatever "
    "trustno killer hunter ranger harley cookie cheese pepper ginger maggie buster forever correcthorsebatterystaple"
).split()

KEY_ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm")
#: How far each row of keys is shifted to the right.
_SHIFT = (0.0, 0.5, 0.75, 1.25)
_KEYS = {key: (row, column + _SHIFT[row]) for row, keys in enumerate(KEY_ROWS) for column, key in enumerate(keys)}
_DATE = re.compile(r"(?:19|20)\d\d([-/._]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01])|(?:0[1-9]|[12]\d|3[01])([-/._]?)(?:0[1-9]|1[0-2])\2(?:19|20)\d\d|(?:19|20)\d\d")
_YEAR = re.compile(r"(?:19|20)\d\d")
#: Characters that stand for letters; 1 stands for two.
_LEET = [str.maketrans("@403!$57+1", "aaoeisstt" + one) for one in "il"]

#: log10 of the guesses for a keyboard walk of three keys, each of its turns, an alphabet sequence, and a repeat of what stood before.
WALK, TURN, SEQUENCE, REPEAT = 1.9, 0.8, 1.7, 1.7
#: Longest unit that counts as repeated.
LONGEST_UNIT = 32

#: Least log10 of guesses of a reported value.
LEAST_GUESSES = 9.0


def vocabulary_words(path: str) -> tuple[str, ...]:
    """WORDS, then the words of three letters or more in a tokenizer file's vocabulary, by id: the earlier merged, the commoner."""
    with open(path, encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    found = (re.fullmatch(r"([a-z]{3,})</w>", piece) for piece in sorted(vocabulary, key=vocabulary.get))
    return (*WORDS, *(m[1] for m in found if m))


def _spread(value: str) -> float:
    """log10 of the alphabet that a brute-force guess must try for each character."""
    size = 26 * any(c.islower() for c in value) + 26 * any(c.isupper() for c in value) + 10 * any(c.isdigit() for c in value)
    return math.log10(max(10, size + 10 * any(not c.isalnum() for c in value)))


def _direction(a: str, b: str) -> tuple[int, bool] | None:
    """Where key b lies beside key a; None if it doesn't."""
    if a not in _KEYS or b not in _KEYS:
        return None
    down, right = _KEYS[b][0] - _KEYS[a][0], _KEYS[b][1] - _KEYS[a][1]
    beside = abs(right) == 1 if down == 0 else abs(down) == 1 and abs(right) < 1
    return (down, right > 0) if beside else None


def _step(a: str, b: str) -> int:
    """1 or -1 if b follows or precedes a among the letters or digits, else 0."""
    same = a.isascii() and b.isascii() and (a.isalpha() and b.isalpha() or a.isdigit() and b.isdigit())
    return ord(b) - ord(a) if same and abs(ord(b) - ord(a)) == 1 else 0


class GuessCost:
    """log10 of the guesses for a value, from a ranked word list."""

    def __init__(self, words: tuple[str, ...] | list[str] = tuple(WORDS)):
        self.rank = {}
        for n, w in enumerate(words):
            self.rank.setdefault(w.lower(), n + 1)
        self.longest = max(map(len, self.rank), default=0)

    def spans(self, value: str, low: str) -> Iterator[tuple[int, int, float, str]]:
        """Every dictionary word, also with letters replaced by lookalikes, and every date: start, end, cost, kind."""
        n = len(value)
        forms = [low, *dict.fromkeys(f for f in map(low.translate, _LEET) if f != low)]
        for i in range(n):
            for j in range(i + 3, min(n, i + self.longest) + 1):
                for k, form in enumerate(forms):
                    if (rank := self.rank.get(form[i:j])) is None or k and not any(map(str.isalpha, low[i:j])):
                        continue
                    part = value[i:j]
                    case = 0.0 if part == low[i:j] else 0.31 if part.isupper() or part[0].isupper() and part[1:] == low[i + 1 : j] else 1.0
                    yield i, j, math.log10(rank) + case + (0.9 if k else 0.3), "word"
            for m in filter(None, (_DATE.match(value, i), _YEAR.match(value, i))):
                yield i, m.end(), 2.1 if m.end() - i == 4 else 4.6, "date"

    def segment(self, value: str) -> tuple[float, list[tuple[int, int, str]]]:
        """The least cost over all cuts, and that cut; neighbouring brute-force characters are one span. Empty: 0.

        Walks, sequences and repeats may begin and end anywhere within a longer run: for each kind the cheapest cut whose
        last span may still grow is carried along, so the time is linear in the length of the value.
        """
        n, each = len(value), _spread(value) if value else 0.0
        low = value.lower() if len(value.lower()) == len(value) else value
        ending: list[list[tuple[int, float, str]]] = [[] for _ in range(n + 1)]
        for i, j, cost, kind in self.spans(value, low):
            ending[j].append((i, cost, kind))
        way = [None, *(_direction(a, b) for a, b in zip(low, low[1:]))]
        step = [0, *(_step(a, b) for a, b in zip(low, low[1:]))]
        none = (math.inf, 0)
        walk = sequence = none
        repeats = [none] * (LONGEST_UNIT + 1)
        best, back = [0.0] * (n + 1), [(0, "")] * (n + 1)
        for j in range(1, n + 1):
            at = j - 1
            options = [(best[at] + each, at, "brute"), *((best[i] + cost, i, kind) for i, cost, kind in ending[j])]
            turn = TURN if way[at] != way[at - 1] else 0.0
            if j >= 3 and way[at] and way[at - 1]:
                walk = min((walk[0] + turn, walk[1]), (best[j - 3] + WALK + turn, j - 3))
                options.append((*walk, "walk"))
            else:
                walk = none
            if j >= 3 and step[at] and step[at] == step[at - 1]:
                sequence = min(sequence, (best[j - 3] + SEQUENCE, j - 3))
                options.append((*sequence, "sequence"))
            else:
                sequence = none
            for unit in range(1, min(at, LONGEST_UNIT) + 1):
                if low[at] == low[at - unit]:
                    repeats[unit] = min(repeats[unit], (best[at] + REPEAT + math.log10(unit), at))
                    options.append((*repeats[unit], "repeat"))
                else:
                    repeats[unit] = none
            cost, i, kind = min(options, key=lambda o: o[0])
            best[j], back[j] = cost, (i, kind)
        cut: list[tuple[int, int, str]] = []
        j = n
        while j:
            i, kind = back[j]
            if cut and kind == "brute" == cut[-1][2]:
                cut[-1] = (i, cut[-1][1], kind)
            else:
                cut.append((i, j, kind))
            j = i
        return best[n], cut[::-1]


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Spans of the base kinds as (start, end, kind), code points, in order of start and kind."""
    low = text.lower()
    out = []
    if "assword" in low or "asswd" in low or "secret" in low or "token" in low or "api" in low:
        out += [(*m.span(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        out += [(*m.span(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    out += [(*m.span(), "hex") for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def guess_spans(text: str, model: GuessCost, least: float) -> list[tuple[int, int, str]]:
    """Credential-context values whose cheapest guess costs at least 10 ** least tries."""
    low = text.lower()
    if not any(h in low for h in _HINTS):
        return []
    return [(*m.span(1), "guess") for m in CONTEXT.finditer(text) if model.segment(m[1])[0] >= least]


def _named(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def _masked(text: str, spans: list[tuple[int, int, str]], mark: str) -> str:
    """Text with the union of the spans, which come in order of their starts, replaced, each run by one mark."""
    out, at = [], -1
    for a, b, _ in spans:
        if a > at:
            out += [text[max(at, 0) : a], mark]
        at = max(at, b)
    return "".join([*out, text[max(at, 0) :]])


def _finder(words, least: float, names: list[str], mark: str | None):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = GuessCost(words)
        for batch in batches:
            base, full, left = [], [], []
            for value in batch.column("text"):
                value = value.as_py()
                text = value or ""
                b = base_spans(text)
                base.append([{"start": x, "end": y, "kind": k} for x, y, k in b])
                both = sorted(b + guess_spans(text, model, least), key=lambda s: (s[0], KINDS.index(s[2])))
                full.append([{"start": x, "end": y, "kind": k} for x, y, k in both])
                if mark is not None:
                    left.append(_masked(text, both, mark) if both else value)
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))
            columns = {c: batch.column(c) for c in names}
            if mark is not None:
                columns["text"] = pa.array(left, batch.column("text").type)
            yield pa.RecordBatch.from_arrays([*columns.values(), pa.array(base, kind), pa.array(full, kind)], [*names, "base_spans", "secret_spans"])

    return find


_SPANS = "array<struct<start:bigint,end:bigint,kind:string>>"


def find_secrets(docs: DataFrame, words: tuple[str, ...] = tuple(WORDS), least: float = LEAST_GUESSES, mark: str | None = None) -> DataFrame:
    """The documents with `base_spans` and `secret_spans` (base and `guess` spans), each sorted by start and kind.

    Columns named like these are replaced. With a `mark`, each run of spans in `text` is replaced by it. A null text is empty
    (and stays null). Every row gives one row, repeated rows as well.
    """
    kept = docs.drop("base_spans", "secret_spans")
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept.schema) + f"base_spans {_SPANS}, secret_spans {_SPANS}"
    return kept.mapInArrow(_finder(words, least, kept.columns, mark), schema)


def redact(docs: DataFrame, mark: str = "[SECRET]", least: float = LEAST_GUESSES, words: tuple[str, ...] = tuple(WORDS)) -> DataFrame:
    """The documents with every secret span replaced by `mark` and `n_chars` set anew; the columns stay. Null stays null."""
    found = find_secrets(docs, words, least, mark)
    if "n_chars" in docs.columns:
        length = F.when(F.size("secret_spans") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
        found = found.withColumn("n_chars", length)
    return found.select(*docs.columns)


def _listed(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame, least: float = LEAST_GUESSES, words: tuple[str, ...] = tuple(WORDS)) -> DataFrame:
    """A row per document: counts of the base kinds, the digest of the base spans and the list of all spans."""
    found = find_secrets(docs.select("doc_id", "text"), words, least)
    count = lambda kind: F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    n_guess = F.size(F.filter("secret_spans", lambda s: s["kind"] == "guess")).cast("bigint").alias("n_guess")
    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(_listed(F.col("base_spans")).cast("binary"), 256).alias("base_sha256"),
                        _listed(F.col("secret_spans")).alias("spans"), n_guess)
