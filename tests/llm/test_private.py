import hashlib
import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm import private

PATTERNS = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
            ("card", r"[0-9]([ -]?[0-9])+"), ("phone", r"\+[0-9][ ().0-9-]+[0-9]")]
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def check_digit_right(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = int(d) * (2 if k % 2 else 1)
        total += d if d < 10 else d - 9
    return total % 10 == 0


def plain(text):
    """Base spans as (start, end, kind, spelling), straight from the rules."""
    out = []
    for kind, pattern in PATTERNS:
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(len(x.lstrip("0")) > 3 or int(x.lstrip("0") or "0") > 255 for x in m[0].split(".")):
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and check_digit_right(digits)):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append((m.start(), m.end(), kind, {"email": m[0].lower(), "ip": m[0]}.get(kind, digits)))
    return out


TEXTS = [
    "a@b.com_c@d.com e@f e@f.g. x.y%z+w@sub-1.host.tld, @no.com a@@b.c", "1.2.3.4.5.6.7.8 256.1.1.1 001.02.0255.3 1.2.3 9.9.9.9999", "0000000000000000000000000000.1.1.1",
    "4111 1111 1111 1111 and 4111-1111-1111-1112 4111111111111111 5", "+1 (487) 555-7209 +123 +49-30.1234567) +1((((((((2 +999999999999999999 ++12345678", "", None,
    "é漢 a@b.com 😀 10.0.0.1 ß", "no digits here", "4952935900253052", "z" * 4000 + "@" + "z" * 4000, "1" * 6000, "1." * 3000, "a." * 3000 + "@", "+" * 3000 + "1 " * 3000]


def test_base_spans_follow_the_rules(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string")
    for r in private.report(docs).collect():
        want = plain(TEXTS[r.doc_id] or "")
        listed = ",".join(f"{k}:{a}:{b}" for a, b, k, _ in want)
        assert r.spans == listed and r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x[2] for x in want) for k in ("email", "ip", "card", "phone")]


def class_of(word):
    if all("0" <= c <= "9" for c in word):
        return ("number", min(len(word), 9))
    case = "upper" if "A" <= word[0] <= "Z" else "wide" if word[0] > "\x7f" else "digit" if "0" <= word[0] <= "9" else "lower"
    return (case, sum(len(word) >= n for n in (3, 5, 9, 13)))


def lowered(word):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in word)


def brute(texts, reach, least_share, least_places):
    """All spans of each text, by counting in plain dictionaries."""
    docs = []
    for text in texts:
        spans = plain(text or "")
        terms = [(m.start(), m.end(), m[0]) for m in WORD.finditer(text or "") if not any(m.start() < b and a < m.end() for a, b, *_ in spans)]
        docs.append((spans, terms))
    holding, holders, meeting, places = Counter(), Counter(), Counter(), defaultdict(set)
    met = []
    for spans, terms in docs:
        holding.update({lowered(w) for *_, w in terms} | {class_of(w) for *_, w in terms})
        near, first = set(), {}
        for a, b, kind, value in spans:
            before, after = [w for _, y, w in terms if y <= a], [w for x, _, w in terms if x >= b]
            first.setdefault((kind, value), tuple(map(lowered, before[-private.PLACE_WORDS :] + after[: private.PLACE_WORDS])))
            near |= {((kind, value), lowered(w), class_of(w)) for w in before[max(0, len(before) - reach) :] + after[:reach]}
        holders.update(list(first))
        for e, x in {(e, x) for e, t, c in near for x in (t, c)}:
            meeting[e, x] += 1
            places[e, x].add(first[e])
        met.append(near)

    def tells(e, x):
        n = len(texts)
        return holders[e] < n and len(places[e, x]) >= least_places and math.log2(meeting[e, x] * n / holders[e] / holding[x]) / math.log2(n / holders[e]) >= least_share

    out = []
    for (spans, terms), near in zip(docs, met):
        gone = {t for e, t, c in near if tells(e, t) and tells(e, c)}
        general = {t for e, t, c in near if tells(e, t)} - gone
        listed = [f"{k}:{a}:{b}" for a, b, k, _ in spans]
        listed += [f"generalise:{a}:{b}" for a, b, w in terms if lowered(w) in general] + [f"remove:{a}:{b}" for a, b, w in terms if lowered(w) in gone]
        out.append(",".join(listed))
    return out


FILLER = "the old harbour wall keeps winter sea away from small houses people walk there in evening when it is calm".split()


def corpus():
    texts = []
    for k in range(40):
        words = [FILLER[(k * 7 + j * (k % 5 + 1)) % len(FILLER)] for j in range(30)]
        if k % 5 == 0:  # one word goes with one address, in different surroundings
            words[10:10] = ["Zorrowitz", words[3], "ann@corp.example", "wrote"]
        if k % 7 == 0:  # a word that is common elsewhere, too
            words[20:20] = ["harbour", "+1 (487) 555-7209"]
        if k % 3 == 1:
            words.insert(0, "Harbourer")
        if k % 8 == 1:  # number and its class go with a card
            words[5:5] = ["code", "731946", "for", "4111111111111111"]
        texts.append(" ".join(words))
    return texts + [texts[0]] * 5 + ["Zorrowitz once far " + " ".join(FILLER * 3), None, ""]


@pytest.mark.parametrize(("reach", "share", "places"), [(25, 0.9, 3), (3, 0.7, 1), (25, 0.3, 2)])
def test_terms_against_plain_counts(spark, reach, share, places):
    texts = corpus()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(5)
    want = brute(texts, reach, share, places)
    got = {r.doc_id: r.spans for r in private.report(docs, reach=reach, least_share=share, least_places=places).collect()}
    assert got == dict(enumerate(want))
    assert any("generalise" in w for w in want) and any("remove" in w for w in want)


def test_copies_are_no_evidence(spark):
    text = "Quillfeather lives there, write to q@corp.example or not at all, says the note on the door of the house"
    docs = spark.createDataFrame([(k, text + "!" * (k % 3)) for k in range(30)] + [(100 + k, " ".join(FILLER)) for k in range(60)], "doc_id bigint, text string")
    assert {r.spans.count(":") for r in private.report(docs).collect()} == {0, 2}


def test_sanitise(spark):
    texts = corpus()
    docs = spark.createDataFrame([(k, t, None if t is None else len(t), 1) for k, t in enumerate(texts)], "doc_id bigint, text string, n_chars bigint, private_spans int")
    got = {r.doc_id: r for r in private.sanitise(docs).collect()}
    assert got[46].text is None and got[47].text == "" and got[45].text == texts[45] and "private_spans" not in got[0]
    assert "Zorrowitz" not in got[0].text and "[NAME]" in got[0].text and "[EMAIL]" in got[0].text and "ann@" not in got[0].text
    assert "731946" not in got[1].text and "[CARD]" in got[1].text
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in got.values())


def test_odd_rows(spark, odd, odd_rows, nothing):
    named = odd.withColumn("_hash", F.lit(1)).withColumn("base_spans", F.lit(2)).withColumn("entity", F.lit(3)).withColumn("term", F.lit(3))
    got = private.find_private(named)
    assert got.columns == [*odd.columns, "entity", "term", "base_spans", "private_spans"] and got.count() == len(odd_rows)
    assert private.report(nothing).count() == 0 and private.report(odd).count() == len(odd_rows)
    assert sorted(map(str, private.sanitise(odd).collect())) == sorted(map(str, odd.collect()))
