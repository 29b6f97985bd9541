"""Fill-in-middle transformation by counted quantifiers.

A text is a row of units: words with the white space before them, and white space at the end. `regexp_count` counts them.
Each row then has a pattern of its own, in which one possessive group takes `a` units and the next `b - a` units; a single
match of it captures prefix, middle and suffix, and the replacement of that match puts them in their new order.
Possessive groups of fixed counts run in a loop, so that long texts need no deep stack. All is SQL functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The unit, and the marks before prefix, suffix and middle.
UNIT = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
MARKS = ("<P>", "<S>", "<M>")

#: What a fresh match of (prefix)(middle)(suffix) becomes, by form.
_ARRANGED = {"psm": "<P>$1<S>$3<M>$2", "spm": "<S>$3<P>$1<M>$2"}
#: The pattern that takes an output apart again, and the text in the order of its groups.
_TAKEN = {"psm": (r"(?s)\A<P>(.*?)<S>(.*?)<M>(.*)\z", "$1$3$2"), "spm": (r"(?s)\A<S>(.*?)<P>(.*?)<M>(.*)\z", "$2$3$1")}

_NEW = ("n_units", "form", "prefix_chars", "middle_chars", "output")


def _by_form(form: Column, values: dict[str, str]) -> Column:
    return F.when(form == "psm", F.lit(values["psm"])).otherwise(F.lit(values["spm"]))


def fill_in_middle(docs: DataFrame, seed: int = 42, share: int = 50, spm_share: int = 80) -> DataFrame:
    """The documents with `n_units`, `form` (plain, psm or spm), `prefix_chars`, `middle_chars` and `output`.

    Cuts and form come from the SHA-256 of `seed:doc_id`: `share` per cent of the texts are transformed, `spm_share` per
    cent of those suffix first. Empty texts and texts that hold a mark stay plain, with null lengths. A null text is
    empty, a null doc_id has no digits; repeated rows give repeated results. Columns of the new names are replaced.
    """
    kept = docs.drop(*_NEW, "_text", "_h", "_a", "_b")
    text, form = F.col("_text"), F.col("form")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    number = lambda k: F.conv(F.substring(F.col("_h"), 8 * k + 1, 8), 16, 10).cast("bigint")
    rows = kept.select("*", F.coalesce("text", F.lit("")).alias("_text"), digest.alias("_h"))
    rows = rows.select("*", F.regexp_count(text, F.lit(UNIT)).cast("bigint").alias("n_units"))
    plain = (text == "") | (number(2) % 100 >= share)
    for mark in MARKS:
        plain = plain | text.contains(mark)
    first, second = number(0) % (F.col("n_units") + 1), number(1) % (F.col("n_units") + 1)
    rows = rows.select(
        "*", F.when(plain, "plain").when(number(3) % 100 < spm_share, "spm").otherwise("psm").alias("form"),
        F.least(first, second).alias("_a"), F.greatest(first, second).alias("_b"))
    pattern = F.concat(F.lit(rf"(?s)\A((?:{UNIT}){{"), F.col("_a"), F.lit(rf"}}+)((?:{UNIT}){{"), F.col("_b") - F.col("_a"), F.lit(r"}+)(.*)\z"))
    rows = rows.select("*", F.when(form == "plain", text).otherwise(F.regexp_replace(text, pattern, _by_form(form, _ARRANGED))).alias("output"))
    out, at = F.col("output"), lambda mark: F.locate(mark, F.col("output"))
    after_prefix = F.when(form == "psm", at("<S>") - 4).otherwise(at("<M>") - at("<P>") - 3)
    return rows.select(
        *(F.col(f"`{c}`") for c in kept.columns), "n_units", "form", F.when(form != "plain", after_prefix).cast("bigint").alias("prefix_chars"),
        F.when(form != "plain", F.length(out) - at("<M>") - 2).cast("bigint").alias("middle_chars"), "output")


def restored(output: Column, form: Column) -> Column:
    """The text from an output and its form. No text of a transformed row holds a mark, so each mark is found where it was put."""
    pieces = _by_form(form, {f: p for f, (p, _) in _TAKEN.items()}), _by_form(form, {f: r for f, (_, r) in _TAKEN.items()})
    return F.when(form == "plain", output).otherwise(F.regexp_replace(output, *pieces))


def report(docs: DataFrame, seed: int = 42) -> DataFrame:
    """A row per document: units, form, lengths, and digests of the output and of the text rebuilt from it."""
    done = fill_in_middle(docs.select("doc_id", "text"), seed)
    return done.select(
        "doc_id", F.col("n_units").alias("n"), "form", "prefix_chars", "middle_chars", F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"))
