"""Slot lines in free text, read with array expressions only."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from treadmark.functions.lists import is_valid_id, let, padded, words
from treadmark.functions.text import compare_key

PRODUCTS = 24
FORMAT_ERROR = "FormatError"
ERROR_NAMES = ("ERROR_VEHICLE", "ERROR_SIZE")


def error_line(vehicle: Column, size: Column, error: str) -> Column:
    """Line reported for a request without an answer."""
    v = F.coalesce(F.nullif(vehicle, F.lit("")), F.lit("UNKNOWN"))
    s = F.coalesce(F.nullif(size, F.lit("")), F.lit("UNKNOWN"))
    return F.concat_ws(
        " ",
        F.replace(F.trim(v), F.lit(" "), F.lit("_")),
        F.replace(F.replace(F.trim(s), F.lit("/"), F.lit("-")), F.lit(" "), F.lit("_")),
        F.array_repeat(F.lit(error), 4),
        F.array_repeat(F.lit("-"), 20),
    )


def _split_at(at: Column) -> Column:
    """Splits (vehicle words, size words) that put the first product at ``at`` (0-based)."""
    three = F.array(F.lit(1), F.lit(2), F.lit(3))
    return F.transform(
        F.filter(three, lambda s: at - s >= 1), lambda s: F.struct((at - s).alias("v"), s.alias("s"))
    )


def lenient_line(text: Column) -> Column:
    """struct(vehicle, size, ids) at the first split with four hotbox entries.

    ``ids`` are the four hotboxes and at most 20 further tokens.  Text without
    such a split gives error names and FormatError everywhere; empty text gives
    the word Error instead.
    """
    error = F.when(F.coalesce(text, F.lit("")) == "", F.lit("Error")).otherwise(F.lit(FORMAT_ERROR))
    failed = F.struct(
        F.lit(ERROR_NAMES[0]).alias("vehicle"), F.lit(ERROR_NAMES[1]).alias("size"),
        F.array_repeat(error, PRODUCTS).alias("ids"),
    )

    def read(tokens: Column) -> Column:
        n = F.size(tokens)

        # Only places where four tokens in a row are ids or dashes can follow a size.
        def boxes(i: Column) -> Column:
            return F.forall(F.slice(tokens, i + 1, F.lit(4)), lambda t: is_valid_id(t) | (t == "-"))

        starts = F.filter(F.sequence(F.lit(2), F.greatest(n - 4, F.lit(2))), lambda i: (i + 4 <= n) & boxes(i))
        # Order of trial: fewer vehicle words first, then fewer size words.
        splits = F.filter(F.flatten(F.transform(starts, _split_at)), lambda x: x["v"] <= n - 5)

        def parts(best: Column) -> Column:
            found = F.struct(
                F.array_join(F.slice(tokens, F.lit(1), best["v"]), " ").alias("vehicle"),
                F.array_join(F.slice(tokens, best["v"] + 1, best["s"]), "").alias("size"),
                F.slice(tokens, best["v"] + best["s"] + 1, F.lit(PRODUCTS)).alias("ids"),
            )
            return F.when(best.isNotNull(), found).otherwise(failed)

        return F.when(n >= 6, let(F.array_min(splits), parts)).otherwise(failed)

    return let(words(text), read)


def strict_line(text: Column, vehicle: Column, size: Column) -> Column:
    """The first line that starts with the requested vehicle and size, as a 24-id line; else NULL.

    Lines whose normalised text does not begin with the normalised request are
    skipped before any split is tried.
    """

    def read(want: Column) -> Column:
        def line_match(line: Column) -> Column:
            def tokens_match(tokens: Column) -> Column:
                n = F.size(tokens)

                def joined(start: Column, count: Column) -> Column:
                    return compare_key(F.array_join(F.slice(tokens, start, count), ""))

                def ids(x: Column) -> Column:
                    return padded(F.slice(tokens, x["v"] + x["s"] + 1, F.lit(PRODUCTS)), PRODUCTS, "-")

                # Vehicle ends first, then size ends, in order of trial.
                ends = F.filter(F.sequence(F.lit(1), n - 5), lambda v: joined(F.lit(1), v) == want["v"])
                three = F.array(F.lit(1), F.lit(2), F.lit(3))
                splits = F.flatten(
                    F.transform(ends, lambda v: F.transform(three, lambda s: F.struct(v.alias("v"), s.alias("s"))))
                )
                fits = F.filter(
                    splits,
                    lambda x: (x["v"] + x["s"] <= n)
                    & (joined(x["v"] + 1, x["s"]) == want["s"])
                    & F.forall(ids(x), lambda t: t.rlike("^([0-9]+|-)$")),
                )

                def out(first: Column) -> Column:
                    whole = F.concat_ws(" ", F.slice(tokens, F.lit(1), first["v"] + first["s"]), ids(first))
                    return F.when(first.isNotNull(), whole)

                return F.when(n >= 6, let(F.get(fits, F.lit(0)), out))

            begins = compare_key(line).startswith(F.concat(want["v"], want["s"]))
            return F.when(begins, let(words(line), tokens_match))

        lines = F.split(F.coalesce(text, F.lit("")), r"\r\n|[\n\r\x0b\f\x1c-\x1e\x85\u2028\u2029]")
        return F.get(F.filter(F.transform(lines, line_match), lambda x: x.isNotNull()), F.lit(0))

    return let(F.struct(compare_key(vehicle).alias("v"), compare_key(size).alias("s")), read)


def loose_line(text: Column, vehicle: Column, size: Column) -> Column:
    """All 7-8 digit ids of a text that mentions the request, as a 24-id line; else NULL.

    Dashes count once an id has been seen; fewer than four entries is no answer.
    """

    def mentioned(whole: Column) -> Column:
        return F.contains(whole, compare_key(vehicle)) & F.contains(whole, compare_key(size))

    tokens = words(F.regexp_replace(text, r"[^a-zA-Z0-9-]", " "))
    entries = F.filter(tokens, lambda t: is_valid_id(t) | (t == "-"))
    name = F.replace(F.upper(F.trim(vehicle)), F.lit(" "), F.lit("_"))
    label = F.replace(F.replace(F.upper(F.trim(size)), F.lit("/"), F.lit("")), F.lit(" "), F.lit(""))

    def from_first_id(wanted: Column) -> Column:
        lead = F.array_position(F.transform(wanted, lambda t: t != "-"), F.lit(True)).cast("int")
        return F.when(lead > 0, F.slice(wanted, lead, F.size(wanted)))

    def line(ids: Column) -> Column:
        return F.when(F.size(ids) >= 4, F.concat_ws(" ", name, label, padded(ids, PRODUCTS, "-")))

    answer = let(let(entries, from_first_id), line)
    return F.when((F.coalesce(text, F.lit("")) != "") & let(compare_key(text), mentioned), answer)
