"""Secret scans with DataFrame functions only.

Three base kinds are found by pattern, leftmost and non-overlapping: ``assign`` (a named
credential and its value), ``access`` (access key ids) and ``hex`` (long hexadecimal runs).
Two added kinds look at character classes: a candidate is a run of one class (``entropy_hex``:
hexadecimal digits; ``entropy_base64``: letters, digits and ``+/_=-``) with a digit or a
change to a capital in it. A window of ``window`` characters slides over it; the counts of its
characters, and with them the Shannon entropy, are updated by the one character that
enters and the one that leaves. The span from the first to the last window at or above the
class's threshold is reported, unless the candidate is on the allow-list (placeholders,
sequences, UUIDs) or lies within a base span.

Each text is scanned within its row, so nothing is shuffled and a common secret or a hot
source costs no more than its rows. Positions are code points, ends exclusive. A null text
counts as empty. Repeated rows give repeated results. Rows without ``doc_id`` are left out.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cashcycle.llm.tables import texts

# The base kinds' patterns. The value of an assignment is group 2.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}+"
HEX = r"[0-9a-f]{32,}+"
MIN_VALUE = 8
KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_base64")


@dataclass(frozen=True)
class SecretOptions:
    window: int = 20
    hex_bits: float = 3.2
    base64_bits: float = 3.9
    allow: str = (
        r"(?i)example|sample|dummy|placeholder|change_?me|lorem|your[_-]|x{5}|0{8}|1234567|abcdefg"
        r"|^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
    )


_SPAN = "struct<start:int,end:int,kind:int>"


def _spans(text: Column, pattern: str, kind: int, least: int = 0) -> Column:
    """All matches as spans; with ``least``, those whose group 2 is that long."""
    pieces = F.split(text, pattern, -1).alias("before")
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("whole")
    value = (F.regexp_extract_all(text, F.lit(pattern), F.lit(2)) if least else whole).alias("value")
    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_SPAN}>").alias("found"))

    def step(seen: Column, x: Column) -> Column:
        begin = seen["at"] + F.length(x["before"])
        end = begin + F.coalesce(F.length(x["whole"]), F.lit(0))
        span = F.struct(begin.alias("start"), end.alias("end"), F.lit(kind).alias("kind"))
        good = x["whole"].isNotNull() & (F.length(x["value"]) >= least)
        return F.struct(
            end.alias("at"),
            F.when(good, F.concat(seen["found"], F.array(span))).otherwise(seen["found"]).alias("found"),
        )

    zipped = F.arrays_zip(pieces, whole, value)
    found = F.aggregate(zipped, start, step, lambda seen: seen["found"])
    return F.when(F.regexp_like(text, F.lit(pattern)), found).otherwise(F.array().cast(f"array<{_SPAN}>"))


def _bits(count: Column) -> Column:
    """``count * log2(count)``, 0 for 0."""
    return F.when(count > 1, count * F.log2(count.cast("double"))).otherwise(F.lit(0.0))


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _dense(candidate: Column, alphabet: str, window: int, bits: float) -> Column:
    """First and last (exclusive) character of the windows with enough entropy, -1 if none."""
    # A character's place in the alphabet by its code: the same work for each, however long the run.
    places = F.array(*[F.lit(alphabet.find(chr(code))) for code in range(128)])
    nothing = F.struct(
        F.array_repeat(F.lit(0), len(alphabet)).alias("counts"),
        F.lit(0.0).alias("total"),
        F.lit(0).alias("at"),
        F.lit(-1).alias("first"),
        F.lit(-1).alias("last"),
    )

    def step(s: Column, move: Column) -> Column:
        come, go = move["come"], move["go"]
        arrives, leaves = F.get(s["counts"], come), F.get(s["counts"], go)
        shift = F.when(come == go, F.lit(0.0)).otherwise(
            _bits(arrives + 1) - _bits(arrives) + F.when(go >= 0, _bits(leaves - 1) - _bits(leaves)).otherwise(0.0)
        )
        counts = F.transform(s["counts"], lambda n, k: n + (k == come).cast("int") - (k == go).cast("int"))
        at = s["at"] + 1

        def moved(total: Column) -> Column:
            entropy = F.log2(F.lit(window).cast("double")) - total / window
            dense = (at >= window) & (entropy >= bits)
            return F.struct(
                counts.alias("counts"),
                total.alias("total"),
                at.alias("at"),
                F.when(dense & (s["first"] < 0), at - window).otherwise(s["first"]).alias("first"),
                F.when(dense, at).otherwise(s["last"]).alias("last"),
            )

        return _with(s["total"] + shift, moved)

    def slid(entering: Column) -> Column:
        leaving = F.concat(F.array_repeat(F.lit(-1), window), entering)
        moves = F.filter(F.arrays_zip(entering.alias("come"), leaving.alias("go")), lambda m: m["come"].isNotNull())
        return F.aggregate(
            moves, nothing, step, lambda s: F.struct(s["first"].alias("first"), s["last"].alias("last"))
        )

    entering = F.transform(F.split(candidate, ""), lambda c: F.get(places, F.ascii(c)))
    return _with(entering, slid)


def _alphabet(letters: str) -> str:
    """The characters of a class of ASCII."""
    return "".join(chr(c) for c in range(128) if re.fullmatch(f"[{letters}]", chr(c)))


def _entropy_spans(text: Column, letters: str, kind: int, bits: float, options: SecretOptions) -> Column:
    # tried where a run begins only: within a run of n characters it would look ahead n times
    pattern = rf"(?<![{letters}])(?=[{letters}]*?(?:[0-9]|[a-z][A-Z]))[{letters}]{{{options.window},}}+"
    runs = _spans(text, pattern, kind)

    def measured(span: Column) -> Column:
        run = F.substring(text, span["start"] + 1, span["end"] - span["start"])
        place = _with(run, judged)
        return F.struct(
            (span["start"] + place["first"]).alias("start"),
            (span["start"] + place["last"]).alias("end"),
            span["kind"].alias("kind"),
        )

    def judged(run: Column) -> Column:
        allowed = F.regexp_like(run, F.lit(options.allow))
        return F.when(~allowed, _dense(run, _alphabet(letters), options.window, bits))

    return F.filter(
        F.transform(runs, lambda span: _with(measured(span), lambda s: s)), lambda s: s["end"] > s["start"]
    )


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], s["kind"], s["end"])))
    return F.array_join(
        F.transform(ordered, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ","
    )


def find_secrets(docs: DataFrame, options: SecretOptions | None = None) -> DataFrame:
    """(doc_id, base, added): arrays of spans (start, end, kind as its place in ``KINDS``)."""
    options = options or SecretOptions()
    rows = texts(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    text = F.col("text")
    rows = rows.select(
        "doc_id",
        _spans(text, ASSIGN, 0, MIN_VALUE).alias("assign"),
        _spans(text, ACCESS, 1).alias("access"),
        _spans(text, HEX, 2).alias("hex"),
        _entropy_spans(text, "0-9a-fA-F", 3, options.hex_bits, options).alias("in_hex"),
        _entropy_spans(text, "A-Za-z0-9+/_=-", 4, options.base64_bits, options).alias("in_base64"),
    )
    rows = rows.select("doc_id", F.concat("assign", "access", "hex").alias("base"), F.concat("in_hex", "in_base64").alias("more"))
    return rows.select(
        "doc_id",
        "base",
        F.filter(
            "more",
            lambda m: ~F.exists("base", lambda b: (b["start"] <= m["start"]) & (m["end"] <= b["end"])),
        ).alias("added"),
    )


def secret_digest(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, their digest, and all spans as text."""

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(_joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _joined(F.concat("base", "added")).alias("spans"),
    )
