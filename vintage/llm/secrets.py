r"""Secret scans, with DataFrame functions only.

Three pattern scans (assignments to secret-like names, access-key ids, long
lower-case hex runs) and, beside them, an entropy scan: candidate strings
are the long runs of a character class (hex digits; base-64 characters); a
window of ``WINDOW`` characters slides over each, and the count of every
character in the window is kept up to date as one character enters and one
leaves, so the Shannon entropy changes by two table look-ups a step. The
stretch from the first to the last window at or above the class's threshold
is a span. What pattern spans cover and placeholder words (each with up to
``WINDOW`` letters and digits that hang on it) is cut out of a run first, and
each piece left is a candidate of its own, unless the allow list suppresses
it (UUIDs, digests named as such, paths, plain words and numbers). Of a
base-64 span only what a hex entropy span covers is left out.

Everything is computed inside a row: no shuffle, no Python; a long text
stays with its row and costs time linear in its length (quadratic only in
the number of its matches).

Defined results: null text is an empty text and has no spans; repeated rows
are scanned each for itself; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vintage.llm.common import fresh, let

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: A run that is too short holds no later start that is long enough, so
#: these two carry their least length in the pattern.
ACCESS = "AKIA[A-Z0-9]{12,}"
HEX = "[0-9a-f]{32,}"
ASSIGN_LEAST = 8

WINDOW = 20
#: class name, characters, threshold in bits (at most log2 WINDOW = 4.32).
CLASSES = (
    ("entropy_hex", "0123456789abcdefABCDEF", 3.1),
    ("entropy_base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-", 3.9),
)
#: Candidates that are no secrets: UUIDs, paths and words joined by signs.
SHAPES = (r"^[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}$"
          r"|^/?[A-Za-z]+([/_-][A-Za-z]+)+/?$|^[A-Za-z]+$|^[0-9_=/+-]+$")
#: Placeholders and alphabets in order.
WORDS = (r"(?i:example|placeholder|dummy|sample|redacted|changeme|your[_-]|xxxx|1234567890|0123456789|abcdefghij)")
ALLOWED = f"{SHAPES}|{WORDS}"
PLACEHOLDER = f"[A-Za-z0-9]{{0,{WINDOW}}}{WORDS}[A-Za-z0-9]{{0,{WINDOW}}}"
#: What stands before a value that is meant to be public.
ALLOWED_BEFORE = r"""(?i:(sha-?(1|224|256|384|512)|md5|crc32|etag|commit|revision|digest|checksum|integrity|uuid)["']?[\x20:=/-]*["']?)$"""

_SPANS = "array<struct<start:bigint,rank:int,kind:string,end:bigint>>"
_PARTS = "array<struct<start:bigint,end:bigint>>"
KINDS = ("assign", "access", "hex", *[c[0] for c in CLASSES])


def _none() -> Column:
    return F.array().cast(_SPANS)


def _span(kind: str, start: Column, end: Column) -> Column:
    return F.struct(start.cast("long").alias("start"), F.lit(KINDS.index(kind)).alias("rank"),
                    F.lit(kind).alias("kind"), end.cast("long").alias("end"))


def _located(text: Column, pattern: str, found: Column) -> Column:
    """Array of (piece before, match, start) of the matches ``found``: the
    text splits at exactly these, so lengths add up to positions."""
    pairs = F.arrays_zip(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found)).alias("piece"), found.alias("match"))
    kind = "array<struct<piece:string,match:string,start:bigint>>"
    state = F.aggregate(
        pairs, F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(kind).alias("out")),
        lambda s, x: F.struct(
            (s["at"] + F.length(x["piece"]) + F.length(x["match"])).alias("at"),
            F.concat(s["out"], F.array(F.struct(x["piece"].alias("piece"), x["match"].alias("match"),
                                                (s["at"] + F.length(x["piece"])).alias("start")))).alias("out")))
    return state["out"]


def _pattern_spans(text: Column, pattern: str, kind: str, found: Column) -> Column:
    at = _located(text, pattern, found)
    if kind == "assign":
        at = F.filter(at, lambda x: F.length(F.regexp_extract(x["match"], ASSIGN, 2)) >= ASSIGN_LEAST)
    return F.when(F.size(found) == 0, _none()).otherwise(
        F.transform(at, lambda x: _span(kind, x["start"], x["start"] + F.length(x["match"]))))


def entropy_window(string: Column, alphabet: str, threshold: float, window: int = WINDOW) -> Column:
    """struct(first, last): end positions (1-based, inclusive) of the first and
    the last window of ``string`` whose entropy reaches ``threshold``; nulls
    where none does."""
    log = F.array(*[F.lit(n * math.log2(n) if n else 0.0) for n in range(window + 2)])
    codes = F.transform(F.split(string, ""), lambda c: F.instr(F.lit(alphabet), c))
    steps = let(codes, lambda all_: F.transform(all_, lambda c, i: F.struct(
        c.alias("enters"), F.when(i >= window, F.get(all_, i - window)).otherwise(0).alias("leaves"),
        (i + 1).alias("at"))))
    start = F.struct(F.array_repeat(F.lit(0), len(alphabet)).alias("counts"), F.lit(0.0).alias("sum"),
                     F.lit(None).cast("int").alias("first"), F.lit(None).cast("int").alias("last"))

    def slide(s: Column, x: Column) -> Column:
        same = x["enters"] == x["leaves"]
        n_in = F.element_at(s["counts"], x["enters"])
        n_out = F.element_at(s["counts"], F.greatest(x["leaves"], F.lit(1)))
        gone = F.when(x["leaves"] > 0, F.element_at(log, n_out + 1) - F.element_at(log, n_out)).otherwise(0.0)
        total = F.when(same, s["sum"]).otherwise(
            s["sum"] - gone + F.element_at(log, n_in + 2) - F.element_at(log, n_in + 1))
        counts = F.when(same, s["counts"]).otherwise(F.transform(
            s["counts"], lambda n, k: n + F.when(k + 1 == x["enters"], 1).when(k + 1 == x["leaves"], -1).otherwise(0)))
        high = (x["at"] >= window) & (F.lit(math.log2(window)) - total / window >= threshold)
        return F.struct(counts.alias("counts"), total.alias("sum"),
                        F.when(s["first"].isNull() & high, x["at"]).otherwise(s["first"]).alias("first"),
                        F.when(high, x["at"]).otherwise(s["last"]).alias("last"))

    return F.aggregate(steps, start, slide, lambda s: F.struct(s["first"].alias("first"), s["last"].alias("last")))


def _left(start: Column, end: Column, cuts: Column, least: int) -> Column:
    """Array of the stretches of [start, end) outside ``cuts`` (start, end)
    that have ``least`` characters or more."""
    closed = F.array_sort(F.concat(cuts, F.array(F.struct(end.alias("start"), end.alias("end")))))

    def step(s: Column, c: Column) -> Column:
        stop = F.least(c["start"], end)
        return F.struct(F.greatest(s["at"], c["end"]).alias("at"), F.when(stop - s["at"] >= least, F.concat(
            s["out"], F.array(F.struct(s["at"].alias("start"), stop.alias("end"))))).otherwise(s["out"]).alias("out"))

    return F.aggregate(closed, F.struct(start.cast("long").alias("at"), F.array().cast(_PARTS).alias("out")), step, lambda s: s["out"])


def _parts(spans: Column, start: Column, end: Column) -> Column:
    """(start, end) of the ``spans`` that touch [start, end), counted from ``start``."""
    near = F.filter(spans, lambda b: (b["start"] < end) & (start < b["end"]))
    return F.transform(near, lambda b: F.struct((b["start"] - start).alias("start"), (b["end"] - start).alias("end")))


def _candidates(run: Column, base: Column) -> Column:
    """(match, start, before): the pieces of a run outside the ``base`` spans
    and the placeholders that may hold a secret."""
    match, size = run["match"], F.length(run["match"]).cast("long")
    words = F.transform(_located(match, PLACEHOLDER, F.regexp_extract_all(match, F.lit(PLACEHOLDER), F.lit(0))), lambda w: F.struct(
        w["start"].alias("start"), (w["start"] + F.length(w["match"])).alias("end")))
    pieces = _left(F.lit(0), size, F.concat(_parts(base, run["start"], run["start"] + size), words), WINDOW)
    cut = F.transform(pieces, lambda p: F.struct(
        F.substring(match, (p["start"] + 1).cast("int"), (p["end"] - p["start"]).cast("int")).alias("match"), (run["start"] + p["start"]).alias("start"),
        F.right(F.concat(F.right(run["piece"], F.lit(24)), F.substring(match, F.lit(1), p["start"].cast("int"))), F.lit(24)).alias("before")))
    return F.filter(cut, lambda x: x["match"].rlike("[0-9]") & x["match"].rlike("[A-Za-z]") & ~x["match"].rlike(SHAPES)
                    & ~F.btrim(x["match"], F.lit("+/_=-")).rlike(SHAPES) & ~x["before"].rlike(ALLOWED_BEFORE))


def _entropy_spans(text: Column, found: Column, name: str, alphabet: str, threshold: float, base: Column, taken: Column | None = None) -> Column:
    """Entropy spans outside the ``base`` spans, without what ``taken`` covers."""
    runs = F.filter(_located(text, _runs(alphabet), found), lambda x: x["match"].rlike("[0-9]") & x["match"].rlike("[A-Za-z]")
                    & ~x["match"].rlike(SHAPES))
    at = F.flatten(F.transform(runs, lambda x: _candidates(x, base)))
    seen = F.transform(at, lambda x: F.struct(x["start"].alias("start"), x["match"].alias("match"),
                                              entropy_window(x["match"], alphabet, threshold).alias("w")))
    hits = F.filter(seen, lambda x: x["w"]["first"].isNotNull())

    def rest(x: Column) -> Column:
        first, size = x["w"]["first"] - WINDOW, (x["w"]["last"] - x["w"]["first"] + WINDOW).cast("long")
        if taken is None:
            return F.array(_span(name, x["start"] + first, x["start"] + first + size))
        start = x["start"] + first
        parts = F.filter(_left(F.lit(0), size, _parts(taken, start, start + size), 1), lambda p: F.substring(
            x["match"], (first + p["start"] + 1).cast("int"), (p["end"] - p["start"]).cast("int")).rlike("[A-Za-z0-9]"))
        return F.transform(parts, lambda p: _span(name, start + p["start"], start + p["end"]))

    return F.when(F.size(found) == 0, _none()).otherwise(F.flatten(F.transform(hits, rest)))


def _runs(alphabet: str) -> str:
    chars = "0-9a-fA-F" if len(alphabet) == 22 else "A-Za-z0-9+/_=-"
    return f"[{chars}]{{{WINDOW},}}"


def scan(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``base_spans`` and ``spans`` added (names made fresh if
    taken): arrays of (start, rank, kind, end), code points, end exclusive,
    by start and then kind as listed in ``KINDS``."""
    base_name, all_name = fresh(docs, "base_spans", "spans")
    patterns = {"assign": ASSIGN, "access": ACCESS, "hex": HEX}
    found = fresh(docs, *[f"found_{k}" for k in (*patterns, *[c[0] for c in CLASSES])])
    text = F.coalesce(F.col(text_col), F.lit(""))
    every = [*patterns.values(), *[_runs(c[1]) for c in CLASSES]]
    df = docs.select("*", *[F.regexp_extract_all(text, F.lit(p), F.lit(0)).alias(n) for p, n in zip(every, found)])
    parts = [_pattern_spans(text, p, k, F.col(n)) for (k, p), n in zip(patterns.items(), found)]
    df = df.withColumn(base_name, F.array_sort(F.concat(*parts)))
    # the base-64 scan also leaves what the hex scan has found
    hex_name, = fresh(df, "hex_spans")
    (k1, a1, t1), (k2, a2, t2) = CLASSES
    base, hex_spans = F.col(base_name), F.col(hex_name)
    df = df.withColumn(hex_name, _entropy_spans(text, F.col(found[3]), k1, a1, t1, base))
    df = df.withColumn(all_name, F.array_sort(F.concat(
        base, hex_spans, _entropy_spans(text, F.col(found[4]), k2, a2, t2, base, hex_spans))))
    return df.drop(hex_name, *found)


def masked(text: Column, spans: Column, mask: str = "[SECRET]") -> Column:
    """``text`` with every span (sorted by start, overlaps joined) replaced."""
    whole = F.aggregate(spans, F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out")), lambda s, x: F.struct(
        F.greatest(s["at"], x["end"]).alias("at"),
        F.when(x["start"] < s["at"], s["out"]).otherwise(F.concat(
            s["out"], F.substring(text, (s["at"] + 1).cast("int"), (x["start"] - s["at"]).cast("int")), F.lit(mask))).alias("out")),
        lambda s: F.concat(s["out"], F.substring(text, (s["at"] + 1).cast("int"), F.length(text))))
    return F.when(F.size(spans) == 0, text).otherwise(whole)


def listed(spans: Column) -> Column:
    """kind:start:end of every span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def counted(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
