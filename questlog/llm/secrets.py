"""Secret scans by DataFrame expressions alone: patterns, and entropy in sliding windows."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_base64")
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
#: Runs of fewer digits fail, so that only the long ones need to match.
HEX = r"[0-9a-f]{32,}"
WINDOW = 24
#: By class: what a candidate is, its characters, and the least entropy of a window in bits.
CLASSES = {
    "entropy_hex": (r"[0-9a-fA-F]{24,}", "0123456789abcdefABCDEF", 3.0),
    "entropy_base64": (r"[A-Za-z0-9+/_-]{24,}", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-", 4.0),
}
#: No secrets: parts of candidates that match one of the first five (placeholders, plain sequences), candidates that are one of the others (UUIDs, words without digits).
ALLOWED = (r"(?i)example", r"(?i)x{6,}", r"0123456789", r"(?i)abcdefgh", r"(.)\1{7,}", r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$", r"^[^0-9]*$", r"^[^A-Za-z]*$")

_SPANS = "array<struct<start:int,kind:int,end:int,match:string>>"


def _found(text: Column, pattern: str, kind: int) -> Column:
    """Spans of the leftmost matches that do not overlap, in code points. What stands between the
    matches and the matches themselves alternate, so their lengths give the places."""
    gaps, hits = F.split(text, pattern), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.arrays_zip(F.slice(gaps, F.lit(1), F.size(hits)).alias("gap"), hits.alias("hit"))
    placed = F.aggregate(
        pairs,
        F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("out")),
        lambda acc, x: F.struct(
            (acc["at"] + F.length(x["gap"]) + F.length(x["hit"])).alias("at"),
            F.array_append(
                acc["out"],
                F.struct((acc["at"] + F.length(x["gap"])).alias("start"), F.lit(kind).alias("kind"), (acc["at"] + F.length(x["gap"]) + F.length(x["hit"])).alias("end"), x["hit"].alias("match")),
            ).alias("out"),
        ),
        lambda acc: acc["out"],
    )
    return F.when(text.rlike(pattern), placed).otherwise(F.array().cast(_SPANS))


def _windows(span: Column, kind: int, alphabet: str, least: float) -> Column:
    """Joined windows of a candidate whose entropy reaches the least, as spans.

    Counts change by the character that enters and the one that leaves; the sum of c log2 c, from
    which the entropy follows, changes with them.
    """
    table = F.array(*[F.lit(k * math.log2(k) if k else 0.0) for k in range(WINDOW + 2)])
    most = WINDOW * (math.log2(WINDOW) - least) + 1e-9
    chars = F.slice(F.split(span["match"], ""), 1, F.length(span["match"]))
    ids = F.transform(chars, lambda c: F.instr(F.lit(alphabet), c))
    entering = F.zip_with(ids, F.concat(F.array_repeat(F.lit(0), WINDOW), ids), lambda a, b: F.struct(a.alias("a"), b.alias("b")))

    def step(acc: Column, x: Column) -> Column:
        # x.a enters; x.b leaves, or is 0 while the first window fills; x.a is null past the end
        up, down = F.get(acc["counts"], x["a"]), F.get(acc["counts"], x["b"])
        total = acc["total"] + F.when(
            x["a"] == x["b"], F.lit(0.0)
        ).otherwise(
            F.get(table, up + 1) - F.get(table, up) + F.when(x["b"] > 0, F.get(table, down - 1) - F.get(table, down)).otherwise(0.0)
        )
        counts = F.transform(acc["counts"], lambda c, j: c + F.when(j == x["a"], 1).otherwise(0) - F.when((j == x["b"]) & (x["b"] > 0), 1).otherwise(0))
        return F.struct(counts.alias("counts"), total.alias("total"), (acc["n"] + 1).alias("n"), acc["out"].alias("out"))

    def note(acc: Column) -> Column:
        start, end = span["start"] + acc["n"] - WINDOW, span["start"] + acc["n"]
        last = F.element_at(acc["out"], -1)
        joins = (F.size(acc["out"]) > 0) & (F.try_element_at(acc["out"], F.lit(-1))["end"] >= start)
        span_of = lambda s: F.struct(s.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), F.lit("").alias("match"))
        longer = F.concat(F.slice(acc["out"], F.lit(1), F.size(acc["out"]) - 1), F.array(span_of(last["start"])))
        out = F.when((acc["n"] >= WINDOW) & (acc["total"] <= most), F.when(joins, longer).otherwise(F.array_append(acc["out"], span_of(start)))).otherwise(acc["out"])
        return F.struct(acc["counts"].alias("counts"), acc["total"].alias("total"), acc["n"].alias("n"), out.alias("out"))

    begin = F.struct(F.array_repeat(F.lit(0), len(alphabet) + 1).alias("counts"), F.lit(0.0).alias("total"), F.lit(0).alias("n"), F.array().cast(_SPANS).alias("out"))
    return F.aggregate(F.filter(entering, lambda x: x["a"].isNotNull()), begin, lambda acc, x: note(step(acc, x)), lambda acc: acc["out"])


def _pieces(span: Column, kind: int) -> Column:
    """What of a candidate lies between its parts on the allow-list, where it is WINDOW characters or longer."""
    parts = "|".join(f"(?:{p})" for p in (ALLOWED[4], *ALLOWED[:4]))
    hits = _found(span["match"], parts, kind)
    starts = F.concat(F.array(F.lit(0)), F.transform(hits, lambda h: h["end"]))
    ends = F.concat(F.transform(hits, lambda h: h["start"]), F.array(F.length(span["match"])))
    piece = lambda a, b: F.struct((span["start"] + a).alias("start"), F.lit(kind).alias("kind"), (span["start"] + b).alias("end"), F.substring(span["match"], a + 1, b - a).alias("match"))
    return F.filter(F.zip_with(starts, ends, piece), lambda x: F.length(x["match"]) >= WINDOW)


def _entropy(text: Column, name: str) -> Column:
    pattern, alphabet, least = CLASSES[name]
    kind = KINDS.index(name)
    candidates = F.filter(_found(text, pattern, kind), lambda x: ~x["match"].rlike("|".join(f"(?:{p})" for p in ALLOWED[5:])))
    pieces = F.flatten(F.transform(candidates, lambda x: _pieces(x, kind)))
    return F.flatten(F.transform(pieces, lambda x: _windows(x, kind, alphabet, least)))


def scan_secrets(docs: DataFrame, text: str = "text", name: str = "secrets") -> DataFrame:
    """Add all spans of secrets as array<struct<kind,start,end>>, by start, then kind, then end.

    Places are code points of the whole text, ends exclusive. Base kinds: assignments of a value
    of 8 characters or more, access keys of 16 or more, runs of 32 or more hex digits. The method
    adds windows of WINDOW characters inside candidates of one character class whose Shannon
    entropy reaches the class's bound, joined where they touch; windows that overlap a part on the
    allow-list, and whole candidates without a digit or letter or of a UUID's form, add none. A null or empty text has no spans. Other columns pass through; name is replaced.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    value = F.lit(ASSIGN)
    pairs = F.zip_with(_found(whole, ASSIGN, 0), F.regexp_extract_all(whole, value, F.lit(2)), lambda s, v: F.when(F.length(v) >= 8, s))
    assign = F.when(whole.rlike(ASSIGN), F.filter(pairs, lambda s: s.isNotNull())).otherwise(F.array().cast(_SPANS))
    access = F.filter(_found(whole, ACCESS, 1), lambda s: s["end"] - s["start"] >= 16)
    every = F.array_sort(F.concat(assign, access, _found(whole, HEX, 2), *[_entropy(whole, c) for c in CLASSES]))
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return docs.withColumn(name, every).withColumn(
        name, F.transform(name, lambda s: F.struct(F.get(kinds, s["kind"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    )


def redact(docs: DataFrame, spans: str, text: str = "text", mask: str = "[SECRET]") -> DataFrame:
    """Put the mask in place of every span (overlapping ones share one); null texts stay null."""
    whole = F.col(text)
    cleaned = F.aggregate(
        F.col(spans),
        F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out")),
        lambda acc, s: F.when(
            s["start"] >= acc["at"],
            F.struct(s["end"].alias("at"), F.concat(acc["out"], F.array(F.substring(whole, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mask))).alias("out")),
        ).otherwise(F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out"))),
        lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(whole, acc["at"] + 1, F.length(whole))),
    )
    return docs.withColumn(text, F.when(F.size(spans) > 0, cleaned).otherwise(whole))
