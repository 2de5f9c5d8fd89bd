"""Benchmark decontamination by winnowing."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from questlog.llm.common import by_size, cut

#: Words of a window, and of the grams whose smallest hashes are kept.
WINDOW = 10
GRAM = 5
#: Log2 of the bits of the filter that the fingerprints of the items set: 2 MB, whatever the benchmark's size.
FILTER_BITS = 24
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = True
_WORD[128:] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_GAP = b" "
#: Bytes of a word up to which a polynomial is its hash, and of a piece of a batch.
LONG = 64
_PIECE = 1 << 20


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


@functools.cache
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse."""
    both = []
    for base in (int(_BASE), pow(int(_BASE), -1, 1 << 64)):
        out = np.ones(_PIECE + LONG + 1, np.uint64)
        np.multiply.accumulate(np.full(_PIECE + LONG, base, np.uint64), out=out[1:])
        both.append(out)
    return both[0], both[1]


class Words:
    """The words of a batch of texts, and a hash of each; of: the text that each belongs to.

    Words are runs of the bytes that kinds marks, letters A-Z lowered; a space is never among them."""

    def __init__(self, texts: list[str | None], kinds: np.ndarray = _WORD):
        raw = [(t or "").encode("utf-8", "replace") for t in texts]
        self.data = _GAP.join(raw)
        low = _LOWER[np.frombuffer(self.data, np.uint8)] if self.data else np.zeros(0, np.uint8)
        self.low = low.tobytes()
        inside = np.concatenate([[False], kinds[low], [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        self.start, self.end = edges[0::2], edges[1::2]
        ends = np.cumsum([len(r) + 1 for r in raw])
        self.of = np.searchsorted(ends, self.start, side="right")
        self.count = np.bincount(self.of, minlength=len(raw))
        self.first = np.cumsum(self.count) - self.count
        self.hash = self._hashes(low)

    def _hashes(self, low: np.ndarray) -> np.ndarray:
        """A polynomial of each word's bytes, from running sums over pieces of the batch; of words
        longer than LONG, whose polynomials can be made to meet, another hash."""
        size = self.end - self.start
        out = np.zeros(len(size), np.uint64)
        up, down = _powers()
        short = np.flatnonzero(size <= LONG)
        for i in np.flatnonzero(size > LONG).tolist():
            out[i] = xxhash.xxh64_intdigest(self.low[self.start[i] : self.end[i]], 1)
        begin, end = self.start[short], self.end[short]
        for lo in range(0, len(low), _PIECE):
            a, b = np.searchsorted(begin, [lo, lo + _PIECE])
            if a == b:
                continue
            part = low[lo : int(end[b - 1])].astype(np.uint64) + np.uint64(1)
            run = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(part * up[: len(part)], out=run[1:])
            s, e = begin[a:b] - lo, end[a:b] - lo
            out[short[a:b]] = _mix((run[e] - run[s]) * down[s])
        return out

    def word(self, i: int) -> str:
        return self.low[self.start[i] : self.end[i]].decode("utf-8", "replace")

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """A hash for each run of n words, and which of them lie inside one text."""
        m = max(0, len(self.hash) - n + 1)
        h = np.zeros(m, np.uint64)
        for j in range(n):
            h = h * _BASE + self.hash[j : j + m]
        return _mix(h + np.uint64(n)), self.of[:m] == self.of[n - 1 : n - 1 + m]

    def selected(self) -> tuple[np.ndarray, np.ndarray]:
        """Winnowed grams: of each window of WINDOW words the rightmost of the grams with the least hash."""
        h, _ = self.grams(GRAM)
        wide = WINDOW - GRAM + 1
        m = max(0, len(self.hash) - WINDOW + 1)
        at = np.arange(m)
        low, where = h[:m].copy(), at.copy()
        for j in range(1, wide):
            better = h[j : j + m] <= low
            low[better] = h[j : j + m][better]
            where[better] = at[better] + j
        where = np.unique(where[self.of[:m] == self.of[WINDOW - 1 : WINDOW - 1 + m]])
        return where, h[where]


def _rows(texts: list[str | None], lengths: list[int], keep: np.ndarray | None, items: bool) -> tuple[Words, list[list[tuple]]]:
    """For each text its fingerprints (hash, length, position, context) that the filter lets pass.

    Length GRAM with WINDOW - GRAM words of context on each side stands for winnowed grams; shorter
    items are looked for whole, by every run of as many words, and have no context around."""
    words = Words(texts)
    out: list[list[tuple]] = [[] for _ in texts]
    around = WINDOW - GRAM
    wanted = [(0, *words.selected())]
    for n in lengths:
        h, whole = words.grams(n)
        at = np.flatnonzero(whole & (words.count[words.of[: len(h)]] == n)) if items else np.flatnonzero(whole)
        wanted.append((n, at, h[at]))
    for n, at, h in wanted:
        if keep is not None:
            bit = (h >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
            ok = (keep[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1
            at, h = at[ok], h[ok]
        for i, x in zip(at.tolist(), h.view(np.int64).tolist()):
            t = int(words.of[i])
            first, last = int(words.first[t]), int(words.first[t] + words.count[t])
            lo, hi = (i, i + n) if n else (i - around, i + GRAM + around)
            out[t].append((x, n, i - first, [words.word(j) if first <= j < last else "" for j in range(lo, hi)]))
    return words, out


def _fingerprints(df: DataFrame, text: str, lengths: list[int], keep: np.ndarray | None, items: bool) -> DataFrame:
    """Add n_words and the array of fingerprints to each row."""
    shared = df.sparkSession.sparkContext.broadcast(keep)

    @F.pandas_udf("n_words long, prints array<struct<hash:long,length:int,pos:int,context:array<string>>>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            counts, prints = [], []
            for part in by_size(texts):
                words, rows = _rows(part, lengths, shared.value, items)
                counts += words.count.tolist()
                prints += [[{"hash": h, "length": n, "pos": p, "context": c} for h, n, p, c in r] for r in rows]
            yield pd.DataFrame({"n_words": counts, "prints": prints})

    return df.withColumn("_f", run(F.col(text))).select("*", "_f.n_words", "_f.prints").drop("_f")


def _filter(prints: DataFrame) -> np.ndarray:
    """The filter's bits, gathered as at most 2 ** (FILTER_BITS - 5) words of 32 bits."""
    bit = F.shiftrightunsigned("hash", 64 - FILTER_BITS).alias("bit")
    words = prints.select(bit).selectExpr("shiftright(bit, 5) AS w", "shiftleft(1L, cast(bit & 31 AS int)) AS b").groupBy("w").agg(F.bit_or("b").alias("bits"))
    found = words.toPandas()
    out = np.zeros(1 << (FILTER_BITS - 5), np.uint32)
    out[found["w"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64).astype(np.uint32)
    return out.view(np.uint8)


def _same_run(steps: list[tuple[Column, Column]]) -> Column:
    """How many of the steps agree before the first that does not."""
    total, so_far = F.lit(0), F.lit(True)
    for a, b in steps:
        so_far = so_far & (a == b) & (a != "")
        total = total + so_far.cast("int")
    return total


def contamination(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Find where documents hold windows of benchmark items.

    Returns (rows, hits, items): rows has row_id, doc_id and n_words for every row of docs; hits
    has (row_id, start, end, passage): words of a document, end exclusive, that lie inside
    occurrences of windows; items has (passage, item_id), the items that such a passage comes from.
    A window is WINDOW consecutive words of an item; an item of fewer words, but not none, is one
    window. Winnowing keeps a gram from every window, by content alone, so both sides keep the
    same one and every shared window is found; the words around it are then compared themselves.
    Null texts have no words. Repeated rows count each for themselves. Items without an id are
    looked for like any other.
    """
    bench = benchmark.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("_text"))
    lengths = sorted(
        r["n"] for r in _fingerprints(bench, "_text", [], None, True).where((F.col("n_words") > 0) & (F.col("n_words") < WINDOW)).select(F.col("n_words").alias("n")).distinct().collect()
    )
    items = cut(
        _fingerprints(bench, "_text", lengths, None, True)
        .select("item_id", F.explode("prints").alias("p"))
        .select("item_id", F.col("p.hash").alias("hash"), F.col("p.length").alias("length"), F.col("p.context").alias("item_context"))
        .withColumn("passage", F.md5(F.to_json(F.struct("length", "item_context")).cast("binary")))
        .distinct()
    )
    passages = cut(items.select("hash", "length", "item_context", "passage").distinct())
    scanned = cut(
        _fingerprints(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text")), "_text", lengths, _filter(passages.select("hash").distinct()), False)
        .select(F.monotonically_increasing_id().alias("row_id"), "doc_id", "n_words", "prints")
    )
    near = scanned.where(F.size("prints") > 0).select("row_id", F.explode("prints").alias("p")).select("row_id", F.col("p.hash").alias("hash"), F.col("p.length").alias("length"), F.col("p.pos").alias("pos"), F.col("p.context").alias("context"))
    around = WINDOW - GRAM
    a, b = F.col("context"), F.col("item_context")
    pair = lambda j: (F.get(a, F.lit(j)), F.get(b, F.lit(j)))
    same = _same_run([pair(j) for j in range(around, around + GRAM)]) == GRAM
    left = _same_run([pair(j) for j in range(around - 1, -1, -1)])
    right = _same_run([pair(j) for j in range(around + GRAM, around + GRAM + around)])
    joined = near.join(passages, ["hash", "length"])
    hits = joined.withColumns({"left": left, "right": right}).where(
        F.when(F.col("length") > 0, a == b).otherwise(same & (F.col("left") + F.col("right") + GRAM >= WINDOW))
    )
    whole = F.col("length") > 0
    hits = hits.select(
        "row_id",
        F.when(whole, F.col("pos")).otherwise(F.col("pos") - F.col("left")).alias("start"),
        F.when(whole, F.col("pos") + F.col("length")).otherwise(F.col("pos") + GRAM + F.col("right")).alias("end"),
        "passage",
    )
    return scanned.select("row_id", "doc_id", "n_words"), cut(hits), items.select("passage", "item_id").distinct()


def decontaminate(docs: DataFrame, benchmark: DataFrame, **names: str) -> DataFrame:
    """One row for each row of docs: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.
    Items without an id hit words and are in no list."""
    rows, hits, items = contamination(docs, benchmark, **names)
    order = Window.partitionBy("row_id").orderBy("start", "end")
    reach = F.coalesce(F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    covered = (
        hits.groupBy("row_id", "start").agg(F.max("end").alias("end"))
        .select("row_id", F.greatest(F.col("end") - F.greatest("start", reach), F.lit(0)).alias("fresh"))
        .groupBy("row_id").agg(F.sum("fresh").alias("n_hit"))
    )
    named = (
        hits.select("row_id", "passage").distinct().join(items.where("item_id is not null"), "passage").select("row_id", F.col("item_id").cast("string").alias("item")).distinct()
        .groupBy("row_id").agg(F.sort_array(F.collect_list("item")).alias("items"))
        .select("row_id", F.size("items").cast("long").alias("n_items"), F.array_join("items", ",").alias("joined"))
    )
    return (
        rows.join(covered.join(named, "row_id", "left"), "row_id", "left")
        .select(
            "doc_id",
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
            F.sha2(F.coalesce("joined", F.lit("")), 256).alias("items_sha256"),
            (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
        )
    )
