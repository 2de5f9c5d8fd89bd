"""Language identification by cross-parsing entropy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from questlog.llm.common import by_size

#: Symbols of a block. Blocks of a text are parsed side by side and then made to fit together.
BLOCK = 256
#: Labelled rows of each language, the documented bound of the fitted sample; their texts are whole.
SAMPLE_ROWS = 12
#: Rows of more characters are drawn only where too few others are there, as an automaton is as large as its text.
LONG_ROW = 16_000
#: Blocks that walk through the automata side by side.
WIDTH = 8192


@dataclass(frozen=True)
class Model:
    """One suffix automaton for each language, all in one table without room for what is not there.

    symbols maps a code point to 1..; 0 is any character that the samples lack. A transition of a
    state stands at base[state] + symbol: the state in the upper 32 bits, where it leads in the
    lower. State 0 has none and means that there is none: no automaton leads back to its root.
    """

    langs: list[str]
    symbols: dict[int, int]
    base: np.ndarray
    packed: np.ndarray
    roots: np.ndarray
    bits: np.ndarray

    def step(self, state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        found = self.packed[self.base[state] + symbol]
        return np.where(found >> 32 == state, found & 0xFFFFFFFF, 0)


def suffix_automaton(symbols: np.ndarray) -> list[dict[int, int]]:
    """Transitions of the smallest automaton that accepts every substring; state 0 is the root."""
    nxt: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in symbols.tolist():
        cur = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                twin = len(nxt)
                nxt.append(dict(nxt[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and nxt[p].get(c) == q:
                    nxt[p][c] = twin
                    p = link[p]
                link[q] = link[cur] = twin
        last = cur
    return nxt


def _fold(text: str) -> np.ndarray:
    """Lower-case code points with each run of others than letters as one space."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32).copy()
    plain = points < 128
    letter = ~plain | ((points >= 97) & (points <= 122))
    odd = np.flatnonzero(~plain)
    if len(odd):
        kinds, where = np.unique(points[odd], return_inverse=True)
        letter[odd] = np.array([chr(k).isalpha() for k in kinds.tolist()])[where]
    points[~letter] = 32
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    return points[keep] if letter.any() else points[:0]


def _placed(rows: list[dict[int, int]], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Bases and packed transitions of states 1.. : rows of several symbols go where they fit
    between others, tried at some places before the table grows; rows of one fill what is left."""
    rng = np.random.default_rng(5)
    base = np.zeros(len(rows) + 1, np.int64)
    packed = np.full(2 * width + sum(map(len, rows)), -1 << 32, np.int64)
    state_of = lambda i, row: (i << 32) | np.fromiter(row.values(), np.int64, len(row))
    several = sorted((i for i, r in enumerate(rows, 1) if len(r) > 1), key=lambda i: -len(rows[i - 1]))
    for i in several:
        at = np.fromiter(rows[i - 1], np.int64, len(rows[i - 1]))
        for b in rng.integers(0, len(packed) - width, 40).tolist():
            if (packed[b + at] < 0).all():
                break
        else:
            b = len(packed) - width
            packed = np.concatenate([packed, np.full(len(packed) // 2 + width, -1 << 32, np.int64)])
        base[i] = b
        packed[b + at] = state_of(i, rows[i - 1])
    single = [i for i, r in enumerate(rows, 1) if len(r) == 1]
    free = np.flatnonzero(packed[width:] < 0)[: len(single)] + width
    if len(free) < len(single):
        more = np.arange(len(packed), len(packed) + len(single) - len(free))
        packed = np.concatenate([packed, np.full(len(more) + width, -1 << 32, np.int64)])
        free = np.concatenate([free, more])
    if single:
        symbol, to = (np.array(x, np.int64) for x in zip(*[next(iter(rows[i - 1].items())) for i in single]))
        base[single] = free - symbol
        packed[free] = (np.array(single, np.int64) << 32) | to
    return base, np.concatenate([packed, np.full(width, -1 << 32, np.int64)])


def train(samples: dict[str, str]) -> Model:
    """Fit on one text per language; languages without a letter are left out."""
    folded = {k: x for k in sorted(samples) if len(x := _fold(samples[k]))}
    kinds = np.unique(np.concatenate(list(folded.values()))) if folded else np.zeros(0, np.uint32)
    symbols = {int(k): i + 1 for i, k in enumerate(kinds)}
    rows: list[dict[int, int]] = []
    roots = []
    for points in folded.values():
        at = len(rows) + 1
        roots.append(at)
        rows += [{c: to + at for c, to in row.items()} for row in suffix_automaton(np.searchsorted(kinds, points) + 1)]
    bits = np.array([np.log2(len(x) + 1) for x in folded.values()])
    return Model(list(folded), symbols, *_placed(rows, len(symbols) + 1), np.array(roots, np.int64), bits)


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit on the whole texts of sample_rows labelled rows of each language at most.

    Rows are taken in the order of their texts' hashes, long ones last; of those only a share, set by
    the number of different texts of a language, is ordered. So the sample is the same for any order
    and partitioning of rows, copies count once, and no more rows reach the driver. Rows without a
    language or a text are passed over; none left: a model that knows no language.
    """
    seed = F.xxhash64("text")
    rows = docs.where(F.col(lang).isNotNull() & (F.length(text) > 0)).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    totals = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.approx_count_distinct(seed).alias("n")).collect()}
    if not totals:
        return train({})
    share = F.create_map(*[F.lit(x) for k, n in totals.items() for x in (k, min(1.0, 4 * sample_rows / n))])
    low = seed.bitwiseAND(F.lit(0xFFFFFF))
    drawn = rows.where(low / F.lit(0x1000000) < share[F.col("lang")]).select("lang", "text", low.alias("seed")).distinct()
    order = Window.partitionBy("lang").orderBy(F.length("text") > LONG_ROW, "seed", "text")
    found: dict[str, list[str]] = {}
    for r in drawn.withColumn("n", F.row_number().over(order)).where(F.col("n") <= sample_rows).collect():
        found.setdefault(r["lang"], []).append(r["text"])
    return train({k: "\n".join(sorted(v)) for k, v in found.items()})


def parse_costs(model: Model, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Phrases that each language needs for each text, and the number of symbols of each text."""
    kinds = np.array(list(model.symbols), np.uint32)
    folded = [_fold(t) if t else np.zeros(0, np.uint32) for t in texts]
    sizes = np.array([len(x) for x in folded], np.int64)
    counts = np.zeros((len(texts), len(model.langs)), np.int64)
    if not sizes.sum() or not len(kinds):
        return counts, sizes
    points = np.concatenate(folded)
    at = np.minimum(np.searchsorted(kinds, points), len(kinds) - 1)
    codes = np.where(kinds[at] == points, at + 1, 0).astype(np.int32)
    per = -(-sizes // BLOCK)
    owner = np.repeat(np.arange(len(texts)), per)
    inner = np.arange(len(owner)) - np.repeat(np.cumsum(per) - per, per)
    start = (np.cumsum(sizes) - sizes)[owner] + inner * BLOCK
    length = np.minimum(sizes[owner] - inner * BLOCK, BLOCK)
    langs = len(model.langs)
    for first in range(0, len(owner), WIDTH):
        # whole texts only: a lot runs up to the end of the text that its last block is of
        lo = int(np.searchsorted(owner, owner[first])) if first else 0
        hi = len(owner) if first + WIDTH >= len(owner) else int(np.searchsorted(owner, owner[first + WIDTH]))
        if lo < hi:
            _parse_lot(model, codes, start[lo:hi], length[lo:hi], inner[lo:hi], owner[lo:hi], counts[:, :langs])
    return counts, sizes


def _parse_lot(model: Model, codes: np.ndarray, start: np.ndarray, length: np.ndarray, inner: np.ndarray, owner: np.ndarray, counts: np.ndarray) -> None:
    """Add the phrases of whole texts, given by their blocks, to counts.

    Every block is parsed as if a phrase began with it. Then a block that is not its text's first
    is parsed on from the state in which the one before ends, until a phrase begins where one did
    before: from there on both agree. Where they never do, its own end changes and the next block
    is taken up again. The outcome is that of one parse of the whole text.
    """
    roots = model.roots
    langs, blocks = len(roots), len(start)
    opening = model.step(roots[:, None], np.arange(len(model.symbols) + 1)[None, :])  # where a phrase's first symbol leads
    begins = np.zeros((langs, BLOCK, blocks), bool)
    final = np.zeros((langs, blocks), np.int64)
    order = np.argsort(-length, kind="stable")
    s, n = start[order], length[order]
    active = np.searchsorted(-n, -np.arange(n[0]), side="left")
    state = np.zeros((langs, blocks), np.int64)
    for t in range(int(n[0])):
        k = int(active[t])
        sym = codes[s[:k] + t]
        to = model.step(state[:, :k], sym)
        miss = to == 0
        begins[:, t, :k] = miss
        # after a symbol that a language lacks a phrase begins anyway
        state[:, :k] = np.where(miss, opening[:, sym], to)
    final[:, order] = state
    begins[:, :, order] = begins.copy()
    plain = final.copy()
    total = begins.sum(axis=1, dtype=np.int64)
    shift = np.zeros_like(total)
    lang, block = (x.ravel() for x in np.meshgrid(np.arange(langs), np.flatnonzero(inner > 0), indexing="ij"))
    entered = np.zeros((langs, blocks), np.int64)
    while len(block):
        state = final[lang, block - 1]
        fresh = state != entered[lang, block]
        lang, block, state = lang[fresh], block[fresh], state[fresh]
        entered[lang, block] = state
        shift[lang, block] = 0
        seen = np.zeros(len(block), np.int64)
        changed = []
        for t in range(BLOCK):
            over = t >= length[block]
            if over.any():
                shift[lang[over], block[over]] = seen[over]
                moved = over & (final[lang, block] != state)
                final[lang[moved], block[moved]] = state[moved]
                changed.append((lang[moved], block[moved]))
                lang, block, state, seen = lang[~over], block[~over], state[~over], seen[~over]
            if not len(block):
                break
            sym = codes[start[block] + t]
            to = model.step(state, sym)
            miss = to == 0
            was = begins[lang, t, block]
            seen += miss.astype(np.int64) - was
            met = miss & was
            shift[lang[met], block[met]] = seen[met]
            back = met & (final[lang, block] != plain[lang, block])
            if back.any():
                final[lang[back], block[back]] = plain[lang[back], block[back]]
                changed.append((lang[back], block[back]))
            state = np.where(miss, opening[lang, sym], to)
            lang, block, state, seen = lang[~met], block[~met], state[~met], seen[~met]
        else:
            shift[lang, block] = seen
            moved = final[lang, block] != state
            final[lang[moved], block[moved]] = state[moved]
            changed.append((lang[moved], block[moved]))
        lang, block = (np.concatenate([c[i] for c in changed]) if changed else np.zeros(0, np.int64) for i in (0, 1))
        block = block + 1
        on = block < blocks
        lang, block = lang[on], block[on]
        on = inner[block] > 0
        lang, block = lang[on], block[on]
    for j in range(langs):
        np.add.at(counts[:, j], owner, total[j] + shift[j])


def identify(model: Model, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, score and bits a symbol for each text.

    Cost: phrases times log2 of the sample's length, a symbol. Least cost wins, the first name on
    a tie. Score: how far the next language's cost lies above it, as a share; 1 for a model of one language.
    """
    counts, sizes = parse_costs(model, texts)
    names, scores, bits = ["und"] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
    if not model.langs:
        return names, scores, bits
    cost = counts * model.bits / np.maximum(sizes, 1)[:, None]
    best = cost.argmin(axis=1)
    ranked = np.sort(cost, axis=1)
    for i in np.flatnonzero(sizes):
        names[i] = model.langs[best[i]]
        bits[i] = ranked[i, 0]
        scores[i] = 1 - ranked[i, 0] / ranked[i, 1] if len(model.langs) > 1 else 1.0
    return names, np.clip(scores, 0, 1), bits


def detect_language(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add lang_pred, score and lang_bits to each row, by its whole text.

    A null or empty text and one without a letter gets 'und', score 0. Repeated rows get the same
    result each; other columns pass through, those of the three names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, bits double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            found = [identify(shared.value, part) for part in by_size(texts)]
            names, scores, bits = ([x for part in column for x in part] for column in zip(*found)) if found else ([], [], [])
            yield pd.DataFrame({"lang_pred": names, "score": scores, "bits": bits})

    found = docs.withColumn("_lang", run(F.col(text)))
    return found.withColumns({"lang_pred": F.col("_lang.lang_pred"), "score": F.col("_lang.score"), "lang_bits": F.col("_lang.bits")}).drop("_lang")
