"""Language-model scores by logistic mixing of context bit predictors, and by word counts."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BooleanType, DoubleType, LongType, StructField, StructType

from questlog.llm.common import by_size, cut, release
from questlog.llm.winnow import Words

#: Bytes and one end of text.
SYMBOLS = 257
END = 256
#: Preceding bytes that the counted predictors see; one more sees a single byte, the last one is the text's own.
ORDERS = (2, 4)
#: Bytes of text in a block: its words and contexts look their counts up together.
BLOCK_BYTES = 24 << 20
#: Characters whose symbols and contexts are laid out at once, to be scored and to be counted.
PART, COUNT_PART = 2 << 20, 2 << 20
#: Bits of a preceding byte and symbol, of a node, and of a cell (the bytes before that, and a node).
_KEY_BITS, _NODE_BITS = 17, 16
_CELL_BITS = 8 * (max(ORDERS) - 1) + _NODE_BITS
#: Bits of a piece of text, through which weights, counts of its own and the refinement are carried.
SEGMENT = 4096
#: Segments mixed side by side, and steps whose inputs are fetched at once.
STREAMS = 6144
STEPS = 32
#: Learning rates of the weights, of a text's own contexts and of the refinement.
RATE, OWN_RATE, FINE_RATE = 0.02, 0.8, 0.02
#: First weights: of the longest context that has been seen, and of the others.
FIRST, OTHER = 0.6, 0.2
#: Log2 of the slots of a text's own hashed contexts; the largest log odds, which the refinement's curve covers by halves.
OWN_BITS, CURVE = 10, 8
_SPACE = np.ones(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = False
#: In place of a block: counts of a byte and the symbol after it, and of ends of texts, travel with the words.
_PAIRS, _ENDS = -1, -2


@dataclass(frozen=True)
class Code:
    """A binary tree of symbols for each preceding byte; the way to each symbol, laid out flat.

    The way of symbol s after byte p is at[p * SYMBOLS + s] .. + length: packed holds, for each
    step, the node's 16 bits (a number of its own among all trees) and the bit taken there."""

    at: np.ndarray
    length: np.ndarray
    packed: np.ndarray

    @property
    def node(self) -> np.ndarray:
        return self.packed & 0xFFFF

    @property
    def bit(self) -> np.ndarray:
        return self.packed >> 16


def build_code(pairs: np.ndarray) -> Code:
    """Huffman trees from counts of (preceding byte, symbol); every symbol has a way."""
    at, length = np.zeros(256 * SYMBOLS, np.int64), np.zeros(256 * SYMBOLS, np.int64)
    nodes: list[int] = []
    bits: list[int] = []
    for p in range(256):
        counts = pairs[p * SYMBOLS : (p + 1) * SYMBOLS]
        heap = [(int(c) * SYMBOLS + 1, s) for s, c in enumerate(counts.tolist())]
        heapq.heapify(heap)
        parent: dict[int, tuple[int, int]] = {}
        new = SYMBOLS
        while len(heap) > 1:
            a, b = heapq.heappop(heap), heapq.heappop(heap)
            parent[a[1]], parent[b[1]] = (new, 0), (new, 1)
            heapq.heappush(heap, (a[0] + b[0], new))
            new += 1
        for s in range(SYMBOLS):
            way = []
            x = s
            while x in parent:
                x, b = parent[x]
                way.append((p * 256 + x - SYMBOLS, b))
            at[p * SYMBOLS + s], length[p * SYMBOLS + s] = len(nodes), len(way)
            nodes += [n for n, _ in reversed(way)]
            bits += [b for _, b in reversed(way)]
    return Code(at.astype(np.int32), length.astype(np.int32), np.array(nodes, np.int32) | np.array(bits, np.int32) << 16)


def _symbols(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each text's symbols begin; for all symbols, one text after the other, the key of the
    preceding byte and the symbol, and a number made of the bytes before that, nearest lowest."""
    depth = max(ORDERS)
    raw = [(t or "").encode("utf-8", "replace") for t in texts]
    ends = np.cumsum(np.array([len(r) + 1 for r in raw], np.int64))
    starts = np.concatenate([[0], ends])
    # zeros in front; the end of a text counts as byte 0 for what follows
    data = np.frombuffer(b"\0".join([bytes(depth - 1), *raw, b""]), np.uint8)
    n = int(starts[-1])
    symbols = data[depth : depth + n].astype(np.int32)
    symbols[ends - 1] = END
    context = np.zeros(n, np.int64)
    for k in range(2, depth + 1):
        back = data[depth - k : depth - k + n].copy()
        for j in range(k):  # nothing of the text before is seen
            at = starts[:-1] + j
            back[at[at < n]] = 0
        for lo in range(0, n, 1 << 18):
            context[lo : lo + (1 << 18)] |= back[lo : lo + (1 << 18)].astype(np.int64) << (8 * (k - 2))
    return starts, data[depth - 1 : depth - 1 + n].astype(np.int32) * SYMBOLS + symbols, context


@dataclass(frozen=True)
class Layout:
    """The steps of the ways of a part's distinct symbols in context, one after the other.

    place: of each symbol of the part, its number among the distinct ones, whose steps are
    first[place] .. first[place + 1]; step: each step as in Code; cells: for each counted
    predictor, each step's context and node in one number, exactly."""

    place: np.ndarray
    first: np.ndarray
    step: np.ndarray
    cells: list[np.ndarray]


def _steps(code: Code, kinds: np.ndarray, place: np.ndarray | None = None) -> Layout:
    """The layout of distinct symbols in context, numbers made of the bytes before and the key."""
    key, seen = kinds & ((1 << _KEY_BITS) - 1), kinds >> _KEY_BITS
    length = code.length[key]
    first = np.concatenate([[0], np.cumsum(length, dtype=np.int64)])
    step = code.packed[np.repeat(code.at[key] - first[:-1], length) + np.arange(first[-1])]
    cells = [np.repeat((seen & ((1 << 8 * (order - 1)) - 1)) << _NODE_BITS, length) | (step & 0xFFFF) for order in ORDERS]
    return Layout(np.arange(len(kinds)) if place is None else place, first, step, cells)


def _layout(code: Code, texts: list[str | None]) -> tuple[np.ndarray, Layout]:
    """Where each text's symbols begin, and the layout of all of them."""
    starts, key, context = _symbols(texts)
    context <<= _KEY_BITS
    context |= key
    del key
    place, kinds = pd.factorize(context)
    del context
    order = np.argsort(kinds)
    back = np.empty(len(order), np.int32)
    back[order] = np.arange(len(order), dtype=np.int32)
    return starts, _steps(code, kinds[order], back.take(place, mode="clip"))


def _stretch(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    return np.log((ones + 0.4) / (zeros + 0.4)).astype(np.float32)


@dataclass(frozen=True)
class Model:
    """first: stretched counts by node; cells: for each counted predictor the sorted cells that are
    known, and known their stretched counts. A cell that is not there is even."""

    code: Code
    first: np.ndarray
    cells: list[np.ndarray] = field(default_factory=lambda: [np.zeros(0, np.int64) for _ in ORDERS])
    known: list[np.ndarray] = field(default_factory=lambda: [np.zeros(0, np.float32) for _ in ORDERS])


def _summed(cells: np.ndarray, zeros: np.ndarray, ones: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct cells in order and the sums of their counts."""
    at, kinds = pd.factorize(cells)
    order = np.argsort(kinds)
    sums = [np.bincount(at, weights=n, minlength=len(kinds)).astype(np.int64)[order] for n in (zeros, ones)]
    return kinds[order], *sums


def context_counts(code: Code, texts: list[str | None], train: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each counted predictor, the distinct cells of all texts in order, and how often a zero
    and a one followed each in training texts."""
    kinds, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    lo = 0
    for part in by_size(texts, COUNT_PART):
        starts, key, context = _symbols(part)
        context <<= _KEY_BITS
        context |= key
        del key
        place, own = pd.factorize(context)
        del context
        learned = np.repeat(train[lo : lo + len(part)], np.diff(starts))
        n = np.bincount(place[learned], minlength=len(own))
        del place, learned
        at, kinds = pd.factorize(np.concatenate([kinds, own]))
        counts = np.bincount(at, weights=np.concatenate([counts, n]), minlength=len(kinds)).astype(np.int64)
        lo += len(part)
    x = _steps(code, kinds)
    n = np.repeat(counts, np.diff(x.first))
    bit = x.step >> 16
    return [_summed(cells, n * (1 - bit), n * bit) for cells in x.cells]


def fit(pairs: np.ndarray) -> tuple[Code, np.ndarray]:
    """The code, and the first predictor's stretched counts by node, from how often each symbol
    follows each byte."""
    code = build_code(pairs)
    nodes = np.zeros((256 * 256, 2), np.int64)
    for k in np.flatnonzero(pairs).tolist():
        way = slice(code.at[k], code.at[k] + code.length[k])
        nodes[code.node[way], code.bit[way]] += pairs[k]
    return code, _stretch(nodes[:, 0], nodes[:, 1])


def _found(kinds: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The value of each wanted kind, 0 where it is not among the sorted kinds."""
    if not len(kinds):
        return np.zeros(len(wanted), values.dtype)
    at = np.minimum(np.searchsorted(kinds, wanted), len(kinds) - 1)
    return np.where(kinds[at] == wanted, values[at], values.dtype.type(0))


def _inputs(model: Model, x: Layout) -> np.ndarray:
    """A record of 16 bytes for each step: three inputs, and in one number the bit taken, the gate
    from the second bit on, and the slot of a text's own counts from the ninth on."""
    out = np.zeros((len(x.step), 4), np.float32)
    out[:, 0] = model.first[x.step & 0xFFFF]
    gate = np.zeros(len(x.step), np.int32)
    for i, (cells, kinds, known) in enumerate(zip(x.cells, model.cells, model.known)):
        if len(kinds):
            at = np.minimum(np.searchsorted(kinds, cells), len(kinds) - 1)
            there = kinds[at] == cells
            out[:, 1 + i] = np.where(there, known[at], np.float32(0))
            gate[there] = i + 1
    own = (x.cells[0].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - OWN_BITS)).astype(np.int32)
    out.view(np.int32)[:, 3] = x.step >> 16 | gate << 1 | own << 8
    return out.view(np.complex128).ravel()


def log10_probability(model: Model, texts: list[str | None]) -> np.ndarray:
    """The log10 of each whole text's probability, its end included.

    Each symbol is coded by the bits of its way in the tree of the byte before, a third of the
    steps that its eight plain bits would take. The predictors' log odds are added with weights that
    a gate, the longest context with counts, chooses. After every bit the weights move along the
    gradient of the coding cost, and so does a predictor of the text's own hashed contexts, which
    starts empty; a curve over the mixed odds refines the outcome by what came of like ones. These
    three start anew with every SEGMENT bits, with the preceding bytes as context, so segments of
    any texts run side by side and a text of any length takes bounded memory. The two branches of a
    node add up to one, and so do all texts.
    """
    starts, x = _layout(model.code, texts)
    records = _inputs(model, x)
    length = np.diff(x.first).astype(np.int32).take(x.place, mode="clip")
    first = np.zeros(len(length) + 1, np.int32)
    np.cumsum(length, out=first[1:])
    way = np.repeat(x.first.astype(np.int32).take(x.place, mode="clip") - first[:-1], length)
    del length, x
    for lo in range(0, len(way), 1 << 20):
        way[lo : lo + (1 << 20)] += np.arange(lo, min(len(way), lo + (1 << 20)), dtype=np.int32)
    base = np.repeat(first[starts[:-1]], np.diff(starts))
    piece = (first[:-1] - base) // np.int32(SEGMENT)
    fresh = np.ones(len(piece), bool)
    fresh[1:] = (piece[1:] != piece[:-1]) | (base[1:] != base[:-1])
    del base, piece
    begin = np.flatnonzero(fresh)
    owner = np.searchsorted(starts, begin, side="right") - 1
    begin = first[begin].astype(np.int64)
    size = np.diff(np.concatenate([begin, first[-1:]]))
    del first
    order = np.argsort(-size, kind="stable")
    cost = np.zeros(len(order))
    for lo in range(0, len(order), STREAMS):
        group = order[lo : lo + STREAMS]
        cost[group] = _mix(records, way, begin[group], size[group])
    return -np.bincount(owner, weights=cost, minlength=len(texts)) / math.log(10)


def _mix(records: np.ndarray, way: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Cost in nats of segments, the longest first: steps way[first] .. + size of each."""
    n, sets = len(size), len(ORDERS) + 1
    lane = np.arange(n)
    begin = np.full((sets, n, 4), OTHER, np.float32)
    for i in range(sets):
        begin[i, :, i] = FIRST
    weights = begin.view(np.complex128).ravel()
    mine = np.zeros(n << OWN_BITS, np.float32)
    points = 4 * CURVE + 1
    curve = np.tile((1 / (1 + np.exp(-(np.arange(points, dtype=np.float32) / 2 - CURVE)))).astype(np.float32), n)
    start, own = lane * points, lane << OWN_BITS
    one, half, two, top, middle = map(np.float32, (1, 0.5, 2, CURVE, 2 * CURVE + 0.5))
    total = np.zeros(n)
    active = np.searchsorted(-size, -np.arange(int(size[0])), side="left")
    for r in range(0, int(size[0]), STEPS):
        rows = min(STEPS, int(size[0]) - r)
        k = int(active[r])
        at = way.take(np.minimum(first[:k] + np.arange(r, r + rows)[:, None], len(way) - 1), mode="clip").astype(np.intp)
        inputs = records.take(at, mode="clip").view(np.float32).reshape(rows, k, 4)
        mark = inputs.view(np.int32)[:, :, 3].astype(np.intp)
        y = (mark & 1).astype(np.float32)
        other = one - y
        chosen = (mark >> 1 & 127) * n + lane[:k]
        slot = (mark >> 8) + own[:k]
        said = np.ones((rows, k), np.float32)
        for i in range(rows):
            k = int(active[r + i])
            x, yi, c, s = inputs[i, :k], y[i, :k], chosen[i, :k], slot[i, :k]
            m = mine.take(s, mode="clip")
            x[:, 3] = m
            taken = weights.take(c, mode="clip")
            w = taken.view(np.float32).reshape(k, 4)
            z = x * w
            d = z[:, 0] + z[:, 1]
            d += z[:, 2]
            d += z[:, 3]
            np.minimum(np.maximum(d, -top, out=d), top, out=d)
            p = one / (one + np.exp(-d))
            d *= two
            d += middle
            low = d.astype(np.intp)
            low += start[:k]
            f = curve.take(low, mode="clip")
            curve[low] = f + (yi - f) * np.float32(FINE_RATE)
            f += p
            f *= half
            np.subtract(f, other[i, :k], out=said[i, :k])
            error = yi - p
            mine[s] = m + error * np.float32(OWN_RATE)
            error *= np.float32(RATE)
            x *= error[:, None]
            w += x
            weights[c] = taken
        total[: said.shape[1]] -= np.log(np.abs(said)).sum(axis=0, dtype=np.float64)
    return total


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows as blocks of about BLOCK_BYTES of text, each one compressed value with a number of its own."""
    number = TaskContext.get().partitionId() << 32
    held: list[pa.RecordBatch] = []
    size = 0

    def block() -> pa.RecordBatch:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, held[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            for part in held:
                out.write_batch(part)
        return pa.RecordBatch.from_pydict({"block": pa.array([number], pa.int64()), "payload": pa.array([sink.getvalue().to_pybytes()], pa.binary())})

    for b in batches:
        ends = np.concatenate([[0], np.cumsum(pc.fill_null(pc.binary_length(b["text"]), 0).to_numpy(zero_copy_only=False).astype(np.int64))])
        lo = 0
        while lo < b.num_rows:
            hi = min(b.num_rows, max(lo + 1, int(np.searchsorted(ends, ends[lo] + BLOCK_BYTES - size))))
            held.append(b.slice(lo, hi - lo))
            size += int(ends[hi] - ends[lo])
            lo = hi
            if size >= BLOCK_BYTES:
                yield block()
                held, size, number = [], 0, number + 1
    if held:
        yield block()


def _unpacked(payload: pa.Scalar) -> tuple[pa.Table, list[str | None], np.ndarray]:
    """The rows of a block without their texts, the texts, and which of them are training texts."""
    rows = pa.ipc.open_stream(payload.as_buffer()).read_all()
    texts = rows["text"].to_pylist()
    rows = rows.drop_columns(["text"])
    release()
    return rows, texts, ~rows["held_out"].to_numpy().astype(bool)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        for i in range(b.num_rows):
            yield b["block"][i].as_py(), *_unpacked(b["payload"][i])


def _word_counts(texts: list[str | None], train: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of words of all texts, and how often each stands in training texts."""
    hashes, counts, at = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
    for part in by_size(texts):
        w = Words(part, _SPACE)
        place, kinds = pd.factorize(w.hash.view(np.int64))
        hashes.append(kinds)
        counts.append(np.bincount(place[train[w.of + at]], minlength=len(kinds)))
        at += len(part)
    place, kinds = pd.factorize(np.concatenate(hashes))
    return kinds, np.bincount(place, weights=np.concatenate(counts), minlength=len(kinds)).astype(np.int64)


def _word_scores(texts: list[str | None], kinds: np.ndarray, counts: np.ndarray, whole: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each text: words, known words, and the sum of the words' log10 of (count + 0.5) / whole; kinds are sorted."""
    out: list[list[np.ndarray]] = [[], [], []]
    for part in by_size(texts):
        w = Words(part, _SPACE)
        place, own = pd.factorize(w.hash.view(np.int64))
        n = _found(kinds, counts, own)
        for values, weights in zip(out, (None, (n > 0)[place], np.log10((n + 0.5) / whole)[place])):
            values.append(np.bincount(w.of, weights=weights, minlength=len(part)))
    lengths, known, base = (np.concatenate(x) for x in out)
    return lengths, known.astype(np.int64), base


def score_texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", held_out: str = "held_out") -> DataFrame:
    """One row for each row of docs: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Everything is learned from the whole texts of rows that are not held out. Tokens are runs
    without ASCII white space, letters A-Z lowered, and one end for each text; base_score adds up
    log10 of (count + 0.5) / (N + 0.5 (V + 1)). score is the mixing model's log10 probability of
    the text; divided by the number of bytes and log10(2) it gives bits per byte. Null texts count
    as empty, a null held_out as false; repeated rows count and are scored each. With no training
    text all counts are zero and every bit is even to begin with. An empty table gives no rows.

    The rows are written once as blocks of bounded size. A block sends each of its words and of its
    contexts once, and gets back what all training texts have of them. So what is counted grows with
    the corpus, and no table of all of it is held anywhere; a very common word has one row a block.
    Contexts are known exactly, words by 64-bit hashes.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.coalesce(held_out, F.lit(False)).alias("held_out"))
    blocks = cut(rows.mapInArrow(_pack, "block long, payload binary"), {"parquet.page.row.count.limit": "1"})

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = np.zeros(256 * SYMBOLS, np.int64)
        ends = 0

        def counts(block: int, h: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"block": np.full(len(h), block, np.int64), "h": h.astype(np.int64), "n": n.astype(np.int64)})

        for block, _, texts, train in _blocks(batches):
            yield counts(block, *_word_counts(texts, train))
            ends += int(train.sum())
            for part in by_size([t for t, learned in zip(texts, train) if learned], COUNT_PART):
                pairs += np.bincount(_symbols(part)[1], minlength=len(pairs))
        k = np.flatnonzero(pairs)
        yield counts(_PAIRS, k, pairs[k])
        yield counts(_ENDS, np.zeros(1), np.full(1, ends))

    seen = Observation()
    word = F.col("block") >= 0
    by_word = Window.partitionBy("h", word)
    counted = (
        blocks.mapInArrow(gather, "block long, h long, n long")
        .withColumns({"c": F.sum("n").over(by_word), "first": F.row_number().over(by_word.orderBy("block")) == 1})
        .observe(
            seen, F.coalesce(F.sum(F.when(word | (F.col("block") == _ENDS), F.col("n"))), F.lit(0)).alias("tokens"),
            F.coalesce(F.sum(F.when(F.col("block") == _ENDS, F.col("n"))), F.lit(0)).alias("ends"), F.count_if(word & F.col("first") & (F.col("c") > 0)).alias("kinds"),
        )
    )
    counts = cut(counted.where((word & (F.col("c") > 0)) | (F.col("block") == _PAIRS)).select("block", "h", "n", "c"))
    tokens, ends, distinct = seen.get["tokens"], seen.get["ends"], seen.get["kinds"]
    distinct += ends > 0
    pairs = np.zeros(256 * SYMBOLS, np.int64)
    for r in counts.where(~word).groupBy("h").agg(F.sum("n").alias("c")).collect():
        pairs[r["h"]] = r["c"]
    model = docs.sparkSession.sparkContext.broadcast(fit(pairs))

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, _, texts, train in _blocks(batches):
            for i, (cells, zeros, ones) in enumerate(context_counts(model.value[0], texts, train)):
                yield pa.RecordBatch.from_pydict({"block": np.full(len(cells), block, np.int64), "h": cells | i << _CELL_BITS, "n": zeros, "n1": ones})

    by_cell = Window.partitionBy("h")
    cells = (
        blocks.mapInArrow(contexts, "block long, h long, n long, n1 long")
        .withColumns({"c": F.sum("n").over(by_cell), "c1": F.sum("n1").over(by_cell)})
        .where("c + c1 > 0")
    )
    none = F.lit(0).cast("long")
    totals = counts.where(word).select("block", "h", "c", none.alias("c1"), F.lit(True).alias("word")).unionByName(cells.select("block", "h", "c", "c1", F.lit(False).alias("word")))

    def score(rows: pa.Table, counts: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return schema.empty_table()
        own, texts, _ = _unpacked(rows["payload"][0])
        h, c, c1, word = (counts[k].to_numpy() for k in ("h", "c", "c1", "word"))
        group = np.where(word.astype(bool), -1, h >> _CELL_BITS)
        order = np.lexsort((h, group))
        h, c, c1 = h[order] & np.where(group[order] < 0, -1, (1 << _CELL_BITS) - 1), c[order], c1[order]
        ends_of = np.searchsorted(group[order], np.arange(-1, len(ORDERS) + 1))
        del counts, word, group, order
        code, first = model.value
        found = Model(code, first, *([v[a:b] for a, b in zip(ends_of[1:], ends_of[2:])] for v in (h, _stretch(c, c1))))
        whole = tokens + 0.5 * (distinct + 1)
        lengths, n_known, base = _word_scores(texts, h[: ends_of[1]], c[: ends_of[1]], whole)
        del c, c1
        release()
        return pa.Table.from_arrays([
            own["doc_id"], own["held_out"], pa.array(lengths + 1), pa.array(n_known + (ends > 0)),
            pa.array(np.full(len(texts), tokens, np.int64)), pa.array(base + math.log10((ends + 0.5) / whole)),
            pa.array(np.concatenate([log10_probability(found, p) for p in by_size(texts, PART)])),
        ], names=_RESULT)

    kind = rows.schema["doc_id"].dataType
    schema = to_arrow_schema(StructType([StructField("doc_id", kind), *_NUMBERS]))
    return blocks.groupBy("block").cogroup(totals.groupBy("block")).applyInArrow(score, StructType([StructField("doc_id", kind), *_NUMBERS]))


_NUMBERS = [StructField("held_out", BooleanType()), *[StructField(n, LongType()) for n in ("n_tokens", "n_known", "train_tokens")], StructField("base_score", DoubleType()), StructField("score", DoubleType())]
_RESULT = ["doc_id", *[f.name for f in _NUMBERS]]
