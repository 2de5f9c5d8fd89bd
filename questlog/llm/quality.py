"""Quality classifier: a convolutional network over bytes, in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from questlog.llm.common import by_size

#: Bytes of a filter, filters, and bytes of a chunk; neighbouring chunks share WIDTH - 1 bytes, so
#: every position of a filter lies in one chunk.
WIDTH = 6
FILTERS = 16
CHUNK = 512
#: The bound of the fitted sample: labelled rows, whole.
SAMPLE_ROWS = 1600
EPOCHS = 14
_BATCH = 32
#: Chunks whose filters are evaluated at once.
_AT_ONCE = 16


@dataclass(frozen=True)
class Network:
    """taps[j, byte] is what a byte at place j adds to each filter; two dense layers follow."""

    taps: np.ndarray
    bias: np.ndarray
    weight: np.ndarray
    offset: np.ndarray
    out: np.ndarray
    last: float


def chunks(data: np.ndarray) -> np.ndarray:
    """A row of CHUNK + WIDTH - 1 bytes for each chunk of the whole text; padded by zeros, which
    no text of UTF-8 but one with NUL holds."""
    n = max(1, -(-max(1, len(data) - WIDTH + 1) // CHUNK))
    padded = np.zeros(n * CHUNK + WIDTH - 1, np.uint8)
    padded[: len(data)] = data
    return np.lib.stride_tricks.sliding_window_view(padded, CHUNK + WIDTH - 1)[::CHUNK]


def _pairs(taps: np.ndarray) -> np.ndarray:
    """What two bytes in a row add to each filter, for each even place: half as many look-ups."""
    return np.ascontiguousarray((taps[0::2, :, None] + taps[1::2, None, :]).reshape(WIDTH // 2, 65536, taps.shape[2]))


def _pooled(pairs: np.ndarray, rows: np.ndarray, where: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
    """The largest response of each filter in each chunk, and its place."""
    best = np.empty((len(rows), pairs.shape[2]), np.float32)
    place = np.empty(best.shape, np.int32) if where else None
    total, more = (np.empty((_AT_ONCE * CHUNK, pairs.shape[2]), np.float32) for _ in range(2))
    for lo in range(0, len(rows), _AT_ONCE):
        part = rows[lo : lo + _AT_ONCE].astype(np.intp)
        code = part[:, :-1] * 256 + part[:, 1:]
        n = len(part) * CHUNK
        np.take(pairs[0], code[:, :CHUNK].ravel(), axis=0, out=total[:n], mode="clip")
        for j in range(1, WIDTH // 2):
            np.take(pairs[j], code[:, 2 * j : 2 * j + CHUNK].ravel(), axis=0, out=more[:n], mode="clip")
            np.add(total[:n], more[:n], out=total[:n])
        shaped = total[:n].reshape(len(part), CHUNK, -1)
        best[lo : lo + len(part)] = shaped.max(axis=1)
        if place is not None:
            place[lo : lo + len(part)] = shaped.argmax(axis=1)
    return best, place


def _combine(net: Network, pooled: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, ...]:
    """From chunks to documents: mean and maximum of the activations over a document's chunks."""
    act = np.tanh(pooled + net.bias)
    start = np.searchsorted(owner, np.arange(n))
    mean = np.add.reduceat(act, start, axis=0) / np.bincount(owner, minlength=n)[:, None]
    top = np.maximum.reduceat(act, start, axis=0)
    x = np.concatenate([mean, top], axis=1)
    hidden = np.tanh(x @ net.weight + net.offset)
    return act, x, hidden, 1 / (1 + np.exp(-(hidden @ net.out + net.last)))


def score(net: Network, texts: list[str | None]) -> np.ndarray:
    """The probability of quality 1 for each whole text; a missing or empty one is one padded chunk."""
    rows = [chunks(np.frombuffer((t or "").encode("utf-8", "replace"), np.uint8)) for t in texts]
    if not rows:
        return np.zeros(0)
    pairs = _pairs(net.taps)
    pooled = np.concatenate([_pooled(pairs, r)[0] for r in _grouped(rows)])
    return _combine(net, pooled, np.repeat(np.arange(len(rows)), [len(r) for r in rows]), len(rows))[3].astype(np.float64)


def _grouped(rows: list[np.ndarray]) -> Iterator[np.ndarray]:
    """The same chunks in larger arrays."""
    held, n = [], 0
    for r in rows:
        held.append(r)
        n += len(r)
        if n >= 64 * _AT_ONCE:
            yield np.concatenate(held)
            held, n = [], 0
    if held:
        yield np.concatenate(held)


def train(samples: list[tuple[str, int]], seed: int = 7) -> Network:
    """Fit by Adam on the log loss; only the place of each maximum gets a gradient."""
    rng = np.random.default_rng(seed)
    net = {
        "taps": rng.normal(0, 0.15, (WIDTH, 256, FILTERS)).astype(np.float32), "bias": np.zeros(FILTERS, np.float32) - 0.8,
        "weight": rng.normal(0, 0.3, (2 * FILTERS, 16)).astype(np.float32), "offset": np.zeros(16, np.float32),
        "out": rng.normal(0, 0.3, 16).astype(np.float32), "last": np.zeros((), np.float32),
    }
    net["taps"][:, 0] = 0
    data = [(chunks(np.frombuffer(t.encode("utf-8", "replace"), np.uint8)), y) for t, y in samples]
    one, two = ({k: np.zeros_like(v) for k, v in net.items()} for _ in range(2))
    share = np.array([y for _, y in data], np.float32).mean() if data else 0.5
    balance = {1: 0.5 / max(share, 1e-3), 0: 0.5 / max(1 - share, 1e-3)}
    step = 0
    for epoch in range(EPOCHS if 0 < share < 1 else 0):
        order = rng.permutation(len(data))
        rate = 0.01 * (1 - epoch / EPOCHS) + 0.0005
        for lo in range(0, len(order), _BATCH):
            picked = [data[i] for i in order[lo : lo + _BATCH]]
            n = len(picked)
            y = np.array([t for _, t in picked], np.float32)
            owner = np.repeat(np.arange(n), [len(r) for r, _ in picked])
            rows = np.concatenate([r for r, _ in picked])
            pooled, place = _pooled(_pairs(net["taps"]), rows, True)
            now = Network(**{**net, "last": float(net["last"])})
            act, x, hidden, p = _combine(now, pooled, owner, n)
            d = (p - y) * np.where(y == 1, balance[1], balance[0]) / n
            g = {"last": d.sum(), "out": hidden.T @ d}
            dh = d[:, None] * net["out"] * (1 - hidden**2)
            g["weight"], g["offset"] = x.T @ dh, dh.sum(axis=0)
            dx = dh @ net["weight"].T
            size = np.bincount(owner, minlength=n)[owner][:, None]
            mine = dx[:, :FILTERS][owner] / size + np.where(act == x[:, FILTERS:][owner], dx[:, FILTERS:][owner], 0)
            dp = (mine * (1 - act**2)).astype(np.float32)
            g["bias"] = dp.sum(axis=0)
            g["taps"] = np.zeros_like(net["taps"])
            k = np.arange(FILTERS)
            for j in range(WIDTH):
                np.add.at(g["taps"][j], (np.take_along_axis(rows, place + j, axis=1), k[None, :]), dp)
            step += 1
            for name, value in net.items():
                grad = np.asarray(g[name], np.float32) + 1e-4 * value
                one[name] = 0.9 * one[name] + 0.1 * grad
                two[name] = 0.99 * two[name] + 0.01 * grad**2
                net[name] = (value - rate * (one[name] / (1 - 0.9**step)) / (np.sqrt(two[name] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
    if not 0 < share < 1:  # one label, or none, to learn from
        net["out"][:] = 0
        net["last"] = np.float32(0 if not data else 4 * (2 * share - 1))
    return Network(**{**net, "last": float(net["last"])})


def fit(labelled: DataFrame, text: str = "text", label: str = "label") -> Network:
    """Fit on the whole texts of a sample of SAMPLE_ROWS labelled rows, those whose texts have the
    least hashes; no more reaches the driver. Null labels and texts are left out; a text that is
    there twice counts once for each label. The sample is the same for any order of rows."""
    rows = labelled.where(F.col(label).isNotNull() & F.col(text).isNotNull()).select(F.col(text).alias("text"), F.col(label).cast("int").alias("label"))
    total = rows.count()
    seed = F.xxhash64("text").bitwiseAND(F.lit(0x7FFFFFFF))
    drawn = rows.where(seed / F.lit(0x80000000) < min(1.0, 2 * SAMPLE_ROWS / max(1, total))).distinct()
    found = drawn.orderBy(seed, "text", "label").limit(SAMPLE_ROWS).collect()
    return train(sorted((r["text"], r["label"]) for r in found))


def classify(docs: DataFrame, net: Network, text: str = "text", least: float = 0.7) -> DataFrame:
    """Add score (0 to 1) and predicted (1 from least on) by each row's whole text.

    A null or empty text is scored as one padded chunk. Repeated rows get equal scores; other
    columns pass through, those of the two names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(net)

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            found = [score(shared.value, part) for part in by_size(texts, 1 << 20)]
            yield pd.Series(np.concatenate(found) if found else np.zeros(0))

    scored = docs.withColumn("score", run(F.col(text)))
    return scored.withColumn("predicted", F.when(F.col("score") >= least, 1).otherwise(0))
