"""Quality by a small convolutional network over bytes, in numpy.

A text's bytes become vectors (learned, plus one channel that marks bytes which
repeat what stood up to ``LAGS`` bytes before for a while).  Learned filters read
overlapping chunks of ``CHUNK`` bytes, one every ``STEP`` bytes from the first to
the last byte; each filter's largest answer over the whole text goes through
tanh, and a weighted sum of them is the log-odds.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, texts, with_columns
from .learning import chance, labelled, sigmoid

CHUNK = 12
STEP = 4
FILTERS = 16
WIDTH = 7
LAGS = 32
#: A byte counts as repeated when it ends a run of so many bytes equal to those one lag before.
RUN = 16
BLOCK_BYTES = 1 << 19
#: Learning documents of each label, and bytes of their texts together.
MAX_DOCS = 2000
MAX_BYTES = 16 << 20
STEPS = 800
BATCH = 32
RATE = 0.01
SEED = 7


def repeats(data: np.ndarray) -> np.ndarray:
    """Bytes that end a run of ``RUN`` bytes equal to those some lag before."""
    out = np.zeros(len(data), bool)
    for lag in range(1, min(LAGS, len(data) - RUN) + 1):
        same = data[lag:] == data[:-lag]
        step = 1
        while step < RUN:
            same = same[step:] & same[:-step]
            step *= 2
        out[lag + RUN - 1 :] |= same
    return out


def padded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts from multiples of ``STEP`` on, so far apart that no chunk or lag reaches the next.

    Also the first chunk of each text and the one after its last, by turns.
    """
    sizes = np.diff(offsets)
    chunks = np.maximum(-(-sizes // STEP), 1)
    room = (chunks + -(-max(CHUNK, LAGS) // STEP)) * STEP
    low = np.cumsum(room) - room
    out = np.zeros(room.sum(), np.uint8)
    out[np.arange(len(data)) + np.repeat(low - offsets[:-1], sizes)] = data
    return out, np.stack([low // STEP, low // STEP + chunks], axis=1).ravel()


class Network:
    """Byte vectors, filters and output weights."""

    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.vectors = rng.normal(0, 0.5, (256, WIDTH)).astype(np.float32)
        self.vectors[0] = 0
        self.filters = rng.normal(0, 0.15, (CHUNK * (WIDTH + 1), FILTERS)).astype(np.float32)
        self.bias = np.zeros(FILTERS, np.float32)
        self.out = rng.normal(0, 0.3, FILTERS).astype(np.float32)
        self.base = np.zeros(1, np.float32)
        self.prior = 0.0

    def chunks(self, data: np.ndarray) -> np.ndarray:
        """The vectors of each chunk, side by side."""
        x = np.empty((len(data), WIDTH + 1), np.float32)
        x[:, :WIDTH] = self.vectors[data]
        x[:, WIDTH] = repeats(data) & (data > 0)
        n = (len(data) - CHUNK) // STEP + 1
        shape, strides = (n, CHUNK * (WIDTH + 1)), (STEP * (WIDTH + 1) * 4, 4)
        return np.lib.stride_tricks.as_strided(x, shape, strides)

    def answers(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Each filter's largest answer over each text."""
        return np.maximum.reduceat(self.chunks(data) @ self.filters, bounds, axis=0)[::2] + self.bias

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The probability of label 1 of each text."""
        if len(offsets) < 2:
            return np.zeros(0)
        data, bounds = padded(data, offsets)
        return sigmoid(np.tanh(self.answers(data, bounds)) @ self.out + self.base + self.prior).astype(np.float64)

    def learn(self, rows: list[bytes], labels: np.ndarray, steps: int = STEPS, seed: int = SEED) -> None:
        """Adam steps on the log-loss; the largest answers alone pass the slope back."""
        rng = np.random.default_rng(seed)
        parameters = [self.vectors, self.filters, self.bias, self.out, self.base]
        first, second = ([np.zeros_like(p) for p in parameters] for _ in range(2))
        # Both labels weigh the same.
        share = labels.mean()
        weight = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)
        step = 0
        while step < steps:
            order = rng.permutation(len(rows))
            for batch in np.array_split(order, max(1, len(order) // BATCH)):
                rate = RATE * max(0.02, 1 - step / steps)
                own = [rows[i] for i in batch]
                flat = np.frombuffer(b"".join(own), np.uint8)
                data, bounds = padded(flat, np.concatenate(([0], np.cumsum([len(x) for x in own]))))
                x = self.chunks(data)
                y = x @ self.filters
                best = np.stack([a + y[a:b].argmax(0) for a, b in bounds.reshape(-1, 2)])
                hidden = np.tanh(y[best, np.arange(FILTERS)] + self.bias)
                error = (sigmoid(hidden @ self.out + self.base) - labels[batch]) * weight[batch] / len(batch)
                back = error[:, None] * self.out * (1 - hidden**2)
                picked = x[best.ravel()].reshape(len(batch), FILTERS, -1)
                slopes = [np.zeros_like(p) for p in parameters]
                slopes[1] = np.einsum("df,dfx->xf", back, picked)
                slopes[2] = back.sum(0)
                slopes[3] = error @ hidden
                slopes[4][0] = error.sum()
                # Through the filters to the vectors of the bytes in the picked chunks.
                into = back[:, :, None] * self.filters.T[None]
                places = (best * STEP)[:, :, None] + np.arange(CHUNK)
                np.add.at(slopes[0], data[places].ravel(), into.reshape(-1, WIDTH + 1)[:, :WIDTH])
                slopes[0][0] = 0
                step += 1
                for p, g, m, v in zip(parameters, slopes, first, second, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.01 * (g * g - v)
                    p -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)).astype(np.float32)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text_col: str = "text", max_docs: int = MAX_DOCS, max_bytes: int = MAX_BYTES) -> Network:
    """A network for label 1, from about ``max_docs`` learning documents of each label and ``max_bytes`` of text at most.

    Without rows of both labels every score is the share of label 1.
    """
    sample, share = labelled(docs, labels, label, max_docs, id_col, text_col)
    size = sample.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    # A bounded sample: it is the driver that learns.
    rows = sample.where(chance(F.col("id"), 13) < min(1.0, max_bytes / max(1, size))).orderBy("id").collect()
    y = np.array([r["label"] for r in rows], np.float32)
    network = Network()
    odds = np.log(max(share, 1e-6) / max(1 - share, 1e-6))
    if not 0 < y.sum() < len(y):
        network.out[:], network.prior = 0, odds
        return network
    network.learn([r["text"].encode("utf-8", "surrogatepass") for r in rows], y)
    network.prior = odds
    return network


def score(docs: DataFrame, network: Network, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the double ``out`` in [0, 1]: how likely label 1 is.

    A null text is the empty text, which is scored as any other.  A column
    called ``out`` is replaced; all other columns and rows stay.
    """
    sent = docs.sparkSession.sparkContext.broadcast(network)

    def work(column):
        data, offsets = texts(column)
        found = [np.zeros(0)]
        for low, high in blocks(offsets, BLOCK_BYTES):
            at = offsets[low : high + 1]
            found.append(sent.value(data[at[0] : at[-1]], at - at[0]))
        return [pa.array(np.concatenate(found))]

    return with_columns(docs, [text_col], work, f"`{out}` double")
