"""What the two learned scorers share: the fold, labelled rows, logistic regression."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pin
from .phrases import in_map, slot_map

#: Bits of the map of labelled ids: 2**24 are 2 MB.
SLOTS = 1 << 24


def held_out(doc_id) -> F.Column:
    """Whether a row belongs to the fold that no model learns from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def chance(column, seed: int) -> F.Column:
    """A number in [0, 1) that depends on the value only."""
    return F.pmod(F.xxhash64(F.lit(seed), column), F.lit(1 << 30)) / float(1 << 30)


def _known(labels: DataFrame, label: str, id_col: str) -> tuple[DataFrame, dict[int, int]]:
    """(id, label) of the rows to learn from, and how many have each label.

    Labels other than 0 and 1, null ids and held-out ones do not count; of
    repeated labels the largest counts.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(F.col(id_col))).groupBy(F.col(id_col).alias("id")).agg(F.max(label).cast("int").alias("label"))
    return known, {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}


def _share(sizes: dict[int, int]) -> float:
    total = sum(sizes.values())
    return sizes.get(1, 0) / total if total else 0.0


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def labelled(docs: DataFrame, labels: DataFrame, label: str, max_docs: int, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, float]:
    """(id, text, label) of about ``max_docs`` documents of each label at most, never held-out ones; the share of label 1.

    Documents are drawn by a hash of their id, all of them where there are fewer.
    """
    known, sizes = _known(labels, label, id_col)
    part = [min(1.0, max_docs / sizes.get(i, 1)) for i in (0, 1)]
    # About 2 * max_docs rows, so this side is small at any input size.
    drawn = known.where(chance(F.col("id"), 11) < F.when(F.col("label") == 1, part[1]).otherwise(part[0]))
    return pin(_rows(docs, id_col, text_col).join(F.broadcast(drawn), "id")), _share(sizes)


def all_labelled(docs: DataFrame, labels: DataFrame, label: str, part: Column, id_col: str = "doc_id", text_col: str = "text", slots: int = SLOTS) -> tuple[DataFrame, DataFrame, float]:
    """(id, text, label) of every labelled document that is not held out: those in ``part``, a condition on ``id``, and the others; the share of label 1.

    A bit map of fixed size keeps most texts without a label out of the join;
    the join alone decides.  It is the same at any size: the ids grow with the
    texts, so they are not broadcast.
    """
    known, sizes = _known(labels, label, id_col)
    rows = _rows(docs, id_col, text_col).where(~held_out(F.col("id")))
    if rows.schema["id"].dataType == known.schema["id"].dataType:
        bits = slot_map(known.select(F.xxhash64("id").alias("hash")), slots, 1)
        rows = rows.where(in_map(bits, slots, F.xxhash64("id")))
    return rows.where(part).join(known.where(part).hint("merge"), "id"), rows.where(~part).join(known.where(~part).hint("merge"), "id"), _share(sizes)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Logistic:
    """Regression on standardised features, by Newton steps with a small ridge; Spark sums up each step over all rows."""

    def __init__(self, rows: DataFrame, ridge: float = 1e-2, steps: int = 25):
        """``rows``: the array ``evidence`` and ``label`` 0 or 1; they are read once a step."""
        found = totals(rows, lambda x, y: np.concatenate(([len(x)], x.sum(0), (x * x).sum(0))))
        width = len(found) // 2
        n, x, xx = found[0], found[1 : width + 1], found[width + 1 :]
        self.mean = x / n
        self.scale = np.sqrt(np.maximum(xx / n - self.mean**2, 0)) + 1e-6
        self.weights = np.zeros(width + 1)
        for _ in range(steps):
            found = totals(rows, self._slopes)
            slope = found[: width + 1] + ridge * self.weights
            curve = found[width + 1 :].reshape(width + 1, -1) + ridge * np.eye(width + 1)
            step = np.linalg.solve(curve, slope)
            step /= max(1.0, np.abs(step).max() / 4)
            self.weights = self.weights - step
            if np.abs(step).max() < 1e-9:
                break

    def _z(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([np.ones((len(x), 1)), (x - self.mean) / self.scale], axis=1)

    def _slopes(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        z, p = self._z(x), self(x)
        return np.concatenate([z.T @ (p - y), ((z * (p * (1 - p))[:, None]).T @ z).ravel()])

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self._z(x) @ self.weights)


def totals(rows: DataFrame, work) -> np.ndarray:
    """The sum of ``work(evidence, label)``, an array of fixed size, over all batches of ``rows``."""

    def run(batches):
        out = 0
        for batch in batches:
            if batch.num_rows:
                y = batch.column(1).to_numpy()
                out = out + work(batch.column(0).flatten().to_numpy().reshape(len(y), -1), y)
        if not np.isscalar(out):
            yield pa.RecordBatch.from_arrays([pa.array([out.tolist()], pa.list_(pa.float64()))], ["sums"])

    parts = rows.select("evidence", "label").mapInArrow(run, "sums array<double>")
    # One short row a task.
    return sum(np.array(r["sums"]) for r in parts.collect())
