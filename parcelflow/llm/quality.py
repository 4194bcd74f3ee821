"""Operator 6, quality classifier: a byte-level convolutional network in numpy.

Every byte becomes a learned vector; learned filters slide over the bytes; the text is cut
into overlapping chunks of 256 bytes that cover all of it, and each chunk keeps the highest
response of every filter. The mean and the highest of the chunks go through one hidden layer
to one probability. Fitted on a bounded sample of labelled rows (``MOST_ROWS``) on the driver;
every text is scored whole in the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelflow.llm.arrays import flat, slices
from parcelflow.llm.storage import fresh

#: Labelled rows to fit on at most, taken in the order of a hash of the id.
MOST_ROWS = 3000
EMBED, WIDTH, FILTERS, HIDDEN = 6, 6, 16, 16
#: A chunk is eight blocks of 32 bytes and shares one with the next chunk.
BLOCK, BLOCKS, STRIDE = 32, 8, 7
THRESHOLD = 0.3
SLICE_BYTES = 100_000
VISITS = 9_000


class Network:
    """Parameters, forward pass and gradients."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        draw = lambda *shape, s: rng.normal(0, s, shape).astype(np.float32)
        self.p = {
            "embed": draw(256, EMBED, s=0.5),
            "filters": draw(WIDTH * EMBED, FILTERS, s=(WIDTH * EMBED) ** -0.5),
            "shift": np.zeros(FILTERS, np.float32),
            "w1": draw(2 * FILTERS, HIDDEN, s=(2 * FILTERS) ** -0.5),
            "b1": np.zeros(HIDDEN, np.float32),
            "w2": draw(HIDDEN, 1, s=HIDDEN**-0.5),
            "b2": np.zeros(1, np.float32),
        }

    @staticmethod
    def laid_out(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Texts one after the other, each filled up with zero bytes to whole blocks, and
        where each text's blocks begin. The zeros before a text are as many as a window of the
        text before it can reach, so a score never depends on a neighbour."""
        size = np.diff(offsets)
        blocks = -(-(size + WIDTH - 1) // BLOCK)
        first = np.append(0, np.cumsum(blocks))
        out = np.zeros(first[-1] * BLOCK + WIDTH - 1, np.uint8)
        move = np.repeat(first[:-1] * BLOCK + WIDTH - 1 - offsets[:-1], size)
        out[np.arange(len(data)) + move] = data
        return out, first

    def responses(self, padded: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The highest response of every filter in every block, and the byte it begins at."""
        n = len(padded) - WIDTH + 1
        embed = self.p["embed"] * (np.arange(256) > 0)[:, None]
        # What a byte adds at each place of a filter: one table for each place.
        tables = np.einsum("be,wef->wbf", embed, self.p["filters"].reshape(WIDTH, EMBED, FILTERS))
        total = np.take(tables[0], padded[:n], axis=0)
        for k in range(1, WIDTH):
            total += np.take(tables[k], padded[k : k + n], axis=0)
        total = total.reshape(-1, BLOCK, FILTERS)
        return total.max(axis=1), total

    @staticmethod
    def chunks(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First block of every chunk, and where each text's chunks begin. The last chunk of a
        text ends with it and may be shorter."""
        blocks = np.diff(first)
        count = np.maximum(1, -(-(blocks - 1) // STRIDE))
        begin = np.append(0, np.cumsum(count))
        inside = np.arange(begin[-1]) - np.repeat(begin[:-1], count)
        return np.repeat(first[:-1], count) + inside * STRIDE, begin

    def forward(self, data: np.ndarray, offsets: np.ndarray, keep: bool = False):
        """The score of each text before the logistic function; with ``keep`` also what the
        gradients need."""
        padded, first = self.laid_out(data, offsets)
        highest, total = self.responses(padded)
        start, begin = self.chunks(first)
        text = np.repeat(np.arange(len(offsets) - 1), np.diff(begin))
        stop = np.minimum(start + BLOCKS, first[1:][text])
        pooled = highest[start]
        for k in range(1, BLOCKS):
            at = np.minimum(start + k, stop - 1)
            pooled = np.maximum(pooled, highest[at])
        active = np.maximum(pooled + self.p["shift"], 0)
        count = np.diff(begin)[:, None]
        mean = np.add.reduceat(active, begin[:-1], axis=0) / count
        top = np.maximum.reduceat(active, begin[:-1], axis=0)
        x = np.concatenate([mean, top], axis=1)
        h = np.maximum(x @ self.p["w1"] + self.p["b1"], 0)
        score = (h @ self.p["w2"] + self.p["b2"])[:, 0]
        if not keep:
            return score
        return score, (padded, total, start, stop, text, pooled, active, count, top, x, h)

    def gradients(self, data: np.ndarray, offsets: np.ndarray, label: np.ndarray) -> dict:
        score, kept = self.forward(data, offsets, keep=True)
        padded, total, start, stop, text, pooled, active, count, top, x, h = kept
        g = {}
        d = ((1 / (1 + np.exp(-score)) - label) / len(label)).astype(np.float32)[:, None]
        g["w2"], g["b2"] = h.T @ d, d.sum(0)
        d = (d @ self.p["w2"].T) * (h > 0)
        g["w1"], g["b1"] = x.T @ d, d.sum(0)
        d = d @ self.p["w1"].T
        wins = (active == top[text]) & (active > 0)
        # Chunks that tie for the highest share what it gets.
        ties = np.zeros_like(top)
        np.add.at(ties, text, wins)
        each = (d[:, :FILTERS] / count)[text] + (d[:, FILTERS:] / np.maximum(ties, 1))[text] * wins
        each = each * (pooled + self.p["shift"] > 0)
        g["shift"] = each.sum(0)
        # The byte where each chunk's highest response begins.
        span = np.minimum(start[:, None] + np.arange(BLOCKS), (stop - 1)[:, None])
        filters = np.zeros((WIDTH, EMBED, FILTERS), np.float32)
        embed = np.zeros((256, EMBED), np.float32)
        weights = self.p["filters"].reshape(WIDTH, EMBED, FILTERS)
        for f in range(FILTERS):
            own = total[:, :, f][span].reshape(len(start), -1)
            win = own.argmax(axis=1)
            at = span[np.arange(len(start)), win // BLOCK] * BLOCK + win % BLOCK
            for k in range(WIDTH):
                byte = padded[at + k]
                real = (byte > 0) * each[:, f]
                filters[k, :, f] = self.p["embed"][byte].T @ real
                np.add.at(embed, byte, real[:, None] * weights[k, :, f])
        g["filters"], g["embed"] = filters.reshape(-1, FILTERS), embed
        return g


def _flat_texts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    offsets = np.append(0, np.cumsum([len(t) for t in texts])).astype(np.int64)
    return np.frombuffer(b"".join(texts), np.uint8), offsets


def fitted(texts: list[str | None], labels: list[int], seed: int = 7) -> Network:
    """Adam over small batches; the number of passes follows the number of texts. Without any
    text the network is as it was drawn."""
    network, rng = Network(seed), np.random.default_rng(seed)
    texts = [(t or "").encode() for t in texts]
    labels = np.asarray(labels, np.float32)
    if not len(texts):
        return network
    rate = float(np.clip(labels.mean(), 0.01, 0.99))
    network.p["b2"][:] = np.log(rate / (1 - rate))
    first = {k: np.zeros_like(v) for k, v in network.p.items()}
    second = {k: np.zeros_like(v) for k, v in network.p.items()}
    passes = int(np.clip(VISITS // len(texts), 3, 30))
    batch, steps = 24, 0
    total = passes * -(-len(texts) // batch)
    for _ in range(passes):
        order = rng.permutation(len(texts))
        for i in range(0, len(order), batch):
            own = order[i : i + batch]
            g = network.gradients(*_flat_texts([texts[k] for k in own]), labels[own])
            steps += 1
            pace = 0.01 * (1 - steps / (total + 1))
            for k, v in g.items():
                first[k] += 0.1 * (v - first[k])
                second[k] += 0.001 * (v * v - second[k])
                m = first[k] / (1 - 0.9**steps)
                s = second[k] / (1 - 0.999**steps)
                network.p[k] -= pace * m / (np.sqrt(s) + 1e-8)
    return network


def _score(network: Network, text: str, name: str, keep_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text, SLICE_BYTES):
            score = network.forward(*flat(batch.column(text))).astype(np.float64)
            rest = [c for c in batch.schema.names if keep_text or c != text]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in rest], pa.array(1 / (1 + np.exp(-score)))],
                names=[*rest, name],
            )

    return run


def training_rows(df: DataFrame, labels: DataFrame, id_column: str, text: str) -> DataFrame:
    """``text`` and ``quality`` of at most ``MOST_ROWS`` labelled rows outside the held-out
    fifth, however often ids repeat. The bounded labels are broadcast, so no text is shuffled."""
    outside = F.crc32(F.col(id_column).cast("string")) % 5 != 0
    chosen = (
        labels.where(outside & F.col("quality").isin(0, 1))
        .select(F.col(id_column).alias("_id"), "quality")
        .orderBy(F.xxhash64("_id"), "_id", "quality")
        .limit(MOST_ROWS)
    )
    rows = df.select(F.col(id_column).alias("_id"), F.col(text).alias("_text"))
    order = (F.xxhash64("_id"), "_id", "quality", "_text")
    return rows.join(F.broadcast(chosen), "_id").orderBy(*order).limit(MOST_ROWS)


def fit(df: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text") -> Network:
    """A network fitted on labelled rows of ``df``. Rows without a label, with a null id or with
    a label other than 0 or 1 are no examples; a null text is an empty one."""
    rows = training_rows(df, labels, id_column, text).select("_text", "quality").collect()
    return fitted([r[0] for r in rows], [r[1] for r in rows])


def score(
    df: DataFrame, network: Network, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of ``df``: id, ``held_out``, ``score``, ``predicted``.

    Only the text is an input of the score. Null and empty texts get the score of no bytes;
    ids may be null (never held out) or repeated. Other columns are ignored.
    """
    id_type = df.schema[id_column].dataType.simpleString()
    rows = df.select(F.col(id_column).alias("id"), F.col(text).alias("body"))
    scored = rows.mapInArrow(_score(network, "body", "score", False), f"id {id_type}, score double")
    held_out = F.coalesce(F.crc32(F.col("id").cast("string")) % 5 == 0, F.lit(False))
    return scored.select(
        F.col("id").alias(id_column),
        held_out.alias("held_out"),
        "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
    )


def keep_good(df: DataFrame, network: Network, text: str = "text") -> DataFrame:
    """The rows of ``df`` that the network does not reject, with all their columns."""
    name = fresh(df, "_quality_score")
    schema = T.StructType([*df.schema.fields, T.StructField(name, T.DoubleType())])
    scored = df.mapInArrow(_score(network, text, name, True), schema)
    return scored.where(F.col(name) >= THRESHOLD).drop(name)
