"""Quality classifier: a byte-level convolutional network in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewright.llm.common import batches_then_release, held_out, labelled_sample, prepare

#: Bytes under a filter, filters, bytes of a chunk and its step: chunks overlap by WIDTH - 1 bytes, so no window is lost.
WIDTH, FILTERS, CHUNK = 6, 16, 512
#: Labelled training texts at most, of each class.
SAMPLE = {0: 500, 1: 1000}
EPOCHS, RATE, DECAY, SEED = 12, 0.1, 1e-4, 11
#: From this score a document is predicted to be good.
THRESHOLD = 0.5
#: A filter rejects only below this score, so that a doubtful document stays.
KEEP_FROM = 0.3


class ByteCNN:
    """score = sigmoid(mean over chunks of relu(max over windows of filters) . a + max over chunks . b + c).

    A filter is a table of one weight for each of WIDTH places and 256 byte values. For scoring, the tables of two
    neighbouring places are added up into one of 65,536 rows, which halves the look-ups.
    """

    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.conv = rng.normal(0, 0.1, (WIDTH, 256, FILTERS)).astype(np.float32)
        self.bias = np.zeros(FILTERS, np.float32)
        self.mean_weight = rng.normal(0, 0.1, FILTERS).astype(np.float32)
        self.max_weight = rng.normal(0, 0.1, FILTERS).astype(np.float32)
        self.shift = np.float32(0)
        self.pairs: list[np.ndarray] | None = None

    def freeze(self) -> ByteCNN:
        self.pairs = [(self.conv[i][:, None, :] + self.conv[i + 1][None, :, :]).reshape(65536, FILTERS) for i in range(0, WIDTH, 2)]
        return self

    @staticmethod
    def bytes_of(text: str | None) -> np.ndarray:
        """The whole text's bytes, padded by zeros to one window at least."""
        raw = np.frombuffer((text or "").encode("utf-8"), np.uint8)
        return raw if len(raw) >= WIDTH else np.concatenate([raw, np.zeros(WIDTH - len(raw), np.uint8)])

    def pooled(self, raw: np.ndarray, where: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
        """Per chunk and filter: the largest response, and (if asked for) the window it comes from."""
        n = len(raw) - WIDTH + 1
        pair = (raw[:-1].astype(np.int32) << 8) | raw[1:]
        most, at = [], []
        for start in range(0, n, CHUNK):
            stop = min(n, start + CHUNK)
            if self.pairs is not None:
                z = self.pairs[0][pair[start:stop]]
                for i in range(1, WIDTH // 2):
                    z += self.pairs[i][pair[start + 2 * i : stop + 2 * i]]
            else:
                z = sum(self.conv[k][raw[start + k : stop + k]] for k in range(WIDTH))
            most.append(z.max(axis=0))
            if where:
                at.append(z.argmax(axis=0) + start)
        return np.stack(most) + self.bias, np.stack(at) if where else None

    def score(self, text: str | None) -> float:
        h = np.maximum(self.pooled(self.bytes_of(text))[0], 0)
        z = float(h.mean(axis=0) @ self.mean_weight + h.max(axis=0) @ self.max_weight + self.shift)
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))

    def fit(self, rows: list[tuple[str, int]], epochs: int = EPOCHS) -> ByteCNN:
        """Adagrad on the log loss. Without rows of both classes the score is the share of 1."""
        ys = np.array([y for _, y in rows], float)
        if len(rows) == 0 or ys.min() == ys.max():
            self.mean_weight[:], self.max_weight[:] = 0, 0
            self.shift = np.float32(np.log((ys.sum() + 1) / (len(ys) - ys.sum() + 1)))
            return self.freeze()
        rng = np.random.default_rng(SEED)

        data = [(self.bytes_of(t), y) for t, y in rows]
        g_conv, g_bias = np.full(self.conv.shape, 1e-3, np.float32), np.full(FILTERS, 1e-3, np.float32)
        g_mean, g_max, g_shift = np.full(FILTERS, 1e-3, np.float32), np.full(FILTERS, 1e-3, np.float32), 1e-3
        filters = np.arange(FILTERS)
        for epoch in range(epochs):
            rate = RATE / (1 + epoch / 4)
            for i in rng.permutation(len(data)):
                raw, y = data[i]
                z, at = self.pooled(raw, True)
                h = np.maximum(z, 0)
                mean, best = h.mean(axis=0), h.argmax(axis=0)
                out = mean @ self.mean_weight + h[best, filters] @ self.max_weight + self.shift
                d = 1 / (1 + np.exp(-np.clip(out, -30, 30))) - y
                if abs(d) < 0.02:
                    continue
                dh = np.broadcast_to(d * self.mean_weight / len(h), h.shape).copy()
                dh[best, filters] += d * self.max_weight
                dh *= h > 0
                gm, gx = d * mean + DECAY * self.mean_weight, d * h[best, filters] + DECAY * self.max_weight
                g_mean += gm * gm
                g_max += gx * gx
                g_shift += d * d
                self.mean_weight -= rate * gm / np.sqrt(g_mean)
                self.max_weight -= rate * gx / np.sqrt(g_max)
                self.shift -= np.float32(rate * d / np.sqrt(g_shift))
                db = dh.sum(axis=0)
                g_bias += db * db
                self.bias -= rate * db / np.sqrt(g_bias)
                columns = np.broadcast_to(filters, at.shape)
                for k in range(WIDTH):
                    grad = np.zeros((256, FILTERS), np.float32)
                    np.add.at(grad, (raw[at + k], columns), dh)
                    g_conv[k] += grad * grad
                    self.conv[k] -= rate * grad / np.sqrt(g_conv[k])
        return self.freeze()


def train(docs: DataFrame, labels: DataFrame, sample: dict[int, int] | None = None) -> ByteCNN:
    """A network from a bounded sample of labelled rows outside the held-out fold (SAMPLE texts of each class at most)."""
    return ByteCNN().fit(labelled_sample(docs, labels, "quality", sample or SAMPLE))


def score_documents(docs: DataFrame, model: ByteCNN) -> DataFrame:
    """All columns of ``docs`` (``quality_score`` and ``_text`` apart) and ``quality_score`` (0 to 1, higher: better).

    Null texts are empty texts, which have a score like any other. Repeated rows have equal scores. A column of the same
    name as the score is replaced by it. An empty table gives an empty result.
    """
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 3 tables of 65,536 x FILTERS floats: 12 MB, whatever the input

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        net = shared.value
        for batch in batches_then_release(batches):
            yield batch.assign(quality_score=np.array([net.score(t) for t in batch["_text"]], float)).drop(columns="_text")

    own = docs.drop("quality_score", "_text")
    flat = own.withColumn("_text", F.col("text"))
    schema = own.withColumn("quality_score", F.lit(0.0)).schema
    return flat.mapInPandas(run, schema)


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of ``docs``; only texts enter a score.

    Null and empty texts have the score of the empty text, null ids are not held out, repeated rows each come back with
    equal scores, other columns are not looked at, and an empty table gives an empty result.
    """
    scored = score_documents(docs.select("doc_id", "text"), train(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("quality_score").alias("score"), (F.col("quality_score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, least: float = KEEP_FROM) -> DataFrame:
    """The rows of ``docs`` that score ``least`` or more, with their columns as they are.

    Null and empty texts are judged as the empty text; equal texts stay or go together; an empty table stays empty.
    """
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        net = shared.value
        for batch in batches_then_release(batches):
            yield batch[np.array([net.score(t) >= least for t in batch["text"]], bool)]

    return docs.mapInPandas(run, docs.schema)
