"""Language identification by a byte convolutional network.

Texts are cut into windows of `WINDOW` bytes.  Filters of several widths run over the bytes, each filter's largest
response in a window is kept (max pooling), and a softmax layer gives the languages.  A text's prediction is the sum of its windows'
log-probabilities, so long texts are read whole and in constant memory.

The network is trained in numpy on the driver with windows of at most `TRAIN_DOCS` labelled documents of each language (the first by a hash of the
id, so the choice does not depend on order or source); `TRAIN_WINDOWS` windows of each, any of its whole text, drawn by a hash of it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regioncast.llm.common import crc_of_id, narrowed, slices, small_batches, stored

WINDOW = 192
WIDTHS = (2, 3, 4)
FILTERS = 12
#: Labelled documents of each language, and windows of each document, that the network learns from.
TRAIN_DOCS, TRAIN_WINDOWS = 600, 4
EPOCHS, RATE, SEED = 8, 0.02, 11
#: Windows that are scored at a time.
BATCH = 256


def windows_of(text: bytes) -> np.ndarray:
    """All windows of a text, one after another; the last one is filled with zero bytes."""
    n = max(1, -(-len(text) // WINDOW))
    out = np.zeros(n * WINDOW, dtype=np.uint8)
    out[:len(text)] = np.frombuffer(text, dtype=np.uint8)
    return out.reshape(n, WINDOW)


class ByteNetwork:
    """One-hot byte convolutions as table lookups: filter f of width w adds tables[w][k, byte, f] over its k = 0 .. w-1 bytes."""

    def __init__(self, classes: list[str]):
        rng = np.random.default_rng(SEED)
        self.classes = classes
        self.tables = {w: rng.normal(0, 0.3 / np.sqrt(w), (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS}
        self.weights = rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(classes))).astype(np.float32)
        self.bias = np.zeros(len(classes), dtype=np.float32)
        for t in self.tables.values():
            t[:, 0] = 0  # filling has no response

    def pooled(self, windows: np.ndarray, places: bool = False):
        """Largest response of each filter in each window (at least 0), and where."""
        best, where = [], []
        for w, table in self.tables.items():
            size = WINDOW - w + 1
            response = table[0][windows[:, :size]]
            for k in range(1, w):
                response += table[k][windows[:, k:k + size]]
            if places:
                at = response.argmax(axis=1)
                where.append(at)
                top = np.take_along_axis(response, at[:, None, :], axis=1)[:, 0]
            else:
                top = response.max(axis=1)
            best.append(np.maximum(top, 0))
        return (np.concatenate(best, axis=1), where) if places else np.concatenate(best, axis=1)

    def log_probabilities(self, windows: np.ndarray) -> np.ndarray:
        z = self.pooled(windows) @ self.weights + self.bias
        z -= z.max(axis=1, keepdims=True)
        return z - np.log(np.exp(z).sum(axis=1, keepdims=True))

    def train(self, windows: np.ndarray, labels: np.ndarray, epochs: int = EPOCHS, batch: int = 64) -> None:
        """Cross-entropy, Adam steps; the gradient of max pooling goes to the place of the largest response."""
        rng = np.random.default_rng(SEED)
        values = [self.weights, self.bias, *(self.tables[w] for w in WIDTHS)]
        first, second, step = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values], 0
        for _ in range(epochs):
            order = rng.permutation(len(windows))
            for at in range(0, len(order), batch):
                rows = order[at:at + batch]
                x, y = windows[rows], labels[rows]
                top, where = self.pooled(x, places=True)
                z = top @ self.weights + self.bias
                p = np.exp(z - z.max(axis=1, keepdims=True))
                p /= p.sum(axis=1, keepdims=True)
                p[np.arange(len(y)), y] -= 1
                p /= len(y)
                back = (p @ self.weights.T) * (top > 0)
                grads = [top.T @ p + 1e-4 * self.weights, p.sum(axis=0)]
                for i, w in enumerate(WIDTHS):
                    grad = np.zeros_like(self.tables[w])
                    own, place = back[:, i * FILTERS:(i + 1) * FILTERS], where[i]
                    for k in range(w):
                        seen = x[np.arange(len(x))[:, None], place + k]
                        np.add.at(grad[k], (seen, np.arange(FILTERS)[None, :]), own)
                    grad[:, 0] = 0
                    grads.append(grad)
                step += 1
                for v, g, m, s in zip(values, grads, first, second):
                    m += 0.1 * (g - m)
                    s += 0.001 * (g * g - s)
                    v -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.999 ** step)) + 1e-8)

    def predict(self, texts: list[bytes]) -> tuple[list[str], np.ndarray]:
        """Class and score of each text: softmax of the mean log-probability of its windows, weighted by the root of their number."""
        total, count = np.zeros((len(texts), len(self.classes))), np.zeros(len(texts))
        held: list[np.ndarray] = []
        owner: list[np.ndarray] = []

        def flush():
            if held:
                x, o = np.concatenate(held), np.concatenate(owner)
                for at in range(0, len(x), BATCH):
                    np.add.at(total, o[at:at + BATCH], self.log_probabilities(x[at:at + BATCH]))
                held.clear()
                owner.clear()

        for k, text in enumerate(texts):
            rows = windows_of(text)
            count[k] = len(rows)
            held.append(rows)
            owner.append(np.full(len(rows), k))
            if sum(map(len, held)) >= 16 * BATCH:
                flush()
        flush()
        z = total / np.sqrt(np.maximum(count, 1))[:, None]
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        best = p.argmax(axis=1)
        return [self.classes[b] for b in best], p[np.arange(len(texts)), best]


def training_windows(docs: DataFrame, folds: int, held_fold: int) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, windows and labels of the bounded sample."""
    labelled = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull()
                          & (F.pmod(crc_of_id(F.col("doc_id")), F.lit(folds)) != held_fold))
    # The ids are chosen before the texts are read.  Each language's ids are first thinned by their hash to a few times what is
    # taken, so few ids of a language meet in the ranking, whatever its share of the corpus; the share comes from the number of
    # different ids, as the rows of one id stay or go together.
    ids = labelled.select("lang", "doc_id", F.xxhash64("doc_id").alias("place"))
    share = F.least(F.lit(1.0), 4.0 * TRAIN_DOCS / F.col("ids"))
    counts = stored(ids.groupBy("lang").agg(F.approx_count_distinct("doc_id").alias("ids")), "counts")  # a row for each language
    thin = ids.join(F.broadcast(counts), "lang").where(F.pmod("place", F.lit(1_000_003)) < share * 1_000_003).select("lang", "doc_id", "place").distinct()
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("place", "doc_id"))
    first = stored(thin.withColumn("rank", rank).where(F.col("rank") <= TRAIN_DOCS).select("lang", "doc_id", "place"), "chosen")
    # At most TRAIN_DOCS ids of each language, as the network has a column for each; an id may have many rows, of which as many stay.
    keyed = labelled.withColumn("key", F.xxhash64("text"))
    rows = keyed.join(F.broadcast(first), ["lang", "doc_id"]).select("lang", "doc_id", "place", "key").distinct()
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("place", "doc_id", "key"))
    chosen = stored(rows.withColumn("rank", rank).where(F.col("rank") <= TRAIN_DOCS).select("lang", "doc_id", "key"), "rows")

    def cut(batches):
        for batch in slices(batches, "text"):
            rows = []
            for lang, key, text in zip(batch.column("lang").to_pylist(), batch.column("key").to_pylist(), batch.column("text").to_pylist()):
                all_ = windows_of(text)
                some = np.random.default_rng(key & (2**63 - 1)).choice(len(all_), min(TRAIN_WINDOWS, len(all_)), replace=False)
                rows += [(lang, key, int(k), all_[k].tobytes()) for k in some]
            if rows:
                kinds = (pa.string(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows), kinds)], names=["lang", "key", "place", "bytes"])

    texts = keyed.join(F.broadcast(chosen), ["lang", "doc_id", "key"], "left_semi").select("lang", "key", "text")
    # Equal rows give equal windows, and one of each stays.
    got = texts.mapInArrow(cut, "lang string, key long, place long, bytes binary").distinct().collect()
    got.sort(key=lambda r: (r.lang, bytes(r.bytes)))
    classes = sorted({r.lang for r in got})
    windows = np.frombuffer(b"".join(bytes(r.bytes) for r in got), dtype=np.uint8).reshape(-1, WINDOW)
    return classes, windows, np.array([classes.index(r.lang) for r in got], dtype=np.int64)


def has_letter(text: bytes) -> bool:
    """Whether a text has a letter of any script."""
    if text.translate(None, bytes(range(65)) + b"[\\]^_`{|}~\x7f") == b"":
        return False
    return any(c.isalpha() for c in text.decode("utf-8", "replace"))


def languages(docs: DataFrame, folds: int = 5, held_fold: int = 0) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row of ``docs`` (doc_id, text, lang).

    Only rows with a lang whose crc32(doc_id as text) mod ``folds`` is not ``held_fold`` are learned from.  Null texts and texts without a letter
    are `und` with score 0; a null doc_id is not held out and never learned from; rows that share an id are judged one by one; extra
    columns are ignored; without any labelled row every text is `und`; no rows give no rows.
    """
    spark = docs.sparkSession
    small_batches(spark)
    own = narrowed(docs, doc_id="long", text="binary", lang="string")
    classes, windows, labels = training_windows(own, folds, held_fold)
    network = None
    if classes:
        network = ByteNetwork(classes)
        network.train(windows, labels)
    sent = spark.sparkContext.broadcast(network)
    held = F.coalesce(F.pmod(crc_of_id(F.col("doc_id")), F.lit(folds)) == held_fold, F.lit(False))

    def apply(batches):
        model = sent.value
        for batch in slices(batches, "text"):
            texts = [t or b"" for t in batch.column("text").to_pylist()]
            known = [k for k, t in enumerate(texts) if model and has_letter(t)]
            lang, score = ["und"] * len(texts), np.zeros(len(texts))
            if known:
                names, p = model.predict([texts[k] for k in known])
                for k, name, s in zip(known, names, p.tolist()):
                    lang[k], score[k] = name, s
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(lang, type=pa.string()), pa.array(score)],
                                             names=["doc_id", "held_out", "lang_pred", "score"])

    return own.select("doc_id", held.alias("held_out"), "text").mapInArrow(apply, "doc_id long, held_out boolean, lang_pred string, score double")
