"""Language identification by a convolutional network over bytes.

Filters of several widths slide over fixed windows of a text, each keeps its largest
response in the window (max pooling), and a softmax layer turns those into languages.
Training is plain numpy; a text's windows are scored in batches and averaged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsemill.llm import words as W
from pulsemill.llm.common import small_batches

WINDOW = 192  # bytes
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBED = 8
SYMBOLS = 64
DOCS_PER_LANGUAGE = 800  # expected size of the training sample, one window of each
EPOCHS = 8
FOLDS = 5
UNKNOWN = "und"
_AT_ONCE = 256  # windows scored together


def _symbols() -> np.ndarray:
    """Bytes to 64 symbols: letters without case, digits, marks, lead bytes, trail bytes."""
    table = np.full(256, 28, np.uint8)
    table[:33] = 0
    table[48:58] = 27
    table[65:91] = np.arange(1, 27)
    table[97:123] = np.arange(1, 27)
    table[128:192] = 32 + (np.arange(64) & 31)
    table[192:] = 30
    table[0xC3] = 29
    table[0xE0:] = 31
    return table


SYMBOL_OF = _symbols()


@dataclass
class Network:
    languages: list[str]
    embed: np.ndarray
    filters: list[np.ndarray]  # per width: width * EMBED inputs by FILTERS
    bias: list[np.ndarray]
    out: np.ndarray
    out_bias: np.ndarray
    _tables: tuple = field(default=(), repr=False)

    @classmethod
    def start(cls, languages: list[str], seed: int = 1) -> Network:
        rng = np.random.default_rng(seed)
        return cls(
            languages, rng.normal(0, 0.5, (SYMBOLS, EMBED)),
            [rng.normal(0, (w * EMBED) ** -0.5, (w * EMBED, FILTERS)) for w in WIDTHS],
            [np.zeros(FILTERS) for _ in WIDTHS],
            rng.normal(0, 0.1, (FILTERS * len(WIDTHS), len(languages))), np.zeros(len(languages)))

    def _parameters(self) -> list[np.ndarray]:
        return [self.embed, *self.filters, *self.bias, self.out, self.out_bias]

    def train(self, windows: np.ndarray, labels: np.ndarray, epochs: int = EPOCHS, seed: int = 2) -> None:
        """Cross entropy by Adam on shuffled batches of 64 windows."""
        rng = np.random.default_rng(seed)
        parameters = self._parameters()
        first = [np.zeros_like(p) for p in parameters]
        second = [np.zeros_like(p) for p in parameters]
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(labels))
            for at in range(0, len(order), 64):
                rows = order[at:at + 64]
                step += 1
                for p, g, m, v in zip(
                        parameters, self._gradients(windows[rows], labels[rows]), first, second, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    p -= 0.01 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        self._tables = ()

    def _gradients(self, windows: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
        n = len(windows)
        embedded = self.embed[windows]
        pooled, winners = [], []
        for width, kernel, bias in zip(WIDTHS, self.filters, self.bias, strict=True):
            n_places = windows.shape[1] - width + 1
            response = np.zeros((n, n_places, FILTERS))
            for j in range(width):
                response += embedded[:, j:j + n_places] @ kernel[j * EMBED:(j + 1) * EMBED]
            place = response.argmax(1)
            best = np.take_along_axis(response, place[:, None, :], 1)[:, 0] + bias
            pooled.append(np.maximum(best, 0))
            winners.append(place)
        hidden = np.concatenate(pooled, 1)
        error = _softmax(hidden @ self.out + self.out_bias)
        error[np.arange(n), labels] -= 1
        error /= n
        back = error @ self.out.T
        d_embed = np.zeros_like(self.embed)
        d_filters, d_bias = [], []
        for i, (width, kernel) in enumerate(zip(WIDTHS, self.filters, strict=True)):
            own = back[:, i * FILTERS:(i + 1) * FILTERS] * (pooled[i] > 0)
            d_bias.append(own.sum(0))
            d_kernel = np.zeros_like(kernel)
            for j in range(width):
                seen = np.take_along_axis(windows, winners[i] + j, 1)
                rows = slice(j * EMBED, (j + 1) * EMBED)
                d_kernel[rows] = np.einsum("nfe,nf->ef", self.embed[seen], own)
                np.add.at(d_embed, seen, own[:, :, None] * kernel[rows].T[None])
            d_filters.append(d_kernel)
        return [d_embed, *d_filters, *d_bias, hidden.T @ error, error.sum(0)]

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What pairs and single symbols add to the filters: the same sums, looked up.

        A pair of symbols gives all of width 2 and the first half of widths 3 and 4; the
        other half of width 4 is a pair too, that of width 3 one symbol.
        """
        if not self._tables:
            part = [[self.embed @ k[j * EMBED:(j + 1) * EMBED] for j in range(w)]
                    for w, k in zip(WIDTHS, self.filters, strict=True)]

            def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
                return (a[:, None] + b[None]).reshape(SYMBOLS * SYMBOLS, FILTERS)

            first = np.concatenate([pair(p[0], p[1]) for p in part], 1)
            self._tables = tuple(x.astype(np.float32) for x in (first, part[1][2], pair(*part[2][2:])))
        return self._tables

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        """Languages by window; windows are rows of symbols."""
        first, third, second = self.tables()
        bias = np.concatenate(self.bias)
        out = np.zeros((len(windows), len(self.languages)))
        f = FILTERS
        for at in range(0, len(windows), _AT_ONCE):
            w = windows[at:at + _AT_ONCE].astype(np.int32)
            pairs = w[:, :-1] * SYMBOLS + w[:, 1:]
            response = first[pairs]
            three = response[:, :-1, f:2 * f]
            three += third[w[:, 2:]]
            four = response[:, :-2, 2 * f:]
            four += second[pairs[:, 2:]]
            pooled = np.concatenate(
                [response[:, :, :f].max(1), three.max(1), four.max(1)], 1) + bias
            out[at:at + _AT_ONCE] = _softmax(np.maximum(pooled, 0) @ self.out + self.out_bias)
        return out


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def windows_of(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of all texts as windows, the last of a text filled up with blanks."""
    size = np.diff(offsets)
    count = -(-size // WINDOW)
    text = np.repeat(np.arange(len(size)), count)
    out = np.zeros(int(count.sum()) * WINDOW, np.uint8)
    first = (np.cumsum(count) - count) * WINDOW
    place = np.arange(len(data)) + np.repeat(first - offsets[:-1], size)
    out[place] = SYMBOL_OF[data]
    return out.reshape(-1, WINDOW), text


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """Whether a document is kept from training: a fifth, by checksum of its id."""
    text = F.coalesce(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id, F.lit(""))
    return F.crc32(text) % FOLDS == 0


def fit(docs: DataFrame, per_language: int = DOCS_PER_LANGUAGE) -> Network | None:
    """The network trained on one window of about ``per_language`` documents of each language.

    Only documents with a language, outside the held-out fifth, are read. Sampling is by
    hash with a share that follows the language's count, so the bound holds in expectation;
    a limit makes it certain, the least draws first. None if no document is labelled.
    """
    usable = docs.where(~held_out() & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counts = {r.lang: r.n for r in usable.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    languages = sorted(counts)
    share = F.element_at(
        F.create_map(*[F.lit(x) for k in languages for x in (k, min(1.0, per_language / counts[k]))]),
        F.col("lang"))
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / float(1 << 30)
    spare = F.greatest(F.length("text") - WINDOW + 1, F.lit(1))
    start = (F.pmod(F.xxhash64("text"), spare.cast("long")) + 1).cast("int")
    sample = usable.where(draw < share).select(
        "lang", F.substring(F.col("text"), start, F.lit(WINDOW)).alias("piece"), draw.alias("draw"),
    ).orderBy("draw", "lang", "piece").limit(2 * per_language * len(languages)).toPandas().sort_values(["lang", "piece"])
    windows = np.zeros((len(sample), WINDOW), np.uint8)
    for i, piece in enumerate(sample.piece):
        codes = SYMBOL_OF[np.frombuffer(piece.encode()[:WINDOW], np.uint8)]
        windows[i, :len(codes)] = codes
    network = Network.start(languages)
    network.train(windows, np.searchsorted(languages, sample.lang.to_numpy(str)))
    return network


def _predict(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network: Network = shared.value
        names = np.array(network.languages)
        for batch in batches:
            for part in W.slices(batch, "text"):
                offsets, data = W.utf8(part.column("text"))
                n = part.num_rows
                total = np.zeros((n, len(names)))
                windows, text = windows_of(offsets, data)
                for at in range(0, len(windows), 16 * _AT_ONCE):
                    p = network.probabilities(windows[at:at + 16 * _AT_ONCE])
                    np.add.at(total, text[at:at + 16 * _AT_ONCE], p)
                mean = total / np.maximum(total.sum(1, keepdims=True), 1e-300)
                best = mean.argmax(1)
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), part.column("held_out"), part.column("letters"),
                    pa.array(names[best]), pa.array(mean[np.arange(n), best]),
                ], ["doc_id", "held_out", "letters", "lang_pred", "score"])

    return run


def languages(docs: DataFrame, network: Network | None) -> DataFrame:
    """Rows (doc_id, held_out, lang_pred, score), one per document.

    A null text, or one without a letter, is ``und`` with score 0; so is everything if there
    is no network. Equal texts get equal predictions; repeated rows each get their row. A
    null doc_id counts as held out.
    """
    spark = docs.sparkSession
    small_batches(spark)
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    rows = docs.select("doc_id", "text", held_out().alias("held_out"), letters.alias("letters"))
    if network is None:
        return rows.select(
            "doc_id", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    network.tables()
    scored = rows.mapInArrow(
        _predict(spark.sparkContext.broadcast(network)),
        "doc_id long, held_out boolean, letters boolean, lang_pred string, score double")
    return scored.select(
        "doc_id", "held_out", F.when(F.col("letters"), F.col("lang_pred")).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(F.col("letters"), F.least("score", F.lit(1.0))).otherwise(0.0).alias("score"))
