"""Language identification by a byte convolutional network.

Bytes are embedded, convolved with filters of several widths, max-pooled over the window
and classified by softmax. The network is trained in numpy, in the driver, on
``sample_chars`` characters each of at most ``sample_docs`` labelled texts in expectation,
shared evenly by the languages; twice that number of texts is never exceeded. Prediction covers whole texts: windows of fixed
length that overlap by the widest filter less one, in batches; a document's probabilities
are the means over its windows, weighted by their bytes.

The sum over a filter's byte offsets is a sum of table rows (embedding times filter), so
prediction is table lookups and additions.

Defined results: null text and text without a letter is ``und`` with score 0, as is every
text if there is nothing to learn from; repeated rows get equal predictions; other columns
play no part, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tallyboard.llm.common import col

UNDETERMINED = "und"
WINDOW = 256
PAD = 256  # a symbol besides the 256 bytes
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBEDDING = 8
SAMPLE_DOCS = 6_000
SAMPLE_CHARS = 1_000  # of one text, from a place that a hash chooses
STEPS = 900
BATCH = 64
# Windows and bytes that are worked on together.
WINDOWS_AT_ONCE = 128
BYTES_AT_ONCE = 4_000_000


def _valid(lengths: np.ndarray, width: int) -> np.ndarray:
    """Number of filter positions inside windows of these lengths, one at least."""
    return np.maximum(1, lengths - width + 1)


@dataclass
class Network:
    """Weights; ``filters[w]`` is (w, EMBEDDING, FILTERS)."""

    labels: list[str]
    embedding: np.ndarray
    filters: dict[int, np.ndarray]
    bias: dict[int, np.ndarray]
    dense: np.ndarray
    offset: np.ndarray

    def tables(self) -> dict[int, np.ndarray]:
        """For each width, what byte b at offset o adds to the filters: (width, 257, FILTERS)."""
        return {w: np.ascontiguousarray(np.einsum("be,oef->obf", self.embedding, k)).astype(np.float32)
                for w, k in self.filters.items()}

    def probabilities(self, x: np.ndarray, lengths: np.ndarray, tables: dict[int, np.ndarray]) -> np.ndarray:
        """(windows, labels) for padded windows ``x`` (windows, WINDOW)."""
        short = np.flatnonzero(lengths < x.shape[1])
        pooled = []
        for w, table in tables.items():
            n = x.shape[1] - w + 1
            sums = np.take(table[0], x[:, :n], axis=0)
            for o in range(1, w):
                sums += np.take(table[o], x[:, o:o + n], axis=0)
            sums[short] = np.where((np.arange(n) < _valid(lengths[short], w)[:, None])[..., None], sums[short], -np.inf)
            pooled.append(np.maximum(sums.max(axis=1) + self.bias[w], 0))
        return _softmax(np.concatenate(pooled, axis=1) @ self.dense + self.offset)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def windows(texts: Sequence[bytes], step: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All bytes, and start, length and text number of the windows that cover every text."""
    sizes = np.array([len(t) for t in texts], np.int64)
    counts = np.maximum(1, -(-(sizes - (WINDOW - step)) // step))
    of = np.repeat(np.arange(len(texts)), counts)
    within = (np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)) * step
    starts = np.repeat(np.cumsum(sizes) - sizes, counts) + within
    # Room for a whole window after the last byte.
    flat = np.frombuffer(b"".join(texts) + bytes(WINDOW), np.uint8)
    return flat, starts, np.minimum(WINDOW, sizes[of] - within), of


def padded(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    place = np.arange(WINDOW)
    x = flat[starts[:, None] + place].astype(np.int64)
    x[place >= lengths[:, None]] = PAD
    return x


def train(texts: Sequence[str], labels: Sequence[str], seed: int = 1, steps: int = STEPS) -> Network | None:
    """Fit by Adam on windows cropped to random lengths, so that short texts are learned, too."""
    names = sorted(set(labels))
    if not names:
        return None
    rng = np.random.default_rng(seed)
    flat, starts, lengths, of = windows([t.encode("utf-8", "replace") for t in texts], WINDOW)
    whole = lengths >= 2
    flat_labels = np.searchsorted(names, np.asarray(labels, dtype=object)[of].astype(str)) if len(of) else of
    by_label = [np.flatnonzero((flat_labels == k) & whole) for k in range(len(names))]
    by_label = [i if len(i) else np.flatnonzero(flat_labels == k) for k, i in enumerate(by_label)]

    def weights(*shape, fan):
        return rng.normal(0, np.sqrt(2 / fan), shape)

    p = {"embedding": rng.normal(0, 0.5, (257, EMBEDDING)),
         "dense": weights(FILTERS * len(WIDTHS), len(names), fan=FILTERS * len(WIDTHS)), "offset": np.zeros(len(names))}
    p |= {f"filter{w}": weights(w * EMBEDDING, FILTERS, fan=w * EMBEDDING) for w in WIDTHS}
    p |= {f"bias{w}": np.zeros(FILTERS) for w in WIDTHS}
    p["embedding"][PAD] = 0
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in p.items()}
    for step in range(1, steps + 1):
        y = rng.integers(len(names), size=BATCH)
        pick = np.array([rng.choice(by_label[k]) for k in y])
        # Lengths from a few bytes to the whole window, evenly on a log scale.
        size = np.minimum(lengths[pick], np.exp(rng.uniform(np.log(12), np.log(WINDOW + 1), BATCH)).astype(np.int64))
        begin = starts[pick] + (rng.random(BATCH) * (lengths[pick] - size + 1)).astype(np.int64)
        x = padded(flat, begin, size)
        embedded = p["embedding"][x]
        pooled, kept = [], {}
        for w in WIDTHS:
            n = WINDOW - w + 1
            cols = np.concatenate([embedded[:, o:o + n] for o in range(w)], axis=2)
            sums = cols @ p[f"filter{w}"] + p[f"bias{w}"]
            sums[np.arange(n) >= _valid(size, w)[:, None]] = -np.inf
            best = sums.argmax(axis=1)
            kept[w] = cols, best
            pooled.append(np.maximum(np.take_along_axis(sums, best[:, None], 1)[:, 0], 0))
        features = np.concatenate(pooled, axis=1)
        delta = _softmax(features @ p["dense"] + p["offset"])
        delta[np.arange(BATCH), y] -= 1
        delta /= BATCH
        grad = {"dense": features.T @ delta + 1e-4 * p["dense"], "offset": delta.sum(axis=0),
                "embedding": np.zeros_like(p["embedding"])}
        back = (delta @ p["dense"].T) * (features > 0)
        for k, w in enumerate(WIDTHS):
            cols, best = kept[w]
            up = back[:, k * FILTERS:(k + 1) * FILTERS]
            at = cols[np.arange(BATCH)[:, None], best]  # batch, filter, width * embedding
            grad[f"filter{w}"] = np.einsum("bf,bfi->if", up, at)
            grad[f"bias{w}"] = up.sum(axis=0)
            to_input = (up[..., None] * p[f"filter{w}"].T).reshape(BATCH, FILTERS, w, EMBEDDING)
            symbols = x[np.arange(BATCH)[:, None, None], best[..., None] + np.arange(w)]
            np.add.at(grad["embedding"], symbols.ravel(), to_input.reshape(-1, EMBEDDING))
        grad["embedding"][PAD] = 0
        rate = 0.01 * (1 - 0.9 * step / steps)
        for k, g in grad.items():
            m, v = moments[k]
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p[k] -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return Network(names, p["embedding"], {w: p[f"filter{w}"].reshape(w, EMBEDDING, FILTERS) for w in WIDTHS},
                   {w: p[f"bias{w}"] for w in WIDTHS}, p["dense"], p["offset"])


def held_out(id_col: str) -> Column:
    """Rows never learned from: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(col(id_col).cast("string")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang",
          sample_docs: int = SAMPLE_DOCS, seed: int = 1, sample_chars: int = SAMPLE_CHARS) -> Network | None:
    """Network learned from rows that have a language, a letter and an id, and are not held out.

    A hash of the id decides which rows are in the sample: an even share of ``sample_docs``
    for each language, all rows of a language that has fewer. Of a row's text a window of
    ``sample_chars`` characters is learned from, at a place that a hash of the id decides.
    So what the driver holds is bounded by the product of both parameters.
    """
    usable = (docs.where(col(id_col).isNotNull() & ~held_out(id_col) & col(lang).isNotNull() & col(text).rlike(r"\p{L}"))
              .select(col(id_col).cast("string").alias("id"), col(text).alias("text"), col(lang).cast("string").alias("lang")))
    counts = {r["lang"]: r["count"] for r in usable.groupBy("lang").count().collect()}  # one row per language
    if not counts:
        return None
    share = {k: min(1.0, sample_docs / len(counts) / n) for k, n in counts.items()}
    limits = F.create_map(*[F.lit(x) for kv in share.items() for x in kv])
    draw = F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(1_000_000)) / 1_000_000
    place = F.pmod(F.xxhash64(F.lit(seed + 1), "id"), F.greatest(F.lit(1), F.char_length("text") - sample_chars + 1)) + 1
    sample = usable.where(draw < limits[F.col("lang")]).select(
        "id", "lang", F.col("text").substr(place.cast("int"), F.lit(sample_chars)).alias("text"))
    rows = sorted(tuple(r) for r in sample.limit(2 * sample_docs).collect())
    return train([r[2] for r in rows], [r[1] for r in rows], seed)


def predict_column(network: Network | None, text: Column) -> Column:
    """struct(lang_pred, score) of a text column."""

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        tables = network.tables() if network else {}
        step = WINDOW - max(WIDTHS) + 1
        for texts in batches:
            langs = np.full(len(texts), UNDETERMINED, dtype=object)
            scores = np.zeros(len(texts))
            spelled = [i for i, t in enumerate(texts) if network and t and any(map(str.isalpha, t))]
            for group in _groups(texts, spelled):
                flat, starts, lengths, of = windows([texts.iloc[i].encode("utf-8", "replace") for i in group], step)
                total = np.zeros((len(group), len(network.labels)))
                for a in range(0, len(starts), WINDOWS_AT_ONCE):
                    cut = slice(a, a + WINDOWS_AT_ONCE)
                    x = padded(flat, starts[cut], lengths[cut])
                    np.add.at(total, of[cut], network.probabilities(x, lengths[cut], tables) * lengths[cut, None])
                mean = total / total.sum(axis=1, keepdims=True)
                langs[group] = np.array(network.labels, dtype=object)[mean.argmax(axis=1)]
                scores[group] = np.minimum(mean.max(axis=1), 1.0)
            yield pd.DataFrame({"lang_pred": langs, "score": scores})

    return predict(text)


def _groups(texts: pd.Series, rows: list[int]) -> Iterator[list[int]]:
    """Consecutive rows of about BYTES_AT_ONCE characters together, at least one."""
    group, size = [], 0
    for i in rows:
        group.append(i)
        size += len(texts.iloc[i])
        if size >= BYTES_AT_ONCE:
            yield group
            group, size = [], 0
    if group:
        yield group


def identify(docs: DataFrame, network: Network | None, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score."""
    found = docs.select(col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"),
                        predict_column(network, col(text)).alias("p"))
    return found.select("doc_id", "held_out", "p.lang_pred", "p.score")


def keep_identified(docs: DataFrame, network: Network | None, min_score: float, text: str = "text") -> DataFrame:
    """Rows whose language is found with at least this score; all columns stay as they are."""
    found = predict_column(network, col(text))
    return docs.where((found["lang_pred"] != UNDETERMINED) & (found["score"] >= min_score))
