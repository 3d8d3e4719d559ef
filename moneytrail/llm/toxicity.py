"""Toxicity: a convolutional text classifier over hashed word embeddings, trained here in numpy.

A word is the sum of the embeddings of its hashed spelling and of its hashed first 3 to 6 bytes (inflected
and compound words share those). Filters one to three words wide run over the text, each takes its maximum
over the *whole* text, and a logistic layer joins the maxima. The first embedding dimension starts
from how much more often a hash occurs in toxic training texts than chance gives; all weights
are then trained by gradient steps. A part of the sample is kept back to scale the scores to
probabilities and to calibrate a decision threshold for each language (languages with few toxic rows share the
general one).

The model is fitted on a bounded sample of labelled rows: the ``SAMPLE_ROWS`` rows of smallest hashed id, as far
as their texts stay within ``SAMPLE_BYTES``. Every row is scored, by text alone, in runs of bounded size:
labels, languages, sources and ids are not inputs of a score (the language picks the threshold only).

Defined cases: a null or empty text has no words and gets the score of no words; labels with a null id or null
value are left out, and of several labels of an id the largest counts; without both kinds of labels every
score is 0; an unknown or null language takes the general threshold; equal texts get equal scores; other columns
are kept, and columns named ``score``, ``threshold`` or ``toxic`` give way to the result's.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moneytrail.llm.common import filled, input_columns, map_texts, row_ranges
from moneytrail.llm.words import ALNUM, Words

SAMPLE_ROWS, SAMPLE_BYTES = 6_000, 24 << 20
PREFIXES = (3, 4, 5, 6)
BUCKETS, DIMENSIONS, FILTERS, WIDTHS = 1 << 19, 8, 8, (1, 2, 3)
EPOCHS, BATCH, RATE = 3, 32, 0.02
#: Toxic rows that a language needs in the kept-back part for a threshold of its own.
LEAST_TOXIC = 8
RESULTS = ("score", "threshold", "toxic")
#: Words of which the filters' outputs are held at once.
RUN_WORDS = 1 << 16


def word_rows(splitter: Words, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(embedding rows of each word, first word of each text and the end); row 0 is that of nothing."""
    _, _, hashes, of = splitter.split(data, offsets)
    ids = (hashes >> np.uint64(45)).astype(np.int32)  # 19 bits
    ids[(ids == 0) & (hashes != 0)] = 1
    return ids.T, np.searchsorted(of, np.arange(len(offsets)))


@dataclass
class Model:
    embedding: np.ndarray
    filters: list[np.ndarray]  # by width: width x dimensions x filters
    bias: np.ndarray
    out: np.ndarray
    out_bias: float
    scale: tuple[float, float] = (1.0, 0.0)
    thresholds: dict[str | None, float] = field(default_factory=dict)
    threshold: float = 0.5
    empty: bool = False

    def vectors(self, ids: np.ndarray) -> np.ndarray:
        x = self.embedding[ids[:, 0]]
        for k in range(1, ids.shape[1]):
            x += self.embedding[ids[:, k]]
        return x

    def responses(self, x: np.ndarray, n: int) -> np.ndarray:
        """Filter outputs at the first ``n`` positions of ``x``; beyond its end there are zeros."""
        x = np.concatenate([x, np.zeros((len(WIDTHS), DIMENSIONS), np.float32)])
        return np.concatenate([sum(x[j : j + n] @ w[j] for j in range(len(w))) for w in self.filters], 1)

    def pooled(self, ids: np.ndarray, heads: np.ndarray) -> np.ndarray:
        """The maximum of each filter over each text (``heads``: first words and the end)."""
        n, widest = len(heads) - 1, max(WIDTHS) - 1
        top = np.full((n, len(self.bias)), -np.inf, np.float32)
        spaced, firsts = _spaced(ids, heads)
        stops = firsts + np.diff(heads)
        for a in range(0, len(spaced), RUN_WORDS):
            b = min(len(spaced), a + RUN_WORDS)
            found = self.responses(self.vectors(spaced[a : b + widest]), b - a + 1)
            i, j = int(np.searchsorted(stops, a, "right")), int(np.searchsorted(firsts, b))
            mine = np.arange(i, j)
            mine = mine[stops[mine] > firsts[mine]]
            if len(mine):
                bounds = np.stack([np.maximum(firsts[mine] - a, 0), np.minimum(stops[mine] - a, b - a)], 1)
                top[mine] = np.maximum(top[mine], np.maximum.reduceat(found, bounds.ravel(), axis=0)[::2])
        return np.maximum(np.where(np.isfinite(top), top, 0) + self.bias, 0)

    def logits(self, ids: np.ndarray, heads: np.ndarray) -> np.ndarray:
        return self.pooled(ids, heads) @ self.out + self.out_bias

    def scores(self, ids: np.ndarray, heads: np.ndarray) -> np.ndarray:
        if self.empty:
            return np.zeros(len(heads) - 1)
        a, b = self.scale
        return _sigmoid(a * self.logits(ids, heads).astype(np.float64) + b)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _spaced(ids: np.ndarray, heads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts with rows of nothing behind each, so that no filter that starts in one reaches the next, and where each begins."""
    gap = max(WIDTHS) - 1 or 1
    n = len(heads) - 1
    out = np.zeros((len(ids) + gap * n, ids.shape[1]), ids.dtype)
    of = np.repeat(np.arange(n), np.diff(heads))
    out[np.arange(len(ids)) + gap * of] = ids
    return out, heads[:-1] + gap * np.arange(n)


def train(texts: list[bytes], toxic: np.ndarray, seed: int = 5) -> Model:
    """Fit the classifier (without thresholds) on a bounded list of texts."""
    rng = np.random.default_rng(seed)
    splitter = Words(ALNUM, PREFIXES)
    docs = [word_rows(splitter, np.frombuffer(t, np.uint8), np.array([0, len(t)]))[0] for t in texts]
    some = [i for i, d in enumerate(docs) if len(d)]  # a text without words teaches nothing
    docs, toxic = [docs[i] for i in some], toxic[some]
    n, positive = len(docs), float(np.clip(toxic.mean(), 1e-3, 1 - 1e-3)) if docs else 0.5
    embedding = rng.normal(0, 0.02, (BUCKETS, DIMENSIONS)).astype(np.float32)
    seen, seen_toxic = np.zeros(BUCKETS, np.int32), np.zeros(BUCKETS, np.int32)
    for ids, y in zip(docs, toxic, strict=True):
        rows = np.unique(ids)
        seen[rows] += 1
        seen_toxic[rows] += int(y)
    excess = (seen_toxic - positive * seen) / np.sqrt(positive * seen + 1)
    embedding[:, 0] = np.where((seen_toxic >= 2) | (excess < 0), np.sign(excess) * np.log1p(np.abs(excess)), 0)
    embedding[0] = 0
    filters = [rng.normal(0, 0.1, (k, DIMENSIONS, FILTERS)).astype(np.float32) for k in WIDTHS]
    for w in filters:
        w[:, 0, :] += 0.5 / len(w)
    model = Model(embedding, filters, np.full(FILTERS * len(WIDTHS), -1, np.float32), np.full(FILTERS * len(WIDTHS), 0.1, np.float32), float(np.log(positive / (1 - positive))))
    weight = np.where(toxic == 1, min(4.0, (1 - positive) / positive), 1.0).astype(np.float32)
    dense = [*model.filters, model.bias, model.out, np.array([model.out_bias], np.float32)]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in dense]
    gathered, step = np.full(BUCKETS, 1e-3, np.float32), 0
    for _ in range(EPOCHS):
        order = rng.permutation(n)
        for at in range(0, n, BATCH):
            some = order[at : at + BATCH]
            heads = np.concatenate([[0], np.cumsum([len(docs[i]) for i in some])])
            ids, firsts = _spaced(np.concatenate([docs[i] for i in some]), heads)
            x = model.vectors(ids)
            found = model.responses(x, len(x))
            ends = firsts + np.diff(heads)
            where = np.stack([a + found[a:b].argmax(0) for a, b in zip(firsts.tolist(), ends.tolist(), strict=True)])
            pooled = np.maximum(np.take_along_axis(found, where, 0) + model.bias, 0)
            error = ((_sigmoid(pooled @ model.out + model.out_bias) - toxic[some]) * weight[some] / len(some)).astype(np.float32)
            back = error[:, None] * model.out * (pooled > 0)
            gradients, x = [], np.concatenate([x, np.zeros((len(WIDTHS), DIMENSIONS), np.float32)])
            padded = np.concatenate([ids, np.zeros((len(WIDTHS), ids.shape[1]), ids.dtype)])
            changes = []
            for k, w in enumerate(model.filters):
                mine = slice(k * FILTERS, (k + 1) * FILTERS)
                g = np.zeros_like(w)
                for j in range(len(w)):
                    at_j = where[:, mine] + j
                    g[j] = np.einsum("bf,bfd->df", back[:, mine], x[at_j])
                    changes.append((padded[at_j].reshape(-1, ids.shape[1]), (back[:, mine, None] * w[j].T[None]).reshape(-1, DIMENSIONS)))
                gradients.append(g)
            gradients += [back.sum(0), pooled.T @ error, np.array([error.sum()], np.float32)]
            step += 1
            for p, g, (m, v) in zip(dense, gradients, moments, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-6)
            model.out_bias = float(dense[-1][0])
            for rows, g in changes:  # embeddings: steps that shrink with the squares gathered by each row
                used = np.abs(g).sum(1) > 0
                rows, g = rows[used], g[used]
                for c in range(rows.shape[1]):
                    np.add.at(gathered, rows[:, c], (g * g).sum(1))
                    np.add.at(embedding, rows[:, c], -0.02 * g / np.sqrt(gathered[rows[:, c]])[:, None])
            embedding[0] = 0
    return model


def calibrate(model: Model, texts: list[bytes], toxic: np.ndarray, languages: list[str | None]) -> None:
    """Scale logits to probabilities, then set the general and each language's threshold, on rows kept back."""
    splitter = Words(ALNUM, PREFIXES)
    z = np.array([model.logits(*word_rows(splitter, np.frombuffer(t, np.uint8), np.array([0, len(t)])))[0] for t in texts], np.float64)
    a, b = 1.0, 0.0
    ridge = 1e-2  # keeps the scale finite where the classes are apart
    for _ in range(50):
        p = _sigmoid(a * z + b)
        gradient = np.array([((p - toxic) * z).sum() + ridge * (a - 1), (p - toxic).sum() + ridge * b])
        w = p * (1 - p) + 1e-9
        hessian = np.array([[(w * z * z).sum() + ridge, (w * z).sum()], [(w * z).sum(), w.sum() + ridge]])
        move = np.linalg.solve(hessian, gradient)
        a, b = a - np.clip(move[0], -1, 1), b - np.clip(move[1], -1, 1)
    model.scale = (max(float(a), 0.05), float(b))
    p = _sigmoid(model.scale[0] * z + model.scale[1])
    model.threshold = best_threshold(p, toxic)
    for lang in sorted({x for x in languages if x is not None}):
        mine = np.array([x == lang for x in languages])
        if toxic[mine].sum() >= LEAST_TOXIC:
            model.thresholds[lang] = best_threshold(p[mine], toxic[mine])


def best_threshold(p: np.ndarray, toxic: np.ndarray) -> float:
    """The cut of the highest F1, in the middle of the scores beside it, held between 0.3 and 0.9."""
    order = np.argsort(-p, kind="stable")
    p, y = p[order], toxic[order]
    hits = np.cumsum(y)
    f1 = 2 * hits / (np.arange(1, len(y) + 1) + max(1, y.sum()))
    f1[:-1][p[:-1] == p[1:]] = -1  # a cut can't part equal scores
    best = int(f1.argmax())
    below = p[best + 1] if best + 1 < len(p) else 0.0
    return float(np.clip((p[best] + below) / 2, 0.3, 0.9))


def fit(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", lang: str | None = "lang", label: str = "toxic", usable: Column | None = None, sample_rows: int = SAMPLE_ROWS, sample_bytes: int = SAMPLE_BYTES) -> Model:
    """Fit and calibrate on the bounded sample. ``usable``: which ids (column ``id``) may be learned from."""
    known = labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("y")).where("id is not null and y is not null")
    known = known.where(usable) if usable is not None else known
    first = known.groupBy("id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("id"), "id").limit(sample_rows)
    sample = docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"), (F.col(lang) if lang else F.lit(None).cast("string")).alias("lang"))
    sample = sample.join(F.broadcast(first), "id")  # sample_rows rows of two numbers
    sizes = sample.select("id", F.octet_length("text").alias("n")).toPandas().groupby("id")["n"].sum().to_dict()
    chosen, total = [], 0
    for i in [r["id"] for r in first.collect()]:
        if i in sizes and total + sizes[i] <= sample_bytes:
            total += sizes[i]
            chosen.append(i)
    spark = docs.sparkSession
    wanted = spark.createDataFrame([(i, k) for k, i in enumerate(chosen)], known.select("id", F.lit(0).alias("k")).schema)
    rows = sample.join(F.broadcast(wanted), "id").select("k", "text", "lang", "y").collect()
    rows.sort(key=lambda r: (r["k"], r["text"]))
    toxic = np.array([r["y"] for r in rows], np.float32)
    kept_back = np.array([r["k"] % 5 == 4 for r in rows], bool)
    if len({*toxic[~kept_back].tolist()}) < 2:
        empty = np.zeros((1, DIMENSIONS), np.float32)
        return Model(empty, [], empty[0], empty[0], 0.0, empty=True)
    texts = [r["text"].encode() for r in rows]
    model = train([t for t, k in zip(texts, kept_back, strict=True) if not k], toxic[~kept_back])
    own = kept_back if len({*toxic[kept_back].tolist()}) == 2 else ~kept_back
    calibrate(model, [t for t, k in zip(texts, own, strict=True) if k], toxic[own], [r["lang"] for r, k in zip(rows, own, strict=True) if k])
    return model


def score(docs: DataFrame, model: Model, *, text: str = "text", lang: str | None = "lang", plain: bool = False) -> DataFrame:
    """The input rows with score, threshold (of the row's language) and toxic (score >= threshold);
    ``plain``: as they are, without the toxic ones."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by BUCKETS x DIMENSIONS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter, m = Words(ALNUM, PREFIXES), shared.value
        for batch in batches:
            found = [m.scores(*word_rows(splitter, data, offsets)) for _, _, data, offsets in row_ranges(filled(batch.column("text")))]
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("text"), pa.array(np.concatenate(found) if found else np.zeros(0))], ["row", "text", "score"])

    done = map_texts(docs, text, run, "score double")
    general = F.lit(model.threshold)
    if lang and model.thresholds:
        table = F.create_map(*[F.lit(x) for kv in model.thresholds.items() for x in kv])
        general = F.coalesce(table[F.col(f"row.`{lang}`")], general)
    kept = input_columns(docs, text, () if plain else RESULTS)
    return done.where(F.col("score") < general).select(*kept) if plain else done.select(*kept, "score", general.alias("threshold"), (F.col("score") >= general).alias("toxic"))


def remove_toxic(docs: DataFrame, labels: DataFrame, *, text: str = "text", lang: str | None = "lang", **options) -> DataFrame:
    """The input rows that the classifier does not reject, as they are."""
    return score(docs, fit(docs, labels, text=text, lang=lang, **options), text=text, lang=lang, plain=True)
