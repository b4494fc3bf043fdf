"""Language identification with a byte convolutional network, trained in numpy.

A text's UTF-8 bytes are cut into windows of ``WINDOW`` bytes (the last one is
padded). Every byte is embedded, filters of widths 2, 3 and 4 slide over the
window, each filter keeps its maximum (max pooling) and a softmax layer gives the
languages' probabilities. A text's score for a language is the mean over all its
windows, weighted by their bytes; the whole text is read.

Applying a filter is adding rows of small tables (embedding times filter weights,
worked out once per task), so inference is lookups and additions over batches of
windows.

Training rows: for each language, windows at hash-chosen places of at most
``SAMPLE_PER_LANG`` labelled documents (smallest hashes of the id) go to the
driver: languages x SAMPLE_PER_LANG x WINDOW bytes at most.

Defined results: null text or text without a letter gives ``und`` with score 0.0;
with no labelled row every text is ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNKNOWN = "und"
WINDOW = 256
SAMPLE_PER_LANG = 2500
SALTS = 64  # parts in which a language's ids are ranked before its smallest hashes are picked
WIDTHS = (2, 3, 4)
FILTERS = 16  # per width
EMBED = 12
EPOCHS = 6
BATCH_WINDOWS = 512  # windows held at once when applied
SEED = 20240607


def windows_of(data: bytes) -> np.ndarray:
    """(windows, WINDOW) matrix of byte codes 1..256, padded with 0."""
    n = max(1, -(-len(data) // WINDOW))
    out = np.zeros(n * WINDOW, np.int16)
    out[:len(data)] = np.frombuffer(data, np.uint8).astype(np.int16) + 1
    return out.reshape(n, WINDOW)


class ByteConvNet:
    """Embedding, filters of several widths, max pooling, softmax."""

    def __init__(self, langs: list[str], rng: np.random.Generator):
        self.langs = langs
        self.embed = rng.normal(0, 0.5, (257, EMBED)).astype(np.float32)
        self.filters = [rng.normal(0, (2 / (w * EMBED)) ** 0.5, (w, EMBED, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.bias = np.zeros((len(WIDTHS), FILTERS), np.float32)
        self.out = rng.normal(0, 0.2, (len(WIDTHS) * FILTERS, len(langs))).astype(np.float32)
        self.out_bias = np.zeros(len(langs), np.float32)

    def weights(self) -> list[np.ndarray]:
        return [self.embed, *self.filters, self.bias, self.out, self.out_bias]

    def tables(self) -> list[list[np.ndarray]]:
        """For each width and place in the filter, byte code -> FILTERS numbers."""
        return [[self.embed @ f[j] for j in range(f.shape[0])] for f in self.filters]

    def pooled(self, codes: np.ndarray, tables: list[list[np.ndarray]], where: bool = False):
        """Maximum over places for every filter; with ``where`` also the places."""
        best, places = [], []
        for k, rows in enumerate(tables):
            w = len(rows)
            m = codes.shape[1] - w + 1
            conv = rows[0][codes[:, :m]]
            for j in range(1, w):
                conv += rows[j][codes[:, j:j + m]]
            if where:
                at = conv.argmax(1)
                places.append(at)
                best.append(np.take_along_axis(conv, at[:, None, :], 1)[:, 0] + self.bias[k])
            else:
                best.append(conv.max(1) + self.bias[k])
        pooled = np.concatenate(best, 1)
        return (pooled, places) if where else pooled

    def probabilities(self, codes: np.ndarray, tables: list[list[np.ndarray]] | None = None) -> np.ndarray:
        hidden = np.maximum(self.pooled(codes, tables or self.tables()), 0)
        z = hidden @ self.out + self.out_bias
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)

    def gradients(self, codes: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        """Cross-entropy gradients, in the order of ``weights``; only pooled places pass any back."""
        n = len(codes)
        pre, places = self.pooled(codes, self.tables(), where=True)
        hidden = np.maximum(pre, 0)
        z = hidden @ self.out + self.out_bias
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        p[np.arange(n), y] -= 1
        p /= n
        back = (p @ self.out.T) * (pre > 0)
        g_embed = np.zeros_like(self.embed)
        g_filters, g_bias = [], np.zeros_like(self.bias)
        for k, w in enumerate(WIDTHS):
            g = back[:, k * FILTERS:(k + 1) * FILTERS]
            g_bias[k] = g.sum(0)
            gf = np.zeros_like(self.filters[k])
            for j in range(w):
                code = np.take_along_axis(codes, places[k] + j, 1)  # (n, FILTERS)
                gf[j] = np.einsum("nfe,nf->ef", self.embed[code], g)
                np.add.at(g_embed, code, g[:, :, None] * self.filters[k][j].T[None])
            g_filters.append(gf)
        return [g_embed, *g_filters, g_bias, hidden.T @ p, p.sum(0)]


def train(data: list[bytes], labels: list[str], epochs: int = EPOCHS, batch: int = 64) -> ByteConvNet:
    """Adam on cross-entropy over windows; the same rows give the same network."""
    langs, rng = sorted(set(labels)), np.random.default_rng(SEED)
    net = ByteConvNet(langs, rng)
    codes = np.concatenate([windows_of(d[:WINDOW])[:1] for d in data])
    y = np.array([langs.index(x) for x in labels])
    params = net.weights()
    first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for epoch in range(epochs):
        rate = 0.01 * (1 - epoch / epochs)
        order = rng.permutation(len(codes))
        for a in range(0, len(order), batch):
            rows = order[a:a + batch]
            step += 1
            for p, m, v, g in zip(params, first, second, net.gradients(codes[rows], y[rows])):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return net


def training_windows(docs: DataFrame, keep: Column, doc_id: str = "doc_id", text: str = "text",
                     lang: str = "lang", per_lang: int = SAMPLE_PER_LANG) -> DataFrame:
    """(lang, piece): a piece of WINDOW characters at a hash-chosen place of each sampled document."""
    known = docs.filter(keep & F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(doc_id).alias("id"), F.col(lang).alias("lang"), F.xxhash64(F.col(doc_id).cast("string")).alias("h"),
        F.col(text).alias("text"))
    ids = known.select("id", "lang", "h", F.pmod("h", F.lit(SALTS)).alias("salt"))
    order = ["h", "id"]  # ranked within salts first, so that a language's ids don't meet in one task
    few = (ids.withColumn("r", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order)))
           .filter(F.col("r") <= per_lang))
    chosen = (few.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
              .filter(F.col("r") <= per_lang))
    n = F.length("text")
    place = F.when(n > WINDOW, F.pmod(F.xxhash64("h"), (n - WINDOW).cast("bigint"))).otherwise(0).cast("int") + 1
    return (known.join(F.broadcast(chosen.select("id", "lang").distinct()), ["id", "lang"])  # languages x per_lang ids
            .select("lang", F.substring(F.col("text"), place, F.lit(WINDOW)).alias("piece"), "h")
            .filter(F.col("piece").rlike(r"\p{L}")).groupBy("lang", "h").agg(F.min("piece").alias("piece")))


def fit(docs: DataFrame, keep: Column, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
        per_lang: int = SAMPLE_PER_LANG) -> ByteConvNet | None:
    """Network trained on the sampled labelled rows that ``keep`` admits; None if there are none."""
    rows = sorted((r["h"], r["lang"], r["piece"]) for r in
                  training_windows(docs, keep, doc_id, text, lang, per_lang).collect())
    if not rows:
        return None
    return train([p.encode() for _, _, p in rows], [x for _, x, _ in rows])


def predicted(text: str | Column, net: ByteConvNet | None) -> Column:
    """STRUCT(lang, score) for a text column."""

    @F.arrow_udf("struct<lang:string,score:double>")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tables = net.tables() if net else None
        for texts in batches:
            langs, scores = [], []
            for group in _grouped(texts):
                blocks = [b for _, b in group if b is not None]
                means = iter(_means(net, tables, blocks)) if net and blocks else iter(())
                for _, b in group:
                    if b is None or net is None:
                        langs.append(UNKNOWN)
                        scores.append(0.0)
                    else:
                        p = next(means)
                        langs.append(net.langs[int(p.argmax())])
                        scores.append(min(1.0, float(p.max())))
            yield pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                             ["lang", "score"])

    return of(text)


def _grouped(texts: pa.Array) -> Iterator[list[tuple[int, bytes | None]]]:
    """Runs of rows with about BATCH_WINDOWS windows together; None for rows without a letter."""
    group, size = [], 0
    for i, value in enumerate(texts):
        t = value.as_py()
        data = t.encode() if t is not None and any(map(str.isalpha, t)) else None
        group.append((i, data))
        size += 1 + len(data or b"") // WINDOW
        if size >= BATCH_WINDOWS:
            yield group
            group, size = [], 0
    if group:
        yield group


def _means(net: ByteConvNet, tables: list[list[np.ndarray]], blocks: list[bytes]) -> list[np.ndarray]:
    """Byte-weighted mean window probabilities of each block."""
    counts = [max(1, -(-len(b) // WINDOW)) for b in blocks]
    total = [np.zeros(len(net.langs)) for _ in blocks]
    owner = np.repeat(np.arange(len(blocks)), counts)
    weight = np.concatenate([np.minimum(WINDOW, len(b) - WINDOW * np.arange(c)) for b, c in zip(blocks, counts)])
    codes = np.concatenate([windows_of(b) for b in blocks])
    for a in range(0, len(codes), BATCH_WINDOWS):  # a very long text in several rounds
        p = net.probabilities(codes[a:a + BATCH_WINDOWS], tables) * weight[a:a + BATCH_WINDOWS, None]
        for i in np.unique(owner[a:a + BATCH_WINDOWS]):
            total[i] += p[owner[a:a + BATCH_WINDOWS] == i].sum(0)
    return [t / max(1, len(b)) for t, b in zip(total, blocks)]
