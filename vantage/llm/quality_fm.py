"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

score = sigmoid(w0 + sum w_i x_i + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)): pairwise
interactions of low rank in time linear in the number of features. Features of a text: its distinct
words hashed into buckets (damped counts, scaled to length one), bins of statistics of its structure,
and bins of its size. It is fitted on a bounded, documented number of labelled rows and scores every
whole text in one pass without a shuffle.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vantage.llm.base import blank, release, ship

BUCKETS = 1 << 16
BINS = 12
#: Statistics of a text, each cut into BINS parts of [0, 1].
STATS = ("upper", "digit", "symbol", "mark", "blank", "distinct", "top", "pair", "line", "word", "size", "lines")
N_FEATURES = BUCKETS + len(STATS) * BINS


def features(text: str, cache: dict[str, int]) -> tuple[list[int], list[float]]:
    """(feature numbers, values) of one text; an empty text has its statistics only."""
    import math

    words = text.split()
    n = max(len(words), 1)
    counts = Counter(words)
    ids = []
    for word in counts:
        at = cache.get(word)
        if at is None:
            if len(cache) > 400_000:
                cache.clear()
            at = cache[word] = zlib.crc32(word.lower().encode()) % BUCKETS
        ids.append(at)
    values = [1.0 if c == 1 else 1.0 + math.log(c) for c in counts.values()]
    norm = math.sqrt(sum(v * v for v in values)) or 1.0
    values = [v / norm for v in values]

    size = max(len(text), 1)
    raw = text.encode()
    upper = len(raw) - len(raw.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    digit = len(raw) - len(raw.translate(None, b"0123456789"))
    symbol = len(raw) - len(raw.translate(None, b"#$%&*@^~|<>{}[]=+_\\/"))
    mark = len(raw) - len(raw.translate(None, b".,;:!?\"'()-"))
    lines = text.split("\n")
    top = max(counts.values(), default=0)
    pairs = len(set(zip(words, words[1:]))) / max(len(words) - 1, 1)
    stats = (upper / size, 5 * digit / size, 5 * symbol / size, 2 * mark / size, 2 * (len(words) / size),
             len(counts) / n, top / n, pairs, len(set(lines)) / len(lines), (size / n) / 20,
             math.log1p(n) / 12, math.log1p(len(lines)) / 10)
    for k, x in enumerate(stats):
        ids.append(BUCKETS + k * BINS + min(int(max(x, 0.0) * BINS), BINS - 1))
        values.append(0.5)
    return ids, values


def _flat(texts: list[str], cache: dict[str, int]):
    import numpy as np

    ids, values, lens = [], [], np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        a, b = features(text, cache)
        ids += a
        values += b
        lens[i] = len(a)
    return np.array(ids, np.int64), np.array(values, np.float32), lens


@dataclass
class FactorisationMachine:
    bias: float
    weight: object  # N_FEATURES
    factor: object  # N_FEATURES x rank

    def logits(self, ids, values, lens):
        """Scores before the sigmoid; every row has at least one feature."""
        import numpy as np

        starts = np.cumsum(lens) - lens
        x = values[:, None]
        vx = self.factor[ids] * x
        total = np.add.reduceat(vx, starts)
        return (self.bias + np.add.reduceat(self.weight[ids] * values, starts)
                + 0.5 * (total ** 2 - np.add.reduceat(vx ** 2, starts)).sum(1))


def fit(ids, values, lens, labels, rank: int = 8, epochs: int = 8, batch: int = 256, rate: float = 0.15,
        decay: float = 1e-5, seed: int = 7) -> FactorisationMachine:
    """Logistic loss, mini-batches, Adagrad steps. No rows: a model that scores 0.5."""
    import numpy as np

    rng = np.random.default_rng(seed)
    model = FactorisationMachine(0.0, np.zeros(N_FEATURES, np.float32),
                                 rng.normal(0, 0.02, (N_FEATURES, rank)).astype(np.float32))
    if not len(lens):
        return model
    seen_w, seen_v, seen_b = np.full(N_FEATURES, 1e-4, np.float32), np.full((N_FEATURES, rank), 1e-4, np.float32), 1e-4
    starts = np.cumsum(lens) - lens
    for _ in range(epochs):
        order = rng.permutation(len(lens))
        for a in range(0, len(order), batch):
            rows = order[a:a + batch]
            n = lens[rows]
            at = np.arange(int(n.sum())) + np.repeat(starts[rows] - (np.cumsum(n) - n), n)
            i, x = ids[at], values[at]
            error = 1 / (1 + np.exp(-model.logits(i, x, n))) - labels[rows]
            total = np.add.reduceat(model.factor[i] * x[:, None], np.cumsum(n) - n)
            g = (np.repeat(error, n) * x / len(rows)).astype(np.float32)
            sort = np.argsort(i, kind="stable")
            own, first = np.unique(i[sort], return_index=True)
            grad_w = np.add.reduceat(g[sort], first) + decay * model.weight[own]
            terms = g[:, None] * (np.repeat(total, n, 0) - model.factor[i] * x[:, None])
            grad_v = np.add.reduceat(terms[sort], first) + decay * model.factor[own]
            seen_w[own] += grad_w ** 2
            seen_v[own] += grad_v ** 2
            model.weight[own] -= rate * grad_w / np.sqrt(seen_w[own])
            model.factor[own] -= 0.2 * rate * grad_v / np.sqrt(seen_v[own])
            grad_b = float(error.mean())
            seen_b += grad_b ** 2
            model.bias -= rate * grad_b / seen_b ** 0.5
    return model


def train(docs: DataFrame, labels: DataFrame, max_rows: int = 10_000) -> FactorisationMachine:
    """Fit on at most ``max_rows`` labelled documents (those with the smallest hash of their id).

    ``labels`` has (doc_id, label 0 or 1); several labels of one id are averaged, null ones ignored. Of
    several texts of one id the smallest counts. Only the sampled rows' features reach the driver.
    """
    import numpy as np

    spark = docs.sparkSession
    ship(spark)
    chosen = (labels.where(F.col("doc_id").isNotNull() & F.col("label").isNotNull()).groupBy("doc_id")
              .agg((F.avg("label") >= 0.5).cast("int").alias("label"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows))
    rows = docs.select("doc_id", blank(F.col("text")).alias("text")).join(F.broadcast(chosen), "doc_id")
    # one row per chosen id, whatever number of rows has it; reduced before the shuffle
    rows = rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.min("label").alias("label"))

    def extract(batches: Iterator) -> Iterator:
        import pyarrow as pa

        cache: dict[str, int] = {}
        for part in batches:
            found = [features(t, cache) for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(2), pa.array([f[0] for f in found], pa.list_(pa.int32())),
                 pa.array([f[1] for f in found], pa.list_(pa.float32()))], ["doc_id", "label", "ids", "values"])

    table = rows.select("doc_id", "text", "label").mapInArrow(
        extract, "doc_id long, label int, ids array<int>, values array<float>").toArrow()
    table = table.sort_by([("doc_id", "ascending")])
    column = {c: table.column(c).combine_chunks() for c in table.column_names}
    lens = np.diff(column["ids"].offsets.to_numpy())
    return fit(column["ids"].flatten().to_numpy().astype(np.int64), column["values"].flatten().to_numpy(), lens.astype(np.int64),
               column["label"].to_numpy().astype(np.float32))


def score(docs: DataFrame, model: FactorisationMachine, threshold: float = 0.3) -> DataFrame:
    """The columns of ``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on).

    These replace input columns of the same name. A null text is scored as an empty one; ids and
    other columns may hold anything; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    ship(spark)
    kept = [c for c in docs.columns if c.lower() not in ("score", "predicted")]
    source = docs.select(*[F.col(f"`{c}`") for c in kept])
    shared = spark.sparkContext.broadcast((model.bias, model.weight, model.factor))

    def apply(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        from vantage.llm.unit_cache import text_slices

        own = FactorisationMachine(*shared.value)
        cache: dict[str, int] = {}
        for part in text_slices(batches, "text", 1 << 20):
            texts = [t or "" for t in part.column(part.schema.get_field_index("text")).to_pylist()]
            p = 1 / (1 + np.exp(-own.logits(*_flat(texts, cache)).astype(np.float64)))
            yield pa.RecordBatch.from_arrays(part.columns + [pa.array(p), pa.array((p >= threshold).astype(np.int32))],
                                             kept + ["score", "predicted"])
        del own, cache
        release()

    return source.mapInArrow(apply, StructType(source.schema.fields + StructType.fromDDL("score double, predicted int").fields))


def held_out(doc_id: str = "doc_id"):
    """Rows no label is learned from; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string")) % 5 == 0


def quality_model(docs: DataFrame, labels: DataFrame, max_rows: int = 10_000) -> FactorisationMachine:
    """The model of ``labels.quality``, learned from rows that are not held out."""
    return train(docs, labels.where(~held_out()).select("doc_id", F.col("quality").alias("label")), max_rows)
