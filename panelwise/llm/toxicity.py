"""Toxicity by a factorization machine over hashed terms.

The logit of a text is ``b + sum w_i + sum <v_i, v_j>`` over the pairs of its distinct terms: besides each term's own weight,
the model learns what two terms mean together, such as an insult and the mention of a group, which additive weights
miss. Terms are words and the beginnings of words (so inflected forms share something), hashed into 2^18 numbers.

The model is fitted on a bounded sample of the labelled rows (``max_rows`` of each class, those with the smallest hash of
the id), once per distinct text. Everything else covers all documents: each is scored once, on its whole text, in the
tasks that read it, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwise.llm.common import NO_LETTERS, SLICE_BYTES, WordHasher, bound_batches, broadcast_if_small, byte_views, col, fresh, slices

TERM_BITS = 18
#: Stems of so many bytes join the words.
STEMS = [4, 5, 6, 8]
FACTORS = 8
#: Labelled texts that must hold a term for it to take part.
LEAST_SEEN = 4
LEAST_STEPS = 700
#: Labelled rows of each class to fit on, at most.
MAX_ROWS = 8000
THRESHOLD = 0.3


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def terms(texts: list[memoryview], hasher: WordHasher) -> list[np.ndarray]:
    """The sorted distinct term numbers of each text; a long text is worked through in parts that end between words."""
    out = []
    for first, last in slices([len(t) for t in texts]):
        if len(texts[first]) > 2 * SLICE_BYTES:
            parts = [terms([memoryview(p)], hasher)[0] for p in hasher._cut(np.frombuffer(texts[first], np.uint8))]
            out.append(np.unique(np.concatenate(parts)))
            continue
        found, at = hasher.stems(texts[first:last], STEMS)
        found = (found & np.uint64((1 << TERM_BITS) - 1)).astype(np.int32)
        out += [np.unique(found[a:b]) for a, b in zip(at.tolist(), at.tolist()[1:])]
    return out


def _margins(bounds: np.ndarray, flat: np.ndarray, bias: float, w: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Logits of the texts whose (known) terms stand one after the other, and the sums of their factors."""
    n = len(bounds) - 1
    owner = np.repeat(np.arange(n), np.diff(bounds))
    own = v[flat]
    sums = np.stack([np.bincount(owner, own[:, f], n) for f in range(v.shape[1])], 1)
    squares = np.bincount(owner, (own * own).sum(1), n)
    return bias + np.bincount(owner, w[flat], n) + 0.5 * ((sums * sums).sum(1) - squares), sums


def fit(sets: list[np.ndarray], labels: np.ndarray, weights: np.ndarray, epochs: int = 12, rate: float = 0.2, decay: float = 1e-4, penalty: float = 0.0125) -> dict:
    """Logistic loss, AdaGrad on batches, over all terms that ``LEAST_SEEN`` texts hold, whatever each says alone.

    Own weights are drawn to 0 by ``penalty``, as strongly as by so many texts, factors by ``decay`` and by AdaGrad sums that
    start high: the factors of rare terms hardly move, which in texts of thousands of terms would otherwise outweigh all
    else. Small samples are passed over more often, for ``LEAST_STEPS`` batches in all.
    """
    size = 1 << TERM_BITS
    mass = weights.sum()
    if not len(sets) or not mass:
        return {"known": np.zeros(0, np.int32), "w": np.zeros(0), "v": np.zeros((0, FACTORS)), "bias": 0.0}
    share = float((weights * labels).sum() / mass)
    seen = np.zeros(size, np.int64)
    for s in sets:
        seen[s] += 1
    known = np.flatnonzero(seen >= LEAST_SEEN).astype(np.int32)
    place = np.full(size, -1, np.int32)
    place[known] = np.arange(len(known))
    own = [p[p >= 0] for p in (place[s] for s in sets)]
    starts = np.concatenate(([0], np.cumsum([len(p) for p in own])))
    flat = np.concatenate(own)
    del own

    random = np.random.default_rng(5)
    w, v = np.zeros(len(known)), random.normal(0, 0.01, (len(known), FACTORS))
    bias = float(np.log((share + 1e-6) / (1 - share + 1e-6)))
    w_sum, v_sum, b_sum = np.full(len(known), 1e-3), np.full((len(known), FACTORS), 3.0), 1e-3
    scale = weights / weights.mean()
    for _ in range(max(epochs, -(-LEAST_STEPS // -(-len(sets) // 256)))):
        order = random.permutation(len(sets))
        for first in range(0, len(order), 256):
            rows = order[first : first + 256]
            counts = starts[rows + 1] - starts[rows]
            bounds = np.concatenate(([0], np.cumsum(counts)))
            # Only the batch's own terms are touched.
            local, ids = np.unique(flat[np.repeat(starts[rows] - bounds[:-1], counts) + np.arange(bounds[-1])], return_inverse=True)
            margin, sums = _margins(bounds, ids, bias, w[local], v[local])
            gap = scale[rows] * (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels[rows]) / len(rows)
            each = np.repeat(np.arange(len(rows)), counts)
            pull = np.bincount(ids, gap[each], len(local))
            dw = pull + decay * w[local]
            dv = np.stack([np.bincount(ids, (gap * sums[:, f])[each], len(local)) for f in range(FACTORS)], 1) + (decay - pull[:, None]) * v[local]
            db = gap.sum()
            w_sum[local] += dw * dw
            v_sum[local] += dv * dv
            b_sum += db * db
            step = rate / np.sqrt(w_sum[local])
            moved = w[local] - step * dw
            w[local] = np.sign(moved) * np.maximum(np.abs(moved) - step * penalty / len(sets) ** 0.5, 0)
            v[local] -= rate * 0.3 * dv / np.sqrt(v_sum[local])
            bias -= rate * db / b_sum**0.5
    return {"known": known, "w": w, "v": v, "bias": bias}


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label_id: str = "doc_id", label: str = "toxic", max_rows: int = MAX_ROWS) -> dict:
    """The fitted model. Labels of held-out ids, null ids and null labels are left out; of several labels the largest holds.

    The sample is bounded, so it fits one task; the driver gets the model only. Without labels every text scores 0.5.
    """
    bound_batches(docs.sparkSession)
    own = labels.select(col(label_id).alias("id"), col(label).cast("int").alias("y")).filter(F.col("id").isNotNull() & F.col("y").isNotNull())
    own = own.filter(~held_out(F.col("id"))).groupBy("id").agg((F.max("y") > 0).cast("int").alias("y"))
    counts = {r["y"]: r["n"] for r in own.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    picked = None
    for y, n in counts.items():
        part = own.filter(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(max_rows).withColumn("weight", F.lit(n / min(n, max_rows)))
        picked = part if picked is None else picked.unionByName(part)
    if picked is None:
        return fit([], np.zeros(0), np.zeros(0))
    texts = docs.select(col(doc_id).alias("id"), F.coalesce(col(text).cast("string"), F.lit("")).alias("text"))
    rows = texts.join(broadcast_if_small(picked, 2 * max_rows, 64), "id").groupBy(F.md5("text").alias("digest")).agg(F.first("text").alias("text"), F.max("y").alias("y"), F.max("weight").alias("weight"))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(NO_LETTERS)
        for batch in batches:
            sets = terms(byte_views(batch.column("text")), hasher)
            yield pa.RecordBatch.from_arrays([batch.column("digest"), pa.array([s.tobytes() for s in sets], pa.binary()), batch.column("y"), batch.column("weight")], names=["digest", "terms", "y", "weight"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if len(b)]
        if held:
            t = pa.Table.from_batches(held).sort_by("digest")
            model = fit([np.frombuffer(x, np.int32) for x in t.column("terms").to_pylist()], t.column("y").to_numpy().astype(float), t.column("weight").to_numpy())
        else:
            model = fit([], np.zeros(0), np.zeros(0))
        yield pa.RecordBatch.from_pylist([{"known": model["known"].tobytes(), "w": model["w"].tobytes(), "v": model["v"].tobytes(), "bias": model["bias"]}])

    got = rows.mapInArrow(features, "digest string, terms binary, y int, weight double").repartition(1).mapInArrow(learn, "known binary, w binary, v binary, bias double").first()
    if got is None:
        return fit([], np.zeros(0), np.zeros(0))
    return {"known": np.frombuffer(got["known"], np.int32), "w": np.frombuffer(got["w"]), "v": np.frombuffer(got["v"]).reshape(-1, FACTORS), "bias": got["bias"]}


def score(docs: DataFrame, model: dict, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the probability of being toxic, from the whole text. Null and empty texts get the score of no terms.

    A column of the name ``out`` is replaced. Scores of identical texts are identical; an empty table stays empty.
    """
    bound_batches(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        hasher, m = WordHasher(NO_LETTERS), model.value
        place = np.full(1 << TERM_BITS, -1, np.int32)
        place[m["known"]] = np.arange(len(m["known"]))
        for texts in batches:
            out = []
            views = byte_views(texts)
            for first, last in slices([len(t) for t in views]):
                own = [p[p >= 0] for p in (place[s] for s in terms(views[first:last], hasher))]
                bounds = np.concatenate(([0], np.cumsum([len(p) for p in own])))
                margin, _ = _margins(bounds, np.concatenate(own), m["bias"], m["w"], m["v"])
                out.append(1 / (1 + np.exp(-np.clip(margin, -30, 30))))
            yield pa.array(np.concatenate(out) if out else np.zeros(0), pa.float64())

    scorer = F.arrow_udf(run, "double", F.ArrowUDFType.SCALAR_ITER)
    return docs.withColumn(out, scorer(F.coalesce(col(text).cast("string"), F.lit(""))))


def drop_toxic(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score below ``threshold``, with all their columns."""
    (name,) = fresh(docs, "_toxicity")
    scored = score(docs, train(docs, labels, doc_id, text), text, name)
    return scored.filter(col(name) < threshold).select(*[col(c) for c in docs.columns])
