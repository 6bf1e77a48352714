"""Toxicity by maximum-scoring segments of token log-odds.

Tokens are runs of letters and digits, lower-cased in ASCII; a token also counts by its first bytes (PREFIXES). All are
hashed into a fixed number of features. A training text doesn't count if it is proven to be a copy of one with the
same label: texts that share their least token trigram are compared on all their trigrams with the smallest doc_id
among them, and by digest with each other. So a copied text's own words aren't taken for the reason of its
label, and what only shares a passage counts. Log-odds with an informative Dirichlet prior (the distribution of all
labelled texts, weighted to `prior` occurrences) and their standard errors come from counts over all training rows; a
token scores as the most certain of its features, less a drift that makes the expected score negative. A scan in
linear time finds every maximal scoring segment of a text. Segment scores are calibrated as extreme values
(Karlin and Altschul: expected number K * m * exp(-lambda * S) of segments as good in m tokens by chance, lambda and K
from the scores of all tokens of the clean training texts); what the
significant ones add up to goes through a logistic curve fitted to the training rows.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tidewatch.llm import bytehash as bh
from tidewatch.llm.common import merged, pieces, saved, small_batches, text_bytes
from tidewatch.llm.near_dedup import packed, unpacked

U = np.uint64
#: Number of hashed features: bounds the model, its counts on the driver and what is sent to executors (2 MB).
FEATURES = 1 << 18
PREFIXES = (4, 5, 6, 7, 8)
#: Rows of labelled scores that the final logistic curve is fitted to, at most.
CURVE_ROWS = 50_000
#: Texts with at least this share of common trigrams (Jaccard) are copies.
COPY = 0.8
#: Bytes that part tokens: ASCII other than letters and digits.
APART = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def _features(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each token of the rows: the row, the hash of the token, and its features (the token and its first bytes)."""
    with np.errstate(over="ignore"):
        data = bh.LOWER[data]
        start, end = bh.words(data, off, APART)
        p = bh.prefix(data)
        word = bh.mix(bh.span(p, start, end))
        of = [word % U(FEATURES)]
        for n in PREFIXES:
            of.append(np.where(end - start > n, bh.mix(bh.span(p, start, np.minimum(end, start + n)) + U(n)) % U(FEATURES), of[0]))
    return np.searchsorted(off, start, "right") - 1, word, np.stack(of).astype(np.int64)


def _trigrams(word: np.ndarray) -> np.ndarray:
    """Hashes of three tokens in a row; the tokens themselves of a text with fewer."""
    with np.errstate(over="ignore"):
        return bh.mix(word[:-2] * U(3) + word[1:-1] * U(5) + word[2:]) if len(word) > 2 else word


def _copies(batches):
    """Adds a key that copies of a text share mostly, the least hash of three tokens in a row, and a digest of all tokens; and packs the text."""
    for b in batches:
        off, data = text_bytes(b.column(1))
        key, digest = np.zeros(b.num_rows, U), [b""] * b.num_rows
        for i, j in pieces(off):
            row, word, _ = _features(data[off[i] : off[j]], off[i : j + 1] - off[i])
            first = np.flatnonzero(np.concatenate([[True], np.diff(row) != 0])) if len(row) else row
            for r, a, z in zip(row[first], first, [*first[1:], len(row)], strict=True):
                key[i + r] = _trigrams(word[a:z]).min()
                digest[i + r] = hashlib.sha256(word[a:z].tobytes()).digest()
        z = next(packed(iter([b])))
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(key.view(np.int64)), pa.array(digest, pa.binary()), z.column(1)], names=["doc_id", "key", "digest", "z"])


def training_rows(documents: DataFrame, known: DataFrame) -> DataFrame:
    """Rows (toxic, z, first) of the labelled texts, packed: of those of one label with equal tokens the one with the smallest doc_id, combined
    before they move; first is the text with the smallest doc_id of those that share the least trigram and label, null for itself.
    It is one row that meets all of its group, which so needs no place of its own."""
    rows = documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(_copies, "doc_id long, key long, digest binary, z binary").join(known.hint("merge"), "doc_id")
    least = F.min(F.struct("doc_id", "z"))
    one = saved(rows.groupBy("key", "toxic", "digest").agg(least.alias("x")).select("key", "toxic", "x.*"))
    first = saved(one.groupBy("key", "toxic").agg(least.alias("f")))
    return merged(one, first, ["key", "toxic"]).select("toxic", "z", F.when(F.col("doc_id") != F.col("f.doc_id"), F.col("f.z")).alias("first"))


def _grams(z) -> np.ndarray:
    off, data = text_bytes(unpacked(pa.array([z], pa.binary())))
    return np.unique(_trigrams(_features(data, off)[1]))


def _counts(batches):
    """In how many texts of each label a feature stands, copies of the group's first left out; a row for each feature that does. Feature FEATURES counts the texts."""
    total = np.zeros((2, FEATURES + 1), np.int64)
    last, theirs = None, np.zeros(0, U)
    for b in batches:
        label, first = b.column("toxic").to_numpy(zero_copy_only=False), b.column("first").to_pylist()
        off, data = text_bytes(unpacked(b.column("z")))
        for i, j in pieces(off):
            row, word, of = _features(data[off[i] : off[j]], off[i : j + 1] - off[i])
            ends = np.searchsorted(row, np.arange(j - i + 1))
            new = np.ones(j - i, bool)
            for r in range(j - i):
                if first[i + r] is not None:
                    if first[i + r] != last:
                        last, theirs = first[i + r], _grams(first[i + r])
                    grams = np.unique(_trigrams(word[ends[r] : ends[r + 1]]))
                    both = len(np.intersect1d(grams, theirs, assume_unique=True))
                    new[r] = both < COPY * (len(grams) + len(theirs) - both)
            seen = np.unique((row * FEATURES + of)[:, new[row]].ravel())
            for y in (0, 1):
                total[y, :FEATURES] += np.bincount(seen[label[i + seen // FEATURES] == y] % FEATURES, minlength=FEATURES)
                total[y, FEATURES] += (new & (label[i:j] == y)).sum()
    some = np.flatnonzero(total.any(0))
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[0, some]), pa.array(total[1, some])], names=["feature", "clean", "toxic"])


def log_odds(clean: np.ndarray, toxic: np.ndarray, prior: float) -> tuple[np.ndarray, np.ndarray]:
    """Log-odds of each feature in toxic against clean texts and their z values, with an informative Dirichlet prior."""
    n0, n1 = max(clean[-1], 1), max(toxic[-1], 1)
    clean, toxic = clean[:-1].astype(float), toxic[:-1].astype(float)
    share = (clean + toxic + 0.5) / (n0 + n1 + 1)
    a0, a1 = clean + prior * share, toxic + prior * share
    # odds of standing in a text
    odds = np.log(a1 / np.maximum(n1 + prior - a1, 0.5)) - np.log(a0 / np.maximum(n0 + prior - a0, 0.5))
    return odds, odds / np.sqrt(1 / a0 + 1 / a1)


def segments(score: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, past, score) in linear time (Ruzzo and Tompa)."""
    out: list[list[float]] = []  # start, past, sum before, sum with it
    good = np.flatnonzero(score > 0)
    if not len(good):
        return []
    total = np.concatenate([[0.0], np.cumsum(score)])
    for i in good.tolist():
        new = [i, i + 1, total[i], total[i + 1]]
        while True:
            j = len(out) - 1
            while j >= 0 and out[j][2] >= new[2]:
                j -= out[j][4]
            if j < 0 or out[j][3] >= new[3]:
                # how far back the next smaller sum before is
                out.append([*new, len(out) - max(j, -1)])
                break
            new = [out[j][0], new[1], out[j][2], new[3]]
            del out[j:]
    return [(int(s), int(e), b - a) for s, e, a, b, _ in out]


def extreme_k(values: np.ndarray, share: np.ndarray, rate: float) -> float:
    """K of Karlin and Altschul for integer scores (values, each with its share) and their lambda, by sums of up to 100 scores."""
    step = int(np.gcd.reduce(values))
    values, rate = values // step, rate * step
    low = int(values.min())
    one = np.zeros(int(values.max()) - low + 1)
    one[values - low] = share
    total, sums = 0.0, np.ones(1)
    for k in range(1, 101):
        sums = np.convolve(sums, one)
        term = (sums * np.exp(rate * np.minimum(np.arange(len(sums)) + k * low, 0))).sum() / k
        total += term
        if term < 1e-6:
            break
    return float(np.exp(-2 * total) / ((values * share * np.exp(rate * values)).sum() * -np.expm1(-rate)))


def _histogram(model):
    """The token scores of each text: hundredths, and how many tokens have them."""

    def run(batches):
        m = model.value
        for b in batches:
            off, data = text_bytes(b.column("text"))
            for i, j in pieces(off):
                row, _, of = _features(data[off[i] : off[j]], off[i : j + 1] - off[i])
                hundredths = np.round(m.token_scores(of) * 100).astype(np.int64) + (1 << 20)
                at, n = np.unique((row << 21) + hundredths, return_counts=True)
                ends = pa.array(np.searchsorted(at >> 21, np.arange(j - i + 1)), pa.int32())
                score = pa.array((at & ((1 << 21) - 1)) - (1 << 20), pa.int32())
                scores = pa.StructArray.from_arrays([score, pa.array(n, pa.int64())], names=["score", "n"])
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(i, j - i), pa.ListArray.from_arrays(ends, scores)], names=["doc_id", "scores"])

    return run


class Model:
    """The score of each pair of features, the extreme-value parameters and the logistic curve."""

    def __init__(self, clean: np.ndarray, toxic: np.ndarray, prior: float, drift: float, least: float):
        self.odds, self.z = log_odds(clean, toxic, prior)
        self.odds = np.where(np.abs(self.z) >= least, self.odds, 0).clip(-4, 4).astype(np.float32)
        self.z = np.abs(self.z).astype(np.float32)
        self.drift = drift
        self.rate, self.k = 1.0, 0.1
        self.curve = (-3.0, 0.5)

    def fit_rate(self, values: np.ndarray, n: np.ndarray) -> None:
        """lambda and K from how often (n) which token score (values, in hundredths) stands in clean texts.

        lambda is the positive root of E exp(lambda * score) = 1. Where no score is positive, or the mean isn't negative, there
        is none: lambda then ends at a bound and K stays.
        """
        share, lo, hi = n / n.sum(), 1e-3, 8.0
        for _ in range(60):
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if (np.exp(np.minimum(mid * values / 100, 50)) * share).sum() < 1 else (lo, mid)
        self.rate = lo
        if values.max() > 0 > (values * share).sum():
            self.k = extreme_k(values, share, lo / 100)

    def token_scores(self, of: np.ndarray) -> np.ndarray:
        return self.odds[of[self.z[of].argmax(0), np.arange(of.shape[1])]] - self.drift

    def evidence(self, score: np.ndarray) -> tuple[float, list[tuple[int, int, float]]]:
        """What the significant segments of a text add up to, in nats against chance, and the segments."""
        found, m = [], np.log(self.k * max(len(score), 1))
        for start, past, s in segments(score):
            nats = self.rate * s - m
            if nats > 0:
                found.append((start, past, nats))
        return float(np.log1p(sum(x[2] for x in found))), found


def _raw(model, with_spans: bool, with_text: bool = False):
    """Adds the evidence to all columns but the text, or to all."""

    def run(batches):
        m = model.value
        for b in batches:
            off, data = text_bytes(b.column("text"))
            x, spans = np.zeros(b.num_rows), [[] for _ in range(b.num_rows)]
            for i, j in pieces(off):
                row, _, of = _features(data[off[i] : off[j]], off[i : j + 1] - off[i])
                score = m.token_scores(of)
                for r in np.unique(row[score > 0]):
                    own = slice(*np.searchsorted(row, (r, r + 1)))
                    x[i + r], found = m.evidence(score[own])
                    if with_spans:
                        spans[i + r] = [{"first": s, "past": e, "nats": n} for s, e, n in found]
            own = [i for i, n in enumerate(b.schema.names) if with_text or n != "text"]
            cols = [*[b.column(i) for i in own], pa.array(x)]
            names = [*[b.schema.names[i] for i in own], "evidence"]
            if with_spans:
                cols.append(pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("past", pa.int64()), ("nats", pa.float64())]))))
                names.append("passages")
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return run


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Intercept and slope by Newton steps with a slight ridge."""
    w, a = np.zeros(2), np.stack([np.ones(len(x)), x], 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        g = a.T @ (p - y) + 1e-3 * w
        h = (a * (p * (1 - p))[:, None]).T @ a + 1e-3 * np.eye(2)
        w = w - np.clip(np.linalg.solve(h, g), -5, 5)
    return float(w[0]), float(max(w[1], 1e-6))


def fit(documents: DataFrame, labels: DataFrame, prior: float = 10.0, drift: float = 1.5, least: float = 2.5) -> Model:
    """A model from the labelled rows of documents (doc_id, text) that aren't held out, labels being (doc_id, toxic 0/1).

    Held out is a crc32 of doc_id as text that leaves 2 modulo 4. Counts are over all rows; only the two numbers of the
    curve come from a hashed sample of about CURVE_ROWS rows. No rows give a model that calls nothing toxic; rows with a
    null doc_id or another label are left aside; of a doc_id labelled twice the higher label counts.
    """
    spark = documents.sparkSession
    small_batches(spark)
    known = labels.where("doc_id is not null and toxic in (0, 1)").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    known = known.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2)
    found = training_rows(documents, known).mapInArrow(_counts, "feature long, clean long, toxic long").groupBy("feature").agg(F.sum("clean"), F.sum("toxic")).toArrow()
    counts = np.zeros((2, FEATURES + 1), np.int64)
    at = found.column(0).to_numpy()
    counts[0, at], counts[1, at] = found.column(1).to_numpy(), found.column(2).to_numpy()
    model = Model(counts[0], counts[1], prior, drift, least)
    n = known.count()
    if counts[:, -1].sum():
        first = spark.sparkContext.broadcast(model)
        scores = documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(_histogram(first), "doc_id long, scores array<struct<score: int, n: long>>")
        scores = scores.join(known.where("toxic = 0"), "doc_id").select(F.inline("scores")).groupBy("score").agg(F.sum("n")).toArrow()
        if scores.num_rows:
            model.fit_rate(scores.column(0).to_numpy().astype(np.int64), scores.column(1).to_numpy())
        some = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) <= int(CURVE_ROWS / n * (1 << 20)))
        sent = spark.sparkContext.broadcast(model)
        got = documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(_raw(sent, False), "doc_id long, evidence double").join(some, "doc_id").select("evidence", "toxic").toArrow()
        model.curve = _logistic(got.column(0).to_numpy(), got.column(1).to_numpy())
    return model


def _score(model: Model, evidence: Column) -> Column:
    a, b = model.curve
    return 1 / (1 + F.exp(-(F.lit(a) + F.lit(b) * evidence)))


def without_toxic(documents: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """The rows of documents that toxicity() doesn't predict to be toxic, with all their columns, in one pass."""
    spark = documents.sparkSession
    small_batches(spark)
    names = [f"c{i}" if n != "text" else n for i, n in enumerate(documents.columns)]  # no clash with the new column
    rows = documents.toDF(*names)
    scored = rows.mapInArrow(_raw(spark.sparkContext.broadcast(model), False, True), StructType([*rows.schema.fields, StructField("evidence", DoubleType())]))
    return scored.where(_score(model, F.col("evidence")) < threshold).select(*names).toDF(*documents.columns)


def toxicity(documents: DataFrame, model: Model, threshold: float = 0.3, with_spans: bool = False) -> DataFrame:
    """One row for each row of documents (doc_id, text): doc_id, score in 0 to 1, predicted (1 from `threshold` on), and with_spans the significant passages as token ranges.

    Scores depend on the text alone; null and empty texts get the score of no evidence; equal rows equal scores; other
    columns are ignored; an empty table gives an empty result.
    """
    spark = documents.sparkSession
    small_batches(spark)
    sent = spark.sparkContext.broadcast(model)
    extra = ", passages array<struct<first: long, past: long, nats: double>>" if with_spans else ""
    out = documents.select("doc_id", "text").mapInArrow(_raw(sent, with_spans), f"doc_id {documents.schema['doc_id'].dataType.simpleString()}, evidence double{extra}")
    out = out.withColumn("score", _score(model, F.col("evidence"))).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
    return out.select("doc_id", "score", "predicted", *["passages"] * with_spans)
