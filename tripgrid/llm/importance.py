"""Quality classifier by importance resampling of hashed n-grams.

Two generative models of hashed unigrams and bigrams are counted: ``target`` over labelled good
documents, ``raw`` over all documents. A document's log importance weight compares them; documents
are sampled by Gumbel top-k, that is the ``k`` largest weights after adding Gumbel noise.

The log ratio of one n-gram is ``log(target share / raw share)``. Of a document two things are taken:

* ``tell``: what its unigrams say against it. Only ratios below ``-DOUBT`` count, so that words too
  rare for the target sample say nothing. Summed and divided by the root of the length.
* ``style``: the mean ratio over all its unigrams and bigrams in a smaller table, drawn towards 0 in
  short texts.

Both are centred on a low quantile of labelled good documents the models did not count (``STRICT``)
and scaled by its distance from their median; the smaller of the two is the log weight. ``k`` is the
number of documents with a weight of 0 or more unless given, and the noise is scaled by
``TEMPERATURE``, so sampling only matters near the border.

Counts run over all documents. The target and the quantiles come from a bounded sample of labelled
rows (``most_labels``, by hash order); of each id in it one row reaches the driver, however many copies
there are. Tables of weights have a fixed size. Without good labels the border is arbitrary (-1, with the
median 0), and all documents with n-grams near the corpus's own mean are kept.

A document without n-grams (null, empty, blanks only) has null weights and is not kept. Ties at the
cut are all kept, so repeated rows stay or go together.
"""

import re
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from .common import Staging, matching

TELL_BITS, STYLE_BITS = 20, 16
DOUBT, STRICT, TEMPERATURE = 2.0, 0.001, 0.01
# So many n-grams without evidence are added to each document, so short ones are not judged by chance.
CALM = 50
MOST_LABELS = 40_000
# One labelled document in so many is kept from the models, to place the border.
HELD = 5

_TOKEN = re.compile(rb"[0-9a-z_\x80-\xff]+|[!-/:-@\[-^`{-~]+")
_TELL, _STYLE = 1 << TELL_BITS, 1 << STYLE_BITS
# One table: unigrams for ``tell``, then unigrams and bigrams for ``style``.
BUCKETS = _TELL + 2 * _STYLE


def _grams(text):
    """Bucket numbers of a text's unigrams (twice, once per table) and bigrams."""
    tokens = _TOKEN.findall(text.lower().encode())
    hashed = np.fromiter(map(crc32, tokens), np.uint32, len(tokens)).astype(np.uint64)
    mixed = (hashed[:-1] * np.uint64(0x9E3779B97F4A7C15) + hashed[1:]) * np.uint64(0xC2B2AE3D27D4EB4F)
    tell = (hashed & np.uint64(_TELL - 1)).astype(np.int64)
    style = (hashed & np.uint64(_STYLE - 1)).astype(np.int64) + _TELL
    pairs = (mixed >> np.uint64(64 - STYLE_BITS)).astype(np.int64) + _TELL + _STYLE
    return tell, np.concatenate([style, pairs])


# So many texts are counted at a time.
_GROUP = 1024


def _count(batches):
    """Per task: how often each bucket occurs in its documents, and in the target's among them."""
    raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for batch in batches:
        good = np.array([bool(g) for g in batch.column(1).to_pylist()])
        for at in range(0, batch.num_rows, _GROUP):
            grams = [np.concatenate(_grams(t or "")) for t in batch.column(0).slice(at, _GROUP).to_pylist()]
            raw += np.bincount(np.concatenate(grams), minlength=BUCKETS)
            chosen = [g for g, is_good in zip(grams, good[at:at + _GROUP]) if is_good]
            if chosen:
                target += np.bincount(np.concatenate(chosen), minlength=BUCKETS)
    seen = np.flatnonzero(raw)
    for at in range(0, len(seen), 1 << 16):
        part = seen[at:at + (1 << 16)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part.astype(np.int32)), pa.array(raw[part]), pa.array(target[part])],
            names=["bucket", "raw", "target"])


def _ratios(raw, target):
    """Log ratio of each bucket; each of the three parts is a model of its own, smoothed by one count."""
    out = np.zeros(BUCKETS, np.float32)
    for part in (slice(0, _TELL), slice(_TELL, _TELL + _STYLE), slice(_TELL + _STYLE, BUCKETS)):
        n = part.stop - part.start
        p = (target[part] + 1) / (target[part].sum() + n)
        q = (raw[part] + 1) / (raw[part].sum() + n)
        out[part] = np.log(p / q)
    return out


def _score(texts, ratios):
    """``n_grams, tell, style`` of each text."""
    doubt = np.minimum(ratios[:_TELL] + np.float32(DOUBT), 0)
    rows = []
    for text in texts:
        tell, style = _grams(text) if text is not None else ((), ())
        n = len(style)
        rows.append((n, float(doubt[tell].sum()) / n ** 0.5, float(ratios[style].sum()) / (n + CALM)) if n else (0, None, None))
    return rows


def _scorer(shared):
    def score(batches):
        ratios = shared.value
        for batch in batches:
            rows = _score(batch.column(1).to_pylist(), ratios)
            n, tell, style = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(n, pa.int64()), pa.array(tell, pa.float64()),
                 pa.array(style, pa.float64())],
                names=["doc_id", "text_hash", "n_grams", "tell", "style"])

    return score


def measured(documents, ratios):
    """``doc_id, text_hash, n_grams, tell, style`` of every document, one row each."""
    shared = documents.sparkSession.sparkContext.broadcast(ratios)
    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).mapInArrow(
        _scorer(shared), f"doc_id {kind}, text_hash long, n_grams long, tell double, style double")


class ImportanceModel:
    """The fitted ratios (a table of fixed size), and where both measures are centred and how scaled."""

    def __init__(self, ratios, centres, scales):
        self.ratios, self.centres, self.scales = ratios, centres, scales

    def weighted(self, documents):
        """``measured`` with ``log_weight``."""
        (c0, c1), (s0, s1) = self.centres, self.scales
        weight = F.least((F.col("tell") - c0) / s0, (F.col("style") - c1) / s1)
        return measured(documents, self.ratios).withColumn("log_weight", F.when(F.col("n_grams") > 0, weight))


def labelled_sample(labels, staging, most=MOST_LABELS, seed=0):
    """At most ``most`` labelled ids as ``doc_id, good, held``; ``held`` ones are kept from the models.

    Chosen by the hash of the id, at a rate that the table's size gives. An id labelled twice is
    good only if all its labels are.
    """
    rate = min(1.0, most / max(1, labels.count()))
    draw = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 30))
    chosen = labels.filter(F.col("doc_id").isNotNull() & (draw < int(rate * (1 << 30)))).limit(most)
    good = (F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)
    return staging.table(
        chosen.groupBy("doc_id").agg(F.min(F.coalesce(good, F.lit(False))).alias("good"))
        .withColumn("held", F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id"), F.lit(HELD)) == 0), "labels")


def held_scores(documents, ratios, sample):
    """``doc_id, tell, style`` of the good documents kept from the models: one row per id, the least of its copies."""
    held = documents.join(sample.filter("good and held").select("doc_id"), "doc_id", "left_semi")
    return measured(held, ratios).filter("n_grams > 0").groupBy("doc_id").agg(F.min("tell").alias("tell"), F.min("style").alias("style"))


def fit(documents, labels, staging, most=MOST_LABELS, seed=0):
    """Count both models and calibrate their ratio."""
    sample = F.broadcast(labelled_sample(labels, staging, most, seed))
    marked = documents.select("doc_id", "text").join(sample, "doc_id", "left")
    counted = marked.select("text", F.coalesce(F.col("good") & ~F.col("held"), F.lit(False))).mapInArrow(
        _count, "bucket int, raw long, target long")
    totals = counted.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toArrow()
    raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    at = totals["bucket"].to_numpy()
    raw[at], target[at] = totals["raw"].to_numpy(), totals["target"].to_numpy()
    ratios = _ratios(raw, target)
    quantiles = held_scores(documents, ratios, sample).select("tell", "style").toArrow()
    centres, scales = [], []
    for name in ("tell", "style"):
        values = quantiles[name].to_numpy()
        low, mid = np.quantile(values, [STRICT, 0.5]) if len(values) else (-1.0, 0.0)
        centres.append(float(low))
        scales.append(max(float(mid - low), 1e-6))
    return ImportanceModel(ratios, centres, scales)


def _kth_largest(table, name, k):
    """The k-th largest value of a column, found by counting ever narrower intervals.

    Each round counts values by 256 equal intervals and goes on in the one that holds the k-th, until
    its ends meet; ties make no difference.
    """
    low, high = table.agg(F.min(name), F.max(name)).first()
    while low is not None and low < high:
        step = (high - low) / 256
        if low + step <= low:
            break
        inside = table.filter(F.col(name).between(low, high))
        slot = F.least(F.floor((F.col(name) - low) / step), F.lit(255))
        counts = inside.groupBy(slot.alias("slot")).agg(
            F.count(F.lit(1)).alias("n"), F.min(name).alias("low"), F.max(name).alias("high")).collect()
        for row in sorted(counts, key=lambda r: -r["slot"]):
            if row["n"] >= k:
                break
            k -= row["n"]
        if row["n"] == k:
            return row["low"]
        if (row["low"], row["high"]) == (low, high) and len(counts) == 1:
            break
        low, high = row["low"], row["high"]
    return low


def gumbel_top_k(weighted, k=None, seed=0, temperature=TEMPERATURE):
    """``weighted`` (a staged table) with ``perturbed`` and ``kept``: the k largest after adding noise.

    The noise is keyed by id and text, so repeated rows share it; rows equal to the k-th stay as well.
    """
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id", "text_hash"), 11).cast("double") + 0.5) / float(1 << 53)
    noisy = weighted.withColumn("perturbed", F.col("log_weight") - F.log(-F.log(u)) * temperature)
    if k is None:
        k = noisy.filter("log_weight >= 0").count()
    cut = _kth_largest(noisy.filter("log_weight is not null"), "perturbed", k) if k else None
    kept = F.lit(False) if cut is None else F.coalesce(F.col("perturbed") >= cut, F.lit(False))
    return noisy.withColumn("kept", kept)


def resample(documents, labels, k=None, most_labels=MOST_LABELS, seed=0, staging=None):
    """``doc_id, text_hash, n_grams, tell, style, log_weight, perturbed, kept`` of every document."""
    staging = staging or Staging(documents.sparkSession)
    model = fit(documents, labels, staging, most_labels, seed)
    return gumbel_top_k(staging.table(model.weighted(documents), "weights"), k, seed)


def resampled(documents, labels, k=None, most_labels=MOST_LABELS, seed=0, staging=None):
    """The documents that are kept, with all their columns."""
    judged = resample(documents, labels, k, most_labels, seed, staging).filter("kept")
    return matching(documents, judged, "left_semi")
