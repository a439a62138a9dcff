"""Quality selection by importance resampling over hashed n-gram models.

Two bag-of-n-grams models over the same hashed buckets: the target model counts the n-grams of
rows labelled good, the raw model those of the whole corpus, each distinct text once: a text is as good
with a thousand copies as without.  A document's importance weight is
the likelihood ratio target / raw of its n-grams; with Gumbel noise added to the log weights, the
``k`` largest are a sample without replacement in proportion to the weights (Gumbel top-k).

N-grams are words and adjacent word pairs, a word being a run of letters, digits or
underscores, or a run of other visible characters, lower-cased but told apart if all upper
case.  Log weights are per n-gram (a mean), scaled by ``sharpness``, so that long documents do not
crowd out short ones.  The noise comes from a hash of the id and the text's size: runs repeat
exactly.

``k`` is the number of rows whose noisy log weight reaches a floor, so that it follows the rows and not the mix of
labels.  The floor parts the labelled good rows from the others nearly best (see ``clean_floor``) and leaves at most
``slack`` of the good ones below.  A good row the target model was fitted on is rated without its own n-grams, as
if it had no label.  The k-th largest key is found by radix
selection over histograms of at most 65,536 rows; no rows are sorted or cut by a limit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from sluice.llm.staging import stage
from sluice.llm.textcols import CodedWords, segment_sums, slices, texts_of

BUCKETS = 1 << 18
_CUT = 1 << 14  # buckets per shuffled row of counts
_REPEATS = 1 << 22  # marks of texts that may occur more than once
_BIN = 1000  # bins of the log ratio in one unit
_MARKS = r"[^\s\pL\pN_]+"


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _hashes(uniq: pa.Array) -> np.ndarray:
    """64-bit hash of each distinct word (FNV-1a over its bytes, all words at once)."""
    sizes = pc.binary_length(uniq).to_numpy(zero_copy_only=False).astype(np.int64)
    data = np.frombuffer(b"".join(uniq.cast(pa.binary()).to_numpy(zero_copy_only=False)), dtype=np.uint8)
    starts = np.cumsum(sizes) - sizes
    h = np.full(len(sizes), 0xCBF29CE484222325, dtype=np.uint64)
    order = np.argsort(-sizes, kind="stable")
    alive = len(order)
    for i in range(int(sizes.max()) if len(sizes) else 0):
        while alive and sizes[order[alive - 1]] <= i:
            alive -= 1
        if alive < 64:  # few very long words: one by one
            for w in order[:alive].tolist():
                rest = data[starts[w] + i:starts[w] + sizes[w]].tolist()
                x = int(h[w])
                for b in rest:
                    x = (x ^ b) * 0x100000001B3 & 0xFFFFFFFFFFFFFFFF
                h[w] = x
            break
        at = order[:alive]
        h[at] = (h[at] ^ data[starts[at] + i]) * np.uint64(0x100000001B3)
    return h


def features(texts: pa.Array, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """(buckets of all n-grams, offsets by text)."""
    spaced = pc.replace_substring_regex(texts_of(texts), _MARKS, r" \0 ")
    words = CodedWords(pc.utf8_split_whitespace(spaced))
    uniq = words.uniq
    upper = pc.and_(pc.utf8_is_upper(uniq), pc.greater(pc.utf8_length(uniq), 1)) \
        .to_numpy(zero_copy_only=False)
    h = _hashes(pc.utf8_lower(uniq)) + upper.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    real = (pc.binary_length(uniq).to_numpy(zero_copy_only=False) > 0)[words.codes] if len(uniq) else \
        np.zeros(0, bool)
    of = np.repeat(np.arange(len(words.offsets) - 1), np.diff(words.offsets))[real]
    w = h[words.codes[real]] if len(uniq) else np.zeros(0, np.uint64)
    pair = of[1:] == of[:-1]
    pairs = _mix(w[:-1][pair] * np.uint64(3) + _mix(w[1:][pair]))
    doc = np.concatenate([of, of[1:][pair]])
    feats = (np.concatenate([_mix(w), pairs]) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(doc, kind="stable")
    counts = np.bincount(doc, minlength=len(words.offsets) - 1)
    return feats[order], np.concatenate([[0], np.cumsum(counts)])


def _repeats(keys: DataFrame) -> np.ndarray:
    """Marks by ``key`` modulo their number, set for every key that occurs more than once (and for those that
    share its mark; their number is fixed whatever the corpus)."""
    at = keys.groupBy("key").count().where("count > 1") \
        .select(F.pmod("key", F.lit(_REPEATS)).cast("int").alias("at")).distinct().toArrow()  # bounded
    marks = np.zeros(_REPEATS, dtype=bool)
    marks[at.column("at").to_numpy()] = True
    return marks


def _count_models(docs: DataFrame, good_ids: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Feature counts (raw, target) of ``(id, text)``: dense slices summed by Spark, then
    ``buckets`` numbers each to the driver.  The target model counts the rows whose id is among ``good_ids``.  Both
    count a text once (by its 64-bit hash): only texts that may have copies are shuffled, the first of each task."""
    docs = docs.withColumn("key", F.xxhash64("text"))
    marks = docs.sparkSession.sparkContext.broadcast(_repeats(docs.select("key")))

    def sums_of(batches: Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, buckets), dtype=np.int64)
        for texts, raw, good in batches:
            feats, offsets = features(texts, buckets)
            n = np.diff(offsets)
            sums[0] += np.bincount(feats[np.repeat(raw, n)], minlength=buckets)
            sums[1] += np.bincount(feats[np.repeat(good, n)], minlength=buckets)
        cuts = [(m, c) for m in range(2) for c in range(0, buckets, _CUT) if sums[m, c:c + _CUT].any()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([m for m, _ in cuts], pa.int32()), pa.array([c for _, c in cuts], pa.int32()),
             pa.array([sums[m, c:c + _CUT].astype("<i8").tobytes() for m, c in cuts], pa.binary())],
            names=["model", "cut", "counts"])

    def split(batch: pa.RecordBatch, repeated: bool) -> pa.RecordBatch:
        """The rows whose text may (or cannot) have copies: good, text, key."""
        marked = marks.value[batch.column("key").to_numpy() % _REPEATS]
        batch = batch.filter(pa.array(marked if repeated else ~marked))
        return pa.RecordBatch.from_arrays([pc.is_in(batch.column(0), pa.array(good_ids)), batch.column(1), batch.column(2)],
                                          names=["good", "text", "key"])

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
            for whole in batches:
                for batch in slices(split(whole, False), 1):
                    yield batch.column(1), np.ones(len(batch), bool), batch.column(0).to_numpy(zero_copy_only=False)
        return sums_of(rows())

    def firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[bool, int]] = set()
        for whole in batches:
            batch = split(whole, True)
            pairs = zip(batch.column(0).to_pylist(), batch.column(2).to_pylist())
            yield batch.filter(pa.array([p not in seen and not seen.add(p) for p in pairs], pa.bool_()))

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
            seen: tuple[set[int], set[int]] = (set(), set())
            for whole in batches:
                for batch in slices(whole, 1):
                    raw, target = [], []
                    for good, key in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                        raw.append(key not in seen[0])
                        target.append(good and key not in seen[1])
                        seen[0].add(key)
                        if good:
                            seen[1].add(key)
                    new = np.array(raw, bool) | np.array(target, bool)
                    yield batch.column(1).filter(pa.array(new)), np.array(raw, bool)[new], np.array(target, bool)[new]
        return sums_of(rows())

    def add(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for blob in batch.column("counts"):
                got = np.frombuffer(blob.as_buffer(), dtype="<i8")
                total = got.copy() if total is None else total + got
        yield pa.RecordBatch.from_arrays(
            [pa.array([key[0].as_py()], pa.int32()), pa.array([key[1].as_py()], pa.int32()),
             pa.array([total.tobytes()], pa.binary())], names=["model", "cut", "counts"])

    schema = "model int, cut int, counts binary"
    repeated = docs.mapInArrow(firsts, "good boolean, text string, key long").repartition("key")
    rows = docs.mapInArrow(alone, schema).unionAll(repeated.mapInArrow(once, schema)).groupBy("model", "cut").applyInArrow(add, schema).collect()
    sums = np.zeros((2, buckets), dtype=np.int64)
    for r in rows:
        part = np.frombuffer(r["counts"], dtype="<i8")
        sums[r["model"], r["cut"]:r["cut"] + len(part)] = part
    return sums[0], sums[1]


def log_ratios(raw: np.ndarray, target: np.ndarray, smoothing: float = 1.0) -> np.ndarray:
    """Log target/raw probability per bucket.  The target model is smoothed towards the raw one, so a
    feature that no good row was seen to hold counts against a text by how common it is in the corpus."""
    p_raw = (raw + smoothing) / (raw.sum() + smoothing * len(raw))
    p_target = (target + smoothing * p_raw * len(raw)) / (target.sum() + smoothing * len(raw))
    return np.log(p_target / p_raw)


def own_left_out(feats: np.ndarray, raw: np.ndarray, target: np.ndarray, smoothing: float = 1.0) -> float:
    """Mean log ratio of the n-grams of a text that the target model counts, as if it did not."""
    own, n = np.unique(feats, return_counts=True)
    p_raw = (raw[own] + smoothing) / (raw.sum() + smoothing * len(raw))
    p_target = (target[own] - n + smoothing * p_raw * len(raw)) / (target.sum() - len(feats) + smoothing * len(raw))
    return float((np.log(p_target / p_raw) * n).sum() / len(feats))


def clean_floor(rated: DataFrame, slack: float) -> float | None:
    """Floor of ``(ratio, good)`` by bins of 1/1,000: the lowest at which the share of good rows above exceeds that of
    the others by the most there is, less ``slack`` and one standard error; or lower, until at most ``slack`` of the
    good rows are below.  It lies amid the gap to the rows below.  None if there are not both kinds."""
    counts = {(r["bin"], r["good"]): r["count"] for r in rated.groupBy(
        F.floor(F.col("ratio") * _BIN).alias("bin"), "good").count().collect()}  # bounded: ratios are logarithms
    bins = sorted({b for b, _ in counts})
    good, bad = (np.array([counts.get((b, kind), 0) for b in bins], dtype=np.int64) for kind in (True, False))
    if not good.sum() or not bad.sum():
        return None
    n_bad = bad.sum()
    good, bad = (np.cumsum(x[::-1])[::-1] / x.sum() for x in (good, bad))
    best = int(np.argmax(good - bad))
    error = np.sqrt(bad[best] * (1 - bad[best]) / n_bad)
    near = int(np.flatnonzero(good - bad >= (good - bad)[best] - slack - error)[0])
    at = min(near, int(np.flatnonzero(good >= 1 - slack)[-1]))
    return (bins[at] + (bins[at - 1] + 1 if at else bins[at])) / 2 / _BIN


def kth_largest(df: DataFrame, key: str, k: int) -> float | None:
    """The k-th largest value of a double column, by radix selection over four 16-bit digits
    of its order-preserving bits: four aggregates of at most 65,536 groups.  None if k is 0 or more
    than the rows."""
    def ordered(value: np.ndarray) -> np.ndarray:
        bits = value.astype("<f8").view(np.uint64)
        return np.where(bits >> np.uint64(63), ~bits, bits | np.uint64(1 << 63))

    def digits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = ordered(batch.column(0).to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays(
                [pa.array(((bits >> np.uint64(s)) & np.uint64(0xFFFF)).astype(np.int32))
                 for s in (48, 32, 16, 0)], names=["d0", "d1", "d2", "d3"])

    rows = df.select(F.col(key).cast("double")).where(F.col(key).isNotNull()) \
        .mapInArrow(digits, "d0 int, d1 int, d2 int, d3 int")
    left, found = k, 0
    for level in range(4):
        counts = sorted(((r[0], r[1]) for r in rows.groupBy(f"d{level}").count().collect()), reverse=True)
        for digit, n in counts:
            if left <= n:
                break
            left -= n
        else:
            return None
        if left <= 0:
            return None
        found = found << 16 | digit
        rows = rows.where(F.col(f"d{level}") == digit)
    bits = np.uint64(found)
    bits = bits & np.uint64((1 << 63) - 1) if found >> 63 else ~bits
    return float(np.array([bits], dtype=np.uint64).view("<f8")[0])


def resample(docs: DataFrame, labels: DataFrame, share: float | None = None, slack: float = 0.02,
             sharpness: float = 100.0, smoothing: float = 1.0, buckets: int = BUCKETS,
             label_rows: int = 50_000) -> DataFrame:
    """Score and sample ``documents``-like rows by importance resampling.

    ``labels``: ``doc_id, quality`` (1 good, 0 not; null: unlabelled).  The target model is fitted on at most
    ``label_rows`` good ids (a uniform choice by hash); the raw model and the sample cover all rows.  ``share`` is the
    share of texts to sample; by default as many as reach ``clean_floor``.  Adds to all
    columns of ``docs`` ``log_ratio`` (mean log target/raw ratio per n-gram), ``gumbel_key`` and ``sampled``.  Rows
    without any n-gram (null, empty and blank texts) have a null ratio and are not sampled.  Without
    labels of both kinds every text is sampled.  Repeated rows are scored alike; columns of ``docs`` with these names are
    replaced.  Scores are computed twice (for the k-th key, then for the result), so that no text is
    staged."""
    mine = ("log_ratio", "gumbel_key", "sampled")
    docs = docs.select(*[c for c in docs.columns if c.lower() not in mine])
    marks = labels.where("quality is not null and doc_id is not null").groupBy(
        F.col("doc_id").cast("long").alias("id")).agg((F.max("quality") > 0).alias("good"))
    marks = stage(marks, "quality-labels")
    chosen = marks.where("good").orderBy(F.xxhash64("id"), "id").limit(label_rows).toArrow()  # bounded
    good_ids = chosen.column("id").to_numpy()
    text = F.col("text").cast("string").alias("text")
    raw, target = _count_models(docs.select(F.col("doc_id").cast("long").alias("id"), text), good_ids, buckets)
    table = log_ratios(raw, target, smoothing) if target.sum() else np.zeros(buckets)
    shared = docs.sparkSession.sparkContext.broadcast(table.astype(np.float32))  # one float a bucket
    models = docs.sparkSession.sparkContext.broadcast((raw, target))  # two counts a bucket

    def scored(rows: DataFrame, fair: bool = False) -> DataFrame:
        """``fair``: also ``fair_key``, the key without a row's own n-grams in the target model."""
        names = rows.columns
        extra = ["log_ratio", "gumbel_key", *(["fair_key"] if fair else [])]
        at, id_at = (next(i for i, c in enumerate(names) if c.lower() == x) for x in ("text", "doc_id"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for batch in slices(whole, at):
                    feats, offsets = features(batch.column(at), buckets)
                    n = np.diff(offsets)
                    ratio = segment_sums(shared.value[feats].astype(np.float64), offsets) / np.maximum(n, 1)
                    ids = pc.fill_null(batch.column(id_at).cast(pa.int64()), -1).to_numpy(zero_copy_only=False)
                    sizes = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False)
                    bits = _mix(_mix(ids.astype(np.uint64)) + sizes.astype(np.uint64)) >> np.uint64(11)
                    noise = -np.log(-np.log((bits.astype(float) + 0.5) / 2.0**53))
                    empty = n == 0
                    columns = [ratio, sharpness * ratio + noise]
                    if fair:
                        alone = ratio.copy()
                        known = pc.is_in(batch.column(id_at).cast(pa.int64()), pa.array(good_ids)) \
                            .to_numpy(zero_copy_only=False)
                        for i in np.flatnonzero(known & ~empty):
                            alone[i] = own_left_out(feats[offsets[i]:offsets[i + 1]], *models.value, smoothing)
                        columns.append(sharpness * alone + noise)
                    yield pa.RecordBatch.from_arrays(
                        [*batch.columns, *(pa.array(c, mask=empty) for c in columns)], names=[*names, *extra])

        return rows.mapInArrow(run, T.StructType([
            *rows.schema.fields, *(T.StructField(c, T.DoubleType()) for c in extra)]))

    keys = stage(scored(docs.select("doc_id", "text"), fair=True).select(
        F.col("doc_id").cast("long").alias("id"), "gumbel_key", "fair_key")
        .where("gumbel_key is not null"), "quality-keys")
    if share is None:
        rated = keys.join(marks, "id").groupBy("id", "good").agg((F.avg("fair_key") / sharpness).alias("ratio"))
        least = clean_floor(rated, slack)
        k = keys.count() if least is None else keys.where(F.col("gumbel_key") >= least * sharpness).count()
    else:
        k = int(np.ceil(share * keys.count()))
    floor = kth_largest(keys, "gumbel_key", k)
    if floor is None:
        return scored(docs).withColumn("sampled", F.lit(False))
    return scored(docs).withColumn("sampled", F.coalesce(F.col("gumbel_key") >= floor, F.lit(False)))
