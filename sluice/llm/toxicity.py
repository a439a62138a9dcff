"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Tokens are runs of letters; a chain is a run of at most 64 tokens of one document (together the chains cover
the whole text).  Tags are 1 (toxic) and 0.  A tag's score is the sum of weights of the token's features - the
lower-cased word, its first three to five and last three to four letters, hashed to a fixed number
of buckets - and there are weights for the first tag and for each pair of adjacent tags.

Labels exist for documents only, so token labels are made from them.  A word is toxic if its counts in
toxic and other documents are far likelier for a toxic word than for an ordinary one (a likelihood ratio
beyond the number of distinct words).  Tokens of documents labelled clean are 0, and so are words of toxic
documents that also occur in clean ones; words that occur in toxic documents only without being
that sure stay open, and training sums over both tags for them.  Training maximizes the
likelihood of the labelled tokens (forward-backward, once free and once held to the labels) by Adam over a sample of chains of
bounded size (``train_chains``); word counts cover all labelled rows.

A document's evidence is its most certain token and its expected number of toxic tokens, both from the
marginals; a logistic curve fitted on labelled training documents (at most ``curve_docs``) makes it the score.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from sluice.llm.langid import letter_words
from sluice.llm.staging import held_out, stage
from sluice.llm.textcols import Characters, CodedWords, slices, texts_of

CHAIN = 64
BUCKETS = 1 << 18
_OPEN = 2  # token label: either tag


_PREFIXES, _SUFFIXES = (3, 4, 5), (3, 4)


def features_of(words: list[str]) -> np.ndarray:
    """Feature buckets of lower-cased words, a row each: the word, its prefixes and its suffixes (bucket 0 where it is no
    longer than they are)."""
    chars = Characters(words)
    out = np.zeros((len(words), 1 + len(_PREFIXES) + len(_SUFFIXES)), dtype=np.int64)

    def bucket(hashes: np.ndarray) -> np.ndarray:
        return 1 + (hashes % np.uint64(BUCKETS - 1)).astype(np.int64)
    out[:, 0] = bucket(chars.whole())
    kinds = [*((k, chars.starts) for k in _PREFIXES), *((k, chars.ends - k) for k in _SUFFIXES)]
    for kind, (k, first) in enumerate(kinds, 1):
        longer = np.flatnonzero(chars.sizes > k)
        out[longer, kind] = bucket(chars.stretches(first[longer], k, kind))
    return out


def word_features(word: str) -> list[int]:
    """The feature buckets of one word."""
    return features_of([word])[0].tolist()


class Crf:
    """``weights`` by bucket (bucket 0 stays 0), ``bias`` of tag 1, ``trans[a, b]``, ``first[a]`` and the document
    curve ``curve`` (intercept, two slopes)."""

    def __init__(self, weights: np.ndarray, bias: float, trans: np.ndarray, first: np.ndarray,
                 curve: np.ndarray) -> None:
        self.weights, self.bias, self.trans, self.first, self.curve = weights, bias, trans, first, curve

    def word_scores(self, words: list[str]) -> np.ndarray:
        """Score of tag 1 over tag 0 by word."""
        return self.weights[features_of(words)].sum(axis=1) + self.bias

    def document_scores(self, top: np.ndarray, expected: np.ndarray) -> np.ndarray:
        x = self.curve[0] + self.curve[1] * top + self.curve[2] * expected
        return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


_FORCED = 60.0  # log odds that stand for a tag that is not allowed
_MOST = 40.0  # bound of a token's log odds


def forward_backward(emit: np.ndarray, length: np.ndarray, trans: np.ndarray, first: np.ndarray,
                     allowed: np.ndarray | None = None,
                     sums: bool = True) -> tuple[np.ndarray, np.ndarray | None, np.ndarray | None]:
    """Chains padded to one width: ``emit[chain, step]`` is tag 1's score (tag 0 has 0), ``allowed[chain, step, tag]`` masks
    tags.  Returns (marginal of tag 1, log partition by chain, expected tag pairs summed over chains), the last two only
    with ``sums``.  With two tags, one number a step says all: the odds of tag 1, passed forwards and backwards."""
    n, width = emit.shape
    kind = emit.dtype.type
    odds = np.exp(np.clip(emit.T, -_MOST, _MOST))  # (step, chain)
    if allowed is not None:
        no = (allowed == 0).transpose(1, 0, 2)
        odds = odds * np.exp(_FORCED * (no[:, :, 0].astype(float) - no[:, :, 1]))
    (m00, m01), (m10, m11) = np.exp(trans).astype(emit.dtype)
    ahead = np.empty((width, n), dtype=emit.dtype)
    grow = np.empty((width, n), dtype=emit.dtype) if sums else None  # by what tag 0's weight grows
    for t in range(width):
        if t:
            down = m00 + ahead[t - 1] * m10
            ahead[t] = odds[t] * (m01 + ahead[t - 1] * m11) / down
        else:
            ahead[0] = odds[0] * kind(np.exp(first[1] - first[0]))
        if sums:
            grow[t] = down if t else np.exp(first[0])
    marginal = np.zeros((width, n), dtype=emit.dtype)
    pairs = np.zeros((2, 2))
    back = np.ones(n, dtype=emit.dtype)  # odds that the later steps give to tag 1
    for t in range(width - 1, -1, -1):
        back[t >= length - 1] = 1
        both = ahead[t] * back
        np.divide(both, 1 + both, out=marginal[t])
        if t:
            into = odds[t] * back
            if sums:
                joint = np.stack([np.full(n, m00), m01 * into, m10 * ahead[t - 1], m11 * ahead[t - 1] * into])
                joint = joint[:, t < length]
                pairs += (joint / joint.sum(axis=0)).sum(axis=1).reshape(2, 2)
            back = (m10 + m11 * into) / (m00 + m01 * into)
    inside = np.arange(width)[:, None] < length
    marginal[~inside] = 0
    if not sums:
        return marginal.T, None, None
    log_z = np.where(inside, np.log(grow), 0).sum(axis=0) + np.log1p(ahead[length - 1, np.arange(n)])
    if allowed is not None:
        log_z = log_z - _FORCED * (no[:, :, 0] & inside).sum(axis=0)
    return marginal.T, log_z, pairs


def _chains(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, first token, length) of each chain."""
    sizes = np.diff(offsets)
    n = -(-sizes // CHAIN)
    doc = np.repeat(np.arange(len(sizes)), n)
    k = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
    start = offsets[doc] + k * CHAIN
    return doc, start, np.minimum(CHAIN, offsets[doc + 1] - start)


def _padded(values: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    at = start[:, None] + np.arange(CHAIN)[None, :]
    return np.where(np.arange(CHAIN)[None, :] < length[:, None], values[np.minimum(at, len(values) - 1)], 0)


def _without_empty(words: CodedWords) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(distinct words, codes, offsets) without the empty words at the ends of texts."""
    uniq = words.strings()
    real = np.array([w != "" for w in uniq], dtype=bool)[words.codes] if uniq else np.zeros(0, bool)
    before = np.concatenate([[0], np.cumsum(real)])
    return uniq, words.codes[real], before[words.offsets]


def token_marginals(crf: Crf, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """(distinct words, word of each token, offsets by text, marginal of each token)."""
    uniq, codes, offsets = _without_empty(letter_words(texts))
    out = np.zeros(len(codes), dtype=np.float32)
    if len(codes):
        emit = crf.word_scores(uniq).astype(np.float32)[codes]
        _, start, length = _chains(offsets)
        for at in range(0, len(start), 1 << 13):  # bounded memory
            s = slice(at, at + (1 << 13))
            marginal, _, _ = forward_backward(_padded(emit, start[s], length[s]), length[s], crf.trans, crf.first, sums=False)
            inside = np.arange(CHAIN)[None, :] < length[s][:, None]
            out[start[s][0]:start[s][-1] + length[s][-1]] = marginal[inside]  # chains follow each other without gaps
    return uniq, codes, offsets, out


def _evidence(marginals: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per document: logit of its most certain token (-12 without tokens, at most 12), and log(1 + expected toxic
    tokens) over tokens of at least 0.1, so that a long text's many tiny marginals do not add up."""
    marginals = marginals.astype(float)
    top = np.full(len(offsets) - 1, 6e-6)
    expected = np.zeros(len(offsets) - 1)
    full = np.flatnonzero(np.diff(offsets) > 0)
    if len(full):
        top[full] = np.maximum.reduceat(marginals, offsets[full])
        expected[full] = np.add.reduceat(np.where(marginals >= 0.1, marginals, 0), offsets[full])
    top = np.clip(top, 6e-6, 1 - 6e-6)
    return np.log(top / (1 - top)), np.log1p(expected)


def word_counts(labelled: DataFrame) -> DataFrame:
    """``(word, pos, neg)``: toxic and other documents that hold the word, over all rows of (``text``, boolean ``toxic``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 0):
                words = letter_words(batch.column(0))
                n = max(1, len(words.uniq))
                doc = np.repeat(np.arange(batch.num_rows), np.diff(words.offsets))
                pair = np.unique(doc.astype(np.int64) * n + words.codes)
                toxic = batch.column(1).to_numpy(zero_copy_only=False)[pair // n].astype(bool)
                pos = np.bincount((pair % n)[toxic], minlength=n)[:len(words.uniq)]
                neg = np.bincount((pair % n)[~toxic], minlength=n)[:len(words.uniq)]
                yield pa.RecordBatch.from_arrays([words.uniq, pa.array(pos), pa.array(neg)],
                                                 names=["word", "pos", "neg"])
    return labelled.select("text", "toxic").mapInArrow(
        run, "word string, pos long, neg long").where("word <> ''").groupBy("word").agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def _train(emit_rows: np.ndarray, tokens: np.ndarray, labels: np.ndarray, length: np.ndarray,
           steps: int, l2: float) -> tuple[np.ndarray, float, np.ndarray, np.ndarray]:
    """Adam on the conditional likelihood.  ``emit_rows[word]``: feature buckets; ``tokens``/``labels[chain, step]``."""
    inside = np.arange(CHAIN)[None, :] < length[:, None]
    used, at = np.unique(emit_rows, return_inverse=True)
    at = at.reshape(emit_rows.shape)
    live = (used > 0).astype(float)
    allowed = np.stack([labels != 1, (labels == 1) | (labels == _OPEN)], axis=2).astype(float)
    allowed[~inside] = 1
    params = np.concatenate([np.zeros(len(used)), [-2.0], np.zeros(6)])
    m, v = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, steps + 1):
        weights, bias = params[:len(used)] * live, params[len(used)]
        trans, first = params[-6:-2].reshape(2, 2), params[-2:]
        emit = np.where(inside, (weights[at].sum(axis=1) + bias)[tokens], 0)
        free, _, free_pairs = forward_backward(emit, length, trans, first)
        held, _, held_pairs = forward_backward(emit, length, trans, first, allowed)
        diff = np.where(inside, held - free, 0)
        by_word = np.bincount(tokens.ravel(), weights=diff.ravel(), minlength=len(emit_rows))
        grad = np.zeros_like(params)
        grad[:len(used)] = np.bincount(at.ravel(), weights=np.repeat(by_word, emit_rows.shape[1]),
                                       minlength=len(used)) * live
        grad[len(used)] = diff.sum()
        grad[-6:-2] = (held_pairs - free_pairs).ravel()
        begin = (held - free)[:, 0].sum()
        grad[-2:] = [-begin, begin]
        grad -= l2 * params
        m = 0.9 * m + 0.1 * grad
        v = 0.99 * v + 0.01 * grad * grad
        params = params + 0.15 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    full = np.zeros(BUCKETS)
    full[used] = params[:len(used)] * live
    return full, float(params[len(used)]), params[-6:-2].reshape(2, 2), params[-2:]


def _fit_curve(top: np.ndarray, expected: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton steps with a small ridge."""
    x = np.stack([np.ones(len(top)), top, expected], axis=1)
    w = np.zeros(3)
    ridge = np.diag([1e-3, 1e-2, 1e-2]) * max(1, len(top)) / 100
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (toxic - p) - ridge @ w
        hess = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + ridge
        w = w + np.linalg.solve(hess, grad)
    return w


def _chain_rows(labelled: DataFrame, lexicon: set[str], least: dict[tuple[bool, bool], int] | None) -> DataFrame:
    """Chains of labelled rows: (toxic, marked) with their number per slice, or, given hash thresholds per class, the
    chosen ones with their words."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 0):
                uniq, codes, offsets = _without_empty(letter_words(batch.column(0)))
                doc, start, length = _chains(offsets)
                known = np.array([w in lexicon for w in uniq], dtype=bool)
                hot = np.concatenate([[0], np.cumsum(known[codes])]) if len(codes) else np.zeros(1)
                toxic = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)[doc]
                marked = hot[start + length] > hot[start]
                kinds = [(t, m) for t in (False, True) for m in (False, True)]
                if least is None:
                    rows = [int(((toxic == t) & (marked == m)).sum()) for t, m in kinds]
                    yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in kinds]), pa.array([m for _, m in kinds]), pa.array(rows)],
                                                     names=["toxic", "marked", "n"])
                    continue
                key = batch.column(2).to_numpy(zero_copy_only=False).view(np.uint64)[doc] + start.astype(np.uint64)
                key = (key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _KEY_BITS)
                floor = np.select([(toxic == t) & (marked == m) for t, m in kinds], [least[k] for k in kinds])
                for i in np.flatnonzero(key < floor.astype(np.uint64)).tolist():
                    words = [uniq[c] for c in codes[start[i]:start[i] + length[i]]]
                    yield pa.RecordBatch.from_pydict({"toxic": [bool(toxic[i])], "words": [words]})
    schema = "toxic boolean, marked boolean, n long" if least is None else "toxic boolean, words array<string>"
    return labelled.select("text", "toxic", "key").mapInArrow(cut, schema)


_KEY_BITS = 40


def fit_toxicity(labelled: DataFrame, train_chains: int = 6000, curve_docs: int = 3000,
                 steps: int = 60, l2: float = 0.02) -> Crf:
    """Fit on rows of (``doc_id``, ``text``, ``toxic``), a table of bounded size (see ``toxicity``).  Counts cover all of them; the lexicon
    holds words of these rows, so it is bounded with them.  Chains (about ``train_chains`` of toxic rows with a toxic word, a quarter of it
    of toxic rows without, ``train_chains`` of others) and the documents of the curve are samples by hash."""
    labelled = labelled.where("text is not null and toxic is not null").select(
        F.col("text").cast("string").alias("text"), (F.col("toxic") > 0).alias("toxic"), F.xxhash64("doc_id", "text").alias("key"))
    n_pos, n_all = labelled.agg(F.coalesce(F.sum(F.col("toxic").cast("long")), F.lit(0)), F.count("*")).first()
    nothing = Crf(np.zeros(BUCKETS), -12.0, np.zeros((2, 2)), np.zeros(2), np.array([-3.0, 0.0, 0.0]))
    if not n_pos or n_pos == n_all:
        nothing.curve[0] = 3.0 if n_pos else -3.0
        return nothing
    rate = n_pos / n_all
    counts = stage(word_counts(labelled), "toxic-words")
    n_words = counts.count()
    # log likelihood ratio: a toxic word is in toxic documents 98 % of the time, an ordinary one at the base rate
    ratio = F.col("pos") * math.log(0.98 / rate) + F.col("neg") * math.log(0.02 / (1 - rate))
    sure = ratio > math.log(n_words + 1) + 3
    lexicon = {r["word"] for r in counts.where(sure).select("word").collect()}

    wanted = {(True, True): train_chains, (True, False): train_chains // 4, (False, True): train_chains, (False, False): train_chains}
    have = {(r["toxic"], r["marked"]): r["n"] for r in
            _chain_rows(labelled, lexicon, None).groupBy("toxic", "marked").agg(F.sum("n").alias("n")).collect()}
    clean_chains = have.get((False, True), 0) + have.get((False, False), 0)
    size = {k: have.get(k, 0) if k[0] else clean_chains for k in wanted}
    least = {k: int((1 << _KEY_BITS) * min(1.0, wanted[k] / max(1, size[k]))) for k in wanted}
    some = stage(_chain_rows(labelled, lexicon, least), "toxic-chains")  # bounded by train_chains
    seen = some.select(F.explode("words").alias("word")).distinct()
    clean = {r["word"] for r in counts.where("neg > 0").join(seen, "word", "left_semi").select("word").collect()}
    rows = some.collect()
    if not len(rows):
        return nothing

    uniq = sorted({w for r in rows for w in r["words"]})
    index = {w: i for i, w in enumerate(uniq)}
    tokens = np.zeros((len(rows), CHAIN), dtype=np.int64)
    labels = np.zeros((len(rows), CHAIN), dtype=np.int64)
    length = np.array([len(r["words"]) for r in rows], dtype=np.int64)
    for i, r in enumerate(rows):
        tokens[i, :len(r["words"])] = [index[w] for w in r["words"]]
        if r["toxic"]:
            labels[i, :len(r["words"])] = [1 if w in lexicon else 0 if w in clean else _OPEN for w in r["words"]]
    crf = Crf(*_train(features_of(uniq), tokens, labels, length, steps, l2),
              np.array([0.0, 1.0, 0.0]))

    floor = max(1, int((1 << 20) * min(1.0, curve_docs / n_all)))  # a uniform sample by hash
    top, expected, toxic = zip(*_curve_points(labelled.where(F.pmod("key", F.lit(1 << 20)) < floor), crf)) or ((), (), ())
    crf.curve = _fit_curve(np.array(top), np.array(expected), np.array(toxic, dtype=float))
    return crf


def _curve_points(rows: DataFrame, crf: Crf) -> list[tuple[float, float, bool]]:
    shared = rows.sparkSession.sparkContext.broadcast(crf)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 0):
                _, _, offsets, marginals = token_marginals(shared.value, batch.column(0))
                top, expected = _evidence(marginals, offsets)
                yield pa.RecordBatch.from_arrays([pa.array(top), pa.array(expected), batch.column(1)],
                                                 names=["top", "expected", "toxic"])
    points = rows.select("text", "toxic").mapInArrow(run, "top double, expected double, toxic boolean").collect()
    shared.destroy()
    return [tuple(p) for p in points] or [(-12.0, 0.0, False)]


def _spans(text: str, marginals: np.ndarray, floor: float) -> list[dict]:
    """Offsets (in characters) and marginals of the tokens at or above ``floor``."""
    import regex
    hot = np.flatnonzero(marginals >= floor)
    if not len(hot):
        return []
    wanted, out = set(hot.tolist()), []
    for i, m in enumerate(regex.finditer(r"\p{L}+", text)):
        if i in wanted:
            out.append({"start": m.start(), "end": m.end(), "marginal": float(marginals[i])})
    return out


_MINE = ("score", "predicted", "spans")
_SPAN = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
                                  T.StructField("marginal", T.DoubleType())]))


def score_toxicity(docs: DataFrame, crf: Crf, floor: float = 0.5) -> DataFrame:
    """The columns of ``docs`` (but own ones of these names) plus ``score`` (0 to 1), ``predicted`` (1 if the score is at least 0.5) and
    ``spans``: start, end (character offsets) and marginal of every token with a marginal of at least ``floor``.  Only ``text`` is read; a null
    or empty text, or one without letters, has no spans and the curve's lowest score."""
    docs = docs.select(*[c for c in docs.columns if c.lower() not in _MINE])
    names = docs.columns
    at = next(i for i, c in enumerate(names) if c.lower() == "text")
    shared = docs.sparkSession.sparkContext.broadcast(crf)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type
        for whole in batches:
            for batch in slices(whole, at):
                texts = texts_of(batch.column(at))
                _, _, offsets, marginals = token_marginals(shared.value, texts)
                top, expected = _evidence(marginals, offsets)
                score = shared.value.document_scores(top, expected)
                hot = np.concatenate([[0], np.cumsum(marginals >= floor)])
                hot = np.diff(hot[offsets]) > 0
                spans = [_spans(texts[i].as_py(), marginals[offsets[i]:offsets[i + 1]], floor) if hot[i] else []
                         for i in range(len(texts))]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(score), pa.array((score >= 0.5).astype(np.int32)),
                     pa.array(spans, to_arrow_type(_SPAN))], names=[*names, *_MINE])

    schema = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType()),
                           T.StructField("predicted", T.IntegerType()), T.StructField("spans", _SPAN)])
    return docs.mapInArrow(run, schema)


LABEL_ROWS = 50_000


def toxicity(docs: DataFrame, labels: DataFrame, label_rows: int = LABEL_ROWS, **options) -> DataFrame:
    """Learn from the labelled rows whose crc32(doc_id as text) mod 5 is not 0, score every row of ``docs``.  Adds ``held_out`` and the
    columns of ``score_toxicity``.  A document with several labels counts as toxic if one says so.

    The classifier is fitted on a bounded sample of labelled ids: about ``label_rows``, by the hash of the id.  They are sent to the
    tasks that read the texts, so no text is shuffled; only the sample's texts are staged."""
    marks = labels.where("doc_id is not null and toxic is not null").where(~held_out("doc_id")) \
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    marks = stage(marks, "toxic-labels")
    floor = max(1, int((1 << 40) * min(1.0, label_rows / max(1, marks.count()))))
    some = stage(marks.where(F.pmod(F.xxhash64(F.lit(7), "doc_id"), F.lit(1 << 40)) < floor), "toxic-sample")
    train = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(some), "doc_id")
    crf = fit_toxicity(stage(train, "toxic-train", compression="zstd"), **options)
    return score_toxicity(docs.withColumn("held_out", held_out("doc_id")), crf)
