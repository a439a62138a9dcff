"""Language identification: known words first, character n-grams for the others.

A word is a run of letters of the lower-cased text.  The model has, for each language, the log
frequency of its commonest ``max_words`` words that occur at least ``min_count`` times in the
training rows, and of the commonest ``max_grams`` character n-grams of each length from 1 to 5
of its words (with a mark at either end).  A known word is scored by its log frequency per language.  An unknown
one backs off: its n-grams of the longest length of which at least one is known stand for
it, the mean of their log frequencies; shorter n-grams are tried only if no longer one is
known.  A text's score per language is the sum over its words, and ``score`` the winner's share
after softmax.

Counting covers all training rows; the model's size is bounded by its parameters, whatever the
corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from sluice.llm.staging import held_out, stage
from sluice.llm.textcols import Characters, CodedWords, slices, texts_of

LENGTHS = (5, 4, 3, 2, 1)
_NOT_LETTERS = r"[^\pL]+"
_START, _END = "\x02", "\x03"  # marks around a word


def letter_words(texts: pa.Array) -> CodedWords:
    """Lower-cased letter runs of each text (an empty word may stand at its ends)."""
    low = pc.replace_substring_regex(pc.utf8_lower(texts_of(texts)), _NOT_LETTERS, " ")
    return CodedWords(pc.split_pattern(low, " "))


def grams_of(word: str, n: int) -> list[str]:
    """Character n-grams of a word between marks; the single characters without marks."""
    if n == 1:
        return list(word)
    marked = f"{_START}{word}{_END}"
    return [marked[i:i + n] for i in range(len(marked) - n + 1)]


def word_counts(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """``(lang, word, n)`` over all rows with a language; counts are summed in each task first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 1):
                words = letter_words(batch.column(1))
                langs = batch.column(0).dictionary_encode()
                row_lang = langs.indices.to_numpy(zero_copy_only=False)
                n_words = max(1, len(words.uniq))
                pair = np.repeat(row_lang, np.diff(words.offsets)).astype(np.int64) * n_words + words.codes
                pairs, counts = np.unique(pair, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [langs.dictionary.take(pa.array(pairs // n_words)),
                     words.uniq.take(pa.array(pairs % n_words)), pa.array(counts.astype(np.int64))],
                    names=["lang", "word", "n"])
    return docs.where(F.col(lang).isNotNull()).select(
        F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text")) \
        .mapInArrow(run, "lang string, word string, n long").where("word <> ''") \
        .groupBy("lang", "word").agg(F.sum("n").alias("n"))


class LanguageModel:
    """``langs`` in order; ``keys``: (length, text) of known words (length 0) and n-grams; ``logs``: their log
    frequencies per language, a row per key.

    Look-ups go through sorted 64-bit hashes of the keys, which with ``logs`` are all that is sent to tasks: some 25 bytes a
    key and no objects.  (An unknown string that shares a known one's hash would be taken for it: below 1e-13 per string.)"""

    def __init__(self, langs: list[str], keys: list[tuple[int, str]], logs: np.ndarray) -> None:
        self.langs, self.keys, self.logs = langs, keys, logs
        hashes = np.zeros(len(keys), dtype=np.uint64)
        lengths = np.array([k for k, _ in keys], dtype=np.int64)
        for n in np.unique(lengths).tolist():
            own = np.flatnonzero(lengths == n)
            hashes[own] = Characters([keys[i][1] for i in own]).whole(n)
        order = np.argsort(hashes, kind="stable")
        self._hashes, self._sorted_logs = hashes[order], logs[order]
        self._words = lengths[order] == 0

    def __getstate__(self) -> dict:
        return {**self.__dict__, "keys": None, "logs": None}

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """Row of each hash, -1 for unknown ones."""
        if not len(self._hashes):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self._hashes, hashes), len(self._hashes) - 1)
        return np.where(self._hashes[at] == hashes, at, -1)

    def word_scores(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Log frequency per language of each word, its own or by back-off (a row of zeros for the empty word and where nothing
        is known); and which words are known themselves."""
        out = np.zeros((len(words), len(self.langs)), dtype=np.float32)
        plain = Characters(words)
        at = self._find(plain.whole(0))
        known = (at >= 0) & (plain.sizes > 0)
        out[known] = self._sorted_logs[at[known]]
        left = np.flatnonzero(~known & (plain.sizes > 0))
        for n in LENGTHS:
            if not len(left):
                break
            chars = Characters([words[i] if n == 1 else f"{_START}{words[i]}{_END}" for i in left])
            grams = np.maximum(chars.sizes - n + 1, 0)
            owner = np.repeat(np.arange(len(left)), grams)
            place = np.arange(len(owner)) - np.repeat(np.cumsum(grams) - grams, grams) + chars.starts[owner]
            at = self._find(chars.stretches(place, n, n))
            owner, at = owner[at >= 0], at[at >= 0]
            found = np.bincount(owner, minlength=len(left))
            for x in range(len(self.langs)):
                total = np.bincount(owner, weights=self._sorted_logs[at, x], minlength=len(left))
                out[left, x] = np.where(found > 0, total / np.maximum(found, 1), 0)
            left = left[found == 0]
        return out, known

    def word_score(self, word: str) -> np.ndarray:
        """Log frequency of one word per language: its own, or by back-off."""
        return self.word_scores([word])[0][0]

    def score_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(language index or -1 without letters, share of the winner, share of known words)."""
        words = letter_words(texts)
        uniq = words.strings()
        per_word, known = self.word_scores(uniq)
        real = np.array([w != "" for w in uniq], dtype=np.int64)
        total, letters = words.sums(per_word.astype(np.float64)), words.sums(real)
        known_share = words.sums(known.astype(np.int64)) / np.maximum(letters, 1)
        if not self.langs:
            return np.full(len(letters), -1), np.zeros(len(letters)), known_share
        best = total.argmax(axis=1)
        share = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
        return np.where(letters > 0, best, -1), np.where(letters > 0, share, 0.0), known_share


def _floors(rows: DataFrame, value: str, limit: Column) -> DataFrame:
    """Per length and language: the least value (``floor``) of the bins, from the greatest down, that are needed for ``limit`` rows,
    and how many rows of that last bin still fit (``room``).  Works on a histogram, so no task sorts a language's keys."""
    sizes = rows.groupBy("k", "lang", value).agg(F.count("*").alias("keys"), F.max(limit).alias("limit"))
    down = Window.partitionBy("k", "lang").orderBy(F.desc(value)).rowsBetween(Window.unboundedPreceding, -1)
    bins = sizes.withColumn("above", F.coalesce(F.sum("keys").over(down), F.lit(0))).where("above < limit")
    return bins.groupBy("k", "lang").agg(F.min(value).alias("floor"), F.min(F.col("limit") - F.col("above")).alias("room"))


def _commonest(counts: DataFrame, limits: dict[int, int], min_count: int) -> DataFrame:
    """Keys (``k``, ``key``) among the commonest ``limits[k]`` of some language.  Of keys that tie at the limit those of the
    greatest hashes stay, so that exactly the limit is kept: the tied bin is cut by a histogram of its hashes' first 16
    bits, and only the keys of the one piece at the cut are ranked."""
    limit = F.create_map(*(F.lit(x) for item in limits.items() for x in item))[F.col("k")].cast("long")
    counts = counts.where(F.col("n") >= min_count)
    floors = _floors(counts, "n", limit)  # a row per length and language
    joined = counts.join(F.broadcast(floors), ["k", "lang"])
    tied = joined.where("n = floor").drop("floor").withColumn("hash", F.xxhash64("key")) \
        .withColumn("piece", F.shiftright("hash", 48))
    pieces = _floors(tied, "piece", F.col("room")).withColumnRenamed("room", "left")
    tied = tied.join(F.broadcast(pieces), ["k", "lang"])
    ranked = tied.where("piece = floor").withColumn(
        "rank", F.row_number().over(Window.partitionBy("k", "lang").orderBy(F.desc("hash"), "key"))).where("rank <= left")
    kept = [joined.where("n > floor"), tied.where("piece > floor"), ranked]
    return kept[0].select("k", "key").unionAll(kept[1].select("k", "key")).unionAll(kept[2].select("k", "key")).distinct()


_BATCH_WORDS = 100_000  # counted together: an n-gram of several of them is one row


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, word, n) -> (k, key, lang, n), summed up over runs of words."""
    held: list[pa.RecordBatch] = []

    def out() -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(held).combine_chunks()
        held.clear()
        langs = rows["lang"].combine_chunks().dictionary_encode()
        code = langs.indices.to_numpy(zero_copy_only=False).astype(np.uint64)
        words, n = rows["word"].to_pylist(), rows["n"].to_numpy()
        for size in LENGTHS:
            chars = Characters(words if size == 1 else [f"{_START}{w}{_END}" for w in words])
            grams = np.maximum(chars.sizes - size + 1, 0)
            owner = np.repeat(np.arange(len(words)), grams)
            place = np.arange(len(owner)) - np.repeat(np.cumsum(grams) - grams, grams) + chars.starts[owner]
            hashes = chars.stretches(place, size, size) + code[owner] * np.uint64(0x9E3779B97F4A7C15)
            _, first, of = np.unique(hashes, return_index=True, return_inverse=True)
            sums = np.bincount(of, weights=n[owner]).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(first), size, dtype=np.int32)), pa.array(chars.text(place[first], size), pa.string()),
                 langs.dictionary.take(pa.array(code[owner[first]])), pa.array(sums)], names=["k", "key", "lang", "n"])

    rows = 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= _BATCH_WORDS:
            yield from out()
            rows = 0
    if rows:
        yield from out()


def fit_language_model(docs: DataFrame, text: str = "text", lang: str = "lang", min_count: int = 2,
                       max_words: int = 50_000, max_grams: int = 15_000) -> LanguageModel:
    """Fit on all given rows with a language.  Counts cover all of them; the model keeps the
    commonest ``max_words`` words and ``max_grams`` n-grams of each length per language (ties at a limit by hash)."""
    words = stage(word_counts(docs, text, lang), "lang-words")
    counts = stage(words.select(F.lit(0).alias("k"), F.col("word").alias("key"), "lang", "n").unionAll(
        words.select("lang", "word", "n").mapInArrow(_gram_counts, "k int, key string, lang string, n long")
        .groupBy("k", "key", "lang").agg(F.sum("n").alias("n"))), "lang-counts")
    kept = _commonest(counts, {0: max_words, **dict.fromkeys(LENGTHS, max_grams)}, min_count)
    model = counts.join(kept, ["k", "key"], "left_semi").select("k", "key", "lang", "n").toArrow()
    totals = {(r["k"], r["lang"]): r["n"] for r in
              counts.groupBy("k", "lang").agg(F.sum("n").alias("n")).collect()}
    langs = sorted({name for _, name in totals})
    rows = list(zip(*(model.column(c).to_pylist() for c in range(4))))
    keys = sorted({(k, key) for k, key, _, _ in rows})
    index = {key: i for i, key in enumerate(keys)}
    sums = np.full((len(keys), len(langs)), 0.1)
    for k, key, name, n in rows:
        sums[index[k, key], langs.index(name)] += n
    of = np.array([[totals.get((k, name), 0) + 1 for name in langs] for k in (0, *sorted(LENGTHS))])
    lengths = np.array([k for k, _ in keys], dtype=np.int64)
    logs = np.log(sums / of.reshape(-1, len(langs))[lengths]) if len(keys) else sums
    return LanguageModel(langs, keys, logs.astype(np.float32))


def predict_language(docs: DataFrame, model: LanguageModel, known: str | None = None) -> DataFrame:
    """The columns of ``docs`` that are not ``lang_pred`` or ``lang_score``, plus these two; and, if ``known`` names a column, the share
    of the text's words that are known themselves (0 without letters): unlike ``lang_score``, which nears 1 for any long text,
    it tells a learned language from others.

    ``lang_pred`` is ``und`` and ``lang_score`` 0 where the text is null or has no letter.  Only ``text`` is
    read for it; ties go to the first language in alphabetical order."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded: see fit_language_model
    added = ["lang_pred", "lang_score", *([known] if known else [])]
    kept = [c for c in docs.columns if c.lower() not in added]
    docs = docs.select(*kept)
    at = kept.index(next(c for c in kept if c.lower() == "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        names = pa.array([*held.langs, "und"], pa.string())
        for whole in batches:
            for batch in slices(whole, at):
                best, share, familiar = held.score_column(batch.column(at))
                best = np.where(best < 0, len(held.langs), best)
                found = [names.take(pa.array(best)), pa.array(share, pa.float64()), pa.array(familiar, pa.float64())]
                yield pa.RecordBatch.from_arrays([*batch.columns, *found[:len(added)]], names=[*kept, *added])

    schema = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()),
                           *(T.StructField(c, T.DoubleType()) for c in added[1:])])
    return docs.mapInArrow(run, schema)


def identify_language(docs: DataFrame, **options) -> DataFrame:
    """Learn from the rows of ``docs`` whose crc32(doc_id as text) mod 5 is not 0 and that have a
    ``lang``; predict every row.  Adds ``held_out``, ``lang_pred`` and ``lang_score``."""
    train = docs.where(~held_out("doc_id"))
    model = fit_language_model(train, **options)
    return predict_language(docs.withColumn("held_out", held_out("doc_id")), model)
