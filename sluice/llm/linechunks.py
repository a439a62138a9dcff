"""Line dedup by content-defined chunks of lines, in DataFrame functions only.

Every line gets a 32-bit hash (the first eight hex digits of its MD5).  A rolling hash over a line and the one before it,
``h[i] + 1000003 * h[i - 1]``, sets a boundary at line i unless it is divisible by ``divisor``; the two lines at a boundary are a
chunk.  Boundaries depend on two lines only, so a passage has the same chunks wherever it stands, and text inserted elsewhere
does not move them.  A line of ``LONG_LINE`` or more words is a chunk by itself.

Chunks that occur more than once in the whole corpus are candidates by hash; the two lines are then compared byte by byte (grouped and
joined by the text itself; long lines by their SHA-256).  Of equal chunks the first - by doc_id, then position - stays.  Every
other one is removed together with the lines around it, line by line as far as they equal those around the first one (by the first
half of their SHA-256), up to the next chunk on either side, which has its own occurrences.  So a repeated passage goes whole, edges
and lines between chunks included, and so does an exact copy; the lines of the first occurrence stay in the same document.

The corpus is staged once with row numbers.  Hashes alone are counted and matched; each text then travels once to the numbers of
its repeated chunks, where the candidates get their two lines and the hashes of their surroundings.  Counting and finding the
first occurrence are aggregates with map-side combine, and the joins that find candidates and mark the other occurrences are plain
equi-joins of two shuffled tables, which AQE splits at a hot chunk.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sluice.llm.staging import fresh_name, stage

ROLL = 1_000_003
DIVISOR = 3
LONG_LINE = 50


def _boundaries(hashes: Column, divisor: int) -> Column:
    """Numbers (from 1) of the lines at a boundary; the first line has none before it."""
    before = F.concat(F.array(F.lit(0).cast("long")), F.slice(hashes, 1, F.size(hashes) - 1))
    marks = F.zip_with(hashes, before, lambda h, b: (h + F.lit(ROLL) * b) % divisor != 0)
    return F.filter(F.transform(marks, lambda cut, i: F.when(cut & (i > 0), i + 1)), lambda n: n.isNotNull())


def _long_lines(lines: Column) -> Column:
    blanks = F.transform(lines, lambda x, i: F.when(F.length(x) - F.length(F.replace(x, F.lit(" "))) >= LONG_LINE - 1, i + 1))
    return F.filter(blanks, lambda n: n.isNotNull())


def _with_lines(docs: DataFrame, text: str, divisor: int) -> DataFrame:
    """``docs`` plus ``_lines``, ``_ends`` (boundaries) and ``_longs`` (numbers of long lines); null for a null text."""
    docs = docs.withColumn("_lines", F.split(F.col(text), "\n", -1))
    docs = docs.withColumn("_hashes", F.transform(
        "_lines", lambda x: F.conv(F.substring(F.md5(x.cast("binary")), 1, 8), 16, 10).cast("long")))
    return docs.withColumns({"_ends": _boundaries(F.col("_hashes"), divisor), "_longs": _long_lines(F.col("_lines"))})


def _pair(end: Column) -> Column:
    """The text of the chunk that ends at a line."""
    return F.concat(F.element_at("_lines", end - 1), F.lit("\n"), F.element_at("_lines", end))


def _sha(line: Column) -> Column:
    """The first 128 bits of a line's SHA-256."""
    return F.substring(F.unhex(F.sha2(line.cast("binary"), 256)), 1, 16)


def _keys(cut: DataFrame) -> DataFrame:
    """One row per chunk: the hash of its text and its number (from 0) in its document, pairs before long lines."""
    pairs = F.transform("_ends", lambda e: F.xxhash64(_pair(e)))
    singles = F.transform("_longs", lambda i: F.xxhash64(F.element_at("_lines", i)))
    return cut.select("row", F.posexplode(F.concat(pairs, singles)).alias("slot", "key"))


def _chunks(cut: DataFrame) -> DataFrame:
    """One row per chunk whose number is in ``_slots``: ``key``, its first and last line ``lo`` and ``hi``, ``t`` (its two lines, or
    a long line's SHA-256), and the hashes of the lines around it: ``left`` (nearest first) back to the start of the chunk before,
    ``right`` to the end of the one after.  A long line has no surroundings."""
    cut = cut.withColumn("_shas", F.transform("_lines", _sha))
    n, pairs = F.size("_lines"), F.size("_ends")

    def pair(i: Column) -> Column:
        end = F.get("_ends", i)
        start = F.when(i > 0, F.get("_ends", i - 1) - 1).otherwise(1)
        stop = F.coalesce(F.get("_ends", i + 1), n)
        text = _pair(end)
        return F.struct((end - 1).alias("lo"), end.alias("hi"), F.xxhash64(text).alias("key"), text.alias("t"),
                        F.reverse(F.slice("_shas", start, end - 1 - start)).alias("left"),
                        F.slice("_shas", end + 1, stop - end).alias("right"))

    def single(i: Column) -> Column:
        nothing = F.array().cast("array<binary>")
        at = F.get("_longs", i)
        line = F.element_at("_lines", at)
        return F.struct(at.alias("lo"), at.alias("hi"), F.xxhash64(line).alias("key"), F.sha2(line.cast("binary"), 256).alias("t"),
                        nothing.alias("left"), nothing.alias("right"))
    every = F.transform("_slots", lambda k: F.when(k < pairs, pair(k)).otherwise(single(k - pairs)))
    return cut.select("row", "id", F.explode(every).alias("c")).select("row", "id", "c.*")


def _common(a: Column, b: Column) -> Column:
    """How many leading items two arrays share."""
    differ = F.array_position(F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False))), F.lit(False))
    return F.when(differ > 0, differ - 1).otherwise(F.size(a)).cast("int")


def dedup_lines(docs: DataFrame, divisor: int = DIVISOR) -> DataFrame:
    """Remove repeated passages of two or more lines, and repeated long lines, from ``text``.

    Keeps every row and column of ``docs``; ``text`` loses the removed lines and ``removed_lines`` (bigint) counts
    them (an own column of this name is replaced).  A null text stays null with 0 removed lines; a
    document all of whose lines occurred earlier gets the empty text.  Among equal doc_ids (and null ones, which
    come last) the first occurrence is decided by the staged row order.  An empty table gives an
    empty result."""
    docs = docs.select(*[c for c in docs.columns if c.lower() != "removed_lines"])
    row = fresh_name(docs, "_row")
    text = next(c for c in docs.columns if c.lower() == "text")
    doc_id = next(c for c in docs.columns if c.lower() == "doc_id")
    held = stage(docs.withColumn(text, F.col(text).cast("string")).withColumn(row, F.monotonically_increasing_id()),
                 "lines", compression="zstd")
    rows = held.select(F.col(row).alias("row"), F.col(doc_id).alias("id"), F.col(text).alias("text"))
    keys = _keys(_with_lines(rows, "text", divisor))
    repeated = keys.groupBy("key").agg(F.count("*").alias("k")).where("k > 1").select("key")
    slots = keys.join(repeated, "key", "left_semi").groupBy("row").agg(F.collect_list("slot").alias("_slots"))
    candidates = stage(_chunks(_with_lines(rows.join(slots, "row"), "text", divisor)), "line-candidates", compression="zstd")
    place = F.struct(F.col("id").isNull().alias("last"), "id", "row", "lo", "hi", "left", "right")
    firsts = stage(candidates.groupBy("key", "t").agg(F.min(place).alias("first"), F.count("*").alias("k"))
                   .where("k > 1").select("key", "t", "first"), "line-firsts", compression="zstd")
    again = candidates.join(firsts, ["key", "t"]).where((F.col("row") != F.col("first.row")) | (F.col("lo") != F.col("first.lo")))
    low, high = F.col("lo") - _common(F.col("left"), F.col("first.left")), F.col("hi") + _common(F.col("right"), F.col("first.right"))
    # in the first occurrence's own document, its lines stay
    low = F.when(F.col("row") == F.col("first.row"), F.greatest(low, F.col("first.hi") + 1)).otherwise(low)
    gone = again.select(F.col("row").alias(row), F.sequence(low, high).alias("_numbers")) \
        .groupBy(row).agg(F.array_distinct(F.flatten(F.collect_list("_numbers"))).alias("_gone"))

    lines = F.split(F.col(text), "\n", -1)
    kept = F.array_except(F.sequence(F.lit(1), F.size(lines)), F.col("_gone"))
    left = F.array_join(F.transform(kept, lambda i: F.element_at("_all", i)), "\n")
    rows = held.join(gone, row, "left").withColumn("_all", F.when(F.col("_gone").isNotNull(), lines))
    rows = rows.withColumn(text, F.when(F.col("_gone").isNull(), F.col(text)).otherwise(left))
    return rows.select(*docs.columns, F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("removed_lines"))


def _around(side: str, own: str, first: str) -> str:
    """SQL: how many lines two surroundings (lists) share from their beginning."""
    return f"""coalesce(list_position(list_transform(range(1, greatest(len({own}.{side}), len({first}.{side})) + 1),
      lambda k: coalesce({own}.{side}[k] = {first}.{side}[k], false)), false) - 1, len({own}.{side}))"""


#: DuckDB: the same result by way of lists of lines per document, windows over chunk texts, and one row per line.
SQL = f"""
WITH docs AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents WHERE text IS NOT NULL),
lines AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM docs),
hashed AS (SELECT *, ('0x' || substr(md5(line), 1, 8))::BIGINT AS h FROM lines),
marked AS (
  SELECT doc_id, i AS hi, coalesce((h + {ROLL} * lag(h) OVER w) % {DIVISOR} <> 0, false) AS cut,
         lag(line) OVER w || chr(10) || line AS t
  FROM hashed WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
spread AS (
  SELECT doc_id, hi, t, coalesce(lag(hi) OVER w - 1, 1) AS start, lead(hi) OVER w AS stop
  FROM marked WHERE cut WINDOW w AS (PARTITION BY doc_id ORDER BY hi)),
chunks AS (
  SELECT s.doc_id, hi - 1 AS lo, hi, t, list_reverse(d.lines[start:hi - 2]) AS lefts,
         d.lines[hi + 1:coalesce(stop, len(d.lines))] AS rights
  FROM spread s JOIN docs d ON d.doc_id = s.doc_id
  UNION ALL
  SELECT doc_id, i, i, line, [], [] FROM lines
  WHERE length(line) - length(replace(line, ' ', '')) >= {LONG_LINE - 1}),
firsts AS (SELECT * FROM chunks QUALIFY row_number() OVER (PARTITION BY t ORDER BY doc_id, lo) = 1),
gone AS (
  SELECT c.doc_id, unnest(range(
      greatest(c.lo - {_around('lefts', 'c', 'f')}, if(c.doc_id = f.doc_id, f.hi + 1, 1)),
      c.hi + {_around('rights', 'c', 'f')} + 1)) AS i
  FROM chunks c JOIN firsts f ON f.t = c.t AND (f.doc_id <> c.doc_id OR f.lo <> c.lo)),
texts AS (
  SELECT l.doc_id, coalesce(string_agg(line, chr(10) ORDER BY l.i) FILTER (g.i IS NULL), '') AS text, count(g.i) AS removed_lines
  FROM lines l LEFT JOIN (SELECT DISTINCT doc_id, i FROM gone) g ON g.doc_id = l.doc_id AND g.i = l.i
  GROUP BY l.doc_id)
SELECT d.doc_id, t.text, coalesce(t.removed_lines, 0) AS removed_lines
FROM documents d LEFT JOIN texts t ON t.doc_id = d.doc_id
"""
