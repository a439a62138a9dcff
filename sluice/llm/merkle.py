"""Merkle manifest of a dataset: leaves, roots and a witness (inclusion proof) per row, built incrementally.

A row's leaf is the SHA-256 of its fields; the leaves of a group (here a language), in the order of their ids, are
paired level by level up to the group's root, and the group roots likewise up to the dataset's root.  A
last node without a partner is hashed alone.

Witnesses grow while leaves are appended: every open subtree keeps the partial witnesses of its leaves, and when its
sibling is complete, both sides' witnesses get the other's root (``OpenTrees``).  A group may hold most of the
rows, so its leaves are cut into aligned blocks of ``2 ** block_bits``; a block's root is one node of
the level above, and the blocks' roots are appended in the next round as the leaves were, until one
node per group is left, and then over the group roots.  Going down again, the witness of a block's root
is the upper part of the witness of each leaf in it.

Positions come from one range partitioning of the narrow leaf table (no text) and prefix sums of the
counts per partition and group; no window runs over a group, and no task holds more than a block of rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from sluice.llm.staging import fresh_name, stage

BLOCK_BITS = 12
LEFT, RIGHT, NONE = "<", ">", "="  # where the sibling of a witness step stands; NONE: hashed alone


def _h(*digests: str) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


class OpenTrees:
    """Aligned append: complete subtrees of falling height, each with its root and its leaves' partial witnesses."""

    def __init__(self) -> None:
        self.open: list[tuple[int, str, list[list[str]]]] = []

    def append(self, digest: str) -> None:
        """Add a leaf; subtrees of equal height that now stand side by side become one."""
        self.open.append((0, digest, [[]]))
        while len(self.open) > 1 and self.open[-2][0] == self.open[-1][0]:
            self._join()

    def _join(self) -> None:
        (height, left, a), (_, right, b) = self.open[-2:]
        for witness in a:
            witness.append(RIGHT + right)
        for witness in b:
            witness.append(LEFT + left)
        a += b
        self.open[-2:] = [(height + 1, _h(left, right), a)]

    def close(self, height: int) -> tuple[str, list[list[str]]]:
        """(root, witnesses in order) after the last leaf; lone subtrees rise alone, the root at least to ``height``."""
        while len(self.open) > 1 or self.open[0][0] < height:
            low, digest, witnesses = self.open[-1]
            if len(self.open) > 1 and self.open[-2][0] == low:
                self._join()
                continue
            for witness in witnesses:
                witness.append(NONE)
            self.open[-1] = (low + 1, _h(digest), witnesses)
        _, root, witnesses = self.open.pop()
        return root, witnesses


def leaf(fields: list[Column]) -> Column:
    """SHA-256 (lowercase hex) of the fields, each ``-`` if null, else its UTF-8 byte count, ``:`` and its text."""
    def part(c: Column) -> Column:
        text = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))
    return F.sha2(F.concat(*[part(c) for c in fields]), 256)


def fold(digest: Column, witness: Column) -> Column:
    """The root that a leaf and its witness lead to."""
    def step(node: Column, sibling: Column) -> Column:
        side, other = F.substring(sibling, 1, 1), F.substring(sibling, 2, 64)
        return F.sha2(F.when(side == LEFT, F.concat(other, node)).when(side == RIGHT, F.concat(node, other))
                      .otherwise(node), 256)
    return F.aggregate(witness, digest, step)


def siblings(witness: Column) -> Column:
    """The siblings' digests after each other, from the leaf's level upwards."""
    return F.array_join(F.transform(witness, lambda s: F.substring(s, 2, 64)), "")


def _positions(rows: DataFrame, group: str | None, order: list[str]) -> DataFrame:
    """``rows`` plus ``gid`` (one number per group, ascending in the order of groups), ``n`` (rows of the group) and ``at``
    (place in the group, from 0); ``order`` starts with the group and tells all rows apart."""
    seq = stage(rows.repartitionByRange(*order).sortWithinPartitions(*order)
                .withColumn("seq", F.monotonically_increasing_id()), "merkle-ordered")
    number = F.shiftright("seq", 33)  # the partition that numbered the row
    part, key, first, size, before = (fresh_name(seq, c) for c in ("_part", "_group", "_first", "_rows", "_before"))
    of_row = F.col(group) if group else F.lit(None).cast("string")
    counts = seq.groupBy(number.alias(part), of_row.alias(key)).agg(F.min("seq").alias(first), F.count("*").alias(size))
    # a row per partition and group: far fewer than leaves, and within a group at most one a partition
    of_group = Window.partitionBy(key)
    counts = counts.withColumns({
        before: F.sum(size).over(of_group.orderBy(part)) - F.col(size),
        "gid": F.min(first).over(of_group), "n": F.sum(size).over(of_group)})
    same = F.col(key).eqNullSafe(of_row) if group else F.lit(True)
    return seq.join(counts, (number == F.col(part)) & same) \
        .withColumn("at", F.col("seq") - F.col(first) + F.col(before)) \
        .drop("seq", part, key, first, size, before)


def _by_block(nodes: DataFrame, bits: int) -> DataFrame:
    if "block" not in nodes.columns:
        nodes = nodes.withColumn("block", F.shiftright("at", bits))
    return nodes.repartition("gid", "block").sortWithinPartitions("gid", "block", "at")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each block, in order; batches are cut and joined at the block's ends."""
    held: list[pa.RecordBatch] = []
    key = None
    for batch in batches:
        gid, block = batch.column("gid"), batch.column("block")
        ends = [0]
        if batch.num_rows > 1:
            new = pc.or_(pc.not_equal(gid[1:], gid[:-1]), pc.not_equal(block[1:], block[:-1]))
            ends += [i + 1 for i in pc.indices_nonzero(new).to_pylist()]
        for start, end in zip(ends, [*ends[1:], batch.num_rows]):
            if start == end:
                continue
            here = gid[start].as_py(), block[start].as_py()
            if held and here != key:
                yield pa.Table.from_batches(held)
                held = []
            key = here
            held.append(batch.slice(start, end - start))
    if held:
        yield pa.Table.from_batches(held)


def _append_all(digests: list[str], n: int, bits: int) -> tuple[str, list[list[str]]]:
    """Root and witnesses of one block; a group of more than one block has its roots at height ``bits``."""
    trees = OpenTrees()
    for digest in digests:
        trees.append(digest)
    return trees.close(bits if n > 1 << bits else 0)


_NODE = pa.schema([("gid", pa.int64()), ("n", pa.int64()), ("at", pa.int64()), ("digest", pa.string())])


def _block_roots(nodes: DataFrame, bits: int) -> DataFrame:
    """(gid, n, at, digest) of the blocks' roots: the nodes of the next round."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _runs(batches):
            n = rows["n"][0].as_py()
            root, _ = _append_all(rows["digest"].to_pylist(), n, bits)
            yield pa.RecordBatch.from_pylist([{"gid": rows["gid"][0].as_py(), "n": (n - 1 >> bits) + 1,
                                               "at": rows["block"][0].as_py(), "digest": root}], schema=_NODE)
    return _by_block(nodes.select("gid", "n", "at", "digest"), bits) \
        .mapInArrow(run, "gid long, n long, at long, digest string")


def _climb(leaves: DataFrame, bits: int) -> list[DataFrame]:
    """The nodes of each round, from the leaves to one node per group."""
    rounds = [leaves]
    most = leaves.agg(F.max("n")).first()[0] or 0
    while most > 1:
        rounds.append(stage(_block_roots(rounds[-1], bits), "merkle-blocks"))
        most = (most - 1 >> bits) + 1
    return rounds


def _with_witness(nodes: DataFrame, upper: DataFrame, bits: int) -> DataFrame:
    """``nodes`` plus ``witness``, ``subroot`` and ``root``: each block's rows come behind the same columns of its root
    (``upper``, by gid and at), so that both meet in one sorted stream and are not joined."""
    columns = nodes.columns
    head = upper.select("gid", F.col("at").alias("block"), F.lit(-1).cast("long").alias("at"), "witness", "subroot", "root")
    both = _by_block(nodes.withColumn("block", F.shiftright("at", bits)).unionByName(head, allowMissingColumns=True), bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _runs(batches):
            above, subroot, root = (rows[c][0].as_py() for c in ("witness", "subroot", "root"))
            rows = rows.slice(1)
            _, witnesses = _append_all(rows["digest"].to_pylist(), rows["n"][0].as_py(), bits)
            out = rows.select(columns).combine_chunks()
            out = out.append_column("witness", pa.array([w + above for w in witnesses], pa.list_(pa.string())))
            for name, value in (("subroot", subroot), ("root", root)):
                out = out.append_column(name, pa.array([value] * len(witnesses), pa.string()))
            yield from out.to_batches()
    schema = nodes.withColumns({"witness": F.array(F.lit("")), "subroot": F.lit(""), "root": F.lit("")}).schema
    return both.mapInArrow(run, schema)


def _descend(rounds: list[DataFrame], tops: DataFrame, bits: int) -> DataFrame:
    """The leaves of ``rounds`` with their witnesses, given those of the last round's nodes."""
    for nodes in reversed(rounds[1:-1]):
        tops = stage(_with_witness(nodes, tops, bits).select("gid", "at", "witness", "subroot", "root"), "merkle-witnesses")
    return _with_witness(rounds[0], tops, bits)


def merkle_manifest(docs: DataFrame, leaf_column: str = "leaf", group: str = "lang", order: str = "doc_id",
                    block_bits: int = BLOCK_BITS) -> DataFrame:
    """``docs`` (narrow: ids, group, leaves, no texts) plus ``subroot``, ``root`` and ``witness``: array of steps from the
    leaf to ``root``, each ``<`` or ``>`` (the sibling is on the left or right) with the sibling's digest, or ``=``.

    Groups are ordered with null first, then by UTF-8 bytes; rows of a group by ``order``, null first; rows of
    equal ``order`` by their leaf (rows equal in both may change places).  Other columns are passed on; those named like a
    working column (``WORKING``) or an added one are refused.  An empty table gives an empty result."""
    clash = [c for c in docs.columns if c.lower() in WORKING]
    if clash:
        raise ValueError(f"columns {clash} have names that the manifest uses itself")
    rows = stage(docs.withColumn("row", F.monotonically_increasing_id()), "merkle-leaves")
    placed = _positions(rows, group, [group, order, leaf_column, "row"]).drop("row").withColumn("digest", F.col(leaf_column))
    rounds = _climb(stage(placed, "merkle-placed"), block_bits)
    subroots = rounds[-1].select("gid", "digest")

    groups = _positions(stage(subroots.withColumnRenamed("gid", "member"), "merkle-subroots"), None, ["member"])
    group_rounds = _climb(stage(groups, "merkle-groups"), block_bits)
    summit = group_rounds[-1].select("gid", "at", F.array().cast("array<string>").alias("witness"),
                                     F.col("digest").alias("subroot"), F.col("digest").alias("root"))
    above = _descend(group_rounds, summit, block_bits).select(F.col("member").alias("gid"), "witness", "root")
    tops = rounds[-1].select("gid", "at", F.col("digest").alias("subroot")).join(above, "gid")  # a row per group each
    return _descend(rounds, stage(tops, "merkle-tops"), block_bits).select(*docs.columns, "subroot", "root", "witness")


WORKING = {"subroot", "root", "witness", "gid", "n", "at", "block", "digest", "row", "seq"}

#: DuckDB: CRC-32 of a decimal id, bit by bit (-1 stands for one shift).
_CRC = """coalesce(xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(
  string_split(doc_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295) % 7 = 0, false)"""

#: DuckDB: recursive pairing per level, then one row per document and level.
SQL = f"""
WITH RECURSIVE
fields AS (
  SELECT doc_id, lang, crc32_seven, n_chars,
         coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
           || coalesce(strlen(lang) || ':' || lang, '-') AS head,
         coalesce(strlen(text) || ':' || text, '-') AS tail
  FROM (SELECT *, {_CRC} AS crc32_seven FROM documents)),
leaves AS (
  SELECT doc_id, lang,
         sha256(head || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || tail) AS leaf,
         sha256(head || CASE WHEN crc32_seven THEN coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-')
                             ELSE coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') END || tail) AS changed
  FROM fields),
placed AS (
  SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n FROM leaves),
low(level, g, pos, n, h) AS (
  SELECT 0, g, pos, n, leaf FROM placed
  UNION ALL
  SELECT any_value(level) + 1, g, pos // 2, (any_value(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY pos))
  FROM low WHERE n > 1 GROUP BY g, pos // 2),
subroots AS (SELECT g, level AS height, h FROM low WHERE n = 1),
high(level, pos, n, h) AS (
  SELECT 0, g, (SELECT count(*) FROM subroots), h FROM subroots
  UNION ALL
  SELECT any_value(level) + 1, pos // 2, (any_value(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY pos))
  FROM high WHERE n > 1 GROUP BY pos // 2),
steps AS (
  SELECT p.doc_id, l.level, (p.pos >> l.level) % 2 = 1 AS is_right, l.h AS sibling
  FROM placed p JOIN subroots s ON s.g = p.g
  JOIN (SELECT DISTINCT g, level FROM low) v ON v.g = p.g AND v.level < s.height
  LEFT JOIN low l ON l.g = p.g AND l.level = v.level AND l.pos = xor(p.pos >> v.level, 1)
  WHERE l.h IS NOT NULL
  UNION ALL
  SELECT p.doc_id, s.height + l.level, (p.g >> l.level) % 2 = 1, l.h
  FROM placed p JOIN subroots s ON s.g = p.g
  JOIN high l ON l.pos = xor(p.g >> l.level, 1) AND l.n > 1),
heights AS (
  SELECT p.doc_id, s.height + (SELECT max(level) FROM high) AS height FROM placed p JOIN subroots s ON s.g = p.g),
folded(doc_id, level, h) AS (
  SELECT doc_id, 0, changed FROM placed
  UNION ALL
  SELECT f.doc_id, f.level + 1,
         sha256(CASE WHEN s.sibling IS NULL THEN f.h WHEN s.is_right THEN s.sibling || f.h ELSE f.h || s.sibling END)
  FROM folded f JOIN heights t ON t.doc_id = f.doc_id AND f.level < t.height
  LEFT JOIN steps s ON s.doc_id = f.doc_id AND s.level = f.level),
proofs AS (SELECT doc_id, sha256(string_agg(sibling, '' ORDER BY level)) AS proof FROM steps GROUP BY doc_id)
SELECT p.doc_id, p.leaf, s.h AS subroot, r.h AS root, coalesce(f.proof, sha256('')) AS proof_sha256,
       x.h AS folded_root, x.h = r.h AS verified
FROM placed p JOIN subroots s ON s.g = p.g LEFT JOIN proofs f ON f.doc_id = p.doc_id
JOIN heights t ON t.doc_id = p.doc_id JOIN folded x ON x.doc_id = p.doc_id AND x.level = t.height
CROSS JOIN (SELECT h FROM high WHERE n = 1) r
"""
