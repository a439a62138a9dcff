"""Content-defined line chunks against a plain Python model and the DuckDB oracle."""

import hashlib
import random

from sluice.llm import linechunks


def slow_chunks(lines):
    """(first line, last line, text) of the chunks, from 0: pairs of lines at boundaries, and long lines."""
    h = [int(hashlib.md5(line.encode()).hexdigest()[:8], 16) for line in lines]
    pairs = [(i - 1, i, lines[i - 1] + "\n" + lines[i]) for i in range(1, len(lines)) if (h[i] + 1_000_003 * h[i - 1]) % 3]
    return pairs, [(i, i, line) for i, line in enumerate(lines) if line.count(" ") >= 49]


def slow_dedup(docs):
    """{id: (text, removed lines)}"""
    first, out = {}, {}
    texts = {i: t.split("\n") for i, t in sorted(docs.items()) if t is not None}
    around = {}
    for d, lines in texts.items():
        pairs, longs = slow_chunks(lines)
        for k, (lo, hi, t) in enumerate(pairs):
            start = pairs[k - 1][0] if k else 0
            stop = pairs[k + 1][1] if k + 1 < len(pairs) else len(lines) - 1
            around[d, lo, hi] = (lines[start:lo][::-1], lines[hi + 1:stop + 1])
            first.setdefault((2, t), (d, lo, hi))
        for lo, hi, t in longs:
            around[d, lo, hi] = ([], [])
            first.setdefault((1, t), (d, lo, hi))

    def common(a, b):
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        return n
    for d, t in sorted(docs.items()):
        if t is None:
            out[d] = (None, 0)
            continue
        gone = set()
        for size, chunks in zip((2, 1), slow_chunks(texts[d])):
            for lo, hi, t in chunks:
                f = first[size, t]
                if f == (d, lo, hi):
                    continue
                low = lo - common(around[d, lo, hi][0], around[f][0])
                high = hi + common(around[d, lo, hi][1], around[f][1])
                gone.update(range(max(low, f[2] + 1) if f[0] == d else low, high + 1))
        out[d] = ("\n".join(x for i, x in enumerate(texts[d]) if i not in gone), len(gone))
    return out


def test_matches_brute_force(spark):
    rng = random.Random(11)
    lines = [f"line {i} ü" for i in range(60)] + ["", "", " "] + ["long " * n + "line" for n in (48, 49, 50, 51)]
    passage = [f"shared {i}" for i in range(12)]
    docs = {0: None, 1: "", 2: "\n", 3: "\n\n\n", 4: "one", 5: "\n\n\n"}
    for i in range(6, 120):
        body = [rng.choice(lines) for _ in range(rng.randint(0, 25))]
        if rng.random() < 0.4:
            at = rng.randint(0, len(body))
            body[at:at] = passage
        docs[i] = "\n".join(body)
        if rng.random() < 0.1 and i > 10:
            docs[i] = docs[i - 3]
    rows = [(i, t, "s", 5, "x") for i, t in docs.items()]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, removed_lines int, row string")
    out = linechunks.dedup_lines(df.repartition(5))
    assert out.columns == ["doc_id", "text", "source", "row", "removed_lines"]
    got = {r.doc_id: (r.text, r.removed_lines) for r in out.collect()}
    assert got == slow_dedup(docs)
    assert sum(n for _, n in got.values()) > 100


def test_shared_passage_is_found_at_any_shift(spark):
    passage = [f"passage line {i}" for i in range(20)]
    docs = {i: "\n".join([f"own {i} {j}" for j in range(i)] + passage + [f"end {i}"]) for i in range(8)}
    got = {r.doc_id: r.removed_lines for r in linechunks.dedup_lines(
        spark.createDataFrame(list(docs.items()), "doc_id long, text string")).collect()}
    assert got[0] == 0 and min(got[i] for i in range(1, 8)) >= 10


def test_nulls_repeats_long_and_empty(spark):
    long = "\n".join(f"l{i}" for i in range(30_000))
    rows = [(None, long), (1, long), (1, long), (2, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r.doc_id), r.removed_lines > 15_000, r.text is None)
                 for r in linechunks.dedup_lines(df).collect())
    assert got == [("1", False, False), ("1", True, False), ("2", False, True), ("None", True, False)]
    assert linechunks.dedup_lines(df.where("doc_id > 5")).collect() == []


def test_plan_has_no_python(spark):
    df = spark.createDataFrame([(1, "a\nb")], "doc_id long, text string")
    plan = linechunks.dedup_lines(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def recall_of(spark, length, seed=3, docs=60, words=4):
    """Share of a passage's lines that go from the second document that holds it; ``docs`` pairs of documents."""
    rng = random.Random(seed)
    rows, want = [], 0
    for k in range(docs):
        passage = [f"p {k} {i} " + " ".join(rng.choice("abcdef") for _ in range(words)) for i in range(length)]
        for copy in (0, 1):
            own = [[f"own {k} {copy} {side} {i}" for i in range(rng.randint(1, 12))] for side in (0, 1)]
            rows.append((2 * k + copy, "\n".join(own[0] + passage + own[1])))
        want += length
    got = linechunks.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert all(r.removed_lines == 0 for r in got if r.doc_id % 2 == 0)
    assert all("own" in x or "p " in x for r in got for x in r.text.split("\n"))
    assert all(r.text.count("own") == dict(rows)[r.doc_id].count("own") for r in got)
    return sum(r.removed_lines for r in got) / want


def test_recall_of_passages(spark):
    found = {n: recall_of(spark, n) for n in (2, 3, 5, 10, 35)}
    assert all(found[n] >= 0.9 for n in (5, 10, 35)), found
    assert found[2] >= 0.5 and found[3] >= 0.75, found
    assert recall_of(spark, 1, words=60) == 1.0 and recall_of(spark, 1) == 0.0


def test_exact_copies_go_whole(spark):
    rng = random.Random(8)
    docs = [(i, "\n".join(f"{i} {j} {rng.random()}" for j in range(n))) for i, n in enumerate([4, 6, 10, 35, 200] * 6)]
    rows = docs + [(100 + i, t) for i, t in docs] + [(200 + i, "new start\n" + t + "\nnew end") for i, t in docs]
    got = {r.doc_id: r.text for r in linechunks.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[i] == t for i, t in docs)
    left = [got[100 + i] for i, t in docs]
    assert all(x in ("", t) for x, (_, t) in zip(left, docs)) and sum(x != "" for x in left) <= 2
    assert sum(got[200 + i] != "new start\nnew end" for i, _ in docs) <= 2
