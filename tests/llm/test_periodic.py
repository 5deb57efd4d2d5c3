"""Runs against a search over all periods; the query against plain Python."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from rowloom.llm import periodic
from rowloom.llm.queries import repeats

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute_runs(words, exponent, least):
    """Every maximal stretch with words p apart alike, by its smallest period."""
    found = {}
    n = len(words)
    for p in range(1, n // exponent + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            if j > i and j + p - i >= max(least, exponent * p):
                found.setdefault((i, j + p), p)
            i = max(j, i + 1)
    return sorted((s, e - s, p) for (s, e), p in found.items())


def brute(words, exponent, least):
    runs = sorted(brute_runs(words, exponent, least), key=lambda r: (r[0], r[2]))
    gone = {k for s, n, p in runs for k in range(s + p, s + n)}
    return runs, " ".join(w for k, w in enumerate(words) if k not in gone)


@pytest.mark.parametrize("exponent,least", [(2, 2), (4, 6), (3, 5)])
def test_runs_equal_a_search_over_all_periods(exponent, least):
    rng = random.Random(7)
    texts = [[rng.choice("abc"[: rng.randint(1, 3)]) for _ in range(rng.randint(0, 40))] for _ in range(400)]
    for _ in range(60):
        unit = [rng.choice("abcd") for _ in range(rng.randint(1, 9))]
        texts.append([rng.choice("ab") for _ in range(5)] + unit * rng.randint(1, 7) + unit[: rng.randint(0, len(unit))] + [rng.choice("ab") for _ in range(4)])
    fib = ["a", "ab"]
    while len(fib[-1]) < 300:
        fib.append(fib[-1] + fib[-2])
    texts += [list(fib[-1]), ["a"] * 500, []]
    word = np.array([ord(w) for t in texts for w in t], np.int64)
    first = np.append(0, np.cumsum([len(t) for t in texts]))
    start, end, period = periodic.find_runs(word, first, exponent, least)
    text = np.searchsorted(first, start, "right") - 1
    got = [[] for _ in texts]
    for t, s, e, p in zip(text, start, end, period):
        got[t].append((int(s - first[t]), int(e - s), int(p)))
    for t, words in enumerate(texts):
        assert got[t] == sorted(brute_runs(words, exponent, least), key=lambda r: (r[0], r[2])), words


def test_long_blocks_take_the_other_sort():
    """Texts of over two million words do not fit packed numbers; the same classes come out."""
    rng = np.random.default_rng(1)
    word, text = rng.integers(0, 2, 3000), np.repeat([0, 1, 2], 1000)
    packed, plain = periodic.classes(word, text), periodic.classes(word, text, width=0)
    assert len(packed) == len(plain) and all((a == b).all() for a, b in zip(packed, plain))
    assert sorted(plain[-1].tolist()) == list(range(3001))


ROWS = [
    (1, "a b a b a b a b a b c", 1),
    (2, None, 2),
    (3, "", 3),
    (4, "  \n\t ", 4),
    (5, "x" * 50, 5),
    (None, "q q q q q q q  Ünö q", 6),
    (6, "w " * 3000 + "end", 7),
    (6, "w " * 3000 + "end", 7),
    (7, " ".join(str(k % 7) for k in range(2000)) + " tail " + "z " * 9, 8),
    (8, "one\ntwo\tthree  four", 9),
]


def test_edges_and_extra_columns(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, runs int").withColumnRenamed("runs", "__source")
    out = periodic.with_runs(docs, exponent=4, least=6).collect()
    assert sorted(r["__source"] for r in out) == sorted(r[2] for r in ROWS)
    for row in out:
        runs, text = brute(WORD.findall(row["text"] or ""), 4, 6)
        assert [tuple(r) for r in row["runs"]] == runs and row["collapsed"] == text
    assert periodic.with_runs(docs.limit(0)).count() == 0


def test_query_equals_plain_python(spark, tmp_path):
    rng = random.Random(3)
    rows = [(k, " ".join(rng.choice("ab cd ef gh".split()) for _ in range(rng.randint(0, 60)))) for k in range(400)]
    rows += [(r[0], r[1]) for r in ROWS]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    want = []
    for doc_id, text in rows:
        words = WORD.findall(text or "")
        h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
        if h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        runs, collapsed = brute(words, 4, 6)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        want.append((doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, sha("".join(f"{s},{n},{p}\n" for s, n, p in runs)), sha(collapsed)))
    got = [tuple(r) for r in repeats.op12_periodic_runs(spark, str(tmp_path)).collect()]
    order = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(got, key=order) == sorted(want, key=order)
    assert sum(r[1] > 0 for r in want) > 20
