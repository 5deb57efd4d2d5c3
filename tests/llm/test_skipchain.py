"""Base spans against plain patterns; messages against all labellings; consistency of repeated tokens."""

import hashlib
import itertools
import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rowloom.llm import skipchain
from rowloom.llm.queries import private

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, s):
    digits = [int(c) for c in s if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in s.split("."))
    if kind == "card":
        odd = digits[-1::-2]
        even = [sum(divmod(2 * d, 10)) for d in digits[-2::-2]]
        return 16 <= len(digits) <= 19 and (sum(odd) + sum(even)) % 10 == 0
    return kind == "email" or 8 <= len(digits) <= 15


def brute(text):
    return [(kind, m.start(), m.end()) for kind, p in PATTERNS.items() for m in re.finditer(p, text or "") if valid(kind, m[0])]


def found(texts, model=None):
    column = pa.array(texts, pa.string())
    g, data, offsets = skipchain.graph(column)
    out = [[] for _ in texts]
    for t, k, a, b in g.base:
        start = len(bytes(data[offsets[t] : a]).decode())
        out[t].append((skipchain.KINDS[k], start, start + len(bytes(data[a:b]).decode())))
    return [sorted(x, key=lambda s: (skipchain.KINDS.index(s[0]), s[1])) for x in out]


TEXTS = [
    "mail a.b@c.example.org, or x@y", "a@b.c_d@e.f", "a@b@c.d", "@x.y z@", "Zoë zoë@host.de über +49 30 1234567", "1.2.3.4.5.6.7.8 999.1.1.1 01.002.3.4", "4111 1111 1111 1111",
    "4111111111111111 4111111111111111", "+1 (743) 555-3824 and +1", "+1((((((((", None, "", "5500-0000-0000-0004x", "1." * 50, "+" * 30 + "12345678", "a@b-.c.-d..e", "12 34\n56",
]


def test_base_spans():
    assert found(TEXTS) == [brute(t) for t in TEXTS]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab1234.@+-_ ()é0\n"), max_size=60), max_size=4))
def test_base_spans_of_any_text(texts):
    assert found(texts) == [brute(t) for t in texts]


@pytest.mark.parametrize("unit", ["a", "1", "1.", "+", "+1", "a.", "@", "1 ", "(1", "a@"])
def test_long_texts_take_linear_time(unit):
    began = time.time()
    skipchain.graph(pa.array([unit * (2_000_000 // len(unit))]))
    assert time.time() - began < 60


def _random_model(rng, scale=1.5):
    skip = rng.normal(0, scale, (skipchain.N, skipchain.N))
    return skipchain.Model(rng.normal(0, scale, (len(skipchain.SHAPES), skipchain.N)), rng.normal(0, scale, (skipchain.N, skipchain.N)), (skip + skip.T) / 2)


def _exact(g, model):
    n, out = len(g.label), 0
    out = np.zeros((n, skipchain.N))
    before, behind = set(g.chain[:, 1].tolist()), set(g.chain[:, 0].tolist())
    for y in itertools.product(range(skipchain.N), repeat=n):
        score = sum(model.shape[[k for k in range(len(skipchain.SHAPES)) if g.shape[i] >> k & 1], y[i]].sum() for i in range(n))
        score += sum(model.chain[y[i], y[j]] for i, j in g.chain) + sum(model.skip[y[i], y[j]] for i, j in g.skip)
        score += sum(model.chain[0, y[i]] for i in range(n) if i not in before) + sum(model.chain[y[i], 0] for i in range(n) if i not in behind)
        for i in range(n):
            out[i, y[i]] += np.exp(score)
    return out / out.sum(axis=1, keepdims=True)


def test_messages_equal_the_sum_over_all_labellings():
    """Exact without loops; close to it on a loop with mild potentials."""
    rng = np.random.default_rng(4)
    for text in ("+1 (743) 555-3824 word 12", "77 and 77 or 77 then 77", "9 8 7 6 5"):
        g, _, _ = skipchain.graph(pa.array([text]))
        model = _random_model(rng)
        assert np.abs(skipchain.marginals(g, model, 60) - _exact(g, model)).max() < 1e-6
    g, _, _ = skipchain.graph(pa.array(["12 34 x 12 34"]))
    assert len(g.chain) == 2 and len(g.skip) == 2
    model = _random_model(rng, 0.3)
    assert np.abs(skipchain.marginals(g, model, 60) - _exact(g, model)).max() < 0.02


def test_weights_are_a_stationary_point():
    rng = random.Random(2)
    texts = [" ".join(rng.choice(["a@b.com", "1.2.3.4", "12", "+1 (201) 555-0100", "x9", "word"]) for _ in range(8)) for _ in range(50)]
    counts = skipchain.situations(pa.array(texts))
    rows, n = np.array(list(counts)), np.array(list(counts.values()), float)
    model = skipchain.fit_weights(rows, n)

    def loss(m):
        total = 0.0
        for row, k in zip(rows.tolist(), n):
            bits = [i for i in range(len(skipchain.SHAPES)) if row[0] >> i & 1]
            score = [m.shape[bits, y].sum() + m.chain[row[1], y] + m.chain[y, row[2]] + sum(row[3 + z] * m.skip[y, z] for z in range(skipchain.N)) for y in range(skipchain.N)]
            total += k * (np.log(np.exp(score).sum()) - score[row[-1]])
        return total + skipchain.RIDGE / 2 * ((m.shape**2).sum() + (m.chain**2).sum() + (np.triu(m.skip) ** 2).sum())

    best = loss(model)
    for part, i, j in [("shape", 1, 1), ("shape", 0, 0), ("chain", 4, 4), ("chain", 0, 1), ("skip", 1, 1)]:
        for step in (0.01, -0.01):
            moved = skipchain.Model(model.shape.copy(), model.chain.copy(), model.skip.copy())
            getattr(moved, part)[i, j] += step
            assert loss(moved) >= best - 1e-9


def _card(rng):
    digits = [rng.randint(0, 9) for _ in range(15)]
    total = sum(sum(divmod(d * (2 - i % 2), 10)) for i, d in enumerate(digits))
    return "".join(map(str, digits)) + str(-total % 10)


def _documents(rng):
    words = "lorem ipsum dolor sit amet 3.0 v2 x1y2 12 2024".split()
    rows = []
    for k in range(600):
        w = [rng.choice(words) for _ in range(rng.randint(3, 30))]
        if k % 3 == 0:
            thing = rng.choice([f"u{k}@mail.example.com", f"{k % 256}.20.30.40", _card(rng), f"+1 ({rng.randint(200, 999)}) 555-{k:04d}", str(rng.randint(10**15, 10**16 - 1))])
            w.insert(rng.randint(0, len(w)), thing)
        rows.append((k, " ".join(w)))
    return rows


def test_repeated_tokens_take_one_label_and_clean_texts_stay_clean(spark, tmp_path):
    rng = random.Random(11)
    rows = _documents(rng)
    card, other = _card(rng), "1234567890123456"
    assert not valid("card", other)
    twice = f"Ñ paid {card} {card} today; see {card}."
    rows += [(1000, twice), (1001, f"no {other} {other} card"), (1002, None), (1003, ""), (None, "x@y.example.com"), (1004, "plain words only"), (1004, "plain words only")]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = {}
    for r in private.op13_personal_data(spark, str(tmp_path)).collect():
        got.setdefault(r["doc_id"], []).append(r)
    sha = lambda spans: hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()
    added = 0
    for doc_id, text in rows:
        r, base = got[doc_id][0], brute(text)
        assert [r[f"n_{k}"] for k in PATTERNS] == [sum(s[0] == k for s in base) for k in PATTERNS] and r["base_sha256"] == sha(base)
        listed = [tuple(s.split(":")) for s in r["spans"].split(",")] if r["spans"] else []
        assert set(base) <= {(k, int(a), int(b)) for k, a, b in listed}
        added += len(listed) - len(base)
    places = [m.start() for m in re.finditer(card, twice)]
    assert got[1000][0]["spans"] == ",".join(f"card:{a}:{a + 16}" for a in places) and got[1000][0]["n_card"] == 1
    assert got[1001][0]["spans"] == "" and added == 2 and len(got[1004]) == 2


def test_extra_columns_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a@b.c", "kept", 2)], "doc_id long, text string, __source string, kind int")
    model = skipchain.fit(docs)
    row = skipchain.tagged(docs, model).first()
    assert (row["__source"], row["kind"]) == ("kept", 2) and tuple(row["spans"][0]) == ("email", 0, 5, True)
    none = skipchain.fit(docs.limit(0))
    assert skipchain.tagged(docs.limit(0), none).count() == 0
    assert [tuple(s) for s in skipchain.tagged(docs, none).first()["spans"]] == [("email", 0, 5, True)]
