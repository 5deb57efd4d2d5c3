"""The alignment against both libraries over whole texts and plain Python."""

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from rowloom.llm import crosstoken
from rowloom.llm.queries import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
FIRST = Tokenizer.from_file(A)
FIRST.encode_special_tokens = True
SECOND = sentencepiece.SentencePieceProcessor(model_file=B)
OWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BYTE = {chr(x): x for x in OWN} | {chr(256 + k): x for k, x in enumerate(x for x in range(256) if x not in OWN)}


def a_bytes(i):
    return bytes(BYTE[c] for c in FIRST.id_to_token(i))


def b_bytes(i):
    return bytes([int(SECOND.id_to_piece(i)[3:5], 16)]) if SECOND.is_byte(i) else SECOND.id_to_piece(i).replace("▁", " ").encode()


def align(text):
    """(a ids, b ids, groups as pairs of lists, links)"""
    if not text:
        return [], [], [], []
    a, b = FIRST.encode(" " + text, add_special_tokens=False).ids, SECOND.encode(text)
    x, y = [a_bytes(i) for i in a], [b_bytes(i) for i in b]
    if not b"".join(x) == b"".join(y) == (" " + text).encode():
        return [], [], [], []

    def ends(parts):
        out, at = [], 0
        for p in parts:
            at += len(p)
            out.append(at)
        return out

    ea, eb = ends(x), ends(y)
    groups, links, i, j = [], [], 0, 0
    for cut in sorted(set(ea) & set(eb)):
        g = ([], [])
        while i < len(a) and ea[i] <= cut:
            g[0].append(i)
            i += 1
        while j < len(b) and eb[j] <= cut:
            g[1].append(j)
            j += 1
        links += [(a[p], b[q]) for p in g[0] for q in g[1] if ea[p] - len(x[p]) < eb[q] and eb[q] - len(y[q]) < ea[p]]
        groups.append(([a[p] for p in g[0]], [b[q] for q in g[1]]))
    return a, b, groups, links


def shown(groups):
    return ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)


TEXTS = [
    "The quick brown fox, déjà vu!", None, "", " ", "  two  spaces  ", "tab\tand\nnew\n\n lines \n", "mark ▁ inside", "▁", "<|endoftext|> and <s> </s> <unk>",
    "nbsp x  y  　z", "x" * 3000, "12345 67,890.12 \U0001f600\U0001f680 你好", "a  b   c", "don't we'll I'M", "\x00 nul \x1c\x1d file", "trail   sep", "tab \tx \x85y",
    "<0x41> <0x0A>", "aaaa aaaaa aaaaaa", " lead", "trail ", "\n", "é combining", " \n x",
]


def test_groups_of_texts(spark):
    rows = [(k, t, k) for k, t in enumerate(TEXTS)]
    out = crosstoken.groups(spark.createDataFrame(rows, "id int, text string, __source int"), A, B).collect()
    assert len(out) == len(rows)
    for r in out:
        assert r["groups"] == shown(align(r["text"])[2]), repr(r["text"])
        assert r["__source"] == r["id"]


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.sampled_from(" \n\t'ab1.▁ 　"), st.characters(exclude_categories=["Cs"])), max_size=40))
def test_any_text(text):
    import pyarrow as pa

    block = crosstoken.Block(crosstoken.tokenizers(A, B), pa.array([text, "x", text]))
    want = shown(align(text)[2])
    assert block.strings().to_pylist() == [want, shown(align("x")[2]), want]


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(5)
    words = "the of token tokens tokenization und Geschäft été 2024 12 foo_bar x=y; 你好 antidisestablishment café's".split()
    rows = [(k, " ".join(rng.choice(words) + rng.choice(["", "", ",", "\n", " "]) for _ in range(rng.randint(0, 50)))) for k in range(300)]
    rows += [(1000 + k, t) for k, t in enumerate(TEXTS)] + [(None, "the of the"), (3, "the of the"), (3, "the of the")]
    path = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame(rows, "doc_id long, text string").repartition(5).write.parquet(str(path / "documents.parquet"))
    return str(path), rows


def test_query_equals_plain_python(spark, corpus, monkeypatch):
    path, rows = corpus
    made = [(doc_id, *align(text)) for doc_id, text in rows]
    count = Counter(link for m in made for link in m[4])
    highest = Counter()
    for (_, b), n in count.items():
        highest[b] = max(highest[b], n)
    want = [
        (d, len(a), len(b), len(g), len(links), sum(count[x] == highest[x[1]] for x in links), sum(count[x] for x in links), hashlib.sha256(shown(g).encode()).hexdigest() if g else "")
        for d, a, b, g, links in made
    ]
    got = [tuple(r) for r in alignment.op11_token_alignment(spark, path).collect()]
    order = lambda r: (r[0] is not None, r[0] or 0, r[1:])
    assert sorted(got, key=order) == sorted(want, key=order)
    found = crosstoken.pair_counts(spark.read.parquet(path + "/documents.parquet"), A, B).collect()
    assert {(r["a"], r["b"]): r["n"] for r in found} == dict(count)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert crosstoken.scored(empty, A, B).count() == 0 and crosstoken.groups(empty, A, B).count() == 0
    nothing = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert sorted(tuple(r)[1:] for r in crosstoken.scored(nothing, A, B).collect()) == [(0, 0, 0, 0, 0, 0, "")] * 2
