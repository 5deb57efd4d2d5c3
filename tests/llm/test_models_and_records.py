"""Operators 2, 3, 4, 7, 9 and 10 against brute force, round trips and held-out rows."""

import binascii
import collections
import gzip
import html.parser
import math
import random
import re
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from conftest import SMALL

from rowloom.llm import backoff, chat, ngramevidence, phrases, sitequality, stringkernel, textstats, warc
from rowloom.llm.arrowtext import document_key
from rowloom.llm.queries import ORACLES, QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- 2: WARC derivatives


class Reader(html.parser.HTMLParser):
    """Text by the standard parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.hidden = [], 0

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in warc.HIDDEN
        if re.fullmatch(warc.BREAKING, tag):
            self.out.append("\n")

    def handle_endtag(self, tag):
        self.hidden -= tag in warc.HIDDEN
        if re.fullmatch(warc.BREAKING, tag):
            self.out.append("\n")

    def handle_data(self, data):
        if not self.hidden:
            self.out.append(data)


def parsed(page):
    reader = Reader()
    reader.feed(page)
    reader.close()
    lines = (re.sub(r"[ \t\r\f\v]+", " ", x).strip(" ") for x in "".join(reader.out).split("\n"))
    return "\n".join(x for x in lines if x)


def test_plain_text_equals_a_parser(spark):
    for row in spark.read.parquet(f"{SMALL}/pages.parquet").collect():
        assert warc.plain_text(row.html) == parsed(row.html)
    assert warc.plain_text('a<b title="x>y">c</b><br/>d&amp;lt;<!-- <p> -->e<script>"<p>"</script>') == "ac\nd&lt;e"
    assert warc.plain_text("") == "" and warc.plain_text("1 < 2") == "1 < 2"


def test_derived_records_refer_to_their_source(spark):
    pages = spark.createDataFrame([(1, "http://a/", "<title>T\n x</title><p>Hi &amp; ho</p><a href='/u'>l</a>", 0), (2, None, None, 1), (3, "u", "", 2), (3, "u", "", 2)], "page_id long, url string, html string, block int")
    source = warc.responses(pages).collect()
    rows = warc.serialized(warc.derivatives(warc.responses(pages))).collect()
    assert len(rows) == 2 * len(source)
    by_source = collections.defaultdict(list)
    for r in rows:
        by_source[r.refers_to].append(r)
    for s in source:
        for r in by_source[s.record_id]:
            assert (r.target_uri, r.source_block_digest, r.source_payload_digest) == (s.target_uri, s.block_digest, s.payload_digest)
            assert r.content_length == len(r.block.encode()) and r.warc.endswith(r.block + "\r\n\r\n")
            assert f"WARC-Refers-To: <{s.record_id}>\r\n" in r.warc
            if r.warc_type == "metadata":
                assert r.concurrent_to in {x.record_id for x in by_source[s.record_id] if x.warc_type == "conversion"}
                assert "http-header: Content-Type: text/html; charset=utf-8" in r.block
                assert "digest-holds: false" not in r.block
    first = {r.warc_type: r for r in by_source[source[0].record_id]}
    assert first["conversion"].block == "T\nx\nHi & ho\nl"
    assert "title: T x\r\n" in first["metadata"].block and "outlink: /u\r\n" in first["metadata"].block


def test_a_registered_query_returns_whole_records(spark):
    rows = QUERIES["op2_warc_derivatives"](spark, SMALL)
    assert rows.columns == [part.split()[0] for part in warc.RECORD.split(", ")]
    rows = rows.collect()
    made = {(r.record_id, r.refers_to) for r in rows if r.warc_type == "conversion"}
    linked = [(r.concurrent_to, r.refers_to) for r in rows if r.warc_type == "metadata"]
    assert len(linked) * 2 == len(rows) > 0 and set(linked) == made


def test_foreign_responses_with_nulls():
    rows = warc.derived(None, None, None, b"HTTP/1.1 404 x\r\nA: b", None, "sha1:0")
    assert [r[0] for r in rows] == ["conversion", "metadata"] and rows[0][-1] == ""
    assert "http-status: HTTP/1.1 404 x" in rows[1][-1] and "source-payload-digest-holds: false" in rows[1][-1]
    assert warc.derived(None, None, None, None, None, None)[0][-1] == ""
    assert warc.derived("i", "u", "d", b"h\r\n\r\n\xff", None, None)[0][-1] == "�"


@pytest.mark.parametrize("unit", ["<script>", "<!--", "<title>", "<a ", "<p ", '<p "', "<p '", "<a href='", "<style>x<!--", "<script "])
def test_open_tags_take_linear_time(unit):
    page = unit * (10_000_000 // len(unit))
    began = time.time()
    warc.plain_text(page + '" >'), warc.title_of(page), warc.links_of(page)
    assert time.time() - began < 90


def test_pages_of_loose_parts_equal_plain_patterns():
    """What stays, the title and the links, as backtracking patterns find them."""
    hidden = re.compile(r"<!--.*?-->|" + "|".join(rf"<{t}(?:\s[^>]*)?>.*?</{t}\s*>" for t in warc.HIDDEN), re.S | re.I)
    quoted = r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>"
    passes = [(rf"</?(?:{warc.BREAKING})(?:[\s/]{quoted}|>)", "\n"), (rf"<[a-z/!?]{quoted}", ""), (r"<[a-z/!?][^>]*>", "")]
    link = re.compile(r"<a\s[^>]*?href\s*=\s*(?:\"([^\">]*)\"|'([^'>]*)')", re.I)
    rng = random.Random(3)
    parts = ["<p>", "</p>", "<p ", '<a href="x">', "<a ", "<a\thref = 'y'", 'href="q', "<!--", "-->", "<script>", "</script>", "<script src='a>b'>", "</script >", "<title>", "</title>", "<title x", "<b>", "<i a='>'>", "'", '"', ">", "<", "text", " ", "\n", "<br", "<head>", "</head>", "</ p>", "<style", "</STYLE>", "<noscript>", "<template>"]
    for _ in range(5000):
        page = "".join(rng.choice(parts) for _ in range(rng.randint(0, 22)))
        want = hidden.sub("", page)
        for pattern, new in passes:
            want = re.sub(pattern, new, want, flags=re.I)
        want = "\n".join(x for line in want.split("\n") if (x := re.sub(r"[ \t\r\f\v]+", " ", line).strip(" ")))
        assert warc.plain_text(page) == want, page
        found = re.search(r"<title(?:\s[^>]*)?>(.*?)</title", page, re.S | re.I)
        assert warc.title_of(page) == (found[1] if found else "")
        assert warc.links_of(page) == [a or b for a, b in link.findall(page)]


def test_headers_are_followed():
    def plain(head, body):
        return [r[-1] for r in warc.derived("i", "u", None, b"HTTP/1.1 200 OK\r\n" + head + b"\r\n\r\n" + body, None, None) if r[0] == "conversion"]

    page = "<p>caf\u00e9</p>"
    assert plain(b"Content-Type: text/html; charset=ISO-8859-1", page.encode("latin-1")) == ["caf\u00e9"]
    assert plain(b"content-type: TEXT/HTML;charset=nonsense", page.encode()) == ["caf\u00e9"]
    assert plain(b"Content-Encoding: gzip", gzip.compress(page.encode())) == ["caf\u00e9"]
    assert plain(b"Content-Encoding: deflate", zlib.compress(page.encode())[2:-4]) == ["caf\u00e9"]
    assert plain(b"Transfer-Encoding: chunked", b"4\r\n<p>c\r\n9;x=1\r\naf\xc3\xa9</p>\r\n0\r\n\r\n") == ["caf\u00e9"]
    assert plain(b"Content-Type: image/png", b"\x89PNG") == []
    (row,) = warc.derived("i", "u", None, b"HTTP/1.1 200 OK\r\nContent-Type: image/png\r\n\r\n\x89PNG", None, None)
    assert row[0] == "metadata" and row[3] is None and "title:" not in row[-1]
    assert plain(b"Content-Encoding: gzip", b"not gzip") == ["not gzip"] and plain(b"Transfer-Encoding: chunked", b"zz") == ["zz"]


# --- 3: site quality


def test_sparse_sites_shrink_and_large_sites_do_not(spark):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(6000):
        host = ["bad", "good", "mixed"][i % 3] if i % 100 else f"rare{i % 7}"
        quality = rng.random() < {"bad": 0.1, "good": 0.95}.get(host, 0.6)
        rows.append((i, host, f"{host}/{i % 2}", 100 if quality else 90, 500, 0 if quality else rng.randint(0, 40), 0, 0, 5, 0, 0))
        if i % 2:
            labels.append((i, int(quality)))
    docs = spark.createDataFrame(rows, "doc_id long, host string, path string, " + ", ".join(f"{c} long" for c in textstats.COUNTS))
    known = spark.createDataFrame(labels + [(None, 1), (5, None)], "doc_id long, quality int")
    got = sitequality.scored(docs, known).collect()
    assert len(got) == len(rows)
    mean = collections.defaultdict(list)
    for r in got:
        mean[r.host].append(r.path_posterior)
    mean = {h: float(np.mean(v)) for h, v in mean.items()}
    assert mean["bad"] < 0.2 and mean["good"] > 0.85
    assert all(0.3 < v < 0.9 for h, v in mean.items() if h.startswith("rare"))
    assert all(0 <= r.quality_score <= 1 for r in got)


def test_site_quality_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, None, None) + (0,) * 8, (2, "h", "h/p") + (5,) * 8], "doc_id long, host string, path string, " + ", ".join(f"{c} long" for c in textstats.COUNTS))
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [r.quality_score for r in sitequality.scored(docs, none).collect()] == pytest.approx([0.5, 0.5])
    assert sitequality.scored(docs.limit(0), none).collect() == []


def test_word_evidence_finds_labels_it_has_not_seen(spark):
    """Labels that only the words tell; margins come from the other half; scores follow plain sums."""
    rng = random.Random(9)
    good, bad = [f"g{i}" for i in range(60)], [f"b{i}" for i in range(60)]
    rows, labels = [], []
    for i in range(700):
        y = rng.random() < 0.5
        rows.append((i, " ".join(rng.choices((good if y else bad) + ["the", "of"] * 20, k=rng.randint(20, 60))), i))
        labels.append((i, int(y)))
    docs = spark.createDataFrame(rows + [(None, "g1 g2", 0), (9999, None, 0), (9998, "", 0)], "doc_id long, text string, __margin0 int")
    known = spark.createDataFrame(labels, "doc_id long, quality int")
    got = {r["doc_id"]: r for r in ngramevidence.with_margin(docs, known).collect()}
    assert len(got) == 703 and got[9999]["margin"] == got[9998]["margin"] == 0 and got[5]["__margin0"] == 5
    assert sum((got[i]["margin"] > 0) == bool(y) for i, y in labels) > 0.97 * len(labels)
    weights = ngramevidence.fit(docs, known)
    halves = {r["doc_id"]: r["h"] for r in docs.select("doc_id", ngramevidence.half("doc_id").alias("h")).collect()}
    for i in range(20):
        bucket, counts = ngramevidence.buckets(pa.array([rows[i][1]]))
        assert len(bucket) == counts[0] == len(set(bucket.tolist()))
        w = weights[1 - halves[i]]
        assert got[i]["margin"] == pytest.approx(sum(w[b] for b in bucket.tolist()) / math.sqrt(len(bucket)) + w[-1])
    flipped = spark.createDataFrame([(i, 1 - y if halves[i] == 0 else y) for i, y in labels], "doc_id long, quality int")
    after = {r["doc_id"]: r["margin"] for r in ngramevidence.with_margin(docs, flipped).collect()}
    assert all(after[i] == pytest.approx(got[i]["margin"]) for i in range(700) if halves[i] == 0)  # judged by the other half
    assert ngramevidence.with_margin(docs.limit(0), known).collect() == []
    assert {r["margin"] for r in ngramevidence.with_margin(docs, known.limit(0)).collect()} == {0.0}


def test_site_quality_finds_labelled_junk(spark):
    got = {r.doc_id: r.quality_score for r in QUERIES["op3_site_quality"](spark, SMALL).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    good = [got[i] for i, q in labels.items() if q == 1]
    bad = [got[i] for i, q in labels.items() if q == 0]
    assert sum(g > b for g in good for b in bad) > 0.9 * len(good) * len(bad)


# --- 4: phrases


def plain_contamination(docs, items, size=10):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    cut = lambda t: word.findall((t or "").translate(LOWER))
    windows = collections.defaultdict(set)
    for item, text in items:
        w = cut(text)
        for k in range(max(len(w) - size, 0) + 1 if w else 0):
            windows[tuple(w[k : k + size])].add(item)
    lengths = {len(w) for w in windows}
    out = []
    for i, text in docs:
        w, hit, found = cut(text), set(), set()
        for n in lengths:
            for k in range(len(w) - n + 1):
                if (own := windows.get(tuple(w[k : k + n]))) is not None:
                    hit |= set(range(k, k + n))
                    found |= own
        out.append((i, len(w), len(hit), tuple(sorted(map(str, found)))))
    return sorted(out, key=str)


def test_contamination_equals_brute_force(spark):
    rng = random.Random(6)
    vocab = ["a", "B", "c1", "Éé", "é", "dd", "the"]
    say = lambda n: "".join(rng.choice(vocab) + rng.choice([" ", ", ", "\n", "-"]) for _ in range(n))
    items = [(1, "x y"), (2, say(25)), (3, None), (4, "..."), (5, "solo"), (10, say(12)), (11, "a a a a a a a a a a a a"), (2, say(3))]
    docs = [(0, None), (1, ""), (2, "solo"), (3, ".Solo. x Y x y"), (4, "a " * 400), (5, say(300))]
    for i in range(6, 60):
        part = (rng.choice(items)[1] or "") if i % 2 else ""
        docs.append((i % 50, say(rng.randint(0, 20)) + part.upper() + say(3)))
    docs += docs[20:24]
    left = spark.createDataFrame([(i, t, "k", 1) for i, t in docs], "doc_id long, text string, key string, pos int").repartition(3)
    right = spark.createDataFrame(items, "item_id long, text string")
    got = phrases.contamination(left, right).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_hit, tuple(r.item_ids)) for r in got), key=str) == plain_contamination(docs, items)
    clean = sorted((r.doc_id, r.text) for r in phrases.clean(left, right).where("doc_id > 1").collect())
    hit = collections.Counter((i, t) for i, t in docs)
    dirty = {(r.doc_id, r.key) for r in got if r.n_hit}
    assert len(clean) == sum(1 for r in got if not r.n_hit and r.doc_id > 1) and dirty and hit
    assert phrases.contamination(left.limit(0), right).collect() == []
    assert {r.n_hit for r in phrases.contamination(left, right.limit(0)).collect()} == {0}


def test_contamination_without_broadcasts(spark, monkeypatch):
    monkeypatch.setattr(phrases, "SMALL_ROWS", -1)
    items = [(1, "one two three four five six seven eight nine ten eleven")]
    docs = [(1, "x one two three four five six seven eight nine ten y"), (2, "one two"), (3, "zero " + items[0][1])]
    got = phrases.contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted((r.doc_id, r.n_words, r.n_hit, tuple(r.item_ids)) for r in got) == plain_contamination(docs, items)


def plain_near(docs, items, reach):
    """For every window the places of its rarest term with all other terms close by."""
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    texts = [cut(t) for _, t in docs]
    found = {}
    for item, text in items:
        w = cut(text)
        found.update({(item, tuple(w[k : k + 10])): tuple(w[k : k + 10]) for k in range(max(len(w) - 9, 1)) if w})
    vocabulary = {x for w in found.values() for x in w}
    freq = collections.Counter(x for t in texts for x in t if x in vocabulary)
    out = []
    for (i, _), t in zip(docs, texts):
        places, hit = set(), set()
        for (item, w) in found:
            if all(freq[x] for x in w):
                rare = min(set(w), key=lambda x: (freq[x], x))
                at = [p for p, x in enumerate(t) if x == rare and set(w) <= set(t[max(0, p - reach) : p + reach + 1])]
                places |= {(w, p) for p in at}
                hit |= {item} if at else set()
        out.append((i, len(places), tuple(sorted(map(str, hit)))))
    return sorted(out, key=str)


@pytest.mark.parametrize("rows", [300_000, -1])
def test_near_equals_brute_force(spark, monkeypatch, rows):
    monkeypatch.setattr(phrases, "SMALL_ROWS", rows)
    rng = random.Random(4)
    words = "one two three four five six seven eight nine ten eleven twelve".split()
    items = [(k, " ".join(rng.choices(words, k=rng.choice([0, 1, 2, 5, 10, 13])))) for k in range(12)]
    docs = [(k, " ".join(rng.choices(words + ["pad"] * 4, k=rng.randint(0, 60)))) for k in range(60)] + [(1, None), (None, "one TWO"), (None, "one TWO")]
    left = spark.createDataFrame(docs, "doc_id long, text string")
    right = spark.createDataFrame(items, "item_id long, text string")
    got = sorted(((r.doc_id, r.n_near, tuple(r.item_ids)) for r in phrases.near(left, right, 8).collect()), key=str)
    assert got == plain_near(docs, items, 8) and sum(r[1] for r in got) > 20
    assert phrases.near(left.limit(0), right, 8).collect() == [] and {r.n_near for r in phrases.near(left, right.limit(0), 8).collect()} == {0}


def test_proximity_matches_ignore_the_order(spark):
    docs = spark.createDataFrame([(1, "rare x y common other"), (2, "other rare common"), (3, "rare a b c d e f g common other"), (4, "common other")], "doc_id long, text string")
    index = phrases.postings(docs, spark.createDataFrame([("rare",), ("common",), ("other",)], "term string"))
    asked = spark.createDataFrame([("rare common other", ["rare", "common", "other"])], "phrase string, terms array<string>")
    keys = {r.key: r.doc_id for r in docs.select("doc_id", document_key("doc_id", "text").alias("key")).collect()}
    assert {keys[r.key] for r in phrases.proximity_matches(index, asked, 4).collect()} == {1, 2}
    assert {keys[r.key] for r in phrases.proximity_matches(index, asked, 9).collect()} == {1, 2, 3}


# --- 7: chat


def test_chat_comes_back_whatever_it_says(spark):
    rng = random.Random(8)
    rows = []
    for c in range(40):
        for t in range(rng.randint(1, 9)):
            text = "".join(rng.choice(["### ", "</turn>\n", ": ", "\\", "\n", "é", "x", "#", "<", "assistant"]) for _ in range(rng.randint(0, 12)))
            rows.append((c, t, rng.choice(["user", "assistant", "a:b", "sys\\", None, ""]), text if rng.random() < 0.9 else None, "extra"))
    rows += [(None, 0, "assistant", "q", "e"), (5, 0, "user", "tie", "e"), (5, 0, "user", "tie", "e"), (6, None, "user", "x" * 50000, "e")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string").repartition(4)
    formatted = chat.format_chat(turns)
    got = {r.conv_id: r for r in chat.read_back(formatted).collect()}
    held = {r.conv_id: r for r in formatted.collect()}
    low = lambda v: (v is not None, v if v is not None else 0)
    for c in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == c), key=lambda r: (low(r[1]), (r[2] is not None, r[2] or ""), (r[3] is not None, r[3] or "")))
        assert got[c].roles == [r[2] or "" for r in own]
        assert got[c].texts == [r[3] or "" for r in own]
        assert got[c].learned == [r[3] or "" for r in own if r[2] == "assistant"]
        assert got[c].formatted_chars == len(held[c].formatted) and held[c].n_turns == len(own)
    assert chat.format_chat(turns.limit(0)).collect() == []


# --- 9: language model


def plain_model(docs, strength, order):
    train = [t for _, held, t in docs if not held]
    cut = lambda t: [*WORD.findall((t or "").translate(LOWER)), "</s>"]
    grams, states = collections.Counter(), collections.Counter()
    for t in train:
        w = ["<s>", *cut(t)]
        for i in range(1, len(w)):
            for k in range(1, order + 1):
                if i - k + 1 >= 0:
                    grams[tuple(w[i - k + 1 : i + 1])] += 1
                    states[tuple(w[i - k + 1 : i])] += 1
    n, v = states[()], sum(len(g) == 1 for g in grams)

    def chance(h, x):
        if not h:
            return (grams[x,] + 0.5) / (n + 0.5 * (v + 1))
        return (grams[*h, x] + strength * chance(h[1:], x)) / (states[h] + strength)

    out = {}
    for i, _, t in docs:
        w = ["<s>", *cut(t)]
        base = sum(math.log10(chance((), x)) for x in w[1:])
        score = sum(math.log10(chance(tuple(w[max(0, j - order + 1) : j]), w[j])) for j in range(1, len(w)))
        out[i] = (len(w) - 1, sum(grams[x,] > 0 for x in w[1:]), n, base, score)
    return out


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_scores_equal_the_smoothed_model(spark, monkeypatch, order):
    rng = random.Random(11)
    docs = [(0, False, None), (1, True, ""), (2, False, "A a\x0bA"), (3, True, "unseen words only")]
    docs += [(i, i % 5 == 1, " ".join(rng.choice(["Der", "die", "und", "ß", "x" * 30, f"w{rng.randrange(200)}"]) for _ in range(rng.randint(1, 80)))) for i in range(4, 200)]
    for name, value in (("CHUNK_BYTES", 3000), ("BUCKET_ENTRIES", 64), ("SEGMENT", 7)):
        monkeypatch.setattr(backoff, name, value)
    df = spark.createDataFrame([(i, not h, t, "k") for i, h, t in docs], "doc_id long, train boolean, text string, chunk string").repartition(3)
    got = backoff.scored(df, order).collect()
    assert len(got) == len(docs)
    expected = plain_model(docs, got[0].strength, order)
    for r in got:
        assert (r.n_tokens, r.n_known, r.train_tokens) == expected[r.doc_id][:3]
        assert (r.base_score, r.score) == pytest.approx(expected[r.doc_id][3:], rel=1e-9)
    assert backoff.scored(df.limit(0), order).collect() == []


def test_the_state_is_the_longest_seen_context():
    """States that the traversal carries, arcs before failures, on a text that leaves the known path and returns."""
    texts = pa.array(["a b c d", "x a b q c d"])
    chunk = backoff.Chunk(texts, np.array([True, False]), 3)
    model = backoff.Automaton(chunk, chunk.counts, 5, 5)
    state, arc, fails = model.traverse()
    seen = {g for g in [("<s>",), ("a",), ("b",), ("c",), ("d",), ("<s>", "a"), ("a", "b"), ("b", "c"), ("c", "d"), ("d", "</s>")]}
    words, at = ["a", "b", "c", "d", "</s>", "x", "a", "b", "q", "c", "d", "</s>"], chunk.first.tolist()
    for i in range(len(words)):
        t = 0 if i < at[1] else at[1]
        history = ["<s>", *words[t:i]][-2:]
        longest = next((tuple(history[j:]) for j in range(len(history)) if tuple(history[j:]) in seen), ())
        depth = sum(state[i] >= o for o in model.offset[1:])
        assert depth == len(longest), (i, longest)
    assert fails[: at[1]].tolist() == [0] * 5 and fails[at[1]] == 1


def test_smoothed_probabilities_add_up_to_one():
    chunk = backoff.Chunk(pa.array(["a b a c", "b a"]), np.array([True, True]), 2)
    model = backoff.Automaton(chunk, chunk.counts, 8, 4)
    arcs, failures = model.weights(3.0)
    chance = (model.counts[0] + 0.5) / (8 + 0.5 * 5)
    for state in range(1, len(chunk.keys[0]) + 1):
        own = np.flatnonzero(model.codes // model.width == state)
        if not len(own):
            continue
        seen = set((model.codes[own] % model.width).tolist())
        others = [w for w in range(model.width) if w not in seen and w != chunk.begin]
        rest = 10 ** failures[state] * (sum(chance[w] for w in others) + 0.5 / (8 + 0.5 * 5))
        assert (10 ** arcs[own]).sum() + rest == pytest.approx(1.0)


def test_pairs_help_on_held_out_texts(spark):
    got = QUERIES["op9_lm_score"](spark, SMALL).collect()
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {r.doc_id for r in got if binascii.crc32(str(r.doc_id).encode()) % 5 == 1}
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


# --- 10: language


def test_languages_of_held_out_texts(spark):
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = QUERIES["op10_language_id"](spark, SMALL).collect()
    held = [r for r in got if r.held_out and langs[r.doc_id] is not None]
    assert len(got) == len(langs) and {r.doc_id for r in held} <= {i for i in langs if binascii.crc32(str(i).encode()) % 3 == 1}
    right = sum(r.lang_pred == langs[r.doc_id] for r in held)
    assert right >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in got)


def test_no_language_is_left_out_of_the_sample(spark):
    """Languages of long texts only, of one id for all rows, of no ids, and of one row over and over."""
    rows = [(i, f"das lange wort {i} " * 2000, "long") for i in range(3)] + [(None, f"ohne nummer {i}", "none") for i in range(200)]
    for id in range(6):
        rows += [(id, f"words of {id} and {i}", f"shared{id}") for i in range(200)] + [(id, f"copy {id}", f"copies{id}") for _ in range(200)]
    rows += [(1, "12", "letterless"), (2, None, "letterless")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = stringkernel.fit(docs, key="doc_id", per_class=4, landmarks=28)
    assert model.languages == sorted({r[2] for r in rows} - {"letterless"})


def test_kernel_equals_its_definition():
    import pyarrow as pa

    from rowloom.llm.arrowtext import text_bytes

    texts, labels = ["der die das und", "the and of it", "über die", "of the"], ["de", "en", "de", "en"]
    model = stringkernel.train(texts, labels, [0, 1])
    fold = lambda t: re.sub(rb"[^a-z\x80-\xff]", b" ", t.translate(LOWER).encode())
    grams = lambda t: {fold(t)[i : i + n] for n in (1, 2, 3) for i in range(len(fold(t)) - n + 1)}
    space = grams(texts[0]) | grams(texts[1])
    expected = [[len(grams(x) & grams(z)) / math.sqrt(len(grams(x) & space) * len(grams(z))) for z in texts[:2]] for x in texts]
    assert np.allclose(stringkernel.kernel(model, stringkernel.tables(model), *text_bytes(pa.array(texts))), expected)


def test_texts_without_letters_are_undetermined(spark):
    docs = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "12 !!", "x"), (4, "der die und", "x"), (4, "der die und", "x"), (5, "Я" * 5000, "x")], "doc_id long, text string, score string")
    model = stringkernel.train(["der die das und", "the and of it"], ["de", "en"], [0, 1])
    got = stringkernel.predict(docs, model)
    assert got.columns == ["doc_id", "text", "lang_pred", "score"]
    found = sorted((r.doc_id, r.lang_pred) for r in got.collect())
    assert found[:5] == [(1, "und"), (2, "und"), (3, "und"), (4, "de"), (4, "de")] and found[5][1] in ("de", "en")
    nothing = stringkernel.fit(docs.selectExpr("doc_id", "text", "CAST(NULL AS string) AS lang"), key="doc_id")
    assert {r.lang_pred for r in stringkernel.predict(docs, nothing).collect()} == {"und"}
    assert stringkernel.predict(docs.limit(0), model).collect() == []


# --- queries with SQL


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_equal_their_sql(spark, name):
    from check_oracle import compare, connect

    problem = compare(QUERIES[name](spark, SMALL).toPandas(), connect(SMALL).execute(ORACLES[name]).df())
    assert not problem


def test_counts_beyond_32_bits():
    """Two chunks with three thousand million occurrences each of one word."""
    keys = np.array([7], np.uint64)
    raw = backoff.packed(np.diff(keys, prepend=np.uint64(0))), backoff.packed(np.array([3_000_000_000], np.uint64))
    table = pa.table({"kind": [1, 1], "bucket": [0, 0], "chunk": [1, 2], "keys": pa.array([raw[0]] * 2, pa.binary()), "counts": pa.array([raw[1]] * 2, pa.binary())})
    out = backoff._answer(table)
    assert out.column("total").to_pylist() == [6_000_000_000, 0]
    assert [int(backoff.unpacked(x, np.uint64)[0]) for x in out.column("counts").to_pylist()] == [6_000_000_000] * 2


def test_clean_keeps_columns_of_any_name(spark):
    docs = spark.createDataFrame([(1, "one two three", "k"), (2, "other words", "l")], "doc_id long, text string, __key string")
    items = spark.createDataFrame([("a", "two three")], "item_id string, text string")
    assert [tuple(r) for r in phrases.clean(docs, items).collect()] == [(2, "other words", "l")]


def test_long_words_with_one_polynomial_hash_differ():
    bits = [bin(i).count("1") & 1 for i in range(2048)]
    chunk = backoff.Chunk(pa.array(["".join("ab"[b] for b in bits) + " " + "".join("ba"[b] for b in bits)]), np.array([True]), 2)
    assert len(chunk.keys[0]) == 4
