"""Phrase search over a positional inverted index, with DataFrame functions only.

The index is a written table of postings (key, pos, term) of the terms that the searched phrases hold; the
postings of other terms can never take part in a match. A phrase is searched from its rarest term: each
posting of that term proposes a start (position less the term's offset), the offset-adjusted postings of the
second rarest term are intersected with the proposals, and those of all other terms with what is left. The
long lists of frequent words are thus read only for documents in which two rare words already fit.

Words: A to Z are lower-cased, words are runs of digits, a to z and non-ASCII characters. Null texts have no
words. A phrase is WINDOW consecutive words of an item; an item of fewer words (but not none) is one phrase.
``key`` is 128 bits of a document's id and text, so that rows that share an id keep apart; rows alike in both have
the same matches. Of equally rare terms the first in text order, then by place, goes first; the matches do not
depend on it. Long texts are rows of postings like others. Extra columns stay in ``clean`` whatever their names
and do not matter elsewhere; empty tables give empty results.

Phrases come from the benchmark, whose tables are broadcast only if ``small`` has counted and measured them;
beyond that the joins are shuffles with Spark's adaptive splitting of hot keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rowloom.llm.arrowtext import document_key, free_name
from rowloom.session import stored

WINDOW = 10
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Most rows and bytes of a table that is broadcast.
SMALL_ROWS, SMALL_BYTES = 300_000, 16 << 20


def _parts(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), _BETWEEN)


def _lowered(word: Column) -> Column:
    """A to Z in lower case, other capitals as they are."""
    return F.when(F.lower(word) == word, word).otherwise(F.translate(word, _UPPER, _LOWER))


def words(text: Column) -> Column:
    """The words of a text in order."""
    return F.filter(_parts(F.translate(text, _UPPER, _LOWER)), lambda w: w != "")


def n_words(text: Column) -> Column:
    parts = _parts(text)
    edge = (F.element_at(parts, 1) == "").cast("long") + ((F.size(parts) > 1) & (F.element_at(parts, -1) == "")).cast("long")
    return F.size(parts).cast("long") - edge


def small(df: DataFrame, width: Column | None = None) -> DataFrame:
    """A written table, marked for broadcast if it is proven small. ``width``: bytes of a row's texts."""
    rows, size = df.agg(F.count("*"), F.sum((width if width is not None else F.lit(0)) + 64)).first()
    return F.broadcast(df) if rows <= SMALL_ROWS and (size or 0) <= SMALL_BYTES else df


def windows(items: DataFrame, size: int = WINDOW) -> DataFrame:
    """(item_id, terms): every phrase of every item."""
    listed = items.select("item_id", words(F.col("text")).alias("w")).where("size(w) > 0")
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - size, F.lit(0)))
    return listed.select("item_id", F.explode(F.transform(starts, lambda i: F.slice("w", i + 1, size))).alias("terms"))


def postings(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """The index: (key, pos, term) of every occurrence of the given terms in (doc_id, text)."""
    # The key is worked out below the generator, once per document and not once per word.
    keyed = docs.select(document_key("doc_id", "text").alias("key"), _parts(F.col("text")).alias("parts"))
    located = keyed.select("key", F.posexplode("parts").alias("pos", "raw"))
    return located.select("key", "pos", _lowered(F.col("raw")).alias("term")).join(terms, "term", "left_semi")


def ranked_phrases(phrases: DataFrame, index: DataFrame) -> DataFrame:
    """Phrases with their terms as (freq, term, offset), rarest first; those with an absent term are left out."""
    freq = index.groupBy("term").agg(F.count("*").alias("freq"))
    place = phrases.select("phrase", F.size("terms").alias("n"), F.posexplode("terms").alias("offset", "term"))
    return (
        place.join(freq, "term")
        .groupBy("phrase", "n")
        .agg(F.sort_array(F.collect_list(F.struct("freq", "term", "offset"))).alias("order"))
        .where("size(order) = n")
    )


def phrase_matches(index: DataFrame, phrases: DataFrame) -> DataFrame:
    """(phrase, n, key, start) of every occurrence. ``phrases``: (phrase, terms), each phrase once."""
    ranked = stored(ranked_phrases(phrases, index), "ranked")
    width = F.length("phrase") * 2
    # Only numbers travel with the proposals: a phrase goes by its hash, which the table shows to be unique.
    ranked = ranked.withColumn("id", F.xxhash64("phrase"))
    if ranked.groupBy("id").count().where("count > 1").head(1):
        raise ValueError("two phrases share a hash")
    first = small(ranked.select("id", "n", F.col("order")[0]["term"].alias("term"), F.col("order")[0]["offset"].alias("offset"), F.get("order", F.lit(1))["term"].alias("term2"), F.get("order", F.lit(1))["offset"].alias("offset2")), F.lit(64))
    proposed = index.join(first, "term").select("id", "n", "key", (F.col("pos") - F.col("offset")).alias("start"), "term2", (F.col("pos") - F.col("offset") + F.col("offset2")).alias("pos2"))
    single = proposed.where("term2 IS NULL").select("id", "key", "start")

    seconds = small(stored(ranked.where("n > 1").select(F.col("order")[1]["term"].alias("term2")).distinct(), "seconds"), F.length("term2"))
    second = index.withColumnRenamed("term", "term2").withColumnRenamed("pos", "pos2").join(seconds, "term2", "left_semi")
    pairs = stored(proposed.where("term2 IS NOT NULL").join(second, ["key", "pos2", "term2"]).select("id", "key", "start").union(single), "pairs")

    rest = F.slice("order", 3, 1 << 20)
    asked = small(ranked.select("id", "n", "phrase", F.transform(rest, lambda x: F.struct(x["term"].alias("term"), x["offset"].alias("offset"))).alias("rest")), width * 2)
    complete = pairs.join(asked, "id")
    keys = small(stored(pairs.select("key").distinct(), "keys"))
    here = index.join(keys, "key", "left_semi")
    needed = complete.where("n > 2").select("id", "key", "start", "n", F.explode("rest").alias("t")).select("id", "key", "start", "n", (F.col("start") + F.col("t.offset")).alias("pos"), F.col("t.term").alias("term"))
    full = needed.join(here, ["key", "pos", "term"]).groupBy("id", "key", "start", "n").agg(F.count_distinct("pos").alias("found")).where("found = n - 2")
    whole = complete.where("n <= 2").select("id", "key", "start").union(full.select("id", "key", "start")).distinct()
    return whole.join(small(ranked.select("id", "phrase", "n"), width), "id").select("phrase", "n", "key", "start")


def proximity_matches(index: DataFrame, phrases: DataFrame, reach: int) -> DataFrame:
    """(phrase, key, pos): postings of a phrase's rarest term with every other term at most ``reach`` words away.

    As for phrases, the second rarest term is looked for first, in the three blocks of ``reach`` words around, and
    the others only around what is left.
    """
    ranked = stored(ranked_phrases(phrases, index), "ranked").withColumn("id", F.xxhash64("phrase"))
    if ranked.groupBy("id").count().where("count > 1").head(1):
        raise ValueError("two phrases share a hash")
    terms = ranked.select("id", "phrase", F.array_distinct(F.transform("order", lambda x: x["term"])).alias("terms"))
    first = small(terms.select("id", F.col("terms")[0].alias("term"), F.get("terms", F.lit(1)).alias("term2")), F.lit(64))
    anchors = index.join(first, "term").select("id", "key", "pos", "term2")
    alone = anchors.where("term2 IS NULL").select("id", "key", "pos")
    around = F.explode(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda d: F.floor(F.col("pos") / reach) + d)).alias("block")
    placed = index.select("key", "term", F.col("pos").alias("at"), F.floor(F.col("pos") / reach).alias("block"))
    close = F.abs(F.col("at") - F.col("pos")) <= reach

    seconds = small(stored(terms.select(F.get("terms", F.lit(1)).alias("term")).where("term IS NOT NULL").distinct(), "seconds"), F.length("term"))
    second = placed.join(seconds, "term", "left_semi").withColumnRenamed("term", "term2")
    asked = anchors.where("term2 IS NOT NULL").select("id", "key", "pos", "term2", around)
    pairs = stored(asked.join(second, ["key", "term2", "block"]).where(close).select("id", "key", "pos").distinct(), "pairs")

    rest = small(terms.where("size(terms) > 2").select("id", F.slice("terms", 3, 1 << 20).alias("rest"), (F.size("terms") - 2).alias("n")), F.lit(256))
    keys = small(stored(pairs.select("key").distinct(), "keys"), F.lit(16))
    here = placed.join(keys, "key", "left_semi")
    wanted = pairs.join(rest, "id").select("id", "key", "pos", "n", around, "rest").select("id", "key", "pos", "n", "block", F.explode("rest").alias("term"))
    full = wanted.join(here, ["key", "term", "block"]).where(close).groupBy("id", "key", "pos", "n").agg(F.count_distinct("term").alias("found")).where("found = n")
    short = pairs.join(small(terms.where("size(terms) = 2").select("id"), F.lit(8)), "id", "left_semi")
    whole = alone.union(short).union(full.select("id", "key", "pos")).distinct()
    return whole.join(small(terms.select("id", "phrase"), F.length("phrase") * 2), "id").select("phrase", "key", "pos")


def covered(matches: DataFrame) -> DataFrame:
    """(key, n_hit): words inside any occurrence, each counted once."""
    before = Window.partitionBy("key").orderBy("start", "n").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("n")
    new = F.greatest(end - F.greatest(F.col("start"), F.coalesce(F.max(end).over(before), F.col("start"))), F.lit(0))
    return matches.select("key", new.alias("new")).groupBy("key").agg(F.sum("new").cast("long").alias("n_hit"))


def found(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """(key, n_hit, item_ids) of the documents (doc_id, text) that hold a phrase of an item."""
    listed = stored(windows(items.select("item_id", "text"), size).select("item_id", "terms", F.array_join("terms", " ").alias("phrase")), "windows")
    phrases = listed.select("phrase", "terms").distinct()
    vocabulary = stored(phrases.select(F.explode("terms").alias("term")).distinct(), "vocabulary")
    index = stored(postings(docs, small(vocabulary, F.length("term"))), "postings")
    matches = stored(phrase_matches(index, phrases), "matches")
    holders = small(listed.select("phrase", "item_id").distinct(), F.length("phrase"))
    ids = matches.select("key", "phrase").distinct().join(holders, "phrase").groupBy("key").agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("item_ids"))
    return stored(covered(matches.select("key", "start", "n").distinct()).join(ids, "key", "left"), "hits")


def contamination(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """(doc_id, key, n_words, n_hit, item_ids): every document with its hit words and the items found in it."""
    docs = docs.select("doc_id", "text")
    sizes = docs.select("doc_id", document_key("doc_id", "text").alias("key"), n_words(F.col("text")).alias("n_words"))
    return sizes.join(small(found(docs, items, size)), "key", "left").select(
        "doc_id", "key", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids")
    )


def clean(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """``docs`` without the documents that hold a phrase of an item."""
    own = free_name(docs.columns, "__key")
    hit = small(found(docs.select("doc_id", "text"), items, size).select(F.col("key").alias(own)))
    return docs.join(hit, document_key("doc_id", "text") == F.col(own), "left_anti")


def near(docs: DataFrame, items: DataFrame, reach: int, size: int = WINDOW) -> DataFrame:
    """(doc_id, n_near, item_ids): for every document the places where all terms of a phrase stand within ``reach``
    words of its rarest one, in any order, and the items of these phrases."""
    docs = docs.select("doc_id", "text")
    listed = stored(windows(items.select("item_id", "text"), size).select("item_id", "terms", F.array_join("terms", " ").alias("phrase")), "windows")
    vocabulary = stored(listed.select(F.explode("terms").alias("term")).distinct(), "vocabulary")
    index = stored(postings(docs, small(vocabulary, F.length("term"))), "postings")
    matches = stored(proximity_matches(index, listed.select("phrase", "terms").distinct(), reach), "near")
    holders = small(listed.select("phrase", "item_id").distinct(), F.length("phrase"))
    ids = matches.select("key", "phrase").distinct().join(holders, "phrase").groupBy("key").agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("item_ids"))
    counted = stored(matches.groupBy("key").agg(F.count("*").alias("n_near")).join(ids, "key"), "found")
    keyed = docs.select("doc_id", document_key("doc_id", "text").alias("key"))
    return keyed.join(small(counted), "key", "left").select(
        "doc_id", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids")
    )
