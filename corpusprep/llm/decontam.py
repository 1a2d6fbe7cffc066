"""Benchmark decontamination over a distributed positional inverted index, in DataFrame operations only.

A test item's phrases are its windows of ``width`` consecutive words (a shorter item is one window).
Exact phrase search runs in three steps.

1. Count how often each test term occurs in the documents.
2. Store the postings of the rarest two terms of each phrase: (term, document key, position) with the
   words around the position, written to the shared folder.
3. Shift each posting by the term's offset in the phrase, which names the place where the phrase would
   begin, intersect the lists of the phrase's two terms on (phrase, document, place), and compare the
   words around with the whole phrase.

Frequent words are never stored, so no posting list grows with the corpus unless the phrase itself is
frequent.  The test terms are broadcast to the scans only if their bytes are below ``BROADCAST_BYTES``;
beyond it the same joins run as shuffles.

Defined results: a null text has no words; an item without words has no window and matches nothing;
a null ``item_id`` is not counted; items that share a window all match; repeated document rows get the
same result each; empty tables give no hits.  Only the id and text columns are read by the searches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusprep.llm.common import KEY_HASH, KEY_ID, LOWER, UPPER, saved, with_row_key

WIDTH = 13
BROADCAST_BYTES = 32 << 20
#: Rarest terms of a phrase whose lists are intersected.
LISTS = 2
KEY = [KEY_ID, KEY_HASH]


def words(text: Column) -> Column:
    """Runs of letters, digits and everything beyond ASCII, A-Z lower-cased."""
    given = F.coalesce(text, F.lit(""))
    # lower() is the faster one, but also changes capitals beyond ASCII
    low = F.when(F.octet_length(given) == F.length(given), F.lower(given)).otherwise(F.translate(given, UPPER, LOWER))
    return F.array_remove(F.split(low, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def count_words(text: Column) -> Column:
    """The number of ``words``, without building them."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")).cast("long")


def small(df: DataFrame, n_bytes: int) -> DataFrame:
    """``df`` with a broadcast hint if it is known to be small."""
    return F.broadcast(df) if n_bytes <= BROADCAST_BYTES else df


def term_bytes(df: DataFrame) -> int:
    row = df.agg(F.sum(F.octet_length("term") + 64).alias("n")).collect()[0]
    return int(row["n"] or 0)


def item_phrases(items: DataFrame, item_col: str = "item_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """(item, phrase, terms): the windows of every item; ``phrase`` is the terms joined by spaces."""
    w = items.select(F.col(item_col).cast("string").alias("item"), words(F.col(text_col)).alias("w")).where(F.size("w") > 0)
    windows = F.transform(F.sequence(F.lit(1), F.greatest(F.size("w") - (width - 1), F.lit(1))), lambda i: F.slice("w", i, width))
    return w.select("item", F.explode(windows).alias("terms")).select("item", F.array_join("terms", " ").alias("phrase"), "terms")


def keyed_words(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    keyed = with_row_key(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), "doc_id", "text")
    return keyed.select("doc_id", *KEY, words(F.col("text")).alias("w"))


def term_counts(docs_words: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, n): occurrences in the documents of each of ``terms`` that occurs at all."""
    terms = small(terms, term_bytes(terms))
    return docs_words.select(F.explode("w").alias("term")).join(terms, "term").groupBy("term").agg(F.count(F.lit(1)).alias("n"))


def positional_index(docs_words: DataFrame, terms: DataFrame, reach: int) -> DataFrame:
    """Stored postings (term, key, pos, around, at) of ``terms``: ``around`` holds the words up to
    ``reach`` before and after, ``at`` the place of the term in it."""
    terms = small(terms, term_bytes(terms))
    hit = docs_words.select(*KEY, "w", F.posexplode("w").alias("pos", "term")).join(terms, "term")
    first = F.greatest(F.col("pos") - reach, F.lit(0))
    return saved(hit.select("term", *KEY, "pos", F.slice("w", first + 1, F.lit(2 * reach + 1)).alias("around"),
                            (F.col("pos") - first).alias("at")), "postings")


def rarest_terms(phrases: DataFrame, counts: DataFrame, lists: int = LISTS) -> DataFrame:
    """(phrase, terms, list, term, offset) of the rarest ``lists`` distinct places of each phrase all of
    whose terms occur."""
    each = phrases.select("phrase", "terms", F.posexplode("terms").alias("offset", "term")).join(counts, "term")
    by = Window.partitionBy("phrase")
    placed = each.withColumn("list", F.row_number().over(by.orderBy("n", "term", "offset"))) \
        .withColumn("found", F.count(F.lit(1)).over(by))
    return placed.where((F.col("found") == F.size("terms")) & (F.col("list") <= lists)).select("phrase", "terms", "list", "term", "offset")


def phrase_matches(index: DataFrame, rare: DataFrame, lists: int = LISTS) -> DataFrame:
    """(phrase, key, start, n): every exact occurrence of each phrase of n words."""
    joined = index.join(rare, "term").withColumn("start", F.col("pos") - F.col("offset")).where("start >= 0")
    n = F.size("terms")
    exact = (F.col("at") >= F.col("offset")) & (F.slice("around", F.greatest(F.col("at") - F.col("offset"), F.lit(0)) + 1, n) == F.col("terms"))
    places = joined.select("phrase", *KEY, "start", n.alias("n"), F.shiftleft(F.lit(1), F.col("list") - 1).alias("bit"), exact.alias("exact")) \
        if lists <= 1 else joined.select("phrase", *KEY, "start", n.alias("n"), F.expr("shiftleft(1, list - 1)").alias("bit"), exact.alias("exact"))
    met = places.groupBy("phrase", *KEY, "start", "n").agg(F.bit_or("bit").alias("bits"), F.bool_and("exact").alias("exact"))
    whole = F.expr(f"shiftleft(1, least(n, {lists})) - 1")
    return met.where((F.col("bits") == whole) & F.col("exact")).select("phrase", *KEY, "start", "n")


def proximity_matches(index: DataFrame, pairs: DataFrame, slop: int) -> DataFrame:
    """(a, b, key, pos_a, pos_b): places where the terms ``a`` and ``b`` stand within ``slop`` words.  Positions
    are dealt into cells of ``slop + 1`` words; a match lies in the same or a neighbouring cell, so it is an
    equi-join."""
    cell = F.floor(F.col("pos") / (slop + 1))
    left = index.join(pairs.select(F.col("a").alias("term"), "b"), "term") \
        .select(F.col("term").alias("a"), "b", *KEY, F.col("pos").alias("pos_a"), F.explode(F.array(cell - 1, cell, cell + 1)).alias("cell"))
    right = index.select(F.col("term").alias("b"), *KEY, F.col("pos").alias("pos_b"), cell.alias("cell"))
    return left.join(right, ["b", *KEY, "cell"]).where((F.abs(F.col("pos_a") - F.col("pos_b")) <= slop) & (F.col("pos_a") != F.col("pos_b"))) \
        .select("a", "b", *KEY, "pos_a", "pos_b").distinct()


def document_hits(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """(key, n_hit, items): for each document with an occurrence, its words inside any occurrence and the
    distinct ids of the items (as strings, sorted)."""
    found = saved(item_phrases(items, item_col, item_text_col, width), "phrases")
    phrases = found.select("phrase", "terms").dropDuplicates(["phrase"])
    dw = keyed_words(docs, id_col, text_col)
    counts = saved(term_counts(dw, phrases.select(F.explode("terms").alias("term")).distinct()), "term-counts")
    rare = saved(rarest_terms(phrases, counts), "rare-terms")
    index = positional_index(dw, rare.select("term").distinct(), width - 1)
    places = saved(phrase_matches(index, rare), "phrase-places")
    # union of the intervals [start, start + n) of each document
    before = Window.partitionBy(*KEY).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    spans = places.select(*KEY, "start", (F.col("start") + F.col("n")).alias("end")).distinct() \
        .withColumn("upto", F.coalesce(F.max("end").over(before), F.lit(0)))
    covered = spans.groupBy(*KEY).agg(F.sum(F.greatest(F.col("end") - F.greatest("start", "upto"), F.lit(0))).cast("long").alias("n_hit"))
    named = places.select(*KEY, "phrase").distinct().join(found.where("item is not null").select("phrase", "item").distinct(), "phrase") \
        .select(*KEY, "item").distinct().groupBy(*KEY).agg(F.array_sort(F.collect_list("item")).alias("items"))
    return covered.join(named, KEY, "left")


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", width: int = WIDTH, share: int = 20) -> DataFrame:
    """(doc_id, key, n_words, n_hit, items, contaminated) for every row: a document is contaminated if at least one
    in ``share`` of its words is hit."""
    hits = document_hits(docs, items, id_col, text_col, item_col, item_text_col, width)
    keyed = with_row_key(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), "doc_id", "text")
    sizes = keyed.select("doc_id", *KEY, count_words(F.col("text")).alias("n_words"))
    out = sizes.join(hits, KEY, "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return out.select("doc_id", *KEY, "n_words", n_hit.alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"),
                      ((n_hit > 0) & (share * n_hit >= F.col("n_words"))).alias("contaminated"))


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the contaminated documents; all columns are kept."""
    bad = saved(contamination(docs, items, id_col, text_col, **options).where("contaminated").select(*KEY).distinct(), "contaminated")
    return with_row_key(docs, id_col, text_col).join(bad, KEY, "left_anti").drop(*KEY)
