"""Benchmark passages in training texts by a positional inverted index: postings
of test terms are stored once, offset-adjusted lists are intersected from the
rarest term of each passage on, and what is left is compared word by word.
DataFrame functions only.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

WINDOW = 10   # words of a passage
BLOCK = 512   # places of a text that are indexed together
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # what stands between words: A-Z become a-z


def _words(text: Column) -> Column:
    spaced = F.trim(F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), BETWEEN, " "))
    return _split(F.translate(spaced, string.ascii_uppercase, string.ascii_lowercase))


def _split(text: Column) -> Column:
    return F.filter(F.split(text, " "), lambda w: w != "")  # no words: one empty string


# ------------------------------------------------------------ test passages

@dataclass
class Passages:
    windows: DataFrame  # (win, terms, size): each different passage once
    items: DataFrame    # (win, item_id)
    terms: DataFrame    # (id, term): each different word of a passage


def passages(benchmark: DataFrame, window: int = WINDOW) -> Passages:
    """All runs of ``window`` consecutive words of benchmark(item_id, text, ...);
    an item of fewer words, but not none, is one passage."""
    words = benchmark.select(F.col("item_id").cast("string").alias("item_id"), _words(F.col("text")).alias("words"))
    starts = F.explode(F.sequence(F.lit(1), F.greatest(F.size("words") - (window - 1), F.lit(1))))
    cut = (words.where(F.size("words") > 0).select("item_id", "words", starts.alias("at"))
           .select("item_id", F.slice("words", F.col("at"), window).alias("terms")).distinct())
    windows = stored(cut.select("terms").distinct().select(F.monotonically_increasing_id().alias("win"), "terms", F.size("terms").alias("size")),
                     "passages")
    items = stored(cut.join(windows, "terms").select("win", "item_id"), "passage-items")
    terms = stored(windows.select(F.explode("terms").alias("term")).distinct()
                   .select(F.monotonically_increasing_id().alias("id"), "term"), "terms")
    return Passages(windows, items, terms)


# -------------------------------------------------------------------- index

@dataclass
class Index:
    blocks: DataFrame    # (key, doc_id, n_words, block, text): BLOCK words of a text and the next ``reach``, joined by a space
    postings: DataFrame  # (id, key, block, place): every place of a test term in a block
    reach: int


def build_index(docs: DataFrame, terms: DataFrame, reach: int = WINDOW - 1) -> Index:
    """Stores the words of docs(doc_id, text, ...) by block and the postings of
    ``terms``.  A text of any length is many rows of bounded size; a row without
    words is one block without words.  The terms are joined by Spark's own size
    check; beyond it the join of a frequent term is split by adaptive execution."""
    words = docs.select(F.monotonically_increasing_id().alias("key"), F.col("doc_id").cast("long").alias("doc_id"), _words(F.col("text")).alias("words"))
    block = F.explode(F.sequence(F.lit(0), F.floor(F.greatest(F.size("words") - 1, F.lit(0)) / BLOCK).cast("int")))
    part = F.array_join(F.slice("words", F.col("block") * BLOCK + 1, F.lit(BLOCK + reach)), " ")
    blocks = stored(words.select("key", "doc_id", F.size("words").cast("long").alias("n_words"), "words", block.alias("block"))
                    .select("key", "doc_id", "n_words", "block", part.alias("text")), "blocks")
    places = blocks.select("key", "block", F.posexplode(F.split("text", " ")).alias("place", "term"))
    return Index(blocks, stored(places.join(terms, "term").select("id", "key", "block", "place"), "postings"), reach)


def _rarest(index: Index, found: Passages) -> DataFrame:
    """(win, size, id1, at1, id2, at2): the rarest two terms of each passage, by
    postings over all texts, and their offsets.  id2 is null for a single word."""
    often = index.postings.groupBy("id").agg(F.count("*").alias("often"))
    each = found.windows.select("win", "size", F.posexplode("terms").alias("at", "term")).join(found.terms, "term").join(often, "id", "left")
    ranked = each.groupBy("win", "size").agg(F.array_sort(F.collect_list(
        F.struct(F.coalesce("often", F.lit(0)).alias("often"), "at", "id"))).alias("ranked"))
    first, second = F.get("ranked", F.lit(0)), F.get("ranked", F.lit(1))
    return stored(ranked.where(first["often"] > 0).select(
        "win", "size", first["id"].alias("id1"), first["at"].alias("at1"), second["id"].alias("id2"), second["at"].alias("at2")), "rarest")


def search(index: Index, found: Passages, slop: int = 0) -> DataFrame:
    """(key, block, start, size, win): matches of passages, start counted in the block.

    slop 0: every place where a passage stands word for word.  slop > 0: for
    each place of a passage's rarest term, the first stretch of size + slop
    words around it that holds all different words of the passage, in any
    order; the index needs a reach of window + slop - 1.
    """
    rarest = _rarest(index, found)
    lists = index.postings.join(rarest, F.col("id") == F.col("id1")).drop("id")
    if slop:
        near = lists.select("key", "block", "win", "size", "id2", "place")
    else:
        start = F.col("place") - F.col("at1")
        near = (lists.select("key", "block", "win", "size", "id2", start.alias("start"), (start + F.col("at2")).alias("place"))
                .where((F.col("start") >= 0) & (F.col("start") < BLOCK)))
    seconds = (index.postings.join(rarest.select(F.col("id2").alias("id")).distinct(), "id", "left_semi")
               .select(F.col("id").alias("id_"), F.col("key").alias("key_"), F.col("block").alias("block_"), F.col("place").alias("place_")))
    same = (F.col("key") == F.col("key_")) & (F.col("block") == F.col("block_")) & (F.col("id2") == F.col("id_"))
    if slop:
        meet = same & (F.abs(F.col("place") - F.col("place_")) < F.col("size") + slop)
    else:
        meet = same & (F.col("place") == F.col("place_"))
    both = near.where("id2 is not null").join(seconds, meet, "left_semi").unionByName(near.where("id2 is null"))
    # what is left is compared on the words themselves, all candidates of a block at once
    at = "place" if slop else "start"
    by_block = both.groupBy("key", "block").agg(F.collect_list(F.struct("win", "size", F.col(at).alias("at"))).alias("near"))
    text = index.blocks.select("key", "block", "text").join(by_block, ["key", "block"]).withColumn("words", F.split("text", " "))
    if not slop:
        pieces = F.expr("transform(near, c -> struct(c.win as win, c.size as size, c.at as start, slice(words, c.at + 1, c.size) as piece))")
        cut = text.select("key", "block", F.inline(pieces))
        return (cut.join(found.windows.select("win", "terms"), "win").where(F.col("piece") == F.col("terms"))
                .select("key", "block", "start", "size", "win"))
    pieces = F.expr(f"""transform(near, c -> struct(c.win as win, c.size + {slop} as size, c.at as at, greatest(c.at - c.size - {slop} + 1, 0) as low,
                        slice(words, greatest(c.at - c.size - {slop} + 1, 0) + 1, 2 * (c.size + {slop}) - 1) as piece))""")
    cut = text.select("key", "block", F.inline(pieces)).where(F.col("low") < BLOCK)
    first = F.expr(f"""get(filter(sequence(0, least(at, {BLOCK - 1}) - low),
                       s -> size(array_except(terms, slice(piece, s + 1, size))) = 0), 0)""")
    return (cut.join(found.windows.select("win", "terms"), "win").withColumn("first", first).where("first is not null")
            .select("key", "block", (F.col("low") + F.col("first")).alias("start"), "size", "win").distinct())


def matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, slop: int = 0) -> DataFrame:
    """(doc_id, start, size, item_id): each place (word number) where a passage
    of an item stands, or for slop > 0 where its words stand close together."""
    found = passages(benchmark, window)
    index = build_index(docs, found.terms, window - 1 + slop)
    hits = search(index, found, slop).join(found.items, "win").select(
        "key", (F.col("block").cast("long") * BLOCK + F.col("start")).alias("start"), "size", "item_id").distinct()
    return index.blocks.where("block = 0").select("key", "doc_id").join(hits, "key").drop("key")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) for each row of docs(doc_id, text, ...).

    Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z.
    A passage is ``window`` consecutive words of an item of benchmark(item_id,
    text, ...), or all words of a shorter item.  n_hit counts the words of a
    text inside any occurrence of a passage; n_items the items with one;
    items_sha256 is over their ids, sorted as strings, joined by commas.

    Null and empty texts have no words.  An item without words matches
    nothing; one with a null id marks words but is not counted; repeated ids
    count once.  Repeated rows and null ids of docs give a row each, since
    rows are told apart by a stored key.  Other columns are ignored.  Without
    texts there are no rows, without items no hits.
    """
    found = passages(benchmark, window)
    index = build_index(docs, found.terms, window - 1)
    hits = stored(search(index, found), "matches")
    merged = F.expr("""aggregate(array_sort(collect_set(struct(start, start + size as end))), cast(array() as array<struct<start:int,end:int>>),
        (spans, x) -> if(size(spans) > 0 and element_at(spans, -1).end >= x.start,
                         concat(slice(spans, 1, size(spans) - 1),
                                array(struct(element_at(spans, -1).start as start, greatest(element_at(spans, -1).end, x.end) as end))),
                         concat(spans, array(x))))""")
    spans = hits.groupBy("key", "block").agg(merged.alias("spans"))
    spans = spans.select("key", F.expr(f"transform(spans, s -> struct(block * {BLOCK}L + s.start as start, block * {BLOCK}L + s.end as end))").alias("spans"))
    covered = F.expr("""aggregate(array_sort(flatten(collect_list(spans))), struct(0L as words, 0L as upto),
        (done, x) -> struct(done.words + greatest(x.end - greatest(done.upto, x.start), 0L) as words, greatest(done.upto, x.end) as upto)).words""")
    counts = spans.groupBy("key").agg(covered.alias("hit"))
    items = (hits.select("key", "win").distinct().join(found.items, "win")
             .groupBy("key").agg(F.array_sort(F.collect_set("item_id")).alias("items")))
    rows = index.blocks.where("block = 0").select("key", "doc_id", "n_words").join(counts, "key", "left").join(items, "key", "left")
    hit, listed = F.coalesce("hit", F.lit(0)), F.coalesce("items", F.array().cast("array<string>"))
    return rows.select("doc_id", "n_words", hit.alias("n_hit"), F.size(listed).cast("long").alias("n_items"),
                       F.sha2(F.array_join(listed, ",").cast("binary"), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))
