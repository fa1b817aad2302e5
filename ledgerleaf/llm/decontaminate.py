"""Benchmark passages inside documents, by SimHash of item-sized windows.

Only DataFrame functions.  A window is worth a fingerprint only if it shares a shingle with the
benchmark, since without one its similarity is zero; the alignment of the shared shingle says
where the window starts and how long it is.  Fingerprints of distinct windows meet those of the
items through blocks of bits: within ``RADIUS`` at least one of ``RADIUS + 1`` blocks is equal.
Similar passages may lie beyond the radius, so a window also meets every item of its size of
which it has one of the heaviest shingles: of the rest alone none reaches the similarity.  All
pairs are verified by exact weighted similarity of their shingles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import let, staged, text_column

SHINGLE = 5
SIMILARITY = 0.8
#: Largest Hamming distance of 64-bit fingerprints that is looked up, by one more blocks.  Farther
#: pairs come from ``heaviest`` alone, which misses none.
RADIUS = 11
BITS = 64


def word_list(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def shingle_hashes(words: Column, width: int = SHINGLE) -> Column:
    """Hashes of all runs of ``width`` words, empty for shorter lists."""
    starts = F.sequence(F.lit(0), F.size(words) - width)
    hashed = F.transform(starts, lambda i: F.xxhash64(*[words[i + k] for k in range(width)]))
    return F.when(F.size(words) >= width, hashed).otherwise(F.array().cast("array<bigint>"))


def shingle_list(words: Column, width: int = SHINGLE) -> Column:
    starts = F.sequence(F.lit(1), F.size(words) - (width - 1))
    return F.array_distinct(F.transform(starts, lambda i: F.array_join(F.slice(words, i, width), " ")))


def simhash(words: Column) -> Column:
    """Bit by bit the sign of the sum of the words' hash bits; longer words weigh more."""
    places = F.sequence(F.lit(0), F.lit(BITS - 1))
    weighted = F.transform(words, lambda w: F.struct(F.xxhash64(w).alias("h"), F.length(w).alias("n")))
    votes = F.aggregate(weighted, F.array_repeat(F.lit(0), BITS), lambda sums, w: F.zip_with(
        sums, places, lambda total, i: total + F.when(F.getbit(w["h"], i) == 1, w["n"]).otherwise(-w["n"])))
    bits = F.transform(votes, lambda total, i: F.when(total > 0, F.call_function("shiftleft", F.lit(1).cast("bigint"), i)).otherwise(F.lit(0).cast("bigint")))
    return F.aggregate(bits, F.lit(0).cast("bigint"), lambda out, bit: out.bitwiseOR(bit))


def bit_blocks(fingerprint: Column, radius: int = RADIUS) -> Column:
    """``(block, bits)`` structs: the fingerprint in ``radius + 1`` blocks as equal as may be."""
    n = radius + 1
    edges = [i * BITS // n for i in range(n + 1)]
    return F.array(*[
        F.struct(F.lit(i).alias("block"), F.shiftrightunsigned(fingerprint, a).bitwiseAND(F.lit((1 << (b - a)) - 1).cast("bigint")).alias("bits"))
        for i, (a, b) in enumerate(zip(edges, edges[1:]))
    ])


def benchmark_items(benchmark: DataFrame) -> DataFrame:
    """``item, item_id, words``, one row per id and words; items shorter than a shingle take no part."""
    items = benchmark.select("item_id", word_list(text_column()).alias("words")).filter(F.size("words") >= SHINGLE).distinct()
    return items.withColumn("item", F.md5(F.concat_ws(" ", F.col("item_id").cast("string"), F.lit(":"), F.array_join("words", " "))))


def heaviest(weighted: DataFrame, similarity: float) -> DataFrame:
    """``item, shingle``: the heaviest shingles of each item, of which any window of that similarity has one.

    A similar window lacks at most ``1 - similarity`` of the item's weight, and these weigh more.
    """
    listed = weighted.groupBy("item").agg(
        F.sort_array(F.collect_list(F.struct("weight", "shingle")), asc=False).alias("all"), F.sum("weight").alias("total"))
    spare = F.col("total") * (1 - similarity) + 1e-9
    start = F.struct(F.lit(0.0).alias("before"), F.lit(0).alias("n"))
    taken = F.aggregate("all", start, lambda out, s: F.struct(
        (out["before"] + s["weight"]).alias("before"), (out["n"] + F.when(out["before"] <= spare, 1).otherwise(0)).alias("n")))
    return listed.select("item", F.explode(F.slice("all", 1, taken["n"])).alias("s")).select("item", "s.shingle")


def candidate_windows(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``doc_id, text_hash, start, size``: item-sized windows that share an aligned shingle with the benchmark.

    At the end of a text, where windows run short, they may begin at a shared shingle too: what
    stands before it need not count against the passage.
    """
    anchors = items.select(F.size("words").alias("size"), F.posexplode(shingle_hashes(F.col("words"))).alias("at", "shingle")).distinct()
    shingles = let(word_list(text_column()), lambda words: F.transform(
        shingle_hashes(words), lambda h: F.struct(h.alias("shingle"), F.size(words).alias("n_words"))))
    places = docs.select("doc_id", F.xxhash64(text_column()).alias("text_hash"), F.posexplode(shingles).alias("place", "s"))
    places = places.select("doc_id", "text_hash", "place", "s.*")
    hits = places.join(anchors, "shingle")
    aligned = F.greatest(F.col("place") - F.col("at"), F.lit(0))
    short = F.col("place") + F.col("size") > F.col("n_words")
    starts = F.explode(F.when(short, F.array(aligned, F.col("place"))).otherwise(F.array(aligned)))
    return hits.select("doc_id", "text_hash", starts.alias("start"), "size").distinct()


def contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """``doc_id, text_hash, item_id, start_word, similarity``: the best window of each leaked item.

    A document holds an item if a window of as many words as the item reaches ``similarity`` in
    five-word shingles, weighted by how few items have them.  Rows of one id and text give one
    answer; null texts are empty and empty texts clean; items of fewer than five words are too
    general and match nothing.  Ties go to the earliest window.  Clean documents have no row.
    """
    items = staged(benchmark_items(benchmark), "benchmark-items")
    windows = staged(candidate_windows(docs, items), "leak-windows")
    texts = docs.select("doc_id", text_column().alias("text")).withColumn("text_hash", F.xxhash64("text"))
    w = windows.select(F.col("doc_id").alias("w_doc_id"), F.col("text_hash").alias("w_hash"), "start", "size")
    found = texts.join(w, (F.col("text_hash") == F.col("w_hash")) & F.col("doc_id").eqNullSafe(F.col("w_doc_id")))
    cut = F.slice(word_list(F.col("text")), F.col("start") + 1, F.col("size"))
    passages = found.select("doc_id", "text_hash", "start", "size", F.array_join(cut, " ").alias("passage")).distinct()
    passages = staged(passages.withColumn("window", F.md5(F.concat_ws(" ", "size", "passage"))), "leak-passages")
    distinct = passages.groupBy("window").agg(F.first("passage").alias("passage"), F.first("size").alias("size"))
    distinct = distinct.select("window", "size", F.split("passage", " ").alias("words")).filter(F.size("words") >= SHINGLE)

    ours = staged(distinct.withColumn("print", simhash(F.col("words"))), "leak-prints")
    theirs = staged(items.select("*", F.size("words").alias("size"), simhash(F.col("words")).alias("print")), "item-prints")
    our_blocks = ours.select("window", "size", F.col("print").alias("a"), F.inline(bit_blocks(F.col("print"), radius)))
    their_blocks = theirs.select("item", "size", F.col("print").alias("b"), F.inline(bit_blocks(F.col("print"), radius)))
    near = our_blocks.join(their_blocks, ["block", "bits", "size"]).filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)

    n_items = theirs.count()
    item_shingles = theirs.select("item", F.explode(shingle_list(F.col("words"))).alias("shingle"))
    weights = item_shingles.groupBy("shingle").agg(F.log1p(n_items / F.count("*")).alias("weight"))
    window_shingles = ours.select("window", F.explode(shingle_list(F.col("words"))).alias("shingle")).join(weights, "shingle", "left")
    window_shingles = window_shingles.withColumn("weight", F.coalesce("weight", F.log1p(F.lit(float(n_items)))))
    anchored = heaviest(item_shingles.join(weights, "shingle"), similarity).join(theirs.select("item", "size"), "item")
    anchored = window_shingles.join(ours.select("window", "size"), "window").join(anchored, ["shingle", "size"])
    pairs = near.select("window", "item").unionByName(anchored.select("window", "item")).distinct()
    window_sums = window_shingles.groupBy("window").agg(F.sum("weight").alias("window_weight"))
    item_sums = item_shingles.join(weights, "shingle").groupBy("item").agg(F.sum("weight").alias("item_weight"))
    shared = pairs.join(window_shingles, "window").join(item_shingles, ["item", "shingle"])
    shared = shared.groupBy("window", "item").agg(F.sum("weight").alias("shared"))
    rated = shared.join(window_sums, "window").join(item_sums, "item")
    rated = rated.withColumn("similarity", F.col("shared") / (F.col("window_weight") + F.col("item_weight") - F.col("shared")))
    leaks = rated.filter(F.col("similarity") >= similarity).join(theirs.select("item", "item_id"), "item").select("window", "item_id", "similarity")

    best = passages.join(leaks, "window").groupBy("doc_id", "text_hash", "item_id").agg(
        F.max(F.struct("similarity", (-F.col("start")).alias("neg"))).alias("best"))
    return best.select("doc_id", "text_hash", "item_id", (-F.col("best.neg")).cast("long").alias("start_word"), F.col("best.similarity").alias("similarity"))


def decontaminated(docs: DataFrame, benchmark: DataFrame, **terms) -> DataFrame:
    """The rows of ``docs`` in which no benchmark item was found, with all their columns."""
    leaks = staged(contaminated(docs, benchmark, **terms).select(F.col("doc_id").alias("leak_doc_id"), F.col("text_hash").alias("leak_hash")).distinct(), "leaks")
    same = (F.xxhash64(text_column()) == F.col("leak_hash")) & docs["doc_id"].eqNullSafe(F.col("leak_doc_id"))
    return docs.join(leaks, same, "left_anti")
