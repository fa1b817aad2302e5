"""Similarity join of texts by the Jaccard similarity of their word shingles, by chosen paths.

Texts that are equal are one set.  A set is known by its MinHash tokens.  In every run the sets
are split recursively: a node samples ``BRANCH`` of the tokens, and sets that share a sampled one
go on together.  Small buckets are compared by brute force, and so are buckets that splitting
hardly shrinks, whose sets are nearly all alike.  Runs are repeated until a pair at the similarity
is missed with a probability under one in ten million.  What meets becomes groups; within each
group every pair is verified on the texts themselves, so that no link depends on the estimate.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import U64, WORD, joined, mixed, pieces, shingle_hashes, sorted_groups, staged, text_column
from .components import components

SHINGLE = 5
SIMILARITY = 0.8
#: MinHash tokens of a set, and their bytes: enough that different sets rarely share one by chance.
TOKENS = 128
TOKEN_BYTES = 4
#: Runs, and sampled tokens per node: a run misses a pair at 0.8 with probability 0.0625 at most
#: (the fixed point of q = (0.2 + 0.8 q)^2), seven runs with 0.0625^7 < 1e-8.
RUNS = 7
BRANCH = 2
#: Buckets up to this size are compared; larger ones are split while that halves them at least.
BUCKET = 512
DEPTH = 16
#: Share of equal tokens from which sets are grouped for verification; for a pair at 0.8 it is
#: five standard deviations below the mean.
ESTIMATE = 0.62
#: Text bytes of the two sides of a verification task.
TILE_BYTES = 2 << 20  # and at most BUCKET texts a side
#: So many members, at some 100 bytes each, are sent to where the texts are; beyond, the texts are shuffled to them.
SENT_MEMBERS = 250_000


def signatures(texts: pa.Array) -> list[bytes | None]:
    """MinHash tokens of every text, None for one without words."""
    buffer, offsets = joined(texts)
    hashes, counts = shingle_hashes(buffer, offsets, SHINGLE)
    some = np.flatnonzero(counts)
    at = (np.cumsum(counts) - counts)[some]
    out = np.zeros((len(some), TOKENS), dtype=np.uint32)
    factors = mixed(np.arange(1, TOKENS + 1, dtype=U64) * U64(0x9E3779B97F4A7C15)) | U64(1)
    if len(some):
        # stretches of shingles that stay in the processor's cache, cut between texts
        cuts = np.unique(np.searchsorted(at, np.arange(0, len(hashes), 1 << 15)))
        cuts = np.unique(np.concatenate([[0], cuts, [len(at)]]))
        for a, b in zip(cuts[:-1], cuts[1:]):
            stop = at[b] if b < len(at) else len(hashes)
            part, inner = hashes[at[a] : stop], at[a:b] - at[a]
            for k, factor in enumerate(factors):
                out[a:b, k] = (np.minimum.reduceat(part * factor, inner) >> U64(16)).astype(np.uint32)
    rows: list[bytes | None] = [None] * len(texts)
    for i, row in zip(some, out):
        rows[i] = row.tobytes()
    return rows


def distinct_texts(docs: DataFrame) -> DataFrame:
    """``set, text_key, rep_id, copies, bytes, tokens``: one row per different text, written once.

    ``rep_id`` is the least id among the copies, ``tokens`` is null for texts without words.
    """

    def hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 4 << 20):
            rows = pa.array(signatures(batch.column("text")), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("text_key"), batch.column("doc_id"), batch.column("bytes"), rows], ["text_key", "doc_id", "bytes", "tokens"])

    texts = docs.select(F.md5(text_column()).alias("text_key"), F.col("doc_id").cast("long").alias("doc_id"),
                        F.octet_length(text_column()).cast("long").alias("bytes"), text_column().alias("text"))
    rows = texts.mapInArrow(hashed, "text_key string, doc_id bigint, bytes bigint, tokens binary")
    sets = rows.groupBy("text_key").agg(
        F.min("doc_id").alias("rep_id"), F.count("*").alias("copies"), F.max("bytes").alias("bytes"), F.max("tokens").alias("tokens"))
    return staged(sets.withColumn("set", F.monotonically_increasing_id()), "sets")


def _sampled(bucket: Column) -> Column:
    """Positions of the tokens that a node samples, from its path alone."""
    return F.array_distinct(F.array(*[F.pmod(F.xxhash64(bucket, F.lit(i)), F.lit(TOKENS)).cast("int") for i in range(BRANCH)]))


def _split(rows: DataFrame) -> DataFrame:
    """Children ``set, bucket, parent_size`` of rows ``set, bucket, size, tokens``."""
    drawn = rows.select("set", "bucket", F.col("size").alias("parent_size"), "tokens", F.explode(_sampled(F.col("bucket"))).alias("at"))
    value = F.substring("tokens", (F.col("at") * TOKEN_BYTES + 1).cast("int"), F.lit(TOKEN_BYTES))
    return drawn.select("set", F.xxhash64("bucket", "at", value).alias("bucket"), "parent_size")


def buckets(sets: DataFrame, labels: DataFrame | None, runs: range) -> DataFrame:
    """``set, bucket, size`` of all buckets to compare, from all levels of the given runs.

    A bucket whose sets are all in one group of ``labels`` has nothing more to find.
    """
    tokens = sets.filter("tokens is not null").select("set", "tokens")
    label = tokens.select("set")
    label = label.withColumn("label", F.col("set")) if labels is None else label.join(
        labels.withColumnRenamed("vertex", "set"), "set", "left").select("set", F.coalesce("component", "set").alias("label"))
    label = staged(label, "labels")
    roots = tokens.select("set", "tokens", F.explode(F.array(*[F.lit(-1 - r).cast("long") for r in runs])).alias("bucket"))
    level = staged(_split(roots.withColumn("size", F.lit(1 << 62))), "paths")
    ready = []
    for depth in range(DEPTH):
        sizes = level.join(label, "set").groupBy("bucket").agg(
            F.count("*").alias("size"), F.max("parent_size").alias("parent_size"), F.min("label").alias("low"), F.max("label").alias("high"))
        sizes = sizes.filter("size > 1 and low < high").select(
            "bucket", "size", (F.lit(depth == DEPTH - 1) | (F.col("size") <= BUCKET) | (F.col("size") * 2 > F.col("parent_size"))).alias("compared"))
        sized = staged(level.select("set", "bucket").join(sizes, "bucket"), "buckets")
        ready.append(sized.filter("compared").select("set", "bucket", "size"))
        larger = sized.filter("not compared")
        if larger.isEmpty():
            break
        level = staged(_split(larger.join(tokens, "set")), "paths")
    out = ready[0]
    for more in ready[1:]:
        out = out.union(more)
    return out


def tiled(rows: DataFrame, tiles: Column, member: str) -> DataFrame:
    """Rows dealt to pairs of tiles ``low <= high`` of their group, so that every two rows meet once.

    A row goes to as many tasks as its group has ``tiles``; ``tile`` says which side it is on.
    """
    dealt = rows.withColumn("tiles", tiles.cast("int")).withColumn("tile", F.pmod(F.xxhash64(F.lit(77), member), "tiles").cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    return dealt.withColumn("low", F.least("tile", "other")).withColumn("high", F.greatest("tile", "other")).drop("other", "tiles")


def forest(near: np.ndarray) -> np.ndarray:
    """Least index of every row's component in a symmetric boolean matrix."""
    label = np.arange(len(near))
    while True:
        moved = np.minimum(label, np.where(near, label[None, :], len(near)).min(axis=1, initial=len(near)))
        moved = moved[moved]
        if (moved == label).all():
            return label
        label = moved


def allowed_pairs(tile: np.ndarray, low: int, high: int) -> np.ndarray:
    """Pairs that this task is to compare: across the two tiles, or all of a single one."""
    if low == high:
        out = np.ones((len(tile), len(tile)), dtype=bool)
    else:
        out = tile[:, None] != tile[None, :]
    np.fill_diagonal(out, False)
    return out


def near_edges(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """``a, b``: a spanning forest of the pairs of each bucket whose tokens agree often enough."""
    dealt = tiled(rows, F.ceil(F.col("size") / BUCKET), "set").join(sets.select("set", "tokens"), "set")
    dealt = dealt.select("bucket", "low", "high", "tile", "set", "tokens").repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high")

    def compared(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = [], []
        for group in sorted_groups(batches, ["bucket", "low", "high"]):
            n = group.num_rows
            if n < 2:
                continue
            ids = group.column("set").to_numpy()
            tokens = np.frombuffer(b"".join(group.column("tokens").to_pylist()), dtype=np.uint32).reshape(n, TOKENS)
            if n == 2:
                if (tokens[0] == tokens[1]).sum() >= ESTIMATE * TOKENS:
                    a.append(ids[1:])
                    b.append(ids[:1])
                continue
            near = np.zeros((n, n), dtype=bool)
            for i in range(0, n, 32):
                near[i : i + 32] = (tokens[i : i + 32, None, :] == tokens[None, :, :]).sum(axis=2, dtype=np.uint8) >= ESTIMATE * TOKENS
            tile = group.column("tile").to_numpy()
            root = forest(near & allowed_pairs(tile, group.column("low")[0].as_py(), group.column("high")[0].as_py()))
            moved = np.flatnonzero(root != np.arange(n))
            a.append(ids[moved])
            b.append(ids[root[moved]])
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])

    return dealt.mapInArrow(compared, "a bigint, b bigint").distinct()


def candidate_groups(sets: DataFrame) -> DataFrame:
    """``vertex, component``: groups outside which no pair reaches the similarity.

    A first run groups what is nearly alike; the others compare only buckets that hold sets of
    more than one group.
    """
    first = staged(near_edges(buckets(sets, None, range(1)), sets), "near-first")
    groups = components(first)
    rest = staged(near_edges(buckets(sets, groups, range(1, RUNS)), sets), "near-rest")
    return components(first.union(rest))


def exact_links(texts: list[bytes], copies: np.ndarray, pairs: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Number of linked copies of each text, and the root of its component, over the given pairs."""
    buffer, offsets = joined(pa.array(texts, pa.large_binary()))
    hashes, counts = shingle_hashes(buffer, offsets, SHINGLE)
    n = len(texts)
    owner = np.repeat(np.arange(n), counts)
    order = np.lexsort((owner, hashes))
    hashes, owner = hashes[order], owner[order]
    fresh = np.ones(len(hashes), dtype=bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    hashes, owner = hashes[fresh], owner[fresh]
    sizes = np.bincount(owner, minlength=n)
    starts = np.ones(len(hashes), dtype=bool)
    starts[1:] = hashes[1:] != hashes[:-1]
    column = np.cumsum(starts) - 1
    shared = np.bincount(column)[column] > 1 if len(column) else np.zeros(0, dtype=bool)
    owner, column = owner[shared], np.unique(column[shared], return_inverse=True)[1]
    common = np.zeros((n, n), dtype=np.float32)
    columns = int(column[-1]) + 1 if len(column) else 0
    width = max(1, min(columns, (4 << 20) // n))
    cuts = np.searchsorted(column, np.arange(0, columns + width, width))
    for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
        if a < b:
            part = np.zeros((n, width), dtype=np.float32)
            part[owner[a:b], column[a:b] - k * width] = 1
            common += part @ part.T
    union = sizes[:, None] + sizes[None, :] - common
    linked = pairs & (common >= similarity * union - 1e-6) & (union > 0)
    return linked.astype(np.int64) @ copies, forest(linked)


def similarity_join(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``text_key, rep_id, copies, class_id, class_key, n_links``: one row per different text.

    Two documents are linked if the Jaccard similarity of their sets of five-word shingles
    (lower-cased A-Z; all words where there are fewer) is ``similarity`` or more.  Classes are the
    connected components of the links; ``class_id`` is the least id in the class, ``class_key``
    the text that holds it.  ``n_links`` counts the linked documents of one document with this
    text, copies included.  A null text is empty; texts without words have no links and are each
    a class by their text, with their own least id.  Ids need not be unique; a class of null ids
    has a null id.
    """
    sets = distinct_texts(docs)
    groups = candidate_groups(sets)
    members = groups.withColumnRenamed("vertex", "set").join(sets.drop("tokens"), "set")
    tiles = F.greatest(F.ceil(F.sum("bytes") / TILE_BYTES), F.ceil(F.count("*") / BUCKET))
    members = staged(members.join(members.groupBy("component").agg(tiles.alias("tiles")), "component"), "members")
    wanted = members.select("text_key", F.col("rep_id").alias("wanted_id"), "component", "tiles", "set", "copies")
    wanted = F.broadcast(wanted) if wanted.count() <= SENT_MEMBERS else wanted
    texts = docs.select(F.md5(text_column()).alias("text_key"), F.col("doc_id").cast("long").alias("doc_id"), text_column().alias("text"))
    found = texts.join(wanted, (texts["text_key"] == wanted["text_key"]) & texts["doc_id"].eqNullSafe(wanted["wanted_id"]))
    found = found.select("component", "tiles", "set", "copies", F.col("text").cast("binary").alias("text"))
    dealt = tiled(found, F.col("tiles"), "set")
    dealt = dealt.select("component", "low", "high", "tile", "set", "copies", "text")
    dealt = dealt.repartition("component", "low", "high").sortWithinPartitions("component", "low", "high", "set")

    def verified(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, ["component", "low", "high"]):
            ids, first = np.unique(group.column("set").to_numpy(), return_index=True)  # repeated rows of one id
            group = group.take(pa.array(first))
            copies = group.column("copies").to_numpy()
            pairs = allowed_pairs(group.column("tile").to_numpy(), group.column("low")[0].as_py(), group.column("high")[0].as_py())
            links, root = exact_links(group.column("text").to_pylist(), copies, pairs, similarity)
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(links), pa.array(ids[root])], ["set", "links", "root"])

    checked = staged(dealt.mapInArrow(verified, "set bigint, links bigint, root bigint"), "links")
    classes = components(checked.select(F.col("set").alias("a"), F.col("root").alias("b")))
    links = checked.groupBy("set").agg(F.sum("links").alias("links"))
    rows = sets.withColumn("has_words", F.col("tokens").isNotNull()).drop("tokens", "bytes").join(links, "set", "left").join(classes.withColumnRenamed("vertex", "set"), "set", "left")
    rows = rows.withColumn("component", F.coalesce("component", "set"))
    least = F.struct(F.col("rep_id").isNull().alias("none"), F.col("rep_id"), F.col("text_key"))
    heads = rows.groupBy("component").agg(F.min(least).alias("head"))
    rows = rows.join(heads, "component")
    n_links = F.when(F.col("has_words"), F.coalesce("links", F.lit(0)) + F.col("copies") - 1).otherwise(F.lit(0))
    return rows.select("text_key", "rep_id", "copies", F.col("head.rep_id").alias("class_id"), F.col("head.text_key").alias("class_key"),
                       "has_words", n_links.cast("long").alias("n_links"))


def op8(docs: DataFrame) -> DataFrame:
    """``doc_id, class_id, n_links`` of every row; a text without words is a class by itself."""
    classes = staged(similarity_join(docs), "classes")
    keyed = docs.select("doc_id", F.md5(text_column()).alias("text_key"))
    out = keyed.join(classes, "text_key")
    own = F.when(F.col("has_words"), F.col("class_id")).otherwise(F.col("doc_id").cast("long"))
    return out.select("doc_id", own.alias("class_id"), "n_links")


def one_of_each_class(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with one row of every class, the one of least id, with all columns.

    Rows without words are classes by themselves and all stay.  Where several rows share the
    class's least id and text, one of them stays.
    """
    classes = staged(similarity_join(docs, similarity).filter("has_words"), "classes")
    heads = classes.filter("text_key = class_key").select(F.col("text_key").alias("nd_key"), F.col("rep_id").alias("nd_id"))
    key, number = F.md5(text_column()), F.col("doc_id").cast("long")
    rows = docs.select(key.alias("same_key"), number.alias("same_id")).groupBy("same_key", "same_id").agg(F.count("*").alias("nd_alike"))
    rows = rows.filter("nd_alike > 1")
    repeated = heads.join(rows, (F.col("nd_key") == F.col("same_key")) & F.col("nd_id").eqNullSafe(F.col("same_id")), "left")
    heads = staged(repeated.select("nd_key", "nd_id", F.coalesce("nd_alike", F.lit(1)).alias("nd_alike")), "heads")
    tagged = docs.join(heads, (key == F.col("nd_key")) & docs["doc_id"].cast("long").eqNullSafe(F.col("nd_id")), "left")
    wordless = ~text_column().rlike(WORD)
    own = [docs[f"`{c}`"] for c in docs.columns]
    single = tagged.filter(wordless | (F.col("nd_alike") == 1)).select(*own)
    # rows that share id and text are rare: their heads stand in a table of their own, so that the texts move once
    often = staged(heads.filter("nd_alike > 1").select(F.col("nd_key").alias("of_key"), F.col("nd_id").alias("of_id")), "heads-often")
    if often.isEmpty():
        return single
    again = docs.join(often, (key == F.col("of_key")) & docs["doc_id"].cast("long").eqNullSafe(F.col("of_id")))
    again = again.filter(~wordless).dropDuplicates(["of_key", "of_id"]).select(*own)
    return single.unionByName(again)
