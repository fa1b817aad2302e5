"""Words within one edit of each other, and the frequent word each rare one is a variant of.

Of two words one edit apart, the shorter (of equal ones the smaller) contributes two disjoint
chunks, its halves; the other contributes its positional grams.  One edit leaves a chunk whole,
and the gram that equals it stands at the chunk's place, or one further behind an insertion;
grams elsewhere cannot meet a chunk, so only these are made.  What is left beside the whole chunk
is again within one edit, so its own halves are taken in the same way: a key is a chunk and half
of the rest, three quarters of a word, and words with a common beginning or ending do not share
one key.  Pairs that meet are verified by their distance inside the join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import let, staged

# Fixed values of the grouping: letters, the rate and place of deletions, least length and
# count of a word, and how much more frequent a form is.
RUN = r"[a-zÀ-ÿ]"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DELETE_EVERY = 199
LEAST_LENGTH = 6
LEAST_COUNT = 5
TIMES = 5


def word_counts(docs: DataFrame) -> DataFrame:
    """``word, n`` of all words that occur often enough, over whole texts.

    Only runs of the least length are taken out, as a deletion makes none longer.  Counts are
    partial per task before they are shuffled.
    """
    low = F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), CAPITALS, SMALL)
    runs = docs.select(
        F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":")).alias("head"),
        F.explode(F.regexp_extract_all(low, F.lit(f"({RUN}{{{LEAST_LENGTH},}})"), F.lit(1))).alias("run"),
    )
    hashed = runs.select("run", F.crc32(F.concat("head", "run")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = hashed.select(F.when(F.col("h") % DELETE_EVERY == 0, shorter).otherwise(F.col("run")).alias("word"))
    counted = words.filter(F.length("word") >= LEAST_LENGTH).groupBy("word").agg(F.count("*").alias("n"))
    return counted.filter(F.col("n") >= LEAST_COUNT)


def part(word: Column, start, length) -> Column:
    """Code points of a word from ``start``, counted from 0."""
    return F.substring(word, F.lit(1) + start, length)


def keys(word: Column, length: Column, shift: Column) -> Column:
    """Keys that a word shares with a chunk word of ``length`` code points, one edit away.

    ``shift`` is 0 for the chunk word itself and for words of its length, 1 for longer ones.  The
    four keys stand for an edit in the last, third, second and first quarter; whatever lies
    behind the edit is shifted.  Keys are hashes; the words that share one by chance are told
    apart by their distance.
    """
    half = F.floor(length / 2).cast("int")
    quarter, third = F.floor(half / 2).cast("int"), (half + F.floor((length - half) / 2)).cast("int")
    first, second = part(word, F.lit(0), half), part(word, half + shift, length - half)
    pieces = [
        (first, part(word, half, third - half)),
        (first, part(word, third + shift, length - third)),
        (second, part(word, F.lit(0), quarter)),
        (second, part(word, quarter + shift, half - quarter)),
    ]
    return F.array(*[F.xxhash64(F.lit(i), length, chunk, rest) for i, (chunk, rest) in enumerate(pieces)])


def near_pairs(words: DataFrame) -> DataFrame:
    """``a, a_n, b, b_n``: every two of ``words(word, n)`` at distance one, once, ``a`` the chunk word.

    The words are few beside the texts they come from; a key is shared by words that agree in
    three quarters of their letters.
    """
    size = F.length("word")
    chunks = words.select(
        F.col("word").alias("a"), F.col("n").alias("a_n"), size.alias("a_size"),
        F.explode(keys(F.col("word"), size, F.lit(0))).alias("key"))
    grams = words.select(
        F.col("word").alias("b"), F.col("n").alias("b_n"), size.alias("b_size"),
        F.explode(F.concat(keys(F.col("word"), size, F.lit(0)), keys(F.col("word"), size - 1, F.lit(1)))).alias("key"))
    ordered = (F.col("a_size") < F.col("b_size")) | (F.col("a") < F.col("b"))
    met = chunks.join(grams, (chunks["key"] == grams["key"]) & (F.abs(F.col("a_size") - F.col("b_size")) <= 1)
                      & ordered & (F.levenshtein("a", "b", 1) == 1))
    return met.select("a", "a_n", "b", "b_n").distinct()


def forms(words: DataFrame) -> DataFrame:
    """``word, n, n_near, form, form_n`` of every row of ``words(word, n)``.

    The form is the most frequent near word, the first in code point order of equal ones, if it
    is at least :data:`TIMES` as frequent as the word.
    """
    pairs = staged(near_pairs(words), "near-words")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("b_n").alias("other_n")).union(
        pairs.select("b", "a", "a_n"))
    best = both.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
    joined = words.join(best, "word", "left")
    known = -F.col("best.less") >= TIMES * F.col("n")
    return joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(known, F.col("best.other")).alias("form"), F.when(known, -F.col("best.less")).alias("form_n"))


def roots(links: DataFrame) -> DataFrame:
    """``word, root`` of ``links(word, form)``: the last form that forms lead to.

    Counts grow :data:`TIMES`-fold along a chain, so it is short and without a loop; each round
    doubles how far a row looks ahead, and rounds end when no root has a form.
    """
    current = staged(links.select("word", F.col("form").alias("root")), "word-roots")
    for _ in range(8):
        ahead = current.select(F.col("word").alias("root"), F.col("root").alias("next"))
        stepped = current.join(ahead, "root", "left")
        after = staged(stepped.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "word-roots")
        current = after.select("word", "root")
        if after.filter("moved").isEmpty():
            return current
    raise RuntimeError("a chain of forms is longer than counts allow")


def op12(docs: DataFrame) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of the documents.

    Null and empty texts have no words; a null id counts as empty text in the hash of a run.
    Repeated rows count each.  Without words there are no rows.
    """
    words = staged(word_counts(docs.select("doc_id", "text")), "word-counts")
    found = staged(forms(words), "word-forms")
    ends = roots(found.filter("form is not null").select("word", "form"))
    return found.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


OP12_SQL = r"""
with recursive table_steps(k, i, c) as (
  select 0, i::ubigint, i::ubigint from range(256) r(i)
  union all
  select k + 1, i, case when c & 1 = 1 then xor(c >> 1, 3988292384::ubigint) else c >> 1 end from table_steps where k < 8),
crc_table as (select list(c order by i) as t from table_steps where k = 8),
runs as (
  select doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz') as run from documents),
counted as (
  select run, hex(encode(concat(doc_id, ':', run))) as x, count(*) as n from runs where length(run) >= 6 group by doc_id, run),
hashed as (
  select run, n, xor(4294967295::ubigint, list_reduce(
    list_transform(range(0, len(x), 2), lambda p: ('0x' || substr(x, (p + 1)::int, 2))::ubigint),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255)::int + 1]), 4294967295::ubigint)) as h
  from counted, crc_table),
results as (
  select n, case when h % 199 = 0 then concat(substr(run, 1, (h % length(run))::int), substr(run, (h % length(run))::int + 2))
    else run end as word from hashed),
words as (select word, sum(n)::bigint as n from results where length(word) >= 6 group by word having sum(n) >= 5),
holes as (
  select word, n, i, concat(substr(word, 1, i - 1), substr(word, i + 1)) as rest
  from (select word, n, unnest(range(1, length(word) + 1))::int as i from words)),
pairs as (
  select a.word as word, b.word as other, b.n as other_n from holes a join holes b on a.rest = b.rest and a.i = b.i and a.word <> b.word
  union select h.word, w.word, w.n from holes h join words w on h.rest = w.word
  union select w.word, h.word, h.n from holes h join words w on h.rest = w.word),
best as (
  select word, count(*) as n_near, arg_min(other, (-other_n, other)) as other, max(other_n) as other_n from pairs group by word),
formed as (
  select w.word, w.n, coalesce(n_near, 0)::bigint as n_near, case when other_n >= 5 * w.n then other end as form,
    case when other_n >= 5 * w.n then other_n end as form_n
  from words w left join best b on w.word = b.word),
chains(word, last, depth) as (
  select word, word, 0 from formed
  union all
  select c.word, f.form, depth + 1 from chains c join formed f on c.last = f.word where f.form is not null)
select f.word, f.form, r.root, f.n, f.n_near, f.form_n
from formed f join (select word, arg_max(last, depth) as root from chains group by word) r on f.word = r.word
"""
