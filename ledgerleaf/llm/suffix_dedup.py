"""Long repeats across a corpus, found by a logarithmic family of sampled suffix arrays.

Suffixes are sampled where the text itself says so: every window of ``WINDOW`` bytes is anchored
at its least-hashed run of ``GRAM`` bytes, so equal windows are anchored at equal places, and about
one position in seventy is an anchor.  An anchor's context, the bytes that any of its windows can
cover, decides all of them.  Copies of a context are counted before anything is shuffled far; each
different context of a repeated anchor goes once to the index of its part.  There, every batch of
contexts gets a suffix array, is merge-scanned against the arrays of the existing levels for long
matches, and levels of equal size are merged.  Where contexts match in part only, their windows
are compared one by one, so the removed bytes are exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import U64, id_type, joined, mixed, pack, pieces, staged, text_column, unpack

WINDOW = 200
GRAM = 64
#: An anchor lies at most so many bytes after the start of its window.
REACH = WINDOW - GRAM
CONTEXT = REACH + WINDOW
#: Text bytes of a block, of a part of the anchors, and window starts handled at a time.
BLOCK_BYTES = 4 << 20
PART_BYTES = 40 << 20
STRETCH = 1 << 20
#: Contexts whose windows are compared at a time.
COMPARED = 16384

BYTE_HASH = mixed(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))
FACTORS = mixed(np.arange(301, 307, dtype=U64) * U64(0xD1342543DE82EF95)) | U64(1)
CONTEXT_FACTORS = mixed(np.arange(401, 401 + CONTEXT // 8, dtype=U64) * U64(0x9E3779B97F4A7C15)) | U64(1)


# ---- anchors -----------------------------------------------------------------------------


def gram_hashes(buffer: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from every position that has so many, by doubling."""
    h, size = BYTE_HASH[buffer], 1
    for factor in FACTORS:
        h = h[:-size] * factor + h[size:] if len(h) > size else h[:0]
        h ^= h >> U64(29)
        size *= 2
    return h


def anchors(buffer: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor positions, first and last start of the windows each anchors, and gram hashes.

    Windows do not cross texts.  Among equal hashes the leftmost anchors a window.
    """
    out: list[tuple[np.ndarray, ...]] = []
    n_starts = len(buffer) - WINDOW + 1
    change = np.zeros(max(n_starts, 0) + 1, dtype=np.int8)
    first, last = offsets[:-1], offsets[1:] - WINDOW
    fits = last >= first
    if n_starts <= 0 or not fits.any():
        none = np.zeros(0, dtype=np.int64)
        return none, none, none, none.astype(U64)
    np.add.at(change, first[fits], 1)
    np.add.at(change, last[fits] + 1, -1)
    inside = np.cumsum(change[:-1], dtype=np.int8) > 0
    for base in range(0, n_starts, STRETCH):
        stop = min(base + STRETCH, n_starts)
        hashes = gram_hashes(buffer[base : stop + WINDOW - 1])
        # the upper bits order the grams, the lower ones say where, so a minimum is a place
        key = (hashes & ~U64((1 << 24) - 1)) | np.arange(len(hashes), dtype=U64)
        size = 1
        while size * 2 <= REACH + 1:
            key = np.minimum(key[:-size], key[size:])
            size *= 2
        rest = REACH + 1 - size
        key = np.minimum(key[: stop - base], key[rest : rest + stop - base])
        starts = np.flatnonzero(inside[base:stop])
        at = (key[starts] & U64((1 << 24) - 1)).astype(np.int64)
        if not len(at):
            continue
        fresh = np.ones(len(at), dtype=bool)
        fresh[1:] = at[1:] != at[:-1]
        heads = np.flatnonzero(fresh)
        tails = np.append(heads[1:], len(at)) - 1
        out.append((at[heads] + base, starts[heads] + base, starts[tails] + base, hashes[at[heads]]))
    where, low, high, grams = (np.concatenate(c) for c in zip(*out))
    # an anchor whose windows lie on both sides of a stretch's end is one anchor
    fresh = np.ones(len(where), dtype=bool)
    fresh[1:] = where[1:] != where[:-1]
    heads = np.flatnonzero(fresh)
    return where[heads], low[heads], high[np.append(heads[1:], len(where)) - 1], grams[heads]


def contexts(buffer: np.ndarray, offsets: np.ndarray, where: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes around every anchor, zero beyond its text, and how many lie left and right of it."""
    text = np.searchsorted(offsets, where, side="right") - 1
    left = np.minimum(where - offsets[text], REACH)
    right = np.minimum(offsets[text + 1] - where, WINDOW)
    padded = np.zeros(len(buffer) + CONTEXT, dtype=np.uint8)
    padded[REACH : REACH + len(buffer)] = buffer
    rows = np.lib.stride_tricks.sliding_window_view(padded, CONTEXT)[where]
    place = np.arange(CONTEXT)
    cut = np.flatnonzero((left < REACH) | (right < WINDOW))
    rows[cut] *= (place >= REACH - left[cut, None]) & (place < REACH + right[cut, None])
    return rows, left, right


def context_hashes(rows: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(rows), dtype=U64)
    for a in range(0, len(rows), 8192):
        part = np.ascontiguousarray(rows[a : a + 8192]).view(U64)
        sums[a : a + 8192] = (mixed(part ^ CONTEXT_FACTORS) * CONTEXT_FACTORS).sum(axis=1, dtype=U64)
    return mixed(sums + left.astype(U64) * U64(1 << 20) + right.astype(U64))


# ---- the index of one part ---------------------------------------------------------------


class SuffixIndex:
    """Levels of sorted contexts, each at least twice as large as the next.

    A context is ordered by the text from its anchor on, then by the text before it read
    backwards: a suffix array of the anchors, bounded to what their windows can cover.
    """

    def __init__(self):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []  # sorted keys, rows of the contexts
        self.met: list[np.ndarray] = []  # rows that share their first GRAM bytes with another

    @staticmethod
    def keys(rows: np.ndarray) -> np.ndarray:
        turned = np.concatenate([rows[:, REACH:], rows[:, :REACH][:, ::-1]], axis=1)
        return np.ascontiguousarray(turned).view(f"S{CONTEXT}").reshape(-1)

    @staticmethod
    def heads(keys: np.ndarray) -> np.ndarray:
        return keys.astype(f"S{GRAM}")

    def add(self, keys: np.ndarray, rows: np.ndarray) -> None:
        """Index a batch: sort it, scan it against every level, merge levels of like size."""
        order = np.argsort(keys, kind="stable")
        keys, rows = keys[order], rows[order]
        own = self.heads(keys)
        twin = np.flatnonzero(own[1:] == own[:-1])
        self.met += [rows[twin], rows[twin + 1]]
        for other, other_rows in self.levels:
            place = np.searchsorted(other, keys)
            for shift in (-1, 0):
                at = place + shift
                ok = np.flatnonzero((at >= 0) & (at < len(other)))
                ok = ok[self.heads(other[at[ok]]) == own[ok]]
                self.met += [rows[ok], other_rows[at[ok]]]
        while self.levels and len(self.levels[-1][0]) < 2 * len(keys):
            more, more_rows = self.levels.pop()
            both, both_rows = np.concatenate([more, keys]), np.concatenate([more_rows, rows])
            order = np.argsort(both, kind="stable")
            keys, rows = both[order], both_rows[order]
        self.levels.append((keys, rows))

    def matched(self) -> np.ndarray:
        """Rows with a match of GRAM bytes or more anywhere in the index."""
        return np.unique(np.concatenate(self.met)) if self.met else np.zeros(0, dtype=np.int64)


def repeated_offsets(rows: np.ndarray, group: np.ndarray, weight: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest offset of each context's own windows that stand elsewhere, else -1.

    A window at offset ``o`` begins ``o`` bytes before the anchor; a context's own windows are
    ``low..high``.  Contexts are compared within their ``group``, a context of ``weight`` 2 or
    more with itself.
    """
    n = len(rows)
    least, most = np.full(n, -1, dtype=np.int64), np.full(n, -1, dtype=np.int64)
    base = 0x9E3779B97F4A7C15
    far = U64(pow(base, WINDOW, 1 << 64))
    salt = mixed(group.astype(U64) + U64(1))
    band = max(1, min(REACH + 1, (COMPARED * (REACH + 1)) // max(n, 1)))
    for begin in range(0, REACH + 1, band):
        offsets = np.arange(begin, min(begin + band, REACH + 1))
        hashes = np.zeros((len(offsets), n), dtype=U64)
        for a in range(0, n, COMPARED):
            part = rows[a : a + COMPARED].T.astype(U64) + U64(1)
            prefix = np.zeros((CONTEXT + 1, part.shape[1]), dtype=U64)
            for j in range(CONTEXT):
                prefix[j + 1] = prefix[j] * U64(base) + part[j]
            for i, o in enumerate(offsets):
                begins = REACH - o
                hashes[i, a : a + COMPARED] = prefix[begins + WINDOW] - prefix[begins] * far
        for i, o in enumerate(offsets):
            own = np.flatnonzero((low <= o) & (o <= high))
            if not len(own):
                continue
            _, inverse = np.unique(mixed(hashes[i, own] + salt[own]), return_inverse=True)
            twice = own[np.bincount(inverse, weight[own])[inverse] >= 2]
            least[twice] = np.where(least[twice] < 0, o, least[twice])
            most[twice] = o
    return least, most


# ---- the operator ------------------------------------------------------------------------


def _removed_rows(ids: pa.Array, buffer: np.ndarray, offsets: np.ndarray, begin: np.ndarray, end: np.ndarray, texts: np.ndarray) -> pa.RecordBatch:
    """Result rows of some texts of a block, given the covered byte ranges of the block."""
    steps = np.zeros(len(buffer) + 1, dtype=np.int64)
    np.add.at(steps, begin, 1)
    np.add.at(steps, end, -1)
    gone = np.cumsum(steps[:-1]) > 0
    n_bytes, n_removed, n_spans, kept = [], [], [], []
    for t in texts:
        part, cut = buffer[offsets[t] : offsets[t + 1]], gone[offsets[t] : offsets[t + 1]]
        n_bytes.append(len(part))
        n_removed.append(int(cut.sum()))
        n_spans.append(int((cut[1:] & ~cut[:-1]).sum()) + int(len(cut) > 0 and cut[0]))
        kept.append(part.tobytes() if not n_removed[-1] else part[~cut].tobytes())
    return pa.RecordBatch.from_arrays(
        [ids.take(pa.array(texts)), pa.array(n_bytes, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(n_spans, pa.int64()),
         pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()), pa.array(kept, pa.binary())],
        ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def _text_body(buffer: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(buffer.tobytes())


def _text_of(body: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(body), dtype=np.uint8)


def without_repeats(docs: DataFrame, keep_text: bool = True) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256[, kept]`` for every row of ``docs(doc_id, text)``.

    Removed is every byte covered by a 200-byte string that starts anywhere else in the corpus,
    the same text included.  Texts are UTF-8 bytes, null is empty, matches never cross texts;
    strings are judged on the input.  Repeated rows are each other's copies.  ``kept`` (binary)
    are the remaining bytes.  Other columns are not read.
    """
    ids = id_type(docs)
    total = docs.select(F.sum(F.octet_length(text_column()))).first()[0] or 0
    parts = max(1, -(-total // PART_BYTES))
    packet = f"kind string, block bigint, part int, body binary, extra binary, ids array<{ids}>"
    names = ["kind", "block", "part", "body", "extra", "ids"]

    def packets(rows: list[tuple], id_kind: pa.DataType) -> pa.RecordBatch:
        kinds = [pa.string(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.list_(id_kind)]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    def cut_blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for piece in pieces(batches, BLOCK_BYTES):
            id_column = piece.column("doc_id")
            buffer, offsets = joined(piece.column("text"))
            where, low, high, grams = anchors(buffer, offsets)
            around = [context_hashes(*contexts(buffer, offsets, where[a : a + 65536])) for a in range(0, len(where), 65536)]
            hashes = np.concatenate(around) if around else np.zeros(0, dtype=U64)
            part = (grams % U64(parts)).astype(np.int32)
            steps = [np.diff(a, prepend=0).astype(np.int64) for a in (offsets, where, where - low, high - low)]
            rows = [("text", block, -1, _text_body(buffer), pack(*steps, part), id_column.to_pylist())]
            for p in np.unique(part):
                at = np.flatnonzero(part == p)
                rows.append(("anchor", block, int(p), pack(grams[at], hashes[at]), None, None))
            yield packets(rows, id_column.type)
            block += 1

    def count(table: pa.Table) -> pa.Table:
        """For every anchor of the part: 0 its gram stands once, 1 its context does, 2 a copy of a context, 3 the first copy."""
        order = np.argsort(table.column("block").to_numpy(), kind="stable")
        blocks = table.column("block").to_numpy()[order]
        bodies = [unpack(table.column("body")[int(i)].as_py()) for i in order]
        lengths = [len(b[0]) for b in bodies]
        grams, hashes = (np.concatenate([b[i] for b in bodies]) for i in (0, 1))
        sort = np.lexsort((hashes, grams))
        g, h = grams[sort], hashes[sort]
        new_gram = np.ones(len(g), dtype=bool)
        new_gram[1:] = g[1:] != g[:-1]
        new_context = new_gram.copy()
        new_context[1:] |= h[1:] != h[:-1]
        gram_no, context_no = np.cumsum(new_gram) - 1, np.cumsum(new_context) - 1
        alone = np.bincount(gram_no)[gram_no] == 1
        single = np.bincount(context_no)[context_no] == 1
        code = np.where(alone, 0, np.where(single, 1, np.where(new_context, 3, 2))).astype(np.uint8)
        codes = np.zeros(len(code), dtype=np.uint8)
        codes[sort] = code
        answers = np.split(codes, np.cumsum(lengths)[:-1])
        part = table.column("part")[0].as_py()
        return pa.Table.from_batches([packets(
            [("code", int(b), part, pack(a), None, None) for b, a in zip(blocks, answers)], table.schema.field("ids").type.value_type)])

    def with_codes(table: pa.Table) -> pa.Table:
        """A block and its codes: contexts for the index, covered ranges, and the texts that wait for a verdict."""
        kinds = table.column("kind").to_pylist()
        own = kinds.index("text")
        id_kind = table.schema.field("ids").type.value_type
        block = table.column("block")[own].as_py()
        buffer = _text_of(table.column("body")[own].as_py())
        offsets, where, back, span, part = unpack(table.column("extra")[own].as_py())
        offsets, where, back, span = (np.cumsum(a) for a in (offsets, where, back, span))
        low = where - back
        high = low + span
        codes = np.zeros(len(where), dtype=np.uint8)
        for i, kind in enumerate(kinds):
            if kind == "code":
                codes[part == table.column("part")[i].as_py()] = unpack(table.column("body")[i].as_py())[0]
        sure = np.flatnonzero(codes >= 2)
        sent = np.flatnonzero((codes == 1) | (codes == 3))
        text_of = np.searchsorted(offsets, where, side="right") - 1
        waits = np.zeros(len(offsets) - 1, dtype=bool)
        waits[text_of[codes == 1]] = True
        rows = []
        for p in np.unique(part[sent]):
            at = sent[part[sent] == p]
            around, _, _ = contexts(buffer, offsets, where[at])
            weight = np.where(codes[at] == 3, 2, 1).astype(np.uint8)
            extra = pack(at.astype(np.uint32), weight, (where[at] - high[at]).astype(np.uint8), (where[at] - low[at]).astype(np.uint8))
            rows.append(("context", block, int(p), _text_body(around.reshape(-1)), extra, None))
        held = np.flatnonzero(waits)
        if len(held):
            keep = np.repeat(waits, np.diff(offsets))
            extra = pack(offsets, held, where, low, high, sure)
            rows.append(("waiting", block, -1, _text_body(buffer[keep]), extra, [table.column("ids")[own].values[int(t)].as_py() for t in held]))
        done = _removed_rows(table.column("ids")[own].values, buffer, offsets, low[sure], high[sure] + WINDOW, np.flatnonzero(~waits))
        out = packets(rows, id_kind) if rows else packets([("none", block, -1, None, None, None)], id_kind)
        return pa.Table.from_batches([_spread(out, done)])

    def _spread(packets_: pa.RecordBatch, done: pa.RecordBatch) -> pa.RecordBatch:
        n, m = packets_.num_rows, done.num_rows
        columns = {name: pa.concat_arrays([packets_.column(name), pa.nulls(m, packets_.schema.field(name).type)]) for name in names}
        columns["kind"] = pa.concat_arrays([packets_.column("kind"), pa.array(["done"] * m, pa.string())])
        for name in done.schema.names:
            columns[name] = pa.concat_arrays([pa.nulls(n, done.schema.field(name).type), done.column(name)])
        if not keep_text:
            columns["kept"] = pa.nulls(n + m, pa.binary())
        return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    def resolve(table: pa.Table) -> pa.Table:
        """The index of one part: first and last offset of the repeated windows of contexts that stand once."""
        order = np.argsort(table.column("block").to_numpy(), kind="stable")
        blocks = table.column("block").to_numpy()[order]
        index, matrices, fields, base = SuffixIndex(), [], [], 0
        for i in order:
            around = _text_of(table.column("body")[int(i)].as_py()).reshape(-1, CONTEXT)
            index.add(index.keys(around), np.arange(base, base + len(around)))
            matrices.append(around)
            fields.append(unpack(table.column("extra")[int(i)].as_py()))
            base += len(around)
        lengths = [len(m) for m in matrices]
        around = np.concatenate(matrices)
        at, weight, first, last = (np.concatenate([f[k] for f in fields]) for k in range(4))
        least, most = np.full(base, -1, dtype=np.int64), np.full(base, -1, dtype=np.int64)
        met = index.matched()
        met_order = np.argsort(index.heads(index.keys(around[met])), kind="stable")
        met = met[met_order]
        heads = around[met][:, REACH : REACH + GRAM]
        new = np.ones(len(met), dtype=bool)
        new[1:] = (heads[1:] != heads[:-1]).any(axis=1)
        group = np.cumsum(new) - 1
        open_group = np.bincount(group, weight[met] == 1) > 0 if len(met) else np.zeros(0, dtype=bool)
        keep = open_group[group] if len(met) else np.zeros(0, dtype=bool)
        met, group = met[keep], group[keep]
        cuts = [0]
        ends = np.append(np.flatnonzero(group[1:] != group[:-1]) + 1, len(group))
        while cuts[-1] < len(group):  # whole groups, about COMPARED contexts at a time
            k = np.searchsorted(ends, cuts[-1] + COMPARED, side="right") - 1
            cuts.append(int(ends[k]) if k >= 0 and ends[k] > cuts[-1] else int(ends[np.searchsorted(ends, cuts[-1], side="right")]))
        for a, b in zip(cuts, cuts[1:]):
            rows = met[a:b]
            least[rows], most[rows] = repeated_offsets(around[rows], group[a:b], weight[rows].astype(np.int64), first[rows].astype(np.int64), last[rows].astype(np.int64))
        found = (weight == 1) & (least >= 0)
        part = table.column("part")[0].as_py()
        rows, base = [], 0
        for block, n in zip(blocks, lengths):
            own = np.flatnonzero(found[base : base + n]) + base
            rows.append(("verdict", int(block), part, pack(at[own], least[own].astype(np.uint8), most[own].astype(np.uint8)), None, None))
            base += n
        return pa.Table.from_batches([packets(rows, table.schema.field("ids").type.value_type)])

    def finish(table: pa.Table) -> pa.Table:
        """The texts of a block that waited, with the verdicts of all parts."""
        kinds = table.column("kind").to_pylist()
        if "waiting" not in kinds:
            return pa.table({n: pa.array([], result_types[n]) for n in result_names})
        own = kinds.index("waiting")
        offsets, held, where, low, high, sure = unpack(table.column("extra")[own].as_py())
        verdicts = [unpack(table.column("body")[i].as_py()) for i, k in enumerate(kinds) if k == "verdict"]
        at, least, most = (np.concatenate([v[k] for v in verdicts]).astype(np.int64) if verdicts else np.zeros(0, dtype=np.int64) for k in range(3))
        begin = np.concatenate([low[sure], where[at] - most])
        end = np.concatenate([high[sure], where[at] - least]) + WINDOW
        # the held texts lie one after another, so ranges move with the text they are in
        size = np.diff(offsets)[held]
        new_offsets = np.concatenate([[0], np.cumsum(size)])
        text = np.searchsorted(offsets, begin, side="right") - 1
        new_text = np.full(len(offsets), -1)
        new_text[held] = np.arange(len(held))
        ok = new_text[text] >= 0
        shift = new_offsets[new_text[text[ok]]] - offsets[text[ok]]
        out = _removed_rows(table.column("ids")[own].values, _text_of(table.column("body")[own].as_py()), new_offsets,
                            begin[ok] + shift, end[ok] + shift, np.arange(len(held)))
        columns = {n: out.column(n) for n in result_names}
        return pa.table(columns)

    result_names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * keep_text
    from pyspark.sql.pandas.types import to_arrow_type

    result_types = {"doc_id": to_arrow_type(docs.schema["doc_id"].dataType), "n_bytes": pa.int64(), "n_removed": pa.int64(),
                    "n_spans": pa.int64(), "kept_sha256": pa.string(), "kept": pa.binary()}
    result = f"doc_id {ids}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"

    texts = docs.select("doc_id", text_column().alias("text"))
    blocks = staged(texts.mapInArrow(cut_blocks, packet), "blocks", "kind").select(*names)
    codes = blocks.filter("kind = 'anchor'").groupBy("part").applyInArrow(count, packet)
    coded = blocks.filter("kind = 'text'").unionByName(codes).groupBy("block").applyInArrow(with_codes, f"{packet}, {result}")
    coded = staged(coded, "coded", "kind")
    verdicts = coded.filter("kind = 'context'").select(*names).groupBy("part").applyInArrow(resolve, packet)
    waiting = coded.filter("kind = 'waiting'").select(*names)
    late = waiting.unionByName(verdicts).groupBy("block").applyInArrow(finish, ", ".join(p for p in result.split(", ") if keep_text or not p.startswith("kept binary")))
    return coded.filter("kind = 'done'").select(*result_names).unionByName(late)


def op9(docs: DataFrame) -> DataFrame:
    return without_repeats(docs, keep_text=False)
