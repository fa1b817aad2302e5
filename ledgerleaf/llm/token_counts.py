"""Token counts of a byte-pair vocabulary without emitting a single token.

A text is a linked list of symbols, at first its characters.  A heap holds the adjacent pairs
whose union is a piece, best score first and leftmost among equals; each pop links two symbols
into one.  The count is the initial symbols minus the merges, and a character that is no piece
counts one per byte of its UTF-8 form.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import id_type, text_column

#: The mark that stands for a space.
SPACE = "▁"
#: Fixed rule of the vocabulary: every text is counted as if a space stood before it.
LIMIT = 4096


def load_pieces(path: str) -> dict[str, float]:
    """Pieces that merges may form, with the negated score that orders the merges."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = (
        i for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    )
    return {model.id_to_piece(i): -model.get_score(i) for i in plain}


def merged_count(symbols: str, pieces: dict[str, float]) -> int:
    """Tokens of one stretch of characters."""
    n = len(symbols)
    held: list[str | None] = list(symbols)
    left, right = list(range(-1, n - 1)), list(range(1, n + 1))
    right[-1] = -1
    heap = []
    for i in range(n - 1):
        score = pieces.get(symbols[i : i + 2])
        if score is not None:
            heap.append((score, i, i + 1, 2))
    heapq.heapify(heap)
    merges = 0
    while heap:
        _, a, b, size = heapq.heappop(heap)
        if held[a] is None or held[b] is None or len(held[a]) + len(held[b]) != size:
            continue
        union = held[a] = held[a] + held[b]
        held[b] = None
        merges += 1
        after = right[a] = right[b]
        if after >= 0:
            left[after] = a
            score = pieces.get(union + held[after])
            if score is not None:
                heapq.heappush(heap, (score, a, after, size + len(held[after])))
        before = left[a]
        if before >= 0:
            score = pieces.get(held[before] + union)
            if score is not None:
                heapq.heappush(heap, (score, before, a, size + len(held[before])))
    fallback = sum(len(s.encode("utf-8", "replace")) - 1 for s in held if s is not None and s not in pieces)
    return n - merges + fallback


class StretchCounts(dict):
    """Counts by stretch, computed when first asked for; forgotten when they are too many."""

    def __init__(self, pieces: dict[str, float], most: int):
        super().__init__()
        self.pieces, self.most = pieces, most

    def __missing__(self, stretch: str) -> int:
        count = merged_count(stretch, self.pieces)
        if len(stretch) <= 64:
            if len(self) >= self.most:
                self.clear()
            self[stretch] = count
        return count


def cutter(pieces: dict[str, float]) -> re.Pattern:
    """Where a text may be cut because no piece reaches across.

    A cut before every run of spaces is exact if no piece has a space after another character,
    and one around a line feed if no longer piece contains it; a vocabulary that breaks a rule
    is cut less.
    """
    if any(SPACE in p.lstrip(SPACE) for p in pieces):
        return re.compile(r"(?s).+")
    if any("\n" in p and len(p) > 1 for p in pieces):
        return re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
    return re.compile(f"{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+|\n")


def token_counts(docs: DataFrame, model_path: str, limit: int = LIMIT, cached: int = 1 << 20) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row of ``docs(doc_id, text)``.

    Counts equal those of the vocabulary's own encoder without begin or end tokens.  A null text
    is empty; an empty text has no tokens.  Repeated rows and null ids give their own rows, other
    columns are not read.  ``cached`` bounds the remembered stretches of one task, nothing else.
    """
    pieces = load_pieces(model_path)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, cut = StretchCounts(pieces, cached), cutter(pieces)
        for batch in batches:
            totals = []
            for text in batch.column("text"):
                text = text.as_py()
                stretches = cut.findall(SPACE + text.replace(" ", SPACE)) if text else ()
                totals.append(sum(map(counts.__getitem__, stretches)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(totals, pa.int64())], ["doc_id", "n_bytes", "n_tokens"]
            )

    texts = docs.select("doc_id", F.octet_length(text_column()).cast("long").alias("n_bytes"), text_column().alias("text"))
    counted = texts.mapInArrow(count, f"doc_id {id_type(docs)}, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
