"""Evaluation passages in a training corpus: pigeonhole pieces, exact piece hits, Myers verification.

A passage is ``min_words`` consecutive words of a test item. The item is cut into pieces of
``(min_words + 1) // (errors + 2)`` words, so that every passage holds at least ``errors + 1`` whole pieces: a
passage with at most ``errors`` edited words leaves one piece untouched. One automaton finds all pieces in a
document in a single pass; around each hit the passages that hold the piece are compared with the document by
Myers' bit-parallel distance over words. The corpus is never shuffled, and no document is paired with an item
that it shares no piece with.

The test items go to the executors in blocks of at most ``block_bytes`` of text (an item that is larger by itself
makes a larger block), one corpus pass a block; that is the bound of what is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from cratework.llm.words import words

MIN_WORDS = 12
ERRORS = 1
BLOCK_BYTES = 16 << 20

_built: dict = {}


def masks(pattern: list[str]) -> dict[str, int]:
    """For each word the bits of its places in the pattern."""
    out: dict[str, int] = {}
    for i, w in enumerate(pattern):
        out[w] = out.get(w, 0) | 1 << i
    return out


def myers(bits: dict[str, int], start: int, length: int, text: list[str]) -> int:
    """Least edit distance between pattern[start : start + length] and any stretch of ``text`` (Myers 1999)."""
    full, top = (1 << length) - 1, 1 << (length - 1)
    plus, minus, score = full, 0, length
    best = score
    for w in text:
        eq = bits.get(w, 0) >> start & full
        xv = eq | minus
        xh = (((eq & plus) + plus) ^ plus) | eq
        ph = (minus | ~(xh | plus)) & full
        mh = plus & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph = ph << 1 & full
        mh = mh << 1 & full
        plus = (mh | ~(xv | ph)) & full
        minus = ph & xv
        best = min(best, score)
    return best


class Finder:
    """All pieces of a block of items, as one automaton."""

    def __init__(self, items: list[tuple], min_words: int, errors: int) -> None:
        import ahocorasick

        self.n, self.errors = min_words, errors
        self.piece = (min_words + 1) // (errors + 2)
        if self.piece < 1:
            raise ValueError("too many errors for passages of so few words")
        self.items = []
        where: dict[str, list[tuple[int, int]]] = {}
        for item, text in items:
            w = words(text)
            if len(w) < min_words:
                continue
            k = len(self.items)
            self.items.append((item, w, masks(w)))
            for q in range(0, len(w) - self.piece + 1, self.piece):
                where.setdefault(" " + " ".join(w[q : q + self.piece]) + " ", []).append((k, q))
        self.automaton = ahocorasick.Automaton()
        for text, at in where.items():
            self.automaton.add_word(text, (len(text), at))
        if where:
            self.automaton.make_automaton()
        self.any = bool(where)

    def search(self, text: str | None) -> dict[int, tuple[int, int, int]]:
        """item number -> (longest run of equal words, least distance of a passage, item words in matched passages)."""
        if not self.any or not text:
            return {}
        w = words(text)
        line = " " + " ".join(w) + " "
        hits: dict[int, set[tuple[int, int]]] = {}
        seen_to, at_word = 0, 0
        for end, (length, at) in self.automaton.iter(line):
            start = end - length + 1
            if start >= seen_to:
                at_word += line.count(" ", seen_to, start)
                p = at_word
                seen_to = start
            else:
                p = at_word - line.count(" ", start, seen_to)
            for k, q in at:
                hits.setdefault(k, set()).add((p, q))
        out = {}
        for k, places in hits.items():
            found = self._verify(w, self.items[k][1], self.items[k][2], places)
            if found:
                out[k] = found
        return out

    def _verify(self, w: list[str], pattern: list[str], bits: dict[str, int], places: set[tuple[int, int]]) -> tuple[int, int, int] | None:
        """Myers distance of each passage that holds one of the hit pieces, at the place where the piece puts it."""
        run, least, covered = 0, self.n + 1, 0
        window = (1 << self.n) - 1
        ends: dict[int, int] = {}
        tried: set[tuple[int, int]] = set()
        for p, q in sorted(places):
            a, b = 0, self.piece
            if q < ends.get(p - q, -1):
                continue  # inside the equal run of an earlier piece on the same diagonal
            while p - a > 0 and q - a > 0 and w[p - a - 1] == pattern[q - a - 1]:
                a += 1
            while p + b < len(w) and q + b < len(pattern) and w[p + b] == pattern[q + b]:
                b += 1
            ends[p - q] = q + b
            best = self.n + 1
            for s in range(max(0, q + self.piece - self.n - a), min(q + b - self.piece, len(pattern) - self.n) + 1):
                d = p - (q - s)
                if (d, s) in tried:
                    continue
                tried.add((d, s))
                stretch = w[max(0, d - self.errors) : max(0, d + self.n + self.errors)]
                distance = myers(bits, s, self.n, stretch)
                if distance <= self.errors:
                    covered |= window << s
                    best = min(best, distance)
            if best <= self.errors:
                least, run = min(least, best), max(run, a + b)
                if run == len(pattern):
                    break
        return (run, least, covered.bit_count()) if least <= self.errors else None


def leaks(
    documents: DataFrame,
    items: DataFrame,
    doc: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    min_words: int = MIN_WORDS,
    errors: int = ERRORS,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """doc, item, longest_run, distance, item_words: every document that holds a passage of an item with at most ``errors`` edited words.

    ``longest_run`` is the longest stretch of equal consecutive words, ``distance`` the least number of edited
    words of a passage (0: word for word), ``item_words`` how many of the item's words lie in matched passages.
    Null texts and items of fewer than ``min_words`` words match nothing; repeated document rows give repeated
    results; repeated items count once. Where both key columns have one name, the item's comes out as ``item_<name>``.
    """
    doc_type, item_type = documents.schema[doc].dataType, items.schema[item].dataType
    wanted = items.select(F.col(item).alias("item"), F.col(item_text).alias("text")).filter(F.col("text").isNotNull()).distinct()
    total = wanted.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    schema = T.StructType([
        T.StructField(doc, doc_type), T.StructField(item if item != doc else f"item_{item}", item_type), T.StructField("longest_run", T.IntegerType()),
        T.StructField("distance", T.IntegerType()), T.StructField("item_words", T.IntegerType()),
    ])
    corpus = documents.select(F.col(doc), F.col(text)).filter(F.col(text).isNotNull())
    item_arrow = to_arrow_type(item_type)
    parts = []
    for b in range(blocks):
        block = wanted.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b).collect()
        sent = documents.sparkSession.sparkContext.broadcast([tuple(r) for r in block])

        def search(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            if _built.get("of") is not sent.value:
                _built["of"], _built["finder"] = sent.value, Finder(sent.value, min_words, errors)
            finder = _built["finder"]
            for batch in batches:
                ids, rows = [], []
                keys = batch.column(0).to_pylist()
                for key, t in zip(keys, batch.column(1).to_pylist()):
                    for k, found in finder.search(t).items():
                        ids.append((key, finder.items[k][0]))
                        rows.append(found)
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([x[0] for x in ids], batch.schema.field(0).type), pa.array([x[1] for x in ids], item_arrow)]
                        + [pa.array([r[i] for r in rows], pa.int32()) for i in range(3)],
                        names=schema.names,
                    )

        parts.append(corpus.mapInArrow(search, schema))
    return reduce(DataFrame.unionAll, parts)
