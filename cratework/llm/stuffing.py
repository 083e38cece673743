"""Keyword-stuffed and link-list pages, from the mutual information of neighbouring words.

One pass counts every word and every pair of neighbouring words of the whole corpus (occurrences and documents, by
64-bit hashes, combined batch by batch and shuffled by key), so that no word is left out of the statistics. With
p(w) and PMI(a, b) from these counts, all taken without the page in question (a page can't vouch for itself),

* a page that has a word a c(a) times should have b after it c(a) * p(b) * exp(PMI(a, b)) times, and likewise from b
  backward: a pair that comes back ``REPEATS`` times or more, and ``EXCESS`` times as often as the PMI lets expect, is
  an excessively repeated collocation. The grammar of a language, names and fixed phrases are what PMI expects;
* a line whose mean PMI is no better than chance and most of whose words come back in the page is incoherent word
  salad, whether or not any pair is repeated; lines with too few pairs to tell are salad if the page as a whole is;
* words of external addresses strung together, of product tags and of short lines with a price count by themselves.

The share of words so labelled decides: more than half. References, comments and attributes of markup are no
neighbours of words.

Only pages that could be stuffed need PMI: where less than half of the words would be labelled even if each repeated
pair were excessive and each line of recurring words were salad, no statistics can change the verdict (all rules only
add labels). For the other pages, the candidates, the counts of their words and pairs are joined in: those of keys
in more than ``HEAD_SHARE`` of the documents from a broadcast table (of at most distinct keys a page / HEAD_SHARE
entries, whatever the corpus), all others by a shuffled join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from cratework.llm.words import slices
from cratework.session import settle

REPEATS = 3
EXCESS = 4.0
# Other documents that a pair must be in for half of its rate to count: a few copies of a page don't vouch for it.
VOUCHERS = 5.0
# A page vouches for a pair with at most this part of its pairs (once at least): stuffing doesn't vouch for stuffing.
VOUCHED_PART = 64
SALAD_PMI = 0.0
SALAD_PAIRS = 6
SALAD_SHARE = 0.67
LINE_SHARE = 0.5
ECHO_SHARE = 0.3
ECHO = 0.9
LINKS = 3
TAGS = 5
SHORT_LINE = 16
SPAM_SHARE = 0.5
HEAD_SHARE = 0.01
DOCS, WORDS, PAIRS = 0, 1, 2  # keys of the totals

# Patterns of RE2, which the vectorised string functions use.
_WORD = r"[\p{L}\p{N}]+"
_GAP = r"[^\p{L}\p{N}]+"
_DROP = r"(?is)<!--.*?-->|<ref[^<>]*/>|<ref[^<>]*>.*?</ref>|\{\{\s*cite[^{}]*\}\}"
_ATTRIBUTE = r"(?i)\b(?:[a-gi-z][a-z-]*|h[a-qs-z][a-z-]*)\s*=\s*(?:\"[^\"\n]*\"|(?:right|left|center)\b|\d+%?)"
_URL = r"(?i)https?://[^\s|}\]\"'<>]+"
_TAG = r"(?:^|\s)#[\p{L}\p{N}_]+"
_PRICE = r"(?i)\d[.,]\d\d\s*(?:€|\$|£|(?:usd|eur|gbp)\b)|[€$£]\s*\d"
_LINE = r"(?i)[\r\n\x{2028}\x{2029}]+|<br\s*/?>"


def _numpy(c) -> np.ndarray:
    return c.to_numpy(zero_copy_only=False)


def _words_in(lines: pa.Array) -> np.ndarray:
    return _numpy(pc.count_substring_regex(lines, _WORD)).astype(np.int64)


def _where(lines: pa.Array, chosen: np.ndarray, change) -> tuple[pa.Array, np.ndarray]:
    """The lines with the chosen ones changed, and by how many words each became shorter."""
    fewer = np.zeros(len(lines), np.int64)
    at = np.flatnonzero(chosen)
    if not len(at):
        return lines, fewer
    old = lines.take(pa.array(at))
    new = change(old)
    fewer[at] = _words_in(old) - _words_in(new)
    return pc.replace_with_mask(lines, pa.array(chosen), new), fewer


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts in lower case, and the text each is of."""
    lists = pc.split_pattern_regex(pc.utf8_lower(texts), pattern=_GAP)
    words, of = pc.list_flatten(lists), _numpy(pc.list_parent_indices(lists)).astype(np.int64)
    real = pc.greater(pc.binary_length(words), 0)
    return words.filter(real), of[_numpy(real)]


def word_key(word: str) -> int:
    """The key of a word in the counts: 64 bits, never that of a total."""
    return max(xxhash.xxh3_64_intdigest(word), PAIRS + 1)


def pair_keys(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The keys of pairs of word keys (order counts): both multiplied by odd numbers, then mixed."""
    with np.errstate(over="ignore"):
        x = a * np.uint64(0x9E3779B97F4A7C15) ^ (b * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(0x165667B19E3779F9))
        for shift, odd in ((32, 0xD6E8FEB86659FD93), (29, 0xD6E8FEB86659FD93)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(odd)
    return np.maximum(x ^ (x >> np.uint64(32)), np.uint64(PAIRS + 1))


class Page:
    """The words of a batch of texts, flat: the place of each word in ``keys``, its line, and for each line what it counts."""

    def __init__(self, texts: pa.Array, places: bool = True) -> None:
        """Numbers, addresses, tags (where a line strings them together) and attributes are no words, but are counted.

        Null texts have no lines.
        """
        texts = pc.fill_null(texts, "")
        lists = pc.split_pattern_regex(pc.replace_substring_regex(texts, pattern=_DROP, replacement="\n"), pattern=_LINE)
        lines, doc = pc.list_flatten(lists), _numpy(pc.list_parent_indices(lists)).astype(np.int64)
        n = _words_in(lines)
        some = n > 0
        lines, doc, n = lines.filter(pa.array(some)), doc[some], n[some]
        self.docs, self.doc, self.n_words = len(texts), doc, n
        has = lambda what: _numpy(pc.match_substring(lines, what))
        linked = has("://")
        n_links = np.zeros(len(n), np.int64)
        n_links[linked] = _numpy(pc.count_substring_regex(lines.filter(pa.array(linked)), _URL))
        lines, link_words = _where(lines, linked, lambda x: pc.replace_substring_regex(x, pattern=_URL, replacement=" "))
        lines, _ = _where(lines, has("="), lambda x: pc.replace_substring_regex(x, pattern=_ATTRIBUTE, replacement=" "))
        marked = np.flatnonzero(has("#"))
        n_tags = np.zeros(len(n), np.int64)
        n_tags[marked] = _numpy(pc.count_substring_regex(lines.take(pa.array(marked)), _TAG))
        n_tags[n_tags < TAGS] = 0
        lines, tag_words = _where(lines, n_tags > 0, lambda x: pc.replace_substring_regex(x, pattern=_TAG, replacement=" "))
        self.n_links, self.link_words = n_links + n_tags, link_words + tag_words
        short = np.flatnonzero((n <= SHORT_LINE) & (self.n_links == 0))
        priced = short[_numpy(pc.match_substring_regex(lines.take(pa.array(short)), _PRICE))] if len(short) else short
        self.n_links[priced] = 1
        self.link_words[priced] = n[priced]
        words, line = split_words(lines)
        kept = _numpy(pc.invert(pc.utf8_is_decimal(words)))
        bare = np.zeros(len(n), bool)
        bare[priced] = True
        kept &= ~bare[line]
        coded = words.filter(pa.array(kept)).dictionary_encode()
        self.line = line[kept]
        self.keys = np.array([word_key(w) for w in coded.dictionary.to_pylist()], np.uint64)
        self.ids = _numpy(coded.indices).astype(np.int64) if len(coded) else np.zeros(0, np.int64)
        self.sizes = np.bincount(self.line, minlength=len(n))
        self.first = np.flatnonzero(self.line[1:] == self.line[:-1])
        self.word_doc = self.doc[self.line]
        self.pair_line = self.line[self.first]
        self.pair_doc = self.word_doc[self.first]
        self.a, self.b = self.ids[self.first], self.ids[self.first + 1]
        # distinct words and pairs of each text, how often it has them, and (``places``) which of them each word and pair is
        size = max(len(self.keys), 1)

        def unique(x: np.ndarray) -> tuple[np.ndarray, np.ndarray | None, np.ndarray]:
            if places:
                return np.unique(x, return_inverse=True, return_counts=True)
            x = np.sort(x)
            ends = np.flatnonzero(np.append(x[1:] != x[:-1], True)) if len(x) else np.zeros(0, np.int64)
            return x[ends], None, np.diff(ends, prepend=-1)

        w, self.word_at, self.word_count = unique(self.word_doc * size + self.ids)
        self.of_word, self.word_of_doc = w % size, w // size
        pairs, at = np.unique(self.a * size + self.b, return_inverse=True)
        self.pair_a, self.pair_b = pairs // size, pairs % size
        p, self.pair_at, self.pair_count = unique(self.pair_doc * max(len(pairs), 1) + at)
        self.of_pair, self.pair_of_doc = p % max(len(pairs), 1), p // max(len(pairs), 1)
        if places:  # where the words of each distinct pair of a text stand among the distinct words of that text
            self.a_at = np.searchsorted(w, self.pair_of_doc * size + self.pair_a[self.of_pair])
            self.b_at = np.searchsorted(w, self.pair_of_doc * size + self.pair_b[self.of_pair])
        self.n_pairs = np.bincount(self.pair_doc, minlength=self.docs)
        self.vouched = np.minimum(self.pair_count, np.maximum(self.n_pairs // VOUCHED_PART, 1)[self.pair_of_doc])

    def pair_keys(self) -> np.ndarray:
        """The key of each distinct pair of the batch."""
        return pair_keys(self.keys[self.pair_a], self.keys[self.pair_b])


class Counts:
    """Occurrences and documents of keys, from a sorted table."""

    def __init__(self, keys: np.ndarray, n: np.ndarray, d: np.ndarray) -> None:
        order = np.argsort(keys)
        self.keys, self.n, self.d = keys[order], n[order].astype(np.float64), d[order].astype(np.float64)

    def get(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(occurrences, documents, whether the table has the key); 0 where it hasn't."""
        if not len(self.keys):
            none = np.zeros(len(keys))
            return none, none, none > 0
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        there = self.keys[at] == keys
        return np.where(there, self.n[at], 0), np.where(there, self.d[at], 0), there


def corpus_counts(documents: DataFrame, text: str = "text") -> DataFrame:
    """key, n, d: occurrences and documents of each word and pair of neighbours in more than one document, and the totals.

    Of a pair, a document counts at most 1 / VOUCHED_PART of its neighbours, or one.

    Keys are 64-bit hashes (as BIGINT); among 10^12 of them another one's count is met once in 10^7 lookups. What is in
    one document only needs no row: without that document it is unknown.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 0):
            page = Page(batch.column(0), places=False)
            sizes = (len(page.keys), len(page.pair_a))
            n = [np.bincount(at, weights, size) for at, weights, size in zip((page.of_word, page.of_pair), (page.word_count, page.vouched), sizes)]
            d = [np.bincount(at, minlength=size) for at, size in zip((page.of_word, page.of_pair), sizes)]
            totals = [batch.num_rows, len(page.ids), len(page.first)]
            keys = np.concatenate([np.array([DOCS, WORDS, PAIRS], np.uint64), page.keys, page.pair_keys()]).view(np.int64)
            columns = [keys, np.concatenate([totals, *n]).astype(np.int64), np.concatenate([[2, 2, 2], *d]).astype(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["key", "n", "d"])

    rows = documents.select(text).filter(F.col(text).isNotNull()).mapInArrow(count, "key long, n long, d long")
    return rows.groupBy("key").agg(F.sum("n").alias("n"), F.sum("d").alias("d")).filter("d > 1")


def _labels(page: Page, excess: np.ndarray, salad: np.ndarray) -> np.ndarray:
    """The labelled words of each text, given which pair occurrences are excessive and which lines are salad. Monotone in both."""
    docs, lines = page.docs, len(page.sizes)
    mark = np.zeros(len(page.ids), bool)
    mark[page.first[excess]] = True
    mark[page.first[excess] + 1] = True
    linked = np.bincount(page.doc, page.n_links, docs)[page.doc] >= LINKS
    hits = np.bincount(page.line, mark, lines).astype(np.int64) + np.where(linked, page.link_words, 0)
    size = page.sizes + page.link_words
    spam = (size > 0) & (hits >= LINE_SHARE * size)
    returning = np.bincount(page.line, page.word_count[page.word_at] >= REPEATS, lines)
    spam |= (hits >= ECHO_SHARE * size) & (returning >= ECHO * page.sizes) & (size > 0)
    spam |= salad
    between = np.zeros(lines, bool)
    if lines > 2:
        same = (page.doc[:-2] == page.doc[1:-1]) & (page.doc[2:] == page.doc[1:-1])
        between[1:-1] = same & spam[:-2] & spam[2:] & (page.n_words[1:-1] <= SHORT_LINE)
    # numbers go with the words around them
    part = np.rint(hits * page.n_words / np.maximum(size, 1)).astype(np.int64)
    labelled = np.where(spam | between, page.n_words, np.minimum(part, page.n_words))
    return np.bincount(page.doc, labelled, docs).astype(np.int64)


def _returning(page: Page, back: np.ndarray) -> np.ndarray:
    """Whether ``SALAD_SHARE`` of the words of each line are of the distinct words in ``back``."""
    return np.bincount(page.line, back[page.word_at], len(page.sizes)) > SALAD_SHARE * page.sizes


def needed_keys(texts: pa.Array, head: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, key) of the distinct words and pairs of each text that aren't in the sorted ``head``."""
    page = Page(texts, places=False)
    of = np.concatenate([page.word_of_doc, page.pair_of_doc])
    keys = np.concatenate([page.keys[page.of_word], page.pair_keys()[page.of_pair]])
    rest = np.ones(len(keys), bool) if not len(head) else head[np.minimum(np.searchsorted(head, keys), len(head) - 1)] != keys
    return of[rest], keys[rest]


def score(texts: pa.Array, tables: list[Counts], pairs: float, bound: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each text: its words, the words labelled as spam, the mean PMI of its neighbours (NaN if none is known elsewhere).

    ``tables`` together hold the counts of all words and pairs of the texts that are in more than one document; with
    ``bound``, a key that they lack may have any counts, and the labelled words are the most that there can be.
    """
    total = _words_in(pc.fill_null(texts, ""))
    page = Page(texts)
    lines = len(page.sizes)
    if not lines:
        return total, np.zeros(page.docs, np.int64), np.full(page.docs, np.nan)

    def counts(keys: np.ndarray, here: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Occurrences and documents without the page, of each distinct word or pair of each text, and whether they are open."""
        n, d, found = np.zeros(len(keys)), np.zeros(len(keys)), np.zeros(len(keys), bool)
        for t in tables:
            tn, td, there = t.get(keys)
            n, d, found = np.where(there, tn, n), np.where(there, td, d), found | there
        return np.maximum(n[which] - here, 0), np.maximum(d[which] - 1, 0), ~found[which] & bound

    here, own = page.pair_count, page.word_count
    word_n, word_d, word_open = counts(page.keys, own, page.of_word)
    pair_n, pair_d, pair_open = counts(page.pair_keys(), page.vouched, page.of_pair)
    a, b = page.a_at, page.b_at
    pair_open |= word_open[a] | word_open[b]
    rate = np.maximum(np.maximum(own[a] / np.maximum(word_n[a], 1), own[b] / np.maximum(word_n[b], 1)), page.n_pairs[page.pair_of_doc] / max(pairs, 1))
    expected = rate * pair_n * pair_d / (pair_d + VOUCHERS)
    excess = (here >= REPEATS) & (pair_open | (here >= EXCESS * expected))

    known = (word_d[a] > 0) & (word_d[b] > 0)
    with np.errstate(divide="ignore", invalid="ignore"):
        pmi = np.where(known, np.log((pair_n + 0.1) * max(pairs, 1) / ((word_n[a] + 0.1) * (word_n[b] + 0.1))), 0.0)
        known, pmi = known | pair_open, np.where(pair_open, -1e9, pmi)
        n_known = np.bincount(page.pair_doc, known[page.pair_at], page.docs)
        total_pmi = np.bincount(page.pair_doc, pmi[page.pair_at], page.docs)
        mean = np.where(n_known > 0, total_pmi / n_known, np.nan)
    back = own >= REPEATS
    line_known, line_pmi = np.bincount(page.pair_line, known[page.pair_at], lines), np.bincount(page.pair_line, pmi[page.pair_at], lines)
    salad = (line_known >= SALAD_PAIRS) & (line_pmi < SALAD_PMI * line_known) & _returning(page, back)
    # lines too short to be judged alone, on a page that is salad as a whole
    most = np.bincount(page.word_doc, back[page.word_at], page.docs) > SALAD_SHARE * np.bincount(page.doc, page.sizes, page.docs)
    whole = (n_known >= SALAD_PAIRS) & (total_pmi < SALAD_PMI * n_known) & most
    few = (line_known < SALAD_PAIRS) | (np.bincount(page.pair_line, pair_open[page.pair_at], lines) > 0)
    salad |= whole[page.doc] & few & (page.sizes > 0)
    return total, np.minimum(_labels(page, excess[page.pair_at], salad), total), mean


def stuffed_pages(documents: DataFrame, doc: str = "doc_id", text: str = "text", share: float = SPAM_SHARE) -> DataFrame:
    """doc, n_words, spam_words, mean_pmi, is_spam of every document.

    spam_words and mean_pmi are null for the documents that can't be stuffed, whatever the statistics (at most
    ``share`` of their words could be labelled), null and empty texts among them; mean_pmi is null as well where no
    other document has both words of any pair. Repeated document rows give repeated results.
    """
    spark = documents.sparkSession
    counts = settle(corpus_counts(documents, text))
    totals = {r["key"]: r["n"] for r in counts.filter(F.col("key").isin(DOCS, WORDS, PAIRS)).collect()}
    n_docs, n_pairs = float(totals.get(DOCS, 0)), float(totals.get(PAIRS, 0))
    real = counts.filter(~F.col("key").isin(DOCS, WORDS, PAIRS))
    often = real.filter(F.col("d") > F.lit(HEAD_SHARE * n_docs)).toArrow()  # at most distinct keys a page / HEAD_SHARE rows
    table = Counts(*(often.column(c).to_numpy().view(k) for c, k in (("key", np.uint64), ("n", np.int64), ("d", np.int64))))
    sent = spark.sparkContext.broadcast((table.keys, table.n, table.d))

    def possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = Counts(*sent.value)
        for batch in slices(batches, 1):
            total, most, _ = score(batch.column(1), [head], n_pairs, bound=True)
            text = batch.column(1).take(pa.array(np.arange(batch.num_rows), mask=most <= share * total))
            yield pa.RecordBatch.from_arrays([batch.column(0), text, pa.array(total)], names=["doc", "text", "n_words"])

    named = documents.select(F.col(doc).alias("doc"), F.col(text).alias("text"))
    first = T.StructType([named.schema["doc"], T.StructField("text", T.StringType()), T.StructField("n_words", T.LongType())])
    seen = settle(named.mapInArrow(possible, first))  # with the texts of candidates only
    candidates = seen.filter(F.col("text").isNotNull()).withColumn("page", F.unhex(F.md5("text")))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = sent.value[0]
        for batch in slices(batches, 1):
            of, keys = needed_keys(batch.column(1), head)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(of)), pa.array(keys.view(np.int64))], names=["page", "key"])

    asked = candidates.select("page", "text").mapInArrow(ask, "page binary, key long").distinct()
    answers = asked.join(real.filter(F.col("d") <= F.lit(HEAD_SHARE * n_docs)), "key").groupBy("page").agg(
        F.collect_list("key").alias("keys"), F.collect_list("n").alias("ns"), F.collect_list("d").alias("ds")
    )  # the words and pairs of one text
    key_type = documents.schema[doc].dataType
    schema = T.StructType([
        T.StructField(doc, key_type), T.StructField("n_words", T.LongType()), T.StructField("spam_words", T.LongType()),
        T.StructField("mean_pmi", T.DoubleType()), T.StructField("is_spam", T.BooleanType()),
    ])
    arrow = to_arrow_type(key_type)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = Counts(*sent.value)
        for batch in slices(batches, 1):
            flat = [_numpy(pc.list_flatten(batch.column(i))) for i in (2, 3, 4)]
            keys, at = np.unique(flat[0].astype(np.int64).view(np.uint64), return_index=True)
            own = Counts(keys, flat[1][at], flat[2][at])
            total, spam, mean = score(batch.column(1), [head, own], n_pairs)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(arrow), pa.array(total), pa.array(spam), pa.array(mean, from_pandas=True), pa.array(spam > share * total)],
                names=schema.names,
            )

    judged = candidates.join(answers, "page", "left").select("doc", "text", "keys", "ns", "ds").mapInArrow(judge, schema)
    clean = seen.filter(F.col("text").isNull())
    return judged.unionAll(clean.select("doc", "n_words", *[F.lit(None).cast(schema[c].dataType) for c in ("spam_words", "mean_pmi")], F.lit(False)))
