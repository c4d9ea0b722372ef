"""Benchmark decontamination: a BM25 inverted index of the test items with block-max WAND. Every training text is
a query, whole, as an item may be spread over it; all items above their threshold are retrieved, then question
and answer overlap are verified on word shingles. Blocks are ranges of items: a block whose bounds (each term's
largest impact there) do not add up to a threshold is skipped by every list."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, text_chunks
from .windows import rolled, runs, word_hashes

#: Text of the items that are indexed and broadcast at a time; more are taken in further blocks.
ITEM_BYTES = 16 << 20
#: Postings to a block of a list, each with its largest impact.
BLOCK = 4
_TOKEN = np.zeros(256, bool)
_TOKEN[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True


def token_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word, A-Z lower-cased and punctuation left out; words of each text."""
    clean = bytes(i if _TOKEN[i] else 32 for i in range(256))
    return word_hashes([t.lower().translate(clean) for t in texts])


@dataclass
class Index:
    """Items in order; of each term the postings (item, impact), impacts so scaled that an item is retrieved at 1."""

    ids: np.ndarray
    terms: np.ndarray  # sorted hashes
    begin: np.ndarray  # of each term's postings
    item: np.ndarray
    impact: np.ndarray
    common: np.ndarray  # of each item, the impacts of terms that are no reason to look at it
    essential: np.ndarray  # of each term
    shingles: list[np.ndarray]  # of each item, in order
    answer_from: list[int]  # the first shingle of its answer
    words: np.ndarray  # of each item

    def block_bounds(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """Postings of essential terms by block of items, with the largest impact; and each block's common rest."""
        n = -(-len(self.ids) // BLOCK)
        term = np.repeat(np.arange(len(self.terms)), np.diff(self.begin))
        keep = self.essential[term]
        key = term[keep] * n + self.item[keep] // BLOCK
        cut = np.flatnonzero(np.concatenate(([True], np.diff(key) != 0))) if len(key) else np.empty(0, int)
        top = np.maximum.reduceat(self.impact[keep], cut) if len(key) else np.empty(0)
        rest = np.maximum.reduceat(self.common, np.arange(0, len(self.ids), BLOCK)) if len(self.ids) else np.empty(0)
        begin = np.searchsorted(key[cut] // n if len(key) else cut, np.arange(len(self.terms) + 1))
        return begin, key[cut] % n if len(key) else cut, top, rest


def answer_starts(n: int) -> int:
    """The first shingle of the answer of an item of n shingles that does not say where it is: the last quarter."""
    return max(0, n - max(1, n // 4))


def most_hidden(words: np.ndarray, m: int, shingle: int) -> float:
    """The most that the words in no shingle can weigh if m shingles of an item are missing: words at its ends hide
    with a shingle each, and r words elsewhere with r + shingle - 1."""
    if not len(words) or not m:
        return 0.0
    if m >= len(words):
        return float(words.sum())
    ends = np.concatenate(([0.0], np.cumsum(words[:m])))[:, None] + np.concatenate(([0.0], np.cumsum(words[::-1][:m])))
    best = np.concatenate(([0.0], np.cumsum(np.sort(words)[::-1][:m])))
    left = m - np.arange(m + 1)[:, None] - np.arange(m + 1)
    return float(np.where(left >= 0, ends + best[np.maximum(0, left - shingle + 1)], 0).max())


def build_index(ids: list[int], texts: list[bytes], shingle: int = 5, percent: int = 80, k1: float = 1.2, b: float = 0.75) -> Index:
    """An item's threshold is the least score of a text that verification can accept: the item's own, less the
    most that the words hidden by the shingles that may be missing can weigh."""
    h, counts = token_hashes(texts)
    ends = np.cumsum(counts)
    own = [h[e - c : e] for e, c in zip(ends, counts, strict=True)]
    mean = max(1.0, counts.mean()) if len(counts) else 1.0
    doc = np.repeat(np.arange(len(texts)), counts)
    key, tf = np.unique(np.stack((h, doc.astype(np.uint64))), axis=1, return_counts=True) if len(h) else (np.empty((2, 0), np.uint64), np.empty(0, int))
    term_of, item = key[0], key[1].astype(np.int64)
    terms, df = np.unique(term_of, return_counts=True)
    begin = np.concatenate(([0], np.cumsum(df)))
    idf = np.log1p((len(texts) - df + 0.5) / (df + 0.5))
    impact = np.repeat(idf, df) * tf * (k1 + 1) / (tf + k1 * (1 - b + b * counts[item] / mean))
    total = np.bincount(item, impact, len(texts))
    n = np.where(counts >= shingle, counts - shingle + 1, np.minimum(counts, 1))
    asked = np.array([answer_starts(int(x)) for x in n], np.int64)
    needed = lambda x: -(-percent * x // 100)
    lost = n - np.where(asked > 0, np.minimum(needed(n), needed(asked)), needed(n))  # m missing shingles hide m words at most
    lost = np.where(n > 0, lost, 0)
    posting = np.searchsorted(np.repeat(np.arange(len(terms)), df) * len(texts) + item, np.searchsorted(terms, h) * len(texts) + doc)
    occurrence = impact[posting]  # of each word of each item, its term's impact
    limit = total - np.array([most_hidden(occurrence[e - c : e], int(m), shingle) for e, c, m in zip(ends, counts, lost, strict=True)])
    limit = np.maximum(limit, 1e-9 * (1 + total))  # rounding apart, no text with a word in common is left out then
    impact = impact / limit[item]
    # common terms: by falling df, as long as no item gets more than 0.3 from them
    common, essential = np.zeros(len(texts)), np.ones(len(terms), bool)
    for t in np.argsort(-df, kind="stable"):
        at = slice(begin[t], begin[t + 1])
        if (common[item[at]] + impact[at] > 0.3).any():
            break
        common[item[at]] += impact[at]
        essential[t] = False
    shingles = [rolled(w, shingle) if len(w) >= shingle else rolled(w, len(w)) if len(w) else np.empty(0, np.uint64) for w in own]
    return Index(np.array(ids, np.int64), terms, begin, item, impact, common, essential, shingles, asked.tolist(), counts)


def block_max_wand(index: Index, terms: np.ndarray, live: np.ndarray) -> list[int]:
    """Items whose score with the query's terms is 1 or more, item at a time: lists are kept in order of their next
    item; the pivot is the first item at which the lists' bounds reach 1. If the largest impacts of these lists in the
    pivot's block do not, they leap to the block's end, or to the next list's item if that comes first, and nothing in
    between is read. live: the blocks whose own bounds reach 1, in order; all lists leap over the others."""
    a, size = index.begin[terms], index.begin[terms + 1] - index.begin[terms]
    at = np.repeat(a - (np.cumsum(size) - size), size) + np.arange(size.sum())
    alive = np.zeros(-(-len(index.ids) // BLOCK), bool)
    alive[live] = True
    ok = alive[index.item[at] // BLOCK]
    at, owner = at[ok], np.repeat(np.arange(len(terms)), size)[ok]
    first = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1]))) if len(at) else np.empty(0, int)
    impact, end = index.impact[at], len(index.ids)
    bound = np.maximum.reduceat(impact, first) if len(at) else impact
    # all lists in one row, each with an end behind it
    rank = np.cumsum(np.concatenate(([0], owner[1:] != owner[:-1])))[: len(at)]
    item = np.insert(index.item[at], np.append(first[1:], len(at)), end)
    impact = np.insert(impact, np.append(first[1:], len(at)), 0.0)
    key = np.insert(rank, np.append(first[1:], len(at)), np.arange(len(first))) * (end + 1) + item
    begin = first + np.arange(len(first))
    own = np.arange(len(first)) * (end + 1)
    # the largest impact of each list in each block that it has items in
    blocks = len(alive) + 1
    part = rank * blocks + index.item[at] // BLOCK
    cut = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1]))) if len(at) else np.empty(0, int)
    top, part = np.maximum.reduceat(index.impact[at], cut) if len(at) else index.impact[at], part[cut]
    now, found = begin.copy(), []
    while True:
        here = item[now]
        order = np.argsort(here, kind="stable")
        p = int(np.searchsorted(np.cumsum(bound[order]), 1 - 1e-9))
        if p == len(order) or here[order[p]] == end:
            return found
        pivot = here[order[p]]
        while p + 1 < len(order) and here[order[p + 1]] == pivot:
            p += 1
        upto = order[: p + 1]
        of = upto * blocks + pivot // BLOCK
        k = np.minimum(np.searchsorted(part, of), len(part) - 1)
        if np.where(part[k] == of, top[k], 0.0).sum() < 1 - 1e-9:
            after = (pivot // BLOCK + 1) * BLOCK if p + 1 == len(order) else min((pivot // BLOCK + 1) * BLOCK, here[order[p + 1]])
            now[upto] = np.searchsorted(key, own[upto] + min(int(after), end))
        elif here[order[0]] == pivot:
            same = here == pivot
            if impact[now[same]].sum() >= 1 - 1e-9:
                found.append(int(pivot))
            now[same] += 1
        else:
            back = here < pivot
            now[back] = np.searchsorted(key, own[back] + pivot)


def _retrieved(index: Index, bounds: tuple, h: np.ndarray, counts: np.ndarray) -> Iterator[tuple[int, int]]:
    """(text, item) of every text, whole, that reaches an item's threshold."""
    begin, block, top, rest = bounds
    at = np.searchsorted(index.terms, h)
    at[at == len(index.terms)] = 0
    hit = np.flatnonzero(index.terms[at] == h)
    doc = np.repeat(np.arange(len(counts)), counts)
    pair = np.unique(doc[hit] * len(index.terms) + at[hit])
    doc, term = pair // len(index.terms), pair % len(index.terms)
    key = index.essential[term]
    size = begin[term[key] + 1] - begin[term[key]]
    # a few texts at a time, by what their lists have: of one text it is the index itself at most
    load = np.cumsum(np.bincount(doc[key], size, len(counts)))
    groups = np.unique(load // 1_000_000, return_index=True)[1]
    for first, last in zip(groups.tolist(), [*groups[1:].tolist(), len(counts)], strict=True):
        some = (doc[key] >= first) & (doc[key] < last)
        n = size[some]
        if not n.sum():
            continue
        flat = np.repeat(begin[term[key][some]] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        place, where = np.unique(np.repeat(doc[key][some], n) * len(rest) + block[flat], return_inverse=True)
        good = place[np.bincount(where, top[flat]) + rest[place % len(rest)] >= 1 - 1e-9]
        owner, live = good // len(rest), good % len(rest)
        for a, b in runs(owner):
            d = int(owner[a])
            x, y = np.searchsorted(doc, [d, d + 1])
            yield from ((d, i) for i in block_max_wand(index, term[x:y], live[a:b]))


def contaminated(docs: DataFrame, items: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", need_answer: bool = False) -> DataFrame:
    """Pairs of a document and a test item that the document holds: percent or more of the word shingles of its
    question, or of all its shingles. With need_answer, as much of the answer as well.

    Returns id, item, question_overlap and answer_overlap (shares of the shingles of an item's first three
    quarters and of its last quarter that the text holds, wherever in it they are), overlap (of all of them) and
    answered (whether it holds percent of the answer). Words are compared without case and punctuation; an
    item with fewer words than a shingle counts as one, and is all answer. Items without words and null texts
    match nothing; null item ids are left out; null document ids are kept. Ties and repeated rows give a row
    each; empty tables give none. Other columns are not read.

    Items are indexed on the driver and broadcast up to ITEM_BYTES of text at a time; a larger set is taken
    in blocks, each over all documents. Nothing is shuffled."""
    spark = docs.sparkSession
    known = items.where(F.col(item_col).isNotNull() & F.col(item_text).isNotNull()).select(F.col(item_col).cast("long").alias("item"), F.col(item_text).alias("text"))
    blocks = 1 + int(known.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]) // ITEM_BYTES
    out = None
    for k in range(blocks):
        some = known.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == k).orderBy("item", "text").toArrow()
        index = build_index(some.column("item").to_pylist(), as_bytes(some.column("text").combine_chunks()), shingle, percent)
        found = _search(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col)), spark.sparkContext.broadcast((index, index.block_bounds())), shingle, percent, need_answer)
        out = found if out is None else out.union(found)
    return out.withColumnRenamed("id", id_col).withColumnRenamed("item", item_col)


def _search(docs: DataFrame, shared, shingle: int, percent: int, need_answer: bool) -> DataFrame:
    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, bounds = shared.value
        for ids, texts in text_chunks(batches):
            if not len(index.terms):
                continue
            h, counts = token_hashes(texts)
            ends, rows, held = np.cumsum(counts), [], {}
            for d, i in sorted(_retrieved(index, bounds, h, counts)):
                want = index.shingles[i]
                words = h[ends[d] - counts[d] : ends[d]]
                k = min(shingle, int(index.words[i]))
                if (d, k) not in held:
                    held[d, k] = np.unique(rolled(words, k))
                hit = np.isin(want, held[d, k])
                cut = index.answer_from[i]
                whole, asked, answer = (100 * int(x.sum()) >= percent * len(x) > 0 for x in (hit, hit[:cut], hit[cut:]))
                if (whole or asked) and (answer or not need_answer):
                    rows.append((ids[d], int(index.ids[i]), float(hit[:cut].mean()) if cut else 1.0, float(hit[cut:].mean()), float(hit.mean()), answer))
            if rows:
                kinds = (pa.int64(), pa.int64(), *[pa.float64()] * 3, pa.bool_())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], ["id", "item", "question_overlap", "answer_overlap", "overlap", "answered"])

    return docs.mapInArrow(searched, "id long, item long, question_overlap double, answer_overlap double, overlap double, answered boolean")
