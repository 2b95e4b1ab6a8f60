"""Benchmark decontamination: an FM-index over each shard of the training texts.

A shard's words become numbers; the index (suffix order, last column in a wavelet matrix, sampled
suffix positions) answers where any test phrase occurs: backward search narrows a row range word by
word through wavelet ranks, and the rows' text positions come from walking to the next sample. The
hit words merge into removal spans. Words no phrase has cannot be part of a hit: they break the
text into runs, and runs shorter than the shortest phrase are left out of the index.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwatch.llm.common import ALNUM, LOWER, csr_rows, joined, slices, span_hashes, table, text_bytes, word_spans

WINDOW = 10
#: Symbols and text bytes of a shard; words of the phrases one pass carries to the tasks.
SHARD_WORDS, SHARD_BYTES, PASS_WORDS = 1 << 20, 32 << 20, 1 << 20
SAMPLE = 8


class WaveletMatrix:
    """Rank and access on a sequence of small numbers, a bit vector with block counts per level."""

    def __init__(self, x: np.ndarray, size: int):
        self.levels = max(1, int(size - 1).bit_length())
        self.words, self.counts, self.zeros = [], [], []
        for level in range(self.levels - 1, -1, -1):
            bit = (x >> level) & 1
            packed = np.zeros(-(-(len(x) + 1) // 64) * 8, np.uint8)
            raw = np.packbits(bit.astype(np.uint8), bitorder="little")
            packed[: len(raw)] = raw
            words = packed.view(np.uint64)
            self.words.append(words)
            self.counts.append(np.concatenate([[0], np.cumsum(np.bitwise_count(words).astype(np.int64))]))
            self.zeros.append(int(len(x) - bit.sum()))
            x = np.concatenate([x[bit == 0], x[bit == 1]])
        everything = np.arange(size)
        self.base = self._down(everything, np.zeros(size, np.int64))

    def _ones(self, level: int, i: np.ndarray) -> np.ndarray:
        word = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.counts[level][word] + np.bitwise_count(self.words[level][word] & mask)

    def _down(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        for level in range(self.levels):
            ones, bit = self._ones(level, i), (c >> (self.levels - 1 - level)) & 1
            i = np.where(bit == 1, self.zeros[level] + ones, i - ones)
        return i

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of c among the first i."""
        return self._down(c, i) - self.base[c]

    def access(self, i: np.ndarray) -> np.ndarray:
        c = np.zeros(len(i), np.int64)
        for level in range(self.levels):
            bit = ((self.words[level][i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1)).astype(np.int64)
            ones = self._ones(level, i)
            c, i = c * 2 + bit, np.where(bit == 1, self.zeros[level] + ones, i - ones)
        return c


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling; a symbol 0 ends a suffix and is smaller the earlier it stands."""
    n, ends = len(text), text == 0
    rank = np.where(ends, np.cumsum(ends) - 1, text + int(ends.sum()))
    order, reach = np.argsort(rank, kind="stable"), 1
    while True:
        ordered = rank[order]
        new = np.empty(n, np.int64)
        new[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        if new[order[-1]] == n - 1:
            return order
        after = np.zeros(n, np.int64)
        after[: n - reach] = new[reach:] + 1
        after[ends] = 0
        rank = new * (n + 1) + after
        order, reach = np.argsort(rank), reach * 2


class FmIndex:
    """Index of a sequence of symbols 1..size-1 in which 0 separates pieces (and ends the last)."""

    def __init__(self, text: np.ndarray, size: int):
        order = suffix_order(text)
        last = text[order - 1]  # the symbol before each suffix; the whole text's is its end, a 0
        self.rows = WaveletMatrix(last, size)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=size))])
        sampled = (order % SAMPLE == 0) | (last == 0)
        self.sampled, self.positions = np.cumsum(sampled) - 1, order[sampled]
        self.is_sampled, self.n = sampled, len(text)

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges of phrases, given right-aligned in a matrix."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n)
        for back in range(1, phrases.shape[1] + 1):
            live = np.flatnonzero((lengths >= back) & (low < high))
            if not len(live):
                break
            c = phrases[live, -back]
            low[live] = self.before[c] + self.rows.rank(c, low[live])
            high[live] = self.before[c] + self.rows.rank(c, high[live])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text position of each row, by walking backwards to a sampled one."""
        rows, out, left = rows.copy(), np.zeros(len(rows), np.int64), np.arange(len(rows))
        steps = 0
        while len(left):
            done = self.is_sampled[rows]
            out[left[done]] = self.positions[self.sampled[rows[done]]] + steps
            rows, left, steps = rows[~done], left[~done], steps + 1
            c = self.rows.access(rows)
            rows = self.before[c] + self.rows.rank(c, rows)
        return out


@dataclass
class Phrases:
    """Distinct windows as right-aligned word numbers, and the items each belongs to."""

    vocabulary: np.ndarray  # sorted word hashes; a word's number is its place + 1
    windows: np.ndarray
    lengths: np.ndarray
    item_starts: np.ndarray
    item_of: np.ndarray
    items: list[str]


def words_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts behind each other, and each text's number of words."""
    data, offsets = joined(texts)
    data = LOWER[data]
    starts, ends, n = word_spans(data, offsets, ALNUM)
    return span_hashes(data, starts, ends), n


def phrases(rows: list[tuple[str, bytes]], window: int = WINDOW) -> Phrases:
    """Windows of ``window`` words of each item; an item of fewer words is one window."""
    hashes, n = words_of([t for _, t in rows])
    vocabulary, number = np.unique(hashes, return_inverse=True)
    found: dict[tuple, set[int]] = {}
    at = 0
    for item, count in enumerate(n):
        own = (number[at:at + count] + 1).tolist()
        for i in range(max(1, count - window + 1) if count else 0):
            found.setdefault(tuple(own[i:i + window]), set()).add(item)
        at += count
    lengths = np.array([len(w) for w in found], np.int64)
    matrix = np.zeros((len(found), window), np.int64)
    for i, w in enumerate(found):
        matrix[i, window - len(w):] = w
    owners = [sorted(s) for s in found.values()]
    return Phrases(vocabulary, matrix, lengths, np.cumsum([0, *map(len, owners)]),
                   np.array([x for s in owners for x in s], np.int64), [i for i, _ in rows])


def hits(numbers: np.ndarray, n: np.ndarray, p: Phrases) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hit flag of every word of a shard, and the (text, item) pairs found.

    numbers: word numbers of all texts behind each other, 0 for words no phrase has.
    """
    flag, none = np.zeros(len(numbers), bool), np.zeros(0, np.int64)
    if not len(p.lengths) or not len(numbers):
        return flag, none, none
    text_of = np.repeat(np.arange(len(n)), n)
    new = np.ones(len(numbers), bool)
    new[1:] = ((numbers[1:] == 0) != (numbers[:-1] == 0)) | (text_of[1:] != text_of[:-1])
    starts = np.flatnonzero(new)
    sizes = np.diff(np.append(starts, len(numbers)))
    kept = (numbers[starts] > 0) & (sizes >= p.lengths.min())
    starts, sizes = starts[kept], sizes[kept]
    if not len(starts):
        return flag, none, none
    own = csr_rows(starts, sizes)                    # word behind each symbol
    text = np.zeros(len(own) + len(starts), np.int64)
    symbol = np.arange(len(own)) + np.repeat(np.arange(len(starts)), sizes)
    text[symbol] = numbers[own]                      # a 0 behind every run
    word = np.zeros(len(text), np.int64)
    word[symbol] = own
    present, compact = np.unique(text, return_inverse=True)
    wanted = np.searchsorted(present, p.windows)
    wanted[wanted == len(present)] = 0
    possible = np.flatnonzero(((present[wanted] == p.windows) | (p.windows == 0)).all(1))
    if not len(possible):
        return flag, none, none
    index = FmIndex(compact, len(present))
    low, high = index.search(wanted[possible], p.lengths[possible])
    depth, texts, items = np.zeros(len(numbers) + 1, np.int64), [none], [none]
    live = np.flatnonzero(high > low)
    for group in np.array_split(live, max(1, int((high - low)[live].sum()) >> 18)):
        many = (high - low)[group]
        at = word[index.locate(csr_rows(low[group], many))]
        window = np.repeat(possible[group], many)
        np.add.at(depth, at, 1)
        np.add.at(depth, at + p.lengths[window], -1)
        owners = p.item_starts[window + 1] - p.item_starts[window]
        pair = np.unique(np.repeat(text_of[at], owners) * len(p.items)
                         + p.item_of[csr_rows(p.item_starts[window], owners)]) if len(at) else none
        texts.append(pair // len(p.items))
        items.append(pair % len(p.items))
    pair = np.unique(np.concatenate(texts) * len(p.items) + np.concatenate(items))
    return np.cumsum(depth[:-1]) > 0, pair // len(p.items), pair % len(p.items)


def _runs(flag: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flag.view(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist()))


FOUND = [("n_words", "long"), ("spans", "array<struct<start:int,end:int>>"), ("items", "array<string>")]


def _pass(rows: DataFrame, p: Phrases, place: int, cut: bool = False) -> DataFrame:
    """One pass over texts (column number ``place``), adding to the last three columns.

    cut: the passages found so far leave the text in the same task, so that it needs no second worker.
    """
    shared = rows.sparkSession.sparkContext.broadcast(p)  # PASS_WORDS bounds it

    def results(parts, hashes, counts, p):
        n = np.concatenate(counts)
        at = np.searchsorted(p.vocabulary, words := np.concatenate(hashes))
        at[at == len(p.vocabulary)] = 0
        numbers = np.where(p.vocabulary[at] == words, at + 1, 0) if len(p.vocabulary) else np.zeros(len(words), np.int64)
        flag, texts, items = hits(numbers, n, p)
        ends, row = np.cumsum(n), 0
        first, last = np.searchsorted(texts, np.arange(len(n))), np.searchsorted(texts, np.arange(len(n)), "right")
        for part in parts:
            spans, owners = part.column(part.num_columns - 2).to_pylist(), part.column(part.num_columns - 1).to_pylist()
            for i in range(part.num_rows):
                if last[row] > first[row]:
                    own = flag[ends[row] - n[row]:ends[row]].copy()
                    for s in spans[i]:
                        own[s["start"]:s["end"]] = True
                    spans[i] = [{"start": a, "end": b} for a, b in _runs(own)]
                    owners[i] = sorted({*owners[i], *(p.items[x] for x in items[first[row]:last[row]])})
                row += 1
            own_n = pa.array(n[row - part.num_rows:row])
            kind = part.schema.field(part.num_columns - 2).type
            columns = [*part.columns[:-3], own_n, pa.array(spans, kind), pa.array(owners, pa.list_(pa.string()))]
            if cut:
                columns[place] = _without(part.column(place), spans)
            yield pa.RecordBatch.from_arrays(columns, names=part.schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, parts, hashes, counts, words, size = shared.value, [], [], [], 0, 0
        for batch in batches:
            for part in slices(batch, place):
                texts = text_bytes(part.column(place))
                own, n = words_of(texts)
                parts.append(part), hashes.append(own), counts.append(n)
                words, size = words + len(own), size + sum(map(len, texts))
                if size >= SHARD_BYTES or words >= 8 * SHARD_WORDS:
                    yield from results(parts, hashes, counts, p)
                    parts, hashes, counts, words, size = [], [], [], 0, 0
        if parts:
            yield from results(parts, hashes, counts, p)

    return rows.mapInArrow(run, rows.schema)


def find(docs: DataFrame, tests: DataFrame, text: str = "text", item_id: str = "item_id",
         test_text: str = "text", window: int = WINDOW, cut: bool = False) -> DataFrame:
    """All columns of docs, n_words, spans (merged hit words, start to end) and items (sorted ids).

    cut: the spans are cut from the text as by ``remove_spans``, in the tasks that find them.

    Test texts are read in passes of at most PASS_WORDS words, so tests of any size work. Null or
    wordless texts have no words and no hits, null or wordless items no windows; repeated items
    count as one id, repeated documents are judged alike. Columns of docs named like the new ones
    are replaced.
    """
    docs = docs.drop(*(n for n, _ in FOUND if n in docs.columns))
    place = docs.columns.index(text)
    rows = docs.withColumns({"n_words": F.lit(None).cast("long"), "spans": F.array().cast(FOUND[1][1]),
                             "items": F.array().cast("array<string>")})
    items = tests.select(F.col(item_id).cast("string").alias("i"), F.col(test_text).alias("t"))
    block, size = [], 0
    for row in items.filter("i IS NOT NULL").orderBy("i").toLocalIterator():
        item = (row["i"], (row["t"] or "").encode())
        block.append(item)
        size += len(words_of([item[1]])[0])
        if size >= PASS_WORDS:
            rows, block, size = _pass(rows, phrases(block, window), place), [], 0
    return _pass(rows, phrases(block, window), place, cut)


def _without(column: pa.Array, spans: list[list[dict]]) -> pa.Array:
    """The texts without the words of their spans, first to last byte of each."""
    texts = column.to_pylist()
    for i, s in enumerate(spans):
        if s:
            raw = texts[i].encode()
            data, offsets = joined([raw])
            starts, ends, _ = word_spans(LOWER[data], offsets, ALNUM)
            kept, at = [], 0
            for x in s:
                kept.append(raw[at:starts[x["start"]]])
                at = ends[x["end"] - 1]
            texts[i] = b"".join([*kept, raw[at:]]).decode()
    return pa.array(texts, pa.string())


def remove_spans(found: DataFrame, text: str = "text") -> DataFrame:
    """The result of ``find`` with the hit words, first to last byte of each span, cut from the text."""
    place, spans = found.columns.index(text), found.columns.index("spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, place):
                columns = part.columns
                columns[place] = _without(part.column(place), part.column(spans).to_pylist())
                yield pa.RecordBatch.from_arrays(columns, names=part.schema.names)

    return found.mapInArrow(run, found.schema)


def op4_fm_decontaminate(spark, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = find(docs, table(spark, folder, "benchmark")).drop("text")
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


SQL = r"""
WITH dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
bw AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS g
    FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM bw WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
grams AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS g
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, sizes WHERE len(w) >= n)),
occ AS (SELECT doc_id, item_id, i, grams.n FROM grams JOIN win ON grams.g = win.g AND grams.n = win.n),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM occ) GROUP BY 1),
its AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(x, ',' ORDER BY x)) AS s
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS x FROM occ) GROUP BY 1)
SELECT dw.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    coalesce(s, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hit ON dw.doc_id = hit.doc_id LEFT JOIN its ON dw.doc_id = its.doc_id"""
