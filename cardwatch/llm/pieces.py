"""SentencePiece encoding with N-best segmentations, and decoding.

A text is a lattice whose arcs are vocabulary pieces. The forward Viterbi score of a position is
the exact best score of any way to reach it, so a backward A* search from the end that adds it to
the score of the pieces behind pops complete segmentations best first. Every path passes between two
characters that no piece has side by side, so a text's lattice is a chain of small ones ("words").
Only the words whose second best way costs least can differ in the text's N best; those are searched,
the others take their Viterbi path.

A vocabulary without probabilities (BPE: scores are merge ranks) gets the Zipf-Mandelbrot law's
log-probability of its rank. Scores are whole millionths of a nat, so sums and ties are exact.
"""
from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwatch.llm.common import SpanHashes, csr_rows, slices, span_hashes, table

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
N_BEST = 4
UNIT = 1_000_000
#: Nats by which a byte of a character without a piece is worse than the worst piece.
PENALTY = 10
#: Distinct words a worker remembers before it starts anew.
REMEMBERED = 250_000
#: New words whose lattices are solved together.
TOGETHER = 4000
SLICE = 1 << 19
_LUT, _PAIRS, _MIX = 22, 22, 7919
_NEVER = np.int64(-(1 << 60))


@dataclass
class Vocabulary:
    """Pieces with a space for the word mark; scores in units; ids of the 256 byte pieces."""

    pieces: list[str | None]  # None: control, unknown and byte pieces
    scores: np.ndarray
    byte_ids: np.ndarray
    table: dict[str, int] = field(default_factory=dict)

    def __post_init__(self):
        self.table = {p: i for i, p in enumerate(self.pieces) if p}
        self.longest = max(map(len, self.table), default=1)
        self.byte_score = int(self.scores[list(self.table.values())].min()) - PENALTY * UNIT if self.table else -PENALTY * UNIT
        self.pairs = np.zeros(1 << _PAIRS, bool)  # neighbours in some piece; a clash only joins words
        for p in self.table:
            for a, b in zip(p, p[1:]):
                self.pairs[(ord(a) * _MIX + ord(b)) & ((1 << _PAIRS) - 1)] = True
        raw = [p.encode() if p else b"" for p in self.pieces]
        for value, i in enumerate(self.byte_ids.tolist()):
            raw[i] = bytes([value])
        self.raw, self.raw_size = np.frombuffer(b"".join(raw), np.uint8), np.array([len(r) for r in raw], np.int64)
        self.raw_start = np.cumsum(self.raw_size) - self.raw_size
        names = list(self.table)
        points, ends = _points(names)
        hashes = span_hashes(points, ends[:-1], ends[1:])
        order = np.argsort(hashes)
        self.hashes, self.hash_ids = hashes[order], np.array([self.table[p] for p in names], np.int64)[order]
        self.maybe = np.zeros(1 << _LUT, bool)
        self.maybe[(hashes >> np.uint64(64 - _LUT)).astype(np.intp)] = True

    def words(self, texts: list[str]) -> list[list[str]]:
        """Each text with its first space, cut between characters that no piece has side by side:
        every path of the text's lattice passes there."""
        own = [" " + t if t else "" for t in texts]
        points, ends = _points(own)
        if not len(points):
            return [[] for _ in own]
        cut = ~self.pairs[(points[:-1].astype(np.int64) * _MIX + points[1:]) & ((1 << _PAIRS) - 1)]
        at = np.flatnonzero(cut) + 1
        first, last = np.searchsorted(at, ends[:-1], "right"), np.searchsorted(at, ends[1:])
        at = at.tolist()
        out = []
        for t, start, a, b in zip(own, ends.tolist(), first.tolist(), last.tolist()):
            stops = [x - start for x in at[a:b]]
            out.append([t[x:y] for x, y in zip([0, *stops], [*stops, len(t)])] if t else [])
        return out

    def __reduce__(self):
        return Vocabulary, (self.pieces, self.scores, self.byte_ids)


def load(path: str = MODEL, offset: float = 2.7) -> Vocabulary:
    """Vocabulary of a SentencePiece model with byte fallback (read on the driver)."""
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i) for i in range(n)]
    pieces = [None if special[i] else sp.id_to_piece(i).replace("▁", " ") for i in range(n)]
    scores = np.array([sp.get_score(i) for i in range(n)])
    normal = np.flatnonzero(~np.array(special))
    if np.all(scores[normal] == np.round(scores[normal])):  # ranks, not log-probabilities
        rank = -scores[normal]
        scores[normal] = -np.log(rank + offset) - np.log((1 / (rank + offset)).sum())
    byte_ids = np.array([sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)])
    if not all(sp.is_byte(int(i)) for i in byte_ids):
        raise ValueError("the model has no byte fallback, so texts could not be restored")
    return Vocabulary(pieces, np.round(scores * UNIT).astype(np.int64), byte_ids)


def _points(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
    return points, np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64)


# One word: forward Viterbi, backward A* -----------------------------------------------------------

def arcs_to(word: str, v: Vocabulary) -> list[list[tuple[int, tuple[int, ...], int]]]:
    """For every position, the arcs that end there: start, piece ids, score."""
    arcs = [[] for _ in range(len(word) + 1)]
    for i in range(len(word)):
        for j in range(i + 1, min(len(word), i + v.longest) + 1):
            piece = v.table.get(word[i:j])
            if piece is not None:
                arcs[j].append((i, (piece,), int(v.scores[piece])))
            elif j == i + 1:
                raw = word[i:j].encode()
                arcs[j].append((i, tuple(v.byte_ids[list(raw)].tolist()), v.byte_score * len(raw)))
    return arcs


def n_best(word: str, v: Vocabulary, n: int) -> list[tuple[int, tuple[int, ...]]]:
    """The n best segmentations, (score, ids), best first; fewer if there are fewer.

    No position needs to be popped more than n times: its n best continuations come first.
    """
    arcs, forward = arcs_to(word, v), [0]
    for own in arcs[1:]:
        forward.append(max(forward[i] + s for i, _, s in own))
    heap, pops, found, tie = [(-forward[-1], len(word), 0, 0, None)], [0] * (len(word) + 1), [], 0
    while heap and len(found) < n:
        _, at, _, behind, path = heapq.heappop(heap)
        pops[at] += 1
        if at == 0:
            ids = []
            while path:
                ids += path[0]
                path = path[1]
            found.append((behind, tuple(ids)))
        elif pops[at] <= n:
            for start, ids, score in arcs[at]:
                tie += 1
                heapq.heappush(heap, (-(behind + score + forward[start]), start, tie, behind + score, (ids, path)))
    return found


# Many words at once: Viterbi both ways -------------------------------------------------------------

def _relax(level: np.ndarray, source: np.ndarray, target: np.ndarray, score: np.ndarray, value: np.ndarray, first: np.ndarray):
    """Best value of every target, level by level, and the arc it comes by (smallest ``first`` on ties)."""
    by = np.full(len(value), -1)
    if (int(level.max(initial=0)) + 1) * len(value) ** 2 < 1 << 63:
        order = np.argsort((level * len(value) + target) * len(value) + first)
    else:  # a run of millions of characters: one number cannot hold the key
        order = np.lexsort((first, target, level))
    cuts = np.searchsorted(level[order], np.arange(1, level.max() + 2)) if len(level) else [0]
    source, target, score = source[order], target[order], score[order]
    for a, b in zip(cuts[:-1], cuts[1:]):
        if a == b:
            continue
        reached, at = value[source[a:b]] + score[a:b], target[a:b]
        new = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
        best = np.maximum.reduceat(reached, new)
        value[at[new]] = best
        place = np.where(reached == np.repeat(best, np.diff(np.append(new, b - a))), np.arange(a, b), b)
        by[at[new]] = order[np.minimum.reduceat(place, new)]
    return by


def viterbi(words: list[str], v: Vocabulary):
    """Best segmentation of each word: ids behind each other, their numbers, scores, and what the
    second best segmentation costs more (-1 if there is none)."""
    points, ends = _points(words)
    n_words, size = len(words), np.diff(ends)
    word_of = np.repeat(np.arange(n_words), size)
    stop = ends[1:][word_of]
    at, starts, stops, ids = np.arange(len(points)), [], [], []
    prefix = SpanHashes(points)
    for length in range(1, v.longest + 1):
        at = at[at + length <= stop[at]]
        if not len(at):
            break
        hashes = prefix(at, at + length)
        some = np.flatnonzero(v.maybe[(hashes >> np.uint64(64 - _LUT)).astype(np.intp)])
        place = np.searchsorted(v.hashes, hashes[some])
        place[place == len(v.hashes)] = 0
        same = v.hashes[place] == hashes[some] if len(v.hashes) else np.zeros(0, bool)
        found = np.full(len(at), -1)
        found[some[same]] = v.hash_ids[place[same]]
        take = np.arange(len(at)) if length == 1 else np.flatnonzero(found >= 0)
        starts.append(at[take]), stops.append(at[take] + length), ids.append(found[take])
    start, stop, piece = np.concatenate(starts), np.concatenate(stops), np.concatenate(ids)
    point = points[start].astype(np.int64)
    n_bytes = np.where(piece >= 0, 1, 1 + (point > 0x7F) + (point > 0x7FF) + (point > 0xFFFF))
    score = np.where(piece >= 0, v.scores[piece], v.byte_score * n_bytes)
    word = word_of[start]
    u, w = start + word, stop + word                   # a word of L characters has L + 1 nodes
    first, last = ends[:-1] + np.arange(n_words), ends[1:] + np.arange(n_words)
    nodes = int(last[-1]) + 1
    ahead, behind = np.full(nodes, _NEVER), np.full(nodes, _NEVER)
    ahead[first], behind[last] = 0, 0
    by = _relax(w - first[word], u, w, score, ahead, u)
    _relax(last[word] - u, w, u, score, behind, w)
    chosen, node, live = [], last.copy(), np.arange(n_words)
    while len(live):
        arc = by[node[live]]
        chosen.append(arc)
        node[live] = u[arc]
        live = live[node[live] > first[live]]
    path = np.concatenate(chosen)
    path = path[np.lexsort((start[path], word[path]))]
    off = np.ones(len(start), bool)
    off[path] = False
    through, best = np.full(n_words, _NEVER), ahead[last]
    np.maximum.at(through, word[off], (ahead[u] + score + behind[w])[off])
    gap = np.where(through > _NEVER // 2, best - through, -1)
    ids = piece[path]
    unknown = np.flatnonzero(ids < 0)
    if len(unknown):
        counts = n_bytes[path]
        ids = np.repeat(ids, counts)
        raw = "".join(map(chr, point[path[unknown]].tolist())).encode()
        ids[ids < 0] = v.byte_ids[np.frombuffer(raw, np.uint8)]
    else:
        counts = np.ones(len(path), np.int64)
    return ids.astype(np.int32), np.bincount(word[path], counts, n_words).astype(np.int64), best, gap


class Encoder:
    """Remembers the words a worker has seen: their ids, scores and costs of a second best way."""

    def __init__(self, v: Vocabulary, n: int):
        self.v, self.n = v, n
        self._forget()

    def _forget(self):
        self.number: dict[str, int] = {}
        self.others: dict[str, list] = {}
        self.ids, self.start, self.size = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.best, self.gap = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _learn(self, words: list[str]):
        for a in range(0, len(words), TOGETHER):
            own = words[a:a + TOGETHER]
            ids, size, best, gap = viterbi(own, self.v)
            self.number.update(zip(own, range(len(self.number), len(self.number) + len(own))))
            self.start = np.concatenate([self.start, len(self.ids) + np.cumsum(size) - size])
            self.ids = np.concatenate([self.ids, ids])
            self.size, self.best, self.gap = (np.concatenate(p) for p in ((self.size, size), (self.best, best), (self.gap, gap)))

    def _alternatives(self, word: str) -> list[tuple[int, tuple[int, ...]]]:
        """The other segmentations of a word: what each costs more, and its ids."""
        if word not in self.others:
            k = self.number[word]
            top = tuple(self.ids[self.start[k]:self.start[k] + self.size[k]].tolist())
            found = [(int(self.best[k]) - s, ids) for s, ids in n_best(word, self.v, self.n) if ids != top]
            self.others[word] = found[: self.n - 1]
        return self.others[word]

    def encode(self, texts: list[str]):
        """Ids behind each other, their numbers, best scores, and per text the other N-best as
        (cost, edits); an edit replaces ``count`` ids from ``at`` on."""
        if len(self.number) > REMEMBERED:
            self._forget()
        words = self.v.words(texts)
        new = set(chain.from_iterable(words)).difference(self.number)
        if new:
            self._learn(sorted(new))
        n_words = np.array([len(w) for w in words], np.int64)
        number = np.fromiter(map(self.number.__getitem__, chain.from_iterable(words)), np.int64, int(n_words.sum()))
        sizes = self.size[number]
        ids = self.ids[csr_rows(self.start[number], sizes)]
        ends = np.concatenate([[0], np.cumsum(n_words)])
        places = np.concatenate([[0], np.cumsum(sizes)])
        totals = np.concatenate([[0], np.cumsum(self.best[number])])
        others = [self._combined(words[i], number[a:b], places[a:b] - places[a])
                  for i, (a, b) in enumerate(zip(ends[:-1], ends[1:]))]
        return ids, places[ends[1:]] - places[ends[:-1]], totals[ends[1:]] - totals[ends[:-1]], others

    def _combined(self, words: list[str], number: np.ndarray, places: np.ndarray):
        """The N-best of a chain of words: only the n - 1 words with the cheapest second ways matter,
        for these alone give n - 1 texts that are no worse than any other."""
        gap = self.gap[number]
        free = np.flatnonzero(gap >= 0)
        if len(free) > self.n - 1 > 0:
            limit = np.partition(gap[free], self.n - 2)[self.n - 2]
            free = free[gap[free] <= limit]
            free = free[np.argsort(gap[free], kind="stable")][: self.n - 1]
        ways = [(0, ())]
        for w in sorted(free.tolist()) if self.n > 1 else []:
            edits = [(cost, ((int(places[w]), int(self.size[number[w]]), ids),)) for cost, ids in self._alternatives(words[w])]
            ways = heapq.nsmallest(self.n, [(c + d, p + e) for c, p in ways for d, e in [(0, ()), *edits]])
        return ways[1:]


ENCODED = ("ids array<int>, score double, "
           "others array<struct<score:double,edits:array<struct<at:int,count:int,ids:array<int>>>>>")


def encode(docs: DataFrame, v: Vocabulary, keep: list[str], text: str = "text", n: int = N_BEST) -> DataFrame:
    """The kept columns, ids and score (nats) of the best segmentation of the whole text, and the
    next n - 1 as scores with edits of the best ids.

    Null and empty texts have no ids, score 0 and no others. Segmentations of equal score come in a
    fixed order. ``expanded`` gives the others' ids in full.
    """
    shared, k = docs.sparkSession.sparkContext.broadcast(v), len(keep)  # the vocabulary file's pieces
    place = keep.index(text) if text in keep else k

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared, n)
        for batch in batches:
            for part in slices(batch, place, SLICE):
                ids, sizes, best, others = encoder.encode([t or "" for t in part.column(place).to_pylist()])
                lists = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32), pa.array(ids))
                rows = [[{"score": (b - cost) / UNIT, "edits": [{"at": a, "count": c, "ids": list(x)} for a, c, x in edits]}
                         for cost, edits in own] for b, own in zip(best.tolist(), others)]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:k], lists, pa.array(best / UNIT), pa.array(rows, _OTHERS)],
                    names=[*part.schema.names[:k], "ids", "score", "others"])

    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.select(*keep).schema)
    rows = docs.select(*keep) if place < k else docs.select(*keep, F.col(text).alias("_text"))
    return rows.mapInArrow(run, kept + ENCODED)


_OTHERS = pa.list_(pa.struct([("score", pa.float64()), ("edits", pa.list_(pa.struct(
    [("at", pa.int32()), ("count", pa.int32()), ("ids", pa.list_(pa.int32()))])))]))
_ENCODERS: dict = {}


def _encoder(shared, n: int) -> Encoder:
    """The worker's encoder: it keeps what it remembers from task to task."""
    if (shared.id if hasattr(shared, "id") else id(shared), n) not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[(shared.id if hasattr(shared, "id") else id(shared), n)] = Encoder(shared.value, n)
    return next(iter(_ENCODERS.values()))


def expanded(ids: np.ndarray, edits: list[dict]) -> np.ndarray:
    """Ids of another segmentation: the best ids with its edits."""
    parts, at = [], 0
    for e in edits:
        parts += [ids[at:e["at"]], np.array(e["ids"], ids.dtype)]
        at = e["at"] + e["count"]
    return np.concatenate([*parts, ids[at:]])


def decoded(ids: np.ndarray, v: Vocabulary) -> bytes:
    """Bytes of the ids' text; the space in front of the first word is not part of it."""
    return _raw(ids, v)[1:]


def _raw(ids: np.ndarray, v: Vocabulary) -> bytes:
    return v.raw[csr_rows(v.raw_start[ids], v.raw_size[ids])].tobytes()


def decode(encoded: DataFrame, v: Vocabulary, keep: list[str]) -> DataFrame:
    """The kept columns, text, n_pieces, and sha256 (of the ids as 4-byte little-endian numbers) and
    same (its pieces spell that text) of every segmentation, best first. Null ids are no text (null)."""
    shared, k = encoded.sparkSession.sparkContext.broadcast(v), len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared.value
        for batch in batches:
            texts, sizes, digests, same = [], [], [], []
            for best, others in zip(batch.column(k), batch.column(k + 1).to_pylist()):
                if not best.is_valid:
                    texts.append(None), sizes.append(None), digests.append([]), same.append([])
                    continue
                ids = best.values.to_numpy(zero_copy_only=False).astype("<i4")
                raw, own, digest = decoded(ids, v), [True], [hashlib.sha256(ids.tobytes()).hexdigest()]
                for other in others or []:
                    changed = expanded(ids, other["edits"])
                    digest.append(hashlib.sha256(changed.tobytes()).hexdigest())
                    own.append(all(_raw(ids[e["at"]:e["at"] + e["count"]], v) == _raw(np.array(e["ids"]), v) for e in other["edits"]))
                texts.append(raw.decode()), sizes.append(len(ids)), digests.append(digest), same.append(own)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:k], pa.array(texts, pa.string()), pa.array(sizes, pa.int64()),
                 pa.array(digests, pa.list_(pa.string())), pa.array(same, pa.list_(pa.bool_()))],
                names=[*batch.schema.names[:k], "decoded", "n_pieces", "sha256", "same"])

    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in encoded.select(*keep).schema)
    return encoded.select(*keep, "ids", "others").mapInArrow(
        run, kept + "decoded string, n_pieces long, sha256 array<string>, same array<boolean>")


def op1_sentencepiece(spark, folder: str) -> DataFrame:
    """Encode every document, decode every segmentation again, compare with the text."""
    v, docs = load(), table(spark, folder, "documents").select("doc_id", "text")
    scores = F.concat(F.array("score"), F.transform("others", lambda x: x["score"])).alias("nbest_scores")
    encoded = encode(docs.withColumn("own", F.sha2(F.coalesce("text", F.lit("")), 256)), v, ["doc_id", "own"])
    back = decode(encoded.select("doc_id", "own", "score", scores, "ids", "others"), v, ["doc_id", "own", "score", "nbest_scores"])
    return back.select("doc_id", "n_pieces", "score", "nbest_scores", F.col("sha256").alias("nbest_sha256"),
                       ((F.sha2("decoded", 256) == F.col("own")) & F.forall("same", lambda x: x)).alias("round_trip"))
