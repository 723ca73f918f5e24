"""N-best segmentation over a SentencePiece lattice, and decoding.

A text's lattice has an edge for every piece that its characters spell and, for a character that no
piece spells alone, a fallback edge to its bytes. Forward Viterbi scores are the exact heuristic of a
backward A* search, which then yields segmentations in order of their total piece score.

The lattice falls apart at spaces and line ends, which no piece crosses, so both searches run on the
parts between and each worker keeps the parts it has seen. Viterbi (best and second-best score) runs
over all new parts at once in numpy. The N best of a whole text change only the N - 1 part occurrences
whose second best costs least: a segmentation that changes another part is beaten by N others. A*
lists the N best of those parts and a heap merges their sums.
"""

from __future__ import annotations

import heapq
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _BASE, _BASE_INVERSE, _power, mix64, slices, text_or_empty, tidy, utf8

SPACE = "▁"
_PART = re.compile(r" *[^ \n]+|\n| +")
FALLBACK_PENALTY = 10.0
_FAR = -1e18
MAX_PARTS, MAX_PIECE_IDS = 600_000, 6_000_000


class Lattice:
    """The vocabulary as hashed pieces, and the searches over texts."""

    def __init__(self, model_path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
        n = sp.get_piece_size()
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) for i in range(n)]
        self.byte_ids = {int(sp.id_to_piece(i)[3:5], 16): i for i in range(n) if sp.is_byte(i)}
        self.unknown = sp.unk_id()
        self.surface = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else b"" if special[i] else sp.id_to_piece(i).replace(SPACE, " ").encode() for i in range(n)]
        own = [i for i in range(n) if not special[i] and not sp.is_byte(i)]
        pieces = [sp.id_to_piece(i).replace(SPACE, " ") for i in own]
        self.crossing = any((" " in p.lstrip(" ")) or ("\n" in p and p != "\n") for p in pieces)
        scores = np.array([sp.get_score(i) for i in own])
        self.fallback = float(scores[scores > -1e8].min()) - FALLBACK_PENALTY
        self.longest = max(map(len, pieces))
        codes, starts, ends = _codes(pieces)
        h = _span_hashes(codes, starts, ends)
        order = np.argsort(h)
        self.hash, self.id, self.score = h[order], np.array(own)[order], scores[order]
        self.table = {p: (float(s), i) for p, s, i in zip(pieces, scores, own)}
        self.sieve = np.zeros(1 << 20, bool)
        self.sieve[(h >> np.uint64(44)).astype(np.int64)] = True
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.starts = np.zeros(1, np.int64)
        self.flat = np.zeros(0, np.uint32)
        self.best, self.cost = np.zeros(0), np.zeros(0)
        self.lists: dict[str, list] = {}

    def parts(self, text: str) -> list[str]:
        """The text with its leading space, cut where no piece crosses."""
        return [" " + text] if self.crossing else _PART.findall(" " + text)

    def edges(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """First codes of the parts, their lengths, and per length - 1 and code: score and id of the edge from there."""
        codes, starts, ends = _codes(parts)
        n = len(codes)
        cum = np.zeros(n + 1, np.uint64)
        np.cumsum(mix64(codes.astype(np.uint64) + np.uint64(1)) * _power(_BASE, n)[:n], dtype=np.uint64, out=cum[1:])
        inverse = _power(_BASE_INVERSE, n)
        left = np.repeat(ends, ends - starts) - np.arange(n)  # codes up to the part's end
        score, which = np.full((self.longest, n), _FAR), np.full((self.longest, n), -1, np.int32)
        for size in range(1, self.longest + 1):
            if size > n:
                break
            at = np.flatnonzero(left >= size)
            h = mix64((cum[at + size] - cum[at]) * inverse[at] + np.uint64(size))
            maybe = self.sieve[(h >> np.uint64(44)).astype(np.int64)]
            at, h = at[maybe], h[maybe]
            place = np.minimum(np.searchsorted(self.hash, h), len(self.hash) - 1)
            hit = self.hash[place] == h
            score[size - 1, at[hit]], which[size - 1, at[hit]] = self.score[place[hit]], self.id[place[hit]]
        alone = which[0] < 0
        score[0, alone] = self.fallback
        return starts, ends - starts, score, which

    def viterbi(self, parts: list[str]):
        """Per part the best score, what the second best loses, and (ids one part after another, first id)."""
        starts, lengths, score, which = self.edges(parts)
        order = np.argsort(-lengths, kind="stable")
        base, size = starts[order] + np.arange(len(parts))[order], lengths[order]  # a place more per part
        code = starts[order]
        first = np.full(int(lengths.sum()) + len(parts), _FAR)
        second, choice = first.copy(), np.zeros(len(first), np.int32)
        first[base] = 0.0
        live = len(parts)
        for j in range(1, int(size[0]) + 1 if len(size) else 0):
            while live and size[live - 1] < j:
                live -= 1
            b, c = base[:live], code[:live]
            top, runner, taken = np.full(live, _FAR), np.full(live, _FAR), np.zeros(live, np.int32)
            for step in range(1, min(self.longest, j) + 1):
                s = score[step - 1, c + j - step]
                if s.max() <= _FAR:
                    continue
                one, two = first[b + j - step] + s, second[b + j - step] + s
                runner = np.maximum(np.maximum(runner, two), np.minimum(top, one))
                better = one > top
                taken[better] = step
                top = np.maximum(top, one)
            first[b + j], second[b + j], choice[b + j] = top, runner, taken
        end = base + size
        best, cost = np.empty(len(parts)), np.empty(len(parts))
        best[order] = first[end]
        cost[order] = np.where(second[end] > _FAR / 2, first[end] - second[end], np.inf)
        # Back along the choices, all parts at once.
        at, of = size.copy(), order
        b, c = base, code
        steps_of, steps_at, steps_id = [], [], []
        while len(at):
            step = choice[b + at]
            at = at - step
            steps_of.append(of)
            steps_at.append(at)
            steps_id.append(which[step - 1, c + at])
            more = at > 0
            at, of, b, c = at[more], of[more], b[more], c[more]
        of, at, ids = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (steps_of, steps_at, steps_id))
        sort = np.lexsort((at, of))
        of, at, ids = of[sort], at[sort], ids[sort]
        if (ids < 0).any():
            flat: list[int] = []
            count = np.ones(len(ids), np.int64)
            low = 0
            for k in np.flatnonzero(ids < 0).tolist():
                flat += ids[low:k].tolist()
                raw = self.bytes_of(parts[of[k]][at[k]])
                flat += raw
                count[k] = len(raw)
                low = k + 1
            flat += ids[low:].tolist()
            ids, of = np.array(flat), np.repeat(of, count)
        return best, cost, ids.astype(np.uint32), np.searchsorted(of, np.arange(len(parts) + 1))

    def bytes_of(self, character: str) -> list[int]:
        return [self.byte_ids.get(b, self.unknown) for b in character.encode("utf-8", "surrogatepass")]

    def a_star(self, part: str, n: int) -> list[tuple[float, list[int]]]:
        """The n best segmentations of a part, best first; equal scores: shorter last pieces first.

        A path is a chain of steps to their parents, and a step's rivals wait in their order until it has been taken, so that
        memory follows the part's length.
        """
        length = len(part)
        forward = [0.0] + [_FAR] * length
        piece = lambda j, size: self.table.get(part[j - size : j], (self.fallback if size == 1 else _FAR, -1))
        for j in range(1, length + 1):
            forward[j] = max(forward[j - size] + piece(j, size)[0] for size in range(1, min(self.longest, j) + 1))

        def below(parent: _Step) -> _Step | None:
            """The best step back from where a step begins, which leads to its rivals."""
            at, done, ways = parent.at, parent.done, []
            for size in range(1, min(self.longest, at) + 1):
                s, which_id = piece(at, size)
                if s > _FAR and forward[at - size] > _FAR / 2:
                    ways.append((-(done + s + forward[at - size]), size, done + s, which_id))
            ways.sort(reverse=True)  # the last is the best
            return _Step(parent, at, ways) if ways else None

        root = _Step(None, length, None)
        heap = [first] if length and (first := below(root)) else []
        found = [] if length else [(0.0, [])]
        while heap and len(found) < n:
            step = heapq.heappop(heap)
            if step.rivals:
                heapq.heappush(heap, _Step(step.parent, step.end, step.rivals))
            step.rivals = None
            if step.at:
                then = below(step)
                if then:
                    heapq.heappush(heap, then)
                continue
            ids, node = [], step
            while node is not root:
                ids += [node.id] if node.id >= 0 else self.bytes_of(part[node.at])
                node = node.parent
            found.append((step.done, ids))
        return found

    def learn(self, parts: list[str]) -> None:
        new = [p for p in dict.fromkeys(parts) if p not in self.index]
        if new:
            best, cost, ids, first = self.viterbi(new)
            self.index.update(zip(new, range(len(self.index), len(self.index) + len(new))))
            self.starts = np.concatenate([self.starts, self.starts[-1] + first[1:]])
            self.flat = np.concatenate([self.flat, ids])
            self.best, self.cost = np.concatenate([self.best, best]), np.concatenate([self.cost, cost])

    def encode(self, texts: list[str], n: int = 1):
        """Per text a list of up to n (score, ids), best first."""
        if len(self.index) > MAX_PARTS or len(self.flat) > MAX_PIECE_IDS:
            self.clear()
        found = [self.parts(t) if t else [] for t in texts]
        flat = [p for x in found for p in x]
        self.learn(flat)
        rows = np.fromiter(map(self.index.__getitem__, flat), np.int64, len(flat))
        lengths = self.starts[rows + 1] - self.starts[rows]
        total = np.concatenate([[0], np.cumsum(lengths)])
        ids = self.flat[np.repeat(self.starts[rows] - total[:-1], lengths) + np.arange(total[-1])]
        score = np.concatenate([[0.0], np.cumsum(self.best[rows])])
        lo = 0
        for own in found:
            hi = lo + len(own)
            best = (float(score[hi] - score[lo]), ids[total[lo] : total[hi]])
            yield [best] if n == 1 or not own else self._merge(own, rows[lo:hi], total[lo : hi + 1] - total[lo], best, n)
            lo = hi

    def _merge(self, parts, rows, first, best, n):
        cost = self.cost[rows]
        few = np.argpartition(cost, n - 2)[: n - 1] if len(cost) > n - 1 else np.arange(len(cost))
        few = sorted(int(i) for i in few if np.isfinite(cost[i]))
        options = []
        for i in few:
            if parts[i] not in self.lists:
                self.lists[parts[i]] = self.a_star(parts[i], n)
            options.append(self.lists[parts[i]][:n])
        start = (0,) * len(few)
        heap, seen, out = [(0.0, start)], {start}, []
        while heap and len(out) < n:
            loss, picks = heapq.heappop(heap)
            if any(picks):
                cut, low = [], 0
                for i, k, option in zip(few, picks, options):
                    if k:
                        cut += [best[1][low : first[i]], np.array(option[k][1], np.uint32)]
                        low = first[i + 1]
                out.append((best[0] - loss, np.concatenate([*cut, best[1][low:]])))
            else:
                out.append(best)
            for j, option in enumerate(options):
                if picks[j] + 1 < len(option):
                    then = (*picks[:j], picks[j] + 1, *picks[j + 1 :])
                    if then not in seen:
                        seen.add(then)
                        heapq.heappush(heap, (loss + option[picks[j]][0] - option[picks[j] + 1][0], then))
        return out

    def decode(self, ids: np.ndarray) -> str:
        """The text of the ids: pieces and fallback bytes joined, without the leading space."""
        raw = b"".join(map(self.surface.__getitem__, ids.tolist()))
        return raw[1:].decode("utf-8", "replace") if raw[:1] == b" " else raw.decode("utf-8", "replace")


class _Step:
    """A piece on a way back from the end of a part, in order of the way's best total, then of its pieces' sizes from the end.

    ``jump`` leads over many steps at once (to an ancestor whose depth follows from this one's alone), so that two ways of any
    length are compared in logarithmic time.
    """

    __slots__ = ("at", "depth", "done", "end", "id", "jump", "loss", "parent", "rivals", "size")

    def __init__(self, parent: _Step | None, end: int, ways: list | None):
        self.parent, self.end, self.rivals = parent, end, ways
        if parent is None:
            self.at, self.depth, self.done, self.jump = end, 0, 0.0, self
            return
        self.loss, self.size, self.done, self.id = ways.pop()
        self.at, self.depth = end - self.size, parent.depth + 1
        over = parent.jump
        self.jump = over.jump if parent.depth - over.depth == over.depth - over.jump.depth else parent

    def _up(self, depth: int) -> _Step:
        while self.depth > depth:
            self = self.jump if self.jump.depth >= depth else self.parent
        return self

    def __lt__(self, other: _Step) -> bool:
        if self.loss != other.loss:
            return self.loss < other.loss
        depth = min(self.depth, other.depth)
        a, b = self._up(depth), other._up(depth)
        if a is b:  # one way begins with the other
            return self.depth < other.depth
        while a.parent is not b.parent:
            a, b = (a.jump, b.jump) if a.jump is not b.jump else (a.parent, b.parent)
        return a.size < b.size


def _codes(parts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    codes = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))
    return codes, np.concatenate([[0], ends[:-1]]).astype(np.int64), ends


def _span_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    n = len(codes)
    cum = np.zeros(n + 1, np.uint64)
    np.cumsum(mix64(codes.astype(np.uint64) + np.uint64(1)) * _power(_BASE, n)[:n], dtype=np.uint64, out=cum[1:])
    return mix64((cum[ends] - cum[starts]) * _power(_BASE_INVERSE, n)[starts] + (ends - starts).astype(np.uint64))


_lattices: dict[str, Lattice] = {}


def lattice(path: str) -> Lattice:
    if path not in _lattices:
        _lattices[path] = Lattice(path)
    return _lattices[path]


RESULT = "doc_id long, round_trip boolean, nbest array<struct<score:double, n_pieces:long, ids_crc32:long>>"


def _segment(path: str, n: int, with_ids: bool):
    entry = [("score", pa.float64()), ("n_pieces", pa.int64()), ("ids_crc32", pa.int64())] + ([("ids", pa.list_(pa.int32()))] if with_ids else [])
    schema = pa.schema([("doc_id", pa.int64()), ("round_trip", pa.bool_()), ("nbest", pa.list_(pa.struct(entry)))])

    def run(batches):
        own = lattice(path)
        for batch in batches:
            _, off = utf8(batch.column("text"))
            for lo, hi in slices(off):
                part = batch.slice(lo, hi - lo)
                texts = part.column("text").to_pylist()
                trips, lists = [], []
                for text, found in zip(texts, own.encode(texts, n)):
                    trips.append(own.decode(found[0][1]) == text)
                    lists.append([{"score": s, "n_pieces": len(ids), "ids_crc32": zlib.crc32(ids.astype("<u4").tobytes())} | ({"ids": ids.tolist()} if with_ids else {}) for s, ids in found])
                yield pa.record_batch([part.column("doc_id"), pa.array(trips), pa.array(lists, schema.field("nbest").type)], schema=schema)

    return run


def segment(docs: DataFrame, model_path: str, n: int = 3, with_ids: bool = False, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The n best segmentations of every whole text, best first, and whether the best decodes to the text.

    A null or empty text has one empty segmentation of score 0. A text with fewer segmentations than n
    lists them all. Repeated ids keep a row each; other columns are ignored.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    return rows.mapInArrow(tidy(_segment(model_path, n, with_ids)), RESULT.replace("ids_crc32:long", "ids_crc32:long, ids:array<int>") if with_ids else RESULT)


def decode(segmented: DataFrame, model_path: str, ids: str = "ids") -> DataFrame:
    """doc_id and the text that an array of piece ids spells; null ids give an empty text."""
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def run(batches):
        own = lattice(model_path)
        for batch in batches:
            yield pa.record_batch([batch.column("doc_id"), pa.array([own.decode(np.array(x or [], np.int64)) for x in batch.column("ids").to_pylist()], pa.string())], schema=schema)

    return segmented.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(ids).alias("ids")).mapInArrow(tidy(run), "doc_id long, text string")
