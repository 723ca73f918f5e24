"""Substring dedup by collinear chaining.

1. Every text is cut into words; a run of six words is a seed if the smallest of their hashes stands at
   its first or last word. The choice depends on nothing but the six words, so an edit beside them
   doesn't undo it, and of equal runs of eleven words one seed at least is shared.
2. Seeds found in more than one document are joined to the first document (smallest id) that holds them.
   Counts are aggregated before the shuffle and the join back is a plain shuffled join that Spark may
   split, so a seed that a third of all documents share is no special case, and no pairs of occurrences
   are made: each occurrence meets one anchor. Runs of two neighbouring seeds are joined in the same way
   to the first document that holds the run, so a passage whose seeds are each found in other, earlier
   documents too still meets the document that holds more of it.
3. Per (document, anchor) the matches are chained in order of both positions: a chain's score is the
   gain of its matches less a cost per word between them, found with a Fenwick tree of prefix maxima
   over the anchor's positions. Chains break at long gaps; one seed is a chain too.
4. Chains are aligned on the words themselves: between seeds by position or by longest common
   subsequence, at the ends by the best-scoring extension. A chain below the identity is split at
   stretches of other words, and each part is tested for itself.
5. Aligned pieces of a document that touch are one passage; passages of at least ``min_words`` words
   are its repeats, whether exact or with edits. The first document to hold a passage keeps it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import each_slice, mix64, ngram_hashes, one_text_each, possible_rows, stored, text_or_empty, tidy, utf8, word_hashes, words

K = 6
RUN_GAP = 24
GAIN, COST = 8.0, 0.15
MAX_GAP = 40
MARGIN = 64
MIN_WORDS, MIN_PIECE, MIN_IDENTITY, JOIN_GAP = 50, 18, 0.8, 3
#: Windows of one text that a task cuts; a text with more is sent to several tasks.
WINDOWS = 2048


def syncmers(h: np.ndarray) -> np.ndarray:
    """Places of the runs of K words whose smallest word hash is the first's or the last's."""
    if len(h) < K:
        return np.zeros(0, np.int64)
    n = len(h) - K + 1
    low = h[:n].copy()
    for j in range(1, K):
        np.minimum(low, h[j : j + n], out=low)
    return np.flatnonzero((low == h[:n]) | (low == h[K - 1 :]))


def _seeds(batches):
    schema = pa.schema([("seed", pa.int64()), ("doc", pa.int64()), ("pos", pa.int32()), ("again", pa.bool_())])
    for batch in batches:
        ids = batch.column("doc_id")
        for lo, hi, data, off in each_slice(batch):
            starts, ends, first = words(data, off)
            h = word_hashes(data, starts, ends)
            grams, at = ngram_hashes(h, K), syncmers(h)
            row = np.searchsorted(first, at, "right") - 1
            inside = at + K <= first[row + 1] if len(at) else np.zeros(0, bool)
            row, at = row[inside], at[inside] - first[row[inside]]
            if not len(row):
                continue
            seed = grams[first[row] + at].view(np.int64)
            yield pa.record_batch([pa.array(seed), ids.slice(lo, hi - lo).take(pa.array(row)), pa.array(at.astype(np.int32)), pa.array(_repeated(row, seed))], schema=schema)


def _repeated(group: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Whether the same value stands earlier in the same group; groups are in order."""
    order = np.lexsort((value, group))  # stable: equal ones stay in order
    again = np.zeros(len(value), bool)
    again[order[1:]] = (value[order[1:]] == value[order[:-1]]) & (group[order[1:]] == group[order[:-1]])
    return again


def _grouped(batches, columns: tuple[str, ...], key: int):
    """Rows of batches sorted by their first ``key`` columns, as blocks of whole groups (an array of all columns)."""
    held = None
    for batch in batches:
        now = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in columns])
        held = now if held is None else np.concatenate([held, now], axis=1)
        change = np.flatnonzero((np.diff(held[:key], axis=1) != 0).any(axis=0)) + 1
        if len(change):
            yield held[:, : change[-1]]
            held = held[:, change[-1] :]
    if held is not None and held.shape[1]:
        yield held


def _runs(batches):
    """Tasks: shared seeds sorted by (doc, pos) -> runs of two neighbours, with what each seed's own anchor says.

    A run whose two seeds have one anchor, as far apart there as here, is left out: its seeds meet that
    anchor anyway, and no earlier document can hold the run.
    """
    schema = pa.schema([(c.split()[0], {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}[c.split()[1]]) for c in _RUN.split(", ")])
    for b in _grouped(batches, ("doc", "pos", "seed", "anchor", "apos"), 1):
        doc, pos, seed, anchor, apos = b
        gap = pos[1:] - pos[:-1]
        near = (doc[1:] == doc[:-1]) & (gap <= RUN_GAP) & (gap > 0)
        near &= (anchor[1:] != anchor[:-1]) | (apos[1:] - apos[:-1] != gap)
        i = np.flatnonzero(near)
        run = mix64(seed[i].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + mix64(seed[i + 1].view(np.uint64))).view(np.int64)
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip((run, doc[i], pos[i], gap[i], _repeated(doc[i], run), anchor[i], apos[i], anchor[i + 1], apos[i + 1]), schema)], schema=schema)


_RUN = "run long, doc long, pos int, gap int, again boolean, anchor1 long, apos1 int, anchor2 long, apos2 int"


def chains(x: np.ndarray, y: np.ndarray) -> list[list[int]]:
    """Chains of matches (x, y), each strictly rising in both, best first; every match is in at most one.

    f(i) = GAIN + max(0, max over j before i in x and y of f(j) - COST ((x_i - x_j) + (y_i - y_j))): with
    f(j) + COST (x_j + y_j) in a Fenwick tree of prefix maxima over y the inner maximum takes log n steps.
    """
    order = np.lexsort((-y, x))  # equal x: larger y first, so none precedes another
    rank = np.searchsorted(np.unique(y), y) + 1
    n, size = len(x), int(rank.max()) + 1
    value, holder = [-1e18] * size, [-1] * size
    score, before = [0.0] * n, [-1] * n
    xs, ys, ranks = x.tolist(), y.tolist(), rank.tolist()
    for i in order.tolist():
        best, j, r = -1e18, -1, ranks[i] - 1
        while r > 0:
            if value[r] > best:
                best, j = value[r], holder[r]
            r -= r & -r
        gain = best - COST * (xs[i] + ys[i])
        score[i] = GAIN + max(0.0, gain)
        before[i] = j if gain > 0 else -1
        mark, r = score[i] + COST * (xs[i] + ys[i]), ranks[i]
        while r < size:
            if mark > value[r]:
                value[r], holder[r] = mark, i
            r += r & -r
    used, out = [False] * n, []
    for i in sorted(range(n), key=lambda i: (-score[i], xs[i])):
        if used[i]:
            continue
        path = []
        while i >= 0 and not used[i]:
            used[i] = True
            path.append(i)
            i = before[i]
        path.reverse()
        out.append(path)
    return out


def _broken(path: list[int], x: np.ndarray, y: np.ndarray):
    """A chain's parts between gaps that are too long on either side."""
    part = path[:1]
    for i in path[1:]:
        if x[i] - x[part[-1]] > MAX_GAP + K or y[i] - y[part[-1]] > MAX_GAP + K:
            yield part
            part = []
        part.append(i)
    yield part


def _chain(batches):
    """Tasks: matches sorted by (doc, anchor) -> chains as lists of matched positions.

    Where a group's matches rise strictly on both sides, the match before is always the best to follow, so
    the chains are the stretches between long gaps and need no search.
    """
    schema = pa.schema([("doc", pa.int64()), ("anchor", pa.int64()), ("xs", pa.list_(pa.int32())), ("ys", pa.list_(pa.int32()))])
    for block in _grouped(batches, ("doc", "anchor", "pos", "apos"), 2):
        block = block[:, np.lexsort(block[::-1])]
        new = np.ones(block.shape[1], bool)  # seeds and runs of seeds may give the same matches
        new[1:] = (np.diff(block, axis=1) != 0).any(axis=0)
        doc, anchor, x, y = block[:, new]
        head = np.ones(len(x), bool)
        head[1:] = (np.diff(doc) != 0) | (np.diff(anchor) != 0)
        group = np.cumsum(head) - 1
        dx, dy = np.diff(x, prepend=0), np.diff(y, prepend=0)
        far = (dx > MAX_GAP + K) | (dy > MAX_GAP + K)
        tangled = ~head & ((dx <= 0) | (dy <= 0) | (~far & (COST * (dx + dy) >= GAIN)))
        searched = np.bincount(group[tangled], minlength=group[-1] + 1) > 0
        plain = ~searched[group]
        start = np.flatnonzero((head | far)[plain])
        d, a, u, v = doc[plain], anchor[plain], x[plain], y[plain]
        offsets = pa.array(np.append(start, len(u)).astype(np.int32))
        lists = [pa.ListArray.from_arrays(offsets, pa.array(c.astype(np.int32))) for c in (u, v)]
        if len(start):
            yield pa.record_batch([pa.array(d[start]), pa.array(a[start]), *lists], schema=schema)
        first = np.append(np.flatnonzero(head), len(x))
        out = []
        for g in np.flatnonzero(searched):
            lo, hi = first[g], first[g + 1]
            own, other = x[lo:hi], y[lo:hi]
            out += [(doc[lo], anchor[lo], own[part].tolist(), other[part].tolist()) for path in chains(own, other) for part in _broken(path, own, other)]
        if out:
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)


def _anchor_words(batches):
    """Tasks: rows sorted by (anchor, salt, lo), a text before the windows on it -> the hashes of the words there."""
    schema = pa.schema([("anchor", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32()), ("window", pa.binary())])
    h = np.zeros(0, np.uint32)
    for batch in batches:
        for a, b, data, off in each_slice(batch):
            part = batch.slice(a, b - a)
            starts, ends, first = words(data, off)
            now = word_hashes(data, starts, ends).astype(np.uint32)
            is_text = part.column("text").is_valid().to_numpy(zero_copy_only=False)
            lo, hi = (part.column(c).fill_null(0).to_numpy(zero_copy_only=False) for c in ("lo", "hi"))
            found = []
            for i in range(b - a):
                if is_text[i]:
                    h = now[first[i] : first[i + 1]]
                else:
                    found.append(h[lo[i] : hi[i]].tobytes())
            yield pa.record_batch([*(part.column(c).filter(pa.array(~is_text)) for c in ("anchor", "lo", "hi")), pa.array(found, pa.binary())], schema=schema)


def _common(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in a and in b of a longest common subsequence."""
    if len(a) == len(b):
        at = np.flatnonzero(a == b)
        return at, at
    table = np.zeros((len(a) + 1, len(b) + 1), np.int32)
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            table[i, j] = table[i + 1, j + 1] + 1 if a[i] == b[j] else max(table[i + 1, j], table[i, j + 1])
    out, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        if a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        elif table[i + 1, j] >= table[i, j + 1]:
            i += 1
        else:
            j += 1
    at = np.array(out, np.int64).reshape(-1, 2)
    return at[:, 0], at[:, 1]


def _reach(same: np.ndarray) -> int:
    """How far an end extends: the length with the best score of +1 for equal and -2 for other words."""
    if not len(same):
        return 0
    score = np.cumsum(np.where(same, 1, -2))
    best = int(score.argmax())
    return best + 1 if score[best] > 0 else 0


def align(own: np.ndarray, other: np.ndarray, xs: list[int], ys: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Places in own and in other of a chain's equal words, both strictly rising."""
    x0, y0 = xs[0], ys[0]
    if xs[-1] - x0 == ys[-1] - y0 and all(c - d == x0 - y0 for c, d in zip(xs, ys)):  # one diagonal: word by word
        end, other_end = xs[-1] + K, ys[-1] + K
        n, m = min(x0, y0, MARGIN), min(len(own) - end, len(other) - other_end, MARGIN)
        same = own[x0 - n : end + m] == other[y0 - n : other_end + m]
        back, on = _reach(same[:n][::-1]), _reach(same[len(same) - m :])
        at = np.flatnonzero(same[n - back : len(same) - m + on]) - back
        return x0 + at, y0 + at
    n = min(x0, y0, MARGIN)
    same = own[x0 - n : x0] == other[y0 - n : y0]
    back = _reach(same[::-1])
    at = np.flatnonzero(same[n - back :]) - back
    left, right = [x0 + at], [y0 + at]
    x, y = x0, y0  # the next free places
    for c, d in zip(xs, ys):
        if c > x and d > y:
            i, j = _common(own[x:c], other[y:d])
            left.append(x + i)
            right.append(y + j)
        at = np.arange(max(0, x - c, y - d), K)
        if len(at):
            left.append(c + at)
            right.append(d + at)
            x, y = c + K, d + K
    n = min(len(own) - x, len(other) - y, MARGIN)
    same = own[x : x + n] == other[y : y + n]
    at = np.flatnonzero(same[: _reach(same)])
    left.append(x + at)
    right.append(y + at)
    return np.concatenate(left), np.concatenate(right)


def split(i: np.ndarray, j: np.ndarray, min_piece: int, min_identity: float):
    """Parts (start, end, other's start, other's end, equal words) of equal words' places, each at the identity, longest first.

    Parts begin and end with runs of equal words, so such a run is never lost for its neighbours: a chain
    that reaches the identity is one part, else its longest part that does is taken and both rests are
    searched. A rest's ends of fewer words than a seed behind a longer gap met by chance and are left off.
    """
    if not len(i):
        return
    cut = np.flatnonzero((np.diff(i) > 1) | (np.diff(j) > 1)) + 1
    first, last = np.concatenate([[0], cut]), np.concatenate([cut, [len(i)]])
    a, b, u, v = i[first], i[last - 1] + 1, j[first], j[last - 1] + 1
    todo = [(0, len(first), False)]
    while todo:
        lo, hi, rest = todo.pop()
        if lo >= hi or b[hi - 1] - a[lo] < min_piece:
            continue
        best, length = None, 0
        for k in range(lo, hi):
            if b[hi - 1] - a[k] <= length:
                break
            n = last[k:hi] - first[k]
            good = np.flatnonzero(n >= min_identity * np.maximum(b[k:hi] - a[k], v[k:hi] - u[k]))
            if len(good) and b[k + good[-1]] - a[k] > length:
                best, length = (k, k + int(good[-1]) + 1), b[k + good[-1]] - a[k]
        if best is None:
            continue
        k, m = best
        fits = lambda k, m: last[m - 1] - first[k] >= min_identity * max(b[m - 1] - a[k], v[m - 1] - u[k])
        if rest or best != (lo, hi):
            while m - k > 1 and last[k] - first[k] < min(K, a[k + 1] - b[k]) and fits(k + 1, m):
                k += 1
            while m - k > 1 and last[m - 1] - first[m - 1] < min(K, a[m - 1] - b[m - 2]) and fits(k, m - 1):
                m -= 1
        if b[m - 1] - a[k] >= min_piece:
            yield int(a[k]), int(b[m - 1]), int(u[k]), int(v[m - 1]), int(last[m - 1] - first[k])
        todo += [(lo, k, True), (m, hi, True)]


PASSAGE = "doc_id long, start int, end int, source_id long, source_start int, source_end int, n_equal int"


def _margins(h: np.ndarray, w: np.ndarray, at: np.ndarray, other: np.ndarray, room: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """How far each of many ends extends from h[at] and w[other], forwards or backwards, as ``_reach`` has it, and its equal words."""
    out, equal = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
    ahead = np.arange(MARGIN) * step
    for lo in range(0, len(at), 8192):
        hi = lo + 8192
        inside = np.arange(MARGIN) < room[lo:hi, None]
        i, j = np.where(inside, at[lo:hi, None] + ahead, 0), np.where(inside, other[lo:hi, None] + ahead, 0)
        score = np.cumsum(np.where(inside & (h[i] == w[j]), 1, -2), axis=1) if len(h) and len(w) else np.zeros(inside.shape, int)
        best = score.argmax(axis=1)
        top = score[np.arange(len(best)), best]
        out[lo:hi] = np.where(top > 0, best + 1, 0)
        equal[lo:hi] = (top + 2 * out[lo:hi]) // 3 * (top > 0)  # top = equal - 2 x others
    return out, equal


def _align(min_words: int, min_piece: int, min_identity: float):
    """Tasks: rows sorted by doc, a text before its chains -> the passages of each document."""
    types = {"long": pa.int64(), "int": pa.int32()}
    schema = pa.schema([(c.split()[0], types[c.split()[1]]) for c in PASSAGE.split(", ")])

    def passages(doc: int, pieces: list[tuple]):
        pieces.sort()
        group: list = []
        for p in [*pieces, None]:
            if group and (p is None or p[0] > end + JOIN_GAP):
                start = group[0][0]
                if end - start >= min_words:
                    main = max(group, key=lambda q: (q[1] - q[0], -q[2]))
                    covered, n_equal = start, 0
                    for q in group:  # words of overlapping pieces count once, at each piece's rate
                        new = max(0, q[1] - max(covered, q[0]))
                        n_equal += round(new * q[5] / (q[1] - q[0]))
                        covered = max(covered, q[1])
                    yield doc, start, end, main[2], main[3], main[4], n_equal
                group = []
            if p is not None:
                end = max(end, p[1]) if group else p[1]
                group.append(p)

    def measured(h, w, base, size, wbase, wsize, part):
        """Of chains (words from base in h, window from wbase in w): start, end, window start, window end and equal words
        of those on one diagonal that are one part as they stand, and which others may reach min_piece words.
        """
        xs, ys, lo = part.column("xs"), part.column("ys"), part.column("lo").to_numpy()
        first, last = xs.offsets.to_numpy()[:-1], xs.offsets.to_numpy()[1:] - 1
        vx, vy = xs.values.to_numpy().astype(np.int64), ys.values.to_numpy().astype(np.int64)
        x0, y0, x1, y1 = vx[first], vy[first] - lo, vx[last] + K, vy[last] + K - lo
        back, equal_back = _margins(h, w, base + x0 - 1, wbase + y0 - 1, np.minimum(x0, y0), -1)
        on, equal_on = _margins(h, w, base + x1, wbase + y1, np.minimum(size - x1, wsize - y1), 1)
        long = x1 - x0 + back + on >= min_piece
        turns = np.add.reduceat(np.abs(np.diff(vx - vy, append=0)) * (np.arange(len(vx)) < np.repeat(last, last - first + 1)), first)
        one = np.flatnonzero(long & (turns == 0))
        n = x1[one] - x0[one]
        inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        same = h[np.repeat(base[one] + x0[one], n) + inner] == w[np.repeat(wbase[one] + y0[one], n) + inner]
        equal = equal_back[one] + equal_on[one] + (np.add.reduceat(same, np.cumsum(n) - n) if len(one) else n)
        spans = np.stack([x0 - back, x1 + on, y0 - back + lo, y1 + on + lo])[:, one]
        whole = equal >= min_identity * (spans[1] - spans[0])
        rest = long.copy()
        rest[one[whole]] = False
        return one[whole], np.vstack([spans, equal])[:, whole].T.tolist(), np.flatnonzero(rest)

    def run(batches):
        doc, text, pieces = None, np.zeros(0, np.uint32), []
        for batch in batches:
            for a, b, data, off in each_slice(batch):
                part = batch.slice(a, b - a)
                starts, ends, at = words(data, off)
                h = np.concatenate([text, word_hashes(data, starts, ends).astype(np.uint32)])
                at = at + len(text)
                is_text = part.column("text").is_valid().to_numpy(zero_copy_only=False)
                owner = np.maximum.accumulate(np.where(is_text, np.arange(len(part)), -1))
                base, size = np.where(owner < 0, 0, at[owner]), np.where(owner < 0, len(text), at[owner + 1] - at[owner])
                rows = np.flatnonzero(~is_text)
                docs, out = part.column("doc").to_pylist(), []
                chained = pa.RecordBatch.from_arrays([pa.concat_arrays([part.column(c).take(pa.array(rows))]) for c in ("anchor", "xs", "ys", "lo", "window")], ["anchor", "xs", "ys", "lo", "window"])
                blob, woff = utf8(chained.column("window"))
                w = blob[: len(blob) // 4 * 4].view(np.uint32)
                wbase, wsize = woff[:-1] // 4, np.diff(woff) // 4
                found: dict[int, list] = {}
                anchors, los = chained.column("anchor").to_pylist(), chained.column("lo").to_pylist()
                plain, spans, rest = measured(h, w, base[rows], size[rows], wbase, wsize, chained) if len(rows) else (rows, [], rows)
                for k, (p, q, u, v, n) in zip(plain.tolist(), spans):
                    found.setdefault(owner[rows[k]], []).append((p, q, anchors[k], u, v, n))
                for k in rest.tolist():
                    i = rows[k]
                    xs, lo = chained.column("xs")[k].as_py(), los[k]
                    equal = align(h[base[i] : base[i] + size[i]], w[wbase[k] : wbase[k] + wsize[k]], xs, [y - lo for y in chained.column("ys")[k].as_py()])
                    found.setdefault(owner[i], []).extend((p, q, anchors[k], u + lo, v + lo, n) for p, q, u, v, n in split(*equal, min_piece, min_identity))
                pieces += found.get(-1, [])
                for i in np.flatnonzero(is_text).tolist():
                    if doc is not None:
                        out += passages(doc, pieces)
                    doc, pieces, text = docs[i], found.get(i, []), h[at[i] : at[i + 1]].copy()
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), schema)] if out else [pa.array([], f.type) for f in schema], schema=schema)
        if doc is not None:
            out = list(passages(doc, pieces))
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), schema)] if out else [pa.array([], f.type) for f in schema], schema=schema)

    return run


def _run_matches(met: DataFrame, parts: int) -> DataFrame:
    """Both seeds of each run of two neighbouring shared seeds, matched to the first document that holds the run."""
    by_doc = met.select("doc", "pos", "seed", "anchor", "apos").repartition(parts, "doc").sortWithinPartitions("doc", "pos")
    runs = stored(by_doc.mapInArrow(tidy(_runs), _RUN), "seed-runs")
    places = F.min_by(F.struct("pos", "gap"), F.when(~F.col("again"), F.col("doc")))
    first = runs.groupBy("run").agg(F.min("doc").alias("anchor"), F.max("doc").alias("last"), places.alias("at")).where("anchor < last")
    first = stored(first.select("run", "anchor", F.col("at.pos").alias("apos"), F.col("at.gap").alias("agap")), "run-anchors")
    both = runs.join(first, "run").where("doc > anchor")
    ends = F.array(F.struct(F.col("pos").alias("pos"), F.col("apos").alias("apos"), (F.col("anchor1") == F.col("anchor")) & (F.col("apos1") == F.col("apos"))), F.struct((F.col("pos") + F.col("gap")).alias("pos"), (F.col("apos") + F.col("agap")).alias("apos"), (F.col("anchor2") == F.col("anchor")) & (F.col("apos2") == F.col("apos") + F.col("agap"))))
    # What the seed's own match says already isn't said again.
    return both.select("doc", "anchor", F.explode(ends).alias("e")).where("NOT e.col3").select("doc", "anchor", "e.pos", "e.apos")


def repeated_passages(docs: DataFrame, min_words: int = MIN_WORDS, min_piece: int = MIN_PIECE, min_identity: float = MIN_IDENTITY, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Passages that an earlier document (smaller id) holds too, per later document.

    doc_id, start and end in words, source_id with its span (the longest piece's source if several
    documents supply the passage), n_equal. A document's passages don't overlap. Null, empty and short
    texts have none. Rows without an id are left out; rows that share an id are one document, read as
    the least of their texts. Other columns are ignored.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.where(F.col(id_column).isNotNull()).select(F.col(id_column).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    rows = one_text_each(rows)
    # Seeds are many and cheap: they are made twice rather than written. Spark may split the partition of a hot seed.
    seeds = rows.mapInArrow(tidy(_seeds), "seed long, doc long, pos int, again boolean")
    first = F.min_by("pos", F.when(~F.col("again"), F.col("doc")))
    shared = stored(seeds.groupBy("seed").agg(F.min("doc").alias("anchor"), F.max("doc").alias("last"), first.alias("apos")).where("anchor < last").select("seed", "anchor", "apos"), "anchors")
    met = stored(seeds.drop("again").join(shared, "seed"), "shared-seeds")
    matches = met.where("doc > anchor").select("doc", "anchor", "pos", "apos").unionByName(_run_matches(met, parts))
    chained = matches.repartition(parts, "doc").sortWithinPartitions("doc", "anchor").mapInArrow(tidy(_chain), "doc long, anchor long, xs array<int>, ys array<int>")
    lo = F.greatest(F.element_at("ys", 1) - MARGIN, F.lit(0))
    hi = F.element_at("ys", -1) + K + MARGIN
    chained = stored(chained.withColumns({"lo": lo, "hi": hi}), "chains")
    # Only texts that take part travel. A task has an anchor's text once and cuts its windows one by one;
    # an anchor with many windows is dealt over several tasks.
    salts = lambda n: F.ceil(F.col(n) / WINDOWS).cast("int")
    windows = stored(chained.groupBy("anchor", "lo", "hi").agg(F.count("*").alias("n")).drop("n"), "windows")
    popular = stored(windows.groupBy("anchor").agg(F.count("*").alias("n")).select("anchor", salts("n").alias("salts")), "window-anchors")
    texts = possible_rows(rows, popular.select(F.col("anchor").alias("doc_id"))).withColumnRenamed("doc_id", "anchor").join(popular, "anchor")
    texts = texts.select("anchor", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(None).cast("int").alias("lo"), F.lit(None).cast("int").alias("hi"), "text")
    asked = windows.join(popular, "anchor").select("anchor", F.pmod(F.xxhash64("lo", "hi"), F.col("salts")).cast("int").alias("salt"), "lo", "hi", F.lit(None).cast("string").alias("text"))
    met = texts.unionByName(asked).repartition(parts, "anchor", "salt").sortWithinPartitions("anchor", "salt", F.asc_nulls_first("lo"))
    cut = stored(met.mapInArrow(tidy(_anchor_words), "anchor long, lo int, hi int, window binary"), "anchor-windows")
    of = chained.join(cut, ["anchor", "lo", "hi"]).select("doc", "anchor", "xs", "ys", "lo", "window")
    none = {"anchor": "long", "xs": "array<int>", "ys": "array<int>", "lo": "int", "window": "binary"}
    own = possible_rows(rows, chained.select(F.col("doc").alias("doc_id"))).select(F.col("doc_id").alias("doc"), *(F.lit(None).cast(t).alias(c) for c, t in none.items()), "text")
    both = own.unionByName(of.withColumn("text", F.lit(None).cast("string"))).repartition(parts, "doc").sortWithinPartitions("doc", F.asc_nulls_first("anchor"))
    return both.mapInArrow(tidy(_align(min_words, min_piece, min_identity)), PASSAGE)


def _without(batches):
    """Tasks: texts with spans of words in the last column -> texts without them."""
    for batch in batches:
        at = batch.schema.get_field_index("text")
        texts = []
        for lo, hi, data, off in each_slice(batch):
            starts, ends, first = words(data, off)
            for i, spans in enumerate(batch.column(batch.num_columns - 1).slice(lo, hi - lo).to_pylist()):
                raw, base = data[off[i] : off[i + 1]].tobytes(), off[i]
                left, low = [], 0
                for span in sorted((s["start"], s["end"]) for s in spans or []):
                    left.append(raw[low : starts[first[i] + span[0]] - base])
                    low = int(ends[first[i] + span[1] - 1] - base)
                left.append(raw[low:])
                texts.append(b"".join(left).decode("utf-8", "replace"))
        yield batch.set_column(at, "text", pa.array(texts, pa.string())).select(range(batch.num_columns - 1))


def remove_passages(docs: DataFrame, passages: DataFrame) -> DataFrame:
    """docs with the passages cut out of their texts; a document without a word left goes.

    A null text goes with the wordless ones. n_chars, if there is such a column, follows the text. Texts
    without a passage are not shuffled. Repeated ids lose the passages each; rows without an id stay as they are; other columns
    are kept, whatever their names. An empty table gives no rows.
    """
    name = next(c for c in (f"spans{i}" for i in range(len(docs.columns) + 1)) if c not in docs.columns)
    spans = stored(passages.groupBy("doc_id").agg(F.collect_list(F.struct("start", "end")).alias(name)), "spans")
    ids = spans.select("doc_id")
    joined = possible_rows(docs, ids).join(spans, "doc_id", "left").select(*docs.columns, name)
    out = possible_rows(docs, ids, wanted=False).unionByName(joined.mapInArrow(tidy(_without), docs.schema)).where(F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
