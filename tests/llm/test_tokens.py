"""Packing, token-id files and piece lattices: against the libraries and brute force."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from gleanery.llm import bitplane, packing, pieces
from gleanery.llm.tokens import WordEncoder

BYTE, WORD, PIECE = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_cached_words_give_the_library_ids(path):
    rnd = random.Random(1)
    texts = ["", " x", "a  b\n\nc \t d", "it's 'sup", "é́ \x1c!a", "<|endoftext|> x", "ａ１ ² ª", "İi ß Σας"]
    texts += ["".join(rnd.choice(" \n\tab1!.,'sÉ́İß漢ªΣ") for _ in range(30)) for _ in range(1500)]
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    encoder = WordEncoder(path, max_words=50)
    for lo in range(0, len(texts), 300):
        ids, at = encoder.encode(texts[lo : lo + 300])
        for a, b, want in zip(at[:-1], at[1:], t.encode_batch(texts[lo : lo + 300], add_special_tokens=False)):
            assert ids[a:b].tolist() == want.ids


def test_layout_fills_every_place_once():
    rng = np.random.default_rng(0)
    for n, capacity in ((0, 64), (1, 64), (300, 64), (5000, 256)):
        h = np.bincount(rng.integers(1, capacity + 1, n), minlength=capacity + 1)
        rows, sequences = packing.layout(h)
        fill = {}
        for length, lo, count, base, offset in rows:
            for k in range(count):
                fill.setdefault(base + k, []).append((offset, length))
        assert sum(len(x) for x in fill.values()) == n and len(fill) == sequences
        for x in fill.values():
            at = 0
            for offset, length in sorted(x):
                assert offset == at
                at += length
            assert at <= capacity
        assert sequences <= 1.03 * np.ceil((h * np.arange(capacity + 1)).sum() / capacity) + 2


def _ids(path, texts, end):
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return [np.array([*x.ids, end], "<u4") for x in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def test_pack_documents(spark, odd_docs, no_docs):
    rows = [r for r in odd_docs.collect()]
    own: dict = {}
    for r, ids in zip(rows, _ids(BYTE, [r.text for r in rows], 0)):
        own.setdefault(r.doc_id, ids)
    got = packing.pack_documents(odd_docs, BYTE).collect()
    assert sum(r["length"] for r in got) == sum(len(own[r.doc_id]) for r in rows)
    for r in got:
        assert zlib.crc32(own[r.doc_id][r["start"] : r["start"] + r["length"]].tobytes()) == r["ids_crc32"]
    for s in {r["sequence_id"] for r in got}:
        at = 0
        for r in sorted((r for r in got if r["sequence_id"] == s), key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048
    assert packing.pack_documents(no_docs, BYTE).count() == 0


@pytest.mark.parametrize("bits", [1, 8])
def test_file_round_trip(bits):
    rng = np.random.default_rng(2)
    for n in (0, 1, 7, 70_000):
        ids = rng.integers(0, 1 << 20, n).astype(np.uint32)
        docs, lengths, back = bitplane.unpack_file(bitplane.pack_file([3, None], [n, 0], ids, bits))
        assert docs == [3, None] and lengths == [n, 0] and (back == ids).all()
    with pytest.raises(ValueError):
        bitplane.unpack_file(b"nope" + bitplane.pack_file([], [], ids[:0])[4:])


def test_token_files(spark, odd_docs, no_docs):
    rows = sorted(odd_docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    want, at = [], 0
    for r, ids in zip(rows, _ids(WORD, [r.text for r in rows], 2)):
        want.append((r.doc_id, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    got = bitplane.token_file_digest(odd_docs, WORD).collect()
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want
    assert bitplane.token_file_digest(no_docs, WORD).count() == 0


def _segmentations(lattice, text):
    out = []

    def walk(at, score, ids):
        if at == len(text):
            out.append((score, tuple(ids)))
        for end in range(at + 1, min(len(text), at + lattice.longest) + 1):
            if text[at:end] in lattice.table:
                s, i = lattice.table[text[at:end]]
                walk(end, score + s, [*ids, i])
            elif end == at + 1:
                walk(end, score + lattice.fallback, [*ids, *lattice.bytes_of(text[at])])

    walk(0, 0.0, [])
    return sorted(out, key=lambda x: -x[0])


def test_nbest_against_all_segmentations():
    lattice, rnd = pieces.Lattice(PIECE), random.Random(3)
    for _ in range(120):
        text = "".join(rnd.choice("the aondin\né漢.") for _ in range(rnd.randint(1, 10)))
        (found,) = lattice.encode([text], 4)
        every = _segmentations(lattice, " " + text)
        assert [s for s, _ in found] == [s for s, _ in every[:4]]
        assert len({tuple(i.tolist()) for _, i in found}) == len(found)
        for s, ids in found:
            assert (s, tuple(ids.tolist())) in every and lattice.decode(ids) == text


def test_segment_and_decode(spark, odd_docs, no_docs):
    got = pieces.segment(odd_docs, PIECE, 3, with_ids=True)
    rows = got.collect()
    assert len(rows) == odd_docs.count() and all(r.round_trip for r in rows)
    assert [r.nbest[0].n_pieces for r in rows if r.doc_id in (1, 2)] == [0, 0]
    texts = {r.doc_id: r.text or "" for r in odd_docs.collect()}
    back = pieces.decode(got.selectExpr("doc_id", "nbest[0].ids AS ids"), PIECE)
    assert all(r.text == texts[r.doc_id] for r in back.collect())
    assert pieces.segment(no_docs, PIECE).count() == 0


def _plain_nnls(a, h):
    """Lawson and Hanson's active-set method with a dense solver."""
    n = a.shape[1]
    x, passive = np.zeros(n), np.zeros(n, bool)
    for _ in range(20 * n):
        gradient = a.T @ (h - a @ x)
        if passive.all() or gradient[~passive].max() <= 1e-9:
            return x
        passive[np.flatnonzero(~passive)[gradient[~passive].argmax()]] = True
        while True:
            s = np.zeros(n)
            s[passive] = np.linalg.lstsq(a[:, passive], h, rcond=None)[0]
            bad = passive & (s <= 1e-12)
            if not bad.any():
                x = s
                break
            alpha = min(x[i] / (x[i] - s[i]) if x[i] != s[i] else 0.0 for i in np.flatnonzero(bad))
            x = x + alpha * (s - x)
            passive &= x > 1e-12
    return x


def test_fit_is_the_least_squares_solution():
    rng = np.random.default_rng(7)
    for capacity in (6, 9, 14):
        patterns = packing.patterns_of(capacity)
        assert len({tuple(p) for p in patterns.tolist()}) == len(patterns) and (patterns.sum(1) == capacity).all()
        matrix = np.stack([(patterns == n).sum(1) for n in range(capacity + 1)])
        matrix[0] = 0
        weight = (np.arange(capacity + 1) / capacity) ** packing.WEIGHT_POWER + 1e-9
        went_down = 0
        for _ in range(6):
            h = rng.integers(0, 200, capacity + 1)
            h[0] = 0
            x, rises, falls = packing.solve(h, patterns, weight, rounds=30_000, tolerance=1e-7)
            went_down += falls
            best = _plain_nnls(np.sqrt(weight)[:, None] * matrix, np.sqrt(weight) * h)
            loss = lambda v: (weight * (matrix @ v - h) ** 2).sum()
            assert (x >= 0).all() and rises and loss(x) <= loss(best) * (1 + 1e-4) + 1e-3
        assert went_down


def test_counts_stay_within_the_histogram():
    rng = np.random.default_rng(8)
    h = np.bincount(np.minimum(2048, 1 + rng.lognormal(6, 1, 5000).astype(int)), minlength=2049)
    used = np.zeros(2049, np.int64)
    for pattern, n in packing.fit_patterns(h).items():
        assert sum(pattern) == 2048 and n > 0
        np.add.at(used, list(pattern), n)
    assert (used <= h).all() and used.sum() > 0.25 * h.sum()


def test_one_block_is_read_alone():
    rng = np.random.default_rng(4)
    ids = rng.integers(0, 50_000, 10_000).astype(np.uint32)
    for bits in (1, 8):
        payload = bitplane.pack_file([3], [10_000], ids, bits, block=1000)
        for start, count in ((0, 10), (999, 2), (2500, 3100), (9990, 100), (10_000, 5)):
            assert (bitplane.read_ids(payload, start, count) == ids[start : start + count]).all()
        short = payload[:-50]  # the last block is cut; the others can still be read
        assert (bitplane.read_ids(short, 1500, 4000) == ids[1500:5500]).all()
        with pytest.raises(Exception):  # noqa: B017
            bitplane.unpack_file(short)


def _tuple_search(own, part, n):
    """The n best segmentations by a heap of whole paths: what the steps to parents must equal."""
    import heapq

    from gleanery.llm.pieces import _FAR

    forward = [0.0] + [_FAR] * len(part)
    into = [[] for _ in range(len(part) + 1)]
    for j in range(1, len(part) + 1):
        for size in range(1, min(own.longest, j) + 1):
            s, i = own.table.get(part[j - size : j], (own.fallback if size == 1 else _FAR, -1))
            if s > _FAR:
                into[j].append((size, s, i))
                forward[j] = max(forward[j], forward[j - size] + s)
    heap, found = [(-forward[-1], (), len(part), 0.0)], []
    while heap and len(found) < n:
        _, sizes, at, done = heapq.heappop(heap)
        if not at:
            found.append((done, sizes))
        for size, s, _ in into[at]:
            if forward[at - size] > _FAR / 2:
                heapq.heappush(heap, (-(done + s + forward[at - size]), (*sizes, size), at - size, done + s))
    return found


def test_a_star_keeps_its_order_and_its_memory():
    import tracemalloc

    own = pieces.lattice(public_tokenizers.path("piece_bpe_32k.model"))
    for part in ("aaaaaaaa", "abababab", "internationalization", "x", "Ünïcodé漢字漢字", "0000011111"):
        got = own.a_star(part, 12)
        want = _tuple_search(own, part, 12)
        assert [s for s, _ in got] == [s for s, _ in want]
        spelled = [[own.table[part[e - z : e]][1] for e, z in _ends(part, sizes)] for _, sizes in want if all(part[e - z : e] in own.table for e, z in _ends(part, sizes))]
        assert [ids for _, ids in got if ids in spelled] == spelled
    long = "".join("abcdefghijklmnopqrstuvwxyz0123456789"[(i * i + i // 7) % 36] for i in range(50_000))
    tracemalloc.start()
    found = own.a_star(long, 3)
    assert tracemalloc.get_traced_memory()[1] < 75 << 20
    tracemalloc.stop()
    assert len(found) == 3 and found[0][0] >= found[1][0] >= found[2][0] and own.decode(np.array(found[0][1])) in (long, long[1:])


def _ends(part, sizes):
    """(end, size) of the pieces from the start of the part; sizes come from its end."""
    end = 0
    for z in reversed(sizes):
        end += z
        yield end, z
