"""Forward scores of pre-tokens under unigram piece models, computed on a trie of the distinct pre-tokens.

A pre-token is a word (a run without ASCII white space) after a word-start mark, however long it is.  The trie is made
level by level: nodes of depth t are the distinct pairs of a parent and a byte.  A node's score needs its ancestors' scores
and the pieces that end at it, so each shared prefix is scored once, and a pre-token's score stands at its terminal
node.  Pre-tokens of more than LIMIT bytes hardly share prefixes: they are scored side by side, in blocks of bytes
that hand their last scores on.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece

from .words import _BYTE, mix, powers, ranged, words

LIMIT = 64
_BLOCK = 1 << 16
_TOGETHER = 1 << 13
MARK = b" "
#: Where the environment has public tokenizers' vocabularies.
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
_loaded: dict[str, tuple[Pieces, sentencepiece.SentencePieceProcessor]] = {}


class Pieces(NamedTuple):
    """A fixed vocabulary of byte strings, found by hash; every byte also has a piece of its own."""

    hashes: np.ndarray  # sorted
    ids: np.ndarray
    filter: np.ndarray  # whether some hash ends in these bits
    single: np.ndarray  # the id for each byte
    longest: int
    size: int

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in h that are pieces, and their ids."""
        some = np.flatnonzero(self.filter[(h & np.uint64(len(self.filter) - 1)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.hashes, h[some]), len(self.hashes) - 1)
        ok = self.hashes[at] == h[some]
        return some[ok], self.ids[at[ok]]


def pieces(strings: list[bytes], single: np.ndarray) -> Pieces:
    data = np.frombuffer(b"".join(strings), np.uint8)
    ends = np.cumsum([len(s) for s in strings])
    h = ranged(_BYTE[data], ends - [len(s) for s in strings], ends)
    order = np.argsort(h)
    found = np.zeros(1 << 20, bool)
    found[(h & np.uint64(len(found) - 1)).astype(np.int64)] = True
    return Pieces(h[order], order, found, single, max(map(len, strings)), len(strings))


def vocabulary(path: str = VOCABULARY) -> tuple[Pieces, sentencepiece.SentencePieceProcessor]:
    """The pieces of a SentencePiece file; kept in the worker."""
    if path not in _loaded:
        tokens = sentencepiece.SentencePieceProcessor(model_file=path)
        strings, single = [], np.full(256, tokens.unk_id())
        for i in range(tokens.get_piece_size()):
            piece = tokens.id_to_piece(i)
            if tokens.is_byte(i):
                single[int(piece[3:5], 16)] = i
            # what is no text has a string that no pre-token holds
            strings.append(b"\0%d" % i if tokens.is_byte(i) or tokens.is_control(i) or tokens.is_unknown(i) else piece.replace("▁", MARK.decode()).encode())
        _loaded[path] = pieces(strings, single), tokens
    return _loaded[path]


class PreTokens(NamedTuple):
    data: np.ndarray  # the distinct pre-tokens' bytes, marks included
    start: np.ndarray
    length: np.ndarray
    index: np.ndarray  # the distinct pre-token of each place in the texts
    first: np.ndarray  # the places of text i are first[i]:first[i + 1]

    def strings(self) -> list[bytes]:
        data = self.data.tobytes()
        return [data[s : s + n] for s, n in zip(self.start.tolist(), self.length.tolist(), strict=True)]


def pretokens(texts: pa.Array) -> PreTokens:
    """The pre-tokens of texts; equal ones are found byte by byte."""
    w = words(texts)
    coded = w.column().dictionary_encode()
    _, offsets, plain = coded.dictionary.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(coded.dictionary) + 1) if len(coded.dictionary) else np.zeros(1, np.int64)
    plain = np.frombuffer(plain, np.uint8, int(offsets[-1])) if plain is not None else np.zeros(0, np.uint8)
    start = offsets[:-1] + np.arange(len(offsets) - 1)  # a mark before each
    data = np.full(len(plain) + len(start), MARK[0], np.uint8)
    is_mark = np.zeros(len(data), bool)
    is_mark[start] = True
    data[~is_mark] = plain
    return PreTokens(data, start, np.diff(offsets) + 1, coded.indices.to_numpy().astype(np.int64), w.first)


def forward(tokens: PreTokens, known: Pieces, logp: np.ndarray, best: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(scores, counts) of the distinct pre-tokens; logp is (pieces, models).

    scores[i, m] is the log of the sum over all segmentations of the product of their pieces' probabilities under
    model m.  With `best` it is that of the best one segmentation instead, and counts[i] its number of pieces, the
    fewest among equals; `best` takes one model.
    """
    n, models = len(tokens.start), logp.shape[1]
    scores, counts = np.zeros((n, models)), np.zeros(n, np.int64)
    order = np.argsort(-tokens.length, kind="stable")
    start, length = tokens.start[order], tokens.length[order]
    sums = np.zeros(len(tokens.data) + 1, np.uint64)
    np.cumsum(_BYTE[tokens.data] * powers(len(tokens.data)), out=sums[1:])
    inverse = powers(len(tokens.data) + 1, pow(int(powers(2)[1]), -1, 1 << 64)) if len(tokens.data) else sums
    many = int(np.searchsorted(-length, -(LIMIT + 1), "left"))  # those of more than LIMIT bytes and the mark
    if many:
        scores[order[:many]], counts[order[:many]] = _forward_long(start[:many], length[:many], tokens.data, sums, inverse, known, logp, best)
        order, start, length = order[many:], start[many:], length[many:]
        n -= many
    node, level, number = [np.zeros(n, np.int64)], [np.zeros((1, models))], [np.zeros(1, np.int64)]
    for t in range(1, int(length[0]) + 1 if n else 0):
        alive = int(np.searchsorted(-length, -t, "right"))  # the pre-tokens of t bytes or more
        byte = tokens.data[start[:alive] + t - 1]
        _, one, mine = np.unique(node[-1][:alive] * 256 + byte, return_index=True, return_inverse=True)
        end = start[one] + t
        steps = []
        for size in range(1, min(t, known.longest) + 1):
            at, ids = known.find(mix((sums[end] - sums[end - size]) * inverse[end - size]))
            if size == 1:  # a byte that is no piece as a character falls back to its own piece
                rest = np.setdiff1d(np.arange(len(one)), at)
                at, ids = np.append(at, rest), np.append(ids, known.single[byte[one[rest]]])
            if len(at):
                parent = node[t - size][one[at]]
                steps.append((at, level[t - size][parent] + logp[ids], number[t - size][parent] + 1))
        top = np.full((len(one), models), -np.inf)
        count = np.full(len(one), np.iinfo(np.int64).max)
        for at, value, k in steps:
            if best:
                better = (value[:, 0] > top[at, 0]) | ((value[:, 0] == top[at, 0]) & (k < count[at]))
                top[at[better]], count[at[better]] = value[better], k[better]
            else:
                top[at] = np.maximum(top[at], value)
        if not best:
            total = np.zeros_like(top)
            for at, value, _ in steps:
                total[at] += np.exp(value - top[at])
            top += np.log(total)
        node.append(mine)
        level.append(top)
        number.append(count)
        if t > known.longest:
            node[t - known.longest - 1] = level[t - known.longest - 1] = number[t - known.longest - 1] = None
        done = int(np.searchsorted(-length, -t, "left"))  # those of t bytes end here
        scores[order[done:alive]] = top[mine[done:alive]]
        counts[order[done:alive]] = count[mine[done:alive]]
    return scores, counts


def _forward_long(start: np.ndarray, length: np.ndarray, data: np.ndarray, sums: np.ndarray, inverse: np.ndarray, known: Pieces, logp: np.ndarray, best: bool) -> tuple[np.ndarray, np.ndarray]:
    """forward() of pre-tokens by falling length, without a trie.

    The pieces of a block of bytes (of about _BLOCK, over all pre-tokens that reach it) are found at once; the
    scores of the last `longest` places before a block are all that its own scores need.
    """
    n, models, back = len(start), logp.shape[1], known.longest
    scores, counts = np.zeros((n, models)), np.zeros(n, np.int64)
    value, number = np.full((back, n, models), -np.inf), np.zeros((back, n), np.int64)  # of the places up to t0
    value[-1] = 0
    t0 = 0
    while t0 < length[0]:
        alive = int(np.searchsorted(-length, -t0, "left"))  # the pre-tokens of more than t0 bytes
        wide = int(min(max(8, _BLOCK // alive), length[0] - t0))
        value = np.concatenate([value[:, :alive], np.full((wide, alive, models), -np.inf)])
        number = np.concatenate([number[:, :alive], np.zeros((wide, alive), np.int64)])
        t, run = np.divmod(np.arange(wide * alive), alive)
        inside = t + t0 < length[run]
        t, run = t[inside], run[inside]
        end = start[run] + t0 + t + 1
        places, sizes, ids = [], [], []
        for size in range(1, back + 1):
            some = np.flatnonzero(t + t0 + 1 >= size)
            at, found = known.find(mix((sums[end[some]] - sums[end[some] - size]) * inverse[end[some] - size]))
            at = some[at]
            if size == 1:  # a byte that is no piece as a character falls back to its own piece
                rest = np.setdiff1d(np.arange(len(t)), at)
                at, found = np.append(at, rest), np.append(found, known.single[data[end[rest] - 1]])
            places.append(at)
            sizes.append(np.full(len(at), size))
            ids.append(found)
        place, size, id_ = np.concatenate(places), np.concatenate(sizes), np.concatenate(ids)
        by = np.argsort(place, kind="stable")  # by t, then by pre-token
        place, size, id_ = place[by], size[by], id_[by]
        first = np.flatnonzero(np.diff(place, prepend=-1))  # each place has its byte's piece at least
        row, of, source = t[place], run[place], back + t[place] - size
        low = np.searchsorted(row, np.arange(wide + 1)).tolist()
        begin = np.searchsorted(first, low).tolist()
        for k in range(wide):
            a, b = low[k], low[k + 1]
            if a == b:
                break
            starts = first[begin[k] : begin[k + 1]] - a
            target = of[a:b][starts]
            step = value[source[a:b], of[a:b]] + logp[id_[a:b]]
            top = np.maximum.reduceat(step, starts)
            each = np.repeat(top, np.diff(starts, append=b - a), axis=0)
            if best:
                pieces_ = np.where(step[:, 0] == each[:, 0], number[source[a:b], of[a:b]] + 1, np.iinfo(np.int64).max)
                number[back + k, target] = np.minimum.reduceat(pieces_, starts)
            else:
                top = top + np.log(np.add.reduceat(np.exp(step - each), starts))
            value[back + k, target] = top
        done = np.flatnonzero(length[:alive] <= t0 + wide)
        scores[done], counts[done] = value[back - 1 + length[done] - t0, done], number[back - 1 + length[done] - t0, done]
        value, number = value[wide:], number[wide:]
        t0 += wide
    return scores, counts


def encoded_counts(tokens: PreTokens, weights: np.ndarray, path: str) -> np.ndarray:
    """(pieces, models): how often each piece stands in the tokenizer's own encoding; weights is (distinct, models)."""
    known, encoder = vocabulary(path)
    out = np.zeros((known.size, weights.shape[1]))
    strings = tokens.strings()
    for low in range(0, len(strings), _TOGETHER):
        # one thread: others would each keep an arena of the worker's memory
        ids = encoder.encode([s.decode("utf-8", "replace").lstrip(" ") for s in strings[low : low + _TOGETHER]], num_threads=1)
        sizes = np.array([len(x) for x in ids], np.int64)
        flat = np.fromiter((x for row in ids for x in row), np.int64, int(sizes.sum()))
        of = np.repeat(np.arange(low, low + len(ids)), sizes)
        for m in range(weights.shape[1]):
            out[:, m] += np.bincount(flat, weights[of, m], known.size)
    return out
