"""Subword lattices of words: marginal probabilities and expected piece counts, many words at a time.

A word's lattice has an arc for every vocabulary piece that matches between two of its characters.
The first piece of a word carries the vocabulary's word-start mark, no later piece does, so the
segmentations of a text are the combinations of those of its words, and its marginal probability is the
product over its words. First pieces have a distribution of their own; later pieces share one with the end
of the word, so the probabilities of all words sum to one. Every character also has an arc that costs the
probability of an unknown character, so no word is impossible.
Words of equal length share one recursion in numpy, over all of them at once, in log space.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

START = "▁"
CODE_POINTS = 0x110000  # an unknown character is one of these, all alike
GROUP = 4096  # words of one recursion
NOTHING = -np.inf
PRIME = np.uint64(1099511628211)


def _hash_rows(codes: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each row of code points."""
    h = np.full(len(codes), 14695981039346656037, np.uint64)
    for column in codes.T:
        h = (h ^ column.astype(np.uint64)) * PRIME
        h ^= h >> np.uint64(29)
    return h


def code_points(words: list[str], length: int) -> np.ndarray:
    return np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(-1, length)


class Vocabulary:
    """Pieces of a vocabulary file with their scores; ``index`` finds pieces by hash, none collide (checked)."""

    def __init__(self, pieces: list[str], scores: list[float]):
        self.pieces = pieces
        self.scores = np.asarray(scores, float)
        self.first = np.array([p.startswith(START) for p in pieces])
        by_length = defaultdict(list)
        for i, piece in enumerate(pieces):
            by_length[len(piece)].append(i)
        self.longest = max(by_length)
        hashes, numbers = [], []
        for length, found in by_length.items():
            hashes.append(_hash_rows(code_points([pieces[i] for i in found], length)))
            numbers.append(np.array(found))
        hashes, numbers = np.concatenate(hashes), np.concatenate(numbers)
        order = np.argsort(hashes)
        self.hashes, self.numbers = hashes[order], numbers[order]
        if len(np.unique(self.hashes)) != len(pieces):
            raise ValueError("two pieces share a hash")

    @classmethod
    def from_file(cls, path: str) -> "Vocabulary":
        """Ordinary pieces with at most a leading mark, and the scores as the file has them."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        kept = [i for i in range(model.get_piece_size())
                if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        kept = [i for i in kept if (p := model.id_to_piece(i)).strip(START) and START not in p[1:]]
        return cls([model.id_to_piece(i) for i in kept], [model.get_score(i) for i in kept])

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Piece numbers, -1 where there is none."""
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.numbers[at], -1)

    def first_weights(self) -> np.ndarray:
        """Weights of the pieces before any text is seen, then of unknown characters and of word ends.

        The scores of a merge vocabulary are falling ranks; ranks become weights by Zipf's law."""
        rank = np.argsort(np.argsort(-self.scores, kind="stable"), kind="stable")
        weight = 1.0 / (rank + 2.7)
        return np.concatenate([weight, [weight.sum() * 1e-4, weight.sum() / 2]])

    def parameters(self, weights: np.ndarray) -> "Parameters":
        """Log probabilities from weights or expected counts, none of them zero."""
        weights = weights + 1e-3
        first = np.append(self.first, [False, False])
        p = np.where(first, weights / weights[first].sum(), weights / weights[~first].sum())
        return Parameters(np.log(p[:-2]), float(np.log(p[-2] / CODE_POINTS)), float(np.log(p[-1])))


@dataclass(frozen=True)
class Parameters:
    pieces: np.ndarray
    unknown: float
    end: float


class Arcs:
    """Arcs of equally long marked words: ``pieces[i, j]`` are the piece numbers from character i to j."""

    def __init__(self, vocabulary: Vocabulary, codes: np.ndarray):
        self.length = codes.shape[1]
        self.pieces: dict[tuple[int, int], np.ndarray] = {}
        wide = codes.astype(np.uint64)
        for i in range(self.length):
            h = np.full(len(codes), 14695981039346656037, np.uint64)
            marked = i > 0 and (codes[:, i] == ord(START)).any()
            for j in range(i + 1, min(self.length, i + vocabulary.longest) + 1):
                h = (h ^ wide[:, j - 1]) * PRIME
                h ^= h >> np.uint64(29)
                found = vocabulary.find(h)
                if marked:  # a word may hold the mark's own character; first pieces only begin a word
                    found = np.where((found >= 0) & vocabulary.first[found], -1, found)
                if (found >= 0).any():
                    self.pieces[i, j] = found


def _arc_scores(arcs: Arcs, p: Parameters) -> dict[tuple[int, int], np.ndarray]:
    """Log probability of every arc, those of unknown characters among them."""
    padded = np.append(p.pieces, NOTHING)
    out = {span: padded[found] for span, found in arcs.pieces.items()}
    for i in range(arcs.length):
        alone = out.get((i, i + 1))
        out[i, i + 1] = np.full(1, p.unknown) if alone is None else np.logaddexp(alone, p.unknown)
    return out


def forward(arcs: Arcs, n: int, p: Parameters) -> tuple[np.ndarray, dict]:
    """Log of the summed probability of all segmentations of each prefix."""
    scores = _arc_scores(arcs, p)
    alpha = np.full((arcs.length + 1, n), NOTHING)
    alpha[0] = 0
    for (i, j) in sorted(scores, key=lambda s: (s[1], s[0])):
        alpha[j] = np.logaddexp(alpha[j], alpha[i] + scores[i, j])
    return alpha, scores


def backward(arcs: Arcs, n: int, scores: dict) -> np.ndarray:
    """Log of the summed probability of all segmentations of each rest."""
    beta = np.full((arcs.length + 1, n), NOTHING)
    beta[-1] = 0
    for (i, j) in sorted(scores, key=lambda s: (-s[0], -s[1])):
        beta[i] = np.logaddexp(beta[i], beta[j] + scores[i, j])
    return beta


def grouped(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places in the list and code points of marked words of equal length; long words go in smaller groups."""
    by_length = defaultdict(list)
    for at, word in enumerate(words):
        by_length[len(word) + 1].append(at)
    for length, places in by_length.items():
        step = max(1, min(GROUP, (1 << 16) // length))
        for begin in range(0, len(places), step):
            part = places[begin:begin + step]
            yield np.array(part), code_points([START + words[i] for i in part], length)


def marginals(vocabulary: Vocabulary, words: list[str], p: Parameters) -> np.ndarray:
    """Natural log of the summed probability of all segmentations of each word."""
    out = np.zeros(len(words))
    for places, codes in grouped(words):
        out[places] = forward(Arcs(vocabulary, codes), len(codes), p)[0][-1] + p.end
    return out


def expected_counts(vocabulary: Vocabulary, words: list[str], p: Parameters) -> np.ndarray:
    """How often each piece, unknown characters and word ends are expected in the words, by forward and backward sums."""
    n_pieces = len(p.pieces)
    total = np.zeros(n_pieces + 2)
    total[-1] = len(words)
    for places, codes in grouped(words):
        arcs = Arcs(vocabulary, codes)
        alpha, scores = forward(arcs, len(codes), p)
        beta = backward(arcs, len(codes), scores)
        for (i, j) in scores:
            around = alpha[i] + beta[j] - alpha[-1]
            found = arcs.pieces.get((i, j))
            if found is not None:
                has = found >= 0
                share = np.exp(around[has] + p.pieces[found[has]])
                total[:n_pieces] += np.bincount(found[has], share, n_pieces)
            if j == i + 1:
                total[-2] += float(np.exp(around + p.unknown).sum())
    return total
