"""Token counts under a unigram vocabulary, computed over a trie of distinct pre-tokens.

A pre-token's best segmentation needs, at each position, only the best segmentations of shorter
prefixes. Distinct pre-tokens go into a trie; each node holds the forward score and token count of
its prefix, computed once however many pre-tokens share it. A pre-token's count is what its terminal
node holds. The trie is ``DEEPEST`` characters deep; a longer pre-token goes on from its node there with the scores of as many
characters as a piece can have, so memory does not follow its length. A worker starts a new trie when one holds ``MOST_NODES``.

Scores: the vocabulary file ranks its pieces; piece of rank r (0 the most frequent) has the Zipf
log-probability ``-ln(r + 2.7)``. A character outside the vocabulary costs one token a UTF-8 byte,
each as dear as the rarest piece. The best segmentation has the greatest sum; of equal sums the one with
fewer tokens counts.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidewright.llm._common import map_texts, vocabulary_path
from tidewright.llm.sentencepieces import MODEL, SPACE, Recent, piece_table

MOST_NODES = 400_000
DEEPEST = 64
#: Bytes, about, of the counts that a worker remembers; two generations are held.
KEPT_BYTES = 64_000_000
ZIPF_SHIFT = 2.7


class UnigramTrie:
    """Forward scores over a trie. ``scores`` maps pieces to log-probabilities."""

    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        self.rarest = min(scores.values())
        sizes: dict[str, set[int]] = {}
        for p in scores:
            sizes.setdefault(p[-1], set()).add(len(p))
        self.sizes = {c: sorted(s) for c, s in sizes.items()}
        self.longest = max(map(len, scores))
        self.counts: Recent = Recent(KEPT_BYTES, 150, 1)
        self.clear()

    def clear(self) -> None:
        self.child: dict[tuple[int, str], int] = {}
        self.best: list[tuple[float, int]] = [(0.0, 0)]  # by node: greatest score, minus its token count

    def forward(self, before: list[tuple[float, int]], text: str, end: int) -> tuple[float, int]:
        """Score and minus the count of ``text[:end]``; ``before`` holds those of shorter prefixes, ``before[-1]`` of the next shorter."""
        c, scores = text[end - 1], self.scores
        score, count = before[-1]
        found = None
        if c not in scores:
            size = len(c.encode("utf-8"))
            found = (score + size * self.rarest, count - size)
        for size in self.sizes.get(c, ()):
            if size > end:
                break
            piece = scores.get(text[end - size : end])
            if piece is not None:
                score, count = before[-size]
                here = (score + piece, count - 1)
                if found is None or here > found:
                    found = here
        return found

    def count(self, pre_token: str) -> int:
        """Walks to the terminal, adding the nodes that are missing."""
        best, child = self.best, self.child
        if len(best) > MOST_NODES:
            self.clear()
            best, child = self.best, self.child
        at, path = 0, [best[0]]
        for end, c in enumerate(pre_token[:DEEPEST], 1):
            below = child.get((at, c))
            if below is None:
                best.append(self.forward(path, pre_token, end))
                below = child[at, c] = len(best) - 1
            at = below
            path.append(best[at])
        for end in range(DEEPEST + 1, len(pre_token) + 1):
            path.append(self.forward(path, pre_token, end))
            if len(path) > 4 * self.longest:
                del path[: -self.longest]
        return -path[-1][1]

    def count_all(self, pre_tokens: list[str]) -> int:
        counts, total, unknown = self.counts, 0, []
        for p in pre_tokens:
            try:
                total += counts[p]
            except KeyError:
                unknown.append(p)
        for p in unknown:
            n = counts[p] = self.count(p)
            total += n
        return total


def zipf_scores(model_path: str) -> dict[str, float]:
    """Log-probabilities of the ordinary pieces of a vocabulary file by their rank."""
    return {p: -math.log(rank + ZIPF_SHIFT) for rank, p in enumerate(piece_table(model_path).ids)}


_tries: dict[str, UnigramTrie] = {}


def token_counts(docs: DataFrame, text: str = "text", model_path: str | None = None) -> DataFrame:
    """Adds ``n_pretokens`` and ``n_tokens`` (long) to each row; drops ``text``.

    A pre-token is a run of blanks with the characters up to the next blank or line break; a blank is put
    before the text. Null and empty texts count zero. Very long texts, and pre-tokens without a blank, are counted whole in time
    linear in them. Of segmentations with equal scores the one with fewer tokens counts. Other columns pass through, except old
    ones of the two names; repeated rows stay; an empty table gives an empty result.
    """

    def start():
        path = model_path or vocabulary_path(MODEL)
        if path not in _tries:
            _tries[path] = UnigramTrie(zipf_scores(path))
        trie, table = _tries[path], piece_table(path)

        def work(texts):
            split = [table.stretches(x or "") for x in texts]
            fresh = set().union(*split) - trie.counts.keys() - trie.counts.old.keys() if split else set()
            for p in sorted(fresh):  # neighbours share long prefixes
                trie.counts[p] = trie.count(p)
            return {"n_pretokens": [len(s) for s in split], "n_tokens": [trie.count_all(s) for s in split]}

        return work

    added = T.StructType([T.StructField("n_pretokens", T.LongType()), T.StructField("n_tokens", T.LongType())])
    return map_texts(docs.drop("n_pretokens", "n_tokens"), start, added, text)


__all__ = ["SPACE", "UnigramTrie", "token_counts", "zipf_scores"]
