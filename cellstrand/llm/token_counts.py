"""Token counts by a linear longest-match automaton.

Greedy longest-match word pieces of a word are found in one pass over its bytes: a trie of the
vocabulary, where a node that has no edge for the next byte follows a failure link that pops one or
more whole pieces at once. How many pieces each failure link pops is worked out when the automaton
is built, so counting never builds a piece. Continuation pieces hang below a second root.

A word begins with its space in the vocabulary (`initial` pieces carry the mark), continuation
pieces carry none. A word that cannot be covered counts as one unknown token.

Defined results: null, empty and blank texts have no words and no tokens; texts of any length are
counted whole; repeated rows and ids give repeated rows; other columns are not read.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from cellstrand.llm.common import bytes_of, id_and_text, slices

#: Distinct words that a worker remembers the count of.
REMEMBERED = 1_000_000


class LongestMatch:
    """Automaton over initial and continuation pieces; both are byte strings without any mark."""

    def __init__(self, initial: Iterable[bytes], continuation: Iterable[bytes]):
        #: edges[node] maps a byte to a node; node 0 begins a word, node 1 a continuation
        self.edges: list[dict[int, int]] = [{}, {}]
        self.is_piece = [False, False]
        parent: list[tuple[int, int]] = [(0, 0), (0, 0)]
        for root, pieces in ((0, initial), (1, continuation)):
            for piece in pieces:
                node = root
                for byte in piece:
                    after = self.edges[node].get(byte)
                    if after is None:
                        after = self.edges[node][byte] = len(self.edges)
                        self.edges.append({})
                        self.is_piece.append(False)
                        parent.append((node, byte))
                    node = after
                self.is_piece[node] = self.is_piece[node] or node > 1
        #: where a node goes on when it has no edge, and the pieces that are then complete; -1: nowhere
        self.fail, self.pops = [-1] * len(self.edges), [0] * len(self.edges)
        level = [n for root in (0, 1) for n in self.edges[root].values()]
        while level:
            after = []
            for node in level:
                after += self.edges[node].values()
                if self.is_piece[node]:
                    self.fail[node], self.pops[node] = 1, 1
                    continue
                above, byte = parent[node]
                at, popped = self.fail[above], self.pops[above]
                while at >= 0 and byte not in self.edges[at]:
                    popped += self.pops[at]
                    at = self.fail[at]
                if at >= 0:
                    self.fail[node], self.pops[node] = self.edges[at][byte], popped
            level = after

    def count(self, word: bytes) -> int:
        """Pieces of the greedy longest match; 1 if the word cannot be covered; 0 for no bytes."""
        edges, fail, pops = self.edges, self.fail, self.pops
        node, found = 0, 0
        for byte in word:
            while (after := edges[node].get(byte)) is None:
                found += pops[node]
                node = fail[node]
                if node < 0:
                    return 1
            node = after
        # at the end, failure links lead to the continuation root only if all that is left is covered
        while node > 1:
            found += pops[node]
            node = fail[node]
        return found if node == 1 or not word else 1


def byte_of_letter() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary file stands for: printable bytes are themselves, others follow from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("\xa1"), ord("\xac") + 1), *range(ord("\xae"), ord("\xff") + 1)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


@lru_cache(maxsize=2)
def automaton(path: str) -> LongestMatch:
    """Word pieces of a byte-level vocabulary: those with a leading space begin words, the others continue them."""
    letters = byte_of_letter()
    with open(path, encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    pieces = [bytes(letters[c] for c in token) for token in vocabulary if all(c in letters for c in token)]
    return LongestMatch([p[1:] for p in pieces if p[:1] == b" " and len(p) > 1], [p for p in pieces if p[:1] != b" "])


@lru_cache(maxsize=2)
def known_counts(path: str) -> dict[bytes, int]:
    return {}


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_words (parted by ASCII white space) and n_tokens of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, known = automaton(path), known_counts(path)
        for batch in slices(batches):
            words, tokens = [], []
            rows = [t.split() for t in bytes_of(batch.column(1))]
            if len(known) > REMEMBERED:
                known.clear()
            for word in set().union(*rows).difference(known):
                known[word] = own.count(word)
            for row in rows:
                words.append(len(row))
                tokens.append(sum([known[w] for w in row]))
            yield pa.record_batch([batch.column(0), pa.array(words, pa.int64()), pa.array(tokens, pa.int64())], names=["doc_id", "n_words", "n_tokens"])

    return id_and_text(docs).mapInArrow(run, "doc_id long, n_words long, n_tokens long")
