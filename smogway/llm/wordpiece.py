"""Token counts by linear longest match: a trie with failure links and precomputed popped-token counts.

A word, with the word-start mark before it, is read once, character by character. Where the trie has no next node,
the failure link moves to the node of what is left after the tokens that must end there, and their number,
stored with the link, is added: no piece is ever built, no character read twice.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smogway.llm.common import narrowed, public_id, text_slices

WORD_START = "▁"
#: Counts of words are remembered within a task, for at most so many words at a time.
REMEMBERED = 300_000


class Automaton:
    """Greedy longest-match token counts over a vocabulary.

    A character at which no piece begins is as many tokens as it has UTF-8 bytes, or one if not `byte_fallback`.
    """

    def __init__(self, pieces: Iterable[str], byte_fallback: bool = True):
        self.byte_fallback = byte_fallback
        self.next: list[dict[str, int]] = [{}]
        self.fail, self.popped = [0], [0]
        is_piece = [False]
        for piece in pieces:
            node = 0
            for c in piece:
                if c not in self.next[node]:
                    self.next[node][c] = len(self.next)
                    self.next.append({})
                    is_piece.append(False)
                node = self.next[node][c]
            is_piece[node] = node > 0
        self.fail, self.popped = [0] * len(self.next), [0] * len(self.next)
        level = [(0, c, v) for c, v in self.next[0].items()]
        while level:  # breadth first: links lead to shallower nodes
            deeper = []
            for parent, c, node in level:
                if is_piece[node]:
                    self.popped[node], self.fail[node] = 1, 0
                elif parent == 0:
                    self.popped[node], self.fail[node] = self._alone(c), 0
                else:
                    self.fail[node], self.popped[node] = self._step(self.fail[parent], c, self.popped[parent])
                deeper += [(node, d, v) for d, v in self.next[node].items()]
            level = deeper

    def _alone(self, c: str) -> int:
        return len(c.encode("utf-8", "surrogatepass")) if self.byte_fallback else 1

    def _step(self, node: int, c: str, count: int) -> tuple[int, int]:
        """The node after `c`, and `count` with the tokens that ended before it."""
        while True:
            to = self.next[node].get(c)
            if to is not None:
                return to, count
            if node == 0:
                return 0, count + self._alone(c)
            count += self.popped[node]
            node = self.fail[node]

    def count(self, word: str) -> int:
        node = count = 0
        step = self._step
        for c in word:
            node, count = step(node, c, count)
        while node:
            count += self.popped[node]
            node = self.fail[node]
        return count


class _Remembered(dict):
    """Token counts by word as bytes."""

    def __init__(self, automaton: Automaton):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        n = self.automaton.count(WORD_START + word.decode("utf-8", "replace"))
        self[word] = n
        return n


def sentencepiece_pieces(path: str) -> list[str]:
    """The ordinary pieces of a SentencePiece model file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [
        model.id_to_piece(i) for i in range(model.vocab_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    ]


def token_counts(docs: DataFrame, pieces: Iterable[str], byte_fallback: bool = True) -> DataFrame:
    """`doc_id, n_words, n_tokens, longest_word_tokens` for every row of `docs`.

    Words are maximal runs without ASCII white space; each is matched greedily from the word-start mark on. NULL
    and empty texts have 0 words and tokens. The automaton is built once and its size is that of the vocabulary.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Automaton(pieces, byte_fallback))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Remembered(shared.value)
        for piece in text_slices(batches):
            raw, off = piece.data.tobytes(), piece.offsets.tolist()
            words, tokens, longest = [], [], []
            for a, b in zip(off, off[1:]):
                counts = np.fromiter(map(known.__getitem__, raw[a:b].split()), np.int64)
                words.append(len(counts))
                tokens.append(int(counts.sum()))
                longest.append(int(counts.max(initial=0)))
            yield pa.RecordBatch.from_arrays(
                [piece.batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in (words, tokens, longest))],
                ["doc_id", "n_words", "n_tokens", "longest_word_tokens"],
            )

    out = narrowed(docs).mapInArrow(run, "doc_id long, n_words long, n_tokens long, longest_word_tokens long")
    return out.select(public_id(), *(F.col(c) for c in ("n_words", "n_tokens", "longest_word_tokens")))
