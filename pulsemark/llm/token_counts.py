"""Numbers of word pieces per text by linear longest-match tokenization, without building the pieces.

Words are split at white space and cut greedily into the longest pieces of a vocabulary; pieces at the start
of a word and inside it differ. The pieces form a trie. A node from which matching cannot go on has a
failure link to the node that stands for what is left after its longest pieces are taken, and the number of
pieces taken is computed beforehand, so that a word needs one step per character and per link followed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsemark.llm import vocab
from pulsemark.llm.text import Memory, Words, runs, short_batches, sum_by_row


class LongestMatch:
    """The trie with failure links and popped-piece counts. Node 0 starts a word, node 1 continues one."""

    def __init__(self, pieces):
        """``pieces``: strings; those with a leading marker U+2581 stand at the start of a word."""
        self.next: list[dict[str, int]] = [{}, {}]
        ends: set[int] = set()
        for piece in pieces:
            first = piece.startswith(vocab.SPACE)
            node = 0 if first else 1
            for char in piece[1:] if first else piece:
                node = self.next[node].setdefault(char, len(self.next))
                if node == len(self.next):
                    self.next.append({})
            if node > 1:
                ends.add(node)
        self.link: list[int | None] = [None] * len(self.next)
        self.popped = [0] * len(self.next)
        if vocab.SPACE in pieces:  # the marker alone is a piece: a word may begin with it
            self.link[0], self.popped[0] = 1, 1
        queue = [0, 1]
        for node in queue:  # breadth first; the list grows as it is read
            for char, child in self.next[node].items():
                queue.append(child)
                if child in ends:
                    self.link[child], self.popped[child] = 1, 1
                    continue
                at, popped = self.link[node], self.popped[node]
                while at is not None and char not in self.next[at]:
                    popped, at = popped + self.popped[at], self.link[at]
                if at is not None:
                    self.link[child], self.popped[child] = self.next[at][char], popped
        self.memory = Memory(2)

    def count(self, word: str) -> tuple[int, int]:
        """Pieces of a word and 0, or 1 and 1 for a word that the pieces cannot spell: one unknown token."""
        node, total = 0, 0
        steps, link, popped = self.next, self.link, self.popped
        for char in word:
            while (after := steps[node].get(char)) is None:
                if link[node] is None:
                    return 1, 1
                total, node = total + popped[node], link[node]
            node = after
        while node > 1:
            if link[node] is None:
                return 1, 1
            total, node = total + popped[node], link[node]
        return total, 0

    def rows(self, words: Words) -> np.ndarray:
        return self.memory.look_up(words, lambda picked: np.array(
            [self.count(words.text(k)) for k in picked], np.float32).reshape(-1, 2))


def _counted(shared):
    def run(batches):
        matcher = shared.value
        for batch in batches:
            out = [np.zeros((0, 3))]
            for _, _, data, at in runs(batch.column(0)):
                words = Words(data, at, lower=False)
                sums = sum_by_row(matcher.rows(words), words.bounds)
                out.append(np.column_stack([np.diff(words.bounds), sums]))
            columns = [pa.array(c.astype(np.int64)) for c in np.concatenate(out).T]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], *columns], [*batch.schema.names[1:], "n_words", "n_tokens", "n_unknown"])
    return run


def count_tokens(docs: DataFrame, keep: list[str], text_column: str = "text", path: str = vocab.PIECES) -> DataFrame:
    """The columns ``keep`` with the numbers of words, of tokens, and of words that are one unknown token.

    A null or empty text has none of each. Each row stands alone: repeated rows and null ids are kept, an
    empty table gives an empty result. No kept column may have the new names.
    """
    shared = short_batches(docs.sparkSession).sparkContext.broadcast(LongestMatch(vocab.load(path).ids))
    asked = docs.select(F.col(f"`{text_column}`").alias("_text"), *[F.col(f"`{c}`") for c in keep])
    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.select(*keep).schema)
    return asked.mapInArrow(_counted(shared), f"{kept}n_words long, n_tokens long, n_unknown long")
