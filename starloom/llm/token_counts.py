"""Token counts by dynamic programming over a trie of pre-tokens.

A pre-token is a word (a run outside ``\\x20`` and ``\\x09-\\x0D``) with a leading
word mark. Its tokens are the segmentation into vocabulary pieces with the
largest sum of scores; of equal sums, the one whose last piece is shortest wins,
position by position. A character in no piece costs ``unknown`` and counts as
its UTF-8 bytes (the vocabulary has a piece for each byte).

Distinct pre-tokens are inserted in a trie. A node keeps the best score and the
token count of its prefix, computed once when the node is made from the nodes
above it, so pre-tokens that share a prefix share that work; the node a
pre-token ends at stores its count. Documents need no shuffle: every task
grows the trie over its own documents and starts it anew when it is full.

Defined results: a null, empty or blank text has no pre-tokens, no tokens and
score 0. Repeated rows are each counted.
"""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from starloom.llm.words import texts

MARK = "▁"
UNKNOWN = -100_000.0
#: Nodes after which a task starts its trie anew; this bounds memory, not results.
MAX_NODES = 1_500_000


def load_pieces(model_path: str) -> dict[str, float]:
    """Pieces and scores of a sentencepiece model, without control and byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_proto=Path(model_path).read_bytes())
    return {
        model.id_to_piece(i): model.get_score(i)
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
    }


class Trie:
    """Prefixes of pre-tokens with their best score and its number of tokens."""

    def __init__(self, pieces: dict[str, float], max_nodes: int = MAX_NODES) -> None:
        self.pieces = pieces
        self.longest = max(map(len, pieces), default=0)
        self.endings: dict[str, list[int]] = {}
        for piece in pieces:
            self.endings.setdefault(piece[-1], []).append(len(piece))
        self.endings = {k: sorted(set(v)) for k, v in self.endings.items()}
        self.max_nodes = max_nodes
        self.terminals: dict[bytes, tuple[int, float]] = {}
        self._restart()

    def _restart(self) -> None:
        self.children: dict[tuple[int, str], int] = {}
        self.score = [0.0]
        self.count = [0]
        self.terminals.clear()

    def __call__(self, word: bytes) -> tuple[int, float]:
        """(tokens, score) of a pre-token."""
        known = self.terminals.get(word)
        if known is None:
            if len(self.score) >= self.max_nodes:
                self._restart()
            node = self._insert(MARK + word.decode("utf-8", "replace"))
            known = self.terminals[word] = (self.count[node], self.score[node])
        return known

    def _insert(self, text: str) -> int:
        path = [0]
        for end, letter in enumerate(text, 1):
            at = (path[-1], letter)
            node = self.children.get(at)
            if node is None:
                node = self.children[at] = len(self.score)
                self._forward(path, text, end)
            path.append(node)
        return path[-1]

    def _forward(self, path: list[int], text: str, end: int) -> None:
        """The new node's score from the nodes where its last piece may begin."""
        best = None
        for size in self.endings.get(text[end - 1], ()):
            if size > end:
                break
            value = self.pieces.get(text[end - size : end])
            if value is not None:
                value += self.score[path[end - size]]
                if best is None or value > best[0]:
                    best = (value, self.count[path[end - size]] + 1)
        if best is None:
            above = path[end - 1]
            best = (self.score[above] + UNKNOWN, self.count[above] + len(text[end - 1].encode()))
        self.score.append(best[0])
        self.count.append(best[1])


def count_tokens(
    docs: DataFrame,
    pieces: dict[str, float],
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    max_nodes: int = MAX_NODES,
) -> DataFrame:
    """One row per document: id, n_pretokens, n_tokens, score (sum over its pre-tokens).

    ``pieces`` travels to the tasks; a vocabulary is bounded by its file.
    """
    id_type = docs.schema[id_column].dataType.simpleString()
    given = docs.sparkSession.sparkContext.broadcast(pieces)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie(given.value, max_nodes)
        for batch in batches:
            pretokens, tokens, scores = [], [], []
            for text in texts(batch, 1):
                words = text.split()
                found = np.array([trie(word) for word in words], np.float64).reshape(-1, 2)
                pretokens.append(len(words))
                tokens.append(int(found[:, 0].sum()))
                scores.append(float(found[:, 1].sum()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(pretokens, pa.int64()), pa.array(tokens, pa.int64()), pa.array(scores)],
                names=[id_column, "n_pretokens", "n_tokens", "score"],
            )

    return docs.select(id_column, text_column).mapInArrow(
        count, f"{id_column} {id_type}, n_pretokens long, n_tokens long, score double"
    )
