"""Token counts by unigram segmentation of pre-tokens that share a trie."""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tillroll.llm.common import ship

_SPACE = "▁"  # stands for the space before a word in the vocabulary
_POINTS = 0x110000
_tries: dict[str, TrieCounts] = {}


def log_scores(path: str) -> tuple[dict[str, float], float]:
    """Log-probability of each ordinary piece of a sentencepiece vocabulary, and of one fallback byte.

    The vocabulary lists its merges from the most frequent on, so a piece's probability is taken from its rank by
    Zipf's law. Nothing is trained.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [i for i in range(model.vocab_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    total = math.log(sum(1 / (r + 2.7) for r in range(len(pieces))))
    scores = {model.id_to_piece(i): -math.log(r + 2.7) - total for r, i in enumerate(pieces)}
    return scores, min(scores.values()) - 1.0


class TrieCounts(dict):
    """Tokens of each pre-token seen: its best segmentation, by the highest sum of scores, then the fewest tokens.

    Pre-tokens are paths of one trie. A node holds the best score of its prefix and the tokens of that; they are
    computed from the nodes above when the node is made, so words with a common prefix share the work. The number at
    a word's last node is kept under the word. `nodes` and `words` bound both stores; a full one starts anew.
    """

    def __init__(self, scores: Mapping[str, float], byte: float, nodes: int = 500_000, words: int = 1_000_000):
        super().__init__()
        self.pieces, self.byte, self.nodes, self.words = scores, byte, nodes, words
        self.longest = max(map(len, scores), default=1)
        self.next: dict[int, int] = {}
        self.best: list[tuple[float, int]] = [(0.0, 0)]

    def __missing__(self, word: str) -> int:
        if len(self) >= self.words:
            self.clear()
        if len(self.best) > self.nodes:
            self.next, self.best = {}, [(0.0, 0)]
        tokens = self[word] = self._walk(_SPACE + word)
        return tokens

    def _walk(self, text: str) -> int:
        down, best, node, path = self.next, self.best, 0, [0]
        for at, letter in enumerate(text, 1):
            key = node * _POINTS + ord(letter)
            node = down.get(key)
            if node is None:
                node = down[key] = len(best)
                best.append(self._score(text, at, path))
            path.append(node)
        return -best[node][1]

    def _score(self, text: str, at: int, path: list[int]) -> tuple[float, int]:
        """The best of all last pieces that end at `at`; (score, minus tokens), so that the greater is the better."""
        best, pieces, top = self.best, self.pieces, None
        for start in range(max(0, at - self.longest), at):
            score = pieces.get(text[start:at])
            if score is not None:
                before, tokens = best[path[start]]
                here = (before + score, tokens - 1)
                if top is None or here > top:
                    top = here
        if text[at - 1] not in pieces:
            size = len(text[at - 1].encode("utf-8", "surrogatepass"))
            before, tokens = best[path[at - 1]]
            here = (before + size * self.byte, tokens - size)
            if top is None or here > top:
                top = here
        return top


def counter(path: str) -> TrieCounts:
    if path not in _tries:
        _tries[path] = TrieCounts(*log_scores(path))
    return _tries[path]


def count_tokens(docs: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, pretokens, tokens) for each row of `docs` (doc_id, text).

    Pre-tokens are the words between white space, each with the space before it. Letters that the vocabulary lacks
    count one token for each of their UTF-8 bytes. Each task keeps one trie for all its rows; nothing is shuffled.

    Null or empty text has no tokens. Null ids and repeated rows are rows each. Other columns are ignored; an empty
    table gives no rows.
    """
    ship(docs.sparkSession)

    def task(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = counter(vocabulary)
        for batch in stream:
            words, tokens = [], []
            for text in batch.column(1):
                own = (text.as_py() or "").split()
                words.append(len(own))
                tokens.append(sum(map(known.__getitem__, own)))
            yield pa.record_batch([batch.column(0), pa.array(words, pa.int64()), pa.array(tokens, pa.int64())], names=["doc_id", "pretokens", "tokens"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(task, "doc_id long, pretokens long, tokens long")
