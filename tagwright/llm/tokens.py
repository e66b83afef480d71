"""Token counts by dynamic programming over a trie of pre-tokens.

The pieces and scores of a vocabulary file are read as a unigram model: a pre-token is split into the
pieces with the greatest sum of scores. A prefix of a pre-token has a best score of its own, and
pre-tokens share prefixes, so each task inserts its distinct pre-tokens into a trie and computes the score once per
node, from the nodes above; a pre-token's count is stored at its last node.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagwright.llm.common import as_bytes

#: A task forgets its trie at so many nodes; results are the same.
NODES = 2_000_000
#: A longer pre-token goes on without nodes from here; only the scores of its last prefixes are kept.
DEEP = 4096
#: Stands before every pre-token, as in the vocabulary.
START = "▁"
#: How much worse than the worst piece a character outside the vocabulary is.
UNKNOWN = 10.0


def vocabulary(piece_file: str) -> dict[str, float]:
    """Piece → score, without control, byte, unknown and unused pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=piece_file)
    return {
        model.id_to_piece(i): model.get_score(i)
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    }


class Trie:
    """Pre-tokens as paths. Node arrays hold the best score of a prefix and its number of tokens.

    A character outside the vocabulary counts as its UTF-8 bytes. Of equal scores the split whose last piece is
    shortest wins. Prefixes are never recomputed: a new pre-token starts at the deepest node it has. At ``nodes`` nodes the
    trie is emptied, and no pre-token adds more than ``deep``, however long it is.
    """

    def __init__(self, scores: dict[str, float], nodes: int = NODES, deep: int = DEEP):
        self.nodes, self.deep = nodes, deep
        self.by_end: dict[str, list[tuple[str, int, float]]] = {}
        for piece, s in scores.items():
            self.by_end.setdefault(piece[-1], []).append((piece, len(piece), s))
        self.scores = scores
        self.longest = max(map(len, scores), default=1)
        self.worst = min(scores.values(), default=0.0) - UNKNOWN
        self.clear()

    def clear(self) -> None:
        self.children: list[dict[str, int]] = [{}]
        self.parent, self.best, self.count, self.ends = [0], [0.0], [0], {}

    def __len__(self) -> int:
        return len(self.best)

    def add(self, token: str) -> int:
        """The number of pieces of the pre-token."""
        known = self.ends.get(token)
        if known is not None:
            return known
        if len(self) > self.nodes:
            self.clear()
        path, node = [0], 0
        children, scores, best, count = self.children, self.scores, self.best, self.count
        for i, c in enumerate(token[: self.deep]):
            below = children[node].get(c)
            if below is None:
                # The forward step: the last piece of this prefix is one of its suffixes.
                top, n = best[node] + self.worst, count[node] + len(c.encode())
                if c in scores:
                    top, n = best[node] + scores[c], count[node] + 1
                for j in range(i - 1, max(-1, i - self.longest), -1):
                    s = scores.get(token[j : i + 1])
                    if s is not None and best[path[j]] + s > top:
                        top, n = best[path[j]] + s, count[path[j]] + 1
                below = len(best)
                children[node][c] = below
                children.append({})
                best.append(top)
                count.append(n)
            node = below
            path.append(node)
        if len(token) > self.deep:
            return self._beyond(token, path)
        self.ends[token] = count[node]
        return count[node]

    def _beyond(self, token: str, path: list[int]) -> int:
        """The same forward steps after the deepest node, over the scores of the last prefixes only."""
        scores, kept = self.scores, self.longest
        last = [(self.best[p], self.count[p]) for p in path[-kept:]]
        for i in range(len(path) - 1, len(token)):
            c = token[i]
            before, pieces = last[-1]
            top, n = before + self.worst, pieces + len(c.encode())
            if c in scores:
                top, n = before + scores[c], pieces + 1
            for back in range(1, min(len(last), kept - 1, i + 1)):
                s = scores.get(token[i - back : i + 1])
                if s is not None and last[-1 - back][0] + s > top:
                    top, n = last[-1 - back][0] + s, last[-1 - back][1] + 1
            last.append((top, n))
            if len(last) > 64 * kept:
                del last[:-kept]
        return last[-1][1]


def count_tokens(docs: DataFrame, piece_file: str, nodes: int = NODES) -> DataFrame:
    """Per row: ``doc_id``, ``n_pretokens``, ``n_tokens``.

    Pre-tokens are the runs of characters between ASCII blanks, with the start sign before each. Null and
    empty texts have none; a pre-token of any length takes bounded memory beside its text. Rows stand alone: repeated rows and doc_ids give repeated results, other
    columns are ignored, an empty table gives no rows. There is no shuffle.
    """
    from collections import Counter

    def work(batches):
        trie = Trie(vocabulary(piece_file), nodes)
        for batch in batches:
            lengths, totals = [], []
            for text in as_bytes(batch.column(1)):
                words = Counter(text.split())
                lengths.append(sum(words.values()))
                totals.append(sum(trie.add(START + w.decode()) * n for w, n in words.items()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lengths, pa.int64()), pa.array(totals, pa.int64())],
                ["doc_id", "n_pretokens", "n_tokens"],
            )

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(work, f"doc_id {kind}, n_pretokens long, n_tokens long")
