"""Token counts by a linear longest-match automaton.

Greedy word pieces: from the start of a word, the longest piece that fits, then
the longest from there, and so on.  The automaton is a trie of the pieces in
which every node has a failure link, to the node where matching goes on once
the pieces that are certain have been taken off its string, and the number of
those pieces.  It reads each character once and adds numbers; no piece is ever
built.

Words are runs without white space.  Pieces that begin a word carry the mark
``▁``; a mark alone, if it is a piece, may begin any word.  A word that the
pieces can't cover is one unknown token.

Corner cases: a null or empty text has no words and no tokens; a vocabulary
without pieces makes every word one unknown token; the mark itself, written in
a text, is an ordinary character; a very long text or word is read whole, in
linear time; of pieces that fit the longest is taken, so there are no ties;
repeated rows get equal results; an empty table gives no rows.  Only the text
is read; columns to carry that are called n_words or n_tokens are for the
caller to rename (``common.set_aside``).
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from timeloom.llm import common

MARK = "▁"


class Automaton:
    """goto, fail and pops by node; node 0 stands inside a word, ``start`` before its first character."""

    def __init__(self, pieces):
        self.goto: list[dict[str, int]] = [{}]
        ends = {0: False}
        for piece in pieces:
            if not piece or MARK in piece[1:]:
                continue
            node = 0
            for c in piece:
                if c not in self.goto[node]:
                    self.goto[node][c] = len(self.goto)
                    ends[len(self.goto)] = False
                    self.goto.append({})
                node = self.goto[node][c]
            ends[node] = True
        # The mark's own edge is moved off node 0, so that texts can't take it.
        self.start = self.goto[0].pop(MARK, None)
        if self.start is None:
            self.start = len(self.goto)
            ends[self.start] = False
            self.goto.append({})
        self.fail = [-1] * len(self.goto)
        self.pops = [0] * len(self.goto)
        self._link(ends)

    def _link(self, ends: dict[int, bool]) -> None:
        goto, fail, pops = self.goto, self.fail, self.pops
        if ends[self.start]:
            fail[self.start], pops[self.start] = 0, 1
        queue = [(0, c, v) for c, v in goto[0].items()] + [(self.start, c, v) for c, v in goto[self.start].items()]
        for parent, c, node in queue:  # grows while it is read: breadth first
            if ends[node]:
                fail[node], pops[node] = 0, 1
            else:
                z, taken = fail[parent], pops[parent]
                while z != -1 and c not in goto[z]:
                    taken += pops[z]
                    z = fail[z]
                if z != -1:
                    fail[node], pops[node] = goto[z][c], taken
            queue += [(node, x, v) for x, v in goto[node].items()]

    def count(self, word: str) -> int:
        goto, fail, pops = self.goto, self.fail, self.pops
        node, total = self.start, 0
        for c in word:
            while c not in goto[node]:
                total += pops[node]
                node = fail[node]
                if node == -1:
                    return 1
            node = goto[node][c]
        while node:
            total += pops[node]
            node = fail[node]
            if node == -1:
                return 1
        return total


@lru_cache(1)
def worker_counts(pieces: tuple[str, ...]) -> common.Kept:
    return common.Kept(Automaton(pieces).count)


def sentence_pieces(path: str) -> tuple[str, ...]:
    """The ordinary pieces of a sentencepiece model; its form is the marked one already."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    odd = (model.is_control, model.is_unknown, model.is_byte, model.is_unused)
    return tuple(model.id_to_piece(i) for i in range(model.get_piece_size()) if not any(f(i) for f in odd))


def word_pieces(lines: list[str]) -> tuple[str, ...]:
    """Marked pieces from a vocabulary in which ``##`` marks those inside words."""
    return tuple(x[2:] if x.startswith("##") else MARK + x for x in lines)


def count_tokens(docs: DataFrame, pieces: tuple[str, ...], *keep: str, text: str = "text") -> DataFrame:
    """The columns ``keep`` with n_words and n_tokens of each whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(tuple(pieces))

    def make():
        counts = worker_counts(shared.value)
        counts.make_room()
        look = counts.__getitem__

        def score(texts):
            words = [t.split() for t in texts]
            return {"n_words": [len(w) for w in words], "n_tokens": [sum(map(look, w)) for w in words]}

        return score

    return common.map_text(docs, list(keep), make, [("n_words", T.LongType()), ("n_tokens", T.LongType())], text)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count_tokens(common.documents(spark, sf_dir), sentence_pieces(public_tokenizers.path("piece_bpe_32k.model")), "doc_id")
