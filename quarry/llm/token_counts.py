"""Greedy word-piece token counts by a linear longest-match automaton
(operator 7).

The vocabulary becomes a trie.  Each node knows its failure link (the node
that spells what remains once the greedy longest pieces are popped off its
path) and how many tokens that pops, so a word is counted in one pass over its
characters and no piece is ever built.  Words start with the vocabulary's
word mark.  A character that is no piece costs its UTF-8 bytes, as byte
fallback does, so every text has a count."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quarry.llm.common import map_arrow, slices, texts_of

MARK = "▁"


class LongestMatch:
    """Automaton over ``pieces``; ``count(word)`` is the number of tokens of
    the greedy longest-match split of ``mark + word``."""

    def __init__(self, pieces: Iterable[str], mark: str = MARK, room: int = 300_000):
        self.mark, self.room = mark, room
        self.known: dict[bytes, int] = {}
        pieces = {p for p in pieces if p}
        cost = {p: 1 for p in pieces}
        for c in {c for p in pieces for c in p}:  # every single character can be matched
            cost.setdefault(c, len(c.encode()))
        nodes: list[dict[str, int]] = [{}]
        ends: list[int] = [0]  # tokens of the node's path if it is a piece, else 0
        for p, n in cost.items():
            u = 0
            for c in p:
                v = nodes[u].get(c)
                if v is None:
                    v = nodes[u][c] = len(nodes)
                    nodes.append({})
                    ends.append(0)
                u = v
            ends[u] = n
        fail, popped = [0] * len(nodes), [0] * len(nodes)
        todo = deque([0])
        while todo:  # parents before children: links of shorter paths are known
            u = todo.popleft()
            for c, v in nodes[u].items():
                if ends[v]:
                    fail[v], popped[v] = 0, ends[v]
                else:
                    z, n = fail[u], popped[u]
                    while c not in nodes[z]:  # ends at the root, which has every character
                        n += popped[z]
                        z = fail[z]
                    fail[v], popped[v] = nodes[z][c], n
                todo.append(v)
        self.nodes, self.fail, self.popped = nodes, fail, popped

    def scan(self, word: str) -> int:
        nodes, fail, popped = self.nodes, self.fail, self.popped
        u = n = 0
        for c in word:
            while c not in nodes[u]:
                if not u:
                    n += len(c.encode())  # no piece has this character
                    break
                n += popped[u]
                u = fail[u]
            else:
                u = nodes[u][c]
        while u:
            n += popped[u]
            u = fail[u]
        return n

    def count(self, words: list[bytes]) -> int:
        known = self.known
        try:
            return sum([known[w] for w in words])
        except KeyError:
            if len(known) > self.room:
                known.clear()
            for w in set(words):
                if w not in known:
                    known[w] = self.scan(self.mark + w.decode())
            return sum([known[w] for w in words])


_automata: dict[str, LongestMatch] = {}


def automaton(model: str) -> LongestMatch:
    """The automaton of a SentencePiece model's ordinary pieces."""
    if model not in _automata:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        _automata[model] = LongestMatch(sp.id_to_piece(i) for i in range(sp.vocab_size())
                                        if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i)))
    return _automata[model]


def token_counts(docs: DataFrame, model: str) -> DataFrame:
    """``docs(doc_id, text)`` -> ``(doc_id, n_words, n_tokens)``, a row per
    row.  Words are ``[^\\x20\\x09-\\x0D]+``; null and empty texts count 0;
    repeated rows repeat; an empty table gives no rows."""
    src = docs.select("doc_id", "text")
    kind = src.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto = automaton(model)
        for batch in batches:
            texts = texts_of(batch.column(1))
            words, tokens = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
            for lo, hi in slices(texts):
                for i, text in enumerate(texts.slice(lo, hi - lo).to_pylist(), lo):
                    found = text.encode().split()
                    words[i], tokens[i] = len(found), auto.count(found)
            yield pa.record_batch([batch.column(0), pa.array(words), pa.array(tokens)],
                                  names=["doc_id", "n_words", "n_tokens"])

    return map_arrow(src, run, f"doc_id {kind}, n_words bigint, n_tokens bigint")
