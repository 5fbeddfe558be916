"""Removal of passages that an earlier document already holds, by suffix automata of reference shards.

The reference shards are the distinct segments at shared anchors (see ``repeats``).  A shard's automaton is sent only to
where segments with its anchors are, as an automaton of the whole corpus would outgrow any task.  Streaming a segment
through the automaton gives, at each word, the longest match and the smallest doc_id that holds it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storeops.llm.repeats import WORDS, removals, spans
from storeops.llm.rolling import Words, chunks

LENGTH = 13


class Automaton:
    """Suffix automaton of several word sequences; each state knows the smallest document among its occurrences."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.size, self.low = [-1], [0], [1 << 62]

    def _state(self, size: int, low: int, link: int = 0, after: dict | None = None) -> int:
        self.next.append(dict(after) if after else {})
        self.size.append(size)
        self.low.append(low)
        self.link.append(link)
        return len(self.size) - 1

    def _clone(self, p: int, q: int, word: int) -> int:
        """The part of q that follows p, as a state of its own."""
        new = self._state(self.size[p] + 1, self.low[q], self.link[q], self.next[q])
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = new
            p = self.link[p]
        self.link[q] = new
        return new

    def add(self, words: list[int], doc: int) -> None:
        last = 0
        for word in words:
            q = self.next[last].get(word)
            if q is not None:
                last = q if self.size[q] == self.size[last] + 1 else self._clone(last, q, word)
                if doc < self.low[last]:
                    self.low[last] = doc
                continue
            new, p = self._state(self.size[last] + 1, doc), last
            while p >= 0 and word not in self.next[p]:
                self.next[p][word] = new
                p = self.link[p]
            if p >= 0:
                q = self.next[p][word]
                self.link[new] = q if self.size[q] == self.size[p] + 1 else self._clone(p, q, word)
            last = new

    def finish(self) -> None:
        """Carry the smallest document up the suffix links."""
        for s in sorted(range(1, len(self.size)), key=self.size.__getitem__, reverse=True):
            up = self.link[s]
            if self.low[s] < self.low[up]:
                self.low[up] = self.low[s]

    def windows(self, words: list[int], length: int) -> np.ndarray:
        """Smallest document of each window of ``length`` words, a very large number where none holds it."""
        state, matched, out = 0, 0, np.full(max(len(words) - length + 1, 0), 1 << 62, np.int64)
        nexts, link, size = self.next, self.link, self.size
        for i, word in enumerate(words):
            while state and word not in nexts[state]:
                state = link[state]
                matched = size[state]
            if word in nexts[state]:
                state = nexts[state][word]
                matched += 1
            while size[link[state]] >= length:
                state = link[state]
                matched = size[state]
            if matched >= length:
                out[i - length + 1] = self.low[state]
        return out


def match(bodies: list[bytes], docs: np.ndarray) -> list[np.ndarray]:
    texts = [np.frombuffer(b, np.int64).tolist() for b in bodies]
    shard = Automaton()
    for words, doc in zip(texts, docs.tolist()):
        shard.add(words, doc)
    shard.finish()
    return [shard.windows(words, LENGTH) for words in texts]


def remove_passages(docs: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the kept words joined by one space), per row of ``docs`` (doc_id, text).

    The columns ``extra`` of ``docs`` follow under the names x_0, x_1 and so on.

    A word goes if a 13-word window over it also starts in a document with a smaller doc_id.  A null, empty or blank text
    has no words and keeps the empty string; a row without id keeps all its words; repeated rows agree.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(x or "").encode() for x in batch.column("text").to_pylist()]
            copy, at = batch.column("copy").to_pylist(), batch.column("at").to_pylist()
            counts, removed, kept = [], [], []
            for a, b in chunks(map(len, texts)):
                w = Words(texts[a:b])
                raw = w.buf.tobytes()
                for i in range(b - a):
                    lo, hi = int(w.first[i]), int(w.first[i + 1])
                    keep = np.ones(hi - lo, bool)
                    if copy[a + i] and hi - lo >= LENGTH:
                        keep[:] = False
                    else:
                        for x, y in zip(*spans(at[a + i], LENGTH)):
                            keep[x:y] = False
                    of = np.flatnonzero(keep) + lo
                    counts.append(hi - lo)
                    removed.append(hi - lo - len(of))
                    kept.append(b" ".join([raw[x:y] for x, y in zip(w.start[of].tolist(), w.end[of].tolist())]).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string()), *[batch.column(c) for c in names]],
                ["doc_id", "n_words", "n_removed", "kept", *names],
            )

    names = [f"x_{i}" for i in range(len(extra))]
    schema = ", ".join(["doc_id long, n_words long, n_removed long, kept string", *[f"{n} {docs.schema[c].dataType.simpleString()}" for n, c in zip(names, extra)]])
    return removals(docs, WORDS, match, extra).mapInArrow(run, schema)


def digest(kept: DataFrame) -> DataFrame:
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
