"""Token counts: count-only Viterbi over a unigram vocabulary.

White space is written as U+2581 and each text is cut before every such mark; pieces never cross a
cut, so a word's count depends on the word alone and is remembered.  In a word, an Aho-Corasick
automaton lists all vocabulary pieces by their end, longest first.  The best score and its piece
count are carried from end to end; a candidate replaces the best only when strictly better, so the
earliest start wins a tie, as in the original library.  A character that no piece covers alone may
also be read as unknown, at ``min score - 10``, and counts as its UTF-8 bytes (byte fallback).

The rules are those of the `tokenizers` library's Unigram model, which takes every listed piece as text:
control and byte pieces ("<s>", "<0x41>") match where a text spells them out.  A vocabulary without them
gives counts without them.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from vectrace.llm.common import slices, texts

MARK = "▁"
UNKNOWN_PENALTY = 10.0
#: Distinct words whose counts a worker remembers at once; bounds its memory, not its results.
CACHED_WORDS = 400_000

Vocabulary = tuple[tuple[str, float], ...]


def read_pieces(path: str) -> Vocabulary:
    """(piece, score) pairs of a sentencepiece file, read on the driver; a vocabulary is a bounded file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return tuple((model.id_to_piece(i), float(model.get_score(i))) for i in range(model.get_piece_size()))


class Counter:
    def __init__(self, pieces: Vocabulary):
        import ahocorasick

        self.unknown = min(score for _, score in pieces) - UNKNOWN_PENALTY
        self.single = {piece for piece, _ in pieces if len(piece) == 1}
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            if piece and piece not in self.automaton:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.known: dict[str, int] = {}

    def word(self, word: str) -> int:
        """Pieces of the best reading of one word."""
        n = len(word)
        best = [0.0] * (n + 1)
        count = [0] * (n + 1)
        set_at = [False] * (n + 1)
        done = 0  # ends up to here are final

        def unknowns(to: int) -> None:
            nonlocal done
            while done < to:
                c = word[done]
                if c not in self.single:
                    s = best[done] + self.unknown
                    if not set_at[done + 1] or s > best[done + 1]:
                        best[done + 1], count[done + 1], set_at[done + 1] = s, count[done] + len(c.encode("utf-8", "surrogatepass")), True
                done += 1

        for end, (length, score) in self.automaton.iter(word):
            if done < end:
                unknowns(end)
            end += 1
            start = end - length
            s = score + best[start]
            if not set_at[end] or s > best[end]:
                best[end], count[end], set_at[end] = s, count[start] + 1, True
        unknowns(n)
        return count[n]

    def text(self, text: str) -> int:
        """Pieces of a whole text; an empty text has none."""
        if not text:
            return 0
        known = self.known
        marked = text.replace(" ", MARK)
        parts = (marked if marked[0] == MARK else MARK + marked).split(MARK)
        total = 0
        for part in parts[1:]:
            n = known.get(part)
            if n is None:
                if len(known) > CACHED_WORDS:
                    known.clear()
                n = known[part] = self.word(MARK + part)
            total += n
        return total


@lru_cache(maxsize=2)
def _counter(pieces: Vocabulary) -> Counter:
    return Counter(pieces)


def token_counts(df: DataFrame, pieces: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, n_bytes) for every row.  A null or empty text has 0 tokens; rows are never merged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(pieces)
        for part in slices(batches, 2048):
            read = texts(part.column(1))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([counter.text(t) for t in read], pa.int64()), pa.array([len(t.encode()) for t in read], pa.int64())],
                ["doc_id", "n_tokens", "n_bytes"],
            )

    kind = dict(df.dtypes)[id_col]
    return df.select(id_col, text_col).mapInArrow(run, f"doc_id {kind}, n_tokens long, n_bytes long")
