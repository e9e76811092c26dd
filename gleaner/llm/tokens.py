"""Exact token counts of every prefix by dynamic programming over a public BPE vocabulary."""

from __future__ import annotations

import json
import unicodedata
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.llm.common import Batches, map_batches

END = "</w>"
#: Distinct words and token pairs a Python worker remembers; beyond it forgets all and goes on.
REMEMBERED = 1 << 20
#: Words and pieces of more letters are counted by place and not remembered, so what is remembered has a bounded size.
LONG = 64
#: The pieces that the vocabulary's file names, with Unicode blanks spelled out.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+")

#: Blanks that part words, and the control characters that Python's split takes for blanks too.
BLANKS, OTHER_BLANKS = regex.compile(r"\p{White_Space}+"), regex.compile("[\x1c-\x1f]")


def _byte_letters() -> dict[int, str]:
    """Byte-level letters: printable Latin-1 characters stand for themselves, the rest follow from U+0100."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(0x100 + i) for i, b in enumerate(hidden)}


LETTERS = _byte_letters()


class WordCounts(dict):
    """Token counts of words between blanks, found on first use by prefix dynamic programming.

    ``prefix[w]`` has the last token of the encoding of the symbols ``w`` and its number of tokens. A token that ends
    ``w`` is the right last one exactly if merging it with the last token before its start leaves both as they are,
    so each prefix needs only the count of one shorter prefix. Words share the entries of common beginnings. Long
    pieces keep the same two by the length of the prefix instead.
    """

    def __init__(self, path: str) -> None:
        super().__init__()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.vocab = set(model["vocab"])
        self.ranks = {tuple(m) if isinstance(m, list) else tuple(m.split(" ")): i for i, m in enumerate(model["merges"])}
        self.longest = max(len(t.removesuffix(END)) for t in self.vocab)
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.cut = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self.pairs: dict[tuple[str, str], bool] = {}
        self.prefix: dict[str, tuple[str, int]] = {}
        self.closed_words: dict[str, int] = {}

    def merged(self, parts: list[str]) -> list[str]:
        """Merges by rank, the lowest first and leftmost among equals."""
        while len(parts) > 1:
            rank, at = min((self.ranks.get(p, 1 << 60), i) for i, p in enumerate(zip(parts, parts[1:], strict=False)))
            if rank == 1 << 60:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    @staticmethod
    def symbols(token: str) -> list[str]:
        body = token.removesuffix(END)
        parts = list(body)
        if body != token:
            parts[-1] += END
        return parts

    def fits(self, left: str, right: str) -> bool:
        pair = (left, right)
        known = self.pairs.get(pair)
        if known is None:
            if len(self.pairs) >= REMEMBERED:
                self.pairs.clear()
            known = self.pairs[pair] = self.merged(self.symbols(left) + self.symbols(right)) == [left, right]
        return known

    @staticmethod
    def spelled(word: str) -> str:
        return word if word.isascii() and word.isprintable() else "".join(map(LETTERS.__getitem__, word.encode()))

    def grow(self, word: str) -> None:
        """Enter the prefixes of a spelled word that are not known yet."""
        prefix, vocab, fits, longest = self.prefix, self.vocab, self.fits, self.longest
        if len(prefix) >= REMEMBERED:
            prefix.clear()
        known = len(word)
        while known and word[:known] not in prefix:
            known -= 1
        for p in range(known + 1, len(word) + 1):
            for i in range(p - longest if p > longest else 0, p):
                token = word[i:p]
                if token in vocab:
                    if i == 0:
                        prefix[token] = token, 1
                        break
                    last, count = prefix[word[:i]]
                    if fits(last, token):
                        prefix[word[:p]] = token, count + 1
                        break

    def closed(self, word: str) -> int:
        """Tokens of a spelled word whose prefixes but the whole are known."""
        for i in range(max(0, len(word) - self.longest), len(word)):
            token = word[i:] + END
            if token in self.vocab:
                if i == 0:
                    return 1
                last, count = self.prefix[word[:i]]
                if self.fits(last, token):
                    return count + 1
        raise ValueError(f"no encoding ends with {word!r}")

    def by_place(self, word: str) -> tuple[array, array]:
        """For each prefix of a spelled word, by its length, where its last token starts and its number of tokens."""
        vocab, fits, longest = self.vocab, self.fits, self.longest
        starts, counts = array("q", [0]), array("q", [0])
        for p in range(1, len(word) + 1):
            for i in range(p - longest if p > longest else 0, p):
                token = word[i:p]
                if token in vocab and (i == 0 or fits(word[starts[i] : i], token)):
                    starts.append(i)
                    counts.append(counts[i] + 1)
                    break
            else:
                raise ValueError(f"no encoding of {p} letters of {word[:LONG]!r}")
        return starts, counts

    def closed_at(self, word: str, p: int, starts: array, counts: array) -> int:
        """Tokens of a spelled word's first ``p`` letters as a whole word."""
        for i in range(max(0, p - self.longest), p):
            token = word[i:p] + END
            if token in self.vocab and (i == 0 or self.fits(word[starts[i] : i], token)):
                return counts[i] + 1
        raise ValueError(f"no encoding ends after {p} letters of {word[:LONG]!r}")

    def of_piece(self, piece: str) -> int:
        if len(piece) > LONG:
            word = self.spelled(piece)
            return self.closed_at(word, len(word), *self.by_place(word[:-1]))
        known = self.closed_words.get(piece)
        if known is None:
            if len(self.closed_words) >= REMEMBERED:
                self.closed_words.clear()
            word = self.spelled(piece)
            self.grow(word[:-1])
            known = self.closed_words[piece] = self.closed(word)
        return known

    def __missing__(self, word: str) -> int:
        tokens = sum(map(self.of_piece, PIECES.findall(normal(word))))
        if len(word) <= LONG:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = tokens
        return tokens

    def every_prefix(self, piece: str) -> list[int]:
        """Token counts of a piece's first 1, 2, … characters, each as the end of a text."""
        word = self.spelled(piece)
        places = self.by_place(word)
        ends = np.cumsum([len(c.encode()) for c in piece]).tolist()
        return [self.closed_at(word, p, *places) for p in ends]

    def words(self, text: str) -> list[str]:
        return BLANKS.split(text) if OTHER_BLANKS.search(text) else text.split()

    def counts(self, text: str) -> np.ndarray:
        """Tokens up to and with each word between blanks, or special token, of the text."""
        if self.cut is None or not any(s in text for s in self.special):
            each = list(map(self.__getitem__, self.words(text)))
        else:
            each, at = [], 0
            for hit in self.cut.finditer(text):
                each += [*map(self.__getitem__, self.words(text[at : hit.start()])), 1]
                at = hit.end()
            each += map(self.__getitem__, self.words(text[at:]))
        return np.cumsum(np.array(each, np.int64))


def normal(text: str) -> str:
    """Canonical composition, then lower case letter by letter (a final sigma is like any other)."""
    if not text.isascii():
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
    return text.lower()


@lru_cache(maxsize=2)
def word_counts(path: str) -> WordCounts:
    """One table for each worker process and vocabulary file."""
    return WordCounts(path)


def token_prefixes(docs: DataFrame, path: str, limit: int = 2048, keep: bool = True) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, within, words_within[, prefix_tokens])`` for each document, map-only.

    ``path`` is the vocabulary file, which every executor must have at that place. ``prefix_tokens`` holds the
    token count up to and with each word between blanks, so ``tokens_of_prefix`` and ``words_in_budget`` answer
    questions about any prefix without encoding again; ``keep=False`` leaves the array out and answers for ``limit``
    only: ``words_within`` whole words with ``within`` tokens fit. A null or empty text has no bytes and no tokens.
    Repeated rows come out repeated; other columns are ignored.
    """
    schema = "doc_id long, n_bytes long, n_tokens long, within long, words_within long" + ", prefix_tokens array<int>" * keep

    def run(batches: Batches) -> Batches:
        table = word_counts(path)
        for batch in batches:
            rows, kept = [], []
            for text in batch.column("text").to_pylist():
                prefix = table.counts(text or "")
                fit = int(np.searchsorted(prefix, limit, side="right"))
                rows.append((len((text or "").encode()), int(prefix[-1]) if len(prefix) else 0, int(prefix[fit - 1]) if fit else 0, fit))
                if keep:
                    kept.append(prefix.astype(np.int32))
            numbers = np.array(rows, np.int64).reshape(-1, 4)
            columns = [batch.column("doc_id"), *(pa.array(numbers[:, i]) for i in range(4))]
            if keep:
                columns.append(pa.array(kept, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in schema.split(", ")])

    return map_batches(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, schema)


def tokens_of_prefix(prefix_tokens: Column, words: Column | int) -> Column:
    """Tokens of a text's first ``words`` words."""
    at = F.least(F.lit(words) if isinstance(words, int) else words, F.size(prefix_tokens)).cast("int")
    return F.when(at < 1, F.lit(0)).otherwise(F.get(prefix_tokens, at - 1)).cast("long")


def words_in_budget(prefix_tokens: Column, budget: int) -> Column:
    """How many whole words fit in ``budget`` tokens."""
    return F.size(F.filter(prefix_tokens, lambda n: n <= budget)).cast("long")
