"""Token ids of whole columns of texts, with most of the work in Arrow and numpy.

Blanks never survive tokenisation and never join their neighbours, so the ids of a text are those of its
blank-separated parts in a row.  A batch is lower-cased and split in Arrow, its distinct parts are looked up
once, and the ids of all texts are gathered with one index.  Parts seen for the first time are tokenised; a part
that ends in marks after a letter is two parts to the tokeniser, so its stem and its marks are.

Texts with the bracket of special tokens keep their case, since these are found before lower-casing.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Parts that are remembered; beyond these, the half that most batches have used is kept.
CACHED_PARTS = 500_000
#: New words that are tokenised as one text, and the ending of their last tokens.
LINE = 500
WORD_END = "</w>"

#: ASCII marks without the apostrophe, which belongs to some endings, and without the bracket of special tokens.
_MARKS = "!\"#$%&()*+,-./:;=>?@[\\]^_`{|}~"
_WORD = re.compile("[a-zß-öø-ÿ]+")
_ENDED = re.compile(rf"([^<]*[a-zß-öø-ÿ])([{re.escape(_MARKS)}]+)", re.DOTALL)


class Tokens:
    """Ids of texts by the tokeniser in the file `path`; every text is followed by the id `end`."""

    def __init__(self, path: str, end: int, most: int = CACHED_PARTS) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.end, self.most = Tokenizer.from_file(path), end, most
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True
        self.known: dict[str, int] = {}  # part -> its number
        self.ids, self.used = np.zeros(1 << 20, np.uint32), 0
        self.starts, self.sizes, self.seen = (np.zeros(1 << 16, np.int32) for _ in range(3))

    def _forget(self) -> None:
        """Keep the half of the parts that were in most batches."""
        n = len(self.known)
        keep = np.sort(np.argsort(-self.seen[:n], kind="stable")[: self.most // 2])
        parts = np.array(list(self.known), object)[keep].tolist()
        flat, sizes, seen = self._gathered(keep), self.sizes[keep], self.seen[keep]
        self.known, self.used = {}, 0
        self._remember(parts, flat, sizes)
        self.seen[: len(keep)] = seen
        self.seen[len(keep) :] = 0

    def _remember(self, parts: list[str], flat: np.ndarray, sizes: np.ndarray) -> None:
        at, n = len(self.known), len(parts)
        while self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while at + n > len(self.starts):
            self.starts, self.sizes, self.seen = (np.concatenate([x, np.zeros_like(x)]) for x in (self.starts, self.sizes, self.seen))
        self.ids[self.used : self.used + len(flat)] = flat
        self.starts[at : at + n] = self.used + np.cumsum(sizes) - sizes
        self.sizes[at : at + n] = sizes
        self.used += len(flat)
        self.known.update(zip(parts, range(at, at + n), strict=True))

    def _learn(self, parts: list[str]) -> None:
        """Remember new parts, stems and endings first."""
        cut = [_ENDED.fullmatch(p) if p[-1:] in _MARKS else None for p in parts]
        whole = [p for p, m in zip(parts, cut, strict=True) if m is None]
        ended = [m for m in cut if m is not None]
        pairs = [s for m in ended for s in m.groups()]
        new = whole + list(set(pairs).difference(self.known, whole))
        words = [p for p in new if _WORD.fullmatch(p)]
        self._learn_words(words)
        self._learn_any(list(set(new).difference(words)))
        numbers = np.fromiter(map(self.known.__getitem__, pairs), np.int64, len(pairs))
        sizes = self.sizes[numbers].reshape(-1, 2).sum(axis=1)
        self._remember([m.string for m in ended], self._gathered(numbers), sizes)

    def _learn_any(self, parts: list[str]) -> None:
        encoded = [e.ids for e in self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)]
        sizes = np.fromiter(map(len, encoded), np.int64, len(parts))
        self._remember(parts, np.fromiter(chain.from_iterable(encoded), np.uint32, int(sizes.sum())), sizes)

    def _learn_words(self, words: list[str]) -> None:
        """Remember words of letters alone: tokenised together, and told apart by the ids that end a word."""
        lines = [" ".join(words[k : k + LINE]) for k in range(0, len(words), LINE)]
        encoded = [e.ids for e in self.tokenizer.encode_batch_fast(lines, add_special_tokens=False)]
        ids = np.fromiter(chain.from_iterable(encoded), np.uint32, sum(map(len, encoded)))
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) != len(words) or (len(ends) and ends[-1] != len(ids)):  # another tokeniser
            return self._learn_any(words)
        self._remember(words, ids, np.diff(ends, prepend=0))

    def _gathered(self, numbers: np.ndarray) -> np.ndarray:
        """The ids of parts, given by number, in a row."""
        sizes = self.sizes[numbers]
        ends = np.cumsum(sizes, dtype=np.int64)
        return self.ids[np.repeat(self.starts[numbers] - ends + sizes, sizes) + np.arange(int(sizes.sum()))]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, where each text's ids begin; one more entry for the end).  Null texts are empty."""
        if texts.offset:  # pc.ascii_lower misreads the offsets of a slice
            texts = texts.take(pa.array(np.arange(len(texts))))
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        lower = pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts))
        lists = pc.ascii_split_whitespace(lower)
        parts = pc.dictionary_encode(lists.flatten())
        words = parts.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.known) > self.most:
            self._forget()
        numbers = list(map(self.known.get, words))
        if None in numbers:
            missing = [k for k, n in enumerate(numbers) if n is None]
            self._learn([words[k] for k in missing])
            for k in missing:
                numbers[k] = self.known[words[k]]
        numbers = np.array(numbers, np.int32)
        self.seen[numbers] += 1
        codes = numbers[parts.indices.to_numpy(zero_copy_only=False)]
        ends = np.concatenate([[0], np.cumsum(self.sizes[codes], dtype=np.int64)])
        flat = self._gathered(codes)
        cuts = ends[lists.offsets.to_numpy() - lists.offsets[0].as_py()]  # ids before each text
        n = len(cuts) - 1
        starts = cuts + np.arange(n + 1)  # with one end id after each text
        out = np.full(int(ends[-1]) + n, self.end, np.uint32)
        keep = np.ones(len(out), bool)
        keep[starts[1:] - 1] = False
        out[keep] = flat
        return out, starts


@lru_cache(maxsize=1)
def shared_tokens(path: str, end: int) -> Tokens:
    """One memory per Python worker, kept from task to task where Spark reuses its workers."""
    return Tokens(path, end)
