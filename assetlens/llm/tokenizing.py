"""Token ids of whole texts by the ``tokenizers`` library, with repeated words encoded once.

Both vocabularies used here split a text at single spaces before they merge bytes, so a
piece between two spaces always gets the same ids. The encoder looks each piece up, gives
only unseen pieces to the library, and gathers the ids with numpy. Texts in which a space
touches other white space are encoded whole where the vocabulary keeps white space, and so
are texts that hold the text of an added token (``<|endoftext|>`` and the like), which the library
makes that token's id. The result equals encoding each whole text with the library as it is (tested).
"""

from __future__ import annotations

import os
import re
from itertools import repeat

import numpy as np

END_ID = 1
_PLAIN = re.compile(r"([A-Za-z]{1,64})([!-&(-/:-@\[-`{-~]{0,16})")  # letters, then marks but no apostrophe
MAX_CACHED_CHARS = 16_000_000
"""Cached pieces (their characters plus 8 each) before the cache starts anew: about 190 MB."""


def _library(path: str, special_are_text: bool):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(path)
    tok.encode_special_tokens = special_are_text
    return tok


class PieceEncoder:
    """``keeps_space``: whether white space belongs to the vocabulary (byte-level BPE, where
    a word carries the space before it) or is dropped (word-end BPE)."""

    def __init__(self, path: str, keeps_space: bool):
        self.tok, self.keeps_space = _library(path, True), keeps_space
        # A special token between pieces lets one call encode many of them.
        self.joined = _library(path, False)
        added = self.joined.get_added_tokens_decoder().values()
        self.special = [t.content for t in added if t.special]
        # Added tokens that are matched after normalisation could be spelt in capitals.
        self.added = re.compile("|".join(re.escape(t.content) for t in added),
                                re.IGNORECASE if any(t.normalized for t in added) else 0)
        self.mark_id = self.joined.token_to_id(self.special[0])
        self._clear()

    def _split_off_plain(self, pieces: list) -> tuple[list[list[int]], list]:
        """Ids of the pieces that are ASCII letters, or letters and then marks: these are one
        or two words of the vocabulary's own splitting, and go to its model directly. The
        other pieces are returned for the whole library."""
        model, plain, ids, others = self.tok.model.tokenize, _PLAIN.fullmatch, [], []
        first = len(self.slot)
        for piece in pieces:
            lead = "\u0120" if self.keeps_space else ""  # the space before, as the vocabulary writes it
            text = piece
            if type(piece) is tuple:
                lead, text = "", piece[0]
            match = plain(text)
            if match is None:
                others.append(piece)
                continue
            word, marks = match.groups()
            own = [t.id for t in model(lead + (word if self.keeps_space else word.lower()))]
            if marks:
                own += [t.id for t in model(marks)]
            ids.append(own)
            self.slot[piece] = first
            first += 1
            self.chars += len(text) + 8
        return ids, others

    def _encode_each(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and the count of each."""
        flats, counts = [], []
        for i in range(0, len(texts), 100):
            some = texts[i:i + 100]
            line = self.special[0].join(some)
            if line.count(self.special[0]) == len(some) - 1 and not any(x in line for x in self.special[1:]):
                ids = np.array(self.joined.encode_batch_fast([line], add_special_tokens=False)[0].ids, np.uint32)
                marks = np.flatnonzero(ids == self.mark_id)
                flats.append(np.delete(ids, marks))
                counts.append(np.diff(np.concatenate([[-1], marks, [len(ids)]])) - 1)
            else:
                each = [e.ids for e in self.tok.encode_batch_fast(some, add_special_tokens=False)]
                flats += [np.array(x, np.uint32) for x in each]
                counts.append(np.array([len(x) for x in each], np.int64))
        empty = np.zeros(0, np.int64)
        return np.concatenate([empty.astype(np.uint32), *flats]), np.concatenate([empty, *counts])

    def _clear(self) -> None:
        self.slot: dict = {}
        self.chars = 0
        self.flat = np.zeros(1 << 16, np.uint32)
        self.used = 0
        self.starts = np.zeros(1 << 14, np.int64)
        self.lens = np.zeros(1 << 14, np.int64)
        self.whole = np.zeros(1 << 14, bool)  # pieces whose text must be encoded whole

    def _learn(self, pieces: list) -> None:
        ids, pieces = self._split_off_plain(pieces)
        self._store(len(self.slot) - len(ids), np.array([i for own in ids for i in own], np.uint32),
                    np.array([len(own) for own in ids], np.int64))
        if self.keeps_space:
            texts = [p[0] if type(p) is tuple else " " + p for p in pieces]
        else:
            texts = pieces
        first = len(self.slot)
        self._store(first, *self._encode_each(texts))
        for k, piece in enumerate(pieces, first):
            self.slot[piece] = k
            bare = piece[0] if type(piece) is tuple else piece
            if self.keeps_space:
                self.whole[k] = not bare or bare[0].isspace() or bare[-1].isspace()
            self.chars += len(bare) + 8

    def _store(self, first: int, ids: np.ndarray, lens: np.ndarray) -> None:
        """Ids and counts of the pieces in the slots from ``first`` on."""
        need = first + len(lens)
        if need > len(self.starts):
            size = max(need, 2 * len(self.starts))
            self.starts, self.lens, self.whole = (
                np.concatenate([a, np.zeros(size - len(a), a.dtype)]) for a in (self.starts, self.lens, self.whole))
        self.lens[first:need] = lens
        self.starts[first:need] = self.used + np.cumsum(lens) - lens
        if self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(max(len(ids), len(self.flat)), np.uint32)])
        self.flat[self.used:self.used + len(ids)] = ids
        self.used += len(ids)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, each text followed by END_ID, and the count per text."""
        if self.chars > MAX_CACHED_CHARS:
            self._clear()
        pieces: list = []
        counts = np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            if self.keeps_space:
                own = text.split(" ")
                own[0] = (own[0],)
            else:
                # Lower case is the vocabulary's own normalisation; here it only merges pieces.
                own = (text.lower() if text.isascii() else text).replace("\n", " ").split(" ")
            counts[i] = len(own)
            pieces += own
        at = np.fromiter(map(self.slot.get, pieces, repeat(-1)), np.int64, len(pieces))
        missing = np.flatnonzero(at < 0)
        if len(missing):
            unseen = [pieces[i] for i in missing.tolist()]
            self._learn(list(dict.fromkeys(unseen)))
            at[missing] = np.fromiter(map(self.slot.__getitem__, unseen), np.int64, len(unseen))
        del pieces
        lens = self.lens[at]
        ends = np.cumsum(lens)
        flat = self.flat[np.repeat(self.starts[at] - ends + lens, lens) + np.arange(ends[-1] if len(ends) else 0)]
        bounds = np.concatenate([[0], np.cumsum(counts)])
        total = np.concatenate([[0], ends])[bounds]  # ids before each text
        n_ids = np.diff(total)
        special = np.fromiter((self.added.search(t) is not None for t in texts), bool, len(texts))
        risky = np.flatnonzero((np.add.reduceat(self.whole[at], bounds[:-1]) & (counts > 1)) | special) if len(texts) else []
        parts, done = [], 0
        for i in risky:
            whole = np.array(self.joined.encode(texts[i], add_special_tokens=False).ids, np.uint32)
            parts += [flat[done:total[i]], whole]
            done, n_ids[i] = total[i + 1], len(whole)
        if parts:
            flat = np.concatenate([*parts, flat[done:]])
        flat = np.insert(flat, np.cumsum(n_ids), END_ID).astype(np.uint32)
        return flat, n_ids + 1


_ENCODERS: dict[tuple[str, bool], PieceEncoder] = {}


def encoder(path: str, keeps_space: bool) -> PieceEncoder:
    """The Python worker's encoder of a vocabulary file (its cache is bounded)."""
    key = (path, keeps_space)
    if key not in _ENCODERS:
        _ENCODERS[key] = PieceEncoder(path, keeps_space)
    return _ENCODERS[key]
