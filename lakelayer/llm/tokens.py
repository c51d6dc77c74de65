"""Token ids of whole texts with the public tokenizers, one encoding per distinct piece.

A text is cut before spaces that are followed by a visible character. Byte-level patterns keep such a space with the
word behind it, and the word-end vocabulary drops white space, so no piece of the tokenizer's own splitting crosses a
cut: the ids of the pieces, joined, are the ids of the text (tests compare both on whole documents). Texts that hold
``<|`` might name an added token and are encoded whole. The word-end vocabulary also ends its words between a letter and
an ASCII sign or digit and lower-cases them, so texts are cut there too and ASCII letters folded first: that leaves fewer
distinct pieces.

The cuts are found on the bytes of an Arrow column, its pieces are dictionary-encoded, and only the dictionary reaches
Python; the ids of the texts are gathered from the ids of the distinct pieces with numpy.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# bytes that may follow a space where a text is cut: no ASCII white space or control, and none of the bytes that white
# space beyond ASCII starts with (a cut left out does no harm)
_VISIBLE = np.ones(256, bool)
_VISIBLE[:33] = False
_VISIBLE[[0x7F, 0xC2, 0xE1, 0xE2, 0xE3]] = False


_LETTER = np.zeros(256, bool)                  # ASCII letters, and the ASCII signs and digits that end a word behind one
_LETTER[65:91] = _LETTER[97:123] = True
_SIGN = ~_LETTER
_SIGN[:33] = _SIGN[127:] = False


# pieces of known shape: a space and a visible run (byte level), or letters and a run of ASCII punctuation (word ends)
_RUN = re.compile(r" [^\s<][^ <]*")
_WORD = re.compile(r" ?([^\W\d_]+)([!-;=-@\[-`{-~]*)")


class PieceEncoder:
    """Encodes texts; remembers the ids of at most 2 x ``cap`` short pieces."""

    def __init__(self, path: str, cap: int = 400_000, longest: int = 48):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.sep_id, self.sep = max((i, t.content) for i, t in self.tok.get_added_tokens_decoder().items())
        self.word_ends = self.tok.normalizer is not None
        self.folds = self.word_ends and self.tok.normalizer.normalize_str("Az") == "az"
        self.edge = np.zeros(self.tok.get_vocab_size(), bool)           # ids that end a word, or that start with a space
        for t, i in self.tok.get_vocab().items():
            self.edge[i] = t.endswith("</w>") if self.word_ends else t.startswith("\u0120")
        self.cap, self.longest = cap, longest
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _encode(self, text: str) -> np.ndarray:
        return np.array(self.tok.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<i4")

    def _shaped(self, pieces: list[str]) -> list[bytes] | None:
        """Ids of pieces of known shape, encoded as one text and cut where the shape says; None if they don't add up."""
        if self.word_ends:
            ids = self._encode(" ".join(pieces))
            ends = np.flatnonzero(self.edge[ids]) + 1
            words = np.cumsum([1 + (not p[-1].isalpha()) for p in pieces])
            if len(ends) != words[-1] or ends[-1] != len(ids):
                return None
            stop = ends[words - 1]
            start = np.concatenate([[0], stop[:-1]])
        else:
            ids = self._encode("".join(pieces))
            start = np.flatnonzero(self.edge[ids])
            if len(start) != len(pieces) or start[0]:
                return None
            stop = np.append(start[1:], len(ids))
        raw = ids.tobytes()
        return [raw[4 * s:4 * e] for s, e in zip(start.tolist(), stop.tolist())]

    def _apart(self, pieces: list[str]) -> list[bytes]:
        """Ids of any pieces, encoded between separator tokens; texts that might hold one, each alone."""
        ids = self._encode(self.sep.join("" if "<|" in p else p for p in pieces))
        cut = np.flatnonzero(ids == self.sep_id)
        raw = ids.tobytes()
        out = [raw[4 * s:4 * e] for s, e in zip([0, *(cut + 1).tolist()], [*cut.tolist(), len(ids)])]
        return [self._encode(p).tobytes() if "<|" in p else x for p, x in zip(pieces, out)]

    def _learn(self, fresh: list[str], at_once: int = 4000) -> list[bytes]:
        """Ids of new pieces, many at a time."""
        shape = (_WORD if self.word_ends else _RUN).fullmatch
        out: list[bytes] = [b""] * len(fresh)
        known = [k for k, p in enumerate(fresh) if shape(p)]
        others = sorted(set(range(len(fresh))).difference(known))
        for way, places in ((self._shaped, known), (self._apart, others)):
            for i in range(0, len(places), at_once):
                mine = places[i:i + at_once]
                part = [fresh[k] for k in mine]
                for k, ids in zip(mine, way(part) or self._apart(part)):
                    out[k] = ids
        return out

    def _ids(self, pieces: list[str]) -> list[bytes]:
        """Ids of distinct pieces, from memory where they are known."""
        if len(self.new) > self.cap:
            self.old, self.new = self.new, {}
        known, old = self.new, self.old
        out = [known.get(p) for p in pieces]
        missing = [k for k, ids in enumerate(out) if ids is None]
        fresh = []
        for k in missing:
            ids = old.get(pieces[k])
            if ids is None:
                fresh.append(k)
            else:
                out[k] = known[pieces[k]] = ids
        for k, ids in zip(fresh, self._learn([pieces[k] for k in fresh])):
            out[k] = ids
            if len(pieces[k]) <= self.longest:
                known[pieces[k]] = ids
        return out

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts as little-endian int32, where each text's ids start, and the end). Null is empty."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        data = texts.buffers()[2]
        if data is None or at[-1] == at[0]:
            return np.empty(0, "<i4"), np.zeros(len(texts) + 1, np.int64)
        raw = np.frombuffer(data, np.uint8)[at[0]:at[-1]]
        at = at - at[0]
        cut = np.zeros(len(raw), bool)
        cut[:-1] = (raw[:-1] == 32) & _VISIBLE[raw[1:]]
        ends = at[1:][np.diff(at) > 0]
        cut[ends - 1] = False                              # a text's last space is followed by nothing
        if self.word_ends:
            cut[1:] |= _LETTER[raw[:-1]] & _SIGN[raw[1:]]
        upper = np.zeros(len(raw), bool)
        if self.folds:                                     # a letter before a byte beyond ASCII may be composed with it
            upper[:-1] = (raw[:-1] - np.uint8(65) < 26) & (raw[1:] < 128)
        for k in np.flatnonzero(pc.match_substring(texts, "<|").to_numpy(zero_copy_only=False)):
            cut[at[k]:at[k + 1]] = upper[at[k]:at[k + 1]] = False
        if self.folds:
            raw = raw | upper.view(np.uint8) << np.uint8(5)
        cut[at[:-1][np.diff(at) > 0]] = True
        starts = np.flatnonzero(cut)
        pieces = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(np.append(starts, len(raw)).astype(np.int64)),
                                                  pa.py_buffer(np.ascontiguousarray(raw))).dictionary_encode()
        ids = self._ids(pieces.dictionary.to_pylist())
        size = np.array([len(x) // 4 for x in ids], np.int64)
        first = np.cumsum(size) - size
        which = pieces.indices.to_numpy()
        n = size[which]
        upto = np.concatenate([[0], np.cumsum(n)])
        take = np.repeat(first[which] - upto[:-1], n) + np.arange(upto[-1])
        return np.frombuffer(b"".join(ids), "<i4")[take], upto[np.searchsorted(starts, at)]

    def encode(self, texts: list[str]) -> list[bytes]:
        flat, at = self.encode_column(pa.array(texts, pa.large_string()))
        raw = flat.tobytes()
        return [raw[4 * s:4 * e] for s, e in zip(at[:-1].tolist(), at[1:].tolist())]


@lru_cache(maxsize=2)
def encoder(path: str) -> PieceEncoder:
    """The encoder of this Python worker; tasks that run in it one after the other share its memory of pieces."""
    return PieceEncoder(path)


def chunks(texts: pa.Array, limit: int = 8_000_000) -> Iterator[tuple[int, int, pa.Array]]:
    """(start, stop, texts) of an Arrow string column, about ``limit`` bytes at a time; a longer text is alone."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    start, done = 0, 0
    while start < len(texts):
        stop = max(start + 1, int(np.searchsorted(upto, done + limit, "right")))
        yield start, stop, texts.slice(start, stop - start)
        start, done = stop, int(upto[stop - 1])
