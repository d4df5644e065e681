"""Token ids by the tokenizers library, with remembered pieces.

Byte-level BPE never merges across its pre-tokenizer's cuts. A cut always lies before a space, and around a line
break, that has no white space beside it, and between an ASCII letter and a mark, as no pattern has a letter and then a
mark. Texts without doubled white space are therefore encoded piece by piece and each different piece only once; all
others are encoded whole. Either way every id comes from the library.
The pieces of a batch are numbered by a dictionary of their bytes, so that Python meets each different one once.
"""

from __future__ import annotations

import os

import numpy as np

from .common import Memory, coded

END = 2
#: White space of more than one byte, and the bytes of the rest.
WIDE = "".join(c for c in map(chr, range(128, 1 << 16)) if c.isspace())
BLANK = np.isin(np.arange(256), list(b" \t\n\v\f\r\x1c\x1d\x1e\x1f"))
CUT = np.isin(np.arange(256), list(b" \n"))
LETTER = np.isin(np.arange(256), [*range(65, 91), *range(97, 123)])
MARK = np.isin(np.arange(256), list(b".,;:!?)"))


def single_spaced(text: str) -> bool:
    """Words with exactly one white-space character between them, and none at either end."""
    words = text.split()
    return len(text) == sum(map(len, words)) + len(words) - 1


def doubled(raw: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Of texts that lie end to end (none empty, ``edges`` around them), those with white space of one byte beside such
    or at an end: the others are single-spaced, if they have no wider one."""
    blank = BLANK[raw]
    out = blank[edges[:-1]] | blank[edges[1:] - 1]
    at = np.flatnonzero(blank[:-1] & blank[1:])
    out[np.searchsorted(edges, at, side="right") - 1] = True  # a pair across an edge has white space at two ends
    return out


class Encoder:
    """Encodes texts to uint32 ids. At most ``most`` different pieces are remembered, none of more than ``LONG`` bytes."""

    LONG = 100

    def __init__(self, path: str, most: int = 1_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.seen = Memory(most)
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        # Of byte-level tokens, those that begin with a space or a line break: a piece has these bytes at its start only.
        self.begins = np.zeros(self.tok.get_vocab_size(), bool)
        self.begins[[i for t, i in self.tok.get_vocab().items() if t[:1] in ("\u0120", "\u010a")]] = True

    def whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces that begin with a space or a line break: end to end they cost one call, and the tokens that
        begin with such a byte show where each piece begins."""
        ids = np.array(self.tok.encode_batch_fast(["".join(pieces)], add_special_tokens=False)[0].ids, "<u4")
        cut, raw = (4 * np.flatnonzero(self.begins[ids])).tolist(), ids.tobytes()
        if len(cut) != len(pieces):
            return self.whole(pieces)
        return [raw[i:j] for i, j in zip(cut, [*cut[1:], len(raw)])]

    def _learn(self, pieces: list[bytes]) -> None:
        known = self.seen.young
        new = self.seen.missing(pieces)
        inner = [p for p in new if p[0] in b" \n"]
        known.update(zip(inner, self.pieces([p.decode() for p in inner])) if inner else ())
        first = [p for p in new if p[0] not in b" \n"]
        known.update(zip(first, self.whole([p.decode() for p in first])))

    def _by_pieces(self, raw: np.ndarray, edges: np.ndarray) -> list[np.ndarray]:
        """Ids of single-spaced texts that lie end to end."""
        begin = CUT[raw]
        begin[1:] |= MARK[raw[1:]] & LETTER[raw[:-1]]
        begin[edges[:-1]] = True
        cuts = np.r_[np.flatnonzero(begin), len(raw)]
        pieces, codes = coded(raw, cuts)
        self._learn(pieces)
        own = [*map(self.seen.young.__getitem__, pieces)]
        flat, size = np.frombuffer(b"".join(own), "<u4"), np.fromiter(map(len, own), np.int64, len(own)) // 4
        first, n = (np.cumsum(size) - size)[codes], size[codes]
        ends = np.cumsum(n)
        ids = flat[np.repeat(first - (ends - n), n) + np.arange(ends[-1])]
        for p in pieces:
            if len(p) > self.LONG:
                del self.seen.young[p]
        return np.split(ids, ends[np.searchsorted(cuts, edges[1:-1]) - 1])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Texts end to end cost few calls: give as many at a time as memory allows."""
        self.seen.take_up()
        out = [np.zeros(0, "<u4")] * len(texts)
        odd = [bool(t) and any(s in t for s in self.special) for t in texts]
        odd = [x or (not t.isascii() and any(s in t for s in WIDE) and not single_spaced(t)) for x, t in zip(odd, texts)]
        at = [i for i, t in enumerate(texts) if t and not odd[i]]
        if at:
            raws = [texts[i].encode() for i in at]
            edges = np.cumsum([0, *map(len, raws)])
            raw = np.frombuffer(b"".join(raws), np.uint8)
            wrong = doubled(raw, edges)
            if wrong.any():
                for i in np.flatnonzero(wrong).tolist():
                    odd[at[i]] = True
                at = [i for i in at if not odd[i]]
                raw = raw[np.repeat(~wrong, np.diff(edges))]
                edges = np.r_[0, np.cumsum(np.diff(edges)[~wrong])]
        if at:
            for i, ids in zip(at, self._by_pieces(raw, edges)):
                out[i] = ids
        for i, t in enumerate(texts):
            if odd[i]:
                out[i] = np.frombuffer(self.whole([t])[0], "<u4")
        return out


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder for each worker process and file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
