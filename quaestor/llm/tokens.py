"""Exact, cached encoding with the public ``tokenizers`` files.

Both vocabularies split a text into words before merging, so a text's ids are
the ids of its pieces one after the other, if it is cut only where the
splitting rule always cuts.  Most pieces repeat; a bounded two-generation
cache keeps their ids as little-endian unsigned 32-bit bytes.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_LOADED: dict = {}
_BLANKS = re.compile(r" (?=\s)")


def public_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def loaded(path: str, kind: str) -> "PieceEncoder":
    """The process's encoder for ``path`` (Python workers are reused)."""
    if (path, kind) not in _LOADED:
        _LOADED[path, kind] = PieceEncoder(path, kind)
    return _LOADED[path, kind]


class PieceEncoder:
    """``kind='byte'``: byte-level vocabulary whose rule gives a word the space
    before it; ``kind='word'``: vocabulary that drops white space.

    Cuts for 'byte': before a space that a non-blank follows.  The rule takes a
    run of blanks without its last one, and that last space starts the next
    word, so such a place is always a word's start.  Texts where a space stands
    before another blank, or at the end, are encoded whole.  Cuts for 'word':
    at spaces and newlines, which never belong to a word or a special token.
    """

    #: Pieces kept by kind, and ids in all; about 250 bytes a piece.
    CACHED, MOST_IDS = {"byte": 700_000, "word": 1_300_000}, 8_000_000

    def __init__(self, path: str, kind: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.kind = kind
        self._apart = "<|endoftext|>"  # both vocabularies' special token
        self._apart_id = self.tok.token_to_id(self._apart)
        self._bytes = None
        self._forget()

    def _forget(self) -> None:
        self._index: dict[str | tuple[str], int] = {}
        self._ids, self._starts, self._used = np.zeros(1 << 20, np.uint32), np.zeros(1 << 18, np.int64), 0

    def _encoded(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """ids of all ``pieces`` one after the other, and how many each has.
        A special token between pieces keeps them apart in one long text,
        which costs the library less than many short ones."""
        if any("<|" in p for p in pieces):
            found = [array("I", e.ids) for e in self.tok.encode_batch_fast(pieces, add_special_tokens=False)]
            return (np.frombuffer(b"".join(a.tobytes() for a in found), np.uint32),
                    np.fromiter(map(len, found), np.int64, len(found)))
        ids, sizes = [], []
        for e in self.tok.encode_batch_fast([self._apart.join(pieces[i:i + 100]) for i in range(0, len(pieces), 100)],
                                            add_special_tokens=False):
            one = np.frombuffer(array("I", e.ids), np.uint32)
            marks = one == self._apart_id
            sizes.append(np.diff(np.flatnonzero(marks), prepend=-1, append=len(one)) - 1)
            ids.append(one[~marks])
        return np.concatenate(ids), np.concatenate(sizes)

    def _add(self, pieces: list[str], keys: list) -> None:
        """Encodes ``pieces`` and keeps their ids under ``keys``."""
        found, sizes = self._encoded(pieces)
        n, new = len(self._index), self._used + len(found)
        while new > len(self._ids):
            self._ids = np.concatenate([self._ids, np.zeros_like(self._ids)])
        while n + len(keys) + 1 > len(self._starts):
            self._starts = np.concatenate([self._starts, np.zeros_like(self._starts)])
        self._ids[self._used:new] = found
        self._starts[n + 1:n + 1 + len(keys)] = self._used + np.cumsum(sizes)
        self._used = new
        self._index.update(zip(keys, range(n, n + len(keys))))

    def encode(self, texts: list[str]) -> list[bytes]:
        """ids of each text; call with some million characters at once."""
        if len(self._index) > self.CACHED[self.kind] or self._used > self.MOST_IDS:
            self._forget()
        if self.kind == "word":
            whole = {}
            cut = pa.array([t.replace("\n", " ") for t in texts], pa.large_string())
        else:
            whole = {i: t for i, t in enumerate(texts) if _BLANKS.search(t) or t.endswith(" ")}
            cut = pa.array(["" if i in whole else t for i, t in enumerate(texts)], pa.large_string())
        lists = pc.split_pattern(cut, " ")
        edges = lists.offsets.to_numpy()
        words = lists.flatten().dictionary_encode()
        known = words.dictionary.to_pylist()
        place = np.fromiter((self._index.get(w, -1) for w in known), np.int64, len(known))
        fresh = np.flatnonzero(place < 0)
        if len(fresh):
            new = [known[i] for i in fresh.tolist()]
            place[fresh] = np.arange(len(self._index), len(self._index) + len(new))
            # an empty key stands for nothing: blanks at a text's end, or doubled
            self._add([" " + w if w and self.kind == "byte" else w for w in new], new)
        word = place[words.indices.to_numpy()]
        if self.kind == "byte":  # a text's first word has no space before it
            heads = np.flatnonzero(edges[1:] > edges[:-1])
            names = [(known[i],) for i in words.indices.to_numpy()[edges[heads]].tolist()]
            absent = list({k for k in names if k not in self._index})
            if absent:
                self._add([k[0] for k in absent], absent)
            word[edges[heads]] = [self._index[k] for k in names]
        size = self._starts[word + 1] - self._starts[word]
        ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(size)])
        ids = self._ids[np.repeat(self._starts[word] - ends[:-1], size) + np.arange(ends[-1])].astype("<u4").tobytes()
        at = (4 * ends[edges]).tolist()
        out = [ids[a:b] for a, b in zip(at, at[1:])]
        for i, t in whole.items():
            out[i] = self.one(t)
        return out

    def one(self, text: str) -> bytes:
        """ids of a text, straight from the library."""
        return array("I", self.tok.encode(text, add_special_tokens=False).ids).tobytes()

    def decode(self, ids: bytes) -> str:
        """As the library's decode(ids, skip_special_tokens=False) of a
        byte-level vocabulary: the tokens' bytes, badly formed UTF-8 replaced."""
        if self._bytes is None:
            self._bytes = self._token_bytes()
        table = self._bytes
        return b"".join(map(table.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")

    def _token_bytes(self) -> list[bytes]:
        # The byte-level alphabet: printable Latin-1 stands for itself, the
        # other bytes for the code points from 256 on, in order.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        other = [b for b in range(256) if b not in set(plain)]
        back = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}
        out = []
        for i in range(self.tok.get_vocab_size(with_added_tokens=True)):
            t = self.tok.id_to_token(i) or ""
            out.append(bytes(map(back.__getitem__, t)) if all(c in back for c in t) else t.encode())
        return out
