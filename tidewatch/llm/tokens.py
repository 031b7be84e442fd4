"""Byte-level BPE token ids of whole texts, by the ``tokenizers`` library.

Most words of a corpus recur, and a byte-level BPE encodes each pre-token on its own. So a batch
of texts is cut into pre-tokens with array operations, each distinct pre-token goes through the
library's model once, and the ids are gathered back. Strings of added tokens in a text become
those tokens, as the library does. A tokenizer file of any other make (normalizer, pre-tokenizer,
model) goes through the library text by text. ``tests/llm`` holds the result against the library's
own encoding of the whole texts.
"""

from __future__ import annotations

import json
import os
import re
from codecs import charmap_decode
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

END_ID = 2
#: Distinct pre-tokens whose ids a worker remembers, some 150 bytes each; at more it starts afresh.
REMEMBERED = 1_000_000
#: Bytes of text whose distinct pre-tokens are sought together, and that are cut at a time; a longer text stays whole.
SLICE_BYTES, CUT_BYTES = 8 << 20, 1 << 17

_LETTER, _DIGIT, _SPACE, _OTHER, _UNKNOWN = 1, 2, 3, 0, 9
#: Suffixes that an apostrophe takes along, in the order of the pattern.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")


def _byte_alphabet() -> str:
    """The printable stand-in of each byte in byte-level BPE vocabularies: printable Latin-1 stays, the rest moves up."""
    moved = iter(range(256, 512))
    return "".join(chr(b) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174 else chr(next(moved)) for b in range(256))


class Encoder:
    """Ids of texts; build it in the worker, once (see ``encoder``)."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        made = json.loads(self.tokenizer.to_str())
        cutter, added = made["pre_tokenizer"] or {}, made["added_tokens"]
        plain = not any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added)
        #: Whether pre-tokens can be cut here; else the library encodes whole texts.
        self.cuts_here = plain and made["normalizer"] is None and cutter.get("type") == "ByteLevel" and cutter.get("use_regex") and not cutter.get("add_prefix_space") and made["model"]["type"] == "BPE" and not made["model"].get("dropout")
        self.model, self.cutter = self.tokenizer.model, self.tokenizer.pre_tokenizer
        self.added = {t["content"].encode(): t["id"] for t in added}
        self.find_added = re.compile(b"|".join(re.escape(t) for t in sorted(self.added, key=len, reverse=True))) if self.added else None
        self.alphabet = _byte_alphabet()
        self.classes = np.full(0x110000, _UNKNOWN, np.uint8)
        self._forget()

    def _forget(self) -> None:
        self.places: dict[bytes, int] = {}
        self.pool = np.empty(0, np.uint32)
        self.ends = np.zeros(1, np.int32)

    def _class(self, point: int) -> int:
        """Ask the library's own pre-tokenizer which run a character joins."""
        c = chr(point)
        joins = lambda before: len(self.cutter.pre_tokenize_str(before + c)) == 1
        return _LETTER if joins("a") else _DIGIT if joins("1") else _OTHER if joins("!") else _SPACE

    def _known(self, words: list[bytes]) -> np.ndarray:
        """The place of each word's ids in the pool; words that are new go through the model."""
        if len(self.places) > REMEMBERED:
            self._forget()
        found = list(map(self.places.get, words))
        ids: list[int] = []
        ends: list[int] = []
        tokenize, alphabet, at = self.model.tokenize, self.alphabet, len(self.pool)
        for k in [k for k, place in enumerate(found) if place is None]:
            word = words[k]
            ids += [t.id for t in tokenize(charmap_decode(word, "strict", alphabet)[0])] if word not in self.added else [self.added[word]]
            ends.append(at + len(ids))
            found[k] = self.places[word] = len(self.places)
        if ends:
            self.pool = np.concatenate([self.pool, np.array(ids, np.uint32)])
            self.ends = np.concatenate([self.ends, np.array(ends, np.int32)])
        return np.array(found, np.int32)

    def _cuts(self, raw: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Byte offsets where pre-tokens start; ``begins``: offsets of texts that are not empty."""
        lead = np.flatnonzero((raw & 0xC0) != 0x80).astype(np.int32)
        b0 = raw[lead].astype(np.int32)
        point = b0
        if len(lead) != len(raw):
            wide = np.flatnonzero(b0 >= 0x80)
            at, head = lead[wide], b0[wide]
            padded = np.concatenate([raw, np.zeros(3, np.uint8)])
            low = lambda k: (padded[at + k] & 0x3F).astype(np.int32)
            point[wide] = np.where(head < 0xE0, (head & 0x1F) << 6 | low(1), np.where(head < 0xF0, (head & 0x0F) << 12 | low(1) << 6 | low(2), (head & 7) << 18 | low(1) << 12 | low(2) << 6 | low(3)))
        cls = self.classes[point]
        if (cls == _UNKNOWN).any():
            for p in np.unique(point[cls == _UNKNOWN]).tolist():
                self.classes[p] = self._class(p)
            cls = self.classes[point]
        n = len(lead)
        first = np.zeros(n + 1, bool)
        first[np.searchsorted(lead, begins)] = True
        first[n] = True
        run = np.empty(n + 1, bool)
        run[0] = run[n] = True
        run[1:n] = cls[1:] != cls[:-1]
        run |= first
        space = cls == _SPACE
        blank = point == 0x20
        start = run[:n].copy()
        # The last white space before a run stands alone, or with the run if it is a blank.
        last = space & run[1:] & ~first[1:]
        start |= last
        glued = np.zeros(n, bool)
        glued[1:] = (last & blank)[:-1]
        start &= ~glued
        # A lone apostrophe takes a contraction along.
        quote = np.flatnonzero((point[: n - 1] == 0x27) & start[: n - 1] & run[1:n] & ~first[1:n])
        for q in quote[cls[quote + 1] == _LETTER].tolist():
            word = "".join(chr(p) for p in point[q + 1 : q + 3].tolist())
            for suffix in CONTRACTIONS:
                end = q + 1 + len(suffix)
                if word.startswith(suffix) and not first[q + 2 : end].any():
                    start[q + 1] = False
                    if end < n and not run[end]:
                        start[end] = True
                    break
        return lead[start]

    def _pieces(self, raw: np.ndarray, bounds: np.ndarray) -> Iterator[np.ndarray]:
        """Cuts of whole texts, so many bytes at a time that the arrays stay in the processor's cache."""
        k = 0
        while k < len(bounds) - 1:
            upto = max(k + 1, int(np.searchsorted(bounds, bounds[k] + CUT_BYTES, "right")) - 1)
            yield self._cuts(raw[bounds[k] : bounds[upto]], bounds[k:upto] - bounds[k]) + np.int32(bounds[k])
            k = upto

    def batches(self, texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first row, ids of some texts end to end, offsets of each text in them), slice by slice; null counts as empty."""
        texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
        texts = texts.cast(pa.large_string()).fill_null("")
        n = len(texts)
        if not n:
            return
        if not self.cuts_here:
            for row in range(0, n, 256):
                found = [x.ids for x in self.tokenizer.encode_batch(texts.slice(row, 256).to_pylist(), add_special_tokens=False)]
                yield row, np.array([i for ids in found for i in ids], np.uint32), np.cumsum([0, *map(len, found)])
            return
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
        row = 0
        while row < n:
            upto = max(row + 1, int(np.searchsorted(offsets, offsets[row] + SLICE_BYTES, "right")) - 1)
            at = offsets[row : upto + 1] - offsets[row]
            yield row, *self._encode(data[offsets[row] : offsets[upto]], at)
            row = upto

    def _added(self, raw: np.ndarray, at: np.ndarray) -> np.ndarray:
        """(start, end) of each added token's string inside of a text."""
        body = raw.tobytes() if self.added else b""
        if not any(t in body for t in self.added):
            return np.empty((0, 2), np.int64)
        return np.array([(a + m.start(), a + m.end()) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True) for m in self.find_added.finditer(body[a:b])], np.int64).reshape(-1, 2)

    def _encode(self, raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(raw):
            return np.empty(0, np.uint32), np.zeros(len(at), np.int64)
        added = self._added(raw, at)
        # An added token parts what stands before and behind it, as the ends of texts do.
        cuts = np.concatenate(list(self._pieces(raw, np.unique(np.concatenate([at, added.ravel()])))))
        if len(added):
            owner = np.searchsorted(added[:, 0], cuts, "right") - 1
            cuts = cuts[(owner < 0) | (cuts == added[owner, 0]) | (cuts >= added[owner, 1])]
        edges = np.append(cuts, len(raw)).astype(np.int32)
        words = pa.Array.from_buffers(pa.binary(), len(cuts), [None, pa.py_buffer(edges), pa.py_buffer(np.ascontiguousarray(raw))]).dictionary_encode()
        found = words.dictionary
        body, ends = found.buffers()[2].to_pybytes(), np.frombuffer(found.buffers()[1], np.int32)[: len(found) + 1].tolist()
        places = self._known([body[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)])[words.indices.to_numpy()]
        taken = pa.ListArray.from_arrays(pa.array(self.ends), pa.array(self.pool)).take(pa.array(places))
        return taken.values.to_numpy(), taken.offsets.to_numpy().astype(np.int64)[np.searchsorted(cuts, at)]


_held: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file, built once a process."""
    if path not in _held:
        _held[path] = Encoder(path)
    return _held[path]


def with_end(ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Append END_ID to each text's ids."""
    n = len(offsets) - 1
    return np.insert(ids, offsets[1:], np.uint32(END_ID)).astype("<u4", copy=False), offsets + np.arange(n + 1)
