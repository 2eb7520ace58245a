"""Token ids of whole Arrow columns, equal to the tokenizer's own, for byte-level BPE files.

Byte-level BPE merges inside pre-tokens only, and texts repeat their pre-tokens. A slice of
texts is cut at the pre-token limits with array operations, each distinct pre-token is given
to the tokenizer once, and the ids are gathered from a table that a worker process keeps
between tasks. Texts with characters whose class is not the same in all Unicode versions, and texts that hold
one of the tokenizer's added tokens literally, go to the tokenizer as a whole. Pre-tokens are told apart by 64-bit hashes.
"""

from __future__ import annotations

import os
import re
import sys
import types
import unicodedata

import numpy as np

from slotcast.llm import textops as T

SPACE, LETTER, DIGIT, OTHER, UNSURE = range(5)
KNOWN_LIMIT = 3_000_000  # pre-tokens a worker remembers; more starts a new table

# Code points with the White_Space property.
WHITE_SPACE = (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def worker_state() -> dict:
    """A dictionary that lives as long as the Python worker process."""
    return sys.modules.setdefault("slotcast_worker_state", types.ModuleType("slotcast_worker_state")).__dict__


def _classes() -> np.ndarray:
    """Class of every code point; UNSURE where its category changed since the oldest tables at hand."""
    kinds = {"L": LETTER, "N": DIGIT}
    table = np.full(0x110000, UNSURE, np.uint8)
    old = unicodedata.ucd_3_2_0.category
    for cp in range(0x110000):
        now, before = unicodedata.category(chr(cp)), old(chr(cp))
        if now[0] == before[0] and now != "Cn":
            table[cp] = kinds.get(now[0], OTHER)
    table[list(WHITE_SPACE)] = SPACE
    return table


class Encoder:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # a look ahead, so that occurrences may overlap
        self.added = re.compile("(?=" + "|".join(map(re.escape, added)) + ")") if added else None
        self.classes = _classes()
        self.values = T.numbers(0x110000, 11)
        self._forget()

    def _forget(self):
        self.known, self.slot = np.zeros(0, T.U64), np.zeros(0, np.int64)
        self.begin, self.length, self.pool = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def _ask(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _limits(self, points, offsets):
        """Start of every pre-token: maximal runs of letters, digits or other signs with one space
        before them, runs of white space, and English contractions."""
        n = len(points)
        kind = self.classes[points]
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        run = edge[:n].copy()
        run[1:] |= kind[1:] != kind[:-1]
        start = run.copy()
        after = np.flatnonzero(run[1:] & ~edge[1:n] & (kind[1:] != SPACE) & (kind[:-1] == SPACE)) + 1
        start[after - 1] = True
        start[after[points[after - 1] == 0x20]] = False
        # An apostrophe that begins a pre-token, alone, followed by one of the endings.
        at = np.flatnonzero(start & (points == ord("'")))
        at = at[at + 1 < n]
        at = at[run[at + 1] & ~edge[at + 1] & (kind[at + 1] == LETTER)]
        one, two = points[at + 1], np.where(at + 2 < n, points[np.minimum(at + 2, n - 1)], 0)
        two = np.where(edge[np.minimum(at + 2, n)], 0, two)
        size = np.zeros(len(at), np.int64)
        for ending in "stmd":
            size[one == ord(ending)] = 2
        for a, b in ("re", "ve", "ll"):
            size[(one == ord(a)) & (two == ord(b))] = 3
        at, size = at[size > 0], size[size > 0]
        start[at + 1] = False
        past = at + size
        start[past[past < n]] = True
        return np.flatnonzero(start), kind

    def encode(self, column):
        """(first row, past-the-end row, ids, bounds of the rows' ids) for slices of a column."""
        for first, past, data, byte_offsets in T.slices(column):
            n = past - first
            text = data.tobytes().decode()
            points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
            leads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
            offsets = leads[byte_offsets]
            if not len(points):
                yield first, past, np.zeros(0, np.uint32), np.zeros(n + 1, np.int64)
                continue
            starts, kind = self._limits(points, offsets)
            ends = np.append(starts[1:], len(points))
            rows = T.rows_of(starts, offsets)
            # A literal across the limit of two texts only sends the first of them whole, too.
            literal = np.array([m.start() for m in self.added.finditer(text)] if self.added else [], np.int64)
            unsure = np.unique(T.rows_of(np.concatenate([np.flatnonzero(kind == UNSURE), literal]), offsets))
            hashes = T.Prefix(points, self.values).hashes(starts, ends)
            distinct, where, back = np.unique(hashes, return_index=True, return_inverse=True)
            slots = self._slots(distinct, starts[where], ends[where], text)[back]
            length = self.length[slots]
            total = np.concatenate([[0], np.cumsum(length)])
            ids = self.pool[np.repeat(self.begin[slots] - total[:-1], length) + np.arange(total[-1])]
            bounds = total[T.starts_of(rows, n)]
            if len(unsure):
                parts = [ids[bounds[r]:bounds[r + 1]] for r in range(n)]
                for r, whole in zip(unsure, self._ask([text[offsets[r]:offsets[r + 1]] for r in unsure])):
                    parts[r] = np.array(whole, np.uint32)
                ids = np.concatenate(parts)
                bounds = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
            yield first, past, ids, bounds

    def _slots(self, distinct, starts, ends, text):
        place = np.searchsorted(self.known, distinct)
        new = np.ones(len(distinct), bool)
        inside = place < len(self.known)
        new[inside] = self.known[place[inside]] != distinct[inside]
        if new.any():
            if len(self.known) + int(new.sum()) > KNOWN_LIMIT and len(self.known):
                self._forget()
                return self._slots(distinct, starts, ends, text)
            found = self._ask([text[a:b] for a, b in zip(starts[new].tolist(), ends[new].tolist())])
            sizes = np.array([len(f) for f in found], np.int64)
            fresh = len(self.length) + np.arange(len(found))
            self.begin = np.concatenate([self.begin, len(self.pool) + np.cumsum(sizes) - sizes])
            self.length = np.concatenate([self.length, sizes])
            self.pool = np.concatenate([self.pool, np.fromiter((i for f in found for i in f), np.uint32, int(sizes.sum()))])
            known = np.concatenate([self.known, distinct[new]])
            order = np.argsort(known, kind="stable")
            self.known, self.slot = known[order], np.concatenate([self.slot, fresh])[order]
            place = np.searchsorted(self.known, distinct)
        return self.slot[place]


def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file, made once per process."""
    kept = worker_state().setdefault("encoders", {})
    if path not in kept:
        kept[path] = Encoder(path)
    return kept[path]


def with_end(ids, bounds, end: int):
    """Ids and bounds with the end-of-text id after every row."""
    out = np.insert(ids, bounds[1:], np.uint32(end))
    return out, bounds + np.arange(len(bounds))
