"""Byte-level BPE ids of whole Arrow batches, with pieces of text looked up before they are merged.

Text is cut into the pieces that the vocabulary's own pattern makes (contractions, words, numbers,
signs, white space) with array operations; only pieces not met before are merged, by the installed
library. Texts with characters outside ``TRUSTED``, or with a special token's string, go through the
library whole, so the ids are always those of the library.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa

from . import text as tx

LIMIT = 0x2100
SLOTS = 1 << 18
POOL = 1 << 20
SPECIAL = "<|endoftext|>"

_encoders: dict[tuple[str, str], BatchEncoder] = {}


def encoder(json_path: str, ranks_path: str) -> BatchEncoder:
    """The encoder of a vocabulary, one for each worker process."""
    key = (json_path, ranks_path)
    if key not in _encoders:
        _encoders[key] = BatchEncoder(*key)
    return _encoders[key]


class BatchEncoder:
    def __init__(self, json_path: str, ranks_path: str):
        import regex
        import tiktoken

        self.json_path, self.whole = json_path, None
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.ranks = tiktoken.Encoding("pieces", pat_str=r"(?s:.+)", mergeable_ranks=ranks, special_tokens={})
        # Classes of code points: 0 white space, 1 letter, 2 number, 3 other, 9 not trusted.
        self.kind = np.full(LIMIT + 1, 9, np.int8)
        for c in [9, 10, 11, 12, 13, *range(0x20, 0x7F), *range(0xA0, 0x250), *range(0x2010, 0x2028), 0x20AC]:
            s = chr(c)
            self.kind[c] = 0 if s.isspace() else 1 if regex.match(r"\p{L}", s) else 2 if regex.match(r"\p{N}", s) else 3
        self.code = tx.mix(np.arange(LIMIT + 1, dtype=np.uint64) + np.uint64(0xA5A5)) | np.uint64(1)
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(SLOTS, np.uint64)
        self.at = np.zeros(SLOTS, np.int32)
        self.size = np.zeros(SLOTS, np.int32)
        self.pool = np.zeros(POOL, np.uint32)
        self.used = 0

    def batch(self, column: pa.Array):
        """(first row, ids, offsets) of chunks of a string column; null is the empty text."""
        for lo, hi, raw, offsets in tx.chunks(column):
            yield lo, *self.encode(raw, offsets)

    def encode(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of the texts, and where those of each text begin."""
        n = len(offsets) - 1
        if len(raw) == 0:
            return np.zeros(0, np.uint32), np.zeros(n + 1, np.int64)
        chars = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        # Offsets in code points: bytes that don't continue a character, counted up to each offset.
        lead = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
        edges = lead[offsets]
        small = np.minimum(chars, LIMIT).astype(np.int32)
        kind = self.kind[small]
        odd = np.zeros(n, bool)
        strange = np.flatnonzero(kind == 9)
        odd[np.searchsorted(edges, strange, "right") - 1] = True
        for at in np.flatnonzero((chars[:-1] == ord("<")) & (chars[1:] == ord("|"))):
            row = int(np.searchsorted(edges, at, "right")) - 1
            odd[row] |= chars[at : at + len(SPECIAL)].tobytes() == SPECIAL.encode("utf-32-le")
        starts = self._starts(chars, kind, edges)
        ends = np.append(starts[1:], len(chars))
        hashes = self._hash(small, starts, ends)
        fine = ~odd[np.searchsorted(edges, starts, "right") - 1]
        where, size = self._look_up(chars, starts, ends, hashes, fine)
        size = np.where(fine, size, 0)
        flat = self._gather(where, size)
        counts = np.concatenate(([0], np.cumsum(size)))
        bounds = counts[np.searchsorted(starts, edges, "left")]
        if odd.any():
            return self._with_odd(raw, offsets, odd, flat, bounds)
        return flat, bounds

    def _with_odd(self, raw, offsets, odd, flat, bounds):
        texts = [raw[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8") for i in np.flatnonzero(odd)]
        if self.whole is None:
            # Read only when an odd text comes, as it takes some thirty megabytes.
            from tokenizers import Tokenizer

            self.whole = Tokenizer.from_file(self.json_path)
        whole = iter(self.whole.encode_batch(texts, add_special_tokens=False))
        parts = [np.asarray(next(whole).ids, np.uint32) if odd[i] else flat[bounds[i] : bounds[i + 1]] for i in range(len(odd))]
        return np.concatenate(parts), np.concatenate(([0], np.cumsum([len(p) for p in parts])))

    def _hash(self, small, starts, ends):
        up, down = tx.powers(len(small))
        sums = np.empty(len(small) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(self.code[small] * up, out=sums[1:])
        return tx.mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64)) | np.uint64(1)

    @staticmethod
    def _starts(chars: np.ndarray, kind: np.ndarray, edges: np.ndarray) -> np.ndarray:
        """Where pieces begin: at runs of one class, with a blank before a run joined to it."""
        n = len(chars)
        first = np.zeros(n + 1, bool)
        first[edges] = True
        turn = first.copy()
        turn[1:n] |= kind[1:] != kind[:-1]
        turn[n] = True
        run = np.flatnonzero(turn)
        a, b = run[:-1], run[1:]
        begins = np.zeros(n + 1, bool)
        space = kind[a] == 0
        # Runs of other than white space; a blank just before, in the same text, belongs to them.
        s = a[~space]
        joined = (s > 0) & ~first[s] & (chars[np.maximum(s - 1, 0)] == 32)
        begins[np.where(joined, s - 1, s)] = True
        # White space: all of it at the end of a text, else all but its last character.
        p, q = a[space], b[space]
        final = first[q] | (q == n)
        begins[p[final | (q - p >= 2)]] = True
        last = q[~final] - 1
        begins[last[chars[last] != 32]] = True
        # Contractions: an apostrophe that begins a piece takes the letters of one of seven endings.
        quote = np.flatnonzero((chars == 39) & begins[:n])
        quote = quote[(quote + 1 < n)]
        quote = quote[~first[quote + 1]]
        if len(quote):
            c1 = chars[quote + 1]
            two = np.minimum(quote + 2, n - 1)
            c2 = np.where((quote + 2 < n) & ~first[quote + 2], chars[two], 0)
            one = np.isin(c1, np.frombuffer("stmd".encode("utf-32-le"), np.uint32))
            pair = ((c1 == ord("r")) & (c2 == ord("e"))) | ((c1 == ord("v")) & (c2 == ord("e"))) | ((c1 == ord("l")) & (c2 == ord("l")))
            for pick, size in ((one, 2), (pair, 3)):
                at = quote[pick]
                begins[at + 1] = False
                begins[at + size] = True
        return np.flatnonzero(begins[:n])

    def _look_up(self, chars, starts, ends, hashes, fine):
        slot = (hashes >> np.uint64(20)) & np.uint64(SLOTS - 1)
        where, size = self.at[slot].astype(np.int64), self.size[slot].astype(np.int64)
        missing = np.flatnonzero((self.keys[slot] != hashes) & fine)
        if len(missing):
            fresh, first, back = np.unique(hashes[missing], return_index=True, return_inverse=True)
            first = missing[first]
            text = chars.tobytes()
            made = [self.ranks._encode_single_piece(text[4 * i : 4 * j].decode("utf-32-le")) for i, j in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]
            lengths = np.fromiter(map(len, made), np.int64, len(made))
            total = int(lengths.sum())
            if self.used + total > len(self.pool):
                # Pieces found in the old pool are read again below, so they are kept for this call.
                old = self._gather(where, np.where(fine, size, 0) * (self.keys[slot] == hashes))
                held = np.where(fine & (self.keys[slot] == hashes), size, 0)
                self._clear()
                if total + len(old) > len(self.pool):
                    self.pool = np.zeros(total + len(old) + POOL, np.uint32)
                self.pool[: len(old)] = old
                where = np.cumsum(held) - held
                self.used = len(old)
            begin = self.used + np.cumsum(lengths) - lengths
            self.pool[self.used : self.used + total] = np.fromiter((i for m in made for i in m), np.uint32, total)
            self.used += total
            where[missing], size[missing] = begin[back], lengths[back]
            place = ((fresh >> np.uint64(20)) & np.uint64(SLOTS - 1)).astype(np.int64)
            self.keys[place], self.at[place], self.size[place] = fresh, begin, lengths
        return where, size

    def _gather(self, where, size):
        total = int(size.sum())
        start = np.repeat(where - (np.cumsum(size) - size), size)
        return self.pool[start + np.arange(total)]
