"""Numbers of pieces that a model's own library cuts texts into.

In a BPE model no piece has a blank after another character, so no merge joins a character with a
blank behind it: text is cut there, with runs of blanks whole, and the library counts each unit once for
each chunk; counts are remembered. Of models or normalizers for which that doesn't hold the library
counts whole texts.

``Counter`` counts by unigram scores, by an automaton over the bytes of all pieces and dynamic
programming. Read so, a BPE model's merge ranks give other counts than its own, so no query uses it.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as tx

UNKNOWN_PENALTY = 10.0
MARK = "▁"
SLOTS = 1 << 20

_counters: dict[str, Counter] = {}
_libraries: dict[str, LibraryCounter] = {}


def read_vocabulary(path: str) -> list[tuple[str, float]]:
    """The pieces and scores of a model file; the first is the unknown piece."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


def counter(path: str) -> Counter:
    """The counter of a vocabulary, one for each worker process."""
    if path not in _counters:
        _counters[path] = Counter(read_vocabulary(path))
    return _counters[path]


def library_counter(path: str) -> LibraryCounter:
    """The library's counter of a model, one for each worker process."""
    if path not in _libraries:
        _libraries[path] = LibraryCounter(path)
    return _libraries[path]


class LibraryCounter:
    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        with open(path, "rb") as file:
            model = sentencepiece_model_pb2.ModelProto.FromString(file.read())
        rule, kinds = model.normalizer_spec, model.SentencePiece
        plain = rule.add_dummy_prefix and rule.escape_whitespaces and not rule.remove_extra_whitespaces and not rule.precompiled_charsmap
        plain = plain and not model.trainer_spec.treat_whitespace_as_suffix and model.trainer_spec.model_type == model.trainer_spec.BPE
        own = {kinds.NORMAL, kinds.BYTE, kinds.CONTROL, kinds.UNKNOWN}
        self.cut = plain and all(p.type in own and MARK not in p.piece.lstrip(MARK) for p in model.pieces)
        # A lone blank behind a character; the library would add one to the empty text's none.
        self.blank = len(self.library.encode("a ")) - len(self.library.encode("a"))
        self.keys = np.zeros(SLOTS, np.uint64)
        self.held = np.zeros(SLOTS, np.int64)

    def _counted(self, texts: list[str]) -> np.ndarray:
        return np.fromiter(map(len, self.library.encode(texts, num_threads=1)), np.int64, len(texts))

    def count(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The number of pieces of each text."""
        n = len(offsets) - 1
        if len(raw) == 0:
            return np.zeros(n, np.int64)
        data = raw.tobytes()
        if not self.cut:
            return self._counted([data[a:b].decode() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)])
        # A unit begins at a text and at the first of each run of blanks, which is the mark that the
        # library puts before a text. The mark itself in a text reads as a blank.
        blank = (raw == 32).astype(np.int64)
        mark = MARK.encode()
        if len(raw) >= 3:
            blank[:-2][(raw[:-2] == mark[0]) & (raw[1:-1] == mark[1]) & (raw[2:] == mark[2])] = 3
        at = np.flatnonzero(blank)
        behind = np.zeros(len(raw) + 3, bool)
        behind[at + blank[at]] = True
        begins = (blank > 0) & ~behind[: len(raw)]
        opening = offsets[:-1][offsets[:-1] < offsets[1:]]
        begins[opening] = True
        # At a text's start the mark comes before its own blanks.
        blank[opening] = 0
        starts = np.flatnonzero(begins)
        ends = np.append(starts[1:], len(raw))
        body = starts + blank[starts]
        hashes = tx.span_hashes(raw, body, ends) | np.uint64(1)
        slot = ((hashes >> np.uint64(20)) & np.uint64(SLOTS - 1)).astype(np.int64)
        value = self.held[slot]
        missing = np.flatnonzero(self.keys[slot] != hashes)
        if len(missing):
            fresh, first, back = np.unique(hashes[missing], return_index=True, return_inverse=True)
            where = missing[first]
            made = self._counted([data[a:b].decode() for a, b in zip(body[where].tolist(), ends[where].tolist(), strict=True)])
            made[body[where] == ends[where]] = self.blank
            value[missing] = made[back]
            place = ((fresh >> np.uint64(20)) & np.uint64(SLOTS - 1)).astype(np.int64)
            self.keys[place], self.held[place] = fresh, made
        total = np.concatenate(([0], np.cumsum(value)))
        edge = np.searchsorted(starts, offsets, "left")
        return total[edge[1:]] - total[edge[:-1]]


class Counter:
    def __init__(self, vocabulary: list[tuple[str, float]], unknown: int = 0):
        self.unknown_score = min(s for _, s in vocabulary) - UNKNOWN_PENALTY
        children: list[dict[int, int]] = [{}]
        piece = [-1]
        for k, (text, _) in enumerate(vocabulary):
            at = 0
            for b in text.encode():
                if b not in children[at]:
                    children[at][b] = len(children)
                    children.append({})
                    piece.append(-1)
                at = children[at][b]
            if at:
                piece[at] = k
        n = len(children)
        self.next = np.zeros((n, 256), np.int32)
        fail = np.zeros(n, np.int64)
        link = np.zeros(n, np.int64)  # the longest proper suffix that is a piece, or the root
        piece_at = np.array(piece)
        level = [0]
        while level:
            below = []
            for s in level:
                if s:
                    link[s] = fail[s] if piece_at[fail[s]] >= 0 else link[fail[s]]
                row = self.next[fail[s]].copy() if s else self.next[0]
                for b, child in children[s].items():
                    fail[child] = row[b] if s else 0
                    row[b] = child
                    below.append(child)
                self.next[s] = row
            level = below
        self.first = np.where(piece_at >= 0, np.arange(n), link)
        self.link = link
        known = piece_at >= 0
        self.length = np.where(known, [len(vocabulary[k][0].encode()) if k >= 0 else 0 for k in piece], 0)
        self.score = np.where(known, [vocabulary[k][1] if k >= 0 else 0.0 for k in piece], 0.0)
        self.is_unknown = piece_at == unknown
        self.single = known & np.array([k >= 0 and len(vocabulary[k][0]) == 1 for k in piece])
        self.keys = np.zeros(SLOTS, np.uint64)
        self.held = np.zeros(SLOTS, np.int64)

    def count(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The number of pieces of each text."""
        n = len(offsets) - 1
        if len(raw) == 0:
            return np.zeros(n, np.int64)
        # A unit begins at a text and at each blank; its blank, or the start of the text, is the mark.
        # The mark itself in a text reads as a blank.
        blank = (raw == 32).astype(np.int64)
        mark = MARK.encode()
        if len(raw) >= 3:
            blank[:-2][(raw[:-2] == mark[0]) & (raw[1:-1] == mark[1]) & (raw[2:] == mark[2])] = 3
        begins = blank > 0
        begins[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
        starts = np.flatnonzero(begins)
        ends = np.append(starts[1:], len(raw))
        body = starts + blank[starts]
        hashes = tx.span_hashes(raw, body, ends) | np.uint64(1)
        slot = ((hashes >> np.uint64(20)) & np.uint64(SLOTS - 1)).astype(np.int64)
        value = self.held[slot]
        missing = np.flatnonzero(self.keys[slot] != hashes)
        if len(missing):
            fresh, first, back = np.unique(hashes[missing], return_index=True, return_inverse=True)
            at = missing[first]
            made = self._units(raw, body[at], ends[at])
            value[missing] = made[back]
            place = ((fresh >> np.uint64(20)) & np.uint64(SLOTS - 1)).astype(np.int64)
            self.keys[place], self.held[place] = fresh, made
        total = np.concatenate(([0], np.cumsum(value)))
        edge = np.searchsorted(starts, offsets, "left")
        return total[edge[1:]] - total[edge[:-1]]

    def _units(self, raw, body, ends) -> np.ndarray:
        size = ends - body
        out = np.zeros(len(body), np.int64)
        order = np.argsort(size, kind="stable")
        cuts = np.flatnonzero(np.diff(size[order])) + 1
        for group in np.split(order, cuts):
            width = int(size[group[0]])
            step = max(1, (1 << 22) // (width + 3))
            for a in range(0, len(group), step):
                part = group[a : a + step]
                grid = raw[body[part][:, None] + np.arange(width)[None, :]] if width else np.zeros((len(part), 0), np.uint8)
                out[part] = self._best(grid)
        return out

    def _best(self, grid: np.ndarray) -> np.ndarray:
        """Piece counts of units of one length, all at once."""
        n = len(grid)
        mark = np.frombuffer(MARK.encode(), np.uint8)
        grid = np.concatenate((np.broadcast_to(mark, (n, len(mark))), grid), axis=1)
        width = grid.shape[1]
        score = np.full((n, width + 1), -np.inf)
        count = np.zeros((n, width + 1), np.int64)
        unknown = np.zeros((n, width + 1), bool)
        score[:, 0] = 0.0
        state = np.zeros(n, np.int64)
        rows = np.arange(n)
        starts = (grid & 0xC0) != 0x80
        begin = np.zeros(n, np.int64)  # where the character at hand begins
        for j in range(1, width + 1):
            begin = np.where(starts[:, j - 1], j - 1, begin)
            state = self.next[state, grid[:, j - 1]]
            whole = starts[:, j] if j < width else np.ones(n, bool)
            node = self.first[state]
            alone = np.zeros(n, bool)
            live = np.flatnonzero(node)
            while len(live):
                at = node[live]
                from_ = j - self.length[at]
                made = score[live, from_] + self.score[at]
                better = made > score[live, j]
                alone[live] |= self.single[at]
                won, src, at_won = live[better], from_[better], at[better]
                score[won, j] = made[better]
                unk = self.is_unknown[at_won]
                count[won, j] = count[won, src] + ~(unk & unknown[won, src])
                unknown[won, j] = unk
                node[live] = self.link[at]
                live = live[node[live] > 0]
            lone = np.flatnonzero(whole & ~alone)
            if len(lone):
                src = begin[lone]
                made = score[lone, src] + self.unknown_score
                better = made > score[lone, j]
                won, src = lone[better], src[better]
                score[won, j] = made[better]
                count[won, j] = count[won, src] + ~unknown[won, src]
                unknown[won, j] = True
        return count[rows, width]


def _counted(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    made = library_counter(path)
    for batch in batches:
        for lo, hi, raw, offsets in tx.chunks(batch.column("text")):
            n = made.count(raw, offsets)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo), pa.array(n)], ["doc_id", "n_tokens"])


def count_tokens(docs: DataFrame, model_path: str) -> DataFrame:
    """One row for every row of ``docs``: doc_id, n_tokens.

    Counts are those of the model's own library, without its marks of start and end. Null and empty
    texts have 0. Repeated rows are counted one by one; only ``doc_id`` and ``text`` are used. An empty
    table gives an empty one.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return docs.mapInArrow(partial(_counted, path=model_path), "doc_id long, n_tokens long")
