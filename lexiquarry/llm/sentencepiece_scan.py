"""SentencePiece encoding as a max-plus scan, and decoding.

A text is segmented into the vocabulary's pieces with the largest sum of scores, as in the library's
unigram mode. Scores are rounded to multiples of 2**-24, so sums are exact and do not depend on their order; of equal
sums, the one whose last piece is longest is taken, then the longest before it, and so on. A character without a piece
costs the smallest score less ten and becomes byte pieces. Scores of a file learnt by merges are ranks, not
log-probabilities; rank r counts as -log(1 + r) then, its log-probability under Zipf's law up to a constant.

Where no piece contains two neighbouring characters, every segmentation has a border between them, so the
text falls into short pieces there and each distinct one is solved once per block, all of them in step.
A giant text is cut anywhere into chunks of fixed length. A chunk gives a max-plus matrix: the best score from
"so many characters of it belong to a piece begun before" to "so many characters beyond it are taken".
What lies between the first and the last certain border of a chunk is solved in the same pass. The matrices are
multiplied up a tree, FAN neighbours at a time, and going down it each chunk gets the best scores of all states before it.
With these, the head and the tail of every chunk are traced back on their own. Ids do not depend on the length of chunks.

Defined results: a null or empty text has no ids; repeated rows give repeated results; an empty table gives
an empty result. Decoding turns the piece mark into a blank, so a text that contains the mark itself decodes
with blanks instead; ids outside the vocabulary, control ids and null lists decode to nothing.
Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiquarry.llm import arrays as ar
from lexiquarry.llm.pieces import Memo, distinct_pieces, gather, marked

MARK = "▁"
CHUNK_CHARS = 1 << 15
FAN = 16
GRID = 1 << 24
FEW = 32  # texts of one length that are not worth a matrix
UNKNOWN_PENALTY = 10.0
MEMO_PIECES = 250_000  # some 300 bytes each
NEVER = -1e8  # pieces of a smaller score were not ranked
_EMPTY = np.uint64(2**64 - 1)
_SLOT = np.uint64(0x9E3779B97F4A7C15)


class Vocabulary:
    """Pieces and scores of a model file, as a trie in a hash table that numpy can walk for many texts at once."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        pieces = [model.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (
            model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        self.byte_ids = np.full(256, -1, np.int32)
        for i in range(n):
            if model.is_byte(i):
                self.byte_ids[int(pieces[i][1:-1], 16)] = i
        self.unknown_id = model.unk_id()
        self.has_bytes = bool((self.byte_ids >= 0).all())
        self.longest = max((len(pieces[i]) for i in plain), default=1)
        scores = {i: model.get_score(i) for i in plain}
        ranked = [-s for s in scores.values() if s > NEVER]
        if ranked and min(ranked) >= 0 and all(r == int(r) for r in ranked):
            behind = max(ranked) + 1
            scores = {i: -math.log(1 + min(-s, behind)) for i, s in scores.items()}
        self.scores = scores = {i: round(s * GRID) / GRID for i, s in scores.items()}
        self.unknown_score = min(scores.values(), default=0.0) - UNKNOWN_PENALTY
        self.text_of = [b""] * n
        for i in plain:
            self.text_of[i] = pieces[i].replace(MARK, " ").encode()
        for value, i in enumerate(self.byte_ids):
            if i >= 0:
                self.text_of[i] = bytes([value])
        # A character made of byte pieces counts once, at its first byte.
        self.score_of = np.zeros(n)
        self.score_of[list(scores)] = list(scores.values())
        self.score_of[self.unknown_id] = self.unknown_score
        first_bytes = self.byte_ids[np.r_[0:128, 192:256]]
        self.score_of[first_bytes[first_bytes >= 0]] = self.unknown_score
        self.known = {pieces[i]: (i, scores[i]) for i in plain}
        self._build([(pieces[i], i) for i in plain], scores)
        # Pairs of characters that stand side by side in some piece; all others always part.
        codes = [[32 if c == MARK else ord(c) for c in pieces[i]] for i in plain]
        pairs = {(a, b) for c in codes for a, b in zip(c, c[1:])}
        self.pairs = np.array(sorted((a << 21) | b for a, b in pairs), np.uint64)
        self.joined = np.zeros((128, 128), bool)
        for a, b in pairs:
            if a < 128 and b < 128:
                self.joined[a, b] = True

    def _build(self, pieces: Sequence[tuple[str, int]], scores: dict[int, float]) -> None:
        nodes: dict[tuple[int, int], int] = {}
        piece_at: dict[int, int] = {}
        for piece, i in pieces:
            node = 0
            for c in piece:
                node = nodes.setdefault((node, ord(c)), len(nodes) + 1)
            piece_at[node] = i
        self.piece = np.full(len(nodes) + 1, -1, np.int32)
        self.score = np.full(len(nodes) + 1, -np.inf)
        for node, i in piece_at.items():
            self.piece[node], self.score[node] = i, scores[i]
        bits = max(8, int(np.ceil(np.log2(8 * len(nodes) + 1))))
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.next = np.full(1 << bits, _EMPTY), np.zeros(1 << bits, np.int32)
        for (node, c), to in nodes.items():
            key = (node << 21) | c
            slot = (key * int(_SLOT) & 0xFFFFFFFFFFFFFFFF) >> int(self.shift)
            while self.keys[slot] != _EMPTY:
                slot = (slot + 1) & self.mask
            self.keys[slot], self.next[slot] = key, to

    def step(self, node: np.ndarray, char: np.ndarray) -> np.ndarray:
        """Trie nodes after one more character; 0 where there is none."""
        key = (node.astype(np.uint64) << np.uint64(21)) | char.astype(np.uint64)
        slot = ((key * _SLOT) >> self.shift).astype(np.int64)
        out, open_ = np.zeros(len(key), np.int32), np.arange(len(key))
        while len(open_):
            held = self.keys[slot]
            hit = held == key[open_]
            out[open_[hit]] = self.next[slot[hit]]
            on = ~hit & (held != _EMPTY)
            open_, slot = open_[on], (slot[on] + 1) & self.mask
        return out

    def relax(self, chars: np.ndarray, best: np.ndarray, came: np.ndarray, piece: np.ndarray) -> None:
        """Forward pass over a matrix of equally long texts.

        `best[:, p]` is the largest score of the first p characters, `came` the start of the last piece
        and `piece` its id (-1 for an unknown character).
        """
        n = chars.shape[1]
        for start in range(n):
            rows = np.flatnonzero(best[:, start] > -np.inf)
            node = np.zeros(len(rows), np.int32)
            for end in range(start + 1, min(start + self.longest, n) + 1):
                node = self.step(node, chars[rows, end - 1])
                alive = node > 0
                if end == start + 1:
                    lone = rows[~alive | (self.piece[node] < 0)]
                    self._better(lone, best[lone, start] + self.unknown_score, start, end, -1, best, came, piece)
                rows, node = rows[alive], node[alive]
                if not len(rows):
                    break
                whole = self.piece[node] >= 0
                r = rows[whole]
                self._better(r, best[r, start] + self.score[node[whole]], start, end, self.piece[node[whole]],
                             best, came, piece)

    @staticmethod
    def _better(rows, score, start, end, ids, best, came, piece) -> None:
        up = score > best[rows, end]
        rows = rows[up]
        best[rows, end], came[rows, end] = score[up], start
        piece[rows, end] = ids[up] if isinstance(ids, np.ndarray) else ids

    def relax_one(self, text: str, reach: Sequence[float], last: int) -> tuple[list[float], list[int], list[int]]:
        """(best, came, piece) of one text, as by `relax`, from first places with the scores `reach`.

        `came` is -1 where nothing in the text is better than `reach`: of equal sums, the last piece that began before it is longer.
        """
        n, longest, known = len(text), self.longest, self.known
        best, came, piece = [-math.inf] * (n + 1), [-1] * (n + 1), [-1] * (n + 1)
        best[:len(reach)] = reach[:n + 1]
        for start in range(min(last, n)):
            base = best[start]
            if base == -math.inf:
                continue
            for end in range(start + 1, min(start + longest, n) + 1):
                found = known.get(text[start:end])
                if found is None:
                    if end > start + 1:
                        continue
                    found = -1, self.unknown_score
                if base + found[1] > best[end]:
                    best[end], came[end], piece[end] = base + found[1], start, found[0]
        return best, came, piece

    def trace(self, text: str, came: np.ndarray, piece: np.ndarray, end: int, start: int = 0) -> list[int]:
        """Ids along the best path that ends at `end`, back to `start`."""
        ids: list[int] = []
        while end > start:
            begin = int(came[end])
            i = int(piece[end])
            if i >= 0:
                ids.append(i)
            elif self.has_bytes:
                ids += [int(self.byte_ids[b]) for b in reversed(text[begin:end].encode())]
            else:
                ids.append(self.unknown_id)
            end = begin
        return ids[::-1]

    def solve(self, texts: list[str]) -> list[tuple[float, bytes]]:
        """(best score, ids as 32-bit integers) of each text by itself; texts of one length are solved in step."""
        out: list = [None] * len(texts)
        by_size: dict[int, list[int]] = {}
        for i, t in enumerate(texts):
            by_size.setdefault(len(t), []).append(i)
        for size, members in by_size.items():
            if len(members) < FEW:
                for i in members:
                    best, came, piece = self.relax_one(texts[i], [0.0], size)
                    out[i] = best[size], np.array(self.trace(texts[i], came, piece, size), np.int32).tobytes()
                continue
            rows = max(1, (1 << 19) // (size + 1))
            for at in range(0, len(members), rows):
                part = members[at:at + rows]
                own = [texts[i] for i in part]
                flat = "".join(own).encode("utf-32-le", "replace")
                best = np.full((len(part), size + 1), -np.inf)
                best[:, 0] = 0
                came, piece = np.zeros(best.shape, np.int32), np.full(best.shape, -1, np.int32)
                self.relax(np.frombuffer(flat, np.uint32).reshape(len(part), size), best, came, piece)
                scores = best[:, size].tolist()
                for i, score, ids in zip(part, scores, self._trace_all(own, came, piece, size), strict=True):
                    out[i] = score, ids
        return out

    def _trace_all(self, texts: list[str], came: np.ndarray, piece: np.ndarray, size: int) -> list[bytes]:
        """`trace` for all rows in step; rows with unknown characters one by one."""
        rows, at, steps = np.arange(len(texts)), np.full(len(texts), size), []
        while at.any():
            steps.append(np.where(at > 0, piece[rows, at], -2))
            at = np.where(at > 0, came[rows, at], 0)
        if not steps:
            return [b""] * len(texts)
        ids = np.stack(steps[::-1], axis=1).astype(np.int32)
        used = ids != -2
        raw, cuts = ids[used].tobytes(), [0, *(4 * np.cumsum(used.sum(axis=1))).tolist()]
        parts = [raw[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        for row in np.flatnonzero((ids == -1).any(axis=1)):
            parts[row] = np.array(self.trace(texts[row], came[row], piece[row], size), np.int32).tobytes()
        return parts


class Encoder:
    def __init__(self, path: str) -> None:
        self.vocabulary = Vocabulary(path)
        self.memo = Memo(MEMO_PIECES)

    def _solve(self, pieces: list[bytes]) -> Iterator[bytes]:
        texts = [p.decode("utf-8", "replace").replace(" ", MARK) for p in pieces]
        return (ids for _, ids in self.vocabulary.solve(texts))

    def borders(self, data: np.ndarray) -> np.ndarray:
        """Places in a byte string where every segmentation has a border."""
        v = self.vocabulary
        a, b = data[:-1], data[1:]
        plain = (a < 128) & (b < 128)
        found = np.flatnonzero(plain & ~v.joined[a & 127, b & 127]) + 1
        if plain.all():
            return found
        chars = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32).astype(np.uint64)
        begins = np.flatnonzero((data & 0xC0) != 0x80)
        if len(chars) != len(begins):  # not valid UTF-8: only ASCII places are certain
            return found
        mixed = np.flatnonzero((chars[:-1] > 127) | (chars[1:] > 127))
        chars[chars == ord(MARK)] = 32
        key = (chars[mixed] << np.uint64(21)) | chars[mixed + 1]
        place = np.minimum(np.searchsorted(v.pairs, key), max(len(v.pairs) - 1, 0))
        apart = v.pairs[place] != key if len(v.pairs) else np.ones(len(key), bool)
        return marked(len(data), found, begins[mixed[apart] + 1])

    def rows(self, column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(first row, last row, ids, bounds) for blocks of a column whose texts begin with their blank."""
        data, offsets = ar.text_buffers(column)
        for first, last in ar.row_blocks(offsets, 4 << 20):
            block = data[offsets[first]:offsets[last]]
            breaks = offsets[first:last + 1] - offsets[first]
            if not len(block):
                yield first, last, np.zeros(0, np.int32), np.zeros(last - first + 1, np.int64)
                continue
            starts = marked(len(block), self.borders(block), breaks[:-1])
            ids, bounds = self._ids(block, starts)
            yield first, last, ids, bounds[np.searchsorted(starts, breaks)]

    def _ids(self, block: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds of each piece) of a block whose pieces between certain borders begin at `starts`."""
        index, distinct = distinct_pieces(block, starts, np.append(starts[1:], len(block)))
        known = self.memo.lookup(distinct, self._solve)
        values = np.frombuffer(b"".join(known), np.int32)
        return gather(values, np.array([len(k) // 4 for k in known], np.int64), index)

    def open_chunk(self, chunk: str, ahead: str) -> tuple[np.ndarray, str | None, np.ndarray, str]:
        """(matrix, head, ids between the first and the last certain border, tail) of a chunk.

        The max-plus matrix is [characters taken from before, characters taken beyond] -> score. `ahead` are the characters that
        follow the chunk, as many as a piece may reach. At a certain border there is one state only, so the matrix is
        the product of a column (the head), a number (what lies between) and a row (the tail). Without such a
        border the head is None and all of the chunk is the tail.
        """
        v = self.vocabulary
        data = np.frombuffer(chunk.encode("utf-8", "replace"), np.uint8)
        cuts = self.borders(data)
        ahead = ahead.replace(" ", MARK)
        out = np.full((v.longest, v.longest), -np.inf)
        if not len(cuts):
            tail = chunk.replace(" ", MARK)
            entries = min(v.longest, len(tail) + 1)
            reach = self._spread(tail + ahead, entries, len(tail))[:, len(tail):len(tail) + v.longest]
            out[:entries, :reach.shape[1]] = reach
            return out, None, np.zeros(0, np.int32), tail
        head, tail = (part.tobytes().decode("utf-8", "replace").replace(" ", MARK) for part in (data[:cuts[0]], data[cuts[-1]:]))
        ids = self._ids(data[cuts[0]:cuts[-1]], cuts[:-1] - cuts[0])[0] if len(cuts) > 1 else np.zeros(0, np.int32)
        entries = min(v.longest, len(head) + 1)
        column = self._spread(head, entries, len(head))[:, len(head)] + v.score_of[ids].sum()
        row = self._spread(tail + ahead, 1, len(tail))[0, len(tail):len(tail) + v.longest]
        out[:entries, :len(row)] = column[:, None] + row
        return out, head, ids, tail

    def _spread(self, text: str, entries: int, last: int) -> np.ndarray:
        """Best scores at all places of a text, from `entries` different starts."""
        return np.array([self.vocabulary.relax_one(text, [-math.inf] * i + [0.0], last)[0] for i in range(entries)])

    def entries(self, head: str | None, tail: str, ahead: str, reach: np.ndarray) -> list[int]:
        """Characters taken from before on the best path, for each number of characters taken beyond; one number if all agree."""
        if head is not None:
            return [self._back(self.vocabulary.relax_one(head, reach.tolist(), len(head))[1], len(head))]
        best, came, _ = self.vocabulary.relax_one(tail + ahead.replace(" ", MARK), reach.tolist(), len(tail))
        most = min(self.vocabulary.longest, len(best) - len(tail))
        return [self._back(came, len(tail) + leave) if best[len(tail) + leave] > -np.inf else -1 for leave in range(most)]

    @staticmethod
    def _back(came: list[int], end: int) -> int:
        while came[end] >= 0:
            end = came[end]
        return end

    def ends(self, head: str | None, tail: str, ahead: str, reach: np.ndarray, leave: int) -> tuple[list[int], list[int]]:
        """Ids of the pieces that begin in the head and in the tail, on the best path that takes `leave` characters beyond."""
        v, first = self.vocabulary, []
        if head is not None:
            _, came, piece = v.relax_one(head, reach.tolist(), len(head))
            first = v.trace(head, came, piece, len(head), self._back(came, len(head)))
            reach = np.zeros(1)
        text = tail + ahead.replace(" ", MARK)
        _, came, piece = v.relax_one(text, reach.tolist(), len(tail))
        return first, v.trace(text, came, piece, len(tail) + leave, self._back(came, len(tail) + leave))


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker; it keeps its memo."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def max_plus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Product of two max-plus matrices; associative."""
    return (a[:, :, None] + b[None, :, :]).max(axis=1)


def _level(m: np.ndarray) -> np.ndarray:
    """Scores less their largest one: only differences matter, and small numbers stay exact."""
    return m - m.max()


def product(matrices: list[np.ndarray]) -> np.ndarray:
    out = matrices[0]
    for m in matrices[1:]:
        out = _level(max_plus(out, m))
    return out


def reaches(before: np.ndarray, matrices: list[np.ndarray]) -> list[np.ndarray]:
    """Scores of the states in front of each chunk, from those in front of the first."""
    out = [before]
    for m in matrices[:-1]:
        out.append(_level(max_plus(out[-1][None, :], m)[0]))
    return out


def leaves(entries: list[list[int]]) -> list[int]:
    """Characters that each chunk takes beyond its end; nothing lies beyond the last one."""
    out = [0]
    for at in entries[:0:-1]:
        out.append(at[out[-1]] if len(at) > 1 else at[0])
    return out[::-1]


def _chunks(giants: DataFrame, path: str, chunk_chars: int) -> DataFrame:
    """(mark, k, chunk, ahead): every text in chunks, each with what a last piece may reach into."""
    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        reach = encoder(path).vocabulary.longest - 1
        for i in range(batch.num_rows):
            mark, text = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
            starts = range(0, len(text), chunk_chars)
            for at in range(0, len(starts), 64):
                part = starts[at:at + 64]
                ends = [s + chunk_chars for s in part]
                yield {"mark": [mark] * len(part), "k": [s // chunk_chars for s in part],
                       "chunk": [text[s:e] for s, e in zip(part, ends, strict=True)],
                       "ahead": [text[e:e + reach] for e in ends]}

    return ar.map_arrow(giants, work, "mark string, k int, chunk string, ahead string")


def _matrix(raw: bytes) -> np.ndarray:
    flat = np.frombuffer(raw, np.float64)
    return flat.reshape(math.isqrt(len(flat)), -1)


def _reached(level: DataFrame) -> DataFrame:
    """(mark, k, reach): the scores of the states in front of every chunk, by a tree of matrix products.

    Every task has FAN matrices at a time. The rounds are as many as the largest text needs.
    """
    from lexiquarry.llm.storage import settle

    most = level.agg(F.max("k")).first()[0] or 0
    up = (F.col("k") / FAN).cast("int")
    levels = [level.withColumn("up", up)]

    def multiply(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("k")
        whole = product([_matrix(m) for m in rows["m"]])
        return pd.DataFrame({"mark": rows["mark"].iloc[:1].to_numpy(), "k": rows["up"].iloc[:1].to_numpy(), "m": [whole.tobytes()]})

    def descend(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("k")
        matrices = [_matrix(m) for m in rows["m"]]
        begin = np.full(len(matrices[0]), -np.inf)
        begin[0] = 0  # a text begins with its first piece
        held = rows["before"].iloc[0]
        found = reaches(begin if held is None else np.frombuffer(held, np.float64), matrices)
        return rows[["mark", "k"]].assign(reach=[r.tobytes() for r in found])

    while most >= FAN:
        levels.append(settle(levels[-1].groupBy("mark", "up").applyInPandas(multiply, "mark string, k int, m binary"),
                             "products").withColumn("up", up))
        most //= FAN
    before = levels[-1].withColumn("before", F.lit(None).cast("binary"))
    while True:
        found = settle(before.groupBy("mark", "up").applyInPandas(descend, "mark string, k int, reach binary"), "reached")
        levels.pop()
        if not levels:
            return found
        before = levels[-1].join(found.select("mark", F.col("k").alias("up"), F.col("reach").alias("before")), ["mark", "up"])


def _encode_giants(giants: DataFrame, path: str, key: str, keep: Sequence[str], chunk_chars: int) -> DataFrame:
    from lexiquarry.llm.storage import settle

    # Chunks of one text meet other tasks here, and equal texts are solved once.
    chunks = _chunks(giants.select("mark", "blanked"), path, chunk_chars).dropDuplicates(["mark", "k"])

    def solve(batch: pa.RecordBatch) -> Iterator[dict]:
        work = encoder(path)
        for at in range(0, batch.num_rows, 32):
            part = batch.slice(at, 32)
            found = [work.open_chunk(c, a) for c, a in zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True)]
            yield {"mark": part.column(0), "k": part.column(1), "ahead": part.column(3), "m": [f[0].tobytes() for f in found],
                   "head": [f[1] for f in found], "ids": ar.list_column([f[2] for f in found], pa.int32()), "tail": [f[3] for f in found]}

    solved = settle(ar.map_arrow(chunks, solve, "mark string, k int, ahead string, m binary, head string, ids array<int>, tail string"),
                    "solved")
    reached = _reached(solved.select("mark", "k", "m"))
    borders = solved.select("mark", "k", "head", "tail", "ahead").join(reached, ["mark", "k"])

    def enter(batch: pa.RecordBatch) -> Iterator[dict]:
        work = encoder(path)
        rows = batch.to_pylist()
        yield {c: batch.column(c) for c in ("mark", "k", "head", "tail", "ahead", "reach")} | {
            "entries": [work.entries(r["head"], r["tail"], r["ahead"], np.frombuffer(r["reach"], np.float64)) for r in rows]}

    texts = "mark string, k int, head string, tail string, ahead string, reach binary"
    entered = settle(ar.map_arrow(borders, enter, texts + ", entries array<int>"), "entered")

    def walk(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("k")
        return rows[["mark", "k"]].assign(leave=leaves([list(e) for e in rows["entries"]]))

    # A text has at most 2**31 characters, so a group has at most 2**31 / chunk_chars rows of a few numbers.
    left = entered.select("mark", "k", "entries").groupBy("mark").applyInPandas(walk, "mark string, k int, leave int")

    def trace(batch: pa.RecordBatch) -> Iterator[dict]:
        work = encoder(path)
        ids = [work.ends(r["head"], r["tail"], r["ahead"], np.frombuffer(r["reach"], np.float64), r["leave"]) for r in batch.to_pylist()]
        for side in (0, 1):
            yield {"mark": batch.column("mark"), "k": batch.column("k"), "side": [2 * side] * len(ids),
                   "ids": ar.list_column([np.array(i[side], np.int32) for i in ids], pa.int32())}

    shape = "mark string, k int, side int, ids array<int>"
    ends = ar.map_arrow(entered.drop("entries").join(left, ["mark", "k"]), trace, shape)
    whole = (ends.unionByName(solved.select("mark", "k", F.lit(1).alias("side"), "ids"))
             .groupBy("mark").agg(F.sort_array(F.collect_list(F.struct("k", "side", "ids"))).alias("parts"))
             .select("mark", F.flatten(F.col("parts")["ids"]).alias("ids")))
    rows = giants.select(key, "mark", *keep)
    return rows.join(whole, "mark").select(rows[key], *[rows[c] for c in keep], F.size("ids").alias("n_tokens"), "ids")


def encode_pieces(documents: DataFrame, model_path: str, key: str = "doc_id", text: str = "text",
                  keep: Sequence[str] = (), chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """(key, *keep, n_tokens, ids): the best segmentation of a blank and the text, for every row.

    Texts of more than `chunk_chars` characters are cut into chunks of that many, which other tasks share.
    """
    if chunk_chars < 256:
        raise ValueError("a chunk must be longer than any piece: chunk_chars is at least 256")
    types = dict(documents.dtypes)
    kept = [c for c in keep if c != key]
    blanked = F.when(F.length(text) > 0, F.concat(F.lit(" "), F.col(text))).otherwise("")
    rows = documents.select(key, *kept, blanked.alias("blanked"))
    giant = F.length("blanked") > chunk_chars

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        for first, last, ids, bounds in encoder(model_path).rows(batch.column(batch.num_columns - 1)):
            part = batch.slice(first, last - first)
            yield {c: part.column(i) for i, c in enumerate([key, *kept])} | {
                "n_tokens": np.diff(bounds).astype(np.int32),
                "ids": pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids, pa.int32()))}

    schema = ", ".join(f"{c} {types[c]}" for c in [key, *kept]) + ", n_tokens int, ids array<int>"
    short = ar.map_arrow(rows.where(~giant).select(key, *kept, "blanked"), work, schema)
    return short.unionByName(_encode_giants(rows.where(giant).withColumn("mark", F.md5("blanked")), model_path, key, kept, chunk_chars))


def decode_pieces(rows: DataFrame, model_path: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """Replaces the id column by the text it stands for."""
    others = [c for c in rows.columns if c != ids]
    types = dict(rows.dtypes)

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        v = encoder(model_path).vocabulary
        store, sizes = np.frombuffer(b"".join(v.text_of), np.uint8), np.array([len(t) for t in v.text_of] + [0])
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            column = part.column(len(others))
            flat = np.array(column.flatten(), dtype=np.int64)
            flat = np.where((flat >= 0) & (flat < len(v.text_of)), flat, len(v.text_of))
            counts = np.array(pc.fill_null(pc.list_value_length(column), 0))
            data, bounds = gather(store, sizes, flat)
            ends = bounds[np.concatenate([[0], np.cumsum(counts)])]
            raw = data.tobytes()
            texts = [raw[a:b].decode("utf-8", "replace").removeprefix(" ") for a, b in zip(ends[:-1], ends[1:])]
            yield {c: part.column(i) for i, c in enumerate(others)} | {text: texts}

    schema = ", ".join([*[f"{c} {types[c]}" for c in others], f"{text} string"])
    return ar.map_arrow(rows.select(*others, ids), work, schema)
