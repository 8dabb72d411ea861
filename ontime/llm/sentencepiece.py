"""SentencePiece encoding and decoding by a streaming Viterbi search.

The search runs over the characters of a normalised text. A piece spans at
most ``longest`` characters, so only the last ``longest`` positions can still
be extended; their best paths are kept as back pointers. Whenever the paths of
all these positions pass through one boundary, the pieces up to it are
committed and forgotten. Memory is bounded by the window and the stretch since
the last commit, not by the text.

Both kinds of model files are supported. In a unigram model a path's score is
the sum of its pieces' scores. In a BPE model an edge from piece p to piece t
is open only if merging p + t by the model's priorities leaves [p, t]; such
paths are exactly the merge results of every prefix, so each position has one
survivor and the committed ids equal those of the merge procedure.

If no piece holds a space mark after another character, every path has a
boundary before such a mark, so all paths meet there. The stretches between
these boundaries repeat over a corpus, so their ids are kept in a bounded table
per worker. In a BPE model many stretches stream side by side, a lane each: a
round takes up to ``_STEP`` more characters of every stretch that is not at its
end, and the lanes commit up to the boundary where the paths of their window
meet. A short stretch ends in its first round. Rounds serve every length; where fewer than
``_SIDE`` lanes are left, each goes on alone from its last commit, character by character.

Defined cases. NULL stays NULL in decoding and has no ids in encoding; empty
text has no ids. Characters outside the vocabulary become byte pieces, or, in
a model without those, one unknown id a run. Repeated rows are encoded alike;
empty tables give empty results.
"""

from __future__ import annotations

import re
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

MARK = "\u2581"  # stands for a space
_NORMAL, _UNKNOWN, _USER_DEFINED, _BYTE = 1, 2, 4, 6
_UNIGRAM, _BPE = 1, 2
UNKNOWN_PENALTY = 10.0
_DEAD = -3  # marks a boundary that no path reaches
_TABLE_LIMIT, _PAIR_LIMIT, _PAIR_BITS, _STEP, _SIDE = 1_000_000, 1_000_000, 20, 64, 48
_KEEP = 32  # longest stretch in the table
_BATCH_CHARS = 1 << 21
_STRETCH = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
_models: dict[str, "PieceModel"] = {}


def _spread(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


class _PieceTable:
    """Piece ids by the polynomial hash of their characters; a second table holds what shares a slot in the first."""

    def __init__(self, ids: dict[str, int]):
        bits = 20
        self.reserve(max(map(len, ids), default=1))
        self.shifts = (np.uint64(64 - bits), np.uint64(20))
        self.mask = np.uint64((1 << bits) - 1)
        self.keys, self.places = np.zeros(max(ids.values(), default=0) + 1, np.uint64), []
        value = {i: sum((ord(c) + 1) * int(self.power[k]) for k, c in enumerate(t)) % (1 << 64)
                 for t, i in ids.items()}
        for shift in self.shifts:
            places, rest = np.full(1 << bits, -1, np.int32), {}
            if value:
                mixed = _spread(np.array(list(value.values()), np.uint64))
                slots = ((mixed >> shift) & self.mask).astype(np.int64)
                for (i, v), slot in zip(value.items(), slots.tolist()):
                    if places[slot] < 0:
                        self.keys[i], places[slot] = v, i
                    else:
                        rest[i] = v
            self.places.append(places)
            value = rest
        if value:
            raise ValueError("the vocabulary does not fit the lookup tables")

    def reserve(self, n: int) -> None:
        """Powers of the hash's base up to ``n`` characters, and of its inverse."""
        base = 0x9E3779B97F4A7C15
        self.power, self.back = (np.multiply.accumulate(np.append(np.uint64(1), np.full(n, b, np.uint64)))
                                 for b in (base, pow(base, -1, 1 << 64)))

    def find(self, value: np.ndarray) -> np.ndarray:
        """Piece ids of hashes, -1 where there is none."""
        mixed = _spread(value)
        out = np.full(len(value), -1)
        for shift, places in zip(self.shifts, self.places):
            place = places[((mixed >> shift) & self.mask).astype(np.int64)]
            out = np.where((place >= 0) & (self.keys[place] == value), place, out)
        return out


class PieceModel:
    """The pieces of a model file and the search over them."""

    def __init__(self, proto: sentencepiece_model_pb2.ModelProto):
        spec, norm = proto.trainer_spec, proto.normalizer_spec
        if spec.model_type not in (_UNIGRAM, _BPE):
            raise ValueError("only unigram and BPE models are supported")
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces \
                or spec.treat_whitespace_as_suffix:
            raise ValueError("only models with the identity normaliser are supported")
        if any(p.type == _USER_DEFINED for p in proto.pieces):
            raise ValueError("user-defined pieces are not supported")
        self.bpe, self.prefix = spec.model_type == _BPE, norm.add_dummy_prefix
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == _NORMAL}
        self.text = [p.piece for p in proto.pieces]
        self.score = [p.score for p in proto.pieces]
        self.longest = max(map(len, self.ids), default=1)
        self.unknown = next((i for i, p in enumerate(proto.pieces) if p.type == _UNKNOWN), 0)
        byte_ids = {int(p.piece[3:5], 16): i for i, p in enumerate(proto.pieces) if p.type == _BYTE}
        self.byte_ids = [byte_ids[b] for b in range(256)] if len(byte_ids) == 256 else None
        self.raw = [bytes([int(p.piece[3:5], 16)]) if p.type == _BYTE
                    else p.piece.replace(MARK, " ").encode() if p.type == _NORMAL
                    else spec.unk_surface.encode() if p.type == _UNKNOWN else b"" for p in proto.pieces]
        self.floor = min((self.score[i] for i in self.ids.values()), default=0.0) - UNKNOWN_PENALTY
        self.breaks_at_mark = not any(MARK in t.lstrip(MARK) for t in self.ids)
        self.starts = dict.fromkeys((t[:k] for t in self.ids for k in range(1, len(t))), -1) | self.ids
        self.characters = frozenset(t for t in self.ids if len(t) == 1)
        self.closed = all(self.characters.issuperset(t) for t in self.ids)
        self.lookup = _PieceTable(self.ids)
        self.pair_key = np.full(1 << _PAIR_BITS, np.iinfo(np.uint64).max)
        self.pair_open = np.zeros(1 << _PAIR_BITS, bool)
        self.pairs: dict[int, bool] = {}
        self.stretches: dict[str, bytes] = {}

    # ---- merge procedure of short strings, to decide which pieces may follow each other ----

    def merged(self, text: str) -> list[str]:
        """Greedy merges: always the adjacent pair whose union has the best score, leftmost first."""
        parts, ids, score = list(text), self.ids, self.score
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                k = ids.get(parts[i] + parts[i + 1])
                if k is not None and (best is None or score[k] > best):
                    best, at = score[k], i
            if at < 0:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def may_follow(self, p: int, t: int) -> bool:
        key = p << 32 | t
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= _PAIR_LIMIT:
                self.pairs.clear()
            left, right = self.text[p], self.text[t]
            known = self.pairs[key] = self.merged(left + right) == [left, right]
        return known

    # ---- streaming search ----

    def pieces(self, chars, after: int | None = None):
        """Yield (piece id, or -1 and an unknown character) of an iterable of characters, as they are committed.

        ``after`` is the piece that was committed before them (BPE; known characters only). A boundary that
        only paths around that commit could reach is then dead.
        """
        # path[k] = (start, id, score) of the best way to the boundary after k characters of the buffer;
        # open_at: starts from which the buffer's end is still inside some piece
        text, path, longest, since, get = "", [(0, after, 0.0)], self.longest, 0, self.starts.get
        open_at: list[int] = []
        for c in chars:
            text += c
            n = len(text)
            open_at.append(n - 1)
            best, still = None, []
            for start in open_at:
                i = get(text[start:])
                if i is None:
                    continue
                still.append(start)
                if i >= 0:
                    before = path[start]
                    if not self.bpe:
                        total = before[2] + self.score[i]
                        if best is None or total > best[2]:
                            best = (start, i, total)
                    elif best is None and before[1] != _DEAD and (before[1] is None or before[1] < 0
                                                                  or self.may_follow(before[1], i)):
                        best = (start, i, 0.0)
            if best is None and after is not None:
                best = (n - 1, _DEAD, 0.0)
            elif best is None or (not self.bpe and c not in self.ids):
                unknown = (n - 1, -1, path[n - 1][2] + self.floor)
                if best is None or unknown[2] > best[2]:
                    best = unknown
            path.append(best)
            open_at = still
            since += 1
            if since >= longest and n >= longest:
                cut = self._meeting(path, longest)
                since = 0
                if cut:
                    yield from self._trace(text, path, cut)
                    # the piece before the cut stays known to the first positions after it
                    head = (0, path[cut][1], path[cut][2])
                    path = [head] + [(start - cut, i, s) for start, i, s in path[cut + 1:]]
                    text = text[cut:]
                    open_at = [start - cut for start in open_at if start >= cut]
        yield from self._trace(text, path, len(text))

    @staticmethod
    def _meeting(path, longest: int) -> int:
        """The last boundary that the paths of all positions of the window share."""
        alive = set(range(max(1, len(path) - longest), len(path)))
        while len(alive) > 1:
            last = max(alive)
            alive.discard(last)
            alive.add(path[last][0])
        return alive.pop()

    @staticmethod
    def _trace(text: str, path, end: int):
        out = []
        while end > 0:
            start, i, _ = path[end]
            out.append((i, text[start:end]))
            end = start
        return reversed(out)

    # ---- the same search for many BPE stretches side by side ----

    def _solve(self, stretches: list[str]) -> list[bytes]:
        """Ids of distinct stretches of vocabulary characters."""
        out: list[bytes] = [b""] * len(stretches)
        size = np.fromiter(map(len, stretches), np.int64, len(stretches))
        # of every lane: its stretch, the characters committed and reached, and the piece before the first open one
        lane, base, end, head = np.arange(len(size)), np.zeros_like(size), np.minimum(size, _STEP), np.full(len(size), -2)
        while len(lane):
            if len(lane) < _SIDE:
                for k, a, h in zip(lane.tolist(), base.tolist(), head.tolist()):
                    out[k] += np.array([i for i, _ in self.pieces(stretches[k][a:], h)], np.uint32).tobytes()
                break
            width = end - base
            order, lo, cut, before = np.argsort(width, kind="stable"), 0, np.zeros_like(width), head.copy()
            while lo < len(order):  # lanes of like width together
                shortest = int(width[order[lo]])
                hi = int(np.searchsorted(width[order], max(6, shortest + shortest // 2), "right"))
                group, lo = order[lo:hi], hi
                text = [stretches[k][a:e] if a or e < size[k] else stretches[k]
                        for k, a, e in zip(lane[group].tolist(), base[group].tolist(), end[group].tolist())]
                last, come = self._lanes(text, width[group], head[group])
                stop = width[group].copy()
                for i in np.flatnonzero(end[group] < size[lane[group]]).tolist():
                    stop[i] = self._meeting_of(come[:stop[i] + 1, i].tolist())
                for k, ids in zip(lane[group].tolist(), self._trace_all(last, come, stop)):
                    out[k] = out[k] + ids if out[k] else ids
                cut[group], before[group] = stop, last[stop, np.arange(len(group))]
            going = np.flatnonzero(end < size[lane])
            lane, base, head, width = lane[going], (base + cut)[going], before[going], width[going]
            # without a commit the next round takes twice as much, so that no character is read often
            end = np.minimum(size[lane], end[going] + np.where(cut[going] > 0, _STEP, np.maximum(_STEP, width)))
        return out

    def _meeting_of(self, come: list[int]) -> int:
        """The last boundary that the paths of the window's positions share; ``come`` holds where each one's piece starts."""
        if len(come) <= self.longest:
            return 0
        alive = set(range(len(come) - self.longest, len(come)))
        while len(alive) > 1:
            last = max(alive)
            alive.discard(last)
            alive.add(come[last])
        return alive.pop()

    def _lanes(self, stretches: list[str], size: np.ndarray, head: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The piece that ends at each position of each lane (-1: none), and where it starts; ``head`` stands before (-2: none)."""
        m, width = len(stretches), int(size.max())
        chars = np.array(stretches, f"<U{width}").view(np.uint32).reshape(m, width).T.astype(np.uint64)
        table = self.lookup
        if len(table.power) <= width:
            table.reserve(2 * width)
        sums = np.zeros((width + 1, m), np.uint64)
        np.cumsum((chars + np.uint64(1)) * table.power[:width, None], axis=0, out=sums[1:])
        last, come = np.full((width + 1, m), -1), np.zeros((width + 1, m), np.int64)
        last[0] = head
        for end in range(1, width + 1):
            left = np.flatnonzero(size >= end)  # lanes without a piece that ends here
            for start in range(max(0, end - self.longest), end):
                before = last[start, left]
                piece = table.find((sums[end, left] - sums[start, left]) * table.back[start])
                fits = (piece >= 0) & (before != -1)
                inner = np.flatnonzero(fits & (before >= 0))
                if len(inner):
                    fits[inner] = self._may_follow_all(before[inner], piece[inner])
                if fits.any():
                    lanes = left[fits]
                    last[end, lanes], come[end, lanes] = piece[fits], start
                    left = left[~fits]
                    if not len(left):
                        break
        return last, come

    @staticmethod
    def _trace_all(last: np.ndarray, come: np.ndarray, stop: np.ndarray) -> list[bytes]:
        """Ids of the pieces up to position ``stop`` of each lane."""
        width, m = len(last) - 1, len(stop)
        ids, at, end, rows = np.zeros((m, width), np.uint32), np.full(m, width), stop.copy(), np.flatnonzero(stop)
        while len(rows):
            at[rows] -= 1
            ids[rows, at[rows]] = last[end[rows], rows]
            end[rows] = come[end[rows], rows]
            rows = rows[end[rows] > 0]
        return [row[a:].tobytes() for row, a in zip(ids, at.tolist())]

    def _may_follow_all(self, p: np.ndarray, t: np.ndarray) -> np.ndarray:
        key = (p.astype(np.uint64) << np.uint64(32)) | t.astype(np.uint64)
        slot = (_spread(key) >> np.uint64(64 - _PAIR_BITS)).astype(np.int64)
        fresh = np.flatnonzero(self.pair_key[slot] != key)
        if len(fresh):
            new, first = np.unique(key[fresh], return_index=True)
            at = slot[fresh[first]]
            answers = [self.may_follow(k >> 32, k & 0xFFFFFFFF) for k in new.tolist()]
            self.pair_key[at], self.pair_open[at] = new, answers
            # a slot holds one pair, so pairs that share a slot are answered here
            found = np.array(answers)[np.searchsorted(new, key[fresh])]
            out = self.pair_open[slot]
            out[fresh] = found
            known = np.setdiff1d(np.arange(len(key)), fresh, assume_unique=True)
            lost = known[self.pair_key[slot[known]] != key[known]]
            out[lost] = [self.may_follow(k >> 32, k & 0xFFFFFFFF) for k in key[lost].tolist()]
            return out
        return self.pair_open[slot]

    # ---- whole texts ----

    def _unknown(self, run: str) -> bytes:
        ids = [self.byte_ids[b] for b in run.encode("utf-8", "replace")] if self.byte_ids else [self.unknown]
        return np.array(ids, np.uint32).tobytes()

    def _encode_stretch(self, text: str) -> bytes:
        out, was_unknown = [], False
        for i, piece in self.pieces(text):
            if i >= 0:
                out.append(i)
            elif self.byte_ids:
                out.extend(self.byte_ids[b] for b in piece.encode("utf-8", "replace"))
            elif not was_unknown:
                out.append(self.unknown)
            was_unknown = i < 0
        return np.array(out, np.uint32).tobytes()

    def _stretches_of(self, text: str) -> list[str]:
        """The stretches between certain boundaries of a text, in order."""
        if not text:
            return []
        text = (MARK if self.prefix else "") + text.replace(" ", MARK)
        # without byte pieces a run of unknown characters may cross a mark that is itself unknown
        if not self.breaks_at_mark or not (self.byte_ids or MARK in self.ids):
            return [text]
        if MARK + MARK not in text and text[0] == MARK:
            return [MARK + w for w in text[1:].split(MARK)]
        return _STRETCH.findall(text)

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Little-endian uint32 ids of texts."""
        parts, table = [self._stretches_of(t) for t in texts], self.stretches
        if len(table) > _TABLE_LIMIT:
            table.clear()
        new = set().union(*parts).difference(table)
        solved, runs, mixed = {}, set(), {}
        for p in new:
            if not (self.bpe and self.closed):
                solved[p] = self._encode_stretch(p)
            elif self.characters.issuperset(p):
                runs.add(p)
            else:  # no piece holds an unknown character, so all paths meet on both sides of it
                mixed[p] = [(known, "".join(run)) for known, run in groupby(p, self.characters.__contains__)]
                runs.update(run for known, run in mixed[p] if known)
        plain = list(runs)
        ids_of = dict(zip(plain, self._solve(plain))) if plain else {}
        solved.update((p, b"".join(ids_of[run] if known else self._unknown(run) for known, run in parts))
                      for p, parts in mixed.items())
        solved.update((p, ids_of[p]) for p in new if p not in solved)
        table.update(solved)
        out = [b"".join(map(table.__getitem__, part)) for part in parts]
        for p in new:  # long stretches hardly repeat
            if len(p) > _KEEP:
                del table[p]
        return out

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def decode(self, ids: bytes) -> str:
        """The text of little-endian uint32 ids."""
        joined = b"".join(map(self.raw.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        if self.prefix and joined[:1] == b" ":
            joined = joined[1:]
        return joined.decode("utf-8", "replace")


def load_model(path: str) -> PieceModel:
    """The model of a file; read once per worker."""
    if path not in _models:
        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        _models[path] = PieceModel(proto)
    return _models[path]


def _encoded(model, texts: pa.Array) -> list[bytes]:
    out, group, size = [], [], 0
    for t in texts:
        group.append(t.as_py() or "")
        size += len(group[-1])
        if size > _BATCH_CHARS:
            out += model.encode_all(group)
            group, size = [], 0
    return out + model.encode_all(group)


def encode(text: Column, model_path: str) -> Column:
    """BINARY column: little-endian uint32 ids; empty for NULL."""
    @F.arrow_udf("binary")
    def ids(texts: pa.Array) -> pa.Array:
        return pa.array(_encoded(load_model(model_path), texts), pa.binary())
    return ids(text)


def round_trip(text: Column, model_path: str) -> Column:
    """STRUCT column (ids, back): :func:`encode` and what :func:`decode` makes of it, in one call."""
    @F.arrow_udf("struct<ids:binary,back:string>")
    def both(texts: pa.Array) -> pa.Array:
        model = load_model(model_path)
        ids = _encoded(model, texts)
        return pa.StructArray.from_arrays([pa.array(ids, pa.binary()), pa.array([model.decode(i) for i in ids], pa.string())],
                                          ["ids", "back"])
    return both(text)


def decode(ids: Column, model_path: str) -> Column:
    """STRING column: the text of ids as :func:`encode` gives them."""
    @F.arrow_udf("string")
    def texts(column: pa.Array) -> pa.Array:
        model = load_model(model_path)
        return pa.array([None if not i.is_valid else model.decode(i.as_py()) for i in column], pa.string())
    return texts(ids)
