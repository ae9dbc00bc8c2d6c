"""SentencePiece encoding and decoding by suffix-array matching.

The words of a batch are concatenated once each and their suffixes sorted (by the first ``LONGEST`` characters, the
length of the longest piece). Every piece of the vocabulary is binary-searched for its range of occurrences; the
ranges are the edges of a segmentation lattice, sorted by the position where they end. Relaxing the edges in that
order gives each position its last piece: a BPE vocabulary has exactly one, namely the piece that stays beside the
last piece of the position where it starts, when both are merged from their characters in the order of the
vocabulary's scores. The ids are those of the vocabulary's own BPE encoder, byte fallback included.

The vocabulary file is read on the driver (a fixed size) and broadcast; nothing is trained.

Defined results: null and empty texts have no ids and decode to an empty text; the character U+2581, which the
vocabulary uses for the space, decodes as a space; every other text comes back exactly; repeated rows are encoded
alike; an empty table gives an empty result; other columns are kept (an existing ``ids``, ``n_ids`` or ``decoded``
is replaced).
"""
from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, types as T

from .common import chunks, ready

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
LONGEST = 16
#: Characters of one suffix array, and entries of the table of piece pairs seen before.
INDEXED = 1 << 19
PAIRS_SEEN = 1 << 20
#: Bytes that the ids of words seen before may take in a task, and the longest word that is remembered.
REMEMBERED = 32 << 20
REMEMBERED_WORD = 64
#: What a remembered word takes besides its characters and ids (two dictionary entries and their objects).
WORD_BYTES = 220
#: Bytes of text that are encoded together.
TOGETHER = 2 << 20

_NONE = -1


class Vocabulary:
    """Pieces, the merges that make them, and the pairs that merge."""

    def __init__(self, path: str = MODEL):
        from sentencepiece import SentencePieceProcessor
        sp = SentencePieceProcessor(model_file=path)
        size = sp.get_piece_size()
        special = {i for i in range(size) if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)}
        self.bytes = np.full(256, _NONE, np.int32)
        self.text: list[bytes] = []
        normal: dict[str, int] = {}
        for i in range(size):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
                self.text.append(bytes([int(piece[3:5], 16)]))
            else:
                self.text.append(b"" if i in special else piece.replace(SPACE, " ").encode())
                if i not in special:
                    normal[piece] = i
        self.space = normal[SPACE]
        #: runs of spaces merge last, from the left, up to the longest run that is a piece
        self.runs = {len(p): i for p, i in normal.items() if set(p) == {SPACE}}
        inner = {p: i for p, i in normal.items() if len(p) == 1 or set(p) != {SPACE}}
        rank = {p: -sp.get_score(i) for p, i in inner.items()}
        self.left, self.right = np.full(size, _NONE, np.int32), np.full(size, _NONE, np.int32)
        self.rank = np.full(size + 1, -1, np.int64)  # the last one stands for a character beyond the vocabulary
        self.length = np.ones(size + 1, np.int32)
        order = {p: r for r, p in enumerate(sorted((p for p in inner if len(p) > 1), key=rank.get))}
        reachable = []
        for p, i in inner.items():
            self.length[i] = len(p)
            if len(p) == 1:
                reachable.append((p, i))
                continue
            parts = list(p)
            while len(parts) > 2:
                at = min((k for k in range(len(parts) - 1) if parts[k] + parts[k + 1] in order),
                         key=lambda k: (order[parts[k] + parts[k + 1]], k), default=None)
                if at is None:
                    break
                parts[at:at + 2] = [parts[at] + parts[at + 1]]
            if len(parts) == 2 and parts[0] in inner and parts[1] in inner:
                self.left[i], self.right[i] = inner[parts[0]], inner[parts[1]]
                self.rank[i] = order[p]
                reachable.append((p, i))
        pairs = sorted((inner[p[:k]] * (size + 1) + inner[p[k:]], order[p]) for p in order for k in range(1, len(p))
                       if p[:k] in inner and p[k:] in inner)
        self.pair_codes = np.array([c for c, _ in pairs], np.int64)
        self.pair_ranks = np.array([r for _, r in pairs], np.int64)
        self.unknown = size
        # characters in code-point order become small numbers; 0: not in the vocabulary
        chars = sorted({c for p, _ in reachable for c in p})
        self.chars = np.array([ord(c) for c in chars], np.int64)
        number = {c: k + 1 for k, c in enumerate(chars)}
        self.piece_ids = np.array([i for _, i in reachable], np.int32)
        codes = np.zeros((len(reachable), LONGEST), np.uint64)
        for row, (p, _) in enumerate(reachable):
            codes[row, :len(p)] = [number[c] for c in p]
        self.piece_size = np.array([len(p) for p, _ in reachable], np.int64)
        # the smallest and largest suffix that begins with the piece
        high = np.where(np.arange(LONGEST) < self.piece_size[:, None], codes, np.uint64(0xFFFF))
        self.low_keys, self.high_keys = _packed(codes), _packed(high)


def _packed(codes: np.ndarray) -> list[np.ndarray]:
    """[n, LONGEST] small numbers -> LONGEST / 4 sort keys of 4 x 16 bits."""
    shift = np.array([48, 32, 16, 0], np.uint64)
    return [(codes[:, k:k + 4] << shift).sum(1, dtype=np.uint64) for k in range(0, LONGEST, 4)]


def _sorted_by(key: np.ndarray) -> np.ndarray:
    """Stable order of numbers; below 2^32 by their low and then their high 16 bits (each sorted by counting)."""
    if len(key) and int(key.max()) >> 32:
        return np.argsort(key, kind="stable")
    order = np.argsort((key & 0xFFFF).astype(np.uint16), kind="stable")
    return order[np.argsort((key >> 16).astype(np.uint16)[order], kind="stable")]


def _taken(words: list[str]) -> int:
    return WORD_BYTES * len(words) + 8 * len("".join(words))


def _parts(ids: np.ndarray, stops: np.ndarray) -> list[np.ndarray]:
    stops = stops.tolist()
    return [ids[a:b] for a, b in zip([0, *stops], stops)]


class SuffixArray:
    """Suffixes of a text of small numbers, sorted by their first LONGEST characters."""

    def __init__(self, codes: np.ndarray):
        padded = np.concatenate([codes, np.zeros(LONGEST, np.int64)]).astype(np.uint64)
        four = sum(padded[k:len(codes) + 12 + k] << np.uint64(48 - 16 * k) for k in range(4))
        keys = [four[k:k + len(codes)] for k in range(0, LONGEST, 4)]
        order = self._by_first_half(padded, keys)
        # few suffixes share their first half with another; only these are told apart by the rest
        same = np.ones(len(codes), bool)
        for k in keys[:2]:
            same[1:] &= k[order[1:]] == k[order[:-1]]
        same[:1] = False
        tied = same.copy()
        tied[:-1] |= same[1:]
        at = np.flatnonzero(tied)
        group = np.cumsum(~same)[at]
        order[at] = order[at][np.lexsort((keys[3][order[at]], keys[2][order[at]], group))]
        self.order = order
        self.keys = [k[self.order] for k in keys]

    @staticmethod
    def _by_first_half(padded: np.ndarray, keys: list[np.ndarray]) -> np.ndarray:
        """Order by the first eight characters; of up to 256 different ones, these fit one number."""
        count = len(keys[0])
        used = np.bincount(padded.astype(np.int64)) > 0
        if count and used.sum() <= 256:
            small = (np.cumsum(used) - 1).astype(np.uint64)[padded.astype(np.int64)]
            eight = small[:count].copy()
            for k in range(1, 8):
                eight <<= np.uint64(8)
                eight |= small[k:count + k]
            return np.argsort(eight)
        return np.lexsort(keys[1::-1])

    def bound(self, keys: list[np.ndarray], above: bool) -> np.ndarray:
        """For each key the first place whose suffix is not below it (above: that is above it)."""
        low, high = np.zeros(len(keys[0]), np.int64), np.full(len(keys[0]), len(self.order), np.int64)
        while (todo := low < high).any():
            mid = (low + high) // 2
            at = np.minimum(mid, len(self.order) - 1)
            before, same = np.zeros(len(mid), bool), np.ones(len(mid), bool)
            for own, key in zip(self.keys, keys):
                v = own[at]
                before |= same & (v < key)
                same &= v == key
            before |= same & above
            low = np.where(todo & before, mid + 1, low)
            high = np.where(todo & ~before, mid, high)
        return low


class Encoder:
    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.seen_code = np.full(PAIRS_SEEN, _NONE, np.int64)
        self.seen_stays = np.zeros(PAIRS_SEEN, bool)
        self._forget()

    def _forget(self) -> None:
        """Words seen before: the number of each, and the ids of word k in flat[cut[k]:cut[k + 1]]."""
        self.number: dict[str, int] = {}
        self.flat, self.cut = np.zeros(0, np.int32), np.zeros(1, np.int64)
        self.taken = 0

    def _keep(self, words: list[str]) -> None:
        """Forgets all but these of the words seen before."""
        which = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
        size = self.cut[which + 1] - self.cut[which]
        stop = np.cumsum(size)
        self.flat = self.flat[np.arange(int(size.sum())) + np.repeat(self.cut[which] - (stop - size), size)]
        self.cut = np.concatenate([[0], stop])
        self.number = dict(zip(words, range(len(words))))
        self.taken = _taken(words)

    # -- which pieces stay side by side
    def _merge_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        v = self.v
        code = a.astype(np.int64) * v.unknown + a + b  # a * (size + 1) + b
        at = np.minimum(np.searchsorted(v.pair_codes, code), len(v.pair_codes) - 1)
        return np.where(v.pair_codes[at] == code, v.pair_ranks[at], np.iinfo(np.int64).max)

    def _work_out(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Undoes the merges of both pieces, latest first; the boundary stays unless a merge across it came first."""
        v = self.v
        a, b = a.copy(), b.copy()
        limit = np.full(len(a), np.iinfo(np.int64).max)
        stays = np.ones(len(a), bool)
        open_ = np.arange(len(a))
        while len(open_):
            x, y = a[open_], b[open_]
            crossed = self._merge_rank(x, y) < limit[open_]
            stays[open_[crossed]] = False
            rx, ry = v.rank[x], v.rank[y]
            go = ~crossed & ((rx >= 0) | (ry >= 0))
            open_, x, y, rx, ry = open_[go], x[go], y[go], rx[go], ry[go]
            first = rx > ry  # of equal merges the left one came first, so the right one is undone first
            a[open_] = np.where(first, v.right[np.minimum(x, v.unknown - 1)], x)
            b[open_] = np.where(first, y, v.left[np.minimum(y, v.unknown - 1)])
            limit[open_] = np.where(first, rx, ry + 1)
        return stays

    def stays(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        code = a.astype(np.int64) * (self.v.unknown + 1) + b
        slot = (code * 0x9E3779B1 >> 12) & (PAIRS_SEEN - 1)
        missing = self.seen_code[slot] != code
        out = self.seen_stays[slot]
        if missing.any():
            new, back = np.unique(code[missing], return_inverse=True)
            found = self._work_out(new // (self.v.unknown + 1), new % (self.v.unknown + 1))
            out[missing] = found[back]
            where = slot[missing]
            self.seen_code[where] = -2  # slots that several pairs fall into keep one of them
            self.seen_stays[where], self.seen_code[where] = out[missing], code[missing]
            clash = self.seen_code[where] != code[missing]
            if clash.any():
                kept = self.seen_code[where[clash]]
                self.seen_stays[where[clash]] = self._work_out(
                    kept // (self.v.unknown + 1), kept % (self.v.unknown + 1))
        return out

    # -- words
    def words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each word with a space before it, one after the other, and where each word's ids stop."""
        until = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        flat, stops, at, ids = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)], 0, 0
        while at < len(words):
            to = max(at + 1, int(np.searchsorted(until, (until[at - 1] if at else 0) + INDEXED, side="right")))
            found, cut = self._slice(words[at:to])
            flat.append(found)
            stops.append(cut + ids)
            at, ids = to, ids + len(found)
        return np.concatenate(flat), np.concatenate(stops)

    def _slice(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        v = self.v
        text = SPACE + SPACE.join(words)  # each word begins with its space, so the words are told apart by length
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        size = np.array([len(w) + 1 for w in words])
        stop = np.cumsum(size)
        start = stop - size
        near = np.minimum(np.searchsorted(v.chars, points), len(v.chars) - 1)
        codes = np.where(v.chars[near] == points, near + 1, 0)
        # edges: every occurrence of every piece, by the position where it ends, the longest first
        index = SuffixArray(codes)
        low, high = index.bound(v.low_keys, False), index.bound(v.high_keys, True)
        times = high - low
        which = np.repeat(np.arange(len(times)), times)
        begin = index.order[np.arange(len(which)) - np.repeat(np.cumsum(times) - times, times) + np.repeat(low, times)]
        beyond = np.flatnonzero(codes == 0)
        piece = np.concatenate([v.piece_ids[which], np.full(len(beyond), v.unknown, np.int32)])
        end = np.concatenate([begin + v.piece_size[which], beyond + 1])
        order = _sorted_by(end * 32 + (31 - v.length[piece]))
        piece, end = piece[order], end[order]
        first = np.searchsorted(end, np.arange(len(codes) + 2))
        # no merge reaches over a place that no piece crosses: words are cut there and their parts relaxed side by side
        room = len(codes) + 2
        inside = np.cumsum(np.bincount(end - v.length[piece] + 1, minlength=room) - np.bincount(end, minlength=room))
        begins = inside[:len(codes)] == 0
        begins[start] = True
        word_stop = stop
        start = np.flatnonzero(begins)
        size = np.diff(np.append(start, len(codes)))
        stop = start + size
        # relax: step k settles the k-th position of every part
        last = np.full(len(codes) + 1, _NONE, np.int32)
        live = np.argsort(-size, kind="stable")
        longest_first = -size[live]
        for k in range(1, int(size.max()) + 1):
            live = live[:np.searchsorted(longest_first, -k, side="right")]
            longest_first = longest_first[:len(live)]
            here, floor = start[live] + k, start[live]
            edge = first[here]
            while len(here):
                p = piece[edge]
                back = here - v.length[p]
                inside = back >= floor
                good = inside & (back == floor)
                ask = np.flatnonzero(inside & (back > floor))
                if len(ask):
                    good[ask] = self.stays(last[back[ask]], p[ask])
                last[here[good]] = p[good]
                todo = ~good
                here, floor, edge = here[todo], floor[todo], edge[todo] + 1
        # walk back from the ends
        ends = np.zeros(len(codes) + 1, bool)
        here, floor = stop, start
        while len(here):
            ends[here] = True
            here = here - v.length[last[here]]
            on = here > floor
            here, floor = here[on], floor[on]
        at = np.flatnonzero(ends)
        ids, cut = last[at], np.searchsorted(at, word_stop, side="right")
        if (ids == v.unknown).any():
            return self._with_bytes(text, at, ids, cut)
        return ids, cut

    def _with_bytes(self, text: str, at: np.ndarray, ids: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        flat, count = [], np.ones(len(ids), np.int64)
        for k in np.flatnonzero(ids == self.v.unknown):
            raw = text[at[k] - 1].encode("utf-8", "surrogatepass")
            count[k] = len(raw)
            flat.append(self.v.bytes[list(raw)])
        out = np.repeat(ids, count)
        out[out == self.v.unknown] = np.concatenate(flat)
        total = np.concatenate([[0], np.cumsum(count)])
        return out, total[cut]

    # -- texts
    def encode(self, texts: list[str]) -> list[np.ndarray]:
        split = [t.replace(SPACE, " ").split(" ") if t else [] for t in texts]
        words = dict.fromkeys(chain.from_iterable(split))
        short = [w for w in words if w not in self.number]
        if self.taken + _taken(short) > REMEMBERED:
            self._keep([w for w in words if w in self.number])  # most words of these texts were in the ones before
        long = [w for w in short if len(w) > REMEMBERED_WORD]
        if long:
            short = [w for w in short if len(w) <= REMEMBERED_WORD]
        known = len(self.number)
        self.flat, self.cut = self._with(short)
        self.number.update(zip(short, range(known, known + len(short))))
        self.taken += _taken(short)
        flat, cut = self.flat, self.cut
        if long:  # known for these texts only
            flat, cut = self._with(long)
            known = len(self.number)
            self.number.update(zip(long, range(known, known + len(long))))
        which = np.fromiter(map(self.number.__getitem__, chain.from_iterable(split)), np.int64, sum(map(len, split)))
        for w in long:
            del self.number[w]
        size = cut[which + 1] - cut[which]
        to = np.cumsum(size)
        ids = flat[np.arange(int(size.sum())) + np.repeat(cut[which] - (to - size), size)]
        stops = np.concatenate([[0], to])[np.cumsum([len(ws) for ws in split], dtype=np.int64)]
        out = _parts(ids, stops)
        alone = ids == self.v.space
        for k in np.unique(np.searchsorted(stops, np.flatnonzero(alone[1:] & alone[:-1]), side="right")):
            out[k] = self._merge_spaces(out[k])
        return out

    def _with(self, new: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """flat and cut with the ids of further words."""
        ids, stops = self.words(new)
        return np.concatenate([self.flat, ids]), np.concatenate([self.cut, self.cut[-1] + stops])

    def _merge_spaces(self, ids: np.ndarray) -> np.ndarray:
        runs, longest, out, k = self.v.runs, max(self.v.runs), [], 0
        ids = ids.tolist()
        while k < len(ids):
            to = k
            while to < len(ids) and ids[to] == self.v.space and to - k < longest:
                to += 1
            if to - k > 1:
                n = max(m for m in runs if m <= to - k)
                out.append(runs[n])
                k += n
            else:
                out.append(ids[k])
                k += 1
        return np.array(out, np.int32)

    def decode(self, ids) -> str:
        """The text of the ids, without the space before its first word."""
        raw = b"".join([self.v.text[i] for i in ids])
        return raw[raw[:1] == b" ":].decode("utf-8", "replace")


def encode(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """docs with ``ids`` (array of int), ``n_ids`` and ``decoded``: whether decoding the ids gives the text back
    (U+2581 read as a space)."""
    ready(docs.sparkSession)
    docs = docs.drop("ids", "n_ids", "decoded")
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary(model))
    at = docs.columns.index("text")

    def run(batches):
        enc = Encoder(shared.value)  # a task's own: what it remembers goes with it
        for part in chunks(batches, size=TOGETHER):
            texts = pc.fill_null(part.column(at), "").to_pylist()
            ids = enc.encode(texts)
            size = np.array([len(x) for x in ids], np.int64)
            back = [enc.decode(x.tolist()) == t.replace(SPACE, " ") for x, t in zip(ids, texts)]
            lists = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(size)]).astype(np.int32),
                                             np.concatenate(ids).astype(np.int32))
            names = list(part.schema.names) + ["ids", "n_ids", "decoded"]
            yield pa.RecordBatch.from_arrays([*part.columns, lists, pa.array(size), pa.array(back)], names=names)

    added = [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("n_ids", T.LongType()),
             T.StructField("decoded", T.BooleanType())]
    return docs.mapInArrow(run, T.StructType(docs.schema.fields + added))


def decode(tokens: DataFrame, model: str = MODEL) -> DataFrame:
    """tokens with ``ids`` -> the same rows with ``text`` rebuilt from the ids."""
    ready(tokens.sparkSession)
    tokens = tokens.drop("text")
    shared = tokens.sparkSession.sparkContext.broadcast(Vocabulary(model))
    at = tokens.columns.index("ids")

    def run(batches):
        enc = Encoder(shared.value)
        for part in batches:
            text = [enc.decode(x or []) for x in part.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(text, pa.string())],
                                             names=[*part.schema.names, "text"])

    return tokens.mapInArrow(run, T.StructType(tokens.schema.fields + [T.StructField("text", T.StringType())]))
