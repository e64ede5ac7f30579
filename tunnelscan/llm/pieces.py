"""SentencePiece encoding and decoding by a shared-prefix forward search.

A text is normalised as the model file says and cut into marked words (a word
with the white-space marks before it); no piece crosses such a cut.  The
distinct words of a batch are sorted, which lays them out as the paths of a
trie, and the trie is walked depth-first: every node (a prefix) holds the
forward state of its best segmentation, so words with a common prefix share it.

* ``unigram`` model files: Viterbi.  The state is the best score and its last
  piece.
* ``bpe`` model files: the file's scores are merge ranks, and the largest sum of
  ranks is not what merging gives.  The same forward search is run, but a path
  is admitted by compatibility in place of the sum: a segmentation is the merge
  result if and only if each two neighbouring pieces are what merging gives for
  the two of them alone.  So each prefix has exactly one last piece, and the ids
  equal those of the merges.

Characters without a piece become their UTF-8 byte pieces (or the unknown id
where the file has no byte pieces).

Edge cases: a NULL text counts as empty and has no ids; NULL ids in a list to
decode are left out, a NULL list decodes to NULL; repeated rows give a row each;
other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunnelscan.llm.common import as_strings, batch_of, id_text, list_array, slices

MARK = "▁"
# Words up to this many characters share prefixes; longer ones go alone.
SHARED = 64
# Words (and pairs of pieces) remembered in a task, some 200 bytes each; the
# memory starts anew beyond that.
REMEMBERED = 50_000
SLICE = 1 << 20
_WORD = re.compile(f"{MARK}+[^{MARK}\n]*|\n|[^{MARK}\n]+")


def _fields(data: bytes):
    """(number, value) of a protocol buffer message, nested ones as bytes."""
    k = 0

    def varint():
        nonlocal k
        out = shift = 0
        while True:
            c = data[k]
            k += 1
            out |= (c & 127) << shift
            shift += 7
            if c < 128:
                return out

    while k < len(data):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(key & 7) or varint()
            yield key >> 3, data[k:k + size]
            k += size


class Vocabulary:
    """Pieces, scores and rules of a model file."""

    def __init__(self, proto: bytes):
        spec, norm = {}, {}
        self.pieces, self.kinds, scores = [], [], []
        for number, value in _fields(proto):
            if number == 1:
                f = dict(_fields(value))
                self.pieces.append(f.get(1, b"").decode())
                scores.append(float(np.frombuffer(f.get(2, b"\0\0\0\0"), "<f4")[0]))
                self.kinds.append(f.get(3, 1))
            elif number == 2:
                spec = dict(_fields(value))
            elif number == 3:
                norm = dict(_fields(value))
        self.bpe = spec.get(3, 1) == 2
        # Fixed values of the file format: 1 normal, 2 unknown, 4 user-defined, 6 byte.
        self.id_of = {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k in (1, 4)}
        self.score = {p: scores[i] for p, i in self.id_of.items()}
        self.unknown = self.kinds.index(2) if 2 in self.kinds else 0
        self.byte_id = {int(p[1:-1], 16): i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k == 6}
        # A character outside every piece scores ten below the worst piece.
        self.unknown_score = min(self.score.values(), default=0.0) - 10.0
        self.identity = not norm.get(2) and not norm.get(4, 1) and norm.get(5, 1)
        self.prefix = bool(norm.get(3, 1))
        if any(MARK in p.lstrip(MARK) or ("\n" in p and len(p) > 1) for p in self.id_of):
            raise ValueError("pieces that cross words are not supported")


class Encoder:
    """Ids of distinct marked words."""

    def __init__(self, vocabulary: Vocabulary, remembered: int = REMEMBERED):
        self.v = vocabulary
        self.remembered = remembered
        self.pairs: dict[tuple[str, str], bool] = {}
        self.parts: dict[str, tuple[str, str] | None] = {}
        # Ids (32-bit, as bytes) of words met before in this task.
        self.seen: dict[str, bytes] = {}
        # Lengths of the pieces that end in two characters, the longest first.
        ends: dict[str, set[int]] = {}
        for piece in vocabulary.id_of:
            if len(piece) > 1:
                ends.setdefault(piece[-2:], set()).add(len(piece))
        self.lengths = {k: sorted(n, reverse=True) for k, n in ends.items()}

    def split(self, piece: str) -> tuple[str, str] | None:
        """The two pieces whose merge makes ``piece``; None for one character
        or a piece that merging does not reach."""
        if piece not in self.parts:
            self.parts[piece] = self._merged(piece)
        return self.parts[piece]

    def _merged(self, piece: str) -> tuple[str, str] | None:
        rank, now, last = self.v.score, list(piece), None
        while len(now) > 1:
            best = max(range(len(now) - 1), key=lambda k: (rank.get(now[k] + now[k + 1], -np.inf), -k))
            if now[best] + now[best + 1] not in rank:
                return None
            last = (now[best], now[best + 1])
            now[best:best + 2] = [now[best] + now[best + 1]]
        return last

    def compatible(self, p: str, q: str) -> bool:
        """Whether merging ``p + q`` ends in exactly the pieces p and q."""
        key = (p, q)
        if key not in self.pairs:
            self.pairs[key] = self._apart(p, q)
        return self.pairs[key]

    def _apart(self, p: str, q: str) -> bool:
        # Undo the merges of both sides, the latest (lowest score) first, and look
        # whether the pieces at the boundary would have merged before that one.
        # Equal scores are equal pieces, and the leftmost of them merges first:
        # a merge inside p comes before one across, one inside q after it.
        rank, none = self.v.score, -np.inf
        next_made, in_q = none, True
        while True:
            across = rank.get(p + q, none)
            if across > next_made or (across == next_made != none and in_q):
                return False
            made_p = rank.get(p, none) if len(p) > 1 else np.inf
            made_q = rank.get(q, none) if len(q) > 1 else np.inf
            if made_p == made_q == np.inf:
                return True
            in_q = made_q <= made_p
            next_made = made_q if in_q else made_p
            parts = self.split(q if in_q else p)
            if parts is None:
                return False
            if in_q:
                q = parts[0]
            else:
                p = parts[1]

    def encode(self, words: list[str]) -> list[list[int]]:
        """Ids of each word; ``words`` are distinct and sorted."""
        v, known = self.v, self.v.id_of
        step = self._step_bpe if v.bpe else self._step_unigram
        lengths = self.lengths
        # Forward states along the current path: entry k belongs to its first k characters.
        back, best = [0], [0.0]
        previous, out = "", []
        for w in words:
            shared = 0
            top = min(len(previous), len(w))
            while shared < top and previous[shared] == w[shared]:
                shared += 1
            del back[shared + 1:], best[shared + 1:]
            for end in range(shared + 1, len(w) + 1):
                step(w, end, back, best, lengths.get(w[end - 2:end], ()) if end > 1 else (), known)
            ids, end = [], len(w)
            while end:
                start = end - back[end]
                piece = w[start:end]
                if piece in known:
                    ids.append(known[piece])
                elif v.byte_id:
                    ids.extend(v.byte_id[c] for c in reversed(piece.encode("utf-8", "surrogatepass")))
                else:
                    ids.append(v.unknown)
                end = start
            ids.reverse()
            out.append(ids)
            previous = w
        return out

    def _step_bpe(self, w, end, back, best, lengths, known):
        for n in lengths:
            start = end - n
            if start < 0:
                continue
            piece = w[start:end]
            if piece in known and (self.parts.get(piece) or self.split(piece)):
                if not start:
                    back.append(end)
                    break
                key = (w[start - back[start]:start], piece)
                ok = self.pairs.get(key)
                if ok or ok is None and self.compatible(*key):
                    back.append(n)
                    break
        else:
            back.append(1)
        best.append(0.0)

    def _step_unigram(self, w, end, back, best, lengths, known):
        score = self.v.score
        top, size = best[end - 1] + score.get(w[end - 1:end], self.v.unknown_score), 1
        for n in lengths:
            if n <= end:
                s = score.get(w[end - n:end])
                if s is not None and best[end - n] + s > top:
                    top, size = best[end - n] + s, n
        back.append(size)
        best.append(top)

    def encode_all(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words in any order, as the bytes of 32-bit numbers;
        short words are remembered."""
        seen = self.seen
        if len(seen) > self.remembered:
            seen.clear()
        if len(self.pairs) > self.remembered:
            self.pairs.clear()
        new = sorted(w for w in words if len(w) <= SHARED and w not in seen)
        for w, ids in zip(new, self.encode(new)):
            seen[w] = array("i", ids).tobytes()
        return [seen[w] if len(w) <= SHARED else array("i", self.encode([w])[0]).tobytes() for w in words]


def marked(text: str, v: Vocabulary, normalise=None) -> str:
    """The normalised text with marks in place of spaces."""
    if not v.identity:
        return normalise(text)
    return (MARK if v.prefix and text else "") + text.replace(" ", MARK)


def _load(proto: bytes):
    v = Vocabulary(proto)
    if v.identity:
        return v, None
    import sentencepiece
    library = sentencepiece.SentencePieceProcessor(model_proto=proto)
    return v, library.normalize


def _words(part: pa.Array, v: Vocabulary, normalise):
    """(row of each word, dictionary-coded words) of a slice of texts."""
    if v.identity and not pc.any(pc.match_substring(part, "\0")).as_py():
        s = pc.replace_substring(part, " ", MARK)
        if v.prefix:
            s = pc.if_else(pc.equal(pc.binary_length(part), 0), s, pc.binary_join_element_wise(
                pa.scalar(MARK, pa.large_string()), s, pa.scalar("", pa.large_string())))
        s = pc.replace_substring(s, "\n", "\0\n\0")
        s = pc.replace_substring_regex(s, f"({MARK}+)", "\0\\1")
        lists = pc.split_pattern(s, "\0")
        row, words = pc.list_parent_indices(lists), pc.list_flatten(lists)
        full = pc.not_equal(pc.binary_length(words), 0)
        row, words = pc.filter(row, full), pc.filter(words, full)
    else:
        lists = [_WORD.findall(marked(t, v, normalise)) for t in part.to_pylist()]
        row = pa.array(np.repeat(np.arange(len(lists)), [len(x) for x in lists]))
        words = pa.array([w for x in lists for w in x], pa.large_string())
    return row.to_numpy(zero_copy_only=False), pc.dictionary_encode(words)


def encode_slice(part: pa.Array, v: Vocabulary, encoder: Encoder, normalise=None):
    """Ids of all texts one after the other, and the offsets of the texts."""
    row, coded = _words(part, v, normalise)
    ids = encoder.encode_all(coded.dictionary.to_pylist())
    sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
    every = np.frombuffer(b"".join(ids), np.int32)
    begin = np.cumsum(sizes) - sizes
    at = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    n = sizes[at] if len(at) else np.empty(0, np.int64)
    total = np.cumsum(n)
    # Positions in ``every`` of the ids of each word in turn.
    where = np.arange(int(n.sum())) - np.repeat(total - n, n) + np.repeat(begin[at], n) if len(at) else []
    count = np.bincount(row, weights=n, minlength=len(part)).astype(np.int64)
    return every[where] if len(at) else np.empty(0, np.int32), np.concatenate([[0], np.cumsum(count)])


class Decoder:
    """Texts of id lists, as bytes laid out with numpy."""

    def __init__(self, v: Vocabulary):
        raw = []
        byte = {i: c for c, i in v.byte_id.items()}
        for i, (p, kind) in enumerate(zip(v.pieces, v.kinds)):
            raw.append(bytes([byte[i]]) if kind == 6 else " ⁇ ".encode() if kind == 2
                       else p.replace(MARK, " ").encode() if kind in (1, 4) else b"")
        self.size = np.array([len(x) for x in raw], dtype=np.int64)
        self.at = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(raw), dtype=np.uint8)
        self.prefix = v.prefix

    def decode(self, ids: np.ndarray, offs: np.ndarray) -> list[str]:
        n = self.size[ids]
        ends = np.cumsum(n)
        where = np.arange(int(n.sum())) - np.repeat(ends - n, n) + np.repeat(self.at[ids], n)
        data = self.data[where].tobytes()
        cuts = np.concatenate([[0], ends])[offs]
        drop = 1 if self.prefix else 0
        out = []
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            x = data[a:b]
            out.append((x[drop:] if x[:1] == b" " else x).decode("utf-8", "replace"))
        return out


def _encode(model, with_text: bool, remembered: int, slice_bytes: int):
    kinds = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("round_trip", pa.bool_()),
                       *([("decoded", pa.string())] if with_text else [])])

    def run(batches):
        v, normalise = _load(model.value)
        encoder, decoder = Encoder(v, remembered), Decoder(v)
        for batch in batches:
            col = as_strings(batch.column(1))
            for a, b in slices(col, slice_bytes):
                part = col.slice(a, b - a)
                ids, offs = encode_slice(part, v, encoder, normalise)
                texts = decoder.decode(ids, offs)
                if v.identity:
                    same = pc.equal(pa.array(texts, pa.large_string()), part)
                else:
                    clean = [normalise(t).replace(MARK, " ") for t in part.to_pylist()]
                    same = pa.array([t == (c[1:] if v.prefix and c[:1] == " " else c) for t, c in zip(texts, clean)])
                yield batch_of(kinds, batch.column(0).slice(a, b - a), list_array(ids, offs, pa.int32()), same,
                               *([pa.array(texts, pa.string())] if with_text else []))
    return run


def _decode(model):
    kinds = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def run(batches):
        decoder = Decoder(Vocabulary(model.value))
        for batch in batches:
            lists = batch.column(1)
            none = lists.is_null().to_numpy(zero_copy_only=False)
            each = [np.array([i for i in x if i is not None], dtype=np.int64) if x else np.empty(0, np.int64)
                    for x in lists.to_pylist()]
            offs = np.cumsum([0] + [len(x) for x in each])
            texts = decoder.decode(np.concatenate(each) if each else np.empty(0, np.int64), offs)
            yield batch_of(kinds, batch.column(0), [None if z else t for t, z in zip(texts, none)])
    return run


def _model(df: DataFrame, path: str):
    with open(path, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def encode(documents: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
           with_text: bool = True, remembered: int = REMEMBERED, slice_bytes: int = SLICE) -> DataFrame:
    """``doc_id``, ``ids``, whether the text decoded from them is the normalised
    text again (``round_trip``), and that text (``decoded``) unless not wanted."""
    return id_text(documents, id_col, text_col).mapInArrow(
        _encode(_model(documents, model_path), with_text, remembered, slice_bytes),
        "doc_id long, ids array<int>, round_trip boolean" + ", decoded string" * with_text)


def decode(encoded: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``doc_id`` and the ``text`` of each list of ids."""
    rows = encoded.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                          F.col(f"`{ids_col}`").cast("array<int>").alias("ids"))
    return rows.mapInArrow(_decode(_model(encoded, model_path)), "doc_id long, text string")


def op1_sentencepiece(documents: DataFrame, model_path: str) -> DataFrame:
    # More memory for fewer words encoded anew; the ids do not depend on it.
    out = encode(documents, model_path, with_text=False, remembered=400_000, slice_bytes=8 << 20)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "round_trip")
