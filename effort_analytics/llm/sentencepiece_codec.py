"""SentencePiece encoding and decoding (5): streaming Viterbi over a piece vocabulary.

The best segmentation maximises the sum of piece scores (ties: the longer last piece). Text is
read character by character; a boundary's best path needs only the boundaries up to the longest
piece before it, so only that window of scores is kept. Now and then the surviving paths - those of
the boundaries that a later piece can still start from - are followed back: where they meet in one
boundary, the ids before it are final, are handed out, and their back pointers dropped.

Where no piece of the vocabulary crosses a place - one that has the space mark only at its start
can't cross the end of a word - all paths meet at once: what stands between two such places is
encoded by itself and remembered in a cache of bounded size.

A piece whose own text has a better segmentation by other pieces is on no best path (that
segmentation could take its place), so the trie leaves it out; ids decode by all pieces.

Characters outside the vocabulary become their UTF-8 bytes' pieces. A literal space mark (U+2581)
is always spelt by its bytes, so that decoding restores every text exactly.
"""

from __future__ import annotations

import hashlib
import re
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ._common import batch_of, keyed, table

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
_MARK = "▁"
_SHORT = 64
_NEVER = float("-inf")


class Vocabulary:
    """Pieces and scores of a model file, as a trie: a node is (map of characters to nodes, id and
    score of the piece that ends there, or None). ``bytes_``: the ids of the 256 byte pieces.
    ``chosen``: the pieces that a best path can have, where :func:`_chosen` has found them before."""

    def __init__(self, pieces: list[tuple[str, float, int]], bytes_: list[int], cache: int = 200_000,
                 chosen: list[tuple[str, float, int]] | None = None):
        self.bytes_ = bytes_
        self.text = {i: p.replace(_MARK, " ").encode() for p, _, i in pieces} | {b: bytes([k]) for k, b in enumerate(bytes_)}
        self.low = _low(pieces)
        self.cost = _ByteCosts(self.low)
        used = _chosen(pieces) if chosen is None else chosen
        self.longest = max((len(p) for p, _, _ in used), default=1)
        nodes: dict[str, dict] = {"": {}}
        ends = {p: (i, score) for p, score, i in used}
        for p in sorted({p[:k] for p, _, _ in used for k in range(1, len(p) + 1)}, key=len):
            nodes[p] = {}
            nodes[p[:-1]][p[-1]] = (nodes[p], *ends.get(p, (None, None)))
        self.trie = nodes[""]
        self.start = _State.over(used, self.cost)
        self.units = _units({p for p, _, _ in used})
        self.cache: dict[str, bytes] = {}  # ids as int32
        self.cache_size = cache


class _ByteCosts(dict):
    """Score of a character spelt by its bytes."""

    def __init__(self, low: float):
        self.low = low

    def __missing__(self, c: str) -> float:
        self[c] = cost = self.low * len(c.encode())
        return cost


def _low(pieces: list[tuple[str, float, int]]) -> float:
    """Score of one byte piece: below that of any other."""
    return min((s for p, s, _ in pieces if _MARK not in p.lstrip(_MARK)), default=0.0) - 10.0


def _chosen(pieces: list[tuple[str, float, int]]) -> list[tuple[str, float, int]]:
    """The pieces that a best path can have: those with the space mark only at their start, without
    those whose text other pieces (of these, which suffices, or bytes) spell at a higher score. A tie
    keeps a piece. Sums of whole numbers are exact; with others a piece stays unless the rest is
    better by more than rounding can make."""
    used = {p: (p, s, i) for p, s, i in pieces if _MARK not in p.lstrip(_MARK)}
    cost = _ByteCosts(_low(pieces))
    slack = 0.0 if all(s == int(s) for _, s, _ in used.values()) else 1e-6 * max(abs(s) for _, s, _ in used.values())
    kept: dict[str, tuple[str, float, int]] = {}
    longest = 1
    for p in sorted(used, key=len):
        score = [0.0]
        for e in range(1, len(p) + 1):
            found = [score[-1] + cost[p[e - 1]]]
            found += [score[s] + kept[p[s:e]][1] for s in range(max(0, e - longest), e) if p[s:e] in kept]
            score.append(max(found))
        if score[-1] <= used[p][1] + slack:
            kept[p] = used[p]
            longest = len(p)
    return list(kept.values())


class _State(dict):
    """The longest end of the characters read so far that begins a piece; maps a character to the next
    such state. ``ends``: (length, score, id) of the pieces that end here, longest first; where no
    piece is the last character alone, its bytes (the character as id) come last."""

    __slots__ = ("name", "ends", "every")

    def __init__(self, name: str, every: dict[str, "_State"]):
        self.name, self.every = name, every

    def __missing__(self, c: str) -> "_State":
        p = self.name + c
        while p not in self.every:
            p = p[1:]
        if p and len(self) < 512:
            self[c] = self.every[p]
        return self.every[p]

    @classmethod
    def over(cls, pieces: list[tuple[str, float, int]], cost: dict[str, float]) -> "_State":
        known = {p: (len(p), s, i) for p, s, i in pieces}
        every: dict[str, _State] = {}
        for p in {""} | {p[:k] for p in known for k in range(1, len(p) + 1)}:
            every[p] = cls(p, every)
        for p, state in every.items():
            ends = [known[p[k:]] for k in range(len(p)) if p[k:] in known]
            state.ends = (*ends, *([(1, cost[p[-1]], p[-1])] if p and p[-1] not in known else []))
        return every[""]


def load(path: str = MODEL) -> dict:
    """What a task needs of a model file: its pieces with scores, and its byte pieces."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    plain = [(model.id_to_piece(i), model.get_score(i), i) for i in range(n) if not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i))]
    by_name = {model.id_to_piece(i): i for i in range(n) if model.is_byte(i)}
    bytes_ = [by_name[f"<0x{k:02X}>"] for k in range(256)]
    return {"pieces": plain, "bytes_": bytes_, "chosen": _chosen(plain)}


def _units(pieces: set[str]) -> re.Pattern:
    """Pattern of the stretches between places that no piece crosses: before spaces that follow
    other text, between a letter or digit and a mark that no piece has after one, around line ends
    and tabs that no longer piece has."""
    pairs = {p[i:i + 2] for p in pieces for i in range(len(p) - 1)}
    alone = re.escape("".join(c for c in "\n\t\r" if not any(c in p for p in pairs)))
    after = {p[1] for p in pairs if (p[0].isalnum() or p[0] > "\x7f") and p[0] != _MARK}
    marks = re.escape("".join(c for c in map(chr, range(0x21, 0x7F)) if not c.isalnum() and c not in after))
    own = f"[{alone}]+|" if alone else ""
    other = f"[^ {alone}{marks}]"
    if not marks:
        return re.compile(f"{own} *{other}+| +")
    return re.compile(rf"{own} *(?:[{marks}]|{other})(?:{other}|(?<![A-Za-z0-9\x80-\U0010ffff])[{marks}])*| +")


class StreamingViterbi:
    """Encodes characters as they come: ``push`` returns ids that are final, ``finish`` the rest.

    A boundary hands its score on to those that a piece from it reaches, once as many characters
    as the longest piece has follow it. ``chars``, ``score`` and ``back`` start at the last
    boundary that all surviving paths are known to share.
    """

    def __init__(self, vocabulary: Vocabulary, check: int | None = None):
        self.v = vocabulary
        self.check = check or 4 * vocabulary.longest
        self.chars: list[str] = []
        self.score = [0.0]
        self.back: list[tuple[int, object]] = [(0, None)]  # start of the last piece; its id, or a character for its bytes
        self.at = 0       # boundaries before this have handed on their scores
        self.widest = 1   # boundaries kept at a time, at most

    def push(self, text: str, marks: int = 0) -> list[int]:
        """``marks``: so many characters at the start of ``text`` are space marks, others literal."""
        self.chars += [_MARK * 3 if c == _MARK and k >= marks else c for k, c in enumerate(text)]  # no edge of the trie is so called
        return self._advance(len(self.chars) - self.v.longest)

    def finish(self) -> list[int]:
        return self._advance(len(self.chars)) + self._commit(len(self.chars))

    def _advance(self, to: int) -> list[int]:
        out: list[int] = []
        while self.at < to:
            self._relax(self.at)
            self.at += 1
            if self.at >= self.check:
                done = self._meeting()
                self.widest = max(self.widest, len(self.back))
                out += self._commit(done)
                self.at -= done
                to -= done
                if not done:  # paths that don't meet yet: look again after as many boundaries
                    self.check *= 2
        return out

    def _relax(self, s: int) -> None:
        score, back, chars, node = self.score, self.back, self.chars, self.v.trie
        own, c = score[s], chars[s]
        c = _MARK if len(c) > 1 else c
        last = len(score) - 1
        if s == last:
            score.append(own + self.v.low * len(c.encode()))
            back.append((s, c))
            last += 1
        elif (t := own + self.v.low * len(c.encode())) > score[s + 1]:
            score[s + 1], back[s + 1] = t, (s, c)
        for e in range(s, len(chars)):
            hit = node.get(chars[e])
            if hit is None:
                return
            node, piece, gain = hit
            if piece is not None:
                t = own + gain
                while last <= e:  # boundaries that no path reaches yet
                    score.append(_NEVER)
                    back.append((s, None))
                    last += 1
                if t > score[e + 1] or t == score[e + 1] and back[e + 1][0] == s:
                    score[e + 1], back[e + 1] = t, (s, piece)

    def _meeting(self) -> int:
        """The last boundary that the paths of all boundaries still in use share."""
        live = {i for i in range(self.at, len(self.back)) if self.score[i] != _NEVER}
        while len(live) > 1:
            last = max(live)
            live.remove(last)
            live.add(self.back[last][0])
        return live.pop()

    def _commit(self, to: int) -> list[int]:
        ids: list[int] = []
        at = to
        while at > 0:
            start, piece = self.back[at]
            ids.extend([self.v.bytes_[b] for b in reversed(piece.encode())] if isinstance(piece, str) else [piece])
            at = start
        del self.chars[:to], self.score[:to]
        self.back = [(0, None), *((s - to, p) for s, p in self.back[to + 1:])]
        return ids[::-1]


def _best(unit: str, v: Vocabulary) -> list[int]:
    """Ids of a stretch between two places where all paths meet; long ones go through the window."""
    marks = len(unit) - len(unit.lstrip(" "))
    if len(unit) > _SHORT or _MARK in unit:
        coder = StreamingViterbi(v)
        return coder.push(_MARK * marks + unit[marks:], marks) + coder.finish()
    state, score, back = v.start, [0.0], []
    for c in _MARK * marks + unit[marks:]:
        state = state[c]
        if not state.ends:  # a character of no piece
            score.append(score[-1] + v.cost[c])
            back.append((1, c))
            continue
        best = _NEVER
        for k, gain, piece in state.ends:
            t = score[-k] + gain
            if t > best:
                best, length, last = t, k, piece
        score.append(best)
        back.append((length, last))
    ids: list[int] = []
    at = len(back)
    while at:
        length, piece = back[at - 1]
        at -= length
        if isinstance(piece, str):
            ids.extend([v.bytes_[b] for b in reversed(piece.encode())])
        else:
            ids.append(piece)
    return ids[::-1]


def encode(text: str, v: Vocabulary) -> np.ndarray:
    """Ids of a text, with a space put before it; of an empty text none."""
    if not text:
        return np.zeros(0, np.int32)
    units, cache = v.units.findall(" " + text), v.cache
    new = set(units).difference(cache)
    for unit in new:
        cache[unit] = array("i", _best(unit, v)).tobytes()
    ids = np.frombuffer(b"".join(map(cache.__getitem__, units)), np.int32)
    for unit in new:
        if len(unit) > _SHORT:
            del cache[unit]
    if len(cache) > v.cache_size:
        cache.clear()
    return ids


def decode(ids, v: Vocabulary) -> str:
    return b"".join(map(v.text.__getitem__, ids))[1:].decode("utf-8", "replace")


_OUT = "doc_id long, n_chars long, n_tokens long, ids array<int>, ids_sha256 string, text_sha256 string, exact boolean"


def _code(shared):
    schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32())),
                        ("ids_sha256", pa.string()), ("text_sha256", pa.string()), ("exact", pa.bool_())])

    def run(batches):
        v = Vocabulary(**shared.value)
        for batch in batches:
            doc, text = batch.column("doc_id"), batch.column("text")
            for i in range(0, len(text), 256):
                out = {f.name: [] for f in schema if f.name != "doc_id"}
                for t in text.slice(i, 256).to_pylist():
                    ids = encode(t, v)
                    again = decode(ids.tolist(), v)
                    for k, x in (("n_chars", len(t)), ("n_tokens", len(ids)), ("ids", ids), ("ids_sha256", hashlib.sha256(ids.tobytes()).hexdigest()),
                                 ("text_sha256", hashlib.sha256(again.encode()).hexdigest()), ("exact", again == t)):
                        out[k].append(x)
                yield batch_of(schema, doc_id=doc.slice(i, 256), **out)
    return run


def encode_documents(docs: DataFrame, model: str = MODEL, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: doc_id, n_chars, n_tokens, ids, the digest of the ids (int32, little
    endian), the digest of the text decoded from them, and whether that is the text itself.

    NULL and empty texts have no ids. Every input row gives a row; a NULL id stays NULL. Other
    columns are left out. The vocabulary is read once, on the driver, and broadcast: its size
    doesn't depend on the data.
    """
    shared = docs.sparkSession.sparkContext.broadcast(load(model))
    return keyed(docs, id_col, text_col).select("doc_id", "text").mapInArrow(_code(shared), _OUT)


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents")).drop("ids")
