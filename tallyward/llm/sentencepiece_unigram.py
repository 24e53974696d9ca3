"""SentencePiece-style encoding and decoding: unigram Viterbi over a double-array trie.

A vocabulary file gives pieces in order of rank and byte pieces; a piece of rank r
gets the log probability of a Zipf law, ``-log(r + SHIFT) - log(norm)`` (the file's
own scores are merge ranks, not probabilities).  The best segmentation is found by
Viterbi: from each position the trie lists all pieces that start there.  A character
that is no piece costs ``UNKNOWN_PENALTY`` below the worst piece and is written as
its UTF-8 bytes.  Spaces are part of pieces (the white-space marker), a text begins
with one, and decoding takes it away again, so every text comes back exactly.

Text is cut where no piece reaches across: in front of each run of spaces, at line
ends, and between a word and the marks behind it, as far as the vocabulary allows.
The pieces found for a chunk are kept in a bounded cache; this changes no result.
The model is a few MB of fixed arrays, broadcast once.  Documents are mapped where
they are, nothing is shuffled.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.llm.common import query, table

MARKER = "▁"
SHIFT = 2.7
UNKNOWN_PENALTY = 10.0
#: Scores are multiples of this, so sums are exact and ties are ties.
GRAIN = 1 / 1024
CACHE = 400_000
#: Longer chunks are segmented one by one.
SHORT = 64


@dataclass
class Trie:
    """Double array: the child of state s by code c is t = base[s] + c if check[t] == s."""

    codes: dict[str, int]
    base: array
    check: array
    value: array

    @classmethod
    def build(cls, pieces: dict[str, int]) -> Trie:
        uses = Counter(c for p in pieces for c in p)
        codes = {c: i + 1 for i, (c, _) in enumerate(sorted(uses.items(), key=lambda x: (-x[1], x[0])))}
        children: list[dict[int, int]] = [{}]
        piece_of = {}
        for piece, number in pieces.items():
            node = 0
            for c in piece:
                step = children[node]
                node = step.get(codes[c], -1)
                if node < 0:
                    node = step[codes[c]] = len(children)
                    children.append({})
            piece_of[node] = number
        size = len(children) * 2 + 2 * len(codes) + 16
        base, check, value = array("i", [0]) * size, array("i", [-1]) * size, array("i", [-1]) * size
        check[0] = 0
        free, todo = 1, [(0, 0)]
        for node, state in todo:  # breadth first
            value[state] = piece_of.get(node, -1)
            kids = sorted(children[node])
            if not kids:
                continue
            while check[free] >= 0:
                free += 1
            slot = free
            while True:
                b = slot - kids[0]
                if check[slot] < 0 and b >= 0 and b + kids[-1] < size and all(check[b + k] < 0 for k in kids):
                    break
                slot += 1
                if slot + kids[-1] >= size:
                    for a, fill in ((base, 0), (check, -1), (value, -1)):
                        a.extend([fill] * size)
                    size *= 2
            base[state] = b
            for k in kids:
                check[b + k] = state
                todo.append((children[node][k], b + k))
        for a, fill in ((base, 0), (check, -1), (value, -1)):  # any state plus any code is inside
            a.extend([fill] * (len(codes) + 1))
        return cls(codes, base, check, value)


@dataclass
class Unigram:
    """Pieces (with spaces for markers), scores, trie, and the ids of the 256 byte pieces."""

    texts: list[str]
    scores: list[float]
    byte_ids: list[int]
    trie: Trie

    @classmethod
    def load(cls, path: str) -> Unigram:
        """From a SentencePiece vocabulary file with byte pieces; its merge order is the rank."""
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        kind = ["byte" if sp.is_byte(i) else "none" if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) else "piece" for i in range(n)]
        pieces = [sp.id_to_piece(i) for i in range(n)]
        ranked = sorted((i for i in range(n) if kind[i] == "piece"), key=lambda i: (-sp.get_score(i), i))
        return cls.of(pieces, kind, ranked)

    @classmethod
    def of(cls, pieces: list[str], kind: list[str], ranked: list[int]) -> Unigram:
        norm = np.log(sum(1 / (r + SHIFT) for r in range(len(ranked))))
        scores = [0.0] * len(pieces)
        for r, i in enumerate(ranked):
            scores[i] = round((-np.log(r + SHIFT) - norm) / GRAIN) * GRAIN
        texts = [p.replace(MARKER, " ") if k == "piece" else "" for p, k in zip(pieces, kind, strict=True)]
        byte_ids = [0] * 256
        for i, k in enumerate(kind):
            if k == "byte":
                byte_ids[int(pieces[i][1:-1], 16)] = i
        return cls(texts, scores, byte_ids, Trie.build({texts[i]: i for i in ranked}))


def chunk_pattern(texts: list[str]):
    """A function that cuts text into chunks that no piece reaches across; None if spaces do not part pieces."""
    pairs = {(a, b) for t in texts for a, b in zip(t, t[1:], strict=False)}
    if any(b == " " and a != " " for a, b in pairs):
        return None
    marks = {c for t in texts for c in t if not c.isalnum() and c not in " \n"}
    while bad := {b for a, b in pairs if b in marks and a != " " and a not in marks}:
        marks -= bad  # marks stay that only ever follow spaces or other such marks
    m = "".join(map(re.escape, sorted(marks)))
    lone = "" if any("\n" in t for t in texts) else "\n"  # a line end that is in no piece stands alone
    head = f" *[{m}]*" if m else " *"
    ends = "|\n" if lone else ""
    marked = f"|[{m}]+" if m else ""
    return re.compile(f"{head}[^ {lone}{m}]+{marked}| +(?:[{m}]+)?{ends}" if m else f"{head}[^ {lone}]+| +{ends}").findall


class Codec:
    """Encodes and decodes single texts in a task."""

    #: Python workers serve many tasks; what the last one learned stays.
    _kept: tuple[int, Codec] | None = None

    @classmethod
    def of(cls, model: Broadcast) -> Codec:
        mark = hash((tuple(model.value.scores), model.value.trie.base.tobytes()))
        if cls._kept is None or cls._kept[0] != mark:
            cls._kept = (mark, cls(model.value))
        return cls._kept[1]

    def __init__(self, model: Unigram) -> None:
        self.model = model
        self.cache: dict[str, tuple[int, ...]] = {}
        self.arrays = None
        self.unknown = min(model.scores) - UNKNOWN_PENALTY
        self.chunks = chunk_pattern(model.texts)
        self.byte_of = {i: b for b, i in enumerate(model.byte_ids)}
        # Bytes below 128 are characters of their own.
        self.plain = [chr(self.byte_of[i]) if self.byte_of.get(i, 128) < 128 else t for i, t in enumerate(model.texts)]
        self.parts = {i for i, b in self.byte_of.items() if b >= 128}

    def viterbi(self, text: str) -> tuple[int, ...]:
        t, scores = self.model.trie, self.model.scores
        codes, base, check, value = t.codes, t.base, t.check, t.value
        found = [codes.get(c, 0) for c in text]
        n = len(text)
        best = [float("-inf")] * (n + 1)
        best[0] = 0.0
        back: list[tuple[int, int]] = [(0, -1)] * (n + 1)
        for i in range(n):
            here, state, single = best[i], 0, False
            for j in range(i, n):
                c = found[j]
                if not c:
                    break
                following = base[state] + c
                if check[following] != state:
                    break
                state = following
                v = value[state]
                if v >= 0:
                    single |= j == i
                    score = here + scores[v]
                    if score > best[j + 1]:
                        best[j + 1], back[j + 1] = score, (i, v)
            if not single and here + self.unknown > best[i + 1]:
                best[i + 1], back[i + 1] = here + self.unknown, (i, -1)
        out: list[int] = []
        while n:
            i, v = back[n]
            if v >= 0:
                out.append(v)
            else:
                out.extend(self.model.byte_ids[b] for b in reversed(text[i:n].encode("utf-8")))
            n = i
        return tuple(reversed(out))

    def viterbi_many(self, chunks: list[str]) -> list[tuple[int, ...]]:
        """``viterbi`` of many short chunks at once: each step advances all of them."""
        if self.arrays is None:
            t = self.model.trie
            codes = np.zeros(0x110000, dtype=np.int32)
            codes[[ord(c) for c in t.codes]] = list(t.codes.values())
            self.arrays = (codes, np.array(t.base), np.array(t.check), np.array(t.value), np.array(self.model.scores))
        codes, base, check, value, scores = self.arrays
        points = np.frombuffer("".join(chunks).encode("utf-32-le"), dtype=np.uint32)
        length = np.array([len(c) for c in chunks], dtype=np.int64)
        start = np.cumsum(length) - length
        node = start + np.arange(len(chunks))  # a chunk of n characters has n + 1 nodes
        found = codes[points]
        total = len(points) + len(chunks)
        best = np.full(total, -np.inf)
        best[node] = 0.0
        back, piece = np.zeros(total, dtype=np.int64), np.full(total, -1, dtype=np.int64)
        for i in range(int(length.max())):
            live = np.flatnonzero(length > i)
            single = np.zeros(len(chunks), dtype=bool)
            here, on, state, j = best[node + np.minimum(i, length)], live, np.zeros(len(live), dtype=np.int64), i
            while len(on):
                c = found[start[on] + j]
                step = base[state] + c
                good = (c > 0) & (check[step] == state)
                on, state = on[good], step[good].astype(np.int64)
                v = value[state]
                has = v >= 0
                at, v = on[has], v[has]
                if j == i:
                    single[at] = True
                target, score = node[at] + j + 1, here[at] + scores[v]
                better = score > best[target]
                target = target[better]
                best[target], back[target], piece[target] = score[better], i, v[better]
                j += 1
                more = length[on] > j
                on, state = on[more], state[more]
            lone = live[~single[live]]
            target, score = node[lone] + i + 1, here[lone] + self.unknown
            better = score > best[target]
            target = target[better]
            best[target], back[target], piece[target] = score[better], i, -1
        at, rows, steps = length.copy(), np.arange(len(chunks)), []
        while len(rows):
            v = piece[node[rows] + at[rows]]
            before = back[node[rows] + at[rows]]
            steps.append((rows, np.where(v >= 0, v, -2 - before)))
            at[rows] = before
            rows = rows[before > 0]
        flat_rows = np.concatenate([r for r, _ in reversed(steps)])
        flat = np.concatenate([v for _, v in reversed(steps)])
        order = np.argsort(flat_rows, kind="stable")
        ends = np.cumsum(np.bincount(flat_rows, minlength=len(chunks))).tolist()
        ids, out, a = flat[order].tolist(), [], 0
        for chunk, b in zip(chunks, ends, strict=True):
            got = ids[a:b]
            if min(got) < 0:
                got = [x for g in got for x in ((g,) if g >= 0 else [self.model.byte_ids[y] for y in chunk[-2 - g].encode("utf-8")])]
            out.append(tuple(got))
            a = b
        return out

    def encode_many(self, texts: list[str | None]) -> list[list[int]]:
        """The ids of each text; null or empty gives none."""
        if self.chunks is None:
            return [list(self.viterbi(" " + t)) if t else [] for t in texts]
        parts = [self.chunks(" " + t) if t else [] for t in texts]
        if len(self.cache) > CACHE:
            self.cache.clear()
        cache = self.cache
        new = list({c for p in parts for c in p if c not in cache})
        short = [c for c in new if len(c) <= SHORT]
        if short:
            cache.update(zip(short, self.viterbi_many(short), strict=True))
        cache.update((c, self.viterbi(c)) for c in new if len(c) > SHORT)
        out = []
        for p in parts:
            ids: list[int] = []
            for c in p:
                ids.extend(cache[c])
            out.append(ids)
        return out

    def encode(self, text: str | None) -> list[int]:
        return self.encode_many([text])[0]

    def decode(self, ids: list[int]) -> str:
        """Byte pieces in a row are one UTF-8 string; ids without a text (control) say nothing."""
        texts, byte_of, multi = self.plain, self.byte_of, self.parts
        if multi.isdisjoint(ids):
            out = "".join([texts[i] for i in ids])
        else:
            parts, held = [], bytearray()
            for i in ids:
                if i in multi:
                    held.append(byte_of[i])
                    continue
                if held:
                    parts.append(held.decode("utf-8", "replace"))
                    held = bytearray()
                parts.append(texts[i])
            parts.append(held.decode("utf-8", "replace"))
            out = "".join(parts)
        return out[1:] if out.startswith(" ") else out


def share(spark: SparkSession, model: Unigram) -> Broadcast:
    return spark.sparkContext.broadcast(model)


def encode(model: Broadcast, text: Column) -> Column:
    """array<int> of piece ids; null or empty text gives an empty array."""

    def run(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = Codec.of(model)
        for a in arrays:
            found: list[list[int]] = []
            for at in range(0, len(a), 256):
                found.extend(codec.encode_many(a.slice(at, 256).to_pylist()))
            yield pa.array(found, pa.list_(pa.int32()))

    return F.arrow_udf(run, "array<int>")(text)


def decode(model: Broadcast, ids: Column) -> Column:
    """The text of an array of ids; null gives null."""

    def run(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = Codec.of(model)
        for a in arrays:
            yield pa.array([None if (x := i.as_py()) is None else codec.decode(x) for i in a], pa.string())

    return F.arrow_udf(run, "string")(ids)


def round_trips(docs: DataFrame, model: Broadcast, id_col: str = "doc_id", text_col: str = "text", step_chars: int = 1 << 20) -> DataFrame:
    """(id, n_ids, n_bytes, ids_crc32, ids, decoded_sha256, exact) of each row.

    ``n_bytes`` counts byte pieces; ``ids_crc32`` is that of the ids as little-endian
    unsigned 32-bit integers; ``exact`` says that decoding gives the text (null as
    empty) back.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, n_ids long, n_bytes long, ids_crc32 long, ids array<int>, decoded_sha256 string, exact boolean"
    names = [id_col, "n_ids", "n_bytes", "ids_crc32", "ids", "decoded_sha256", "exact"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.of(model)
        is_byte = np.zeros(len(codec.model.texts), dtype=bool)
        is_byte[list(codec.byte_of)] = True
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                flat, ends, nb, crc, sha, exact, chars, begin, texts = array("i"), [0], [], [], [], [], 0, at, []
                while at < batch.num_rows and chars < step_chars:
                    texts.append(batch.column(1)[at].as_py() or "")
                    chars += len(texts[-1])
                    at += 1
                for text, ids in zip(texts, codec.encode_many(texts), strict=True):
                    data = np.array(ids, dtype="<u4")
                    flat.frombytes(data.tobytes())
                    ends.append(len(flat))
                    nb.append(int(is_byte[data].sum()))
                    crc.append(zlib.crc32(data.tobytes()))
                    back = codec.decode(ids)
                    sha.append(hashlib.sha256(back.encode("utf-8")).hexdigest())
                    exact.append(back == text)
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(flat, dtype=np.int32) if len(flat) else np.zeros(0, np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(begin, at - begin),
                        pa.array(np.diff(ends), pa.int64()),
                        pa.array(nb, pa.int64()),
                        pa.array(crc, pa.int64()),
                        lists,
                        pa.array(sha, pa.string()),
                        pa.array(exact, pa.bool_()),
                    ],
                    names,
                )

    return docs.select(id_col, F.col(text_col).cast("string").alias("__text")).mapInArrow(run, schema)


def default_model() -> Unigram:
    import public_tokenizers

    return Unigram.load(public_tokenizers.path("piece_bpe_32k.model"))


@query("op5_sentencepiece")
def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trips(table(spark, sf_dir, "documents"), share(spark, default_model()))
