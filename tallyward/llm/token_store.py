"""Token-id output: raw id payloads in shards, found by a minimal perfect hash index.

Documents are range partitioned and sorted by id; each task encodes its documents
and writes one shard as it goes: a payload file of plain little-endian ids, and an
index file that maps each document key to its offset and length.  A key's place in
the index is its minimal perfect hash number; a stored 32-bit fingerprint and the
key's copy count turn away keys that are not there.  Access by key is one hash, one
index entry, one ranged read.  A manifest table (one row per shard) has the key
ranges and the number of ids before each shard.

Files are written under a name of their own for each attempt and then renamed, so
a task that is run again or twice leaves one whole shard.

Format.  ``<shard>.ids``: ids of all documents in order, 2 bytes each where the
vocabulary fits 65 536 ids, else 4.  ``<shard>.idx``: the hash function, then by
hash number: fingerprint u32, copies u32, first id u64, ids u64.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.llm.common import query, table
from tallyward.llm.perfect_hash import PerfectHash, mix
from tallyward.session import fresh_path

ENTRY = np.dtype([("print", "<u4"), ("copies", "<u4"), ("start", "<u8"), ("n", "<u8")])
END_ID = 1
MANIFEST = "folder string, shard string, first long, has_null boolean, last long, n_docs long, n_ids long, width int"


def place(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a shared folder, local or remote."""
    return pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def key_of(ids: np.ndarray, null: np.ndarray, copy: np.ndarray) -> np.ndarray:
    """A 64-bit key of (document id or null, copy number)."""
    plain = mix(ids.view(np.uint64), 11)
    base = np.where(null, np.uint64(0x5851F42D4C957F2D), plain)
    return np.where((copy == 0) & ~null, ids.view(np.uint64), mix(base + copy.astype(np.uint64), 13))


#: A letter and a mark behind it are never one piece of a word tokenizer that parts letters from marks.
MARK = re.compile(r"(?<=[A-Za-z])(?=[.,])")


class Encoder:
    """Encodes texts with the tokenizers library, each distinct word once.

    Where the tokenizer drops white space and parts letters from marks, the ids of a
    text are those of its words in a row; a bounded cache then saves most of the
    work and changes no result.  Other tokenizers encode whole texts.
    """

    #: Python workers serve many tasks; what the last one learned stays.
    _kept: tuple[bytes, Encoder] | None = None

    @classmethod
    def of(cls, blob: bytes) -> Encoder:
        mark = hashlib.sha256(blob).digest()
        if cls._kept is None or cls._kept[0] != mark:
            cls._kept = (mark, cls(blob))
        return cls._kept[1]

    def __init__(self, blob: bytes, cache: int = 700_000) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for each core already
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(blob.decode("utf-8"))
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        probe = "one two.\nThree, four  five's <x> 6.7"
        self.by_word = self._plain([probe])[0] == [i for w in self._words(probe) for i in self._plain([w])[0]]
        self.cache: dict[str, bytes] = {}
        self.most = cache

    def _plain(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    @staticmethod
    def _words(text: str) -> list[str]:
        return MARK.sub(" ", text.replace("\n", " ")).split(" ")

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if not self.by_word:
            return [np.array(x, dtype=np.uint32) for x in self._plain(texts)]
        parts = [self._words(t) for t in texts]
        if len(self.cache) > self.most:
            self.cache.clear()
        cache = self.cache
        new = list({w for p in parts for w in p if w not in cache})
        for at in range(0, len(new), 5000):
            part = new[at : at + 5000]
            cache.update((w, np.array(ids, dtype=np.uint32).tobytes()) for w, ids in zip(part, self._plain(part), strict=True))
        return [np.frombuffer(b"".join([cache[w] for w in p]), dtype=np.uint32) for p in parts]


class _Shard:
    """Writes one shard."""

    def __init__(self, folder: str, width: int) -> None:
        self.fs, self.folder = place(folder)
        self.uri, self.name, self.width = folder, f"shard-{uuid.uuid4().hex}", width
        self.file = self.fs.open_output_stream(f"{self.folder}/{self.name}.part")
        self.ids: list[np.ndarray] = []
        self.nulls: list[np.ndarray] = []
        self.lengths: list[np.ndarray] = []
        self.total = 0

    def add(self, ids: np.ndarray, null: np.ndarray, encoded: list[np.ndarray], end: int) -> None:
        last = np.array([end], dtype=np.uint32)
        flat = np.concatenate([x for e in encoded for x in (e, last)])
        self.file.write(flat.astype(f"<u{self.width}").tobytes())
        self.ids.append(ids)
        self.nulls.append(null)
        self.lengths.append(np.array([len(e) + 1 for e in encoded], dtype=np.int64))
        self.total += len(flat)

    def close(self) -> dict:
        self.file.close()
        ids, null, n = (np.concatenate(x) for x in (self.ids, self.nulls, self.lengths))
        # Rows of one id stand together; each is a copy with a number of its own.
        new = np.concatenate(([True], (ids[1:] != ids[:-1]) | (null[1:] != null[:-1])))
        first = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        copy = np.arange(len(ids)) - first[group]
        keys = key_of(ids, null, copy)
        tree = PerfectHash.build(keys)
        entries = np.zeros(len(ids), dtype=ENTRY)
        at = tree.find(keys)
        entries["print"][at] = (mix(keys, 17) >> np.uint64(32)).astype(np.uint32)
        entries["copies"][at] = np.diff(np.concatenate((first, [len(ids)])))[group]
        entries["start"][at] = np.concatenate(([0], np.cumsum(n)))[:-1]
        entries["n"][at] = n
        with self.fs.open_output_stream(f"{self.folder}/{self.name}.idx-part") as out:
            out.write(tree.dump())
            out.write(entries.tobytes())
        for old, new_name in ((".part", ".ids"), (".idx-part", ".idx")):
            self.fs.move(f"{self.folder}/{self.name}{old}", f"{self.folder}/{self.name}{new_name}")
        known = ids[~null]
        return {
            "folder": self.uri,
            "shard": self.name,
            "first": int(known[0]) if len(known) else None,
            "has_null": bool(null.any()),
            "last": int(known[-1]) if len(known) else None,
            "n_docs": len(ids),
            "n_ids": self.total,
            "width": self.width,
        }


def write_store(
    docs: DataFrame,
    tokenizer: bytes,
    folder: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = END_ID,
    shards: int | None = None,
    batch_chars: int = 500_000,
) -> DataFrame:
    """Encode every text and write it below ``folder``; returns the manifest, one row per shard.

    Null text counts as empty: its payload is the end id alone.  Null ids come first;
    rows that repeat an id are copies of it, ordered by their text.
    """
    spark = docs.sparkSession
    shared: Broadcast = spark.sparkContext.broadcast(tokenizer)
    model = json.loads(tokenizer)
    top = max([*model["model"]["vocab"].values(), *(t["id"] for t in model.get("added_tokens", [])), end_id])
    width = 2 if top < 65536 else 4
    fs, path = place(folder)
    fs.create_dir(path, recursive=True)
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    )
    n = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = rows.repartitionByRange(n, F.col("id").asc_nulls_first()).sortWithinPartitions(
        F.col("id").asc_nulls_first(), "text"
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard = Encoder.of(shared.value), None
        for batch in batches:
            column, texts = batch.column(0), batch.column(1)
            size = np.array(pc.utf8_length(texts))
            null = np.array(column.is_null())
            ids = column.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            at = 0
            while at < len(texts):  # few enough characters at a time
                stop, chars = at, 0
                while stop < len(texts) and (stop == at or chars + size[stop] <= batch_chars):
                    chars += size[stop]
                    stop += 1
                encoded = encoder.encode(texts.slice(at, stop - at).to_pylist())
                shard = shard or _Shard(folder, width)
                shard.add(ids[at:stop], null[at:stop], encoded, end_id)
                at = stop
        if shard:
            yield pa.RecordBatch.from_pylist([shard.close()], schema=_ARROW_MANIFEST)

    manifest = f"{folder.rstrip('/')}/manifest"
    parts.mapInArrow(write, MANIFEST).write.parquet(manifest)
    return spark.read.parquet(manifest)


_ARROW_MANIFEST = pa.schema(
    [
        ("folder", pa.string()),
        ("shard", pa.string()),
        ("first", pa.int64()),
        ("has_null", pa.bool_()),
        ("last", pa.int64()),
        ("n_docs", pa.int64()),
        ("n_ids", pa.int64()),
        ("width", pa.int32()),
    ]
)


class Reader:
    """Keyed access to one shard."""

    def __init__(self, folder: str, shard: str, width: int) -> None:
        fs, path = place(folder)
        with fs.open_input_file(f"{path}/{shard}.idx") as f:
            data = f.read()
        self.tree, at = PerfectHash.load(data)
        self.entries = np.frombuffer(data, ENTRY, self.tree.size, at)
        self.file, self.width = fs.open_input_file(f"{path}/{shard}.ids"), width

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Entry number of each key, -1 where the fingerprint says that it is not here."""
        at = self.tree.find(keys)
        prints = (mix(keys, 17) >> np.uint64(32)).astype(np.uint32)
        return np.where((at >= 0) & (self.entries["print"][at] == prints), at, -1)

    def ids(self, entry: int) -> np.ndarray:
        e = self.entries[entry]
        data = self.file.read_at(int(e["n"]) * self.width, int(e["start"]) * self.width)
        return np.frombuffer(data, f"<u{self.width}").astype("<u4")

    def close(self) -> None:
        self.file.close()


def read_store(keys: DataFrame, manifest: DataFrame, id_col: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) of each distinct key that the store holds, all its copies.

    Keys that are not stored give no row.
    """
    spark = keys.sparkSession
    # One row per shard: its size follows the number of files, not of documents.
    shards = sorted(
        (r.asDict() for r in manifest.collect()), key=lambda r: (not r["has_null"], r["first"] is not None, r["first"] or 0)
    )
    base = 0
    for s in shards:
        s["base"] = base
        base += s["n_ids"]
    known = [i for i, s in enumerate(shards) if s["first"] is not None]
    shared = spark.sparkContext.broadcast((shards, known, np.array([shards[i]["first"] for i in known], dtype=np.int64)))
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if with_ids else "")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every, where, firsts = shared.value
        reader, opened = None, -1
        for batch in batches:
            column = batch.column(0)
            null = np.array(column.is_null())
            ids = column.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            found: list[tuple] = []
            at = np.searchsorted(firsts, ids, side="right") - 1
            home = np.array([where[a] if a >= 0 else -1 for a in at], dtype=np.int64)
            home[null] = 0 if every and every[0]["has_null"] else -1
            for shard in np.unique(home[home >= 0]):
                here = np.flatnonzero(home == shard)
                if shard != opened:
                    if reader:
                        reader.close()
                    s = every[shard]
                    reader, opened = Reader(s["folder"], s["shard"], s["width"]), shard
                entry = reader.find(key_of(ids[here], null[here], np.zeros(len(here), dtype=np.int64)))
                for i, e in zip(here[entry >= 0], entry[entry >= 0], strict=True):
                    copies = int(reader.entries["copies"][e])
                    if copies > 1:
                        more = key_of(np.full(copies, ids[i]), np.full(copies, null[i]), np.arange(copies))
                        all_at = reader.find(more)
                    else:
                        all_at = [e]
                    for a in all_at:
                        payload = reader.ids(a)
                        row = (
                            None if null[i] else int(ids[i]),
                            every[shard]["base"] + int(reader.entries["start"][a]),
                            len(payload),
                            zlib.crc32(payload.tobytes()),
                        )
                        found.append((*row, payload.tolist()) if with_ids else row)
            names = ["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: 4 + with_ids]
            kinds = [pa.int64()] * 4 + [pa.list_(pa.int32())] * with_ids
            cols = list(zip(*found, strict=True)) if found else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)
        if reader:
            reader.close()

    wanted = keys.select(F.col(id_col).cast("long").alias("doc_id")).distinct()
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return wanted.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id").mapInArrow(read, schema)


@query("op10_token_store")
def op10_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    with open(public_tokenizers.path("word_bpe_49k.json"), "rb") as f:
        blob = f.read()
    manifest = write_store(docs, blob, fresh_path(spark, "tokens"))
    return read_store(docs.select("doc_id"), manifest)
