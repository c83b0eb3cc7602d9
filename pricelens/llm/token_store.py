"""Token-id files: documents in ascending id order, range-coded in checksummed blocks.

A file is one binary value (``content``) of a Parquet table, so that any file system Spark writes to can
hold it and a file appears only when its task commits.  Layout, little-endian:

    magic, sizes (documents, ids, block length, entries of the order-0 table), four lengths
    zlib: document ids, null flags and id counts; zlib: order-0 ids and frequencies
    zlib: byte length and crc32 (over the ids as uint32) of each block; the blocks

Blocks are reset independently: each can be decoded with the order-0 table alone.
"""

from __future__ import annotations

import json
import os
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pricelens.llm.arrays import released
from pricelens.llm.range_coder import ZeroOrder, decode_files, encode_files
from pricelens.llm.textbatch import byte_slices
from pricelens.llm.token_counts import counter
from pricelens.llm.transducer import pretoken_spans

MAGIC = b"PLTOKEN1"
BLOCK = 4096
FILE_TOKENS = 1 << 21
PARTITION_BYTES = 32 << 20
SLICE_BYTES = 1 << 19    # of texts that are split at once; the arrays for more leave the processor's cache
SPLIT_BYTES = 32 << 20   # of texts whose distinct pre-tokens are encoded together
LANE_IDS = 8 << 20      # ids of the files that are coded side by side
END_ID = 2


@dataclass
class Split:
    """A slice of texts as pre-tokens."""

    words: pa.DictionaryArray
    per: np.ndarray                  # pre-tokens of each text
    odd: dict[int, np.ndarray]       # ids of the texts that are not split


class TokenEncoder:
    """Ids of whole texts: the library encodes each distinct pre-token once, texts are put together from those.

    Pre-tokens are compared by their bytes.  They are normalised already, so they go to a copy of the
    tokenizer without its normaliser: normalising twice may reorder combining marks.
    """

    MAX_HELD = 1 << 20       # distinct pre-tokens, counted in each slice, that are held for one call
    MAX_KNOWN = 1 << 18      # that are kept between calls, those met last

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        spec["normalizer"] = None
        self.plain = Tokenizer.from_str(json.dumps(spec))
        self.plain.encode_special_tokens = True
        self.machine = counter(path)
        vocab = self.library.get_vocab()
        self.final = np.zeros(max(vocab.values()) + 1, bool)
        self.final[[k for word, k in vocab.items() if word.endswith("</w>")]] = True
        # known pre-tokens, how many ids each has, all their ids, and the call that met each last
        self.known = pa.array([], pa.large_binary())
        self.size, self.pool, self.met = np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int64)
        self.calls = 0

    def _ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pre-tokens in order, and where each one's end; its last id is the one that ends a word."""
        texts = [" ".join(words[i:i + 1000]) for i in range(0, len(words), 1000)]
        ids = np.concatenate([np.array(e.ids, np.int32) for e in
                              self.plain.encode_batch_fast(texts, add_special_tokens=False)])
        ends = np.flatnonzero(self.final[ids]) + 1
        if len(ends) == len(words) and ends[-1] == len(ids):
            return ids, ends
        own = [np.array(self.plain.encode(w, add_special_tokens=False).ids, np.int32) for w in words]
        return np.concatenate(own), np.cumsum([len(x) for x in own])

    def split(self, texts: list[str]) -> Split:
        """The pre-tokens of a slice of texts; those with special strings go to the library whole."""
        odd = {i: np.array(self.library.encode(t, add_special_tokens=False).ids, np.int32)
               for i, t in enumerate(texts) if "<|" in t and self.machine.special.search(t)}
        plain = ["" if i in odd else t for i, t in enumerate(texts)] if odd else texts
        data, starts, ends, owner, _ = self.machine.pretokens(plain, pretoken_spans)
        edges = np.zeros(2 * len(starts) + 1, np.int64)        # pre-tokens and what lies between them, in turn
        edges[:-1:2], edges[1::2] = starts, ends
        edges[-1] = len(data)
        pieces = pa.Array.from_buffers(pa.large_binary(), len(edges) - 1, [None, pa.py_buffer(edges), pa.py_buffer(data)])
        words = pieces.take(pa.array(np.arange(0, len(edges) - 1, 2)))
        return Split(words.dictionary_encode(), np.bincount(owner, minlength=len(texts)), odd)

    def encode_splits(self, splits: list[Split], end_id: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each slice all ids, each text's followed by ``end_id``, and the number of ids of each text."""
        # the unified dictionary begins with that of the first chunk, which is the known pre-tokens
        known = pa.DictionaryArray.from_arrays(pa.array([], pa.int32()), self.known)
        chunks = pa.chunked_array([known, *(s.words for s in splits)]).unify_dictionaries().chunks[1:]
        words = chunks[0].dictionary
        new = words.slice(len(self.known)).to_numpy(zero_copy_only=False).tolist()
        if new:
            ids, ends = self._ids([w.decode("utf-8", "surrogatepass") for w in new])
            self.size = np.concatenate([self.size, np.diff(ends, prepend=0)])
            self.pool = np.concatenate([self.pool, ids])
        at = np.cumsum(self.size) - self.size
        entries = [chunk.indices.to_numpy() for chunk in chunks]
        out = [self._joined(s, self.pool, at, self.size, entry, end_id) for s, entry in zip(splits, entries, strict=True)]
        self._keep(words, at, entries)
        return out

    def _keep(self, words: pa.Array, at: np.ndarray, entries: list[np.ndarray]) -> None:
        """``words`` are known from now on, or those met last where they are too many."""
        self.calls += 1
        self.met = np.concatenate([self.met, np.zeros(len(words) - len(self.met), np.int64)])
        for entry in entries:
            self.met[entry] = self.calls
        self.known = words
        if len(words) > self.MAX_KNOWN:
            kept = np.sort(np.argsort(-self.met, kind="stable")[:self.MAX_KNOWN])
            own = self.size[kept]
            self.pool = self.pool[np.repeat(at[kept] - (np.cumsum(own) - own), own) + np.arange(own.sum())]
            self.known, self.size, self.met = words.take(pa.array(kept)), own, self.met[kept]

    @staticmethod
    def _joined(split: Split, pool: np.ndarray, at: np.ndarray, size: np.ndarray, entry: np.ndarray, end_id: int
                ) -> tuple[np.ndarray, np.ndarray]:
        """A slice's ids from those of its pre-tokens."""
        own = size[entry]
        ends = np.cumsum(own)
        total = int(ends[-1]) if len(ends) else 0
        ids = pool[np.repeat(at[entry] - (ends - own), own) + np.arange(total)]
        bounds = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(split.per)))]
        counts = np.diff(bounds)
        if split.odd:
            pieces, done = [], 0
            for i, got in split.odd.items():
                pieces += [ids[bounds[done]:bounds[i]], got]
                counts[i], done = len(got), i
            ids = np.concatenate([*pieces, ids[bounds[done]:]])
        counts += 1
        out = np.full(len(ids) + len(counts), end_id, np.int32)
        keep = np.ones(len(out), bool)
        keep[np.cumsum(counts) - 1] = False
        out[keep] = ids
        return out, counts

    def encode(self, texts: list[str], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids, each text's followed by ``end_id``, and the number of ids of each text."""
        return self.encode_splits([self.split(texts)], end_id)[0]


@lru_cache(maxsize=2)
def encoder(path: str) -> TokenEncoder:
    return TokenEncoder(path)


@dataclass
class Tokens:
    """What a file holds: documents in order with their ids."""

    doc_ids: np.ndarray
    null: np.ndarray
    counts: np.ndarray
    tokens: np.ndarray


def pack_files(files: list[Tokens], block: int = BLOCK) -> Iterator[bytes]:
    """The content of each file; all are coded side by side."""
    zeros = [ZeroOrder.of(f.tokens) for f in files]
    coded = encode_files([(f.tokens, zero) for f, zero in zip(files, zeros, strict=True)], block)
    for f, zero, blocks in zip(files, zeros, coded, strict=True):
        raw = f.tokens.astype("<u4")
        sums = [zlib.crc32(raw[i:i + block].tobytes()) for i in range(0, len(raw), block)]
        parts = [zlib.compress(f.doc_ids.astype("<i8").tobytes() + f.null.astype("u1").tobytes() + f.counts.astype("<i8").tobytes()),
                 zlib.compress(zero.ids.astype("<u4").tobytes() + zero.freq.astype("<u4").tobytes()),
                 zlib.compress(np.array([len(b) for b in blocks], "<u4").tobytes() + np.array(sums, "<u4").tobytes()),
                 b"".join(blocks)]
        head = struct.pack("<8q", len(f.doc_ids), len(raw), block, len(zero.ids), *map(len, parts))
        yield MAGIC + head + struct.pack("<I", zlib.crc32(head)) + b"".join(parts)


def pack_file(doc_ids: np.ndarray, null: np.ndarray, counts: np.ndarray, tokens: np.ndarray, block: int = BLOCK) -> bytes:
    """One file: documents in order with their ids."""
    return next(pack_files([Tokens(doc_ids, null, counts, tokens)], block))


def _parts(content: bytes) -> tuple[list[int], list[bytes]]:
    """Documents, ids, block length and order-0 entries of a file, and its four parts."""
    head = content[8:72]
    if content[:8] != MAGIC or struct.unpack("<I", content[72:76])[0] != zlib.crc32(head):
        raise ValueError("not a token file, or its header is damaged")
    numbers = struct.unpack("<8q", head)
    parts, at = [], 76
    for size in numbers[4:]:
        parts.append(content[at:at + size])
        at += size
    return list(numbers[:4]), parts


def unpack_files(contents: list[bytes]) -> Iterator[Tokens]:
    """Documents and ids of the files, in order; raises if any checksum fails.

    Files with blocks of one length are decoded side by side, up to ``LANE_IDS`` ids of them or one larger file.
    """
    held, n_ids, length = [], 0, None
    for content in contents:
        numbers, parts = _parts(content)
        if held and (numbers[2] != length or n_ids + numbers[1] > LANE_IDS):
            yield from _decoded(held)
            held, n_ids = [], 0
        held.append((numbers, parts))
        n_ids, length = n_ids + numbers[1], numbers[2]
    if held:
        yield from _decoded(held)


def _decoded(files: list[tuple[list[int], list[bytes]]]) -> Iterator[Tokens]:
    coded, all_sums, block = [], [], files[0][0][2]
    for (_, n, _, entries), parts in files:
        table = np.frombuffer(zlib.decompress(parts[1]), "<u4")
        lengths, sums = np.frombuffer(zlib.decompress(parts[2]), "<u4").reshape(2, -1)
        ends = np.cumsum(lengths.astype(np.int64)).tolist()
        coded.append(([parts[3][a:b] for a, b in zip([0, *ends][:-1], ends, strict=True)], n, ZeroOrder(table[:entries], table[entries:])))
        all_sums.append(sums.tolist())
    decoded = decode_files(coded, block)
    del coded
    for k, (((docs, *_), parts), sums) in enumerate(zip(files, all_sums, strict=True)):
        tokens, decoded[k] = decoded[k], None
        raw = tokens.astype("<u4")
        for i, want in enumerate(sums):
            if zlib.crc32(raw[i * block:(i + 1) * block].tobytes()) != want:
                raise ValueError(f"block {i} does not match its checksum")
        index = zlib.decompress(parts[0])
        yield Tokens(np.frombuffer(index, "<i8", docs), np.frombuffer(index, "u1", docs, 8 * docs) > 0,
                     np.frombuffer(index, "<i8", docs, 9 * docs), tokens)


def unpack_file(content: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Document ids, null flags, id counts and all ids of a file; raises if any checksum fails."""
    f = next(unpack_files([content]))
    return f.doc_ids, f.null, f.counts, f.tokens


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                      end_id: int = END_ID, file_tokens: int = FILE_TOKENS, block: int = BLOCK) -> None:
    """Encode every whole text and write files in ascending order of the integer id (null ids first).

    Documents are range-partitioned by id, so files are in order across tasks and in each task.  Null
    and empty texts have the end id alone; repeated rows are all written; a file holds whole documents
    up to ``file_tokens`` ids (or one longer document).  Other columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = max(1, -(-total // PARTITION_BYTES))
    if parts > 1:
        parts = max(parts, min(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * parts))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, part, seq = encoder(tokenizer_path), TaskContext.get().partitionId(), 0
        splits: list[tuple[pa.Array, Split]] = []
        slices: list[Tokens] = []                                # of the file to come
        files: list[Tokens] = []
        text_bytes = words = held = ready = 0

        def whole() -> Tokens:
            joined = [np.concatenate(x) for x in zip(*((s.doc_ids, s.null, s.counts, s.tokens) for s in slices), strict=True)]
            slices.clear()
            return Tokens(*joined)

        def packed() -> Iterator[pa.RecordBatch]:
            nonlocal seq
            sizes = [len(f.tokens) for f in files]
            for n, content in zip(sizes, pack_files(files, block), strict=True):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f"{part:07d}-{seq:05d}"]), pa.array([n], pa.int64()), pa.array([content], pa.binary())],
                    names=["name", "n_tokens", "content"])
                seq += 1
            files.clear()

        def encoded() -> Iterator[pa.RecordBatch]:
            nonlocal held, ready
            coded = machine.encode_splits([x for _, x in splits], end_id)[::-1]
            for key, _ in splits:
                own, sizes = coded.pop()
                if held and held + len(own) > file_tokens:
                    if files and ready + held > LANE_IDS:
                        yield from packed()
                        ready = 0
                    files.append(whole())
                    held, ready = 0, ready + held
                slices.append(Tokens(key.fill_null(0).to_numpy(zero_copy_only=False), key.is_null().to_numpy(zero_copy_only=False),
                                     sizes, own))
                held += len(own)
            splits.clear()

        for batch in batches:
            key, text = batch.column(0), batch.column(1)
            for i, j, data, _ in byte_slices(text, SLICE_BYTES):
                split = machine.split([t or "" for t in text.slice(i, j - i).to_pylist()])
                if splits and (text_bytes + len(data) > SPLIT_BYTES or words + len(split.words.dictionary) > machine.MAX_HELD):
                    yield from encoded()
                    text_bytes = words = 0
                splits.append((key.slice(i, j - i), split))
                text_bytes, words = text_bytes + len(data), words + len(split.words.dictionary)
        if splits:
            yield from encoded()
        if held:
            files.append(whole())
            yield from packed()

    ordered = rows.repartitionByRange(parts, F.col("id").asc_nulls_first()).sortWithinPartitions(F.col("id").asc_nulls_first())
    ordered.mapInArrow(released(encode), "name string, n_tokens long, content binary").write.parquet(path)


def read_token_files(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """One row per document of the files: ``doc_id, start, n_tokens, ids_crc32`` (and ``ids``, uint32 binary).

    ``start`` counts the ids of all documents before it, over all files.
    """
    files = spark.read.schema("name string, n_tokens long, content binary").parquet(path)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            unpacked = unpack_files([c.as_py() for c in batch.column(1)])
            for name, f in zip(batch.column(0).to_pylist(), unpacked, strict=True):
                raw, ends = f.tokens.astype("<u4").tobytes(), np.cumsum(f.counts)
                spans = [raw[4 * a:4 * b] for a, b in zip((ends - f.counts).tolist(), ends.tolist(), strict=True)]
                columns = [pa.array([name] * len(ends)), pa.array(f.doc_ids, mask=f.null), pa.array(ends - f.counts),
                           pa.array(f.counts), pa.array([zlib.crc32(s) for s in spans], pa.int64())]
                names = ["name", "doc_id", "offset", "n_tokens", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array(spans, pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    docs = files.select("name", "content").mapInArrow(released(decode), "name string, doc_id long, offset long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids)
    # one row a file: its place among all ids
    before = Window.orderBy("name").rowsBetween(Window.unboundedPreceding, -1)
    places = files.select("name", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base"))
    return docs.join(places, "name").select(
        "doc_id", (F.col("base") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids)
