"""Token ids in packed files: one zstandard frame a document, a seek table at the end.

A file is a valid zstandard stream in the public seekable layout: independent frames,
one skippable frame with the document ids, then a skippable frame with the compressed
size, the size and the checksum (low half of XXH64) of every frame. A reader fetches
the tail, and then only the frames of the documents it wants.

Ids are little-endian unsigned integers of 2 bytes where the vocabulary allows it, else 4.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from namewire.llm.base import released, stored, table
from namewire.llm.words import slices
from namewire.session import scratch_path

SEEK_MAGIC, TABLE_FRAME, IDS_FRAME = 0x8F92EAB1, 0x184D2A5E, 0x184D2A50
CHECKSUMS = 0x80  # descriptor bit: entries carry checksums
CACHED_WORDS = 300_000
ENCODED_BYTES = 1 << 22  # of texts at a time
SPACE, WORD = np.zeros(256, bool), np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
WORD[[*range(48, 58), *range(97, 123)]] = True
# a word of a-z and letters of Latin-1, perhaps with a full stop or comma
PLAIN = re.compile(rb"((?:[a-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+)([.,]?)")


def open_folder(uri: str) -> tuple[pa.fs.FileSystem, str]:
    """The file system of a folder that all executors share, and the folder in it."""
    if uri.startswith("file:"):
        uri = uri[len("file:"):]
        return pa.fs.LocalFileSystem(), "/" + uri.lstrip("/")
    if "://" not in uri:
        return pa.fs.LocalFileSystem(), uri
    return pa.fs.FileSystem.from_uri(uri)


def word_encoder(path: str, width: int = 2) -> Callable[[list[bytes]], list[bytes]]:
    """Encodes texts with a word BPE that lower-cases and drops white space; ids come as bytes.

    Each piece between white space is encoded once and kept, up to ``CACHED_WORDS``
    pieces; the ids of a text are those of its pieces, as an ``encode`` of the whole text
    gives them. New words of plain letters go to the tokenizer together, and are cut
    apart where a token ends a word; a full stop or comma after a word is a word of its own.
    Texts are UTF-8. A text in which a special token may stand is encoded as it is.
    """
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks are the parallelism
    from tokenizers import Tokenizer, pre_tokenizers

    tokenizer = Tokenizer.from_file(path)
    # words of a-z alone, lower-cased: its normalizer and its pattern leave them as they are
    letters = Tokenizer(tokenizer.model)
    letters.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    size = tokenizer.get_vocab_size()
    if size > 1 << 8 * width:
        raise ValueError(f"ids of {path} need more than {width} bytes")
    kind = f"<u{width}"
    closing = np.array([(tokenizer.id_to_token(k) or "").endswith("</w>") for k in range(size)])
    cache: dict[bytes, int] = {}  # of one task: over tasks it saves nothing, as most words that are looked up are common
    known: list[bytes] = []

    def ids_of(pieces: list[str]) -> list[bytes]:
        return [np.array(e.ids, kind).tobytes() for e in tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]

    def keep(words: list[bytes], ids: list[bytes]) -> None:
        cache.update(zip(words, range(len(known), len(known) + len(words))))
        known.extend(ids)

    marks = dict(zip((b"", b".", b","), ids_of(["", ".", ","])))

    def learn(new: list[bytes]) -> None:
        found = {w: PLAIN.fullmatch(w) for w in new if not w.isalpha()}
        stems = {m[1] for m in found.values() if m}.union(filter(bytes.isalpha, new)) - cache.keys()
        plain = list(filter(bytes.isalpha, stems))  # a-z only: most of them
        stems = list(stems.difference(plain))
        for words, by in ((plain, letters), (stems, tokenizer)):
            for low in range(0, len(words), 4096):
                part = words[low: low + 4096]
                ids = np.array(by.encode_batch_fast([b" ".join(part).decode()], add_special_tokens=False)[0].ids, kind)
                ends = ((np.flatnonzero(closing[ids]) + 1) * width).tolist()
                if len(ends) == len(part):
                    raw = ids.tobytes()
                    keep(part, [raw[i:j] for i, j in zip([0, *ends], ends)])
                else:
                    keep(part, ids_of([w.decode() for w in part]))
        ended = [(w, m) for w, m in found.items() if m and m[2]]
        keep([w for w, _ in ended], [known[cache[m[1]]] + marks[m[2]] for _, m in ended])
        others = [w for w, m in found.items() if not m]
        keep(others, ids_of([w.decode() for w in others]))

    def encode_part(texts: list[bytes]) -> list[bytes]:
        """Words are found on the bytes of all texts, and each different one is looked up once."""
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        edges = np.r_[0, np.cumsum(lengths)]
        data = np.frombuffer(b"".join(texts).lower(), np.uint8)
        inside = ~SPACE[data]
        starts, ends = word_edges(data, inside, edges)
        cuts = np.r_[0, np.cumsum(ends - starts)].astype(np.int32)
        column = pa.Array.from_buffers(
            pa.binary(), len(starts), [None, pa.py_buffer(cuts), pa.py_buffer(data[inside])]).dictionary_encode()
        words = column.dictionary.to_pylist()
        new = [w for w in words if w not in cache]
        if len(cache) + len(new) > CACHED_WORDS:
            kept = [(w, known[cache[w]]) for w in words if w in cache]
            cache.clear()
            known.clear()
            keep([w for w, _ in kept], [ids for _, ids in kept])
        learn(new)
        ids = [known[cache[w]] for w in words]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // width
        flat, begin = np.frombuffer(b"".join(ids), kind), np.cumsum(sizes) - sizes
        words = column.indices.to_numpy()
        sizes, begin = sizes[words], begin[words]
        after = np.r_[0, np.cumsum(sizes)]
        out = flat[np.repeat(begin - after[:-1], sizes) + np.arange(after[-1])].tobytes()
        at = (after[np.searchsorted(starts, edges)] * width).tolist()
        return [out[i:j] for i, j in zip(at, at[1:])]

    def encode(texts: list[bytes]) -> list[bytes]:
        plain = iter(encode_part([t for t in texts if b"<|" not in t]))
        return [ids_of([t.decode()])[0] if b"<|" in t else next(plain) for t in texts]

    return encode


def word_edges(data: np.ndarray, inside: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of lower-cased texts that lie between ``edges``; ``inside`` is where no white space is.

    A full stop or comma before white space or the end is a word of its own after a-z, a digit or a
    letter of Latin-1, as the tokenizer takes it; after others it may be one symbol with them.
    """
    before, after = np.r_[False, inside[:-1]][: len(data)], np.r_[inside[1:], False][: len(data)]
    begin = np.zeros(len(data) + 1, bool)  # a word that is here starts here, whatever is before it
    begin[edges] = True
    at = np.flatnonzero(((data == 46) | (data == 44)) & (~after | begin[1:]))
    at = at[at > 1]
    one, two = data[at - 1], data[at - 2]
    alone = WORD[one] | ((two == 0xC3) & (one >= 0x80) & (one <= 0xBF) & (one != 0x97) & (one != 0xB7))
    begin[at[alone]] = True
    return np.flatnonzero(inside & (~before | begin[:-1])), np.flatnonzero(inside & (~after | begin[1:])) + 1


def write_file(file: pa.NativeFile, documents: Iterator[tuple[int | None, bytes]]) -> tuple[int, int]:
    """Write frames, ids and the seek table; returns the number of documents and of bytes of ids."""
    compress = zstandard.ZstdCompressor(level=1).compress
    entries, ids, total = [], [], 0
    for doc_id, raw in documents:
        frame = compress(raw)
        file.write(frame)
        entries.append(struct.pack("<III", len(frame), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        ids.append(struct.pack("<?q", doc_id is not None, doc_id or 0))
        total += len(raw)
    named = b"".join(ids)
    file.write(struct.pack("<II", IDS_FRAME, len(named)) + named)
    seek = b"".join(entries) + struct.pack("<IBI", len(entries), CHECKSUMS, SEEK_MAGIC)
    file.write(struct.pack("<II", TABLE_FRAME, len(seek)) + seek)
    return len(entries), total


class Reader:
    """Random access to the documents of a packed file."""

    def __init__(self, file: pa.NativeFile, width: int):
        self.file, self.width = file, width
        end = file.size()
        file.seek(end - 9)
        count, flags, magic = struct.unpack("<IBI", file.read(9))
        if magic != SEEK_MAGIC or flags != CHECKSUMS:
            raise ValueError("not a packed file")
        start = end - 9 - 12 * count
        file.seek(start - 8)
        if struct.unpack("<II", file.read(8)) != (TABLE_FRAME, 12 * count + 9):
            raise ValueError("broken seek table")
        self.entries = np.frombuffer(file.read(12 * count), "<u4").reshape(count, 3).astype(np.int64)
        self.offsets = np.r_[0, np.cumsum(self.entries[:, 0])]
        file.seek(int(self.offsets[-1]))
        if struct.unpack("<II", file.read(8)) != (IDS_FRAME, 9 * count):
            raise ValueError("broken id table")
        self.doc_ids = [i if known else None for known, i in struct.iter_unpack("<?q", file.read(9 * count))]
        self.decompressor = zstandard.ZstdDecompressor()

    def tokens(self, k: int) -> np.ndarray:
        """Ids of the k-th document; only its frame is read."""
        packed, size, checksum = map(int, self.entries[k])
        self.file.seek(int(self.offsets[k]))
        raw = self.decompressor.decompress(self.file.read(packed), max_output_size=max(size, 1))
        if len(raw) != size or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != checksum:
            raise ValueError(f"document {self.doc_ids[k]} is damaged")
        return np.frombuffer(raw, f"<u{self.width}")


def _encode(path: str, end_id: int, width: int, cuts: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, edges = word_encoder(path, width), np.array(cuts, np.int64)
        end = np.array([end_id], f"<u{width}").tobytes()
        for batch in batches:
            column = batch.column("text").cast(pa.binary())
            # the number of cuts below an id; rows without an id come before all others
            known = batch.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
            shards = np.searchsorted(edges, batch.column("doc_id").fill_null(0).to_numpy()) * known
            offsets = np.r_[0, np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))]
            for low, high in slices(offsets, ENCODED_BYTES):
                part = [ids + end for ids in encode([t or b"" for t in column.slice(low, high - low).to_pylist()])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(low, high - low), pa.array(shards[low:high], pa.int32()),
                     pa.array(part, pa.binary())], names=["doc_id", "shard", "ids"])
    return run


def _write(folder: str, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = open_folder(folder)
        rows = ((s, i, ids) for b in batches
                for s, i, ids in zip(*(b.column(c).to_pylist() for c in ("shard", "doc_id", "ids"))))
        row = next(rows, None)
        while row is not None:
            shard = row[0]

            def of_shard():
                nonlocal row
                while row is not None and row[0] == shard:
                    yield row[1:]
                    row = next(rows, None)

            name = f"{root}/shard-{shard:06d}.zst"
            attempt = f"{root}/.{uuid.uuid4().hex}"  # a repeated task replaces the file as a whole
            with system.open_output_stream(attempt) as file:
                count, size = write_file(file, of_shard())
            system.move(attempt, name)
            yield pa.RecordBatch.from_pydict(
                {"shard": [shard], "file": [name], "documents": [count], "tokens": [size // width]},
                schema=pa.schema([("shard", pa.int32()), ("file", pa.string()), ("documents", pa.int64()),
                                  ("tokens", pa.int64())]))
    return run


def _read(folder: str, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = open_folder(folder)
        for batch in batches:
            for name, first in zip(batch.column("file").to_pylist(), batch.column("first").to_pylist()):
                with system.open_input_file(name) as file:
                    reader = Reader(file, width)
                    counts, sums = [], []
                    for k in range(len(reader.doc_ids)):
                        ids = reader.tokens(k)
                        counts.append(len(ids))
                        sums.append(zlib.crc32(ids.astype("<u4").tobytes()))
                starts = first + np.r_[0, np.cumsum(counts, dtype=np.int64)][:-1]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(reader.doc_ids, pa.int64()), "start": pa.array(starts, pa.int64()),
                    "n_tokens": pa.array(counts, pa.int64()), "ids_crc32": pa.array(sums, pa.int64())})
    return run


def pack_tokens(
    documents: DataFrame, tokenizer_path: str, folder: str, end_id: int = 1, width: int = 2,
    id_column: str = "doc_id", text_column: str = "text", rows_per_file: int = 4096, max_files: int = 20_000,
) -> DataFrame:
    """Encode every text, append ``end_id``, and write the ids in ascending order of ``id_column``.

    ``folder`` must be reachable from all executors. Files are cut at quantiles of the
    ids, so texts move once, encoded, and no task holds more than its file. Returns one
    row a file: ``shard``, ``file``, ``documents``, ``tokens``, and ``first``, the number
    of ids in the files before it. A null text is empty; rows without an id come first;
    rows that repeat an id are all written, in the order of their ids' bytes. An empty
    table writes nothing.
    """
    plain = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    count = plain.count()
    files = max(1, min(max_files, -(-count // rows_per_file)))
    cuts = []
    if files > 1:
        shares = [k / files for k in range(1, files)]
        cuts = sorted(set(plain.select(F.percentile_approx("doc_id", shares, 100 * files).alias("c")).first().c or []))
    system, root = open_folder(folder)
    system.create_dir(root, recursive=True)
    encoded = plain.mapInArrow(
        released(_encode(tokenizer_path, end_id, width, cuts)), "doc_id long, shard int, ids binary")
    # the shard's number is the partition's: a task has one file
    ordered = encoded.repartitionById(len(cuts) + 1, "shard").sortWithinPartitions("shard", F.asc_nulls_first("doc_id"), "ids")
    manifest = stored(ordered.mapInArrow(
        released(_write(folder, width)), "shard int, file string, documents long, tokens long"), "manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("first", F.coalesce(F.sum("tokens").over(before), F.lit(0)))


def read_back(manifest: DataFrame, folder: str, width: int = 2) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens``, ``ids_crc32`` of every document, read from the files."""
    count = max(1, manifest.count())
    files = manifest.repartitionById(count, (F.col("shard") % count).cast("int")).select("file", "first")
    return files.mapInArrow(released(_read(folder, width)), "doc_id long, start long, n_tokens long, ids_crc32 long")


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the file system that Spark takes it to be in."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString()


def pack_and_read(documents: DataFrame) -> DataFrame:
    import public_tokenizers

    folder = qualified(documents.sparkSession, scratch_path(documents.sparkSession, "tokens"))
    manifest = stored(pack_tokens(documents, public_tokenizers.path("word_bpe_49k.json"), folder), "shards")
    return read_back(manifest, folder)


def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack_and_read(table(spark, folder, "documents"))
