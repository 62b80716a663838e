"""Token ids as flat files of unsigned integers, with 64-bit offsets of the documents.

A part holds the ids of a range of documents, in order of ``doc_id``. Beside its ``.bin`` file lie
``.off``, where each document begins in the part (one more entry than documents), ``.doc``, the
documents' ids, and ``.nil``, a byte per document that says whether it has none. The manifest, a
Parquet table, names the parts and what comes before each: prefix sums over the parts, so that a
place in the whole corpus is the part's base plus the place in the part.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain
from urllib.parse import urlsplit

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clinflow.session import work_dir

PART = "part int, file string, n_docs long, n_tokens long"
READ = "doc_id long, start long, n_tokens long, ids_crc32 long"
#: Bytes of texts that a task encodes together, each different word once; a longer text is alone.
CHUNK_BYTES = 24 * 1024 * 1024
#: Words that the tokenizer gets at a time.
TOGETHER = 50_000
#: Bytes of text to a part.
PART_BYTES = 48 * 1024 * 1024


@dataclass(frozen=True)
class Encoding:
    """``path``: a file of the tokenizers library, present on every machine. ``end``: the id put
    after each document."""

    path: str
    end: int = 0


class Encoder:
    """Ids of many texts at once: each different word of them is encoded once.

    The pre-tokenizer takes white space only at the start of a token, so that a cut between a visible
    character and white space after it separates tokens. Words with the space before them can
    therefore be encoded in rows, and the bytes of the tokens tell which belong to which word. Texts
    with other white space before a space, or a space at the end, are cut and encoded piece by piece.
    """

    cut = re.compile(r"(?<=\S)(?=\s)")
    #: White space by anyone's definition before a space, or a space at the end.
    odd = (
        "[\\s\\v\\x{1c}-\\x{1f}\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}"
        "\\x{202f}\\x{205f}\\x{3000}] | $"
    )

    def __init__(self, encoding: Encoding) -> None:
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokenizer = Tokenizer.from_file(encoding.path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.end = encoding.end
        size = self.tokenizer.get_vocab_size()
        self.dtype = np.dtype("<u2" if max(size, encoding.end + 1) <= 1 << 16 else "<u4")
        self.known = pa.array([], pa.large_string()), np.empty(0, self.dtype), np.empty(0, np.int64)
        self.length = np.zeros(size, np.int64)
        for token, i in self.tokenizer.get_vocab().items():
            self.length[i] = len(token)  # of a byte-level vocabulary, whose characters are bytes

    def each(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces in a row, and how many each has."""
        flat, sizes = [np.empty(0, self.dtype)], []
        for at in range(0, len(pieces), TOGETHER):
            found = [e.ids for e in self.tokenizer.encode_batch_fast(pieces[at : at + TOGETHER], add_special_tokens=False)]
            flat.append(np.fromiter(chain.from_iterable(found), self.dtype))
            sizes.extend(map(len, found))
        return np.concatenate(flat), np.array(sizes, np.int64)

    def words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The same for different words, each with a space before it. Those that the texts before had
        as well are not encoded again; of older ones nothing is kept."""
        old_words, old_flat, old_sizes = self.known
        at = pc.index_in(words, value_set=old_words)
        fresh = at.is_null()
        flat, sizes = self.spaced(words.filter(fresh))
        place = pc.fill_null(at, -1).to_numpy(zero_copy_only=False).astype(np.int64)
        is_new = fresh.to_numpy(zero_copy_only=False)
        place[is_new] = len(old_words) + np.arange(int(is_new.sum()))
        flat, sizes = np.concatenate((old_flat, flat)), np.concatenate((old_sizes, sizes))
        n = sizes[place]
        starts = (np.cumsum(sizes) - sizes)[place]
        flat = flat[np.arange(n.sum()) + np.repeat(starts - np.cumsum(n) + n, n)]
        self.known = words, flat, n
        return flat, n

    def spaced(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Words with a space before them, many in a row; the bytes of the tokens tell them apart."""
        flat, sizes = [np.empty(0, self.dtype)], [np.empty(0, np.int64)]
        for at in range(0, len(words), TOGETHER):
            some = [" " + w for w in words[at : at + TOGETHER].to_pylist()]
            rows = ["".join(some[i : i + 500]) for i in range(0, len(some), 500)]
            ids, _ = self.each(rows)
            ends = np.cumsum(self.length[ids])
            wanted = np.cumsum(np.array(pc.binary_length(words[at : at + TOGETHER]), np.int64) + 1)
            upto = np.searchsorted(ends, wanted, "right")
            if len(ends) and ends[-1] == wanted[-1] and (ends[upto - 1] == wanted).all():
                counts = np.diff(upto, prepend=0)
            else:  # a vocabulary that is not byte-level
                ids, counts = self.each(some)
            flat.append(ids)
            sizes.append(counts)
        return np.concatenate(flat), np.concatenate(sizes)

    def encode(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Of some texts (null: empty) at a time: all ids in a row, the end after each text, and how
        many each text has with it."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        cut = pc.match_substring_regex(texts, self.odd)
        odd = np.flatnonzero(cut.to_numpy(zero_copy_only=False))
        split = pc.split_pattern(pc.if_else(cut, "", texts) if len(odd) else texts, " ")
        starts = np.asarray(split.offsets)[: len(texts) + 1].copy()
        coded = split.flatten().dictionary_encode()
        del split
        # Entries of the table of pieces: the words, the texts' first words, pieces of odd texts, the end.
        place = coded.indices.to_numpy(zero_copy_only=False).copy()
        firsts = coded.dictionary.take(pa.array(place[starts[:-1]])).to_pylist() if len(texts) else []
        pieces = {i: self.cut.split(texts[i].as_py()) for i in odd.tolist()}
        flat, sizes = self.words(coded.dictionary)
        more, more_sizes = self.each(firsts + [p for i in odd.tolist() for p in pieces[i]])
        flat = np.concatenate((flat, more, np.array([self.end], self.dtype)))
        sizes = np.concatenate((sizes, more_sizes, [1]))
        place[starts[:-1]] = len(coded.dictionary) + np.arange(len(texts))
        order, ends = np.insert(place, starts[1:], len(sizes) - 1), starts[1:] + np.arange(1, len(texts) + 1)
        if len(odd):
            # The first piece of an odd text, which is empty so far, makes room for all of its pieces.
            lots = np.array([len(pieces[i]) for i in odd.tolist()])
            at = np.concatenate(([0], ends[:-1]))[odd]
            new = len(coded.dictionary) + len(texts) + np.arange(lots.sum())
            order = np.insert(order, np.repeat(at + 1, lots), new)
            grown = np.zeros(len(texts), np.int64)
            grown[odd] = lots
            ends = ends + np.cumsum(grown)
        before = np.cumsum(sizes) - sizes
        lower = 0
        for text in range(0, len(texts), 1000):
            last = min(text + 1000, len(texts))
            some = order[lower : ends[last - 1]]
            n = sizes[some]
            total = np.cumsum(n)
            ids = flat[np.arange(total[-1]) + np.repeat(before[some] - total + n, n)]
            yield ids, np.diff(total[ends[text:last] - lower - 1], prepend=0)
            lower = ends[last - 1]


def storage(folder: str):
    """The file system of a folder and the path in it; any that Arrow knows, local ones included."""
    from pyarrow import fs

    if not urlsplit(folder).scheme:
        return fs.LocalFileSystem(), folder
    return fs.FileSystem.from_uri(folder)


def put(files, path: str, data: np.ndarray) -> None:
    with files.open_output_stream(path) as out:
        out.write(data.tobytes())


def mapped(files, path: str, dtype: str) -> np.ndarray:
    """A file's numbers: mapped into memory where files are local, read elsewhere."""
    from pyarrow import fs, memory_map

    if isinstance(files, fs.LocalFileSystem):
        return np.frombuffer(memory_map(path, "r").read_buffer(), dtype)
    with files.open_input_file(path) as file:
        return np.frombuffer(file.read_buffer(), dtype)


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The same rows, about :data:`CHUNK_BYTES` of them at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        rows = max(1, batch.num_rows * CHUNK_BYTES // max(batch.nbytes, 1))
        for at in range(0, batch.num_rows, rows):
            held.append(batch.slice(at, rows))
            if sum(b.nbytes for b in held) >= CHUNK_BYTES:
                yield pa.Table.from_batches(held)
                held = []
    if held:
        yield pa.Table.from_batches(held)


def write_part(folder: str, encoding: Encoding):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, (files, top) = Encoder(encoding), storage(folder)
        part = TaskContext.get().partitionId()
        # An attempt that is repeated writes under another name; the manifest names the one that counts.
        name = f"part-{part:06d}-{uuid.uuid4().hex}"
        lengths, docs, nils = ([np.empty(0, np.int64)] for _ in range(3))
        with files.open_output_stream(f"{top}/{name}.bin") as out:
            for rows in chunks(batches):
                ids = rows.column("doc_id").combine_chunks()
                nils.append(ids.is_null().to_numpy(zero_copy_only=False))
                docs.append(pc.fill_null(ids, 0).to_numpy(zero_copy_only=False))
                for coded, sizes in encoder.encode(pa.concat_arrays(rows.column("text").chunks)):
                    out.write(coded.tobytes())
                    lengths.append(sizes)
                pa.default_memory_pool().release_unused()
        offsets = np.concatenate(([0], np.cumsum(np.concatenate(lengths)))).astype("<u8")
        put(files, f"{top}/{name}.off", offsets)
        put(files, f"{top}/{name}.doc", np.concatenate(docs).astype("<i8"))
        put(files, f"{top}/{name}.nil", np.concatenate(nils).astype("u1"))
        found = {"part": part, "file": f"{name}:{encoder.dtype.str}", "n_docs": len(offsets) - 1, "n_tokens": int(offsets[-1])}
        schema = pa.schema({"part": pa.int32(), "file": pa.string(), "n_docs": pa.int64(), "n_tokens": pa.int64()})
        yield pa.RecordBatch.from_pylist([found], schema)

    return write


def write_token_files(docs: DataFrame, encoding: Encoding, folder: str, parts: int | None = None) -> DataFrame:
    """Encode ``text`` (null: empty) of every row into files below ``folder``; return the manifest.

    Documents are sorted by ``doc_id``, nulls first; rows with equal ids are sorted by text. One
    range of ids is one task and one part; a task holds its documents' lengths, not their ids.
    An empty table gives parts without documents. Other columns are not read.
    """
    storage(folder)[0].create_dir(storage(folder)[1])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    if parts is None:
        size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        parts = max(docs.sparkSession.sparkContext.defaultParallelism, -(-size // PART_BYTES))
    order = [F.col("doc_id").asc_nulls_first(), "text"]
    ranges = rows.repartitionByRange(parts, order[0]).sortWithinPartitions(*order)
    written = f"{folder}/written"
    ranges.mapInArrow(write_part(folder, encoding), PART).write.parquet(written)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = docs.sparkSession.read.schema(PART).parquet(written)
    for name in ("n_docs", "n_tokens"):
        base = F.coalesce(F.sum(name).over(before), F.lit(0))
        bases = bases.withColumn(name.replace("n_", "base_"), base)
    bases.write.parquet(f"{folder}/manifest")
    return read_manifest(docs.sparkSession, folder)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/manifest")


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """Per document, from the files: its start in the corpus, its length, and the CRC-32 of its ids
    as little-endian 32-bit integers. Parts are read by as many tasks as there are parts."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, top = storage(folder)
        for batch in batches:
            for part in batch.itertuples():
                name, dtype = part.file.split(":")
                ids = mapped(files, f"{top}/{name}.bin", dtype)
                offsets = mapped(files, f"{top}/{name}.off", "<u8").astype("i8")
                docs = mapped(files, f"{top}/{name}.doc", "<i8")
                nils = mapped(files, f"{top}/{name}.nil", "u1").astype(bool)
                for at in range(0, len(docs), 4096):
                    to = min(at + 4096, len(docs))
                    sums = [
                        zlib.crc32(ids[offsets[i] : offsets[i + 1]].astype("<u4").tobytes())
                        for i in range(at, to)
                    ]
                    yield pd.DataFrame(
                        {
                            "doc_id": pd.array(docs[at:to], "Int64"),
                            "start": part.base_tokens + offsets[at:to],
                            "n_tokens": np.diff(offsets[at : to + 1]),
                            "ids_crc32": np.array(sums, "i8"),
                        }
                    ).assign(doc_id=lambda d: d["doc_id"].mask(nils[at:to]))

    n = max(1, manifest.count())
    return manifest.repartition(n, "part").mapInPandas(read, READ)


def token_digests(docs: DataFrame, encoding: Encoding, folder: str | None = None) -> DataFrame:
    """Write the files, by default to a working folder of their own, and read them back."""
    folder = folder or work_dir(docs.sparkSession, "tokens")
    return read_token_files(write_token_files(docs, encoding, folder), folder)
