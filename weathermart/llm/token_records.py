"""Token ids as length-delimited binary records, with an offset index beside them.

A record is: length of the payload (8 bytes), masked checksum of those (4), payload,
masked checksum of the payload (4); all little-endian. The payload is the document's
number (8 bytes, signed), the width of an id (1 byte) and the ids, of 2 bytes each where the
vocabulary allows that and of 4 otherwise. Files hold whole records one
after the other in ascending order of documents, and file names sort in that order
too. The index is a Parquet table with one row per record, so that a reader can
fetch records in any shuffled order with one seek each.

Files are written by tasks into shared storage. A task writes to a name of its own
attempt and then moves the finished file to its place, so a lost executor leaves no
half file behind and a repeated attempt replaces a file by the same bytes.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weathermart.llm.common import slices, text_or_empty
from weathermart.sources.paths import scratch_dir, storage

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
# Fixed values of the record format.
MASK_DELTA = 0xA282EAD8
HEAD, FOOT, DOC = "<QI", "<I", "<qB"
HEAD_SIZE, FOOT_SIZE, DOC_SIZE = 12, 4, 9
ID_TYPES = {2: "<u2", 4: "<u4"}

# Bytes of text that a file stands for: at most, and at least where there are fewer files than
# the session has shuffle partitions.
MOST_TEXT, LEAST_TEXT = 256 << 20, 8 << 20

INDEX = (
    "doc_id long, file int, nth long, offset long, length long, n_tokens long"
)


def masked(data: bytes) -> int:
    """Checksum that stays sound when the data themselves hold checksums: rotated, then moved."""
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    size = struct.pack("<Q", len(payload))
    return size + struct.pack(FOOT, masked(size)) + payload + struct.pack(FOOT, masked(payload))


def unframe(record: bytes) -> bytes:
    """The payload of one whole record; a ValueError if it was damaged."""
    size, check = struct.unpack_from(HEAD, record)
    payload = record[HEAD_SIZE : HEAD_SIZE + size]
    if masked(record[:8]) != check or len(record) != HEAD_SIZE + size + FOOT_SIZE:
        raise ValueError("damaged record length")
    if struct.unpack_from(FOOT, record, HEAD_SIZE + size)[0] != masked(payload):
        raise ValueError("damaged record payload")
    return payload


def payload_of(doc_id: int | None, width: int, ids: bytes) -> bytes:
    """``ids`` are little-endian, ``width`` bytes each. A missing doc_id is the lowest number."""
    return struct.pack(DOC, -(2**63) if doc_id is None else doc_id, width) + ids


def ids_of(payload: bytes) -> np.ndarray:
    """The ids of a payload, as unsigned 32-bit numbers."""
    return np.frombuffer(payload, ID_TYPES[payload[DOC_SIZE - 1]], offset=DOC_SIZE).astype("<u4")


_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")


_SIMPLE = re.compile("[a-zß-öø-ÿ]+")


class WordEncoder:
    """Encodes texts word by word with a tokenizer that drops white space.

    Such a tokenizer encodes every run between spaces on its own, so the ids of a
    word are looked up once and then remembered, for up to ``limit`` words. A word of
    Latin letters with trailing marks is put together from its two pieces; all others
    go to the tokenizer whole.
    """

    def __init__(self, path: str, limit: int = 600_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.known: dict[str, bytes] = {"": b""}
        self.limit = limit
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.kind = ID_TYPES[self.width]

    def _whole(self, pieces: list[str]) -> None:
        # Of normaliser and pre-tokeniser only the byte alphabet changes a run of lower-case letters.
        model = self.tokenizer.model
        for piece in filter(_SIMPLE.fullmatch, pieces):
            plain = piece if piece.isascii() else self.bytes.pre_tokenize_str(piece)[0][0]
            self.known[piece] = np.array([t.id for t in model.tokenize(plain)], self.kind).tobytes()
        pieces = [p for p in pieces if p not in self.known]
        for piece, done in zip(
            pieces, self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False), strict=True
        ):
            self.known[piece] = np.array(done.ids, self.kind).tobytes()

    def learn(self, words: set[str]) -> None:
        """Look up the words that are not known yet."""
        new = [w for w in words if w not in self.known]
        if len(self.known) + len(new) > self.limit:
            self.known = {"": b""}
            new = list(words)
        split, whole = {}, set()
        for word in new:
            plain = _PLAIN.fullmatch(word)
            if plain and (plain[2] or not word.islower()):
                split[word] = (plain[1].lower(), plain[2])
                whole.update(p for p in split[word] if p not in self.known)
            elif word not in self.known:
                whole.add(word)
        self._whole(sorted(whole))
        for word, (letters, marks) in split.items():
            self.known[word] = self.known[letters] + self.known[marks]

    def encode(self, texts: list[str]) -> list[bytes]:
        parted = [text.replace("\n", " ").split(" ") for text in texts]
        self.learn(set().union(*parted))
        return [b"".join(map(self.known.__getitem__, words)) for words in parted]


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder per worker process and file, kept between tasks."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def file_name(number: int) -> str:
    return f"part-{number:06d}.rec"


def write_records(
    docs: DataFrame,
    root: str,
    tokenizer: str,
    end_id: int = END_ID,
    files: int | None = None,
) -> DataFrame:
    """Encode ``docs`` (doc_id, text) into record files and their index below ``root``.

    ``tokenizer`` is the path of a tokenizers file that drops white space; ``end_id``
    closes every document. Returns the index: doc_id, file (number in file order),
    nth (place in the file), offset and length (bytes of the record), n_tokens (with
    the end id). Documents are dealt to ``files`` files by ranges of doc_id; by default the
    texts' bytes decide how many (``MOST_TEXT``, ``LEAST_TEXT``).

    A null or empty text is a document of the end id alone. Rows without doc_id come
    first, rows with the same doc_id in order of their texts; each is a record of its
    own. An empty table gives no records. Other columns are ignored.
    """
    spark = docs.sparkSession
    files = files or file_count(docs)
    where, folder = storage(root)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        number = task.partitionId()
        words = encoder(tokenizer)
        width = words.width
        end = np.array([end_id], words.kind).tobytes()
        store, base = storage(root)
        store.create_dir(f"{base}/data")
        own = f"{base}/data/.{file_name(number)}.{task.taskAttemptId()}"
        at = nth = 0
        try:
            with store.open_output_stream(own) as out:
                for batch in slices(batches, 256):
                    doc_ids = batch.column("doc_id").to_pylist()
                    rows = []
                    for doc_id, ids in zip(
                        doc_ids, words.encode(batch.column("text").to_pylist()), strict=True
                    ):
                        record = frame(payload_of(doc_id, width, ids + end))
                        out.write(record)
                        rows.append((doc_id, number, nth, at, len(record), len(ids) // width + 1))
                        at += len(record)
                        nth += 1
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _INDEX_TYPES, strict=True)],
                        _INDEX_NAMES,
                    )
        except BaseException:
            store.delete_file(own)
            raise
        store.move(own, f"{base}/data/{file_name(number)}")

    where.create_dir(f"{folder}/data")
    (
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), text_or_empty(F.col("text")).alias("text")
        )
        # The hash only parts rows that share a doc_id; ranges are of doc_id.
        .withColumn("_tie", F.xxhash64("text"))
        .repartitionByRange(files, F.col("doc_id").asc_nulls_first(), "_tie")
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "_tie")
        .select("doc_id", "text")
        .mapInArrow(write, INDEX)
        .write.parquet(f"{root}/index")
    )
    # What attempts on lost executors left behind.
    for left in where.get_file_info(fs.FileSelector(f"{folder}/data")):
        if left.base_name.startswith("."):
            where.delete_file(left.path)
    return spark.read.schema(INDEX).parquet(f"{root}/index")


_INDEX_NAMES = ["doc_id", "file", "nth", "offset", "length", "n_tokens"]
_INDEX_TYPES = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]


def file_count(docs: DataFrame) -> int:
    """Files for the texts of ``docs``: none stands for more than ``MOST_TEXT`` bytes on average, and
    small tables use as many as the session has shuffle partitions, down to ``LEAST_TEXT``."""
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first().n
    session = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, -(-size // MOST_TEXT), min(session, -(-size // LEAST_TEXT)))


def read_records(index: DataFrame, root: str) -> DataFrame:
    """The records that ``index`` lists, checked: its columns and ids_crc32 of the ids read.

    Rows may be in any order and any subset: every record is fetched by its offset.
    """
    return index.mapInArrow(_reader(root, with_ids=False), f"{INDEX}, ids_crc32 long")


def read_ids(index: DataFrame, root: str) -> DataFrame:
    """The same with the ids themselves as an array of ints."""
    return index.mapInArrow(_reader(root, with_ids=True), f"{INDEX}, ids_crc32 long, ids array<int>")


def _reader(root: str, with_ids: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = storage(root)
        number, data = None, None
        for batch in slices(batches, 1024):
            crcs, arrays = [], []
            for row in batch.to_pylist():
                if row["file"] != number:
                    number = row["file"]
                    if data is not None:
                        data.close()
                    data = store.open_input_file(f"{base}/data/{file_name(number)}")
                payload = unframe(data.read_at(row["length"], row["offset"]))
                if payload[: DOC_SIZE - 1] != payload_of(row["doc_id"], 0, b"")[:-1]:
                    raise ValueError("the record at this offset is of another document")
                ids = ids_of(payload)
                crcs.append(zlib.crc32(ids.tobytes()))
                if with_ids:
                    arrays.append(ids.astype(np.int32))
            columns = [*batch.select(_INDEX_NAMES).columns, pa.array(crcs, pa.int64())]
            if with_ids:
                columns.append(pa.array(arrays, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(
                columns, [*_INDEX_NAMES, "ids_crc32", *["ids"] * with_ids]
            )
        if data is not None:
            data.close()

    return read


def with_starts(index: DataFrame) -> DataFrame:
    """``index`` with start: ids of all documents before, over files in order.

    Files are summed up first; the running total over files has one row per file.
    Within a file the running total follows its records.
    """
    totals = index.groupBy("file").agg(F.sum("n_tokens").alias("ids"))
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    first = totals.select("file", F.coalesce(F.sum("ids").over(earlier), F.lit(0)).alias("first"))
    in_file = Window.partitionBy("file").orderBy("nth").rowsBetween(Window.unboundedPreceding, -1)
    # One row per file on this side.
    return (
        index.withColumn("start", F.coalesce(F.sum("n_tokens").over(in_file), F.lit(0)))
        .join(first, "file")
        .withColumn("start", F.col("start") + F.col("first"))
        .drop("first")
    )


def encode_documents(docs: DataFrame, tokenizer: str, root: str | None = None) -> DataFrame:
    """Write ``docs`` as records and read them back: doc_id, start, n_tokens, ids_crc32, file, offset, length."""
    root = root or f"{scratch_dir(docs.sparkSession)}/records"
    index = write_records(docs, root, tokenizer)
    return with_starts(read_records(index, root)).select(
        "doc_id", "start", "n_tokens", "ids_crc32", "file", "offset", "length"
    )
