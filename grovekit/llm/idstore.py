"""Token ids on disk: one compressed frame per document, a shared dictionary, an offset index.

A store is a folder with two Parquet tables. ``dictionary`` has the zstandard dictionary,
its SHA-256 and the width of an id. ``shards`` has a row per shard: the frames of its
documents back to back, and, per document, its id, where its frame starts and how many ids
it has, together with the hash of the dictionary that the frames need. A document is read
by finding its shard through the id range and cutting out one frame.

Documents are dealt by range of ``doc_id``; a shard closes after so many documents or
bytes, so no task holds more than one shard. The dictionary is trained on at most
``samples`` short documents, chosen by hash; every document is encoded, none is cut.

Defined results: null and empty texts store the end id alone; a null ``doc_id`` sorts
first; equal ids keep one entry each; an empty table makes a store without shards; with
too few samples to train on, frames are written without a dictionary (hash of no bytes).
Further columns of the input are ignored.
"""

import hashlib

import numpy as np
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from grovekit.llm.arrow import arrow_schema, slices, to_batch
from grovekit.llm.tokens import default_path, encoder

END_ID = 0
SAMPLES = 2_000
SAMPLE_CHARS = 8_192
DICTIONARY_BYTES = 65_536
SHARD_DOCUMENTS = 2_048
SHARD_BYTES = 4 << 20
_LEVEL = 3
_SHARD = (
    "part int, shard int, first_id long, last_id long, part_start long, n_ids long, dictionary_sha256 string, "
    "doc_ids array<long>, offsets array<long>, counts array<long>, frames binary"
)
_DOCUMENT = "doc_id long, start long, n_tokens long, ids binary"


def _documents(df):
    return df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def train_dictionary(docs, tokenizer=None, samples=SAMPLES):
    """Dictionary trained on the serialized ids of at most ``samples`` short documents."""
    drawn = F.xxhash64("doc_id", "text")
    # A hash sieve leaves about twice as many as are wanted, so few reach the driver from each task.
    sieve = max(1, docs.count() // (2 * samples))
    rows = (
        _documents(docs).where((F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(sieve)) == 0) & F.length("text").between(1, SAMPLE_CHARS))
        .orderBy(drawn, "doc_id").limit(samples).select("text").collect()
    )
    arrays = [_narrow(ids, 2) for ids in encoder(tokenizer or default_path())([r.text for r in rows])]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, arrays).as_bytes() if len(arrays) >= 16 else b""
    except zstandard.ZstdError:  # too little or too uniform to train on
        return b""


def _narrow(ids, width):
    return np.frombuffer(ids, "<u4").astype(f"<u{width}").tobytes()


def _codec(dictionary):
    return {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}


def write_store(docs: DataFrame, path: str, tokenizer=None, end_id=END_ID, samples=SAMPLES) -> str:
    """Encode ``docs`` (doc_id, text) into a store at ``path`` in ascending ``doc_id``; returns ``path``."""
    spark = docs.sparkSession
    tokenizer = tokenizer or default_path()
    dictionary = train_dictionary(docs, tokenizer, samples)
    digest = hashlib.sha256(dictionary).hexdigest()
    # Ids are kept in two bytes when all ids of the tokenizer fit.
    from tokenizers import Tokenizer
    width = 2 if max(Tokenizer.from_file(tokenizer).get_vocab_size(), end_id + 1) <= 1 << 16 else 4
    schema = arrow_schema(_SHARD)

    def encode(batches):
        from pyspark import TaskContext

        part, shard, ids_before = TaskContext.get().partitionId(), 0, 0
        encode_ids = encoder(tokenizer)
        pack = zstandard.ZstdCompressor(level=_LEVEL, write_content_size=True, **_codec(dictionary))
        tail = np.array([end_id], "<u4").tobytes()
        keys, counts, frames, size = [], [], [], 0

        def close():
            offsets = np.concatenate([[0], np.cumsum([len(f) for f in frames])])
            known = [k for k in keys if k is not None]
            return to_batch(schema, [
                [part], [shard], [min(known, default=None)], [max(known, default=None)], [ids_before], [sum(counts)],
                [digest], [keys], [offsets.tolist()], [counts], [b"".join(frames)]])

        for batch in slices(batches):
            ids_of = encode_ids(batch.column("text").to_pylist())
            for key, ids in zip(batch.column("doc_id").to_pylist(), ids_of):
                ids += tail
                frames.append(pack.compress(_narrow(ids, width)))
                keys.append(key)
                counts.append(len(ids) // 4)
                size += len(frames[-1])
                if len(keys) >= SHARD_DOCUMENTS or size >= SHARD_BYTES:
                    yield close()
                    ids_before += sum(counts)
                    shard, keys, counts, frames, size = shard + 1, [], [], [], 0
        if keys:
            yield close()

    # The hash splits a repeated id; it is not stored.
    ordered = (
        _documents(docs).withColumn("tie", F.xxhash64("text"))
        .repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    )
    ordered.mapInArrow(encode, _SHARD).write.option("compression", "uncompressed").parquet(f"{path}/shards")
    # 'dictionary' is written last: its presence marks a complete store.
    spark.createDataFrame([(bytearray(dictionary), digest, width, end_id)],
                          "dictionary binary, sha256 string, width int, end_id int").coalesce(1).write.parquet(f"{path}/dictionary")
    return path


def read_store(spark, path: str, doc_id=None) -> DataFrame:
    """Documents of a store: doc_id, start (ids before it), n_tokens, ids (little-endian unsigned 32-bit).

    With ``doc_id`` only shards whose range holds it are read, and only its frame is decoded.
    """
    head = spark.read.parquet(f"{path}/dictionary").head()
    dictionary, width = bytes(head.dictionary), head.width
    if hashlib.sha256(dictionary).hexdigest() != head.sha256:
        raise ValueError("the dictionary of the store is damaged")
    shards = spark.read.schema(T._parse_datatype_string(_SHARD)).parquet(f"{path}/shards")
    # One row per written partition, so the running sum and the broadcast are small at any size.
    totals = shards.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = totals.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    if doc_id is not None:
        shards = shards.where(F.lit(doc_id).between(F.col("first_id"), F.col("last_id")))
    schema = arrow_schema(_DOCUMENT)
    wanted_sha = head.sha256

    def decode(batches):
        unpack = zstandard.ZstdDecompressor(**_codec(dictionary))
        for batch in slices(batches, 1):
            row = batch.to_pylist()[0]
            if row["dictionary_sha256"] != wanted_sha:
                raise ValueError("a shard was written with another dictionary")
            start, frames, out = row["start"], row["frames"], ([], [], [], [])
            for i, (key, n) in enumerate(zip(row["doc_ids"], row["counts"])):
                if doc_id is None or key == doc_id:
                    ids = unpack.decompress(frames[row["offsets"][i]:row["offsets"][i + 1]])
                    for column, value in zip(out, (key, start, n, np.frombuffer(ids, f"<u{width}").astype("<u4").tobytes())):
                        column.append(value)
                start += n
                if len(out[0]) >= 256:
                    yield to_batch(schema, out)
                    out = ([], [], [], [])
            yield to_batch(schema, out)

    return (
        shards.join(F.broadcast(before), "part").withColumn("start", F.col("before") + F.col("part_start"))
        .select("dictionary_sha256", "doc_ids", "counts", "offsets", "frames", "start").mapInArrow(decode, _DOCUMENT)
    )
