"""Token ids as flat unsigned files with 64-bit document offsets.

Format, one shard per partition: `<name>.ids` holds little-endian uint16 ids (uint32 when the
vocabulary is larger than 65,536), `<name>.docs` holds little-endian int64 triples: document id,
offset of its first id in the shard, number of its ids. Shards follow ascending document id;
a shard's base is the prefix sum of the id counts before it, kept in the manifest.

A task writes under a name of its own and only the manifest makes a shard part of the data set,
so a task that is lost or run twice leaves at most an unread file. Files go to the shared folder
through pyarrow's filesystems and are memory-mapped where that folder is a mount.

Null texts are empty documents (one end id); null ids sort first and come back null. Rows that
repeat an id are each kept, ordered by text. An empty table gives an empty result.
"""

import os
import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Window, functions as F

from quillon.session import materialize, ship_package, work_path

NO_ID = np.iinfo(np.int64).min
MANIFEST = "shard int, n_docs long, n_tokens long, path string, wide boolean"


def filesystem(uri):
    return pafs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}" if not uri.startswith("file:") else uri.replace("file:", "file://", 1))


#: Endings and runs of white space at which words are not parted by one space or newline.
ODD = (" ", "\n"), ("  ", "\n\n", " \n", "\n ")

#: Marks that never join the letters before them.
CLOSING = ".,!?;:*$%&#"

#: The vocabulary's letters for bytes, and the first letter that is left to the tokenizer's own splitting.
_PLAIN = {*range(33, 127), *range(161, 173), *range(174, 256)}
_OTHERS = sorted(set(range(256)) - _PLAIN)
LETTERS = [chr(b if b in _PLAIN else 256 + _OTHERS.index(b)) for b in range(256)]
SPACED, BEYOND = LETTERS[32], "\u0250"


class _Known(dict):
    """Encodings by word, made when first asked for; emptied at `limit` entries."""

    def __init__(self, make, limit):
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, key):
        ids = self.make(key)
        if len(self) >= self.limit:
            self.clear()
        self[key] = ids
        return ids


class PieceCache:
    """Encodes by words, each distinct word only once while it stays cached.

    The vocabulary merges only inside the pieces of its own splitting pattern, and that pattern
    always cuts before a single space or newline that parts two words. So in texts whose words are
    parted that way the ids are those of the words in order, each with its space or newline.
    Latin letters, which are one piece with a space before them and one without, go to the merges
    themselves, and marks behind them are another piece. Other texts are cut by the pattern itself,
    and texts that hold an added token's string go to the tokenizer whole. A table is emptied when
    it reaches `limit` entries.
    """

    def __init__(self, path, limit=500_000):
        import regex
        from tokenizers import Tokenizer
        import public_tokenizers

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.kind = "<u4" if self.tokenizer.get_vocab_size() > 65536 else "<u2"
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.find = regex.compile(public_tokenizers.PATTERN).findall
        self.tokenize = self.tokenizer.model.tokenize
        self.limit, self.pieces = limit, {}
        self.words, self.stems, self.tails = _Known(self._of_word, limit), _Known(self._of_stem, limit), _Known(self._of_piece, 10_000)
        self.pack = [struct.Struct(f"<{n}{'I' if self.kind == '<u4' else 'H'}").pack for n in range(16)]

    def _joined(self, keys, known, encode):
        try:
            return b"".join(map(known.__getitem__, keys))
        except KeyError:
            new = list(set(keys).difference(known))
            if len(known) + len(new) > self.limit:
                known.clear()
                new = list(set(keys))
            known.update(zip(new, encode(new)))
        return b"".join(map(known.__getitem__, keys))

    def _whole(self, texts):
        return [np.array(e.ids, self.kind).tobytes() for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _of_piece(self, text):
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def _of_stem(self, stem):
        """Letters after a space, or with their newline, which is a piece of its own."""
        if stem[0] == "\n":
            return self.tails["\n"] + self._merged("", stem[1:])
        return self._merged(SPACED, stem)

    def _merged(self, before, letters):
        piece = before + (letters if letters.isascii() else "".join(map(LETTERS.__getitem__, letters.encode())))
        ids = [t.id for t in self.tokenize(piece)]
        return self.pack[len(ids)](*ids) if len(ids) < len(self.pack) else np.array(ids, self.kind).tobytes()

    def _of_word(self, word):
        """A word after a space, or with its newline; letters before closing marks are two pieces."""
        stem = word.rstrip(CLOSING)
        letters = stem[1:] if stem[:1] == "\n" else stem
        if not letters.isalpha() or not (letters.isascii() or max(letters) < BEYOND):
            return self._of_piece(word if word[0] == "\n" else " " + word)
        ids = self.stems[stem]
        return ids + self.tails[word[len(stem) :]] if len(stem) < len(word) else ids

    def encode(self, text):
        """The ids of a text as bytes."""
        if any(s in text for s in self.special):
            return self._of_piece(text)
        if text.endswith(ODD[0]) or any(x in text for x in ODD[1]):
            return self._joined(self.find(text), self.pieces, self._whole)
        first, *rest = text.replace("\n", " \n").split(" ")
        start = self._joined([first], self.pieces, self._whole) if first else b""
        return start + b"".join(map(self.words.__getitem__, rest))


#: Tables stay with a worker process from task to task.
_caches = {}


def cache_of(path):
    if path not in _caches:
        _caches[path] = PieceCache(path)
    return _caches[path]


def write_shard(batches, path, end_id, folder):
    from pyspark import TaskContext

    cache = cache_of(path)
    shard = TaskContext.get().partitionId()
    wide = cache.kind == "<u4"
    width, end = (4 if wide else 2), np.array([end_id], cache.kind).tobytes()
    fs, base = filesystem(folder)
    fs.create_dir(base, recursive=True)
    name = f"{shard:06d}-{uuid.uuid4().hex}"
    n_docs = n_tokens = 0
    with fs.open_output_stream(f"{base}/{name}.ids") as ids, fs.open_output_stream(f"{base}/{name}.docs") as docs:
        for batch in batches:
            rows = np.empty((batch.num_rows, 3), "<i8")
            for i, (doc_id, text) in enumerate(zip(batch.column("doc_id").to_pylist(), batch.column("text"))):
                got = cache.encode(text.as_py() or "") + end
                ids.write(got)
                rows[i] = (NO_ID if doc_id is None else doc_id, n_tokens, len(got) // width)
                n_tokens += len(got) // width
            n_docs += batch.num_rows
            docs.write(rows.tobytes())
    if n_docs:
        yield pa.RecordBatch.from_pylist([{"shard": shard, "n_docs": n_docs, "n_tokens": n_tokens, "path": f"{folder}/{name}", "wide": wide}], pa.schema([("shard", pa.int32()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("path", pa.string()), ("wide", pa.bool_())]))


def read_shards(batches, step=20_000):
    for batch in batches:
        for row in batch.to_pylist():
            fs, path = filesystem(row["path"])
            local = isinstance(fs, pafs.LocalFileSystem)
            load = lambda end, kind: np.memmap(path + end, kind, "r") if local else np.frombuffer(fs.open_input_file(path + end).read(), kind)
            ids, docs = load(".ids", "<u4" if row["wide"] else "<u2"), load(".docs", "<i8").reshape(-1, 3)
            for lo in range(0, len(docs), step):
                part = np.array(docs[lo : lo + step])
                crc = [zlib.crc32(np.asarray(ids[s : s + n], "<u4").tobytes()) for _, s, n in part]
                yield pa.RecordBatch.from_arrays([pa.array(part[:, 0], mask=part[:, 0] == NO_ID), pa.array(part[:, 1] + row["base"]), pa.array(part[:, 2]), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])


def write_token_files(docs, tokenizer_path, end_id=2, partitions=None, folder=None):
    """Writes the shards; returns the manifest with a base (ids in earlier shards) per shard.

    The manifest has one row a shard, so the prefix sum over it is a small window.
    """
    spark = docs.sparkSession
    ship_package(spark)
    folder = folder or work_path(spark, "tokens")
    n = partitions or max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = docs.repartitionByRange(n, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    shards = materialize(ordered.mapInArrow(lambda it: write_shard(it, tokenizer_path, end_id, folder), MANIFEST), "manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return shards.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_token_files(manifest):
    """One row per document from the files: doc_id, start, n_tokens, ids_crc32."""
    n = max(manifest.count(), 1)
    return manifest.repartition(n, "shard").mapInArrow(read_shards, "doc_id long, start long, n_tokens long, ids_crc32 long")
