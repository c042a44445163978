"""Token ids in shards, with a minimal perfect hash index from document keys to offsets.

``write`` orders documents by key with one range shuffle, encodes them in the tasks that received them, and
cuts each task's stream into shards of bounded size. A shard is one row of a Parquet table, so Spark's
commit protocol covers lost executors and any file system Spark reads will do:

``payload``  raw ids, little endian, two bytes each if the vocabulary allows, else four, documents in key order
``keys``     the documents' keys, int64 little endian, in payload order
``index``    the hash index: header, bit arrays of the levels, then one slot per document (fingerprint, offset, length)

The index is a cascade of bit arrays: on every level the keys that are still open are hashed into gamma times
as many bits, keys alone on their bit stay there, the others go to the next level. A key's slot is the number
of set bits before its own, so n keys have exactly n slots. Slots keep a 32-bit fingerprint of the key, which
tells unknown keys apart (one in four thousand million passes). A look-up reads a few bits and one slot,
however large the shard is.

Ids come from the tokenizers library. Texts are cut at ASCII white space, which this kind of tokenizer drops and
never merges across, and between letters and ASCII symbols or digits, where a token always ends, so the ids of a
text are those of its pieces in order; each distinct piece is encoded once per worker while a bounded cache has
room. ``Encoder`` refuses tokenizers for which that does not hold.

Cases: null texts are empty and have only the end id; a null key can't be indexed and is stored under the
smallest int64; rows with equal keys are all stored in key order, and the index points to the first; a text longer
than a shard has a shard of its own; an empty table gives an empty store; other columns are not read.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reelgauge.llm.pieces import IdStore, distinct, per_text, portions, spread, text_bytes
from reelgauge.llm.tables import written
from reelgauge.operators.ordered import carry_forward

#: Ids and documents of a shard, at most (one long document may exceed the first).
SHARD_IDS = 2_000_000
SHARD_DOCS = 65_536
NULL_KEY = -(1 << 63)

_MAGIC = b"RGMPH1\x00\x00"
_GAMMA = 2
_LEVELS = 48


def _mix64(keys: np.ndarray, salt: int) -> np.ndarray:
    """A 64-bit finaliser over keys and a salt."""
    h = keys.astype(np.uint64) ^ np.uint64((salt * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & 0xFFFFFFFFFFFFFFFF)
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return h ^ (h >> np.uint64(33))


def _fingerprint(keys: np.ndarray) -> np.ndarray:
    return (_mix64(keys, 10_007) >> np.uint64(32)).astype(np.uint32)


def build_index(keys: np.ndarray, offsets: np.ndarray, lengths: np.ndarray) -> bytes:
    """Index of distinct int64 keys."""
    n, open_ = len(keys), np.arange(len(keys))
    as_bits = keys.astype(np.int64).view(np.uint64)
    sizes, bitmaps, slot_of, used = [], [], np.zeros(n, np.int64), 0
    for level in range(_LEVELS):
        if not len(open_):
            break
        size = max(64, (_GAMMA * len(open_) + 63) // 64 * 64)
        at = (_mix64(as_bits[open_], level) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(at, minlength=size) == 1
        settled = alone[at]
        ranks = np.cumsum(alone)
        slot_of[open_[settled]] = used + ranks[at[settled]] - 1
        used += int(ranks[-1])
        sizes.append(size)
        bitmaps.append(np.packbits(alone, bitorder="little").tobytes())
        open_ = open_[~settled]
    if len(open_):
        raise ValueError("keys repeat")
    slots = np.zeros(n, np.dtype([("fp", "<u4"), ("length", "<u4"), ("offset", "<u8")]))
    slots["fp"][slot_of], slots["length"][slot_of], slots["offset"][slot_of] = _fingerprint(as_bits), lengths, offsets
    head = _MAGIC + struct.pack(f"<QI{len(sizes)}Q", n, len(sizes), *sizes)
    return head + b"".join(bitmaps) + slots.tobytes()


class Index:
    """Look-ups in the bytes of an index; nothing is rebuilt."""

    def __init__(self, data: bytes):
        if data[:8] != _MAGIC:
            raise ValueError("not an index")
        self.n, levels = struct.unpack_from("<QI", data, 8)
        self.sizes = struct.unpack_from(f"<{levels}Q", data, 20)
        at = 20 + 8 * levels
        self.bits, self.ranks, self.base, used = [], [], [], 0
        for size in self.sizes:
            packed = np.frombuffer(data, np.uint8, size // 8, at)
            at += size // 8
            before = np.concatenate([[0], np.cumsum(np.bitwise_count(packed.view("<u8")).astype(np.int64))])
            self.bits.append(packed.view("<u8"))
            self.ranks.append(before)
            self.base.append(used)
            used += int(before[-1])
        self.slots = np.frombuffer(data, np.dtype([("fp", "<u4"), ("length", "<u4"), ("offset", "<u8")]), self.n, at)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(known, offset, length) of each key."""
        as_bits = np.asarray(keys, np.int64).view(np.uint64)
        slot, open_ = np.full(len(as_bits), -1, np.int64), np.arange(len(as_bits))
        for level, size in enumerate(self.sizes):
            at = _mix64(as_bits[open_], level) % np.uint64(size)
            word, bit = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            value = self.bits[level][word]
            here = ((value >> bit) & np.uint64(1)).astype(bool)
            below = np.bitwise_count(value & ((np.uint64(1) << bit) - np.uint64(1))).astype(np.int64)
            slot[open_[here]] = self.base[level] + self.ranks[level][word[here]] + below[here]
            open_ = open_[~here]
            if not len(open_):
                break
        known = slot >= 0
        known[known] = self.slots["fp"][slot[known]] == _fingerprint(as_bits[known])
        chosen = self.slots[np.where(known, slot, 0)] if self.n else np.zeros(len(as_bits), self.slots.dtype)
        return known, np.where(known, chosen["offset"], 0).astype(np.int64), np.where(known, chosen["length"], 0).astype(np.int64)


#: Fixed value: the pattern of word-level BPE in lower case.
_WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Letters that neither normalisation nor lower case turns into anything else than one letter.
_LETTERS = re.compile("[a-zÀ-ÖØ-öø-įı-ſ]+")
#: Letters that normalisation and lower case leave as they are.
_PLAIN = re.compile("[a-zß-öø-ÿ]+")

#: Kinds of bytes. A letter next to a symbol is the border of two tokens; about other bytes nothing is known.
_SPACE, _LETTER, _SYMBOL, _OTHER = 0, 1, 2, 4
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
#: Second bytes of the letters that begin with the byte C3.
_LATIN = np.zeros(256, bool)
_LATIN[0x80:0xC0] = True
_LATIN[[0x97, 0xB7]] = False


def _kind_table(uncut: str) -> np.ndarray:
    """The kind of each byte; characters of ``uncut`` and apostrophes, which may begin a token with letters, are no symbols."""
    table = np.full(256, _OTHER, np.uint8)
    table[list(b" \t\n\x0b\x0c\r")] = _SPACE
    for byte in range(0x21, 0x7F):
        if chr(byte).isalpha():
            table[byte] = _LETTER
        elif chr(byte) not in uncut + "'":
            table[byte] = _SYMBOL
    return table


class Encoder:
    """Ids of whole texts, batch by batch, through the tokenizers library."""

    CACHE = 600_000

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core per task
        from tokenizers import Tokenizer, pre_tokenizers

        described = json.loads(spec)
        before = (described.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        steps = [s.get("type") for s in (described.get("normalizer") or {}).get("normalizers", [])]
        added = described["added_tokens"]
        if (
            before[0].get("pattern") != {"Regex": _WORD_PATTERN} or before[0].get("behavior") != "Removed" or not before[0].get("invert")
            or steps != ["NFC", "Replace", "Lowercase"] or not added or not described["model"].get("end_of_word_suffix")
            or any(t["lstrip"] or t["rstrip"] or t["single_word"] or "<" not in t["content"] or any(c.isspace() for c in t["content"]) for t in added)
        ):
            raise ValueError("this tokenizer may join pieces across white space")
        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        #: The same model for words that need no normaliser and no pattern.
        self.plain = Tokenizer(self.tokenizer.model)
        later = [self.tokenizer.pre_tokenizer[i] for i in range(1, len(before))]
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), *later])
        self.kinds = _kind_table("".join(t["content"] for t in added))
        #: Put between pieces, a special token gives one call's pieces back.
        self.mark = min(added, key=lambda t: t["id"])
        self.width = 2 if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        self.dtype = np.dtype(f"<u{self.width}")
        self.ends_word = np.zeros(self.tokenizer.get_vocab_size(with_added_tokens=True), bool)
        suffix = described["model"]["end_of_word_suffix"]
        self.ends_word[[i for token, i in described["model"]["vocab"].items() if token.endswith(suffix)]] = True
        self.known = IdStore(self.CACHE)

    def _learn(self, pieces: list[bytes]) -> None:
        """Ids of pieces that are not known, many in one call of the library."""
        mark = self.mark["content"]
        texts = [p.decode("utf-8", "replace") for p in pieces]
        plain, words, others, rest = [], [], [], []
        for i, t in enumerate(texts):
            (plain if _PLAIN.fullmatch(t) else words if _LETTERS.fullmatch(t) else rest if "<" in t else others).append(i)
        for chosen, between, tokenizer in ((plain, " ", self.plain), (words, " ", self.tokenizer), (others, mark, self.tokenizer)):
            groups = [chosen[i : i + 500] for i in range(0, len(chosen), 500)]
            encoded = tokenizer.encode_batch_fast([between.join([texts[i] for i in g]) for g in groups], add_special_tokens=False)
            for g, e in zip(groups, encoded, strict=True):
                ids = np.array(e.ids, np.uint32)
                if between == " ":  # a word of letters has one token that ends a word, its last
                    ends = np.flatnonzero(self.ends_word[ids]) + 1
                    begins = np.concatenate([[0], ends[:-1]])
                else:
                    cuts = np.flatnonzero(ids == self.mark["id"])
                    begins, ends = np.concatenate([[0], cuts + 1]), np.append(cuts, len(ids))
                if len(ends) != len(g):
                    raise ValueError("pieces and ids disagree")
                length = ends - begins
                self.known.add_all([pieces[i] for i in g], spread(ids, begins, length), length)
        for i, e in zip(rest, self.tokenizer.encode_batch_fast([texts[i] for i in rest], add_special_tokens=False), strict=True):
            self.known.add_all([pieces[i]], np.array(e.ids, np.uint32), np.array([len(e.ids)]))

    def _kind(self, data: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The kind of each byte. ``first`` are the texts' first bytes, which belong to no character before them."""
        kind = self.kinds[data]
        pair = data[:-1] == 0xC3
        pair &= _LATIN[data[1:]]
        pair[first[first > 0] - 1] = False
        kind[:-1][pair] = kind[1:][pair] = _LETTER
        return kind

    @staticmethod
    def _lower(data: np.ndarray, kind: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """A-Z in lower case, as the tokenizer has it.

        Pieces that may be a special token stay, as it counts in its own spelling only, and so do letters before a mark:
        some compose with it in lower case only, and the tokenizer composes first.
        """
        lower, tags = _LOWER[data], np.flatnonzero(data == ord("<"))
        np.copyto(lower[:-1], data[:-1], where=(kind[1:] == _OTHER) & (data[1:] > 0x7F))
        if len(tags):
            kept = np.zeros(len(starts), bool)
            kept[np.searchsorted(starts, tags, side="right") - 1] = True
            np.copyto(lower[starts[0] :], data[starts[0] :], where=np.repeat(kept, np.diff(np.append(starts, len(data)))))
        return lower

    def batch(self, texts: pa.Array, end_id: int | None) -> tuple[np.ndarray, np.ndarray]:
        """All ids in one array, and the number of ids of each text."""
        data, edges = text_bytes(texts)
        first = edges[:-1][edges[:-1] < len(data)]
        kind = self._kind(data, first)
        visible = kind != _SPACE
        begins = visible.copy()
        begins[1:] &= (kind[:-1] == _SPACE) | (kind[:-1] ^ kind[1:] == _LETTER | _SYMBOL)
        begins[first] |= visible[first]  # texts touch in the buffer
        starts = np.flatnonzero(begins)
        codes, pieces = distinct(self._lower(data, kind, starts)[visible], np.flatnonzero(begins[visible]))
        at = self.known.find(pieces)
        new = np.flatnonzero(at < 0)
        if not self.known.room_for(len(new)):
            new = np.arange(len(pieces))
        if len(new):
            fresh = [pieces[i] for i in new.tolist()]
            self._learn(fresh)
            at[new] = self.known.find(fresh)
        pool, begin, length = self.known.slices_at(at)
        counts = per_text(starts, edges)
        if end_id is not None:  # one more piece, after the last piece of every text
            begin, length, pool = np.append(begin, len(pool)), np.append(length, 1), np.append(pool, np.uint32(end_id))
            codes = np.insert(codes, np.cumsum(counts), len(pieces))
            counts = counts + 1
        each = length[codes]
        bounds = np.concatenate([[0], np.cumsum(each)])[np.concatenate([[0], np.cumsum(counts)])]
        return spread(pool.astype(self.dtype), begin[codes], each), np.diff(bounds)


@lru_cache(maxsize=1)
def encoder_of(spec: str) -> Encoder:
    """One encoder per worker process, so that tasks share what it knows."""
    return Encoder(spec)


_STORE = "first_key long, last_key long, n_docs long, n_ids long, width int, keys binary, payload binary, index binary"
_STORE_TYPES = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary())


def _shard(keys: list[int], lengths: list[int], payload: list[np.ndarray], width: int) -> pa.RecordBatch:
    k, n = np.array(keys, np.int64), np.array(lengths, np.int64)
    offsets = np.cumsum(n) - n
    _, first = np.unique(k, return_index=True)
    row = (int(k[0]), int(k[-1]), len(k), int(n.sum()), width, k.astype("<i8").tobytes() + n.astype("<i8").tobytes(),
           b"".join(p.tobytes() for p in payload), build_index(k[first], offsets[first], n[first]))
    names = [c.split()[0] for c in _STORE.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, _STORE_TYPES, strict=True)], names)


def write(docs: DataFrame, path: str, spec: str, end_id: int | None = 1, text: str = "text", doc_id: str = "doc_id", shard_ids: int = SHARD_IDS) -> None:
    """Encode every text and write the store. ``spec`` is the content of a tokenizer file."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(spec)  # one vocabulary file
    rows = docs.select(F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(NULL_KEY)).alias("key"), F.col(f"`{text}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, keys, lengths, payload, held = encoder_of(shared.value), [], [], [], 0
        for batch in (p for whole in batches for p in portions(whole, 1)):
            ids, counts = encoder.batch(batch.column(1), end_id)
            at = 0
            for key, n in zip(batch.column(0).to_pylist(), counts.tolist(), strict=True):
                if keys and (held + n > shard_ids or len(keys) == SHARD_DOCS):
                    yield _shard(keys, lengths, payload, encoder.width)
                    keys, lengths, payload, held = [], [], [], 0
                keys.append(key)
                lengths.append(n)
                payload.append(ids[at : at + n].copy())
                at, held = at + n, held + n
        if keys:
            yield _shard(keys, lengths, payload, encoder.width)

    # A key with many rows is split by the hash of the text, and equal rows by the task that read them; sorting
    # keeps each task's stream in key order.
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = rows.withColumns({"_h": F.xxhash64("text"), "_p": F.spark_partition_id()})
    ordered = placed.repartitionByRange(n, "key", "_h", "_p").sortWithinPartitions("key", "_h")
    ordered.select("key", "text").mapInArrow(run, _STORE).write.option("parquet.block.size", str(32 << 20)).parquet(path)


def _shards(spark, path: str) -> DataFrame:
    """The shards with their place: ``file``, and ``row`` in it."""
    place = {"file": F.col("_metadata.file_path"), "row": F.col("_metadata.row_index")}
    return spark.read.schema(_STORE).parquet(path).withColumns(place)


def read(spark, path: str) -> DataFrame:
    """The store's shards with ``start``: the number of ids in all shards before."""
    shards = _shards(spark, path)
    # Offsets of shards: totals by file first, so that no window holds more than the shards of one file or one row per file.
    sizes = shards.select("file", "row", "first_key", "last_key", "n_ids")
    files = sizes.groupBy("file").agg(F.min("first_key").alias("low"), F.max("last_key").alias("high"), F.sum("n_ids").alias("n"))
    before = Window.orderBy("low", "high", "file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("file").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        sizes.withColumn("within", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)))
        .join(files, "file")
        .select("file", "row", (F.col("base") + F.col("within")).alias("start"))
    )
    return shards.join(written(starts, "store-starts"), ["file", "row"]).drop("file", "row")


_DOCUMENTS = "doc_id long, start long, n_tokens long, ids_crc32 long"


def documents(shards: DataFrame, with_ids: bool = False) -> DataFrame:
    """Per document: doc_id, start, n_tokens, ids_crc32 (of the ids as unsigned 32-bit integers), and the ids if asked for.

    Every first occurrence of a key is located through the shard's hash index.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = {c: batch.column(c)[at].as_py() for c in ("keys", "payload", "index", "width", "n_docs", "start")}
                n = row["n_docs"]
                keys, lengths = np.frombuffer(row["keys"], "<i8", n), np.frombuffer(row["keys"], "<i8", n, 8 * n)
                ids = np.frombuffer(row["payload"], f"<u{row['width']}")
                known, offsets, sizes = Index(row["index"]).find(keys)
                first = np.concatenate([[True], keys[1:] != keys[:-1]]) if n else np.zeros(0, bool)
                stored = np.cumsum(lengths) - lengths
                if not known.all() or (offsets[first] != stored[first]).any() or (sizes[first] != lengths[first]).any():
                    raise ValueError("the index and the payload of a shard disagree")
                offsets = np.where(first, offsets, stored)
                parts = [ids[o : o + m].astype("<u4").tobytes() for o, m in zip(offsets.tolist(), lengths.tolist(), strict=True)]
                out = [
                    pa.array(keys, mask=keys == NULL_KEY),
                    pa.array(row["start"] + offsets),
                    pa.array(lengths),
                    pa.array([zlib.crc32(p) for p in parts], pa.int64()),
                ]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    out.append(pa.array(parts, pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(out, names)

    return shards.select("keys", "payload", "index", "width", "n_docs", "start").mapInArrow(run, _DOCUMENTS + (", ids binary" if with_ids else ""))


def _located(shards: DataFrame, wanted: DataFrame) -> DataFrame:
    """file, row, keys: the first shard whose key range has each key, for lists of at most SHARD_DOCS keys.

    Last keys of shards and wanted keys are sorted together, from the largest down, and each key takes the nearest
    shard above it: one range shuffle of narrow rows, and one value carried from partition to partition.
    """
    ends = shards.select(F.col("last_key").alias("key"), "first_key", F.struct("file", "row").alias("shard"))
    asked = wanted.select("key", F.lit(None).cast("long").alias("first_key"), F.lit(None).cast("struct<file: string, row: bigint>").alias("shard"))
    # Of shards with one last key the first one comes last, next to the keys asked for.
    order = [F.col("key").desc(), F.col("shard").desc_nulls_last()]
    lined = ends.unionByName(asked).withColumn("_asks", F.col("shard").isNull()).repartitionByRange(*order).sortWithinPartitions(*order)
    lined = written(lined.withColumn("_tag", F.monotonically_increasing_id()), "store-lined")
    lined = lined.withColumn("_block", F.shiftright("_tag", 33))  # the partition
    met = carry_forward(lined, ["shard", "first_key"], [], "_block", ["_tag"]).where("_asks AND first_key <= key")
    some = F.expr(f"_tag div {SHARD_DOCS}").alias("_some")  # bounds a list, whatever is asked for
    return met.groupBy("shard.file", "shard.row", some).agg(F.collect_list("key").alias("asked")).drop("_some")


def lookup(spark, path: str, keys: DataFrame, key: str = "doc_id") -> DataFrame:
    """Keyed access: key, found, n_tokens, ids (32-bit little endian; null if unknown) for the distinct given keys.

    A shard's index answers without a scan of its keys; of rows with equal keys the first is given.
    """
    shards = _shards(spark, path)
    wanted = keys.select(F.col(f"`{key}`").cast("long").alias("key")).where("key IS NOT NULL").distinct()
    met = _located(shards, wanted).join(shards, ["file", "row"]).select("asked", "payload", "index", "width")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                asked, payload, index, width = (batch.column(c)[at].as_py() for c in ("asked", "payload", "index", "width"))
                known, offset, length = Index(index).find(np.array(asked, np.int64))
                ids = [
                    np.frombuffer(payload, f"<u{width}", n, o * width).astype("<u4").tobytes()
                    for o, n in zip(offset[known].tolist(), length[known].tolist(), strict=True)
                ]
                found = np.array(asked, np.int64)[known]
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(ids, pa.binary())], ["key", "ids"])

    hit = met.mapInArrow(run, "key long, ids binary")
    return wanted.join(hit, "key", "left").select(
        F.col("key").alias(key), F.col("ids").isNotNull().alias("found"), (F.length("ids") / 4).cast("long").alias("n_tokens"), "ids"
    )
