"""Byte-level BPE with a minimal acyclic transducer of frequent words.

The words of the whole corpus are counted (a word goes up to the next single space, full stop or comma, and has its
own space in front), and the most frequent ones are encoded and compiled into a minimal acyclic automaton: words that share
an ending share its states. Arcs carry outputs whose sum along a word is the word's number, and the number
leads to the word's ids. The automaton is a few arrays in one buffer of bounded size; every Python worker
maps it from an unlinked file. All distinct words of an Arrow batch walk it together, one array step per byte.

Words that the lexicon does not have are split by the tokenizer's pattern and merged exactly, pair by pair in
order of rank, with a heap once they are long; a bounded cache keeps the last results. The lexicon only saves
time: ids are the same without it.

A text may be cut before every single space that a visible character follows, and between a letter and a full stop
or comma, since no token of this kind crosses these places. Special tokens in a text are found first, as the tokenizers library does.

Cases: null texts are empty and have no ids; ids outside the vocabulary can't be decoded and raise; bytes that are not
UTF-8 decode to U+FFFD; repeated rows repeat; an empty table gives an empty lexicon and an empty result; other
columns are not read.
"""

from __future__ import annotations

import heapq
import json
import mmap
import re
import tempfile
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelgauge.llm.pieces import IdStore, distinct, per_text, portions, spread, text_bytes
from reelgauge.llm.tables import written

#: Words of the lexicon, and the longest word it takes, in bytes: together they bound its size.
LEXICON_WORDS = 65_536
LEXICON_BYTES = 32
_LONG = 48
_NONE = 1 << 62
_NO_MERGE = (_NONE, 0)

#: Fixed value: the pattern of byte-level BPE, with white space spelt out.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"

#: Bytes that begin a visible character for certain (the lead bytes of other white space are left out).
_VISIBLE = np.zeros(256, bool)
_VISIBLE[0x21:0x7F] = True
_VISIBLE[0x80:] = True
_VISIBLE[[0xC2, 0xE1, 0xE2, 0xE3]] = False
_STOP, _LETTER = np.zeros(256, bool), np.zeros(256, bool)
_STOP[list(b".,")] = True
_LETTER[list(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")] = True


def byte_of_char() -> dict[str, int]:
    """The characters that stand for bytes: printable ones for themselves, the others from 256 on."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """Bytes, merges and special tokens of a tokenizer file."""

    def __init__(self, spec: str):
        described = json.loads(spec)
        model, pre, decoder = described["model"], described.get("pre_tokenizer") or {}, described.get("decoder") or {}
        if (
            model["type"] != "BPE" or described.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space")
            or not pre.get("use_regex", True) or decoder.get("type") != "ByteLevel" or model.get("dropout") or model.get("ignore_merges")
            or model.get("byte_fallback") or model.get("continuing_subword_prefix") or model.get("end_of_word_suffix")
        ):
            raise ValueError("not a plain byte-level BPE tokenizer")
        added = described["added_tokens"]
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in added):
            raise ValueError("special tokens with conditions are not supported")
        to_byte, vocab = byte_of_char(), model["vocab"]
        self.bytes_of: dict[int, bytes] = {}
        for token, i in [*vocab.items(), *((t["content"], t["id"]) for t in added)]:
            whole = all(c in to_byte for c in token)
            self.bytes_of[i] = bytes(to_byte[c] for c in token) if whole else token.encode()
        self.first = [vocab[c] for c, _ in sorted(to_byte.items(), key=lambda x: x[1])]
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.merges = {(vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in enumerate(pairs)}
        self.special = {t["content"].encode(): t["id"] for t in added}
        names = sorted((t["content"] for t in added), key=len, reverse=True)
        self.find_special = re.compile("|".join(map(re.escape, names)).encode()) if names else None

    def merge(self, data: bytes) -> list[int]:
        """Ids of one word: the pair of lowest rank, leftmost first, is merged until none is left."""
        ids = [self.first[b] for b in data]
        return self._merge_long(ids) if len(ids) > _LONG else self._merge_short(ids)

    def _merge_short(self, ids: list[int]) -> list[int]:
        get = self.merges.get
        ranks = [get(pair, _NO_MERGE)[0] for pair in pairwise(ids)]
        while ranks:
            best = min(ranks)
            if best == _NONE:
                break
            i = ranks.index(best)
            ids[i : i + 2] = [get((ids[i], ids[i + 1]))[1]]
            del ranks[i]
            if i:
                ranks[i - 1] = get((ids[i - 1], ids[i]), _NO_MERGE)[0]
            if i < len(ranks):
                ranks[i] = get((ids[i], ids[i + 1]), _NO_MERGE)[0]
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        n, get = len(ids), self.merges.get
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = [(found[0], i, pair) for i, pair in enumerate(pairwise(ids)) if (found := get(pair))]
        heapq.heapify(heap)
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = right[i] if ids[i] >= 0 else -1
            if j < 0 or (ids[i], ids[j]) != pair:
                continue  # one of the two has been merged since
            ids[i], ids[j] = get(pair)[1], -1
            right[i] = right[j]
            if right[j] >= 0:
                left[right[j]] = i
                if found := get((ids[i], ids[right[i]])):
                    heapq.heappush(heap, (found[0], i, (ids[i], ids[right[i]])))
            if left[i] >= 0 and (found := get((ids[left[i]], ids[i]))):
                heapq.heappush(heap, (found[0], left[i], (ids[left[i]], ids[i])))
        return [i for i in ids if i >= 0]


def word_starts(data: np.ndarray, edges: np.ndarray, find_special: re.Pattern | None) -> np.ndarray:
    """Where words begin: at texts, at single spaces before visible characters, at full stops and commas after
    letters, and around special tokens."""
    begins = np.zeros(len(data), bool)
    begins[:-1] = (data[:-1] == 0x20) & _VISIBLE[data[1:]]
    begins[edges[1:][edges[1:] > 0] - 1] = False  # the next byte is another text's
    begins[1:] |= _STOP[data[1:]] & _LETTER[data[:-1]]
    begins[edges[:-1][edges[:-1] < len(data)]] = True
    whole = data.tobytes() if find_special else b""
    if find_special and find_special.search(whole):
        for lo, hi in pairwise(edges.tolist()):
            after = lo
            for m in find_special.finditer(whole, lo, hi):
                if m.start() - 1 > after:
                    begins[m.start() - 1] = False  # for the pattern, a text ends here
                begins[m.start() : m.end()] = False
                begins[m.start()] = True
                after = m.end()
                if after < hi:
                    begins[after] = True
    return np.flatnonzero(begins)


class Builder:
    """Minimal acyclic automaton of sorted byte strings, built word by word: finished branches are looked up
    in a register of states, and a state equal to an earlier one is replaced by it."""

    def __init__(self) -> None:
        self.arcs: list[dict[int, int]] = [{}]
        self.final: list[bool] = [False]
        self.register: dict[tuple, int] = {}
        self.open: list[tuple[int, int, int]] = []  # (state, byte, child) along the last word
        self.last = b""

    def add(self, word: bytes) -> None:
        if self.last and word <= self.last:
            raise ValueError("words must ascend")
        same = 0
        for a, b in zip(word, self.last, strict=False):
            if a != b:
                break
            same += 1
        self._close(same)
        state = self.open[-1][2] if self.open else 0
        for byte in word[same:]:
            self.arcs.append({})
            self.final.append(False)
            child = len(self.arcs) - 1
            self.arcs[state][byte] = child
            self.open.append((state, byte, child))
            state = child
        self.final[state] = True
        self.last = word

    def _close(self, upto: int) -> None:
        while len(self.open) > upto:
            state, byte, child = self.open.pop()
            shape = (self.final[child], tuple(self.arcs[child].items()))
            self.arcs[state][byte] = self.register.setdefault(shape, child)

    def arrays(self) -> dict[str, np.ndarray]:
        """Reachable states, renumbered; arcs sorted by (state, byte) with target and output."""
        self._close(0)
        number, order, stack = {0: 0}, [0], [0]
        while stack:
            for child in self.arcs[stack.pop()].values():
                if child not in number:
                    number[child] = len(order)
                    order.append(child)
                    stack.append(child)
        below: dict[int, int] = {}
        todo = [(0, False)]
        while todo:
            state, seen = todo.pop()
            if state in below:
                continue
            if seen:
                below[state] = self.final[state] + sum(below[c] for c in self.arcs[state].values())
            else:
                todo += [(state, True), *((c, False) for c in self.arcs[state].values())]
        keys, targets, outputs = [], [], []
        for i, state in enumerate(order):
            passed = int(self.final[state])
            for byte, child in sorted(self.arcs[state].items()):
                keys.append(i << 8 | byte)
                targets.append(number[child])
                outputs.append(passed)
                passed += below[child]
        return {
            "keys": np.array(keys, np.int64),
            "targets": np.array(targets, np.int32),
            "outputs": np.array(outputs, np.int32),
            "final": np.array([self.final[s] for s in order], np.uint8),
        }


def compile_lexicon(words: Sequence[bytes], vocabulary: Vocabulary) -> bytes:
    """Words with their ids as one buffer: a JSON line with names, types and lengths, then the arrays."""
    encoder = WordEncoder(vocabulary, None)
    builder, ids, starts = Builder(), [], [0]
    for word in sorted(set(words)):
        builder.add(word)
        ids += encoder.exact(word)
        starts.append(len(ids))
    arrays = builder.arrays() | {"starts": np.array(starts, np.int32), "ids": np.array(ids, np.uint32)}
    head = json.dumps({name: [str(a.dtype), len(a)] for name, a in arrays.items()}).encode()
    head = head.ljust(-(-(len(head) + 1) // 8) * 8 - 1) + b"\n"
    return head + b"".join(a.tobytes().ljust(-(-a.nbytes // 8) * 8, b"\0") for a in arrays.values())


class Lexicon:
    """The compiled lexicon, mapped from a file that is unlinked at once."""

    def __init__(self, data: bytes):
        with tempfile.TemporaryFile() as file:
            file.write(data)
            file.flush()
            self.map = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        at = data.index(b"\n") + 1
        for name, (kind, n) in json.loads(data[:at]).items():
            array = np.frombuffer(self.map, kind, n, at)
            setattr(self, name, array)
            at += -(-array.nbytes // 8) * 8

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """The number of each word, or -1; all words walk together."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        text = np.frombuffer(b"".join(words), np.uint8)
        begins = np.cumsum(lengths) - lengths
        state, number = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        out = np.full(len(words), -1, np.int64)
        alive = np.flatnonzero((lengths > 0) & (lengths <= LEXICON_BYTES)) if len(self.keys) else np.zeros(0, np.int64)
        step = 0
        while len(alive):
            key = state[alive] << 8 | text[begins[alive] + step]
            arc = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            ok = self.keys[arc] == key
            alive, arc = alive[ok], arc[ok]
            state[alive] = self.targets[arc]
            number[alive] += self.outputs[arc]
            step += 1
            ended = lengths[alive] == step
            done = alive[ended]
            done = done[self.final[state[done]] == 1]
            out[done] = number[done]
            alive = alive[~ended]
        return out


class WordEncoder:
    """Ids of words, from the lexicon or by exact merging."""

    CACHE = 300_000

    def __init__(self, vocabulary: Vocabulary, lexicon: Lexicon | None):
        self.vocabulary, self.lexicon = vocabulary, lexicon
        self.pattern = regex.compile(PATTERN)
        self.known = IdStore(self.CACHE)

    def exact(self, word: bytes) -> list[int]:
        special = self.vocabulary.special.get(word)
        if special is not None:
            return [special]
        ids: list[int] = []
        for piece in self.pattern.findall(word.decode("utf-8", "surrogatepass")):
            ids += self.vocabulary.merge(piece.encode("utf-8", "surrogatepass"))
        return ids

    def _unseen(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        slot = self.known.slot
        new = [w for w in words if w not in slot]
        if not self.known.room_for(len(new)):
            new = words
        ids = [self.exact(w) for w in new]
        self.known.add_all(new, np.array([i for x in ids for i in x], np.uint32), np.fromiter(map(len, ids), np.int64, len(ids)))
        return self.known.slices(words)

    def slices(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pool, start, length) of the ids of distinct words."""
        lexicon = self.lexicon
        if lexicon is None:
            return self._unseen(words)
        number = lexicon.numbers(words)
        hit, miss = np.flatnonzero(number >= 0), np.flatnonzero(number < 0)
        pool, start, length = self._unseen([words[i] for i in miss.tolist()])
        begins, lengths = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        begins[hit], lengths[hit] = lexicon.starts[number[hit]], np.diff(lexicon.starts)[number[hit]]
        begins[miss], lengths[miss] = start + len(lexicon.ids), length
        return np.concatenate([lexicon.ids, pool]), begins, lengths

    def batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of all texts, and where each text's begin and the last ends."""
        data, edges = text_bytes(texts)
        starts = word_starts(data, edges, self.vocabulary.find_special)
        codes, words = distinct(data, starts)
        pool, begin, length = self.slices(words)
        each = length[codes]
        bounds = np.concatenate([[0], np.cumsum(each)])[np.concatenate([[0], np.cumsum(per_text(starts, edges))])]
        return spread(pool.astype("<u4"), begin[codes], each), bounds


@lru_cache(maxsize=1)
def vocabulary_of(spec: str) -> Vocabulary:
    return Vocabulary(spec)


@lru_cache(maxsize=1)
def encoder_of(spec: str, compiled: bytes | None) -> WordEncoder:
    """One encoder per worker process, so that tasks share the mapped lexicon and what has been merged."""
    return WordEncoder(vocabulary_of(spec), Lexicon(compiled) if compiled else None)


def word_counts(docs: DataFrame, spec: str, text: str = "text") -> DataFrame:
    """word, n: how often each word that may enter the lexicon occurs in the whole table."""
    shared = docs.sparkSession.sparkContext.broadcast(spec)  # one vocabulary file

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = vocabulary_of(shared.value)
        for batch in (p for whole in batches for p in portions(whole, 0)):
            data, edges = text_bytes(batch.column(0))
            codes, words = distinct(data, word_starts(data, edges, vocabulary.find_special))
            n = np.bincount(codes, minlength=len(words))
            fits = [i for i, w in enumerate(words) if len(w) <= LEXICON_BYTES and w not in vocabulary.special]
            yield pa.RecordBatch.from_arrays([pa.array([words[i] for i in fits], pa.binary()), pa.array(n[fits], pa.int64())], ["word", "n"])

    return docs.select(F.col(f"`{text}`").alias("text")).mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def lexicon(docs: DataFrame, spec: str, text: str = "text", size: int = LEXICON_WORDS) -> bytes:
    """The compiled lexicon of the most frequent words, ``size`` at most.

    Words are taken from the top in steps of count (64 to the octave), whole steps only. So the driver gets one row per
    step and then the words themselves, never a candidate list of every partition. A word that occurs once saves nothing.
    """
    step = F.floor(F.log2(F.col("n").cast("double")) * 64).cast("int")
    counts = written(word_counts(docs, spec, text).where("n > 1").withColumn("step", step), "bpe-words")
    left, low = size, None
    for row in sorted(counts.groupBy("step").agg(F.count("*").alias("words")).collect(), key=lambda r: -r["step"]):
        left -= row["words"]
        if left < 0:
            break
        low = row["step"]
    top = counts.where(F.col("step") >= low).select("word").collect() if low is not None else []
    return compile_lexicon([bytes(r["word"]) for r in top], vocabulary_of(spec))


def _text_of(ids: bytes | None, bytes_of: dict[int, bytes]) -> str:
    return b"".join(map(bytes_of.__getitem__, np.frombuffer(ids or b"", "<u4").tolist())).decode("utf-8", "replace")


def encode(
    docs: DataFrame, spec: str, compiled: bytes | None, keep: Sequence[str] = ("doc_id",), text: str = "text", decoded: bool = False
) -> DataFrame:
    """The kept columns, ``n_tokens`` and ``ids`` (unsigned 32-bit integers, little endian).

    ``decoded`` adds ``text``, decoded from the ids in the same Python worker.
    """
    context = docs.sparkSession.sparkContext
    shared, built = context.broadcast(spec), context.broadcast(compiled)  # one vocabulary file, one bounded lexicon
    rows = docs.select(*(F.col(f"`{k}`").alias(f"k{n}") for n, k in enumerate(keep)), F.col(f"`{text}`").alias("_text"))
    added = ["n_tokens", "ids", *["text"] * decoded]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(shared.value, built.value)
        for batch in (p for whole in batches for p in portions(whole, len(keep))):
            ids, bounds = encoder.batch(batch.column(len(keep)))
            data, edges = ids.tobytes(), (4 * bounds).tolist()
            each = [data[a:b] for a, b in pairwise(edges)]
            out = [pa.array(np.diff(bounds)), pa.array(each, pa.binary())]
            if decoded:
                out.append(pa.array([_text_of(i, encoder.vocabulary.bytes_of) for i in each], pa.string()))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *out], [*batch.schema.names[: len(keep)], *added])

    kinds = {"n_tokens": "long", "ids": "binary", "text": "string"}
    schema = rows.select(*rows.columns[:-1], *(F.lit(None).cast(kinds[c]).alias(c) for c in added)).schema
    return rows.mapInArrow(run, schema).select(*(F.col(f"k{n}").alias(k) for n, k in enumerate(keep)), *added)


def decode(encoded: DataFrame, spec: str, keep: Sequence[str] = ("doc_id", "n_tokens", "ids")) -> DataFrame:
    """The kept columns and ``text``, from a column ``ids``."""
    shared = encoded.sparkSession.sparkContext.broadcast(spec)
    rows = encoded.select(*(F.col(f"`{k}`").alias(f"k{n}") for n, k in enumerate(keep)), F.col("ids").alias("_ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bytes_of = vocabulary_of(shared.value).bytes_of
        for batch in batches:
            texts = [_text_of(i, bytes_of) for i in batch.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], pa.array(texts, pa.string())], [*batch.schema.names[: len(keep)], "text"]
            )

    schema = rows.select(*rows.columns[:-1], F.lit("").alias("text")).schema
    return rows.mapInArrow(run, schema).select(*(F.col(f"k{n}").alias(k) for n, k in enumerate(keep)), "text")
