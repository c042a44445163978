import hashlib
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from reelgauge.llm import bpe, chat_format, pieces, token_store
from reelgauge.llm.chat_format import Template
from reelgauge.session import scratch_path

BYTE = Path(public_tokenizers.path("byte_bpe_50k.json")).read_text(encoding="utf-8")
WORD = Path(public_tokenizers.path("word_bpe_49k.json")).read_text(encoding="utf-8")

#: Pieces that meet in bad places: contractions, stops, several kinds of white space, special tokens, marks, astral letters.
BITS = ["a", "The", "ing", "'s", "'ll", "'", ".", ",", " ", "  ", "\n", "\t", "é", "e\u0301", "\u00a0", "\u2003", "\x1c", "\x85", "<|endoftext|>",
        "<|ENDOFTEXT|>", "<|startoftext|>", "<", "1", "²", "ß", "İ", "Σ", "ﬁ", "𝔸", "中", "!", "_"]
texts = st.lists(st.lists(st.sampled_from(BITS), max_size=12).map("".join), max_size=20)


@pytest.fixture(scope="module")
def byte_vocabulary():
    return bpe.Vocabulary(BYTE)


@pytest.fixture(scope="module")
def byte_reference():
    return Tokenizer.from_str(BYTE)


@pytest.fixture(scope="module")
def word_pair():
    return token_store.Encoder(WORD), Tokenizer.from_str(WORD)


@settings(max_examples=150, deadline=None)
@given(texts, st.lists(st.sampled_from([b"a", b" The", b" a", b"ing", " é".encode(), b"The", b"."]), unique=True))
def test_byte_bpe_equals_the_library(byte_vocabulary, byte_reference, given_texts, lexicon_words):
    lexicon = bpe.Lexicon(bpe.compile_lexicon(lexicon_words, byte_vocabulary))
    ids, bounds = bpe.WordEncoder(byte_vocabulary, lexicon).batch(pa.array(given_texts, pa.string()))
    for i, text in enumerate(given_texts):
        want = byte_reference.encode(text, add_special_tokens=False).ids
        assert ids[bounds[i] : bounds[i + 1]].tolist() == want
        decoded = b"".join(byte_vocabulary.bytes_of[x] for x in want).decode("utf-8", "replace")
        assert decoded == byte_reference.decode(want, skip_special_tokens=False)


def test_long_words_merge_alike(byte_vocabulary, byte_reference, words):
    for text in ["a" * 700, "abcdefgh" * 200, "é" * 300, "".join(words(100, "long")), "-" * 1000]:
        ids, _ = bpe.WordEncoder(byte_vocabulary, None).batch(pa.array([text]))
        assert ids.tolist() == byte_reference.encode(text, add_special_tokens=False).ids


def test_automaton_is_minimal_and_numbers_words(byte_vocabulary):
    words = [b"walking", b"talking", b"walked", b"talked", b"walk", b"talk"]
    builder = bpe.Builder()
    for w in sorted(words):
        builder.add(w)
    # Both stems share every state after their first letter: root, t/w, a, l, k (final), e, d, i, n, g with one final end.
    assert len(builder.arrays()["final"]) == 9
    lexicon = bpe.Lexicon(bpe.compile_lexicon(words, byte_vocabulary))
    asked = [*sorted(words), b"wal", b"walks", b"", b"x", b"walkingly"]
    assert lexicon.numbers(asked).tolist() == [0, 1, 2, 3, 4, 5, -1, -1, -1, -1, -1]
    with pytest.raises(ValueError):
        builder.add(b"a")


def test_unsupported_tokenizers_are_refused():
    with pytest.raises(ValueError):
        bpe.Vocabulary(WORD)
    with pytest.raises(ValueError):
        token_store.Encoder(BYTE)


def test_encode_decode_tables(spark, plain_docs, odd_texts, byte_reference):
    docs = plain_docs([(i // 2, t) for i, t in enumerate(odd_texts)]).withColumn("ids", pa_lit("mine"))
    compiled = bpe.lexicon(docs, BYTE, size=50)
    assert compiled == bpe.lexicon(docs.repartition(3), BYTE, size=50)
    encoded = bpe.encode(docs, BYTE, compiled)
    got = bpe.decode(encoded, BYTE).collect()
    want = []
    for i, t in enumerate(odd_texts):
        ids = byte_reference.encode(t or "", add_special_tokens=False).ids
        want.append((i // 2, len(ids), np.array(ids, "<u4").tobytes(), t or ""))
    assert sorted((r.doc_id, r.n_tokens, bytes(r.ids), r.text) for r in got) == sorted(want)
    empty = docs.limit(0)
    assert bpe.encode(empty, BYTE, bpe.lexicon(empty, BYTE)).count() == 0


def pa_lit(value):
    from pyspark.sql import functions as F

    return F.lit(value)


def test_word_counts_cover_all_rows(plain_docs):
    docs = plain_docs([(i, "of the. of") for i in range(50)])
    counts = {bytes(r.word): r.n for r in bpe.word_counts(docs.repartition(4), BYTE).collect()}
    assert counts == {b"of": 50, b" the": 50, b".": 50, b" of": 50}


def test_cache_may_forget(byte_vocabulary, byte_reference, words):
    encoder = bpe.WordEncoder(byte_vocabulary, None)
    encoder.known = pieces.IdStore(5)
    for k in range(4):
        text = " ".join(words(40, f"forget{k}"))
        ids, _ = encoder.batch(pa.array([text]))
        assert ids.tolist() == byte_reference.encode(text, add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(texts)
def test_word_bpe_equals_the_library(word_pair, given_texts):
    encoder, reference = word_pair
    ids, counts = encoder.batch(pa.array(given_texts, pa.string()), 1)
    assert len(counts) == len(given_texts)
    at = 0
    for text, n in zip(given_texts, counts.tolist(), strict=True):
        assert ids[at : at + n].tolist() == [*reference.encode(text, add_special_tokens=False).ids, 1]
        at += n


#: What may stand next to a letter: symbols with and without meaning to special tokens, digits, marks that combine, letters of two bytes.
BORDERS = ["a", "Ab", "s", "t", "é", "É", "ß", "ÿ", "×", "÷", "ā", "$", "$$", "(", ")", "=", "%", "#", "'", "'s", "<", "|", ">", "<|", "|>", "endoftext",
           "<|endoftext|>", "0", "12", "²", "€", "\u0301", "\u0338", "\u20e3", "\x7f", "\x01", "Ω", "Σ", "中", ".", ",", " "]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(BORDERS), max_size=10).map("".join), max_size=12))
def test_cuts_at_symbols_equal_the_library(word_pair, given_texts):
    encoder, reference = word_pair
    ids, counts = encoder.batch(pa.array(given_texts, pa.string()), None)
    want = [reference.encode(text, add_special_tokens=False).ids for text in given_texts]
    assert counts.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]


def test_words_are_learned_once_whatever_stands_next_to_them():
    encoder, reference = token_store.Encoder(WORD), Tokenizer.from_str(WORD)
    text = "Valley valley, VALLEY\n(valley) valley$$$ valley%\tvalley9 caf\u00e9 caf\u00e9, caf\u00e9! valley"
    ids, _ = encoder.batch(pa.array([text]), None)
    assert ids.tolist() == reference.encode(text, add_special_tokens=False).ids
    assert sorted(encoder.known.slot) == sorted([b"valley", "caf\u00e9".encode(), *b", ( ) $$$ % 9 !".split()])


def test_letters_compose_with_marks_before_they_get_lower_case():
    """There is one character for h and this mark, and none for H and it."""
    encoder, reference = token_store.Encoder(WORD), Tokenizer.from_str(WORD)
    for text in ["H\u0331", "AT\u0308a", "W\u030a Y\u030a J\u030c", "H\u05b0\u0331", "h\u0331 H\u0331"]:
        ids, _ = encoder.batch(pa.array([text, "\u0331"]), None)
        assert ids.tolist() == [i for t in (text, "\u0331") for i in reference.encode(t, add_special_tokens=False).ids]


def test_texts_that_touch_share_no_character():
    """Bytes that are no UTF-8 are replacement characters, also where the next text would complete them."""
    encoder, reference = token_store.Encoder(WORD), Tokenizer.from_str(WORD)
    parts = [b"a$\xc3", b"\xa9$ b", b"\xc3", b"\xa9a", b"", b"x\xc3\xa9$"]
    data, edges = b"".join(parts), np.cumsum([0, *map(len, parts)]).astype(np.int32)
    texts = pa.StringArray.from_buffers(len(parts), pa.py_buffer(edges), pa.py_buffer(data))
    ids, counts = encoder.batch(texts, None)
    want = [reference.encode(p.decode("utf-8", "replace"), add_special_tokens=False).ids for p in parts]
    assert counts.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(-(1 << 63), (1 << 63) - 1), max_size=300), st.integers(0, 5))
def test_hash_index_is_minimal_and_perfect(keys, seed):
    k = np.array(sorted(keys), np.int64)
    n = np.arange(len(k)) * 7 + seed
    data = token_store.build_index(k, n, n + 1)
    index = token_store.Index(data)
    known, offset, length = index.find(k)
    assert known.all() and offset.tolist() == n.tolist() and length.tolist() == (n + 1).tolist()
    assert len(index.slots) == len(k)


def test_hash_index_rejects_unknown_keys():
    index = token_store.Index(token_store.build_index(np.arange(5000), np.arange(5000), np.ones(5000, int)))
    known, offset, length = index.find(np.arange(5000, 105_000))
    assert known.sum() == 0 and offset.sum() == 0 and length.sum() == 0
    with pytest.raises(ValueError):
        token_store.build_index(np.array([1, 1]), np.zeros(2), np.zeros(2))
    with pytest.raises(ValueError):
        token_store.Index(b"something")


def test_store_round_trip(spark, plain_docs, odd_texts, words):
    rows = [(i * 3 - 20, t) for i, t in enumerate(odd_texts)] + [(1000 + i, " ".join(words(i % 50, f"s{i}"))) for i in range(200)]
    docs = plain_docs(rows).repartition(5)
    path = scratch_path(spark, "test-store")
    token_store.write(docs, path, WORD, end_id=1, shard_ids=300)
    assert spark.read.parquet(path).count() > 5
    reference, want, start = Tokenizer.from_str(WORD), {}, 0
    for i, t in sorted(rows):
        ids = np.array([*reference.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        want[i] = (start, len(ids), zlib.crc32(ids.tobytes()), ids.tobytes())
        start += len(ids)
    got = token_store.documents(token_store.read(spark, path), with_ids=True).collect()
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32, bytes(r.ids)) for r in got} == want and len(got) == len(rows)
    asked = spark.createDataFrame([(-20,), (1005,), (5,), (999_999,), (None,)], "doc_id long")
    found = {r.doc_id: (r.found, r.ids and bytes(r.ids)) for r in token_store.lookup(spark, path, asked).collect()}
    assert found == {-20: (True, want[-20][3]), 1005: (True, want[1005][3]), 5: (False, None), 999_999: (False, None)}


def test_store_of_repeated_null_and_no_keys(spark, plain_docs):
    docs = plain_docs([(7, "a b"), (7, "c"), (None, "d"), (7, "a b"), (1, None)])
    path = scratch_path(spark, "test-store")
    token_store.write(docs, path, WORD)
    got = token_store.documents(token_store.read(spark, path)).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens) for r in got) == [(False, 1, 1), (False, 7, 2), (False, 7, 3), (False, 7, 3), (True, 0, 2)]
    assert sorted(r.start for r in got)[0] == 0
    empty = scratch_path(spark, "test-store")
    token_store.write(docs.limit(0), empty, WORD)
    assert token_store.documents(token_store.read(spark, empty)).count() == 0
    assert [r.found for r in token_store.lookup(spark, empty, docs).collect()] == [False, False]


def test_store_of_one_key_in_many_equal_shards(spark, plain_docs):
    docs = plain_docs([(7, "a b c")] * 200 + [(i, f"w{i} b") for i in range(0, 400, 2)]).repartition(6)
    path = scratch_path(spark, "test-store")
    token_store.write(docs, path, WORD, shard_ids=8)
    shards = spark.read.parquet(path)
    assert shards.where("first_key = 7 AND last_key = 7").count() > 50
    got = sorted((r.start, r.n_tokens, r.doc_id) for r in token_store.documents(token_store.read(spark, path)).collect())
    assert [i for _, _, i in got] == sorted([7] * 200 + list(range(0, 400, 2)))
    assert got[0][0] == 0 and all(a[0] + a[1] == b[0] for a, b in zip(got, got[1:], strict=False))
    asked = spark.range(-5, 420).withColumnRenamed("id", "doc_id")
    found = [(r.doc_id, r.found, r.n_tokens) for r in token_store.lookup(spark, path, asked.union(asked)).collect()]
    tokens = {i: n for _, n, i in got}
    assert sorted(found, key=lambda f: f[0]) == [(i, i in tokens, tokens.get(i)) for i in range(-5, 420)]
    plan = token_store.lookup(spark, path, asked)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.sampled_from(["user", "\n", "\\", "n", "<|turn|>", "\\n", "x"]), max_size=6).map("".join),
                          st.lists(st.sampled_from(["</s>", "[INST]", "[/INST]", "<|turn|>", "<|end|>", "\\", "\n", "<", "<<SYS>>", "<|", "end|>", "a"]), max_size=10).map("".join))))
def test_template_round_trip(turns):
    template = Template()
    escape, parser = template.escaper(), chat_format.Parser(template)
    text = "".join(
        template.opening + chat_format.escape_role(escape, role) + template.after_role + escape(said) + template.closing for role, said in turns
    )
    assert list(parser.turns(text)) == turns


def test_ambiguous_templates_are_refused():
    for extra in ("ab<|e", ">|<", "a\\", "", "x<"):
        with pytest.raises(ValueError):
            Template(controls=(*Template().controls, extra))
    with pytest.raises(ValueError):
        Template(opening="##")


def test_conversations(spark):
    said = "</s>[INST] ok [/INST]"
    rows = [
        (1, 1, "assistant", said), (1, 0, "user", said), (2, 0, "system", "s"), (2, 1, "user", None), (2, 2, "assistant", ""), (2, 3, "user", "q"),
        (3, 0, "assistant", "first"), (3, 1, "user", "x"), (None, 0, "user", "n"), (None, 0, None, "tie"), (4, 0, "user", "u"), (4, 0, "user", "u"),
    ]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "'mine' AS state")
    formatted = chat_format.format_turns(table)
    got = {r.conv_id: r for r in chat_format.read_back(formatted).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert got[1].turns_sha256 == sha(f"user\n{said}\nassistant\n{said}\n") and got[1].loss_sha256 == sha(said) and got[1].loss_chars == len(said)
    assert got[1].valid and got[1].n_turns == 2
    assert not got[2].valid and got[2].fault == "ends after asked" and got[2].loss_chars == 0 and got[2].loss_sha256 == sha("")
    assert got[3].fault == "assistant after start" and got[3].loss_sha256 == sha("first")
    assert got[None].turns_sha256 == sha("\ntie\nuser\nn\n") and got[4].fault == "user after asked" and got[4].n_turns == 2
    one = [r for r in formatted.collect() if r.conv_id == 1]
    assert [s.loss for s in one[1].segments] == [False, True, False] and "</s>" not in one[1].segments[1].text.replace("\\</s>", "")
    assert sum(len(s.text) for r in one for s in r.segments) == got[1].formatted_chars
    assert chat_format.read_back(chat_format.format_turns(table.limit(0))).count() == 0


def test_long_conversation_spans_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        rows = [(9, i, ("user", "assistant")[i % 2], f"t{i}") for i in range(1000)]
        table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
        row = chat_format.read_back(chat_format.format_turns(table)).first()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = "".join(f"{r}\n{t}\n" for _, _, r, t in rows)
    assert row.n_turns == 1000 and row.valid and row.turns_sha256 == hashlib.sha256(want.encode()).hexdigest()
